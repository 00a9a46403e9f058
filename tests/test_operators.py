import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from agora.operators.keys import dense_key, range_layout, scratch, small_dense_key, stored_rows
from agora.operators.quality import Rule, WatchedRules, evaluate_rules, evaluate_suite, fail_count
from agora.operators.reshape import append_rows, fill_zero, pivot_avg
from agora.operators.windows import ordered_shares, rank_desc, share_of_partition
from agora.session import ensure_checkpoint_dir
from conftest import SF01, rows


def test_dense_key_equals_row_number_and_ignores_partitioning(spark):
    orders = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey", "o_custkey")
    expected = rows(orders.withColumn(
        "id", F.row_number().over(Window.orderBy("o_custkey", "o_orderkey")).cast("long")))
    for n in (1, 3, 7):
        got = rows(dense_key(orders.repartition(5), ["o_custkey", "o_orderkey"], "id", num_partitions=n))
        assert got == expected
    ids = [r[0] for r in dense_key(orders, ["o_custkey", "o_orderkey"], "id").select("id").collect()]
    assert sorted(ids) == list(range(1, orders.count() + 1))


def test_dense_key_hot_leading_value(spark):
    # one leading value holds most rows: range partitioning splits it by the next column
    df = spark.range(0, 3000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("k"),
                                     F.col("id").alias("t"))
    got = dense_key(df, ["k", "t"], "id", num_partitions=6)
    exp = df.withColumn("id", F.row_number().over(Window.orderBy("k", "t")).cast("long"))
    assert rows(got) == rows(exp)


def test_small_dense_key_nulls_last(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "x string")
    assert rows(small_dense_key(df, ["x"], "id")) == sorted([("a", 1), ("b", 2), (None, 3)], key=repr)


def test_share_of_partition_guards(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 3), ("z", 0), ("z", 0), ("n", None), ("n", None), (None, 2), (None, 2), ("m", None),
         ("m", 4)], "k string, v int")
    got = {(r.k, r.v, r.s) for r in share_of_partition(df, "v", ["k"], "s").collect()}
    assert ("a", 1, 25.0) in got and ("a", 3, 75.0) in got
    assert ("z", 0, 0.0) in got                    # total 0 -> 0
    assert ("n", None, None) in got                # total NULL -> NULL
    assert (None, 2, 50.0) in got                  # NULL key is one partition
    assert ("m", None, None) in got and ("m", 4, 100.0) in got


def test_rank_desc_matches_window_rank(spark):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 3), ("a", None), ("b", 1), ("b", 9)],
                               "k string, v int")
    exp = df.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last())))
    assert rows(rank_desc(df, "v", ["k"], "r")) == rows(exp)


def test_pivot_fill_and_patch(spark):
    df = spark.createDataFrame([("1", "x", 2.0), ("1", "x", 4.0), ("1", "y", None), ("2", "z", 1.0)],
                               "k string, cat string, v double")
    p = pivot_avg(df, ["k"], "cat", F.col("v"), {"x": "ax", "y": "ay"})
    assert rows(p) == [("1", 3.0, None), ("2", None, None)]
    patched = append_rows(p, [{"k": "9"}])
    filled = fill_zero(patched, ["ax", "ay"])
    assert rows(filled) == [("1", 3.0, 0.0), ("2", 0.0, 0.0), ("9", 0.0, 0.0)]


R3 = Rule(1, 1, "t", "c", "NOT_NULL", "3L", 95.0, 90.0, "m", error="c IS NULL", warn_ratio=0.05)
RPF = Rule(2, 1, "t", "c", "RANGE", "PF", 99.0, 95.0, "m", error="c < 0")
RPW = Rule(3, 1, "t", "c", "RANGE", "PW", 99.0, 95.0, "m", error="c > 100")
RU = Rule(4, 1, "t", "c", "UNIQUE", "PF", 99.0, 99.0, "m", unique_key="c")


def _status(log):
    return {r.id_check: (r.nb_erreurs, r.statut, r.taux_conformite) for r in log.collect()}


def test_rules_statuses(spark):
    df = spark.createDataFrame([(v,) for v in [1, 1, None] + list(range(2, 99)) + [-1, 200]], "c int")
    got = _status(evaluate_rules(df, [R3, RPF, RPW, RU]))
    n = 102
    assert got[1] == (1, "WARN", (1 - 1 / n) * 100)       # 1/102 < 5 %
    assert got[2] == (1, "FAIL", (1 - 1 / n) * 100)
    assert got[3] == (1, "WARN", (1 - 1 / n) * 100)
    assert got[4][0] == 2 and got[4][1] == "FAIL"         # duplicate 1 and the NULL key


def test_rules_on_empty_input(spark):
    empty = spark.createDataFrame([], "c int")
    got = _status(evaluate_rules(empty, [R3, RPF, RPW, RU]))
    assert got == {1: (None, "FAIL", 100.0), 2: (None, "FAIL", 100.0),
                   3: (None, "WARN", 100.0), 4: (0, "PASS", 100.0)}


def test_one_aggregate_per_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(F.col("id").cast("int").alias("c")).write.parquet(path)
    t = spark.read.parquet(path)
    log = evaluate_suite({"t": t}, [R3, RPF, RPW])
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert fail_count(log).first()[0] == 0


def test_rank_desc_hot_key_spans_partitions(spark):
    # one commune holds half the rows, with ties and NULLs; its values lie in several range partitions
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("k"),
                                  F.when(F.col("id") % 11 > 0, F.col("id") % 700).cast("int").alias("v"))
    exp = df.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last())))
    for n in (1, 5, 9):
        assert rows(rank_desc(df, "v", ["k"], "r", num_partitions=n, hot_rows=200)) == rows(exp)
    for most in (10, 1000, 5000):  # all keys, one key and no key hot
        assert rows(rank_desc(df, "v", ["k"], "r", 3, hot_rows=most)) == rows(exp)
    stored, _ = stored_rows(df)
    both = dense_key(rank_desc(stored, "v", ["k"], "r", 3, hot_rows=1000), ["k", "v", "r"], "id", 4)
    assert rows(both, "k", "v", "r") == rows(exp) and rows(both, "id") == rows(spark.range(1, 4001))


def test_shares_come_in_order_from_one_scan(spark, tmp_path):
    """A hot commune over several tasks, NULL keys and values last, whether
    the totals are broadcast or shuffled."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 13 > 0, (F.col("id") % 3).cast("string")).alias("dep"),
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 17 > 0, F.concat(F.lit("c"), F.col("id") % 40)).alias("com"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 900).cast("int").alias("v"))
    df.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    order = [F.col("dep").asc_nulls_last(), F.col("com").asc_nulls_last(), F.col("v").desc_nulls_last()]
    want = rows(share_of_partition(df, "v", ["com"], "s"))
    for broadcast in (10 << 20, -1):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
        try:
            got = ordered_shares(df, "v", ["com"], "s", order)
            last = lambda x: (x is None, x)
            keys = [(last(r.dep), last(r.com), last(None if r.v is None else -r.v)) for r in got.collect()]
            assert keys == sorted(keys) and rows(got) == want
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert str(tmp_path) not in plan  # the input was scanned when its rows were stored
            hot = got.withColumn("p", F.spark_partition_id()).where("com = 'hot' and dep = '1'")
            assert hot.select("p").distinct().count() > 1
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 << 20)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)


def test_dense_key_computes_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(0, 1000, 1, 4).mapInArrow(count, "id long")
    assert dense_key(df, [F.col("id").desc()], "k", num_partitions=4).agg(F.max("k")).first()[0] == 1000
    assert seen.value == 1000


def test_dense_key_splits_rows_with_one_key(spark):
    df = spark.range(0, 4000).select(F.lit(1).alias("k"))
    laid = range_layout(df, ["k"], 4)
    assert max(r["count"] for r in laid.groupBy("__agora_pid").count().collect()) < 2500
    assert sorted(r.id for r in dense_key(df, ["k"], "id", num_partitions=4).collect()) == list(range(1, 4001))


def test_rows_of_one_partition_are_numbered_without_a_layout(spark):
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(folder))
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), ("a", 3)], "x string, y int")
    got = dense_key(df, ["x"], "id")
    assert sorted((r.id, r.x) for r in got.collect()) == [(1, "a"), (2, "a"), (3, "b"), (4, None)]
    assert len(set(os.listdir(folder)) - before) == 1
    for n in (None, 3):
        assert dense_key(df.limit(0), ["x"], "id", n).count() == 0
    assert rank_desc(df.limit(0), "y", ["x"], "r").count() == 0


def watched(spark, df, rules, path):
    w = WatchedRules(rules)
    w.watch(df).write.parquet(path)
    return w.log(spark.read.parquet(path))


def test_rules_are_counted_by_the_write(spark, tmp_path):
    df = spark.createDataFrame([(v,) for v in [1, 1, None] + list(range(2, 99)) + [-1, 200]], "c int").repartition(5)
    for i, own in enumerate((df, df.limit(0), df.where("c = 1"))):
        log = watched(spark, own, [R3, RPF, RPW, RU], str(tmp_path / f"t{i}"))
        assert _status(log) == _status(evaluate_rules(own, [R3, RPF, RPW, RU]))
    alone = watched(spark, df, [R3, RPF, RPW], str(tmp_path / "alone"))
    assert "Scan parquet" not in alone._jdf.queryExecution().executedPlan().toString()
    only = watched(spark, df, [RU], str(tmp_path / "only"))
    assert _status(only) == _status(evaluate_rules(df, [RU]))


def test_scratch_removes_copies(spark, tmp_path):
    before = set(os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:")))
    with scratch(spark):
        dense_key(spark.range(10).toDF("a"), ["a"], "id").write.parquet(str(tmp_path / "kept"))
    assert set(os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:"))) == before
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 10


def test_shared_folder_is_required_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
