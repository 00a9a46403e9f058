"""Atomic replacement, storage order across files, buckets, the fitted model."""
import os
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from agora.operators.scoring import CATEGORY, SCENARIO_FEATURES, with_status
from agora.operators.training import fit_model, known_candidates, load_model, save_model, training_rows
from agora.plans import pipeline as P
from agora.plans.inputs import CUSTOMER_SOCIO
from agora.session import together
from agora.sources.tables import POINTER, bucketed_table, in_storage_order, read_table, replace_table
from conftest import rows


def versions(path):
    return sorted(f for f in os.listdir(path) if f.startswith("v-"))


def test_a_table_is_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "zone" / "t")
    first = replace_table(spark.range(5), path)
    reader = read_table(spark, path)
    assert rows(first) == rows(reader) == [(i,) for i in range(5)]
    assert rows(replace_table(spark.range(7), path)) == [(i,) for i in range(7)]
    assert rows(reader) == [(i,) for i in range(5)]  # one who reads the version before goes on
    replace_table(spark.range(3), path)
    assert len(versions(path)) == 2 and read_table(spark, f"{path}/").count() == 3
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "none"))


def test_a_table_may_be_replaced_by_what_is_read_from_it(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(5), path)
    assert replace_table(read_table(spark, path).where("id > 2"), path).count() == 2


@pytest.mark.parametrize("at", ["rows", "pointer"])
def test_a_write_that_fails_leaves_the_table(spark, tmp_path, monkeypatch, at):
    path = str(tmp_path / "t")
    replace_table(spark.range(5), path)
    there, current = versions(path), (tmp_path / "t" / POINTER).read_text()
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    if at == "rows":  # some tasks have written their files by then
        with pytest.raises(Exception, match="lost"):
            replace_table(broken, path)
        assert versions(path) == there
    else:  # the rows stand, the driver is lost before the pointer moves
        monkeypatch.setattr("agora.sources.tables._Folder.point_to", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError):
            replace_table(spark.range(9), path)
        monkeypatch.undo()
    assert (tmp_path / "t" / POINTER).read_text() == current
    assert rows(read_table(spark, path)) == [(i,) for i in range(5)]
    assert replace_table(spark.range(4), path).count() == 4 and len(versions(path)) == 2


def test_storage_order_lets_readers_skip_files(spark, tmp_path):
    df = spark.range(4000).select((F.col("id") * 7 % 10).cast("string").alias("dep"), (F.col("id") % 100).alias("com"), F.col("id").alias("v"))
    path = str(tmp_path / "t")
    in_storage_order(df, [("dep", False), ("com", False), ("v", True)], files=5).write.parquet(path)
    seen = []
    for f in sorted(os.listdir(path)):
        if f.endswith(".parquet"):
            meta = pq.ParquetFile(f"{path}/{f}").metadata
            stats = [meta.row_group(g).column(0).statistics for g in range(meta.num_row_groups)]
            seen += [(s.min, s.max) for s in stats]
            own = pq.read_table(f"{path}/{f}").to_pylist()
            assert own == sorted(own, key=lambda r: (r["dep"], r["com"], -r["v"]))
    assert len(seen) == 5 and sum(a <= "3" <= b for a, b in seen) <= 2  # one department: at most one border
    assert rows(spark.read.parquet(path)) == rows(df)


def test_equal_keys_lie_in_several_files(spark, tmp_path):
    df = spark.range(4000).select(F.lit("x").alias("dep"), F.col("id").alias("v"))
    in_storage_order(df, [("dep", False)], files=4).write.parquet(str(tmp_path / "t"))
    assert sum(f.endswith(".parquet") for f in os.listdir(tmp_path / "t")) == 4


def counted(df, made):
    """``df`` with an accumulator that counts the rows made."""
    def run(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema)


def test_storage_order_computes_its_rows_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)
    df = spark.range(4000).select((F.col("id") % 10).alias("dep"), F.col("id").alias("v"))
    stored = replace_table(counted(df, made), str(tmp_path / "t"), [("dep", False)])
    assert made.value == 4000 and rows(stored) == rows(df)


def test_rows_of_a_narrow_table_are_dealt_out(spark, tmp_path):
    spark.range(60_001).withColumnRenamed("id", "c_custkey").coalesce(1).write.option("parquet.block.size", 1 << 30).parquet(f"{tmp_path}/customer.parquet")
    dealt = CUSTOMER_SOCIO.frame(spark, str(tmp_path))
    sizes = [r.n for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 3 and max(sizes) <= 25_000 and sum(sizes) == 60_001
    assert dealt.select("CODGEO").distinct().count() == 60_001


def test_jobs_run_together_in_order(spark):
    met = threading.Barrier(2, timeout=60)  # each waits for the other

    def job(n):
        met.wait()
        return spark.range(n).count()

    assert together([lambda: job(3), lambda: job(5)]) == [3, 5]
    with pytest.raises(ZeroDivisionError):
        together([lambda: 1 // 0, lambda: 1])


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    a = bucketed_table(spark.range(100).selectExpr("cast(id as string) as code", "id as x"), "t_bucket_a", "code", 4, str(tmp_path / "a"))
    b = bucketed_table(spark.range(0, 100, 3).selectExpr("cast(id as string) as code", "id as y"), "t_bucket_b", "code", 4, str(tmp_path / "b"))
    j = a.hint("merge").join(b, "code")
    assert "Exchange" not in j._jdf.queryExecution().executedPlan().toString()
    assert j.where("x = y").count() == 34
    assert len([f for f in os.listdir(tmp_path / "a") if f.endswith(".parquet")]) <= 4
    for t in ("t_bucket_a", "t_bucket_b"):
        spark.sql(f"DROP TABLE {t}")


def test_model_learns_from_complete_rows_only(spark, tmp_path):
    communes = spark.range(60).select(F.col("id").alias("id_commune"), *[
        (F.col("id") * (i + 3) % 17 + F.rand(i)).alias(c) for i, c in enumerate(SCENARIO_FEATURES)])
    lacking = communes.where("id_commune < 2").withColumn("taux_hlm", F.lit(None).cast("double"))
    scenarios = with_status(communes.where("id_commune >= 2").unionByName(lacking))
    names = spark.createDataFrame([(0, "NOBODY"), (1, "A"), (2, "B")], "id_candidat int, nom string")
    truth = F.col(SCENARIO_FEATURES[0]) * 3 + F.col(SCENARIO_FEATURES[5]) - 2 * F.col("c") + 50
    results = communes.crossJoin(spark.range(3).withColumnRenamed("id", "c")).select(
        F.col("id_commune").alias("fk_commune"), F.col("c").cast("int").alias("fk_candidat"),
        F.when(F.col("id_commune") != 7, truth).alias("nb_voix"))
    taught = training_rows(scenarios, results, names)
    assert taught.count() == 3 * 57 and {r[0] for r in taught.select(CATEGORY).distinct().collect()} == {"A", "B", "NOBODY"}
    path = str(tmp_path / "model")
    save_model(fit_model(taught), path)
    model = load_model(path)
    assert known_candidates(model) == ["A", "B", "NOBODY"]
    off = model.transform(taught).select(F.max(F.abs(F.col("prediction") - F.col("nb_voix")))).first()[0]
    assert off < 1e-6


def test_pipeline_tables_are_versions(spark, tmp_path):
    """Rules counted by the writes leave no scan of their own behind."""
    scans = []
    listed = {"a": spark.range(3).selectExpr("cast(id as string) as code_commune")}
    stored, log = P._store_zone(listed, str(tmp_path), "bronze", [], None)
    assert stored["a"].count() == 3 and log == scans and versions(tmp_path / "bronze" / "a")


def test_training_rows_are_computed_once(spark):
    made = spark.sparkContext.accumulator(0)
    df = spark.range(300).select(F.concat(F.lit("c"), F.col("id") % 3).alias(CATEGORY), (F.col("id") % 7).cast("double").alias("x"),
                                 (F.col("id") * 2 + F.col("id") % 3).cast("double").alias("nb_voix"))
    model = fit_model(counted(df, made), ["x"])
    assert made.value == 300 and known_candidates(model) == ["c0", "c1", "c2"]
