import pytest
from pyspark.sql import functions as F

from agora.functions import clean as C
from conftest import rows


def frame(spark, values, col="x"):
    return spark.createDataFrame([(v,) for v in values], f"{col} string")


def test_clean_double_sentinels_commas_and_bad_text(spark):
    df = frame(spark, ["", " NA ", "S", None, " 5,25 ", "3.1", "abc", "\t2"])
    got = [r[0] for r in df.select(C.clean_double("x", ("", "NA"))).collect()]
    # 'S' is not a sentinel here -> not a number -> NULL; tabs are not trimmed
    assert got[:7] == [None, None, None, None, 5.25, 3.1, None]


def test_clean_double_strict_mode_raises(spark):
    df = frame(spark, ["abc"])
    with pytest.raises(Exception):
        df.select(C.clean_double("x", on_error="fail")).collect()


def test_clean_int_truncates_and_has_no_comma_step(spark):
    df = frame(spark, ["12.7", " 3 ", "S", "", "12,5", "-2.9"])
    got = [r[0] for r in df.select(C.clean_int("x", ("", "S"))).collect()]
    assert got == [12, 3, None, None, None, -2]


def test_guarded_ratios(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, None), (5.0, 20.0), (None, 4.0)], "n double, d double")
    got = df.select(C.pct_guarded("n", "d"), C.rate_if_positive("n", "d"),
                    C.ratio_if_positive("n", "d")).collect()
    assert [tuple(r) for r in got] == [(0.0, None, None), (None, None, None),
                                      (25.0, 25.0, 0.25), (None, None, None)]


def test_missing_count_null_safe_sum_and_names(spark):
    df = spark.createDataFrame([(1, None, None, " le pen ")], "a int, b int, c int, n string")
    r = df.select(C.count_missing(["a", "b", "c"]), C.null_safe_sum(["a", "b", "c"]),
                  C.norm_name("n"), C.pct_to_ratio(F.lit(50))).first()
    assert tuple(r) == (2, 1, "LE PEN", 0.5)


def test_prefix_in_and_code_labels(spark):
    df = frame(spark, ["92004", "75056", None, "94000"])
    got = rows(df.where(C.prefix_in("x", ["92", "93", "94"])))
    assert got == [("92004",), ("94000",)]
    labels = [r[0] for r in df.select(C.code_to_label(F.substring("x", 1, 2),
                                                      {"92": "HdS"}, "Inconnu")).collect()]
    assert labels == ["HdS", "Inconnu", "Inconnu", "Inconnu"]


def test_prefix_filter_reaches_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "codes")
    frame(spark, ["92004", "75056"]).write.parquet(path)
    plan = spark.read.parquet(path).where(C.prefix_in("x", ["92", "93"]))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "StringStartsWith" in plan


def test_typed_null_is_typed(spark):
    df = spark.range(1).select(C.typed_null("double").alias("d"))
    assert df.schema["d"].dataType.typeName() == "double"
