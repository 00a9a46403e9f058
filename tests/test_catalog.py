"""Registered queries against their oracle SQL on the smallest scale factor."""
import hashlib
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from agora.plans import catalog, governance, oracle
from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(norm(r[i]) for i in order) for r in data)).encode()).hexdigest()


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


OWN = sorted(catalog.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(exp)
    assert digest(df.columns, got) == digest(cols, exp)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "id_fait" in df.columns


def test_oracle_rules_are_their_own(spark, con, monkeypatch):
    """A changed threshold or predicate in the engine turns a row red."""
    import dataclasses

    from agora.plans import analogs

    rule = governance.RULES[4]
    for change in ({"warn_ratio": 0.0000001}, {"error": "population_totale_2022 < 2000"}):
        monkeypatch.setattr(governance, "RULES", [dataclasses.replace(rule, **change) if r is rule else r for r in governance.RULES])
        df = analogs.QUERIES["qc_positive"](spark, "/root/testdata/sf0.01")
        got = {r.id_check: (r.nb_erreurs, r.statut) for r in df.collect()}
        c = duckdb.connect()
        for t in TABLES:
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.01/{t}.parquet')")
        want = {r[0]: r[1:] for r in c.execute(f"select id_check, nb_erreurs, statut from ({oracle.ORACLE['qc_positive']})").fetchall()}
        assert want[5][1] == "WARN" and got[5] != want[5] and got[8] == want[8]
        monkeypatch.undo()


def test_missing_inputs_are_never_scored(spark):
    scored = catalog.queries()["predict_scores"](spark, "/root/testdata/sf0.01")
    got = {r.statut: (r.n, r.known) for r in scored.groupBy("statut").agg(
        F.count("*").alias("n"), F.count("score_brut_modele").alias("known")).collect()}
    assert got["OK"][0] == got["OK"][1] > 0 and got["REJETE"][0] > 0 == got["REJETE"][1]


def test_shared_scans(spark):
    def scans(name, table):
        plan = catalog.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        return sum("FileScan" in line and f"/{table}.parquet" in line for line in plan.split("\n"))

    assert scans("qc_unknown_member", "orders") == 1
    assert scans("share_of_partition", "orders") == 0  # parsed once, into the stored rows
    assert scans("feature_mart", "customer") == 1


def test_three_landing_statuses(spark):
    got = {r.status for r in catalog.queries()["ingest_summary"](spark, "/root/testdata/sf0.01").collect()}
    assert got == {"OK", "ERREUR_DOWNLOAD", "ERREUR_MINIO"}


def test_facts_of_bucketed_tables_join_without_an_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = catalog.queries()["facts_bucketed"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 7 and "hashpartitioning" not in plan  # the aggregates' exchanges are all that is left
    assert plan.count("Exchange") == plan.count("Exchange SinglePartition")


def test_candidate_shares_come_in_order(spark):
    got = [(r.code_departement, r.code_commune, r.voix is None, -(r.voix or 0))
           for r in catalog.queries()["share_of_partition"](spark, SF001).collect()]
    assert got == sorted(got)
