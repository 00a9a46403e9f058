"""Data-quality rules as data, evaluated with one aggregate per table.

A rule says which rows are errors (a SQL predicate), how the status is
decided and how the log row is labelled.  ``evaluate_rules`` scans a
table once for all of its rules: a single ``agg`` computes ``COUNT(*)``
and every rule's error count (partial aggregation on the executors, one
row to the final stage), then ``inline`` turns the counts into one log
row per rule.

Status shapes:
* ``3L`` -- no error: PASS; error ratio below ``warn_ratio``: WARN; else FAIL
* ``PF`` -- no error: PASS; else FAIL
* ``PW`` -- no error: PASS; else WARN

On an empty table the error count is NULL (SUM over no rows), conformity
is 100 and the status falls to the last branch, as in the SQL it mirrors.
A ``unique_key`` rule counts ``COUNT(*) - COUNT(DISTINCT key)`` instead,
which is 0 on an empty table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType([
    T.StructField("id_check", T.IntegerType()),
    T.StructField("fk_chargement", T.IntegerType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("colonne", T.StringType()),
    T.StructField("regle_qualite", T.StringType()),
    T.StructField("nb_enregistrements", T.LongType()),
    T.StructField("nb_erreurs", T.LongType()),
    T.StructField("taux_conformite", T.DoubleType()),
    T.StructField("statut", T.StringType()),
    T.StructField("seuil_warn", T.DoubleType()),
    T.StructField("seuil_fail", T.DoubleType()),
    T.StructField("date_check", T.TimestampType()),
    T.StructField("detail_message", T.StringType()),
])
LOG_COLUMNS = [f.name for f in LOG_SCHEMA.fields]


@dataclass(frozen=True)
class Rule:
    id_check: int
    fk_chargement: int
    table_name: str
    colonne: str
    regle_qualite: str
    status: str                      # "3L", "PF" or "PW"
    seuil_warn: float
    seuil_fail: float
    detail_message: str
    error: str | None = None         # SQL predicate: the row is an error
    warn_ratio: float | None = None  # for "3L"
    unique_key: str | None = None    # duplicates rule instead of a predicate

    def __post_init__(self):
        if self.status not in ("3L", "PF", "PW"):
            raise ValueError(f"unknown status shape {self.status!r}")
        if (self.error is None) == (self.unique_key is None):
            raise ValueError("a rule needs exactly one of error / unique_key")
        if self.status == "3L" and self.warn_ratio is None:
            raise ValueError("3L rules need warn_ratio")


def _error_count(rule: Rule, n: Column) -> Column:
    if rule.unique_key is not None:
        return (n - F.count_distinct(F.col(rule.unique_key))).cast("long")
    return F.sum(F.when(F.expr(rule.error), 1).otherwise(0)).cast("long")


def _status(rule: Rule, e: Column, n: Column) -> Column:
    passed = F.when(e == 0, F.lit("PASS"))
    if rule.status == "PF":
        return passed.otherwise("FAIL")
    if rule.status == "PW":
        return passed.otherwise("WARN")
    ratio = F.try_divide(e.cast("double"), n.cast("double"))
    return passed.when(ratio < F.lit(rule.warn_ratio), "WARN").otherwise("FAIL")


def evaluate_rules(df: DataFrame, rules: Sequence[Rule],
                   check_ts: _dt.datetime | None = None) -> DataFrame:
    """One scan of ``df`` -> one DATA_QUALITY_LOG row per rule."""
    if not rules:
        raise ValueError("no rules")
    return _log_rows(df.agg(*_counts(rules)), rules, check_ts)


def _counts(rules: Sequence[Rule]) -> list[Column]:
    n_all = F.count(F.lit(1))
    return [n_all.alias("__n"), *(_error_count(r, n_all).alias(f"__e{i}") for i, r in enumerate(rules))]


def _log_rows(counts: DataFrame, rules: Sequence[Rule], check_ts: _dt.datetime | None) -> DataFrame:
    """One log row per rule from one row of counts."""
    n = F.col("__n")
    ts = F.lit(check_ts).cast("timestamp") if check_ts else F.current_timestamp()
    rows = []
    for i, r in enumerate(rules):
        e = F.col(f"__e{i}")
        conformity = (F.when(n == 0, F.lit(100.0))
                       .otherwise((F.lit(1.0) - F.try_divide(e.cast("double"), n.cast("double"))) * 100.0))
        rows.append(F.struct(
            F.lit(r.id_check).cast("int").alias("id_check"),
            F.lit(r.fk_chargement).cast("int").alias("fk_chargement"),
            F.lit(r.table_name).alias("table_name"),
            F.lit(r.colonne).alias("colonne"),
            F.lit(r.regle_qualite).alias("regle_qualite"),
            n.cast("long").alias("nb_enregistrements"),
            e.alias("nb_erreurs"),
            conformity.alias("taux_conformite"),
            _status(r, e, n).alias("statut"),
            F.lit(float(r.seuil_warn)).alias("seuil_warn"),
            F.lit(float(r.seuil_fail)).alias("seuil_fail"),
            ts.alias("date_check"),
            F.lit(r.detail_message).alias("detail_message"),
        ))
    return counts.select(F.inline(F.array(*rows)))


class WatchedRules:
    """Rules counted by the very write that stores their table.

    ``watch`` adds the counts of all rules but those on distinct keys (which
    can't be observed) to a DataFrame as observed metrics; writing that one
    computes them, so checking a stored table costs no second scan.  Watch
    what is written, after any shuffle: counts are then made in the tasks
    that write, of which each counts once however often it is tried.
    """

    def __init__(self, rules: Sequence[Rule]):
        self.rules = [r for r in rules if r.unique_key is None]
        self.others = [r for r in rules if r.unique_key is not None]
        self.seen = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self.seen, *_counts(self.rules)) if self.rules else df

    def log(self, stored: DataFrame, check_ts: _dt.datetime | None = None) -> DataFrame:
        """The log rows, after the write; ``stored`` is what it stored."""
        parts = []
        if self.rules:
            schema = ", ".join(["__n long", *(f"__e{i} long" for i in range(len(self.rules)))])
            seen = self.seen.get
            row = (seen["__n"], *(seen[f"__e{i}"] for i in range(len(self.rules))))
            parts.append(_log_rows(stored.sparkSession.createDataFrame([row], schema), self.rules, check_ts))
        if self.others:
            parts.append(evaluate_rules(stored, self.others, check_ts))
        return reduce(DataFrame.unionByName, parts)


def evaluate_suite(tables: dict[str, DataFrame], rules: Sequence[Rule],
                   check_ts: _dt.datetime | None = None) -> DataFrame:
    """Evaluate rules grouped by table name: one aggregate per table, then
    a UNION ALL of the per-table log rows (in rule order of first table use)."""
    by_table: dict[str, list[Rule]] = {}
    for r in rules:
        by_table.setdefault(r.table_name, []).append(r)
    parts = []
    for name, rs in by_table.items():
        if name not in tables:
            raise KeyError(f"no DataFrame given for table {name!r}")
        parts.append(evaluate_rules(tables[name], rs, check_ts))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quality_summary(log: DataFrame) -> DataFrame:
    """Control report: rounded conformity, FAIL/WARN first, worst first."""
    return (log.select("table_name", "colonne", "regle_qualite", "nb_enregistrements",
                       "nb_erreurs", F.round("taux_conformite", 2).alias("taux_conformite_pct"),
                       "statut", "date_check", "taux_conformite")
               .orderBy(F.col("statut").desc_nulls_last(), F.col("taux_conformite").asc_nulls_last())
               .drop("taux_conformite"))


def fail_count(log: DataFrame) -> DataFrame:
    """Number of FAIL rows in the log (one row)."""
    return log.where(F.col("statut") == "FAIL").agg(F.count(F.lit(1)).alias("nb_fail"))
