"""End-to-end run: RAW -> BRONZE -> checks -> GOLD -> checks -> audit.

Order of the source pipeline: the audit's IN_PROGRESS rows are written
first, the Bronze checks run after the Bronze zone, the Gold checks after
the Gold zone, and the SUCCESS rows last.  Tables are replaced atomically
(see ``agora.sources.tables``), so a rerun is idempotent and a failed one
leaves the earlier tables readable; the two governance logs are appended
to.  Every zone is a folder of tables under ``warehouse``; each table is
read back before the next zone uses it, so later zones start from stored
data, not from the lineage of earlier ones.  The quality rules are counted
by the writes themselves, but for the one on distinct keys.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora.operators.keys import scratch
from agora.operators.quality import LOG_SCHEMA, Rule, WatchedRules
from agora.plans import bronze as B
from agora.plans import gold as G
from agora.plans import governance as GV
from agora.session import together
from agora.sources.raw import read_text_csv
from agora.sources.tables import replace_table

RAW_COLUMNS = {
    "associations": ["adrs_codeinsee", "position"],
    "crime": ["CODGEO_2025", "annee", "indicateur", "taux_pour_mille"],
    "socio": ["CODGEO", *B.SOCIO_DOUBLES, *B.SOCIO_INTS],
    "elections": [*B.ELECTION_KEYS, *B.ELECTION_MEASURES],
    "candidates": [*B.ELECTION_KEYS, "prenom", "nom", "voix"],
}


# Physical order of two Bronze tables (ORDER BY in their CTAS), across files:
# a filter on the leading column skips the others.  (column, descending)
BRONZE_ORDER = {
    "socio_demo_communes": [("code_commune", False)],
    "presidentielle_2022_communes_candidats_pct": [
        ("code_departement", False), ("code_commune", False), ("voix", True)],
}


def read_raw(spark: SparkSession, paths: dict[str, str | Sequence[str]], sep: str = ",",
             encoding: str = "UTF-8") -> dict[str, DataFrame]:
    """Raw CSV files as text relations; the association files may be several."""
    return {k: read_text_csv(spark, p, RAW_COLUMNS[k], sep=sep, encoding=encoding)
            for k, p in paths.items()}


def _store_zone(tables: dict[str, DataFrame], warehouse: str, zone: str, rules: Sequence[Rule],
                check_ts: _dt.datetime | None) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """Replaces the zone's tables; the rules on each are counted as it is
    written.  Returns the stored tables and the log rows."""
    by_table = GV.rules_by_table(rules)

    def store(name: str) -> tuple[DataFrame, list[DataFrame]]:
        watched = {name: WatchedRules(by_table[name])} if name in by_table else {}
        stored = replace_table(tables[name], f"{warehouse.rstrip('/')}/{zone}/{name}", BRONZE_ORDER.get(name, ()),
                               watched[name].watch if watched else None)
        return stored, [GV.watched_log({name: stored}, watched, check_ts or _now())] if watched else []

    done = together(partial(store, name) for name in tables)  # no table of a zone needs another
    return {name: stored for name, (stored, _) in zip(tables, done)}, [rows for _, log in done for rows in log]


def open_log(spark: SparkSession, warehouse: str, name: str, schema: T.StructType) -> str:
    """A governance log by its declared schema, created if it is not there;
    its path."""
    path = f"{warehouse.rstrip('/')}/governance/{name}"
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return path


def _append(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Appends rows in the log's declared columns and types."""
    df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]).write.mode("append").parquet(path)


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def run(spark: SparkSession, raw: dict[str, DataFrame], warehouse: str,
        start_ts: _dt.datetime | None = None, end_ts: _dt.datetime | None = None,
        build_bronze: Callable[..., dict[str, DataFrame]] = B.build_bronze,
        build_gold: Callable[..., dict[str, DataFrame]] = G.build_gold,
        loads: Callable[[dict[str, DataFrame]], Sequence[tuple[DataFrame, DataFrame]]] | None = None) -> dict[str, DataFrame]:
    """Run the whole pipeline; returns the stored tables by name.
    ``build_bronze`` makes the Bronze tables of ``raw`` and the start time,
    ``build_gold`` the Gold tables of the stored Bronze ones.  ``loads`` names,
    of the stored tables, each load's source and what it loaded: the end rows
    then carry the rows of both, otherwise unknown (NULL).

    If a load fails its end rows say FAILED, with the error, and the error
    goes on to the caller.  End rows are stamped when the load ends, unless
    ``end_ts`` is given."""
    start_ts = start_ts or _now()
    audit = open_log(spark, warehouse, "META_CHARGEMENT", GV.AUDIT_SCHEMA)
    quality = open_log(spark, warehouse, "DATA_QUALITY_LOG", LOG_SCHEMA)
    _append(GV.audit_frame(spark, GV.audit_start_rows(start_ts)), audit, GV.AUDIT_SCHEMA)
    try:
        bronze, log = _store_zone(build_bronze(raw, start_ts), warehouse, "bronze", GV.BRONZE_RULES, start_ts)
        clean, more = _store_zone({"criminalite_commune_clean": B.build_clean_crime(bronze["criminalite_commune"])},
                                  warehouse, "bronze", GV.BRONZE_RULES, start_ts)
        bronze |= clean
        _append(reduce(DataFrame.unionByName, log + more), quality, LOG_SCHEMA)
        with scratch(spark):  # the copies that numbering needs go once the keyed tables are stored
            gold, log = _store_zone(build_gold(spark, bronze, start_ts), warehouse, "gold", GV.GOLD_RULES, end_ts)
        _append(reduce(DataFrame.unionByName, log), quality, LOG_SCHEMA)
        counts = [(source.count(), loaded.count()) for source, loaded in loads(bronze | gold)] if loads else None
    except Exception as e:
        _append(GV.audit_frame(spark, GV.audit_end_rows(end_ts or _now(), status=GV.STATUS_FAILED, error=str(e)[:1000])),
                audit, GV.AUDIT_SCHEMA)
        raise
    _append(GV.audit_frame(spark, GV.audit_end_rows(end_ts or _now(), counts=counts)), audit, GV.AUDIT_SCHEMA)
    return {**bronze, **gold, "META_CHARGEMENT": spark.read.schema(GV.AUDIT_SCHEMA).parquet(audit),
            "DATA_QUALITY_LOG": spark.read.schema(LOG_SCHEMA).parquet(quality)}


def reports(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The three control queries run after a load."""
    log = tables["DATA_QUALITY_LOG"]
    return {"quality_summary": GV.quality_summary(log), "fail_count": GV.fail_count(log),
            "load_history": GV.load_history(tables["META_CHARGEMENT"])}


__all__ = ["read_raw", "run", "reports", "RAW_COLUMNS", "BRONZE_ORDER"]
