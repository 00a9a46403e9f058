"""Governance zone: the 18 quality rules, the load audit trail and the
control reports (L1-L4, QC1-QC18)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora.operators.quality import Rule, WatchedRules, evaluate_suite, fail_count, quality_summary

T_CRIME = "Bronze.criminalite_commune_clean"
T_SOCIO = "Bronze.socio_demo_communes"
T_ELECT = "Bronze.elections_communes"
T_RESULTS = "Datalake.Gold.FACT_RESULTATS_ELECTORAUX"
T_PARTICIPATION = "Datalake.Gold.FACT_PARTICIPATION_ELECTORALE"
T_REVENU = "Datalake.Gold.FACT_REVENU"
T_COMMUNE = "Datalake.Gold.DIM_COMMUNE"
T_ECONOMIE = "Datalake.Gold.FACT_ECONOMIE_LOCALE"

# Which Bronze/Gold table each log name refers to.
TABLE_OF = {
    T_CRIME: "criminalite_commune_clean",
    T_SOCIO: "socio_demo_communes",
    T_ELECT: "elections_communes",
    T_RESULTS: "FACT_RESULTATS_ELECTORAUX",
    T_PARTICIPATION: "FACT_PARTICIPATION_ELECTORALE",
    T_REVENU: "FACT_REVENU",
    T_COMMUNE: "DIM_COMMUNE",
    T_ECONOMIE: "FACT_ECONOMIE_LOCALE",
}



def outside(value: str, low, high) -> str:
    """The value is known and not in the range; NULL is no error."""
    return f"NOT ({value} BETWEEN {low} AND {high})"


def or_zero(value: str) -> str:
    return f"coalesce({value}, 0)"


def apart(a: str, b: str, most) -> str:
    """Two known values differ by more than ``most``."""
    return f"abs({a} - {b}) > {most}"


# ---------------------------------------------------------------------------
# The 18 rules.  Fixed values: their labels, thresholds and messages.
# ---------------------------------------------------------------------------
RULES: list[Rule] = [
    Rule(1, 1, T_CRIME, "code_commune", "NOT_NULL", "3L", 95.0, 90.0,
         "Vérification NOT NULL sur code_commune",
         error="code_commune IS NULL", warn_ratio=0.05),
    Rule(2, 1, T_CRIME, "taux_cambriolage", "RANGE[0,100]", "3L", 98.0, 95.0,
         "Taux cambriolage hors intervalle [0,100]",
         error=outside("taux_cambriolage", 0, 100), warn_ratio=0.02),
    Rule(3, 1, T_CRIME, "taux_violence_famille | taux_violence_sexuelle | taux_vols_armes",
         "RANGE[>=0]", "PF", 99.0, 95.0, "Taux de criminalité négatifs détectés",
         error="taux_violence_famille < 0 OR taux_violence_sexuelle < 0 OR taux_vols_armes < 0"),
    Rule(4, 1, T_SOCIO, "code_commune", "NOT_NULL", "PF", 99.0, 95.0,
         "Vérification NOT NULL code_commune socio_demo",
         error="code_commune IS NULL"),
    Rule(5, 1, T_SOCIO, "population_totale_2022", "RANGE[>0]", "3L", 98.0, 95.0,
         "Population totale nulle ou négative",
         error="population_totale_2022 IS NULL OR population_totale_2022 <= 0", warn_ratio=0.02),
    Rule(6, 1, T_SOCIO, "population_hommes + population_femmes vs population_totale_2022",
         "COHERENCE[H+F=TOT±1]", "3L", 95.0, 90.0,
         "Somme H+F doit être égale à population totale (±1)",
         error=apart(or_zero("population_hommes") + " + " + or_zero("population_femmes"),
                     or_zero("population_totale_2022"), 1), warn_ratio=0.05),
    Rule(7, 1, T_ELECT, "code_commune", "NOT_NULL", "PF", 99.0, 95.0,
         "Vérification NOT NULL code_commune elections_communes",
         error="code_commune IS NULL"),
    Rule(8, 1, T_ELECT, "total_inscrits", "RANGE[>0]", "3L", 98.0, 95.0,
         "Communes sans inscrits détectées",
         error="total_inscrits IS NULL OR total_inscrits <= 0", warn_ratio=0.02),
    Rule(9, 1, T_ELECT, "total_votants <= total_inscrits", "COHERENCE[votants<=inscrits]", "PF",
         99.0, 95.0, "Votants supérieurs aux inscrits — incohérence source",
         error="total_votants > total_inscrits"),
    Rule(10, 2, T_RESULTS, "nb_voix", "NOT_NULL", "PW", 99.0, 95.0,
         "Vérification NOT NULL nb_voix dans FACT_RESULTATS",
         error="nb_voix IS NULL"),
    Rule(11, 2, T_RESULTS, "ratio_voix_exprimes", "RANGE[0,1]", "PF", 99.0, 95.0,
         "Ratio voix exprimées hors [0,1]",
         error=outside("ratio_voix_exprimes", 0, 1)),
    Rule(12, 2, T_RESULTS, "fk_candidat", "REFERENTIAL[DIM_CANDIDAT]", "3L", 95.0, 90.0,
         "Lignes avec fk_candidat=0 : candidat non résolu dans DIM_CANDIDAT",
         error="fk_candidat = 0", warn_ratio=0.05),
    Rule(13, 2, T_PARTICIPATION, "taux_participation + taux_abstention", "COHERENCE[SUM≈1±0.01]",
         "PW", 98.0, 90.0, "Participation + abstention devrait être ≈ 1.0 (±0.01)",
         error=apart("taux_participation + taux_abstention", "1.0", 0.01)),
    Rule(14, 2, T_PARTICIPATION, "taux_participation", "RANGE[0,1]", "PF", 99.0, 95.0,
         "Taux participation hors [0,1] — division /100 manquante ?",
         error=outside("taux_participation", 0, 1)),
    Rule(15, 2, T_REVENU, "fk_commune", "NOT_NULL", "PF", 99.0, 95.0,
         "Vérification NOT NULL fk_commune dans FACT_REVENU",
         error="fk_commune IS NULL"),
    Rule(16, 2, T_REVENU, "revenu_median_menages", "RANGE[>0 si non NULL]", "PW", 98.0, 95.0,
         "Revenu médian nul ou négatif (hors secrets INSEE)",
         error="revenu_median_menages <= 0"),
    Rule(17, 2, T_COMMUNE, "code_commune WHERE is_current=TRUE", "UNIQUE[code_commune, is_current]",
         "PF", 99.0, 99.0, "Doublons SCD2 : plusieurs lignes is_current=TRUE pour un même code",
         unique_key="code_commune"),
    Rule(18, 2, T_ECONOMIE, "taux_chomage", "RANGE[0,100 si non NULL]", "PF", 99.0, 95.0,
         "Taux chômage hors [0,100] — erreur de calcul actifs ?",
         error=outside("taux_chomage", 0, 100)),
]
BRONZE_RULES = [r for r in RULES if r.fk_chargement == 1]
GOLD_RULES = [r for r in RULES if r.fk_chargement == 2]


def rule_inputs(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Map log table names to DataFrames; the uniqueness rule reads only the
    current rows of the commune dimension."""
    out = {}
    for log_name, key in TABLE_OF.items():
        if key in tables:
            df = tables[key]
            if log_name == T_COMMUNE:
                df = df.where(F.col("is_current"))
            out[log_name] = df
    return out


def run_quality(tables: dict[str, DataFrame], rules: Sequence[Rule] = tuple(RULES),
                check_ts: _dt.datetime | None = None) -> DataFrame:
    """DATA_QUALITY_LOG rows for ``rules``; one scan per table."""
    return evaluate_suite(rule_inputs(tables), list(rules), check_ts)


def rules_by_table(rules: Sequence[Rule] = tuple(RULES)) -> dict[str, list[Rule]]:
    """The rules of each Bronze or Gold table, for the write that stores it."""
    out: dict[str, list[Rule]] = {}
    for r in rules:
        out.setdefault(TABLE_OF[r.table_name], []).append(r)
    return out


def watched_log(stored: dict[str, DataFrame], watched: dict[str, WatchedRules],
                check_ts: _dt.datetime | None = None) -> DataFrame:
    """The log rows of tables whose writes were watched."""
    inputs = rule_inputs(stored)
    of = {key: inputs[log_name] for log_name, key in TABLE_OF.items() if key in stored}
    return reduce(DataFrame.unionByName, [w.log(of[name], check_ts) for name, w in watched.items()])


# Load audit ------------------------------------------------------------------
AUDIT_SCHEMA = T.StructType([
    T.StructField("id_chargement", T.IntegerType()),
    T.StructField("nom_fichier", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("date_chargement", T.TimestampType()),
    T.StructField("statut", T.StringType()),
    T.StructField("nb_lignes_source", T.LongType()),
    T.StructField("nb_lignes_chargees", T.LongType()),
    T.StructField("nb_lignes_rejetees", T.LongType()),
    T.StructField("erreur_message", T.StringType()),
    T.StructField("etl_version", T.StringType()),
    T.StructField("operateur", T.StringType()),
])
STATUS_IN_PROGRESS, STATUS_SUCCESS, STATUS_FAILED = "IN_PROGRESS", "SUCCESS", "FAILED"
ETL_VERSION = "v1.0"

# The two loads of the pipeline and their audit labels.
# (start name, start source, end name, end source, operator)
LOADS = [
    ("ETL_RAW_TO_BRONZE", "internal://data.iceberg-datalake.*",
     "ETL_RAW_TO_BRONZE_COMPLETED", "internal://Bronze.*", "ETL01_DREMIO"),
    ("ETL_BRONZE_TO_Datalake.Gold", "internal://Bronze.*",
     "ETL_BRONZE_TO_Datalake.Gold_COMPLETED", "internal://Datalake.Gold.*", "ETL02_DREMIO"),
]


def audit_start_rows(start_ts: _dt.datetime, first_id: int = 1) -> list[tuple]:
    """IN_PROGRESS rows, one per load, written before the loads run."""
    return [(first_id + i, name, src, start_ts, STATUS_IN_PROGRESS, None, None, None, None,
             ETL_VERSION, op) for i, (name, src, _, _, op) in enumerate(LOADS)]


def audit_end_rows(end_ts: _dt.datetime, first_id: int = 3, status: str = STATUS_SUCCESS,
                   counts: Sequence[tuple[int | None, int | None]] | None = None,
                   error: str | None = None) -> list[tuple]:
    """SUCCESS / FAILED rows, one per load, written after the loads and the
    checks.  Rejected rows are 0 unless source/loaded counts are given."""
    rows = []
    for i, (_, _, name, src, op) in enumerate(LOADS):
        src_n, loaded_n = counts[i] if counts else (None, None)
        rejected = (src_n - loaded_n) if (src_n is not None and loaded_n is not None) else 0
        rows.append((first_id + i, name, src, end_ts, status, src_n, loaded_n, rejected,
                     error, ETL_VERSION, op))
    return rows


def audit_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), AUDIT_SCHEMA)


def audit_with_counts(spark: SparkSession, start_ts, end_ts,
                      loads: Sequence[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """The four audit rows of a run whose end rows carry the source and loaded
    row counts of each load, computed as one distributed aggregate per side
    (no row leaves the executors; only the counts reach the rows)."""
    start = audit_frame(spark, audit_start_rows(start_ts))
    parts = []
    for i, (src, loaded) in enumerate(loads):
        # one aggregate over both sides (tagged UNION ALL): no join needed
        both = (src.select(F.lit(0).alias("__side"))
                   .unionByName(loaded.select(F.lit(1).alias("__side"))))
        counts = both.agg(F.count_if(F.col("__side") == 0).alias("s"),
                          F.count_if(F.col("__side") == 1).alias("l"))
        _, _, name, url, op = LOADS[i]
        parts.append(counts.select(
            F.lit(3 + i).cast("int").alias("id_chargement"), F.lit(name).alias("nom_fichier"),
            F.lit(url).alias("source_url"), F.lit(end_ts).cast("timestamp").alias("date_chargement"),
            F.lit(STATUS_SUCCESS).alias("statut"), F.col("s").cast("long").alias("nb_lignes_source"),
            F.col("l").cast("long").alias("nb_lignes_chargees"),
            (F.col("s") - F.col("l")).cast("long").alias("nb_lignes_rejetees"),
            F.lit(None).cast("string").alias("erreur_message"), F.lit(ETL_VERSION).alias("etl_version"),
            F.lit(op).alias("operateur")))
    out = start
    for p in parts:
        out = out.unionByName(p)
    return out


def load_history(audit: DataFrame) -> DataFrame:
    """Control report: loads, newest first."""
    return (audit.select("id_chargement", "nom_fichier", "statut", "date_chargement", "operateur")
                 .orderBy(F.col("date_chargement").desc_nulls_last(), F.col("id_chargement").desc()))


__all__ = ["RULES", "BRONZE_RULES", "GOLD_RULES", "run_quality", "quality_summary", "fail_count",
           "audit_start_rows", "audit_end_rows", "audit_frame", "audit_with_counts", "load_history"]
