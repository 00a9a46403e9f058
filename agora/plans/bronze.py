"""RAW -> BRONZE: the six cleaned tables (B1-B6).

Each builder takes raw text DataFrames and returns the Bronze table.
Column names default to those of the source files; they are parameters
so the same builders run on other inputs with the same shape.
Provenance (``date_chargement``, ``source_fichier``) is appended last.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.functions.clean import (SENTINELS_NA, SENTINELS_SECRET, clean_double,
                                   clean_int, prefix_in, trim_spaces)
from agora.operators.reshape import (append_rows, fill_zero, grouped_sums_with_ratios,
                                     pivot_avg, with_provenance)
from agora.operators.windows import ordered_shares, share_of_partition

# ---------------------------------------------------------------------------
# Scope, indicator labels, column mappings and file labels of
# the source pipeline.
# ---------------------------------------------------------------------------
DEPARTMENTS = ("92", "93", "94")
ACTIVE_POSITION = "A"
CRIME_YEAR = 2022
CRIME_INDICATORS = {
    "Cambriolages de logement": "taux_cambriolage",
    "Violences physiques intrafamiliales": "taux_violence_famille",
    "Violences sexuelles": "taux_violence_sexuelle",
    "Vols avec armes": "taux_vols_armes",
}
CRIME_RATES = list(CRIME_INDICATORS.values())
PATCHED_COMMUNE = "93059"
PATCH_SOURCE = "patch_manuel"

SOCIO_DOUBLES = {
    "MED21": "revenu_median_menages_2021",
    "TP6021": "taux_pauvrete_total_2021",
    "TP60AGE121": "taux_pauvrete_0_14_ans",
    "TP60AGE221": "taux_pauvrete_15_29_ans",
    "TP60AGE321": "taux_pauvrete_30_44_ans",
    "TP60AGE421": "taux_pauvrete_45_59_ans",
    "TP60AGE521": "taux_pauvrete_60_74_ans",
    "TP60AGE621": "taux_pauvrete_75_ans_plus",
    "D121": "revenu_decile_1_menages",
    "D921": "revenu_decile_9_menages",
    "PACT21": "part_revenus_activite",
    "PBEN21": "part_revenus_patrimoine",
    "PPAT21": "part_prestations_familiales",
    "PPSOC21": "part_prestations_sociales",
    "PPLOGT21": "part_aides_logement",
}
SOCIO_INTS = {
    "P22_POP": "population_totale_2022",
    "P22_POP0014": "population_0_14_ans",
    "P22_POP1529": "population_15_29_ans",
    "P22_POP3044": "population_30_44_ans",
    "P22_POP4559": "population_45_59_ans",
    "P22_POP6074": "population_60_74_ans",
    "P22_POP7589": "population_75_89_ans",
    "P22_POP90P": "population_90_ans_plus",
    "P22_POPH": "population_hommes",
    "P22_POPF": "population_femmes",
    "P22_CHOM1524": "chomeurs_15_24_ans",
    "P22_CHOM2554": "chomeurs_25_54_ans",
    "P22_CHOM5564": "chomeurs_55_64_ans",
    "P22_ACT15P": "actifs_15_ans_plus",
    "P22_ACTOCC15P": "actifs_occupes_15_ans_plus",
    "P22_SAL15P": "nombre_salaries",
    "P22_NSAL15P": "nombre_non_salaries",
    "P22_EMPLT_SAL": "emplois_salaries",
    "P22_EMPLT_NSAL": "emplois_non_salaries",
    "ENCTOT24": "nombre_creations_entreprises_2024",
    "ETNTOT23": "nombre_total_etablissements_2023",
    "ETPTOT24": "effectif_total_salarie_2024",
    "P22_LOG": "nombre_total_logements",
    "P22_LOGVAC": "nombre_logements_vacants",
    "P22_RP_LOCHLMV": "residences_principales_hlm",
}
ELECTION_KEYS = ["code_departement", "libelle_departement", "code_commune", "libelle_commune"]
ELECTION_MEASURES = {
    "inscrits": "total_inscrits",
    "abstentions": "total_abstentions",
    "votants": "total_votants",
    "blancs": "total_blancs",
    "nuls": "total_nuls",
    "exprimes": "total_exprimes",
}
# ratio -> (numerator total, denominator total), all in percent
ELECTION_RATIOS = {
    "ratio_abstentions_inscrits": ("total_abstentions", "total_inscrits"),
    "ratio_votants_inscrits": ("total_votants", "total_inscrits"),
    "ratio_blancs_votants": ("total_blancs", "total_votants"),
    "ratio_nuls_votants": ("total_nuls", "total_votants"),
    "ratio_exprimes_inscrits": ("total_exprimes", "total_inscrits"),
    "ratio_exprimes_votants": ("total_exprimes", "total_votants"),
}
SOURCE_ASSOCIATIONS = "rna_waldec_20260306_dpt_92+93+94"
SOURCE_CRIME = "donnee-data.gouv-2025-geographie2025-produit-le2026-02-03.csv"
SOURCE_SOCIO = "dossier_complet.csv"
SOURCE_ELECTIONS = "presidentielle-2022-general-results.csv"
SOURCE_CANDIDATES = "presidentielle-2022-communes-t1.csv"


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name (bag semantics)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


# B1 -------------------------------------------------------------------------
def association_counts(raw: DataFrame | Sequence[DataFrame], code: str = "adrs_codeinsee",
                       position: str = "position", prefixes: Sequence[str] = DEPARTMENTS,
                       active: str = ACTIVE_POSITION) -> DataFrame:
    """Active associations per commune over one or several files."""
    df = union_all(raw) if isinstance(raw, (list, tuple)) else raw
    return (df.select(code, position)
              .where(prefix_in(code, prefixes) & (F.col(position) == active))
              .groupBy(F.col(code).alias("code_commune"))
              .agg(F.count(F.lit(1)).alias("nb_associations")))


# B2 -------------------------------------------------------------------------
def crime_pivot(raw: DataFrame, code: str = "CODGEO_2025", year: str = "annee",
                indicator: str = "indicateur", rate: str = "taux_pour_mille",
                year_value: int = CRIME_YEAR, prefixes: Sequence[str] = DEPARTMENTS,
                indicators: dict[str, str] | None = None,
                sentinels: Sequence[str] = SENTINELS_NA) -> DataFrame:
    """Indicators in rows -> one average column per indicator, per commune,
    for one year.  NULL where a commune has no (valid) value."""
    indicators = indicators or CRIME_INDICATORS
    df = raw.where((F.col(year).try_cast("int") == year_value) & prefix_in(code, prefixes))
    out = pivot_avg(df, [code], indicator, clean_double(rate, sentinels), indicators)
    return out.withColumnRenamed(code, "code_commune")


def patch_missing(df: DataFrame, key_value: str = PATCHED_COMMUNE, key: str = "code_commune",
                  source: str = PATCH_SOURCE, load_ts: _dt.datetime | None = None) -> DataFrame:
    """Append one known-missing key with NULL measures and its own provenance."""
    row = {key: key_value, "source_fichier": source}
    if "date_chargement" in df.columns:
        row["date_chargement"] = load_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return append_rows(df, [row])


# B3 -------------------------------------------------------------------------
def neutral_fill(df: DataFrame, measures: Sequence[str] = tuple(CRIME_RATES)) -> DataFrame:
    """NULL measures -> 0 (the patched row included)."""
    return fill_zero(df, list(measures))


# B4 -------------------------------------------------------------------------
def socio_clean(raw: DataFrame, code: str = "CODGEO", doubles: dict[str, str] | None = None,
                ints: dict[str, str] | None = None, prefixes: Sequence[str] = DEPARTMENTS,
                sentinels: Sequence[str] = SENTINELS_SECRET) -> DataFrame:
    """Wide clean projection: every measure cleaned in one ``select``."""
    doubles = SOCIO_DOUBLES if doubles is None else doubles
    ints = SOCIO_INTS if ints is None else ints
    cols = [F.col(code).alias("code_commune")]
    cols += [clean_double(src, sentinels).alias(dst) for src, dst in doubles.items()]
    cols += [clean_int(src, sentinels).alias(dst) for src, dst in ints.items()]
    return raw.where(prefix_in(code, prefixes)).select(*cols)


# B5 -------------------------------------------------------------------------
def participation(raw: DataFrame, keys: Sequence[str] = tuple(ELECTION_KEYS),
                  measures: dict[str, str] | None = None,
                  ratios: dict[str, tuple[str, str]] | None = None,
                  dept: str = "code_departement", prefixes: Sequence[str] = DEPARTMENTS,
                  sentinels: Sequence[str] = SENTINELS_NA) -> DataFrame:
    """Totals per commune key and six zero-guarded percentage ratios."""
    measures = measures or ELECTION_MEASURES
    ratios = ratios or ELECTION_RATIOS
    df = raw.where(prefix_in(dept, prefixes))
    exprs = {dst: clean_double(src, sentinels) for src, dst in measures.items()}
    return grouped_sums_with_ratios(df, list(keys), exprs, ratios)


# B6 -------------------------------------------------------------------------
def candidate_shares(raw: DataFrame, keys: Sequence[str] = tuple(ELECTION_KEYS),
                     first: str = "prenom", last: str = "nom", votes: str = "voix",
                     dept: str = "code_departement", departments: Sequence[str] = DEPARTMENTS,
                     partition_by: Sequence[str] = ("code_commune",),
                     sentinels: Sequence[str] = SENTINELS_NA,
                     extra: Sequence[str] = (), ordered: bool = False) -> DataFrame:
    """One row per candidate and commune: trimmed names, integer votes and the
    share of the commune's votes in percent (0 when the commune total is 0).
    ``ordered``: by department, commune and votes, most first (O2)."""
    df = raw.where(F.col(dept).isin(list(departments))).select(
        *keys, *extra,
        trim_spaces(first).alias("prenom"),
        trim_spaces(last).alias("nom"),
        clean_int(votes, sentinels).alias("voix"))
    if ordered:
        return ordered_shares(df, "voix", list(partition_by), "pourcentage_voix",
                              [F.col(dept).asc_nulls_last(), F.col(keys[2]).asc_nulls_last(), F.col("voix").desc_nulls_last()])
    return share_of_partition(df, "voix", list(partition_by), "pourcentage_voix")


def build_clean_crime(stored: DataFrame) -> DataFrame:
    """B3 from the stored B2."""
    return neutral_fill(stored)


def build_bronze(raw: dict[str, DataFrame], load_ts: _dt.datetime | None = None) -> dict[str, DataFrame]:
    """The Bronze tables that raw inputs give (keys: associations (list),
    crime, socio, elections, candidates); ``criminalite_commune_clean``
    follows from a stored one, see ``build_clean_crime``."""
    crime = with_provenance(crime_pivot(raw["crime"]), SOURCE_CRIME, load_ts)
    crime = patch_missing(crime, load_ts=load_ts)
    return {
        "vie_associative_commune": with_provenance(association_counts(raw["associations"]),
                                                   SOURCE_ASSOCIATIONS, load_ts),
        "criminalite_commune": crime,
        "socio_demo_communes": with_provenance(socio_clean(raw["socio"]), SOURCE_SOCIO, load_ts),
        "elections_communes": with_provenance(participation(raw["elections"]), SOURCE_ELECTIONS, load_ts),
        "presidentielle_2022_communes_candidats_pct": with_provenance(
            candidate_shares(raw["candidates"]), SOURCE_CANDIDATES, load_ts),
    }
