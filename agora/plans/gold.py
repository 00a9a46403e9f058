"""BRONZE -> GOLD: star schema dimensions (G1-G7) and facts (F1-F8).

Facts join the *current* rows of the commune dimension (inner join: a
fact row whose commune is unknown is dropped), carry a dense surrogate
key ``id_fait`` and end with ``fk_chargement, source_fichier,
date_chargement``.  Surrogate keys are numbered with the distributed
``dense_key`` (range partitioning, no single-partition window).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora.functions.clean import (code_to_label, count_missing, d_to_int, norm_name,
                                   null_safe_sum, pct_to_ratio, rate_if_positive, typed_null)
from agora.operators.keys import Rows, dense_key, in_scratch, small_dense_key, stored_rows
from agora.operators.windows import rank_desc
from agora.session import together

# ---------------------------------------------------------------------------
# Reference dimensions of the source pipeline.
# ---------------------------------------------------------------------------
CALENDAR_DATES = [
    (1, "2022-01-01"),
    (2, "2022-04-10"),
    (3, "2022-06-30"),
    (4, "2022-12-31"),
    (5, "2021-12-31"),
    (6, "2023-12-31"),
    (7, "2024-12-31"),
]
# Five-year presidential cycle; 2022 is an election year.
ELECTION_CYCLE_YEARS = 5
ELECTION_CYCLE_ANCHOR = 2022

DEPARTMENT_NAMES = {"92": "Hauts-de-Seine", "93": "Seine-Saint-Denis", "94": "Val-de-Marne"}
UNKNOWN_DEPARTMENT = "Inconnu"
REGION_CODE = "11"
REGION_NAME = "Île-de-France"
URBAN_ZONE = "urbain"

# id_parti, nom_parti, sigle_parti, famille_politique, couleur_hex
PARTIES = [
    (1, "La République En Marche", "LREM", "Centre", "#FF8C00"),
    (2, "Rassemblement National", "RN", "Droite radicale", "#0D1E8C"),
    (3, "La France Insoumise", "LFI", "Gauche radicale", "#CC2443"),
    (4, "Les Républicains", "LR", "Droite", "#0066CC"),
    (5, "Reconquête", "REC", "Droite radicale", "#00BFFF"),
    (6, "Parti Socialiste", "PS", "Gauche", "#FF69B4"),
    (7, "Europe Écologie Les Verts", "EELV", "Gauche écolo", "#27AE60"),
    (8, "Parti Communiste Français", "PCF", "Gauche radicale", "#CC0000"),
    (9, "Debout la France", "DLF", "Droite souv.", "#8B4513"),
    (10, "Union Populaire Républicaine", "UPR", "Droite souv.", "#483D8B"),
    (11, "Lutte Ouvrière", "LO", "Extrême gauche", "#FF4500"),
    (12, "Nouveau Parti Anticapitaliste", "NPA", "Extrême gauche", "#8B0000"),
    (99, "Non applicable", "NA", "NA", "#CCCCCC"),
]
# id_candidat, prenom, nom, fk_parti (0 = unknown member)
CANDIDATES = [
    (1, "Emmanuel", "MACRON", 1),
    (2, "Marine", "LE PEN", 2),
    (3, "Jean-Luc", "MÉLENCHON", 3),
    (4, "Éric", "ZEMMOUR", 5),
    (5, "Valérie", "PÉCRESSE", 4),
    (6, "Yannick", "JADOT", 7),
    (7, "Jean", "LASSALLE", 9),
    (8, "Fabien", "ROUSSEL", 8),
    (9, "Anne", "HIDALGO", 6),
    (10, "Nicolas", "DUPONT-AIGNAN", 9),
    (11, "Philippe", "POUTOU", 12),
    (12, "Nathalie", "ARTHAUD", 11),
    (0, "NON", "APPLICABLE", 99),
]
ELECTIONS = [(1, 2, "présidentielle", 1, "nationale", 2022)]
VOTE_RESULT_TYPES = [(1, "CANDIDAT", "Vote pour un candidat"), (2, "BLANC", "Vote blanc"),
                     (3, "NUL", "Vote nul")]
PARTICIPATION_TYPES = [(1, "VOTANT", "Électeur ayant voté"),
                       (2, "ABSTENTION", "Électeur abstentionniste")]

# Constant foreign keys of the facts.
ELECTION_ID = 1
RESULT_TYPE_CANDIDATE = 1
PARTICIPATION_TYPE_VOTER = 1
LOAD_BRONZE_TO_GOLD = 1
TIME_2022 = 1
TIME_2021_REF = 5
TIME_2024_REF = 7

SOURCE_EDUCATION_SCHEMA = T.StructType([
    T.StructField("id_fait", T.IntegerType()),
    T.StructField("fk_commune", T.IntegerType()),
    T.StructField("fk_temps", T.IntegerType()),
    T.StructField("taux_diplomes_bac", T.DoubleType()),
    T.StructField("taux_diplomes_superieur", T.DoubleType()),
    T.StructField("taux_sans_diplome", T.DoubleType()),
    T.StructField("taux_scolarisation_3_17", T.DoubleType()),
    T.StructField("nb_eleves_primaire", T.IntegerType()),
    T.StructField("nb_eleves_secondaire", T.IntegerType()),
    T.StructField("nb_etudiants", T.IntegerType()),
    T.StructField("fk_chargement", T.IntegerType()),
    T.StructField("source_fichier", T.StringType()),
    T.StructField("date_chargement", T.TimestampType()),
])


def _ts(load_ts: _dt.datetime | None) -> Column:
    return F.lit(load_ts).cast("timestamp") if load_ts else F.current_timestamp()


def _validity(load_ts) -> dict[str, Column]:
    return {"date_debut_validite": _ts(load_ts),
            "date_fin_validite": typed_null("timestamp"),
            "is_current": F.lit(True)}


# G1 -------------------------------------------------------------------------
def calendar_attributes(date_col: Column) -> dict[str, Column]:
    """Year, month, quarter, half-year and election-year flag of a date."""
    year = F.year(date_col)
    return {
        "annee": year,
        "mois": F.month(date_col),
        "trimestre": F.quarter(date_col),
        "semestre": F.when(F.month(date_col) <= 6, 1).otherwise(2),
        "annee_electorale": F.pmod(year - ELECTION_CYCLE_ANCHOR, F.lit(ELECTION_CYCLE_YEARS)) == 0,
    }


def dim_temps(spark: SparkSession, dates: Sequence[tuple[int, str]] = tuple(CALENDAR_DATES)) -> DataFrame:
    """Calendar dimension from (id, ISO date) pairs, attributes derived."""
    df = spark.createDataFrame(list(dates), "id_temps int, d string")
    d = F.to_date("d")
    return df.select("id_temps", d.alias("date_reference"),
                     *[c.alias(n) for n, c in calendar_attributes(d).items()])


def dim_temps_from(df: DataFrame, date_col: str) -> DataFrame:
    """Calendar dimension of the distinct dates found in ``date_col``.

    The distinct is a distributed aggregate; its output is bounded by the
    number of calendar days, so the numbering window is small."""
    dates = df.select(F.to_date(F.col(date_col)).alias("date_reference")).where(
        F.col("date_reference").isNotNull()).distinct()
    return small_dense_key(dates, ["date_reference"], "id_temps").select(
        F.col("id_temps").cast("int"), "date_reference",
        *[c.alias(n) for n, c in calendar_attributes(F.col("date_reference")).items()])


# G2 -------------------------------------------------------------------------
def dim_commune(communes: DataFrame, labels: DataFrame, load_ts=None, code: str = "code_commune",
                label_code: str = "code_commune", label: str = "libelle_commune",
                departments: dict[str, str] | None = None, dept_len: int = 2) -> DataFrame:
    """SCD2 initial snapshot: every commune of ``communes`` with the label(s)
    found for its code in ``labels`` (fallback: the code itself), department
    and region attributes, validity triple, dense key ``id_commune``.

    A code with two labels yields two rows, as a left join to a DISTINCT
    subquery does; the uniqueness rule of the quality suite reports it.
    """
    departments = DEPARTMENT_NAMES if departments is None else departments
    lab = labels.select(F.col(label_code).alias("__lc"), F.col(label).alias("__ll")).distinct()
    s = communes.select(F.col(code).alias("code_commune"))
    j = s.join(lab, F.col("code_commune") == F.col("__lc"), "left")
    dept = F.substring("code_commune", 1, dept_len)
    snap = j.select(
        "code_commune",
        F.coalesce(F.col("__ll"), F.col("code_commune")).alias("nom_commune"),
        typed_null("string").alias("code_postal"),
        dept.alias("code_departement"),
        code_to_label(dept, departments, UNKNOWN_DEPARTMENT).alias("nom_departement"),
        F.lit(REGION_CODE).alias("code_region"),
        F.lit(REGION_NAME).alias("nom_region"),
        typed_null("double").alias("superficie_km2"),
        F.lit(URBAN_ZONE).alias("zone_urbaine"),
        typed_null("string").alias("code_epci"),
        *[c.alias(n) for n, c in _validity(load_ts).items()],
    )
    keyed = dense_key(snap, ["code_commune", "nom_commune"], "id_commune", reused=True)
    return keyed.select("id_commune", *[c for c in snap.columns])


# G3-G7 ----------------------------------------------------------------------
def dim_parti_politique(spark: SparkSession, load_ts=None) -> DataFrame:
    df = spark.createDataFrame(PARTIES, "id_parti int, nom_parti string, sigle_parti string, "
                                        "famille_politique string, couleur_hex string")
    return df.withColumns(_validity(load_ts))


def dim_candidat(spark: SparkSession, load_ts=None) -> DataFrame:
    df = spark.createDataFrame(CANDIDATES, "id_candidat int, prenom string, nom string, fk_parti int")
    return df.withColumns(_validity(load_ts))


def dim_election(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ELECTIONS, "id_election int, fk_temps int, type_election string, "
                                            "tour int, zone_geographique string, annee_election int")


def dim_type_resultat_vote(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(VOTE_RESULT_TYPES, "id_type_resultat int, code string, libelle string")


def dim_type_participation(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PARTICIPATION_TYPES,
                                 "id_type_participation int, code string, libelle string")


def reference_dimension(values: DataFrame, name_col: str, id_col: str, parent_col: str | None = None,
                        unknown: tuple | None = None, load_ts=None) -> DataFrame:
    """A reference dimension from the distinct values of ``name_col``:
    dense id by name, optional parent key, an unknown member row and the
    validity triple.  ``unknown`` = (id, name[, parent id])."""
    cols = [name_col] + ([parent_col] if parent_col else [])
    distinct = values.select(*cols).where(F.col(name_col).isNotNull()).distinct()
    keyed = dense_key(distinct, [name_col] + ([parent_col] if parent_col else []), id_col)
    keyed = keyed.select(F.col(id_col).cast("int"), *cols)
    if unknown is not None:
        spark = values.sparkSession
        fields = [F.lit(unknown[0]).cast("int").alias(id_col),
                  F.lit(unknown[1]).cast(values.schema[name_col].dataType).alias(name_col)]
        if parent_col:
            fields.append(F.lit(unknown[2]).cast(values.schema[parent_col].dataType).alias(parent_col))
        keyed = keyed.unionByName(spark.range(1).select(*fields))
    return keyed.withColumns(_validity(load_ts))


# Facts ----------------------------------------------------------------------
def join_current_commune(df: DataFrame, dim: DataFrame, code: str = "code_commune") -> DataFrame:
    """Inner join to the current commune rows; adds ``__dim_key`` (id_commune).

    The dimension comes out of ``dense_key`` as a written table, so the
    planner knows its on-disk size and broadcasts it only below
    ``spark.sql.autoBroadcastJoinThreshold`` (a shuffle join otherwise)."""
    cur = dim.where(F.col("is_current")).select(F.col("code_commune").alias("__dim_code"),
                                               F.col("id_commune").alias("__dim_key"))
    return df.join(cur, F.col(code) == F.col("__dim_code"), "inner").drop("__dim_code")


def _fact_tail(source: Column | str, load_ts) -> list[Column]:
    src = F.col(source) if isinstance(source, str) else source
    return [F.lit(LOAD_BRONZE_TO_GOLD).alias("fk_chargement"), src.alias("source_fichier"),
            _ts(load_ts).alias("date_chargement")]


def _keyed(df: DataFrame | Rows, order: Sequence, columns: Sequence[str], with_key: bool = True) -> DataFrame:
    """Number the fact rows (``id_fait``); consumers that never read the key
    (quality checks, the feature mart) pass ``with_key=False`` and skip the
    range sort and the frozen write that numbering needs."""
    if not with_key:
        return (df.frame if isinstance(df, Rows) else df).select(*columns)
    return dense_key(df, order, "id_fait").select("id_fait", *columns)


def fact_resultats(bronze: DataFrame, communes: DataFrame, candidates: DataFrame,
                   load_ts=None, tiebreak: Sequence[str] = (), with_key: bool = True,
                   with_rank: bool = True) -> DataFrame:
    """one row per candidate and commune, unknown names -> candidate 0,
    rank of the votes inside the commune (ties share a rank).  Without
    ``with_rank`` the rank is left out, for consumers that never read it."""
    b = join_current_commune(bronze, communes)
    dc = candidates.where(F.col("is_current")).select(
        norm_name("nom").alias("__cand_nom"), F.col("id_candidat").alias("__cand_id"))
    j = b.join(dc, norm_name(F.col("nom")) == F.col("__cand_nom"), "left").drop("__cand_nom")
    if with_rank or with_key:  # rank and key are both made from one stored copy of the joined rows
        j, path = stored_rows(j)
        in_scratch(path)
    if with_rank:
        j = rank_desc(j, "voix", ["code_commune"], "rang_commune")
    out = j.select(
        "code_commune", "__cand_id", *tiebreak,
        F.col("__dim_key").alias("fk_commune"),
        F.lit(ELECTION_ID).alias("fk_election"),
        F.coalesce(F.col("__cand_id"), F.lit(0)).alias("fk_candidat"),
        F.lit(RESULT_TYPE_CANDIDATE).alias("fk_type_resultat"),
        F.col("voix").cast("int").alias("nb_voix"),
        pct_to_ratio("pourcentage_voix").alias("ratio_voix_exprimes"),
        typed_null("int").alias("delta_voix_vs_precedent"),
        typed_null("double").alias("delta_ratio_vs_precedent"),
        *(["rang_commune"] if with_rank else []),
        *_fact_tail("source_fichier", load_ts))
    cols = ["fk_commune", "fk_election", "fk_candidat", "fk_type_resultat", "nb_voix",
            "ratio_voix_exprimes", "delta_voix_vs_precedent", "delta_ratio_vs_precedent",
            *(["rang_commune"] if with_rank else []), "fk_chargement", "source_fichier", "date_chargement"]
    order = ["code_commune", "__cand_id", *tiebreak, "nb_voix", "fk_commune"]
    return _keyed(out, order, cols, with_key)


def fact_participation(bronze: DataFrame, communes: DataFrame, load_ts=None,
                       tiebreak: Sequence[str] = (), with_key: bool = True) -> DataFrame:
    """counts as int, participation and abstention as [0..1]."""
    b = join_current_commune(bronze, communes)
    out = b.select(
        "code_commune", *tiebreak,
        F.col("__dim_key").alias("fk_commune"),
        F.lit(ELECTION_ID).alias("fk_election"),
        F.lit(PARTICIPATION_TYPE_VOTER).alias("fk_type_participation"),
        d_to_int("total_inscrits").alias("total_inscrits"),
        d_to_int("total_votants").alias("total_votants"),
        d_to_int("total_exprimes").alias("total_exprimes"),
        d_to_int("total_abstentions").alias("nb_abstentions"),
        d_to_int("total_blancs").alias("nb_votes_blancs"),
        d_to_int("total_nuls").alias("nb_votes_nuls"),
        pct_to_ratio("ratio_votants_inscrits").alias("taux_participation"),
        pct_to_ratio("ratio_abstentions_inscrits").alias("taux_abstention"),
        typed_null("double").alias("delta_participation_vs_precedent"),
        typed_null("double").alias("delta_abstention_vs_precedent"),
        *_fact_tail("source_fichier", load_ts))
    cols = [c for c in out.columns if c not in ("code_commune", *tiebreak)]
    return _keyed(out, ["code_commune", *tiebreak, "fk_commune"], cols, with_key)


def fact_population(socio: DataFrame, communes: DataFrame, load_ts=None, with_key: bool = True) -> DataFrame:
    """population measures (the 75+ column takes the 75-89 bucket)."""
    s = join_current_commune(socio, communes)
    out = s.select(
        "code_commune",
        F.col("__dim_key").alias("fk_commune"),
        F.lit(TIME_2021_REF).alias("fk_temps"),
        F.col("population_totale_2022").alias("population_totale"),
        "population_0_14_ans", "population_15_29_ans", "population_30_44_ans",
        "population_45_59_ans", "population_60_74_ans",
        F.col("population_75_89_ans").alias("population_75_plus"),
        "population_hommes", "population_femmes",
        typed_null("double").alias("densite_population"),
        typed_null("double").alias("age_median"),
        typed_null("double").alias("part_immigres"),
        typed_null("double").alias("part_etrangers"),
        *_fact_tail("source_fichier", load_ts))
    cols = [c for c in out.columns if c != "code_commune"]
    return _keyed(out, ["code_commune", "fk_commune"], cols, with_key)


def fact_revenu(socio: DataFrame, communes: DataFrame, load_ts=None, with_key: bool = True) -> DataFrame:
    """incomes as int, poverty rates, income shares, count of secret values."""
    s = join_current_commune(socio, communes)
    out = s.select(
        "code_commune",
        F.col("__dim_key").alias("fk_commune"),
        F.lit(TIME_2021_REF).alias("fk_temps"),
        d_to_int("revenu_median_menages_2021").alias("revenu_median_menages"),
        d_to_int("revenu_decile_1_menages").alias("revenu_decile_1"),
        d_to_int("revenu_decile_9_menages").alias("revenu_decile_9"),
        F.col("taux_pauvrete_total_2021").alias("taux_pauvrete_total"),
        "taux_pauvrete_0_14_ans", "taux_pauvrete_15_29_ans", "taux_pauvrete_30_44_ans",
        "taux_pauvrete_45_59_ans", "taux_pauvrete_60_74_ans",
        F.col("taux_pauvrete_75_ans_plus").alias("taux_pauvrete_75_plus"),
        "part_revenus_activite", "part_revenus_patrimoine", "part_prestations_familiales",
        "part_prestations_sociales", "part_aides_logement",
        count_missing(["revenu_median_menages_2021", "taux_pauvrete_total_2021",
                       "revenu_decile_1_menages", "revenu_decile_9_menages"]).alias("nb_valeurs_secretes"),
        F.lit(False).alias("is_imputed"),
        typed_null("string").alias("imputation_methode"),
        *_fact_tail("source_fichier", load_ts))
    cols = [c for c in out.columns if c != "code_commune"]
    return _keyed(out, ["code_commune", "fk_commune"], cols, with_key)


UNEMPLOYED = ["chomeurs_15_24_ans", "chomeurs_25_54_ans", "chomeurs_55_64_ans"]


def fact_economie(socio: DataFrame, communes: DataFrame, associations: DataFrame,
                  load_ts=None, with_key: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """unemployment rate (percent, only when the workforce is > 0),
    labour and business counts, associations (0 when none); ``keep``: source
    columns to carry along."""
    s = join_current_commune(socio, communes)
    v = associations.select(F.col("code_commune").alias("__v_code"),
                            F.col("nb_associations").alias("__v_n"))
    s = s.join(v, F.col("code_commune") == F.col("__v_code"), "left").drop("__v_code")
    unemployed = null_safe_sum(UNEMPLOYED)
    out = s.select(
        "code_commune",
        F.col("__dim_key").alias("fk_commune"),
        F.lit(TIME_2024_REF).alias("fk_temps"),
        rate_if_positive(unemployed, "actifs_15_ans_plus").alias("taux_chomage"),
        F.col("actifs_15_ans_plus").alias("actifs_total"),
        F.col("actifs_occupes_15_ans_plus").alias("actifs_occupes_total"),
        unemployed.alias("chomeurs_total"),
        "nombre_salaries", "nombre_non_salaries",
        F.col("nombre_total_etablissements_2023").alias("nb_etablissements"),
        F.col("nombre_creations_entreprises_2024").alias("creations_entreprises"),
        F.col("effectif_total_salarie_2024").alias("effectif_total_salarie"),
        F.coalesce(F.col("__v_n"), F.lit(0)).cast("long").alias("nb_associations"),
        *keep,
        *_fact_tail("source_fichier", load_ts))
    cols = [c for c in out.columns if c != "code_commune"]
    return _keyed(out, ["code_commune", "fk_commune"], cols, with_key)


CRIME_RATES = ["taux_cambriolage", "taux_violence_famille", "taux_violence_sexuelle", "taux_vols_armes"]


def fact_securite(crime_clean: DataFrame, communes: DataFrame, load_ts=None, with_key: bool = True) -> DataFrame:
    """the four filled crime rates."""
    c = join_current_commune(crime_clean, communes)
    out = c.select("code_commune", F.col("__dim_key").alias("fk_commune"),
                   F.lit(TIME_2022).alias("fk_temps"), *CRIME_RATES,
                   *_fact_tail("source_fichier", load_ts))
    cols = [c for c in out.columns if c != "code_commune"]
    return _keyed(out, ["code_commune", "fk_commune", "source_fichier"], cols, with_key)


def fact_logement(socio: DataFrame, communes: DataFrame, load_ts=None, with_key: bool = True) -> DataFrame:
    """housing counts."""
    s = join_current_commune(socio, communes)
    out = s.select("code_commune", F.col("__dim_key").alias("fk_commune"),
                   F.lit(TIME_2022).alias("fk_temps"),
                   F.col("nombre_total_logements").alias("logements_total"),
                   F.col("nombre_logements_vacants").alias("logements_vacants"),
                   F.col("residences_principales_hlm").alias("logements_hlm"),
                   *_fact_tail("source_fichier", load_ts))
    cols = [c for c in out.columns if c != "code_commune"]
    return _keyed(out, ["code_commune", "fk_commune"], cols, with_key)


def fact_education(spark: SparkSession) -> DataFrame:
    """F8: declared schema, intentionally empty (no source yet)."""
    return spark.createDataFrame([], SOURCE_EDUCATION_SCHEMA)


def build_gold(spark: SparkSession, bronze: dict[str, DataFrame], load_ts=None,
               labels: DataFrame | None = None) -> dict[str, DataFrame]:
    """The Gold tables of the stored Bronze ones; the communes' ``labels`` come
    from the election results unless given."""
    communes = dim_commune(bronze["socio_demo_communes"], bronze["elections_communes"] if labels is None else labels, load_ts)
    candidates = dim_candidat(spark, load_ts)
    socio = bronze["socio_demo_communes"]
    facts = {
        "FACT_RESULTATS_ELECTORAUX": lambda: fact_resultats(
            bronze["presidentielle_2022_communes_candidats_pct"], communes, candidates, load_ts,
            tiebreak=["nom", "prenom", "code_departement", "libelle_departement", "libelle_commune"]),
        "FACT_PARTICIPATION_ELECTORALE": lambda: fact_participation(
            bronze["elections_communes"], communes, load_ts,
            tiebreak=["code_departement", "libelle_departement", "libelle_commune"]),
        "FACT_POPULATION": lambda: fact_population(socio, communes, load_ts),
        "FACT_REVENU": lambda: fact_revenu(socio, communes, load_ts),
        "FACT_ECONOMIE_LOCALE": lambda: fact_economie(socio, communes, bronze["vie_associative_commune"], load_ts),
        "FACT_SECURITE": lambda: fact_securite(bronze["criminalite_commune_clean"], communes, load_ts),
        "FACT_LOGEMENT": lambda: fact_logement(socio, communes, load_ts),
    }
    return {
        "DIM_TEMPS": dim_temps(spark),
        "DIM_COMMUNE": communes,
        "DIM_PARTI_POLITIQUE": dim_parti_politique(spark, load_ts),
        "DIM_CANDIDAT": candidates,
        "DIM_ELECTION": dim_election(spark),
        "DIM_TYPE_RESULTAT_VOTE": dim_type_resultat_vote(spark),
        "DIM_TYPE_PARTICIPATION": dim_type_participation(spark),
        **dict(zip(facts, together(facts.values()))),
        "FACT_EDUCATION": fact_education(spark),
    }
