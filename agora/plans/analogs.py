"""The pipeline's operators run on the driver's tables (``queries()``).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame built by
the library operators over raw-shaped inputs derived from whole tables
(see ``inputs``).  Load timestamps are not part of these outputs (they
are injected values, not results); double measures are rounded to 6
digits so the last float bits of sums do not depend on the engine.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agora.functions.clean import clean_double, clean_int
from agora.operators.keys import dense_key, freeze, in_scratch, scratch
from agora.operators.quality import LOG_SCHEMA, WatchedRules, evaluate_rules, fail_count, quality_summary
from agora.operators.reshape import with_provenance
from agora.operators.scoring import (LinearModel, dummy_name, expand_candidates, one_hot_align,
                                     predict_scores as _predict_scores, ranking, score_with_pipeline,
                                     vote_allocation as _alloc, winners, with_status, CANDIDATS)
from agora.operators.training import fit_model, known_candidates, load_model, save_model, training_rows
from agora.plans import bronze, gold, governance, pipeline
from agora.plans import inputs as I
from agora.sources.ingest import ingest_summary as _ingest_summary, landed_listing, landing_report
from agora.plans.features import build_feature_mart, socio_facts
from agora.session import ensure_checkpoint_dir
from agora.sources.raw import read_testdata, read_text_csv
from agora.sources.tables import bucketed_table, read_table, replace_table

LOAD_TS = _dt.datetime(2026, 1, 1, 2, 0, 0)
END_TS = _dt.datetime(2026, 1, 1, 2, 30, 0)
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
BUCKETS = 8


class Build:
    """One query's build context: every intermediate table is defined once
    and reused by the plans that need it (one checkpointed dimension, not
    one per fact)."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf
        self._memo: dict[str, DataFrame] = {}

    def get(self, name: str, maker):
        if name not in self._memo:
            self._memo[name] = maker(self)
        return self._memo[name]


def _memo(fn):
    """Decorate ``fn(b: Build)``; callable as ``fn(spark, sf)`` or ``fn(build)``."""
    def wrapper(*args):
        b = args[0] if isinstance(args[0], Build) else Build(args[0], args[1])
        return b.get(fn.__name__, fn)
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


def _r6(df: DataFrame) -> DataFrame:
    """Round every double column to 6 digits; drop timestamp columns."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            continue
        if isinstance(f.dataType, T.DoubleType):
            cols.append(F.round(F.col(f.name), 6).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# C20 / C21 -------------------------------------------------------------------
def q_clean_double(spark, sf):
    li = I.LINEITEM_DIRTY.frame(spark, sf)
    v = clean_double("d_text", sentinels=("", "NA"))
    return _r6(li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(v.isNull()).alias("n_null"),
        F.sum(v).alias("sum_v"),
        F.avg(v).alias("avg_v")))


def q_clean_int(spark, sf):
    li = I.LINEITEM_DIRTY.frame(spark, sf)
    v = clean_int("i_text", sentinels=("", "S"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(v.isNull()).alias("n_null"),
        F.sum(v).alias("sum_i"),
        F.max(v).alias("max_i"))


# Bronze builders ---------------------------------------------------------------
def _association_files(spark, sf):
    orders = read_testdata(spark, sf, "orders")
    return [orders.where(F.col("o_orderpriority").isin([p.strip("'") for p in branch]))
                  .selectExpr(*I.ASSOC_ITEMS[:2]) for branch in I.ASSOC_BRANCHES]


@_memo
def associations(b):
    """B1 over three 'files' (orders split by priority), UNION ALL."""
    return bronze.association_counts(_association_files(b.spark, b.sf), prefixes=I.ASSOC_PREFIXES, active=I.ASSOC_ACTIVE)


@_memo
def crime(b):
    raw = I.EVENTS_CRIME.frame(b.spark, b.sf)
    return bronze.crime_pivot(raw, year_value=I.CRIME_YEAR, prefixes=I.CRIME_PREFIXES,
                              indicators=I.CRIME_INDICATORS)


@_memo
def crime_patched(b):
    df = with_provenance(crime(b), I.CRIME_SOURCE, LOAD_TS)
    return bronze.patch_missing(df, key_value=I.PATCH_CODE, load_ts=LOAD_TS)


@_memo
def crime_clean(b):
    return bronze.neutral_fill(crime_patched(b))


@_memo
def socio(b):
    raw = I.CUSTOMER_SOCIO.frame(b.spark, b.sf)
    return with_provenance(bronze.socio_clean(raw, prefixes=I.SOCIO_PREFIXES), I.SOCIO_SOURCE, LOAD_TS)


@_memo
def elections(b):
    raw = I.LINEITEM_ELECTIONS.frame(b.spark, b.sf)
    return with_provenance(bronze.participation(raw, prefixes=I.ELECTION_PREFIXES),
                           I.ELECTIONS_SOURCE, LOAD_TS)


@_memo
def candidates_pct(b):
    raw = I.ORDERS_CANDIDATES.frame(b.spark, b.sf)
    return with_provenance(bronze.candidate_shares(raw, departments=I.CANDIDATE_DEPARTMENTS),
                           I.CANDIDATES_SOURCE, LOAD_TS)


# Gold builders -----------------------------------------------------------------
@_memo
def communes(b):
    labels = I.ORDERS_LABELS.frame(b.spark, b.sf)
    return gold.dim_commune(I.CUSTOMER_COMMUNES.frame(b.spark, b.sf), labels, LOAD_TS)


@_memo
def segment_candidates(b):
    cust = read_testdata(b.spark, b.sf, "customer")
    return gold.reference_dimension(cust.select(F.col("c_mktsegment").alias("nom")), "nom", "id_candidat",
                                    unknown=I.UNKNOWN_CANDIDATE, load_ts=LOAD_TS)


@_memo
def results(b):
    return gold.fact_resultats(candidates_pct(b), communes(b), segment_candidates(b), LOAD_TS,
                               tiebreak=["nom", "prenom", "code_departement", "libelle_departement",
                                         "libelle_commune"])


@_memo
def participation(b):
    return gold.fact_participation(elections(b), communes(b), LOAD_TS,
                                   tiebreak=["code_departement", "libelle_departement", "libelle_commune"])


@_memo
def population(b):
    return gold.fact_population(socio(b), communes(b), LOAD_TS)


@_memo
def income(b):
    return gold.fact_revenu(socio(b), communes(b), LOAD_TS)


@_memo
def economy(b):
    return gold.fact_economie(socio(b), communes(b), associations(b), LOAD_TS)


@_memo
def housing(b):
    return gold.fact_logement(socio(b), communes(b), LOAD_TS)


@_memo
def security(b):
    return gold.fact_securite(crime_clean(b), communes(b), LOAD_TS)


# The same facts without ``id_fait`` for consumers that never read it.
@_memo
def participation_nokey(b):
    return gold.fact_participation(elections(b), communes(b), LOAD_TS, with_key=False)


@_memo
def population_nokey(b):
    return gold.fact_population(socio(b), communes(b), LOAD_TS, with_key=False)


@_memo
def income_nokey(b):
    return gold.fact_revenu(socio(b), communes(b), LOAD_TS, with_key=False)


@_memo
def economy_nokey(b):
    return gold.fact_economie(socio(b), communes(b), associations(b), LOAD_TS, with_key=False)


@_memo
def housing_nokey(b):
    return gold.fact_logement(socio(b), communes(b), LOAD_TS, with_key=False)


@_memo
def security_nokey(b):
    return gold.fact_securite(crime_clean(b), communes(b), LOAD_TS, with_key=False)


@_memo
def results_nokey(b):
    return gold.fact_resultats(candidates_pct(b), communes(b), segment_candidates(b), LOAD_TS,
                               with_key=False, with_rank=False)


def _q(builder):
    def run(spark, sf):
        return _r6(builder(Build(spark, sf)))
    run.__name__ = f"q_{builder.__name__}"
    return run


# Stored tables --------------------------------------------------------------
def _place(spark, name: str) -> str:
    """A new path in the shared folder; an open scratch block removes it."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/agora-{name}-{uuid.uuid4().hex}"
    in_scratch(path)
    return path


def q_csv_folder(spark, sf):
    """S1, S2, B1: three association files of one folder, each with its
    columns in another order, read as a whole by their names."""
    folder = _place(spark, "csv")
    for i, df in enumerate(_association_files(spark, sf)):
        columns = sorted(df.columns, reverse=i % 2 == 1)
        df.select(*columns, F.lit(i).alias("file")).select(*(["file", *columns] if i == 2 else columns)) \
            .write.option("header", True).csv(f"{folder}/{i}")
    raw = read_text_csv(spark, f"{folder}/*", ["adrs_codeinsee", "position"])
    return bronze.association_counts(raw, prefixes=I.ASSOC_PREFIXES, active=I.ASSOC_ACTIVE)


def q_table_replace(spark, sf):
    """K1: a table, replaced by a later load; readers follow its pointer."""
    path, loaded = _place(spark, "table"), associations(spark, sf)
    replace_table(loaded.where(F.col("nb_associations") > 1), path)
    replace_table(loaded, path)
    return read_table(spark, path)


def q_ordered_table(spark, sf):
    """O1: B6 stored in its order across files; one department read back."""
    rows = candidates_pct(Build(spark, sf))
    stored = replace_table(rows, _place(spark, "ordered"), [("code_departement", False), ("code_commune", False), ("voix", True)])
    return _r6(stored.where(F.col("code_departement") == I.CANDIDATE_DEPARTMENTS[1]))


def q_facts_bucketed(spark, sf):
    """J1 in F2-F7: Bronze and the dimension bucketed by commune code, so that
    the facts join without an exchange; rows and key sum of each fact."""
    b = Build(spark, sf)

    def kept(builder):
        name = f"agora_{builder.__name__}_{uuid.uuid4().hex}"
        return bucketed_table(builder(b), name, "code_commune", BUCKETS, _place(spark, name))

    dim, people, crimes, votes, clubs = map(kept, (communes, socio, crime_clean, elections, associations))
    facts = {"participation": gold.fact_participation(votes, dim, LOAD_TS, with_key=False),
             "population": gold.fact_population(people, dim, LOAD_TS, with_key=False),
             "revenu": gold.fact_revenu(people, dim, LOAD_TS, with_key=False),
             "economie": gold.fact_economie(people, dim, clubs, LOAD_TS, with_key=False),
             "securite": gold.fact_securite(crimes, dim, LOAD_TS, with_key=False),
             "logement": gold.fact_logement(people, dim, LOAD_TS, with_key=False)}
    return bronze.union_all([f.agg(F.count(F.lit(1)).alias("n"), F.sum("fk_commune").alias("keys")).select(F.lit(k).alias("fact"), "n", "keys")
                             for k, f in facts.items()])


def q_landing_files(spark, sf):
    """K7, S7: files of one folder per priority, listed in tasks; bytes per folder."""
    root = _place(spark, "landed")
    orders = read_testdata(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("value"), F.col("o_orderpriority").alias("category"))
    orders.write.partitionBy("category").text(f"{root}/raw")
    listed = landed_listing(spark, root, I.BUCKET)
    folder = F.regexp_extract("object_path", "^(.*)/[^/]*$", 1)
    return listed.groupBy(F.url_decode(folder).alias("folder")).agg(F.sum("length").alias("total_octets"))


def q_share_of_partition(spark, sf):
    """B6 in its declared order (O2): department, commune, votes descending,
    NULLs last."""
    raw = I.ORDERS_CANDIDATES.frame(spark, sf)
    shares = bronze.candidate_shares(raw, departments=I.CANDIDATE_DEPARTMENTS, ordered=True)
    return _r6(with_provenance(shares, I.CANDIDATES_SOURCE, LOAD_TS))


# W3 / G1 / G3-G7 ---------------------------------------------------------------
def q_surrogate_key(spark, sf):
    orders = read_testdata(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return dense_key(orders, ["o_custkey", "o_orderkey"], "id")


def q_dim_calendar(spark, sf):
    return gold.dim_temps_from(read_testdata(spark, sf, "orders"), "o_orderdate")


def q_dim_reference(spark, sf):
    region = read_testdata(spark, sf, "region")
    nation = read_testdata(spark, sf, "nation")
    parties = gold.reference_dimension(region, "r_name", "id_parti", unknown=(99, "NA"), load_ts=LOAD_TS)
    pairs = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_name", "r_name")
    cands = gold.reference_dimension(pairs, "n_name", "id_candidat", parent_col="r_name",
                                     unknown=(0, "APPLICABLE", "NA"), load_ts=LOAD_TS)
    p = parties.select(F.col("r_name").alias("__p_name"), F.col("id_parti").alias("fk_parti"))
    out = cands.join(p, cands.r_name == F.col("__p_name"), "left")
    return out.select("id_candidat", F.col("n_name").alias("nom"), "fk_parti",
                      F.col("r_name").alias("famille_politique"), "is_current")


# Quality rules -----------------------------------------------------------------
# no rule reads id_fait: the checked facts are built without it
TABLE_BUILDERS = {
    "criminalite_commune_clean": crime_clean,
    "socio_demo_communes": socio,
    "elections_communes": elections,
    "FACT_RESULTATS_ELECTORAUX": results_nokey,
    "FACT_PARTICIPATION_ELECTORALE": participation_nokey,
    "FACT_REVENU": income_nokey,
    "DIM_COMMUNE": communes,
    "FACT_ECONOMIE_LOCALE": economy_nokey,
}

QC_GROUPS = {
    "qc_not_null": [1, 4, 7, 10, 15],
    "qc_range": [2, 11, 14, 18],
    "qc_multi_nonneg": [3],
    "qc_positive": [5, 8],
    "qc_sum_coherence": [6],
    "qc_order_coherence": [9],
    "qc_unknown_member": [12],
    "qc_complement": [13],
    "qc_positive_if_present": [16],
    "qc_unique": [17],
}
QC_EMPTY_RULES = [1, 4, 10, 17]


def _rules(ids):
    by_id = {r.id_check: r for r in governance.RULES}
    return [by_id[i] for i in ids]


def _log(b, ids):
    names = {governance.TABLE_OF[r.table_name] for r in _rules(ids)}
    tables = {n: TABLE_BUILDERS[n](b) for n in names}
    return governance.run_quality(tables, _rules(ids), LOAD_TS)


def qc(ids):
    def run(spark, sf):
        return _r6(_log(Build(spark, sf), ids))
    return run


@_memo
def suite(b):
    return _log(b, [r.id_check for r in governance.RULES])


def q_qc_observed(spark, sf):
    """K5: the same rows, the rules counted by the writes that store the tables."""
    b, log = Build(spark, sf), []  # 18 rows in all
    with scratch(spark):
        for name, rules in governance.rules_by_table().items():
            watched = WatchedRules(rules)
            stored = freeze(watched.watch(TABLE_BUILDERS[name](b)), "watched")
            log += governance.watched_log({name: stored}, {name: watched}, LOAD_TS).collect()
    return _r6(spark.createDataFrame(log, LOG_SCHEMA))


def q_qc_empty(spark, sf):
    empty = (read_testdata(spark, sf, "orders").where(F.col("o_totalprice") < 0)
             .select(F.col("o_custkey").cast("string").alias("code_commune"),
                     F.col("o_orderkey").cast("int").alias("nb_voix")))
    return _r6(evaluate_rules(empty, _rules(QC_EMPTY_RULES), LOAD_TS))


def q_qc_summary(spark, sf):
    return _r6(quality_summary(suite(spark, sf)))


def q_qc_fail_count(spark, sf):
    return fail_count(suite(spark, sf))


# Audit -------------------------------------------------------------------------
def q_audit_counts(spark, sf):
    """L1 with the end rows' counts filled from the data."""
    b = Build(spark, sf)
    raw = I.CUSTOMER_SOCIO.frame(spark, sf)
    audit = governance.audit_with_counts(spark, LOAD_TS, END_TS, [(raw, socio(b)), (socio(b), population_nokey(b))])
    return audit.withColumn("date_chargement", F.date_format("date_chargement", TS_FORMAT))


def _bronze_tables(b, load_ts):
    """The Bronze zone of the raw inputs derived from the driver's tables."""
    return {"vie_associative_commune": with_provenance(associations(b), I.ASSOC_SOURCE, load_ts),
            "criminalite_commune": crime_patched(b), "socio_demo_communes": socio(b),
            "elections_communes": elections(b), "presidentielle_2022_communes_candidats_pct": candidates_pct(b)}


@_memo
def loaded(b):
    """Every table of one end-to-end run over the driver's tables; its end rows
    count the socio-demographic rows from the raw file to the population fact."""
    def gold_tables(spark, bronze, load_ts):
        return gold.build_gold(spark, bronze, load_ts, labels=I.ORDERS_LABELS.frame(spark, b.sf))

    def loads(stored):
        people = stored["socio_demo_communes"]
        return [(I.CUSTOMER_SOCIO.frame(b.spark, b.sf), people), (people, stored["FACT_POPULATION"])]

    return pipeline.run(b.spark, b, _place(b.spark, "warehouse"), LOAD_TS, END_TS, _bronze_tables, gold_tables, loads)


def q_audit_log(spark, sf):
    """L1: the rows that a run of the pipeline writes, with the counts of its loads."""
    return loaded(Build(spark, sf))["META_CHARGEMENT"].withColumn("date_chargement", F.date_format("date_chargement", TS_FORMAT))


def q_load_history(spark, sf):
    h = governance.load_history(loaded(Build(spark, sf))["META_CHARGEMENT"])
    return h.withColumn("date_chargement", F.date_format("date_chargement", TS_FORMAT))


# Ingest ------------------------------------------------------------------------
@_memo
def landing(b):
    manifest = I.PAGES_MANIFEST.frame(b.spark, b.sf).unionByName(I.NATIONS_MANIFEST.frame(b.spark, b.sf))
    landed = I.PAGES_LANDED.frame(b.spark, b.sf)
    return landing_report(manifest, landed, bucket=I.BUCKET, prefix=I.RAW_PREFIX,
                          landed_key="url", manifest_key="url", uploaded_at=END_TS)


def q_ingest_manifest(spark, sf):
    return landing(spark, sf).drop("uploaded_at")


def q_ingest_summary(spark, sf):
    return _ingest_summary(landing(spark, sf))


# Features and scoring ----------------------------------------------------------
@_memo
def feature_mart(b):
    return build_feature_mart(communes(b), socio_facts(socio(b), communes(b), associations(b)),
                              participation_nokey(b), security_nokey(b))


# Fixed model weights (the fitted model is not part of the source material).
MODEL = LinearModel(
    intercept=120.0,
    weights={
        "population_totale_2022": 0.002, "population_15_29_ans": 0.003,
        "population_45_59_ans": -0.001, "population_60_74_ans": 0.0015,
        "revenu_median_menages_2021": 0.0004, "nombre_total_etablissements_2023": 0.01,
        "entreprises_par_habitant": 35.0, "taux_chomage_global": -40.0,
        "taux_pauvrete_total_2021": 0.6, "taux_hlm": 25.0, "associations_par_habitant": 12.0,
        "participation_reelle": 18.0, "taux_logements_vacants": -9.0, "taux_cambriolage": 0.05,
        **{dummy_name(c): w for c, w in zip(CANDIDATS, [
            -60.0, 80.0, -35.0, -30.0, -25.0, -20.0, 90.0, -10.0, 15.0, -5.0, -45.0, 110.0])},
        "nom_complet_INCONNU": 7.0,
    })


@_memo
def scenarios(b):
    return with_status(feature_mart(b))


def q_one_hot_align(spark, sf):
    rows = expand_candidates(scenarios(spark, sf))
    return _r6(one_hot_align(rows, "nom_complet", MODEL.model_columns, keep=["id_commune", "ordinal"]))


def q_predict_scores(spark, sf):
    return _r6(_predict_scores(scenarios(spark, sf), MODEL, id_col="id_commune"))


def q_vote_allocation(spark, sf):
    return _r6(_alloc(scenarios(spark, sf), MODEL, id_col="id_commune"))


def q_predict_ranking(spark, sf):
    return _r6(ranking(scenarios(spark, sf), MODEL, id_col="id_commune"))


def q_predict_winner(spark, sf):
    return _r6(winners(ranking(scenarios(spark, sf), MODEL, id_col="id_commune"), id_col="id_commune"))


# M3 --------------------------------------------------------------------------
FIT_NUMBERS = ("population_totale_2022", "taux_cambriolage")


def q_model_fit_scores(spark, sf):
    """M3: a regression fitted on the mart's communes and their votes, saved,
    loaded and applied to every commune and known candidate."""
    b = Build(spark, sf)
    known = freeze(scenarios(b), "scenarios")  # read to teach, and twice to score
    rows = training_rows(known, results_nokey(b), segment_candidates(b))
    path = _place(spark, "model")
    with scratch(spark):
        save_model(fit_model(rows, FIT_NUMBERS), path)
    model = load_model(path)
    return _r6(score_with_pipeline(known, model, candidates=known_candidates(model), id_col="id_commune"))


QUERIES = {
    "clean_double": q_clean_double,
    "clean_int": q_clean_int,
    "wide_clean": _q(socio),
    "union_filter_count": _q(associations),
    "csv_folder": q_csv_folder,
    "table_replace": q_table_replace,
    "ordered_table": q_ordered_table,
    "pivot_indicators": _q(crime),
    "manual_patch": _q(crime_patched),
    "null_to_zero": _q(crime_clean),
    "participation_ratios": _q(elections),
    "share_of_partition": q_share_of_partition,
    "surrogate_key": q_surrogate_key,
    "dim_calendar": q_dim_calendar,
    "dim_reference": q_dim_reference,
    "dim_snapshot": _q(communes),
    "fact_results": _q(results),
    "fact_participation": _q(participation),
    "fact_population": _q(population),
    "fact_income": _q(income),
    "fact_economy": _q(economy),
    "fact_security": _q(security),
    "fact_housing": _q(housing),
    "facts_bucketed": q_facts_bucketed,
    **{name: qc(ids) for name, ids in QC_GROUPS.items()},
    "qc_empty": q_qc_empty,
    "qc_suite": _q(suite),
    "qc_observed": q_qc_observed,
    "qc_summary": q_qc_summary,
    "qc_fail_count": q_qc_fail_count,
    "audit_log": q_audit_log,
    "audit_counts": q_audit_counts,
    "load_history": q_load_history,
    "ingest_manifest": q_ingest_manifest,
    "ingest_summary": q_ingest_summary,
    "landing_files": q_landing_files,
    "feature_mart": _q(feature_mart),
    "model_fit_scores": q_model_fit_scores,
    "one_hot_align": q_one_hot_align,
    "predict_scores": q_predict_scores,
    "vote_allocation": q_vote_allocation,
    "predict_ranking": q_predict_ranking,
    "predict_winner": q_predict_winner,
}
