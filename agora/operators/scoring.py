"""Batch scenario scoring, proportional vote allocation and ranking (M2-M5).

A scenario is one row of model inputs for a commune.  Each scenario is
scored for the fixed list of candidates.  The candidate list is a
literal of known length, so the expansion is a row-local generator
(``posexplode`` of a literal array): no join, no shuffle.  Totals, the
allocation and the ranking only look at the candidates of one scenario,
so they are computed inside the row on arrays (higher-order functions)
before the final explode -- again without any shuffle, whatever the
number of scenarios.

The model itself is not part of the source material; ``LinearModel``
holds fixed weights written as a Catalyst expression (features plus the
one-hot candidate columns), which is what a fitted linear regressor
computes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Candidate list (order breaks ties) and political families.
# ---------------------------------------------------------------------------
CANDIDATS = [
    "ARTHAUD Nathalie",
    "MÉLENCHON Jean-Luc",
    "ROUSSEL Fabien",
    "HIDALGO Anne",
    "LASSALLE Jean",
    "DUPONT-AIGNAN Nicolas",
    "LE PEN Marine",
    "PÉCRESSE Valérie",
    "ZEMMOUR Éric",
    "JADOT Yannick",
    "POUTOU Philippe",
    "MACRON Emmanuel",
]
FAMILLES_POLITIQUES = {
    "MACRON Emmanuel": "Centre",
    "LE PEN Marine": "Extrême droite",
    "MÉLENCHON Jean-Luc": "Gauche",
    "ZEMMOUR Éric": "Extrême droite",
    "PÉCRESSE Valérie": "Droite",
    "JADOT Yannick": "Gauche",
    "ROUSSEL Fabien": "Gauche",
    "HIDALGO Anne": "Gauche",
    "LASSALLE Jean": "Centre",
    "DUPONT-AIGNAN Nicolas": "Droite",
    "ARTHAUD Nathalie": "Extrême gauche",
    "POUTOU Philippe": "Extrême gauche",
}
UNKNOWN_FAMILY = "Non défini"
SCENARIO_FEATURES = [
    "population_totale_2022", "population_15_29_ans", "population_45_59_ans",
    "population_60_74_ans", "revenu_median_menages_2021", "nombre_total_etablissements_2023",
    "entreprises_par_habitant", "taux_chomage_global", "taux_pauvrete_total_2021", "taux_hlm",
    "associations_par_habitant", "participation_reelle", "taux_logements_vacants",
    "taux_cambriolage",
]
CATEGORY = "nom_complet"
SCORE_DIGITS = 4


@dataclass(frozen=True)
class LinearModel:
    """``score = intercept + sum(w * x)`` over ``model_columns``."""
    intercept: float
    weights: dict[str, float] = field(default_factory=dict)

    @property
    def model_columns(self) -> list[str]:
        return list(self.weights)

    def expression(self, values: dict[str, Column]) -> Column:
        expr = F.lit(float(self.intercept))
        for name, w in self.weights.items():
            expr = expr + F.lit(float(w)) * values.get(name, F.lit(0.0)).cast("double")
        return expr


#: A scenario: one label and the numbers the model reads, all of them mandatory.
SCENARIO_SCHEMA = T.StructType([T.StructField("commune", T.StringType())]
                               + [T.StructField(f, T.DoubleType()) for f in SCENARIO_FEATURES])
STATUS_SCORED, STATUS_REJECTED = "OK", "REJETE"


def read_scenarios(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Scenarios by their declared schema, each with its status."""
    return with_status(spark.read.schema(SCENARIO_SCHEMA).format(fmt).load(path))


def with_status(scenarios: DataFrame) -> DataFrame:
    """``statut``: a scenario that lacks one of its numbers is rejected; it
    keeps its row, and its scores and votes are NULL."""
    complete = reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in SCENARIO_FEATURES])
    return scenarios.withColumn("statut", F.when(complete, STATUS_SCORED).otherwise(STATUS_REJECTED))


def score_with_pipeline(scenarios: DataFrame, model, candidates: Sequence[str] | None = None,
                        prediction: str = "prediction", id_col: str = "commune") -> DataFrame:
    """Scores of a fitted Spark ML ``PipelineModel`` (its stages index or
    encode ``nom_complet`` and assemble the features): one row per complete
    scenario and candidate, rejected scenarios with a NULL score."""
    rows = expand_candidates(with_status(scenarios), tuple(candidates or CANDIDATS))
    scored = model.transform(rows.where(F.col("statut") == STATUS_SCORED)).select(
        id_col, "ordinal", F.col(CATEGORY).alias("candidat"), "statut",
        F.bround(F.col(prediction).cast("double"), SCORE_DIGITS).alias("score_brut_modele"))
    rejected = rows.where(F.col("statut") == STATUS_REJECTED).select(
        id_col, "ordinal", F.col(CATEGORY).alias("candidat"), "statut",
        F.lit(None).cast("double").alias("score_brut_modele"))
    return scored.unionByName(rejected)


def dummy_name(value: str, prefix: str = CATEGORY) -> str:
    return f"{prefix}_{value}"


def one_hot_align(df: DataFrame, category: str, model_columns: Sequence[str],
                  keep: Sequence[str] = (), prefix: str = CATEGORY) -> DataFrame:
    """Dummy-encode ``category`` and align to ``model_columns``: a dummy
    column is 1 when the category equals its value, model columns absent
    from the input are 0, input columns the model does not know are dropped."""
    cols = [F.col(k) for k in keep]
    for m in model_columns:
        if m.startswith(prefix + "_"):
            value = m[len(prefix) + 1:]
            cols.append(F.when(F.col(category) == value, 1).otherwise(0).alias(m))
        elif m in df.columns:
            cols.append(F.col(m))
        else:
            cols.append(F.lit(0).alias(m))
    return df.select(*cols)


def expand_candidates(scenarios: DataFrame, candidates: Sequence[str] = tuple(CANDIDATS),
                      category: str = CATEGORY) -> DataFrame:
    """Scenario x candidate rows (``ordinal`` keeps the list order) by a
    generator over a literal array -- row-local, no join."""
    arr = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias(category))
                    for i, c in enumerate(candidates)])
    return scenarios.select("*", F.inline(arr))


def _family(name: Column, families: dict[str, str]) -> Column:
    m = F.create_map(*[x for k, v in families.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, name), F.lit(UNKNOWN_FAMILY))


def candidate_scores(scenarios: DataFrame, model: LinearModel,
                     candidates: Sequence[str] = tuple(CANDIDATS),
                     families: dict[str, str] | None = None,
                     category: str = CATEGORY) -> Column:
    """Per scenario row: array of (ordinal, candidat, famille, score), the
    score rounded half-even to 4 digits.  For candidate c the one-hot
    columns are 1 only for c, which is what the aligned frame feeds the model."""
    families = FAMILLES_POLITIQUES if families is None else families
    values = {c: F.col(c) for c in scenarios.columns if c in model.model_columns}
    items = []
    for i, cand in enumerate(candidates):
        v = dict(values)
        for m in model.model_columns:
            if m.startswith(category + "_"):
                v[m] = F.lit(1.0 if m == dummy_name(cand, category) else 0.0)
        items.append(F.struct(F.lit(i).alias("ordinal"), F.lit(cand).alias("candidat"),
                              _family(F.lit(cand), families).alias("famille_politique"),
                              F.bround(model.expression(v), SCORE_DIGITS).alias("score_brut_modele")))
    return F.array(*items)


def predict_scores(scenarios: DataFrame, model: LinearModel, id_col: str = "commune",
                   **kw) -> DataFrame:
    """One row per scenario and candidate with the rounded model score."""
    arr = candidate_scores(scenarios, model, **kw)
    return scenarios.select(id_col, *_status_of(scenarios), F.inline(arr))


def _status_of(df: DataFrame) -> list[str]:
    return ["statut"] if "statut" in df.columns else []


def _allocated(scenarios: DataFrame, model: LinearModel, id_col: str, population: str, **kw) -> DataFrame:
    """Scenario rows with ``__c``: the candidates' scores and predicted votes.

    Votes per candidate are ``round_half_even(score / sum(scores) * population)``;
    the sum uses the rounded scores (NULL scores count as 0); a zero sum
    gives NULL votes.  Each step is its own projection so the score
    expressions are evaluated once per row, not once per lambda call.
    """
    c = F.col("__c")
    df = scenarios.select(id_col, *_status_of(scenarios), F.col(population).cast("double").alias("__pop"),
                          candidate_scores(scenarios, model, **kw).alias("__c"))
    df = df.withColumn("__total", F.aggregate(
        c, F.lit(0.0), lambda acc, x: acc + F.coalesce(x["score_brut_modele"], F.lit(0.0))))
    return df.withColumn("__c", F.transform(c, lambda x: x.withField(
        "voix_predites_estimees",
        F.bround(F.try_divide(x["score_brut_modele"], F.col("__total")) * F.col("__pop"), 0).cast("long"))))


def vote_allocation(scenarios: DataFrame, model: LinearModel, id_col: str = "commune",
                    population: str = "population_totale_2022", **kw) -> DataFrame:
    """One row per scenario and candidate with score and predicted votes."""
    return _allocated(scenarios, model, id_col, population, **kw).select(
        id_col, *_status_of(scenarios), F.inline("__c"))


def ranking(scenarios: DataFrame, model: LinearModel, id_col: str = "commune",
            population: str = "population_totale_2022", **kw) -> DataFrame:
    """Candidates by predicted votes, descending; ties keep list order
    (stable sort); NULL votes last.  ``rang`` starts at 1."""
    df = _allocated(scenarios, model, id_col, population, **kw)
    keyed = F.transform(F.col("__c"), lambda x: F.struct(
        x["voix_predites_estimees"].isNull().alias("k0"),
        (-x["voix_predites_estimees"]).alias("k1"),
        x["ordinal"].alias("k2"),
        x.alias("v")))
    ordered = F.transform(F.sort_array(keyed), lambda s: s["v"])
    return (df.select(id_col, *_status_of(df), F.posexplode(ordered).alias("pos", "c"))
              .select(id_col, *_status_of(df), (F.col("pos") + 1).alias("rang"), "c.*"))


def winners(ranked: DataFrame, id_col: str = "commune") -> DataFrame:
    """Top-1 per scenario; a rejected scenario has no winner."""
    won = F.col("statut") == STATUS_SCORED if "statut" in ranked.columns else F.lit(True)
    return ranked.where(F.col("rang") == 1).select(
        id_col, *_status_of(ranked), F.when(won, F.col("candidat")).alias("gagnant_predit"),
        F.when(won, F.col("famille_politique")).alias("famille_politique_gagnant"),
        F.col("voix_predites_estimees").alias("voix_estimees"))
