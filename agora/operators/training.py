"""Fitting the model that scores scenarios (M3).

The pipeline indexes and one-hot encodes the candidate, assembles the
communes' numbers beside it and fits a linear regression of the observed
votes, in distributed passes over the training rows, computed once.  A fitted pipeline
is saved as a folder and loaded again to score in batch; nothing but the
fitted weights ever comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.operators.keys import freeze
from agora.operators.scoring import CATEGORY, SCENARIO_FEATURES, STATUS_SCORED

LABEL = "nb_voix"


def training_rows(scenarios: DataFrame, results: DataFrame, candidates: DataFrame, name: str = "nom",
                  id_col: str = "id_commune") -> DataFrame:
    """One row per known vote count: the commune's numbers, the candidate's
    name and the votes.  Communes that lack one of the numbers, and results
    without votes, teach nothing.  ``scenarios`` has a ``statut``."""
    votes = results.where(F.col(LABEL).isNotNull()).select("fk_commune", "fk_candidat", F.col(LABEL).cast("double").alias(LABEL))
    names = candidates.select(F.col("id_candidat").alias("fk_candidat"), F.col(name).alias(CATEGORY))
    return scenarios.where(F.col("statut") == STATUS_SCORED) \
        .join(votes, F.col(id_col) == F.col("fk_commune")).join(names, "fk_candidat")


def fit_model(rows: DataFrame, numbers: Sequence[str] = tuple(SCENARIO_FEATURES), label: str = LABEL) -> PipelineModel:
    """Least squares of ``label`` on the numbers and the candidate.  Several
    stages and passes read the rows, so they are stored first; an open
    ``scratch`` removes them."""
    rows = freeze(rows.select(CATEGORY, *numbers, label), "training-rows")
    return Pipeline(stages=[
        StringIndexer(inputCol=CATEGORY, outputCol="candidate_index", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="candidate_index", outputCol="candidate_columns"),
        VectorAssembler(inputCols=[*numbers, "candidate_columns"], outputCol="features"),
        LinearRegression(labelCol=label, featuresCol="features", solver="normal")]).fit(rows)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def known_candidates(model: PipelineModel) -> list[str]:
    """The candidates that the model has seen, by name."""
    return list(model.stages[0].labels)
