"""Linear regressors as MLlib pipelines, and forests."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.functions.columns import require
from paylens.models import forest, onehot_line
from paylens.models.evaluation import regression_metrics
from paylens.operators.features import numeric_feature_columns
from paylens.operators.splits import split_64_16_20, split_70_15_15
from paylens.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from paylens.session import stage_table


@dataclass
class Fitted:
    """A fitted pipeline with its predictions outside the training rows."""

    model: PipelineModel
    predictions: DataFrame
    feature_names: list[str]

    def metrics(self) -> DataFrame:
        return regression_metrics(self.predictions)

    def weights(self, top_n: int | None = None) -> DataFrame:
        """Named coefficients and the intercept, largest magnitude first."""
        last = self.model.stages[-1]
        rows = [(n, float(v)) for n, v in zip(self.feature_names, last.coefficients.toArray())] + [("intercept", float(last.intercept))]
        spark = self.predictions.sparkSession
        table = spark.createDataFrame(rows, "feature string, weight double")
        ordered = table.orderBy(F.desc(F.abs("weight")), "feature")
        return ordered.limit(top_n) if top_n else ordered


@dataclass
class FittedTable:
    """A model that is kept as tables, with its predictions outside the training rows."""

    model: forest.Forest | onehot_line.OneHotLine
    predictions: DataFrame

    def metrics(self) -> DataFrame:
        return regression_metrics(self.predictions)

    def weights(self, top_n: int | None = None) -> DataFrame:
        """Importances of a forest or coefficients of a line, largest magnitude first."""
        ordered = self.model.weights().orderBy(F.desc(F.abs("weight")), "feature")
        return ordered.limit(top_n) if top_n else ordered


def predict(model: PipelineModel, df: DataFrame, target: str = "salary_k", id_col: str = "job_id") -> DataFrame:
    """Prediction table: id, truth, prediction and split."""
    scored = model.transform(df)
    return scored.select(
        id_col, F.col(target).cast("double").alias("y_true"), F.col("prediction").alias("y_pred"), "split"
    )


def _fit(stages: list, split_rows: DataFrame, names: list[str], target: str, id_col: str, fit_on: str) -> Fitted:
    """Fit on the training rows, or the preparing stages on all rows (``fit_on="all"``)."""
    if fit_on not in ("train", "all"):
        raise ValueError(f"fit_on must be 'train' or 'all', not {fit_on!r}")
    train = split_rows.where(F.col("split") == "train")
    if fit_on == "all":
        prepared = Pipeline(stages=stages[:-1]).fit(split_rows)
        model = PipelineModel(stages=[*prepared.stages, stages[-1].fit(prepared.transform(train))])
    else:
        model = Pipeline(stages=stages).fit(train)
    return Fitted(model, predict(model, split_rows.where(F.col("split") != "train"), target, id_col), names)


def _rows(features: DataFrame, target: str, id_col: str, inputs: Sequence[str]) -> DataFrame:
    """The needed columns of rows with a target and complete features."""
    require(features, id_col, target, *inputs)
    return features.select(id_col, target, *inputs).dropna()


def linear_regression(
    features: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES, target: str = "salary_k",
    id_col: str = "job_id", seed: int = 42, fit_on: str = "train",
) -> Fitted:
    """Standardised features, ordinary least squares, 70/15/15 split."""
    rows = split_70_15_15(_rows(features, target, id_col, columns), id_col, seed)
    return _fit([
        VectorAssembler(inputCols=list(columns), outputCol="features_unscaled"),
        StandardScaler(inputCol="features_unscaled", outputCol="features", withMean=True, withStd=True),
        LinearRegression(featuresCol="features", labelCol=target, solver="normal"),
    ], rows, list(columns), target, id_col, fit_on)


def _fit_forest(split_rows: DataFrame, numeric: Sequence[str], text: Sequence[str], target: str, id_col: str, **settings) -> FittedTable:
    grown = forest.fit(split_rows.where(F.col("split") == "train"), numeric, text, target, id_col, **settings)
    held_out = split_rows.where(F.col("split") != "train").withColumn("y_true", F.col(target).cast("double"))
    predictions = stage_table(grown.predict(held_out, [id_col, "y_true", "split"]), "predictions")
    return FittedTable(grown, predictions.select(id_col, "y_true", "y_pred", "split"))


def random_forest(
    features: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES, target: str = "salary_k", id_col: str = "job_id",
    seed: int = 42, num_trees: int = 100, max_depth: int | None = 10, local_rows: int = forest.LOCAL_ROWS,
) -> FittedTable:
    """Forest of 100 trees of depth 10, 70/15/15 split; each node draws a third of the columns."""
    rows = split_70_15_15(_rows(features, target, id_col, columns), id_col, seed)
    return _fit_forest(rows, columns, [], target, id_col, num_trees=num_trees, max_depth=max_depth,
                       per_node=math.ceil(len(columns) / 3), seed=seed, local_rows=local_rows)


def linear_regression_onehot(
    features: DataFrame, cat_cols: Sequence[str] = CATEGORICAL_FEATURES, target: str = "salary_k",
    id_col: str = "job_id", seed: int = 42, fit_on: str = "train",
) -> FittedTable:
    """Least squares on numeric and one-hot columns; predictions for both held-out splits.

    All levels are kept, so the coefficients are not unique: compare predictions and metrics only. ``fit_on="all"`` also lists
    the levels that training rows do not have, with a weight of 0, which is how they count anyway.
    """
    numbers = numeric_feature_columns(features, id_col, target, cat_cols)
    rows = split_64_16_20(_rows(features, target, id_col, [*numbers, *cat_cols]), id_col=id_col, seed=seed)
    if fit_on not in ("train", "all"):
        raise ValueError(f"fit_on must be 'train' or 'all', not {fit_on!r}")
    line = onehot_line.fit(rows.where(F.col("split") == "train"), numbers, cat_cols, target)
    if fit_on == "all":
        line = line.with_levels_of(rows)
    held_out = rows.where(F.col("split") != "train").withColumn("y_true", F.col(target).cast("double"))
    predictions = line.predict(held_out, [id_col, "y_true", "split"])
    return FittedTable(line, predictions.select(id_col, "y_true", "y_pred", "split"))


def random_forest_onehot(
    features: DataFrame, cat_cols: Sequence[str] = CATEGORICAL_FEATURES, target: str = "salary_k", id_col: str = "job_id",
    seed: int = 42, num_trees: int = 100, max_depth: int | None = None, local_rows: int = forest.LOCAL_ROWS,
) -> FittedTable:
    """Forest on numeric and text columns, without a limit of depth and with all columns at every node.

    A text column is split into two sets of its levels; a set of one level is what a one-hot slot would give.
    """
    numbers = numeric_feature_columns(features, id_col, target, cat_cols)
    rows = split_64_16_20(_rows(features, target, id_col, [*numbers, *cat_cols]), id_col=id_col, seed=seed)
    return _fit_forest(rows, numbers, cat_cols, target, id_col, num_trees=num_trees, max_depth=max_depth, seed=seed, local_rows=local_rows)


def vector_columns(df: DataFrame, vector: str, names: Sequence[str], keep: Sequence[str] = ("job_id",)) -> DataFrame:
    """The slots of a vector column as named double columns."""
    slots = vector_to_array(vector)
    return df.select(*keep, *[slots[i].alias(n) for i, n in enumerate(names)])
