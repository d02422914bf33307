"""Metrics over prediction tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.functions.columns import require


def regression_metrics(predictions: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """R2, MAE and RMSE per group, all from one aggregate.

    The spread of the truth is ``n * var_pop``, which does not cancel the way
    the difference of two large sums would. A constant truth has no R2.
    """
    require(predictions, *by, "y_true", "y_pred")
    y = F.col("y_true").cast("double")
    error = y - F.col("y_pred")
    spread = F.var_pop(y) * F.count(y)
    return predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.when(spread > 0, 1 - F.sum(error * error) / spread).alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )


def model_comparison(predictions: Mapping[str, DataFrame], places: int = 4) -> DataFrame:
    """Metrics of several models side by side: one row per (model, split)."""
    tables = [
        df.select(F.lit(name).alias("model"), "split", "y_true", "y_pred") for name, df in predictions.items()
    ]
    everything = tables[0]
    for t in tables[1:]:
        everything = everything.unionByName(t)
    scored = regression_metrics(everything, ("model", "split"))
    return scored.select("model", "split", *[F.round(m, places).alias(m) for m in ("rmse", "mae", "r2")])


def line_predictions(
    rows: DataFrame, x: str = "years_experience", target: str = "salary_k", id_col: str = "job_id"
) -> DataFrame:
    """Predictions of the straight line through the training rows, for all other rows.

    The least-squares line in closed form: one aggregate, used as a scalar subquery.
    """
    require(rows, id_col, "split", x, target)
    line = rows.where(F.col("split") == "train").agg(F.struct(
        F.regr_slope(target, x).alias("slope"), F.regr_intercept(target, x).alias("intercept")
    ))
    return rows.where(F.col("split") != "train").withColumn("_l", line.scalar()).select(
        id_col,
        F.col(target).cast("double").alias("y_true"),
        (F.col("_l.intercept") + F.col("_l.slope") * F.col(x)).alias("y_pred"),
        "split",
    )
