"""The tables behind the charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions.columns import require
from paylens.operators.profiling import numeric_columns, value_counts
from paylens.operators.ranking import grouped_quantiles, running_totals, value_counts_by, with_buckets
from paylens.schemas import FENCE_FACTOR

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
MARKS = {"p01": 0.01, "q25": 0.25, "q50": 0.5, "q75": 0.75, "p99": 0.99}


def chart_category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bars of a count plot: categories without nulls, tallest first."""
    return value_counts(df, columns).where(F.col("value").isNotNull())


def chart_whisker_stats(df: DataFrame, column: str = "salary_k") -> DataFrame:
    """Quartiles, and whiskers at 1.5 IQR clipped to the range of the data."""
    require(df, column)
    stats = grouped_quantiles(df, column, QUARTILES, (), {"low": F.min(column), "high": F.max(column)})
    reach = FENCE_FACTOR * (F.col("q3") - F.col("q1"))
    return stats.select(
        F.greatest(F.col("low").cast("double"), F.col("q1") - reach).alias("lower_whisker"),
        "q1", "median", "q3",
        F.least(F.col("high").cast("double"), F.col("q3") + reach).alias("upper_whisker"),
    )


def chart_percentile_marks(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Quartiles and the 1st and 99th percentile of every numeric column."""
    names = list(columns or numeric_columns(df))
    require(df, *names)
    values = df.select(*[F.col(c).cast("double").alias(c) for c in names]).unpivot([], names, "column_name", "value")
    return grouped_quantiles(values, "value", MARKS, ["column_name"])


def chart_grouped_box_stats(df: DataFrame, by: str, value: str = "salary_k") -> DataFrame:
    """Box of ``value`` per group: quartiles, whiskers at the last value inside the fence, outliers."""
    require(df, by, value)
    rows = df.where(F.col(by).isNotNull())
    quartiles = grouped_quantiles(rows, value, QUARTILES, [by])
    reach = FENCE_FACTOR * (F.col("q3") - F.col("q1"))
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    # the fence meets the counted values, one row per (group, value), not the raw rows, and bucket by bucket,
    # so that the values of a hot group are spread over tasks here too
    counted = with_buckets(value_counts_by(rows, value, [by]), value, ["n"], [by])
    fences = quartiles.join(counted.select(by, "_bucket").distinct(), by)
    return counted.join(fences, [by, "_bucket"]).groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(value))).cast("double").alias("lower_whisker"),
        F.max(F.when(inside, F.col(value))).cast("double").alias("upper_whisker"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("n_outliers"),
    )


def chart_bar_values(df: DataFrame, by: str, value: str = "salary_k", estimator: str = "mean") -> DataFrame:
    """Height of one bar per category: the mean, or the median where asked."""
    require(df, by, value)
    rows = df.where(F.col(by).isNotNull())
    if estimator == "median":
        return grouped_quantiles(rows, value, {"bar_value": 0.5}, [by])
    if estimator != "mean":
        raise ValueError(f"unknown estimator: {estimator}")
    return rows.groupBy(by).agg(F.avg(value).alias("bar_value"))


def melt_metrics(df: DataFrame, x: str, metrics: Sequence[str]) -> DataFrame:
    """Wide to long: one row per (x, Metric) with its Value as double."""
    require(df, x, *metrics)
    wide = df.select(x, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot([x], list(metrics), "Metric", "Value")


def confusion_matrix(
    predictions: DataFrame, truth: str = "y_true", predicted: str = "y_pred", labels: Sequence | None = None
) -> DataFrame:
    """Rows per (true label, predicted label).

    With declared ``labels`` every pair of them has a row, zeros kept, and other labels have none;
    without, the pairs that occur have one.
    """
    require(predictions, truth, predicted)
    labelled = predictions.where(F.col(truth).isNotNull() & F.col(predicted).isNotNull())
    counts = labelled.groupBy(F.col(truth).alias("y_true"), F.col(predicted).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n")
    )
    if labels is None:
        return counts
    kind = predictions.schema[truth].dataType
    declared = F.array(*[F.lit(v).cast(kind) for v in labels])
    grid = predictions.sparkSession.range(1).select(F.explode(declared).alias("y_true")).select(
        "y_true", F.explode(declared).alias("y_pred")
    )
    return grid.join(counts, ["y_true", "y_pred"], "left").na.fill(0, ["n"])


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, 0.0).otherwise(top / bottom)


def classification_report(predictions: DataFrame, truth: str = "y_true", predicted: str = "y_pred") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both averages."""
    matrix = confusion_matrix(predictions, truth, predicted)
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)
    # every cell counts once as its true class and once as its predicted class
    cells = matrix.select(F.inline(F.array(
        F.struct(F.col("y_true").cast("string").alias("label"), F.col("n").alias("actual"),
                 F.lit(0).cast("bigint").alias("named"), hit.cast("bigint").alias("hits")),
        F.struct(F.col("y_pred").cast("string").alias("label"), F.lit(0).cast("bigint").alias("actual"),
                 F.col("n").alias("named"), F.lit(0).cast("bigint").alias("hits")),
    )))
    sums = cells.groupBy("label").agg(
        F.sum("actual").alias("support"), F.sum("named").alias("named"), F.sum("hits").alias("hits")
    )
    p, r = _ratio(F.col("hits"), F.col("named")), _ratio(F.col("hits"), F.col("support"))
    classes = sums.select("label", p.alias("precision"), r.alias("recall"),
                          _ratio(2 * p * r, p + r).alias("f1"), "support", "hits")
    scores = ("precision", "recall", "f1")
    total = F.sum("support")
    summary = classes.agg(
        F.struct(F.lit("accuracy").alias("label"), *[_ratio(F.sum("hits"), total).alias(s) for s in scores],
                 total.alias("support")).alias("a"),
        F.struct(F.lit("macro avg").alias("label"), *[F.avg(s).alias(s) for s in scores],
                 total.alias("support")).alias("m"),
        F.struct(F.lit("weighted avg").alias("label"),
                 *[_ratio(F.sum(F.col(s) * F.col("support")), total).alias(s) for s in scores],
                 total.alias("support")).alias("w"),
    ).select(F.inline(F.array("a", "m", "w")))
    return classes.drop("hits").unionByName(summary)


def _curve_counts(scores: DataFrame, truth: str, score: str) -> DataFrame:
    """True and false positives at, and strictly above, every distinct score."""
    counted = scores.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(truth), 1)).alias("pos")
    )
    totals = running_totals(counted, "threshold", ["n", "pos"])
    above_n = F.col("total_n") - F.col("before_n") - F.col("n")
    above_pos = F.col("total_pos") - F.col("before_pos") - F.col("pos")
    return totals.select(
        "threshold",
        above_pos.alias("tp0"), (above_n - above_pos).alias("fp0"),
        (above_pos + F.col("pos")).alias("tp"), (above_n + F.col("n") - above_pos - F.col("pos")).alias("fp"),
        F.col("total_pos").alias("positives"), (F.col("total_n") - F.col("total_pos")).alias("negatives"),
    )


def roc_pr_curves(scores: DataFrame, truth: str = "y_true", score: str = "score") -> DataFrame:
    """One point per distinct score: the rates when everything at or above it is called positive."""
    require(scores, truth, score)
    return _curve_counts(scores, truth, score).select(
        "threshold", "tp", "fp",
        _ratio(F.col("fp"), F.col("negatives")).alias("fpr"),
        _ratio(F.col("tp"), F.col("positives")).alias("tpr"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("positives")).alias("recall"),
    )


def roc_pr_auc(scores: DataFrame, truth: str = "y_true", score: str = "score") -> DataFrame:
    """Areas under both curves by trapezoids, starting at (0, 0) and at (recall 0, precision 1)."""
    require(scores, truth, score)
    fp, tp, fp0, tp0 = (F.col(c).cast("double") for c in ("fp", "tp", "fp0", "tp0"))
    before = F.when(tp0 + fp0 == 0, 1.0).otherwise(tp0 / (tp0 + fp0))
    return _curve_counts(scores, truth, score).agg(
        F.sum((fp - fp0) * (tp + tp0) / 2.0).alias("roc"),
        F.sum((tp - tp0) * (tp / (tp + fp) + before) / 2.0).alias("prc"),
        F.max("positives").alias("p"), F.max("negatives").alias("n"),
    ).select(
        F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("roc") / F.col("p") / F.col("n")).alias("roc_auc"),
        F.when(F.col("p") > 0, F.col("prc") / F.col("p")).alias("prc_auc"),
    )


def residuals(predictions: DataFrame, keep: Sequence[str] = ("job_id",)) -> DataFrame:
    """``y_true - y_pred`` per row."""
    require(predictions, "y_true", "y_pred")
    return predictions.select(
        *[c for c in keep if c in predictions.columns], "y_true", "y_pred",
        (F.col("y_true") - F.col("y_pred")).alias("residual"),
    )


def residual_line(predictions: DataFrame) -> DataFrame:
    """Ends of the diagonal: the smallest and largest value of truth and prediction."""
    require(predictions, "y_true", "y_pred")
    return predictions.agg(
        F.least(F.min("y_true"), F.min("y_pred")).alias("line_min"),
        F.greatest(F.max("y_true"), F.max("y_pred")).alias("line_max"),
    )
