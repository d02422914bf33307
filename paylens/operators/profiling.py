"""Profiles of columns: counts, quantiles, listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.functions.columns import percent, require
from paylens.operators.ranking import quantile_at, running_totals, value_counts_by
from paylens.schemas import INVALID_SALARIES, MAX_DISTANCE

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _long_form(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """(column_name, value) rows of the given columns, cast to one type."""
    return df.select(*[F.col(c).cast(kind).alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )


def preview_rows(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """First rows in a total order, so the preview is the same every time."""
    order = list(order_by or []) + [c for c in df.columns if c not in (order_by or [])]
    return df.orderBy(*order).limit(n)


def schema_info(df: DataFrame) -> DataFrame:
    """Column, type and non-null count."""
    rows = [
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("column_name"), F.lit(kind).alias("data_type"),
            F.col(f"c{i}").alias("n_non_null"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    counts = [F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    names = list(columns or numeric_columns(df))
    require(df, *names)
    n, v = F.col("n"), F.col("value")
    # everything comes from the counted values, so the table is scanned once;
    # the group's mean is known on every row, which keeps the deviation exact
    counted = value_counts_by(_long_form(df, names, "double"), "value", ["column_name"])
    ranked = running_totals(counted.withColumn("s", n * v), "value", ["n", "s"], ["column_name"])
    mean = F.col("total_s") / F.col("total_n")
    rows = F.sum(n)
    return ranked.groupBy("column_name").agg(
        rows.alias("n_rows"),
        F.max(mean).alias("mean_value"),
        F.when(rows > 1, F.sqrt(F.sum(n * (v - mean) * (v - mean)) / (rows - 1))).alias("std_value"),
        F.min(v).alias("min_value"),
        *[quantile_at("value", p).alias(name) for name, p in QUARTILES.items()],
        F.max(v).alias("max_value"),
    )


def describe_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct values, the most frequent value and its count per column.

    Among equally frequent values the alphabetically first is shown.
    """
    names = list(columns or text_columns(df))
    require(df, *names)
    counted = value_counts_by(_long_form(df, names, "string"), "value", ["column_name"])
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("value")))
    return counted.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_unique"), best.alias("best")
    ).select("column_name", "n_rows", "n_unique", F.col("best.value").alias("top"),
             (-F.col("best.minus_n")).alias("freq"))


def describe_all(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Numeric and text columns described in one table; what does not apply is null."""
    names = list(columns or df.columns)
    numbers = [c for c in numeric_columns(df) if c in names]
    texts = [c for c in text_columns(df) if c in names]
    if not texts:
        return describe_numeric(df, numbers)
    if not numbers:
        return describe_text(df, texts)
    return describe_numeric(df, numbers).unionByName(describe_text(df, texts), allowMissingColumns=True)


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing values: count and percentage, most missing first."""
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"c{i}").alias("missing_count"),
            percent(F.col(f"c{i}"), F.col("total")).alias("missing_pct"),
        )
        for i, c in enumerate(df.columns)
    ]
    counts = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    return (
        df.agg(F.count(F.lit(1)).alias("total"), *counts)
        .where(F.col("total") > 0)
        .select(F.inline(F.array(*rows)))
        .where(F.col("missing_count") > 0)
        .orderBy(F.desc("missing_count"), "column_name")
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value, nulls as a value of their own, most frequent first."""
    require(df, *columns)
    return (
        _long_form(df, columns, "string").groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("column_name", F.desc("n"), F.asc_nulls_last("value"))
    )


def nunique_with_null(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct values per column, null counted as one; ``approx`` uses a sketch."""
    require(df, *columns)
    if approx:
        rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_unique")) for c in columns]
        return df.agg(*[
            (F.approx_count_distinct(c) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))).alias(c)
            for c in columns
        ]).select(F.inline(F.array(*rows)))
    return (
        _long_form(df, columns, "string").distinct()
        .groupBy("column_name").agg(F.count(F.lit(1)).alias("n_unique"))
    )


def predicate_count(
    df: DataFrame, column: str = "education", values: Sequence[str] = ("HIGH_SCHOOL", "NONE")
) -> DataFrame:
    require(df, column)
    return df.agg(F.count(F.when(F.col(column).isin(*values), 1)).alias("n"))


def outlier_listing(
    df: DataFrame, max_distance: float = MAX_DISTANCE, salary: int = INVALID_SALARIES[0]
) -> DataFrame:
    """Rows too far from the centre or with an impossible salary, and why."""
    require(df, "distance_from_cbd", "salary_k")
    far, unpaid = F.col("distance_from_cbd") > max_distance, F.col("salary_k") == salary
    return df.where(far | unpaid).withColumn("reason", F.when(far, "distance").otherwise("salary"))


def top_k_salary(df: DataFrame, k: int = 25, value: str = "salary_k", key: str = "job_id") -> DataFrame:
    """The k largest, ties by key; each task keeps only its own k candidates."""
    require(df, value, key)
    return df.orderBy(F.desc(value), *_tie_break(df, value, key)).limit(k)


def bottom_k_salary(df: DataFrame, k: int = 25, value: str = "salary_k", key: str = "job_id") -> DataFrame:
    require(df, value, key)
    return df.orderBy(F.asc_nulls_last(value), *_tie_break(df, value, key)).limit(k)


def _tie_break(df: DataFrame, value: str, key: str) -> list[str]:
    return [key] + [c for c in df.columns if c not in (value, key)]


def skewness(df: DataFrame, value: str = "salary_k") -> DataFrame:
    """Bias-adjusted sample skewness."""
    require(df, value)
    n = F.count(value).cast("double")
    adjusted = F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2)
    return df.agg(F.count(value).alias("n"), F.when(n > 2, adjusted).alias("skewness"))

