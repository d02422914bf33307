"""The salary questions: grouped profiles, rankings, trends and correlations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions.columns import lookup, percent, require
from paylens.functions.special import student_p
from paylens.operators.profiling import numeric_columns
from paylens.operators.ranking import average_ranks, grouped_quantiles
from paylens.schemas import EDUCATION_LEVEL, MEDIAN_SALARY_K


def median_by(df: DataFrame, by: Sequence[str], value: str = "salary_k", name: str = "median_salary") -> DataFrame:
    """Exact median and row count per group."""
    require(df, *by, value)
    return grouped_quantiles(df, value, {name: 0.5}, by, {"count": F.sum("n")})


def salary_profile(df: DataFrame, by: Sequence[str], value: str = "salary_k") -> DataFrame:
    """Count, lowest, median, highest and their difference per group."""
    require(df, *by, value)
    profile = grouped_quantiles(df, value, {"median_salary": 0.5}, by, {
        "count": F.sum("n"), "lowest_salary": F.min(value), "highest_salary": F.max(value),
    })
    return profile.select(
        *by, "count", "lowest_salary", "median_salary", "highest_salary",
        (F.col("highest_salary") - F.col("lowest_salary")).alias("salary_delta"),
    )


def roles_in_industry(df: DataFrame, industry: str = "WEB") -> DataFrame:
    """Median and count per role of one industry, best paid first."""
    require(df, "industry", "job_role")
    return median_by(df.where(F.col("industry") == industry), ["job_role"]).orderBy(
        F.desc("median_salary"), "job_role"
    )


def top_role_in_industry(df: DataFrame, industry: str = "WEB", k: int = 1) -> DataFrame:
    return roles_in_industry(df, industry).limit(k)


def top_industry_roles(df: DataFrame, k: int = 10) -> DataFrame:
    """The k best paid (industry, role) pairs, labelled ``industry - role``."""
    pairs = median_by(df, ["industry", "job_role"]).orderBy(
        F.desc("median_salary"), "industry", "job_role"
    ).limit(k)
    return pairs.select(F.concat_ws(" - ", "industry", "job_role").alias("role_label"), "median_salary", "count")


def industry_profile(df: DataFrame) -> DataFrame:
    return salary_profile(df, ["industry"]).orderBy(F.desc("median_salary"), "industry")


def role_profile(df: DataFrame) -> DataFrame:
    return salary_profile(df, ["job_role"]).drop("salary_delta").orderBy("median_salary", "job_role")


def lowest_paid(df: DataFrame, by: str, k: int = 1) -> DataFrame:
    """Profile of the k groups with the lowest median."""
    return salary_profile(df, [by]).drop("salary_delta").orderBy("median_salary", by).limit(k)


def below_median(df: DataFrame, by: str, threshold: float = MEDIAN_SALARY_K, value: str = "salary_k") -> DataFrame:
    """Rows per group, rows below the threshold and their share, worst group first."""
    require(df, by, value)
    return (
        df.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.count(F.when(F.col(value) < threshold, 1)).alias("below"),
        )
        .withColumn("pct_below_median", percent(F.col("below"), F.col("count")))
        .orderBy(F.desc("pct_below_median"), by)
    )


def median_trend(df: DataFrame, by: str, value: str = "salary_k") -> DataFrame:
    """Line through the medians of each value of ``by``."""
    medians = median_by(df, [by], value).where(F.col(by).isNotNull())
    return medians.agg(
        F.regr_slope("median_salary", by).alias("slope"),
        F.regr_intercept("median_salary", by).alias("intercept"),
    )


def pair_correlation(a: Column, b: Column) -> Column:
    """Pearson correlation of the complete pairs; null where either side does not vary.

    ``corr`` itself fails on a constant column in ANSI mode.
    """
    both = a.isNotNull() & b.isNotNull()
    spread = F.stddev_pop(F.when(both, a)) * F.stddev_pop(F.when(both, b))
    return F.when(spread > 0, F.covar_pop(a, b) / spread)


def pearson(df: DataFrame, x: str = "years_experience", y: str = "salary_k") -> DataFrame:
    """Correlation with its t statistic, as one aggregate."""
    require(df, x, y)
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    r, n = F.col("pearson_r"), F.col("n")
    return pairs.agg(
        F.count(F.lit(1)).alias("n"),
        pair_correlation(F.col(x).cast("double"), F.col(y).cast("double")).alias("pearson_r"),
    ).withColumn(
        "t_stat", F.when((n > 2) & (F.abs(r) < 1), r * F.sqrt((n - 2) / (1 - r * r)))
    )


def pearson_test(
    df: DataFrame, x: str = "years_experience", y: str = "salary_k", level: float = 0.05
) -> DataFrame:
    """``pearson`` with its two-sided p-value, that of Student's t with n - 2 degrees of freedom; 0 for a perfect line."""
    r, n = F.col("pearson_r"), F.col("n")
    p = F.when((n > 2) & (F.abs(r) >= 1), F.lit(0.0)).otherwise(student_p("t_stat", "df"))
    tested = pearson(df, x, y).withColumn("df", (n - 2).cast("double")).withColumn("p_value", p)
    return tested.withColumn("significant", F.col("p_value") < level).drop("df")


def spearman(
    df: DataFrame, x: str = "education", y: str = "salary_k", order: Mapping[str, int] | None = EDUCATION_LEVEL
) -> DataFrame:
    """Rank correlation with shared ranks for ties; ``order`` encodes a text column first.

    Ranks are taken over distinct values with their counts, and the correlation
    over distinct pairs, so no task ever sorts the whole table. Ranks are
    centred on their known mean before squaring.
    """
    require(df, x, y)
    first = lookup(x, order) if order else F.col(x)
    pairs = (
        df.select(first.alias("x"), F.col(y).alias("y")).dropna()
        .groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = pairs
    for c in ("x", "y"):
        values = pairs.groupBy(c).agg(F.sum("n").alias("n"))
        ranks = average_ranks(values, c, rank=f"rank_{c}")
        centred = F.col(f"rank_{c}") - (F.col("total_n") + 1) / 2.0
        ranked = ranked.join(ranks.select(c, centred.alias(f"d{c}")), c)
    n, dx, dy = F.col("n"), F.col("dx"), F.col("dy")
    spread = F.sqrt(F.sum(n * dx * dx)) * F.sqrt(F.sum(n * dy * dy))
    return ranked.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.when(spread > 0, F.sum(n * dx * dy) / spread).alias("spearman_rho"),
    )


def median_by_education(
    df: DataFrame, levels: Mapping[str, int] = EDUCATION_LEVEL, column: str = "education"
) -> DataFrame:
    """Median per level in the declared order; a level without rows stays, with null."""
    rows = [F.struct(F.lit(v).alias("level"), F.lit(k).alias(column)) for k, v in levels.items()]
    declared = df.sparkSession.range(1).select(F.inline(F.array(*rows)))
    medians = median_by(df.where(F.col(column).isin(*levels)), [column]).drop("count")
    return declared.join(medians, column, "left").select("level", column, "median_salary").orderBy("level")


def ranking(df: DataFrame, by: str) -> DataFrame:
    """Groups by median salary, best paid first."""
    return median_by(df, [by]).orderBy(F.desc("median_salary"), by)


def median_by_value(df: DataFrame, by: str) -> DataFrame:
    """Median salary per value of a numeric column, in the order of that column."""
    return median_by(df, [by]).orderBy(by)


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Every pairwise Pearson correlation as (col_a, col_b, corr), over the rows in which both columns have a value.

    One scan: a row becomes its pairs, which are reduced to their co-moments on the map side, and one aggregate
    serves all pairs. A table without rows has no pairs.
    """
    names = list(columns or numeric_columns(df))
    require(df, *names)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    value = [F.col(c).cast("double") for c in names]
    of_row = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), value[i].alias("x"), value[j].alias("y")) for i, j in pairs])
    moments = df.select(F.inline(of_row)).groupBy("i", "j").agg(pair_correlation(F.col("x"), F.col("y")).alias("corr"))
    both = F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))
    name = F.array(*map(F.lit, names))
    return moments.select("corr", F.explode(F.array_distinct(both)).alias("p")).select(
        name[F.col("p.i")].alias("col_a"), name[F.col("p.j")].alias("col_b"), "corr")
