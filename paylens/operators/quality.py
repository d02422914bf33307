"""Audits. Each reports on a table without changing it, in as few passes as it can."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions.columns import present, require
from paylens.operators.cleaning import type_employees, type_salaries
from paylens.schemas import AUDITED_FEATURES


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def id_format_check(df: DataFrame, column: str = "jobId", pattern: str = "^JOB[0-9]+$") -> DataFrame:
    """Ids that are there but do not match the pattern, and whether all match."""
    require(df, column)
    bad = _count_if(~F.col(column).rlike(pattern))
    return df.agg(
        _count_if(F.col(column).isNotNull()).alias("n_ids"),
        bad.alias("n_invalid"),
        (bad == 0).alias("all_match"),
    )


def _drop_steps(df: DataFrame, steps: dict[str, Sequence[str]]) -> DataFrame:
    """Rows before and after each step of null drops, all from one aggregate."""
    kept = F.lit(True)
    counts, names = [F.count(F.lit(1)).alias("c0")], list(steps)
    for i, name in enumerate(names, 1):
        for c in present(df, steps[name]):
            kept = kept & F.col(c).isNotNull()
        counts.append(_count_if(kept).alias(f"c{i}"))
    rows = [
        F.struct(
            F.lit(name).alias("step"),
            F.col(f"c{i - 1}").alias("rows_before"),
            F.col(f"c{i}").alias("rows_after"),
            (F.col(f"c{i - 1}") - F.col(f"c{i}")).alias("rows_dropped"),
        )
        for i, name in enumerate(names, 1)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def drop_step_report(employees: DataFrame, salaries: DataFrame) -> DataFrame:
    """What each null-dropping step removes from the two raw tables."""
    employee_steps = _drop_steps(type_employees(employees), {
        "employee_categories": ["job_role", "industry"],
        "employee_numbers": ["job_id", "company_id", "years_experience", "distance_from_cbd"],
    })
    return employee_steps.unionByName(
        _drop_steps(type_salaries(salaries), {"salary": ["job_id", "salary_k"]})
    )


def null_audit(df: DataFrame, columns: Sequence[str] = AUDITED_FEATURES) -> DataFrame:
    """Nulls per column with their total, in one pass."""
    names = present(df, columns)
    total = sum((F.col(c) for c in names), F.lit(0))
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null"), total.alias("total_null"))
        for c in names
    ]
    return df.agg(*[_count_if(F.col(c).isNull()).alias(c) for c in names]).select(F.inline(F.array(*rows)))


def _keys(df: DataFrame, key: str, suffix: str) -> DataFrame:
    """One row per key: its rows and its distinct rows, combined before each shuffle."""
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return rows.groupBy(key).agg(F.sum("_n").alias(f"n_{suffix}"), F.count(F.lit(1)).alias(f"d_{suffix}"))


def merge_audit(employees: DataFrame, salaries: DataFrame, key: str = "job_id") -> DataFrame:
    """Rows on each side, after the inner join, and lost from each side.

    The size of the join is the sum over keys of the product of the two counts,
    so the joined rows themselves are never built.
    """
    e = employees.groupBy(key).agg(F.count(F.lit(1)).alias("n_e"))
    s = salaries.groupBy(key).agg(F.count(F.lit(1)).alias("n_s"))
    both = e.join(s, key, "full_outer")
    n_e, n_s = F.coalesce("n_e", F.lit(0)), F.coalesce("n_s", F.lit(0))
    return both.agg(
        F.coalesce(F.sum(n_e), F.lit(0)).alias("employee_rows"),
        F.coalesce(F.sum(n_s), F.lit(0)).alias("salary_rows"),
        F.coalesce(F.sum(n_e * n_s), F.lit(0)).alias("merged_rows"),
    ).select(
        "*",
        (F.col("employee_rows") - F.col("merged_rows")).alias("employee_rows_lost"),
        (F.col("salary_rows") - F.col("merged_rows")).alias("salary_rows_lost"),
    )


def key_coverage(employees: DataFrame, salaries: DataFrame, key: str = "job_id") -> DataFrame:
    """Distinct keys per side, keys only one side has, and the two subset flags."""
    e = employees.select(key).distinct().withColumn("in_e", F.lit(True))
    s = salaries.select(key).distinct().withColumn("in_s", F.lit(True))
    only_e, only_s = _count_if(F.col("in_s").isNull()), _count_if(F.col("in_e").isNull())
    return e.join(s, key, "full_outer").agg(
        F.count("in_e").alias("employee_keys"),
        F.count("in_s").alias("salary_keys"),
        only_e.alias("only_in_employee"),
        only_s.alias("only_in_salary"),
        (only_e == 0).alias("employee_subset_of_salary"),
        (only_s == 0).alias("salary_subset_of_employee"),
    )


def duplicate_counts(df: DataFrame, key: str = "job_id") -> DataFrame:
    """Rows that repeat an earlier full row, and rows that repeat an earlier key."""
    require(df, key)
    return _keys(df, key, "rows").agg(
        (F.coalesce(F.sum("n_rows"), F.lit(0)) - F.coalesce(F.sum("d_rows"), F.lit(0))).alias("full_duplicates"),
        (F.coalesce(F.sum("n_rows"), F.lit(0)) - F.count(F.lit(1))).alias("key_duplicates"),
    )


def merged_duplicate_counts(employees: DataFrame, salaries: DataFrame, key: str = "job_id") -> DataFrame:
    """``duplicate_counts`` of the inner join, from per-key counts instead of the pairs."""
    both = _keys(employees, key, "e").join(_keys(salaries, key, "s"), key)
    rows = F.coalesce(F.sum(F.col("n_e") * F.col("n_s")), F.lit(0))
    distinct_rows = F.coalesce(F.sum(F.col("d_e") * F.col("d_s")), F.lit(0))
    return both.agg(
        (rows - distinct_rows).alias("full_duplicates"),
        (rows - F.count(F.lit(1))).alias("key_duplicates"),
    )


def merged_duplicate_listing(employees: DataFrame, salaries: DataFrame, key: str = "job_id") -> DataFrame:
    """``duplicate_listing`` of the inner join. Repeated keys come from per-key counts of each
    side, and only their pairs are formed, once: they are the result."""
    counts = lambda df, n: df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(n))
    repeated = counts(employees, "_e").join(counts(salaries, "_s"), key).where(F.col("_e") * F.col("_s") > 1).select(key)
    e, s = (df.join(repeated, key, "left_semi") for df in (employees, salaries))
    both = e.join(s, key).select(*employees.columns, *[c for c in salaries.columns if c != key])
    return both.orderBy(key, *[c for c in both.columns if c != key], F.rand(0))


def duplicate_listing(df: DataFrame, key: str = "job_id") -> DataFrame:
    """All rows whose key occurs more than once, sorted.

    Repeated keys are found by a combining count and joined back, so a hot key
    is never gathered in one window; the random last sort column lets the range
    partitioning of the sort split copies that are equal in every column.
    """
    require(df, key)
    repeated = df.groupBy(key).count().where(F.col("count") > 1).select(key)
    others = [c for c in df.columns if c != key]
    return df.join(repeated, key, "left_semi").select(*df.columns).orderBy(key, *others, F.rand(0))


def active_category_domain(
    df: DataFrame, columns: Sequence[str] = ("job_role", "industry")
) -> DataFrame:
    """The levels that still occur; a level whose rows were dropped is gone."""
    names = present(df, columns)
    return df.select(*names).unpivot([], names, "column_name", "level").where(
        F.col("level").isNotNull()
    ).distinct()


def table_shape(**tables: DataFrame) -> DataFrame:
    """Rows and columns of each named table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in tables.items()
    ]
    shapes = parts[0]
    for part in parts[1:]:
        shapes = shapes.unionByName(part)
    return shapes


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows per split."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n"))
