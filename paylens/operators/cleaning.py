"""Cleaning, merging, de-duplicating and outlier rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.functions.columns import (
    first_digits, present, require, to_double, to_long, tokens_to_null,
)
from paylens.operators.ranking import grouped_quantiles
from paylens.schemas import (
    EMPLOYEE_COLUMNS, FENCE_FACTOR, FENCED_ROLE, INVALID_SALARIES, MAX_DISTANCE, NA_TOKENS,
    OUTLIER_ROLE, SALARY_COLUMNS,
)


def rename_columns(df: DataFrame, mapping: Mapping[str, str] = EMPLOYEE_COLUMNS) -> DataFrame:
    """Rename the columns that are there; others are left alone."""
    return df.withColumnsRenamed({a: b for a, b in mapping.items() if a in df.columns and a != b})


def extract_id_digits(df: DataFrame, columns: Iterable[str] = ("job_id", "company_id")) -> DataFrame:
    return df.withColumns({c: first_digits(c) for c in present(df, columns)})


def coerce_numeric(
    df: DataFrame,
    doubles: Iterable[str] = ("years_experience", "distance_from_cbd"),
    longs: Iterable[str] = ("salary_k",),
) -> DataFrame:
    """Numbers as double or long; what cannot be read becomes null."""
    return df.withColumns({
        **{c: to_double(c) for c in present(df, doubles)},
        **{c: to_long(c) for c in present(df, longs)},
    })


def na_tokens_to_null(
    df: DataFrame,
    columns: Iterable[str] = ("education", "major", "job_role", "industry"),
    tokens: Iterable[str] = NA_TOKENS,
) -> DataFrame:
    return df.withColumns({c: tokens_to_null(c, tokens) for c in present(df, columns)})


def fill_none_label(
    df: DataFrame, columns: Iterable[str] = ("education", "major"), label: str = "NONE"
) -> DataFrame:
    names = present(df, columns)
    return df.fillna(label, subset=names) if names else df


def drop_required_nulls(
    df: DataFrame,
    columns: Iterable[str] = (
        "job_role", "industry", "job_id", "company_id", "years_experience", "distance_from_cbd",
    ),
) -> DataFrame:
    names = present(df, columns)
    return df.dropna(subset=names) if names else df


def type_employees(df: DataFrame) -> DataFrame:
    """Renamed and typed employee rows, tokens nulled, nothing dropped yet."""
    renamed = rename_columns(df, EMPLOYEE_COLUMNS)
    return na_tokens_to_null(coerce_numeric(extract_id_digits(renamed)))


def type_salaries(df: DataFrame) -> DataFrame:
    renamed = rename_columns(df, SALARY_COLUMNS)
    return coerce_numeric(extract_id_digits(renamed, ["job_id"]), doubles=())


def clean_employees(df: DataFrame) -> DataFrame:
    """The employee side up to the merge: one narrow, map-only step."""
    return drop_required_nulls(fill_none_label(type_employees(df)))


def clean_salaries(df: DataFrame) -> DataFrame:
    return drop_required_nulls(type_salaries(df), ["job_id", "salary_k"])


def inner_join_job(employees: DataFrame, salaries: DataFrame, key: str = "job_id") -> DataFrame:
    """All pairs that share the key. No hint: AQE picks the strategy and splits hot keys."""
    require(employees, key)
    require(salaries, key)
    return employees.join(salaries, key)


def anti_join_remainder(df: DataFrame, sample: DataFrame, key: str = "job_id") -> DataFrame:
    """Rows of ``df`` whose id is not in ``sample``."""
    require(df, key)
    require(sample, key)
    return df.join(sample.select(key).distinct(), key, "left_anti")


def drop_duplicates_full(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def drop_duplicates_key(df: DataFrame, key: str = "job_id") -> DataFrame:
    """One row per key: the lowest by all other columns, in their order.

    ``min`` of a struct combines on the map side, so copies of a hot key are
    reduced before they are shuffled. A null orders first.
    """
    require(df, key)
    others = [c for c in df.columns if c != key]
    if len(others) == 1:
        return df.groupBy(key).agg(F.min(others[0]).alias(others[0])).select(*df.columns)
    lowest = df.groupBy(key).agg(F.min(F.struct(*others)).alias("_row"))
    return lowest.select(key, "_row.*").select(*df.columns)


def merge_one_per_key(employees: DataFrame, salaries: DataFrame, key: str = "job_id") -> DataFrame:
    """Inner join keeping the lowest row per key, without ever forming the pairs.

    The lowest (employee, salary) pair of a key is its lowest employee row with
    its lowest salary row, so both sides are reduced first. Each side is
    shuffled once, on the key, and the join reuses that partitioning.
    """
    return inner_join_job(drop_duplicates_key(employees, key), drop_duplicates_key(salaries, key), key)


def sentinel_filters(
    df: DataFrame,
    role: str = OUTLIER_ROLE,
    max_distance: float = MAX_DISTANCE,
    invalid_salaries: Sequence[int] = INVALID_SALARIES,
) -> DataFrame:
    """Drop the outlier role, far distances and impossible salaries; null fails a rule."""
    rules = {
        "job_role": F.col("job_role") != role,
        "distance_from_cbd": F.col("distance_from_cbd") <= max_distance,
        "salary_k": ~F.col("salary_k").isin(*invalid_salaries),
    }
    for name in present(df, rules):
        df = df.where(rules[name])
    return df


def iqr_fence(
    df: DataFrame,
    groups: Sequence[str] = (FENCED_ROLE,),
    group_col: str = "job_role",
    value: str = "salary_k",
    factor: float = FENCE_FACTOR,
    approx: bool = False,
) -> DataFrame:
    """Quartiles and outlier limits of ``value`` for each listed group: at most one row each."""
    require(df, group_col, value)
    quartiles = grouped_quantiles(
        df.where(F.col(group_col).isin(*groups)), value, {"q1": 0.25, "q3": 0.75}, [group_col], approx=approx
    )
    return quartiles.select(
        group_col, "q1", "q3",
        (F.col("q3") - F.col("q1")).alias("iqr"),
        (F.col("q1") - factor * (F.col("q3") - F.col("q1"))).alias("lower_limit"),
        (F.col("q3") + factor * (F.col("q3") - F.col("q1"))).alias("upper_limit"),
    )


def iqr_outlier_filter(
    df: DataFrame,
    groups: Sequence[str] = (FENCED_ROLE,),
    group_col: str = "job_role",
    value: str = "salary_k",
    factor: float = FENCE_FACTOR,
    approx: bool = False,
) -> DataFrame:
    """Keep the listed groups inside their fence and every other row untouched.

    The fence has at most ``len(groups)`` rows whatever the data, hence the
    broadcast; the data itself is not shuffled or split in two for it.
    """
    fence = iqr_fence(df, groups, group_col, value, factor, approx).select(
        F.col(group_col).alias("_group"), "lower_limit", "upper_limit"
    )
    inside = F.col(value).between(F.col("lower_limit"), F.col("upper_limit"))
    return (
        df.join(F.broadcast(fence), F.col(group_col) == F.col("_group"), "left")
        .where(F.col("_group").isNull() | inside)
        .select(*df.columns)
    )


def union_by_name(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Bag union matching columns by name."""
    for other in rest:
        first = first.unionByName(other)
    return first


def merge_unique(employees: DataFrame, salaries: DataFrame) -> DataFrame:
    """Both raw tables cleaned, joined and reduced to one row per job."""
    return merge_one_per_key(clean_employees(employees), clean_salaries(salaries))


def finish_clean(merged: DataFrame, approx: bool = False) -> DataFrame:
    """Outlier rules on the merged table, in the order that defines the result."""
    valid = sentinel_filters(merged)
    if not {"job_role", "salary_k"} <= set(valid.columns):
        return valid
    return iqr_outlier_filter(valid, approx=approx)


def clean_merge(employees: DataFrame, salaries: DataFrame, approx: bool = False) -> DataFrame:
    """Raw employees and salaries to the clean table, as one lazy DataFrame."""
    return finish_clean(merge_unique(employees, salaries), approx)
