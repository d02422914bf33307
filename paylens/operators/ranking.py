"""Exact ranks and quantiles without sending a group to one task.

A table is first reduced to one row per (group, value) with a count, which
combines on the map side and spreads a hot group over its values. Positions are
then prefix sums: inside buckets of values, whose number grows with the rows,
and over the bucket totals in levels of constant fan-in. No task grows with the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of a bucket of values, on average; bucket totals that are added up in one piece.
BUCKET_ROWS = 16_384
FAN_IN = 4096
#: Levels of bucket totals: enough for 16,384 * 4096**3 rows.
LEVELS = 2


def _bucket_edges(df: DataFrame, value: str, by: Sequence[str], sums: Sequence[str], bucket_rows: int) -> Column:
    """Sorted edges as a scalar subquery: the values of the rows whose hash is a multiple of ``bucket_rows``.

    Rows chosen by hash are the same in every execution, so all branches of a
    plan agree on the edges, and they follow the distribution and the number of
    the rows: a group with many values gets many edges, a small table none.
    The edges only decide where the buckets lie; no row is left out by them.
    """
    # reading a sum keeps this branch's aggregate equal to the main one, so
    # Spark computes that shuffle once
    rows = df.where(F.col(sums[0]) >= 0).select(*by, value)
    chosen = rows.where(F.pmod(F.xxhash64(*by, value), F.lit(bucket_rows)) == 0)
    return chosen.agg(F.sort_array(F.collect_set(value))).scalar()


def _bucket(value: str, edges: str) -> Column:
    """Number of edges at or below the value, by binary search."""
    steps = F.array(*[F.lit(2**k) for k in reversed(range(30))])
    at_or_below = lambda at, s: F.get(F.col(edges), at + s - 1) <= F.col(value)
    # short arrays end the search's first steps at once: there is no edge that far
    found = F.aggregate(
        F.filter(steps, lambda s: s <= F.size(edges)), F.lit(0), lambda at, s: F.when(at_or_below(at, s), at + s).otherwise(at))
    # never null by construction; saying so keeps the optimizer from testing it on the raw rows
    return F.coalesce(found, F.lit(0))


def with_buckets(df: DataFrame, value: str, sums: Sequence[str], by: Sequence[str] = (), bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``df`` with ``_bucket``: the place of the value among the edges."""
    placed = df.withColumn("_edges", _bucket_edges(df, value, by, sums, bucket_rows))
    return placed.withColumn("_bucket", _bucket(value, "_edges")).drop("_edges")


def _before(df: DataFrame, sums: Sequence[str], within: Sequence[str], order: str, prefix: str) -> DataFrame:
    """Sums over the earlier rows of the same part."""
    part = W.partitionBy(*within) if within else W.partitionBy(F.lit(0))
    earlier = part.orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return df.select("*", *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{prefix}{s}") for s in sums])


def running_totals(
    df: DataFrame, value: str, sums: Sequence[str], by: Sequence[str] = (), bucket_rows: int = BUCKET_ROWS, fan_in: int = FAN_IN
) -> DataFrame:
    """Add ``before_<s>`` and ``total_<s>`` for each column in ``sums``.

    ``df`` holds one row per (``by``, ``value``). ``before_<s>`` adds up ``s``
    over the rows of the same group with a smaller value, ``total_<s>`` over the
    whole group. ``value`` may have any orderable type. Nulls in the value or in
    a group column must be gone.
    """
    by = list(by)
    bucketed = with_buckets(df, value, sums, by, bucket_rows)
    detail = _before(bucketed, sums, [*by, "_bucket"], value, "_in_")

    # totals of buckets, of runs of ``fan_in`` buckets, of runs of those: what lies before each in the next larger run
    names = [f"_run{k}" for k in range(LEVELS + 1)]
    runs = bucketed.groupBy(*by, "_bucket").agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums]).withColumn("_run0", F.col("_bucket"))
    runs = runs.withColumns({n: F.floor(F.col("_bucket") / fan_in**k).cast("int") for k, n in enumerate(names[1:], 1)})
    totals = [f"_sum_{s}" for s in sums]
    offsets = None
    for k in reversed(range(LEVELS + 1)):
        level = runs.groupBy(*by, *names[k:]).agg(*[F.sum(t).alias(t) for t in totals]) if k else runs
        level = _before(level, totals, [*by, *names[k + 1:]], names[k], "_before")
        if offsets is None:
            group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
            level = level.select("*", *[F.sum(t).over(group).alias(f"total_{s}") for s, t in zip(sums, totals)])
            offsets = level.select(*by, *names[k:], *[F.col(f"_before{t}").alias(f"_off_{s}") for s, t in zip(sums, totals)],
                                   *[f"total_{s}" for s in sums])
        else:
            above = offsets.select(*by, *names[k + 1:], *[F.col(f"_off_{s}").alias(f"_up_{s}") for s in sums], *[f"total_{s}" for s in sums])
            offsets = level.join(above, [*by, *names[k + 1:]]).select(
                *by, *names[k:], *[(F.col(f"_before{t}") + F.col(f"_up_{s}")).alias(f"_off_{s}") for s, t in zip(sums, totals)],
                *[f"total_{s}" for s in sums])
    offsets = offsets.select(*by, F.col("_run0").alias("_bucket"), *[f"_off_{s}" for s in sums], *[f"total_{s}" for s in sums])

    return detail.join(offsets, [*by, "_bucket"]).select(
        *df.columns,
        *[(F.col(f"_in_{s}") + F.col(f"_off_{s}")).alias(f"before_{s}") for s in sums],
        *[f"total_{s}" for s in sums],
    )


def value_counts_by(df: DataFrame, value: str, by: Sequence[str] = (), count: str = "n") -> DataFrame:
    """One row per (group, value) with its number of rows; nulls in either are left out."""
    return _complete(df, *by, value).groupBy(*by, value).agg(F.count(F.lit(1)).alias(count))


def _complete(df: DataFrame, *columns: str) -> DataFrame:
    """Rows without nulls in the columns.

    One plain test per column: it is what the optimizer would add for a later
    join, so every branch of a plan keeps the same filter and shares one shuffle.
    """
    for c in columns:
        df = df.where(F.col(c).isNotNull())
    return df


def quantile_at(value: str, p: float) -> Column:
    """Aggregate over running totals: linear interpolation around position ``p * (n - 1)``."""
    position = (F.max("total_n") - 1) * F.lit(float(p))

    def at(place):
        row = place((F.col("total_n") - 1) * F.lit(float(p)))
        here = (F.col("before_n") <= row) & (row < F.col("before_n") + F.col("n"))
        return F.max(F.when(here, F.col(value))).cast("double")

    low, high = at(F.floor), at(F.ceil)
    return low + (high - low) * (position - F.floor(position))


def grouped_quantiles(
    df: DataFrame,
    value: str,
    quantiles: Mapping[str, float],
    by: Sequence[str] = (),
    extra: Mapping[str, Column] | None = None,
    approx: bool = False,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Named quantiles of ``value`` per group, plus ``extra`` aggregates.

    The extra aggregates run over the (group, value) rows and may use the value
    and its count ``n``. ``approx=True`` takes ``percentile_approx`` instead:
    one pass with a fixed-size sketch per group, giving an existing value.
    """
    if approx:
        if extra:
            raise ValueError("extra aggregates need the exact quantiles")
        return _complete(df, *by, value).groupBy(*by).agg(*[
            F.percentile_approx(value, float(p)).cast("double").alias(name)
            for name, p in quantiles.items()
        ])
    counted = value_counts_by(df, value, by)
    ranked = running_totals(counted, value, ["n"], by, bucket_rows)
    return ranked.groupBy(*by).agg(
        *[c.alias(k) for k, c in (extra or {}).items()],
        *[quantile_at(value, p).alias(name) for name, p in quantiles.items()],
    )


def average_ranks(df: DataFrame, value: str, count: str = "n", rank: str = "rank", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rank of every distinct value when ties share the mean of their places."""
    ranked = running_totals(df, value, [count], bucket_rows=bucket_rows)
    return ranked.select(
        value, (F.col(f"before_{count}") + (F.col(count) + 1) / 2.0).alias(rank), f"total_{count}"
    )
