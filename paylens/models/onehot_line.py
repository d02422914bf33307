"""Least squares on numeric and one-hot columns, from sums per combination of levels.

The normal equations need sums of products of pairs of columns. Of one-hot columns these are counts per pair of levels, a sparse table; all
come from one aggregate of the rows by their levels. Columns are numbered by a distributed dictionary and scaled to unit length, numeric
ones after centring, and the system is solved by conjugate gradients, one job per step. The driver holds a few vectors of numbers, one
per column and ``MAX_COLUMNS`` at most, and no label; the matrix stays in the tasks. From a start of zero the solution is the one
of least norm (of the scaled coefficients), so columns that depend on each other, as all levels of a text column do, need no treatment.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.operators.ranking import running_totals
from paylens.session import stage_table
from paylens.sources import writers

#: Length of the remaining residual, as a share of the first, at which the solution counts as found.
TOLERANCE = 1e-10
MAX_STEPS = 500
#: Columns, levels included, of which a vector is sent to every task.
MAX_COLUMNS = 5_000_000


def _moments(train: DataFrame, numeric: Sequence[str], text: Sequence[str], target: str) -> DataFrame:
    """One row per combination of levels: count and sums of products of the centred numbers, target included."""
    names = [*numeric, target]
    numbers = train.select(*text, *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    means = numbers.agg(F.struct(*[F.avg(f"x{i}").alias(f"x{i}") for i in range(len(names))])).scalar()
    centred = numbers.withColumn("_m", means)
    centred = centred.withColumns({f"x{i}": F.col(f"x{i}") - F.col(f"_m.x{i}") for i in range(len(names))})
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    sums = [F.sum(f"x{i}").alias(f"s{i}") for i in range(len(names))]
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i, j in pairs]
    return stage_table(centred.groupBy(*text).agg(F.count(F.lit(1)).alias("n"), *sums, *products), "moments")


def _cells(moments: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(a, b, g): sums of products of all pairs of columns, both ways round; and (a, y): those with the target.

    A column is a struct of its number and its level, which a numeric one does not have.
    """
    k = len(numeric)

    def column(i: int):
        level = F.col(text[i - k]) if i >= k else F.lit(None)
        return F.struct(F.lit(i).alias("of"), level.cast("string").alias("level"))

    def total(i: int, j: int):
        if i < k and j < k:
            return F.col(f"s{min(i, j)}_{max(i, j)}")
        return F.col("n").cast("double") if i >= k and j >= k else F.col(f"s{min(i, j)}")

    columns = range(k + len(text))
    pairs = F.array(*[F.struct(column(i).alias("a"), column(j).alias("b"), total(i, j).alias("g")) for i in columns for j in columns])
    cells = stage_table(moments.select(F.explode(pairs).alias("p")).select("p.*").groupBy("a", "b").agg(F.sum("g").alias("g")), "pairs")
    sides = F.array(*[F.struct(column(i).alias("a"), (F.col(f"s{i}_{k}") if i < k else F.col(f"s{k}")).alias("y")) for i in columns])
    return cells, moments.select(F.explode(sides).alias("p")).select("p.*").groupBy("a").agg(F.sum("y").alias("y"))


def _numbered(cells: DataFrame, sides: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(i, j, g): the scaled system by numbers of columns; (i, a, length, y): the columns; and how many there are."""
    lengths = cells.where((F.col("a") == F.col("b")) | ((F.col("a.of") == F.col("b.of")) & F.col("a.level").isNull())).where("g > 0")
    place = F.struct(F.col("a.of").alias("of"), F.coalesce("a.level", F.lit("")).alias("level"))
    numbered = running_totals(lengths.select("a", F.sqrt("g").alias("length"), place.alias("place"), F.lit(1).alias("one")), "place", ["one"])
    columns = stage_table(numbered.join(sides.withColumnRenamed("a", "_a"), F.col("a").eqNullSafe(F.col("_a"))).select(
        F.col("before_one").cast("int").alias("i"), "a", "length", (F.col("y") / F.col("length")).alias("y")), "columns")
    i, j = (columns.select(F.col("a").alias(f"_{n}"), F.col("i").alias(n), F.col("length").alias(f"_l{n}")) for n in "ij")
    scaled = cells.join(i, F.col("a").eqNullSafe(F.col("_i"))).join(j, F.col("b").eqNullSafe(F.col("_j"))).select(
        "i", "j", (F.col("g") / F.col("_li") / F.col("_lj")).alias("g"))
    n = columns.count()
    if n > MAX_COLUMNS:
        raise ValueError(f"{n} columns: the vectors of the solution are held by every task, {MAX_COLUMNS} at most")
    return stage_table(scaled, "cells"), columns, n


def _solve(cells: DataFrame, columns: DataFrame, n: int) -> np.ndarray:
    """Conjugate gradients: in each step, tasks multiply their part of the matrix with the direction."""
    def product(direction: np.ndarray) -> np.ndarray:
        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(n)
            for b in batches:
                total += np.bincount(b["i"], b["g"].to_numpy() * direction[b["j"].to_numpy()], n)
            used = np.flatnonzero(total)
            yield pd.DataFrame({"i": used, "q": total[used]})

        sums = cells.mapInPandas(partial, "i int, q double").groupBy("i").agg(F.sum("q").alias("q"))
        return _vector(sums.collect(), n)

    x, r = np.zeros(n), _vector(columns.select("i", "y").collect(), n)
    p, rr, first = r, r @ r, r @ r
    for _ in range(MAX_STEPS):
        if rr <= TOLERANCE**2 * first:
            return x
        q = product(p)
        alpha = rr / (p @ q)
        x, r = x + alpha * p, r - alpha * q
        rr, old = r @ r, rr
        p = r + rr / old * p
    raise ArithmeticError(f"no solution within {MAX_STEPS} steps")


def _vector(rows: list, n: int) -> np.ndarray:
    out = np.zeros(n)
    if rows:
        at, values = zip(*rows)
        out[list(at)] = values
    return out


@dataclass
class OneHotLine:
    """Coefficients as a table (column_name, level, weight); the intercept has the column name null."""

    numeric: list[str]
    text: list[str]
    coefficients: DataFrame

    def predict(self, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` and ``y_pred``; a level without a coefficient counts as zero."""
        whole = self.coefficients.where("level IS NULL").agg(F.map_from_entries(F.collect_list(
            F.struct(F.coalesce("column_name", F.lit("")), "weight")))).scalar()
        out = rows.withColumn("_w", whole)
        value = F.col("_w")[""]
        for c in self.numeric:
            value = value + F.coalesce(F.col("_w")[c], F.lit(0.0)) * F.col(c).cast("double")
        for i, c in enumerate(self.text):
            of = self.coefficients.where(F.col("column_name") == c).where("level IS NOT NULL").select(
                F.col("level").alias(f"_l{i}"), F.col("weight").alias(f"_w{i}"))
            out = out.join(of, F.col(c) == F.col(f"_l{i}"), "left")
            value = value + F.coalesce(F.col(f"_w{i}"), F.lit(0.0))
        return out.select(*keep, value.alias("y_pred"))

    def weights(self) -> DataFrame:
        """(feature, weight): numeric columns by their names, levels as ``column_level``, and the intercept."""
        name = F.when(F.col("column_name").isNull(), "intercept").otherwise(F.concat_ws("_", "column_name", "level"))
        return self.coefficients.select(name.alias("feature"), "weight")

    def with_levels_of(self, rows: DataFrame) -> OneHotLine:
        """Levels of ``rows`` that have no coefficient are listed with 0."""
        listed = self.coefficients
        for c in self.text:
            have = self.coefficients.where(F.col("column_name") == c).select("level")
            new = rows.where(F.col(c).isNotNull()).select(F.col(c).alias("level")).distinct().join(have, "level", "left_anti")
            listed = listed.unionByName(new.select(F.lit(c).alias("column_name"), "level", F.lit(0.0).alias("weight")))
        return OneHotLine(self.numeric, self.text, stage_table(listed, "coefficients"))

    def save(self, path: str) -> str:
        settings = self.coefficients.sparkSession.createDataFrame([(self.numeric, self.text)], "numeric array<string>, text array<string>")
        writers.write_parquet(settings, f"{path}/settings")
        writers.write_parquet(self.coefficients, f"{path}/coefficients")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> OneHotLine:
        of = spark.read.parquet(f"{path}/settings").first()
        return cls(list(of.numeric), list(of.text), spark.read.parquet(f"{path}/coefficients"))


def fit(train: DataFrame, numeric: Sequence[str], text: Sequence[str], target: str) -> OneHotLine:
    """Least squares on complete rows."""
    numeric, text = list(numeric), list(text)
    moments = _moments(train, numeric, text, target)
    cells, columns, n = _numbered(*_cells(moments, numeric, text))
    x = _solve(cells, columns, n)
    solved = train.sparkSession.createDataFrame(pd.DataFrame({"i": np.arange(n), "x": x}), "i int, x double")
    names = F.array(*[F.lit(c) for c in [*numeric, *text]])
    slopes = stage_table(columns.join(solved, "i").select(
        F.get(names, "a.of").alias("column_name"), F.col("a.level").alias("level"), (F.col("x") / F.col("length")).alias("weight")), "slopes")
    # centred numbers and target: the intercept undoes it
    means = train.agg(F.avg(F.col(target).cast("double")).alias("y"), *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(numeric)])
    shift = slopes.where("level IS NULL").agg(F.map_from_entries(F.collect_list(F.struct("column_name", "weight")))).scalar()
    intercept = F.col("y")
    for i, c in enumerate(numeric):
        intercept = intercept - F.coalesce(F.col("_w")[c], F.lit(0.0)) * F.col(f"m{i}")
    base = means.withColumn("_w", shift).select(F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("string").alias("level"), intercept.alias("weight"))
    return OneHotLine(numeric, text, stage_table(slopes.unionByName(base), "coefficients"))
