"""Features as small numbers: numeric columns by quantile edges, text columns by a distributed dictionary.

Every feature has at most ``BINS`` bins. The bins of eight features are the bytes of one long, so a row is a few longs however many
trees it is sent to.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.operators.ranking import running_totals
from paylens.session import stage_table

#: Bins of a feature, numbered from 0; the number ``BINS`` itself stands for a level that the fitting rows do not have.
BINS = 255


def numeric_edges(rows: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """(feature, edge): of each column's values in order, those at which another ``bins``-th part of the rows is full.

    A value held by that many rows always is an edge, so small domains keep all their values.
    """
    long = rows.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "feature", "value")
    counted = long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    placed = running_totals(counted, "value", ["n"], ["feature"])

    def part(place: Column) -> Column:
        return F.floor(place * bins / F.col("total_n"))

    full = part(F.col("before_n") + F.col("n")) > part(F.col("before_n"))
    return placed.where(full).select("feature", F.col("value").alias("edge"))


def text_bins(rows: DataFrame, column: str, target: str, bins: int = BINS) -> DataFrame:
    """(level, bin): levels in order of their mean target; up to ``bins`` levels have a bin each, more share them evenly."""
    levels = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("level")).agg(
        (F.sum(F.col(target).cast("double")) / F.count(F.lit(1))).alias("mean"))
    placed = running_totals(levels.select("level", F.struct("mean", "level").alias("place"), F.lit(1).alias("one")), "place", ["one"])
    of = F.floor(F.col("before_one") * F.least(F.col("total_one"), F.lit(bins)) / F.col("total_one"))
    return placed.select("level", of.cast("int").alias("bin"))


@dataclass
class Binning:
    """Bins fitted on one table: edges of the numeric columns, dictionaries of the text columns, both staged tables."""

    numeric: list[str]
    text: list[str]
    edges: DataFrame
    levels: dict[str, DataFrame]

    @classmethod
    def fit(cls, rows: DataFrame, numeric: Sequence[str], text: Sequence[str], target: str) -> Binning:
        edges = stage_table(numeric_edges(rows, numeric), "edges") if numeric else None
        levels = {c: stage_table(text_bins(rows, c, target), "levels") for c in text}
        return cls(list(numeric), list(text), edges, levels)

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *self.text]

    @property
    def packs(self) -> list[str]:
        """Names of the packed columns."""
        return [f"p{i}" for i in range(math.ceil(len(self.names) / 8))]

    def sizes(self) -> list[int]:
        """Bins in use of every feature: one aggregate a table."""
        counted = dict(self.edges.groupBy("feature").count().collect()) if self.numeric else {}
        text = [(self.levels[c].agg(F.max("bin")).first()[0] or 0) + 1 for c in self.text]
        return [counted.get(c, 1) for c in self.numeric] + text

    def transform(self, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` and the packed bins of every row. Values beyond the last edge count as the last bin."""
        out = rows
        if self.numeric:
            edges: dict[str, list[float]] = {c: [] for c in self.numeric}
            for r in self.edges.collect():  # at most BINS numbers a column
                edges[r["feature"]].append(r["edge"])
            out = out.withColumns({f"_bin_{c}": _edge_bin(F.col(c).cast("double"), edges[c]) for c in self.numeric})
        for c in self.text:
            of = self.levels[c].select(F.col("level").alias(f"_level_{c}"), F.col("bin").alias(f"_bin_{c}"))
            out = out.join(of, F.col(c) == F.col(f"_level_{c}"), "left").fillna(BINS, [f"_bin_{c}"])
        packed = []
        for i, name in enumerate(self.packs):
            byte = [F.shiftleft(F.col(f"_bin_{c}").cast("long"), 8 * j) for j, c in enumerate(self.names[8 * i:8 * i + 8])]
            total = byte[0]
            for b in byte[1:]:
                total = total.bitwiseOR(b)
            packed.append(total.alias(name))
        return out.select(*keep, *packed)


def _edge_bin(value: Column, edges: Sequence[float]) -> Column:
    """Number of edges below the value, at most the last one's number; a batch of rows is searched at once. Null counts as below all."""
    ascending = np.sort(np.array(edges, np.float64))

    def below(values: pd.Series) -> pd.Series:
        return pd.Series(np.clip(np.searchsorted(ascending, values.to_numpy(np.float64)), 0, max(0, len(ascending) - 1)).astype(np.int32))

    return F.when(value.isNull(), 0).otherwise(F.pandas_udf(below, "int")(value))


def bin_of(packs: Sequence[str], feature: int) -> Column:
    """One feature's bin of packed columns."""
    return F.shiftrightunsigned(F.col(packs[feature // 8]), 8 * (feature % 8)).bitwiseAND(F.lit(255)).cast("int")


def unpacked(packs: Sequence[np.ndarray], features: int) -> np.ndarray:
    """Matrix of bins, one byte each, from the packed columns of a batch."""
    parts = [np.ascontiguousarray(p, "<i8").view(np.uint8).reshape(-1, 8) for p in packs]
    return np.concatenate(parts, axis=1)[:, :features]
