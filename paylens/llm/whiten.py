"""Embedding whitening: rows are centred, turned into the principal axes of their covariance and scaled to unit variance.

Rows become integers. Their count and sums are exact. Each task reduces its centred rows, block by block, to the triangular factor of their QR
decomposition; the factors of the tasks are reduced in a tree of constant fan-in to one factor R with R'R = n V, V the covariance. No
product of rows is ever summed, so small variances keep their digits. ``bidiagonal.right_singular`` finds R's singular
values s and right vectors: the eigenvalues of V are s**2 / n. A second scan measures the covariance of the whitened rows.

Each length of vectors is a list of its own, with its own model. Directions without variance (s within rounding of zero, as in lists
of fewer rows than dimensions) have whitened null and do not count in ``identity_error``; without any variance, ``explained`` is 0.
Vectors that are null, empty or hold null or non-finite entries are left out; rows with null or repeated ids are rows like others. The sign of a
component makes its entry of largest magnitude positive, the first of equal ones. A sum that does not fit into 64 bits is an error. Only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.bidiagonal import EPS, right_singular
from paylens.session import stage_table

#: Components of the result, at most.
COMPONENTS = 32
#: Factors that are reduced to one at a time.
FAN_IN = 8
#: Numbers in the models of all lengths together, which every task holds.
MAX_MODEL = 50_000_000


def usable(vectors: DataFrame, vec_id: str, vector: str, scale: int, offset: int) -> DataFrame:
    """(vec_id, x): components times ``scale``, rounded down, plus ``offset``, as longs; ids as text, which keeps nulls and large ones."""
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    raw = vectors.select(F.col(vec_id).cast("string").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    kept = raw.where(v.isNotNull() & (F.size(v) > 0) & finite)
    return kept.select("vec_id", F.transform("v", lambda c: F.floor(c * scale) + offset).alias("x"))


@dataclass
class Model:
    """Of all vectors of one length: count, sums, eigenvalues of the covariance and their vectors as columns."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    live: np.ndarray
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact: rows are moved by a whole number near the mean first, so that the product stays small."""
        return (x - self._middle()) * self.n - (self.sums - self.n * self._middle())

    def _middle(self) -> np.ndarray:
        return self.sums // self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of squares of the exact deviations."""
        moved = self.centred(x)
        if float(np.abs(moved).max(initial=0)) ** 2 * moved.shape[1] < 2.0**62:
            return (moved * moved).sum(axis=1).tolist()
        return (moved.astype(object) ** 2).sum(axis=1).tolist()

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows of components with unit variance; NaN where a component has none."""
        with np.errstate(divide="ignore"):
            scales = np.where(self.live, 1 / np.sqrt(self.values), np.nan)
        return (self.centred(x) / self.n) @ self.vectors * scales


def by_length(frame: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, matrix) for each length of vectors in a batch."""
    lengths = frame["x"].map(len).to_numpy()
    for size in np.unique(lengths):
        at = np.flatnonzero(lengths == size)
        yield at, np.stack(frame["x"].to_numpy()[at]).astype(np.int64)


def list_sums(rows: DataFrame, components: int = COMPONENTS) -> dict[int, tuple[int, np.ndarray]]:
    """Count and exact sums of every length: one row a length reaches the driver."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for batch in batches:
            for at, x in by_length(batch):
                n, sums = held.get(x.shape[1], (0, 0))
                held[x.shape[1]] = n + len(at), sums + x.astype(object).sum(axis=0) if np.abs(x).max() >= 2**40 else sums + x.sum(axis=0)
        for size, (n, sums) in held.items():
            yield pd.DataFrame({"size": size, "n": n, "place": np.arange(size), "total": [int(s) for s in sums]})

    parts = rows.mapInPandas(partial, "size int, n long, place int, total long")
    sums = parts.groupBy("size", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    lists = sums.groupBy("size").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("place", "total"))).alias("sums"))
    lists = lists.select("size", "n", "sums.total").collect()
    if sum(r["size"] for r in lists) * (components + 1) > MAX_MODEL:
        raise ValueError(f"models of {len(lists)} lengths of vectors are too large to be held by every task")
    return {r["size"]: (r["n"], np.array(r["total"], np.int64)) for r in lists}


FACTOR = "size int, part int, r binary"


def _reduced(parts: list[np.ndarray]) -> np.ndarray:
    """Triangular factor of the QR decomposition of stacked rows, padded to a square."""
    stacked = np.concatenate(parts)
    size = stacked.shape[1]
    r = np.linalg.qr(stacked, mode="r")
    return r if len(r) == size else np.concatenate([r, np.zeros((size - len(r), size))])


def factors(rows: DataFrame, lists: dict[int, tuple[int, np.ndarray]]) -> DataFrame:
    """(size, part, r): one triangular factor of the centred rows per length."""
    models = {size: Model(n, sums, 0, *[np.zeros(0)] * 3) for size, (n, sums) in lists.items()}

    def blockwise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in by_length(batch):
                size = x.shape[1]
                y = models[size].centred(x) / models[size].n
                held[size] = _reduced([held[size], y] if size in held else [y])
        part = TaskContext.get().partitionId()
        for size, r in held.items():
            yield pd.DataFrame({"size": [size], "part": [part], "r": [r.tobytes()]})

    def merged(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")
        r = _reduced([np.frombuffer(b).reshape(-1, key[0]) for b in frame["r"]])
        return pd.DataFrame({"size": [key[0]], "part": [key[1]], "r": [r.tobytes()]})

    out = stage_table(rows.mapInPandas(blockwise, FACTOR), "factors")
    last = out.agg(F.max("part")).first()[0] or 0
    while last:
        up = F.floor(F.col("part") / FAN_IN).cast("int").alias("part")
        out = stage_table(out.select("size", up, "r").groupBy("size", "part").applyInPandas(merged, FACTOR), "factors")
        last //= FAN_IN
    return out


def fit(rows: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """A model per length of vectors; the decompositions run in tasks, and only models reach the driver."""
    lists = list_sums(rows, components)
    counts = {size: n for size, (n, _) in lists.items()}

    def decompose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                r = np.frombuffer(row.r).reshape(row.size, row.size)
                s, v = right_singular(r, min(components, row.size))
                v = v * np.where(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])] < 0, -1, 1)
                yield pd.DataFrame({"size": [row.size], "trace": [float((r * r).sum()) / counts[row.size]], "s": [s], "v": [v.reshape(-1)]})

    solved = factors(rows, lists).mapInPandas(decompose, "size int, trace double, s array<double>, v array<double>")
    models = {}
    for r in stage_table(solved, "axes").collect():
        n, sums = lists[r["size"]]
        k = min(components, r["size"])
        s = np.array(r["s"])
        models[r["size"]] = Model(n, sums, r["trace"], s[:k] ** 2 / n, np.array(r["v"]).reshape(r["size"], k),
                                  s[:k] > s[0] * EPS * max(n, r["size"]))
    for size, error in identity_errors(rows, models).items():
        models[size].identity_error = error
    return models


def identity_errors(rows: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """Per length, the largest entry of the whitened rows' covariance minus the identity, measured on all rows."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple] = {}
        for batch in batches:
            for _, x in by_length(batch):
                model = models[x.shape[1]]
                z = model.whitened(x)[:, model.live]
                total, products = held.get(x.shape[1], (0, 0))
                held[x.shape[1]] = total + z.sum(axis=0), products + z.T @ z
        for size, (total, products) in held.items():
            values = np.concatenate([total, products.reshape(-1)])
            yield pd.DataFrame({"size": size, "place": np.arange(len(values)), "value": values})

    sums = rows.mapInPandas(partial, "size int, place int, value double").groupBy("size", "place").agg(F.sum("value").alias("value"))
    out = {}
    for r in sums.groupBy("size").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("v")).select("size", "v.value").collect():
        model, values = models[r["size"]], np.array(r["value"])
        k = int(model.live.sum())
        mean = values[:k] / model.n
        covariance = values[k:].reshape(k, k) / model.n - np.outer(mean, mean)
        out[r["size"]] = float(np.abs(covariance - np.eye(k)).max(initial=0.0))
    return out


def whiten(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding",
           scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): one row per vector and component.

    ``deviation`` is a decimal, as it grows with the square of the number of rows.
    """
    rows = stage_table(usable(vectors, vec_id, vector, scale, offset), "rows")
    models = fit(rows, components)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, x in by_length(batch):
                model = models[x.shape[1]]
                share = model.values / model.trace if model.trace > 0 else np.zeros(len(model.values))
                yield pd.DataFrame({
                    "vec_id": batch["vec_id"].to_numpy()[at], "n": model.n, "deviation": [str(d) for d in model.deviations(x)],
                    "z": list(model.whitened(x)), "share": [share] * len(at),
                    "identity_error": model.identity_error if model.live.any() else None})

    done = rows.mapInPandas(
        project, "vec_id string, n long, deviation string, z array<double>, share array<double>, identity_error double")
    long = done.select("*", F.posexplode(F.arrays_zip("z", "share")).alias("place", "of"))
    return long.select(
        F.col("vec_id").cast(vectors.schema[vec_id].dataType).alias("vec_id"), (F.col("place") + 1).alias("component"), "n",
        F.col("deviation").cast("decimal(38,0)").alias("deviation"), F.nanvl("of.z", F.lit(None)).alias("whitened"),
        F.col("of.share").alias("explained"), "identity_error")
