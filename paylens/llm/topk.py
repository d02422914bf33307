"""Exact top-k inner products by a dual-tree search over cover trees.

Vectors are packed into blocks where they are read, queries likewise. Every block is indexed by a cover tree: a node has a
centre, a covering radius around it and children whose centres keep a distance; a child of
the same centre comes first. A block of queries visits every block of data, group by group. There
the two trees are descended together. For nodes Q and R with centres q and r and radii a and b,

    max <x, y>  <=  <q, r> + a * |r| + b * |q| + a * b      (x in Q, y in R)

and the pair is left out if that is below the worst k-th score of the queries in Q. Where few products would be spared, the pair
is not opened but computed as one matrix product, tile by tile. The k best are kept from
block to block of a group, and those of the groups are merged by a window.

Scores are exact integers; a bound is widened by the rounding error of its floats, and an equal bound is kept, so
ties go to the smaller id. Vectors that are null, empty or hold a null or non-finite component take no part. Only vectors of equal
length are compared. A product that may not fit into 64 bits is an error. Rows that repeat an id are candidates each, and one
query, with the smallest vector; none is its own id's candidate. Rows without id take no part. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.llm.blocks import met, pack, unpack
from paylens.session import stage_table

#: Vectors per block, on average.
BLOCK = 8192
#: Blocks of a group of queries; a group of data has up to four times as many.
GROUP = 16
#: Scores that are held at a time.
SCORES = 2**19
#: A pair of nodes is opened if at least this share of its products would be spared at once.
SPARED = 0.25
#: Nodes of up to so many vectors have no children: of data, of queries.
LEAF, QUERY_LEAF = 64, 8
#: A child's radius is the parent's divided by this. In many dimensions most distances are alike; 2 would part all rows.
BASE = 1.5


class CoverTree:
    """Cover tree over the rows of a matrix; a node covers a range of ``rows`` and has a centre, a radius and children.

    The children of a node have centres farther apart than the radius divided by ``base``, and cover their rows within
    that distance. Children of fewer than ``small`` rows are joined into one leaf around the node's own
    centre, as a node of its own would cost more than the products it saves.
    """

    def __init__(self, points: np.ndarray, leaf: int, base: float = BASE):
        self.points, self.leaf, self.base = points.astype(np.float64), leaf, base
        self.children: list[list[int]] = []
        parts: list[np.ndarray] = []
        centres, radii, spans = [], [], []
        filled = 0

        def grow(rows: np.ndarray, centre: int, distances: np.ndarray, split: bool = True) -> int:
            nonlocal filled
            radius, start = float(distances.max()), filled
            children = []
            if not split or len(rows) <= leaf or radius == 0:
                parts.append(rows)
                filled += len(rows)
            else:
                left, at, c, rest = rows, distances, centre, []
                while len(left):
                    near = at <= radius / base
                    if near.sum() * 4 < leaf:
                        rest.append(left[near])
                    else:
                        children.append(grow(left[near], c, at[near]))
                    left = left[~near]
                    if len(left):
                        c = int(left[0])
                        at = self._distances(left, c)
                if rest:
                    rest = np.concatenate(rest)
                    children.append(grow(rest, centre, self._distances(rest, centre), False))
            self.children.append(children)
            centres.append(centre)
            radii.append(radius)
            spans.append((start, filled))
            return len(spans) - 1

        self.root = grow(np.arange(len(points)), 0, self._distances(np.arange(len(points)), 0))
        self.rows, self.spans = np.concatenate(parts), spans
        self.centres, self.radii = self.points[centres], np.array(radii)
        self.norms = np.sqrt((self.centres ** 2).sum(axis=1))

    def _distances(self, rows: np.ndarray, centre: int) -> np.ndarray:
        return np.sqrt(((self.points[rows] - self.points[centre]) ** 2).sum(axis=1))


def bounds(q: CoverTree, r: CoverTree) -> np.ndarray:
    """For every pair of nodes, no product of vectors below them is higher; wide enough for rounding errors."""
    a, b = q.radii[:, None], r.radii[None, :]
    upper = q.centres @ r.centres.T + a * r.norms + b * q.norms[:, None] + a * b
    return upper + 1e-9 * (1 + (q.norms[:, None] + a) * (r.norms + b))


def _type(most: float):
    """The fastest type in which sums of products up to ``most`` are exact integers."""
    if most >= 2.0**63:
        raise ValueError("a product may not fit into 64 bits")
    return np.float32 if most < 2.0**24 else np.float64 if most < 2.0**53 else np.longdouble


def _leaves(tree: CoverTree) -> np.ndarray:
    """Nodes without children, in the order of their rows."""
    leaves = [i for i, children in enumerate(tree.children) if not children]
    return np.array(sorted(leaves, key=lambda i: tree.spans[i]))


class Data:
    """A block of data in the order of its cover tree."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, dtype):
        self.tree = CoverTree(vectors, LEAF)
        order = self.tree.rows
        self.vectors, self.ids = vectors[order].astype(dtype), ids[order]
        self.by_id = np.argsort(self.ids, kind="stable")
        self.ascending = self.ids[self.by_id]
        self.leaves = _leaves(self.tree)
        self.starts, self.ends = np.array(self.tree.spans)[self.leaves].T


class Queries:
    """A block of queries in the order of its cover tree, with the k best scores found so far and their ids, kept from one block of data to the next.

    ``floor`` is a score that k others are known to reach.
    """

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, k: int, dtype):
        self.tree, self.k = CoverTree(vectors, QUERY_LEAF), k
        self.order = self.tree.rows
        self.vectors, self.ids = vectors[self.order].astype(dtype), ids[self.order]
        self.best = np.full((len(ids), k), -np.inf, dtype)
        self.names = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.floor = np.full(len(ids), -np.inf, dtype)
        self.leaves = _leaves(self.tree)
        self.starts, self.ends = np.array(self.tree.spans)[self.leaves].T

    def visit(self, data: Data) -> int:
        """Take the best of one more block; how many products were computed."""
        q_tree, r_tree = self.tree, data.tree
        upper = bounds(q_tree, r_tree)
        of_leaves = upper[np.ix_(self.leaves, data.leaves)]
        products = self._first(data, of_leaves) if np.isinf(self.floor).any() else 0
        weights = data.ends - data.starts
        stack = [(q_tree.root, r_tree.root)]
        while stack:
            q, r = stack.pop()
            (begin, stop), (start, end) = q_tree.spans[q], r_tree.spans[r]
            if upper[q, r] < self.floor[begin:stop].min():
                continue
            q_children, r_children = q_tree.children[q], r_tree.children[r]
            if q_children or r_children:
                some, others = (slice(*np.searchsorted(x.starts, span)) for x, span in ((self, (begin, stop)), (data, (start, end))))
                least = np.minimum.reduceat(self.floor[begin:stop], self.starts[some] - begin)
                pruned = (of_leaves[some, others] < least[:, None]) @ weights[others] @ (self.ends - self.starts)[some]
                # opened where that spares products; where it does not, one large product is quicker than many small ones
                if pruned >= SPARED * (stop - begin) * (end - start):
                    # the wider node is opened; the most promising pair comes off the stack first
                    if r_children and (not q_children or r_tree.radii[r] >= q_tree.radii[q]):
                        stack += [(q, c) for c in sorted(r_children, key=lambda c: upper[q, c])]  # noqa: B023
                    else:
                        stack += [(c, r) for c in sorted(q_children, key=lambda c: upper[c, r])]  # noqa: B023
                    continue
            products += (stop - begin) * (end - start)
            few = max(1, SCORES // (end - start))
            for at in range(begin, stop, few):
                self._take(slice(at, min(at + few, stop)), data, start, end)
        return products

    def _scores(self, rows: slice, data: Data, start: int, end: int) -> np.ndarray:
        """Products with a range of the data; of a query's own id, minus infinity."""
        scores = self.vectors[rows] @ data.vectors[start:end].T
        first, last = (np.searchsorted(data.ascending, self.ids[rows], side) for side in ("left", "right"))
        for i in np.flatnonzero(first < last):
            own = data.by_id[first[i]:last[i]]
            scores[i, own[(own >= start) & (own < end)] - start] = -np.inf
        return scores

    def _first(self, data: Data, upper: np.ndarray) -> int:
        """A first floor for every query, from the most promising leaf; nothing is taken yet."""
        products = 0
        large = np.flatnonzero(data.ends - data.starts > self.k)
        if len(large):
            for i, j in enumerate(large[upper[:, large].argmax(axis=1)]):
                rows = slice(self.starts[i], self.ends[i])
                scores = self._scores(rows, data, data.starts[j], min(data.ends[j], data.starts[j] + LEAF + self.k))
                kth = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k]
                self.floor[rows] = np.maximum(self.floor[rows], kth)
                products += scores.size
        return products

    def _take(self, rows: slice, data: Data, start: int, end: int) -> None:
        scores = self._scores(rows, data, start, end)
        # only what reaches the floor can matter, nor can what has k higher scores beside it
        useful = scores >= self.floor[rows, None]
        if np.count_nonzero(useful) > 4 * self.k * len(scores) and end - start > self.k:
            kth = np.partition(scores, end - start - self.k, axis=1)[:, end - start - self.k]
            useful &= scores >= kth[:, None]
        i, j = np.nonzero(useful)
        found = scores[i, j]
        finite = np.isfinite(found)
        if not finite.any():
            return
        i, j, found = i[finite], j[finite], found[finite]
        changed = np.unique(i)
        at = rows.start + changed
        both = np.concatenate([self.best[at].ravel(), found])
        names = np.concatenate([self.names[at].ravel(), data.ids[start + j]])
        of = np.concatenate([np.repeat(changed, self.k), i])
        order = np.lexsort((names, -both, of))
        top = order[np.flatnonzero(np.diff(of[order], prepend=-1))[:, None] + np.arange(self.k)]
        self.best[at], self.names[at] = both[top], names[top]
        self.floor[at] = np.maximum(self.floor[at], self.best[at, -1])

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of queries as they were given, ids, scores."""
        i, j = np.nonzero(np.isfinite(self.best))
        return self.order[i], self.names[i, j], self.best[i, j].astype(np.int64)


def search(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int):
    """Each query's k best in this block: rows of queries, ids, scores; and how many products were computed."""
    if not len(queries) or not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none, 0
    dtype = _type(float(np.abs(queries).max()) * float(np.abs(data).max()) * data.shape[1])
    asked = Queries(queries, query_ids, k, dtype)
    products = asked.visit(Data(data, ids, dtype))
    return *asked.found(), products


def usable(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, v): components times ``scale``, rounded down; rows that take no part are left out."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    raw = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    kept = raw.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
    return kept.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))


def _blocks(rows: DataFrame, limit: int) -> DataFrame:
    """One row per block of up to ``limit`` vectors of a length, packed and written to the shared folder; rows stay where they were read."""

    def packed(number: int, size: int, frame: pd.DataFrame) -> pd.DataFrame:
        values = np.stack(frame["v"].to_numpy()).astype(np.float64)
        return pd.DataFrame({
            "number": [number], "size": [size], "largest": [float(np.abs(values).max())],
            "ids": [pack(frame["vec_id"].to_numpy(), np.int64)], "vectors": [pack(values.reshape(-1), np.float64)]})

    def form(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, held = TaskContext.get().partitionId(), {}
        for batch in batches:
            for size, frame in batch.groupby(batch["v"].map(len)):
                whole = pd.concat([held.pop(size), frame]) if size in held else frame
                while len(whole) >= limit:
                    yield packed(number, size, whole[:limit])
                    number, whole = number + 1, whole[limit:]
                if len(whole):
                    held[size] = whole
        for size, whole in held.items():
            yield packed(number, size, whole)
            number += 1

    return stage_table(rows.mapInPandas(form, "number int, size int, largest double, ids binary, vectors binary"), "blocks", large_rows=True)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
          scale: int = 256, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products, ties to the smaller id.

    Blocks of data and of queries are dealt out to groups; a cell is a pair of groups and is searched at once. What is moved
    are packed blocks, data once for each group of queries and queries once for each group of data.
    """
    rows = stage_table(usable(vectors, vec_id, vector, scale), "vectors")
    data = _blocks(rows, block)
    queries = _blocks(rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")), block)
    def visit(size: int, asked: pd.DataFrame, here: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})]
        if len(asked) and len(here):
            dtype = _type(asked["largest"].max() * here["largest"].max() * size)

            def opened(row) -> tuple[np.ndarray, np.ndarray]:
                return unpack(row.vectors, np.float64).reshape(-1, size), unpack(row.ids, np.int64)

            parts = [Queries(*opened(row), k, dtype) for row in asked.itertuples()]
            for row in here.itertuples():
                block = Data(*opened(row), dtype)
                for part in parts:
                    part.visit(block)
            for part, row in zip(parts, asked.itertuples()):
                i, names, score = part.found()
                out.append(pd.DataFrame({"query_id": unpack(row.ids, np.int64)[i], "vec_id": names, "score": score}))
        return pd.concat(out)

    found = met(queries, data, GROUP, 4 * GROUP, visit, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
