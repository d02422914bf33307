"""Hard negatives by Four-Russians scoring: subset-sum tables of the anchors, looked up by bit planes of the candidates.

Components are integers. Dimensions are taken in groups of eight. Of an anchor and a group there are 256 sums of subsets of its eight
components, a table that is made once per tile of anchors. A candidate is stored as bit planes: of plane p and a group, one byte holds
bit p of the eight components. The inner product is then

    sum over planes p of 2**p * (sum over groups of table[group][byte[p, group]]),

with the highest plane negative (two's complement): shifts, lookups and additions, and an exact integer.

Candidates are packed in place, block by block and ordered by (label, vec_id), and written to the shared folder; so are the anchors. Every
block of anchors meets every block of candidates twice: for the positives it is scored against the rows of its own labels, for
the negatives against those of other labels, so each product is computed once. Blocks meet by groups, which return their best rows;
these are merged by a window. An anchor's negatives of a positive with score p are the best of other labels whose score s
satisfies low * p <= 100 * s <= high * p. Ties go to the smaller vec_id.

Rows without id or label take no part, nor do vectors that are null, empty or hold null or non-finite components. Only vectors of equal length
are compared. Rows that repeat an id are candidates each, never for their own id, and one anchor, with the smallest (vector, label). An
anchor without positives gives no rows. A score that may not fit into 64 bits is an error. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.llm.blocks import met, pack, shards, unpack
from paylens.session import stage_table

#: Rows of a block of candidates, at most and at least; anchors of a block.
BLOCK, LEAST, ANCHORS = 65_536, 4096, 4096
#: Rows and anchors that are scored at a time: their scores and the tables of the anchors stay in a core's cache.
TILE, ANCHOR_TILE = 1024, 64

#: Blocks of a group of anchors and of a group of candidates.
ANCHOR_GROUP, GROUP = 32, 8

PACKED = "number int, size int, bits int, ids binary, labels binary, planes binary"
ANCHOR_ROWS = "number int, anchor_block string, size int, a_ids array<long>, a_labels binary, a_vectors binary"


def bit_planes(values: np.ndarray) -> tuple[np.ndarray, int]:
    """(bits, groups, rows) bytes of integer rows in two's complement, and the number of bits; the highest plane is the sign."""
    low, high = int(values.min()), int(values.max())
    bits = 1 + max((~low if low < 0 else low).bit_length(), (~high if high < 0 else high).bit_length())
    width = -(-values.shape[1] // 8) * 8
    padded = np.zeros((len(values), width), np.int64)
    padded[:, :values.shape[1]] = values
    planes = [np.packbits((padded >> p) & 1 == 1, axis=1, bitorder="little").T for p in range(bits)]
    return np.ascontiguousarray(np.stack(planes)), bits


def subset_sums(anchors: np.ndarray, dtype=np.int64) -> np.ndarray:
    """(groups, 256, anchors): the sums of all subsets of each eight components, each from a smaller one by one addition."""
    groups = -(-anchors.shape[1] // 8)
    padded = np.zeros((groups * 8, len(anchors)), dtype)
    padded[:anchors.shape[1]] = anchors.T
    tables = np.zeros((groups, 256, len(anchors)), dtype)
    for j in range(8):
        tables[:, 1 << j:2 << j] = tables[:, :1 << j] + padded[j::8][:, None]
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(rows, anchors): exact inner products by lookups, from the highest plane down."""
    total = np.zeros((planes.shape[2], tables.shape[2]), tables.dtype)
    found = np.empty_like(total)
    for plane in reversed(range(len(planes))):
        total <<= 1
        for table, index in zip(tables, planes[plane]):
            np.take(table, index, axis=0, out=found, mode="clip")
            if plane == len(planes) - 1:
                total -= found
            else:
                total += found
    return total


def best(values: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each column's k highest allowed values; of equal ones, the rows of smaller ids."""
    held = np.where(allowed, values, np.iinfo(values.dtype).min)
    floor = np.partition(held, len(held) - k, axis=0)[len(held) - k] if len(held) > k else held.min(axis=0, initial=0)
    row, column = np.nonzero((held >= floor) & allowed)
    order = np.lexsort((ids[row], -held[row, column].astype(np.int64), column))
    row, column = row[order], column[order]
    first = np.searchsorted(column, column)
    kept = np.arange(len(column)) - first < k
    return row[kept], column[kept]


class Block:
    """A row of packed candidates."""

    def __init__(self, row):
        self.ids, self.labels = unpack(row.ids, np.int64), unpack(row.labels, np.int64)
        self.planes = np.frombuffer(row.planes, np.uint8).reshape(row.bits, -1, len(self.ids))

    def ranges(self, label: int, same: bool) -> list[tuple[int, int]]:
        """Ranges of the rows with the label, or of all others."""
        start, end = np.searchsorted(self.labels, [label, label + 1])
        parts = [(int(start), int(end))] if same else [(0, int(start)), (int(end), len(self.labels))]
        return [(s, min(s + TILE, e)) for start, e in parts for s in range(start, e, TILE)]


class Anchors:
    """A row of packed anchors, in order of (label, id)."""

    def __init__(self, row):
        self.ids, self.labels = np.asarray(row.a_ids, np.int64), unpack(row.a_labels, np.int64)
        self.vectors = unpack(row.a_vectors, np.int64).reshape(len(self.ids), -1)

    def tiles(self) -> Iterator[tuple[int, slice]]:
        """(label, slice) of anchors with one label."""
        edges = [0, *(np.flatnonzero(np.diff(self.labels)) + 1).tolist(), len(self.labels)]
        for start, end in zip(edges, edges[1:]):
            for s in range(start, end, ANCHOR_TILE):
                yield int(self.labels[start]), slice(s, min(s + ANCHOR_TILE, end))


def _check(anchors: Anchors, block: Block):
    """The narrowest type in which every score of the pair is exact."""
    largest = float(np.abs(anchors.vectors.astype(np.float64)).max()) * 2.0 ** (len(block.planes) - 1) * block.planes.shape[1] * 8
    if largest >= 2.0**62:
        raise ValueError("a score may not fit into 64 bits")
    return np.int32 if largest < 2.0**30 else np.int64


def _meet(anchors: Anchors, block: Block, same: bool) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(anchors, rows of the block, scores) of all tiles of equal labels, or of all others."""
    dtype = _check(anchors, block)
    for label, part in anchors.tiles():
        ranges = block.ranges(label, same)
        if ranges:
            tables = subset_sums(anchors.vectors[part], dtype)
            for start, end in ranges:
                yield part, np.arange(start, end), scores(tables, block.planes[:, :, start:end])


BEST = ["anchor_id", "slot", "vec_id", "score"]


def _merged(parts: list[np.ndarray], k: int) -> pd.DataFrame:
    """The k best of all tiles per (anchor, slot), ties to the smaller id."""
    anchor, slot, vec_id, score = np.concatenate(parts, axis=1)
    order = np.lexsort((vec_id, -score, slot, anchor))
    new = np.flatnonzero((np.diff(anchor[order], prepend=-1) != 0) | (np.diff(slot[order], prepend=-1) != 0)) if len(order) else order
    starts = np.repeat(new, np.diff(np.append(new, len(order))))
    order = order[np.arange(len(order)) - starts < k]
    return pd.DataFrame(dict(zip(BEST, (x[order] for x in (anchor, slot, vec_id, score)))))


def positives(anchors: Anchors, block: Block, k: int) -> pd.DataFrame:
    """The block's k best rows of each anchor's label."""
    out = [np.zeros((4, 0), np.int64)]
    for part, rows, found in _meet(anchors, block, True):
        row, column = best(found, block.ids[rows][:, None] != anchors.ids[part], block.ids[rows], k)
        out.append(np.stack([anchors.ids[part][column], np.zeros(len(row), np.int64), block.ids[rows[row]],
                             found[row, column].astype(np.int64)]))
    return _merged(out, k)


def negatives(anchors: Anchors, block: Block, wanted: np.ndarray, k: int, low: int, high: int) -> pd.DataFrame:
    """The block's k best rows within the range of every (anchor, slot of a positive); ``wanted`` has the positives' scores."""
    out = [np.zeros((4, 0), np.int64)]
    for part, rows, found in _meet(anchors, block, False):
        other = block.ids[rows][:, None] != anchors.ids[part]
        for slot in range(wanted.shape[1]):
            p = wanted[part, slot]
            # the least and the greatest allowed score, rounded to integers without a product that overflows
            hundreds, rest = p // 100, p % 100
            least, most = low * hundreds - (-low * rest) // 100, high * hundreds + high * rest // 100
            allowed = (found >= least) & (found <= most) & (p != NONE) & other
            if allowed.any():
                row, column = best(found, allowed, block.ids[rows], k)
                out.append(np.stack([anchors.ids[part][column], np.full(len(row), slot), block.ids[rows[row]],
                                     found[row, column].astype(np.int64)]))
    return _merged(out, k)


#: Marks a slot without a positive; scores are below 2**62.
NONE = -(2**62)


def usable(vectors: DataFrame, label: Column, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, label, v): components times ``scale``, rounded down; rows that take no part are left out."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    raw = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    kept = raw.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND size(v) > 0").where(finite)
    return kept.withColumn("v", F.transform("v", lambda x: F.floor(x * scale)))


def _frames(batches: Iterator[pd.DataFrame], limit: int) -> Iterator[tuple[int, pd.DataFrame]]:
    """Rows regrouped by the length of their vectors, up to ``limit`` rows each, ordered by (label, vec_id)."""
    held: dict[int, list[pd.DataFrame]] = {}
    for batch in batches:
        for size, frame in batch.groupby(batch["v"].map(len)):
            held.setdefault(size, []).append(frame)
            while sum(map(len, held[size])) >= limit:
                whole = pd.concat(held[size])
                held[size] = [whole[limit:]]
                yield size, whole[:limit].sort_values(["label", "vec_id"], kind="stable")
    for size, frames in held.items():
        if sum(map(len, frames)):
            yield size, pd.concat(frames).sort_values(["label", "vec_id"], kind="stable")


def index(rows: DataFrame, limit: int) -> DataFrame:
    """Packed candidates, one row a block, written to the shared folder; rows stay where they were read."""

    def form(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        for i, (size, frame) in enumerate(_frames(batches, limit)):
            planes, bits = bit_planes(np.stack(frame["v"].to_numpy()))
            yield pd.DataFrame({
                "number": [part + i], "size": [size], "bits": [bits], "ids": [pack(frame["vec_id"].to_numpy(), np.int64)],
                "labels": [pack(frame["label"].to_numpy(), np.int64)], "planes": [planes.tobytes()]})

    return stage_table(rows.mapInPandas(form, PACKED), "planes", large_rows=True)


def anchor_blocks(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """Packed anchors, one per id, written to the shared folder."""

    def form(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        for i, (size, frame) in enumerate(_frames(batches, ANCHORS)):
            yield pd.DataFrame({
                "number": [part + i], "anchor_block": [f"{part}-{i}"], "size": [size], "a_ids": [frame["vec_id"].to_numpy(np.int64)],
                "a_labels": [pack(frame["label"].to_numpy(), np.int64)],
                "a_vectors": [pack(np.stack(frame["v"].to_numpy()).reshape(-1), np.int64)]})

    one = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("v", "label")).alias("m")).select("vec_id", "m.label", "m.v")
    return stage_table(one.mapInPandas(form, ANCHOR_ROWS), "anchors", large_rows=True)


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None, n_positives: int = 5, k: int = 3, low: int = 50,
         high: int = 95, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of every anchor and positive."""
    rows = stage_table(usable(vectors, F.col("label") if label is None else label, vec_id, vector, scale), "vectors")
    limit = min(block, max(LEAST, rows.count() // shards(vectors.sparkSession) + 1))
    data, anchors = index(rows, limit), anchor_blocks(rows, is_anchor)

    def meeting(k: int, work):
        """The k best of a group of candidates per (anchor, slot); ``work`` finds those of a block."""
        def run(size: int, asked: pd.DataFrame, here: pd.DataFrame) -> pd.DataFrame:
            blocks = [Block(row) for row in here.itertuples()]
            out = [_merged([np.zeros((4, 0), np.int64)], k)]
            for row in asked.itertuples():
                of = Anchors(row)
                found = [work(row, of, b)[BEST].to_numpy(np.int64).T for b in blocks]
                out.append(_merged([np.zeros((4, 0), np.int64), *found], k))
            return pd.concat(out)

        return run

    # the stated anchors against all rows, group by group
    best_of = "anchor_id long, slot int, vec_id long, score long"
    found = met(anchors, data, ANCHOR_GROUP, GROUP, meeting(n_positives, lambda row, of, b: positives(of, b, n_positives)), best_of)
    slot = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")) - 1
    first = stage_table(found.withColumn("slot", slot).where(F.col("slot") < n_positives), "positives")

    # the scores of an anchor's positives go back into the order of its block
    places = anchors.select("anchor_block", F.posexplode("a_ids").alias("place", "anchor_id"))
    listed = places.join(first, "anchor_id").groupBy("anchor_block").agg(F.collect_list(F.struct("place", "slot", "score")).alias("w")).select(
        "anchor_block", F.col("w.place").alias("places"), F.col("w.slot").alias("slots"), F.col("w.score").alias("wanted"))
    again = stage_table(anchors.join(listed, "anchor_block"), "again", large_rows=True)

    def second(row, of: Anchors, block: Block) -> pd.DataFrame:
        wanted = np.full((len(of.ids), n_positives), NONE, np.int64)
        wanted[row.places, row.slots] = row.wanted
        return negatives(of, block, wanted, k, low, high)

    hard = met(again, data, ANCHOR_GROUP, GROUP, meeting(k, second), best_of)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id"))
    kept = hard.withColumn("rank", rank).where(F.col("rank") <= k)
    of = first.select("anchor_id", "slot", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return kept.join(of, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))

