"""Regression forests that grow level by level, on tables of rows and nodes.

A row's weight in a tree is a Poisson draw from a hash of (seed, tree, id), and a node draws its features from a hash of its name, so
a forest depends on the rows alone, not on partitions, cores or order. A node is named by its path: '' is the root, '0' and '1'
append the left and the right side.

Growth has two phases with the same rule of splitting. Rows lie in packed blocks, with their weights in all trees. While a node has
more than ``local_rows`` rows, a task descends its blocks through the splits so far and adds up histograms by (tree, node), which one
group per node turns into a split. Smaller nodes are the whole work of one task each: every block sends them its rows as one packed
message, and the subtree is grown with numpy to any depth. No split, level or label passes through the driver's Python; a block is
joined with the splits of the large nodes, which are few.

A split maximises sl**2 / nl + sr**2 / nr (sums and weights of the two sides) and must gain. Ties go to the first feature and the lowest bin.
A text column is one feature: its levels are put in order of their mean target in the node, and a split takes the first of them;
a level that the node does not have goes right. Sums of whole-numbered targets are exact, so the same forest comes out bit for bit in both phases.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylens.models.binning import Binning, unpacked
from paylens.session import stage_table
from paylens.sources import writers

#: Rows of a node that one task grows to the end, and rows that are predicted in one piece.
LOCAL_ROWS = 200_000
#: Rows of a block, on average, and bytes of the sums over blocks that a task holds.
BLOCK_ROWS = 32_768
SUM_BYTES = 256_000_000
#: Cells a row may have in a full histogram, on average, before sorting the rows is cheaper.
DENSE = 1
_LOW = 0xFFFFFFFF


def poisson_limits() -> list[int]:
    """The draw is the number of limits at or below a hash of 32 bits: a Poisson distribution of mean 1."""
    total, out = 0.0, []
    for k in range(13):
        total += math.exp(-1) / math.factorial(k)
        out.append(int(total * 2**32))
    return [x for x in out if x < 2**32]


def drawn_features(seed: int, tree: int, path: str, names: Sequence[str], k: int) -> list[int]:
    """The node's ``k`` features: those of the lowest hashes."""
    keys = [hashlib.md5(f"{seed}:{tree}:{path}:{n}".encode()).hexdigest() for n in names]
    return sorted(range(len(names)), key=keys.__getitem__)[:k]


@dataclass(frozen=True)
class Spec:
    """What growth needs to know; travels with every task."""

    names: tuple[str, ...]
    sizes: tuple[int, ...]
    n_text: int
    max_depth: int | None
    per_node: int | None
    seed: int

    @property
    def n_numeric(self) -> int:
        return len(self.names) - self.n_text

    @property
    def text_size(self) -> int:
        """Bins of the text column that has most."""
        return max(self.sizes[self.n_numeric:], default=0)

    def is_text(self, feature: int) -> bool:
        return feature >= self.n_numeric

    def allowed(self, tree: int, paths: Sequence[str] | None, n: int) -> np.ndarray | None:
        """(nodes, features) that may be split on; None for all."""
        if self.per_node is None or self.per_node >= len(self.names):
            return None
        out = np.zeros((n, len(self.names)), bool)
        for i, path in enumerate(paths):
            out[i, drawn_features(self.seed, tree, path, self.names, self.per_node)] = True
        return out


class Splits:
    """The best split of each of some nodes, one feature after another."""

    def __init__(self, n: np.ndarray, s: np.ndarray, spec: Spec, allowed: np.ndarray | None):
        self.n, self.s, self.spec, self.allowed = n, s, spec, allowed
        self.score = np.full(len(n), -np.inf)
        self.feature = np.full(len(n), -1, np.int16)
        #: the last bin that goes left, of a number; the bins that go left, of a text
        self.cut = np.zeros(len(n), np.uint8)
        self.mask = np.zeros((len(n), spec.text_size), bool)

    def _scores(self, n: np.ndarray, s: np.ndarray, nl: np.ndarray, sl: np.ndarray) -> np.ndarray:
        nr, sr = n - nl, s - sl
        with np.errstate(invalid="ignore"):
            return np.where((nl > 0) & (nr > 0), sl * sl / np.maximum(nl, 1) + sr * sr / np.maximum(nr, 1), -np.inf)

    def add(self, feature: int, n: np.ndarray, s: np.ndarray) -> None:
        """Weights and sums (nodes, bins) of one feature."""
        order = None
        if self.spec.is_text(feature):
            mean = np.where(n > 0, s / np.maximum(n, 1), np.inf)
            order = np.argsort(mean, axis=1, kind="stable")
            n, s = np.take_along_axis(n, order, 1), np.take_along_axis(s, order, 1)
        score = self._scores(self.n[:, None], self.s[:, None], np.cumsum(n, axis=1), np.cumsum(s, axis=1))
        score[n <= 0] = -np.inf
        if self.allowed is not None:
            score[~self.allowed[:, feature]] = -np.inf
        place = score.argmax(axis=1)
        best = score[np.arange(len(score)), place]
        better = np.flatnonzero(best > self.score)
        self.score[better], self.feature[better] = best[better], feature
        if order is None:
            self.cut[better] = place[better]
        else:
            mask = np.zeros((len(better), self.spec.text_size), bool)
            np.put_along_axis(mask, order[better], np.arange(n.shape[1]) <= place[better, None], 1)
            self.mask[better] = mask

    def add_cells(self, feature: int, node: np.ndarray, b: np.ndarray, n: np.ndarray, s: np.ndarray) -> None:
        """The same from the cells that have rows, ordered by node and bin: a node costs its cells, not all bins."""
        if self.spec.is_text(feature):
            order = _in_order(node, s / n)
            b, n, s = b[order], n[order], s[order]
        fresh = np.concatenate([[True], node[1:] != node[:-1]])
        starts, part = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        here, upto_n, upto_s = node[starts], np.cumsum(n), np.cumsum(s)
        before_n, before_s = upto_n[starts] - n[starts], upto_s[starts] - s[starts]
        score = self._scores(self.n[node], self.s[node], upto_n - before_n[part], upto_s - before_s[part])
        best = np.maximum.reduceat(score, starts)
        at_best = np.flatnonzero(score == best[part])
        of = part[at_best]
        first = at_best[np.concatenate([[True], of[1:] != of[:-1]])]
        better = best > self.score[here]
        nodes = here[better]
        self.score[nodes], self.feature[nodes] = best[better], feature
        if self.spec.is_text(feature):
            left = better[part] & (np.arange(len(node)) <= first[part])
            self.mask[nodes] = False
            self.mask[node[left], b[left]] = True
        else:
            self.cut[nodes] = b[first[better]]

    def done(self) -> np.ndarray:
        """Gains; where there is none, the node is a leaf."""
        with np.errstate(invalid="ignore"):
            gain = self.score - self.s * self.s / self.n
        self.feature[~(gain > 0)] = -1
        return np.where(gain > 0, gain, 0.0)


NODES = "feature binary, cut binary, mask binary, n binary, s binary"


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, path: str, spec: Spec) -> dict:
    """A subtree over some rows, bins as (features, rows): packed arrays in order of levels.

    ``cut`` and ``mask`` have inner nodes only, of numbers and of texts. The j-th inner node has the children 2j + 1 and 2j + 2.
    """
    features, cuts, masks, weights, sums = [], [], [], [], []
    rows, at, wy = np.arange(len(y)), np.zeros(len(y), np.int64), w * y
    k, depth = 1, len(path)
    paths = [path] if spec.per_node is not None else None
    while k:
        here_w, here_wy, targets = w[rows], wy[rows], y[rows]
        n, s = np.bincount(at, here_w, k), np.bincount(at, here_wy, k)
        allowed = spec.allowed(tree, paths, k)
        best = Splits(n, s, spec, allowed)
        # every node has rows, in one piece; a node with one target has no split
        starts = _starts(at)
        mixed = (np.minimum.reduceat(targets, starts) < np.maximum.reduceat(targets, starts))[at]
        rows, at = rows[mixed], at[mixed]
        if len(rows) and (spec.max_depth is None or depth < spec.max_depth):
            _best_splits(best, bins, rows, at, here_w[mixed], here_wy[mixed])
        best.done()
        inner = best.feature >= 0
        text = best.feature >= spec.n_numeric
        for out, new in ((features, best.feature), (cuts, best.cut[inner & ~text]), (masks, np.packbits(best.mask[text], axis=1)),
                         (weights, n.astype(np.int64)), (sums, s)):
            out.append(new)
        moved = inner[at]
        rows, at = rows[moved], at[moved]
        feature = best.feature[at]
        b = bins[feature, rows]
        right = b > best.cut[at]
        of_text = np.flatnonzero(feature >= spec.n_numeric)
        right[of_text] = ~best.mask[at[of_text], b[of_text]]
        order = np.sort((2 * (np.cumsum(inner) - 1)[at] + right) << 32 | np.arange(len(at)))
        rows, at = rows[order & _LOW], order >> 32
        if paths is not None:
            paths = [paths[i] + side for i in np.flatnonzero(inner) for side in "01"]
        k, depth = 2 * int(inner.sum()), depth + 1
    packed = zip(("feature", "cut", "mask", "n", "s"), (features, cuts, masks, weights, sums))
    return {name: np.concatenate(parts).tobytes() for name, parts in packed}


def _best_splits(best: Splits, bins: np.ndarray, rows: np.ndarray, at: np.ndarray, w: np.ndarray, wy: np.ndarray) -> None:
    """All features of the rows' nodes, rows of a node side by side: as full histograms while nodes have rows in most bins, else by the cells in use.

    In small nodes most features have one bin, and so no split; their rows are left out before anything is sorted.
    """
    spec, k = best.spec, len(best.n)
    begins = _starts(at)
    for f, size in enumerate(spec.sizes):
        node, b, fw, fwy, starts = at, bins[f][rows], w, wy, begins
        if best.allowed is not None:
            some = np.flatnonzero(best.allowed[at, f])
            if not len(some):
                continue
            node, b, fw, fwy = at[some], b[some], w[some], wy[some]
            starts = _starts(node)
        if k * size <= DENSE * len(node) + 1000:
            cell = node * size + b
            best.add(f, np.bincount(cell, fw, k * size).reshape(k, size), np.bincount(cell, fwy, k * size).reshape(k, size))
            continue
        mixed = np.minimum.reduceat(b, starts) < np.maximum.reduceat(b, starts)
        some = np.flatnonzero(np.repeat(mixed, np.diff(starts, append=len(node))))
        if not len(some):
            continue
        order = np.sort((node[some] << 8 | b[some]) << 32 | some)
        cell, order = order >> 32, order & _LOW
        starts = _starts(cell)
        cell = cell[starts]
        best.add_cells(f, cell >> 8, cell & 255, np.add.reduceat(fw[order], starts), np.add.reduceat(fwy[order], starts))


def _starts(ascending: np.ndarray) -> np.ndarray:
    """Where each value of an ascending array begins."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(ascending)), bool), ascending[1:] != ascending[:-1]]))


def _in_order(node: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Places by node, value and place, as one sort of whole numbers each for the values' ranks and the result."""
    n, bits = len(node), max(1, (len(node) - 1).bit_length())
    by_value = np.argsort(value)
    ascending = value[by_value]
    rank = np.empty(n, np.int64)
    rank[by_value] = np.cumsum(np.concatenate([[0], ascending[1:] != ascending[:-1]]))
    if int(node[-1]).bit_length() + 2 * bits > 63:
        return np.lexsort((rank, node))
    return np.sort((node << bits | rank) << bits | np.arange(n)) & ((1 << bits) - 1)


class Subtree:
    """Packed arrays of ``grow``, unpacked."""

    def __init__(self, row, spec: Spec):
        self.feature = np.frombuffer(row.feature, np.int16)
        self.n, self.s = np.frombuffer(row.n, np.int64).astype(np.float64), np.frombuffer(row.s, np.float64)
        inner, text = self.feature >= 0, self.feature >= spec.n_numeric
        self.child = np.where(inner, 2 * np.cumsum(inner) - 1, 0)
        self.cut = np.zeros(len(inner), np.uint8)
        self.cut[inner & ~text] = np.frombuffer(row.cut, np.uint8)
        self.text, self.place = text, np.cumsum(text) - 1
        # a level that no split names goes right
        self.mask = np.zeros((int(text.sum()), 256), bool)
        if len(self.mask):
            self.mask[:, :spec.text_size] = np.unpackbits(np.frombuffer(row.mask, np.uint8).reshape(len(self.mask), -1), axis=1, count=spec.text_size)
        left = self.child[inner]
        self.gain = np.zeros(len(inner))
        sides = sum(self.s[c] * self.s[c] / self.n[c] for c in (left, left + 1))
        self.gain[inner] = sides - self.s[inner] * self.s[inner] / self.n[inner]

    def predict(self, bins: np.ndarray) -> np.ndarray:
        """Bins as (features, rows)."""
        out = np.zeros(bins.shape[1], np.int64)
        rows, at = np.arange(bins.shape[1]), out
        while len(rows):
            feature = self.feature[at]
            if (inner := feature >= 0).sum() < len(rows):
                out[rows[~inner]] = at[~inner]
                rows, at, feature = rows[inner], at[inner], feature[inner]
            b = bins[feature, rows]
            right = b > self.cut[at]
            of_text = np.flatnonzero(self.text[at])
            right[of_text] = ~self.mask[self.place[at[of_text]], b[of_text]]
            at = self.child[at] + right
        return self.s[out] / self.n[out]

    def masks(self) -> np.ndarray:
        """(nodes, 256): the bins that go left."""
        out = np.arange(256) <= self.cut[:, None]
        out[self.text] = self.mask
        out[self.feature < 0] = False
        return out

    def paths(self, root: str) -> list[str]:
        out = [root] * len(self.feature)
        for i in np.flatnonzero(self.feature >= 0):
            out[self.child[i]], out[self.child[i] + 1] = out[i] + "0", out[i] + "1"
        return out


TOP = "tree int, path string, feature int, mask binary, n double, s double, gain double, n_left double"


class Top:
    """The large nodes of one tree. ``feature`` is -1 for a leaf and -2 for a node that is still open."""

    def __init__(self, splits: dict, local_rows: int):
        self.paths, features, child, masks, large = [""], [], [], [], [True]
        for path in self.paths:
            feature, mask, n, n_left = splits.get(path, (-2, bytes(32), 0, 0))
            features.append(feature)
            masks.append(mask)
            child.append(len(self.paths))
            if feature >= 0:
                self.paths += [path + "0", path + "1"]
                large += [n_left > local_rows, n - n_left > local_rows]
        self.feature, self.child = np.array(features), np.array(child)
        self.mask = np.unpackbits(np.frombuffer(b"".join(masks), np.uint8).reshape(-1, 32), axis=1).astype(bool)
        self.large = np.array(large) & (self.feature == -2)

    def descend(self, bins: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The number of each row's node; bins as (features, rows)."""
        out = np.zeros(len(rows), np.int64)
        left = np.arange(len(rows))
        while len(left := left[self.feature[out[left]] >= 0]):
            at = out[left]
            out[left] = self.child[at] + ~self.mask[at, bins[self.feature[at], rows[left]]]
        return out


_TOP = ("tree", "path", "feature", "mask", "n", "n_left")


def _with_tops(blocks: DataFrame, tops: Sequence[DataFrame]) -> DataFrame:
    """Every block with the splits of all large nodes so far, which are fewer than the rows by a factor of ``local_rows``."""
    table = blocks.sparkSession.createDataFrame([], TOP)
    for splits in tops:
        table = table.unionByName(splits)
    listed = table.agg(F.collect_list(F.struct(*_TOP)).alias("_t")).select(*[F.col(f"_t.{c}").alias(f"t_{c}") for c in _TOP])
    return blocks.crossJoin(F.broadcast(listed))


def _each_block(batches: Iterator[pd.DataFrame], spec: Spec, num_trees: int, local_rows: int) -> Iterator[tuple]:
    """Blocks with their bins (features, rows) and the trees' large nodes; these are the same for all blocks."""
    trees = None
    for batch in batches:
        for r in batch.itertuples():
            if trees is None:
                splits = [{} for _ in range(num_trees)]
                for tree, path, *what in zip(*[getattr(r, f"t_{c}") for c in _TOP]):
                    splits[tree][path] = what
                trees = [Top(s, local_rows) for s in splits]
            yield r, np.frombuffer(r.bins, np.uint8).reshape(len(spec.names), -1), trees


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of a partition put together to blocks."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= 2 * BLOCK_ROWS:
            yield pd.concat(held)
            held, n = [], 0
    if n:
        yield pd.concat(held)


def _in_blocks(rows: DataFrame, by: str, n: int) -> DataFrame:
    return rows.repartition(max(1, math.ceil(n / BLOCK_ROWS)), by)


def _columns(frame: pd.DataFrame, packs: Sequence[str], spec: Spec) -> bytes:
    return np.ascontiguousarray(unpacked([frame[p].to_numpy() for p in packs], len(spec.names)).T).tobytes()


#: MD5's rotations and constants, and the state it starts from.
_TURNS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_STATE = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
#: Longest message of one block of MD5, and messages that are hashed together.
_ONE_BLOCK, _TOGETHER = 55, 8192


def _first_bits(words: Sequence[np.ndarray | None]) -> np.ndarray:
    """The first 32 bits of MD5, messages of one block side by side: 16 words, None for one that is zero in all."""
    a, b, c, d = (np.full(len(words[0]), x, np.uint32) for x in _STATE)
    for i in range(61):  # the last three steps do not change these bits
        if i < 16:
            f, g = d ^ (b & (c ^ d)), i
        elif i < 32:
            f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif i < 48:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * i % 16
        f += a
        f += np.uint32(_SINES[i])
        if words[g] is not None:
            f += words[g]
        by = _TURNS[i // 16][i % 4]
        a, d, c, b = d, c, b, b + (f << by | f >> (32 - by))
    return (b + np.uint32(_STATE[0])).byteswap()


def hashed(texts: Sequence[bytes], starts: Sequence[bytes]) -> np.ndarray:
    """(starts, texts): the first four bytes of MD5 of start and text, as a number. One call hashes thousands of texts; long ones go one by one."""
    out = np.empty((len(starts), len(texts)), np.uint32)
    sizes, widest = np.array([len(t) for t in texts], np.int64), max(map(len, starts), default=0)
    short = np.flatnonzero(sizes + widest <= _ONE_BLOCK)
    for i in np.flatnonzero(sizes + widest > _ONE_BLOCK):
        out[:, i] = [int.from_bytes(hashlib.md5(start + texts[i]).digest()[:4]) for start in starts]
    for at in range(0, len(short), _TOGETHER):
        rows = short[at:at + _TOGETHER]
        width = int(sizes[rows].max())
        padded = np.frombuffer(b"".join([texts[i].ljust(width, b"\0") for i in rows]), np.uint8).reshape(len(rows), width)
        moved: dict[int, list] = {}
        for k, start in enumerate(starts):
            n = len(start)
            if n not in moved:
                message = np.zeros((len(rows), 64), np.uint8)
                message[:, n:n + width] = padded
                message[np.arange(len(rows)), n + sizes[rows]] = 128
                message[:, 56:] = (8 * (n + sizes[rows])).astype("<u8")[:, None].view(np.uint8)
                moved[n] = list(np.ascontiguousarray(message.view("<u4").T))
            first = np.frombuffer(start.ljust(64, b"\0"), "<u4")
            out[k, rows] = _first_bits([w | x if x else w if j * 4 < n + width + 1 or j == 14 else None for j, (w, x) in enumerate(zip(moved[n], first))])
    return out


def weights(ids: Sequence[str | None], num_trees: int, seed: int) -> np.ndarray:
    """(trees, rows): how often a row is in each tree's bag."""
    limits = np.array(poisson_limits())
    known = [i is not None for i in ids]
    drawn = hashed([(i or "").encode() for i in ids], [f"{seed}:{tree}:".encode() for tree in range(num_trees)])
    return np.where(known, np.searchsorted(limits, drawn, side="right"), len(limits)).astype(np.uint8)


def _top_splits(blocks: DataFrame, spec: Spec, num_trees: int, local_rows: int) -> DataFrame:
    """The splits of all open large nodes: a task adds up the histograms of its blocks, then one group per node."""
    begins = np.concatenate([[0], np.cumsum(spec.sizes)])
    cells = int(begins[-1]) + 1

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        paths, allowed = {}, {}

        def out() -> Iterator[pd.DataFrame]:
            for tree, (n, s) in sums.items():
                yield pd.DataFrame({"tree": tree, "path": paths[tree], "n": [x.tobytes() for x in n], "s": [x.tobytes() for x in s]})
            sums.clear()

        for r, bins, trees in _each_block(batches, spec, num_trees, local_rows):
            all_w, y = np.frombuffer(r.w, np.uint8).reshape(num_trees, -1), np.frombuffer(r.y, np.float64)
            for tree, top in enumerate(trees):
                large = np.flatnonzero(top.large)
                if not len(large):
                    continue
                if tree not in paths:
                    paths[tree] = [top.paths[i] for i in large]
                    allowed[tree] = spec.allowed(tree, paths[tree], len(large))
                k, number = len(large), np.cumsum(top.large) - 1
                rows = np.flatnonzero(all_w[tree])
                at = top.descend(bins, rows)
                rows, at = rows[top.large[at]], number[at[top.large[at]]]
                w = all_w[tree][rows].astype(np.float64)
                wy = w * y[rows]
                if tree not in sums:
                    sums[tree] = np.zeros((2, k, cells))
                for total, value in zip(sums[tree], (w, wy)):
                    total[:, -1] += np.bincount(at, value, k)
                for f, size in enumerate(spec.sizes):
                    some = slice(None) if allowed[tree] is None else np.flatnonzero(allowed[tree][at, f])
                    cell = at[some] * size + bins[f][rows[some]]
                    for total, value in zip(sums[tree], (w, wy)):
                        total[:, begins[f]:begins[f + 1]] += np.bincount(cell, value[some], k * size).reshape(k, size)
            if sum(x.nbytes for x in sums.values()) > SUM_BYTES:
                yield from out()
        yield from out()

    def split(key, frame: pd.DataFrame) -> pd.DataFrame:
        n, s = (sum(np.frombuffer(b, np.float64) for b in frame[c])[None] for c in ("n", "s"))
        tree, path = key
        best = Splits(n[:, -1], s[:, -1], spec, spec.allowed(tree, [path], 1))
        if spec.max_depth is None or len(path) < spec.max_depth:
            for f in range(len(spec.names)):
                best.add(f, n[:, begins[f]:begins[f + 1]], s[:, begins[f]:begins[f + 1]])
        gain, f = best.done(), int(best.feature[0])
        mask, n_left = np.zeros(256, bool), 0.0
        if f >= 0:
            mask[:spec.sizes[f]] = best.mask[0, :spec.sizes[f]] if spec.is_text(f) else np.arange(spec.sizes[f]) <= best.cut[0]
            n_left = float(n[0, begins[f]:begins[f + 1]][mask[:spec.sizes[f]]].sum())
        return pd.DataFrame({"tree": [tree], "path": [path], "feature": [f], "mask": [np.packbits(mask).tobytes()], "n": best.n,
                             "s": best.s, "gain": gain, "n_left": [n_left]})

    parts = blocks.mapInPandas(count, "tree int, path string, n binary, s binary")
    return parts.groupBy("tree", "path").applyInPandas(split, TOP)


def _runs(at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(node, places) of every node that occurs."""
    order = np.argsort(at, kind="stable")
    found, starts = np.unique(at[order], return_index=True)
    yield from zip(found.tolist(), np.split(order, starts[1:]))


@dataclass
class Forest:
    """A fitted forest: bins, the splits of large nodes level by level, and packed subtrees below them."""

    binning: Binning
    spec: Spec
    num_trees: int
    tops: list[DataFrame]
    subtrees: DataFrame
    local_rows: int

    def predict(self, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` and ``y_pred``, the mean over all trees; ``keep`` must name a row. A tree with an empty bag has no vote.

        Blocks of rows send each subtree the rows that reach it as one packed message; its answers go back to the blocks.
        """
        spec, packs, num_trees, local_rows = self.spec, self.binning.packs, self.num_trees, self.local_rows
        placed = stage_table(self.binning.transform(rows, keep).withColumn("_row", F.monotonically_increasing_id()), "asked")

        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in _merged(batches):
                ids = frame["_row"].to_numpy(np.int64)
                yield pd.DataFrame({"block": ids[:1], "ids": [ids.tobytes()], "bins": [_columns(frame, packs, spec)]})

        blocks = _in_blocks(placed.select("_row", *packs), "_row", placed.count()).mapInPandas(pack, "block long, ids binary, bins binary")
        blocks = stage_table(blocks, "blocks")
        with_tops = _with_tops(blocks.drop("ids"), self.tops)

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for _, bins, trees in _each_block(batches, spec, num_trees, local_rows):
                for tree, top in enumerate(trees):
                    n = np.bincount(top.descend(bins, np.arange(bins.shape[1])), minlength=len(top.paths))
                    yield pd.DataFrame({"tree": tree, "path": top.paths, "n": n})

        def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for r, bins, trees in _each_block(batches, spec, num_trees, local_rows):
                for tree, top in enumerate(trees):
                    at = top.descend(bins, np.arange(bins.shape[1]))
                    yield pd.DataFrame([(tree, top.paths[i], r.block, rows.astype(np.int32).tobytes(), bins[:, rows].tobytes())
                                        for i, rows in _runs(at)], columns=["tree", "path", "block", "places", "bins"])

        def score(key, frame: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
            out = frame[["block", "tree", "places"]].assign(value=None)
            if len(frame) and len(tree):
                subtree = Subtree(next(tree.itertuples()), spec)
                out["value"] = [subtree.predict(np.frombuffer(b, np.uint8).reshape(len(spec.names), -1)).tobytes() for b in frame["bins"]]
            return out.dropna()

        # groups of bounded size: a subtree is copied for as many pieces as its rows fill
        counts = with_tops.mapInPandas(count, "tree int, path string, n long").groupBy("tree", "path").agg(F.sum("n").alias("n")).where("n > 0")
        counts = stage_table(counts.select("tree", "path", F.ceil(F.col("n") / (4 * local_rows)).alias("pieces")), "counts")
        asked = with_tops.mapInPandas(ask, "tree int, path string, block long, places binary, bins binary")
        asked = asked.join(counts, ["tree", "path"]).withColumn("piece", F.pmod(F.xxhash64("block"), F.col("pieces"))).drop("pieces")
        copies = self._all_subtrees().join(counts, ["tree", "path"]).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        by = ("tree", "path", "piece")
        values = asked.groupBy(*by).cogroup(copies.drop("pieces").groupBy(*by)).applyInPandas(
            score, "block long, tree int, places binary, value binary")

        def mean(key, frame: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
            ids = np.frombuffer(block["ids"].iloc[0], np.int64)
            total, votes = np.zeros(len(ids)), np.zeros(len(ids))
            for r in frame.sort_values("tree", kind="stable").itertuples():
                places = np.frombuffer(r.places, np.int32)
                total[places] += np.frombuffer(r.value, np.float64)
                votes[places] += 1
            voted = votes > 0
            return pd.DataFrame({"_row": ids[voted], "y_pred": total[voted] / votes[voted]})

        scored = values.groupBy("block").cogroup(blocks.select("block", "ids").groupBy("block")).applyInPandas(mean, "_row long, y_pred double")
        return placed.join(scored, "_row", "left").groupBy(*keep).agg(F.avg("y_pred").alias("y_pred"))

    def _all_subtrees(self) -> DataFrame:
        """The subtrees and, as subtrees of one node, the leaves among the large nodes."""
        def leaf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({
                    "tree": b["tree"], "path": b["path"], "feature": np.int16(-1).tobytes(), "cut": b"", "mask": b"",
                    "n": [np.int64(x).tobytes() for x in b["n"]], "s": [np.float64(x).tobytes() for x in b["s"]]})

        out = self.subtrees
        for splits in self.tops:
            out = out.unionByName(splits.where("feature < 0").mapInPandas(leaf, f"tree int, path string, {NODES}"))
        return out

    def save(self, path: str) -> str:
        """Everything as Parquet tables below ``path``."""
        tables = {"subtrees": self.subtrees} | {f"levels_{c}": t for c, t in self.binning.levels.items()}
        tables |= {"edges": self.binning.edges} if self.binning.numeric else {}
        tables |= {f"top_{i}": t for i, t in enumerate(self.tops)}
        settings = asdict(self.spec) | {"numeric": self.binning.numeric, "text": self.binning.text, "num_trees": self.num_trees,
                                        "tops": len(self.tops), "local_rows": self.local_rows}
        tables["settings"] = self.subtrees.sparkSession.createDataFrame([(json.dumps(settings),)], "settings string")
        for name, table in tables.items():
            writers.write_parquet(table, f"{path}/{name}")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Forest:
        """A forest saved by ``save``."""
        def table(name: str) -> DataFrame:
            return spark.read.parquet(f"{path}/{name}")

        of = json.loads(table("settings").first().settings)
        binning = Binning(of["numeric"], of["text"], table("edges") if of["numeric"] else None, {c: table(f"levels_{c}") for c in of["text"]})
        spec = Spec(tuple(of["names"]), tuple(of["sizes"]), of["n_text"], of["max_depth"], of["per_node"], of["seed"])
        return cls(binning, spec, of["num_trees"], [table(f"top_{i}") for i in range(of["tops"])], table("subtrees"), of["local_rows"])

    def nodes(self) -> DataFrame:
        """(tree, path, feature, edge, bins, n, prediction, gain): every node; leaves have no feature.

        A split on a number sends values up to ``edge`` left, a split on text the levels in ``bins``.
        """
        spec, names = self.spec, list(self.spec.names)

        def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for r in batch.itertuples():
                    t = Subtree(r, spec)
                    mask = np.packbits(t.masks(), axis=1)
                    yield from _listed([r.tree] * len(t.feature), t.paths(r.path), t.feature, mask, t.n, t.s, t.gain, names, spec)

        def top(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    mask = np.stack([np.frombuffer(m, np.uint8) for m in b["mask"]])
                    yield from _listed(b["tree"], b["path"], b["feature"].to_numpy(), mask, b["n"], b["s"], b["gain"], names, spec)

        schema = "tree int, path string, feature string, bin int, bins array<int>, n double, prediction double, gain double"
        out = self.subtrees.mapInPandas(listed, schema)
        for splits in self.tops:
            out = out.unionByName(splits.mapInPandas(top, schema))
        if not self.binning.numeric:
            return out.withColumn("edge", F.lit(None).cast("double")).drop("bin")
        place = F.row_number().over(Window.partitionBy("feature").orderBy("edge")) - 1
        edges = self.binning.edges.select("feature", place.alias("bin"), "edge")
        return out.join(edges, ["feature", "bin"], "left").drop("bin").select(
            "tree", "path", "feature", "edge", "bins", "n", "prediction", "gain")

    def weights(self) -> DataFrame:
        """(feature, weight): each tree's gains by feature, as shares of the tree's gain, averaged over the trees."""
        spec, names = self.spec, list(self.spec.names)

        def gained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for r in batch.itertuples():
                    t = Subtree(r, spec)
                    inner = t.feature >= 0
                    yield pd.DataFrame({"tree": r.tree, "feature": names, "n": np.bincount(t.feature[inner], minlength=len(names)),
                                        "gain": np.bincount(t.feature[inner], t.gain[inner], len(names))})

        found = self.subtrees.mapInPandas(gained, "tree int, feature string, n long, gain double").where("n > 0").drop("n")
        for splits in self.tops:
            name = F.get(F.array(*map(F.lit, names)), F.col("feature"))
            found = found.unionByName(splits.where("feature >= 0").select("tree", name.alias("feature"), "gain"))
        gains = found.groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
        totals = gains.groupBy("tree").agg(F.sum("gain").alias("total"))
        shares = gains.join(totals, "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("total")).alias("share"))
        every = gains.sparkSession.createDataFrame([(n,) for n in self.spec.names], "feature string")
        whole = shares.agg(F.sum("share")).scalar()
        return every.join(shares, "feature", "left").withColumn("whole", whole).select(
            "feature", F.coalesce(F.col("share") / F.col("whole"), F.lit(0.0)).alias("weight"))


def _listed(tree, path, feature, mask, n, s, gain, names, spec) -> Iterator[pd.DataFrame]:
    bits = np.unpackbits(mask, axis=1).astype(bool)
    text = [f >= 0 and spec.is_text(int(f)) for f in feature]
    yield pd.DataFrame({
        "tree": tree, "path": path, "feature": [names[f] if f >= 0 else None for f in feature],
        "bin": pd.array([None if f < 0 or t else int(b.sum()) - 1 for f, t, b in zip(feature, text, bits)], "Int32"),
        "bins": [np.flatnonzero(b).tolist() if t else None for t, b in zip(text, bits)],
        "n": n, "prediction": np.asarray(s) / np.asarray(n), "gain": gain})


def fit(
    train: DataFrame, numeric: Sequence[str], text: Sequence[str], target: str, id_col: str, num_trees: int = 100,
    max_depth: int | None = None, per_node: int | None = None, seed: int = 42, local_rows: int = LOCAL_ROWS,
) -> Forest:
    """Grow a forest on complete rows; ``max_depth=None`` is no limit, ``per_node`` the number of features a node draws (all by default)."""
    binning = Binning.fit(train, numeric, text, target)
    spec = Spec(tuple(binning.names), tuple(binning.sizes()), len(text), max_depth, per_node, seed)
    packs = binning.packs
    y = F.col(target).cast("double").alias("y")
    rows = stage_table(binning.transform(train.select(id_col, y, *binning.names), [F.col(id_col).cast("string").alias("id"), "y"]), "binned")
    n_rows = rows.count()
    forest = Forest(binning, spec, num_trees, [], None, local_rows)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _merged(batches):
            drawn = weights(frame["id"].tolist(), num_trees, seed)
            yield pd.DataFrame({"bins": [_columns(frame, packs, spec)], "y": [frame["y"].to_numpy(np.float64).tobytes()], "w": [drawn.tobytes()]})

    blocks = stage_table(_in_blocks(rows, "id", n_rows).mapInPandas(pack, "bins binary, y binary, w binary"), "blocks")

    # no bag has more different rows than the table
    more = n_rows > local_rows
    while more:
        # leaves among the large nodes leave the frontier; all others get smaller with every level
        splits = stage_table(_top_splits(_with_tops(blocks, forest.tops), spec, num_trees, local_rows), "splits")
        forest.tops.append(splits)
        more = not splits.where((F.col("feature") >= 0) & (F.greatest("n_left", F.col("n") - F.col("n_left")) > local_rows)).isEmpty()

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r, bins, trees in _each_block(batches, spec, num_trees, local_rows):
            all_w, target_values = np.frombuffer(r.w, np.uint8).reshape(num_trees, -1), np.frombuffer(r.y, np.float64)
            for tree, top in enumerate(trees):
                bag = np.flatnonzero(all_w[tree])
                at = top.descend(bins, bag)
                found = [(tree, top.paths[i], bag[places]) for i, places in _runs(at) if top.feature[i] == -2]
                yield pd.DataFrame(
                    [(t, p, bins[:, x].tobytes(), target_values[x].tobytes(), all_w[t][x].tobytes()) for t, p, x in found],
                    columns=["tree", "path", "bins", "y", "w"])

    def subtree(key, frame: pd.DataFrame) -> pd.DataFrame:
        bins = np.concatenate([np.frombuffer(b, np.uint8).reshape(len(spec.names), -1) for b in frame["bins"]], axis=1)
        drawn, targets = np.frombuffer(b"".join(frame["w"]), np.uint8), np.frombuffer(b"".join(frame["y"]), np.float64)
        packed = grow(bins, targets, drawn.astype(np.float64), key[0], key[1], spec)
        return pd.DataFrame({"tree": [key[0]], "path": [key[1]]} | {k: [v] for k, v in packed.items()})

    sent = _with_tops(blocks, forest.tops).mapInPandas(send, "tree int, path string, bins binary, y binary, w binary")
    forest.subtrees = stage_table(sent.groupBy("tree", "path").applyInPandas(subtree, f"tree int, path string, {NODES}"), "subtrees")
    return forest
