"""Line dedup by a segment-partition edit join.

All lines but blank ones take part. A line is dropped if an earlier one (by doc_id, then by place in the text) is
equal, or at most as many edits away (characters inserted, deleted or replaced) as ``EDITS`` allows
for the shorter of the two. With ``least``, only lines of so many characters take part, and all may differ by ``tau`` edits.

1. Equal lines are one from here on, known by 128 bits of their hash; their earliest occurrence stays.
2. A line of length l is split into tau + 1 segments. Two lines within tau edits share a segment: each line
   is indexed under its segments (with l and the segment's number) and probes, for every length from
   l - tau to l, the substrings that a segment of such a line can have moved to. Both sides travel
   as packed hashes, one array per block and shard; shards match them.
3. A pair that meets must also have similar sketches: the parities of its pairs of neighbouring characters in 64 bits, of
   which an edit changes four at most.
4. Pairs are verified once, by the bit-parallel banded algorithm for edit distance, many pairs at a time. The texts of the
   lines to verify are fetched by a second scan, through a bitmap of their ids of fixed size.
   In a round a line meets the next of its partners in every group, in the order of ids: the first ``k``, then ``GROWTH`` times as
   many. A line that is dropped needs no more; rounds go on until no partner of a kept line is left out. So the pairs of
   a round grow with the lines, not with a group's square.

Null and empty texts have no lines that take part; their rows stay. A null doc_id comes after all others. Documents of one
doc_id go by a hash of the text; rows that repeat doc_id and text are one document and keep the same lines. Only line feeds end a line.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.blocks import BLOCK_CHARS, blocks, columns, cut, mix, pack, pack_sorted, shards, texts_of, unpack, unpack_sorted
from paylens.session import stage_table

TAU = 2
#: (characters, edits): lines of so many characters and more may differ by one edit in twelve characters, up to ``TAU``.
EDITS = ((1, 0), (12, 1), (24, 2))
#: Partners that a line meets per group in the first round, and how they grow.
FIRST_ROUND, GROWTH = 64, 16
#: Bits of a key and of a line's id. Collisions only cost a verification.
KEY_BITS, ID_BITS = 48, 40
#: Bits of the bitmap of ids: 4 MB, however many lines there are.
BITMAP_BITS = 1 << 25
#: Characters hashed at a time.
PORTION = 500_000
#: Pairs verified together.
LANES = 2048

_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


class Rolling:
    """Hashes of any substrings of many lines, from sums of character times power; the caller mixes them."""

    def __init__(self, lines: list[str]):
        self.points = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
        self.lengths = np.fromiter(map(len, lines), np.int64, len(lines))
        self.starts = np.cumsum(self.lengths) - self.lengths
        weighted = mix(self.points) * _powers(_BASE, len(self.points))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weighted, dtype=np.uint64)])
        self.back = _powers(_INVERSE, len(self.points) + 1)

    def hashes(self, rows: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        s = self.starts[rows] + start
        return (self.sums[s + size] - self.sums[s]) * self.back[s]


def _segment(length: np.ndarray, i: int, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment i (from 0) of tau + 1; the longer ones come last."""
    size = length // (tau + 1)
    short = tau + 1 - (length - size * (tau + 1))
    return i * size + np.maximum(0, i - short), size + (i >= short)


def allowances(tau: int = TAU, least: int | None = None) -> tuple[tuple[int, int], ...]:
    """(characters, edits): lines from so many characters on may differ by so many edits."""
    out = tuple((n, min(e, tau)) for n, e in EDITS) if least is None else ((least, tau),)
    if any(e and 2 * e + 2 > n for n, e in out):
        raise ValueError("lines must be longer than twice the threshold")
    return out


def _bands(edits: tuple[tuple[int, int], ...]) -> list[tuple[int, int, int]]:
    """(edits, shortest, longest) of the lines that are joined together; a pair belongs to the band of its shorter line."""
    ends = [n - 1 + e for (n, _), (_, e) in zip(edits[1:], edits)] + [1 << 31]
    return [(e, n, end) for (n, e), end in zip(edits, ends) if e]


def segment_keys(r: Rolling, tau: int, shortest: int) -> tuple[np.ndarray, ...]:
    """Keys of the lines' segments, and of all substrings to probe: (key, row) for both.

    A probe tries lengths l from its own down to tau less, but not below ``shortest``, and in
    segment i the starts that leave at most i edits to its left and tau - i to its right.
    """
    rows = np.arange(len(r.lengths))
    index, probe = [], []
    for less in range(tau + 1):
        length = r.lengths - less
        for i in range(tau + 1):
            start, size = _segment(length, i, tau)
            tag = mix((length * (tau + 1) + i).astype(np.uint64))
            for move in range(max(-i, less - tau + i), min(i, less + tau - i) + 1):
                at = start + move
                ok = np.flatnonzero((length >= shortest) & (at >= 0) & (at + size <= r.lengths))
                key = mix(r.hashes(rows[ok], at[ok], size[ok]) ^ tag[ok])
                probe.append((key, rows[ok]))
                if not less and not move:
                    index.append((key, rows[ok]))
    both = lambda parts: (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    return *both(index), *both(probe)


def sketches(r: Rolling) -> np.ndarray:
    """Parities of each line's pairs of neighbouring characters, in 64 bits. Lines have two characters at least."""
    if not len(r.lengths):
        return np.zeros(0, np.uint64)
    pairs = mix(r.points[:-1].astype(np.uint64) << np.uint64(32) | r.points[1:].astype(np.uint64)) >> np.uint64(58)
    bits = np.append(np.uint64(1) << pairs, np.uint64(0))
    bits[r.starts[1:] - 1] = 0  # pairs that span two lines
    return np.bitwise_xor.reduceat(bits, r.starts)


def line_id(line: str) -> int:
    return int.from_bytes(hashlib.md5(line.encode()).digest()[:ID_BITS // 8], "big")


def _lines(block: pd.DataFrame, least: int) -> list[str]:
    """Distinct lines of at least ``least`` characters."""
    return list(dict.fromkeys(x for t in texts_of(block, "text") if t for x in t.split("\n") if len(x) >= least))


def _portions(lines: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of lines with about PORTION characters, and where they start: hashing takes some 50 bytes a character."""
    start = size = 0
    for i, x in enumerate(lines):
        size += len(x)
        if size >= PORTION or i + 1 == len(lines):
            yield start, lines[start:i + 1]
            start, size = i + 1, 0


def candidates(docs: DataFrame, edits: tuple[tuple[int, int], ...], met: int, k: int, first: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Pairs (a, b) of line ids that share a segment and have similar sketches; (a, a) if a has partners beyond the first k.

    Partners up to the ``met``-th of either line were listed before and are left out; ``first`` is the k of the first round.
    """
    count = shards(docs.sparkSession)
    bands = _bands(edits)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, "text", block_chars):
            lines = _lines(block, bands[0][1])
            ids = np.fromiter(map(line_id, lines), np.uint64, len(lines))
            out: dict[str, list] = {"shard": list(range(count))}
            parts, marks = [], np.zeros(len(lines), np.uint64)
            for tau, shortest, longest in bands:
                own = [i for i, x in enumerate(lines) if shortest <= len(x) <= longest]
                for start, some in _portions([lines[i] for i in own]):
                    rows = np.array(own[start:start + len(some)])
                    r = Rolling(some)
                    index_key, index_row, probe_key, probe_row = segment_keys(r, tau, shortest)
                    marks[rows] = sketches(r)
                    parts.append((index_key, rows[index_row], probe_key, rows[probe_row]))
            sides = list(map(np.concatenate, zip(*parts))) if parts else [np.zeros(0, np.uint64)] * 4
            for side, key, row in (("i", *sides[:2]), ("p", *sides[2:])):
                key, row = key >> np.uint64(64 - KEY_BITS), row.astype(np.int64)
                order = np.argsort(key)
                key, row = key[order], row[order]
                at = cut(key, count, KEY_BITS)
                parts = list(zip(at, at[1:]))
                out[f"{side}_keys"] = [pack_sorted(key[a:b]) for a, b in parts]
                out[f"{side}_ids"] = [pack(ids[row[a:b]], np.uint64) for a, b in parts]
                out[f"{side}_marks"] = [pack(marks[row[a:b]], np.uint64) for a, b in parts]
            yield pd.DataFrame(out)

    def match(key, frame: pd.DataFrame) -> pd.DataFrame:
        a, b = _meet(*_side(frame, "i"), *_side(frame, "p"), 4 * bands[-1][0], met, k, first)
        return pd.DataFrame({"a": a.astype(np.int64), "b": b.astype(np.int64)}).drop_duplicates()

    fields = ", ".join(f"{s}_{f} binary" for s in "ip" for f in ("keys", "ids", "marks"))
    sent = columns(docs, "text").mapInPandas(send, f"shard int, {fields}")
    return sent.groupBy("shard").applyInPandas(match, "a long, b long").distinct()


def _side(frame: pd.DataFrame, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All blocks' entries of a shard, distinct and sorted by key and id."""
    keys = np.concatenate([unpack_sorted(v) for v in frame[f"{side}_keys"]])
    ids = np.concatenate([unpack(v, np.uint64) for v in frame[f"{side}_ids"]])
    marks = np.concatenate([unpack(v, np.uint64) for v in frame[f"{side}_marks"]])
    order = np.lexsort((ids, keys))
    keys, ids, marks = keys[order], ids[order], marks[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    return keys[new], ids[new], marks[new]


def _meet(i_keys, i_ids, i_marks, p_keys, p_ids, p_marks, limit: int, met: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids under the same key, smaller id first; per line and group the partners after the first ``met`` to the k-th.

    A line with more has a pair with itself. Groups in which nobody can have more than ``least`` partners, or with few pairs
    in all, are listed whole in the first round.
    """
    names, starts, size = np.unique(i_keys, return_index=True, return_counts=True)
    if not len(names) or not len(p_keys):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    at = np.minimum(np.searchsorted(names, p_keys), len(names) - 1)
    hit = names[at] == p_keys
    probes, group = np.flatnonzero(hit), at[hit]
    per_group = np.bincount(group, minlength=len(names))
    large = (size * per_group > least * least) & (np.maximum(size, per_group) > least)
    a, b = [], []

    plain = ~large[group] & (met == 0)
    p, g = probes[plain], group[plain]
    times = size[g]
    rows = np.repeat(p, times)
    cols = np.repeat(starts[g], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    ok = (i_ids[cols] != p_ids[rows]) & (np.bitwise_count(i_marks[cols] ^ p_marks[rows]) <= limit)
    a.append(i_ids[cols[ok]])
    b.append(p_ids[rows[ok]])

    for g in np.flatnonzero(large).tolist():
        inside = slice(starts[g], starts[g] + size[g])
        ids, marks = i_ids[inside], i_marks[inside]
        seekers = probes[group == g]
        count = np.zeros(len(ids), np.int64)
        for s in range(0, len(seekers), 512):  # strips of probes against the whole list
            rows = seekers[s:s + 512]
            ok = (ids[None, :] != p_ids[rows][:, None]) & (np.bitwise_count(marks[None, :] ^ p_marks[rows][:, None]) <= limit)
            rank = np.minimum(np.cumsum(ok, axis=0) + count, np.cumsum(ok, axis=1))
            y, x = np.nonzero(ok & (rank > met) & (rank <= k))
            a.append(ids[x])
            b.append(p_ids[rows[y]])
            more = p_ids[rows[ok.sum(axis=1) > k]]
            a.append(more)
            b.append(more)
            count += ok.sum(axis=0)
        a.append(ids[count > k])
        b.append(ids[count > k])
    a, b = np.concatenate(a), np.concatenate(b)
    return np.minimum(a, b), np.maximum(a, b)


def within(a: list[str], b: list[str], tau: int) -> np.ndarray:
    """Which pairs are at most ``tau`` edits apart, by bit vectors of the band around the diagonal, all pairs side by side.

    Bit i of a vector belongs to row j - tau + i in column j. Vertical differences are kept as in
    Myers' algorithm; the band moves down by a row per column, and the last row's distance is followed along it.
    """
    n = len(a)
    if not 1 <= 2 * tau + 1 <= 62:
        raise ValueError("the band must fit into a word")
    la, lb = (np.fromiter(map(len, x), np.int64, n) for x in (a, b))
    out = np.abs(la - lb) <= tau
    order = np.flatnonzero(out)
    order = order[np.argsort(lb[order], kind="stable")]
    for s in range(0, len(order), LANES):
        lanes = order[s:s + LANES]
        out[lanes] = _band([a[i] for i in lanes], [b[i] for i in lanes], tau)
    return out


def _band(a: list[str], b: list[str], tau: int) -> np.ndarray:
    la, lb = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    wide, cols = 2 * tau + 1, int(lb.max())
    # pattern a with tau + 1 strange characters before it, and enough after it
    pattern = np.full((len(a), cols + 3 * tau + 3), 0xFFFFFFFF, np.uint32)
    text = np.full((len(b), cols), 0xFFFFFFFE, np.uint32)
    for i, (x, y) in enumerate(zip(a, b)):
        pattern[i, tau + 1:tau + 1 + len(x)] = np.frombuffer(x.encode("utf-32-le"), np.uint32)
        text[i, :len(y)] = np.frombuffer(y.encode("utf-32-le"), np.uint32)
    one, full = np.uint64(1), np.uint64((1 << wide) - 1)
    top = np.uint64(1 << (wide - 1))
    # column 0: rows -tau..0 do not rise, rows 1..tau rise by one each; bit i is the step into row i - tau
    vp = np.full(len(a), ((1 << tau) - 1) << (tau + 1), np.uint64)
    vn = np.zeros(len(a), np.uint64)
    distance = np.full(len(a), tau, np.int64)  # at the band's last row
    final = np.full(len(a), tau + 1, np.int64)
    for j in range(cols + 1):
        done = np.flatnonzero(lb == j)
        if len(done):
            final[done] = _at_row(vp[done], vn[done], distance[done], la[done] - (j + tau), wide)
        if j == cols:
            break
        # the band moves down: bit i now stands for row j + 1 - tau + i, its step into that row unknown for the last
        vp, vn = vp >> one, vn >> one
        match = np.zeros(len(a), np.uint64)
        for i in range(wide):
            row = j + 1 - tau + i  # rows from 1 are characters of a
            match |= (pattern[:, row + tau] == text[:, j]).astype(np.uint64) << np.uint64(i)
        x = match | vn
        d0 = ((((match & vp) + vp) ^ vp) | x) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        distance += np.where(d0 & top, 0, 1)
        up_p, up_n = (hp << one) & full, (hn << one) & full
        vp, vn = (up_n | ~(d0 | up_p)) & full, up_p & d0
    return final <= tau


def _at_row(vp: np.ndarray, vn: np.ndarray, distance: np.ndarray, back: np.ndarray, wide: int) -> np.ndarray:
    """Distance ``-back`` rows above the band's last row."""
    out = distance.copy()
    for up in range(wide - 1):
        step = np.uint64(wide - 1 - up)
        here = -back > up
        out -= np.where(here, (vp >> step & np.uint64(1)).astype(np.int64) - (vn >> step & np.uint64(1)).astype(np.int64), 0)
    return out


def _bitmap(ids: DataFrame) -> bytes:
    """A bitmap of fixed size with a bit for every id (column ``id``), put together from pages of 4 kB."""
    bit = F.col("id") % BITMAP_BITS
    pages = ids.select(F.floor(bit / 32768).cast("int").alias("page"), (bit % 32768).cast("int").alias("bit")).distinct()

    def fill(key, frame: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(32768, np.uint8)
        bits[frame["bit"]] = 1
        return pd.DataFrame({"page": [key[0]], "bits": [np.packbits(bits).tobytes()]})

    out = np.zeros((BITMAP_BITS // 32768, 4096), np.uint8)
    for row in pages.groupBy("page").applyInPandas(fill, "page int, bits binary").collect():  # at most 1024 pages
        out[row.page] = np.frombuffer(row.bits, np.uint8)
    return out.tobytes()


def line_rows(docs: DataFrame, least: int | None) -> DataFrame:
    """(key, doc_id, text_key, place, at) of every line that takes part; ``place`` counts from 0, ``at`` orders all lines.

    ``at`` is one number of the doc_id (null is the largest), 24 bits of the hash of the text, and the place:
    its minimum is found by a hash aggregation, without sorting lines.
    """
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    whole = lambda c, digits: c.cast(f"decimal({digits},0)")
    doc = F.coalesce(whole(F.col("doc_id"), 19), F.lit(str(2**63)).cast("decimal(19,0)"))
    text = whole(F.pmod("text_key", F.lit(1 << 24)), 8)
    at = (doc * F.lit(1 << 24).cast("decimal(8,0)") + text) * F.lit(1 << 31).cast("decimal(10,0)") + whole(F.col("place"), 10)
    return lines.where(takes_part(F.col("line"), least)).select(
        F.unhex(F.md5("line")).alias("key"), "doc_id", "text_key", "place", at.cast("decimal(38,0)").alias("at"))


def takes_part(line: Column, least: int | None) -> Column:
    return line.rlike(r"\S") if least is None else F.length(line) >= least


def _id_of(key: Column) -> Column:
    """The id of a line from its key, as ``line_id`` has it."""
    return F.conv(F.hex(F.substring(key, 1, ID_BITS // 8)), 16, 10).cast("long")


def texts_of_ids(docs: DataFrame, ids: DataFrame, least: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(key, id, line): the distinct lines with one of the ids. The bitmap spares all others the shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(ids))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.frombuffer(shared.value, np.uint8)
        for block in blocks(batches, "text", block_chars):
            lines = _lines(block, least)
            own = np.fromiter(map(line_id, lines), np.int64, len(lines))
            bit = own % BITMAP_BITS
            chosen = np.flatnonzero(bits[bit >> 3] >> (7 - (bit & 7)) & 1)
            if len(chosen):
                yield pd.DataFrame({"line": [lines[i] for i in chosen.tolist()], "id": own[chosen]})

    lines = columns(docs, "text").mapInPandas(pick, "line string, id long")
    return lines.join(ids, "id", "left_semi").distinct().select(F.unhex(F.md5("line")).alias("key"), "id", "line")


def verified(pairs: DataFrame, lines: DataFrame, edits: tuple[tuple[int, int], ...]) -> DataFrame:
    """Keys (x, y) of different lines that belong to pairs of ids (a, b) and are within the edits of the shorter one."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = np.minimum(batch["s"].str.len(), batch["t"].str.len()).to_numpy()
            ok = np.zeros(len(batch), bool)
            for tau, shortest, _ in _bands(edits):
                mine = np.flatnonzero((size >= shortest) & ~ok)
                ok[mine] = within(list(batch["s"].iloc[mine]), list(batch["t"].iloc[mine]), tau)
            yield batch.loc[ok, ["x", "y"]]

    of = lambda id_, key, line: lines.select(F.col("id").alias(id_), F.col("key").alias(key), F.col("line").alias(line))
    both = pairs.join(of("a", "x", "s"), "a").join(of("b", "y", "t"), "b").where("x != y")
    return both.select("x", "y", "s", "t").mapInPandas(verify, "x binary, y binary")


def repeated(docs: DataFrame, tau: int = TAU, least: int | None = None, k: int = FIRST_ROUND, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, text_key, places): the places of the lines to drop from each document that has any."""
    edits = allowances(tau, least)
    shortest = next((n for n, e in edits if e), None)
    docs = columns(docs, "doc_id", "text")
    rows = stage_table(line_rows(docs, least), "lines")
    classes = stage_table(rows.groupBy("key").agg(F.min("at").alias("first"), F.count("*").alias("n")), "line_classes")
    tried, gone, met, first = None, classes.select("key").limit(0), 0, k
    while shortest is not None:
        pairs = stage_table(candidates(docs, edits, met, k, first, block_chars), "line_pairs")
        new = pairs.where("a != b")
        if tried is not None:
            new = new.join(tried, ["a", "b"], "left_anti")
        ids = new.select(F.col("a").alias("id")).unionAll(new.select(F.col("b").alias("id"))).distinct()
        near = verified(new, texts_of_ids(docs, ids, shortest, block_chars), edits)
        of = lambda key, first: classes.select(F.col("key").alias(key), F.col("first").alias(first))
        later = near.join(of("x", "fx"), "x").join(of("y", "fy"), "y").select(
            F.when(F.col("fx") < F.col("fy"), F.col("y")).otherwise(F.col("x")).alias("key"))
        later = stage_table((later if tried is None else later.unionAll(gone)).distinct(), "later_lines")
        tried, gone = (new if tried is None else tried.unionAll(new)), later
        more = pairs.where("a = b").select(F.col("a").alias("id"))
        kept = classes.select(_id_of(F.col("key")).alias("id"), "key").join(gone, "key", "left_anti")
        if kept.join(more, "id", "left_semi").isEmpty():
            break
        met, k = k, k * GROWTH
    repeats = classes.join(gone.withColumn("later", F.lit(True)), "key", "left").where("later OR n > 1").select("key", "first", "later")
    drops = rows.join(repeats, "key").where(F.coalesce("later", F.lit(False)) | (F.col("at") != F.col("first")))
    return drops.groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("places"))


def kept_lines(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, text, rest, kept, n_lines, n_dropped, emptied): ``kept`` is the text without repeated lines, ``rest`` has the other
    columns. A text is ``emptied`` if it lost lines and none that takes part is left.
    """
    rest = F.struct(*[docs[c] for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(0).alias("none")])
    own = docs.select(docs["doc_id"], docs["text"], rest.alias("rest"))
    drops = repeated(docs, **options).select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "places")
    both = own.join(drops, own["doc_id"].eqNullSafe(drops["_doc"]) & (F.xxhash64("text") == drops["_key"]), "left")
    lines = F.split("text", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("places"))
    text = F.when(F.col("places").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.col("lines")[i]), "\n"))
    n = F.when(F.coalesce(F.length("text"), F.lit(0)) == 0, 0).otherwise(F.size("lines")).cast("long")
    dropped = F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("long")
    left_over = F.exists(F.split("kept", "\n", -1), lambda x: takes_part(x, options.get("least")))
    return both.withColumn("lines", lines).select(
        "doc_id", "text", "rest", text.alias("kept"), n.alias("n_lines"), dropped.alias("n_dropped")).withColumn(
        "emptied", (F.col("n_dropped") > 0) & ~left_over)


def dedup(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text`` and ``n_chars``, if there is one, brought up to date.

    A document that loses every line that takes part said nothing of its own and goes; one that lost none stays.
    """
    done = kept_lines(docs, **options).where("NOT emptied")
    of = {c: F.col("rest")[c] for c in docs.columns} | {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    if "n_chars" in docs.columns:
        of["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("kept").cast("long")).otherwise(F.col("rest")["n_chars"])
    return done.select(*[of[c].alias(c) for c in docs.columns])
