"""N-gram Jaccard join: documents whose sets of word n-grams overlap enough, and their components.

1. Whole texts become blocks of numbered words. Every n-gram has a 64-bit hash;
   how many documents hold it is counted over all documents, by 40-bit buckets of
   the hash, with one packed array per block and shard.
2. A set's n-grams are ordered rarest first, ties by hash. Two sets that link share an
   n-gram in their prefixes (the first ``n - ceil(t * n) + 1``). N-grams of one
   document only cannot be shared and are left out. Equal sets are one from here on.
3. Prefix n-grams meet. A pair survives the length filter, the positional filter and the suffix
   filter: the parities of a set's n-grams in 512 bits give a lower bound for the symmetric difference.
4. Surviving pairs of different components are verified once, on the sets. In a
   round each set is paired with the ``k`` sets of a group that have the fewest n-grams of their
   own; components are merged, and k grows until a round leaves no pair out. So a
   group of m near copies around one text costs about m verifications, not m * m.

Any total order keeps the join exact, so neither bucket collisions nor the rounding of counts
can lose a link. Sets are identified by 128 bits and n-grams by 64 bits of their hashes.

Null and empty texts have an empty set, linked with nothing; a text with fewer words than n has one
n-gram, all its words. Repeated rows each get a row. A null doc_id takes part, but never names a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.llm.blocks import (
    BLOCK_CHARS, TokenBlock, cut, mix, pack, pack_sorted, shards, only, token_blocks, unpack, unpack_sorted,
    with_answers, without, word_hashes,
)
from paylens.llm.components import connected_components
from paylens.session import stage_table

#: Bits of the buckets in which documents are counted.
BUCKET_BITS = 40
#: Words of 64 bits in the parity sketch of a set.
SKETCH = 8
#: Groups up to this size list all their pairs at once.
SMALL_GROUP = 32

MESSAGE = "shard int, block string, payload binary, counts binary"
ANSWER = "shard int, block string, payload binary"
SETS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text_key", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("own", T.IntegerType()),
    T.StructField("prefix", T.ArrayType(T.LongType())),
    T.StructField("places", T.ArrayType(T.IntegerType())),
    T.StructField("sketch", T.BinaryType()),
    T.StructField("items", T.BinaryType()),
])


def ngram_sets(block: TokenBlock, n: int) -> list[np.ndarray]:
    """Ascending distinct hashes of each document's word n-grams."""
    words = mix(word_hashes(block.words))[block.tokens] if len(block.tokens) else np.zeros(0, np.uint64)
    odd = np.uint64(0x9E3779B97F4A7C15)

    def fold(parts, seed: int) -> np.ndarray:
        h = np.full(len(parts[0]), seed, np.uint64)
        for p in parts:
            h = mix(h * odd + p)
        return h

    m = len(words)
    grams = fold([words[k:m - n + 1 + k] for k in range(n)], n) if m >= n else np.zeros(0, np.uint64)
    out = []
    for end, size in zip(block.ends.tolist(), block.sizes.tolist()):
        start = end - size
        if size >= n:
            out.append(np.unique(grams[start:end - n + 1]))
        else:
            out.append(fold([words[i:i + 1] for i in range(start, end)], size) if size else np.zeros(0, np.uint64))
    return out


def _buckets(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    joined = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return np.unique(joined >> np.uint64(64 - BUCKET_BITS), return_counts=True)


def _level(counts: np.ndarray) -> np.ndarray:
    """Counts on a scale of eight steps per doubling: one byte, in the same order, 0 for a count of 1 only.

    From 2**31.875 on all are one step: more frequent ones are ordered by hash, as those of equal counts are.
    """
    return np.minimum(np.floor(8 * np.log2(np.maximum(counts, 1))), 255).astype(np.uint8)


def set_rows(docs: DataFrame, n: int, num: int, den: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: its set's size, key, rare-first prefix, sketch and packed items."""
    table = token_blocks(docs, block_chars)
    count = shards(docs.sparkSession)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                buckets, counts = _buckets(ngram_sets(TokenBlock(row), n))
                at = cut(buckets, count, BUCKET_BITS)
                yield pd.DataFrame({
                    "shard": range(count), "block": row.block,
                    "payload": [pack_sorted(buckets[a:b]) for a, b in zip(at, at[1:])],
                    "counts": [pack(counts[a:b], np.uint32) for a, b in zip(at, at[1:])],
                })

    def tally(key, frame: pd.DataFrame) -> pd.DataFrame:
        each = [unpack_sorted(p) for p in frame["payload"]]
        distinct, place = np.unique(np.concatenate(each), return_inverse=True)
        counts = np.concatenate([unpack(c, np.uint32) for c in frame["counts"]])
        levels = _level(np.bincount(place, counts, len(distinct)))[place]
        parts = np.split(levels, np.cumsum([len(e) for e in each])[:-1])
        return pd.DataFrame({"shard": key[0], "block": frame["block"], "payload": [pack(p, np.uint8) for p in parts]})

    answers = table.mapInPandas(send, MESSAGE).groupBy("shard").applyInPandas(tally, ANSWER)

    def order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                block = TokenBlock(row)
                sets = ngram_sets(block, n)
                buckets, _ = _buckets(sets)
                levels = np.concatenate([unpack(p, np.uint8) for p in row.answers])
                yield pd.DataFrame([(d, t, *_set_row(s, buckets, levels, num, den)) for d, t, s in zip(block.doc_ids, block.text_keys, sets)],
                                   columns=SETS.names).astype({"doc_id": "Int64"})

    return stage_table(with_answers(table, answers).mapInPandas(order, SETS), "sets")


def _set_row(items: np.ndarray, buckets: np.ndarray, levels: np.ndarray, num: int, den: int) -> tuple:
    size = len(items)
    if not size:
        return 0, None, 0, [], [], None, None
    level = levels[np.searchsorted(buckets, items >> np.uint64(64 - BUCKET_BITS))]
    ranked = np.lexsort((items, level))[:size - (num * size + den - 1) // den + 1]
    shared = np.flatnonzero(level[ranked])
    key = xxhash.xxh3_128_digest(items.tobytes())
    if not len(shared):
        return size, key, size, [], [], None, None
    prefix = items[ranked[shared]].view(np.int64).tolist()
    return (size, key, int(np.count_nonzero(level == 0)), prefix, shared.tolist(), sketch(items).tobytes(), items.tobytes())


def sketch(items: np.ndarray) -> np.ndarray:
    """Parities of the items in 64 * SKETCH bits; two sets' sketches differ in no more bits than the sets in items."""
    bits = np.bincount((items & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def _passes(i, j, n, place, sketches, num: int, den: int) -> np.ndarray:
    """Length, positional and suffix filter for rows i and j that share an n-gram at their places."""
    a, b = n[i], n[j]
    need = (num * (a + b) + num + den - 1) // (num + den)
    ok = np.minimum(a, b) * den >= num * np.maximum(a, b)
    ok &= np.minimum(place[i], place[j]) + np.minimum(a - place[i], b - place[j]) >= need
    i, j = np.broadcast_arrays(i, j)
    at = np.nonzero(ok)
    differing = np.bitwise_count(sketches[i[at]] ^ sketches[j[at]]).sum(axis=-1, dtype=np.int64)
    ok[at] &= differing <= (np.broadcast_to(a + b - 2 * need, ok.shape))[at]
    return ok


def candidates(postings: DataFrame, num: int, den: int, k: int) -> DataFrame:
    """Pairs (a, b) of sets of different components that share a prefix n-gram and pass the filters.

    Groups larger than SMALL_GROUP give, for each set, only the first ``k`` partners in the order
    of ``own``; a pair of a set with itself tells that it has more, for another round.
    """

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _whole_groups(batches, "h"):
            yield _pairs_of(frame, num, den, k)

    placed = postings.repartition("h").sortWithinPartitions("h", "own", "n", "key")
    return placed.mapInPandas(pairs, "a binary, b binary").distinct()


def _whole_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Sorted rows regrouped so that no value of ``key`` is in two frames."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        values = batch[key].to_numpy()
        if values[0] == values[-1] and held and held[-1][key].iloc[-1] == values[0]:
            held.append(batch)
            continue
        last = int(np.searchsorted(values, values[-1]))
        if held and held[-1][key].iloc[-1] != values[0]:
            yield pd.concat(held, ignore_index=True)
            held = []
        if last:
            yield pd.concat([*held, batch.iloc[:last]], ignore_index=True)
            held = []
        held.append(batch.iloc[last:])
    if held:
        yield pd.concat(held, ignore_index=True)


def _pairs_of(frame: pd.DataFrame, num: int, den: int, k: int) -> pd.DataFrame:
    h, n, place = (frame[c].to_numpy().astype(np.int64) for c in ("h", "n", "place"))
    key = frame["key"].to_numpy()
    sketches = np.frombuffer(b"".join(frame["sketch"]), np.uint64).reshape(-1, SKETCH)
    comp = pd.factorize(frame["comp"])[0]
    starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(h)]]))
    small = np.repeat(sizes <= SMALL_GROUP, sizes)
    first, second = [], []

    for gap in range(1, SMALL_GROUP):
        i = np.flatnonzero(small[:-gap] & (h[:-gap] == h[gap:])) if len(h) > gap else np.zeros(0, np.int64)
        if not len(i):
            break
        i = i[comp[i] != comp[i + gap]]
        i = i[_passes(i, i + gap, n, place, sketches, num, den)]
        first.append(i)
        second.append(i + gap)

    for start, size in zip(starts[sizes > SMALL_GROUP].tolist(), sizes[sizes > SMALL_GROUP].tolist()):
        for lo in range(start, start + size, 256):  # rows lo.. against all before them, a strip at a time
            j = np.arange(lo, min(lo + 256, start + size))
            got = np.zeros(len(j), np.int64)
            for at in range(start, int(j[-1]), 2048):
                i = np.arange(at, min(at + 2048, int(j[-1])))
                jj, ii = j[:, None], i[None, :]
                ok = (ii < jj) & (comp[ii] != comp[jj])
                ok[got > k] = False
                if not ok.any():
                    continue
                ok &= _passes(ii, jj, n, place, sketches, num, den)
                rank = np.cumsum(ok, axis=1) + got[:, None]
                y, x = np.nonzero(ok & (rank <= k))
                got += ok.sum(axis=1)
                first.append(i[x])
                second.append(j[y])
            first.append(j[got > k])
            second.append(j[got > k])
    i, j = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (first, second))
    return pd.DataFrame({"a": key[i], "b": key[j]}).drop_duplicates()


def verified(pairs: DataFrame, items: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets overlap enough; ``items`` has (key, items)."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"]):
                both = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                keep.append(den * both >= num * (len(x) // 8 + len(y) // 8 - both))
            yield batch.loc[keep, ["a", "b"]]

    of = lambda side, name: items.select(F.col("key").alias(side), F.col("items").alias(name))
    return pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").mapInPandas(verify, "a binary, b binary")


def links(sets: DataFrame, num: int, den: int, k: int = 1, growth: int = 8) -> DataFrame:
    """Enough verified links (a, b) between set keys to connect every component."""
    shared = sets.where("size(prefix) > 0").groupBy("key").agg(
        *[F.first(c).alias(c) for c in ("n", "own", "prefix", "places", "sketch", "items")])
    shared = stage_table(shared, "shared_sets")
    items = shared.select("key", "items")
    postings = shared.select(
        "key", "n", "own", "sketch", F.explode(F.arrays_zip("prefix", "places")).alias("p")).select(
        F.col("p.prefix").alias("h"), F.col("p.places").alias("place"), "key", "n", "own", "sketch", F.col("key").alias("comp"))
    postings = stage_table(postings.join(postings.groupBy("h").count().where("count > 1").drop("count"), "h", "left_semi"), "postings")
    tried = done = None
    current = postings
    while True:
        pairs = candidates(current, num, den, k)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stage_table(pairs, "pairs")
        new = pairs.where("a != b")
        passed = stage_table(verified(new, items, num, den), "links")
        tried = new if tried is None else tried.unionAll(new)
        done = passed if done is None else done.unionAll(passed)
        if pairs.where("a = b").isEmpty():
            return done
        roots = connected_components(done)
        current = postings.drop("comp").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn(
            "comp", F.coalesce("root", "key")).drop("root")
        k *= growth


def _roots(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(key, root) of the sets that are linked with another."""
    return connected_components(links(sets, num, den)).withColumnRenamed("node", "key")


def components(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document: the size of its set of word n-grams and the smallest doc_id reachable by links.

    Two documents link when ``den * intersection >= num * union``.
    """
    sets = set_rows(docs, n, num, den, block_chars)
    roots = _roots(sets, num, den)
    named = sets.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least"))
    named = named.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.join(least, "root").select("key", "component_id")
    return sets.select("doc_id", "n", "key").join(of, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, null_ids: bool = False) -> DataFrame:
    """``docs`` with only one document of each component: that of the smallest doc_id, null last, and smallest hash of its text.

    A doc_id and a text name a document: texts that share a doc_id are judged each by itself, and of rows that repeat both one stays.
    Rows without a doc_id stay, unless ``null_ids``: then they are judged like all others.
    """
    sets = set_rows(docs, n, num, den)
    named = sets if null_ids else sets.where("doc_id IS NOT NULL")
    rooted = named.where("key IS NOT NULL").join(_roots(sets, num, den), "key", "left").select(
        F.coalesce("root", "key").alias("root"), "doc_id", "text_key",
        F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key").alias("rank"))
    best = rooted.groupBy("root").agg(F.min("rank").alias("best"))
    kept = without(docs, rooted.join(best, "root").where(~F.col("rank").eqNullSafe(F.col("best"))))
    repeated = stage_table(named.groupBy("doc_id", "text_key").count().where("count > 1"), "repeated_rows")
    if repeated.isEmpty():
        return kept
    row = F.struct(*[F.col(c) for c in docs.columns])
    one = only(kept, repeated).groupBy("doc_id", "text").agg(F.min_by(row, F.to_json(row)).alias("row"))
    return without(kept, repeated).unionAll(one.select(*[F.col("row")[c].alias(c) for c in docs.columns]))
