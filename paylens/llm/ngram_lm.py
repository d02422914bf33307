"""N-gram language model in sharded Elias-Fano tries, trained on and applied to all documents.

Counting and scoring share one exchange per order. A block of documents reduces
its n-grams to distinct ones, sorts them by (context, word) and sends every shard its contexts.
The shard merges the blocks' counts, builds its part of the trie, and answers each
block with the quantised probability of each n-gram that it sent. A context that holds more than
one in ``HOT`` tokens is spread over all shards by the following word, so no shard depends on a hot word.

A level of the trie has four parts: the contexts (ascending numbers, Elias-Fano), monotone pointers to the
start of each context's successors (Elias-Fano), the successors (made monotone by
adding, to each range, the last value of the range before; Elias-Fano), and one byte for the probability.
A lookup finds the context, adds its range's base to the word and searches the successor from there.
Shards are read through memory maps.

The model interpolates: p_n(w | h) = c(hw) / (c(h) + K) + K / (c(h) + K) * p_(n-1)(w | h'), where h'
is h without its first word and p_1 the add-one unigram probability. The first term is stored, in steps of
1/32 of log10 (7 % at most apart); p_1 and the weights are exact.

Null and empty texts have one token, the end. Words are the runs between ASCII white space with A-Z
lower-cased. Repeated rows count and are scored as often as they occur. A null doc_id counts as training row.
Without training rows every probability is 1 / 1. Only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.blocks import (
    BLOCK_CHARS, TokenBlock, cut, mapped, mix, pack, pack_bytes, pack_sorted, shards, token_blocks, unpack, unpack_bytes,
    unpack_sorted, word_hashes,
)
from paylens.session import stage_table

ORDER = 2
KAPPA = 32.0
#: A context of more than one in so many training tokens is spread over all shards; there are as many of them at most.
HOT = 1024
#: Steps of a stored probability per power of ten; 255 of them reach below one in 10**7.
STEPS = 32

#: Numbers of the tokens without a shard: the start (a context only) and the end of a text.
START, END = 0, 1
FIRST = 2

_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class Bits:
    """A bit vector with vectorised select of ones and zeros, over bytes (least significant bit first)."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.ones = np.concatenate([[0], np.cumsum(_POP[data], dtype=np.int64)])
        self.zeros = np.arange(len(data) + 1, dtype=np.int64) * 8 - self.ones

    def _select(self, before: np.ndarray, flip: int, k: np.ndarray) -> np.ndarray:
        byte = np.searchsorted(before, k, "right") - 1
        left = k - before[byte]
        return byte * 8 + _SELECT[self.data[byte] ^ np.uint8(flip), left]

    def select1(self, k: np.ndarray) -> np.ndarray:
        """Places of the k-th ones, from 0."""
        return self._select(self.ones, 0, k)

    def select0(self, k: np.ndarray) -> np.ndarray:
        return self._select(self.zeros, 255, k)


def _select_table() -> np.ndarray:
    table = np.zeros((256, 8), np.int64)
    for value in range(256):
        places = [b for b in range(8) if value >> b & 1]
        table[value, :len(places)] = places
    return table


_SELECT = _select_table()


class EliasFano:
    """Ascending integers: low bits side by side, high bits in unary."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, Bits(high)

    @staticmethod
    def encode(values: np.ndarray) -> list[np.ndarray]:
        """The parts of an encoding: n, width and bytes of the low and high bits."""
        n, values = len(values), values.astype(np.uint64)
        top = int(values[-1]) + 1 if n else 1
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        low = (values[:, None] >> np.arange(width, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(places[-1]) if n else 0) + 2, np.uint8)  # ends in a zero
        high[places] = 1
        pad = np.zeros(8, np.uint8)  # a word beyond the last, for unaligned reads
        return [np.array([n, width], np.int64).view(np.uint8),
                np.concatenate([np.packbits(low.ravel(), bitorder="little"), pad]),
                np.packbits(high, bitorder="little")]

    @classmethod
    def of(cls, parts: list[np.ndarray]) -> EliasFano:
        n, width = np.frombuffer(parts[0].tobytes(), np.int64).tolist()
        return cls(n, width, parts[1], parts[2])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        bit = i * self.width
        byte = bit >> 3
        word = np.zeros(len(i), np.uint64)
        for k in range((self.width + 14) // 8):
            word |= self.low[byte + k].astype(np.uint64) << np.uint64(8 * k)
        return word >> (bit & 7).astype(np.uint64) & np.uint64((1 << self.width) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at the places i."""
        high = (self.high.select1(i) - i).astype(np.uint64)
        return high << np.uint64(self.width) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first value of at least x, and whether it equals x; n if there is none."""
        if not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        bucket = (x >> np.uint64(self.width)).astype(np.int64)
        last = int(self.high.zeros[-1])  # zeros there are
        inside = bucket < last
        b = np.where(inside, bucket, 0)
        start = np.where(b > 0, self.high.select0(np.maximum(b - 1, 0)) - b + 1, 0)
        end = np.minimum(self.high.select0(b) - b, self.n)
        want = x & np.uint64((1 << self.width) - 1)
        start, end = np.where(inside, start, self.n), np.where(inside, end, self.n)
        lo, hi = start, end.copy()
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._low(mid) < want[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        equal = np.zeros(len(x), bool)
        at = np.flatnonzero(lo < end)
        equal[at] = self._low(lo[at]) == want[at]
        return lo, equal


class TrieLevel:
    """One level of a shard: contexts, pointers, successors and quantised probabilities, over one mapped buffer."""

    def __init__(self, data: bytes):
        buffer = mapped(data)
        sizes = np.frombuffer(buffer[:80].tobytes(), np.int64)
        ends = 80 + np.cumsum(sizes)
        parts = [buffer[e - s:e] for s, e in zip(sizes, ends)]
        self.contexts, self.pointers, self.successors = (EliasFano.of(parts[k:k + 3]) for k in (0, 3, 6))
        self.codes = parts[9]

    @staticmethod
    def build(contexts: np.ndarray, sizes: np.ndarray, words: np.ndarray, codes: np.ndarray) -> bytes:
        """Contexts ascending, with ``sizes`` successors each, ascending in their range."""
        pointers = np.concatenate([[0], np.cumsum(sizes)]).astype(np.uint64)
        if len(sizes):
            last = words[pointers[1:].astype(np.int64) - 1].astype(np.uint64)
            base = np.cumsum(last) - last
            words = words + np.repeat(base, sizes)
        parts = [p for v in (contexts, pointers, words) for p in EliasFano.encode(v)] + [codes.astype(np.uint8)]
        return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(p.tobytes() for p in parts)

    def lookup(self, contexts: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and codes of the successors ``words``; ``sizes`` of them belong to each context. Code 0: not there."""
        at, known = self.contexts.successor(contexts)
        at = np.where(known, at, 0)
        if not self.contexts.n:
            return np.zeros(len(words), np.int64), np.zeros(len(words), np.uint8)
        start = self.pointers.access(at).astype(np.int64)
        end = self.pointers.access(at + 1).astype(np.int64)
        base = np.where(start > 0, self.successors.access(np.maximum(start - 1, 0)), 0).astype(np.uint64)
        place, equal = self.successors.successor(np.repeat(base, sizes) + words)
        equal &= np.repeat(known, sizes) & (place >= np.repeat(start, sizes)) & (place < np.repeat(end, sizes))
        place = np.where(equal, place, 0)
        return place, np.where(equal, self.codes[place], 0).astype(np.uint8)


def quantise(p: np.ndarray) -> np.ndarray:
    """Codes 1 to 255 of probabilities above 0."""
    return np.clip(255 + np.rint(np.log10(p) * STEPS), 1, 255).astype(np.uint8)


def probability(codes: np.ndarray) -> np.ndarray:
    """The probabilities of codes; 0 for code 0."""
    return np.where(codes > 0, 10.0 ** ((codes.astype(np.float64) - 255) / STEPS), 0.0)


def held_out(doc: int | None) -> bool:
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


class _Counted:
    """Tokens of a block with everything the shards have answered so far."""

    def __init__(self, row, order: int, count: int):
        block = TokenBlock(row)
        self.block, self.count = block, count
        self.held = np.array([held_out(d) for d in block.doc_ids], bool)
        n, sizes = len(block.sizes), block.sizes + 1  # with the end
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.train = np.repeat(~self.held, sizes)
        self.order = np.argsort(mix(word_hashes(block.words)), kind="stable")
        self.hashes = mix(word_hashes(block.words))[self.order]
        self.at = cut(self.hashes, count)
        if order < 1:
            return
        ids = np.zeros(len(block.words), np.uint64)
        known = np.zeros(len(block.words), np.int64)
        ranks = [unpack(p, np.uint32) for p in row.ids1]
        shard = np.repeat(np.arange(count), np.diff(self.at))
        ids[self.order] = np.concatenate(ranks).astype(np.uint64) * np.uint64(count) + shard.astype(np.uint64) + np.uint64(FIRST)
        known[self.order] = np.concatenate([unpack(p, np.int64) for p in row.counts1])
        inner = np.ones(int(self.ends[-1]) if n else 0, bool)
        inner[self.ends - 1] = False
        self.words = np.full(len(inner), END, np.uint64)
        self.words[inner] = ids[block.tokens]
        self.known = np.full(len(inner), int(row.train_docs), np.int64)
        self.known[inner] = known[block.tokens]
        self.total, self.types = int(row.total), int(row.types)
        self.p = (self.known + 1) / (self.total + self.types + 1)
        self.base = np.log10(self.p)
        self.contexts, self.context_counts = self._shifted(self.words, self.known, START, int(row.train_docs))
        for level in range(2, order + 1):
            key = self.pairs()
            answer = lambda c, t: np.concatenate([unpack(p, t) for p in getattr(row, f"{c}{level}")])[key.inverse]  # noqa: B023, E731
            seen = probability(answer("payload", np.uint8))
            self.p = seen + KAPPA / (self.context_counts + KAPPA) * self.p
            if hasattr(row, f"ids{level}"):  # there is a longer context
                ids, counts = answer("ids", np.uint64), answer("counts", np.int64)
                # a text's first words have shorter contexts: they keep the context before
                keep = self.contexts, self.context_counts
                self.contexts, self.context_counts = self._shifted(ids, counts, *[k[0] if n else 0 for k in keep])

    def _shifted(self, ids, counts, first_id: int, first_count: int):
        """Each token's context is the n-gram that ends one token earlier."""
        contexts, totals = np.roll(ids, 1), np.roll(counts, 1)
        contexts[self.starts], totals[self.starts] = first_id, first_count
        return contexts, totals

    def pairs(self) -> _Pairs:
        return _Pairs(self)


class _Pairs:
    """Distinct (context, word) pairs of a block, sorted by shard, context and word."""

    def __init__(self, t: _Counted):
        count = t.count
        contexts, c = np.unique(t.contexts, return_inverse=True)
        words, w = np.unique(t.words, return_inverse=True)
        totals = np.zeros(len(contexts), np.int64)
        totals[c] = t.context_counts
        hot = totals * HOT > t.total
        shard = np.where(hot[c], t.words % np.uint64(count), t.contexts % np.uint64(count)).astype(np.uint64)
        wide, high = len(words).bit_length(), len(contexts).bit_length()
        if wide + high + count.bit_length() > 64:
            raise ValueError("a block is too large for this number of shards")
        key = (shard << np.uint64(high) | c.astype(np.uint64)) << np.uint64(wide) | w.astype(np.uint64)
        distinct, self.inverse = np.unique(key, return_inverse=True)
        self.counts = np.bincount(self.inverse[t.train], minlength=len(distinct))
        self.words = words[(distinct & np.uint64((1 << wide) - 1)).astype(np.int64)]
        groups = distinct >> np.uint64(wide)
        first = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])) if len(groups) else np.zeros(0, np.int64)
        self.sizes = np.diff(np.concatenate([first, [len(groups)]])).astype(np.int64)
        of = (groups[first] & np.uint64((1 << high) - 1)).astype(np.int64)
        self.contexts, self.totals = contexts[of], totals[of]
        edges = np.arange(count + 1, dtype=np.uint64)
        self.group_cut = np.searchsorted(groups[first] >> np.uint64(high), edges)
        self.pair_cut = np.concatenate([[0], np.cumsum(self.sizes)])[self.group_cut]


def _send_words(count: int):
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                t = _Counted(row, 0, count)
                train = np.repeat(~t.held, t.block.sizes)
                counts = np.bincount(t.block.tokens[train], minlength=len(t.block.words))[t.order]
                words = [t.block.words[i] for i in t.order.tolist()]
                yield pd.DataFrame({
                    "shard": range(count), "block": row.block,
                    "words": [pack_bytes(b" ".join(words[a:b])) for a, b in zip(t.at, t.at[1:])],
                    "counts": [pack(counts[a:b], np.uint32) for a, b in zip(t.at, t.at[1:])],
                })

    return send


def _tally_words(key, frame: pd.DataFrame) -> pd.DataFrame:
    """Counts and numbers of the shard's words; frequent words get small numbers, ties go by the word."""
    each = [unpack_bytes(w).split() for w in frame["words"]]
    place: dict[bytes, int] = {}
    at = [np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, len(words)) for words in each]
    total = np.bincount(np.concatenate(at), np.concatenate([unpack(c, np.uint32) for c in frame["counts"]]), len(place)).astype(np.int64)
    names = list(place)
    rank = np.zeros(len(names), np.int64)
    rank[sorted(range(len(names)), key=lambda i: (-total[i], names[i]))] = np.arange(len(names))
    return pd.DataFrame({
        "shard": key[0], "block": frame["block"], "types": np.count_nonzero(total),
        "ids": [pack(rank[a], np.uint32) for a in at], "counts": [pack(total[a], np.int64) for a in at],
    })


def _send_pairs(order: int, count: int):
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                p = _Counted(row, order - 1, count).pairs()
                g, e = list(zip(p.group_cut, p.group_cut[1:])), list(zip(p.pair_cut, p.pair_cut[1:]))
                yield pd.DataFrame({
                    "shard": range(count), "block": row.block,
                    "contexts": [pack_sorted(p.contexts[a:b]) for a, b in g],
                    "totals": [pack(p.totals[a:b], np.int64) for a, b in g],
                    "sizes": [pack(p.sizes[a:b], np.uint32) for a, b in g],
                    "words": [pack(p.words[a:b], np.uint64) for a, b in e],
                    "counts": [pack(p.counts[a:b], np.uint32) for a, b in e],
                })

    return send


def _build_and_answer(count: int, last: bool):
    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        contexts = [unpack_sorted(c) for c in frame["contexts"]]
        sizes = [unpack(s, np.uint32).astype(np.int64) for s in frame["sizes"]]
        words = [unpack(w, np.uint64) for w in frame["words"]]
        counts = np.concatenate([unpack(c, np.uint32) for c in frame["counts"]]).astype(np.int64)
        all_contexts, place = np.unique(np.concatenate(contexts), return_inverse=True)
        totals = np.zeros(len(all_contexts), np.int64)
        totals[place] = np.concatenate([unpack(t, np.int64) for t in frame["totals"]])
        all_words, word = np.unique(np.concatenate(words), return_inverse=True)
        pair = np.repeat(place, np.concatenate(sizes)) * max(1, len(all_words)) + word
        seen = counts > 0
        distinct, inverse = np.unique(pair[seen], return_inverse=True)
        number = np.bincount(inverse, counts[seen], len(distinct)).astype(np.int64)
        owner, word = np.divmod(distinct, max(1, len(all_words)))
        used, per = np.unique(owner, return_counts=True)
        codes = quantise(number / (totals[owner] + KAPPA)) if len(owner) else np.zeros(0, np.uint8)
        data = TrieLevel.build(all_contexts[used], per, all_words[word], codes)
        trie = TrieLevel(data)
        out = []
        for block, c, s, w in zip(frame["block"], contexts, sizes, words):
            where, code = trie.lookup(c, s, w)
            # n-grams of held-out texts alone have no place: each gets the number of a context that nobody follows
            ids = np.where(code > 0, (where + 1) * count + key[0] + FIRST, FIRST + key[0])
            times = np.where(code > 0, number[where] if len(number) else 0, 0)
            out.append((key[0], block, pack(code, np.uint8), b"" if last else pack(ids, np.uint64), b"" if last else pack(times, np.int64), None))
        out.append((key[0], None, None, None, None, data))
        return pd.DataFrame(out, columns=["shard", "block", "payload", "ids", "counts", "trie"])

    return run


def _joined(table: DataFrame, answers: DataFrame, level: int, names: list[str]) -> DataFrame:
    of = answers.where("block IS NOT NULL").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("shard", *names))).alias("a"))
    return table.join(of.select("block", *[F.col(f"a.{c}").alias(f"{c}{level}") for c in names]), "block")


def score(docs: DataFrame, order: int = ORDER, block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, DataFrame]:
    """(scores, model): a row per document, and the trie as one row per level and shard."""
    count = shards(docs.sparkSession)
    table = token_blocks(docs, block_chars)
    sizes = table.mapInPandas(_sizes, "train_docs long, train_words long").agg(
        F.coalesce(F.sum("train_docs"), F.lit(0)).alias("train_docs"), F.coalesce(F.sum("train_words"), F.lit(0)).alias("w"))
    words = stage_table(table.mapInPandas(_send_words(count), "shard int, block string, words binary, counts binary")
                        .groupBy("shard").applyInPandas(_tally_words, "shard int, block string, types long, ids binary, counts binary"), "words")
    types = words.groupBy("shard").agg(F.max("types").alias("t")).agg(F.coalesce(F.sum("t"), F.lit(0)).alias("t"))
    (train_docs, train_words), (distinct,) = sizes.first(), types.first()
    numbers = {"train_docs": train_docs, "total": train_words + train_docs, "types": distinct + (train_docs > 0)}
    table = _joined(table, words, 1, ["ids", "counts"]).withColumns({k: F.lit(v).cast("long") for k, v in numbers.items()})
    model = None
    sent = "shard int, block string, contexts binary, totals binary, sizes binary, words binary, counts binary"
    for level in range(2, order + 1):
        got = table.mapInPandas(_send_pairs(level, count), sent).groupBy("shard").applyInPandas(
            _build_and_answer(count, level == order), "shard int, block string, payload binary, ids binary, counts binary, trie binary")
        got = stage_table(got, f"level{level}")
        tries = got.where("block IS NULL").select(F.lit(level).alias("level"), "shard", "trie")
        model = tries if model is None else model.unionAll(tries)
        table = _joined(table, got, level, ["payload", "ids", "counts"] if level < order else ["payload"])
    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return table.mapInPandas(_scored(order, count), result), model


def _sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples():
            block = TokenBlock(row)
            train = [not held_out(d) for d in block.doc_ids]
            yield pd.DataFrame({"train_docs": [sum(train)], "train_words": [int(block.sizes[train].sum())]})


def _scored(order: int, count: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                t = _Counted(row, order, count)
                per = lambda v: np.add.reduceat(v, t.starts) if len(t.starts) else v  # noqa: B023, E731
                yield pd.DataFrame({
                    "doc_id": pd.array(t.block.doc_ids, "Int64"), "held_out": t.held, "n_tokens": t.ends - t.starts,
                    "n_known": per((t.known > 0).astype(np.int64)), "train_tokens": t.total, "base_score": per(t.base),
                    "score": per(np.log10(t.p)),
                })

    return run
