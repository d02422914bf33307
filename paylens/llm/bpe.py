"""BPE encoding and decoding with a minimal acyclic transducer for frequent words.

Words are counted over all documents (packed arrays by block and shard). The most frequent ones, a number that is a
parameter, are encoded once and compiled into an automaton in which words share suffixes as well as prefixes. An arc
carries how many words come before those behind it; the sum along a path is the word's number, and
the number leads to its ids. Tasks read the automaton through a memory map.
Every other word is merged by rank, which gives the same ids; the automaton only saves work.

Texts are taken as the tokenizer file has it: its added tokens are found in the raw text; the rest is brought to NFC,
lower-cased character by character, and cut by the pattern; a word's UTF-8 bytes, the last with the word-end mark, are the
first symbols. Decoding joins the tokens' strings by a space, as a tokenizer without decoder does.

Null and empty texts have no ids and decode to an empty text. Repeated rows are each encoded. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import re
import tempfile
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import repeat

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.blocks import (
    BLOCK_CHARS, blocks, columns, cut, ids_of, mix, pack, pack_bytes, shards, texts_of, unpack, unpack_bytes, word_hashes,
)
from paylens.session import stage_table

# The tokenizer's library cuts by Unicode 16 and lower-cases by Unicode 17; the installed modules know other versions.
#: Characters that the installed pattern module takes for letters or numerals, but Unicode 16 does not have.
LATER = (
    "\\u0558\\u058b-\\u058c\\u088f\\u0c5c\\u0cdc\\u208f\\u209d-\\u209f\\ua7ce-\\ua7cf\\ua7d2\\ua7d4\\ua7dd\\ua7e2\\ua7f1\\uab6c-\\uab6d"
    "\\U000107bb-\\U000107bf\\U00010940-\\U00010959\\U00010ec5-\\U00010ec7\\U00010ed9-\\U00010eee\\U00011b0a\\U00011db0-\\U00011ddb"
    "\\U00011de0-\\U00011de9\\U00011df1\\U0001246f\\U00012475-\\U0001247f\\U00012550-\\U00012686\\U00016ea0-\\U00016eb8\\U00016ebb-\\U00016ed3"
    "\\U00016ff2-\\U00016ff6\\U000187f8-\\U000187ff\\U00018cd6-\\U00018cda\\U00018d09-\\U00018d20\\U00018d80-\\U00018df2\\U00018e00-\\U00019191"
    "\\U000191a0-\\U000191d2\\U0001b123-\\U0001b128\\U0001b168\\U0001d6a6\\U0001df1f-\\U0001df24\\U0001df2b-\\U0001df81\\U0001df90-\\U0001df96"
    "\\U0001dfcd-\\U0001dfff\\U0001e6c0-\\U0001e6de\\U0001e6e0-\\U0001e6e2\\U0001e6e4-\\U0001e6e5\\U0001e6e7-\\U0001e6ed\\U0001e6f0-\\U0001e6f4"
    "\\U0001e6fe-\\U0001e6ff\\U0002b73a-\\U0002b73f\\U0002b81e\\U0002cea2-\\U0002cead\\U000323b0-\\U00033479\\U0003d000-\\U0003fc3f")
#: Capitals that Python does not lower-case yet: first, last, first small letter.
LOWERED = (
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x0264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3),
    (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x019B), (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB))

#: Words in the automaton.
LEXICON = 50_000
#: Chunks, and words, in a generation of a task's memory.
REMEMBERED = 300_000
#: Words of more bytes are merged with a heap.
LONG = 100
#: Ids are below this; a merge is one number, its rank times this and its id.
IDS = 1 << 24
#: A pair that never merges.
NEVER = 1 << 62


_LATER = regex.compile(f"[{LATER}]")
_LOWER = {a + i: low + i for a, b, low in LOWERED for i in range(b - a + 1)} | {ord("Σ"): "σ"}


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


@dataclass
class Bpe:
    """Rules of a tokenizer file: byte-level BPE with a word-end mark."""

    tokens: list[bytes]  # string of each id, in UTF-8
    merges: dict[tuple[int, int], int]  # pair -> rank * IDS + id
    inner: list[int]  # id of each byte inside a word
    final: list[int]  # id of each byte at its end
    added: dict[str, int]
    pattern: str

    @classmethod
    def load(cls, path: str) -> Bpe:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cutter = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cutter] != ["Split", "ByteLevel"] or spec["decoder"]:
            raise ValueError("not a tokenizer file of this kind")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [b""] * (1 + max([*vocab.values(), *added.values()]))
        for token, i in [*vocab.items(), *added.items()]:
            tokens[i] = token.encode()
        merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            merges.setdefault((vocab[a], vocab[b]), rank * IDS + vocab[a + b])
        symbols = byte_symbols()
        return cls(tokens, merges, [vocab[s] for s in symbols], [vocab[s + end] for s in symbols], added,
                   cutter[0]["pattern"]["Regex"])

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the pair of lowest rank is merged, leftmost first, until none is left."""
        ids = [self.inner[b] for b in word[:-1]]
        ids.append(self.final[word[-1]])
        if len(ids) > LONG:
            return self._merge_long(ids)
        get = self.merges.get
        ranks = list(map(get, zip(ids, ids[1:]), repeat(NEVER)))
        while ranks and (low := min(ranks)) < NEVER:
            i = ranks.index(low)
            new = ids[i] = low % IDS
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], new), NEVER)
            if i < len(ranks):
                ranks[i] = get((new, ids[i + 1]), NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for long words: pairs wait in a heap by rank and place, and neighbours are linked."""
        n, get = len(ids), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i, pair) for i, pair in enumerate(zip(ids, ids[1:])) if (m := get(pair)) is not None]
        heapify(heap)
        while heap:
            low, i, pair = heappop(heap)
            j = after[i]
            if j >= n or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j], after[i] = low % IDS, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n and (m := get(pair := (ids[left], ids[after[left]]))) is not None:
                    heappush(heap, (m, left, pair))
        return [i for i in ids if i >= 0]


class Encoder:
    """Cuts chunks between ASCII white space into words and encodes them; remembers recent chunks and words."""

    def __init__(self, bpe: Bpe, lexicon: Lexicon | None = None):
        self.bpe, self.lexicon = bpe, lexicon
        # white space by its Unicode property, as \s means in the tokenizer's pattern
        self.pattern = regex.compile(bpe.pattern.replace(r"\s", r"\p{White_Space}"))
        # the same for ASCII, where letters are a-z after lower-casing
        ascii_only = bpe.pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")
        self.ascii = re.compile(ascii_only.encode()).findall
        self.added = regex.compile("(" + "|".join(map(regex.escape, sorted(bpe.added, key=len, reverse=True))) + ")") if bpe.added else None
        self.special = re.compile(b"|".join(re.escape(a.encode()) for a in bpe.added) or b"(?!)").search
        self.chunks, self.seen = Memory(), Memory()

    def words(self, chunk: bytes) -> list[bytes | int]:
        """Words as UTF-8 bytes, and added tokens as their ids."""
        if chunk.isascii() and not self.special(chunk):
            return self.ascii(chunk.lower())
        text = chunk.decode()
        out: list[bytes | int] = []
        for part in self.added.split(text) if self.added else [text]:
            if part in self.bpe.added:
                out.append(self.bpe.added[part])
            elif part:
                part = unicodedata.normalize("NFC", part)
                if max(part) < "\u0370":  # before the first letter that needs care
                    out += [w.encode() for w in self.pattern.findall(part.lower())]
                    continue
                part = part.translate(_LOWER).lower()
                known = _LATER.sub("\ue000", part)  # a character of private use is neither letter nor numeral
                out += [part[m.start():m.end()].encode() for m in self.pattern.finditer(known)]
        return out

    def word(self, word: bytes) -> bytes:
        got = self.seen.get(word)
        if got is None:
            ids = (self.lexicon and self.lexicon.get(word)) or self.bpe.merge(word)
            got = self.seen.put(word, array("I", ids).tobytes())
        return got

    def chunk(self, chunk: bytes) -> bytes:
        got = self.chunks.get(chunk)
        if got is None:
            got = self.chunks.put(chunk, b"".join([array("I", [w]).tobytes() if isinstance(w, int) else self.word(w) for w in self.words(chunk)]))
        return got

    def text(self, text: str | None) -> bytes:
        """Ids of a text, as little-endian unsigned 32-bit integers."""
        chunks = text.encode().split() if text else []
        out = list(map(self.chunks.young.get, chunks))
        if None in out:
            out = [self.chunk(c) if ids is None else ids for c, ids in zip(chunks, out)]
        return b"".join(out)


class Memory:
    """A cache of two generations: when the younger is full, it replaces the older."""

    def __init__(self, size: int = REMEMBERED):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key: bytes) -> bytes | None:
        got = self.young.get(key)
        if got is None and (got := self.old.get(key)) is not None:
            self.put(key, got)
        return got

    def put(self, key: bytes, value: bytes) -> bytes:
        if len(self.young) >= self.size:
            self.young, self.old = {}, self.young
        self.young[key] = value
        return value


#: The encoder of a worker process, with what it remembers, for the next task of the same job.
_LAST: dict[str, Encoder] = {}


def _encoder(bpe: Bpe, lexicon: bytes) -> Encoder:
    key = hashlib.sha256(lexicon).hexdigest()
    if key not in _LAST or _LAST[key].bpe.tokens != bpe.tokens or _LAST[key].bpe.pattern != bpe.pattern:
        _LAST.clear()
        _LAST[key] = Encoder(bpe, Lexicon(lexicon))
    return _LAST[key]


class Lexicon:
    """A minimal acyclic automaton over bytes whose arcs add up to a word's number, with the ids of each number."""

    def __init__(self, data: bytes):
        self.file = tempfile.TemporaryFile()  # without a name: it goes with the map
        self.file.write(data)
        self.file.flush()
        self.map = mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = np.frombuffer(self.map[:40], np.int64).tolist()
        ends = np.cumsum([40, *sizes]).tolist()
        view = memoryview(self.map)
        self.first, self.targets, self.skips, self.at, self.ids = (
            view[a:b].cast("I") for a, b in zip(ends, ends[1:]))
        self.labels = ends[-1]

    def get(self, word: bytes) -> list[int] | None:
        """Ids of a word of the lexicon. Bit 31 of a state's first arc tells that a word ends there."""
        first, targets, skips, find, base = self.first, self.targets, self.skips, self.map.find, self.labels
        state = number = 0
        for b in word:
            lo, hi = first[state] & 0x7FFFFFFF, first[state + 1] & 0x7FFFFFFF
            arc = find(_BYTES[b], base + lo, base + hi) - base
            if arc < lo:
                return None
            number += skips[arc]
            state = targets[arc]
        if not first[state] >> 31:
            return None
        return self.ids[self.at[number]:self.at[number + 1]].tolist()

    @staticmethod
    def build(entries: dict[bytes, list[int]]) -> bytes:
        """Words are added in order; a state that gets no more arcs is replaced by an equal one, if there is one."""
        nodes: list[list] = [[False, {}]]  # [a word ends here, label -> node]
        equal: dict[tuple, int] = {}
        path: list[int] = [0]

        def close(depth: int, word: bytes) -> None:
            for d in range(len(path) - 1, depth, -1):
                node = nodes[path[d]]
                same = equal.setdefault((node[0], tuple(node[1].items())), path[d])
                nodes[path[d - 1]][1][word[d - 1]] = same
            del path[depth + 1:]

        before, order = b"", sorted(entries)
        for word in order:
            common = 0
            while common < min(len(word), len(before)) and word[common] == before[common]:
                common += 1
            close(common, before)
            for b in word[common:]:
                nodes.append([False, {}])
                nodes[path[-1]][1][b] = len(nodes) - 1
                path.append(len(nodes) - 1)
            nodes[path[-1]][0] = True
            before = word
        close(0, before)

        words: dict[int, int] = {}  # words behind a state, by state
        stack = [0]
        while stack:
            s = stack[-1]
            open_ = [t for t in nodes[s][1].values() if t not in words]
            if open_:
                stack += open_
                continue
            stack.pop()
            words[s] = nodes[s][0] + sum(words[t] for t in nodes[s][1].values())
        number = {0: 0}
        for s in sorted(words):
            number.setdefault(s, len(number))
        first, targets, skips, labels = [], [], [], bytearray()
        for s in number:
            ends, arcs = nodes[s]
            first.append(len(labels) | ends << 31)
            skipped = int(ends)
            for label, t in sorted(arcs.items()):
                labels.append(label)
                targets.append(number[t])
                skips.append(skipped)
                skipped += words[t]
        first.append(len(labels))
        ids = [entries[w] for w in order]
        at = np.cumsum([0, *map(len, ids)])
        arrays = [np.array(a, np.uint32).tobytes() for a in (first, targets, skips, at, [i for x in ids for i in x])]
        return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(arrays) + bytes(labels)


_BYTES = [bytes([b]) for b in range(256)]


def word_counts(docs: DataFrame, bpe: Bpe, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(word, count) over all documents, as rows of shards: words and counts packed, most frequent first."""
    count = shards(docs.sparkSession)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(bpe)
        for block in blocks(batches, "text", block_chars):
            chunks: Counter[bytes] = Counter()
            for t in texts_of(block, "text"):
                if t:
                    chunks.update(t.encode().lower().split())
            words: dict[bytes, int] = {}
            for c, n in chunks.items():
                for w in encoder.words(c):
                    if not isinstance(w, int):
                        words[w] = words.get(w, 0) + n
            names = list(words)
            hashes = mix(word_hashes(names))
            order = np.argsort(hashes, kind="stable")
            at = cut(hashes[order], count)
            names = [names[i] for i in order.tolist()]
            counts = np.fromiter(words.values(), np.int64, len(words))[order]
            yield pd.DataFrame({
                "shard": range(count), "words": [pack_bytes(b" ".join(names[a:b])) for a, b in zip(at, at[1:])],
                "counts": [pack(counts[a:b], np.int64) for a, b in zip(at, at[1:])],
            })

    def tally(key, frame: pd.DataFrame) -> pd.DataFrame:
        total: dict[bytes, int] = {}
        for words, counts in zip(frame["words"], frame["counts"]):
            for w, n in zip(unpack_bytes(words).split(b" "), unpack(counts, np.int64).tolist()):
                total[w] = total.get(w, 0) + n
        order = sorted(total, key=lambda w: (-total[w], w))
        return pd.DataFrame({"shard": [key[0]], "words": [pack_bytes(b" ".join(order))],
                             "counts": [pack(np.array([total[w] for w in order], np.int64), np.int64)]})

    sent = columns(docs, "text").mapInPandas(send, "shard int, words binary, counts binary")
    return sent.groupBy("shard").applyInPandas(tally, "shard int, words binary, counts binary")


def frequent_words(docs: DataFrame, bpe: Bpe, size: int = LEXICON, block_chars: int = BLOCK_CHARS) -> list[bytes]:
    """The ``size`` most frequent words; ties go to the smaller one.

    Shards first tell how many of their words lie on each level of frequency (eight levels per doubling). Then only words
    from the level on which the ``size``-th lies are sent, so what is sent follows ``size`` and not the number of shards.
    """
    table = stage_table(word_counts(docs, bpe, block_chars), "word_counts")

    def levels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for counts in batch["counts"]:
                level, n = np.unique(_level(unpack(counts, np.int64)), return_counts=True)
                yield pd.DataFrame({"level": level, "n": n})

    total, least = 0, 0
    found = table.select("counts").mapInPandas(levels, "level int, n long").groupBy("level").agg(F.sum("n").alias("n"))
    for row in found.orderBy(F.desc("level")).collect():  # at most 8 * 63 levels
        least, total = row.level, total + row.n
        if total >= size:
            break

    def leading(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for words, counts in zip(batch["words"], batch["counts"]):
                n = unpack(counts, np.int64)
                n = n[_level(n) >= least][:size]  # they come most frequent first
                if len(n):
                    yield pd.DataFrame({"word": unpack_bytes(words).split(b" ")[:len(n)], "n": n})

    top = table.mapInPandas(leading, "word binary, n long")
    return [bytes(r.word) for r in top.orderBy(F.desc("n"), "word").limit(size).collect()]


def _level(counts: np.ndarray) -> np.ndarray:
    return np.floor(8 * np.log2(np.maximum(counts, 1))).astype(np.int32)


def lexicon_of(docs: DataFrame, bpe: Bpe, size: int = LEXICON, block_chars: int = BLOCK_CHARS) -> bytes:
    """The automaton of the most frequent words. Its size is bounded by ``size`` and the length of words."""
    return Lexicon.build({w: bpe.merge(w) for w in frequent_words(docs, bpe, size, block_chars)})


def encode(docs: DataFrame, bpe: Bpe, lexicon_size: int = LEXICON, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, ids, text, n_tokens, ids_sha256, decoded_sha256) of every document; ``text`` is decoded from the ids.

    ``ids`` are little-endian unsigned 32-bit integers; the digests are of them and of the decoded text. Columns that a
    query does not select are not sent to it.
    """
    return _encoded(docs, bpe, lexicon_size, block_chars, ("ids", "text"))


def digests(docs: DataFrame, bpe: Bpe, lexicon_size: int = LEXICON, block_chars: int = BLOCK_CHARS, ids: bool = False) -> DataFrame:
    """``encode`` without the decoded text, and with the ids only if asked for."""
    return _encoded(docs, bpe, lexicon_size, block_chars, ("ids",) if ids else ())


def _encoded(docs: DataFrame, bpe: Bpe, lexicon_size: int, block_chars: int, more: tuple[str, ...]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((bpe, lexicon_of(docs, bpe, lexicon_size, block_chars)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rules, data = shared.value
        encoder = _encoder(rules, data)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for block in blocks(batches, "text", block_chars // 8):
            ids = [encoder.text(t) for t in texts_of(block, "text")]
            out = {"doc_id": pd.array(ids_of(block, "doc_id"), "Int64"), "n_tokens": [len(i) // 4 for i in ids],
                   "ids_sha256": [sha(i) for i in ids]}
            if "text" in more:
                out["text"] = [decode(i, rules).decode() for i in ids]
                out["decoded_sha256"] = [sha(t.encode()) for t in out["text"]]
            else:
                out["decoded_sha256"] = [sha(decode(i, rules)) for i in ids]
            if "ids" in more:
                out["ids"] = ids
            yield pd.DataFrame(out)

    kinds = {"ids": "ids binary", "text": "text string"}
    schema = ", ".join(["doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", *[kinds[c] for c in more]])
    return columns(docs, "doc_id", "text").mapInPandas(run, schema)


def decode(ids: bytes, bpe: Bpe) -> bytes:
    """The tokens' strings, joined by a space, in UTF-8."""
    return b" ".join(map(bpe.tokens.__getitem__, memoryview(ids).cast("I")))
