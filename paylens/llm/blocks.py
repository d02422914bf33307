"""Texts in blocks, and packed integer arrays that travel between blocks and shards.

Several operators need a statistic for every distinct item (word, n-gram,
shingle) of the corpus, and need it back where the item occurs. As rows of one
item each, that is a shuffle many times the size of the corpus. Here the scan
groups whole texts into *blocks* of bounded size, a block reduces its items to
distinct ones, and sends each *shard* (a range of hashes) one packed array.
Shards answer with one packed array per block, in the order in which the block
sent. A frequent item costs one entry per block, so no key is hot.
"""

from __future__ import annotations

import tempfile
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.session import stage_table

BLOCK_CHARS = 5_000_000

#: Everything but 0-9, a-z and bytes of non-ASCII characters becomes a space.
_ALNUM = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def space_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space (9-13 and 32), with A-Z lower-cased; null has none."""
    return text.encode().lower().split() if text else []


def alnum_words(text: str | None) -> list[bytes]:
    """Words of 0-9, a-z and non-ASCII characters, with A-Z lower-cased; null has none."""
    return text.encode().lower().translate(_ALNUM).split() if text else []


def number_words(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Word numbers of all documents in a row, the ends of the documents, and the distinct words."""
    seen: defaultdict[bytes, int] = defaultdict()
    seen.default_factory = seen.__len__
    get = seen.__getitem__
    ends = np.cumsum([len(d) for d in docs], dtype=np.int64)
    ids = np.fromiter((get(w) for d in docs for w in d), np.uint32, int(ends[-1]) if len(ends) else 0)
    return ids, ends, list(seen)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads them evenly (the finaliser of splitmix64)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def pack(values: np.ndarray, dtype) -> bytes:
    """Integers as compressed byte planes: small numbers cost little whatever their type."""
    a = np.ascontiguousarray(values, dtype)
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).reshape(-1).view(dtype)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned integers, as differences."""
    return pack(np.diff(values.astype(np.uint64), prepend=np.uint64(0)), np.uint64)


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def pack_bytes(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpack_bytes(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def mapped(data: bytes, dtype=np.uint8) -> np.ndarray:
    """``data`` as a read-only memory map of a file that vanishes with it.

    The file has no name once it is open, so nothing is left behind and nobody
    else could come to depend on it.
    """
    if not len(data):
        return np.zeros(0, dtype)
    with tempfile.TemporaryFile() as f:
        f.write(data)
        f.flush()
        return np.memmap(f, dtype, "r")


def blocks(batches: Iterator[pd.DataFrame], text: str, limit: int) -> Iterator[pd.DataFrame]:
    """Rows regrouped so that a frame has up to ``limit`` characters of text, or one longer text."""
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        lengths = batch[text].map(lambda t: len(t) if isinstance(t, str) else 0).to_numpy()
        start = 0
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                yield pd.concat([*held, batch.iloc[start:i]], ignore_index=True)
                held, size, start = [], 0, i
            size += int(n) + 1
        held.append(batch.iloc[start:])
    if held and sum(map(len, held)):
        yield pd.concat(held, ignore_index=True)


def texts_of(frame: pd.DataFrame, column: str) -> list[str | None]:
    return [t if isinstance(t, str) else None for t in frame[column]]


def ids_of(frame: pd.DataFrame, column: str) -> list[int | None]:
    return [None if pd.isna(v) else int(v) for v in frame[column]]


def pack_ids(ids: list[int | None]) -> bytes:
    """Nullable 64-bit integers."""
    return pack(np.array([0 if i is None else i for i in ids] + [i is None for i in ids], np.int64), np.int64)


def unpack_ids(data: bytes) -> list[int | None]:
    values, nulls = np.split(unpack(data, np.int64), 2)
    return [None if n else v for v, n in zip(values.tolist(), nulls.tolist())]


def shards(spark: SparkSession) -> int:
    """As many shards as the session has shuffle partitions: one setting for the size of a task."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@cache
def _edges(n: int, bits: int) -> np.ndarray:
    return np.array([(i << bits) // n for i in range(1, n)], np.uint64)


def cut(sorted_hashes: np.ndarray, n: int, bits: int = 64) -> np.ndarray:
    """Start of each shard's range in sorted hashes of ``bits`` bits, and the end."""
    inner = np.searchsorted(sorted_hashes, _edges(n, bits))
    return np.concatenate([[0], inner, [len(sorted_hashes)]]).astype(np.int64)


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: extra ones, whatever their names, never reach an operator."""
    return df.select(*[df[n] for n in names])


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, text_key): the id, which may be null or shared, and the hash of the text name a row."""
    return columns(docs, "doc_id", "text").withColumn("text_key", F.xxhash64("text"))


def without(docs: DataFrame, names: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``names`` (doc_id, text_key) has; a null id equals a null id."""
    return docs.join(*_named(docs, names), "left_anti")


def only(docs: DataFrame, names: DataFrame) -> DataFrame:
    return docs.join(*_named(docs, names), "left_semi")


def _named(docs: DataFrame, names: DataFrame):
    of = names.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key")).distinct()
    return of, docs["doc_id"].eqNullSafe(of["_doc"]) & (F.xxhash64(docs["text"]) == of["_key"])


TOKEN_BLOCK = T.StructType([
    T.StructField("block", T.StringType()),
    T.StructField("doc_ids", T.BinaryType()),
    T.StructField("text_keys", T.BinaryType()),
    T.StructField("sizes", T.BinaryType()),
    T.StructField("tokens", T.BinaryType()),
    T.StructField("words", T.BinaryType()),
])


def token_blocks(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of (doc_id, text) rows as numbered words, written to the shared folder and read back.

    A block has its documents' ids, hashes of texts and word counts, the words' numbers in the
    block, and the distinct words. Words are those of ``space_words``.
    """

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        for n, block in enumerate(blocks(batches, "text", block_chars)):
            tokens, ends, words = number_words([space_words(t) for t in texts_of(block, "text")])
            yield pd.DataFrame({
                "block": [f"{part}-{n}"], "doc_ids": [pack_ids(ids_of(block, "doc_id"))],
                "text_keys": [pack(block["text_key"], np.int64)],
                "sizes": [pack(np.diff(ends, prepend=0), np.uint32)], "tokens": [pack(tokens, np.uint32)],
                "words": [pack_bytes(b" ".join(words))],
            })

    return stage_table(keyed(docs).mapInPandas(number, TOKEN_BLOCK), "token_blocks")


class TokenBlock:
    """A row of ``token_blocks``, unpacked."""

    def __init__(self, row):
        self.block = row.block
        self.doc_ids = unpack_ids(row.doc_ids)
        self.text_keys = unpack(row.text_keys, np.int64).tolist()
        self.sizes = unpack(row.sizes, np.uint32).astype(np.int64)
        self.tokens = unpack(row.tokens, np.uint32)
        self.words = unpack_bytes(row.words).split()
        self.ends = np.cumsum(self.sizes)


def with_answers(table: DataFrame, answers: DataFrame) -> DataFrame:
    """Blocks with their shards' answers in order of the shards: column ``answers``."""
    of = answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("shard", "payload"))).alias("answers"))
    return table.join(of, "block", "left").withColumn("answers", F.col("answers.payload"))


#: Tasks in which groups of blocks meet, at most.
TASKS = 2000


def met(asked: DataFrame, here: DataFrame, group: int, of_group: int, work, schema: str) -> DataFrame:
    """``work(size, asked, here)`` for groups of packed blocks with a ``number`` and a ``size``, so that every block meets all of its size.

    Groups have up to ``group`` and ``of_group`` blocks on average. A block is moved once for every group of the other side.
    """
    n, m = (max(1, t.count()) for t in (here, asked))
    of_asked = -(-m // group)
    # enough cells for all cores
    of_here = max(-(-n // of_group), min(n, -(-4 * here.sparkSession.sparkContext.defaultParallelism // of_asked)))
    cells, tasks = ("of_here", "of_asked", "size"), min(TASKS, of_here * of_asked)

    def dealt(blocks: DataFrame, own: str, count: int, other: str, times: int) -> DataFrame:
        named = blocks.withColumn(own, F.pmod("number", F.lit(count))).drop("number")
        # cells are long work on few bytes: they are not put together by their size
        return named.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(times - 1)))).repartition(tasks, *cells)

    def meet(key, asked: pd.DataFrame, here: pd.DataFrame) -> pd.DataFrame:
        return work(int(key[2]), asked, here)

    left = dealt(asked, "of_asked", of_asked, "of_here", of_here).groupBy(*cells)
    return left.cogroup(dealt(here, "of_here", of_here, "of_asked", of_asked).groupBy(*cells)).applyInPandas(meet, schema)
