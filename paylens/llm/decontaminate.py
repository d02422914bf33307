"""Benchmark decontamination with a distributed positional inverted index.

The index is a table of segments in the shared folder, like that of a search
engine: a segment holds the postings (word -> ascending positions) of a block of
whole documents. Building it takes no shuffle, and no word is hot, as the
postings of a frequent word lie in every segment. Benchmark windows visit all
segments in batches of bounded size; a window starts from its rarest word
and intersects the other words' lists, each shifted by its offset.

Null texts have no words; an item without words has no window. The words of an item without id are hit like others, but it is in no
list of items; ids are whole numbers. Repeated rows are
each reported; repeated items count once. Empty tables give empty results or
documents without hits. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.llm.blocks import (
    BLOCK_CHARS, alnum_words, blocks, columns, ids_of, keyed, number_words, pack, pack_bytes, pack_ids, texts_of, unpack,
    unpack_bytes, unpack_ids, without,
)
from paylens.session import stage_table

#: Free positions between two documents; the widest span of a proximity match.
GAP = 256
#: Characters of benchmark text per batch of windows that visits the index.
BATCH_CHARS = 4_000_000

SEGMENT = T.StructType([
    T.StructField("segment", T.StringType()),
    T.StructField("doc_ids", T.BinaryType()),
    T.StructField("text_keys", T.BinaryType()),
    T.StructField("lengths", T.BinaryType()),
    T.StructField("terms", T.BinaryType()),
    T.StructField("sizes", T.BinaryType()),
    T.StructField("steps", T.BinaryType()),
])
MATCH = T.StructType([
    T.StructField("segment", T.StringType()),
    T.StructField("place", T.IntegerType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("text_key", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.LongType())),
    T.StructField("near_items", T.ArrayType(T.LongType())),
])


def build_index(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Segments of (doc_id, text) rows, written to the shared folder and read back."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for n, block in enumerate(blocks(batches, "text", block_chars)):
            ids, ends, words = number_words([alnum_words(t) for t in texts_of(block, "text")])
            lengths = np.diff(ends, prepend=0)
            order = np.argsort(ids, kind="stable")
            shift = np.repeat(np.arange(len(ends)) * GAP, lengths)
            positions = (np.arange(len(ids)) + shift)[order]
            sizes = np.bincount(ids, minlength=len(words))
            steps = np.diff(positions, prepend=0)
            firsts = np.cumsum(sizes) - sizes
            steps[firsts] = positions[firsts]
            yield pd.DataFrame({
                "segment": [f"{part}-{n}"], "doc_ids": [pack_ids(ids_of(block, "doc_id"))], "lengths": [pack(lengths, np.uint32)],
                "text_keys": [pack(block["text_key"], np.int64)],
                "terms": [pack_bytes(b" ".join(words))], "sizes": [pack(sizes, np.uint32)], "steps": [pack(steps, np.uint64)],
            })

    return stage_table(keyed(docs).mapInPandas(build, SEGMENT), "positional_index")


class Segment:
    """Postings of one segment."""

    def __init__(self, row):
        terms = unpack_bytes(row.terms).split()
        self.sizes = unpack(row.sizes, np.uint32).astype(np.int64)
        self.at = dict(zip(terms, range(len(terms))))
        ends = np.cumsum(self.sizes)
        self.firsts = ends - self.sizes
        # one running sum; each list starts anew at the sum before it
        total = np.cumsum(unpack(row.steps, np.uint64).astype(np.int64))
        before = np.where(self.firsts > 0, total[self.firsts - 1], 0) if len(total) else self.firsts
        self.positions = total - np.repeat(before, self.sizes)

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.firsts[term]:self.firsts[term] + self.sizes[term]]

    def phrase(self, terms: list[int]) -> np.ndarray:
        """Positions at which the terms stand one after another."""
        order = sorted(range(len(terms)), key=lambda k: self.sizes[terms[k]])
        starts = self.postings(terms[order[0]]) - order[0]
        for k in order[1:]:
            if not len(starts):
                break
            there = self.postings(terms[k])
            at = np.searchsorted(there, starts + k)
            starts = starts[there[np.minimum(at, len(there) - 1)] == starts + k]
        return starts

    def covers(self, need: dict[int, int], anchor: int, span: int) -> bool:
        """Do the needed terms, with their repetitions, stand within ``span`` positions near the anchor?"""
        events = []
        for t in need:
            there = self.postings(t)
            lo, hi = np.searchsorted(there, [anchor - span + 1, anchor + span])
            events += [(int(p), t) for p in there[lo:hi]]
        events.sort()
        have, missing, left = dict.fromkeys(need, 0), len(need), 0
        for p, t in events:
            have[t] += 1
            missing -= have[t] == need[t]
            while events[left][0] <= p - span:
                gone = events[left][1]
                missing += have[gone] == need[gone]
                have[gone] -= 1
                left += 1
            if not missing:
                return True
        return False


def windows(texts: list[tuple[int | None, str | None]], size: int) -> dict[tuple[bytes, ...], set[int]]:
    """Distinct windows of ``size`` words with their items, of which those without id have no name; a shorter item is one window."""
    out: dict[tuple[bytes, ...], set[int]] = {}
    for item, text in texts:
        words = alnum_words(text)
        for i in range(max(1, len(words) - size + 1) if words else 0):
            of = out.setdefault(tuple(words[i:i + size]), set())
            if item is not None:
                of.add(item)
    return out


def matches(index: DataFrame, items: DataFrame, window: int = 13, slop: int = 7, batch_chars: int = BATCH_CHARS) -> DataFrame:
    """Per document of the index: words inside an occurrence of a window, and the items found.

    ``items`` (item_id, text) are the queries. ``hits`` are the places of hit words in the document,
    ``items`` those with a window that occurs word for word, ``near_items`` those
    with a window whose words all stand within ``window + slop`` words in any order.
    Batches are formed by a hash of the item; each holds about ``batch_chars`` characters.
    """
    if window + slop > GAP:
        raise ValueError(f"a span may have {GAP} words at most")
    queries = columns(items, "item_id", "text")
    total = queries.agg(F.sum(F.length("text"))).first()[0] or 0
    n = total // batch_chars + 1
    found = None
    for b in range(n):
        mine = queries.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        part = index.mapInPandas(_visit(windows([(r.item_id, r.text) for r in mine], window), slop), MATCH)
        found = part if found is None else found.unionAll(part)
    gathered = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    return found.groupBy("segment", "place", "doc_id", "text_key", "n_words").agg(
        *[gathered(c).alias(c) for c in ("hits", "items", "near_items")]).drop("segment", "place")


def _visit(wanted: dict[tuple[bytes, ...], set[int]], slop: int):
    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                yield _of_segment(row, wanted, slop)

    return visit


def _of_segment(row, wanted, slop: int) -> pd.DataFrame:
    segment = Segment(row)
    lengths = unpack(row.lengths, np.uint32).astype(np.int64)
    starts = np.cumsum(lengths + GAP) - lengths - GAP
    hits: dict[int, set[int]] = {}
    exact: dict[int, set[int]] = {}
    close: dict[int, set[int]] = {}
    at = segment.at
    for words, of in wanted.items():
        terms = []
        for w in words:
            if (t := at.get(w)) is None:
                break
            terms.append(t)
        else:
            found = segment.phrase(terms)
            docs = np.searchsorted(starts, found, "right") - 1
            for p, d in zip(found.tolist(), docs.tolist()):
                hits.setdefault(d, set()).update(range(p - int(starts[d]), p - int(starts[d]) + len(words)))
                exact.setdefault(d, set()).update(of)
            for d in _near_docs(segment, terms, len(words) + slop, starts, set(docs.tolist())):
                close.setdefault(d, set()).update(of)
    for d, of in exact.items():
        close.setdefault(d, set()).update(of)
    n = len(lengths)
    listed = lambda found: [sorted(found.get(d, ())) for d in range(n)]
    return pd.DataFrame({
        "segment": [row.segment] * n, "place": range(n), "doc_id": pd.array(unpack_ids(row.doc_ids), "Int64"),
        "text_key": unpack(row.text_keys, np.int64), "n_words": lengths,
        "hits": listed(hits), "items": listed(exact), "near_items": listed(close),
    })


def _near_docs(segment: Segment, terms: list[int], span: int, starts: np.ndarray, known: set[int]) -> set[int]:
    """Documents, other than the known ones, in which the terms stand within ``span`` words."""
    need: dict[int, int] = {}
    for t in terms:
        need[t] = need.get(t, 0) + 1
    order = sorted(need, key=lambda t: segment.sizes[t])
    anchors = segment.postings(order[0])
    if known:
        anchors = anchors[~np.isin(np.searchsorted(starts, anchors, "right") - 1, list(known))]
    for t in order[1:]:
        if not len(anchors):
            return set()
        there = segment.postings(t)
        first = np.searchsorted(there, anchors - span + 1)
        anchors = anchors[(first < len(there)) & (there[np.minimum(first, len(there) - 1)] < anchors + span)]
    out: set[int] = set()
    for p in anchors.tolist():
        d = int(np.searchsorted(starts, p, "right")) - 1
        if d not in out and segment.covers(need, p, span):
            out.add(d)
    return out


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, slop: int = 7, percent: int = 5) -> DataFrame:
    """The verdict per document: contaminated if at least ``percent`` % of its words are hit, and one is."""
    found = matches(build_index(docs), items, window, slop)
    n_hit = F.size("hits").cast("long")
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 100 >= F.col("n_words") * percent))


def drop_contaminated(docs: DataFrame, items: DataFrame, null_ids: bool = False, **options) -> DataFrame:
    """``docs`` without contaminated documents; a doc_id and a text name a document.

    Rows without a doc_id stay, unless ``null_ids``: then they are judged like all others.
    """
    bad = contamination(docs, items, **options).where("contaminated")
    return without(docs, bad if null_ids else bad.where("doc_id IS NOT NULL"))
