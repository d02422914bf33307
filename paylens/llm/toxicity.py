"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its words and their first four to six letters (a stem in any inflection), hashed to 64 bits; a text is the
set of them. The score is the logistic of

    w_0 + sum of w_i + sum over pairs of <v_i, v_j>

so two terms that are harmless alone can weigh together: the pair term is learned, which no additive weight can express.

Training takes a bounded sample of labelled ids (``SAMPLE``, the first by a hash of the id); rows that repeat an id are
reduced to one. Terms are counted shard by shard, and only those that can get into the model reach the one task that fits it, as 32-bit places. Terms in at least
``MIN_DOCS`` of them whose rate of toxic texts differs from the common one by more than chance (a likelihood ratio)
get a weight and factors, which are fitted together. So do terms without evidence of their own that meet in a *pair* which is toxic
more often than additive weights of both let expect; all pairs of terms in at least ``PAIR_DOCS`` toxic texts are counted, in
blocks of columns, and the ratio they need grows with their number. The model therefore has at most SAMPLE * terms / MIN_DOCS entries,
in practice some hundred, and is checked against ``MAX_TERMS`` before it is sent to the tasks. Scoring reads every whole text, without a shuffle.

Null and empty texts have no terms: their score is that of w_0. Repeated rows are each scored. Labels other than 0 and 1, null ids and
labels without a document are not learned from; with none of either kind the score is their rate. An id with several labels is toxic if
one is; of its different texts one is learned from, the same in any layout. Only doc_id, text and toxic are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.blocks import alnum_words, columns, cut, ids_of, shards, texts_of
from paylens.session import stage_table

SAMPLE = 8000
MIN_DOCS = 5
#: Twice the log-likelihood ratio that a term needs; chance gives so much to one term in a hundred thousand.
EVIDENCE = 20.0
#: Toxic texts that must hold a term before its pairs are counted, and columns of a block of counts.
PAIR_DOCS = 20
PAIR_BLOCK = 512
MAX_TERMS = 1_000_000
FACTORS = 4
THRESHOLD = 0.3
STEMS = (4, 5, 6)
#: Words a task remembers the terms of.
REMEMBERED = 1_000_000


def word_terms(word: bytes) -> list[int]:
    """Hashes of a word and of its stems. Letters are counted, not bytes."""
    letters = word.decode()
    out = [xxhash.xxh3_64_intdigest(word)]
    out += [xxhash.xxh3_64_intdigest(letters[:n].encode(), seed=n) for n in STEMS if len(letters) >= n]
    return out


def terms(text: str | None) -> np.ndarray:
    """Ascending hashes of a text's terms."""
    found = [t for w in set(alnum_words(_lower(text))) for t in word_terms(w)]
    return np.unique(np.array(found, np.uint64))


def _lower(text: str | None) -> str | None:
    return text and text.lower()


@dataclass
class Model:
    """Weights by term; ``terms`` ascend."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def score(self, at: np.ndarray) -> float:
        """Probability for a text that has the model's terms at these places."""
        v = self.factors[at]
        z = self.bias + self.weights[at].sum() + 0.5 * float((v.sum(axis=0) ** 2 - (v ** 2).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _adagrad(state: np.ndarray, gradient: np.ndarray, rate: float) -> np.ndarray:
    state += gradient ** 2
    return rate * gradient / np.sqrt(state + 1e-12)


def fit(texts: list[np.ndarray], labels: np.ndarray, min_docs: int = MIN_DOCS, factors: int = FACTORS, evidence: float = EVIDENCE,
        l2: float = 1e-6, epochs: int = 800) -> Model:
    """The machine from texts' terms and their labels, by full-batch AdaGrad; the order of the rows has no influence."""
    rate = float(labels.mean()) if len(labels) else 0.0
    if rate in (0.0, 1.0):
        return _without_terms(len(labels), rate, factors)
    names, count = _counted(texts)
    toxic = np.bincount(_entries([t for t, label in zip(texts, labels) if label > 0], names)[1], minlength=len(names))
    chosen = _candidates(count, toxic, rate, min_docs, evidence)
    names, count, toxic = names[chosen], count[chosen], toxic[chosen]
    return _fit_entries(*_entries(texts, names), names, count, toxic, labels, factors, evidence, l2, epochs)


def _without_terms(n: int, rate: float, factors: int = FACTORS) -> Model:
    return Model(float(np.log((rate * n + 0.5) / (n - rate * n + 0.5))), np.zeros(0, np.uint64), np.zeros(0), np.zeros((0, factors)))


def _candidates(count: np.ndarray, toxic: np.ndarray, rate: float, min_docs: int = MIN_DOCS, evidence: float = EVIDENCE) -> np.ndarray:
    """Whether a term of so many texts and toxic texts can get into the model, by its own evidence or by that of a pair."""
    return (count >= min_docs) & ((toxic >= PAIR_DOCS) | (_evidence(toxic.astype(np.float64), count, rate) >= evidence))


def _fit_entries(rows: np.ndarray, cols: np.ndarray, names: np.ndarray, count: np.ndarray, toxic: np.ndarray, labels: np.ndarray,
                 factors: int = FACTORS, evidence: float = EVIDENCE, l2: float = 1e-6, epochs: int = 800) -> Model:
    """The machine from the candidate terms alone: entries (row, place in names) row by row, and the terms' numbers of texts and toxic texts."""
    n, rate, toxic = len(labels), float(labels.mean()), toxic.astype(np.float64)
    often = toxic >= PAIR_DOCS
    paired = np.zeros(len(names), bool)
    number = (np.cumsum(often) - 1).astype(np.int32)
    paired[often] = _pair_evidence(rows, number[cols], often[cols], labels, toxic[often], count[often], rate, evidence)
    chosen = (_evidence(toxic, count, rate) >= evidence) | paired
    names = names[chosen]
    if not len(names):
        return _without_terms(n, rate, factors)
    number, used = (np.cumsum(chosen) - 1).astype(np.int32), chosen[cols]
    rows, cols = rows[used], number[cols[used]]
    w, b, g0 = np.zeros(len(names)), _without_terms(n, rate).bias, 0.0

    v = np.random.default_rng(7).normal(0, 0.05, (len(names), factors))
    gw, gv = np.zeros_like(w), np.zeros_like(v)
    for _ in range(epochs):
        sums = np.stack([np.bincount(rows, v[cols, f], n) for f in range(factors)], axis=1)
        squares = np.bincount(rows, (v ** 2).sum(axis=1)[cols], n)
        error = _logistic(b + np.bincount(rows, w[cols], n) + 0.5 * ((sums ** 2).sum(axis=1) - squares)) - labels
        by_term = np.bincount(cols, error[rows], len(names))
        w -= _adagrad(gw, by_term / n + l2 * w, 0.5)
        pair = np.stack([np.bincount(cols, error[rows] * sums[rows, f], len(names)) for f in range(factors)], axis=1)
        v -= _adagrad(gv, (pair - by_term[:, None] * v) / n + l2 * v, 0.05)
        g0 += error.mean() ** 2
        b -= 0.1 * error.mean() / np.sqrt(g0 + 1e-12)
    return Model(b, names, w, v)


def _evidence(toxic: np.ndarray, n: np.ndarray, rate: float | np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each one's own rate of toxic texts against the given one."""
    part = lambda k, p: np.where(k > 0, k * np.log(np.maximum(k, 1e-9) / (n * p)), 0)
    return 2 * (part(toxic, rate) + part(n - toxic, 1 - rate))


def _pair_evidence(rows: np.ndarray, cols: np.ndarray, used: np.ndarray, labels: np.ndarray, toxic: np.ndarray, count: np.ndarray,
                   rate: float, evidence: float) -> np.ndarray:
    """Whether each term has a pair whose texts are toxic more often than both terms together let expect when their odds multiply, as they
    do under additive weights; a term below the common rate counts as that.

    ``toxic`` and ``count`` are of the terms that ``cols`` numbers where ``used``. Of n terms there are (n - 1) / 2 times as many pairs, so
    a pair needs twice the logarithm of that more evidence, and chance gives as many pairs as terms. Two blocks of columns are dense at a time.
    """
    n = len(count)
    found = np.zeros(n, bool)
    order = np.argsort(cols[used], kind="stable")
    rows, cols = rows[used][order], cols[used][order]
    needed = evidence + 2 * np.log(max((n - 1) / 2, 1.0))
    own = np.maximum(toxic / np.maximum(count, 1), rate)
    edges = [*range(0, n, PAIR_BLOCK), n]

    def block(i: int) -> np.ndarray:
        part = slice(*np.searchsorted(cols, edges[i:i + 2]))
        dense = np.zeros((len(labels), edges[i + 1] - edges[i]), np.float32)
        dense[rows[part], cols[part] - edges[i]] = 1
        return dense

    of_toxic = labels > 0
    for i in range(len(edges) - 1):
        left = block(i)
        for j in range(i, len(edges) - 1):
            right = left if i == j else block(j)
            k = left[of_toxic].T @ right[of_toxic]
            a, b = np.nonzero(k >= needed / (-2 * np.log(rate)))  # fewer are no evidence, even if all are toxic
            if not len(a):
                continue
            k, both = k[a, b].astype(np.float64), (left.T @ right)[a, b].astype(np.float64)
            a, b = a + edges[i], b + edges[j]
            odds = own[a] / (1 - own[a] + 1e-9) * own[b] / (1 - own[b] + 1e-9) * (1 - rate) / rate
            expected = np.minimum(odds / (1 + odds), 1 - 1e-9)
            good = (a != b) & (k > expected * both) & (_evidence(k, both, expected) >= needed)
            found[a[good]] = found[b[good]] = True
    return found


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _counted(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All terms, ascending, with the number of texts that have them. Sorted in place: the sample's terms lie in memory once."""
    found = np.concatenate(texts)
    found.sort()
    fresh = np.ones(len(found), bool)
    fresh[1:] = found[1:] != found[:-1]
    starts = np.flatnonzero(fresh)
    return found[starts], np.diff(starts, append=len(found))


def _entries(texts: list[np.ndarray], names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in names) of every term that is among the names, in 32 bits each."""
    cols = [np.zeros(0, np.int32)]
    for t in texts:
        at = np.searchsorted(names, t)
        cols.append((at[names[np.minimum(at, len(names) - 1)] == t] if len(names) else at[:0]).astype(np.int32))
    return np.repeat(np.arange(len(texts), dtype=np.int32), [len(c) for c in cols[1:]]), np.concatenate(cols)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a null id is not held out, but not labelled either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from a bounded sample of the labelled documents that are not held out."""
    known = columns(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "terms": [terms(t).tobytes() for t in texts_of(batch, "text")]})

    texts = columns(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = texts.select("doc_id", "toxic", "text").mapInPandas(read, "doc_id long, toxic long, terms binary")
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("terms").alias("terms"))
    rows = stage_table(rows.select("toxic", "terms"), "sample")
    n, n_toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if n_toxic in (0, n):
        return _without_terms(n, n_toxic / n if n else 0.0)
    names, count, toxic = candidates(rows, n_toxic / n)

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labels, places = [], []
        for batch in batches:
            labels.append(batch["toxic"].to_numpy(np.float64))
            places += [np.frombuffer(p, np.int32) for p in batch["places"]]
        at = np.repeat(np.arange(len(places), dtype=np.int32), [len(p) for p in places])
        model = _fit_entries(at, np.concatenate(places), names, count, toxic, np.concatenate(labels))
        if len(model.terms) > MAX_TERMS:
            raise ValueError("the model is too large to be sent to every task")
        yield pd.DataFrame([(model.bias, model.terms.tobytes(), model.weights.tobytes(), model.factors.tobytes())],
                           columns=["bias", "terms", "weights", "factors"])

    got = placed(rows, names).mapInPandas(learn, "bias double, terms binary, weights binary, factors binary").first()
    return Model(got.bias, np.frombuffer(got.terms, np.uint64), np.frombuffer(got.weights, np.float64),
                 np.frombuffer(got.factors, np.float64).reshape(-1, FACTORS))


def candidates(rows: DataFrame, rate: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms of (toxic, terms) rows that can get into the model, ascending, and their numbers of texts and toxic texts; counted shard by shard."""
    n_shards = shards(rows.sparkSession)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            all_terms = [np.frombuffer(t, np.uint64) for t in batch["terms"]]
            found, n = _counted(all_terms)
            bad, n_bad = _counted([np.zeros(0, np.uint64), *[t for t, label in zip(all_terms, batch["toxic"]) if label > 0]])
            toxic = np.zeros(len(found), np.int64)
            toxic[np.searchsorted(found, bad)] = n_bad
            at = cut(found, n_shards)
            yield pd.DataFrame({"shard": range(n_shards), **{
                name: [values[i:j].tobytes() for i, j in zip(at, at[1:])] for name, values in (("terms", found), ("n", n), ("toxic", toxic))}})

    def tally(key, frame: pd.DataFrame) -> pd.DataFrame:
        found, at = np.unique(np.frombuffer(b"".join(frame["terms"]), np.uint64), return_inverse=True)
        n, toxic = (np.bincount(at, np.frombuffer(b"".join(frame[c]), np.int64), len(found)).astype(np.int64) for c in ("n", "toxic"))
        good = _candidates(n, toxic, rate)
        return pd.DataFrame({"shard": [key[0]], "terms": [found[good].tobytes()], "n": [n[good].tobytes()], "toxic": [toxic[good].tobytes()]})

    schema = "shard int, terms binary, n binary, toxic binary"
    got = rows.mapInPandas(send, schema).groupBy("shard").applyInPandas(tally, schema).orderBy("shard").collect()
    return tuple(np.frombuffer(b"".join(r[c] for r in got), t) for c, t in (("terms", np.uint64), ("n", np.int64), ("toxic", np.int64)))


def placed(rows: DataFrame, names: np.ndarray) -> DataFrame:
    """(toxic, places) of (toxic, terms) rows in one partition, in order of terms and label: places in ``names`` of the terms that are there."""
    shared = rows.sparkSession.sparkContext.broadcast(names)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(places=[_entries([np.frombuffer(t, np.uint64)], shared.value)[1].tobytes() for t in batch["terms"]])

    found = rows.mapInPandas(place, "toxic long, terms binary, places binary")
    return found.repartition(1).sortWithinPartitions("terms", "toxic").select("toxic", "places")


def scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_hash, held_out, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        place = {int(t): i for i, t in enumerate(model.terms)}
        memory: dict[bytes, tuple[int, ...]] = {}
        for batch in batches:
            yield pd.DataFrame({"doc_id": pd.array(ids_of(batch, "doc_id"), "Int64"), "text_hash": batch["text_hash"],
                                "score": [model.score(_found(t, place, memory)) for t in texts_of(batch, "text")]})

    rows = columns(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    found = rows.mapInPandas(run, "doc_id long, text_hash long, score double")
    return found.select("doc_id", "text_hash", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))


def _found(text: str | None, place: dict[int, int], memory: dict[bytes, tuple[int, ...]]) -> np.ndarray:
    """Places of a text's terms in the model, ascending."""
    out: set[int] = set()
    for w in set(alnum_words(_lower(text))):
        at = memory.get(w)
        if at is None:
            if len(memory) >= REMEMBERED:
                memory.clear()
            at = memory[w] = tuple(place[t] for t in word_terms(w) if t in place)
        if at:
            out.update(at)
    return np.array(sorted(out), np.int64)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that are predicted toxic, whatever further columns they have."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        place = {int(t): i for i, t in enumerate(model.terms)}
        memory: dict[bytes, tuple[int, ...]] = {}
        for text in texts:
            yield pd.Series([model.score(_found(t if isinstance(t, str) else None, place, memory)) for t in text], dtype="float64")

    return docs.where(score(docs["text"]) < THRESHOLD)
