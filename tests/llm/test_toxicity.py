import random
import tracemalloc
import zlib

import numpy as np
import pytest
from llm_fixtures import docs_of, odd  # noqa: F401

from paylens.llm import toxicity as M

LABELS = "doc_id long, quality int, toxic int"


def test_pairs_are_learned_that_no_additive_weights_can_express():
    """Toxic only if an insult meets a group: with weights alone, each term by itself would have to count."""
    rng = random.Random(1)
    texts, labels = [], []
    for _ in range(1500):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.randrange(300)}" for _ in range(12)] + ["wretch"] * insult + ["neighbours"] * group
        texts.append(M.terms(" ".join(words)))
        labels.append(insult and group)
    model = M.fit(texts[:1000], np.array(labels[:1000], float))
    place = {int(t): i for i, t in enumerate(model.terms)}
    score = lambda text: model.score(M._found(text, place, {}))
    assert score("wretch neighbours") > 0.9
    assert score("wretch") < 0.1 and score("neighbours") < 0.1 and score("") < 0.1
    right = [(score_of >= 0.3) == y for score_of, y in
             ((model.score(np.searchsorted(model.terms, t[np.isin(t, model.terms)])), y) for t, y in zip(texts[1000:], labels[1000:]))]
    assert np.mean(right) > 0.99


def test_pairs_of_terms_that_are_harmless_alone():
    """Neither word changes the rate of toxic texts by itself; together they nearly decide it."""
    rng = random.Random(3)
    texts, labels = [], []
    for _ in range(8000):
        insult, group = rng.random() < 0.2, rng.random() < 0.2
        words = [f"w{rng.randrange(300)}" for _ in range(12)] + ["wretch"] * insult + ["neighbours"] * group
        texts.append(M.terms(" ".join(words)))
        labels.append(rng.random() < (0.88 if insult and group else 0.02 if insult or group else 0.2))
    labels = np.array(labels, float)
    for word in ("wretch", "neighbours"):
        with_word = labels[[M.terms(word)[0] in t for t in texts]]
        assert abs(with_word.mean() - labels.mean()) < 0.03
    model = M.fit(texts, labels)
    place = {int(t): i for i, t in enumerate(model.terms)}
    score = lambda text: model.score(M._found(text, place, {}))
    assert score("wretch neighbours") > 0.5
    assert score("wretch") < 0.3 and score("neighbours") < 0.3 and score("") < 0.3
    assert set(model.terms) <= set(M.terms("wretch neighbours"))


def test_pairs_are_counted_alike_in_any_blocks(monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.random((400, 37)) < 0.4
    labels = ((x[:, 3] & x[:, 30]) | (rng.random(400) < 0.1)).astype(float)
    rows, cols = np.nonzero(x)
    toxic, count, rate = x[labels > 0].sum(axis=0), x.sum(axis=0), labels.mean()
    used = np.ones(len(cols), bool)
    whole = M._pair_evidence(rows, cols, used, labels, toxic, count, rate, 10.0)
    monkeypatch.setattr(M, "PAIR_BLOCK", 5)
    assert (M._pair_evidence(rows, cols, used, labels, toxic, count, rate, 10.0) == whole).all()
    want, own = set(), np.maximum(toxic / count, rate)
    for i in range(37):
        for j in range(i):
            both = labels[x[:, i] & x[:, j]]
            odds = own[i] / (1 - own[i]) * own[j] / (1 - own[j]) / (rate / (1 - rate))
            p, q = odds / (1 + odds), both.mean()
            ratio = 2 * sum(n * np.log(n / len(both) / e) for n, e in ((both.sum(), p), (len(both) - both.sum(), 1 - p)) if n)
            want |= {i, j} if q > p and ratio >= 10 + 2 * np.log(18) else set()
    assert set(np.flatnonzero(whole)) == want and {3, 30} <= want


def test_one_row_of_an_id_is_learned_from(spark, docs_of):
    docs = docs_of([(1, "vile words")] * 300 + [(i, f"kind words {i}") for i in range(2, 40)])
    labels = spark.createDataFrame([(i, 1, int(i == 1)) for i in range(1, 40)], LABELS)
    once = docs.dropDuplicates(["doc_id", "text"])
    a, b = M.train(docs, labels), M.train(once, labels)
    assert a.bias == b.bias and (a.terms == b.terms).all() and (a.weights == b.weights).all()


def test_score_is_the_sum_over_terms_and_pairs():
    rng = np.random.default_rng(2)
    m = M.Model(-0.3, np.arange(5, dtype=np.uint64), rng.normal(size=5), rng.normal(size=(5, 3)))
    at = np.array([0, 2, 3])
    z = m.bias + m.weights[at].sum() + sum(m.factors[i] @ m.factors[j] for i in at for j in at if i < j)
    assert m.score(at) == pytest.approx(1 / (1 + np.exp(-z)))


def test_held_out_accuracy(spark, sf_dir):
    """On rows that the model never saw."""
    big = sf_dir.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    found = M.scores(docs, M.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    caught = [r.predicted for r in found if r.toxic == 1]
    false = [r.predicted for r in found if r.toxic == 0]
    assert np.mean(caught) > 0.8 and np.mean(false) < 0.01
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)


def _small(spark, docs_of, odd):
    rows = [*odd, *[(100 + i, "you utter wretch" if i % 3 == 0 else f"a kind word {i}") for i in range(120)]]
    labels = [(100 + i, 1, int(i % 3 == 0)) for i in range(120)] + [(None, 1, 1), (5000, 1, 1), (101, 0, None), (102, 0, 7)]
    return docs_of(rows), spark.createDataFrame(labels, LABELS), len(rows)


def test_odd_rows_and_filter(spark, docs_of, odd):
    docs, labels, n = _small(spark, docs_of, odd)
    model = M.train(docs, labels)
    out = M.scores(docs, model).collect()
    assert len(out) == n and all(0 <= r.score <= 1 for r in out)
    assert {r.doc_id for r in out if r.predicted} == {100 + i for i in range(0, 120, 3)}
    kept = M.drop_toxic(docs, labels)
    assert kept.count() == n - 40 and kept.columns == docs.columns


def test_training_does_not_depend_on_layout(spark, docs_of, odd):
    docs, labels, _ = _small(spark, docs_of, odd)
    a, b = M.train(docs, labels), M.train(docs.repartition(7), labels.repartition(5))
    assert a.bias == b.bias and (a.weights == b.weights).all() and (a.factors == b.factors).all()


def test_no_labels_or_one_kind(spark, docs_of):
    docs = docs_of([(1, "a b"), (2, None)])
    for labels in ([], [(1, 1, 1)], [(1, 1, 0), (2, 1, 0)]):
        out = M.scores(docs, M.train(docs, spark.createDataFrame(labels, LABELS))).collect()
        assert len(out) == 2 and len({r.score for r in out}) == 1
    empty = docs_of([])
    assert M.scores(empty, M.train(empty, spark.createDataFrame([], LABELS))).collect() == []


def test_a_fit_holds_the_sample_about_once():
    """Beside the texts' terms: one sorted copy and 32-bit places. With several copies in 64 bits, the task did not fit an executor."""
    rng = np.random.default_rng(5)
    labels = (rng.random(2000) < 0.1).astype(float)
    texts = [np.unique(np.append(rng.integers(0, 40000, 1500), 50000) if y else rng.integers(0, 40000, 1500)).astype(np.uint64) for y in labels]
    held = sum(t.nbytes for t in texts)
    tracemalloc.start()
    model = M.fit(texts, labels, epochs=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 50000 in model.terms
    assert peak < 3.5 * held


def test_the_fit_gets_the_places_of_candidates_only(spark, docs_of):
    """Every term of the sample went to one task, whose memory the executor did not have."""
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = [f"rare{rng.randrange(40000)}" for _ in range(40)] + ["wretch"] * toxic + [f"often{rng.randrange(9)}"]
        rows.append((toxic, M.terms(" ".join(words)).tobytes()))
        labels.append((i, " ".join(words), int(toxic)))
    table = spark.createDataFrame([(int(t), b) for t, b in rows], "toxic long, terms binary").repartition(5)
    names, count, n_toxic = M.candidates(table, 0.25)
    all_terms = [np.frombuffer(b, np.uint64) for _, b in rows]
    for name, n, bad in zip(names, count, n_toxic):
        has = [name in t for t in all_terms]
        assert (n, bad) == (sum(has), sum(h and t for h, (t, _) in zip(has, rows)))
    assert set(M.terms("wretch")) <= set(names) and (np.diff(names) > 0).all()
    placed = M.placed(table, names)
    assert placed.rdd.getNumPartitions() == 1
    got = [tuple(names[np.frombuffer(r.places, np.int32)]) for r in placed.collect()]
    ordered = [np.frombuffer(b, np.uint64) for b, _ in sorted((b, t) for t, b in rows)]
    assert got == [tuple(t[np.isin(t, names)]) for t in ordered]
    assert 4 * sum(map(len, got)) < 8 * sum(map(len, all_terms)) / 4  # bytes
    trained = M.train(docs_of([r[:2] for r in labels]), spark.createDataFrame([(i, 1, y) for i, _, y in labels], LABELS))
    learned = [(M.terms(text).tobytes(), y) for i, text, y in labels if zlib.crc32(str(i).encode()) % 4 != 2]
    whole = M.fit([np.frombuffer(t, np.uint64) for t, _ in sorted(learned)], np.array([y for _, y in sorted(learned)], float))
    assert trained.bias == whole.bias and (trained.terms == whole.terms).all()
    assert (trained.weights == whole.weights).all() and (trained.factors == whole.factors).all()
