import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import docs_of, odd, texts  # noqa: F401

from paylens.llm import ngram_lm as M


@settings(deadline=None)
@given(st.lists(st.integers(0, 2**45), max_size=60), st.lists(st.integers(0, 2**45), max_size=20))
def test_elias_fano_access_and_successor(values, asked):
    v = np.sort(np.array(values, np.uint64))
    ef = M.EliasFano.of(M.EliasFano.encode(v))
    assert ef.access(np.arange(len(v))).tolist() == v.tolist()
    x = np.array([*asked, *values, *[u + 1 for u in values]], np.uint64)
    at, equal = ef.successor(x)
    assert at.tolist() == np.searchsorted(v, x).tolist()
    assert equal.tolist() == np.isin(x, v).tolist()


@settings(deadline=None)
@given(st.dictionaries(st.integers(0, 10**6), st.dictionaries(st.integers(1, 10**6), st.integers(1, 255), min_size=1, max_size=8), max_size=12),
       st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 10**6)), max_size=10))
def test_trie_finds_what_was_built(level, strangers):
    contexts = sorted(level)
    words = [sorted(level[c]) for c in contexts]
    data = M.TrieLevel.build(
        np.array(contexts, np.uint64), np.array([len(w) for w in words], np.int64), np.array([x for w in words for x in w], np.uint64),
        np.array([level[c][w] for c, ws in zip(contexts, words) for w in ws], np.uint8))
    trie = M.TrieLevel(data)
    asked = [(c, w) for c, ws in zip(contexts, words) for w in ws] + strangers
    for c, w in asked:
        _, code = trie.lookup(np.array([c], np.uint64), np.array([1]), np.array([w], np.uint64))
        assert code.tolist() == [level.get(c, {}).get(w, 0)]


def brute(rows, order):
    tokens = [((t or "").encode().lower().split(), d) for d, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for _, d in tokens]
    tokens = [[*t, "end"] for t, _ in tokens]
    count, single = Counter(), Counter()
    for t, h in zip(tokens, held):
        if not h:
            single.update(t)
            s = ["start", *t]
            for n in range(2, order + 1):
                for i in range(1, len(s)):
                    context = tuple(s[max(0, i - n + 1):i])
                    count[n, context, s[i]] += 1
                    count[n, context] += 1
    total, types = sum(single.values()), len(single)
    out = []
    for (d, _), t, h in zip(rows, tokens, held):
        base = score = 0.0
        s = ["start", *t]
        for i in range(1, len(s)):
            p = (single[s[i]] + 1) / (total + types + 1)
            base += math.log10(p)
            for n in range(2, order + 1):
                context = tuple(s[max(0, i - n + 1):i])
                c, k = count[n, context], count[n, context, s[i]]
                seen = 10 ** ((int(M.quantise(np.array([k / (c + M.KAPPA)]))[0]) - 255) / M.STEPS) if k else 0
                p = seen + M.KAPPA / (c + M.KAPPA) * p
            score += math.log10(p)
        out.append((d, h, len(t), sum(single[w] > 0 for w in t), total, base, score))
    return out


def compare(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(docs_of, texts, order):
    rows = texts[:60]
    compare(M.score(docs_of(rows), order, block_chars=20_000)[0].collect(), brute(rows, order))


def test_odd_rows(docs_of, odd):
    compare(M.score(docs_of(odd), block_chars=40)[0].collect(), brute(odd, 2))


def test_hot_contexts_are_spread(docs_of, monkeypatch):
    rows = [(i, "the " + " ".join(f"the w{i * j % 13}" for j in range(20))) for i in range(30)]
    monkeypatch.setattr(M, "HOT", 0)  # nothing is spread
    plain = sorted(map(tuple, M.score(docs_of(rows), block_chars=200)[0].collect()))
    monkeypatch.undo()
    compare(plain, brute(rows, 2))
    compare(M.score(docs_of(rows), block_chars=200)[0].collect(), brute(rows, 2))


def test_empty_table_and_no_training_rows(docs_of):
    assert M.score(docs_of([]))[0].collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (row,) = M.score(docs_of([(held, "some words")]))[0].collect()
    assert tuple(row) == (held, True, 3, 0, 0, 0.0, 0.0)


def test_context_helps_held_out_texts(docs_of, texts):
    rows = M.score(docs_of(texts), 2)[0].where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_quantisation_is_fine_enough():
    p = 10.0 ** -np.linspace(0, 7, 1000)
    assert (np.abs(np.log10(M.probability(M.quantise(p)) / p)) <= 0.5 / M.STEPS + 1e-9).all()


def test_the_query_scores_by_trigrams(spark, docs_of, tmp_path):
    from paylens.llm import queries

    rows = [(i, f"a b c{i % 3} a b d{i % 2} a b c{i % 3}") for i in range(12)]
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    compare(queries.op2_ngram_lm(spark, str(tmp_path)).collect(), brute(rows, 3))
