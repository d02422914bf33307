import random
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import docs_of, odd, texts  # noqa: F401

from paylens.llm import jaccard as M
from paylens.llm.components import connected_components


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows, n, num, den):
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def got(docs, *args, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in M.components(docs, *args, **options).collect()), key=str)


@pytest.mark.parametrize("n, num", [(3, 90), (5, 80), (1, 50)])
def test_components_equal_brute_force(docs_of, texts, n, num):
    assert got(docs_of(texts), n, num, 100, block_chars=40_000) == brute(texts, n, num, 100)


def near_copies(seed, count, changes):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(count):
        words = list(base)
        for k in rng.sample(range(120), rng.randrange(changes + 1)):
            words[k] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("changes", [1, 2, 4])
def test_large_groups_need_rounds(docs_of, changes, monkeypatch):
    monkeypatch.setattr(M, "SMALL_GROUP", 4)
    rows = near_copies(changes, 70, changes)
    assert got(docs_of(rows), 3, 90, 100) == brute(rows, 3, 90, 100)


def test_pairs_are_not_expanded(spark, docs_of, monkeypatch):
    """A group of m near copies costs about m verifications a round."""
    rows = near_copies(1, 90, 1)
    seen = []
    whole = M.verified
    monkeypatch.setattr(M, "verified", lambda pairs, *a: (seen.append(pairs.count()), whole(pairs, *a))[1])
    got(docs_of(rows), 3, 90, 100)
    assert sum(seen) < 3 * len(rows)


def test_odd_rows(docs_of, odd):
    rows = [*odd, (20, "two  WORDS"), (21, "text a id without"), (22, "A TEXT without id")]
    assert got(docs_of(rows)) == brute(rows, 3, 90, 100)


def test_empty_table_and_long_text(docs_of):
    assert got(docs_of([])) == []
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(3, long), (2, f"{long} more"), (1, "short")]
    assert got(docs_of(rows)) == [(1, 1, 1), (2, 59_999, 2), (3, 59_998, 2)]


def test_one_of_each(docs_of):
    copy = " ".join(f"w{i}" for i in range(60))
    docs = docs_of([(5, copy), (3, copy), (4, f"{copy} x"), (1, "clean"), (2, None), (None, copy), (6, "")])
    kept = M.one_of_each(docs)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 3, 6, None] and kept.columns == docs.columns


@given(st.sets(st.integers(0, 2**64 - 1), max_size=80), st.sets(st.integers(0, 2**64 - 1), max_size=80))
def test_sketches_bound_the_difference(a, b):
    x, y = (M.sketch(np.array(sorted(s), np.uint64)) for s in (a, b))
    assert int(np.bitwise_count(x ^ y).sum()) <= len(a ^ b)


@settings(deadline=None, max_examples=5)
@given(st.lists(st.tuples(st.integers(0, 14), st.integers(0, 14)), max_size=20))
def test_connected_components(spark, edges):
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(20):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    out = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in out} == root and len(out) == len(root)


def test_rows_are_judged_whatever_their_ids(docs_of):
    copy = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(5, copy), (3, copy), (3, copy), (3, other), (9, other), (None, copy), (None, "alone"), (None, "alone"), (None, None), (7, copy), (7, "own")]
    out = M.one_of_each(docs_of(rows), null_ids=True)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(3, copy), (3, other), (None, "alone"), (None, None), (7, "own")], key=str)
    assert out.columns == docs_of(rows).columns
    assert sorted((r.doc_id for r in M.one_of_each(docs_of(rows)).collect()), key=str) == sorted([3, 3, 7, *[None] * 4], key=str)


def test_levels_of_counts_keep_their_order():
    counts = np.array([1, 2, 3, 2**20, 2**31, 2**32, 2**40])
    levels = M._level(counts).astype(int)
    assert levels[0] == 0 and (levels[1:] > 0).all() and (np.diff(levels) >= 0).all()
