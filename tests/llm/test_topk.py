import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from paylens.llm import topk as M

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "clash") for i, v in rows], SCHEMA).repartition(3)


def brute(rows, is_query, k):
    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)
    rows = [(i, [int(np.floor(float(np.float32(x)) * 256)) for x in v]) for i, v in rows if i is not None and ok(v)]
    out = []
    for q in sorted({i for i, _ in rows if is_query(i)}):
        x = min(v for i, v in rows if i == q)
        best = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in rows if i != q and len(v) == len(x))[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return out


def got(spark, rows, **options):
    out = M.top_k(vectors(spark, rows), F.col("vec_id") % 5 == 0, **options)
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("block", [7, 1000])
def test_equals_brute_force(spark, block):
    rng = np.random.default_rng(block)
    centres = rng.normal(size=(4, 8))
    rows = [(i, (centres[i % 4] + 0.2 * rng.normal(size=8)).tolist()) for i in range(150)]
    assert got(spark, rows, k=5, block=block) == brute(rows, lambda i: i % 5 == 0, 5)


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [0.5, 0.25]) for i in range(400)]
    assert got(spark, rows, k=3, block=50) == brute(rows, lambda i: i % 5 == 0, 3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, None]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [9.0, 9.0]), (6, [-1.0, 3.5]),
            (7, [1.0]), (10, [2.0]), (8, [0.0, 0.0]), (9, [1.0, 2.0]), (9, [1.0, 2.0]), (0, [1.0, 2.5]), (15, [1e4, 1e4])]
    assert got(spark, rows, k=5) == brute(rows, lambda i: i % 5 == 0, 5)
    assert got(spark, []) == [] and got(spark, [(0, [1.0])]) == []


def test_large_components_are_exact():
    rng = np.random.default_rng(4)
    q, d = (np.floor(rng.normal(size=(n, 6)) * 2**27) for n in (5, 300))
    i, j, score, _ = M.search(q, np.arange(5) - 10, d, np.arange(300), 4)
    exact = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in d] for x in q]
    for r in range(5):
        assert [(int(s), int(c)) for s, c in zip(score[i == r], j[i == r])] == [
            (-s, c) for s, c in sorted((-s, c) for c, s in enumerate(exact[r]))[:4]]
    with pytest.raises(ValueError):
        M.search(q * 2**12, np.arange(5), d, np.arange(300), 4)


def test_trees_cover_and_keep_their_distance():
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(size=(500, 5)) + 8 * rng.normal(size=5) for _ in range(3)] + [np.ones((200, 5))])
    tree = M.CoverTree(points, 16)
    assert sorted(tree.rows.tolist()) == list(range(len(points)))
    for n, children in enumerate(tree.children):
        rows = tree.rows[slice(*tree.spans[n])]
        assert (np.linalg.norm(points[rows] - tree.centres[n], axis=1) <= tree.radii[n] + 1e-9).all()
        assert sum(np.diff(tree.spans[c])[0] for c in children) in (0, len(rows))


def test_pairs_of_nodes_are_pruned():
    rng = np.random.default_rng(6)
    centres = 40 * rng.normal(size=(30, 8))
    points = np.floor((centres[rng.integers(0, 30, 4000)] + rng.normal(size=(4000, 8))) * 256)
    *_, products = M.search(points[:200], np.arange(200), points, np.arange(4000), 5)
    assert products < 0.5 * 200 * 4000


def test_many_blocks_are_searched_by_few_tasks(spark):
    rng = np.random.default_rng(7)
    found = M.top_k(vectors(spark, [(i, rng.normal(size=4).tolist()) for i in range(400)]), F.col("vec_id") % 2 == 0, block=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert max(int(n) for n in re.findall(r"hashpartitioning\([^)]*, (\d+)\)", plan)) <= 2000


def test_scores_of_a_block_are_held_in_part():
    points = np.ones((6000, 64))
    tracemalloc.start()
    try:
        M.search(points[:4000], np.arange(4000), points, np.arange(6000), 5)
        assert tracemalloc.get_traced_memory()[1] < 120e6
    finally:
        tracemalloc.stop()


def test_groups_of_blocks_give_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(M, "GROUP", 2)
    rng = np.random.default_rng(9)
    rows = [(i, np.round(rng.normal(size=3), 1).tolist()) for i in range(200)] + [(i, [0.5] * 2) for i in range(200, 260)]
    assert got(spark, rows, k=4, block=5) == brute(rows, lambda i: i % 5 == 0, 4)
