"""Forests: both phases of growth, layouts, bins, and the exported nodes; the registered ones are compared with SQL."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paylens.models import binning, forest, regressors

NUMBERS, TEXT = ["a", "b"], ["c"]


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(0)
    rows = [(i, int(rng.integers(0, 30)), float(rng.integers(0, 9)) / 4, "xyzuvw"[rng.integers(0, 6)], "clash", 1) for i in range(400)]
    rows = [(i, a, b, c, int(3 * a + 20 * (c in "xw") + 8 * b + rng.integers(0, 9)), p, n) for i, a, b, c, p, n in rows]
    return spark.createDataFrame(rows, "id long, a int, b double, c string, y long, path string, n int").cache()


def nodes(grown):
    return sorted((tuple(map(str, r)) for r in grown.nodes().collect()))


def predicted(grown, df):
    return {r["id"]: r["y_pred"] for r in grown.predict(df, ["id"]).collect()}


def fit(df, **options):
    return forest.fit(df, NUMBERS, TEXT, "y", "id", **{"num_trees": 6} | options)


@pytest.mark.parametrize("options", [{}, {"max_depth": 3, "per_node": 2}])
def test_both_phases_and_all_layouts_give_one_forest(made, options):
    small = fit(made.repartition(5), local_rows=40, **options)
    whole = fit(made.repartition(2, "y"), **options)
    assert len(small.tops) > 1 and not whole.tops
    assert nodes(small) == nodes(whole)
    unseen = made.withColumn("c", F.when(F.col("id") % 3 == 0, "new").otherwise(F.col("c"))).withColumn("a", F.col("a") * 2 - 20)
    assert predicted(small, unseen) == pytest.approx(predicted(whole, unseen), abs=1e-9)


def brute(rows, features, text, depth, tree, seed=42):
    """One tree by plain recursion."""
    import hashlib

    limits = forest.poisson_limits()
    bag = []
    for r in rows:
        u = int(hashlib.md5(f"{seed}:{tree}:{r['id']}".encode()).hexdigest()[:8], 16)
        bag += [r] * sum(u >= x for x in limits)

    def sse(part):
        return sum(r["y"] for r in part) ** 2 / len(part)

    def node(part, path):
        out = {path: (len(part), sum(r["y"] for r in part) / len(part))}
        best = None
        for f in features:
            values = {v: [r for r in part if r[f] == v] for v in {r[f] for r in part}}
            order = sorted(values, key=lambda v: (sum(r["y"] for r in values[v]) / len(values[v]), v) if f in text else v)  # noqa: B023
            for k in range(1, len(order)):
                left, right = ([r for r in part if (r[f] in order[:k]) == side] for side in (True, False))  # noqa: B023
                score = sse(left) + sse(right)
                if score > sse(part) and (best is None or score > best[0] * (1 + 1e-12)):
                    best = score, left, right
        if best and len(path) < depth:
            out |= node(best[1], path + "0") | node(best[2], path + "1")
        return out

    return node(bag, "")


def test_equals_plain_recursion(made):
    rows = [r.asDict() for r in made.limit(1000).collect()]
    grown = fit(made, num_trees=3, max_depth=4)
    for tree in range(3):
        got = {r["path"]: (r["n"], r["prediction"]) for r in grown.nodes().where(F.col("tree") == tree).collect()}
        want = brute(rows, NUMBERS + TEXT, TEXT, 4, tree)
        assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in got)


def test_nodes_predict_what_the_forest_predicts(spark, made):
    grown = fit(made, max_depth=5)
    made.createOrReplaceTempView("made")
    levels = grown.binning.levels["c"].withColumnRenamed("level", "_l")
    rows = made.join(levels, F.col("c") == F.col("_l"), "left").select("id", "a", "b", F.coalesce("bin", F.lit(255)).alias("c_bin"))
    at = rows.crossJoin(spark.range(6).select(F.col("id").cast("int").alias("tree"))).withColumn("path", F.lit(""))
    for _ in range(5):
        table = grown.nodes().select("tree", "path", "feature", "edge", "bins")
        at = at.join(table, ["tree", "path"], "left").withColumn("path", F.when(F.col("feature").isNull(), F.col("path")).otherwise(F.concat(
            "path", F.expr("CASE WHEN CASE feature WHEN 'a' THEN a <= edge WHEN 'b' THEN b <= edge ELSE array_contains(bins, c_bin) END THEN '0' ELSE '1' END")
        ))).drop("feature", "edge", "bins")
    walked = at.join(grown.nodes().select("tree", "path", "prediction"), ["tree", "path"]).groupBy("id").agg(F.avg("prediction").alias("p"))
    assert {r["id"]: r["p"] for r in walked.collect()} == pytest.approx(predicted(grown, made))


def test_depth_has_no_limit(spark):
    """A staircase: every split takes one row off, 90 levels deep."""
    rows = spark.createDataFrame([(i, i, "x", 3**min(i, 33) if i < 33 else 3**33 + i) for i in range(90)], "id long, a int, c string, y long")
    one = forest.fit(rows, ["a"], [], "y", "id", num_trees=40)
    assert one.nodes().agg(F.max(F.length("path"))).first()[0] > 25


def test_save_and_load(spark, made, tmp_path):
    for local_rows in (40, 10_000):
        grown = fit(made, local_rows=local_rows)
        path = grown.save(str(tmp_path / f"forest{local_rows}"))
        assert predicted(forest.Forest.load(spark, path), made) == pytest.approx(predicted(grown, made))


def test_bins_of_many_values(spark):
    rows = spark.range(3000).select("id", (F.col("id") / 7).alias("a"), F.concat(F.lit("l"), F.col("id") % 1000).alias("c"), (F.col("id") % 1000).alias("y"))
    of = binning.Binning.fit(rows, ["a"], ["c"], "y")
    assert of.sizes() == [255, 255]
    got = of.transform(rows, ["id"]).select("id", binning.bin_of(of.packs, 0).alias("a"), binning.bin_of(of.packs, 1).alias("c")).toPandas().sort_values("id")
    assert (got["a"].diff()[1:] >= 0).all() and got["a"].max() == 254 and got["a"].value_counts().max() <= 13
    levels = got["c"].to_numpy().reshape(3, 1000)
    assert (levels == levels[0]).all() and (np.diff(levels[0]) >= 0).all() and levels[0].max() == 254


def test_bins_at_and_beyond_the_edges(spark):
    edges = spark.createDataFrame([("a", 2.0), ("a", 0.0), ("a", 1.0)], "feature string, edge double")
    of = binning.Binning(["a", "b"], [], edges.union(spark.createDataFrame([("b", 5.0)], "feature string, edge double")), {})
    values = [-1.0, -0.0, 0.5, 1.0, 2.0, 3.0, float("nan"), float("inf"), float("-inf"), None]
    rows = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "id int, a double, b double")
    binned = of.transform(rows, ["id"])
    got = binned.select("id", binning.bin_of(of.packs, 0), binning.bin_of(of.packs, 1)).orderBy("id").collect()
    assert [r[1] for r in got] == [0, 0, 1, 1, 2, 2, 2, 2, 0, 0] and {r[2] for r in got} == {0}
    # a batch of rows is searched at once, not value by value in an interpreted loop
    assert "lambda" not in binned._jdf.queryExecution().executedPlan().toString()


def test_bags_are_drawn_for_many_rows_at_once(monkeypatch):
    ids = [str(i * 7919) for i in range(9000)] + [None, "", "x" * 49, "x" * 50, "x" * 51, "a" * 200, "é\0", "\0"]
    limits = np.array(forest.poisson_limits())
    expected = [[len(limits) if i is None else int(np.searchsorted(
        limits, int(hashlib.md5(f"42:{t}:{i}".encode()).hexdigest()[:8], 16), side="right")) for i in ids] for t in range(12)]
    alone = []

    class Counted:
        @staticmethod
        def md5(message):
            alone.append(message)
            return hashlib.md5(message)

    monkeypatch.setattr(forest, "hashlib", Counted)
    assert forest.weights(ids, 12, 42).tolist() == expected
    # only messages that are longer than a block of MD5 in some tree go one by one
    assert len(alone) == 12 * 3 and min(map(len, alone)) > 54
    assert forest.weights([], 3, 42).shape == (3, 0)


def test_constant_and_tiny_tables(spark):
    rows = spark.createDataFrame([(1, 1, 0.5, "x", 7)], "id long, a int, b double, c string, y long")
    many = spark.range(50).selectExpr("id", "1 AS a", "0.5 AS b", "'x' AS c", "7L AS y")
    for df in (rows.union(rows.withColumn("id", F.lit(2))), many):
        assert set(predicted(fit(df), df).values()) == {7.0}


def test_forests_beat_the_mean(tables):
    for fitted in (
        regressors.random_forest(tables.features, num_trees=10),
        regressors.random_forest_onehot(tables.features, num_trees=5),
    ):
        assert all(r["r2"] > 0.5 for r in fitted.metrics().collect())
        importances = [r["weight"] for r in fitted.weights().collect()]
        assert sum(importances) == pytest.approx(1.0) and importances == sorted(importances, reverse=True)


def test_cells_in_use_give_the_splits_of_whole_histograms():
    rng = np.random.default_rng(1)
    spec = forest.Spec(("a", "c"), (12, 9), 1, None, None, 42)
    bins = np.stack([rng.integers(0, 12, 300), rng.integers(0, 9, 300)]).astype(np.uint8)
    at, w, y = np.sort(rng.integers(0, 40, 300)), rng.integers(1, 4, 300).astype(float), rng.integers(0, 50, 300).astype(float)
    at = np.unique(at, return_inverse=True)[1]
    k = at.max() + 1
    n, s = np.bincount(at, w), np.bincount(at, w * y)
    whole, cells = forest.Splits(n, s, spec, None), forest.Splits(n, s, spec, None)
    for f, size in enumerate(spec.sizes):
        cell = at * size + bins[f]
        whole.add(f, np.bincount(cell, w, k * size).reshape(k, size), np.bincount(cell, w * y, k * size).reshape(k, size))
        used = np.unique(cell)
        cells.add_cells(f, used // size, used % size, np.bincount(cell, w)[used], np.bincount(cell, w * y)[used])
    assert whole.done() == pytest.approx(cells.done())
    assert (whole.feature == cells.feature).all() and (whole.feature == 0).any() and (whole.feature == 1).any()
    for i in range(k):
        held = np.unique(bins[1][at == i])
        assert whole.cut[i] == cells.cut[i] and (whole.mask[i, held] == cells.mask[i, held]).all()


def test_bags_are_poisson_draws_and_are_not_exploded(made, monkeypatch):
    import hashlib

    drawn = forest.weights(["7", None, "12"], 3, 42)
    limits = forest.poisson_limits()
    for tree in range(3):
        for place, i in ((0, "7"), (2, "12")):
            u = int(hashlib.md5(f"42:{tree}:{i}".encode()).hexdigest()[:8], 16)
            assert drawn[tree, place] == sum(u >= x for x in limits)
    staged = {}
    real = forest.stage_table

    def stage(df, name, *more):
        out = real(df, name, *more)
        staged[name] = max(staged.get(name, 0), out.count())
        return out

    monkeypatch.setattr(forest, "stage_table", stage)
    fit(made, local_rows=100, num_trees=10)
    assert max(staged.values()) <= 400  # no table of (tree, row)


def test_rows_of_nodes_with_one_bin_are_not_sorted(monkeypatch):
    """Most features of a deep node have one bin there; sorting and adding up their rows was most of a subtree's growth."""
    rng = np.random.default_rng(8)
    n = 3000
    bins = np.stack([rng.integers(0, 200, n), rng.integers(0, 2, n), rng.integers(0, 40, n)]).astype(np.uint8)
    y, w = rng.integers(0, 50, n).astype(float), rng.integers(1, 4, n).astype(float)
    spec = forest.Spec(("a", "b", "c"), (200, 2, 40), 1, None, None, 1)
    dense = monkeypatch.setattr(forest, "DENSE", 10**6) or forest.grow(bins, y, w, 0, "", spec)
    monkeypatch.setattr(forest, "DENSE", 1)
    cells, add = [], forest.Splits.add_cells
    monkeypatch.setattr(forest.Splits, "add_cells", lambda self, f, node, *rest: cells.append(np.bincount(node)) or add(self, f, node, *rest))
    assert forest.grow(bins, y, w, 0, "", spec) == dense
    assert cells and all((c != 1).all() for c in cells)


def test_cells_of_texts_are_ordered_by_node_and_mean():
    rng = np.random.default_rng(9)
    node, value = np.sort(rng.integers(0, 50, 1000)), rng.integers(0, 7, 1000) / 3
    want = np.lexsort((np.arange(1000), value, node))
    assert (forest._in_order(node, value) == want).all()
    assert (forest._in_order(node << 50, value) == want).all()
