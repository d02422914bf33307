import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paylens.operators import ranking


def _sample(n=3000, seed=1):
    """Continuous values in groups of very different size, one value repeated a lot."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        group = rng.choices(["hot", "b", "c"], [0.8, 0.15, 0.05])[0]
        out.append((group, 7.5 if rng.random() < 0.3 else rng.gauss(0, 100)))
    return out + [("single", 3.0), (None, 1.0), ("b", None)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(_sample(), "g string, v double").repartition(7)


@pytest.mark.parametrize("rows", [1, 30, 16_384])
def test_grouped_quantiles_equal_numpy(frame, rows):
    probs = {"p01": 0.01, "q1": 0.25, "q2": 0.5, "p99": 0.99}
    got = {
        r["g"]: r for r in ranking.grouped_quantiles(
            frame, "v", probs, ["g"], {"rows": F.sum("n"), "low": F.min("v")}, bucket_rows=rows
        ).collect()
    }
    groups = {}
    for g, v in _sample():
        if g is not None and v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g]["rows"] == len(values) and got[g]["low"] == min(values)
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_whole_table_quantile_and_empty_table(spark, frame):
    values = [v for _, v in _sample() if v is not None]
    got = ranking.grouped_quantiles(frame, "v", {"m": 0.5}).first()["m"]
    assert got == pytest.approx(np.median(values), rel=1e-12)
    empty = ranking.grouped_quantiles(frame.where("false"), "v", {"m": 0.5})
    assert empty.first()["m"] is None


def test_approximate_quantiles_are_existing_values(frame):
    values = {v for g, v in _sample() if g == "hot"}
    got = ranking.grouped_quantiles(frame, "v", {"m": 0.5}, ["g"], approx=True)
    assert got.where("g = 'hot'").first()["m"] in values


@pytest.mark.parametrize("rows, fan_in", [(1, 2), (3, 7), (16_384, 4096)])
def test_running_totals_of_text(spark, rows, fan_in):
    words = sorted({f"w{random.Random(i).randrange(10_000)}" for i in range(500)})
    df = spark.createDataFrame([(w, i % 5) for i, w in enumerate(words)], "w string, k int").repartition(5)
    out = ranking.running_totals(df, "w", ["k"], bucket_rows=rows, fan_in=fan_in)
    got = {r["w"]: (r["before_k"], r["total_k"]) for r in out.collect()}
    total, before = sum(i % 5 for i in range(len(words))), 0
    for i, w in enumerate(words):
        assert got[w] == (before, total)
        before += i % 5


def test_average_ranks_share_ties(spark):
    df = spark.createDataFrame([(10, 2), (20, 1), (30, 3)], "v int, n int")
    got = {r["v"]: r["rank"] for r in ranking.average_ranks(df, "v").collect()}
    assert got == {10: 1.5, 20: 3.0, 30: 5.0}


def test_buckets_grow_in_number_and_not_in_size(spark):
    """Ten times the rows of a hot group give ten times the buckets, of the same size."""
    counts = {}
    for n in (20_000, 200_000):
        df = spark.range(n).select(F.when(F.col("id") % 10 == 0, "b").otherwise("hot").alias("g"), F.sqrt("id").alias("v"), F.lit(1).alias("n"))
        sizes = ranking.with_buckets(df, "v", ["n"], ["g"], 1000).groupBy("g", "_bucket").count()
        counts[n] = sizes.where("g = 'hot'").agg(F.count("*"), F.max("count")).first()
    assert counts[20_000][0] > 10 and 6 < counts[200_000][0] / counts[20_000][0] < 15
    assert counts[200_000][1] < 12_000


@pytest.mark.parametrize("rows", [1, 7, 100, 10**6])
def test_bucket_is_the_number_of_edges_at_or_below(spark, rows):
    df = spark.range(0, 2000, 3).select(F.col("id").alias("v"), F.lit(1).alias("n"))
    edges = ranking._bucket_edges(df, "v", [], ["n"], rows)
    got = df.withColumn("e", edges).select("v", "e", ranking._bucket("v", "e").alias("b"))
    for r in got.collect():
        assert r["b"] == sum(e <= r["v"] for e in r["e"])
