import numpy as np
import pytest
from pyspark.sql import functions as F

from paylens.llm import hard_negatives as M

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score string, block int, size string"


def table(spark, rows, partitions=3):
    return spark.createDataFrame([(i, v, label, 1, "clash", 2, "x") for i, v, label in rows], SCHEMA).repartition(partitions)


def brute(rows, low=50, high=95):
    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)
    rows = [(i, [int(np.floor(float(np.float32(x)) * 256)) for x in v], label) for i, v, label in rows
            if i is not None and label is not None and ok(v)]
    out = []
    for a in sorted({i for i, *_ in rows if i % 5 == 0}):
        x, label = min((v, label) for i, v, label in rows if i == a)
        others = sorted((-sum(p * q for p, q in zip(x, v)), i, o) for i, v, o in rows if i != a and len(v) == len(x))
        for p, i, _ in [r for r in others if r[2] == label][:5]:
            hard = [(-s, j) for s, j, o in others if o != label and low * -p <= 100 * -s <= high * -p][:3]
            out += [(a, i, r, j, -p, s) for r, (s, j) in enumerate(hard, 1)]
    return sorted(out)


def got(spark, rows, partitions=3, **options):
    return sorted(map(tuple, M.mine(table(spark, rows, partitions), F.col("vec_id") % 5 == 0, **options).collect()))


def made(seed, n, d, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, d))
    return [(i, (centres[i % labels] * 0.3 + 0.4 * rng.normal(size=d)).tolist(), int(rng.integers(0, labels))) for i in range(n)]


@pytest.mark.parametrize("d, block", [(8, 50_000), (13, 7), (3, 20)])
def test_equals_brute_force(spark, monkeypatch, d, block):
    monkeypatch.setattr(M, "LEAST", 1)
    rows = made(d, 160, d)
    assert got(spark, rows, block=block) == brute(rows) != []


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [0.5, 0.25], i % 2) for i in range(200)] + [(i, [0.4, 0.2], i % 2) for i in range(200, 300)]
    assert got(spark, rows) == brute(rows) != []


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, None], 1), (2, None, 1), (3, [], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (None, [9.0, 9.0], 1),
            (6, [-1.0, 3.5], 1), (7, [1.0], 1), (10, [2.0], 1), (8, [0.5, 0.9], 2), (9, [1.0, 1.1], 2), (9, [1.0, 1.1], 2), (9, [1.0, 1.1], 1),
            (0, [1.0, 2.5], 2), (15, [0.1, 0.2], None), (20, [-1.0, -1.0], 7), (25, [0.0, 0.0], 2), (30, [-0.5, -2.0], 2)]
    assert got(spark, rows) == brute(rows) != []
    assert got(spark, []) == [] and got(spark, [(0, [1.0], 1)]) == []


def test_large_components_are_exact_or_an_error(spark):
    rng = np.random.default_rng(4)
    rows = [(i, np.round(rng.normal(size=6) * 2**12).tolist(), i % 2) for i in range(60)]
    assert got(spark, rows, scale=2) == [
        r for r in brute([(i, [x / 128 for x in v], label) for i, v, label in rows])]
    with pytest.raises(Exception, match="64 bits"):
        got(spark, [(i, [1e9] * 8, i % 2) for i in range(10)])


def test_lookups_are_inner_products():
    rng = np.random.default_rng(5)
    for d in (1, 8, 20):
        a, c = (rng.integers(-300, 300, size=(n, d)) for n in (7, 40))
        planes, bits = M.bit_planes(c)
        assert planes.shape == (bits, -(-d // 8), 40) and bits == 10
        assert (M.scores(M.subset_sums(a), planes) == c @ a.T).all()
    for value in (0, -1, 1, -2**40, 2**40):
        planes, _ = M.bit_planes(np.array([[value]]))
        assert M.scores(M.subset_sums(np.array([[3]])), planes)[0, 0] == 3 * value


def test_tables_hold_all_subset_sums():
    tables = M.subset_sums(np.arange(1, 10)[None, :])
    assert tables.shape == (2, 256, 1) and tables[0, 255, 0] == 36 and tables[1, 1, 0] == 9 and tables[0, 0b101, 0] == 4


def test_repeated_rows_of_one_label_do_not_gather(spark):
    rows = [(i, [0.5, 0.5, -0.25], 1) for i in range(3000)] + made(1, 100, 3)
    rows = [(i, v, label) for i, (_, v, label) in enumerate(rows)]
    want = brute([r for r in rows if r[0] % 5 or r[0] > 2900 or r[0] < 50])
    asked = M.mine(table(spark, [r for r in rows if r[0] % 5 or r[0] > 2900 or r[0] < 50]), F.col("vec_id") % 5 == 0)
    assert sorted(map(tuple, asked.collect())) == want


def test_rows_of_megabytes_are_written_in_small_row_groups(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq

    from paylens import session
    monkeypatch.setattr(M, "LEAST", 1)
    monkeypatch.setattr(session, "scratch_path", lambda _, name: str(tmp_path / name))
    # 13 dimensions of large numbers: 7 MB a block of 65,536 rows
    rows = spark.range(400_000, numPartitions=1).select(
        F.col("id").alias("vec_id"), F.lit(1).alias("label"), F.transform(F.sequence(F.lit(0), F.lit(12)), lambda i: F.xxhash64("id", i) % 2**40).alias("v"))
    M.index(rows, 65_536)
    file, = (tmp_path / "planes").glob("*.parquet")
    of = pq.ParquetFile(file).metadata
    assert of.num_rows == 7 and of.num_row_groups > 1


def test_groups_of_blocks_give_the_same_rows(spark, monkeypatch):
    for name, value in (("LEAST", 1), ("ANCHORS", 3), ("ANCHOR_GROUP", 2), ("GROUP", 2)):
        monkeypatch.setattr(M, name, value)
    rows = made(11, 160, 5) + made(12, 30, 2)
    rows = [(i, v, label) for i, (_, v, label) in enumerate(rows)]
    assert got(spark, rows, block=9) == brute(rows) != []
