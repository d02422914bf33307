import hashlib
import re

import pytest
import xxhash
from llm_fixtures import docs_of, odd, texts  # noqa: F401
from pyspark.sql import functions as F

from paylens.llm import sketch as M


def hashes(text, n=5):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    out = set()
    for i in range(max(1, len(words) - n + 1) if words else 0):
        h = 42
        for w in words[i:i + n]:
            h = xxhash.xxh64_intdigest(w.encode(), seed=h)
        out.add(h - 2**64 if h >= 2**63 else h)
    return out


def bottom(text, k):
    return sorted(hashes(text))[:k]


def alike(a, b, k):
    u = sorted(set(a) | set(b))[:k]
    return sum(h in a and h in b for h in u) / len(u) if u else 1.0


def text_order(row):
    """Descending ids, null last; then the hashes of the texts, unsigned in their first 16 bits."""
    i, t = row
    h = xxhash.xxh64_intdigest((t or "").encode(), seed=42)
    signed = h - 2**64 if h >= 2**63 else h
    return (-(2**63) if i is None else i, h >> 48, signed, (t or "").encode())


def brute(rows, k=M.SIZE):
    rows = sorted(rows, key=text_order, reverse=True)
    hexes = lambda a: "".join(f"{h % 2**64:016X}" for h in a)
    out = []
    for (i, t), (_, following) in zip(rows, rows[1:] + rows[:1]):
        t, following = t or "", following or ""
        third = len(t) // 3
        edited = t[:len(t) - third] + following[:third]
        a, b, c = (bottom(x, k) for x in (t, edited, following))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), hexes(a), hexes(b), alike(a, b, k), alike(a, c, k)))
    return sorted(out, key=str)


NAMES = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def got(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=str)


def test_query_equals_brute_force(spark, sf_dir, texts):
    from paylens.llm.queries import op11_fingerprint
    df = op11_fingerprint(spark, sf_dir)
    assert got(df) == brute(texts)
    near = df.where("n_chars > 200").selectExpr("avg(near_edited)", "avg(near_next)").first()
    assert 0.35 < near[0] < 0.65 and near[1] < 0.05


def test_odd_rows(docs_of, odd):
    long = " ".join(str(i * i % 997) for i in range(60_000))
    rows = [*odd, (9, long), (9, long), (9, long + " x"), (-5, "one two three four five six"), (-(2**63), "least")]
    for partitions in (1, 4):
        assert got(M.digests(docs_of(rows, partitions), k=16)) == brute(rows, 16)


def test_one_row_and_none(docs_of):
    assert got(M.digests(docs_of([(3, "a b c d e f g")]))) == brute([(3, "a b c d e f g")])
    assert got(M.digests(docs_of([(None, None)]))) == brute([(None, None)])
    assert got(M.digests(docs_of([]))) == []


def test_many_rows_of_one_id_go_to_several_buckets(docs_of):
    rows = [(7, f"text {i}") for i in range(600)] + [(i, f"other {i}") for i in range(300)]
    circle, _ = M.in_circle(docs_of(rows))
    assert circle.where("ghost = 0 AND doc_id = 7").groupBy("bucket").count().agg(F.max("count")).first()[0] < 200
    assert got(M.digests(docs_of(rows))) == brute(rows)


def sketches(docs_of, texts, k):
    return M.with_sketch(docs_of(list(enumerate(texts))), "text", "sketch", k=k).select("doc_id", "sketch")


def test_sketches_merge_over_parts(docs_of):
    words = [str(i * 7919 % 1009) for i in range(2000)]
    whole, parts = " ".join(words), [" ".join(words[i:i + 104]) for i in range(0, 2000, 100)]
    merged = M.merge(sketches(docs_of, parts, 64).withColumn("one", F.lit(1)), ["one"], k=64)
    assert merged.first().sketch == bottom(whole, 64)
    empty = M.merge(sketches(docs_of, ["", "a"], 64), ["doc_id"], k=64)
    assert {r.doc_id: r.sketch for r in empty.collect()} == {0: [], 1: bottom("a", 64)}
    a, b = (F.lit(bottom(p, 64)) for p in parts[:2])
    row = docs_of([(1, "x")]).select(M.union(a, b, 64).alias("u")).first()
    assert row.u == sorted(set(bottom(parts[0], 64)) | set(bottom(parts[1], 64)))[:64]


def test_estimates(docs_of):
    a = " ".join(f"w{i}" for i in range(8000))
    b = " ".join(f"w{i}" for i in range(2000, 10000))
    x, y = (F.lit(bottom(t, 512)) for t in (a, b))
    row = docs_of([(1, "x")]).select(
        M.resemblance(x, y, 512), M.containment(x, y, 512), M.distinct_shingles(x, 512), M.distinct_shingles(F.lit(bottom("a b", 512)), 512)).first()
    assert row[0] == pytest.approx(0.6, abs=0.08) and row[1] == pytest.approx(0.75, abs=0.08)
    assert row[2] == pytest.approx(7996, rel=0.15) and row[3] == 1


def test_fingerprints_are_read_back(docs_of):
    df = sketches(docs_of, ["", "a", "a b c d e f g h", None], 4)
    assert all(r.a == r.b for r in df.select(F.col("sketch").alias("a"), M.parsed(M.fingerprint(F.col("sketch"))).alias("b")).collect())


def test_no_python_and_one_shuffle_of_texts(spark, sf_dir):
    from paylens.llm.queries import op11_fingerprint
    plan = op11_fingerprint(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
