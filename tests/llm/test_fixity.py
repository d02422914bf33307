import hashlib

from paylens.llm import fixity

SCHEMA = "archive string, offset long, body string, digest string"


def records(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(3)


def found(spark, a, b, **shape):
    out = fixity.damage(records(spark, a), records(spark, b), "archive", "offset", ["body"], **shape)
    return sorted(((r.archive, r.offset, r.record_sha256, r.n_primary, r.n_replica) for r in out.collect()), key=str)


def digest(body):
    return hashlib.sha256(("-:" if body is None else f"{len(body)}:{body}").encode()).hexdigest()


def test_damage_is_located(spark):
    a = [("a", i, f"body {i}") for i in range(300)] + [("b", i, f"other {i}") for i in range(50)]
    b = [r for r in a if r[:2] not in {("a", 7), ("b", 49)}] + [("a", 7, "changed"), ("c", 1, "new")]
    assert found(spark, a, b, fanout=4, levels=3) == sorted([
        ("a", 7, digest("body 7"), 1, 0), ("a", 7, digest("changed"), 0, 1), ("b", 49, digest("other 49"), 1, 0), ("c", 1, digest("new"), 0, 1)])


def test_equal_replicas_and_order_of_rows(spark):
    a = [("a", i % 7, f"{i}") for i in range(40)]
    assert found(spark, a, a[::-1]) == []


def test_repeats_nulls_and_empty_texts(spark):
    a = [("a", 1, "x"), ("a", 1, "x"), ("a", 2, None), (None, None, "n"), ("a", 3, "")]
    b = [("a", 1, "x"), ("a", 2, ""), (None, None, "n"), ("a", 3, None)]
    assert found(spark, a, b) == sorted([
        ("a", 1, digest("x"), 2, 1), ("a", 2, digest(None), 1, 0), ("a", 2, digest(""), 0, 1), ("a", 3, digest(""), 1, 0),
        ("a", 3, digest(None), 0, 1)])


def test_null_names_and_offsets_equal_nothing_else(spark):
    names = [None, "", "\0n", "\0e", "\0o", "\0o\0n", "n", "a"]
    for x in names:
        for y in names:
            want = [] if x == y else [(x, 1, digest("b"), 1, 0), (y, 1, digest("b"), 0, 1)]
            if x is None or (x, y) in {("", "n"), ("\0n", "\0e"), ("a", "\0o\0n"), ("\0o", "\0o")}:
                assert found(spark, [(x, 1, "b")], [(y, 1, "b")]) == sorted(want, key=str)
    for x, y in ((None, -1), (None, 0), (0, None), (-1, 0)):
        assert found(spark, [("a", x, "b")], [("a", y, "b")]) == sorted([("a", x, digest("b"), 1, 0), ("a", y, digest("b"), 0, 1)], key=str)
    assert found(spark, [(None, None, "b")], [(None, 5, "b")]) == sorted([(None, None, digest("b"), 1, 0), (None, 5, digest("b"), 0, 1)], key=str)


def test_levels_grow_with_the_offsets(spark):
    a = [("a", 10**9 + 512 * i, f"{i}") for i in range(20)] + [("a", 3, "x")]
    tree = fixity.tree(records(spark, a), "archive", "offset", ["body"])
    assert len(tree) == 10 and tree[-2].count() == 1
    assert found(spark, a, a[1:]) == [("a", 10**9, digest("0"), 1, 0)]


def test_empty_replicas(spark):
    a = [("a", 1, "x")]
    assert found(spark, [], []) == []
    assert found(spark, a, []) == [("a", 1, digest("x"), 1, 0)]
    assert found(spark, [], a) == [("a", 1, digest("x"), 0, 1)]


def test_only_differing_branches_are_visited(spark):
    a = records(spark, [("a", i, f"{i}") for i in range(256)])
    b = records(spark, [("a", i, f"{i}" if i != 200 else "?") for i in range(256)])
    x, y = (fixity.tree(t, "archive", "offset", ["body"], fanout=4, levels=3) for t in (a, b))
    assert [(r.archive, r.node) for r in fixity.audit(x, y, fanout=4).collect()] == [("a", 200)]
    assert [level.count() for level in x] == [256, 64, 16, 4, 1]
    assert [fixity.differing(p, q).count() for p, q in zip(x, y)] == [1] * 5
