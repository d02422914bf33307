import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from llm_fixtures import docs_of, odd  # noqa: F401

from paylens.llm import line_dedup as M


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.text("ab😀é", max_size=12), st.text("ab😀é", max_size=12)), min_size=1, max_size=30), st.integers(0, 6))
def test_banded_distance(pairs, tau):
    a, b = map(list, zip(*pairs))
    assert M.within(a, b, tau).tolist() == [distance(x, y) <= tau for x, y in pairs]


def near(a, b, tau):
    """Are a and b within tau edits? Tries each edit where they first differ."""
    if abs(len(a) - len(b)) > tau:
        return False
    start = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    a, b = a[start:], b[start:]
    if not a or not b:
        return len(a) + len(b) <= tau
    return tau > 0 and (near(a[1:], b, tau - 1) or near(a, b[1:], tau - 1) or near(a[1:], b[1:], tau - 1))


def edited(line, n, rng):
    line = list(line)
    for _ in range(n):
        i = rng.randrange(len(line))
        what = rng.randrange(3)
        if what == 0:
            line.insert(i, rng.choice("xyzé"))
        elif what == 1:
            line[i] = rng.choice("xyzé")
        else:
            del line[i]
    return "".join(line)


def test_banded_distance_of_long_lines():
    rng = random.Random(5)
    lines = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(60, 700))) for _ in range(60)]
    others = [edited(x, rng.randrange(7), rng) for x in lines]
    assert M.within(lines, others, 3).tolist() == [distance(x, y) <= 3 for x, y in zip(lines, others)]


@settings(deadline=None, max_examples=60)
@given(st.text("abc", min_size=8, max_size=16), st.integers(1, 3), st.randoms(use_true_random=False))
def test_near_lines_share_a_key(line, tau, rng):
    other = edited(line, rng.randrange(tau + 1), rng)
    if len(other) < 8 or other == line:
        return
    keys, rows, probes, probe_rows = M.segment_keys(M.Rolling([line, other]), tau, 4)
    at = [({k for k, r in zip(keys, rows) if r == i}, {k for k, r in zip(probes, probe_rows) if r == i}) for i in (0, 1)]
    assert at[0][0] & at[1][1] or at[1][0] & at[0][1]
    marks = M.sketches(M.Rolling([line, other]))
    assert bin(int(marks[0]) ^ int(marks[1])).count("1") <= 4 * tau


def brute(rows, tau, least):
    rank = lambda d: (d is None, d or 0)
    first = {}
    for d, p, x in sorted(((d, p, x) for d, t in rows for p, x in enumerate((t or "").split("\n")) if len(x) >= least),
                          key=lambda o: (rank(o[0]), o[1])):
        first.setdefault(x, (rank(d), p))
    by_length = defaultdict(list)
    for x in first:
        by_length[len(x)].append(x)
    gone = {x for x in first for n in range(len(x) - tau, len(x) + tau + 1) for y in by_length[n]
            if first[y] < first[x] and near(x, y, tau)}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        keep = [x for p, x in enumerate(lines) if len(x) < least or (x not in gone and first[x] == (rank(d), p))]
        out.append((d, t if len(keep) == len(lines) else "\n".join(keep), len(lines) if t else 0, len(lines) - len(keep)))
    return out


def got(docs, **options):
    return sorted(((r.doc_id, r.kept, r.n_lines, r.n_dropped) for r in M.kept_lines(docs, **options).collect()), key=str)


@pytest.mark.parametrize("k", [1, 64])
def test_kept_lines_equal_brute_force(docs_of, k):
    rng = random.Random(k)
    lines = ["".join(rng.choice("abcde ") for _ in range(rng.randrange(8, 40))) for _ in range(40)]
    rows = [(i, "\n".join(edited(rng.choice(lines), rng.choice([0, 0, 1, 2, 3]), rng) for _ in range(rng.randrange(6)))) for i in range(60)]
    assert got(docs_of(rows), tau=2, least=12, k=k, block_chars=300) == sorted(brute(rows, 2, 12), key=str)


def test_group_of_near_lines_with_few_partners_per_round(docs_of):
    rng = random.Random(9)
    base = "the same long line of text that everyone writes with a word of their own"
    rows = [(i, base[:30] + "".join(rng.choice("abcdefgh") for _ in range(4)) + base[34:]) for i in range(60)]
    assert got(docs_of(rows), tau=2, least=12, k=1, block_chars=500) == sorted(brute(rows, 2, 12), key=str)


def test_odd_rows(docs_of, odd):
    rows = [*odd, (9, "a line of some length\n\na line of some length"), (None, "a line of some length"), (10, "a" * 50_000), (11, "a" * 49_999)]
    # rows that repeat doc_id and text are one document
    want = {r: None for r in brute(rows, 2, 20)}
    assert set(got(docs_of(rows), tau=2, least=20)) == set(want)
    assert M.kept_lines(docs_of([])).collect() == []


def test_dedup_keeps_columns_and_drops_emptied_documents(docs_of, spark):
    line = "a line that is long enough to count"
    docs = docs_of([(1, line), (2, line), (3, f"{line}\nshort"), (4, None), (5, "")]).withColumn("n_chars", F.lit(7).cast("long"))
    out = {r.doc_id: (r.text, r.n_chars, r.key, r.kept) for r in M.dedup(docs).collect()}
    assert out == {1: (line, 7, "x", "z"), 3: ("short", 5, "x", "z"), 4: (None, 7, "x", "z"), 5: ("", 7, "x", "z")}
    assert M.dedup(docs).columns == docs.columns


def test_exact_copies_with_short_and_blank_lines_go(docs_of):
    text = "a line that is long enough to count\nEauouon.\n\n \nAll rights reserved."
    docs = docs_of([(1, text), (2, text), (3, f"{text}\n"), (4, f"Of its own.\n{text}"), (5, "\n\n")])
    assert {r.doc_id: r.text for r in M.dedup(docs).collect()} == {1: text, 4: "Of its own.\n\n ", 5: "\n\n"}


def test_shorter_lines_may_differ_by_fewer_edits(docs_of):
    rng = random.Random(4)
    lines = ["".join(rng.choice("abcd ") for _ in range(n)) for n in (5, 8, 11, 12, 13, 17, 22, 23, 24, 25, 26, 30) for _ in range(3)]
    rows = [(i, "\n".join(edited(rng.choice(lines), rng.choice([0, 0, 1, 1, 2, 3]), rng) or "x" for _ in range(5))) for i in range(60)]
    order = {}
    for i, t in rows:
        for p, x in enumerate(t.split("\n")):
            order.setdefault(x, (i, p))
    blank = lambda x: not x.strip()
    gone = {x for x in order for y in order if order[y] < order[x] and near(x, y, min(2, len(x) // 12, len(y) // 12))}
    want = {i: "\n".join(x for p, x in enumerate(t.split("\n")) if blank(x) or (x not in gone and order[x] == (i, p))) for i, t in rows}
    for k in (1, 64):
        assert {r.doc_id: r.kept for r in M.kept_lines(docs_of(rows), k=k, block_chars=300).collect()} == want
    assert any(12 <= len(x) < 24 for x in gone) and any(len(x) >= 24 for x in gone)
