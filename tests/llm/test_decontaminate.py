import hashlib
import random

import pytest
from llm_fixtures import docs_of, odd  # noqa: F401

from paylens.llm import decontaminate as M
from paylens.llm.blocks import alnum_words

ITEMS = "item_id long, text string"


def brute(rows, items, window, slop):
    wins = [(i, tuple(w[k:k + window])) for i, t in items for w in [alnum_words(t)]
            for k in range(max(1, len(w) - window + 1) if w else 0)]
    out = []
    for d, t in rows:
        w = alnum_words(t)
        hits, found, near = set(), set(), set()
        for i, win in wins:
            n = len(win)
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) == win:
                    hits |= set(range(k, k + n))
                    found.add(i)
            need = {x: win.count(x) for x in win}
            for k in range(max(1, len(w) - n - slop + 1)):
                span = w[k:k + n + slop]
                if all(span.count(x) >= c for x, c in need.items()):
                    near.add(i)
        out.append((d, len(w), sorted(hits), sorted(found - {None}), sorted(near - {None})))
    return sorted(out, key=str)


def got(spark, docs, items, window, slop, **options):
    index = M.build_index(docs, options.pop("block_chars", 400))
    found = M.matches(index, spark.createDataFrame(items, ITEMS), window, slop, **options)
    return sorted(((r.doc_id, r.n_words, r.hits, r.items, r.near_items) for r in found.collect()), key=str)


@pytest.mark.parametrize("batch_chars", [10**6, 40])
def test_matches_equal_brute_force(spark, docs_of, batch_chars):
    rng = random.Random(batch_chars)
    words = lambda n: [rng.choice("abcdefg") for _ in range(n)]
    items = [(i, " ".join(words(rng.randrange(1, 9)))) for i in range(12)] + [(3, "a a b"), (99, None), (98, "!?"), (None, "a")]
    rows = [(i, " ".join(words(rng.randrange(0, 40)))) for i in range(50)]
    assert got(spark, docs_of(rows), items, 4, 2, batch_chars=batch_chars) == brute(rows, items, 4, 2)


def test_phrases_do_not_span_documents(spark, docs_of):
    rows = [(1, "one two"), (2, "three four")]
    assert got(spark, docs_of(rows, 1), [(7, "two three")], 13, 7) == [(1, 2, [], [], []), (2, 2, [], [], [])]


def test_odd_rows(spark, docs_of, odd):
    items = [(1, "text without id"), (2, ""), (3, "words two"), (4, "beyond every float an id")]
    assert got(spark, docs_of(odd), items, 13, 7) == brute(odd, items, 13, 7)


def test_empty_tables(spark, docs_of):
    assert got(spark, docs_of([]), [(1, "a")], 13, 7) == []
    assert got(spark, docs_of([(1, "a b")]), [], 13, 7) == [(1, 2, [], [], [])]


def test_very_long_text(spark, docs_of):
    rows = [(1, "x " * 300_000 + "the planted phrase of the benchmark"), (2, "x")]
    (one, two) = got(spark, docs_of(rows), [(5, "planted phrase of the")], 13, 7)
    assert one[1:4] == (300_006, [300_001, 300_002, 300_003, 300_004], [5]) and two[2:4] == ([], [])


def test_contamination_needs_a_twentieth(spark, docs_of):
    item = " ".join(f"w{i}" for i in range(13))
    filler = lambda n: " ".join(f"f{i}" for i in range(n))
    rows = [(1, f"{filler(247)} {item}"), (2, f"{filler(248)} {item}"), (3, filler(20)), (None, item), (4, None)]
    items = spark.createDataFrame([(1, item)], ITEMS)
    verdict = {r.doc_id: (r.n_hit, r.contaminated) for r in M.contamination(docs_of(rows), items).collect()}
    assert verdict == {1: (13, True), 2: (13, False), 3: (0, False), None: (13, True), 4: (0, False)}
    kept = M.drop_contaminated(docs_of(rows), items)
    assert {r.doc_id for r in kept.collect()} == {2, 3, 4, None} and kept.columns == docs_of(rows).columns


def test_registered_digest(spark, sf_dir):
    from paylens.llm.queries import op4_decontaminate

    rows = op4_decontaminate(spark, sf_dir).collect()
    assert hashlib.sha256(b"").hexdigest() in {r.items_sha256 for r in rows} and any(r.contaminated for r in rows)


def test_rows_are_dropped_by_id_and_text(spark, docs_of):
    item = " ".join(f"w{i}" for i in range(13))
    items = spark.createDataFrame([(1, item)], ITEMS)
    rows = [(1, item), (1, "clean"), (None, item), (None, "clean too"), (None, None)]
    left = lambda **options: {(r.doc_id, r.text) for r in M.drop_contaminated(docs_of(rows), items, **options).collect()}
    assert left(null_ids=True) == {(1, "clean"), (None, "clean too"), (None, None)}
    assert left() == {(1, "clean"), (None, "clean too"), (None, None), (None, item)}


def test_items_without_id_hit_words_but_have_no_name(spark, docs_of):
    item = " ".join(f"w{i}" for i in range(13))
    items = spark.createDataFrame([(None, item), (5, f"x {item}")], ITEMS)
    out = {r.doc_id: (len(r.hits), r.items, r.contaminated) for r in M.contamination(docs_of([(1, item), (2, f"x {item}"), (3, "w1 w2")]), items).collect()}
    assert out == {1: (13, [5], True), 2: (14, [5], True), 3: (0, [], False)}
    only = {r.doc_id: (len(r.hits), r.items) for r in M.contamination(docs_of([(1, item)]), items.where("item_id IS NULL")).collect()}
    assert only == {1: (13, [])}
