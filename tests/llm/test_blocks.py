import re

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from paylens.llm import blocks as B


@given(st.text())
def test_words_are_those_of_the_patterns(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text.encode("utf-8", "ignore").decode())
    text = text.encode("utf-8", "ignore").decode()
    assert [w.decode() for w in B.space_words(text)] == re.findall(r"[^\x20\x09-\x0D]+", lower)
    assert [w.decode() for w in B.alnum_words(text)] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_null_has_no_words():
    assert B.space_words(None) == B.alnum_words(None) == []


@given(st.lists(st.integers(0, 2**64 - 1)))
def test_packing_round_trips(values):
    a = np.array(values, np.uint64)
    assert B.unpack(B.pack(a, np.uint64), np.uint64).tolist() == values
    assert B.unpack_sorted(B.pack_sorted(np.sort(a))).tolist() == sorted(values)


@given(st.lists(st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1))))
def test_nullable_ids_round_trip(ids):
    assert B.unpack_ids(B.pack_ids(ids)) == ids


@given(st.lists(st.integers(0, 2**40 - 1)), st.integers(1, 9))
def test_every_hash_belongs_to_one_shard(values, n):
    a = np.sort(np.array(values, np.uint64))
    at = B.cut(a, n, 40)
    assert at[0] == 0 and at[-1] == len(a) and (np.diff(at) >= 0).all()
    for i, v in enumerate(a.tolist()):
        assert at[v * n >> 40] <= i < at[(v * n >> 40) + 1]


@settings(deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), max_size=40), st.integers(1, 60), st.integers(1, 5))
def test_blocks_keep_all_rows_in_order(texts, limit, batch):
    frames = [pd.DataFrame({"t": texts[i:i + batch]}, dtype=object) for i in range(0, len(texts), batch)]
    out = list(B.blocks(iter(frames), "t", limit))
    assert [t for f in out for t in B.texts_of(f, "t")] == texts
    for f in out:
        assert len(f) == 1 or sum(len(t or "") for t in f["t"]) <= limit + len(f)


def test_maps_leave_no_file():
    a = B.mapped(b"abc")
    assert bytes(a) == b"abc" and B.mapped(b"").tolist() == []
