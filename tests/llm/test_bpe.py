import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from llm_fixtures import docs_of, odd, texts  # noqa: F401

from paylens.llm import bpe as M

PATH = public_tokenizers.path("word_bpe_49k.json")
RULES = M.Bpe.load(PATH)
ENCODER = M.Encoder(RULES)
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.no_truncation()
LIBRARY.no_padding()


def library(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


@settings(deadline=None, max_examples=400)
@given(st.text(max_size=40))
@example("<|startoftext|>It's <|ENDOFTEXT|><|endoftext|>x'LL 12½ ΑΣ İx é y\x1cz\x85  ")
@example("Ꟛ\U00018e67\U00010d50Ᲊ ՘")
def test_ids_equal_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = ENCODER.text(text)
    assert (np.frombuffer(ids, "<u4").tolist(), M.decode(ids, RULES).decode()) == library(text)


@pytest.mark.parametrize("word", ["the" * 77, "averyverylongword" * 300, "é" * 999 + "x", "zq" * 500, "a" * 101])
def test_long_words_equal_the_library(word):
    assert np.frombuffer(M.Encoder(RULES).text(word), "<u4").tolist() == library(word)[0]


@settings(deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=4), min_size=1, max_size=60),
       st.lists(st.binary(max_size=7), max_size=20))
def test_lexicon_has_its_words_only(entries, others):
    lexicon = M.Lexicon(M.Lexicon.build(entries))
    for w in [*entries, *others]:
        assert lexicon.get(w) == entries.get(w)


def test_lexicon_shares_suffixes():
    stems, endings = [f"s{i}x" for i in range(50)], ["ing", "ings", "ed", "er", "ers"]
    entries = {(a + b).encode(): [1] for a in stems for b in endings}
    arcs = len(M.Lexicon(M.Lexicon.build(entries)).targets)
    assert arcs < 150 < sum(map(len, entries))


def test_frequent_words_are_counted_over_all_blocks(docs_of):
    rows = [(i, "the cat " * (i % 4) + f"word{i}") for i in range(40)]
    words = M.frequent_words(docs_of(rows), RULES, 4, block_chars=50)
    # numerals are words of their own
    assert words[:3] == [b"cat", b"the", b"word"] and len(words) == 4


@pytest.mark.parametrize("size", [1, 1000])
def test_documents_equal_the_library(docs_of, texts, odd, size):
    rows = texts[:60] + odd + [(77, "averyverylongword" * 3000), (78, "w " * 100_000)]
    done = M.encode(docs_of(rows), RULES, size, block_chars=20_000).collect()
    got = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.text) for r in done), key=str)
    assert got == sorted(((d, *library(t)) for d, t in rows), key=str)


def test_empty_table(docs_of):
    assert M.digests(docs_of([]), RULES).collect() == []


def test_digests_are_of_ids_and_text(docs_of, texts):
    rows = texts[:20]
    both = M.encode(docs_of(rows), RULES, 50).join(M.digests(docs_of(rows), RULES, 50, ids=True).withColumnRenamed("ids", "same"), "doc_id")
    for r in both.collect():
        assert r.ids == r.same and len(r.ids) == 4 * r.n_tokens
    small = M.digests(docs_of(rows), RULES, 50).collect()
    for r in small:
        ids, text = library(dict(rows)[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
