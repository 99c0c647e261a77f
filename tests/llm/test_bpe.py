import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from helpers import documents, table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from seekframe.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = bpe.Encoder(PATH)
POOL = ["the", "  ", "\n", "'s", "don't", "x's", "ΑΣ Σ", "İstanbul", "é", "é", "\U0001f600", "漢字",
        "한글", "가", "<|endoftext|>", "<|startoftext|>", "</w>", "\x1c", "\x85", "\xa0",
        "​", "　", "123", "½²", "_", "a" * 50, "aaabbb" * 9, "\x00", "!?,.", "ﬁ", "ͅ"]


def library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(POOL), st.text(max_size=4)), max_size=10).map("".join))
def test_any_text(text):
    ids, decoded = library(text)
    got = ENCODER.encode(text)
    assert got.tolist() == ids
    assert ENCODER.decode(got).decode() == decoded


def test_long_words_take_linear_time():
    for text in ("ab" * 100_000, "a" * 100_001, "qzxj" * 20_000):
        assert ENCODER.encode(text).tolist() == library(text)[0]


def test_compatible_pairs_are_those_the_library_keeps_apart():
    draw = random.Random(4)
    plain = [i for i, t in enumerate(ENCODER.texts) if t.isascii() and t.isalpha() and t.islower()]
    ended = [i for i, t in enumerate(ENCODER.texts) if t[:-1].isascii() and t[:-1].isalpha()
             and t[:-1].islower() and not t.isascii()]
    for _ in range(2000):
        left, right = draw.choice(plain), draw.choice(ended)
        ids = [int(ENCODER.ids[left]), int(ENCODER.ids[right])]
        text = ENCODER.texts[left] + ENCODER.texts[right][:-1]
        assert ENCODER.compatible(left, right) == (library(text)[0] == ids)


def test_table(spark):
    docs = table(spark, "documents")
    got = {tuple(r) for r in bpe.round_trip(docs, PATH).collect()}
    want = set()
    for row in docs.select("doc_id", "text").collect():
        ids, text = library(row.text)
        want.add((row.doc_id, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                  hashlib.sha256(text.encode()).hexdigest()))
    assert got == want


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (2, "Hello there"), (2, "Hello there"), (None, "x y"), (3, " \n")]
    docs = documents(spark, rows).selectExpr("*", "1 AS ids", "2 AS n_tokens", "3 AS _id")
    out = bpe.encode_documents(docs, PATH)
    assert sorted(((r.doc_id, r.ids) for r in out.collect()), key=str) == sorted(
        ((i, library(t or "")[0]) for i, t in rows), key=str)
    back = bpe.decode_documents(out, PATH)
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=str) == sorted(
        ((i, library(t or "")[1]) for i, t in rows), key=str)
    assert bpe.round_trip(docs, PATH).count() == 6


def test_empty_table(spark):
    docs = documents(spark, [])
    assert bpe.round_trip(docs, PATH).collect() == []
    assert bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH).collect() == []


def test_a_vocabulary_with_ambiguous_merges_is_refused(tmp_path):
    bad = tmp_path / "bad.json"
    text = open(PATH, encoding="utf-8").read()
    at = text.index('"merges":[') + len('"merges":[')
    bad.write_text(text[:at] + '["i","n"],' + text[at:], encoding="utf-8")
    with pytest.raises(ValueError):
        bpe.Encoder(str(bad))
