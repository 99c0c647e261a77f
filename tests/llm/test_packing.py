import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from helpers import documents, table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from seekframe.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
POOL = ["the", "  ", "\n", "\n\n", "'s", "don't", " x's", "é", "\U0001f600", "漢字", "<|endoftext|>", "\x1c",
        "\x85", "\xa0", "​", "　", "123", "½²", "_", ".", " .", "abc,", " (def)", "a" * 60]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(POOL), st.text(max_size=4)), max_size=10).map("".join))
def test_ids_of_any_text(text):
    ids = packing._ids(PATH)(text).tolist()
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids


LATIN = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c not in "ªµº")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.builds(str.__add__, st.sampled_from(["", " "]), st.text(LATIN, min_size=1, max_size=60)),
                max_size=30, unique=True))
def test_ids_of_letters_and_of_pieces_met_before(words):
    ids, kept = packing._ids(PATH), packing.KEPT
    texts = ["".join(words), "|".join(words), ".".join(reversed(words))]
    packing.KEPT = 3  # pieces are forgotten and met again
    try:
        got = [i.tolist() for i in ids.encode_all(texts, ids.new_pieces())]
    finally:
        packing.KEPT = kept
    assert got == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_runs_of_letters_go_to_the_model_without_the_whole_tokenizer(monkeypatch):
    ids, asked = packing.Ids(PATH), []
    assert ids.direct
    monkeypatch.setattr(ids, "library", lambda new: asked.append(new) or packing.Ids.library(ids, new))
    text = "The café, naïve words. " * 3 + "a1 " + "x" * 60
    assert next(ids.encode_all([text], ids.new_pieces())).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert sorted(asked) == sorted([",", ".", " a1", " " + "x" * 60])


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), max_size=4), st.integers(0, 20))
def test_fullest_is_the_best_combination(counts, room):
    totals = {sum(n * c for n, c in zip(counts, take))
              for take in product(*[range(c + 1) for c in counts.values()])}
    chosen = packing.fullest(counts, room)
    assert sum(n * c for n, c in chosen.items()) == max(t for t in totals if t <= room)
    assert all(c <= counts[n] for n, c in chosen.items())


def test_patterns_place_all_pieces():
    draw = random.Random(1)
    counts = Counter(draw.randrange(1, 1025) for _ in range(5000)) + Counter({700: 4000})
    left = Counter(counts)
    for pattern, times in packing.minimum_bin_slack(counts):
        assert sum(n * c for n, c in pattern.items()) <= 1024
        left.subtract({n: c * times for n, c in pattern.items()})
    assert not any(left.values())
    assert packing.minimum_bin_slack({}) == []


def check(rows, ids_of, capacity):
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for who, found in pieces.items():
        ids = np.array(ids_of[who] + [2], dtype="<u4")
        found.sort(key=lambda r: r.piece)
        assert [r.piece for r in found] == list(range(len(found)))
        assert [r.start for r in found] == [sum(f.length for f in found[:i]) for i in range(len(found))]
        assert sum(r.length for r in found) == len(ids)
        assert all(r.length == capacity for r in found[1:])
        for r in found:
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    return bins


@pytest.mark.parametrize("capacity", [1024, 64])
def test_table(spark, capacity):
    docs = table(spark, "documents")
    rows = packing.pack_documents(docs, PATH, capacity).collect()
    ids = {r.doc_id: LIBRARY.encode(r.text, add_special_tokens=False).ids for r in docs.collect()}
    assert {r.doc_id for r in rows} == set(ids)
    bins = check(rows, ids, capacity)
    least = -(-sum(len(i) + 1 for i in ids.values()) // capacity)
    assert len(bins) <= 1.02 * least + 1


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (5, "word " * 3000)]
    docs = documents(spark, rows).selectExpr("*", "1 AS length", "2 AS _slot", "3 AS piece")
    got = packing.pack_documents(docs, PATH).collect()
    assert Counter(r.doc_id for r in got if r.piece == 0) == Counter(i for i, _ in rows)
    assert [r.length for r in got if r.doc_id in (1, 2)] == [1, 1]
    places = [(r.sequence_id, r.offset + k) for r in got for k in range(r.length)]
    assert len(places) == len(set(places))
    assert packing.pack_documents(documents(spark, []), PATH).collect() == []
