"""Byte-level BPE against the library and against itself."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from seekframe.llm import byte_bpe, queries
from seekframe.llm.pieces import Generations, encoded
from helpers import FOLDER, documents, table

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def ids_of(text):
    coder = byte_bpe.encoder(PATH)
    known = Generations(coder.encode_pieces)
    return np.frombuffer(next(encoded([text], coder.pattern, known)), dtype="<u4").tolist()


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_query_equals_the_library_on_every_document(spark, library):
    got = {r.doc_id: r for r in queries.QUERIES["op11_byte_bpe"](spark, FOLDER).collect()}
    docs = table(spark, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        text = d.text or ""
        ids = library.encode_ordinary(text)
        assert got[d.doc_id] == (d.doc_id, len(ids), sha(np.array(ids, dtype="<u4").tobytes()),
                                 sha(text.encode()))


@pytest.mark.parametrize("text", [
    "", " ", "a", "\n\n  x", "it's they'LL", "<|endoftext|>", "\x1c\x1d a\x1f", "é́ ß 京都 🎉🎉",
    "   x", "x" * 255, "x" * 256, "x" * 257, "ab" * 20_000, " " * 5000 + "a",
])
def test_texts_of_all_kinds(library, text):
    assert ids_of(text) == library.encode_ordinary(text)


def test_random_pieces_by_matrix_and_by_heap(library):
    draw = random.Random(3)
    coder = byte_bpe.encoder(PATH)
    pieces = ["".join(draw.choices("etaoinshrdlu", k=draw.randint(1, 250))) for _ in range(400)]
    found = coder.encode_pieces(pieces)
    for piece, ids in zip(pieces, found):
        want = library.encode_ordinary(piece)
        assert np.frombuffer(ids, dtype="<u4").tolist() == want
        if len(want) > 1:
            assert coder.long_piece(piece.encode()) == want


def test_every_sign_is_cut_as_the_library_does(library):
    for code in range(0x20, 0x3100):
        text = f"a{chr(code)}{chr(code)} {chr(code)}1{chr(code)}!"
        assert ids_of(text) == library.encode_ordinary(text), hex(code)


def test_pair_table_with_collisions():
    left = np.arange(5000) % 71
    right = np.arange(5000) // 71
    found = byte_bpe.PairTable(left, right, np.arange(5000, dtype=np.int32))
    assert found(left, right).tolist() == list(range(5000))
    assert (found(np.array([-1, 3, 70]), np.array([3, -1, 5000])) == byte_bpe.NONE).all()


def test_generations_keep_what_is_met_again(monkeypatch):
    monkeypatch.setattr("seekframe.llm.pieces.KEPT", 3)
    asked = []

    def encode(pieces):
        asked.extend(pieces)
        return [p.encode() for p in pieces]
    known = Generations(encode)
    for part in (["a", "b", "c", "d"], ["a", "e"], ["a", "x" * 100], ["a", "f", "g", "h"], ["a", "b"]):
        known.learn(set(part))
        assert known.take(part) == "".join(part).encode()
    assert asked.count("a") == 1 and len(known.young) + len(known.old) < 10


def test_nulls_repeats_clashing_columns_and_an_empty_table(spark):
    rows = documents(spark, [(1, None), (1, None), (None, "one"), (2, "")]) \
        .selectExpr("*", "1 AS _id", "2 AS ids", "3 AS _text")
    got = sorted(((r.doc_id, r.n_tokens) for r in byte_bpe.round_trip(rows, PATH).collect()), key=str)
    assert got == [(1, 0), (1, 0), (2, 0), (None, 1)]
    assert byte_bpe.round_trip(rows.limit(0), PATH).count() == 0
    assert byte_bpe.encode_documents(rows.limit(0), PATH).columns == ["doc_id", "ids"]


def test_encode_then_decode(spark):
    rows = documents(spark, [(1, "naïve 京都"), (2, None)])
    ids = byte_bpe.encode_documents(rows, PATH)
    back = {r.doc_id: bytes(r.bytes) for r in byte_bpe.decode_documents(ids, PATH).collect()}
    assert back == {1: "naïve 京都".encode(), 2: b""}


def test_a_long_text_is_cut_in_parts(library, monkeypatch):
    monkeypatch.setattr("seekframe.llm.pieces.PART_CHARS", 1000)
    monkeypatch.setattr("seekframe.llm.pieces.PART_PIECES", 7)
    text = "some words, 12 of them;  and   blanks\n" * 300
    assert ids_of(text) == library.encode_ordinary(text)
