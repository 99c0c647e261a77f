"""Exact byte-pair encoding by backtracking over longest matches, and decoding by offset table.

A word's tokens are found left to right. An Aho-Corasick pass gives the longest token at every
position; a candidate is accepted if it may stand after the previous token, that is, if no merge
that the encoder would make earlier crosses their border. Otherwise the next shorter token is
tried, then the previous token is shortened; positions that failed are marked and never tried
again. Time grows with the length of the word, however long it is.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from seekframe.llm.pieces import KEPT_CHARS, PIECE, Generations, encoded, encoded_apart, valid
from seekframe.session import spread

KEPT_WORDS = 200_000
_END = ""  # stands for the end-of-word suffix, outside the byte alphabet


class Encoder:
    """One vocabulary file. Token numbers inside are ranks: base symbols first, then merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))))
        library = Tokenizer.from_file(path)
        self.normalize = library.normalizer.normalize_str
        self.split = library.pre_tokenizer.pre_tokenize_str
        vocabulary, merges = model["vocab"], [tuple(m) for m in model["merges"]]
        made = {a + b for a, b in merges}
        base = sorted((t for t in vocabulary if t not in made), key=vocabulary.get)
        names = base + [a + b for a, b in merges]
        rank = {name: i for i, name in enumerate(names)}
        if len(rank) != len(names):
            raise ValueError("a token is made by two merges")
        self.ids = np.array([vocabulary[name] for name in names], dtype="<u4")
        self.parts = [(i, i) for i in range(len(base))] + [(rank[a], rank[b]) for a, b in merges]
        self.merged = {pair: len(base) + i for i, pair in enumerate(self.parts[len(base):])}
        self.texts = [self._symbols(name) for name in names]
        self.by_text = {text: i for i, text in enumerate(self.texts)}
        self.automaton = ahocorasick.Automaton()
        for text, i in self.by_text.items():
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self.shorter: dict[int, int] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        # Two generations of words: when the younger is full it becomes the older one.
        self.words: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}
        self.names = {vocabulary[name]: name for name in names} | {
            i: text for text, i in self.added.items()}

    def _symbols(self, name: str) -> str:
        if self.suffix and name.endswith(self.suffix) and name != self.suffix:
            return name[:-len(self.suffix)] + _END
        return name

    def _prefix(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``, or -1."""
        if token not in self.shorter:
            text = self.texts[token]
            self.shorter[token] = next((self.by_text[text[:n]] for n in range(len(text) - 1, 0, -1)
                                        if text[:n] in self.by_text), -1)
        return self.shorter[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their texts are encoded as one.

        Both are taken apart in the reverse order of their merges; a merge across the border that
        comes before the one just undone would have been made instead.
        """
        key = (left, right)
        if key in self.fits:
            return self.fits[key]
        bound, apart, result = len(self.parts), False, True
        while not apart:
            across = self.merged.get((left, right), bound)
            if across < bound:
                result = False
                break
            # Undo the later of the two merges; a base symbol cannot be undone.
            inner = [(left, 0) if self.parts[left] != (left, left) else (-1, 0),
                     (right, 1) if self.parts[right] != (right, right) else (-1, 1)]
            latest, side = max(inner)
            if latest < 0:
                apart = True
            elif side == 0:
                bound, left = left, self.parts[left][1]
            else:
                # A merge on the right comes after an equal one on the left.
                bound, right = right + 1, self.parts[right][0]
        if len(self.fits) < KEPT_WORDS:
            self.fits[key] = result
        return result

    def word(self, text: str) -> list[int]:
        """Ranks of one word given in the byte alphabet, end symbol included."""
        size = len(text)
        longest = [-1] * size
        for end, token in self.automaton.iter(text):
            longest[end + 1 - len(self.texts[token])] = token  # later ends are longer
        open_at = bytearray(b"\1") * (size + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < size:
            while token >= 0:
                end = at + len(self.texts[token])
                if open_at[end] and (end == size or longest[end] >= 0) \
                        and (not out or self.compatible(out[-1], token)):
                    break
                token = self._prefix(token)
            if token >= 0:
                out.append(token)
                at = end
                token = longest[at] if at < size else -1
            else:
                open_at[at] = 0
                if not out:
                    raise ValueError("the vocabulary lacks a byte")
                token = out.pop()
                at -= len(self.texts[token])
        return out

    def ranks(self, text: str) -> list[int]:
        """Tokens of text that stands alone, after the library's own normalising and splitting."""
        out: list[int] = []
        for word, _ in self.split(self.normalize(text)):
            found = self.words.get(word)
            if found is None:
                found = self.older.get(word)
                if found is None:
                    found = self.word(word + _END if self.suffix else word)
                if len(word) <= KEPT_CHARS:
                    if len(self.words) >= KEPT_WORDS:
                        self.words, self.older = {}, self.words
                    self.words[word] = found
            out += found
        return out

    def new_pieces(self) -> Generations:
        """A store of encoded pieces, for the length of a task."""
        return Generations(lambda new: [self.ids[self.ranks(p)].tobytes() for p in new])

    def encode_all(self, texts: list[str | None], known: Generations) -> Iterator[np.ndarray]:
        """Ids of whole texts; the strings of added tokens are these tokens."""
        def with_added(text: str) -> bytes | None:
            found = list(self.special.finditer(text))
            if not found:
                return None
            borders = [0, *(at for m in found for at in m.span()), len(text)]
            between = encoded([text[a:b] for a, b in zip(borders[::2], borders[1::2])], PIECE, known)
            added = [self.added[m[0]].to_bytes(4, "little") for m in found]
            return b"".join(part for pair in zip(between, [*added, b""]) for part in pair)

        for ids in encoded_apart([valid(t) for t in texts], PIECE, known, with_added):
            yield np.frombuffer(ids, dtype="<u4")

    def encode(self, text: str | None) -> np.ndarray:
        return next(self.encode_all([text], self.new_pieces()))

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """All tokens' texts in one byte string, each followed by a blank, and where they start."""
        texts = [(self.names.get(i, "") + " ").encode() for i in range(max(self.names) + 1)]
        starts = np.cumsum([0, *map(len, texts)])
        return np.frombuffer(b"".join(texts), dtype=np.uint8), starts

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the tokens' texts joined by blanks, as the library joins them for vocabularies
        without a decoder of their own."""
        letters, starts = self.table
        out = []
        for at in range(0, len(ids), 1 << 16):
            part = ids[at:at + (1 << 16)].astype(np.int64)
            begin, size = starts[part], starts[part + 1] - starts[part]
            shift = begin - (np.cumsum(size) - size)
            out.append(letters[np.repeat(shift, size) + np.arange(size.sum())].tobytes())
        return b"".join(out)[:-1]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    return Encoder(path)


def _over_texts(docs: DataFrame, path: str, id_column: str, text: str, schema: str,
                make) -> DataFrame:
    """``make(ids, encoder)`` gives the columns after the id for each document."""
    kind = docs.schema[id_column].dataType
    fields = T.StructType([T.StructField(id_column, kind),
                           *T._parse_datatype_string(schema).fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoder(path)
        known = coder.new_pieces()
        for batch in batches:
            # A few texts at a time, so that a batch of long ones is not held twice.
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                texts = [t if isinstance(t, str) else None for t in part["_text"]]
                rows = [make(ids, coder) for ids in coder.encode_all(texts, known)]
                columns = list(zip(*rows))
                yield pd.DataFrame({id_column: part["_id"].to_numpy(), **{
                    f.name: pd.Series(list(c), dtype=object)
                    for f, c in zip(fields.fields[1:], columns)}})

    source = docs.selectExpr(f"`{id_column}` AS _id", f"`{text}` AS _text")
    return spread(source).mapInPandas(run, fields)


def encode_documents(docs: DataFrame, path: str, id_column: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """``(id, ids)`` of every document.

    Null texts count as empty and give no ids. Rows are taken one by one, so repeated rows and null
    ids come back as they are. ``path`` must be readable on every executor, as part of its
    installed packages. Extra columns are left out, whatever their names.
    """
    return _over_texts(docs, path, id_column, text, "ids array<long>",
                       lambda ids, coder: (ids.astype(np.int64),))


def decode_documents(tokens: DataFrame, path: str, id_column: str = "doc_id",
                     ids: str = "ids") -> DataFrame:
    """``(id, text)`` for rows of token ids; a null list counts as empty."""
    kind = tokens.schema[id_column].dataType
    fields = T.StructType([T.StructField(id_column, kind), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [encoder(path).decode(np.asarray([] if i is None else i, dtype=np.int64)).decode()
                     for i in batch["_ids"]]
            yield pd.DataFrame({id_column: batch["_id"].to_numpy(),
                                "text": pd.Series(texts, dtype=object)})
    return tokens.selectExpr(f"`{id_column}` AS _id", f"`{ids}` AS _ids").mapInPandas(run, fields)


def round_trip(docs: DataFrame, path: str, id_column: str = "doc_id",
               text: str = "text") -> DataFrame:
    """Encode and decode every document and return ``n_tokens``, ``ids_sha256`` and
    ``decoded_sha256``, without moving the ids out of the task. Nulls and repeats as in
    ``encode_documents``."""
    def make(ids: np.ndarray, coder: Encoder) -> tuple[int, str, str]:
        return (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                hashlib.sha256(coder.decode(ids)).hexdigest())
    return _over_texts(docs, path, id_column, text,
                       "n_tokens long, ids_sha256 string, decoded_sha256 string", make)
