"""Byte-level BPE by rank: padded matrices of token ids, one merge per row and round.

Pieces of text are sorted into buckets by their number of bytes and laid out as rows of a padded
matrix. Beside it stands a matrix with the rank of every neighbouring pair. Each round every row
merges its leftmost pair of least rank, closes the gap, and looks up only the two pairs that are
new. Rows without a pair to merge leave the matrix. A merged pair's token is its rank.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from seekframe.llm.pieces import Generations, encoded, valid
from seekframe.session import spread

NONE = np.int32(2 ** 31 - 1)  # rank of a pair that does not merge
CELLS = 1 << 18  # cells of one matrix
WIDEST = 256  # bytes of a piece in a matrix; longer ones are merged one by one


def splitter(pattern: str) -> regex.Pattern:
    """The pattern with the library's white space: ``\\s`` of Python takes four signs more."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}")
                         .replace(r"\S", r"\P{White_Space}"))


class PairTable:
    """Ranks of pairs of tokens under open addressing, looked up for whole arrays at once."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.bits = max(8, int(4 * len(rank)).bit_length())
        self.keys = np.full(1 << self.bits, 2 ** 64 - 1, dtype=np.uint64)
        self.ranks = np.full(1 << self.bits, NONE, dtype=np.int32)
        key = self._key(left, right)
        slot, open_ = self._slot(key), np.arange(len(key))
        while len(open_):
            # Of the keys that want a free slot one gets it; the others move on.
            free = self.keys[slot[open_]] == np.uint64(2 ** 64 - 1)
            self.keys[slot[open_[free]]] = key[open_[free]]
            placed = self.keys[slot[open_]] == key[open_]
            self.ranks[slot[open_[placed]]] = rank[open_[placed]]
            open_ = open_[~placed]
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``NONE`` where it does not merge or a side is padding (-1)."""
        out = np.full(len(left), NONE, dtype=np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        key = self._key(left[open_], right[open_])
        slot = self._slot(key)
        while len(open_):
            found = self.keys[slot]
            hit = found == key
            out[open_[hit]] = self.ranks[slot[hit]]
            on = ~hit & (found != np.uint64(2 ** 64 - 1))
            open_, key = open_[on], key[on]
            slot = (slot[on] + 1) & ((1 << self.bits) - 1)
        return out


class Encoder:
    """One file of ranks. Ids of texts, and bytes of ids."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as file:
            self.rank = {base64.b64decode(token): int(number)
                         for token, number in map(bytes.split, file)}
        self.pattern = splitter(pattern)
        pairs = [(self.rank[token[:at]], self.rank[token[at:]], number)
                 for token, number in self.rank.items() for at in range(1, len(token))
                 if token[:at] in self.rank and token[at:] in self.rank]
        self.pairs = PairTable(*np.array(pairs, dtype=np.int64).reshape(-1, 3).T)
        self.merges = {(a, b): n for a, b, n in pairs}
        self.four = {token: number.to_bytes(4, "little") for token, number in self.rank.items()}
        self.bytes = np.array([self.rank.get(bytes([b]), -1) for b in range(256)], dtype=np.int32)
        texts = [b""] * (max(self.rank.values()) + 1)
        for token, number in self.rank.items():
            texts[number] = token
        self.starts = np.cumsum([0, *map(len, texts)])
        self.letters = np.frombuffer(b"".join(texts), dtype=np.uint8)

    def matrix(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces of similar length, all in one padded matrix."""
        sizes = np.array(list(map(len, pieces)))
        width = int(sizes.max())
        inside = np.arange(width) < sizes[:, None]
        tokens = np.full(inside.shape, -1, dtype=np.int32)
        tokens[inside] = self.bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        if (tokens[inside] < 0).any():
            raise ValueError("the vocabulary lacks a byte")
        ranks = self.pairs(tokens[:, :-1].ravel(), tokens[:, 1:].ravel()).reshape(len(pieces), -1)
        who, out = np.arange(len(pieces)), [b""] * len(pieces)
        while len(who):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(who), dtype=np.int64)
            rows = np.arange(len(who))
            best = ranks[rows, at] if ranks.shape[1] else np.full(len(who), NONE)
            ready = best == NONE
            if ready.any():
                held = tokens[ready]
                filled = held >= 0
                ids, ends = held[filled].astype("<u4").tobytes(), 4 * filled.sum(axis=1).cumsum()
                start = 0
                for i, end in zip(who[ready].tolist(), ends.tolist()):
                    out[i] = ids[start:end]
                    start = end
                who, at, best = who[~ready], at[~ready], best[~ready]
                tokens, ranks, rows = tokens[~ready], ranks[~ready], np.arange(len(who))
                if not len(who):
                    break
            tokens[rows, at] = best
            # Close the gap: what stands right of the merged pair moves one place to the left.
            column = np.arange(tokens.shape[1] - 1)
            tokens = np.take_along_axis(tokens, column + (column > at[:, None]), axis=1)
            column = column[:-1]
            ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), axis=1)
            before, after = np.flatnonzero(at > 0), np.flatnonzero(at < ranks.shape[1])
            here = at[before]
            ranks[before, here - 1] = self.pairs(tokens[before, here - 1], tokens[before, here])
            here = at[after]
            ranks[after, here] = self.pairs(tokens[after, here], tokens[after, here + 1])
            # Columns that are padding in every row are cut off.
            used = int((tokens >= 0).sum(axis=1).max())
            tokens, ranks = tokens[:, :used], ranks[:, :max(0, used - 1)]
        return out

    def long_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece of any length: the same merges in the same order, the pairs kept in a
        heap by rank and place, so time is that of sorting instead of growing with the square."""
        tokens: list[int] = self.bytes[np.frombuffer(piece, dtype=np.uint8)].tolist()
        if min(tokens) < 0:
            raise ValueError("the vocabulary lacks a byte")
        size = len(tokens)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        merges = self.merges
        heap = [(merges[pair], at) for at, pair in enumerate(zip(tokens, tokens[1:]))
                if pair in merges]
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            right = after[at]
            if tokens[at] < 0 or right == size or merges.get((tokens[at], tokens[right])) != rank:
                continue  # one of its tokens has gone into another merge
            tokens[at], tokens[right] = rank, -1
            after[at] = right = after[right]
            if right < size:
                before[right] = at
                new = merges.get((rank, tokens[right]))
                if new is not None:
                    heapq.heappush(heap, (new, at))
            left = before[at]
            if left >= 0:
                new = merges.get((tokens[left], rank))
                if new is not None:
                    heapq.heappush(heap, (new, left))
        return [t for t in tokens if t >= 0]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian 32-bit numbers. A piece that is a token is that one."""
        raws = [piece.encode() for piece in pieces]
        out = list(map(self.four.get, raws))
        rest = np.array([i for i, ids in enumerate(out) if ids is None], dtype=np.int64)
        sizes = np.array([len(raws[i]) for i in rest], dtype=np.int64)
        order = np.argsort(sizes, kind="stable")
        rest, sizes = rest[order], sizes[order]
        at = 0
        while at < len(rest):
            shortest = int(sizes[at])
            if shortest > WIDEST:
                out[rest[at]] = np.array(self.long_piece(raws[rest[at]]), dtype="<u4").tobytes()
                at += 1
                continue
            # A bucket: lengths within a quarter of each other, at most CELLS cells.
            longest = min(WIDEST, shortest + shortest // 4)
            stop = int(np.searchsorted(sizes, longest, side="right"))
            stop = min(stop, at + max(1, CELLS // longest))
            bucket = rest[at:stop].tolist()
            for i, ids in zip(bucket, self.matrix([raws[i] for i in bucket])):
                out[i] = ids
            at = stop
        return out

    def decode(self, ids: np.ndarray) -> Iterator[bytes]:
        """Bytes of the ids, part by part, gathered through the table of offsets."""
        for at in range(0, len(ids), 1 << 16):
            part = ids[at:at + (1 << 16)].astype(np.int64)
            begin = self.starts[part]
            size = self.starts[part + 1] - begin
            shift = begin - (np.cumsum(size) - size)
            yield self.letters[np.repeat(shift, size) + np.arange(size.sum())].tobytes()


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
        known = Generations(coder.encode_pieces)  # goes with the task
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                texts = [valid(t if isinstance(t, str) else None) for t in part["_text"]]
                columns = zip(*[make(np.frombuffer(ids, dtype="<u4"), coder)
                                for ids in encoded(texts, coder.pattern, known)])
                yield pd.DataFrame({id_column: part["_id"].to_numpy(), **{
                    f.name: pd.Series(list(c), dtype=object)
                    for f, c in zip(fields.fields[1:], columns)}})

    source = docs.selectExpr(f"`{id_column}` AS _id", f"`{text}` AS _text")
    return spread(source).mapInPandas(run, fields)


def encode_documents(docs: DataFrame, path: str, id_column: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """``(id, ids)`` of every document by the ranks in ``path``, without special tokens.

    Null texts count as empty and give no ids. Rows are taken one by one, so repeated rows and null
    ids come back as they are; an empty table gives no rows. Texts and pieces of any length are
    encoded whole. Of pairs with one rank the leftmost merges first. ``path`` must be readable on
    every executor, as part of its installed packages. Extra columns are left out, whatever their
    names.
    """
    return _over_texts(docs, path, id_column, text, "ids array<long>",
                       lambda ids, coder: (ids.astype(np.int64),))


def decode_documents(tokens: DataFrame, path: str, id_column: str = "doc_id",
                     ids: str = "ids") -> DataFrame:
    """``(id, bytes)`` for rows of token ids; a null list counts as empty."""
    kind = tokens.schema[id_column].dataType
    fields = T.StructType([T.StructField(id_column, kind), T.StructField("bytes", T.BinaryType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [b"".join(encoder(path).decode(np.asarray([] if i is None else i, dtype=np.int64)))
                     for i in batch["_ids"]]
            yield pd.DataFrame({id_column: batch["_id"].to_numpy(),
                                "bytes": pd.Series(found, dtype=object)})
    return tokens.selectExpr(f"`{id_column}` AS _id", f"`{ids}` AS _ids").mapInPandas(run, fields)


def round_trip(docs: DataFrame, path: str, id_column: str = "doc_id",
               text: str = "text") -> DataFrame:
    """Encode and decode every document and return ``n_tokens``, ``ids_sha256`` and
    ``decoded_sha256``, without moving the ids out of the task. Nulls and repeats as in
    :func:`encode_documents`."""
    def make(ids: np.ndarray, coder: Encoder) -> tuple[int, str, str]:
        decoded = hashlib.sha256()
        for part in coder.decode(ids):
            decoded.update(part)
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), decoded.hexdigest()
    return _over_texts(docs, path, id_column, text,
                       "n_tokens long, ids_sha256 string, decoded_sha256 string", make)
