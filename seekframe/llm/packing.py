"""Packing token sequences by minimum bin slack.

Only the lengths matter for packing, and there are at most as many as a sequence has places. So the
lengths are counted in Spark, the counts (at most ``capacity`` rows) are packed on the driver, and
the resulting patterns are dealt back to the pieces by their rank among pieces of equal length. The
driver's work does not grow with the corpus.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from seekframe.llm.pieces import KEPT, KEPT_CHARS, LETTERS, PIECE, parts, valid
from seekframe.operators.skew import join_lookup
from seekframe.session import materialise, spread

CAPACITY = 1024


class Known(dict):
    """Ids of pieces as little-endian bytes, for the length of a task; a piece not met before is
    encoded when it is looked up.

    Two generations as in ``Generations``: ``turn`` makes a full one the old one, and pieces met
    again move up from there. Pieces of over ``KEPT_CHARS`` are not held.
    """

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            found = self.encode(piece)
        if len(piece) <= KEPT_CHARS:
            self[piece] = found
        return found

    def turn(self) -> None:
        if len(self) > KEPT:
            self.old = dict(self)
            self.clear()


class Ids:
    """Ids of whole texts by the library. Texts are cut where its pattern always cuts. A piece that
    is one run of letters goes to the library's model at once if its pattern leaves it whole."""

    def __init__(self, path: str):
        # Tasks are the unit of parallel work; the library's own threads would crowd the executor.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model, cut = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.direct = (self.tokenizer.normalizer is None and isinstance(cut, ByteLevel)
                       and cut.use_regex and not cut.add_prefix_space)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        whole_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        # The byte alphabet of the letters' UTF-8, as the library writes it.
        self.signs = {ord(c): whole_bytes.pre_tokenize_str(c)[0][0]
                      for c in map(chr, range(0x250)) if c == " " or LETTERS.fullmatch(c)}

    def library(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return array("I", found[0].ids).tobytes()

    def piece(self, text: str) -> bytes:
        if not self.direct or len(text) > KEPT_CHARS or not LETTERS.fullmatch(text):
            return self.library(text)
        found = self.model.tokenize(text.translate(self.signs))
        return array("I", [token.id for token in found]).tobytes()

    def new_pieces(self) -> Known:
        """A store of encoded pieces, for the length of a task."""
        return Known(self.piece)

    def encode_all(self, texts: list[str | None], known: Known) -> Iterator[np.ndarray]:
        """Ids of each text; one that holds the string of a special token is encoded whole."""
        for text in map(valid, texts):
            if any(s in text for s in self.special):
                ids = self.library(text)
            else:
                ids = []
                for pieces in parts(PIECE, text):
                    known.turn()
                    ids.append(b"".join(map(known.__getitem__, pieces)))
                ids = b"".join(ids)
            yield np.frombuffer(ids, dtype="<u4")

    def __call__(self, text: str | None) -> np.ndarray:
        return next(self.encode_all([text], self.new_pieces()))


@lru_cache(maxsize=1)
def _ids(path: str) -> Ids:
    return Ids(path)


def fullest(counts: dict[int, int], room: int) -> Counter:
    """The combination of available lengths with the largest total within ``room``.

    Reachable totals are the bits of one number. Longer lengths come first, and a total is traced
    back through the lengths that first reached it, so long pieces are used up early.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, block = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            block = min(block, left)
            steps.append((length, block, reach))
            reach |= (reach << (length * block)) & mask
            left, block = left - block, 2 * block
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, Counter()
    for length, block, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] += block
            total -= length * block
    return chosen


def minimum_bin_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict, int]]:
    """``(lengths in a sequence, number of such sequences)``, all pieces placed.

    Each pattern takes the longest piece left and the fullest combination beside it, and is used as
    often as the counts allow. Every pattern uses up some length, so there are few.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    patterns = []
    while left:
        longest = max(left)
        rest = {n: c - (n == longest) for n, c in left.items() if c > (n == longest)}
        chosen = fullest(rest, capacity - longest)
        chosen[longest] += 1
        times = min(left[n] // c for n, c in chosen.items())
        patterns.append((dict(sorted(chosen.items(), reverse=True)), times))
        for n, c in chosen.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
    return patterns


def _slots(patterns: list[tuple[dict, int]]) -> dict[str, np.ndarray]:
    """For each length and pattern: the first rank it serves and where those pieces go."""
    used, sequence, rows = Counter(), 0, []
    for pattern, times in patterns:
        offset = 0
        for length, copies in pattern.items():
            rows.append((length, used[length], copies, sequence, offset))
            used[length] += copies * times
            offset += length * copies
        sequence += times
    rows.sort()
    names = ("length", "first", "copies", "sequence", "offset")
    return dict(zip(names, np.array(rows, dtype=np.int64).reshape(-1, 5).T))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 2,
                   id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``capacity`` tokens.

    A document's ids are those of ``path`` followed by ``end_id``, so null and empty texts are
    pieces of one token. Only longer documents are cut: the first piece takes what full pieces
    leave over. Repeated rows and null ids are packed like any other. Extra columns are left out,
    whatever their names. An empty table gives no pieces.
    """
    fields = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType),
                           *T._parse_datatype_string(
                               "piece int, start long, length long, ids_crc32 long, "
                               "_task long, _nth long").fields])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        task, seen = TaskContext.get().partitionId(), Counter()
        known = _ids(path).new_pieces()
        for batch in batches:
            rows = []
            texts = [t if isinstance(t, str) else None for t in batch["_text"]]
            for who, found in zip(batch["_id"], _ids(path).encode_all(texts, known)):
                ids = np.append(found, np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                borders = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(borders, borders[1:])):
                    rows.append((who, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()), task,
                                 seen[b - a]))
                    seen[b - a] += 1
            out = pd.DataFrame(rows, columns=fields.names)
            out[id_column] = pd.Series([r[0] for r in rows], dtype=batch["_id"].dtype)
            yield out

    source = docs.selectExpr(f"`{id_column}` AS _id", f"`{text}` AS _text")
    pieces = spread(source).mapInPandas(cut, fields)
    pieces = materialise(pieces.withColumn("_slot", F.col("_task") * (capacity + 1) + F.col("length")),
                         "pieces")
    per_task = pieces.groupBy("_slot").agg(
        F.first("_task").alias("_task"), F.first("length").alias("length"),
        F.count("*").alias("_pieces"))
    # One row per task and length, at most capacity lengths.
    earlier = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counted = materialise(per_task.select(
        "_slot", "length", "_pieces", F.coalesce(F.sum("_pieces").over(earlier), F.lit(0))
        .alias("_before")), "piece-counts")
    totals = counted.groupBy("length").agg(F.sum("_pieces").alias("n")).collect()
    slots = _slots(minimum_bin_slack({r["length"]: r["n"] for r in totals}, capacity))
    codes = slots["length"] << 44 | slots["first"]

    out_fields = T.StructType([f for f in fields.fields if not f.name.startswith("_")]
                              + T._parse_datatype_string("sequence_id long, offset long").fields)
    names = out_fields.names[:-2]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["_rank"].to_numpy()
            slot = np.searchsorted(codes, length << 44 | rank, side="right") - 1
            bin_, copy = np.divmod(rank - slots["first"][slot], slots["copies"][slot])
            out = batch[names].copy()
            out["sequence_id"] = slots["sequence"][slot] + bin_
            out["offset"] = slots["offset"][slot] + copy * length
            yield out

    ranked = join_lookup(pieces, counted.select("_slot", "_before"), "_slot", salts=1)
    return ranked.select(*names, (F.col("_before") + F.col("_nth")).alias("_rank")) \
        .mapInPandas(place, out_fields)
