"""Exact top-k inner products on a bit-sliced index.

A block of vectors is kept as bitmaps: one per attribute and bit, with a bit for every row. The
score of all rows is the sum of shifted bitmaps, added by carry-save adders on whole words, so it is
again a stack of bitmaps. The best rows are read off from the most significant slice downward; rows
that are still tied at the last slice have equal scores and are told apart by their id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.session import materialise

SCALE = 256.0
ROWS, QUERIES = 8192, 8192  # of a block, at most
LIMIT = (1 << 63) - 1  # of a component and of a returned score
LIMB = 45  # bits; the order of scores is kept in three limbs, as scores may pass 64 bits


class Slices:
    """Bitmaps of a block. ``values`` is rows x attributes, sorted by ascending id."""

    def __init__(self, values: np.ndarray):
        self.values, (self.rows, attributes) = values, values.shape
        self.least = values.min(axis=0) if self.rows else np.zeros(attributes, dtype=np.int64)
        # The distance to the least value takes all 64 bits at most.
        shifted = values.astype(np.uint64) - self.least.astype(np.uint64)
        self.bits = max(1, int(shifted.max(initial=0)).bit_length())
        self.size = max(abs(int(values.min(initial=0))), int(values.max(initial=0)))
        words = -(-self.rows // 64)
        padded = np.zeros((words * 64, attributes), dtype=np.uint64)
        padded[:self.rows] = shifted
        columns = np.ascontiguousarray(padded.T)
        planes = np.stack([np.packbits((columns >> np.uint64(b) & np.uint64(1)).astype(np.uint8), axis=1,
                                       bitorder="little").view("<u8")
                           for b in range(self.bits)], axis=1)
        # A negative factor adds the complement, which differs from its product by a constant.
        self.planes = {1: planes, -1: ~planes}  # attribute x bit x word
        self.valid = np.packbits(np.arange(words * 64) < self.rows, bitorder="little").view("<u8")

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of the scores plus a constant, least significant first."""
        size, sign = np.abs(query), np.where(query < 0, -1, 1)
        levels: list[list[np.ndarray]] = []
        for shift in range(int(size.max(initial=0)).bit_length()):
            for way in (1, -1):
                used = np.flatnonzero((size >> shift & 1).astype(bool) & (sign == way))
                for bit in range(self.bits if len(used) else 0):
                    while len(levels) <= shift + bit:
                        levels.append([])
                    levels[shift + bit].append(self.planes[way][used, bit])
        out, at = [], 0
        while at < len(levels):
            here = np.concatenate(levels[at]) if levels[at] else self.valid[None] & np.uint64(0)
            carries = []
            while len(here) > 1:
                third = len(here) // 3
                if third:
                    a, b, c = here[:third], here[third:2 * third], here[2 * third:3 * third]
                    half = a ^ b
                    carries.append((a & b) | (half & c))
                    here = np.concatenate([half ^ c, here[3 * third:]])
                else:
                    carries.append(here[:1] & here[1:])
                    here = here[:1] ^ here[1:]
            if carries:
                if len(levels) == at + 1:
                    levels.append([])
                levels[at + 1] += carries
            out.append(here[0])
            at += 1
        return out

    def top(self, query: np.ndarray, k: int, allowed: np.ndarray) -> np.ndarray:
        """Rows of the ``k`` best scores among the allowed ones; ties go to the first rows."""
        sure, open_ = np.zeros_like(allowed), allowed
        for plane in reversed(self.sums(query)):
            with_bit = open_ & plane
            count = int(np.bitwise_count(sure | with_bit).sum())
            if count > k:
                open_ = with_bit
            else:
                sure, open_ = sure | with_bit, open_ & ~plane
                if count == k:
                    break
        chosen = _rows(sure)
        if len(chosen) < k:
            chosen = np.concatenate([chosen, _rows(open_)[:k - len(chosen)]])
        return chosen


    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Whole scores; Python numbers where 64 bits might not hold them."""
        most = self.size * int(np.abs(query).max(initial=0)) * max(1, len(query))
        kind = np.int64 if most <= LIMIT else object
        return self.values[rows].astype(kind) @ query.astype(kind)


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _matrix(values: pd.Series, width: int) -> np.ndarray:
    """Rows x attributes; shorter vectors are filled with zeros."""
    out = np.zeros((len(values), width), dtype=np.int64)
    for i, row in enumerate(values):
        out[i, :len(row)] = row
    return out


def quantised(vector: str) -> Column:
    """floor(256 * x) of each component, x as double; what 64 bits cannot hold is held at their limit."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    return F.transform(whole, lambda x: F.greatest(x, F.lit(-LIMIT)))


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows for each query row, exactly.

    Vectors that are null or hold a null or non-finite component take no part, nor do null ids.
    Every row is a candidate, also where rows share an id; no row is one for queries of its own id.
    Query rows that share an id are one query, answered by the best of all their scores. Vectors of
    different length are compared as if filled with zeros. With fewer than ``k`` others all are
    returned; ties go to the smaller id. Scores beyond 64 bits rank by their true size and are
    returned as the limit of a long. Extra columns are left out.

    Rows and queries are cut into blocks by a hash of the row; every pair of blocks returns ``k``
    rows a query, so neither side is collected or broadcast. A task walks several pairs, so their
    number does not set the number of tasks.
    """
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector).alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("q"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & good)
    rows = materialise(rows.select("id", quantised("v").alias("v"), "q",
                                   F.monotonically_increasing_id().alias("n")), "topk-rows")
    size = F.greatest(F.array_max("v"), -F.array_min("v"))
    total, queries, width, most = rows.agg(
        F.count("*"), F.count_if("q"), F.max(F.size("v")), F.max(size)).head()
    if (most or 0) < 1 << 31:  # half the bytes to shuffle
        rows = rows.withColumn("v", F.col("v").cast("array<int>"))
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    row_blocks = -(-total // ROWS) or 1
    # At least two cells a core where there are few, so that none waits for the last.
    query_blocks = max(-(-queries // QUERIES), min(queries, -(-2 * cores // row_blocks)), 1)
    block = lambda n: F.pmod(F.xxhash64("n"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    side = rows.select("id", "v", F.lit(False).alias("ask"), block(row_blocks).alias("r"),
                       each(query_blocks).alias("c"))
    asked = rows.filter("q").select("id", "v", F.lit(True).alias("ask"), each(row_blocks).alias("r"),
                                    block(query_blocks).alias("c"))
    fields = "query_id long, vec_id long, score long, high long, mid long, low long"

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        ask = part["ask"].to_numpy()
        held, asked = part[~ask].sort_values("id", kind="stable"), part[ask]
        ids = held["id"].to_numpy(dtype=np.int64)
        slices = Slices(_matrix(held["v"], width))
        found = []
        for who, query in zip(asked["id"], _matrix(asked["v"], width)):
            allowed = slices.valid
            own = np.arange(np.searchsorted(ids, who), np.searchsorted(ids, who, "right"))
            if len(own):
                bits = np.zeros(len(allowed) * 64, dtype=np.uint8)
                bits[own] = 1
                allowed = allowed & ~np.packbits(bits, bitorder="little").view("<u8")
            top = slices.top(query, k, allowed)
            score = slices.scores(top, query)
            low = (1 << LIMB) - 1
            found.append(np.stack([np.full(len(top), who), ids[top],
                                   np.clip(score, -LIMIT - 1, LIMIT).astype(np.int64),
                                   (score >> 2 * LIMB if score.dtype == object else score >> 63).astype(np.int64),
                                   (score >> LIMB & low).astype(np.int64), (score & low).astype(np.int64)]))
        out = np.concatenate(found, axis=1) if found else np.zeros((6, 0), dtype=np.int64)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score", "high", "mid", "low"), out)))

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []
        for batch in batches:
            cell = batch["r"].to_numpy(dtype=np.int64) * query_blocks + batch["c"].to_numpy()
            for part in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(cell)) + 1):
                piece = batch.iloc[part]
                if rest and len(piece) and (rest[-1][["r", "c"]].iloc[0] != piece[["r", "c"]].iloc[0]).any():
                    yield compare(pd.concat(rest))
                    rest = []
                if len(piece):
                    rest.append(piece)
        if rest:
            yield compare(pd.concat(rest))

    tasks = min(row_blocks * query_blocks, max(4 * cores, int(
        vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    best = side.unionAll(asked).repartition(tasks, "r", "c") \
        .sortWithinPartitions("r", "c").mapInPandas(cells, fields)
    order = Window.partitionBy("query_id").orderBy(F.desc("high"), F.desc("mid"), F.desc("low"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
