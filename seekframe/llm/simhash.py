"""Near-duplicate documents by SimHash fingerprints and multi-index hashing.

A fingerprint bit is set when more than half of the shingle hashes have it. Each fingerprint is cut
into segments. Two fingerprints of at most ``radius`` differing bits have a segment in which they
differ in at most ``radius // segments`` bits, so looking up a ball of that size in each segment's
table finds them all. Balls are enumerated on one side only: of two segment values that differ in
one bit, the one with the bit set clears it and meets the other at home.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.llm.tables import components
from seekframe.operators.skew import join_lookup
from seekframe.session import materialise, spread

FP, ROW = "_simhash_fp", "_simhash_row"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
HASH_BLOCK = 65_536
CELL = 4096  # homes of one segment value that are compared in one task
OPEN_ROWS = 8 * CELL  # rows of one unfinished key that are held
PAIRS = 1 << 21  # comparisons held in memory at once


@dataclass(frozen=True)
class Scheme:
    """``words`` per shingle, ``lanes`` 64-bit hashes per shingle, ``segments`` tables.

    Fingerprints link at ``radius`` or fewer differing bits; balls of radius 1 find every link if
    ``radius < 2 * segments``.
    """
    words: int = 3
    lanes: int = 1
    segments: int = 2
    radius: int = 3

    @property
    def segment_bits(self) -> int:
        return 64 * self.lanes // self.segments


EXACT = Scheme()


def _lane(hashes: np.ndarray, lane: int) -> np.ndarray:
    """The hash itself for lane 0, a remixed hash for others."""
    if not lane:
        return hashes
    with np.errstate(over="ignore"):
        mixed = hashes + np.uint64((0x9E3779B97F4A7C15 * lane) & (2 ** 64 - 1))
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(31))


def fingerprint(text: str | None, scheme: Scheme = EXACT) -> tuple[int, ...]:
    """Unsigned 64-bit words of the fingerprint; all zero without words."""
    words = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not words:
        return (0,) * scheme.lanes
    size, digest = scheme.words, xxhash.xxh64_intdigest
    total = max(1, len(words) - size + 1)
    votes = np.zeros((scheme.lanes, 64), dtype=np.int64)
    for start in range(0, total, HASH_BLOCK):
        stop = min(total, start + HASH_BLOCK)
        hashes = np.array([digest(b" ".join(words[i:i + size]), 42) for i in range(start, stop)],
                          dtype=np.uint64)
        for lane in range(scheme.lanes):
            octets = _lane(hashes, lane).astype(">u8").view(np.uint8).reshape(-1, 8)
            votes[lane] += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * votes > total).astype(np.uint8)
    return tuple(int.from_bytes(np.packbits(row).tobytes(), "big") for row in bits)


def with_fingerprint(docs: DataFrame, text: str, scheme: Scheme, column: str) -> DataFrame:
    """Add ``column``: the fingerprint in hexadecimal, 16 digits a lane."""
    def digits(texts: pd.Series) -> pd.Series:
        return pd.Series(["".join(f"{w:016x}" for w in fingerprint(t, scheme)) for t in texts],
                         dtype=object)
    return docs.withColumn(column, F.pandas_udf(digits, T.StringType())(F.col(text)))


def _lanes_of(hexes: pd.Series, lanes: int) -> np.ndarray:
    joined = "".join(hexes)
    return np.frombuffer(bytes.fromhex(joined), dtype=">u8").astype(np.uint64).reshape(-1, lanes)


def _table_rows(scheme: Scheme, ball: bool = True):
    """Rows of the segment tables: a home row per segment and its ball with one bit cleared."""
    width = scheme.segment_bits
    per_lane = 64 // width

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 2048):
                lanes = _lanes_of(batch[FP].iloc[at:at + 2048], scheme.lanes)
                for segment in range(scheme.segments):
                    lane, place = divmod(segment, per_lane)
                    value = (lanes[:, lane] >> np.uint64(place * width)) \
                        & np.uint64((1 << width) - 1)
                    keys, who = [value], [np.arange(len(value))]
                    for bit in range(width if ball else 0):
                        has = np.flatnonzero(value >> np.uint64(bit) & np.uint64(1))
                        keys.append(value[has] ^ np.uint64(1 << bit))
                        who.append(has)
                    homes = len(value)
                    key, index = np.concatenate(keys), np.concatenate(who)
                    out = {"key": key.astype(np.int64), "segment": np.int8(segment),
                           "home": np.arange(len(key)) < homes}
                    for i in range(scheme.lanes):
                        out[f"f{i}"] = lanes[index, i].view(np.int64)
                    yield pd.DataFrame(out)
    return rows


def _forest(homes: np.ndarray, rest: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join what is within ``radius``, without links inside what is joined already.

    Indexes count ``homes`` first, then ``rest``; two of ``rest`` are not compared. A pivot is
    compared with all that is not yet joined to it, so a group of near copies costs little more
    than one pass.
    """
    both = np.concatenate([homes, rest])
    group = np.arange(len(both))
    links = []
    for pivot in range(len(homes)):
        other = np.flatnonzero(group != group[pivot])
        other = other[(other > pivot)]
        if not len(other):
            continue
        distance = np.bitwise_count(both[other] ^ both[pivot]).sum(axis=1)
        for hit in other[distance <= radius]:
            if group[hit] != group[pivot]:
                links.append((pivot, int(hit)))
                group[group == group[hit]] = group[pivot]
    return links


def _spanning(pair: np.ndarray, lanes: np.ndarray) -> np.ndarray:
    """Of links between rows, as many as join the same fingerprints: at most one for each."""
    if not len(pair):
        return pair
    _, code = np.unique(lanes[pair.ravel()], axis=0, return_inverse=True)
    up = list(range(int(code.max()) + 1))
    keep = []
    for i, (a, b) in enumerate(code.reshape(-1, 2).tolist()):
        while up[a] != a:
            up[a] = a = up[up[a]]
        while up[b] != b:
            up[b] = b = up[up[b]]
        if a != b:
            up[max(a, b)] = min(a, b)
            keep.append(i)
    return pair[keep]


def _links(scheme: Scheme):
    """Compare the rows that meet under one key; rows come sorted by (segment, key, cell, home)."""
    names = [f"f{i}" for i in range(scheme.lanes)]
    by = ["segment", "key", "cell"]

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        lanes = rows[names].to_numpy(dtype=np.int64).view(np.uint64)
        codes = rows[by].to_numpy(dtype=np.int64)
        starts = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]).any(axis=1)])
        sizes = np.diff(np.r_[starts, len(rows)])
        homes = np.add.reduceat(rows["home"].to_numpy().astype(np.int64), starts)
        # Of a cell (i, j) of a split key, only rows of different parts are compared.
        work = homes * sizes
        found = []
        small = (work <= 65_536) & (sizes > 1) & (homes > 0)
        first, size, home = starts[small], sizes[small], homes[small]
        load = np.cumsum(home * size)
        at = 0
        while at < len(first):
            stop = max(at + 1, int(np.searchsorted(load, (load[at - 1] if at else 0) + PAIRS)))
            count = (home * size)[at:stop]
            cell = np.repeat(np.arange(at, stop), count)
            within = np.arange(len(cell)) - np.repeat(np.cumsum(count) - count, count)
            left = first[cell] + within // size[cell]
            right = first[cell] + within % size[cell]
            keep = left < right
            left, right = left[keep], right[keep]
            near = np.bitwise_count(lanes[left] ^ lanes[right]).sum(axis=1) <= scheme.radius
            found.append(np.stack([left[near], right[near]], axis=1))
            at = stop
        for index in np.flatnonzero((work > 65_536) & (sizes > 1)):
            begin, size, home = starts[index], sizes[index], homes[index]
            block = lanes[begin:begin + size]
            pairs = _forest(block[:home], block[home:], scheme.radius)
            if pairs:
                found.append(np.array(pairs) + begin)
        pair = _spanning(np.concatenate(found), lanes) if found else np.zeros((0, 2), dtype=np.int64)
        out = {}
        for side, column in (("a", 0), ("b", 1)):
            hexes = lanes[pair[:, column]].astype(">u8").tobytes().hex()
            step = 16 * scheme.lanes
            out[side] = [hexes[i:i + step] for i in range(0, len(hexes), step)]
        return pd.DataFrame(out, dtype=object)

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = batch[by].iloc[-1] if len(batch) else None
            if last is None:
                continue
            # The last key may go on in the next batch. Its homes, which come first, are kept.
            open_rows = (batch[by] == last).all(axis=1).to_numpy()
            done = batch[~open_rows]
            rest = batch[open_rows].reset_index(drop=True)
            if len(done):
                yield compare(done.reset_index(drop=True))
            if len(rest) > OPEN_ROWS:
                yield compare(rest)
                rest = rest[rest["home"]].reset_index(drop=True)
        if rest is not None and len(rest):
            yield compare(rest)
    return links


def linked_fingerprints(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """``(a, b)``: enough links between the distinct fingerprints to join all that reach
    each other.

    A segment value with more than ``CELL`` homes is dealt over cells of two parts each, so no task
    holds a whole group.
    """
    fields = "key long, segment byte, home boolean, " + ", ".join(
        f"f{i} long" for i in range(scheme.lanes))
    rows = spread(nodes).mapInPandas(_table_rows(scheme), fields)
    hot = nodes.mapInPandas(_table_rows(scheme, ball=False), fields) \
        .groupBy("segment", "key").agg(F.count("*").alias("homes")).filter(F.col("homes") > CELL) \
        .select(F.concat_ws(":", "segment", "key").alias("_hot"),
                F.ceil(F.col("homes") / CELL).cast("int").alias("_parts"))
    rows = join_lookup(rows.withColumn("_hot", F.concat_ws(":", "segment", "key")),
                       materialise(hot, "simhash-hot"), "_hot", "left", salts=1)
    part = F.pmod(F.xxhash64(*[f"f{i}" for i in range(scheme.lanes)]), F.col("_parts")).cast("int")
    # Part p meets part q in cell (min, max); cells are numbered min * parts + max.
    cells = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1),
                        lambda q: F.least(part, q) * F.col("_parts") + F.greatest(part, q))
    placed = rows.withColumn("cell", F.explode(
        F.when(F.col("_parts").isNull(), F.array(F.lit(0))).otherwise(cells)))
    placed = placed.select("segment", "key", "cell", F.col("home"),
                           *[f"f{i}" for i in range(scheme.lanes)])
    dealt = placed.repartition("segment", "key", "cell") \
        .sortWithinPartitions("segment", "key", "cell", F.desc("home"))
    return dealt.mapInPandas(_links(scheme), "a string, b string")


def near_duplicates(docs: DataFrame, scheme: Scheme = EXACT, id_column: str = "doc_id",
                    text: str = "text", keep_columns: bool = False) -> DataFrame:
    """Fingerprint and component of every document.

    Returns the id, ``fingerprint``, ``component_id`` (smallest id reachable, itself included) and
    ``keeper`` (true for one row of each component, the one with the smallest id). With
    ``keep_columns`` it returns the kept rows with their own columns, fingerprint and row number.

    Null and empty texts have fingerprint zero and link like any other. A null id is larger than
    any other and never names a component that has an id. Repeated rows are copies: same
    fingerprint, one keeper. Texts of any length are hashed whole, in blocks. Extra columns are
    ignored, whatever their names. An empty table gives no rows.
    """
    own = docs.columns if keep_columns else [id_column]
    source = docs if keep_columns else docs.select(F.col(id_column), F.col(text).alias("_text"))
    held = with_fingerprint(spread(source), text if keep_columns else "_text", scheme, FP) \
        .withColumn(ROW, F.monotonically_increasing_id()).select(*own, FP, ROW)
    held = materialise(held, "fingerprints")
    # A null id sorts after every other; ties go to the row written first.
    rank = F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"),
                    F.col(ROW).alias("row"))
    nodes = materialise(held.groupBy(FP).agg(F.min(rank).alias("_first")), "fingerprint-nodes")
    roots = components(linked_fingerprints(nodes.select(FP), scheme), "simhash-components")
    roots = materialise(roots, "simhash-roots")
    rooted = nodes.join(roots, F.col(FP) == F.col("node"), "left") \
        .select(FP, "_first", F.coalesce("root", FP).alias("_root"))
    best = rooted.groupBy("_root").agg(F.min("_first").alias("_best"))
    places = rooted.join(best, "_root").select(FP, "_best")
    if keep_columns:
        keepers = best.select(F.col("_best.row").alias(ROW))
        drops = held.select(ROW).join(keepers, ROW, "left_anti")
        return join_lookup(held, materialise(drops, "simhash-drops"), ROW, "left_anti", salts=1)
    return held.join(places, FP).select(
        F.col(id_column), F.col(FP).alias("fingerprint"),
        F.col("_best.id").alias("component_id"), (F.col(ROW) == F.col("_best.row")).alias("keeper"))


def drop_near_copies(docs: DataFrame, scheme: Scheme = EXACT, id_column: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; same columns. Other
    cases as in :func:`near_duplicates`: documents without words are one group."""
    return near_duplicates(docs, scheme, id_column, text, keep_columns=True).select(docs.columns)
