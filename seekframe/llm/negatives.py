"""Hard negatives for contrastive training, scored on Kronecker-packed vectors.

A block of candidates is kept as one wide integer per component: every candidate has a field of its
own, wide enough for a whole score, and holds the component there plus a bias, so no field is
negative. For an anchor each wide integer is multiplied once, by the anchor's biased component, and
the products are added. No field runs over into the next, so the fields of the sum are the biased
scores of all candidates; sums of the components take the bias off again. Integers have any width,
so scores are exact whatever the components are.

Positives come first: the nearest rows of the anchor's label, over cells of that label. With their
scores known, a second pass over all rows takes the nearest rows of other labels in each window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.operators.skew import hot_hashes
from seekframe.session import materialise

SCALE = 256.0
ROWS = 8192  # candidates of a cell's row part, and of one packed block
ANCHORS = 4096  # anchors of a cell
_LONG = 2 ** 63 - 1


class Packed:
    """Candidates as wide integers, one per component. ``values`` is rows x components; ``reach``
    bounds the size of any component of candidates and anchors."""

    def __init__(self, values: np.ndarray, reach: int):
        self.rows, self.components = values.shape
        self.bias = reach
        self.sums = values.sum(axis=1, dtype=object) if reach > 2 ** 40 else values.sum(axis=1)
        # The largest sum of a field; whole bytes make packing a plain copy.
        most = self.components * (2 * reach) ** 2
        self.width = next(w for w in (4, 8, 16, 32) if most < 1 << 8 * w)
        self.packed = []
        for column in values.T:
            if self.width == 32 or reach >= 2 ** 62:
                raw = b"".join((int(v) + reach).to_bytes(self.width, "little") for v in column)
            else:
                fields = np.zeros((self.rows, self.width), dtype=np.uint8)
                low = (column + reach).astype("<u8").view(np.uint8).reshape(-1, 8)
                fields[:, :min(8, self.width)] = low[:, :min(8, self.width)]
                raw = fields.tobytes()
            self.packed.append(int.from_bytes(raw, "little"))

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """Inner products of all candidates with the anchor. Beyond a long they are held at its
        limits."""
        total = 0
        for wide, component in zip(self.packed, anchor.tolist()):
            total += wide * (component + self.bias)
        raw = total.to_bytes(self.rows * self.width, "little")
        # sum (b + B)(a + B) = sum ab + B sum a + B sum b + n B B
        fixed = self.bias * (int(anchor.sum(dtype=object)) + self.components * self.bias)
        if self.width <= 8:
            fields = np.frombuffer(raw, dtype=f"<u{self.width}").astype(np.int64)
            return fields - (self.bias * self.sums + fixed)
        fields = [int.from_bytes(raw[i:i + self.width], "little")
                  for i in range(0, len(raw), self.width)]
        exact = [f - self.bias * int(s) - fixed for f, s in zip(fields, self.sums)]
        return np.array([max(-_LONG - 1, min(_LONG, v)) for v in exact], dtype=np.int64)


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest allowed scores, in no order; ties go to the first places."""
    at = np.flatnonzero(allowed)
    if len(at) <= k:
        return at
    found = scores[at]
    last = np.partition(found, len(at) - k)[len(at) - k]
    sure = at[found > last]
    return np.concatenate([sure, at[found == last][:k - len(sure)]])


def _matrix(values: pd.Series, width: int) -> np.ndarray:
    """Rows x components; shorter vectors are filled with zeros."""
    out = np.zeros((len(values), width), dtype=np.int64)
    for i, row in enumerate(values):
        out[i, :len(row)] = row
    return out


def quantised(vector: str) -> Column:
    """floor(256 * x) of each component, x as double. What a long cannot hold is held at its
    limits; a score of such a component is beyond a long as well."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))


def usable(vectors: DataFrame, id_column: str, vector: str, label: str,
           noise: tuple[int, int]) -> DataFrame:
    """``id, label, v`` of the rows that take part; every ``noise[0]``-th id has its label moved on
    by one of ``noise[1]``."""
    every, labels = noise
    rows = vectors.select(F.col(id_column).cast("long").alias("id"),
                          F.col(label).cast("long").alias("label"), F.col(vector).alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull()
                       & F.col("v").isNotNull() & good)
    moved = F.when(F.col("id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return rows.select("id", moved.alias("label"), quantised("v").alias("v"))


def _parts(rows: DataFrame, group: str, size: int) -> DataFrame:
    """``(_place, _n)`` for groups over ``size`` rows: in how many parts they are dealt. Never more
    than 100,000 groups, whatever their number, as only large shares count."""
    hot = hot_hashes(rows, group, min_rows=size)
    return hot.select("_place", F.ceil(F.col("_rows") / size).cast("int").alias("_n"))


def _cells(rows: DataFrame, anchors: DataFrame, group: str) -> DataFrame:
    """Both sides dealt to cells ``(group, r, c)``, anchors first in each. A group has as many row
    parts as hold ``ROWS`` rows and as many anchor parts as hold ``ANCHORS``; row parts are copied
    to every anchor part of their group and the other way round, so no cell is large."""
    by_rows = _parts(rows, group, ROWS).withColumnRenamed("_n", "_rn")
    by_anchors = _parts(anchors, group, ANCHORS).withColumnRenamed("_n", "_an")
    one = F.lit(1)

    def dealt(side: DataFrame, own: str) -> DataFrame:
        placed = side.withColumn("_place", F.xxhash64(group)) \
            .join(F.broadcast(by_rows), "_place", "left") \
            .join(F.broadcast(by_anchors), "_place", "left")
        counts = {"r": F.coalesce("_rn", one), "c": F.coalesce("_an", one)}
        mine = F.array(F.pmod(F.xxhash64("id", "row"), counts[own]).cast("int"))
        places = {name: mine if name == own else F.sequence(F.lit(0), n - 1)
                  for name, n in counts.items()}
        return placed.withColumn("r", F.explode(places["r"])) \
            .withColumn("c", F.explode(places["c"])).drop("_place", "_rn", "_an")

    both = dealt(rows, "r").withColumn("ask", F.lit(False)).unionByName(
        dealt(anchors, "c").withColumn("ask", F.lit(True)), allowMissingColumns=True)
    # A fixed number of tasks; each walks through as many cells as it gets.
    session = rows.sparkSession
    tasks = max(session.sparkContext.defaultParallelism,
                int(session.conf.get("spark.sql.shuffle.partitions")))
    return both.repartition(tasks, group, "r", "c") \
        .sortWithinPartitions(group, "r", "c", F.desc("ask"))


def _walk(group: str, width: int, reach: int, found: Callable) -> Callable:
    """Go through sorted cells: keep a cell's anchors, pack its rows batch by batch.

    ``found(anchors, values, block, packed)`` yields frames for the rows of one block.
    """
    cell = [group, "r", "c"]

    def blocks(cells: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, anchors, values = None, [], None
        for batch in cells:
            codes = batch[cell].to_numpy(dtype=np.int64)
            cuts = np.flatnonzero((codes[1:] != codes[:-1]).any(axis=1)) + 1
            for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
                if start == stop:
                    continue
                here = tuple(codes[start])
                if here != now:
                    now, anchors, values = here, [], None
                part = batch.iloc[start:stop]
                asks = part["ask"].to_numpy(dtype=bool)
                if asks.any():
                    anchors.append(part[asks])
                rows = part[~asks]
                if not len(rows) or not anchors:
                    continue
                if values is None:
                    asked = pd.concat(anchors, ignore_index=True)
                    values = _matrix(asked["v"], width)
                rows = rows.sort_values("id")
                for at in range(0, len(rows), ROWS):
                    block = rows.iloc[at:at + ROWS]
                    yield from found(asked, values, block, Packed(_matrix(block["v"], width), reach))
    return blocks


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90, noise: tuple[int, int] = (7, 10),
                   id_column: str = "vec_id", vector: str = "embedding",
                   label: str = "label") -> DataFrame:
    """Nearest rows of other labels for each anchor and positive, exactly.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. An
    anchor's positives are the ``positives`` best other rows of its label. Negatives of a positive
    are the ``negatives`` best rows of other labels whose score, in hundredths of the positive's,
    lies between ``low`` and ``high``. Scores are inner products of the quantised vectors; ties go
    to the smaller id. ``is_anchor`` is a condition on the column ``id``.

    Rows with a null id or label, a null vector, or a null or non-finite component take no part.
    All rows with the anchor's id count as its own. Repeated rows are rows of their own, as anchors,
    positives and negatives alike. Anchors without a positive, and positives without a negative in
    their window, give no row; nor does an empty table. Vectors of different length are compared as
    if filled with zeros. Scores beyond a long are held at its limits. Extra columns are left out.

    Both sides are dealt to cells of bounded size; a label with most of the rows is only more cells.
    """
    rows = usable(vectors, id_column, vector, label, noise) \
        .withColumn("row", F.monotonically_increasing_id())
    rows = materialise(rows, "negatives-rows")
    size = lambda x: F.greatest(F.abs(F.greatest(x, F.lit(1 - 2 ** 63))), F.lit(1))
    width, reach = rows.agg(
        F.max(F.size("v")), F.max(F.array_max(F.transform("v", size)))).head()
    width, reach = width or 1, (reach or 1) + 1
    anchors = rows.filter(is_anchor)
    most, least = positives, negatives

    def near(asked, values, block, packed):
        ids, who = block["id"].to_numpy(), block["row"].to_numpy()
        label_, out = block["label"].to_numpy(), []
        for i, (own, label) in enumerate(zip(asked["id"], asked["label"])):
            allowed = (label_ == label) & (ids != own)
            if allowed.any():
                scores = packed.scores(values[i])
                at = best(scores, allowed, most)
                out.append(pd.DataFrame({"anchor": asked["row"].iloc[i], "positive_id": ids[at],
                                         "positive": who[at], "positive_score": scores[at]}))
        if out:
            yield pd.concat(out, ignore_index=True)

    found = _cells(rows, anchors, "label").mapInPandas(
        _walk("label", width, reach, near),
        "anchor long, positive_id long, positive long, positive_score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id", "positive")
    chosen = found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most)
    # At most ``positives`` of them to an anchor.
    chosen = chosen.groupBy(F.col("anchor").alias("row")).agg(F.sort_array(F.collect_list(
        F.struct("nth", "positive_id", "positive_score"))).alias("positives"))
    asking = materialise(anchors.join(chosen, "row"), "negatives-positives")

    def hard(asked, values, block, packed):
        ids, label_, out = block["id"].to_numpy(), block["label"].to_numpy(), []
        for i, (own, label, given) in enumerate(zip(asked["id"], asked["label"], asked["positives"])):
            other = (label_ != label) & (ids != own)
            if not other.any():
                continue
            scores = packed.scores(values[i])
            for one in given:
                floor, roof = _window(int(one["positive_score"]), low, high)
                at = best(scores, other & (scores >= floor) & (scores <= roof), least)
                if len(at):
                    out.append(pd.DataFrame({
                        "anchor": asked["row"].iloc[i], "anchor_id": own, "nth": one["nth"],
                        "positive_id": one["positive_id"], "positive_score": one["positive_score"],
                        "negative_id": ids[at], "negative_score": scores[at]}))
        if out:
            yield pd.concat(out, ignore_index=True)

    # Every row meets every anchor: one group of all rows.
    all_rows = lambda side: side.withColumn("all", F.lit(0))
    pairs = _cells(all_rows(rows), all_rows(asking), "all").mapInPandas(
        _walk("all", width, reach, hard),
        "anchor long, anchor_id long, nth int, positive_id long, positive_score long, "
        "negative_id long, negative_score long")
    order = Window.partitionBy("anchor", "nth").orderBy(F.desc("negative_score"), "negative_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= least) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                "negative_score")


def _window(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest whole score with ``low * score <= 100 * it <= high * score``, within a
    long; an empty window for a negative score."""
    floor, roof = -(-low * score // 100), high * score // 100
    return max(-_LONG - 1, floor), min(_LONG, roof)
