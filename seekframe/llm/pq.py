"""Near-duplicate vectors by product quantisation over inverted lists.

Unit vectors go to the list of their nearest coarse centroid; the rest to it is cut into subspaces
and coded. A partner in another list lies beyond the border between the two cells, so a vector
probes the lists whose border is near, which is a plain test on squared distances. How near: two
partners lie on either side of the border between their cells, so their distances to it add up to
no more than their own distance, and one of them is within half the reach. That one probes, so no
partner is missed whatever the vectors look like. In a list, distances come from one table per
probing vector; each stored vector knows the length of what its code leaves out, so the codes miss
no partner. What passes is compared by its exact cosine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.tables import components
from seekframe.operators.skew import join_lookup
from seekframe.session import materialise, spread

SIMILARITY = 0.93
FIT_ROWS = 8000
PARTS, CODES = 16, 64
PART_ROWS = 2048  # stored vectors of one list that are compared in one task
ASK_ROWS = 512


@dataclass(frozen=True)
class Index:
    centroids: np.ndarray  # lists x dimensions
    books: np.ndarray  # subspaces x codes x dimensions of a subspace

    @property
    def width(self) -> int:
        return self.books.shape[0] * self.books.shape[2]

    def distances(self, unit: np.ndarray) -> np.ndarray:
        """Squared distance to each centroid."""
        return np.maximum(0, (unit ** 2).sum(1)[:, None] - 2 * unit @ self.centroids.T
                          + (self.centroids ** 2).sum(1))

    def step(self, similarity: float) -> float:
        """How near a border is probed: half the reach, for one of two partners is that near."""
        return math.sqrt(2 - 2 * similarity) / 2

    def probed(self, unit: np.ndarray, home: np.ndarray, lists: np.ndarray,
               similarity: float) -> np.ndarray:
        """Whether each vector, at home in ``home``, probes the list beside it in ``lists``."""
        own, other = self.centroids[home], self.centroids[lists]
        excess = ((unit - other) ** 2).sum(1) - ((unit - own) ** 2).sum(1)
        return excess <= 2 * self.step(similarity) * np.sqrt(((own - other) ** 2).sum(1)) + 1e-9

    def code(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals and the length of what they leave out."""
        cut = rest.reshape(len(rest), len(self.books), -1)
        codes = np.stack([_nearest(cut[:, m], book) for m, book in enumerate(self.books)], axis=1)
        coded = self.books[np.arange(len(self.books)), codes]
        return codes.astype(np.uint8), np.sqrt(((cut - coded) ** 2).sum(axis=(1, 2)))

    def table(self, rest: np.ndarray) -> np.ndarray:
        """Squared distances of a residual's subspaces to all codes: rows x subspaces x codes."""
        cut = rest.reshape(len(rest), len(self.books), 1, -1)
        return ((cut - self.books[None]) ** 2).sum(axis=3)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(1) - 2 * x @ centres.T).argmin(axis=1)


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = _nearest(x, centres)
        count = np.bincount(own, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def units(values: pd.Series, width: int) -> np.ndarray:
    """Unit vectors in double precision, filled with zeros to ``width``."""
    out = np.zeros((len(values), width))
    for i, row in enumerate(values):
        out[i, :len(row)] = row
    out /= np.abs(out).max(axis=1, keepdims=True)  # no overflow in the squares
    return out / np.sqrt((out ** 2).sum(axis=1, keepdims=True))


def fit(sample: np.ndarray, lists: int) -> Index:
    """Centroids and code books from a sample of unit vectors whose width ``PARTS`` divides."""
    centroids = _kmeans(sample, max(1, min(lists, len(sample))))
    rest = sample - centroids[_nearest(sample, centroids)]
    cut = rest.reshape(len(rest), PARTS, -1)
    books = np.stack([_kmeans(cut[:, m], min(CODES, len(sample))) for m in range(PARTS)])
    return Index(centroids, books)


def _placed(index: Index, similarity: float):
    """Rows for the lists: the home row of each vector and one row for each list it probes."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        apart = np.sqrt(((index.centroids[:, None] - index.centroids) ** 2).sum(2))
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.iloc[at:at + 1024]
                unit = units(part["v"], index.width)
                squared = index.distances(unit)
                home = squared.argmin(axis=1)
                # A coarse test by one matrix product, then the exact one on what it leaves.
                excess = squared - squared.min(axis=1, keepdims=True)
                who, lists = np.nonzero(excess <= 2 * index.step(similarity) * apart[home] + 1e-6)
                near = index.probed(unit[who], home[who], lists, similarity)
                who, lists = who[near], lists[near]
                yield pd.DataFrame({
                    "label": part["label"].to_numpy()[who], "list": lists.astype(np.int32),
                    "own": home[who].astype(np.int32), "cid": part["cid"].to_numpy()[who],
                    "times": part["times"].to_numpy()[who],
                    "v": pd.Series(list(part["v"].to_numpy()[who]), dtype=object)})
    return rows


class _Cell:
    """One list of one label, or a part of it: stored vectors, and those that probe it."""

    def __init__(self, index: Index, rows: pd.DataFrame, similarity: float):
        self.index, self.similarity = index, similarity
        self.list = int(rows["list"].iloc[0])
        self.centre = index.centroids[self.list]
        self.reach = math.sqrt(2 - 2 * similarity)
        self.cid, self.times = rows["cid"].to_numpy(), rows["times"].to_numpy()
        self.unit = units(rows["v"], index.width)
        self.codes, self.left_out = index.code(self.unit - self.centre)

    def pairs(self, rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``rows``, stored vector) of partners. Two vectors that probe each other's lists
        meet twice; the meeting counts that the smaller id probes."""
        cid, unit = rows["cid"].to_numpy(), units(rows["v"], self.index.width)
        table = self.index.table(unit - self.centre)
        squared = np.zeros((len(rows), len(self.cid)))
        for m in range(table.shape[1]):
            squared += table[:, m, self.codes[:, m]]
        near = np.sqrt(squared) <= self.reach + self.left_out + 1e-6
        asks, holds = np.nonzero(near & (cid[:, None] != self.cid))
        exact = np.einsum("ij,ij->i", unit[asks], self.unit[holds]) >= self.similarity
        asks, holds = asks[exact], holds[exact]
        later = np.flatnonzero(cid[asks] > self.cid[holds])
        own = rows["own"].to_numpy()[asks[later]]
        twice = self.index.probed(self.unit[holds[later]], np.full(len(later), self.list), own,
                                  self.similarity)
        keep = np.ones(len(asks), dtype=bool)
        keep[later[twice]] = False
        return asks[keep], holds[keep]


class _Forest:
    """Which vectors of a cell are joined already."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        """Join two trees; false if they were one."""
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _answers(cell: _Cell, forest: _Forest, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Links of ``rows`` into the cell: their number for each vector (``a = b``), and as many single
    links (``links = 0``) as join the vectors."""
    for at in range(0, len(rows), ASK_ROWS):
        part = rows.iloc[at:at + ASK_ROWS]
        asks, holds = cell.pairs(part)
        a, b = part["cid"].to_numpy()[asks], cell.cid[holds]
        both = np.concatenate([a, b])
        times = np.concatenate([cell.times[holds], part["times"].to_numpy()[asks]])
        ids, place = np.unique(both, return_inverse=True)
        count = np.bincount(place, times, len(ids)).astype(np.int64)
        joined = np.array([forest.join(x, y) for x, y in zip(a.tolist(), b.tolist())], dtype=bool)
        yield pd.DataFrame({"a": np.concatenate([ids, a[joined]]),
                            "b": np.concatenate([ids, b[joined]]),
                            "links": np.concatenate([count, np.zeros(joined.sum(), np.int64)])})


def _linked(index: Index, similarity: float):
    """Compare the rows of each (label, list, part); its stored vectors come first."""
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, stored, cell, forest = None, [], None, _Forest()

        def opened() -> Iterator[pd.DataFrame]:
            nonlocal cell
            if cell is None and stored:
                whole = pd.concat(stored)
                cell = _Cell(index, whole, similarity)
                yield from _answers(cell, forest, whole)

        for batch in batches:
            codes = np.column_stack([batch[["label", "list", "part"]].to_numpy(dtype=np.int64),
                                     batch["home"].to_numpy()])
            borders = np.flatnonzero((codes[1:] != codes[:-1]).any(axis=1)) + 1
            for run in np.split(np.arange(len(batch)), borders) if len(batch) else []:
                piece, now = batch.iloc[run], tuple(codes[run[0], :3])
                if now != key:
                    yield from opened()
                    key, stored, cell, forest = now, [], None, _Forest()
                if piece["home"].iloc[0]:
                    stored.append(piece)
                elif stored:
                    yield from opened()
                    yield from _answers(cell, forest, piece)
        yield from opened()
    return links


def near_vectors(vectors: DataFrame, similarity: float = SIMILARITY, id_column: str = "vec_id",
                 vector: str = "embedding", label: str = "label",
                 fit_rows: int = FIT_ROWS) -> DataFrame:
    """``id, n_links, component_id, kept`` for every row.

    Rows link if their labels are equal and their cosine is at least ``similarity``. Null, empty and
    zero vectors, vectors with null or non-finite components and rows without a label link with
    nothing and are their own component. Equal vectors of a label are one class that is compared
    once; every other row of the class counts as a link. Vectors of different length are compared
    as if filled with zeros. A null id never names a component that has an id, and is kept only
    where there is none. Extra columns are left out.

    The index is fitted on at most ``fit_rows`` vectors, picked by a hash; all are indexed. There
    are about twice as many lists as the square root of the rows of a label. A list with more than
    ``PART_ROWS`` vectors is dealt over several tasks.
    """
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector).alias("v"),
                          F.col(label).alias("label"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) \
        & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & F.col("v").isNotNull() & good, F.lit(False))
    classes = rows.filter(usable).groupBy("label", "v").agg(
        F.min("id").alias("first"), F.count("*").alias("times"))
    classes = materialise(classes.withColumn("cid", F.monotonically_increasing_id()), "pq-classes")
    count, labels, longest = classes.agg(F.count("*"), F.count_distinct("label"),
                                         F.max(F.size("v"))).head()
    if count:
        width = -(-longest // PARTS) * PARTS
        picked = classes.orderBy(F.xxhash64("v"), "cid").limit(fit_rows).select("v").toPandas()
        index = fit(units(picked["v"], width), 2 * math.isqrt(count // labels) + 1)
        found = materialise(_search(classes, index, similarity), "pq-links")
    else:
        found = classes.sparkSession.createDataFrame([], "a long, b long, links long")
    degree = found.groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    roots = materialise(components(found.filter("a <> b"), "pq-components"), "pq-roots")
    places = classes.join(roots, F.col("cid") == F.col("node"), "left") \
        .withColumn("root", F.coalesce("root", "cid")) \
        .join(degree, "cid", "left")
    names = places.groupBy("root").agg(F.min("first").alias("name"))
    places = places.join(names, "root").select(
        F.col("label").alias("_label"), F.col("v").alias("_v"), "name",
        (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    key = F.when(usable, F.struct("label", "v"))
    out = rows.withColumn("_key", key).join(
        places.withColumn("_key", F.struct(F.col("_label").alias("label"), F.col("_v").alias("v"))),
        "_key", "left")
    component = F.when(F.col("_label").isNotNull(), F.col("name")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_column),
                      F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def _search(classes: DataFrame, index: Index, similarity: float) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in classes.schema.fields}
    fields = f"label {kinds['label']}, list int, own int, cid long, times long, v {kinds['v']}"
    rows = spread(classes.select("label", "v", "cid", "times")) \
        .mapInPandas(_placed(index, similarity), fields)
    rows = materialise(rows, "pq-lists").withColumns({
        "_list": F.concat_ws(":", "label", "list"), "home": F.col("list") == F.col("own")})
    large = rows.filter("home").groupBy("_list").agg(
        F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts")).filter("parts > 1")
    rows = join_lookup(rows, materialise(large, "pq-large"), "_list", "left", salts=1) \
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")
    # A stored vector is held in its part and probes all; others probe all parts.
    stored = rows.filter("home").withColumn("part", own)
    probing = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .filter(~F.col("home") | (F.col("part") != own)).withColumn("home", F.lit(False))
    names = ["label", "list", "part", "home", "own", "cid", "times", "v"]
    dealt = stored.select(names).unionAll(probing.select(names)) \
        .repartition("label", "list", "part") \
        .sortWithinPartitions("label", "list", "part", F.desc("home"))
    return dealt.mapInPandas(_linked(index, similarity), "a long, b long, links long")
