"""Small helpers the operators share: even partitions, labelled samples, graph components."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.session import materialise, spread

LEARN_ROWS = 4000
LEARN_CHARS = 40_000


def held_out(id_column: str | Column) -> Column:
    """True where crc32 of the id as text leaves 2 when divided by 4. A null id is not held out."""
    text = (F.col(id_column) if isinstance(id_column, str) else id_column).cast("string")
    return F.coalesce(F.pmod(F.crc32(text.cast("binary")), F.lit(4)) == 2, F.lit(False))


class Example(NamedTuple):
    text: str
    label: int
    weight: float


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str,
                    rows: int = LEARN_ROWS, chars: int = LEARN_CHARS) -> list[Example]:
    """At most ``rows`` labelled texts that are not held out, for fitting on the driver.

    Both classes get up to half of the rows; which ones is fixed by a hash of the id, so a rerun
    learns from the same texts. Weights restore the classes' shares among all usable labels. Texts
    over ``chars`` characters are not learned from, which bounds the driver's memory by
    ``rows * chars``. Null ids, labels and texts are left out; repeated rows are taken once.
    """
    usable = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label")) \
        .filter(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out("_id"))
    counts = {r["_label"]: r["count"] for r in usable.groupBy("_label").count().collect()}
    order = F.xxhash64("_id")
    # Twice as many ids as wanted, because some labelled documents are long or absent.
    parts = [usable.filter(F.col("_label") == value).orderBy(order, "_id").limit(rows)
             for value in (0, 1)]
    # The broadcast side holds at most 2 * rows pairs of numbers.
    picked = F.broadcast(parts[0].unionAll(parts[1]).distinct())
    found = documents.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")) \
        .filter(F.col("_text").isNotNull() & (F.length("_text") <= chars)) \
        .join(picked, "_id").distinct()
    taken = Window.partitionBy("_label").orderBy(order, "_id", "_text")
    found = found.withColumn("_n", F.row_number().over(taken)).filter(F.col("_n") <= rows // 2)
    got = sorted((r["_label"], r["_n"], r["_text"]) for r in found.collect())
    total, sizes = sum(counts.values()), [sum(g[0] == v for g in got) for v in (0, 1)]
    weights = [counts.get(v, 0) / total / (n / len(got)) if n else 0.0 for v, n in enumerate(sizes)]
    return [Example(text, value, weights[value]) for value, _, text in got]


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, root)``: the smallest node reachable from each node of ``edges(a, b)``.

    Alternating star contraction: every round hangs each node's neighbours on its smallest
    neighbour, first those below the node, then those above it. The first half needs each edge only
    one way round and merges many. Rounds grow with the logarithm of the longest path. Each round is written to the shared folder, so nothing is kept on executors.
    Nodes without an edge are not listed.
    """
    def above(e: DataFrame) -> DataFrame:
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return both.join(least, "a").filter(F.col("b") > F.col("a")) \
            .select(F.col("b").alias("a"), F.col("m").alias("b"))

    def below(e: DataFrame) -> DataFrame:
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        moved = e.join(least, "a").filter(F.col("b") != F.col("m")) \
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionAll(least.select("a", F.col("m").alias("b")))

    def ordered(e: DataFrame) -> DataFrame:
        return e.filter(F.col("a") != F.col("b")).select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def mark(e: DataFrame) -> tuple[int, int]:
        low = F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 40) - 1))
        count, total = e.agg(F.count("*"), F.sum(low.cast("decimal(20,0)"))).head()
        return count, int(total or 0)

    current = materialise(ordered(edges.select("a", "b")), label)
    state = mark(current)
    while state[0]:
        current = materialise(ordered(above(ordered(below(current)))), label)
        state, before = mark(current), state
        if state == before:
            break
    found = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.unionAll(found.select(F.col("root").alias("node"), "root").distinct())


__all__ = ["LEARN_CHARS", "LEARN_ROWS", "components", "held_out", "labelled_sample",
           "materialise", "spread"]
