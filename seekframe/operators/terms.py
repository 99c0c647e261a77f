"""Terms of a vocabulary inside texts, by a tree of their words that is kept as rows.

A node of the tree is a run of words that begins some term. Places in texts walk down from the root
level by level and stop where no term goes on, so one very long term costs nothing in texts that do
not follow it, and neither rows nor plan grow with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.functions.tokens import words
from seekframe.operators.skew import BROADCAST_ROWS, fits_broadcast, join_lookup
from seekframe.session import materialise

ROOT = "root"


def term_tree(vocabulary: DataFrame, term_col: str = "_key") -> DataFrame:
    """``level, step, node, term, goes_on``: the tree of the vocabulary's words.

    ``step`` is the node above joined with the word that leads here, ``node`` a digest of the whole
    run. ``term`` is the run joined by blanks where it is a term, else null.
    """
    terms = vocabulary.select(words(F.col(term_col)).alias("w")).filter(F.size("w") > 0).distinct()

    # Every node's digest comes from the one above, so a term of n words costs n digests.
    start = F.array(F.struct(F.lit(ROOT).alias("node"), F.lit("").alias("step")))
    step = F.aggregate("w", start, lambda path, word: F.concat(path, F.array(F.struct(
        F.sha2(F.concat_ws(" ", F.element_at(path, -1)["node"], word), 256).alias("node"),
        F.concat_ws(" ", F.element_at(path, -1)["node"], word).alias("step")))))
    nodes = terms.select("w", F.posexplode(step).alias("level", "at")).filter("level > 0")
    ends = F.col("level") == F.size("w")
    return nodes.groupBy("level", F.col("at.step").alias("step"), F.col("at.node").alias("node")).agg(
        F.max(F.when(ends, F.array_join("w", " "))).alias("term"), F.max(~ends).alias("goes_on"))


def term_extract(df: DataFrame, id_col: str, column: str, vocabulary: DataFrame,
                 term_col: str = "_key", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Vocabulary terms that occur in each text, with their counts, as their words joined by blanks.

    Terms are cut into words like the texts, so case and signs do not matter; terms without words
    are none. Rows that share an id count as one text's. The first level meets every place of a text
    whose word begins a term; deeper levels meet only the places that are still on a path, and the
    last is the deepest that any text follows.
    """
    tree = materialise(term_tree(vocabulary, term_col), "term-tree")
    place = F.monotonically_increasing_id().alias("_row")
    texts = df.select(id_col, place, words(F.col(column)).alias("w"))
    level = lambda n: tree.filter(F.col("level") == n).select("step", "node", "term", "goes_on")
    first = texts.select(id_col, "_row", F.posexplode("w").alias("at", "word"))
    longer = not tree.filter("level > 1").isEmpty()
    if longer:  # the places are needed again, and row numbers have to stay the same
        first = materialise(first, "term-places")
    here = join_lookup(first.select(id_col, "_row", "at", F.concat_ws(" ", F.lit(ROOT), "word").alias("step")),
                       level(1), "step", broadcast_rows=broadcast_rows).drop("step")
    parts, depth = [], 1
    if longer:
        here = materialise(here, "term-level")
        # Only words that continue some term can be stepped on.
        inner = vocabulary.select(F.explode(words(F.col(term_col))).alias("word")).distinct()
        stepped = materialise(join_lookup(first, inner, "word", "left_semi", broadcast_rows=broadcast_rows)
                              .select("_row", "at", "word"), "term-steps")
    while True:
        parts.append(here.filter(F.col("term").isNotNull()).select(id_col, "term"))
        going = here.filter("goes_on")
        if not longer or going.isEmpty():
            break
        depth += 1
        going = going.select(id_col, "_row", (F.col("at") + 1).alias("at"), "node")
        if fits_broadcast(going, broadcast_rows):
            going = F.broadcast(going)
        moved = stepped.join(going, ["_row", "at"]) \
            .select(id_col, "_row", "at", F.concat_ws(" ", "node", "word").alias("step"))
        here = materialise(join_lookup(moved, level(depth), "step", broadcast_rows=broadcast_rows)
                           .drop("step"), "term-level")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    return found.groupBy(id_col, "term").agg(F.count("*").alias("n"))
