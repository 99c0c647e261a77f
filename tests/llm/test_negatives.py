"""Hard negatives against a plain statement of the rule."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seekframe.llm import negatives, queries
from helpers import FOLDER, table


def plain(rows, every=100, most=5, least=10):
    held = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or vec_id is None \
                or any(x is None or not math.isfinite(x) for x in vector):
            continue
        held.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label,
                     [math.floor(256 * float(x)) for x in vector]))
    out = []
    for own, label, a in (r for r in held if r[0] % every == 0):
        scored = [(-sum(x * y for x, y in zip(a, v)), i, other) for i, other, v in held if i != own]
        same = sorted((s, i) for s, i, other in scored if other == label)[:most]
        for p, positive in same:
            hard = sorted((s, i) for s, i, other in scored if other != label
                          and 30 * -p <= 100 * -s <= 90 * -p)[:least]
            out += [(own, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(hard, 1)]
    return sorted(out)


def found(df, every=100):
    return sorted(map(tuple, negatives.hard_negatives(df, F.col("id") % every == 0).collect()))


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_query_equals_the_plain_rule(spark):
    rows = [tuple(r) for r in table(spark, "embeddings").collect()]
    got = sorted(map(tuple, queries.QUERIES["op12_hard_negatives"](spark, FOLDER).collect()))
    assert got == plain(rows) and got


@pytest.mark.parametrize("rows, anchors", [(7, 2), (64, 1000)])
def test_cells_of_any_size_and_a_hot_label(spark, monkeypatch, rows, anchors):
    monkeypatch.setattr(negatives, "ROWS", rows)
    monkeypatch.setattr(negatives, "ANCHORS", anchors)
    draw = np.random.default_rng(5)
    data = [(i, draw.normal(0.2, 0.3, 6).round(2).tolist(), 3 if i % 3 else int(draw.integers(6)))
            for i in range(300)]
    df = spark.createDataFrame(data, SCHEMA)
    exact = [tuple(r) for r in df.collect()]
    assert found(df, 10) == plain(exact, every=10)


# Vector 0 stands for label 1 in these: its label is moved on by one.

def test_odd_rows(spark):
    data = [(0, [1.0, 1.0], 0), (1, [1.0, 0.5], 1), (2, [0.5, 0.5], 2), (3, None, 2), (4, [None, 1.0], 2),
            (5, [float("nan"), 1.0], 2), (6, [float("inf"), 1.0], 2), (8, [0.5, 0.5], None), (9, [], 2),
            (10, [0.5, 0.5], 2), (None, [0.5, 0.5], 2)]
    df = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 AS id", "2 AS row", "3 AS score")
    assert found(df) == [(0, 1, 1, 2, 98304, 65536), (0, 1, 2, 10, 98304, 65536)]
    assert found(df.limit(0)) == []


def test_repeated_rows_are_rows_of_their_own(spark):
    data = [(0, [1.0], 0), (0, [1.0], 0), (1, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2), (2, [0.5], 2)]
    got = found(spark.createDataFrame(data, SCHEMA))
    assert got == sorted([(0, 1, rank, 2, 65536, 32768) for rank in (1, 2)] * 4)


def test_negative_and_zero_scores(spark):
    data = [(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [0.0, 2.0], 2),
            (4, [-0.5, 0.0], 2)]
    # A negative score has no window; zero admits zero only.
    assert found(spark.createDataFrame(data, SCHEMA)) == [(0, 2, 1, 3, 0, 0)]


@pytest.mark.parametrize("reach", [1, 300, 70_000, 2 ** 27, 2 ** 40, 2 ** 61])
def test_scores_are_exact_at_any_width(reach):
    draw = np.random.default_rng(1)
    values = draw.integers(-reach, reach + 1, (20, 5))
    packed = negatives.Packed(values, reach + 1)
    for anchor in values[:4]:
        exact = [sum(int(a) * int(b) for a, b in zip(anchor, row)) for row in values]
        held = [max(-2 ** 63, min(2 ** 63 - 1, s)) for s in exact]
        assert packed.scores(anchor).tolist() == held


def test_best_breaks_ties_by_place():
    scores = np.array([5, 7, 7, 7, 1])
    assert sorted(negatives.best(scores, np.array([1, 1, 1, 1, 1], bool), 2)) == [1, 2]
    assert sorted(negatives.best(scores, np.array([1, 0, 0, 1, 1], bool), 5)) == [0, 3, 4]
