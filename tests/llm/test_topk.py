import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seekframe.llm import topk

FIELDS = "vec_id long, embedding array<float>, label int"


def best(rows, queries, k):
    """Of all rows; repeated ids are candidates each."""
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows]
    out = []
    for q in queries:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i)
                        for j, v in whole if j == q for i, w in whole if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return out


@pytest.mark.parametrize("rows_block, queries_block, k", [(8192, 1024, 5), (64, 7, 5), (50, 3, 1), (64, 64, 500)])
def test_equals_brute_force(spark, monkeypatch, rows_block, queries_block, k):
    monkeypatch.setattr(topk, "ROWS", rows_block)
    monkeypatch.setattr(topk, "QUERIES", queries_block)
    draw = np.random.default_rng(3)
    rows = [(i, draw.integers(-3, 4, 6) / 16) for i in range(300)]  # many ties
    rows += [(300 + i, draw.normal(0, 2, 6)) for i in range(100)]
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], FIELDS)
    got = topk.search(df, F.col("vec_id") % 50 == 0, k)
    assert sorted(tuple(r) for r in got.collect()) == best(rows, range(0, 400, 50), k)


def test_odd_vectors(spark):
    nan, inf = float("nan"), math.inf
    rows = [(0, [0.5, 0.25]), (1, [0.5]), (2, []), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [-0.5, -0.25]), (7, [-0.5, -0.25]), (50, [1.0, 0.0, 2.0]), (None, [9.0]), (100, [0.0, -0.001])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], FIELDS) \
        .selectExpr("*", "1 AS id", "2 AS score", "3 AS r")
    got = sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 50 == 0).collect())
    assert got == best([(i, v) for i, v in rows if i in (0, 1, 2, 7, 50, 100)], (0, 50, 100), 5)
    assert topk.search(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    one = df.filter("vec_id = 0")
    assert topk.search(one, F.col("vec_id") % 50 == 0).collect() == []
    huge = spark.createDataFrame([(0, [3e38, 1.0], 0), (1, [3e38, 0.0], 0)], FIELDS)
    assert [r.score for r in topk.search(huge, F.col("vec_id") == 0).collect()] == [topk.LIMIT]


def test_repeated_ids_and_wide_components(spark):
    """Every row is a candidate, and components far over 2^26 keep their exact scores and order."""
    draw = np.random.default_rng(9)
    rows = [(i % 90, [float(np.float32(x)) for x in draw.normal(0, 4e6, 4)]) for i in range(200)]
    rows += [(i, [2.0 ** 45 * (1 + i % 3), 1.0 / 256 * i]) for i in range(500, 540)]
    rows += rows[:30]
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 50 == 0).collect())
    limit = lambda n: max(-2 ** 63, min(2 ** 63 - 1, n))
    want = []
    for q in (0, 50, 500):
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i)
                        for j, v in whole if j == q for i, w in whole if i != q)
        want += [(q, n, i, limit(-s)) for n, (s, i) in enumerate(scores[:5], 1)]
    assert got == want and any(abs(r[3]) == 2 ** 63 - 1 for r in got)


def test_slices_add_up():
    draw = np.random.default_rng(1)
    values = draw.integers(-300, 300, (130, 9))
    slices = topk.Slices(values)
    query = draw.integers(-300, 300, 9)
    total = sum((np.unpackbits(s.view(np.uint8), bitorder="little")[:130].astype(np.int64) << i)
                for i, s in enumerate(slices.sums(query)))
    assert len(set((total - values @ query).tolist())) == 1
