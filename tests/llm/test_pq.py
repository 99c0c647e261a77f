import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seekframe.llm import pq

FIELDS = "vec_id long, embedding array<float>, label int"


def brute(rows, similarity=0.93):
    """(id, links, component, kept) of every row, by comparing all."""
    width = max(len(v) for _, v, _ in rows if v)
    unit = []
    for _, v, label in rows:
        fine = v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.zeros(width)
        if fine:
            x[:len(v)] = np.float32(v)
        unit.append(x / np.linalg.norm(x) if fine else None)
    n, root = len(rows), list(range(len(rows)))
    links = [0] * n
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] \
                    and unit[i] @ unit[j] >= similarity:
                links[i] += 1
                links[j] += 1
                root = [root[i] if r == root[j] else r for r in root]
    name = {r: min((rows[k][0] for k in range(n) if root[k] == r and rows[k][0] is not None), default=None)
            for r in root}
    return sorted(((rows[i][0], links[i], name[root[i]], rows[i][0] == name[root[i]]) for i in range(n)), key=str)


def clustered(seed=5, groups=12, each=25, noise=0.045, width=64):
    draw = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        centre = draw.normal(0, 1, width)
        centre /= np.linalg.norm(centre)
        for _ in range(each):
            out.append((centre + draw.normal(0, noise, width)).tolist())
    return out


@pytest.mark.parametrize("part, ask, fit_rows", [(2048, 512, 8000), (16, 5, 40)])
def test_finds_every_link(spark, monkeypatch, part, ask, fit_rows):
    monkeypatch.setattr(pq, "PART_ROWS", part)
    monkeypatch.setattr(pq, "ASK_ROWS", ask)
    vectors = clustered()
    rows = [(i, [float(np.float32(x)) for x in v], i % 2 if i < 250 else 0) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[3][1], 1) for i in range(30)]  # equal copies
    want = brute(rows)
    assert sum(r[1] for r in want) > 900 and len({r[2] for r in want}) > 3
    df = spark.createDataFrame(rows, FIELDS).repartition(3)
    got = pq.near_vectors(df, fit_rows=fit_rows)
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_odd_vectors(spark):
    nan, inf = float("nan"), math.inf
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
            (6, [], 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 0.0], 1), (10, [None, 1.0], 1),
            (11, [1.0, 0.01, 0.0], 1), (2, [2.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, [0.0, 5.0], 3),
            (12, [3e38, 0.0], 1), (13, [1e-40, 0.0], 1)]
    df = spark.createDataFrame(rows, FIELDS).selectExpr("*", "1 AS id", "2 AS v", "3 AS n_links")
    got = sorted(map(tuple, pq.near_vectors(df).collect()), key=str)
    want = brute(rows)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == [w[2] for w in want]
    assert pq.near_vectors(df.limit(0)).collect() == []
    assert pq.near_vectors(df.filter("vec_id = 5")).collect() == [(5, 0, 5, True)]


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    x = np.array([r.embedding for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r.label for r in rows])
    near = (x @ x.T >= 0.93) & (label[:, None] == label)
    want = dict(zip([r.vec_id for r in rows], (near.sum(axis=1) - 1).tolist()))
    got = {r.vec_id: r.n_links for r in pq.near_vectors(df).collect()}
    assert got == want
    assert df.agg(F.count("*")).first()[0] == len(got)


def test_recall_at_the_threshold():
    """Pairs of cosine 0.93 to 0.95 in random directions, the hardest to find."""
    draw = np.random.default_rng(8)
    x = draw.normal(0, 1, (3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    step = draw.normal(0, 1, x.shape)
    step -= (step * x).sum(1)[:, None] * x
    step /= np.linalg.norm(step, axis=1)[:, None]
    cosine = draw.uniform(0.93, 0.95, (3000, 1))
    y = cosine * x + np.sqrt(1 - cosine ** 2) * step
    index = pq.fit(np.concatenate([x, y])[::2], 120)
    home = [index.distances(v).argmin(axis=1) for v in (x, y)]
    found = index.probed(x, home[0], home[1], 0.93) | index.probed(y, home[1], home[0], 0.93)
    assert found.mean() > 0.97


@pytest.mark.parametrize("width, rank", [(64, 6), (384, 16)])
def test_probes_every_link_of_a_hot_flat_cluster(width, rank):
    """Differences that lie in a few dimensions point straight at the borders."""
    draw = np.random.default_rng(4)
    x = draw.normal(0, 1, (3000, width))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[:1000] = x[0]
    x[:1000, :rank] += draw.normal(0, 0.3 / math.sqrt(rank), (1000, rank))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = pq.fit(x, 120)
    home = index.distances(x).argmin(axis=1)
    a, b = np.nonzero(np.triu(x @ x.T >= 0.93, 1))
    assert len(a) > 10_000 and (home[a] != home[b]).sum() > 5_000
    found = (home[a] == home[b]) | index.probed(x[a], home[a], home[b], 0.93) \
        | index.probed(x[b], home[b], home[a], 0.93)
    assert found.all()
