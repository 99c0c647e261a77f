import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from helpers import documents, table

from seekframe.llm import simhash
from seekframe.llm.tables import components


def slow_fingerprint(text, size=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_roots(ids, prints, radius=3):
    root = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    known = lambda r: [ids[k] for k in range(len(ids)) if root[k] == r and ids[k] is not None]
    return [min(known(r), default=None) for r in root]


def test_equals_brute_force_on_the_table(spark):
    docs = table(spark, "documents")
    rows = docs.select("doc_id", "text").collect()
    prints = [slow_fingerprint(r.text) for r in rows]
    want = {(r.doc_id, f"{p:016x}", c) for r, p, c in
            zip(rows, prints, slow_roots([r.doc_id for r in rows], prints))}
    got = simhash.near_duplicates(docs)
    assert {tuple(r)[:3] for r in got.collect()} == want


def test_nulls_repeats_and_clashing_columns(spark):
    long = " ".join(f"w{i % 977}" for i in range(150_000))
    rows = [(3, None), (1, ""), (2, " \t\n"), (5, "a b c d"), (5, "a b c d"), (None, "A B C D"),
            (7, long), (8, long + " end"), (None, "only text without id"), (9, "x")]
    docs = documents(spark, rows).selectExpr("*", "1 as fingerprint", "2 as component_id", "3 AS _row")
    out = simhash.near_duplicates(docs)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in out.collect()), key=str)
    prints = [slow_fingerprint(t) for _, t in rows]
    roots = slow_roots([i for i, _ in rows], prints)
    assert got == sorted(((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, roots)), key=str)
    kept = simhash.drop_near_copies(docs, simhash.EXACT)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 5, 7, 9, None]


def test_empty_table(spark):
    docs = documents(spark, [])
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.drop_near_copies(docs).collect() == []


@pytest.mark.parametrize("cell, open_rows", [(4096, 32768), (8, 16)])
def test_finds_every_link_of_close_and_crowded_fingerprints(spark, monkeypatch, cell, open_rows):
    monkeypatch.setattr(simhash, "CELL", cell)
    monkeypatch.setattr(simhash, "OPEN_ROWS", open_rows)
    draw = random.Random(5)
    prints = {draw.getrandbits(64) for _ in range(150)}
    for centre in list(prints)[:6]:
        for _ in range(40):
            flips = draw.sample(range(64), draw.choice([1, 2, 3, 4, 6]))
            prints.add(centre ^ sum(1 << b for b in flips))
    prints = sorted(prints)
    nodes = spark.createDataFrame([(f"{p:016x}",) for p in prints], f"{simhash.FP} string")
    links = simhash.linked_fingerprints(nodes, simhash.EXACT)
    roots = {r.node: r.root for r in components(links).collect()}
    want = slow_roots([f"{p:016x}" for p in prints], prints)
    assert [roots.get(f"{p:016x}", f"{p:016x}") for p in prints] == want


def test_links_across_batches():
    draw = random.Random(2)
    homes = [draw.getrandbits(20) for _ in range(30)]
    rows = pd.DataFrame({"segment": 0, "key": [k // 10 for k in range(30)], "cell": 0, "home": True,
                         "f0": np.array(homes, dtype=np.int64)})
    run = simhash._links(simhash.Scheme(radius=8))
    whole = pd.concat(run(iter([rows])))
    parts = pd.concat(run(iter([rows[:7], rows[7:8], rows[8:25], rows[25:]])))
    assert set(map(tuple, whole.values)) == set(map(tuple, parts.values))
    assert len(whole)


def test_close_copies_go_and_others_stay(spark):
    draw = random.Random(1)
    words = [f"word{i}" for i in range(3000)]
    rows, close = [], []
    for i in range(60):
        text = draw.choices(words, k=300)
        rows.append((3 * i, " ".join(text)))
        text[-1] = "changed"
        close.append((3 * i + 1, " ".join(text)))
    kept = {r.doc_id for r in simhash.drop_near_copies(documents(spark, rows + close)).collect()}
    near = {i for (i, a), (_, b) in zip(close, rows) if sum(
        (x ^ y).bit_count() for x, y in zip(simhash.fingerprint(a), simhash.fingerprint(b))) > 3}
    assert kept == {3 * i for i in range(60)} | near
    assert len(near) < 20
