"""The trie against a plain one built from dictionaries."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest

from seekframe.llm import prefix_trie, queries
from helpers import FOLDER, table

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [t for *_, t in sorted(ts)] for c, ts in turns.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        base = c - c % 20 if c >= 0 else c + -c % 20
        whole = tuple(own.get(base, [])[:h] + own[c][h:])
        for depth in range(len(whole) + 1):
            members[whole[:depth]].append(c)
        ends[whole].append(c)
    below = defaultdict(list)
    for path in members:
        if path:
            below[path[:-1]].append(path)
    sums = {}
    for path in sorted(members, key=len, reverse=True):
        own_saved = (len(members[path]) - 1) * len(WORD.findall(path[-1][1])) if path else 0
        sums[path] = (sum(sums[p][0] for p in below[path]) + (not below[path]),
                      sum(sums[p][1] for p in below[path]) + own_saved)
    return sorted(((members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]),
                    len(below[p]), *sums[p],
                    hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
                   for p in members), key=str)


def found(df):
    return sorted(map(tuple, prefix_trie.conversation_trie(df).collect()), key=str)


def test_query_equals_the_plain_trie(spark):
    rows = [tuple(r) for r in table(spark, "conversations").select(
        "conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, queries.QUERIES["op13_prefix_trie"](spark, FOLDER).collect()), key=str)
    assert got == plain(rows)


@pytest.mark.parametrize("slab, shards, chunk", [(1, 5, 1), (3, 2, 2), (32, 11, 8192)])
def test_slabs_shards_and_pieces_of_any_size(spark, monkeypatch, slab, shards, chunk):
    monkeypatch.setattr(prefix_trie, "SLAB", slab)
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    rows = []
    for c in range(140):
        # A third are copies, many share beginnings, one is very long.
        length = 90 if c == 77 else 5 if c % 3 == 0 else c % 7
        rows += [(c, t, "user" if t % 2 else "bot", f"w{t} " * (t + 1) if c % 3 == 0 or t < c % 4
                  else f"own {c % 11} {t}") for t in range(length)]
    df = spark.createDataFrame(rows, SCHEMA)
    seq = prefix_trie.rebuilt(df)
    total = seq.selectExpr("sum(size(words))").head()[0]
    got = prefix_trie.prefix_trie(seq, shard_turns=max(1, total // shards))
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_conversations_that_most_rows_share(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = [(c, t, "user", "hello there") for c in range(200) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = prefix_trie.prefix_trie(prefix_trie.rebuilt(df), shard_turns=20)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_deep_conversations_stay_together(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "DEEP", 2)
    rows = [(c, t, "user", "same" if t < 4 else f"{c % 5}") for c in range(0, 200, 20) for t in range(7)]
    rows += [(c, t, "user", "same") for c in range(400, 600, 20) for t in range(2)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = prefix_trie.prefix_trie(prefix_trie.rebuilt(df), shard_turns=10)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_odd_rows(spark):
    rows = [(1, None, "user", "first"), (1, 3, None, None), (1, 3, "bot", None), (1, 3, "bot", None),
            (1, 2, "u", "ser:x"), (21, 0, "user", "  two\t words here "), (40, 5, "", ""),
            (None, 1, "user", "lost"), (-3, 0, "us", "erx"), (-3, 0, "user", "x"), (0, 0, "user", "")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS words", "'x' AS node")
    assert found(df) == plain(rows)


def test_conversations_without_turns_are_members_of_the_root(spark):
    # Conversation 5 loses its only turn and its head does not exist.
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    rows = [(lone, 0, "user", "gone")]
    none = hashlib.sha256(str(lone).encode()).hexdigest()
    assert found(spark.createDataFrame(rows, SCHEMA)) == [(lone, 0, None, 1, 0, 1, 0, none)]
    assert plain(rows) == [(lone, 0, None, 1, 0, 1, 0, none)]


def test_an_empty_table_has_no_nodes(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)) == []
