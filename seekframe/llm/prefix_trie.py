"""Prefix trie over conversations, from sorted matrices of turn ids.

Conversations are dealt to shards by range of their turn sequences, so a shard holds one stretch of
the trie's leaves. In a shard the turn ids stand in padded matrices, rows sorted by numpy's lexsort.
A row starts a node at depth d if it differs from the row above in any of the first d columns; these
masks are OR-accumulated along the columns, and every aggregate of every node at a depth is one
reduceat over its starts. Columns come in slabs, and only rows that reach a slab are in it, so one
very long conversation does not widen the matrix of the others.

Nodes that may go on in another shard are prefixes of a shard's first or last row. Their partial
aggregates recombine by the node's key afterwards: there are two paths a shard, however many
conversations share them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.operators.skew import join_lookup
from seekframe.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
DIGEST = 16  # bytes of a turn's digest
SLAB = 32  # columns of a matrix
DEEP = 4096  # turns of a conversation that deal it to a shard
SHARD_TURNS = 1 << 18  # turns of a shard, about
CHUNK = 8192  # ids in one piece of a list of ends


def _turns(conversations: DataFrame) -> DataFrame:
    """``id, place, digest, words`` of every turn; places count from 1 in order of ``turn``, null
    first, ties by the digest. A digest is of role and text, null ones empty, kept apart by the
    role's length."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("id"), "turn",
        F.substring(F.sha2(whole, 256), 1, 2 * DIGEST).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).alias("words"))
    # Texts stay where they are: only digests and counts are shuffled.
    listed = turns.groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "digest", "words"))).alias("turns"))
    return listed.select("id", F.transform("turns", lambda t: F.struct(
        t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def rebuilt(conversations: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """``id, key, words``: the rebuilt conversations, ``key`` the digests of their turns in a row.

    Conversation c takes its first h turns from conversation c - c % ``family`` and the rest from
    itself, h being the crc32 of its decimal id modulo ``heads``.
    """
    own = _turns(conversations).withColumn(
        "h", (F.crc32(F.col("id").cast("string").cast("binary")) % heads).cast("int")) \
        .withColumn("head_of", F.col("id") - F.col("id") % family)
    own = materialise(own, "trie-turns")
    # At most heads - 1 turns of every family-th conversation.
    first = own.filter(F.col("id") == F.col("head_of")) \
        .select("head_of", F.slice("turns", 1, heads - 1).alias("first"))
    both = own.join(first, "head_of", "left")
    none = F.array().cast(own.schema["turns"].dataType)
    head = F.slice(F.coalesce("first", none), F.lit(1), F.col("h"))
    # slice takes a place beyond the end as empty.
    tail = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return both.select("id", F.concat(head, tail).alias("turns")).select(
        "id", F.unhex(F.array_join(F.col("turns.digest"), "")).alias("key"),
        F.col("turns.words").alias("words"))


def _refine(ids: np.ndarray, first: np.ndarray, size: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Order of the rows by their turn ids, shorter ones first, then by ``tie``. Slab by slab: rows
    that reach no further keep their place, others are sorted within the ties so far."""
    order = np.lexsort((tie,))
    group = np.zeros(len(size), dtype=np.int64)  # of each row; equal so far
    alive, start = order, 0
    places = np.arange(len(size))
    while len(alive):
        block = _slab(ids, first[alive], size[alive], start)
        inner = np.lexsort((np.arange(len(alive)), *block.T[::-1], group[alive]))
        alive, block = alive[inner], block[inner]
        order[places] = alive
        held = group[alive]
        new = np.r_[True, (held[1:] != held[:-1]) | (block[1:] != block[:-1]).any(axis=1)]
        group[alive] = np.cumsum(new)
        start += SLAB
        longer = size[alive] > start
        places, alive = places[longer], alive[longer]
    return order


def _slab(ids: np.ndarray, first: np.ndarray, size: np.ndarray, start: int) -> np.ndarray:
    """Columns ``start`` … of the rows, padded with -1."""
    column = np.arange(start, min(start + SLAB, int(size.max(initial=start + 1))))
    inside = column < size[:, None]
    out = np.full(inside.shape, -1, dtype=np.int64)
    out[inside] = ids[(first[:, None] + column)[inside]]
    return out


class Shard:
    """Rows of one shard in order, with the aggregates of all their nodes."""

    def __init__(self, who: np.ndarray, keys: list[bytes], words: list[np.ndarray]):
        size = np.array([len(k) // DIGEST for k in keys], dtype=np.int64)
        first = np.cumsum(size) - size
        digests = np.frombuffer(b"".join(keys), dtype=f"S{DIGEST}") \
            if size.sum() else np.zeros(0, dtype=f"S{DIGEST}")
        # Numbers in the order of the digests, so shards and rows are in the same order.
        ids = np.unique(digests, return_inverse=True)[1].astype(np.int64)
        order = _refine(ids, first, size, who)
        self.who, self.size, self.ids = who[order], size[order], ids
        self.first, self.keys = first[order], [keys[i] for i in order]
        flat = np.concatenate([np.asarray(w, dtype=np.int64) for w in words]) \
            if len(ids) else np.zeros(0, dtype=np.int64)
        self.words = flat
        self._nodes()

    def _nodes(self) -> None:
        """Arrays over all nodes, from depth 0 down: ``depth, row`` (where the node starts), ``stop``
        (where it ends), ``smallest``, ``members``, ``parent`` (its number), ``own`` words."""
        rows = len(self.who)
        parts = [dict(depth=np.zeros(1, dtype=np.int64), row=np.zeros(1, dtype=np.int64),
                      stop=np.array([rows]), smallest=np.array([self.who.min()]),
                      members=np.array([rows]), parent=np.array([-1]), own=np.zeros(1, dtype=np.int64))]
        alive = np.arange(rows)
        changed = np.r_[True, np.zeros(rows - 1, dtype=bool)]  # so far, against the row above
        node, count, start = np.zeros(rows, dtype=np.int64), 1, 0
        while True:
            longer = self.size[alive] > start
            if not longer.any():
                break
            # Rows in between that end here differ, or stand before all that go on.
            at = np.flatnonzero(longer)
            carried = np.logical_or.reduceat(changed[:at[-1] + 1], np.r_[0, at[:-1] + 1])
            carried[0] = True
            alive = alive[at]
            block = _slab(self.ids, self.first[alive], self.size[alive], start)
            differs = np.zeros(block.shape, dtype=bool)
            differs[1:] = block[1:] != block[:-1]
            differs[:, 0] |= carried
            mask = np.logical_or.accumulate(differs, axis=1)
            for column in range(block.shape[1]):
                depth = start + column + 1
                filled = block[:, column] >= 0
                begins = np.flatnonzero(mask[:, column])
                real = filled[begins]
                if not real.any():
                    break
                # Padding makes stretches of its own, which are left out after the sums.
                smallest = np.minimum.reduceat(self.who[alive], begins)[real]
                members = np.add.reduceat(filled.astype(np.int64), begins)[real]
                row = alive[begins[real]]
                number = count + np.cumsum(real) - 1
                # Members of a node stand together, as rows that end before it come first.
                parts.append(dict(
                    depth=np.full(len(row), depth), row=row, stop=row + members, smallest=smallest,
                    members=members, parent=node[row],
                    own=self.words[self.first[row] + depth - 1]))
                stretch = np.cumsum(mask[:, column]) - 1
                node[alive[filled]] = number[stretch[filled]]
                count += len(row)
            changed = mask[:, -1]
            start += SLAB
        for name in parts[0]:
            setattr(self, name, np.concatenate([p[name] for p in parts]))
        self.last_node = node  # of each row: its deepest one

    def paths(self) -> np.ndarray:
        """Whether a node is a prefix of the first or the last row."""
        shared = np.zeros(len(self.depth), dtype=bool)
        for row in {0, len(self.who) - 1}:
            shared |= (self.row <= row) & (row < self.stop)
        return shared

    def key(self, node: int) -> bytes:
        """What names a node across shards: a digest of its turns' digests."""
        row, depth = int(self.row[node]), int(self.depth[node])
        return hashlib.sha256(self.keys[row][:depth * DIGEST]).digest()[:DIGEST]

    def up(self, value: np.ndarray, among: np.ndarray) -> np.ndarray:
        """Sum of ``value`` over each node's subtree, without nodes that are not in ``among`` and
        what hangs below these. Depth by depth from below, so a chain of any length needs no
        recursion."""
        total = np.where(among, value, 0)
        border = np.flatnonzero(np.r_[True, self.depth[1:] != self.depth[:-1]])
        for begin, stop in zip(border[:0:-1], [len(self.depth), *border[:0:-1]]):
            level = np.arange(begin, stop)
            # Children of one node stand side by side.
            parent = self.parent[level]
            starts = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
            total[parent[starts]] += np.add.reduceat(np.where(among[level], total[level], 0), starts)
        return total

    def ends(self, node_of_rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Nodes at which rows end, with these rows' ids in ascending order."""
        starts = np.flatnonzero(np.r_[True, node_of_rows[1:] != node_of_rows[:-1]])
        for begin, stop in zip(starts, [*starts[1:], len(node_of_rows)]):
            yield int(node_of_rows[begin]), np.sort(self.who[begin:stop])


_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends_sha256 string")
_PARTIAL = _NODE + ", node binary, parent binary, own long, chunk binary, chunk_first long"


def _joined(who: np.ndarray) -> bytes:
    return ",".join(map(str, who.tolist())).encode()


def _shard_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Finished nodes, partial nodes (with ``node``) and pieces of their ends (with ``chunk``)."""
    held = [b for b in batches if len(b)]
    if not held:
        return
    rows = pd.concat(held, ignore_index=True)
    shard = Shard(rows["id"].to_numpy(dtype=np.int64), rows["key"].tolist(), rows["words"].tolist())
    del held, rows
    count = len(shard.depth)
    shared = shard.paths()
    whole = ~shared
    children = np.bincount(shard.parent[1:][whole[1:]], minlength=count)
    # A shared node's own part is not known here; what hangs below it and is whole is.
    leaves = shard.up((children == 0).astype(np.int64), whole)
    saved = shard.up((shard.members - 1) * shard.own, whole)
    shas = np.full(count, _EMPTY, dtype=object)
    keys = {int(n): shard.key(int(n)) for n in np.flatnonzero(shared)}
    chunks = []
    for node, who in shard.ends(shard.last_node):
        if whole[node]:
            shas[node] = hashlib.sha256(_joined(who)).hexdigest()
        else:
            chunks += [(keys[node], _joined(who[at:at + CHUNK]), int(who[at]))
                       for at in range(0, len(who), CHUNK)]
    parent = shard.parent
    for at in range(0, count, 1 << 16):
        part = np.arange(at, min(count, at + (1 << 16)))
        ours = shared[part]
        above = [keys.get(int(p)) for p in parent[part]]
        yield pd.DataFrame({
            "conv_id": shard.smallest[part], "depth": shard.depth[part],
            "parent_conv_id": pd.array([None if k is not None or p < 0 else int(shard.smallest[p])
                                        for k, p in zip(above, parent[part])], dtype="Int64"),
            "n_convs": shard.members[part], "n_children": children[part],
            "n_leaves": leaves[part], "saved_tokens": saved[part], "ends_sha256": shas[part],
            "node": pd.Series([keys[int(n)] if s else None for n, s in zip(part, ours)], dtype=object),
            "parent": pd.Series(above, dtype=object), "own": shard.own[part],
            "chunk": None, "chunk_first": pd.array([None] * len(part), dtype="Int64")})
    if chunks:
        node, text, first = zip(*chunks)
        none = pd.array([None] * len(chunks), dtype="Int64")
        yield pd.DataFrame({
            **{c: none for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                                 "n_leaves", "saved_tokens")},
            "ends_sha256": None, "node": pd.Series(node, dtype=object), "parent": None, "own": none,
            "chunk": pd.Series(text, dtype=object), "chunk_first": first})


def _hash_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's ids from its pieces in order; one piece is held at a time."""
    now, state = None, None
    for batch in batches:
        for node, chunk in zip(batch["node"], batch["chunk"]):
            if node != now:
                if state is not None:
                    yield pd.DataFrame({"node": [now], "ends_sha256": [state.hexdigest()]})
                now, state = node, hashlib.sha256(chunk)
            else:
                state.update(b"," + chunk)
    if state is not None:
        yield pd.DataFrame({"node": [now], "ends_sha256": [state.hexdigest()]})


def _close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Recombined nodes with the sums over their subtrees: deepest first, each adds to its parent."""
    held = [b for b in batches if len(b)]
    if not held:
        return
    nodes = pd.concat(held, ignore_index=True).sort_values("depth", ascending=False, kind="stable")
    at = {node: i for i, node in enumerate(nodes["node"])}
    above = [at.get(p, -1) for p in nodes["parent"]]
    children, leaves = nodes["n_children"].tolist(), nodes["n_leaves"].tolist()
    saved, smallest = nodes["saved_tokens"].tolist(), nodes["conv_id"].tolist()
    for i, (parent, members, own) in enumerate(zip(above, nodes["n_convs"], nodes["own"])):
        leaves[i] += not children[i]
        saved[i] += (members - 1) * own
        if parent >= 0:
            children[parent] += 1
            leaves[parent] += leaves[i]
            saved[parent] += saved[i]
    yield pd.DataFrame({
        "conv_id": smallest, "depth": nodes["depth"].to_numpy(),
        "parent_conv_id": pd.array([None if p < 0 else smallest[p] for p in above], dtype="Int64"),
        "n_convs": nodes["n_convs"].to_numpy(), "n_children": children, "n_leaves": leaves,
        "saved_tokens": saved, "node": nodes["node"].to_numpy()})


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the trie over ``sequences(id, key, words)``: ``key`` holds a digest of ``DIGEST``
    bytes for every turn, ``words`` their numbers of words.

    Returns ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (words that members share with an earlier one, in
    the whole subtree) and ``ends_sha256`` (of the ids that end at the node).

    A sequence without turns is a member of the root only. Repeated sequences are members each. An
    empty table has no node, not even a root.

    Equal sequences are dealt by id, so a sequence that most rows share is spread over shards. Rows
    of more than ``DEEP`` turns that agree in as many stay together. A shard holds about
    ``shard_turns`` turns; a single conversation has to fit into a task.
    """
    spark = sequences.sparkSession
    size = F.octet_length("key") / DIGEST
    held = sequences.withColumn("n", size.cast("long"))
    total = held.agg(F.sum("n")).head()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, -(-total // shard_turns))
    tie = F.when(F.col("n") <= DEEP, F.col("id"))
    dealt = held.repartitionByRange(shards, F.substring("key", 1, DEEP * DIGEST), tie)
    made = materialise(dealt.select("id", "key", "words").mapInPandas(_shard_rows, _PARTIAL), "trie")
    names = [f.split()[0] for f in _NODE.split(", ")]
    whole = made.filter(F.col("node").isNull())
    pieces = made.filter(F.col("chunk").isNotNull()).select("node", "chunk", "chunk_first")
    ends = pieces.repartition("node").sortWithinPartitions("node", "chunk_first") \
        .mapInPandas(_hash_ends, "node binary, ends_sha256 string")
    partial = made.filter(F.col("node").isNotNull() & F.col("chunk").isNull()).groupBy("node").agg(
        *[F.min(c).alias(c) for c in ("conv_id", "depth", "parent", "own")],
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    # Two paths a shard, so one task sees a few rows for every shard.
    closed = partial.select("node", "parent", "conv_id", "depth", "own", "n_convs", "n_children",
                            "n_leaves", "saved_tokens").coalesce(1).mapInPandas(
        _close, ", ".join(f for f in _NODE.split(", ") if not f.startswith("ends")) + ", node binary")
    closed = materialise(closed.join(ends, "node", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY))), "trie-shared")
    smallest = closed.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    below = join_lookup(whole.filter(F.col("parent").isNotNull()), smallest, "parent") \
        .withColumn("parent_conv_id", F.col("above"))
    rest = whole.filter(F.col("parent").isNull())
    return below.select(*names).unionAll(rest.select(*names)).unionAll(closed.select(*names))


def conversation_trie(conversations: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """The prefix trie of the rebuilt conversations of a table ``(conv_id, turn, role, text)``.

    Null roles and texts are empty; turns are ordered by ``turn``, null first, equal ones by a
    digest of role and text. Repeated rows are turns of their own. Rows without ``conv_id`` belong
    to no conversation. Extra columns are left out. Other cases as in :func:`prefix_trie`.
    """
    return prefix_trie(materialise(rebuilt(conversations, family, heads), "trie-rebuilt"))


__all__ = ["conversation_trie", "prefix_trie", "rebuilt"]
