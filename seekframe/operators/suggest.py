"""Suggestions mined from a query log.

Events: ``_id`` (arrival order), ``sequence``, ``time``, ``item``, ``type`` ('submit' or '').
Items: ``_key``, ``freq``, ``freq2`` (submits), ``last``, optional ``boost`` and ``kana`` (readings).
Pairs: ``pre``, ``post``, ``freq0`` (typed, then submitted), ``freq1`` (submitted, then submitted),
``freq2`` (word of a submitted item).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.operators.prefixes import PrefixStore, names_of
from seekframe.operators.skew import (
    HOT_SHARE,
    best_of_key,
    chunk_hot_keys,
    fits_broadcast,
    join_lookup,
)
from seekframe.session import materialise

TYPES = ("complete", "correct", "suggest")
FREQUENCY_THRESHOLD = 100
PAIR_SECONDS = 60
CHUNK_ROWS = 1_000_000
LAST_EVENTS = 64
KEY_ROWS = 1_000_000  # meeting keys of the queries, when they are to be broadcast


def prepare_events(df: DataFrame, id: Column, sequence: Column, time: Column, item: Column,
                   submit: Column) -> DataFrame:
    """The event columns above from any log table."""
    return df.select(id.alias("_id"), sequence.cast("string").alias("sequence"),
                     time.alias("time"), item.alias("item"),
                     F.when(submit, "submit").otherwise("").alias("type"))


def _submitted() -> Column:
    return F.col("type") == "submit"


# --- learning -----------------------------------------------------------------------------------

def item_stats(events: DataFrame) -> DataFrame:
    """Per item: events, submits and the time of the latest event."""
    return events.groupBy(F.col("item").alias("_key")).agg(
        F.count("*").alias("freq"), F.count_if(_submitted()).alias("freq2"),
        F.max("time").alias("last"))


def with_next_submit(events: DataFrame, chunk_rows: int = CHUNK_ROWS,
                     hot_share: float = HOT_SHARE) -> DataFrame:
    """Add ``_next``: item and time of the next submit of the sequence in arrival order.

    A sequence with more than ``hot_share`` of all events is cut into chunks of at most
    ``chunk_rows`` arrival ids. Events without a sequence have no next submit and are left out. Within a chunk a window finds the next submit; where the chunk has
    none left, the first submit of a later chunk is taken from a summary with one row per chunk.
    """
    groups = ["sequence", "_chunk"]
    events = events.filter(F.col("sequence").isNotNull())
    marked = chunk_hot_keys(events, "sequence", F.col("_id"), chunk_rows, hot_share)
    submit = F.when(_submitted(), F.struct("item", "time"))
    # Newest first, the next submit is the last one seen: a running frame, linear in the group.
    earlier = lambda by: by.rowsBetween(Window.unboundedPreceding, -1)
    inside = marked.withColumn("_inside", F.last(submit, ignorenulls=True).over(
        earlier(Window.partitionBy(*groups).orderBy(F.desc("_id")))))
    chunks = marked.filter(F.col("_chunk").isNotNull()).groupBy(*groups).agg(
        F.min_by(F.struct("item", "time"), F.when(_submitted(), F.col("_id"))).alias("_first"))
    carried = chunks.withColumn("_later", F.last("_first", ignorenulls=True).over(
        earlier(Window.partitionBy("sequence").orderBy(F.desc("_chunk"))))) \
        .select(*groups, "_later")
    return inside.join(carried, groups, "left") \
        .withColumn("_next", F.coalesce("_inside", "_later")) \
        .drop("_chunk", "_inside", "_later")


def _in_time(seconds: float) -> Column:
    gap = F.col("_next.time") - F.col("time")
    return gap.between(F.lit(dt.timedelta(0)), F.lit(dt.timedelta(seconds=seconds)))


def event_pairs(events: DataFrame, seconds: float = PAIR_SECONDS, chunk_rows: int = CHUNK_ROWS,
                hot_share: float = HOT_SHARE) -> DataFrame:
    """``freq0`` and ``freq1`` of every pair, from one pass over the sequences."""
    followed = with_next_submit(events, chunk_rows, hot_share).filter(_in_time(seconds))
    return followed.groupBy(F.col("item").alias("pre"), F.col("_next.item").alias("post")).agg(
        F.count_if(~_submitted()).alias("freq0"), F.count_if(_submitted()).alias("freq1"))


def pairs_complete(events: DataFrame, seconds: float = PAIR_SECONDS) -> DataFrame:
    """Typed item and the submit that followed it."""
    return event_pairs(events, seconds).filter(F.col("freq0") > 0).select("pre", "post", "freq0")


def pairs_correct(events: DataFrame, seconds: float = PAIR_SECONDS) -> DataFrame:
    """Submitted item and the next one submitted."""
    submits = events.filter(_submitted())
    return event_pairs(submits, seconds).select("pre", "post", "freq1")


def pairs_related(items: DataFrame) -> DataFrame:
    """A word of a submitted item and the item; from item counts, so each item is cut once."""
    words = F.array_distinct(F.split("_key", " "))
    return items.filter(F.col("freq2") > 0) \
        .select(F.explode(words).alias("pre"), F.col("_key").alias("post"), "freq2") \
        .filter((F.col("pre") != F.col("post")) & (F.col("pre") != ""))


def learn_pairs(events: DataFrame, items: DataFrame, seconds: float = PAIR_SECONDS) -> DataFrame:
    """The pair table with all three frequencies."""
    related = pairs_related(items)
    zero = F.lit(0).cast("long")
    both = event_pairs(events, seconds).withColumn("freq2", zero).unionByName(
        related.select("pre", "post", zero.alias("freq0"), zero.alias("freq1"), "freq2"))
    return both.groupBy("pre", "post").agg(
        *[F.sum(c).alias(c) for c in ("freq0", "freq1", "freq2")])


def last_events(events: DataFrame, last: int = LAST_EVENTS) -> DataFrame:
    """The latest ``last`` events of every sequence, ``_back`` counting from the newest.

    The row-number filter is applied before the shuffle too, so a long sequence sends no more than
    ``last`` rows per task.
    """
    return best_of_key(events, ["sequence"], [F.desc("_id")], last, "_back")


def sequence_table(events: DataFrame, last: int = LAST_EVENTS) -> DataFrame:
    """Per sequence the ids of its latest ``last`` events, oldest first: vectors of bounded size."""
    return last_events(events, last).groupBy(F.col("sequence").alias("_key")).agg(
        F.sort_array(F.collect_list("_id")).alias("events"))


# --- serving ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Asked:
    """Distinct query strings, and whether they are few enough to be broadcast."""

    queries: DataFrame
    few: bool

    @classmethod
    def of(cls, queries: DataFrame | Asked) -> Asked:
        if isinstance(queries, Asked):
            return queries
        queries = queries.select("query").distinct()
        return cls(queries, fits_broadcast(queries))

    def join(self, big: DataFrame, side: DataFrame | None = None) -> DataFrame:
        """``big`` joined with the queries, or with a ``side`` of at most one row per query."""
        return join_lookup(big, self.queries if side is None else side, "query",
                           broadcast=self.few)


def _pair_hits(pairs: DataFrame, asked: Asked, freq: str) -> DataFrame:
    candidates = pairs.filter(F.col(freq) > 0).select(
        F.col("pre").alias("query"), F.col("post").alias("_key"), F.col(freq).alias("_freq"))
    return asked.join(candidates)


def _probable(hits: DataFrame, bases: DataFrame, asked: Asked, threshold: float) -> DataFrame:
    """Hits whose frequency is at least ``threshold`` of the query's own; ``bases`` has one row
    (query, _base) per query."""
    return asked.join(hits, bases).filter(F.try_divide("_freq", "_base") >= threshold).drop("_base")


def _own_counts(items: DataFrame, asked: Asked, column: str) -> DataFrame:
    return asked.join(items.select(F.col("_key").alias("query"), F.col(column).alias("_base")))


def _prefix_hits(items: DataFrame, asked: Asked, queries: DataFrame) -> DataFrame:
    """Submitted items that start with one of ``queries`` (all or some of those asked), by key or
    by any reading: prefix = query, an equi-join. Only prefixes as long as some query are made."""
    # One number per distinct length of a query.
    lengths = asked.queries.agg(F.collect_set(F.length("query"))).scalar()
    named = items.filter(F.col("freq2") > 0).select(
        "_key", "freq2", names_of(items).alias("_names"), lengths.alias("_lengths"))
    starts = F.flatten(F.transform("_names", lambda name: F.transform(
        F.filter("_lengths", lambda size: (size > 0) & (size <= F.length(name))),
        lambda size: F.substring(name, F.lit(1), size))))
    prefixes = named.select("_key", "freq2", F.explode(F.array_distinct(starts)).alias("query"))
    return asked.join(prefixes, queries) \
        .select("query", "_key", (F.col("freq2") + 1).alias("_freq"))


def _by_prefix(items: DataFrame, asked: Asked, queries: DataFrame, frequency_threshold: int,
               prefixes: PrefixStore | None, top: int | None) -> DataFrame:
    """Hits by prefix that are frequent enough: from a stored table where there is one, and from the
    items for what it does not answer. With ``top``, a query's hits may end after that many."""
    frequent = F.col("_freq") >= frequency_threshold
    if prefixes is None:
        return _prefix_hits(items, asked, queries).filter(frequent)
    hits, rest = prefixes.serve(queries, frequency_threshold, top)
    if rest.isEmpty():
        return hits
    return hits.unionByName(_prefix_hits(items, Asked(rest, asked.few), rest).filter(frequent))


def _bigrams(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit("(?s)(?=(.{2}))."), F.lit(1))


SEGMENTS = 3  # one more than the edits allowed, so one segment of an item is left whole
SHORT = 4  # characters of an item that is found by its bigrams, of which it has at most three
KEYS = 39  # meeting keys of a query, at most


def _segment(n: Column, number: int) -> tuple[Column, Column]:
    """Start, from 0, and length of a segment of a text of ``n`` characters."""
    part = lambda i: F.call_function("div", n + i, F.lit(SEGMENTS)).cast("int")
    return sum((part(i) for i in range(number)), F.lit(0)), part(number)


def _meeting(n: Column, number: Column, text: Column) -> Column:
    return F.xxhash64(n.cast("int"), number.cast("int"), text)


def _kept(items: DataFrame) -> DataFrame:
    key, n = F.col("_key"), F.length("_key")
    whole = F.array(*[_meeting(n, F.lit(i), F.substring(key, start + 1, size))
                      for i in range(SEGMENTS) for start, size in [_segment(n, i)]])
    short = F.transform(F.array_distinct(_bigrams(key)), lambda b: _meeting(n, F.lit(-1), b))
    return items.filter(F.col("freq2") > 0).select(
        "_key", "freq2", F.explode(F.when(n <= SHORT, short).otherwise(whole)).alias("_meet"))


def close_keys(items: DataFrame) -> DataFrame:
    """``_meet, _key``: at most three keys for every submitted item, by which close texts find it.

    An item is cut in three even segments; a text two edits away has one of them unchanged. Items of
    up to ``SHORT`` characters are kept by their bigrams. The table depends on the items' texts only,
    so it is written once and added to as items come.
    """
    return _kept(items).select("_meet", "_key")


def _probes(queries: DataFrame) -> DataFrame:
    """``queries`` with a row for each ``_meet`` under which an item two edits away may be kept.

    For an item of n characters a segment may stand ``shift`` places off in the query; edits before
    it and after it are then at least ``|shift|`` and ``|difference of lengths - shift|``.
    """
    query, size = F.col("query"), F.length("query")
    found = []
    for more in range(-2, 3):  # characters that the item has more than the query
        n = size + more
        for shift in range(-2, 3):
            if abs(shift) + abs(-more - shift) > SEGMENTS - 1:
                continue
            for number in range(SEGMENTS):
                start, width = _segment(n, number)
                at = start + shift
                inside = (n > SHORT) & (at >= 0) & (at + width <= size)
                found.append(F.when(inside, _meeting(n, F.lit(number),
                                                     F.substring(query, at + 1, width))))
    long = F.filter(F.array(*found), lambda m: m.isNotNull())
    lengths = F.filter(F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda d: size + d),
                       lambda n: n.between(2, SHORT))
    short = F.flatten(F.transform(lengths, lambda n: F.transform(
        _bigrams(query), lambda b: _meeting(n, F.lit(-1), b))))
    return queries.withColumn("_meet", F.explode(F.array_distinct(F.concat(long, short))))


def _close(items: DataFrame, asked: Asked, queries: DataFrame,
           keys: DataFrame | None = None) -> DataFrame:
    """Submitted items within two edits of one of ``queries``, sharing a bigram with it, submitted
    more often than the query itself.

    Candidates meet on a segment that the edits left whole; ``keys`` is a stored
    :func:`close_keys`, else it is made here.
    """
    own = asked.join(items.select(F.col("_key").alias("query"), F.col("freq2").alias("_own")))
    wanted = queries.join(own, "query", "left").withColumn("_own", F.coalesce("_own", F.lit(0)))
    few = asked.few and fits_broadcast(asked.queries, KEY_ROWS // KEYS)
    met = join_lookup(_kept(items) if keys is None else keys, _probes(wanted), "_meet", broadcast=few)
    near = met.filter(
        (F.col("_key") != F.col("query")) & (F.levenshtein("_key", "query", 2) >= 0)
        & F.arrays_overlap(_bigrams(F.col("_key")), _bigrams(F.col("query"))))
    if keys is not None:
        near = near.select("query", "_key", "_own").distinct().join(
            items.filter(F.col("freq2") > 0).select("_key", "freq2"), "_key")
    return near.filter(F.col("freq2") > F.col("_own")) \
        .groupBy("query", "_key").agg(F.max("freq2").alias("_freq"))


def _either(first: DataFrame, second: DataFrame) -> DataFrame:
    """Hits of both ways; found twice, the higher frequency counts."""
    return first.unionByName(second).groupBy("query", "_key").agg(F.max("_freq").alias("_freq"))


def _unanswered(asked: Asked, hits: DataFrame) -> DataFrame:
    return asked.queries.join(hits.select("query").distinct(), "query", "left_anti")


def complete(items: DataFrame, pairs: DataFrame, queries: DataFrame | Asked,
             frequency_threshold: int = FREQUENCY_THRESHOLD,
             conditional_probability_threshold: float | None = None,
             prefix_search: bool | None = None, prefixes: PrefixStore | None = None,
             top: int | None = None) -> DataFrame:
    """Completions from pairs; submitted items by prefix where no pair is frequent enough, always
    (``prefix_search=True``) or never (``False``). ``prefixes`` is a stored table of ``items``; only
    the best ``top`` by score are asked of it."""
    asked = Asked.of(queries)
    typed = _pair_hits(pairs, asked, "freq0").filter(F.col("_freq") >= frequency_threshold)
    if conditional_probability_threshold is not None:
        typed = _probable(typed, _own_counts(items, asked, "freq"), asked,
                          conditional_probability_threshold)
    if prefix_search is False:
        return typed
    if prefix_search:
        return _either(typed, _by_prefix(items, asked, asked.queries, frequency_threshold, prefixes, top))
    return typed.unionByName(_by_prefix(items, asked, _unanswered(asked, typed), frequency_threshold,
                                        prefixes, top))


def correct(items: DataFrame, pairs: DataFrame, queries: DataFrame | Asked,
            frequency_threshold: int = FREQUENCY_THRESHOLD,
            conditional_probability_threshold: float | None = None,
            similar_search: bool | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Corrections from pairs; similar items for queries never submitted that have no pair, always
    (``similar_search=True``) or never (``False``). ``keys`` is a stored :func:`close_keys`."""
    asked = Asked.of(queries)
    followed = _pair_hits(pairs, asked, "freq1").filter(F.col("_freq") >= frequency_threshold)
    if conditional_probability_threshold is not None:
        followed = _probable(followed, _own_counts(items, asked, "freq2"), asked,
                             conditional_probability_threshold)
    if similar_search is False:
        return followed
    if similar_search:
        return _either(followed, _close(items, asked, asked.queries, keys)
                       .filter(F.col("_freq") >= frequency_threshold))
    known = items.filter(F.col("freq2") > 0).select(F.col("_key").alias("query"))
    submitted = asked.join(known)
    unknown = _unanswered(asked, followed).join(submitted, "query", "left_anti")
    return followed.unionByName(
        _close(items, asked, unknown, keys).filter(F.col("_freq") >= frequency_threshold))


def related(items: DataFrame, pairs: DataFrame, queries: DataFrame | Asked,
            frequency_threshold: int = FREQUENCY_THRESHOLD,
            conditional_probability_threshold: float | None = None) -> DataFrame:
    """Submitted items that have the query as one of their words."""
    asked = Asked.of(queries)
    worded = _pair_hits(pairs, asked, "freq2")
    if conditional_probability_threshold is not None:
        bases = worded.groupBy("query").agg(F.sum("_freq").alias("_base"))
        worded = _probable(worded, bases, asked, conditional_probability_threshold)
    return worded.filter(F.col("_freq") >= frequency_threshold)


def suggest_batch(items: DataFrame, pairs: DataFrame, queries: DataFrame | Asked,
                  types: tuple[str, ...] = TYPES, top: int | None = None,
                  frequency_threshold: int = FREQUENCY_THRESHOLD,
                  conditional_probability_threshold: float | None = None,
                  prefix_search: bool | None = None,
                  similar_search: bool | None = None, keys: DataFrame | None = None,
                  prefixes: PrefixStore | None = None) -> DataFrame:
    """Suggestions for every distinct ``query``: query, type, ``_key``, ``_score`` (frequency plus
    the item's boost); with ``top``, the best of each query and type and their ``rank``."""
    unknown = [t for t in types if t not in TYPES]
    if unknown:
        raise KeyError(unknown[0])
    if not isinstance(queries, Asked):
        # Every way of answering reads the queries, some twice; they are worked out once.
        asked = materialise(queries.select("query").distinct(), "asked")
        queries = Asked(asked, fits_broadcast(asked))
    shared = (items, pairs, queries, frequency_threshold, conditional_probability_threshold)
    made = {
        "complete": lambda: complete(*shared, prefix_search, prefixes, top),
        "correct": lambda: correct(*shared, similar_search, keys),
        "suggest": lambda: related(*shared),
    }
    hits = None
    for name in types:
        part = made[name]().withColumn("type", F.lit(name))
        hits = part if hits is None else hits.unionByName(part)
    if "boost" in items.columns:
        boosts = items.filter(F.col("boost") != 0).select("_key", "boost")
        hits = join_lookup(hits, boosts, "_key", "left")
        hits = hits.withColumn("_freq", F.col("_freq") + F.coalesce("boost", F.lit(0)))
    scored = hits.select("query", "type", "_key", F.col("_freq").cast("long").alias("_score"))
    if top is None:
        return scored
    return best_of_key(scored, ["query", "type"], [F.desc("_score"), F.asc("_key")], top, "rank")


def suggest(items: DataFrame, pairs: DataFrame, query: str,
            types: tuple[str, ...] = ("complete",), **options) -> DataFrame:
    """Suggestions for one string. Literal filters reach the scans of both tables before the
    general join: pairs by ``pre``, items by what could be a prefix, a similar or the query's item.
    """
    # A row, not a literal column: equality of two constants would leave a join without a key.
    queries = items.sparkSession.createDataFrame([(query,)], "query string")
    key = F.col("_key")
    wanted = (key == query)
    if "complete" in types:
        wanted = wanted | key.startswith(query)
        if "kana" in items.columns:
            wanted = wanted | F.exists(F.coalesce("kana", F.array().cast("array<string>")),
                                       lambda reading: reading.startswith(F.lit(query)))
    if "correct" in types:
        wanted = wanted | (F.levenshtein(key, F.lit(query), 2) >= 0)
    mine = pairs.filter(F.col("pre") == query)
    if "boost" in items.columns:
        # Boosted items are few and may be the target of a pair.
        wanted = wanted | (F.col("boost") != 0)
    return suggest_batch(items.filter(wanted), mine, Asked(queries, True), types, **options)
