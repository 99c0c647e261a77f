import random

import pytest
from conftest import EVENT_SCHEMA, EVENTS, event_rows
from pyspark.sql import functions as F

from seekframe.operators import suggest as sg
from seekframe.operators.prefixes import PrefixStore, merge_prefixes, prefix_table
from seekframe.session import materialise, scratch_path
from seekframe.streaming.item_stats import current_item_stats, read_item_stats, start_item_stats
from seekframe.streaming.pairs import PairLearner

C = F.col


def learned(spark, times):
    events = spark.createDataFrame(event_rows(EVENTS, times), EVENT_SCHEMA)
    items = materialise(sg.item_stats(events), "items")
    return items, materialise(sg.learn_pairs(events, items), "pairs")


@pytest.fixture(scope="module")
def hundred(spark):
    return learned(spark, 100)


@pytest.fixture(scope="module")
def three(spark):
    return learned(spark, 3)


def ranked(df, kind=None):
    rows = [r for r in df.collect() if kind in (None, r["type"])]
    return [(r["_key"], r["_score"]) for r in sorted(rows, key=lambda r: (-r["_score"], r["_key"]))]


def test_item_statistics(spark):
    rows = event_rows([("deadbeef", 12, "s", ""), ("deadbeef", 13, "se", ""),
                       ("deadbeef", 14, "sea", "submit"), ("foobar", 22, "mou", ""),
                       ("foobar", 23, "moun", "submit"), ("foobar", 24, "mountain", "submit")])
    got = sg.item_stats(spark.createDataFrame(rows, EVENT_SCHEMA)).collect()
    assert {r["_key"]: (r["freq"], r["freq2"]) for r in got} == {
        "mou": (1, 0), "moun": (1, 1), "mountain": (1, 1), "s": (1, 0), "se": (1, 0), "sea": (1, 1)}
    assert {r["_key"]: r["last"] for r in got}["sea"] == rows[2][2]


def test_complete(hundred):
    assert ranked(sg.suggest(*hundred, "en")) == [("engine", 100)]
    assert ranked(sg.suggest(*hundred, "sea")) == [("search", 101), ("search engine", 101)]
    assert ranked(sg.suggest(*hundred, "sea", prefix_search=False)) == []


@pytest.mark.parametrize("types, query, complete, correct, related", [
    (("complete",), "en", ["engine"], [], []),
    (("correct",), "saerch", [], ["search"], []),
    (("suggest",), "search", [], [], ["search engine", "web search realtime"]),
    (("complete", "correct"), "search", ["search", "search engine"], [], []),
    (("complete", "suggest"), "search", ["search", "search engine"], [],
     ["search engine", "web search realtime"]),
    (sg.TYPES, "search", ["search", "search engine"], [],
     ["search engine", "web search realtime"]),
])
def test_types(hundred, types, query, complete, correct, related):
    got = materialise(sg.suggest(*hundred, query, types), "got")
    for kind, expected in zip(sg.TYPES, (complete, correct, related)):
        assert [key for key, _ in ranked(got, kind)] == expected


def test_unknown_type(hundred):
    with pytest.raises(KeyError):
        sg.suggest(*hundred, "en", ("dummy",))


@pytest.mark.parametrize("threshold, expected", [(2, [("engine", 3)]), (3, [("engine", 3)]),
                                                 (4, [("engine", 4)]), (5, [])])
def test_frequency_threshold(three, threshold, expected):
    assert ranked(sg.suggest(*three, "en", frequency_threshold=threshold)) == expected


def test_probability(hundred):
    ask = lambda p, q="saerch", types=("correct",): ranked(
        sg.suggest(*hundred, q, types, conditional_probability_threshold=p, similar_search=False))
    assert ask(1.0) == [("search", 100)]
    assert ask(1.01) == []
    assert ask(0.5, "search", ("suggest",)) == [("search engine", 100), ("web search realtime", 100)]
    assert ask(0.51, "search", ("suggest",)) == []


def test_similar(hundred):
    assert ranked(sg.suggest(*hundred, "serch", ("correct",))) == [
        ("saerch", 100), ("search", 100)]
    assert ranked(sg.suggest(*hundred, "engone", ("correct",))) == [("engine", 100)]
    assert ranked(sg.suggest(*hundred, "engone", ("correct",), similar_search=False)) == []


def test_boost_and_readings(spark, hundred):
    items, pairs = hundred
    boosted = items.withColumn("boost", F.when(C("_key") == "search engine", 7).otherwise(0)) \
        .withColumn("kana", F.when(C("_key") == "engine", F.array(F.lit("moteur"))))
    assert ranked(sg.suggest(boosted, pairs, "sea")) == [("search engine", 108), ("search", 101)]
    assert ranked(sg.suggest(boosted, pairs, "mot")) == [("engine", 101)]


def test_close_equals_brute_force(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 7))) for _ in range(250)})
    items = [(w, rng.randint(0, 3)) for w in words]
    asked = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(60)})

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    grams = lambda s: {s[i:i + 2] for i in range(len(s) - 1)}
    own = dict(items)
    want = {(q, w) for q in asked for w, n in items
            if n > own.get(q, 0) and w != q and distance(q, w) <= 2 and grams(q) & grams(w)}
    queries = sg.Asked.of(spark.createDataFrame([(q,) for q in asked], "query string"))
    rows = sg._close(spark.createDataFrame(items, "_key string, freq2 long"), queries,
                     queries.queries).collect()
    assert {(r["query"], r["_key"]) for r in rows} == want and len(rows) == len(want)


def test_long_texts_that_are_close(spark):
    base = "a long search string that nobody would type by hand more than once " * 2
    near = [base, base[1:], base[:50] + "X" + base[52:], "Y" + base + "Z", base[:-2]]
    far = [base[3:], base + "123", base.replace("long", "short")]
    items = spark.createDataFrame([(t, 5) for t in near + far], "_key string, freq2 long")
    for few in (True, False):
        queries = spark.createDataFrame([(base[:20] + "q" + base[20:],)], "query string")
        got = sg._close(items, sg.Asked(queries, few), queries).collect()
        found = {r["_key"] for r in got}
        assert {base, base[1:]} <= found and not found & set(far)


def test_close_long_texts_equal_brute_force(spark):
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh ") for _ in range(130))

    def edited(text, times):
        for _ in range(times):
            at = rng.randint(0, len(text))
            text = rng.choice([text[:at] + "z" + text[at:], text[:at] + text[at + 1:],
                               text[:at] + "y" + text[at + 1:]])
        return text

    items = sorted({edited(base, rng.randint(0, 4)) for _ in range(60)})
    offered = spark.createDataFrame([(t, 5) for t in items], "_key string, freq2 long")
    queries = spark.createDataFrame([(base + "!",), (edited(base, 1),)], "query string").distinct()
    got = sg._close(offered, sg.Asked(queries, True), queries).collect()
    want = offered.crossJoin(queries).filter("_key != query and levenshtein(_key, query) <= 2") \
        .collect()
    assert {(r["query"], r["_key"]) for r in got} == {(r["query"], r["_key"]) for r in want}
    assert {len(r["_key"]) > 128 for r in got} == {True, False} or len(got) > 10


def test_stored_keys_are_three_an_item_and_serve_alike(spark):
    rng = random.Random(11)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(1, 14))) for _ in range(150)})
    items = spark.createDataFrame([(w, 2) for w in words], "_key string, freq2 long")
    keys = sg.close_keys(items)
    assert keys.groupBy("_key").count().agg(F.max("count")).head()[0] <= 3
    queries = items.select(F.expr("substring(_key, 2)").alias("query")).filter("query <> ''").distinct()
    for few in (True, False):
        asked = sg.Asked(queries, few)
        made = {tuple(r) for r in sg._close(items, asked, queries).collect()}
        assert made == {tuple(r) for r in sg._close(items, asked, queries, keys).collect()} and made


def test_batch_equals_single(spark, hundred):
    texts = ["sea", "search", "serch"]
    queries = spark.createDataFrame([(t,) for t in texts + ["en"]], "query string")
    batch = sg.suggest_batch(*hundred, queries, sg.TYPES).collect()
    for text in texts:
        single = sg.suggest(*hundred, text, sg.TYPES).collect()
        assert sorted(map(tuple, single)) == sorted(tuple(r) for r in batch if r["query"] == text)
    top = sg.suggest_batch(*hundred, queries, sg.TYPES, top=1).collect()
    assert {(r["query"], r["type"]): r["_key"] for r in top}["sea", "complete"] == "search"
    assert all(r["rank"] == 1 for r in top)


def random_log(n=2000, seed=3):
    """Half of all events belong to one sequence."""
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.5 else f"s{rng.randint(1, 20)}", i * 7,
             rng.choice("abcdefgh"), "submit" if rng.random() < 0.2 else "") for i in range(n)]
    return event_rows(rows)


def next_submits(rows, seconds):
    pairs, later = {}, {}
    for _id, sequence, time, item, kind in reversed(rows):
        if sequence in later:
            post, at = later[sequence]
            if 0 <= (at - time).total_seconds() <= seconds:
                counts = pairs.setdefault((item, post), [0, 0])
                counts[kind == "submit"] += 1
        if kind == "submit":
            later[sequence] = (item, time)
    return {key: tuple(v) for key, v in pairs.items()}


def counts(df):
    return {(r["pre"], r["post"]): (r["freq0"], r["freq1"]) for r in df.collect()}


@pytest.mark.parametrize("chunk_rows, share", [(1_000_000, 0.001), (10, 0.001), (3, 0.3), (1, 0.3)])
def test_pairs_of_hot_sequences(spark, chunk_rows, share):
    rows = random_log()
    events = spark.createDataFrame(rows, EVENT_SCHEMA)
    assert counts(sg.event_pairs(events, 60, chunk_rows, share)) == next_submits(rows, 60)


def test_last_events(spark):
    rows = random_log()
    got = sg.last_events(spark.createDataFrame(rows, EVENT_SCHEMA), 3).collect()
    want = {}
    for row in rows:
        want.setdefault(row[1], []).append(row[0])
    assert {(r["sequence"], r["_id"]) for r in got} == {
        (s, i) for s, all_ids in want.items() for i in all_ids[-3:]}


def test_sequence_table(spark):
    rows = random_log(300)
    got = sg.sequence_table(spark.createDataFrame(rows, EVENT_SCHEMA), 4).collect()
    want = {}
    for row in rows:
        want.setdefault(row[1], []).append(row[0])
    assert {r["_key"]: r["events"] for r in got} == {s: i[-4:] for s, i in want.items()}


def stream_of(spark, rows, parts):
    """The rows as a file stream of one file per part, read one file per batch."""
    path = scratch_path(spark, "stream")
    size = -(-len(rows) // parts)
    for i in range(parts):
        spark.createDataFrame(rows[i * size:(i + 1) * size], EVENT_SCHEMA).coalesce(1) \
            .write.mode("append").parquet(path)
    return lambda: spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path), path


@pytest.mark.parametrize("delay", [0, 50])
def test_stream_pairs(spark, delay):
    rows = random_log(400)
    stream, _ = stream_of(spark, rows, 3)
    learner = PairLearner(spark, scratch_path(spark, "pairs"), 60, delay, chunk_rows=10)
    learner.start(stream(), scratch_path(spark, "checkpoint")).awaitTermination()
    got = counts(learner.pairs())
    assert learner.late().count() == 0
    if delay == 0:
        assert got == next_submits(rows, 60)
    else:
        # Pairs whose submit the watermark has not passed are still open.
        sealed = rows[-1][2].timestamp() - delay
        closed = [r for r in rows if r[2].timestamp() <= sealed]
        assert got == next_submits(closed, 60)


def test_stream_batch_can_be_repeated(spark):
    rows = random_log(300)
    df = spark.createDataFrame(rows, EVENT_SCHEMA)
    learner = PairLearner(spark, scratch_path(spark, "pairs"), 60)
    for batch, (low, high) in enumerate([(0, 100), (100, 200), (200, 300)]):
        part = df.filter((C("_id") > low) & (C("_id") <= high))
        learner.process(part, batch)
        learner.process(part, batch)
    assert counts(learner.pairs()) == next_submits(rows, 60)
    learner.process(df.filter(C("_id") == 5), 3)
    assert [r["_id"] for r in learner.late().collect()] == [5]
    assert counts(learner.pairs()) == next_submits(rows, 60)


def test_stream_item_stats(spark):
    rows = random_log(300)
    stream, path = stream_of(spark, rows, 3)
    updates, checkpoint = scratch_path(spark, "updates"), scratch_path(spark, "checkpoint")
    start_item_stats(stream(), updates, checkpoint).awaitTermination()
    want = lambda: {tuple(r) for r in sg.item_stats(spark.read.parquet(path)).collect()}
    assert {tuple(r) for r in read_item_stats(spark, updates).collect()} == want()
    spark.createDataFrame([(999, "x", rows[0][2], "new", "submit")], EVENT_SCHEMA) \
        .write.mode("append").parquet(path)
    start_item_stats(stream(), updates, checkpoint).awaitTermination()
    got = {tuple(r) for r in read_item_stats(spark, updates).collect()}
    assert got == want() and len(got) == 9


def named_items(spark, seed, n):
    rng = random.Random(seed)
    rows = [("".join(rng.choice("ab c") for _ in range(rng.randint(1, 7))), rng.randint(0, 9),
             rng.choice([None, 0, 5]), rng.choice([None, [], ["ba", "", "ab c"]])) for _ in range(n)]
    rows = list({r[0]: r for r in rows}.values())
    return rows, spark.createDataFrame(
        rows, "_key string, freq2 long, boost int, kana array<string>").withColumn("freq", C("freq2") + 3)


def best_prefixes(rows, best, longest):
    lists = {}
    for key, freq2, boost, kana in rows:
        if freq2 > 0:
            for start in {n[:i] for n in [key, *(kana or [])] for i in range(1, min(len(n), longest) + 1)}:
                lists.setdefault(start, []).append((-(freq2 + (boost or 0)), key, freq2))
    return {(start, key, freq2, place) for start, found in lists.items()
            for place, (_, key, freq2) in enumerate(sorted(found)[:best + 1], 1)}


@pytest.mark.parametrize("best, longest", [(2, 4), (50, 32)])
def test_prefix_table_follows_items(spark, tmp_path, best, longest):
    rows, items = named_items(spark, 3, 120)
    store = PrefixStore(spark, str(tmp_path / "prefixes"), best, longest, buckets=5)
    got = lambda: {(r["query"], r["_key"], r["freq2"], r["place"]) for r in store.rows().collect()}
    store.build(items)
    assert got() == best_prefixes(rows, best, longest)
    grown = [("abba", 7, 5, ["ab c"]), ("zz", 1, None, None)] + [
        (k, f + 4, b, n) for k, f, b, n in rows[:9]]
    changed = spark.createDataFrame(grown, "_key string, freq2 long, boost int, kana array<string>")
    want = best_prefixes(list({r[0]: r for r in rows + grown}.values()), best, longest)
    for _ in range(2):  # the same change given again
        store.merge(changed)
        assert got() == want
    store.merge(changed.filter("false"))
    assert got() == want
    one = store.rows(spark.createDataFrame([("zz",), (None,)], "query string"))
    assert [r["_key"] for r in one.collect()] == ["zz"]
    with pytest.raises(ValueError):
        merge_prefixes(prefix_table(items, best), changed.withColumn("freq2", F.lit(0) + 1), best)


@pytest.mark.parametrize("prefix_search", [None, True])
@pytest.mark.parametrize("top", [None, 3])
def test_stored_prefixes_serve_alike(spark, tmp_path, prefix_search, top):
    _, items = named_items(spark, 4, 150)
    pairs = spark.createDataFrame([("ab", "c", 12, 0, 0), ("a", "zz", 4, 0, 0)],
                                  "pre string, post string, freq0 long, freq1 long, freq2 long")
    asked = spark.createDataFrame([(q,) for q in ["a", "ab", "b", "c", "ab c", "abcab", "x", ""]],
                                  "query string")
    store = PrefixStore(spark, str(tmp_path / "prefixes"), 4, 3, buckets=3)
    store.build(items)
    for threshold in (1, 8):
        run = lambda **stored: sorted(map(tuple, sg.suggest_batch(
            items, pairs, asked, ("complete",), top, threshold, prefix_search=prefix_search,
            **stored).collect()))
        assert run(prefixes=store) == run()


def test_empty_prefix_table(spark, tmp_path):
    _, items = named_items(spark, 4, 20)
    assert prefix_table(items.filter("false")).count() == 0
    assert merge_prefixes(prefix_table(items.filter("false")), items, 9).count() > 0


def test_item_counters_from_the_state(spark):
    """One row an item after every batch and after a restart, with null items and no update files."""
    rows = random_log(300) + [(998, "y", None, None, "")]
    stream, path = stream_of(spark, rows, 3)
    updates, checkpoint = scratch_path(spark, "updates"), scratch_path(spark, "checkpoint")
    want = lambda: sorted((tuple(r) for r in sg.item_stats(spark.read.parquet(path)).collect()), key=str)
    got = lambda *at: sorted((tuple(r) for r in current_item_stats(spark, checkpoint, *at).collect()), key=str)
    start_item_stats(stream(), updates, checkpoint).awaitTermination()
    before = want()
    assert got() == before
    spark.createDataFrame([(999, "x", rows[0][2], "new", "submit")], EVENT_SCHEMA) \
        .write.mode("append").parquet(path)
    last = spark.read.parquet(updates).agg(F.max("batch")).head()[0]
    start_item_stats(stream(), updates, checkpoint).awaitTermination()
    assert got() == want() != before
    assert got(last) == before
