"""Stored tables cost what a change touches, and their indexes follow."""

import random
import uuid
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from seekframe import schema as sc
from seekframe.operators import index as ix
from seekframe.operators import search, select
from seekframe.sources.store import TableStore

NOTES = sc.declare({"title": sc.Field(), "body": sc.Field("Text"), "n": sc.Field("Int32")})
ROWS = "_key string, title string, body string, n int"


def notes(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def files(store, name):
    """Data files of a table by bucket folder, with the time they were written."""
    found = {}
    for path in Path(store.path(name)).rglob("*.parquet"):
        found.setdefault(path.parent.name, set()).add((path.name, path.stat().st_mtime_ns))
    return found


def changed_buckets(before, after):
    return {b for b in before.keys() | after.keys() if before.get(b) != after.get(b)}


@pytest.fixture
def filled(spark, tmp_path):
    store, name = TableStore(spark, str(tmp_path)), f"notes_{uuid.uuid4().hex}"
    store.create_all({name: NOTES}, buckets=16)
    store.load(name, notes(spark, [(f"k{i}", f"title {i}", f"some body {i % 7}", i) for i in range(200)]))
    return store, name


def rows_of(store, name):
    return {r["_key"]: (r["_id"], r["title"], r["body"], r["n"]) for r in store.scan(name).collect()}


def bucket_of(spark, key):
    return f"_bucket={spark.sql(f'SELECT pmod(xxhash64({key!r}), 16L) AS b').head()[0]}"


def test_changes_rewrite_only_the_buckets_they_touch(spark, filled):
    store, name = filled
    start = files(store, name)
    assert len(start) == 16
    before = rows_of(store, name)
    store.load(name, notes(spark, [("k5", "new", "words", 1), ("k200", None, "late", 2)]))
    after = files(store, name)
    assert changed_buckets(start, after) == {bucket_of(spark, "k5"), bucket_of(spark, "k200")}
    got = rows_of(store, name)
    assert got["k5"] == (before["k5"][0], "new", "words", 1) and got["k200"] == (201, "", "late", 2)
    assert {k: v for k, v in got.items() if k in before and k != "k5"} == \
        {k: v for k, v in before.items() if k != "k5"}

    assert store.delete(name, key=["k7", "k8"]) and not store.delete(name, key="none")
    last = files(store, name)
    assert changed_buckets(after, last) == {bucket_of(spark, "k7"), bucket_of(spark, "k8")}

    edited = store.scan(name).withColumn("n", F.when(F.col("_key") == "k9", -1).otherwise(F.col("n")))
    assert store.commit_changed(name, edited) == 1
    assert changed_buckets(last, files(store, name)) == {bucket_of(spark, "k9")}
    assert rows_of(store, name)["k9"][3] == -1
    assert store.delete(name, id=str(before["k11"][0])) and "k11" not in rows_of(store, name)


def test_ids_go_on_from_the_footers(spark, filled):
    store, name = filled
    assert store._next_id(name) == 201
    store.delete(name, key="k1")
    store.load(name, notes(spark, [("fresh", "a", "b", 0)]))
    assert rows_of(store, name)["fresh"][0] == 201
    plan = spark.conf.get("spark.sql.parquet.aggregatePushdown")
    assert plan == "false"  # the setting is put back


def test_a_bucket_may_become_empty_and_fill_again(spark, tmp_path):
    store, name = TableStore(spark, str(tmp_path)), f"few_{uuid.uuid4().hex}"
    store.create_all({name: NOTES}, buckets=4)
    store.load(name, notes(spark, [("a", "x", "", 1), ("b", "y", "", 2)]))
    assert store.delete(name, where=F.col("n") > 0) and store.scan(name).isEmpty()
    spark.sql(f"DROP TABLE {name}")
    again = TableStore(spark, str(tmp_path))
    again.create_all({name: NOTES})  # without rows there is nothing left to open
    assert again.scan(name).isEmpty() and again.scan(name).columns == NOTES.names
    again.load(name, notes(spark, [("a", "z", "", 5)]))
    assert rows_of(again, name) == {"a": (1, "z", "", 5)}


def test_a_truncated_table_is_created_anew_and_other_files_stay(spark, tmp_path):
    store, name = TableStore(spark, str(tmp_path)), f"few_{uuid.uuid4().hex}"
    store.create_all({name: NOTES}, buckets=4)
    store.load(name, notes(spark, [("a", "x", "", 1)]))
    store.truncate(name)
    spark.sql(f"DROP TABLE {name}")
    again = TableStore(spark, str(tmp_path))
    assert again.create_all({name: NOTES}, buckets=2) == [name]
    again.load(name, notes(spark, [("b", "z", "", 5)]))
    assert rows_of(again, name) == {"b": (1, "z", "", 5)}

    other = f"other_{uuid.uuid4().hex}"
    spark.range(3).write.parquet(again.path(other))
    with pytest.raises(AnalysisException):
        again.create_all({other: NOTES})
    assert spark.read.parquet(again.path(other)).count() == 3


def test_staged_batches_of_different_columns_are_one_load(spark, filled):
    store, name = filled
    staged = store.staged(name)
    staged.load(spark.createDataFrame([("k1", "first"), ("n1", "one")], "_key string, title string"))
    staged.load(spark.createDataFrame([("k1", 50), ("n1", None), ("n2", 9)], "_key string, n int"))
    staged.load(spark.createDataFrame([("k1", "last")], "_key string, title string"))
    start = files(store, name)
    assert staged.commit() == 6
    got = rows_of(store, name)
    assert got["k1"] == (2, "last", "some body 1", 50)
    assert got["n1"] == (201, "one", "", 0) and got["n2"] == (202, "", "", 9)
    touched = {bucket_of(spark, k) for k in ("k1", "n1", "n2")}
    assert changed_buckets(start, files(store, name)) == touched


def test_tables_without_key_are_dealt_by_id(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("seekframe.sources.store.BLOCK", 8)
    store, name = TableStore(spark, str(tmp_path)), f"log_{uuid.uuid4().hex}"
    store.create_all({name: sc.declare({"n": sc.Field("Int32")}, key=None)})
    for start in (0, 15):
        store.load(name, spark.range(start, start + 15).selectExpr("CAST(id AS INT) AS n", "id AS at"), "at")
    before = files(store, name)
    assert len(before) == 4
    assert store.delete(name, id=9)
    assert changed_buckets(before, files(store, name)) == {"_bucket=1"}
    assert sorted(r["n"] for r in store.scan(name).collect()) == [n for n in range(30) if n != 8]


def test_truncate_leaves_other_tables(spark, filled):
    store, name = filled
    other = f"other_{uuid.uuid4().hex}"
    store.create_all({other: sc.declare({"note": sc.Field(ref=name)})})
    store.load(other, spark.createDataFrame([("o", "k1")], "_key string, note string"))
    index = store.index(name, ["body"])
    store.truncate(name)
    assert store.scan(name).isEmpty() and store.scan(other).count() == 1
    assert index.match(["some"]).isEmpty()
    store.load(name, notes(spark, [("k", "t", "some", 1)]))
    assert rows_of(store, name)["k"][0] == 1 and index.match(["some"]).count() == 1


# --- indexes ------------------------------------------------------------------------------------

def scanned(store, name, terms):
    """Scores from postings made anew over the whole table."""
    fresh = ix.build_postings(store.scan(name), "_id", ["body"])
    return {r["_id"]: r["_score"] for r in ix.match_terms(fresh, "_id", terms).collect()}


def looked_up(index, terms):
    return {r["_id"]: r["_score"] for r in index.match(terms).collect()}


def test_an_index_follows_loads_deletes_and_commits(spark, filled):
    store, name = filled
    index = store.index(name, ["body"])
    terms = ["some", "body", "fresh", "3", "words"]
    assert looked_up(index, terms) == scanned(store, name, terms)
    draw = random.Random(4)
    for turn in range(4):
        store.load(name, notes(spark, [(f"k{draw.randrange(230)}", "t", draw.choice(
            ["fresh words", "some fresh fresh", "body 3", ""]), turn) for _ in range(20)]))
        store.delete(name, key=f"k{draw.randrange(200)}")
        assert looked_up(index, terms) == scanned(store, name, terms)
    edited = store.scan(name).withColumn("body", F.when(F.col("n") % 5 == 0, "words").otherwise(F.col("body")))
    store.commit_changed(name, edited)
    store.delete(name, where=F.col("n") == 3)
    assert looked_up(index, terms) == scanned(store, name, terms)
    fresh = ix.build_postings(store.scan(name), "_id", ["body"])
    assert {r["_id"] for r in index.phrase("Some fresh").collect()} == {
        r["_id"] for r in ix.match_phrase(fresh, "_id", ["some", "fresh"]).collect()}
    index.compact()
    assert index._stored("marks", index.marks).isEmpty()
    assert looked_up(index, terms) == scanned(store, name, terms)


def test_unchanged_records_are_not_cut_again(spark, filled):
    store, name = filled
    index = store.index(name, ["body"])
    stored = index._stored("postings", index.schema)
    count = stored.count()
    # The same body under a new title, one new body: only that is posted.
    store.load(name, notes(spark, [("k1", "other", "some body 1", 5), ("k2", "t", "two words", 5)]))
    added = index._stored("postings", index.schema).filter("_generation > 1")
    assert {r["token"] for r in added.collect()} == {"two", "words"}
    assert index._stored("postings", index.schema).count() == count + 2


def test_an_index_is_opened_again_and_compacted_by_bucket(spark, filled, tmp_path):
    store, name = filled
    store.index(name, ["title", "body"]).match(["title"]).count()
    other = TableStore(spark, str(tmp_path))
    index = other.index(name, ["title", "body"])
    other.load(name, notes(spark, [(f"k{i}", "title x", "other", 1) for i in range(50)]))
    buckets = sorted({r[0] for r in index._stored("postings", index.schema).select("_bucket").collect()})
    index.compact(buckets[:3])
    assert index.match(["title"]).count() == 200 and index.match(["other"]).count() == 50
    assert {r["section"] for r in index.postings(["title"]).collect()} == {1}
    before = index._stored("postings", index.schema).count()
    index.compact()
    assert index._stored("postings", index.schema).count() < before
    assert index.match(["title", "other"], require_all=True).count() == 50


def test_a_change_that_was_lost_halfway_is_given_again(spark, filled, monkeypatch):
    store, name = filled
    index = store.index(name, ["body"])
    monkeypatch.setattr(store, "_write", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.load(name, notes(spark, [("k3", "t", "lost words", 1), ("x1", "t", "lost", 1)]))
    monkeypatch.undo()
    store.load(name, notes(spark, [("x2", "t", "found", 1), ("k3", "t", "some words", 1)]))
    terms = ["some", "lost", "found", "words"]
    assert looked_up(index, terms) == scanned(store, name, terms)


def test_a_lookup_opens_the_buckets_of_its_terms(spark, filled):
    store, name = filled
    index = store.index(name, ["body"], buckets=32)
    plan = index.postings(["some"])._jdf.queryExecution().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line and "_bucket" in line]
    assert scans and "token" in plan.split("PushedFilters")[1]


def test_searches_through_an_index(spark, filled):
    store, name = filled
    store.load(name, notes(spark, [("p1", "red fox", "the quick red fox", 1), ("p2", "fox", "red. the fox", 2),
                                   ("p3", "", "quick fox runs far from the red one", 3)]))
    index = store.index(name, {"title": 10, "body": 3})
    keys = dict(store.scan(name).select("_id", "_key").collect())
    got = lambda df: {keys[r[0]]: r[1] for r in df.collect()}
    assert got(index.search(["red fox"])) == {"p1": 13}
    assert got(index.search(["Fox", "far from"])) == {"p1": 13, "p2": 13, "p3": 6}
    assert got(index.near("red fox", 3)) == {"p1": 1, "p2": 3}
    assert got(index.near("fox", 3)) == {"p1": 0, "p2": 0, "p3": 0}
    assert got(index.near("red nowhere", 9)) == {} == got(index.search(["nowhere at all"]))
    found = select.search(store.scan(name), F.col("n") > 1, query=["fox"], index=index,
                          sort_by=["-_score"], output_columns=["_key", "_score"], drilldown=["title"],
                          facet_options={"sort_by": ["-_key"], "limit": 1, "output_columns": ["_key"]})
    assert [tuple(r) for r in found.page.collect()] == [("p2", 13), ("p3", 3)]
    assert found.total.head()[0] == 2 and [r[0] for r in found.facets["title"].collect()] == ["fox"]


def test_near_from_postings_equals_near_on_texts(spark):
    draw = random.Random(8)
    rows = [(i, " ".join(draw.choices(["a", "b", "c", "bird", "fly", "x,y"], k=draw.randint(0, 30))))
            for i in range(120)]
    df = spark.createDataFrame(rows, "_id long, body string")
    postings = ix.build_postings(df, "_id", ["body"])
    for text in ("a b", "a b c", "bird", "x,y fly a"):
        terms = [ix.phrase_tokens(df, t, "TokenBigram") for t in text.split()]
        want = {(r["_id"], r["_span"]) for r in search.near(df, "body", text, 6).collect()}
        assert {tuple(r) for r in ix.near(postings, "_id", terms, 6).collect()} == want and want


def test_escalation_follows_the_table(spark, filled):
    store, name = filled
    index = store.index(name, ["body"])
    assert not index.has_lexicon()
    store.load(name, notes(spark, [("q1", "t", "a cat", 1), ("q2", "t", "cats", 1), ("q3", None, None, 1)]))
    index.keep_lexicon().keep_lexicon()
    store.load(name, notes(spark, [("q2", "t", "a dog", 1), ("q4", "t", "concatenate", 1),
                                   ("q5", "t", "catalogue of a\tcat", 1)]))
    store.delete(name, key="q1")
    for term, threshold in [("Cat", 0), ("cat", 1), ("cat", 5), ("a cat", 0), ("cats", 0), ("og", 3)]:
        want = search.match_escalation(store.scan(name), "body", term, threshold)
        got = index.escalate(store.scan(name), term, threshold)
        assert sorted(map(tuple, got.collect())) == sorted((r["_id"], r["_tier"]) for r in want.collect())
    with pytest.raises(ValueError):
        store.index(name, ["title", "body"]).escalate(store.scan(name), "cat", 0)
