import uuid

import pytest
from conftest import ids
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe import schema as sc
from seekframe.operators import index, mutate, refs, skew
from seekframe.operators.rows import assign_row_id
from seekframe.operators.skew import best_of_key, hot_hashes, join_lookup
from seekframe.session import scratch_path
from seekframe.sources.json_records import read_records, write_records
from seekframe.sources.store import TableStore

C = F.col
SMALL = sc.declare({"name": sc.Field()})
ROWS = "_key string, name string"


def table(df):
    return sorted((r["_id"], r["_key"], r["name"]) for r in df.collect())


@pytest.fixture
def small(spark):
    # Rows whose results the goldens of loads and deletes are stated for.
    return spark.createDataFrame([(1, "key1", "foo"), (2, "key2", "bar"), (3, "key3", "baz")],
                                 "_id long, _key string, name string")


def test_declared_schema():
    made = sc.declare({"n": sc.Field("UInt8"), "tags": sc.Field("ShortText", vector=True, ref="tag"),
                       "big": sc.Field("UInt64"), "ring": sc.Field("Int64", last=3)})
    assert made.names == ["_id", "_key", "n", "tags", "big", "ring"]
    assert made["n"].dataType == T.ShortType()
    assert made["tags"].dataType == T.ArrayType(T.StringType())
    assert made["tags"].metadata["ref"] == "tag"
    assert made["big"].dataType == T.DecimalType(20, 0)
    assert made["ring"].metadata["last"] == 3
    assert "_key" not in sc.declare({}, key=None).names
    with pytest.raises(ValueError):
        sc.declare({"_score": sc.Field()})


def test_unknown_columns_are_rejected(spark, small):
    with pytest.raises(ValueError):
        sc.conform(small.withColumn("other", F.lit(1)), SMALL)
    with pytest.raises(ValueError):
        mutate.upsert(small, spark.createDataFrame([("key1", 1)], "_key string, other int"))


def test_defaults(spark):
    df = spark.createDataFrame([(None, None, None, None, None)],
                               "s string, n int, b boolean, v array<string>, d double")
    assert tuple(sc.fill_defaults(df).head()) == ("", 0, False, [], 0.0)


def test_upsert(spark, small):
    incoming = spark.createDataFrame(
        [("key9", "nine", 1), ("key2", "old", 2), ("key2", "new", 3), ("key7", None, 0)],
        ROWS + ", at long")
    assert table(mutate.upsert(small, incoming, arrival="at")) == [
        (1, "key1", "foo"), (2, "key2", "new"), (3, "key3", "baz"), (4, "key7", ""),
        (5, "key9", "nine")]


def test_upsert_keeps_columns_not_given(spark, small):
    wide = small.withColumn("n", C("_id").cast("int"))
    got = mutate.upsert(wide, spark.createDataFrame([("key2", 9), ("key4", 8)], "_key string, n int"))
    assert sorted((r["_key"], r["name"], r["n"]) for r in got.collect()) == [
        ("key1", "foo", 1), ("key2", "bar", 9), ("key3", "baz", 3), ("key4", "", 8)]


def test_load_same_keys_again(spark):
    empty = spark.createDataFrame([], SMALL)
    first = spark.createDataFrame([(f"key{i}", f"name{i}") for i in range(1, 6)], ROWS)
    once = mutate.upsert(empty, first)
    assert table(once) == [(i, f"key{i}", f"name{i}") for i in range(1, 6)]
    again = mutate.upsert(once, first.withColumn("name", F.concat("name", F.lit("!"))))
    assert table(again) == [(i, f"key{i}", f"name{i}!") for i in range(1, 6)]


def test_staged_load(spark):
    empty = spark.createDataFrame([], SMALL)
    first = spark.createDataFrame([(f"key{i}", "a") for i in range(1, 4)], ROWS)
    second = spark.createDataFrame([(f"key{i}", "b") for i in range(3, 8)], ROWS)
    load = mutate.StagedLoad(empty).load(first).load(second)
    assert table(load.commit()) == [(1, "key1", "a"), (2, "key2", "a")] + [
        (i, f"key{i}", "b") for i in range(3, 8)]
    for end in (load.commit, load.rollback, lambda: load.load(first)):
        with pytest.raises(ValueError):
            end()
    dropped = mutate.StagedLoad(empty).load(first)
    assert dropped.rollback().count() == 0
    with pytest.raises(ValueError):
        dropped.commit()


def test_delete(spark, small):
    assert ids(mutate.delete(small, key="key2")) == [1, 3]
    assert ids(mutate.delete(small, key=["key2", "key3"])) == [1]
    assert sorted(ids(mutate.delete(small, key=small.filter("_id > 1")))) == [1]
    assert ids(mutate.delete(small, id="3")) == [1, 2]
    assert ids(mutate.delete(small, where=C("name").startswith("ba"))) == [1]
    assert mutate.deletes_any(small, key="key2") and not mutate.deletes_any(small, key="key4")
    for wrong in ({"key": "key1", "id": 1}, {}, {"id": 1, "where": C("_id") == 1}):
        with pytest.raises(ValueError):
            mutate.delete(small, **wrong)
    unknown = small.withColumn("name", F.lit(None).cast("string"))
    assert len(ids(mutate.delete(unknown, where=C("name") == "foo"))) == 3


def test_commit_changed(small):
    edited = small.withColumn("name", F.when(C("_id") == 2, F.lit("BAR")).otherwise(C("name")))
    assert mutate.changed_rows(edited, small).count() == 1
    assert mutate.changed_rows(small, small).count() == 0
    assert table(mutate.commit_changed(edited, small))[1] == (2, "key2", "BAR")


def test_store(spark):
    name = f"small_{uuid.uuid4().hex[:8]}"
    log = f"log_{uuid.uuid4().hex[:8]}"
    store = TableStore(spark, scratch_path(spark, "store"))
    plain = sc.declare({"n": sc.Field("Int32")}, key=None)
    assert store.create_all({name: SMALL, log: plain}) == [name, log]
    assert store.create_all({name: SMALL, log: plain}) == []
    rows = spark.createDataFrame([("key1", "foo"), ("key2", "bar"), ("key3", "baz")], ROWS)
    assert store.load(name, rows) == 3
    assert table(store.scan(name)) == [(1, "key1", "foo"), (2, "key2", "bar"), (3, "key3", "baz")]
    assert store.delete(name, key="key2") and not store.delete(name, key="key4")
    with pytest.raises(ValueError):
        store.delete(name, key="key1", id=1)
    staged = store.staged(name).load(rows)
    staged.rollback()
    assert store.scan(name).count() == 2
    store.staged(name).load(rows).commit()
    assert table(store.scan(name)) == [(1, "key1", "foo"), (3, "key3", "baz"), (4, "key2", "bar")]
    edited = store.scan(name).withColumn("name", F.upper("name"))
    assert store.commit_changed(name, edited) == 3
    assert store.commit_changed(name, store.scan(name)) == 0
    assert table(store.scan(name))[0] == (1, "key1", "FOO")
    numbers = spark.createDataFrame([(5,), (6,)], "n int")
    assert store.load(log, numbers) == 2 and store.load(log, numbers) == 2
    assert sorted(ids(store.scan(log))) == [1, 2, 3, 4]
    store.truncate(name)
    assert store.scan(name).count() == 0 and store.scan(log).count() == 4
    assert store.scan(name).schema["_key"].metadata == {"key": True}


def test_json_records(spark, small):
    path = scratch_path(spark, "records")
    write_records(small, path)
    back = read_records(spark, path, SMALL)
    assert back.columns == ["_key", "name"] and back.count() == 3


def test_event_records(spark, tmp_path):
    """An array of events with fractional epoch seconds; absent fields take defaults on load."""
    (tmp_path / "events.json").write_text("""[
        {"sequence": "1", "time": 1312950803.86057, "item": "e"},
        {"sequence": "1", "time": 1312950805.5, "item": "engine", "type": "submit", "_id": 9}]""")
    events = sc.declare({"sequence": sc.Field(), "time": sc.Field("Time"), "item": sc.Field(),
                         "type": sc.Field()}, key=None)
    rows = read_records(spark, str(tmp_path), events, array=True)
    micros = [r[0] for r in rows.select(F.unix_micros("time")).collect()]
    assert micros == [1312950803860570, 1312950805500000]
    assert [r["type"] for r in sc.fill_defaults(rows).collect()] == ["", "submit"]
    path = scratch_path(spark, "records")
    write_records(rows, path)
    assert read_records(spark, path, events).exceptAll(rows).isEmpty()


def test_row_ids_are_dense(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        (C("id") % 3).alias("k"), C("id").alias("v"))
    got = assign_row_id(df, [C("k")], start=10).orderBy("_id").collect()
    assert [r["_id"] for r in got] == list(range(10, 5010))
    assert [r["k"] for r in got] == sorted(r["k"] for r in got)
    plain = assign_row_id(spark.range(0, 1000, numPartitions=5)).orderBy("_id").collect()
    assert [(r["_id"], r["id"]) for r in plain] == [(i + 1, i) for i in range(1000)]
    # Half of the rows share one key: they still come from several tasks.
    hot = spark.range(0, 40000, numPartitions=4).select(F.when(C("id") % 2 == 0, 0).otherwise(C("id")).alias("k"))
    ranked = assign_row_id(hot, [C("k")])
    assert ranked.agg(F.max("_id"), F.count_distinct("_id")).head() == (40000, 40000)


def test_references(spark):
    target = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "_id long, _key string, n int")
    rows = spark.createDataFrame([(1, "b"), (2, "c"), (3, "c"), (4, "a"), (5, "d"), (6, None)],
                                 "_id long, ref string")
    grown = refs.create_missing(rows, "ref", target, order_col="_id")
    assert sorted(tuple(r) for r in grown.collect()) == [
        (1, "a", 5), (2, "b", 6), (3, "c", 0), (4, "d", 0)]
    looked = refs.lookup(rows, target, "ref", "_key", {"n": "value"})
    assert {r["_id"]: r["value"] for r in looked.collect()} == {
        1: 6, 2: None, 3: None, 4: 5, 5: None, 6: None}
    facets = refs.drilldown_ref(rows.filter("ref is not null"), "ref", target, "_key", "n")
    assert {(r["_key"], r["_nsubrecs"], r["n"]) for r in facets.collect()} == {
        ("a", 1, 5), ("b", 1, 6), ("c", 2, None), ("d", 1, None)}
    vectors = spark.createDataFrame([(1, ["b", "x", "a"]), (2, [])], "_id long, v array<string>")
    found = refs.lookup_vector(vectors, target, "_id", "v", "_key", "n", "ns")
    assert {r["_id"]: r["ns"] for r in found.collect()} == {1: [6, None, 5], 2: []}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    big = spark.range(0, 3000).select(
        C("id"), F.when(C("id") % 3 == 0, F.lit(0)).otherwise(C("id") % 50).alias("k"))
    small = spark.range(0, 40).select(C("id").alias("k"), (C("id") * 2).alias("w"))
    plain = sorted(tuple(r) for r in big.join(small, "k", how).collect())
    salted = join_lookup(big, small, "k", how, broadcast_rows=10, part_rows=200)
    assert sorted(tuple(r) for r in salted.collect()) == plain


def test_hot_keys(spark):
    df = spark.range(0, 3000).select(
        F.when(C("id") % 3 == 0, F.lit(-1)).otherwise(C("id")).alias("k"))
    place = df.select(F.xxhash64(F.lit(-1).cast("long"))).head()[0]
    assert [(r["_place"], r["_rows"]) for r in hot_hashes(df, "k", 0.1).collect()] == [(place, 1000)]
    assert hot_hashes(df.select(F.nullif("k", F.lit(-1)).alias("k")), "k", 0.1).count() == 1


def test_best_of_key_beyond_the_window_limit(spark, monkeypatch):
    monkeypatch.setattr(skew, "WINDOW_LIMIT", 5)
    monkeypatch.setattr(skew, "PART_ROWS", 100)
    rows = spark.range(3000).select(
        "id", F.when(C("id") % 3 != 0, C("id") % 40).alias("k"), F.lit("x").alias("g"))
    got = best_of_key(rows, ["k", "g"], [F.desc("id")], 7, "n")
    assert "_part" in got._jdf.queryExecution().toString()
    want = {}
    for i in sorted(range(3000), reverse=True):
        want.setdefault(i % 40 if i % 3 else None, []).append(i)
    assert {(r["k"], r["n"], r["id"]) for r in got.collect()} == {
        (k, n, i) for k, ids in want.items() for n, i in enumerate(ids[:7], 1)}


def test_store_is_found_again(spark, tmp_path):
    store, name = TableStore(spark, str(tmp_path)), f"kept_{uuid.uuid4().hex}"
    assert store.create_all({name: SMALL}) == [name]
    store.load(name, spark.createDataFrame([("a", "x"), ("b", "y")], ROWS))
    store.delete(name, key="a")
    spark.sql(f"DROP TABLE {name}")  # what another application's catalog knows of it
    other = TableStore(spark, str(tmp_path))
    assert other.create_all({name: SMALL}) == []
    assert table(other.scan(name)) == [(2, "b", "y")]
    other.load(name, spark.createDataFrame([("c", "z")], ROWS))
    assert table(other.scan(name)) == [(2, "b", "y"), (3, "c", "z")]


def test_load_creates_references_and_turns_rings(spark, tmp_path):
    site, tag = (f"{n}_{uuid.uuid4().hex}" for n in ("site", "tag"))
    store = TableStore(spark, str(tmp_path))
    store.create_all({
        tag: sc.declare({"uses": sc.Field("Int32")}),
        site: sc.declare({"tags": sc.Field(vector=True, ref=tag), "main": sc.Field(ref=tag),
                          "parent": sc.Field(ref=site), "log": sc.Field("Int32", last=2)})})
    store.load(tag, spark.createDataFrame([("old", 4)], "_key string, uses int"))
    rows = spark.createDataFrame(
        [("s1", ["b", "old", "a", "b"], "c", "s0", [1, 2, 3]), ("s2", None, None, "s1", [4])],
        "_key string, tags array<string>, main string, parent string, log array<int>")
    assert store.load(site, rows) == 2
    assert sorted((r["_id"], r["_key"], r["uses"]) for r in store.scan(tag).collect()) == [
        (1, "old", 4), (2, "b", 0), (3, "a", 0), (4, "c", 0)]
    got = {r["_key"]: r for r in store.scan(site).collect()}
    assert sorted(got) == ["s0", "s1", "s2"]
    assert (got["s1"]["log"], got["s2"]["log"], got["s0"]["log"]) == ([2, 3], [4], [])
    assert got["s1"]["tags"] == ["b", "old", "a", "b"] and got["s2"]["main"] == ""


def test_references_held_in_vectors(spark):
    rows = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["b", None]), (3, []), (4, None)],
                                 "_id long, tags array<string>")
    counts = index.reverse_refs(rows, "tags").filter("_key is not null")
    assert {(r["_key"], r["_nsubrecs"]) for r in counts.collect()} == {("a", 1), ("b", 2)}
    keys = spark.createDataFrame([("b",)], "_key string")
    assert sorted(ids(index.rows_pointing_to(rows, "tags", keys))) == [1, 2]


def test_staged_load_reads_the_table_at_commit(spark, tmp_path):
    store, name = TableStore(spark, str(tmp_path)), f"late_{uuid.uuid4().hex}"
    store.create_all({name: sc.declare({"name": sc.Field(), "age": sc.Field("Int32")})})
    row = lambda **values: spark.createDataFrame([tuple(values.values())], list(values))
    store.load(name, row(_key="k1", name="a"))
    staged = store.staged(name).load(row(_key="k2", name="b")).load(row(_key="k2", age=9))
    store.load(name, row(_key="k3", name="c"))
    assert staged.commit() == 2
    assert sorted((r["_key"], r["name"], r["age"]) for r in store.scan(name).collect()) == [
        ("k1", "a", 0), ("k2", "b", 9), ("k3", "c", 0)]


def test_staged_load_without_key(spark, tmp_path):
    store, name = TableStore(spark, str(tmp_path)), f"plain_{uuid.uuid4().hex}"
    store.create_all({name: sc.declare({"name": sc.Field()}, key=None)})
    batches = [spark.createDataFrame([(n,)], "name string") for n in ("a", "b")]
    assert store.staged(name).load(batches[0]).load(batches[1]).commit() == 2
    assert [(r["_id"], r["name"]) for r in store.scan(name).orderBy("_id").collect()] == [(1, "a"), (2, "b")]


def test_staged_arrival_keeps_its_type(spark):
    base = spark.createDataFrame([], SMALL)
    rows = spark.sql("""SELECT 'k' AS _key, 'early' AS name, timestamp '2020-01-01 00:00:00.2' AS at
                        UNION ALL SELECT 'k', 'late', timestamp '2020-01-01 00:00:00.7'
                        UNION ALL SELECT 'k', 'first', timestamp '2020-01-01 00:00:00.1'""")
    assert [r["name"] for r in mutate.StagedLoad(base).load(rows, "at").commit().collect()] == ["late"]
