import datetime as dt

import pytest
from conftest import ids
from pyspark.sql import functions as F

from seekframe.functions import predicates as p
from seekframe.functions import text as tx
from seekframe.operators import facets as fc
from seekframe.operators import paging as pg
from seekframe.operators import select as sel
from seekframe.operators.update import update_column

C = F.col


@pytest.mark.parametrize("keywords, expected", [
    ({"name": "name"}, [1, 2]), ({"name": "城"}, [4]), ({"address": "ar"}, [3]),
    ({"address": "道寺"}, [5]), ({"_key": "キー４"}, [4]), ({"_key": "1"}, [1]),
    ({"name": "foo", "address": "ADDRESS2"}, [2, 3]),
])
def test_keyword_match(people, keywords, expected):
    assert sorted(ids(sel.select_rows(people, **keywords))) == expected


def test_conditions(articles):
    pick = lambda *c, **k: sorted(ids(sel.select_rows(articles, *c, **k)))
    assert pick(C("title") == "Nyarlathotep") == [3]
    assert pick(C("title") != "Nyarlathotep") == [1, 2, 4, 5]
    assert pick(C("title") != "Gentoo Linux", body="linux") == [1]
    assert pick(C("_key") < "key3") == [1, 2]
    assert pick(C("_id") >= 3) == [3, 4, 5]
    assert pick(C("title") == "Hastur", C("_id") == 1) == [1, 5]
    assert pick() == [1, 2, 3, 4, 5]
    assert sorted(ids(sel.filter_rows(articles, C("_id") == 4, title="linux"))) == [1, 2, 4]


PAGES = [
    (2, 0, [1, 2]), (100, 0, [1, 2, 3, 4, 5]), (-2, 0, [1, 2, 3, 4]), (-1, 0, [1, 2, 3, 4, 5]),
    (-100, 0, []), (0, 0, []), (None, 2, [3, 4, 5]), (None, -2, [4, 5]), (None, -100, [1, 2, 3, 4, 5]),
    (None, 100, []), (3, 2, [3, 4, 5]), (1, -2, [4]), (-3, 1, [2, 3, 4]), (-3, -4, [2, 3, 4]),
    (None, 0, [1, 2, 3, 4, 5]),
]


@pytest.mark.parametrize("limit, offset, expected", PAGES)
def test_pages(articles, limit, offset, expected):
    assert ids(pg.page(articles, ["_id"], limit, offset)) == expected


@pytest.mark.parametrize("limit, offset, expected", [PAGES[i] for i in (0, 2, 4, 6, 8, 11, 13)])
def test_pages_by_rank(articles, limit, offset, expected):
    """Dense-rank plans give the same pages as top-k plans."""
    assert ids(pg.page(articles, ["_id"], limit, offset, top_rows=0)) == expected


def test_sorting(articles, characters):
    assert ids(pg.sort(articles, "title")) == [1, 4, 2, 5, 3]
    assert ids(pg.sort(articles, "-title")) == [3, 5, 2, 4, 1]
    assert ids(pg.sort(characters, "category", "-_id")) == [8, 7, 6, 5, 4, 3, 2, 1]
    assert ids(pg.sort(characters, "category", reverse=True)) == [3, 2, 1, 5, 4, 8, 7, 6]


@pytest.mark.parametrize("limit, offset", [(2, 1), (None, 1), (None, 3), (None, -2), (-2, 0), (-3, 1)])
@pytest.mark.parametrize("top_rows", [0, 100])
def test_page_with_a_tie_of_two_columns(spark, limit, offset, top_rows):
    rows = [("q1", "a", 5), ("q1", "b", 5), ("q2", "a", 5), ("q2", None, 4), ("q1", None, 4)]
    df = spark.createDataFrame(rows, "query string, _key string, n int")
    ordered = sorted(rows, key=lambda r: (-r[2], r[0], r[1] or ""))
    start = offset if offset >= 0 else max(0, len(rows) + offset)
    stop = None if limit is None else start + (limit if limit > 0 else len(rows) + limit + 1)
    got = pg.page(df, ["-n"], limit, offset, tie=["query", "_key"], top_rows=top_rows)
    assert [tuple(r) for r in got.collect()] == ordered[start:stop]


@pytest.mark.parametrize("start, stop, step, top_rows", [
    (0, 5, 2, 100), (1, 4, 3, 100), (2, None, 2, 100), (1, None, 1, 100), (3, 3, 1, 100),
    (4, 2, 1, 100), (0, 8, 3, 100), (1, 8, 3, 0), (1, None, 1, 0)])
def test_slices(characters, start, stop, step, top_rows):
    got = ids(pg.slice_rows(characters, ["_id"], start, stop, step, top_rows=top_rows))
    assert got == list(range(1, 9))[start:stop:step]


def test_total_and_search(articles):
    rows = articles.filter(C("_id") > 1)
    page = pg.with_total(pg.page(rows, ["_id"], 2), rows).collect()
    assert [(r["_id"], r["all_len"]) for r in page] == [(2, 4), (3, 4)]
    found = sel.search(articles, query="linux", match_columns={"title": 10, "body": 1},
                       sort_by=["-_score"], limit=1, output_columns=["_key", "_score"],
                       drilldown=["title"])
    assert [tuple(r) for r in found.page.collect()] == [("key1", 12)]
    assert found.total.head()[0] == 2
    assert found.facets["title"].count() == 2
    either = sel.search(articles, query=["arch", "hastur"], match_columns=["title"]).page
    assert ids(either) == [1, 5] and ids(either, "_score") == [1, 1]
    with pytest.raises(ValueError):
        sel.search(articles, query="linux")


def facet_rows(df):
    return [(r["_key"], r["_nsubrecs"]) for r in df.collect()]


def test_facets(characters):
    facets = fc.drilldown(characters, "category")
    v, g, b = ("VOCALOID", 3), ("Ghostory", 2), ("BLACK LAGOON", 3)
    assert facet_rows(fc.facet_page(facets)) == [v, g, b]
    assert facet_rows(fc.facet_page(facets, ["_nsubrecs"])) == [g, v, b]
    assert facet_rows(fc.facet_page(facets, ["-_nsubrecs"])) == [v, b, g]
    assert facet_rows(fc.facet_page(facets, ["_key"])) == [b, g, v]
    assert facet_rows(fc.facet_page(facets, limit=-2)) == [v, g]
    assert facet_rows(fc.facet_page(facets, offset=-2)) == [g, b]
    assert facet_rows(fc.facet_page(facets, limit=2)) == [v, g]
    assert fc.facet_page(facets, output_columns=["_key"]).columns == ["_key"]
    assert fc.facet_total(facets).head()[0] == 3


def test_facets_of_several_columns(characters):
    both = fc.drilldown_many(characters, ["category", "_key"])
    for column in ("category", "_key"):
        one = {tuple(r) for r in fc.drilldown(characters, column).collect()}
        assert {tuple(r)[1:] for r in both.filter(C("facet") == column).collect()} == one


def test_null_and_literals(spark):
    df = spark.createDataFrame([(1, None, True), (2, "a", False), (3, "b", None)],
                               "_id int, s string, f boolean")
    assert ids(df.filter(p.equals(C("s"), None))) == [1]
    assert ids(df.filter(p.differs(C("s"), None))) == [2, 3]
    assert ids(df.filter(p.equals(C("f"), True))) == [1]
    assert ids(df.filter(p.difference(C("_id") > 1, C("f")))) == [2, 3]
    row = df.select(p.literal(dt.datetime(2020, 1, 2, 3, 4, 5, 6)).alias("t"),
                    p.literal(dt.date(2020, 1, 2)).alias("d"), p.literal(1.5).alias("x")).head()
    assert tuple(row) == (dt.datetime(2020, 1, 2, 3, 4, 5, 6), dt.date(2020, 1, 2), 1.5)


def test_arithmetic_and_bits(spark):
    df = spark.createDataFrame([(7, 0, True, False), (-7, 2, True, True)],
                               "a int, b int, x boolean, y boolean")
    row = lambda *c: [tuple(r) for r in df.select(*c).collect()]
    assert row(p.divide(C("a"), C("b")), p.modulo(C("a"), C("b"))) == [(None, None), (-3.5, -1)]
    assert row(p.bit_and(df, C("a"), F.lit(5)), p.bit_and(df, C("x"), C("y"))) == [(5, False), (1, True)]
    assert row(p.bit_or(df, C("a"), F.lit(8)), p.bit_or(df, C("x"), C("y"))) == [(15, True), (-7, True)]
    assert row(p.bit_xor(df, C("a"), F.lit(1)), p.bit_xor(df, C("x"), C("y"))) == [(6, True), (-8, False)]
    assert row(p.bit_not(df, C("a")), p.bit_not(df, C("y"))) == [(-8, True), (6, False)]
    assert row(p.shift_left(C("a"), 2), p.shift_right(C("a"), 1)) == [(28, 3), (-28, 2147483644)]


def test_updates(spark):
    df = spark.createDataFrame([(1, 10), (2, 7)], "_id int, n int")
    values = lambda op, x, **k: ids(update_column(df, "n", op, x, **k), "n")
    assert values("+=", 1) == [11, 8]
    assert values("-=", 1, where=C("_id") == 2) == [10, 6]
    assert values("/=", 0) == [None, None]
    assert values("%=", 4) == [2, 3]
    assert values("^=", 2) == [8, 5]
    with pytest.raises(ValueError):
        update_column(df, "n", "**=", 2)


def test_scores(spark):
    df = spark.createDataFrame([(1, "aXa xax", "x"), (2, None, "xx")], "_id int, t string, u string")
    assert ids(df.withColumn("s", tx.score({"t": 10, "u": 3}, ["x"])), "s") == [33, 6]
    assert ids(df.withColumn("s", tx.score({"t": 1}, ["a", "xa"])), "s") == [5, 0]
    assert ids(df.filter(tx.matches_any([C("t"), C("u")], "XX"))) == [2]


def test_normalizers(spark):
    df = spark.createDataFrame([(" A　b\t\nC ", "ﾊﾝｶｸ Ａｂ①")], "a string, b string")
    row = df.select(tx.normalise(C("a")), tx.normalise_nfkc("b")).head()
    assert tuple(row) == ("a b c", "ハンカク ab1")


def test_projection(articles):
    assert sel.project(articles, "title", "_key").columns == ["title", "_key"]
    assert sel.project(articles).columns == articles.columns
    assert sel.project(articles, excluding=("body", "_id")).columns == ["_key", "title"]
