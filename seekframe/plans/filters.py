"""Conditions, comparisons, arithmetic, bitwise operators, column updates, projections."""

import datetime as dt

from pyspark.sql import functions as F

from seekframe.functions import predicates as p
from seekframe.functions import text as tx
from seekframe.operators import select as sel
from seekframe.operators.update import update_column
from seekframe.plans.registry import query

C = F.col

# --- comparisons --------------------------------------------------------------------------------


@query("""SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'""")
def filter_eq(t):
    return t.orders.filter(p.equals(C("o_orderpriority"), "1-URGENT")) \
        .select("o_orderkey", "o_orderpriority")


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'""")
def filter_ne(t):
    return t.orders.filter(p.differs(C("o_orderstatus"), "F")).select("o_orderkey", "o_orderstatus")


@query("""SELECT doc_id, source FROM documents WHERE source < 'src15'""")
def filter_lt(t):
    return t.documents.filter(C("source") < "src15").select("doc_id", "source")


@query("""SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal <= 100.5""")
def filter_le(t):
    return t.customer.filter(C("c_acctbal") <= 100.5).select("c_custkey", "c_acctbal")


@query("""SELECT doc_id, lang, n_chars FROM documents WHERE n_chars > 2000""")
def filter_gt(t):
    return t.documents.filter(C("n_chars") > 2000).select("doc_id", "lang", "n_chars")


@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 49""")
def filter_ge(t):
    return t.lineitem.filter(C("l_quantity") >= 49) \
        .select("l_orderkey", "l_linenumber", "l_quantity")


# --- logic --------------------------------------------------------------------------------------

_ORDERS = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE "


def _orders(t, condition):
    return t.orders.filter(condition).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(_ORDERS + "o_orderstatus = 'F' AND o_totalprice > 400000")
def filter_and(t):
    return _orders(t, (C("o_orderstatus") == "F") & (C("o_totalprice") > 400000))


@query(_ORDERS + "o_orderstatus = 'P' OR o_totalprice > 450000")
def filter_or(t):
    return _orders(t, (C("o_orderstatus") == "P") | (C("o_totalprice") > 450000))


@query(_ORDERS + "NOT (o_totalprice > 20000)")
def filter_not(t):
    return _orders(t, ~(C("o_totalprice") > 20000))


@query(_ORDERS + "o_totalprice > 300000 AND NOT coalesce(o_orderstatus = 'O', false)")
def filter_diff(t):
    return _orders(t, p.difference(C("o_totalprice") > 300000, C("o_orderstatus") == "O"))


@query("""SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
          WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' AND o_orderdate < DATE '1998-07-01'
            AND o_totalprice > 250000.5 AND o_orderstatus IS NOT NULL
            AND (o_orderpriority = '2-HIGH') = true""")
def filter_literals(t):
    return t.orders.filter(p.all_of([
        C("o_orderdate") >= p.literal(dt.datetime(1998, 1, 1)),
        C("o_orderdate") < p.literal(dt.date(1998, 7, 1)),
        C("o_totalprice") > p.literal(250000.5),
        p.differs(C("o_orderstatus"), None),
        p.equals(C("o_orderpriority") == "2-HIGH", True),
    ])).select("o_orderkey", "o_orderdate", "o_totalprice")


# --- arithmetic ---------------------------------------------------------------------------------

def _lines(t, value, condition):
    return t.lineitem.withColumn("value", value).filter(condition) \
        .select("l_orderkey", "l_linenumber", "value")


def _lines_sql(value, condition):
    return f"""SELECT l_orderkey, l_linenumber, {value} AS value FROM lineitem
               WHERE {condition.replace('value', '(' + value + ')')}"""


@query(_lines_sql("l_quantity + l_linenumber", "value > 53"))
def arith_add(t):
    return _lines(t, C("l_quantity") + C("l_linenumber"), C("value") > 53)


@query(_lines_sql("l_quantity - l_linenumber", "value < -2"))
def arith_sub(t):
    return _lines(t, C("l_quantity") - C("l_linenumber"), C("value") < -2)


@query(_lines_sql("l_extendedprice * (1 - l_discount)", "value > 90000"))
def arith_mul(t):
    return _lines(t, C("l_extendedprice") * (1 - C("l_discount")), C("value") > 90000)


@query("""SELECT l_orderkey, l_linenumber,
                 l_quantity / nullif(CAST(l_linenumber - 1 AS DOUBLE), 0) AS value
          FROM lineitem WHERE l_quantity > 48""")
def arith_div(t):
    value = p.divide(C("l_quantity"), C("l_linenumber") - 1)
    return _lines(t, value, C("l_quantity") > 48)


@query("""SELECT p_partkey, p_size % nullif(p_size - 20, 0) AS value FROM part""")
def arith_mod(t):
    return t.part.select("p_partkey", p.modulo(C("p_size"), C("p_size") - 20).alias("value"))


# --- bits ---------------------------------------------------------------------------------------

def _parts(t, bits, flags=None):
    df = t.part
    extra = [] if flags is None else [flags(df).alias("flag")]
    return df.select("p_partkey", bits(df).alias("bits"), *extra)


@query("""SELECT p_partkey, p_size & 12 AS bits,
                 (p_size > 20 AND p_type = 'PROMO') AS flag FROM part""")
def bit_and(t):
    return _parts(t, lambda df: p.bit_and(df, C("p_size"), F.lit(12)),
                  lambda df: p.bit_and(df, C("p_size") > 20, C("p_type") == "PROMO"))


@query("""SELECT p_partkey, p_size | 12 AS bits,
                 (p_size > 20 OR p_type = 'PROMO') AS flag FROM part""")
def bit_or(t):
    return _parts(t, lambda df: p.bit_or(df, C("p_size"), F.lit(12)),
                  lambda df: p.bit_or(df, C("p_size") > 20, C("p_type") == "PROMO"))


@query("""SELECT p_partkey, xor(p_size, 12) AS bits,
                 ((p_size > 20) <> (p_type = 'PROMO')) AS flag FROM part""")
def bit_xor(t):
    return _parts(t, lambda df: p.bit_xor(df, C("p_size"), F.lit(12)),
                  lambda df: p.bit_xor(df, C("p_size") > 20, C("p_type") == "PROMO"))


@query("""SELECT p_partkey, ~p_size AS bits, NOT (p_size > 20) AS flag FROM part""")
def bit_not(t):
    return _parts(t, lambda df: p.bit_not(df, C("p_size")),
                  lambda df: p.bit_not(df, C("p_size") > 20))


@query("""SELECT p_partkey, p_size << 3 AS bits FROM part""")
def shift_left(t):
    return _parts(t, lambda df: p.shift_left(C("p_size"), 3))


@query("""SELECT p_partkey,
                 CAST((CAST(p_size - 25 AS BIGINT) & 4294967295) >> 2 AS INTEGER) AS bits
          FROM part""")
def shift_right_unsigned(t):
    return _parts(t, lambda df: p.shift_right(C("p_size") - 25, 2))


@query("""SELECT p_partkey, CAST(CAST(p_size AS BIGINT) << (p_partkey % 5) AS INTEGER) AS bits,
                 CAST((CAST(p_size - 25 AS BIGINT) & 4294967295) >> (1 + p_partkey % 5) AS INTEGER) AS flag
          FROM part""")
def shift_by_column(t):
    return t.part.select("p_partkey", p.shift_left(C("p_size"), C("p_partkey") % 5).alias("bits"),
                         p.shift_right(C("p_size") - 25, C("p_partkey") % 5 + 1).alias("flag"))


# --- column updates -----------------------------------------------------------------------------

def _update(op, operand, where=None):
    return lambda t: update_column(t.part, "p_size", op, operand, where and F.expr(where)) \
        .select("p_partkey", "p_name", "p_size")


def _update_sql(value):
    return f"SELECT p_partkey, p_name, {value} AS p_size FROM part"


query(_update_sql("p_size + 3"), "update_add")(_update("+=", 3))
query(_update_sql("CASE WHEN p_type = 'SMALL' THEN p_size - 2 ELSE p_size END"), "update_sub")(
    _update("-=", 2, "p_type = 'SMALL'"))
query(_update_sql("p_size * 4"), "update_mul")(_update("*=", 4))
query(_update_sql("CAST(p_size AS DOUBLE) / 8"), "update_div")(_update("/=", 8))
query(_update_sql("p_size % 7"), "update_mod")(_update("%=", 7))
query(_update_sql("p_size << 2"), "update_shift_left")(_update("<<=", 2))
query(_update_sql("p_size >> 1"), "update_shift_right")(_update(">>=", 1))
query(_update_sql("p_size & 6"), "update_bit_and")(_update("&=", 6))
query(_update_sql("p_size | 9"), "update_bit_or")(_update("|=", 9))
query(_update_sql("xor(p_size, 5)"), "update_bit_xor")(_update("^=", 5))

# --- conditions and keywords --------------------------------------------------------------------

_DOCS = "SELECT doc_id, lang, n_chars FROM documents WHERE "


def _docs(df):
    return df.select("doc_id", "lang", "n_chars")


@query(_DOCS + "lang = 'es' OR n_chars > 5000")
def select_conditions_or(t):
    return _docs(sel.select_rows(t.documents, C("lang") == "es", C("n_chars") > 5000))


@query(_DOCS + "(contains(lower(text), 'license') OR contains(lower(source), 'c1'))")
def select_keywords_or(t):
    return _docs(sel.select_rows(t.documents, text="license", source="C1"))


@query(_DOCS + "(contains(lower(text), 'copyright') OR contains(lower(source), 'src2')) "
               "AND (lang = 'en' OR n_chars > 3000)")
def select_keywords_and_condition(t):
    return _docs(sel.select_rows(t.documents, C("lang") == "en", C("n_chars") > 3000,
                                 text="copyright", source="src2"))


@query(_DOCS + "n_chars < 100 OR lang = 'de' OR contains(lower(source), 'src9') "
               "OR contains(lower(text), 'http')")
def filter_clause_or(t):
    return _docs(sel.filter_rows(t.documents, C("n_chars") < 100, C("lang") == "de",
                                 text="http", source="SRC9"))


@query(_DOCS + "contains(lower(text), 'the') AND (n_chars > 4000 OR lang = 'fr')")
def query_and_filter(t):
    rows = sel.select_rows(t.documents, text="the")
    return _docs(sel.filter_rows(rows, C("n_chars") > 4000, C("lang") == "fr"))


@query(_DOCS + "contains(lower(text), 'the') AND NOT contains(lower(text), 'that')")
def query_minus(t):
    return _docs(t.documents.filter(
        p.difference(tx.matches(C("text"), "the"), tx.matches(C("text"), "that"))))


@query(_DOCS + "contains(lower(text), 'und') AND contains(lower(text), 'para')")
def query_terms_and(t):
    return _docs(t.documents.filter(tx.matches(C("text"), "und") & tx.matches(C("text"), "para")))


@query(_DOCS + "contains(lower(text), 'license') OR contains(lower(text), 'ness')")
def query_terms_or(t):
    return _docs(t.documents.filter(tx.matches(C("text"), "license") | tx.matches(C("text"), "ness")))


@query(_DOCS + "contains(lower(text), 'of the')")
def match_phrase(t):
    return _docs(t.documents.filter(tx.matches(C("text"), "of the")))


# --- projections --------------------------------------------------------------------------------

@query("SELECT source, doc_id, lang FROM documents")
def project_columns(t):
    return sel.project(t.documents, "source", "doc_id", "lang")


@query("SELECT * FROM customer")
def project_all(t):
    return sel.project(t.customer)


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def project_excluding(t):
    return sel.project(t.documents, excluding=("text",))


@query("""SELECT c_custkey AS _id, c_name AS _key,
                 CAST((length(lower(c_name)) - length(replace(lower(c_name), '9', ''))) AS INTEGER)
                   AS _score
          FROM customer WHERE c_custkey >= 100 AND c_name < 'Customer#000001200'""")
def pseudo_columns(t):
    rows = t.customer.select(C("c_custkey").alias("_id"), C("c_name").alias("_key"))
    return rows.filter((C("_id") >= 100) & (C("_key") < "Customer#000001200")) \
        .withColumn("_score", tx.score({"_key": 1}, ["9"]))


@query("SELECT * FROM documents")
def scan_all(t):
    return t.documents
