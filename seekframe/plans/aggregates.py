"""Facets and reference columns."""

from pyspark.sql import functions as F

from seekframe.functions.text import matches
from seekframe.operators import facets as fc
from seekframe.operators import mutate
from seekframe.operators import paging as pg
from seekframe.operators import refs
from seekframe.plans.registry import query

C = F.col

_FACET = """SELECT {col} AS _key, count(*) AS _nsubrecs, min(doc_id) AS _first
            FROM documents {where} GROUP BY {col}"""


def _facet_sql(col="source", where=""):
    return _FACET.format(col=col, where=where)


def _ranked_sql(order, col="source"):
    return f"""SELECT _key, _nsubrecs, row_number() OVER (ORDER BY {order}) AS rank,
                      count(*) OVER () AS total FROM ({_facet_sql(col)})"""


def _docs(t):
    return t.documents.select("doc_id", "lang", "source", "n_chars")


def _facet(t, col="source"):
    return fc.drilldown(_docs(t), col, "doc_id")


def _rank(facets, keys):
    return pg.rank_page(facets, keys, tie="_first").select("_key", "_nsubrecs", "rank")


@query(_facet_sql("lang"))
def drilldown_single(t):
    return _facet(t, "lang")


@query("""SELECT 'lang' AS facet, lang AS _key, count(*) AS _nsubrecs, min(doc_id) AS _first
          FROM documents GROUP BY lang
          UNION ALL SELECT 'source', source, count(*), min(doc_id) FROM documents GROUP BY source
          UNION ALL SELECT 'n_chars', CAST(n_chars AS VARCHAR), count(*), min(doc_id)
          FROM documents GROUP BY n_chars""")
def drilldown_multi(t):
    return fc.drilldown_many(_docs(t), ["lang", "source", "n_chars"], "doc_id")


@query(_facet_sql("source", "WHERE n_chars > 2000 AND lang = 'en'"))
def drilldown_filtered(t):
    rows = _docs(t).filter((C("n_chars") > 2000) & (C("lang") == "en"))
    return fc.drilldown(rows, "source", "doc_id")


@query(f"""SELECT _key, _nsubrecs, rank FROM ({_ranked_sql('_nsubrecs DESC, _first')})
           WHERE rank <= 100""")
def drilldown_sortby(t):
    return _rank(fc.facet_page(_facet(t), ["-_nsubrecs"], 100), ["-_nsubrecs"])


@query(f"SELECT _key FROM ({_facet_sql()})")
def drilldown_columns(t):
    return fc.facet_page(_facet(t), output_columns=["_key"])


@query(f"SELECT _key, _nsubrecs FROM ({_ranked_sql('_first')}) WHERE rank > total - 3")
def drilldown_offset(t):
    return fc.facet_page(_facet(t), offset=-3, output_columns=["_key", "_nsubrecs"])


@query(f"SELECT _key, _nsubrecs FROM ({_ranked_sql('_key DESC')}) WHERE rank <= total - 4 + 1")
def drilldown_limit(t):
    return fc.facet_page(_facet(t), ["-_key"], limit=-4, output_columns=["_key", "_nsubrecs"])


@query("SELECT count(DISTINCT source) AS all_len FROM documents")
def drilldown_total(t):
    return fc.facet_total(_facet(t))


# --- references ---------------------------------------------------------------------------------

@query("""SELECT o_orderkey, o_custkey, c_name AS customer, n_name AS nation FROM orders
          LEFT JOIN customer ON o_custkey = c_custkey
          LEFT JOIN nation ON c_nationkey = n_nationkey""")
def ref_lookup(t):
    rows = refs.lookup(t.orders.select("o_orderkey", "o_custkey"), t.customer, "o_custkey",
                       "c_custkey", {"c_name": "customer", "c_nationkey": "nationkey"})
    return refs.lookup(rows, t.nation, "nationkey", "n_nationkey", {"n_name": "nation"}) \
        .drop("nationkey")


@query("""SELECT l_orderkey, l_linenumber, p_name AS part, s_name AS supplier FROM lineitem
          LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
          WHERE contains(lower(p_name), 'hot g') OR contains(lower(s_name), '#000000007')""")
def match_across_ref(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = refs.lookup(rows, t.part, "l_partkey", "p_partkey", {"p_name": "part"})
    rows = refs.lookup(rows, t.supplier, "l_suppkey", "s_suppkey", {"s_name": "supplier"})
    hit = F.coalesce(matches(C("part"), "hot g"), F.lit(False)) \
        | F.coalesce(matches(C("supplier"), "#000000007"), F.lit(False))
    return rows.filter(hit).drop("l_partkey", "l_suppkey")


@query("""WITH words AS (SELECT p_partkey, unnest(string_split(lower(p_name), ' ')) AS word,
                                generate_subscripts(string_split(lower(p_name), ' '), 1) AS place
                         FROM part),
               kana AS (SELECT word, count(*) AS uses FROM words GROUP BY word)
          SELECT p_partkey, string_agg(CAST(uses AS VARCHAR), ',' ORDER BY place) AS uses
          FROM words JOIN kana USING (word) GROUP BY p_partkey""")
def ref_vector_lookup(t):
    parts = t.part.select("p_partkey", F.split(F.lower("p_name"), " ").alias("word"))
    kana = parts.select(F.explode("word").alias("word")).groupBy("word").agg(
        F.count("*").alias("uses"))
    found = refs.lookup_vector(parts, kana, "p_partkey", "word", "word", "uses", "uses")
    return found.select("p_partkey", F.array_join("uses", ",").alias("uses"))


@query("""SELECT c_nationkey AS _key, n_name, count(*) AS _nsubrecs, min(c_custkey) AS _first
          FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
          GROUP BY c_nationkey, n_name""")
def drilldown_ref(t):
    return refs.drilldown_ref(t.customer, "c_nationkey", t.nation, "n_nationkey", "n_name",
                              "c_custkey")


@query("""WITH known AS (SELECT p_name AS _key, min(p_partkey) AS _id, max(p_size) AS size
                         FROM part WHERE p_size > 48 GROUP BY p_name),
               fresh AS (SELECT p_name AS _key, min(p_partkey) AS first FROM part
                         WHERE p_name NOT IN (SELECT _key FROM known) GROUP BY p_name)
          SELECT _key, _id, size FROM known
          UNION ALL
          SELECT _key, (SELECT max(_id) FROM known) + row_number() OVER (ORDER BY first), 0
          FROM fresh""")
def ref_autocreate(t):
    target = t.part.filter(C("p_size") > 48).groupBy(C("p_name").alias("_key")).agg(
        F.min("p_partkey").alias("_id"), F.max("p_size").alias("size"))
    return refs.create_missing(t.part.select("p_name", "p_partkey"), "p_name", target,
                               order_col="p_partkey")


@query("SELECT c_custkey, c_nationkey FROM customer ORDER BY 1 LIMIT 0")
def truncate_table(t):
    return mutate.truncate(t.customer.select("c_custkey", "c_nationkey"))
