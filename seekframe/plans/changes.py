"""Loads, deletes and record ids on keyed tables."""

from pyspark.sql import functions as F

from seekframe import schema as sc
from seekframe.operators import mutate
from seekframe.operators.rows import assign_row_id
from seekframe.operators.select import search
from seekframe.plans import sql
from seekframe.plans.registry import query
from seekframe.session import scratch_path
from seekframe.sources.json_records import read_records, write_records
from seekframe.sources.store import TableStore

C = F.col

CUSTOMER = sc.declare({
    "balance": sc.Field("Float"),
    "segment": sc.Field("ShortText"),
    "nation": sc.Field("UInt8", ref="nation"),
})


def _customers(t):
    return t.customer.select(
        C("c_custkey").alias("_id"), C("c_name").alias("_key"), C("c_acctbal").alias("balance"),
        C("c_mktsegment").alias("segment"), C("c_nationkey").alias("nation"))


_CUSTOMERS = """SELECT c_custkey AS _id, c_name AS _key, c_acctbal AS balance,
                       c_mktsegment AS segment, c_nationkey AS nation FROM customer"""


@query("""SELECT c_custkey AS _id, c_name AS _key, c_acctbal AS balance, c_mktsegment AS segment,
                 CAST(c_nationkey AS SMALLINT) AS nation FROM customer""")
def declare_schema(t):
    return sc.conform(_customers(t), CUSTOMER)


# A load for the customer table: spenders of big orders, the last order of a customer wins, and
# customers of the suppliers' names are new.
_INCOMING = """incoming AS (
    SELECT c_name AS _key, max_by(o_totalprice, o_orderkey) AS balance,
           max_by(o_orderpriority, o_orderkey) AS segment, min(o_orderkey) AS first
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 350000 GROUP BY c_name
    UNION ALL
    SELECT s_name, s_acctbal, '', 1000000000 + s_suppkey FROM supplier)"""

_UPSERTED = f"""WITH base AS ({_CUSTOMERS}), {_INCOMING}
    SELECT _id, _key, coalesce(i.balance, b.balance) AS balance,
           coalesce(i.segment, b.segment) AS segment, nation
    FROM base b LEFT JOIN incoming i USING (_key)
    UNION ALL
    SELECT (SELECT max(_id) FROM base) + row_number() OVER (ORDER BY first), _key, balance,
           segment, 0
    FROM incoming WHERE _key NOT IN (SELECT _key FROM base)"""


def _big_orders(t):
    big = t.orders.filter(C("o_totalprice") > 350000)
    return big.join(t.customer, C("o_custkey") == C("c_custkey")).select(
        C("c_name").alias("_key"), C("o_totalprice").alias("balance"),
        C("o_orderpriority").alias("segment"), C("o_orderkey").alias("at"))


def _suppliers(t):
    return t.supplier.select(
        C("s_name").alias("_key"), C("s_acctbal").alias("balance"),
        F.lit(None).cast("string").alias("segment"), (C("s_suppkey") + 1000000000).alias("at"))


@query(_UPSERTED)
def upsert_by_key(t):
    return mutate.upsert(_customers(t), _big_orders(t).unionByName(_suppliers(t)), arrival="at")


@query(_UPSERTED)
def staged_load(t):
    load = mutate.StagedLoad(_customers(t))
    return load.load(_big_orders(t), arrival="at").load(_suppliers(t), arrival="at").commit()


@query("""SELECT event_id, event_type, value FROM events
          UNION ALL SELECT o_orderkey, 'order', o_totalprice FROM orders""")
def append_load(t):
    orders = t.orders.select(C("o_orderkey").alias("event_id"), F.lit("order").alias("event_type"),
                             C("o_totalprice").alias("value"))
    return mutate.append(t.events.select("event_id", "event_type", "value"), orders)


@query("SELECT c_name AS _key, c_acctbal AS balance, c_mktsegment AS segment, "
       "CAST(c_nationkey AS SMALLINT) AS nation FROM customer")
def json_load(t):
    path = scratch_path(t.spark, "records")
    write_records(_customers(t), path)
    return read_records(t.spark, path, CUSTOMER)


@query("""SELECT p_partkey, coalesce(CASE WHEN p_size > 25 THEN p_name END, '') AS name,
                 coalesce(CASE WHEN p_type <> 'PROMO' THEN p_size END, 0) AS size,
                 coalesce(CASE WHEN p_size < 10 THEN p_retailprice END, 0.0) AS price FROM part""")
def load_defaults(t):
    rows = t.part.select(
        "p_partkey", F.when(C("p_size") > 25, C("p_name")).alias("name"),
        F.when(C("p_type") != "PROMO", C("p_size")).alias("size"),
        F.when(C("p_size") < 10, C("p_retailprice")).alias("price"))
    return sc.fill_defaults(rows, ["name", "size", "price"])


@query("""SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS _id
          FROM orders""")
def assign_row_id_by_date(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return assign_row_id(rows, [C("o_orderdate"), C("o_orderkey")])


@query("""SELECT event_id, event_id - (SELECT min(event_id) FROM events) + 1 AS _id FROM events""",
       name="assign_row_id")
def _assign_row_id(t):
    return assign_row_id(t.events.select("event_id"), [C("event_id")])


@query(f"""SELECT * FROM ({_CUSTOMERS})
           WHERE _key NOT IN (SELECT c_name FROM customer JOIN orders ON c_custkey = o_custkey
                              WHERE o_totalprice > 400000)""")
def delete_by_key(t):
    big = t.orders.filter(C("o_totalprice") > 400000)
    gone = t.customer.join(big, C("c_custkey") == C("o_custkey"), "left_semi")
    return mutate.delete(_customers(t), key=gone.select(C("c_name").alias("_key")))


@query(f"SELECT * FROM ({_CUSTOMERS}) WHERE _id <> 17")
def delete_by_id(t):
    return mutate.delete(_customers(t), id="17")


@query(f"SELECT * FROM ({_CUSTOMERS}) WHERE NOT (balance < 0 AND segment = 'BUILDING')")
def delete_by_filter(t):
    return mutate.delete(_customers(t), where=(C("balance") < 0) & (C("segment") == "BUILDING"))


@query("""SELECT c_custkey AS _id, c_name AS _key,
                 CASE WHEN c_nationkey < 5 THEN c_acctbal + 100 ELSE c_acctbal END AS balance,
                 c_mktsegment AS segment, c_nationkey AS nation FROM customer""")
def commit_changed(t):
    stored = _customers(t)
    edited = stored.withColumn("balance", F.when(C("nation") < 5, C("balance") + 100)
                               .otherwise(C("balance")))
    return mutate.commit_changed(edited, stored)


@query(f"""SELECT _key, balance, segment, CAST(nation AS SMALLINT) AS nation, row_number()
              OVER (ORDER BY _id) AS _id FROM ({_CUSTOMERS})""")
def create_if_absent(t):
    """A stored table through its life: create twice, load, delete, scan."""
    store = TableStore(t.spark, scratch_path(t.spark, "store"))
    name = store.root.rsplit("-", 1)[1]
    name = f"customers_{name}"
    store.create_all({name: CUSTOMER})
    store.load(name, _customers(t).withColumnRenamed("_id", "at"), arrival="at")
    store.create_all({name: CUSTOMER})
    return store.scan(name)


def _stored(t, label, schema, rows, arrival):
    """A new stored table with the given rows."""
    store = TableStore(t.spark, scratch_path(t.spark, "store"))
    name = f"{label}_{store.root.rsplit('-', 1)[1]}"
    store.create_all({name: schema}, buckets=8)
    store.load(name, rows, arrival=arrival)
    return store, name


@query(f"""WITH base AS (SELECT row_number() OVER (ORDER BY _id) AS _id, _key, balance, segment, nation
                         FROM ({_CUSTOMERS})), {_INCOMING},
           loaded AS (
             SELECT _id, _key, coalesce(i.balance, b.balance) AS balance,
                    coalesce(i.segment, b.segment) AS segment, nation
             FROM base b LEFT JOIN incoming i USING (_key)
             UNION ALL
             SELECT (SELECT max(_id) FROM base) + row_number() OVER (ORDER BY first), _key, balance,
                    segment, 0
             FROM incoming WHERE _key NOT IN (SELECT _key FROM base))
           SELECT _id, _key, CASE WHEN nation < 5 THEN balance + 100 ELSE balance END AS balance, segment,
                  CAST(nation AS SMALLINT) AS nation
           FROM loaded WHERE NOT (balance < 0 AND segment = 'BUILDING')""")
def stored_changes(t):
    """A stored table after a staged load, a delete and a commit of edited rows."""
    store, name = _stored(t, "customers", CUSTOMER, _customers(t).withColumnRenamed("_id", "at"), "at")
    store.staged(name).load(_big_orders(t), arrival="at").load(_suppliers(t), arrival="at").commit()
    store.delete(name, where=(C("balance") < 0) & (C("segment") == "BUILDING"))
    rows = store.scan(name)
    store.commit_changed(name, rows.withColumn("balance", F.when(C("nation") < 5, C("balance") + 100)
                                               .otherwise(C("balance"))))
    return store.scan(name)


@query("""SELECT 'customers' AS name, 0::BIGINT AS n UNION ALL SELECT 'parts', count(*) FROM part""")
def truncate_stored(t):
    """Rows of two stored tables after one of them was truncated."""
    store, name = _stored(t, "customers", CUSTOMER, _customers(t).withColumnRenamed("_id", "at"), "at")
    other = f"parts_{name.rsplit('_', 1)[1]}"
    store.create_all({other: PART}, buckets=8)
    store.load(other, _parts(t))
    store.truncate(name)
    rows = lambda n, label: store.scan(n).agg(F.count("*").alias("n")).select(
        F.lit(label).alias("name"), "n")
    return rows(name, "customers").unionAll(rows(other, "parts"))


PART = sc.declare({"name": sc.Field("Text"), "size": sc.Field("Int32")})


def _parts(t):
    return t.part.select(C("p_partkey").cast("string").alias("_key"), C("p_name").alias("name"),
                         C("p_size").alias("size"))


_PART_TERMS = ["ring", "hot", "promo"]
_CHANGED_PARTS = """changed AS (SELECT CAST(p_partkey AS VARCHAR) AS _key,
        CASE WHEN p_size > 40 THEN p_type || ' ' || p_name ELSE p_name END AS name
    FROM part WHERE p_size >= 5)"""


@query(f"""WITH {_CHANGED_PARTS}
           SELECT _key, CAST(count(*) AS INTEGER) AS _score
           FROM ({sql.postings('changed', '_key', sql.token_list('name'))})
           WHERE token IN ('ring', 'hot', 'promo') GROUP BY _key""")
def index_in_step(t):
    """A lookup in an index that followed a load and a delete of its table."""
    store, name = _stored(t, "parts", PART, _parts(t), None)
    index = store.index(name, ["name"], buckets=8)
    longer = t.part.filter("p_size > 40").select(
        C("p_partkey").cast("string").alias("_key"), F.concat_ws(" ", "p_type", "p_name").alias("name"))
    store.load(name, longer)
    store.delete(name, where=C("size") < 5)
    return store.scan(name).select("_id", "_key").join(index.match(_PART_TERMS), "_id") \
        .select("_key", "_score")


@query(f"""WITH {_CHANGED_PARTS},
                tiers AS (SELECT _key, CASE WHEN list_contains(ts, 'pro') THEN 1
                              WHEN len(list_filter(ts, lambda x: starts_with(x, 'pro'))) > 0 THEN 2
                              ELSE 3 END AS _tier
                          FROM (SELECT _key, {sql.token_list('name')} AS ts FROM changed
                                WHERE contains(lower(name), 'pro')))
           SELECT _key, _tier FROM tiers""")
def escalation_in_step(t):
    """Escalation from an index and its lexicon that followed a load and a delete."""
    store, name = _stored(t, "parts", PART, _parts(t), None)
    index = store.index(name, ["name"], buckets=8).keep_lexicon()
    longer = t.part.filter("p_size > 40").select(
        C("p_partkey").cast("string").alias("_key"), F.concat_ws(" ", "p_type", "p_name").alias("name"))
    store.load(name, longer)
    store.delete(name, where=C("size") < 5)
    rows = store.scan(name).select("_id", "_key", "name")
    return rows.select("_id", "_key").join(index.escalate(rows, "Pro", 1_000_000), "_id") \
        .select("_key", "_tier")


TYPED = sc.declare({"name": sc.Field("Text"), "kind": sc.Field("Text"), "size": sc.Field("Int32")})
_TYPED_TOKENS = " UNION ALL ".join(
    f"""SELECT p_partkey, {weight} AS weight FROM ({sql.postings('part', 'p_partkey', sql.token_list(column))})
        WHERE token IN ('ring', 'promo')""" for column, weight in {"p_name": 10, "p_type": 3}.items())


@query(f"""WITH hits AS (SELECT p_partkey, CAST(sum(weight) AS INTEGER) AS _score
                         FROM ({_TYPED_TOKENS}) GROUP BY p_partkey),
                rows AS (SELECT p_partkey, _score, p_size FROM hits JOIN part USING (p_partkey)
                         WHERE p_size > 10)
           SELECT 'page' AS part, CAST(p_partkey AS VARCHAR) AS _key, _score::BIGINT AS n FROM (
               SELECT * FROM rows ORDER BY _score DESC, p_partkey LIMIT 20)
           UNION ALL
           SELECT * FROM (SELECT 'size', CAST(p_size AS VARCHAR), count(*) AS n FROM rows GROUP BY p_size
                          ORDER BY n DESC, min(p_partkey) LIMIT 5)""")
def search_indexed(t):
    """A selection whose query is answered by a weighted index: page, and the largest facets."""
    parts = t.part.select(C("p_partkey").cast("string").alias("_key"), C("p_name").alias("name"),
                          C("p_type").alias("kind"), C("p_size").alias("size"),
                          C("p_partkey").alias("at"))
    store, name = _stored(t, "typed", TYPED, parts, "at")
    index = store.index(name, {"name": 10, "kind": 3}, buckets=8)
    found = search(store.scan(name), C("size") > 10, query=["Ring", "promo"], index=index,
                   sort_by=["-_score"], limit=20, output_columns=["_key", "_score"], drilldown=["size"],
                   facet_options={"sort_by": ["-_nsubrecs"], "limit": 5})
    page = found.page.select(F.lit("page").alias("part"), "_key", C("_score").cast("long").alias("n"))
    return page.unionAll(found.facets["size"].select(
        F.lit("size"), C("_key").cast("string"), C("_nsubrecs")))
