"""Query-log mining and suggestions, on the event log and on the part catalogue."""

from pyspark.sql import functions as F

from seekframe.functions.tokens import words
from seekframe.operators import paging as pg
from seekframe.operators import prefixes
from seekframe.operators import suggest as sg
from seekframe.operators.prefixes import PrefixStore
from seekframe.plans.registry import PAIR_DAY, query
from seekframe.plans.sql import (
    CATALOGUE,
    EVENT_PAIRS,
    FOLLOWED,
    ITEMS,
    RELATED,
    log_with,
)
from seekframe.session import materialise, scratch_path

C = F.col
_PAIRS = log_with(FOLLOWED, EVENT_PAIRS)
_LEARNED = log_with(ITEMS, FOLLOWED, EVENT_PAIRS)
_NAMES = f"WITH {CATALOGUE}, {RELATED}"
_SUGGESTED = "query, type, _key, _score"

# --- learning -----------------------------------------------------------------------------------


@query(f"{log_with(ITEMS)} SELECT _key, freq, freq2, last FROM items")
def suggest_item_stats(t):
    return sg.item_stats(t.log)


@query(f"{_PAIRS} SELECT pre, post, freq0 FROM event_pairs WHERE freq0 > 0")
def suggest_pairs_complete(t):
    return sg.pairs_complete(t.log, PAIR_DAY)


@query(f"{_PAIRS} SELECT pre, post, freq1 FROM event_pairs WHERE freq1 > 0")
def suggest_pairs_correct(t):
    return sg.pairs_correct(t.log, PAIR_DAY)


@query(f"{_NAMES} SELECT pre, post, freq2 FROM related")
def suggest_pairs_related(t):
    return sg.pairs_related(t.catalogue[0])


@query("""SELECT event_id AS _id, CAST(user_id AS VARCHAR) AS sequence, back AS _back
          FROM (SELECT event_id, user_id, row_number() OVER (
                    PARTITION BY user_id ORDER BY event_id DESC) AS back FROM events)
          WHERE back <= 64""")
def sequence_last_n(t):
    return sg.last_events(t.log).select("_id", "sequence", "_back")


@query("""SELECT CAST(user_id AS VARCHAR) AS _key,
                 string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS events
          FROM (SELECT event_id, user_id, row_number() OVER (
                    PARTITION BY user_id ORDER BY event_id DESC) AS back FROM events)
          WHERE back <= 10 GROUP BY user_id""")
def sequence_vectors(t):
    return sg.sequence_table(t.log, 10).select("_key", F.array_join(
        F.transform("events", lambda e: e.cast("string")), ",").alias("events"))


# --- one query ----------------------------------------------------------------------------------

def _one(tables, text, types=("complete",), **options):
    items, pairs = tables
    return sg.suggest(items, pairs, text, types, **options)


@query(f"""{_PAIRS} SELECT pre AS query, 'complete' AS type, post AS _key, freq0 AS _score
           FROM event_pairs WHERE pre = '42' AND freq0 >= 1""")
def suggest_complete_pairs(t):
    return _one(t.learned, "42", frequency_threshold=1, prefix_search=False)


@query(f"""{_LEARNED} SELECT '4' AS query, 'complete' AS type, _key, max(n) AS _score FROM (
               SELECT post AS _key, freq0 AS n FROM event_pairs WHERE pre = '4' AND freq0 >= 2
               UNION ALL SELECT _key, freq2 + 1 FROM items
               WHERE starts_with(_key, '4') AND freq2 > 0 AND freq2 + 1 >= 2)
           GROUP BY _key""")
def suggest_complete_prefix(t):
    return _one(t.learned, "4", frequency_threshold=2, prefix_search=True)


@query(f"""{_NAMES} SELECT 'giz' AS query, 'complete' AS type, _key, freq2 + 1 AS _score
           FROM catalogue WHERE freq2 + 1 >= 10 AND (starts_with(_key, 'giz')
               OR len(list_filter(string_split(lower(_key), ' '),
                                  lambda x: starts_with(x, 'giz'))) > 0)""")
def suggest_complete_reading(t):
    items, pairs = t.catalogue
    return _one((items.drop("boost"), pairs), "giz", frequency_threshold=10)


@query(f"""{_PAIRS} SELECT pre AS query, 'correct' AS type, post AS _key, freq1 AS _score
           FROM event_pairs WHERE pre = '42' AND freq1 >= 1""")
def suggest_correct_pairs(t):
    return _one(t.learned, "42", ("correct",), frequency_threshold=1)


def _shared(a, b):
    grams = "list_transform(range(1, length({0})), lambda i: substring({0}, i, 2))"
    return f"list_has_any({grams.format(a)}, {grams.format(b)})"


@query(f"""{_NAMES} SELECT 'rad rinng' AS query, 'correct' AS type, _key, freq2 AS _score
           FROM catalogue WHERE freq2 >= 10 AND levenshtein(_key, 'rad rinng') <= 2
               AND {_shared('_key', "'rad rinng'")}""")
def suggest_correct_similar(t):
    items, pairs = t.catalogue
    return _one((items.drop("boost"), pairs), "rad rinng", ("correct",), frequency_threshold=10)


@query(f"""{_NAMES}, q AS (SELECT DISTINCT replace(_key, 'e', 'a') AS query FROM catalogue
                           UNION SELECT substring(_key, 2) FROM catalogue)
           SELECT query, 'correct' AS type, _key, freq2 AS _score
           FROM q JOIN catalogue ON levenshtein(_key, query) <= 2 AND {_shared('_key', 'query')}
           WHERE query NOT IN (SELECT _key FROM catalogue)""")
def suggest_correct_stored(t):
    """Corrections of many texts from stored segment keys."""
    items, pairs = t.catalogue
    items = items.drop("boost")
    keys = materialise(sg.close_keys(items), "close-keys")
    asked = items.select(F.replace("_key", F.lit("e"), F.lit("a")).alias("query")).union(
        items.select(F.expr("substring(_key, 2)")))
    return sg.suggest_batch(items, pairs, asked, ("correct",), frequency_threshold=1, keys=keys)


@query(f"""{_NAMES} SELECT pre AS query, 'suggest' AS type, post AS _key, freq2 AS _score
           FROM related WHERE pre = 'ring' AND freq2 >= 10""")
def suggest_related(t):
    items, pairs = t.catalogue
    return _one((items.drop("boost"), pairs), "ring", ("suggest",), frequency_threshold=10)


@query(f"""{_LEARNED} SELECT '7' AS query, type, _key, _score FROM (
               SELECT 'complete' AS type, post AS _key, freq0 AS _score FROM event_pairs
               WHERE pre = '7' AND freq0 >= 2
               UNION ALL SELECT 'complete', _key, freq2 + 1 FROM items
               WHERE starts_with(_key, '7') AND freq2 > 0 AND freq2 + 1 >= 2
                 AND NOT EXISTS (SELECT 1 FROM event_pairs WHERE pre = '7' AND freq0 >= 2)
               UNION ALL SELECT 'correct', post, freq1 FROM event_pairs
               WHERE pre = '7' AND freq1 >= 2)""")
def suggest_all_types(t):
    return _one(t.learned, "7", sg.TYPES, frequency_threshold=2, similar_search=False)


_RING = f"""{_NAMES} SELECT 'ring' AS query, 'complete' AS type, _key, freq2 + 1 AS _score
           FROM catalogue WHERE freq2 + 1 >= 10 AND (starts_with(_key, 'ring')
               OR len(list_filter(string_split(lower(_key), ' '),
                                  lambda x: starts_with(x, 'ring'))) > 0)
           UNION ALL SELECT 'ring', 'correct', _key, freq2 FROM catalogue
           WHERE freq2 >= 10 AND levenshtein(_key, 'ring') <= 2 AND _key <> 'ring'
               AND {_shared('_key', "'ring'")}
           UNION ALL SELECT pre, 'suggest', post, freq2 FROM related
           WHERE pre = 'ring' AND freq2 >= 10"""


def _ring(t):
    items, pairs = t.catalogue
    return _one((items.drop("boost"), pairs), "ring", sg.TYPES, frequency_threshold=10)


@query(_RING)
def suggest_all_types_names(t):
    return _ring(t)


@query(f"""SELECT type, _key, _score FROM ({_RING})
           ORDER BY _score DESC, type, _key LIMIT 20 OFFSET 3""")
def suggest_paging_types(t):
    """A page of several types at once, where an item shows up under more than one."""
    return pg.page(_ring(t).drop("query"), ["-_score"], 20, 3, tie=["type", "_key"])


@query(f"""SELECT type, _key, _score FROM ({_RING}) ORDER BY _score DESC, type, _key OFFSET 3""")
def suggest_paging_rest(t):
    return pg.page(_ring(t).drop("query"), ["-_score"], None, 3, tie=["type", "_key"])


@query(f"""{_PAIRS} SELECT pre AS query, 'complete' AS type, post AS _key, freq0 AS _score
           FROM event_pairs WHERE freq0 >= 3""")
def suggest_min_frequency(t):
    items, pairs = t.learned
    return sg.suggest_batch(items, pairs, items.select(C("_key").alias("query")), ("complete",),
                            frequency_threshold=3, prefix_search=False)


@query(f"""{_LEARNED} SELECT pre AS query, 'complete' AS type, post AS _key, freq0 AS _score
               FROM event_pairs JOIN items ON pre = _key
               WHERE freq0 >= 1 AND CAST(freq0 AS DOUBLE) / freq >= 0.02
           UNION ALL SELECT pre, 'correct', post, freq1 FROM event_pairs JOIN items ON pre = _key
               WHERE freq1 >= 1 AND CAST(freq1 AS DOUBLE) / freq2 >= 0.02""")
def suggest_min_probability(t):
    items, pairs = t.learned
    return sg.suggest_batch(items, pairs, items.select(C("_key").alias("query")),
                            ("complete", "correct"), frequency_threshold=1, prefix_search=False,
                            similar_search=False, conditional_probability_threshold=0.02)


@query(f"""{_NAMES} SELECT 'red' AS query, 'complete' AS type, _key, freq2 + 1 + boost AS _score
           FROM catalogue WHERE starts_with(_key, 'red') AND freq2 + 1 >= 10""")
def suggest_boost(t):
    return _one(t.catalogue, "red", frequency_threshold=10)


@query(f"""{_PAIRS}, hits AS (
               SELECT post AS _key, freq0 AS _score,
                      row_number() OVER (ORDER BY freq0 DESC, post) AS rn
               FROM event_pairs WHERE pre = '9' AND freq0 >= 1)
           SELECT _key, _score, rn - 2 AS rank FROM hits WHERE rn > 2 AND rn <= 7""")
def suggest_paging(t):
    hits = _one(t.learned, "9", frequency_threshold=1, prefix_search=False).select("_key", "_score")
    shown = pg.page(hits, ["-_score"], 5, 2, tie="_key")
    return pg.rank_page(shown, ["-_score"], tie="_key")


# --- many queries -------------------------------------------------------------------------------

_BEST = f"""SELECT {_SUGGESTED}, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query, type ORDER BY _score DESC, _key) AS rank
    FROM hits) WHERE rank <= """


@query(f"""{_LEARNED}, typed AS (
               SELECT pre AS query, 'complete' AS type, post AS _key, freq0 AS _score
               FROM event_pairs WHERE freq0 >= 3),
           hits AS (
               SELECT * FROM typed
               UNION ALL SELECT q._key, 'complete', i._key, i.freq2 + 1
               FROM items q JOIN items i ON starts_with(i._key, q._key)
               WHERE i.freq2 > 0 AND i.freq2 + 1 >= 3 AND q._key NOT IN (SELECT query FROM typed)
               UNION ALL SELECT pre, 'correct', post, freq1 FROM event_pairs WHERE freq1 >= 3)
           {_BEST} 3""")
def suggest_batch(t):
    items, pairs = t.learned
    return sg.suggest_batch(items, pairs, items.select(C("_key").alias("query")), top=3,
                            frequency_threshold=3, similar_search=False)


@query(f"""{_NAMES}, q AS (SELECT DISTINCT pre AS query FROM related
                           UNION SELECT replace(_key, 'e', 'a') FROM catalogue
                           UNION SELECT substring(_key, 2) FROM catalogue),
           hits AS (
               SELECT query, 'complete' AS type, _key, freq2 + 1 + boost AS _score
               FROM q JOIN catalogue ON starts_with(_key, query)
                   OR starts_with(string_split(_key, ' ')[1], query)
                   OR starts_with(string_split(_key, ' ')[2], query)
               WHERE freq2 + 1 >= 10
               UNION ALL
               SELECT query, 'correct', _key, freq2 + boost
               FROM q JOIN catalogue ON levenshtein(_key, query) <= 2 AND {_shared('_key', 'query')}
               WHERE query NOT IN (SELECT _key FROM catalogue) AND freq2 >= 10
               UNION ALL
               SELECT pre, 'suggest', post, freq2 + boost FROM related
               JOIN catalogue USING (freq2) WHERE _key = post AND freq2 >= 10)
           {_BEST} 5""")
def suggest_batch_names(t):
    items, pairs = t.catalogue
    asked = pairs.select(C("pre").alias("query")).union(
        items.select(F.replace("_key", F.lit("e"), F.lit("a")))).union(
        items.select(F.expr("substring(_key, 2)")))
    return sg.suggest_batch(items, pairs, asked, top=5, frequency_threshold=10)


# --- stored completions ---------------------------------------------------------------------------

_SPELLED = """spelled AS (
    SELECT DISTINCT substring(name, 1, n) AS query, _key, freq2, freq2 + boost AS _by
    FROM (SELECT _key, freq2, boost,
                 unnest(list_distinct(list_append(string_split(_key, ' '), _key))) AS name
          FROM catalogue), range(1, 33) r(n) WHERE n <= length(name))"""


def _merged_prefixes(t, best):
    """Built from the items of one half of the keys, then the other half is merged in."""
    items, _ = t.catalogue
    store = PrefixStore(t.spark, scratch_path(t.spark, "prefixes"), best, buckets=8)
    half = F.pmod(F.xxhash64("_key"), F.lit(2)) == 0
    store.build(items.filter(half))
    store.merge(items.filter(~half))
    return store


@query(f"""WITH {CATALOGUE}, {_SPELLED}
           SELECT query, _key, freq2, _by, place FROM (
               SELECT *, row_number() OVER (PARTITION BY query ORDER BY _by DESC, _key) AS place
               FROM spelled) WHERE place <= 21""")
def prefix_table(t):
    return _merged_prefixes(t, 20).rows()


@query("""WITH counted AS (
               SELECT word AS _key, count(*) AS freq2 FROM (
                   SELECT unnest(regexp_extract_all(lower(text), '\\p{L}+|\\p{N}+')) AS word FROM documents)
               GROUP BY word),
           spelled AS (SELECT substring(_key, 1, n) AS query, _key, freq2
                       FROM counted, range(1, 33) r(n) WHERE n <= length(_key))
           SELECT query, _key, freq2, place FROM (
               SELECT *, row_number() OVER (PARTITION BY query ORDER BY freq2 DESC, _key) AS place
               FROM spelled) WHERE place <= 11""")
def prefix_table_words(t):
    """The ten best completions, and one more, of every prefix of every word of the documents."""
    found = t.texts.select(F.explode(words(C("text"))).alias("_key"))
    return prefixes.prefix_table(found.groupBy("_key").agg(F.count("*").alias("freq2")), 10) \
        .drop("_by")


@query(f"""WITH {CATALOGUE}, {_SPELLED}, hits AS (
               SELECT query, 'complete' AS type, _key, freq2 + 1 + boost AS _score
               FROM catalogue JOIN (SELECT DISTINCT query FROM spelled) ON starts_with(_key, query)
                   OR starts_with(string_split(_key, ' ')[1], query)
                   OR starts_with(string_split(_key, ' ')[2], query)
               WHERE freq2 + 1 >= 30)
           {_BEST} 10""")
def prefix_serve(t):
    """Every prefix of every item completed: from the stored table, and from the items where its
    lists of 40 hold fewer than ten that are frequent enough."""
    items, pairs = t.catalogue
    store = _merged_prefixes(t, 40)
    asked = store.rows().select("query").distinct()
    return sg.suggest_batch(items, pairs, asked, ("complete",), top=10, frequency_threshold=30,
                            prefixes=store)
