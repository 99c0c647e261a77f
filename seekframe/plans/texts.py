"""Matching, scores, near, similar, term extraction, normalizers."""

from pyspark.sql import functions as F

from seekframe.functions import text as tx
from seekframe.functions.tokens import words
from seekframe.operators import index, lexicon, search, similar, terms
from seekframe.operators import paging as pg
from seekframe.plans import sql
from seekframe.plans.registry import query

C = F.col
_DOCS = "SELECT doc_id, lang, n_chars FROM documents WHERE "


def _docs(df):
    return df.select("doc_id", "lang", "n_chars")


def _count(column, term):
    return (f"CAST((length(lower({column})) - length(replace(lower({column}), '{term}', ''))) "
            f"// {len(term)} AS INTEGER)")


@query(_DOCS + "contains(lower(text), 'ness')")
def match_substring(t):
    return _docs(t.documents.filter(tx.matches(C("text"), "NEss")))


@query("""SELECT p_partkey, p_name, p_type FROM part
          WHERE contains(lower(p_name), 'ring') OR contains(lower(p_type), 'promo')""")
def match_columns_any(t):
    return t.part.filter(tx.matches_any([C("p_name"), C("p_type")], "ring")
                         | tx.matches_any([C("p_name"), C("p_type")], "promo")) \
        .select("p_partkey", "p_name", "p_type")


@query(f"""SELECT doc_id, {_count('text', 'the')} * 10 + {_count('lang', 'e')} * 3
                  + {_count('text', 'and')} * 10 + {_count('lang', 'and')} * 3 AS _score
           FROM documents WHERE contains(lower(text), 'the') OR contains(lower(lang), 'e')""")
def match_columns_weighted(t):
    weights = {"text": 10, "lang": 3}
    rows = t.documents.filter(tx.matches(C("text"), "the") | tx.matches(C("lang"), "e"))
    one = tx.score({"text": 10}, ["the"]) + tx.score({"lang": 3}, ["e"])
    return rows.select("doc_id", (one + tx.score(weights, ["and"])).alias("_score"))


@query(f"""SELECT doc_id, {_count('text', 'der')} AS _score FROM documents
           WHERE contains(lower(text), 'der')""")
def match_score(t):
    return t.documents.filter(tx.matches(C("text"), "der")) \
        .select("doc_id", tx.score({"text": 1}, ["der"]).alias("_score"))


_TOP = f"""SELECT doc_id, lang, n_chars, {_count('text', 'the')} AS _score FROM documents
           WHERE contains(lower(text), 'the') AND n_chars > 200
           ORDER BY _score DESC, doc_id LIMIT 10"""


def top_documents(documents, term="the", chars=200, limit=10):
    """The flagship search: long texts with a term, best score first."""
    rows = documents.filter((C("n_chars") > chars) & tx.matches(C("text"), term)) \
        .select("doc_id", "lang", "n_chars", tx.score({"text": 1}, [term]).alias("_score"))
    return pg.rank_page(pg.page(rows, ["-_score"], limit, tie="doc_id"), ["-_score"], tie="doc_id")


@query(f"SELECT *, row_number() OVER (ORDER BY _score DESC, doc_id) AS rank FROM ({_TOP})")
def match_topk(t):
    return top_documents(t.documents)


def _escalated(term, threshold):
    return f"""
    WITH hits AS (SELECT doc_id, {sql.token_list('text')} AS ts FROM documents
                  WHERE contains(lower(text), '{term}')),
         tiers AS (SELECT doc_id, CASE WHEN list_contains(ts, '{term}') THEN 1
                       WHEN len(list_filter(ts, lambda x: starts_with(x, '{term}'))) > 0 THEN 2
                       ELSE 3 END AS _tier FROM hits),
         chosen AS (SELECT CASE WHEN count(*) FILTER (WHERE _tier <= 1) > {threshold} THEN 1
                       WHEN count(*) FILTER (WHERE _tier <= 2) > {threshold} THEN 2
                       ELSE 3 END AS tier FROM tiers)
    SELECT doc_id, _tier FROM tiers WHERE _tier <= (SELECT tier FROM chosen)"""


@query(_escalated("ent", 0))
def match_escalation(t):
    return search.match_escalation(t.texts, "text", "Ent", 0).select("doc_id", "_tier")


@query(_escalated("tio", 1000000))
def match_escalation_loose(t):
    return search.match_escalation(t.texts, "text", "tio", 1000000).select("doc_id", "_tier")


def _from_lexicon(t, term, threshold):
    held, path = t.stored_lexicon
    return lexicon.match_escalation(
        t.spark, path, lambda tokens: index.read_tokens(t.spark, held, tokens),
        t.documents.select("doc_id", "text"), "doc_id", "text", term, threshold)


@query(_escalated("ent", 0))
def lexicon_escalation(t):
    """As ``match_escalation``, from the tokens' lexicon: no text is read."""
    return _from_lexicon(t, "Ent", 0)


@query(_escalated("tio", 1000000))
def lexicon_escalation_loose(t):
    return _from_lexicon(t, "tio", 1000000)


@query(_escalated("of the", 0))
def lexicon_escalation_blank(t):
    """A term over a blank is looked for in the texts that hold both of its words."""
    return _from_lexicon(t, "of The", 0)


@query("SELECT doc_id, source FROM documents WHERE starts_with(source, 'src1')")
def filter_startswith(t):
    return t.documents.filter(C("source").startswith("src1")).select("doc_id", "source")


@query("SELECT doc_id, source FROM documents WHERE ends_with(source, '7')")
def filter_endswith(t):
    return t.documents.filter(C("source").endswith("7")).select("doc_id", "source")


def _near_sql(terms, distance):
    # Every start position, the next position of each term from there on, and the widest of them.
    ahead = "OVER (PARTITION BY doc_id ORDER BY position ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    following = ", ".join(
        f"min(CASE WHEN token = '{term}' THEN position END) {ahead} AS p{i}"
        for i, term in enumerate(terms))
    names = ", ".join(f"p{i}" for i in range(len(terms)))
    complete = " AND ".join(f"p{i} IS NOT NULL" for i in range(len(terms)))
    wanted = ", ".join(f"'{term}'" for term in terms)
    return f"""WITH hits AS (SELECT * FROM ({sql.postings('documents', 'doc_id', sql.token_list('text'))})
                             WHERE token IN ({wanted})),
                    spans AS (SELECT doc_id, position, {following} FROM hits)
               SELECT doc_id, CAST(min(greatest({names}) - position) AS INTEGER) AS _span
               FROM spans WHERE {complete} GROUP BY doc_id
               HAVING min(greatest({names}) - position) <= {distance}"""


@query(_near_sql(["that", "with", "from"], 10))
def match_near(t):
    return search.near(t.texts, "text", "that WITH from").select("doc_id", "_span")


@query(_near_sql(["that", "with", "from"], 10))
def near_from_index(t):
    """As ``match_near``, from the postings of the terms alone."""
    wanted = ["that", "with", "from"]
    return index.near(index.read_index(t.spark, t.stored_index, wanted), "doc_id", [[w] for w in wanted])


_LIKE = "The house of the people was in the city and they were there for that time with others"


@query(f"""WITH bags AS (SELECT doc_id, list_distinct({sql.words('text')}) AS mine,
                                list_distinct({sql.words("'" + _LIKE + "'")}) AS theirs
                         FROM documents),
                sizes AS (SELECT doc_id, len(mine) AS a, len(theirs) AS b,
                                 len(list_intersect(mine, theirs)) AS c FROM bags)
           SELECT doc_id, round(c / (a + b - c), 6) AS _similarity FROM sizes
           WHERE round(c / (a + b - c), 6) >= 0.05""")
def match_similar(t):
    return search.similar(t.texts, "text", _LIKE, 0.05).select("doc_id", "_similarity")


@query(f"""WITH bags AS MATERIALIZED (SELECT doc_id, list_distinct({sql.words('text')}) AS w FROM documents),
                sizes AS (SELECT q.doc_id AS query_id, d.doc_id, len(q.w) AS a, len(d.w) AS b,
                              len(list_intersect(q.w, d.w)) AS c
                          FROM bags q JOIN bags d ON q.doc_id % 20 = 0 AND len(q.w) > 0 AND len(d.w) > 0)
           SELECT query_id, doc_id, round(c / (a + b - c), 6) AS _similarity FROM sizes
           WHERE round(c / (a + b - c), 6) >= 0.6""")
def match_similar_batch(t):
    """Every twentieth document as a query against all."""
    asked = t.documents.filter(C("doc_id") % 20 == 0).select(C("doc_id").alias("query_id"), "text")
    return similar.similar_batch(t.texts, "doc_id", "text", asked, "query_id", "text", 0.6)


_VOCABULARY = f"""SELECT DISTINCT w AS term FROM (SELECT unnest({sql.words('text')}) AS w FROM benchmark)
                  UNION SELECT DISTINCT lower(p_name) FROM part"""


@query(f"""WITH vocabulary AS ({_VOCABULARY}),
                ws AS (SELECT doc_id, {sql.words('text')} AS w FROM documents),
                grams AS (SELECT doc_id, unnest(w) AS term FROM ws
                          UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)),
                              lambda i: w[i] || ' ' || w[i + 1])) FROM ws
                          UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w) - 1),
                              lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM ws)
           SELECT doc_id, term, count(*) AS n FROM grams JOIN vocabulary USING (term)
           GROUP BY doc_id, term""")
def term_extract(t):
    single = t.benchmark.select(F.explode(words(C("text"))).alias("_key"))
    vocabulary = single.union(t.part.select(F.lower("p_name"))).distinct()
    return terms.term_extract(t.texts, "doc_id", "text", vocabulary)


@query(f"SELECT conv_id, turn, {sql.normalised('text')} AS text FROM conversations")
def normalize_auto(t):
    return t.conversations.select("conv_id", "turn", tx.normalise(C("text")).alias("text"))


@query("SELECT conv_id, turn, lower(nfc_normalize(text)) AS text FROM conversations")
def normalize_nfkc(t):
    """DuckDB only has the canonical form. The texts hold no compatibility characters, so some are
    put in here, which the function has to take back."""
    text = F.replace(F.replace("text", F.lit("fi"), F.lit("\ufb01")), F.lit("a"), F.lit("\uff41"))
    return t.conversations.select("conv_id", "turn", tx.normalise_nfkc(text).alias("text"))
