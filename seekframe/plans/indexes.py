"""Tokenizers and inverted indexes."""

from pyspark.sql import functions as F

from seekframe.functions.tokens import TOKENIZERS, postings
from seekframe.operators import impacts
from seekframe.operators import index as ix
from seekframe.plans import sql
from seekframe.plans.registry import query
from seekframe.session import scratch_path

C = F.col


def _summary(rows):
    """Per token: documents, occurrences, sum of positions. Wrong cuts or places show up here."""
    per_doc = rows.groupBy("doc_id", "token").agg(
        F.count("*").alias("n"), F.sum("position").alias("places"))
    return per_doc.groupBy("token").agg(F.count("*").alias("df"), F.sum("n").alias("tf"),
                                        F.sum("places").alias("places"))


def _summary_sql(rows):
    return f"""SELECT token, count(DISTINCT doc_id) AS df, count(*) AS tf,
                      CAST(sum(position) AS BIGINT) AS places FROM ({rows}) GROUP BY token"""


# Registered query -> tokenizer name.
_QUERIES = {
    "tokens_unigram": "TokenUnigram",
    "tokens_bigram": "TokenBigram",
    "tokens_trigram": "TokenTrigram",
    "tokens_bigram_symbol": "TokenBigramSplitSymbol",
    "tokens_bigram_symbol_alpha": "TokenBigramSplitSymbolAlpha",
    "tokens_bigram_all": "TokenBigramSplitSymbolAlphaDigit",
    "tokens_bigram_ib": "TokenBigramIgnoreBlank",
    "tokens_bigram_ib_symbol": "TokenBigramIgnoreBlankSplitSymbol",
    "tokens_bigram_ib_alpha": "TokenBigramIgnoreBlankSplitAlpha",
    "tokens_bigram_ib_alpha_digit": "TokenBigramIgnoreBlankSplitAlphaDigit",
}


def _register(key, tokenizer):
    spec = TOKENIZERS[tokenizer]
    tokens = sql.token_list("text", spec.n, spec.split, spec.ignore_blank)
    query(_summary_sql(sql.postings("documents", "doc_id", tokens)), key)(
        lambda t: _summary(postings(t.texts, "doc_id", "text", tokenizer)))


for _key, _tokenizer in _QUERIES.items():
    _register(_key, _tokenizer)


def _delimited(text, mark):
    return f"list_filter(string_split({text}, {mark}), lambda x: x <> '')"


@query(_summary_sql(sql.postings("documents", "doc_id",
                                 _delimited(sql.normalised("text"), "' '"))))
def tokens_delimit(t):
    return _summary(postings(t.texts, "doc_id", "text", "TokenDelimit"))


@query(_summary_sql(sql.postings(
    "documents", "doc_id",
    _delimited("concat(lang, chr(0), source, chr(0), CAST(n_chars AS VARCHAR))", "chr(0)"))))
def tokens_delimit_null(t):
    packed = t.documents.select("doc_id", F.concat_ws(
        "\0", "lang", "source", C("n_chars").cast("string")).alias("packed"))
    return _summary(postings(packed, "doc_id", "packed", "TokenDelimitNull"))


# --- indexes ------------------------------------------------------------------------------------

_TOKENS = sql.token_list("text")


@query(f"""SELECT token, count(DISTINCT doc_id) AS df, count(*) AS tf
           FROM ({sql.postings('documents', 'doc_id', _TOKENS)}) GROUP BY token""")
def index_build(t):
    path = scratch_path(t.spark, "index")
    ix.write_index(ix.build_postings(t.texts, "doc_id", ["text"]), "doc_id", path, buckets=16)
    return ix.term_stats(ix.read_index(t.spark, path), "doc_id")


@query(f"""SELECT turn_id, token, CAST(position AS INTEGER) AS position FROM (
           {sql.postings("(SELECT concat(conv_id, '-', turn) AS turn_id, text FROM conversations)",
                         'turn_id', _TOKENS)})""")
def index_positions(t):
    turns = t.conversations.select(F.concat_ws("-", "conv_id", "turn").alias("turn_id"), "text")
    return ix.build_postings(turns, "turn_id", ["text"])


_SECTIONS = " UNION ALL ".join(
    f"""SELECT p_partkey, token, CAST(position AS INTEGER) AS position, {section} AS section,
               {weight} AS weight
        FROM ({sql.postings('part', 'p_partkey', sql.token_list(column))})"""
    for section, (column, weight) in enumerate({"p_name": 10, "p_type": 3}.items(), 1))


@query(f"SELECT p_partkey, token, position, section FROM ({_SECTIONS})")
def index_sections(t):
    return ix.build_postings(t.part, "p_partkey", ["p_name", "p_type"], sections=True)


@query(f"""SELECT p_partkey, CAST(sum(weight) AS INTEGER) AS _score FROM ({_SECTIONS})
           WHERE token IN ('ring', 'hot', 'promo') GROUP BY p_partkey""")
def index_weights(t):
    index = ix.build_postings(t.part, "p_partkey", {"p_name": 10, "p_type": 3}, sections=True,
                              weights=True)
    return ix.match_terms(index, "p_partkey", ["ring", "hot", "promo"])


@query("""SELECT o_custkey AS _key, count(*) AS _nsubrecs FROM orders GROUP BY o_custkey""")
def index_reverse_ref(t):
    return ix.reverse_refs(t.orders, "o_custkey")


@query("""SELECT o_orderkey, o_custkey FROM orders
          WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)""")
def index_reverse_ref_rows(t):
    rich = t.customer.filter(C("c_acctbal") > 9000)
    return ix.rows_pointing_to(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", rich,
                               "c_custkey")


@query("""SELECT l_partkey AS _key, count(DISTINCT l_orderkey) AS _nsubrecs
          FROM lineitem GROUP BY l_partkey""")
def index_reverse_vector(t):
    return ix.reverse_refs(_orders_with_parts(t), "parts")


@query("""SELECT DISTINCT l_orderkey FROM lineitem
          WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 48)""")
def index_reverse_vector_rows(t):
    large = t.part.filter(C("p_size") > 48)
    return ix.rows_pointing_to(_orders_with_parts(t), "parts", large, "p_partkey", "l_orderkey") \
        .select("l_orderkey")


def _orders_with_parts(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("parts"))


@query(f"""SELECT doc_id, lang, CAST(count(*) AS INTEGER) AS _score
           FROM ({sql.postings('documents', 'doc_id', _TOKENS)}) JOIN documents USING (doc_id)
           WHERE token IN ('und', 'für', 'the') GROUP BY doc_id, lang""")
def index_match(t):
    terms = ["und", "Für", "the"]
    hits = ix.match_terms(ix.read_index(t.spark, t.stored_index, terms), "doc_id", terms)
    return t.documents.select("doc_id", "lang").join(hits, "doc_id")


@query(f"""WITH p AS ({sql.postings('documents', 'doc_id', _TOKENS)})
           SELECT doc_id, CAST(count(*) AS INTEGER) AS _score
           FROM p a JOIN p b USING (doc_id)
           WHERE a.token = 'of' AND b.token = 'the' AND b.position = a.position + 1
           GROUP BY doc_id""")
def index_phrase(t):
    phrase = ix.phrase_tokens(t.documents, "Of the")
    return ix.match_phrase(ix.read_index(t.spark, t.stored_index, phrase), "doc_id", phrase)


@query(f"""WITH scored AS (SELECT doc_id, CAST(count(*) AS INTEGER) AS _score
               FROM ({sql.postings('documents', 'doc_id', _TOKENS)})
               WHERE token IN ('und', 'für', 'the') GROUP BY doc_id)
           SELECT doc_id, _score, CAST(row_number() OVER (ORDER BY _score DESC, doc_id) AS INTEGER) AS rank
           FROM scored ORDER BY _score DESC, doc_id LIMIT 20""")
def index_topk(t):
    """The best of ``index_match``, opening only ranges that can hold one."""
    terms = ["und", "Für", "the"]
    return impacts.top_terms(ix.read_index(t.spark, t.stored_index, terms),
                             impacts.read_impacts(t.spark, t.stored_impacts, terms), "doc_id", terms, 20)
