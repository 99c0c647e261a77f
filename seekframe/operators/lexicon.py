"""A lexicon: the distinct tokens of an index, found by how they start and by what they hold.

Two tables. Tokens lie sorted, so those with a common start are one range that Parquet prunes to.
Grams are all runs of three characters inside a token with the token's hash, in one folder per gram
bucket; a token holds a text if it is under each of its grams and then holds it whole. A shorter text,
which a large share of all tokens hold, is looked for in the tokens themselves. Both grow with the number of different tokens, not with the texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.functions.text import BLANK
from seekframe.functions.tokens import Tokenizer, spec_of, with_tokens
from seekframe.operators import search
from seekframe.operators.index import BUCKETS, phrase_tokens, read_tokens, write_index
from seekframe.operators.skew import join_lookup
from seekframe.session import materialise

GRAM = 3  # characters of a gram
LISTED = 500  # tokens in one pushed-down filter

Postings = Callable[[list[str] | None], DataFrame]


def held_tokens(df: DataFrame, id_col: str, column: str,
                tokenizer: str | Tokenizer = "TokenBigram") -> DataFrame:
    """``id, token``: which text holds which token, each once. Postings without places, for where
    only that is asked; made within a row, without a shuffle."""
    cut = with_tokens(df.select(id_col, column), column, tokenizer)
    return cut.select(id_col, F.explode(F.array_distinct("_tokens")).alias("token"))


def _grams(token: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(token, F.lit(f"(?s)(?=(.{{{GRAM}}}))."), F.lit(1)))


def _add(tokens: DataFrame, path: str, buckets: int) -> None:
    tokens = materialise(tokens, "tokens")  # the ranges are sampled from it
    # A token counts as known when its grams are there; given again, grams may be there twice.
    grams = tokens.select(F.col("_hash").alias("held"), F.explode(_grams(F.col("token"))).alias("token"))
    write_index(grams, "held", f"{path}/grams", buckets)
    tokens.repartitionByRange("token").sortWithinPartitions("token") \
        .write.mode("append").parquet(f"{path}/tokens")


def _distinct(postings: DataFrame) -> DataFrame:
    return postings.select("token").distinct().withColumn("_hash", F.xxhash64("token"))


def write_lexicon(postings: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Store the lexicon of ``postings`` (or of any table with a ``token``)."""
    _add(_distinct(postings), path, buckets)


def extend_lexicon(postings: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Add the tokens of new postings that are not there yet; nothing stored is rewritten. Tokens
    whose last text is gone may stay: they have no postings, so no result changes."""
    known = postings.sparkSession.read.parquet(f"{path}/tokens").select("token")
    _add(join_lookup(_distinct(postings), known, "token", "left_anti", salts=1), path, buckets)


def tokens_starting(spark: SparkSession, path: str, text: str) -> DataFrame:
    """``token``: those that start with ``text``, one range of the sorted tokens."""
    return spark.read.parquet(f"{path}/tokens").filter(F.col("token").startswith(text)) \
        .select("token")


def tokens_holding(spark: SparkSession, path: str, text: str) -> DataFrame:
    """``token``: those that hold ``text`` anywhere. Only the buckets of its grams are opened, and
    the tokens under all of them are compared whole; for a text shorter than a gram, all tokens."""
    known = spark.read.parquet(f"{path}/tokens").filter(F.contains(F.col("token"), F.lit(text)))
    if len(text) < GRAM:
        return known.select("token")
    grams = list(dict.fromkeys(text[i:i + GRAM] for i in range(len(text) - GRAM + 1)))
    under = read_tokens(spark, f"{path}/grams", grams).groupBy("held").agg(F.count("*").alias("_n"))
    hashes = under.filter(F.col("_n") >= len(grams)).select(F.col("held").alias("_hash"))
    return join_lookup(known, hashes, "_hash", "left_semi", salts=1).select("token")


def _texts_with(postings: Postings, id_col: str, tokens: DataFrame) -> DataFrame:
    """Ids of the texts that hold any of ``tokens``. A short list opens the buckets of its tokens
    only; a longer one is joined, hot tokens salted."""
    tokens = materialise(tokens, "wanted")
    listed = [r.token for r in tokens.limit(LISTED + 1).collect()]
    if len(listed) <= LISTED:
        found = postings(listed)
    else:
        found = join_lookup(postings(None), tokens, "token", "left_semi")
    return found.select(id_col).distinct()


def match_escalation(spark: SparkSession, path: str, postings: Postings, texts: DataFrame,
                     id_col: str, column: str, term: str, threshold: int,
                     tokenizer: str | Tokenizer = "TokenBigram") -> DataFrame:
    """``id, _tier`` as of :func:`search.match_escalation`, from the lexicon at ``path``.

    ``postings`` gives the postings of a list of tokens, or all of them for None. A term that can only
    stand inside one token is answered without a text: tier by tier, each reads the postings of
    the tokens that the tiers before did not have, and the first tier with more than ``threshold`` texts
    ends it. A term that spans tokens is looked for in the texts that hold all of its pieces.
    Null texts match nothing; an empty or blank term is left to the texts.
    """
    term = term.lower()
    pieces = list(dict.fromkeys(phrase_tokens(texts, term, tokenizer)))
    blank = texts.sparkSession.range(1).select(F.lit(term).rlike(f"[{BLANK}]")).head()[0]
    if pieces == [term] and not blank and not _joins_blanks(tokenizer):
        return _by_tiers(spark, path, postings, id_col, term, threshold)
    rows = texts
    for piece in pieces:
        held = _texts_with(postings, id_col, tokens_holding(spark, path, piece))
        rows = join_lookup(rows, materialise(held, "candidates"), id_col, "left_semi", salts=1)
    return search.match_escalation(rows, column, term, threshold, tokenizer).select(id_col, "_tier")


def _joins_blanks(tokenizer: str | Tokenizer) -> bool:
    # Such a token may stand over a blank of the text, where the term does not match.
    return spec_of(tokenizer).ignore_blank


def _by_tiers(spark: SparkSession, path: str, postings: Postings, id_col: str, term: str,
              threshold: int) -> DataFrame:
    token = F.col("token")
    starting = tokens_starting(spark, path, term)
    tiers = [starting.filter(token == term), starting.filter(token != term),
             tokens_holding(spark, path, term).filter(~token.startswith(term))]
    found, size = None, 0
    for tier, tokens in enumerate(tiers, 1):
        more = _texts_with(postings, id_col, tokens)
        if found is not None:
            more = join_lookup(more, found.select(id_col), id_col, "left_anti", salts=1)
        more = more.withColumn("_tier", F.lit(tier))
        if tier == len(tiers):
            return found.unionByName(more)
        more = materialise(more, "tier")
        found = more if found is None else found.unionByName(more)
        size += more.count()
        if size > threshold:
            return found
