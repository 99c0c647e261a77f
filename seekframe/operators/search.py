"""Search operators that look at whole token lists: escalation, near, similar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.functions.text import matches
from seekframe.functions.tokens import Tokenizer, add_once, tokens, with_tokens, words


def match_escalation(df: DataFrame, column: str, term: str, threshold: int,
                     tokenizer: str | Tokenizer = "TokenBigram") -> DataFrame:
    """Match as strictly as gives more than ``threshold`` rows.

    Tier 1 is a whole token, tier 2 the start of a token, tier 3 any substring; ``_tier`` tells how
    a row matched. Tier sizes come from a one-row aggregate used as a scalar subquery.
    """
    term = term.lower()
    # A token is cut from the normalised text, so a substring test admits every tier.
    hits = with_tokens(df.filter(matches(F.col(column), term)), column, tokenizer)
    tier = F.when(F.array_contains("_tokens", term), 1).when(
        F.exists("_tokens", lambda t: t.startswith(F.lit(term))), 2).otherwise(3)
    hits = add_once(hits, "_tier", tier).drop("_tokens")
    size = lambda tier: F.count_if(F.col("_tier") <= tier)
    chosen = hits.agg(F.when(size(1) > threshold, 1).when(size(2) > threshold, 2).otherwise(3))
    return hits.filter(F.col("_tier") <= chosen.scalar())


def shortest_span(token_list: Column, terms: list[str]) -> Column:
    """Smallest distance between the first and last of a group of tokens that holds every term;
    null if a term is missing. One pass that remembers where each term was last seen."""
    terms = list(dict.fromkeys(terms))
    placed = F.transform(token_list, lambda t, at: F.struct(t.alias("t"), at.alias("at")))
    return _shortest(F.filter(placed, lambda p: p["t"].isin(terms)), terms)


def _run_places(token_list: Column, runs: list[list[str]]) -> Column:
    """Where each run of tokens starts, in order, as (number of the run, place)."""
    def starts(number: int, run: list[str]) -> Column:
        whole = F.array(*[F.lit(r) for r in run])
        found = F.transform(token_list, lambda t, at: F.when(
            F.slice(token_list, at + 1, len(run)) == whole,
            F.struct(at.alias("at"), F.lit(str(number)).alias("t"))))
        return F.filter(found, lambda p: p.isNotNull())
    return F.array_sort(F.concat(*[starts(i, run) for i, run in enumerate(runs)]))


def _shortest(wanted: Column, terms: list[str]) -> Column:
    names = [f"l{i}" for i in range(len(terms))]
    missing = F.lit(None).cast("int")
    start = F.struct(*[missing.alias(n) for n in names], missing.alias("best"))

    def step(state: Column, p: Column) -> Column:
        last = [F.when(p["t"] == term, p["at"]).otherwise(state[n])
                for n, term in zip(names, terms)]
        complete = last[0].isNotNull()
        for seen in last[1:]:
            complete = complete & seen.isNotNull()
        oldest = F.least(*last) if len(last) > 1 else last[0]
        best = F.least(state["best"], F.when(complete, p["at"] - oldest))
        return F.struct(*[seen.alias(n) for seen, n in zip(last, names)], best.alias("best"))

    return F.aggregate(wanted, start, step, lambda state: state["best"])


def near(df: DataFrame, column: str, text: str, distance: int = 10,
         tokenizer: str | Tokenizer = "TokenBigram") -> DataFrame:
    """Rows where all blank-separated terms stand within ``distance`` tokens; ``_span`` is the
    smallest such distance. Works row by row, without a shuffle."""
    terms = list(dict.fromkeys(text.lower().split()))
    if not terms:
        raise ValueError("near needs at least one term")
    # A term is cut by the rules of the text; one of several tokens is looked for as their run.
    runs = df.sparkSession.range(1).select(
        F.array(*[tokens(F.lit(t), tokenizer) for t in terms])).head()[0]
    rows = df
    for term in terms:  # cheap test before the text is cut into tokens
        rows = rows.filter(matches(F.col(column), term))
    rows = with_tokens(rows, column, tokenizer)
    if all(len(run) == 1 for run in runs):
        span = shortest_span(F.col("_tokens"), [run[0] for run in runs])
    else:
        span = _shortest(_run_places(F.col("_tokens"), runs), [str(i) for i in range(len(runs))])
    spans = add_once(rows, "_span", span).drop("_tokens")
    return spans.filter(F.col("_span") <= distance)


def similar(df: DataFrame, column: str, text: str, threshold: float = 0.1) -> DataFrame:
    """Rows whose distinct words resemble those of ``text``: ``_similarity`` is the Jaccard
    coefficient. The query words are a literal array, so this too needs no shuffle."""
    mine, theirs = F.col("_mine"), F.array_distinct(words(F.lit(text)))
    rows = add_once(df, "_mine", F.array_distinct(words(F.col(column))))
    rows = add_once(rows, "_common", F.size(F.array_intersect(mine, theirs)))
    union = F.size(mine) + F.size(theirs) - F.col("_common")
    return rows.withColumn("_similarity", F.round(F.try_divide(F.col("_common"), union), 6)) \
        .drop("_mine", "_common").filter(F.col("_similarity") >= threshold)
