"""Tokenizers as column expressions: a text column becomes an array of tokens in document order.

Text is normalised, cut at blanks and then into runs of one character class: CJK, alpha, digit or
symbol. CJK runs and runs of the classes a tokenizer splits become overlapping n-grams; adjacent
runs of those classes count as one; a run shorter than n is a token itself; any other run is one
token.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.functions.text import BLANK, normalise

# Han, Hiragana, Katakana and the long-vowel mark as code point ranges: a range test is a few times
# faster than a script test.
CJK = (r"\u2E80-\u2FDF\u3005-\u3007\u3021-\u3029\u3038-\u303B\u3041-\u3096\u309D-\u309F"
       r"\u30A1-\u30FA\u30FC-\u30FF\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF"
       r"\uFF66-\uFF9D\x{20000}-\x{323AF}")
WIDE = r"\u2E80-\x{10FFFF}"  # one range that holds all of CJK, for a quick test
CLASSES = {
    "alpha": r"\p{L}",
    "digit": r"\p{N}",
    "symbol": r"[^\p{L}\p{N} ]",  # the blank is the only white space left after normalising
}


@dataclass(frozen=True)
class Tokenizer:
    n: int = 2
    split: tuple[str, ...] = ()
    ignore_blank: bool = False
    delimiter: str | None = None


# Tokenizer names and what each stands for.
TOKENIZERS = {
    "TokenUnigram": Tokenizer(n=1),
    "TokenBigram": Tokenizer(n=2),
    "TokenTrigram": Tokenizer(n=3),
    "TokenBigramSplitSymbol": Tokenizer(split=("symbol",)),
    "TokenBigramSplitSymbolAlpha": Tokenizer(split=("symbol", "alpha")),
    "TokenBigramSplitSymbolAlphaDigit": Tokenizer(split=("symbol", "alpha", "digit")),
    "TokenBigramIgnoreBlank": Tokenizer(ignore_blank=True),
    "TokenBigramIgnoreBlankSplitSymbol": Tokenizer(ignore_blank=True, split=("symbol",)),
    "TokenBigramIgnoreBlankSplitAlpha": Tokenizer(ignore_blank=True, split=("alpha",)),
    "TokenBigramIgnoreBlankSplitAlphaDigit":
        Tokenizer(ignore_blank=True, split=("alpha", "digit")),
    "TokenDelimit": Tokenizer(delimiter=" "),
    "TokenDelimitNull": Tokenizer(delimiter="\\x00"),
}


def _ngrams(run: Column, n: int) -> Column:
    # The lookahead captures n characters at every position, in one linear pass over the run.
    grams = F.regexp_extract_all(run, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1))
    return F.when(F.length(run) <= n, F.array(run)).otherwise(grams)


def _prepared(col: Column, spec: Tokenizer) -> Column:
    return F.regexp_replace(F.lower(col), f"[{BLANK}]+", "") if spec.ignore_blank \
        else normalise(col)


def _cut(text: Column, spec: Tokenizer) -> Column:
    """Tokens of prepared text."""
    if spec.delimiter:
        return F.filter(F.split(text, spec.delimiter, -1), lambda t: t != "")
    split = "".join(CLASSES[name] for name in spec.split)
    whole = [CLASSES[name] for name in CLASSES if name not in spec.split]

    def runs(patterns: list[str]) -> Column:
        return F.regexp_extract_all(text, F.lit("|".join(patterns)), F.lit(0))

    def cut_runs(found: Column, grammed: str) -> Column:
        return F.flatten(F.transform(found, lambda run: F.when(
            run.rlike(f"^[{grammed}]"), _ngrams(run, spec.n)).otherwise(F.array(run))))

    mixed = cut_runs(runs([f"[{split}{CJK}]+", *(f"[{c}&&[^{CJK}]]+" for c in whole)]),
                     split + CJK)
    # Most texts have no such characters, and their classes need no exclusions.
    plain = runs([f"[{c}]+" for c in ([split] if split else []) + whole])
    if split:
        plain = cut_runs(plain, split)
    return F.when(text.rlike(f"[{WIDE}]"), mixed).otherwise(plain)


def spec_of(tokenizer: str | Tokenizer) -> Tokenizer:
    return TOKENIZERS[tokenizer] if isinstance(tokenizer, str) else tokenizer


def tokens(col: Column, tokenizer: str | Tokenizer = "TokenBigram") -> Column:
    """Array of the tokens of ``col``."""
    spec = spec_of(tokenizer)
    return _cut(_prepared(col, spec), spec)


def with_tokens(df: DataFrame, text_col: str, tokenizer: str | Tokenizer = "TokenBigram",
                into: str = "_tokens") -> DataFrame:
    """Add the token array; text is prepared once and cut once, however often it is used later."""
    spec = spec_of(tokenizer)
    prepared = df.withColumn("_text", _prepared(F.col(text_col), spec))
    return add_once(prepared, into, _cut(F.col("_text"), spec)).drop("_text")


def add_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column. As the output of a generator it is a plain value to later filters and
    projections; a projected expression would be evaluated again in each of them."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def words(col: Column) -> Column:
    """Letter runs and digit runs in lower case; punctuation is dropped."""
    return F.regexp_extract_all(F.lower(col), F.lit(r"\p{L}+|\p{N}+"), F.lit(0))


def word_ngrams(word_list: Column, longest: int) -> Column:
    """All runs of 1 to ``longest`` consecutive entries of a word array, joined by one blank."""
    grams = current = word_list
    for size in range(2, longest + 1):
        # ``current`` holds the grams of the size before; append to each the word that follows it.
        room = F.greatest(F.size(word_list) - (size - 1), F.lit(0))
        current = F.zip_with(F.slice(current, 1, room), F.slice(word_list, size, room),
                             lambda a, b: F.concat_ws(" ", a, b))
        grams = F.concat(grams, current)
    return grams


def postings(df: DataFrame, id_col: str, text_col: str,
             tokenizer: str | Tokenizer = "TokenBigram") -> DataFrame:
    """One row per token: id, token, zero-based position in the document."""
    spec = spec_of(tokenizer)
    prepared = df.select(id_col, _prepared(F.col(text_col), spec).alias("_text"))
    return prepared.select(id_col, F.posexplode(_cut(F.col("_text"), spec))
                           .alias("position", "token")).select(id_col, "token", "position")
