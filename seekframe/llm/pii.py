"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, scheme marks, plus signs, digits and identifier cues
such as ``iban``. From each anchor a small parser walks outwards to the borders of the address or
number and validates it. No pattern is tried at other places, and no text is scanned twice.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.session import spread

BASE = ("email", "ip", "card", "phone")
ADDED = ("login", "iban", "account", "secret")
KINDS = BASE + ADDED

ACCOUNT_CUES = ("account", "acct", "iban", "ssn", "passport", "konto", "cuenta", "compte")
SECRET_CUES = ("password", "passwd", "secret", "token", "api_key", "apikey")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOGIN = re.compile(r"[^\s/@:]+(?::[^\s/@]*)?@(?=[A-Za-z0-9])")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_ACCOUNT = re.compile(r"(?:[ \t]*(?:number|no|nr|num|#|:|=|\.))*[ \t]*"
                      r"([A-Z]{0,3}[0-9](?:[ -]?[0-9A-Z]){4,32})(?![A-Za-z0-9])")
_SECRET = re.compile(r"[ \t]*[:=][ \t]*[\"']?([^\s\"']{8,})")
_KEY = re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])")


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for mark in ("@", "://", "+", "AKIA"):
        automaton.add_word(mark, (mark, len(mark)))
    for digit in "0123456789":
        automaton.add_word(digit, ("0", 1))
    for kind, cues in (("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                automaton.add_word(form, (kind, len(form)))
    automaton.make_automaton()
    return automaton


def luhn(digits: str) -> bool:
    total = 0
    for place, char in enumerate(reversed(digits)):
        value = int(char) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def iban_valid(code: str) -> bool:
    moved = code[4:] + code[:4]
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def find(text: str | None) -> dict[str, list[tuple[int, int]]]:
    """Spans by kind, in code points, ends exclusive.

    Base kinds hold what the leftmost non-overlapping matches of their patterns give, without those
    that fail their check. Added kinds: ``login`` (user and password before the host of a url),
    ``iban`` and ``account`` after an identifier cue, ``secret`` (a value after a password or token
    cue, or an access key). A null text has no spans.
    """
    spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    if not text:
        return spans
    email = digit = ip = card = phone = 0  # where the last match of each kind ended
    for last, (mark, size) in _anchors().iter(text):
        at = last - size + 1
        if mark == "0":
            if at >= ip and at >= digit:
                found = _IP.match(text, at)
                if found:
                    ip = digit = found.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
                           for p in found.groups()):
                        spans["ip"].append(found.span())
                else:
                    digit = _DIGITS.match(text, at).end()
            if at >= card:
                found = _CARD.match(text, at)
                card = found.end() if found else at + 1
                if found and found.end() - at >= 16:
                    digits = _only_digits(found[0])
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        spans["card"].append(found.span())
        elif mark == "@":
            start = at
            while start > email and text[start - 1] in _LOCAL:
                start -= 1
            found = _DOMAIN.match(text, at + 1) if start < at else None
            if found:
                email = found.end()
                spans["email"].append((start, email))
        elif mark == "+":
            found = _PHONE.match(text, at)
            if found and at >= phone:
                phone = found.end()
                if 8 <= len(_only_digits(found[0])) <= 15:
                    spans["phone"].append(found.span())
        elif mark == "://":
            found = _LOGIN.match(text, last + 1)
            if found:
                spans["login"].append((found.start(), found.end() - 1))
        elif mark == "AKIA":
            found = _KEY.match(text, at)
            if found and not (at and text[at - 1].isalnum()):
                spans["secret"].append(found.span())
        elif not (at and text[at - 1].isalnum()):
            found = (_ACCOUNT if mark == "account" else _SECRET).match(text, last + 1)
            if mark == "secret" and found:
                spans["secret"].append(found.span(1))
            elif mark == "account":
                # The code may stand a few blanks and signs behind the cue.
                start = last + 1
                while start < len(text) and text[start] in " \t:=.#":
                    start += 1
                code = _IBAN.match(text, start)
                if code and iban_valid(code[0].replace(" ", "")):
                    spans["iban"].append(code.span())
                elif found and sum(c.isdigit() for c in found[1]) >= 5:
                    spans["account"].append(found.span(1))
    return spans


def listed(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by kind as listed, then start, joined by commas."""
    return ",".join(f"{kind}:{a}:{b}" for kind in kinds for a, b in sorted(set(spans[kind])))


def redact(text: str | None) -> str | None:
    """The text with each span replaced by its kind in angle brackets.

    Overlapping spans become one, named by the first; a null text stays null.
    """
    if not text:
        return text
    spans = find(text)
    marks = sorted((a, -b, KINDS.index(kind), b, kind) for kind in KINDS for a, b in spans[kind])
    out, at = [], 0
    shown = None
    for start, _, _, end, kind in marks:
        if shown and start < at:
            at = max(at, end)
            continue
        out += [text[at:start], f"<{kind.upper()}>"]
        at, shown = end, kind
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, id_column: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """Counts, digest of the base spans, and all spans of every document.

    Null texts count as empty. Every row is judged by itself, so ids may be null or repeat. Whole
    texts are read, in one pass each. Extra columns are left out, whatever their names.
    """
    fields = T.StructType([
        T.StructField(id_column, docs.schema[id_column].dataType),
        *[T.StructField(f"n_{kind}", T.LongType()) for kind in BASE],
        T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [find(t if isinstance(t, str) else None) for t in batch["_text"]]
            columns = {id_column: batch["_id"].to_numpy()}
            for kind in BASE:
                columns[f"n_{kind}"] = [len(spans[kind]) for spans in found]
            columns["base_sha256"] = pd.Series(
                [hashlib.sha256(listed(s, BASE).encode()).hexdigest() for s in found], dtype=object)
            columns["spans"] = pd.Series([listed(s, KINDS) for s in found], dtype=object)
            yield pd.DataFrame(columns)

    source = docs.selectExpr(f"`{id_column}` AS _id", f"`{text}` AS _text")
    return spread(source).mapInPandas(run, fields)


def redact_documents(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents with personal data replaced; same rows and columns. ``length``, if there is
    such a column, is set to the new number of characters where the text has changed."""
    def cleaned(texts: pd.Series) -> pd.Series:
        return pd.Series([redact(t if isinstance(t, str) else None) for t in texts], dtype=object)

    new = "_pii_redacted"
    out = spread(docs).withColumn(new, F.pandas_udf(cleaned, T.StringType())(F.col(text)))
    columns = []
    for name in docs.columns:
        if name == text:
            columns.append(F.col(new).alias(name))
        elif name == length:
            kept = F.col(name)
            columns.append(F.when(F.col(new).eqNullSafe(F.col(text)), kept)
                           .otherwise(F.length(new).cast(docs.schema[name].dataType)).alias(name))
        else:
            columns.append(F.col(f"`{name}`"))
    return out.select(*columns)
