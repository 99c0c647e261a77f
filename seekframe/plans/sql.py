"""Building blocks of the SQL counterparts."""

from __future__ import annotations

BLANK = r"\x09-\x0D\x20\x85\p{Z}"
SYMBOL = r"\p{M}\p{P}\p{S}\p{Cf}\p{Co}\x00-\x08\x0E-\x1F\x7F-\x84\x86-\x9F"
CJK = r"\p{Han}\p{Hiragana}\p{Katakana}ー"
CLASSES = {"alpha": r"\p{L}", "digit": r"\p{N}", "symbol": SYMBOL}


def normalised(column: str) -> str:
    return f"trim(regexp_replace(lower({column}), '[{BLANK}]+', ' ', 'g'))"


def words(column: str) -> str:
    return rf"regexp_extract_all(lower({column}), '\p{{L}}+|\p{{N}}+')"


def token_list(column: str, n: int = 2, split: tuple[str, ...] = (),
               ignore_blank: bool = False) -> str:
    """Tokens of a column, for text without CJK letters next to others."""
    text = normalised(column)
    if ignore_blank:
        text = f"regexp_replace(lower({column}), '[{BLANK}]+', '', 'g')"
    grammed = CJK + "".join(CLASSES[name] for name in split)
    others = "".join(f"|[{CLASSES[name]}]+" for name in CLASSES if name not in split)
    runs = f"regexp_extract_all({text}, '[{grammed}]+{others}')"
    return f"""flatten(list_transform({runs}, lambda r:
        CASE WHEN length(r) > {n} AND regexp_matches(r, '^[{grammed}]')
             THEN list_transform(range(1, length(r) - {n} + 2), lambda i: substring(r, i, {n}))
             ELSE [r] END))"""


def postings(table: str, id_col: str, tokens: str) -> str:
    """id, token, zero-based position."""
    return f"""SELECT {id_col}, unnest(ts) AS token, generate_subscripts(ts, 1) - 1 AS position
               FROM (SELECT {id_col}, {tokens} AS ts FROM {table})"""


# The event table as a query log, and the next submit of every event.
LOG = r"""log AS (
    SELECT event_id AS _id, CAST(user_id AS VARCHAR) AS sequence, ts AS time,
           regexp_extract(props, '"k": *(\d+)', 1) AS item,
           CASE WHEN event_type = 'purchase' THEN 'submit' ELSE '' END AS type
    FROM events)"""

ITEMS = """items AS (
    SELECT item AS _key, count(*) AS freq, count(*) FILTER (WHERE type = 'submit') AS freq2,
           max(time) AS last FROM log GROUP BY item)"""

FOLLOWED = """followed AS (
    SELECT a.item AS pre, b.item AS post, a.type AS type
    FROM (SELECT *, min(CASE WHEN type = 'submit' THEN _id END) OVER (
              PARTITION BY sequence ORDER BY _id
              ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_id FROM log) a
    JOIN log b ON a.next_id = b._id
    WHERE b.time >= a.time AND b.time - a.time <= INTERVAL 1 DAY)"""

EVENT_PAIRS = """event_pairs AS (
    SELECT pre, post, count(*) FILTER (WHERE type = '') AS freq0,
           count(*) FILTER (WHERE type = 'submit') AS freq1
    FROM followed GROUP BY pre, post)"""

CATALOGUE = """catalogue AS (
    SELECT p_name AS _key, CAST(sum(lines) AS BIGINT) AS freq2, max(p_size) AS boost
    FROM part JOIN (SELECT l_partkey, count(*) AS lines FROM lineitem GROUP BY l_partkey)
              ON p_partkey = l_partkey
    GROUP BY p_name)"""

RELATED = """related AS (
    SELECT pre, _key AS post, freq2
    FROM (SELECT _key, freq2, unnest(list_distinct(string_split(_key, ' '))) AS pre
          FROM catalogue) WHERE pre <> _key)"""


def log_with(*parts: str) -> str:
    return "WITH " + ", ".join([LOG, *parts])
