"""Sorting, limit, offset, slices, totals. A ``rank`` column carries the order of a page."""

from pyspark.sql import functions as F

from seekframe.operators import paging as pg
from seekframe.plans.registry import query

_COLUMNS = "doc_id, lang, n_chars"
_BY_SIZE = "ORDER BY n_chars DESC, doc_id"


def _ranked_sql(order, where="", columns=_COLUMNS):
    """All documents numbered in ``order``; the caller cuts the page."""
    return f"""SELECT {columns}, row_number() OVER ({order}) AS rn, count(*) OVER () AS total
               FROM documents {where}"""


def _docs(t):
    return t.documents.select("doc_id", "lang", "n_chars")


def _page(t, keys, limit=None, offset=0):
    return pg.page(_docs(t), keys, limit, offset, tie="doc_id")


def _rank(rows, keys):
    return pg.rank_page(rows, keys, tie="doc_id")


@query(f"""SELECT {_COLUMNS}, rn AS rank FROM ({_ranked_sql('ORDER BY lang, n_chars, doc_id')})
           WHERE rn <= 50""")
def sort_asc(t):
    return _rank(_page(t, ["lang", "n_chars"], 50), ["lang", "n_chars"])


@query(f"""SELECT {_COLUMNS}, rn AS rank FROM ({_ranked_sql(_BY_SIZE)}) WHERE rn <= 50""")
def sort_desc(t):
    return _rank(_page(t, ["-n_chars"], 50), ["-n_chars"])


@query(f"SELECT {_COLUMNS} FROM documents {_BY_SIZE} LIMIT 25")
def limit_n(t):
    return _page(t, ["-n_chars"], 25)


@query(f"SELECT {_COLUMNS} FROM ({_ranked_sql(_BY_SIZE)}) WHERE rn <= total - 5 + 1")
def limit_negative(t):
    return _page(t, ["-n_chars"], -5)


@query(f"SELECT {_COLUMNS} FROM ({_ranked_sql(_BY_SIZE)}) WHERE rn > 30")
def offset_n(t):
    return _page(t, ["-n_chars"], offset=30)


@query(f"""SELECT {_COLUMNS}, rn - (total - 20) AS rank FROM ({_ranked_sql(_BY_SIZE)})
           WHERE rn > total - 20""")
def offset_negative(t):
    return _rank(_page(t, ["-n_chars"], offset=-20), ["-n_chars"])


@query(f"""SELECT {_COLUMNS}, rn - 10 AS rank FROM ({_ranked_sql(_BY_SIZE)})
           WHERE rn > 10 AND rn <= 30""")
def page_offset_limit(t):
    return _rank(_page(t, ["-n_chars"], 20, 10), ["-n_chars"])


@query(f"""SELECT {_COLUMNS}, total AS all_len
           FROM ({_ranked_sql(_BY_SIZE, "WHERE lang = 'en'")}) WHERE rn <= 10""")
def page_with_total(t):
    rows = _docs(t).filter(F.col("lang") == "en")
    return pg.with_total(pg.page(rows, ["-n_chars"], 10, tie="doc_id"), rows)


@query(f"""SELECT {_COLUMNS}, (rn - 5) // 3 + 1 AS rank FROM ({_ranked_sql(_BY_SIZE)})
           WHERE rn >= 5 AND rn <= 40 AND (rn - 5) % 3 = 0""")
def result_slice(t):
    rows = pg.slice_rows(_docs(t), ["-n_chars"], 4, 40, 3, tie="doc_id")
    return _rank(rows, ["-n_chars"])


@query(f"""SELECT {_COLUMNS}, total - rn + 1 AS rank FROM ({_ranked_sql(_BY_SIZE)})
           WHERE rn > total - 15""")
def result_reversed(t):
    # The order of -n_chars, doc_id read backwards.
    first = pg.sort(_docs(t), "-n_chars", tie="doc_id", reverse=True).limit(15)
    return pg.rank_page(first, ["n_chars", "-doc_id"], tie="doc_id")


@query(f"SELECT {_COLUMNS} FROM ({_ranked_sql(_BY_SIZE)}) WHERE rn > 100 AND rn <= total - 40 + 100")
def page_ranked(t):
    """A page too deep for a top-k: cut by dense rank."""
    return pg.page(_docs(t), ["-n_chars"], -41, 100, tie="doc_id", top_rows=10)
