"""SQL twins (DuckDB dialect) of the column functions, used by the oracle texts.

These mirror ``glossa.functions`` expression by expression so that the oracle
checks the Spark plan against an independent engine on the same parquet.
"""

from __future__ import annotations

from glossa.functions import text as T


def lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def u(*parts) -> str:
    """Twin of ``rand.uniform``: parts are SQL expressions or python literals."""
    ps = []
    for p in parts:
        if isinstance(p, (int, float)) or (isinstance(p, str) and p.startswith("'")):
            ps.append(lit(str(p)) if not isinstance(p, str) else p)
        else:
            ps.append(f"CAST({p} AS VARCHAR)")
    return (f"(CAST(('0x' || substr(md5(concat_ws('|', {', '.join(ps)})), 1, 13)) AS BIGINT)"
            f" / CAST(4503599627370496 AS DOUBLE))")


def s(v: str) -> str:
    """A python string literal as a SQL literal (for keys in ``u``)."""
    return lit(v)


def rr(e: str, pattern: str, repl: str = "") -> str:
    return f"regexp_replace({e}, {lit(pattern)}, {lit(repl)}, 'g')"


def strip_digits_quotes(e): return rr(e, T.DIGITS_QUOTES)
def strip_hashtags(e): return rr(e, T.HASHTAG)
def strip_mentions(e): return rr(e, T.MENTION)
def strip_urls(e): return rr(e, T.URL)
def collapse_ws(e): return rr(e, T.WS + "+", " ")
def strip_numbers(e): return collapse_ws(rr(e, T.DIGITS))
def py_strip(e): return rr(e, "^" + T.WS + "+|" + T.WS + "+$")


def clean_text(e):
    return collapse_ws(strip_urls(strip_mentions(strip_hashtags(strip_digits_quotes(e)))))


def sentences(e):
    return f"string_split({rr(e, T.SENTENCE_BREAK, chr(92) + '1' + T.SENTENCE_SEP)}, chr(1))"


def dedupe_sentences(e):
    tr = f"list_transform({sentences(e)}, lambda x: {py_strip('x')})"
    return (f"array_to_string(list_filter({tr}, lambda x, i: list_position({tr}, x) = i), ' ')")


def clean_text_mono(e):
    return py_strip(dedupe_sentences(clean_text(e)))


def has_ipv4(e):
    return f"(CASE WHEN regexp_matches({e}, {lit(T.IPV4)}) THEN 1 ELSE 0 END)"


def is_template_message(e):
    t = py_strip(e)
    ends = " OR ".join(f"ends_with({t}, {lit(x)})" for x in T.BOT_SUFFIXES)
    return f"coalesce(starts_with({t}, {lit(T.BOT_PREFIX)}) AND ({ends}), false)"


def pct_rank(v: str, part: str = "") -> str:
    """pandas rank(pct=True) as plain window functions (the oracle may use one task)."""
    over_all = f"PARTITION BY {part}" if part else ""
    over_ord = f"{over_all} ORDER BY {v}"
    over_tie = f"PARTITION BY {part + ', ' if part else ''}{v}"
    return (f"(CASE WHEN {v} IS NULL THEN NULL ELSE "
            f"(CAST(rank() OVER ({over_ord}) - 1 AS DOUBLE) + "
            f"CAST(count({v}) OVER ({over_tie}) + 1 AS DOUBLE) / CAST(2 AS DOUBLE)) "
            f"/ CAST(count({v}) OVER ({over_all}) AS DOUBLE) END)")
