"""Several values packed in one field: one row per value, with its position.

Quoted spans and bracketed remarks may hold delimiters, so they are first replaced by indexed
placeholders built from two characters that are removed from the input beforehand and thus cannot
collide with it. The rest is split at the delimiters, the spans are put back by array lookup, and the
values are exploded with positions. Everything is a built-in expression, so the plan is one narrow
stage without a shuffle or a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Opens and closes a placeholder; private-use characters, dropped from the input first.
_OPEN, _CLOSE = "\ue000", "\ue001"

#: A double-quoted span (doubled or backslash-escaped quotes inside), a bracketed remark, or a
#: single-quoted span that begins and ends at a list boundary (an apostrophe inside a word is none).
_SPAN = (
    r'"(?:[^"\\]|\\.|"")*"'
    r"|\([^()]*\)"
    r"|(?<![^\s\[,;|])'(?:[^'\\]|\\.)*'(?=\s*(?:[,;|\]]|$))"
)

#: Comma, semicolon, bar, line break, tab, middle dot, bullet; a slash or ampersand only between
#: blanks (TCP/IP and R&D are single values); the word "and" between values; the blank before a
#: list number such as ``2) ``.
_DELIMITER = r"[,;|\t\n\r·•]+|\s/(?=\s)|\s&(?=\s)|\sand(?=\s)|\s+(?=\d{1,3}[.)]\s)"

#: A list number or dash in front of a value.
_LIST_MARK = r"^(?:\d{1,3}[.)]|[-*–—])\s+"

_BLANKS = r"^[\s\u00a0\u200b\ufeff]+|[\s\u00a0\u200b\ufeff]+$"

#: Whole fields that stand for "no value", compared after trimming and lowering.
PLACEHOLDERS = ("", "-", "--", "–", "—", "n/a", "na", "none", "null", "nil", "tbd", "tba", "unknown", "?", "nan")


def _trim(c: Column) -> Column:
    return F.regexp_replace(c, _BLANKS, "")


def split_packed(value: Column) -> Column:
    """The values packed in a string column, in order, as ``array<string>``.

    Null, blank and placeholder fields give an empty array; empty values between delimiters are
    dropped and not counted. Outer quotes and list marks are removed, a doubled or escaped quote
    inside a value becomes one quote, and a bracketed remark stays with its value.
    """
    text = F.regexp_replace(value, f"[{_OPEN}{_CLOSE}]", "")
    text = F.when(F.lower(_trim(text)).isin(*PLACEHOLDERS), F.lit("")).otherwise(_trim(text))
    text = F.when(text.rlike(r"(?s)^\[.*\]$"), F.regexp_replace(text, r"^\[|\]$", "")).otherwise(text)
    spans = F.regexp_extract_all(text, F.lit(f"({_SPAN})"), F.lit(1))
    # The k-th gap between spans is followed by placeholder k: split at the spans and zip them back in.
    gaps = F.split(text, _SPAN, -1)
    masked = F.array_join(
        F.transform(
            gaps,
            lambda g, i: F.when(i < F.size(spans), F.concat(g, F.lit(_OPEN), i.cast("string"), F.lit(_CLOSE))).otherwise(g),
        ),
        "",
    )
    parts = F.transform(F.split(masked, _DELIMITER, -1), lambda p: F.regexp_replace(_trim(p), _LIST_MARK, ""))
    return F.filter(F.transform(parts, lambda p: _restore(p, spans)), lambda v: v != "")


def _restore(part: Column, spans: Column) -> Column:
    """Put the spans of one part back, and take the quotes off a part that is one quoted span."""
    pieces = F.split(part, f"(?={_OPEN})|(?<={_CLOSE})", -1)
    back = F.array_join(
        F.transform(
            pieces,
            lambda p: F.when(
                p.startswith(_OPEN), F.get(spans, F.regexp_extract(p, r"(\d+)", 1).try_cast("int"))
            ).otherwise(p),
        ),
        "",
    )
    one_span = part.rlike(f"^{_OPEN}\\d+{_CLOSE}$")
    double = one_span & back.startswith('"')
    single = one_span & back.startswith("'")
    inner = F.substring(back, F.lit(2), F.length(back) - 2)
    return _trim(
        F.when(double, F.regexp_replace(F.regexp_replace(inner, r'\\(["\\])', "$1"), '""', '"'))
        .when(single, F.regexp_replace(inner, r"\\(['\\])", "$1"))
        .otherwise(back)
    )


def explode_packed(df: DataFrame, key: str, field: str, value_name: str = "value") -> DataFrame:
    """``(key, pos, value)``, one row per packed value; positions count from 0.

    Rows without a value give no row; repeated rows each give theirs; other columns of ``df`` are
    not read, so clashing names do no harm.
    """
    return df.select(F.col(key), F.posexplode(split_packed(F.col(field))).alias("pos", value_name)).select(
        key, F.col("pos").cast("long").alias("pos"), value_name
    )
