"""Text helpers: cleaning, keys and casing, as JVM-side column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def collapse(c: Column) -> Column:
    """Trimmed, runs of white space as one blank."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def null_blank(c: Column) -> Column:
    """Trimmed text, null if nothing is left."""
    t = F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.when(t != "", t)


def key_text(c: Column) -> Column:
    """Comparison key: lower case, punctuation dropped, white space collapsed."""
    return collapse(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_\s]", ""))


def key_lower(c: Column) -> Column:
    return collapse(F.lower(c))


def key_email(c: Column) -> Column:
    return F.lower(F.trim(c))


def key_phone(c: Column) -> Column:
    """Digits and plus signs; a value without any is its own lower-cased key."""
    digits = F.regexp_replace(c, r"[^\d+]", "")
    return F.when(digits != "", digits).otherwise(F.lower(F.trim(c)))


def key_url(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), r"/+$", "")


def title_case(c: Column) -> Column:
    """First letter after every non-letter in upper case, other letters in lower case."""
    low = F.lower(c)
    pieces = F.regexp_extract_all(low, F.lit(r"([\p{L}]+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), "")


def capitalize(c: Column) -> Column:
    """First character in upper case, the rest in lower case."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda v: unicodedata.normalize("NFC", v) if v is not None else None)


@F.pandas_udf(T.StringType())
def _ascii(s: pd.Series) -> pd.Series:
    fold = lambda v: unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode()
    return s.map(lambda v: fold(v) if v is not None else None)


def nfc(c: Column) -> Column:
    """Unicode composition; runs in Python only for values that hold combining marks."""
    return F.when(c.rlike(r"\p{M}"), _nfc(c)).otherwise(c)


def ascii_fold(c: Column) -> Column:
    """Accents and other non-ASCII signs removed."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), _ascii(c)).otherwise(c)


def distinct_by(items: Column, key) -> Column:
    """Array without later elements whose ``key`` an earlier one has; order is kept."""
    empty = F.slice(items, 1, 0)
    return F.aggregate(
        items, empty, lambda acc, x: F.when(F.exists(acc, lambda y: key(y) == key(x)), acc).otherwise(F.array_append(acc, x))
    )
