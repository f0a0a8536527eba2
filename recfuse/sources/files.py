"""Readers: delimited files, JSON and JSON lines, text and binary documents, profile API dumps; and writers.

Every reader gives raw records ``(ord, record_id, source, source_type, raw_fields, metadata)`` or a flat
table, with positions that do not depend on the number of partitions.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELIMITERS = ",\t;|"
BOMS = ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16"))


def sniff_encoding(head: bytes) -> str:
    """Encoding of the first bytes of a file: byte order mark, else UTF-8, else Latin-1."""
    for mark, name in BOMS:
        if head.startswith(mark):
            return name
    for cut in range(4 if len(head) >= 8192 else 1):  # a full head may end inside a character
        try:
            head[: len(head) - cut].decode("utf-8")
            return "utf-8"
        except UnicodeDecodeError:
            continue
    return "latin-1"


def sniff_delimiter(text: str) -> str:
    """Delimiter of a table's first lines; a comma if nothing tells."""
    try:
        return csv.Sniffer().sniff(text[:8192], delimiters=DELIMITERS).delimiter
    except csv.Error:
        first = next((x for x in text.splitlines() if x.strip()), "")
        best = max(DELIMITERS, key=first.count)
        return best if first.count(best) else ","


def _head(path: str, n: int = 8192) -> bytes:
    p = Path(path.removeprefix("file://"))
    f = p if p.is_file() else next((x for x in sorted(p.rglob("*")) if x.is_file() and x.name[0] not in "._"), None)
    if f is None:
        raise FileNotFoundError(path)
    with open(f, "rb") as h:
        return h.read(n)


def position(df: DataFrame) -> DataFrame:
    """``df`` with ``ord``: file, then place in it, as one growing number per file split."""
    return df.withColumn("ord", F.monotonically_increasing_id())


def read_delimited(spark: SparkSession, path: str, header: bool = True, delimiter: str | None = None, encoding: str | None = None) -> DataFrame:
    """A delimited file as strings: ``ord`` and its columns; blank rows dropped, blank headers named ``col_<i>``."""
    head = _head(path)
    enc = encoding or sniff_encoding(head)
    text = head.decode(enc, "ignore").lstrip("﻿")
    sep = delimiter or sniff_delimiter(text)
    first = next(csv.reader([next((x for x in text.splitlines() if x.strip()), "")], delimiter=sep, skipinitialspace=True), [])
    names = [h.strip() or f"col_{i}" for i, h in enumerate(first)] if header else [f"col_{i}" for i in range(len(first))]
    schema = T.StructType([T.StructField(n if names.index(n) == i else f"{n}_{i}", T.StringType()) for i, n in enumerate(names)])
    df = spark.read.csv(
        path, schema=schema, sep=sep, header=header, encoding=enc, multiLine=True, quote='"', escape='"', ignoreLeadingWhiteSpace=True, mode="PERMISSIVE", enforceSchema=True
    )
    return drop_blank_rows(position(df), ["ord"])


def drop_blank_rows(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows with a non-blank value in some column beside ``keep``."""
    cells = [F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) for c in df.columns if c not in (keep or [])]
    return df.where(F.concat(*cells) != "") if cells else df


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """Eight hexadecimal digits of a row's sorted ``name=value`` pairs."""
    pairs = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) for c in sorted(columns)]
    return F.substring(F.sha2(F.concat_ws("|", *pairs), 256), 1, 8)


def flag_duplicates(df: DataFrame, columns: list[str], ord_col: str = "ord") -> DataFrame:
    """``df`` with ``row_hash`` and ``duplicate_row``: true for all but the first of equal rows.

    The first of each hash comes from an aggregation and not from a window, so equal rows in any number
    are spread over the cluster.
    """
    hashed = df.withColumn("row_hash", row_hash(df, columns))
    firsts = hashed.groupBy("row_hash").agg(F.min(ord_col).alias("_first"))
    return hashed.join(firsts, "row_hash").withColumn("duplicate_row", F.col(ord_col) > F.col("_first")).drop("_first")


_RAW = ("ord", "record_id", "source", "source_type", "raw_fields", "metadata")


def raw_records(df: DataFrame, source_type: str, payload: Column, source: Column, meta: Column | None = None) -> DataFrame:
    meta = F.create_map().cast("map<string,string>") if meta is None else meta
    return df.select("ord", F.sha2(F.concat_ws("|", source, F.col("ord").cast("string")), 256).alias("record_id"), source.alias("source"), F.lit(source_type).alias("source_type"), payload.alias("raw_fields"), meta.alias("metadata")).select(*_RAW)


def json_records(body: Column) -> Column:
    """Objects of a whole JSON text: itself, or one per element of an array; another value is wrapped as ``_value``."""
    texts = F.when(body.rlike(r"^\s*\["), F.from_json(body, "array<string>")).otherwise(F.array(body))
    return F.transform(texts, lambda one: F.when(one.rlike(r"^\s*\{"), one).otherwise(F.to_json(F.struct(one.alias("_value")))))


def read_json(spark: SparkSession, path: str, lines: bool = False, records_key: str | None = None, isolate: bool = True) -> DataFrame:
    """Raw records of JSON: an object is one, an array one per element, another value is wrapped as ``_value``.

    With ``lines`` every non-blank line is a document. Damaged documents are left out, or fail the read
    if ``isolate`` is false.
    """
    docs = spark.read.text(path, wholetext=not lines).select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("file")).where(F.trim("body") != "")
    parse = F.try_parse_json if isolate else F.parse_json
    body = F.col("body") if records_key is None else F.coalesce(F.get_json_object("body", f"$.{records_key}"), F.col("body"))
    parsed = docs.withColumn("body", body).where(parse(F.col("body")).isNotNull())
    rows = position(parsed.select("file", F.posexplode(json_records(F.col("body"))).alias("record_index", "whole")))
    meta = F.create_map(F.lit("record_index"), F.col("record_index").cast("string"), F.lit("json_structure"), F.lit("lines" if lines else "document"))
    return raw_records(rows, "ats", F.col("whole"), F.col("file"), meta)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Text documents, one row each: ``(ord, record_id, full_text, char_count, word_count)``."""
    docs = position(spark.read.text(path, wholetext=True).select(F.col("value").alias("full_text"), F.col("_metadata.file_path").alias("file")))
    return docs.select(
        "ord", F.sha2("file", 256).alias("record_id"), "full_text", F.length("full_text").alias("char_count"), F.size(F.filter(F.split("full_text", r"\s+"), lambda w: w != "")).alias("word_count")
    )


@F.pandas_udf(T.StringType())
def _pdf_text(content):
    """Text of PDF bytes by whichever library is there; empty if none is or the file is damaged."""
    import io

    def one(data):
        if data is None or not bytes(data[:5]).startswith(b"%PDF"):
            return None
        try:
            from pypdf import PdfReader

            return "\n".join(page.extract_text() or "" for page in PdfReader(io.BytesIO(data)).pages)
        except Exception:  # noqa: BLE001 - a damaged file must not end the read
            return ""

    return content.map(one)


def read_pdf(spark: SparkSession, path: str) -> DataFrame:
    """PDF documents: ``(ord, record_id, full_text, extraction_method)``; files without the PDF mark are left out."""
    files = spark.read.format("binaryFile").load(path)
    rows = position(files.withColumn("full_text", _pdf_text("content")).where(F.col("full_text").isNotNull()))
    return rows.select("ord", F.sha2("path", 256).alias("record_id"), "full_text", F.when(F.col("full_text") == "", "failed").otherwise("pypdf").alias("extraction_method"))


def profile_stats(repos: DataFrame) -> DataFrame:
    """Per login: repositories, stars, forks, topics and the most used language of a table of repositories."""
    languages = repos.where(F.col("language").isNotNull()).groupBy("login", "language").agg(F.count(F.lit(1)).alias("n"))
    top = languages.groupBy("login").agg(F.max_by("language", F.struct("n", "language")).alias("top_language"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("language", "n")))).alias("languages"))
    sums = repos.groupBy("login").agg(
        F.count(F.lit(1)).alias("n_repos"), F.sum(F.coalesce("stars", F.lit(0))).alias("total_stars"), F.sum(F.coalesce("forks", F.lit(0))).alias("total_forks"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("topics", F.array().cast("array<string>")))))).alias("topics"),
    )
    return sums.join(top, "login", "left")


def login_of(c: Column) -> Column:
    """Login in a profile link, an API link, or by itself."""
    bare = F.when(F.trim(c).rlike(r"^[A-Za-z0-9-]{1,39}$"), F.trim(c))
    return F.coalesce(F.nullif(F.regexp_extract(c, r"(?i)github\.(?:com|example)/([A-Za-z0-9-]{1,39})", 1), F.lit("")), F.nullif(F.regexp_extract(c, r"/users/([A-Za-z0-9-]{1,39})", 1), F.lit("")), bare)


_READERS: list[tuple[str, Callable[[str], bool], Callable[..., DataFrame]]] = [
    ("pdf", lambda p: p.lower().endswith(".pdf"), read_pdf),
    ("json", lambda p: bool(re.search(r"\.(?:json|jsonl|ndjson)$", p.lower())), lambda s, p: read_json(s, p, lines=not p.lower().endswith(".json"))),
    ("csv", lambda p: bool(re.search(r"\.(?:csv|tsv|txt)$", p.lower())), read_delimited),
]


def register_reader(name: str, supports: Callable[[str], bool], read: Callable[..., DataFrame], first: bool = True) -> None:
    """Add a source format; earlier readers are asked first."""
    _READERS.insert(0 if first else len(_READERS), (name, supports, read))


def read(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """The source at ``path`` by the reader of ``kind``, or the first reader that supports the path."""
    for name, supports, reader in _READERS:
        if name == kind or (kind is None and supports(path)):
            return reader(spark, path)
    raise ValueError(f"no reader for {kind or path}")


def write_json(rows: DataFrame, path: str, form: str = "jsonl") -> None:
    """Documents of a ``json`` column: ``jsonl`` distributed, ``json`` and ``pretty`` as one array in one file."""
    if form == "jsonl":
        rows.select("json").write.mode("overwrite").text(path)
        return
    import json as J

    docs = rows.select("json").toLocalIterator()
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for i, r in enumerate(docs):
            one = J.dumps(J.loads(r["json"]), ensure_ascii=False, indent=2 if form == "pretty" else None)
            f.write((",\n" if i else "\n") + one)
        f.write("\n]\n")
