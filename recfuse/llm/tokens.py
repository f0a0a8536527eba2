"""Encoding of a corpus with a public byte-level tokenizer, each distinct word once.

One pass cuts every text into pre-tokens and writes, per block of documents, the documents as lists of
word numbers and the block's distinct words. That pre-aggregates the corpus before anything is
shuffled: what crosses the network is one row per distinct word of a block, never one per occurrence.
The distinct words of the whole corpus are encoded once each, their ids joined back to the block
dictionaries, and each block's documents reassembled by position with array gathers.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recfuse.session import durable, spread

#: Characters of text in a block; bounds the memory of a task. A longer text is a block by itself.
BLOCK_CHARS = 1_500_000

DEFAULT_TOKENIZER = "byte_bpe_50k.tiktoken"


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pretoken_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to ids, from the contents of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


_LOADED: dict[int, object] = {}


def encoding(data: bytes, pattern: str):
    """The tokenizer of a rank file, kept by the Python worker."""
    import tiktoken

    key = hash((data, pattern))
    if key not in _LOADED:
        _LOADED[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=load_ranks(data), special_tokens={})
    return _LOADED[key]


def pretokenizer(pattern: str):
    """Compiled pre-token pattern; white space is Unicode's, as in the tokenizer itself."""
    import regex

    return regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def _blocks(docs: DataFrame, key: str, text: str, pattern: str) -> DataFrame:
    """Documents as word numbers (``words`` not null), and the distinct words of each block (``word``)."""
    key_type = docs.schema[key].dataType.simpleString()
    names = ["block", "doc_key", "words", "slot", "word"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = pretokenizer(pattern).findall
        part, number = TaskContext.get().partitionId(), 0
        keys: list = []
        rows: list[np.ndarray] = []
        slots: dict[str, int] = {}
        size, key_arrow = 0, None

        def flush() -> pa.RecordBatch:
            n, m = len(keys), len(slots)
            offsets = np.concatenate(([0], np.cumsum([r.size for r in rows]))).astype(np.int32)
            flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
            words = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
            empty = pa.nulls(m, words.type)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n + m, (part << 32) + number, np.int64)),
                    pa.array([*keys, *[None] * m], key_arrow),
                    pa.concat_arrays([words, empty]),
                    pa.array([*[None] * n, *range(m)], pa.int32()),
                    pa.array([*[None] * n, *slots], pa.string()),
                ],
                names=names,
            )

        for batch in batches:
            key_arrow = batch.column(0).type
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if size and size + len(t or "") > BLOCK_CHARS:
                    yield flush()
                    number += 1
                    keys, rows, slots, size = [], [], {}, 0
                keys.append(k)
                rows.append(np.array([slots.setdefault(w, len(slots)) for w in find(t)] if t else [], np.int32))
                size += len(t or "") + 1
        if keys:
            yield flush()

    picked = docs.select(F.col(key).alias("doc_key"), F.col(text).cast("string").alias("body"))
    return spread(picked).mapInArrow(run, f"block long, doc_key {key_type}, words array<int>, slot int, word string")


def encode_corpus(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, pattern: str | None = None
) -> DataFrame:
    """``(key, ids array<int>)``: the token ids of every row of ``docs``, without special tokens.

    Null and empty texts get an empty list. Repeated keys or texts each give their row; texts of any
    length are encoded whole. Strings that look like special tokens are ordinary text. Only the two
    named columns are read. ``path`` is the tokenizer's rank file.
    """
    spark = docs.sparkSession
    pattern = pattern or pretoken_pattern()
    with open(path or tokenizer_path(), "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())  # a fixed file of under 1 MB
    parts = durable(_blocks(docs, key, text, pattern))
    dictionary = parts.where(F.col("slot").isNotNull()).select("block", "slot", "word")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks.value, pattern)
        for batch in batches:
            words = batch.column(0)
            ids = [enc.encode_ordinary(w) for w in words.to_pylist()]
            yield pa.RecordBatch.from_arrays([words, pa.array(ids, pa.list_(pa.int32()))], names=["word", "ids"])

    vocabulary = dictionary.select("word").distinct().mapInArrow(encode, "word string, ids array<int>")
    coded = dictionary.join(vocabulary, "word").select(F.col("block").alias("at_block"), "slot", "ids")
    texts = parts.where(F.col("words").isNotNull()).select("block", "doc_key", "words")

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = left.column("doc_key").combine_chunks()
        words = left.column("words").combine_chunks()
        slot = right.column("slot").to_numpy()
        ids = right.column("ids").combine_chunks()
        lengths = np.zeros(slot.size, np.int64)
        begins = np.zeros(slot.size, np.int64)
        offsets = np.asarray(ids.offsets, np.int64)
        lengths[slot], begins[slot] = np.diff(offsets), offsets[:-1]
        values = np.asarray(ids.values, np.int32)
        used = np.asarray(words.flatten())
        sizes = lengths[used]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if ends.size else 0
        at = np.arange(total) + np.repeat(begins[used] - (ends - sizes), sizes)
        counts = np.asarray(pa.compute.list_value_length(words).to_numpy(zero_copy_only=False), np.int64)
        upto = np.concatenate(([0], ends))
        row_ends = upto[np.cumsum(counts)] if counts.size else np.zeros(0, np.int64)
        out = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], row_ends)).astype(np.int32)), pa.array(values[at] if total else values[:0], pa.int32())
        )
        return pa.table({key: keys, "ids": out})

    key_type = docs.schema[key].dataType.simpleString()
    return texts.groupBy("block").cogroup(coded.groupBy("at_block")).applyInArrow(assemble, f"`{key}` {key_type}, ids array<int>")


def token_bytes(spark: SparkSession, path: str | None = None) -> DataFrame:
    """One row with the hexadecimal bytes of every token, by id. Its size is that of the vocabulary."""
    with open(path or tokenizer_path(), "rb") as f:
        ranks = load_ranks(f.read())
    by_id = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        by_id[i] = token
    return spark.createDataFrame([([t.hex() for t in by_id],)], "token_hex array<string>")


def decode_corpus(encoded: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of ``ids`` (null for null ids).

    Joins the token-byte table in the form of one row, whose size is bounded by the vocabulary; the
    lookup and the join of bytes run in the JVM, without a shuffle. An id outside the vocabulary
    gives no bytes.
    """
    table = F.broadcast(token_bytes(encoded.sparkSession, path))
    hexed = F.array_join(F.transform(F.col(ids), lambda i: F.get(F.col("token_hex"), i)), "")
    return encoded.crossJoin(table).withColumn("decoded", F.decode(F.unhex(hexed), "UTF-8")).drop("token_hex")
