"""Filling containers of fixed capacity with whole documents, by minimum bin slack.

Documents of equal length are interchangeable, so packing needs only the histogram of lengths, which
has at most ``capacity`` rows whatever the corpus. Each container takes the longest length left; a
bitset subset-sum over the available lengths then finds the fullest feasible combination for the rest
(one big integer, bit n set if n tokens can be reached), which is removed as often as the counts allow.
The result is a short list of patterns with repetitions. Documents are numbered within their length
without any ordering of the whole corpus, and meet their pattern through blocks of numbers.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Item numbers per block of the join between items and patterns; bounds the matches of an item.
BLOCK = 64

#: Items of one length that are numbered in one task, about.
ITEMS_PER_SALT = 200_000


def fullest(room: int, lengths: list[int], counts: dict[int, int]) -> dict[int, int]:
    """The combination of available lengths (descending) that leaves the least of ``room`` unused."""
    reach = 1
    mask = (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []  # length, copies, reach before
    for n in lengths:
        if n > room:
            continue
        left, chunk = min(counts[n], room // n), 1
        while left > 0:
            take = min(chunk, left)
            steps.append((n, take, reach))
            reach |= (reach << (n * take)) & mask
            left -= take
            chunk *= 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for n, take, before in reversed(steps):
        if not before >> at & 1:
            at -= n * take
            chosen[n] = chosen.get(n, 0) + take
    return chosen


def minimum_bin_slack(capacity: int, histogram: dict[int, int]) -> list[tuple[dict[int, int], int]]:
    """Patterns ``(length -> copies, repetitions)`` that use up the histogram (lengths 1 to capacity)."""
    counts = {n: c for n, c in histogram.items() if c > 0}
    lengths = sorted(counts, reverse=True)
    out: list[tuple[dict[int, int], int]] = []
    while counts:
        head = lengths[0]
        counts[head] -= 1
        pattern = fullest(capacity - head, lengths, counts)
        counts[head] += 1
        pattern[head] = pattern.get(head, 0) + 1
        times = min(counts[n] // k for n, k in pattern.items())
        for n, k in pattern.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
        lengths = [n for n in lengths if n in counts]
        out.append((pattern, times))
    return out


def _patterns(capacity_key: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        capacity = int(pdf["capacity"].iloc[0])
        found = minimum_bin_slack(capacity, dict(zip(pdf["size"].tolist(), pdf["n"].tolist())))
        rows, base, used = [], 0, {}
        for pattern, times in found:
            for size, copies in pattern.items():
                first = used.get(size, 0)
                rows.append((size, first, first + copies * times, copies, base))
                used[size] = first + copies * times
            base += times
        out = pd.DataFrame(rows, columns=["size", "first", "last", "copies", "base"], dtype="int64")
        out.insert(0, capacity_key, pdf[capacity_key].iloc[0])
        out["n_bins"] = base
        return out

    return run


def pack(items: DataFrame, capacities: DataFrame, key: str = "doc_id", size: str = "size") -> DataFrame:
    """``(capacity_id, bin_no, key, piece_no, size)``: every item in a container of each capacity.

    An item larger than the capacity is cut: its full pieces fill containers of their own, the rest is
    packed like any item. Items of size 0 or null take no room and are spread over the containers.
    Containers of a capacity are numbered from 0, full pieces after the packed ones. Repeated rows are
    items of their own; capacities that are null or below 1 are left out.
    """
    caps = capacities.select("capacity_id", F.col("capacity_tokens").cast("long").alias("capacity")).where("capacity >= 1")
    sized = items.select(F.col(key).alias("item_key"), F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long").alias("total"))
    # The table of capacities multiplies the items on purpose: each capacity is a packing of its own.
    each = sized.join(caps, F.lit(True))
    pieces = F.transform(
        F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("total") / F.col("capacity")) - 1, F.lit(0)).cast("long")),
        lambda i: F.struct(i.alias("piece_no"), F.least(F.col("capacity"), F.col("total") - i * F.col("capacity")).alias("size")),
    )
    every = each.select("item_key", "capacity_id", "capacity", F.explode(pieces).alias("p")).select(
        "capacity_id", "capacity", "item_key", "p.piece_no", "p.size"
    )
    small = every.where((F.col("size") > 0) & (F.col("size") < F.col("capacity")))
    # Every full piece is a container; it needs a number only.
    full = every.where(F.col("size") == F.col("capacity"))
    blank = every.where(F.col("size") == 0)

    salted = small.unionByName(full).withColumn("salt", F.pmod(F.xxhash64("item_key", "piece_no"), F.lit(1 << 20)))
    # The salts of a length grow with its count, so that no length is numbered in one task.
    sizes = salted.groupBy("capacity_id", "capacity", "size").agg(F.count(F.lit(1)).alias("n"))
    parts = sizes.select("capacity_id", "size", (F.ceil(F.col("n") / ITEMS_PER_SALT)).cast("long").alias("n_salts"))
    salted = salted.join(parts, ["capacity_id", "size"]).withColumn("salt", F.pmod("salt", "n_salts"))
    per_salt = salted.groupBy("capacity_id", "size", "salt").agg(F.count(F.lit(1)).alias("m"))
    before = W.partitionBy("capacity_id", "size").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_salt.select("capacity_id", "size", "salt", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("offset"))
    within = W.partitionBy("capacity_id", "size", "salt").orderBy("item_key", "piece_no")
    numbered = (
        salted.withColumn("rank", F.row_number().over(within) - 1)
        .join(offsets, ["capacity_id", "size", "salt"])
        .withColumn("number", F.col("rank") + F.col("offset"))
    )
    histogram = sizes.where(F.col("size") < F.col("capacity"))
    schema = "capacity_id long, size long, first long, last long, copies long, base long, n_bins long"
    patterns = histogram.withColumn("capacity_id", F.col("capacity_id").cast("long")).groupBy("capacity_id").applyInPandas(_patterns("capacity_id"), schema)
    blocks = patterns.withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("first") / BLOCK), F.floor((F.col("last") - 1) / BLOCK)))
    )
    packed = (
        numbered.where(F.col("size") < F.col("capacity"))
        .withColumn("block", F.floor(F.col("number") / BLOCK))
        .join(blocks, ["capacity_id", "size", "block"])
        .where((F.col("number") >= F.col("first")) & (F.col("number") < F.col("last")))
        .withColumn("bin_no", F.col("base") + F.floor((F.col("number") - F.col("first")) / F.col("copies")))
        .select("capacity_id", "bin_no", "item_key", "piece_no", "size")
    )
    bins = caps.join(patterns.groupBy("capacity_id").agg(F.max("n_bins").alias("n_bins")), "capacity_id", "left").select(
        "capacity_id", F.coalesce("n_bins", F.lit(0)).alias("n_bins")
    )
    own = numbered.where(F.col("size") == F.col("capacity")).join(bins, "capacity_id").select(
        "capacity_id", (F.col("n_bins") + F.col("number")).alias("bin_no"), "item_key", "piece_no", "size"
    )
    free = blank.join(bins, "capacity_id").select(
        "capacity_id", F.pmod(F.xxhash64("item_key"), F.greatest(F.col("n_bins"), F.lit(1))).alias("bin_no"), "item_key", "piece_no", "size"
    )
    out = packed.unionByName(own).unionByName(free)
    return out.select("capacity_id", "bin_no", F.col("item_key").alias(key), "piece_no", "size")


def fill_report(bins: DataFrame, capacities: DataFrame) -> DataFrame:
    """Containers, pieces, tokens and the share of room used, by capacity."""
    used = bins.groupBy("capacity_id").agg(
        F.countDistinct("bin_no").alias("n_bins"), F.count(F.lit(1)).alias("n_pieces"), F.sum("size").alias("n_tokens")
    )
    return used.join(capacities.select("capacity_id", "capacity_tokens"), "capacity_id").select(
        "capacity_id", "n_bins", "n_pieces", "n_tokens", F.round(F.col("n_tokens") / (F.col("n_bins") * F.col("capacity_tokens")), 6).alias("used")
    )
