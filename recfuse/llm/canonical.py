"""Mapping of freely typed values to a canonical list, with unmatched values reported.

Values are deduplicated and normalised first, so the work follows the number of different spellings
and not of rows. Candidates come from an inverted index of character n-grams over the list's names and
aliases; they are scored by the cosine of idf-weighted n-gram vectors and accepted above a threshold
and a margin to the second entry. Of the accepted ones an exact check drops those whose spelling is
another word. Names that several rows already carry with one canonical value serve as further aliases.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recfuse.functions.distance import osa
from recfuse.session import durable

#: Words around a value that say how well it is known, and not what it is. Fixed values.
_BEFORE = (
    r"^(?:hands[- ]on|exp(?:\.|erience|ert)?\s+(?:in|with)|(?:good\s+|basic\s+)?knowledge\s+of|good|strong|solid|proficient\s+in"
    r"|skilled\s+in|basic|advanced|familiar\s+with)\s+"
)
_AFTER = r"\s+(?:experts?|skills?|experience|knowledge|[ivx]{2,4}|v?\d+(?:\.[\dx]+)*|[-–—]\s*\d+\+?\s*(?:years?|yrs?))$"

MIN_COSINE = 0.45
MIN_MARGIN = 0.05
#: Rows that must carry a name with one canonical value, and their share, before the name is an alias.
MIN_SUPPORT, MIN_AGREEMENT = 2, 0.9


def normal_tokens(value: Column) -> Column:
    """Lower-case words of a value without marks, brackets, versions and words of degree.

    ``Reporting, Financial`` becomes ``financial reporting``; a full stop that ends a shortened word
    stays. Null gives null.
    """
    s = F.lower(F.regexp_replace(F.regexp_replace(value, r"[®™©]", ""), r"\([^()]*\)", " "))
    s = F.trim(F.regexp_replace(s, r"[\s_]+", " "))
    s = F.trim(F.regexp_replace(F.regexp_replace(s, _BEFORE, ""), _AFTER, ""))
    s = F.regexp_replace(s, r"^([^,]+),\s*([^,]+)$", "$2 $1")
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"[^\p{L}\p{N}.]+", " "), r"\s+", " "))


def flat(tokens: Column) -> Column:
    """The letters and digits of normalised words, without blanks."""
    return F.regexp_replace(tokens, r"[^\p{L}\p{N}]", "")


def _grams(c: Column) -> Column:
    """Hashes of the letter pairs of a padded word: neighbours as typed, and pairs up to two apart in either order.

    Pairs without an order keep a swap of letters from changing more grams than another slip.
    """
    padded = F.concat(F.lit("^"), c, F.lit("$"))
    at = F.sequence(F.lit(1), F.length(padded) - 1)
    letter = lambda i: F.substring(padded, i, F.lit(1))
    pair = lambda d: F.transform(at, lambda i: F.xxhash64(F.least(letter(i), letter(i + d)), F.greatest(letter(i), letter(i + d))))
    typed = F.transform(at, lambda i: F.xxhash64(F.substring(padded, i, F.lit(2))))
    return F.array_distinct(F.concat(pair(1), F.slice(pair(2), F.lit(1), F.length(padded) - 2), typed))


def same_spelling(value_tokens: str, value_flat: str, form_tokens: str, form_flat: str) -> bool:
    """Whether two normalised values are one name but for a slip or for shortened words.

    One edit or transposition is allowed from five letters on; a word that ends in a full stop matches
    a word that begins with it.
    """
    if value_flat == form_flat:
        return True
    if min(len(value_flat), len(form_flat)) >= 5 and osa(value_flat, form_flat, 1) <= 1:
        return True
    a, b = value_tokens.split(), form_tokens.split()
    if len(a) != len(b) or "." not in value_tokens:
        return False
    short = False
    for x, y in zip(a, b):
        if x.endswith(".") and len(x) > 3 and y.startswith(x[:-1]):
            short = True
        elif x != y and not (min(len(x), len(y)) >= 5 and osa(x, y, 1) <= 1):
            return False
    return short


@F.pandas_udf(T.BooleanType())
def _same_spelling(vt: pd.Series, vf: pd.Series, ft: pd.Series, ff: pd.Series) -> pd.Series:
    return pd.Series([same_spelling(*x) for x in zip(vt, vf, ft, ff)], dtype=bool)


def match_forms(values: DataFrame, forms: DataFrame) -> DataFrame:
    """``(v_flat, entry_id, cosine)`` of the values that name an entry.

    ``values(v_tokens, v_flat)`` are distinct, ``forms(f_tokens, f_flat, entry_id)`` the spellings of the
    entries. A value goes to its best entry if their cosine is ``MIN_COSINE``, the second entry is
    ``MIN_MARGIN`` away, and the spelling holds; a form of two entries is therefore no match for either.
    Values and forms meet by the heaviest n-grams of a value only, so many that what the others can add
    stays below ``MIN_COSINE - MIN_MARGIN``: no candidate that matters is lost, and common n-grams join nothing.
    """
    spelled = forms.groupBy("f_flat").agg(F.min("f_tokens").alias("f_tokens"), F.array_sort(F.collect_set("entry_id")).alias("entries"))
    spelled = spelled.select("f_flat", "f_tokens", "entries", _grams(F.col("f_flat")).alias("f_grams"))
    form_grams = spelled.select("f_flat", F.explode("f_grams").alias("gram"))
    n_forms = spelled.select(F.log1p(F.count(F.lit(1))).alias("most"), F.count(F.lit(1)).alias("n_forms"))
    idf = form_grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).crossJoin(F.broadcast(n_forms))  # one row
    idf = idf.select("gram", F.log1p(F.col("n_forms") / F.col("df")).alias("weight"))
    norms = form_grams.join(idf, "gram").groupBy("f_flat").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("f_norm"))
    index = durable(spelled.join(norms, "f_flat"))

    flats = values.select("v_flat").distinct()
    rated = flats.select("v_flat", F.explode(_grams(F.col("v_flat"))).alias("gram")).join(idf, "gram", "left").crossJoin(F.broadcast(n_forms))  # one row
    mass = F.coalesce("weight", "most") ** 2
    vectors = rated.groupBy("v_flat").agg(F.sort_array(F.collect_list(F.struct(mass.alias("mass"), "gram")), asc=False).alias("v"), F.sum(mass).alias("v_mass"))
    # Heaviest first: a gram is joined unless those from it on weigh too little to bring a candidate.
    tail = (MIN_COSINE - MIN_MARGIN) ** 2
    heavy = F.aggregate(
        "v", F.struct(F.lit(0.0).alias("before"), F.array().cast("array<bigint>").alias("grams")),
        lambda acc, x: F.struct(
            (acc["before"] + x["mass"]).alias("before"),
            F.when(F.col("v_mass") - acc["before"] >= tail * F.col("v_mass") * 0.999999, F.array_append(acc["grams"], x["gram"])).otherwise(acc["grams"]).alias("grams"),
        ),
    )["grams"]
    vectors = durable(vectors.withColumn("heavy", heavy))
    met = vectors.select("v_flat", F.explode("heavy").alias("gram")).join(index.select("f_flat", F.explode("f_grams").alias("gram")), "gram").select("v_flat", "f_flat").distinct()
    dot = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + F.when(F.array_contains("f_grams", x["gram"]), x["mass"]).otherwise(0.0))
    pairs = met.join(vectors, "v_flat").join(index, "f_flat").select(
        "v_flat", "f_flat", "f_tokens", "entries", (dot / (F.col("f_norm") * F.sqrt("v_mass"))).alias("cosine")
    ).where(F.col("cosine") >= MIN_COSINE - MIN_MARGIN)
    each = pairs.select("v_flat", F.explode("entries").alias("entry_id"), "cosine", F.struct("cosine", "f_flat", "f_tokens").alias("form"))
    # Entries by their best form; the two best of a value are enough for the margin.
    best = each.groupBy("v_flat", "entry_id").agg(F.max("form").alias("form"))
    first = best.groupBy("v_flat").agg(F.max(F.struct("form.cosine", (-F.col("entry_id")).alias("first"), "form.f_flat", "form.f_tokens")).alias("top"))
    second = best.join(first.select("v_flat", (-F.col("top.first")).alias("won")), "v_flat").where("entry_id <> won").groupBy("v_flat").agg(F.max("form.cosine").alias("next"))
    won = first.join(second, "v_flat", "left").where(
        (F.col("top.cosine") >= MIN_COSINE) & (F.col("top.cosine") - F.coalesce("next", F.lit(0.0)) >= MIN_MARGIN)
    )
    spelt = values.join(won, "v_flat").select("v_flat", "v_tokens", (-F.col("top.first")).alias("entry_id"), "top.cosine", "top.f_flat", "top.f_tokens")
    good = spelt.where(_same_spelling("v_tokens", "v_flat", "f_tokens", "f_flat"))
    return good.groupBy("v_flat").agg(F.first("entry_id").alias("entry_id"), F.max("cosine").alias("cosine"))


def reference_forms(ref: DataFrame) -> DataFrame:
    """Spellings of the list: canonical names and aliases, normalised."""
    named = ref.select(F.col("skill_id").alias("entry_id"), F.explode(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"))
    tokens = named.select("entry_id", normal_tokens(F.col("name")).alias("f_tokens"))
    return tokens.withColumn("f_flat", flat(F.col("f_tokens"))).where(F.col("f_flat") != "").distinct()


def map_skills(profiles: DataFrame, ref: DataFrame) -> DataFrame:
    """Every element of ``profiles.skills`` that lacks a canonical name, with its entry.

    ``(row_id, skill_pos, name, skill_id, canonical_name, cosine)``; ``skill_id`` is -1 and the last two
    null if no entry is meant (null and blank names included). Repeated rows are all reported.
    """
    exploded = profiles.select("row_id", F.posexplode("skills").alias("skill_pos", "skill"))
    items = exploded.select(
        "row_id", F.col("skill_pos").cast("long").alias("skill_pos"), F.col("skill.name").alias("name"),
        F.col("skill.normalized_name").alias("given"), flat(normal_tokens(F.col("skill.name"))).alias("v_flat"),
        normal_tokens(F.col("skill.name")).alias("v_tokens"),
    )
    canonical = ref.select(F.col("canonical_name").alias("given"), F.col("skill_id").alias("given_id"))
    items = items.join(canonical, "given", "left")
    rows = items.where(F.col("v_flat") != "").groupBy("v_flat", "v_tokens", "given_id").agg(F.count(F.lit(1)).alias("n"))
    # The distinct spellings and their matches are written once; what follows reads small tables.
    rows = durable(rows)
    spelled = rows.select("v_flat", "v_tokens").distinct()
    forms = durable(reference_forms(ref))
    direct = durable(match_forms(spelled, forms))
    # Names that several rows carry with one canonical value, and that no spelling explains, are further aliases.
    votes = rows.where(F.col("given_id").isNotNull()).groupBy("v_flat", "given_id").agg(F.sum("n").alias("n"), F.min("v_tokens").alias("v_tokens"))
    learned = votes.groupBy("v_flat").agg(F.sum("n").alias("all"), F.max(F.struct("n", (-F.col("given_id")).alias("first"), "v_tokens")).alias("top")).where(
        (F.col("top.n") >= MIN_SUPPORT) & (F.col("top.n") >= MIN_AGREEMENT * F.col("all"))
    ).select("v_flat", (-F.col("top.first")).alias("low"), "top.v_tokens")
    novel = learned.join(direct.select("v_flat"), "v_flat", "left_anti").select(
        F.col("low").alias("entry_id"), F.col("v_tokens").alias("f_tokens"), F.col("v_flat").alias("f_flat")
    )
    rest = spelled.join(direct.select("v_flat"), "v_flat", "left_anti")
    found = durable(direct.unionByName(match_forms(durable(rest), durable(novel))))
    names = ref.select(F.col("skill_id").alias("entry_id"), "canonical_name")
    mapped = items.where(F.col("given_id").isNull()).join(found, "v_flat", "left").join(names, "entry_id", "left")
    return mapped.select(
        "row_id", "skill_pos", "name", F.coalesce("entry_id", F.lit(-1)).cast("long").alias("skill_id"), "canonical_name", "cosine"
    )
