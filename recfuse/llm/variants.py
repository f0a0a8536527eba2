"""Variant spellings of organisation names, linked without a reference list.

Different strings are parsed once into a root (the distinguishing words), a descriptor (line of
business or type of institution) and a legal form. Roots that differ by typing slips are found by
MinHash banding over padded q-grams; rows and bands follow from the collision curve so that a wanted
recall holds at the lowest similarity of a slip. Candidates are verified by Monge-Elkan similarity and
an edit bound, and clustered by star clustering: the heaviest spelling of a neighbourhood is its
centre. Names without a descriptor join the one organisation that has their root, if it is one only.
"""

from __future__ import annotations

import math
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recfuse.functions.distance import jaro_winkler, osa
from recfuse.session import durable

#: Values that name no organisation. Fixed values.
NO_NAME = frozenset(
    "|-|--|–|—|n/a|na|none|null|nil|tbd|unknown|confidential|self-employed|self employed|freelance|freelancer|unemployed|various|private|student"
    "|retired|not disclosed|undisclosed|independent|other|test|?".split("|")
)

#: Legal forms: dotted and long writings to one code. Fixed values.
LEGAL_FORMS = {
    "gmbh": "gmbh", "ag": "ag", "aktiengesellschaft": "ag", "ab": "ab", "aktiebolag": "ab", "llc": "llc", "ltd": "ltd", "limited": "ltd",
    "inc": "inc", "incorporated": "inc", "corp": "corp", "corporation": "corp", "spa": "spa", "sa": "sa", "bv": "bv", "nv": "nv", "plc": "plc",
    "sarl": "sarl", "srl": "srl", "oy": "oy", "as": "as", "kg": "kg", "se": "se", "pty": "pty",
}
_PRIVATE = ("pvt", "private")

#: Words for a line of business, which many organisations share. Fixed values.
BUSINESS_WORDS = (
    "aerospace analytics biotech consulting energy engineering foods freight health insurance interactive international logistics media"
    " research retail robotics security software systems technologies telecom textiles automotive bank capital chemicals communications"
    " construction design digital electronics entertainment finance financial group holdings industries investments labs"
    " manufacturing marketing materials mobility motors networks partners pharma power properties publishing resources services solutions studios"
    " trading transport travel ventures"
).split()

#: Short writings that no rule explains. Fixed values.
BUSINESS_SHORT = {"sw": "software", "intl": "international", "mfg": "manufacturing", "svcs": "services"}

#: Words of institution names and their codes; the codes together give the type. Fixed values.
INSTITUTION_WORDS = {
    "university": "univ", "universität": "univ", "universitaet": "univ", "universitat": "univ", "universite": "univ", "universidad": "univ",
    "univ": "univ", "uni": "univ", "u": "univ", "institute": "inst", "institut": "inst", "instituto": "inst", "inst": "inst",
    "technology": "tech", "technical": "tech", "technische": "tech", "technological": "tech", "techn": "tech", "tech": "tech", "technol": "tech",
    "college": "coll", "coll": "coll", "commerce": "comm", "comm": "comm", "school": "school", "sch": "school", "design": "design", "des": "design",
    "applied": "appl", "appl": "appl", "sciences": "sci", "science": "sci", "sci": "sci", "hochschule": "uas", "fachhochschule": "uas",
    "uas": "uas", "fh": "uas", "tu": "tu", "it": "it", "coc": "coc", "sod": "sod", "of": "", "for": "", "the": "", "der": "", "für": "", "de": "", "und": "",
}


def _fold(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def _business(token: str, dotted: bool) -> str:
    """The line of business that a token writes, ``|``-joined if several fit; empty if it is none."""
    if token in BUSINESS_WORDS:
        return token
    if token in BUSINESS_SHORT:
        return BUSINESS_SHORT[token]
    if len(token) >= 4:
        near = [w for w in BUSINESS_WORDS if len(w) >= 5 and abs(len(w) - len(token)) <= 1 and osa(token, w, 1) <= 1]
        if near:
            return "|".join(near)
    stem = token.rstrip("s") if dotted and len(token) > 4 else token
    if len(stem) >= (3 if dotted else 4):
        near = [w for w in BUSINESS_WORDS if w.startswith(stem) and len(w) - len(stem) >= 2]
        if near:
            return "|".join(near)
    vowels = sum(c in "aeiou" for c in token)
    if len(token) >= 4 and vowels <= 1:
        near = [w for w in BUSINESS_WORDS if w[0] == token[0] and w[-1] == token[-1] and len(w) > len(token) and _is_subsequence(token, w)]
        if near:
            return "|".join(near)
    return ""


def _is_subsequence(short: str, long: str) -> bool:
    it = iter(long)
    return all(c in it for c in short)


def parse_company(name: str) -> tuple[str, str, str] | None:
    """``(root, descriptor, legal form)`` of a company name, or None for a value that names none."""
    s = re.sub(r"\s+", " ", unicodedata.normalize("NFKC", name)).strip()
    if s.lower() in NO_NAME or not any(c.isalpha() for c in s):
        return None
    s = _fold(re.sub(r"\([^()]*\)", " ", s))
    s = re.sub(r"([a-z]{3})([A-Z][a-z]{3})", r"\1 \2", s)
    s = re.sub(r"(?i)\bint'l\b", "intl", s)
    s = re.sub(r"[&+]|\b(?i:and|und|u\.)(?=\s)", " ", s)
    s = re.sub(r"(?<!\w)((?:\w\.){2,})", lambda m: m.group(1).replace(".", "") + " ", s)  # S.p.A. to SpA
    tokens = [(m.group(1).lower(), bool(m.group(2))) for m in re.finditer(r"([^\W_]+)(\.?)", s)]
    if tokens and tokens[0][0] == "the":
        tokens = tokens[1:]
    if len(tokens) > 1 and tokens[-1][0] in ("company", "co"):
        tokens = tokens[:-1]
    legal = []
    while len(tokens) > 1 and (tokens[-1][0] in LEGAL_FORMS or tokens[-1][0] in _PRIVATE):
        t = tokens.pop()[0]
        legal.append("pvt" if t in _PRIVATE else LEGAL_FORMS[t])
    coded = [(t, _business(t, d)) for t, d in tokens]
    root = sorted(t for t, c in coded if not c)
    words = [c for _, c in coded if c]
    if not root:  # a name of business words only keeps them as its root
        root, words = sorted(t for t, _ in coded), []
    return " ".join(root), " ".join(sorted(words)), " ".join(sorted(legal))


def parse_institution(name: str) -> tuple[str, str, str] | None:
    """``(root, type, "")`` of an institution name; a place after a comma is dropped if a root remains."""
    s = re.sub(r"\s+", " ", unicodedata.normalize("NFKC", name)).strip()
    if s.lower() in NO_NAME or not any(c.isalpha() for c in s):
        return None
    s = re.sub(r"\([^()]*\)", " ", s)
    s = re.sub(r"(?<!\w)((?:\w\.\s?){2,})", lambda m: m.group(1).replace(".", "").replace(" ", "") + " ", s)  # I.T. to IT

    def words(part: str) -> tuple[list[str], set[str]]:
        roots, codes = [], set()
        for t in re.findall(r"[^\W_]+", part.lower()):
            code = INSTITUTION_WORDS.get(t, INSTITUTION_WORDS.get(_fold(t)))
            if code is None and len(t) >= 5:
                near = [c for w, c in INSTITUTION_WORDS.items() if len(w) >= 5 and abs(len(w) - len(t)) <= 1 and osa(t, w, 1) <= 1]
                code = near[0] if near else None
            if code is None:
                roots.append(_fold(t))
            elif code:
                codes.add(code)
        return roots, codes

    root, codes = [], set()
    for part in s.split(","):
        r, c = words(part)
        codes |= c
        if r and not root:
            root = r
    if not root:
        root, codes = [_fold(t) for t in re.findall(r"[^\W_]+", s.lower())], set()
    if codes & {"uas", "appl", "sci"}:
        kind = "uas"
    elif "tu" in codes or {"tech", "univ"} <= codes:
        kind = "tu"
    elif "it" in codes or codes & {"inst"}:
        kind = "it"
    elif codes & {"coll", "comm", "coc"}:
        kind = "coc"
    elif codes & {"school", "design", "sod"}:
        kind = "sod"
    elif "univ" in codes:
        kind = "univ"
    elif "tech" in codes:
        kind = "it|tu"
    else:
        kind = ""
    return " ".join(sorted(root)), kind, ""


def monge_elkan(a: str, b: str) -> float:
    """Symmetric Monge-Elkan similarity of blank-separated words, Jaro-Winkler inside."""
    x, y = a.split(), b.split()
    if not x or not y:
        return 0.0
    one = sum(max(jaro_winkler(p, q) for q in y) for p in x) / len(x)
    two = sum(max(jaro_winkler(p, q) for q in x) for p in y) / len(y)
    return min(one, two)


# ---------------------------------------------------------------- candidates

#: Padded q-gram length, rows of a band, the lowest similarity of a slip and the recall wanted there.
Q, ROWS, LEAST_SIMILARITY, RECALL = 2, 3, 0.4, 0.98


def bands_for(similarity: float, rows: int, recall: float) -> int:
    """Bands needed so that sets of this Jaccard similarity collide with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)))


BANDS = bands_for(LEAST_SIMILARITY, ROWS, RECALL)


def collision_curve(similarity: float) -> float:
    """Probability that two sets of this similarity share a band."""
    return 1 - (1 - similarity**ROWS) ** BANDS


def _band_hashes(text: Column) -> Column:
    """One hash per band of the MinHash signature over the padded q-grams of a string."""
    padded = F.concat(F.lit("^" * (Q - 1)), text, F.lit("$" * (Q - 1)))
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - (Q - 1)), lambda i: F.substring(padded, i, F.lit(Q))))
    hashed = F.transform(grams, lambda g: F.xxhash64(g))

    def least(seed: Column) -> Column:
        # Independent hashes of a gram: xxhash of its hash with the seed.
        return F.array_min(F.transform(hashed, lambda h: F.xxhash64(h, seed)))

    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, *[least(b * ROWS + r) for r in range(ROWS)]))


def slip(a: str, b: str, sure: bool) -> bool:
    """Whether two roots are one but for typing slips.

    One edit or swap always is (from five letters on); two are if other evidence agrees (``sure``) or
    if a letter was lost, doubled or swapped, which whole words that merely look alike do not show.
    """
    if a == b:
        return True
    if min(len(a), len(b)) < 5:
        return False
    d = osa(a, b, 2)
    if d <= 1:
        return True
    if d > 2 or min(len(a), len(b)) < 8:
        return False
    return sure or len(a) != len(b) or sum(x != y for x, y in zip(a, b)) > 2


LEAST_MONGE_ELKAN = 0.84


@F.pandas_udf(T.BooleanType())
def _linked(a: pd.Series, b: pd.Series, sure: pd.Series) -> pd.Series:
    return pd.Series(
        [slip(x, y, bool(s)) and (x == y or monge_elkan(x, y) >= LEAST_MONGE_ELKAN) for x, y, s in zip(a, b, sure)], dtype=bool
    )


_PARSED = T.StructType([T.StructField(n, T.StringType()) for n in ("root", "descriptor", "legal")])


def _as_frame(parsed: list) -> pd.DataFrame:
    return pd.DataFrame([p or (None, None, None) for p in parsed], columns=["root", "descriptor", "legal"])


@F.pandas_udf(_PARSED)
def _parse_companies(names: pd.Series) -> pd.DataFrame:
    return _as_frame([parse_company(n) for n in names])


@F.pandas_udf(_PARSED)
def _parse_institutions(names: pd.Series) -> pd.DataFrame:
    return _as_frame([parse_institution(n) for n in names])


# ---------------------------------------------------------------- clustering


def star_clusters(edges: DataFrame, weights: DataFrame, most_rounds: int = 50) -> DataFrame:
    """``(node, centre)`` of every node with an edge, by star clustering.

    ``edges(a, b)`` hold each pair in both directions, ``weights(node, weight)`` every node once. A node
    heavier than all its free neighbours (ties: the smaller node) becomes a centre and takes its free
    neighbours, each going to its heaviest centre; this repeats until no node is free.
    """
    rank = F.struct(F.col("weight"), F.col("node"))
    free = durable(weights.join(edges.select(F.col("a").alias("node")).distinct(), "node").select("node", rank.alias("rank")))
    edges = durable(edges.select("a", "b").distinct())
    done = free.select("node", F.col("node").alias("centre")).limit(0)
    for _ in range(most_rounds):
        if free.isEmpty():
            break
        near = edges.join(free.select(F.col("node").alias("a")), "a").join(
            free.select(F.col("node").alias("b"), F.col("rank").alias("b_rank")), "b"
        )
        top = near.groupBy("a").agg(F.max("b_rank").alias("top"))
        centres = free.join(top, free["node"] == top["a"], "left").where(F.col("top").isNull() | (F.col("rank") > F.col("top"))).select("node", "rank")
        centres = durable(centres)
        taken = (
            near.select("a", "b")
            .join(centres.select(F.col("node").alias("b"), F.col("rank").alias("c_rank")), "b")
            .groupBy("a")
            .agg(F.max_by("b", "c_rank").alias("centre"))
            .select(F.col("a").alias("node"), "centre")
        )
        won = durable(centres.select("node", F.col("node").alias("centre")).unionByName(taken))
        done = done.unionByName(won)
        free = durable(free.join(won.select("node"), "node", "left_anti"))
    else:
        if not free.isEmpty():
            raise RuntimeError(f"nodes are still free after {most_rounds} rounds")
    return done


def _legal_fits(a: Column, b: Column) -> Column:
    return (F.size(a) == 0) | (F.size(b) == 0) | F.arrays_overlap(a, b)


def _pairs_by_band(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Distinct candidate pairs of node ids whose roots share a band."""
    a = left.select(F.col("node").alias("a"), *on, F.posexplode(_band_hashes(F.col("root"))).alias("band", "h"))
    b = right.select(F.col("node").alias("b"), *on, F.posexplode(_band_hashes(F.col("root"))).alias("band", "h"))
    return a.join(b, [*on, "band", "h"]).where("a <> b").select("a", "b").distinct()


def link_variants(names: DataFrame) -> DataFrame:
    """``(kind, name, cluster)`` of every different organisation name; ``names(kind, name)`` may repeat.

    ``kind`` is ``company`` or ``institution`` and names link within it only. Null names and values
    that name no organisation are left out. Work follows the number of different spellings.
    """
    counted = names.where(F.col("name").isNotNull()).groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"))
    parsed = counted.withColumn(
        "p", F.when(F.col("kind") == "company", _parse_companies("name")).otherwise(_parse_institutions("name"))
    ).select("kind", "name", "n", "p.*").where(F.col("root").isNotNull() & (F.col("root") != ""))
    parsed = durable(parsed.withColumn("node", F.xxhash64("kind", "root", "descriptor")))
    nodes = durable(
        parsed.groupBy("node", "kind", "root", "descriptor").agg(
            F.sum("n").alias("n"), F.array_sort(F.collect_set(F.when(F.col("legal") != "", F.col("legal")))).alias("legal")
        )
    )
    # Names with a clear descriptor, and names of two roots, stand for an organisation by themselves.
    clear = nodes.where((F.col("descriptor") != "") & ~F.col("descriptor").contains("|") | F.col("root").contains(" "))
    vague = nodes.join(clear.select("node"), "node", "left_anti")

    same_line = _pairs_by_band(clear, clear, ["kind", "descriptor"])
    edges = _verify(same_line, clear, clear).select("a", "b")
    weights = nodes.select("node", F.col("n").alias("weight"))
    stars = star_clusters(edges, weights)
    orgs = clear.join(stars, "node", "left").select("node", "kind", "root", "descriptor", "legal", F.coalesce("centre", "node").alias("cluster"))
    orgs = durable(orgs)

    equal = vague.select(F.col("node").alias("a"), "kind", "root").join(orgs.select(F.col("node").alias("b"), "kind", "root"), ["kind", "root"]).select("a", "b")
    # Only names whose root nobody has exactly are looked for under slips.
    slipped = vague.join(equal.select(F.col("a").alias("node")).distinct(), "node", "left_anti")
    around = durable(equal.unionByName(_pairs_by_band(slipped, orgs, ["kind"])).distinct())
    close = _verify(around, vague, orgs).join(orgs.select(F.col("node").alias("b"), "cluster", F.col("descriptor").alias("b_desc")), "b")
    close = close.join(vague.select(F.col("node").alias("a"), "descriptor"), "a").where(
        (F.col("descriptor") == "") | F.array_contains(F.split("descriptor", r"\|"), F.col("b_desc"))
    )
    # Equal roots go before slips; more than one organisation leaves the name by itself.
    best = close.groupBy("a").agg(F.max("exact").alias("top"))
    joined = close.join(best, "a").where(F.col("exact") == F.col("top")).groupBy("a").agg(
        F.countDistinct("cluster").alias("m"), F.first("cluster").alias("cluster")
    ).where("m = 1").select(F.col("a").alias("node"), "cluster")
    # Vague names without an organisation link to each other by an equal root.
    alone = vague.join(joined.select("node"), "node", "left_anti").select("node", F.xxhash64("kind", "root").alias("cluster"))
    clusters = orgs.select("node", "cluster").unionByName(joined).unionByName(alone)
    return parsed.select("kind", "name", "node").join(clusters, "node").select("kind", "name", "cluster")


def _verify(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """``(a, b, exact)`` of the candidate pairs whose roots agree and whose legal forms do not conflict."""
    full = pairs.join(left.select(F.col("node").alias("a"), F.col("root").alias("ra"), F.col("legal").alias("la")), "a").join(
        right.select(F.col("node").alias("b"), F.col("root").alias("rb"), F.col("legal").alias("lb")), "b"
    )
    fits = full.where(_legal_fits(F.col("la"), F.col("lb")) & (F.abs(F.length("ra") - F.length("rb")) <= 2))
    good = fits.where(_linked("ra", "rb", F.arrays_overlap("la", "lb")))
    return good.select("a", "b", (F.col("ra") == F.col("rb")).cast("int").alias("exact"))


def name_pairs(linked: DataFrame) -> DataFrame:
    """``(kind, name_a, name_b)``: every pair of different strings of a cluster, smaller bytes first."""
    a = linked.select("kind", "cluster", F.col("name").alias("name_a"))
    b = linked.select("kind", "cluster", F.col("name").alias("name_b"))
    return a.join(b, ["kind", "cluster"]).where("name_a < name_b").select("kind", "name_a", "name_b")


def organisation_names(ats: DataFrame, recruiters: DataFrame) -> DataFrame:
    """``(kind, name)`` of the company and institution fields of both tables, with repetitions."""
    schools = ats.select(F.explode("education").alias("e")).select(F.lit("institution").alias("kind"), F.col("e.institution").alias("name"))
    jobs = ats.select(F.lit("company").alias("kind"), F.col("current_position.company").alias("name"))
    typed = recruiters.select(F.lit("company").alias("kind"), F.col("current_company").alias("name"))
    return jobs.unionByName(typed).unionByName(schools)
