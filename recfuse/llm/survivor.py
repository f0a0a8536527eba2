"""Best representative of each duplicate group, field by field, with a latent two-sided quality model.

Every different value of a field in a group is a claim that is true or false. Each source that has a
row in the group either asserts the claim or leaves it out, and the value looks like its field, like
another kind of data or like filler; expectation-maximisation infers from this the sensitivity and the
specificity of every source, how often true and false claims look like what, the share of true claims of
every field, and the probability of each claim, which alone decides whether it is usable. Several values
of a field may be true. Claims are compressed to their patterns of assertions before the iterations,
whose only result for the driver is one pair of numbers per source and per look.

An exact check follows: a value must be no shortened form of a fuller usable value of the group. Fuller
values announce their shortened forms as hash keys, so no values are compared pair by pair and a group of
any size is spread over the cluster.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recfuse.session import durable

#: Words that stand for "no value" or are left over from forms and tests. Fixed values.
FILLERS = (
    "", "-", "--", "–", "—", ".", "?", "n/a", "na", "none", "null", "nil", "nan", "tbd", "tba", "unknown", "undefined", "anonymous",
    "test", "testing", "asdf", "qwerty", "xxx", "foo", "bar", "see cv", "see resume", "see attached", "headline", "name", "full name",
    "title", "job title", "lorem ipsum", "no name", "not provided", "not available", "-none-", "default", "sample", "dummy",
)

#: The rates of more sources than this stay in a table and are joined.
MAX_SOURCES = 4096

LARGEST_YEARS = 60.0


@dataclass(frozen=True)
class QualityConfig:
    """Iterations of the model, pseudo-counts of its priors, and the probability from which a value is usable."""

    iterations: int = 8
    prior_weight: float = 20.0
    min_truth: float = 0.5
    share: float = 0.75  # of true claims, before any is seen


#: ``P(look | true)`` and ``P(look | false)`` before any claim is seen.
_LOOKS = {"good": (0.985, 0.30), "other": (0.01, 0.35), "empty": (0.005, 0.35)}


def row_source(skills: Column) -> Column:
    """The source that most skills of a row name (``none`` if no skill names one)."""
    tags = F.flatten(F.transform(F.coalesce(skills, F.array()), lambda s: F.coalesce(s["sources"], F.array().cast("array<string>"))))
    tags = F.filter(F.transform(tags, lambda t: F.lower(F.trim(t))), lambda t: t.isNotNull() & (t != ""))
    counted = F.transform(F.array_distinct(tags), lambda t: F.struct(F.size(F.filter(tags, lambda x: x == t)).alias("n"), t.alias("tag")))
    return F.coalesce(F.array_max(counted)["tag"], F.lit("none"))


def _text_kind(value: Column) -> Column:
    plain = F.lower(F.trim(F.regexp_replace(F.regexp_replace(value, r"<[^<>]*>|&\w+;", " "), r"[\s ​]+", " ")))
    return (
        F.when(value.isNull() | plain.isin(*FILLERS) | ~plain.rlike(r"\p{L}"), "empty")
        .when(plain.rlike(r"@|://|\bwww\.|^\S+\.(?:com|org|net|example)(?:/\S*)?$"), "other")
        .otherwise("good")
    )


def name_kind(value: Column) -> Column:
    """``good``, ``other`` (an address, link or number in the place of a name) or ``empty``."""
    return F.when(_text_kind(value) != "good", _text_kind(value)).when(value.rlike(r"\d"), "other").otherwise("good")


def headline_kind(value: Column) -> Column:
    return _text_kind(value)


def years_kind(value: Column) -> Column:
    v = value.try_cast("double")
    return (
        F.when(v.isNull() | F.isnan(v), "empty").when((v < 0) | (v > LARGEST_YEARS), "other").otherwise("good")
    )


def claims_of(rows: DataFrame, field: str, kind: Column, value: Column | None = None) -> DataFrame:
    """``(group_id, row_id, updated_at, source, field, value, kind)`` for one field of a table."""
    v = F.col(field) if value is None else value
    return rows.select(
        "group_id", "row_id", "updated_at", "source", F.lit(field).alias("field"), v.cast("string").alias("value"), kind.alias("kind")
    )


def judge(claims: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """``(group_id, field, value, kind, truth)``: the probability of every different non-null value.

    An empty table gives no row; repeated rows count once per source; ties need no rule here.
    """
    named = claims.where(F.col("value").isNotNull()).withColumn("src", F.concat_ws(":", "field", "source"))
    asserted = named.groupBy("group_id", "field", "value", "kind").agg(F.collect_set("src").alias("by"))
    # The sources of a group are few, however many rows it has.
    present = named.groupBy("group_id", "field").agg(F.collect_set("src").alias("all_src"))
    seen = durable(
        asserted.join(present, ["group_id", "field"]).select(
            "group_id", "field", "value", "kind",
            F.array_sort(F.transform("all_src", lambda s: F.struct(s.alias("src"), F.array_contains("by", s).cast("int").alias("said")))).alias("pattern"),
        )
    )
    counted = durable(seen.groupBy("field", "kind", "pattern").agg(F.count(F.lit(1)).alias("n")))
    few = counted.select(F.explode("pattern.src").alias("src")).distinct().limit(MAX_SOURCES + 1).count() <= MAX_SOURCES
    if not few:  # the same numbers, with the rates in a table
        return seen.join(_fit_joined(counted, cfg), ["field", "kind", "pattern"]).select("group_id", "field", "value", "kind", "truth")
    quality, looks, share = _fit(counted, cfg)
    return seen.select("group_id", "field", "value", "kind", _truth(quality, looks, share).alias("truth"))


def _literal_map(values: dict[str, float]) -> Column:
    if not values:
        return F.create_map().cast("map<string,double>")
    return F.create_map(*[F.lit(x) for k, v in sorted(values.items()) for x in (k, float(v))])


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def _own_odds(looks: dict[str, tuple[float, float]], share: dict[str, float]) -> Column:
    """Log-odds of a claim from its field and its look, before the sources are heard."""
    seen = _literal_map({k: math.log(a / b) for k, (a, b) in looks.items()})
    prior = _literal_map({k: _logit(p) for k, p in share.items()})
    zero = F.lit(0.0)
    return F.coalesce(F.element_at(prior, F.col("field")), zero) + F.coalesce(F.element_at(seen, F.concat_ws(":", "field", "kind")), zero)


def _truth(quality: dict[str, tuple[float, float]], looks: dict[str, tuple[float, float]], share: dict[str, float]) -> Column:
    """Probability of a claim from its pattern and look, under the rates of sources and looks and the share of its field."""
    said = _literal_map({s: math.log(a / b) for s, (a, b) in quality.items()})
    silent = _literal_map({s: math.log((1 - a) / (1 - b)) for s, (a, b) in quality.items()})
    odds = F.aggregate(
        "pattern", _own_odds(looks, share),
        lambda acc, x: acc + F.when(x["said"] == 1, F.coalesce(F.element_at(said, x["src"]), F.lit(0.0))).otherwise(
            F.coalesce(F.element_at(silent, x["src"]), F.lit(0.0))
        ),
    )
    return 1 / (1 + F.exp(-odds))


def _bounded(x: float) -> float:
    return min(max(x, 0.02), 0.98)


def _start(counted: DataFrame, cfg: QualityConfig) -> tuple[dict[str, tuple[float, float]], dict[str, float]]:
    keys = counted.select("field", "kind").distinct().collect()  # fields times three looks
    return {f"{r['field']}:{r['kind']}": _LOOKS.get(r["kind"], (0.5, 0.5)) for r in keys}, {r["field"]: cfg.share for r in keys}


def _own_rates(sums: list, anchor: dict[str, tuple[float, float]], cfg: QualityConfig) -> tuple[dict[str, tuple[float, float]], dict[str, float]]:
    """Rates of the looks and shares of the fields from ``(field, kind, t, f)``, the true and false mass of each."""
    w = cfg.prior_weight
    true, false = {}, {}
    for r in sums:
        true[r["field"]] = true.get(r["field"], 0.0) + r["t"]
        false[r["field"]] = false.get(r["field"], 0.0) + r["f"]
    looks = {}
    for r in sums:
        a, b = anchor[f"{r['field']}:{r['kind']}"]
        looks[f"{r['field']}:{r['kind']}"] = ((r["t"] + w * a) / (true[r["field"]] + w), (r["f"] + w * b) / (false[r["field"]] + w))
    share = {k: _bounded((true[k] + w * cfg.share) / (true[k] + false[k] + w)) for k in true}
    return looks, share


def _fit(counted: DataFrame, cfg: QualityConfig) -> tuple[dict[str, tuple[float, float]], dict[str, tuple[float, float]], dict[str, float]]:
    """Rates ``(P(asserts | true), P(asserts | false))`` by source, of the looks by field, and the share of true claims."""
    looks, share = _start(counted, cfg)
    anchor = dict(looks)
    quality: dict[str, tuple[float, float]] = {}
    w = cfg.prior_weight
    for _ in range(cfg.iterations if share else 0):
        p = counted.withColumn("truth", _truth(quality, looks, share))
        # One pass: a claim counts once for its look and once for every source of its group.
        own = F.array(F.struct(F.lit(None).cast("string").alias("src"), F.lit(1).alias("said")))
        true, false = F.col("n") * F.col("truth"), F.col("n") * (1 - F.col("truth"))
        x = p.select("field", "kind", "truth", "n", F.explode(F.concat(own, "pattern")).alias("x"))
        kind = F.when(F.col("x.src").isNull(), F.col("kind"))
        sums = x.groupBy("x.src", "field", kind.alias("kind")).agg(
            F.sum(true).alias("t"), F.sum(true * F.col("x.said")).alias("t_said"), F.sum(false).alias("f"), F.sum(false * F.col("x.said")).alias("f_said")
        ).collect()  # one row per source, field and look
        for r in sums:
            if r["src"] is not None:
                quality[r["src"]] = (_bounded((r["t_said"] + 0.6 * w) / (r["t"] + w)), _bounded((r["f_said"] + 0.3 * w) / (r["f"] + w)))
        looks, share = _own_rates([r for r in sums if r["src"] is None], anchor, cfg)
    return quality, looks, share


def _fit_joined(counted: DataFrame, cfg: QualityConfig) -> DataFrame:
    """``(field, kind, pattern, truth)``: what ``_fit`` and ``_truth`` give, with the sources' rates in a table."""
    patterns = durable(counted.withColumn("pid", F.monotonically_increasing_id()))
    votes = durable(patterns.select("pid", F.explode("pattern").alias("x")).select("pid", "x.src", "x.said"))
    looks, share = _start(counted, cfg)
    anchor = dict(looks)
    w = cfg.prior_weight

    def judged(rates: DataFrame | None) -> DataFrame:
        own = _own_odds(looks, share)
        if rates is None:
            return patterns.withColumn("truth", 1 / (1 + F.exp(-own)))
        said, silent = F.log(F.col("a") / F.col("b")), F.log((1 - F.col("a")) / (1 - F.col("b")))
        odds = votes.join(rates, "src").groupBy("pid").agg(F.sum(F.when(F.col("said") == 1, said).otherwise(silent)).alias("odds"))
        return patterns.join(odds, "pid", "left").withColumn("truth", 1 / (1 + F.exp(-(own + F.coalesce("odds", F.lit(0.0)))))).drop("odds")

    rates = None
    bounded = lambda c: F.least(F.greatest(c, F.lit(0.02)), F.lit(0.98))
    for _ in range(cfg.iterations if share else 0):
        p = durable(judged(rates).select("pid", "field", "kind", "n", "truth"))
        true, false = F.col("n") * F.col("truth"), F.col("n") * (1 - F.col("truth"))
        sums = votes.join(p.select("pid", "n", "truth"), "pid").groupBy("src").agg(
            F.sum(true).alias("t"), F.sum(true * F.col("said")).alias("t_said"), F.sum(false).alias("f"), F.sum(false * F.col("said")).alias("f_said")
        )
        rates = durable(sums.select(
            "src", bounded((F.col("t_said") + 0.6 * w) / (F.col("t") + w)).alias("a"), bounded((F.col("f_said") + 0.3 * w) / (F.col("f") + w)).alias("b")
        ))
        looks, share = _own_rates(p.groupBy("field", "kind").agg(F.sum(true).alias("t"), F.sum(false).alias("f")).collect(), anchor, cfg)
    return judged(rates).select("field", "kind", "pattern", "truth")


def _plain(value: Column) -> Column:
    """Lower-case words with single blanks; full stops and ellipses become blanks."""
    return F.trim(F.regexp_replace(F.lower(value), r"[\s. …]+", " "))


#: Names of at most so many words announce all their shortened forms; longer ones are compared word by word.
FORM_WORDS = 6


def _name_forms(plain: Column) -> Column:
    """Every shortened form of a name of up to ``FORM_WORDS`` words: words whole, as initials or left out."""
    words = F.split(plain, " ")

    def grow(acc: Column, w: Column) -> Column:
        whole = F.transform(acc, lambda a: F.trim(F.concat_ws(" ", a, w)))
        initial = F.transform(acc, lambda a: F.trim(F.concat_ws(" ", a, F.substring(w, 1, 1))))
        return F.array_distinct(F.concat(acc, whole, initial))

    subsets = F.aggregate(F.when(F.size(words) <= FORM_WORDS, words).otherwise(F.slice(words, 1, 0)), F.array(F.lit("")), grow)
    return F.filter(subsets, lambda f: f != "")


def _contained(short: Column, fuller: Column) -> Column:
    """Whether every word of ``short`` is, in order, a word of ``fuller`` or the initial of one (arrays of words)."""

    def step(at: Column, w: Column) -> Column:
        after = F.array_min(F.transform(fuller, lambda x, i: F.when((i >= at) & ((x == w) | (F.substring(x, 1, 1) == w)), i + 1)))
        return F.when(at < 0, at).otherwise(F.coalesce(after, F.lit(-1)))

    return F.aggregate(short, F.lit(0), step) >= 0


def _shortened_long(text: DataFrame) -> DataFrame:
    """``(group_id, field, value)`` of the names that a fuller name of more than ``FORM_WORDS`` words explains."""
    names = text.where("field = 'full_name'").withColumn("words", F.split("plain", " "))
    fuller = names.where(F.size("words") > FORM_WORDS).select("group_id", "field", F.col("plain").alias("fuller"), F.col("words").alias("all")).distinct()
    starts = F.array_distinct(F.concat("all", F.transform("all", lambda w: F.substring(w, 1, 1))))
    met = names.withColumn("start", F.col("words")[0]).join(fuller.withColumn("start", F.explode(starts)), ["group_id", "field", "start"])
    return met.where(F.col("plain") != F.col("fuller")).where(_contained(F.col("words"), F.col("all"))).select("group_id", "field", "value").distinct()


def _prefixes(plain: Column, lengths: Column, least: int) -> Column:
    """The prefixes of a text whose lengths other values of the group have (a prefix may end before a blank)."""
    n = F.length(plain)
    asked = F.filter(lengths, lambda k: (k >= least) & (k < n))
    return F.transform(asked, lambda k: F.substring(plain, F.lit(1), k))


def shortened(values: DataFrame) -> DataFrame:
    """``(group_id, field, value)`` of the values that a fuller value of the group explains.

    Names: a prefix, or words left out or cut to initials. Other text: a prefix, with or without an
    ellipsis. Numbers are never shortened.
    """
    text = values.where(F.col("field") != "years_experience").select("group_id", "field", "value", _plain(F.col("value")).alias("plain"))
    # Of a group only the lengths that occur are kept, not the values.
    several = text.groupBy("group_id", "field").agg(F.min("plain").alias("a"), F.max("plain").alias("b"), F.collect_set(F.length("plain")).alias("lengths"))
    text = text.join(several.where("a <> b").select("group_id", "field", "lengths"), ["group_id", "field"])
    forms = F.when(F.col("field") == "full_name", F.array_union(_name_forms(F.col("plain")), _prefixes(F.col("plain"), F.col("lengths"), 2))).otherwise(
        _prefixes(F.col("plain"), F.col("lengths"), 3)
    )
    announced = text.select("group_id", "field", F.col("plain").alias("fuller"), F.explode(forms).alias("form")).where("form <> fuller")
    keys = announced.select("group_id", "field", F.xxhash64("form").alias("h")).distinct()
    announced_forms = text.withColumn("h", F.xxhash64("plain")).join(keys, ["group_id", "field", "h"], "left_semi").select("group_id", "field", "value")
    return announced_forms.unionByName(_shortened_long(text))


def survivors(claims: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """``(group_id, field, row_id, value, truth)``: the row whose value survives, for every group of two rows or more.

    Among the usable values the latest ``updated_at`` wins (null is earliest), then the smallest
    ``row_id``. A group without a usable value gives no row; null groups are no group.
    """
    rows = durable(claims.where(F.col("group_id").isNotNull()))
    usable = durable(judge(rows, cfg).where(F.col("truth") >= cfg.min_truth).drop("kind"))
    fullest = usable.join(shortened(usable), ["group_id", "field", "value"], "left_anti")
    order = F.struct(F.col("updated_at"), (-F.col("row_id")).alias("first"))
    best = rows.join(fullest, ["group_id", "field", "value"]).groupBy("group_id", "field").agg(
        F.max_by(F.struct("row_id", "value", "truth"), order).alias("best")
    )
    many = rows.groupBy("group_id", "field").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("group_id", "field")
    return best.join(many, ["group_id", "field"]).select("group_id", "field", "best.row_id", "best.value", "best.truth")


def profile_claims(profiles: DataFrame, export: DataFrame) -> DataFrame:
    """Claims on names and headlines of the profiles and on years of the export."""
    a = profiles.withColumn("source", row_source(F.col("skills")))
    b = export.withColumn("source", row_source(F.col("skills")))
    return (
        claims_of(a, "full_name", name_kind(F.col("full_name")))
        .unionByName(claims_of(a, "headline", headline_kind(F.col("headline"))))
        .unionByName(claims_of(b, "years_experience", years_kind(F.col("years_experience"))))
    )


def surviving_profiles(profiles: DataFrame, export: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """One row per group of two rows or more: each field's surviving value, and every e-mail address judged true."""
    single = survivors(profile_claims(profiles, export), cfg)
    wide = single.groupBy("group_id").agg(
        *[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in ("full_name", "headline", "years_experience")]
    )
    mails = profiles.withColumn("source", row_source(F.col("skills"))).select(
        "group_id", "row_id", "updated_at", "source", F.explode("emails").alias("mail")
    )
    mail = F.lower(F.trim(F.col("mail")))
    kind = F.when(mail.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"), "good").otherwise("other")
    claims = claims_of(mails, "emails", kind, mail).where(F.col("group_id").isNotNull())
    true = judge(claims, cfg).where(F.col("truth") >= cfg.min_truth)
    lists = true.groupBy("group_id").agg(F.array_sort(F.collect_set("value")).alias("emails"))
    return wide.join(lists, "group_id", "left")
