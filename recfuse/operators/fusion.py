"""Fusion of clusters into golden records.

Everything is an aggregation by cluster with explicit order keys (source priority, then input
position), so partial aggregation runs before the shuffle and no result depends on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recfuse.functions.normalize import backwards, literal_map, real
from recfuse.functions.text import key_email, key_lower, key_phone, key_text, key_url, null_blank
from recfuse.schema import SOURCE_PRIORITY, UNKNOWN_PRIORITY

LISTS = ("emails", "phones", "certifications", "skills", "experience", "education", "links")
SCALARS = ("full_name", "headline", "summary", "current_company", "current_title", "location", "github_username", "primary_language")


def priority(source: Column) -> Column:
    ranks = literal_map({k: str(v) for k, v in SOURCE_PRIORITY.items()})
    return F.coalesce(F.element_at(ranks, source).cast("int"), F.lit(UNKNOWN_PRIORITY))


def scalar_values(members: DataFrame, fields: tuple[str, ...] = SCALARS) -> DataFrame:
    """``(group_id, field, value, key, source_type, prio, ord, mapped_at)`` of the non-null values; ``members`` has ``group_id``."""
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields]))
    rows = members.select("group_id", "ord", "source_type", "mapped_at", values.alias("v"))
    return rows.where(F.col("v.value").isNotNull()).select(
        "group_id", "v.field", "v.value", key_text(F.col("v.value")).alias("key"), "source_type", priority(F.col("source_type")).alias("prio"), "ord", "mapped_at"
    )


def fuse_scalars(members: DataFrame, strategy: str = "source_priority", overrides: dict[str, str] | None = None, fields: tuple[str, ...] = SCALARS) -> DataFrame:
    """``(group_id, field, value, source_type, agreed, n_values, strategy, reason, discarded)``.

    Values that agree after normalisation give the most trusted spelling. Otherwise the strategy
    decides: ``source_priority``, ``majority_vote`` (a unique plurality, else priority), ``most_recent`` or
    ``manual`` (priority, marked for review). ``overrides`` sets strategies by field.
    """
    v = scalar_values(members, fields)
    trusted = F.struct("prio", "ord")
    # Votes of a spelling and its most trusted writing, then the decision per field.
    spelled = v.groupBy("group_id", "field", "key").agg(
        F.count(F.lit(1)).alias("votes"), F.min_by(F.struct("value", "source_type", "prio", "ord"), trusted).alias("best"),
        F.max_by(F.struct("value", "source_type", "prio", "ord"), F.struct(F.col("mapped_at"), (-F.col("ord")).alias("o"))).alias("newest"),
        F.max(F.struct(F.col("mapped_at").alias("t"), (-F.col("ord")).alias("o"))).alias("newest_rank"),
    )
    decided = spelled.groupBy("group_id", "field").agg(
        F.count(F.lit(1)).alias("n_keys"), F.sum("votes").alias("n_values"), F.min_by("best", F.struct("best.prio", "best.ord")).alias("by_priority"),
        F.max("votes").alias("top"), F.max_by("best", F.struct(F.col("votes"), (-F.col("best.prio")).alias("p"), (-F.col("best.ord")).alias("o"))).alias("by_votes"),
        F.max_by("newest", "newest_rank").alias("by_time"),
        F.array_sort(F.collect_list(F.struct("best.prio", "best.ord", "best.value", "best.source_type", "key", "votes"))).alias("spellings"),
    )
    chosen = F.lit(strategy)
    for f, s in (overrides or {}).items():
        chosen = F.when(F.col("field") == f, F.lit(s)).otherwise(chosen)
    d = decided.withColumn("asked", chosen).withColumn("n_top", F.size(F.filter("spellings", lambda s: s["votes"] == F.col("top"))))
    plural = (F.col("asked") == "majority_vote") & (F.col("n_top") == 1)
    used = F.when(plural, "majority_vote").when(F.col("asked") == "majority_vote", "source_priority").otherwise(F.col("asked"))
    winner = (
        F.when(F.col("n_keys") == 1, F.col("by_priority"))
        .when(plural, F.col("by_votes"))
        .when(F.col("asked") == "most_recent", F.col("by_time"))
        .otherwise(F.col("by_priority"))
    )
    d = d.withColumns({"w": winner, "used": used})
    lost = F.transform(F.filter("spellings", lambda s: s["key"] != key_text(F.col("w.value"))), lambda s: F.struct(s["value"].alias("value"), s["source_type"].alias("source_type")))
    reason = (
        F.when(F.col("n_keys") == 1, "all sources agree")
        .when(F.col("used") == "majority_vote", F.concat(F.col("top").cast("string"), F.lit(" of "), F.col("n_values").cast("string"), F.lit(" values agree")))
        .when(F.col("used") == "most_recent", "the latest value")
        .when(F.col("used") == "manual", "most trusted source, needs manual review")
        .otherwise("most trusted source")
    )
    return d.select(
        "group_id", "field", F.col("w.value").alias("value"), F.col("w.source_type").alias("source_type"), (F.col("n_keys") == 1).alias("agreed"), "n_values",
        F.col("used").alias("strategy"), reason.alias("reason"), lost.alias("discarded"),
    )


def conflicts(fused: DataFrame) -> DataFrame:
    """Long table of the fields on which sources disagree: ``(group_id, field, winner, winner_source, discarded, strategy, reason)``."""
    return fused.where(~F.col("agreed")).select("group_id", "field", F.col("value").alias("winner"), F.col("source_type").alias("winner_source"), "discarded", "strategy", "reason")


def ordered_union(members: DataFrame, field: str, key) -> DataFrame:
    """``(group_id, <field>)``: the different values of an array field, in record order, first spelling kept."""
    items = members.select("group_id", "ord", F.posexplode(field).alias("pos", "value")).where(F.col("value").isNotNull())
    firsts = items.withColumn("k", key(F.col("value"))).groupBy("group_id", "k").agg(F.min(F.struct("ord", "pos", "value")).alias("f"))
    return firsts.groupBy("group_id").agg(F.transform(F.array_sort(F.collect_list("f")), lambda x: x["value"]).alias(field))


def fuse_skills(members: DataFrame) -> DataFrame:
    """``(group_id, skills)``: array of ``(name, normalized_name, aliases, confidence, sources)`` in record order."""
    items = members.select("group_id", "ord", "source_type", F.posexplode("skills").alias("pos", "name")).where(null_blank(F.col("name")).isNotNull())
    merged = items.groupBy("group_id", key_lower(F.col("name")).alias("k")).agg(
        F.min(F.struct("ord", "pos", "name")).alias("f"), F.array_sort(F.collect_set("source_type")).alias("sources"), F.array_sort(F.collect_set("name")).alias("aliases")
    )
    skill = F.struct(
        F.col("f.ord").alias("ord"), F.col("f.pos").alias("pos"), F.col("f.name").alias("name"), F.col("f.name").alias("normalized_name"), F.col("aliases"),
        F.least(F.lit(1.0), F.lit(0.8) + F.lit(0.05) * F.size("sources")).alias("confidence"), F.col("sources"),
    )
    return merged.groupBy("group_id").agg(F.transform(F.array_sort(F.collect_list(skill)), lambda s: s.dropFields("ord", "pos")).alias("skills"))


def _entries(members: DataFrame, field: str, key: Column, fields: list[str], keep: Column) -> DataFrame:
    """Entries with one key become one: each member from the most trusted entry that has it."""
    items = members.select("group_id", "ord", priority(F.col("source_type")).alias("prio"), F.posexplode(field).alias("pos", "e")).where(F.col("e").isNotNull())
    place = F.struct("prio", "ord", "pos")
    text = lambda f: F.when(F.col(f"e.{f}").cast("string") != "", F.col(f"e.{f}"))
    merged = items.withColumn("k", key).groupBy("group_id", "k").agg(
        F.min(place).alias("place"), *[F.min_by(text(f), F.when(text(f).isNotNull(), place)).alias(f) for f in fields]
    )
    return merged.where(keep)


def _gathered(kept: DataFrame, field: str, fields: list[str], sort_by: str) -> DataFrame:
    """``(group_id, <field>)``: the entries of each group, newest first."""
    year = F.coalesce(F.regexp_extract(sort_by, r"^(\d{4})", 1).try_cast("int"), F.lit(0))
    month = F.coalesce(F.regexp_extract(sort_by, r"^\d{4}-(\d{2})", 1).try_cast("int"), F.lit(0))
    entry = F.struct((-year).alias("y"), (-month).alias("m"), F.col("place"), F.struct(*fields).alias("e"))
    return kept.groupBy("group_id").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["e"]).alias(field))


_JOB = ["company", "title", "start_date", "end_date", "is_current", "description", "location"]
_SCHOOL = ["institution", "degree", "field_of_study", "start_date", "end_date", "grade"]


def jobs(members: DataFrame) -> DataFrame:
    """One row per group and job, by company, title and month of start; jobs without a company are dropped."""
    k = F.concat_ws("|", key_text(F.coalesce("e.company", F.lit(""))), key_text(F.coalesce("e.title", F.lit(""))), F.substring(F.coalesce("e.start_date", F.lit("")), 1, 7))
    return _entries(members, "experience", k, _JOB, F.col("company").isNotNull() & F.col("title").isNotNull())


def fuse_experience(members: DataFrame) -> DataFrame:
    """Jobs, newest first."""
    return _gathered(jobs(members), "experience", _JOB, "start_date")


def schools(members: DataFrame) -> DataFrame:
    """One row per group and school, by institution, degree and year of end."""
    k = F.concat_ws("|", key_text(F.coalesce("e.institution", F.lit(""))), key_text(F.coalesce("e.degree", F.lit(""))), F.substring(F.coalesce("e.end_date", F.lit("")), 1, 4))
    merged = members.withColumn(
        "education", F.transform("education", lambda e: e.withField("field_of_study", F.coalesce(e["field"], e["field_of_study"])).withField("grade", F.coalesce(e["gpa"], e["grade"])))
    )
    return _entries(merged, "education", k, _SCHOOL, F.col("institution").isNotNull())


def fuse_education(members: DataFrame) -> DataFrame:
    """Schools, latest first."""
    return _gathered(schools(members), "education", _SCHOOL, "end_date")


def fuse_links(members: DataFrame) -> DataFrame:
    """``(group_id, links)``: profile links verified, others not; verified first, then by platform."""
    others = F.transform(F.map_entries(F.coalesce("other_links", F.create_map().cast("map<string,string>"))), lambda e: F.struct(e["key"].alias("platform"), e["value"].alias("url"), F.lit(False).alias("verified")))
    own = F.array(
        *[F.struct(F.lit(p).alias("platform"), F.col(c).alias("url"), F.lit(v).alias("verified")) for p, c, v in (("github", "github_url", True), ("linkedin", "linkedin_url", True), ("portfolio", "website", False))]
    )
    items = members.select("group_id", priority(F.col("source_type")).alias("prio"), "ord", F.posexplode(F.concat(own, others)).alias("pos", "l")).where(null_blank(F.col("l.url")).isNotNull())
    firsts = items.groupBy("group_id", key_url(F.col("l.url")).alias("k")).agg(F.min(F.struct("prio", "ord", "pos", "l")).alias("f"))
    entry = F.struct((~F.col("f.l.verified")).alias("u"), F.col("f.l.platform").alias("platform"), F.col("f.prio").alias("p"), F.col("f.ord").alias("o"), F.col("f.l").alias("l"))
    return firsts.groupBy("group_id").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["l"]).alias("links"))


def list_facts(members: DataFrame, fields: list[str]) -> DataFrame:
    """``(group_id, <field>_filled, ..., <field>_backwards, ...)``: whether the fused lists have entries, and how many jobs and schools end before they begin.

    No list is gathered, so a group of any size is aggregated before the shuffle.
    """
    url = lambda c: null_blank(c).isNotNull()
    others = F.exists(F.coalesce(F.map_values("other_links"), F.array().cast("array<string>")), url)
    any_of = {
        "emails": lambda: F.exists("emails", lambda x: x.isNotNull()), "phones": lambda: F.exists("phones", lambda x: x.isNotNull()),
        "certifications": lambda: F.exists("certifications", lambda x: x.isNotNull()), "skills": lambda: F.exists("skills", url),
        "links": lambda: url(F.col("github_url")) | url(F.col("linkedin_url")) | url(F.col("website")) | others,
    }
    out = members.groupBy("group_id").agg(F.count(F.lit(1)).alias("rows"), *[F.max(F.coalesce(any_of[f](), F.lit(False))).alias(f"{f}_filled") for f in fields if f in any_of]).drop("rows")
    for f, rows in (("experience", jobs), ("education", schools)):
        if f in fields:
            bad = F.when(backwards(F.struct("start_date", "end_date")), 1)
            kept = rows(members).groupBy("group_id").agg((F.count(F.lit(1)) > 0).alias(f"{f}_filled"), F.count(bad).alias(f"{f}_backwards"))
            out = out.join(kept, "group_id", "left")
    return out


def fuse_location(members: DataFrame) -> DataFrame:
    """``(group_id, place)``: the place with the most known parts, then the most trusted."""
    p = F.col("location_parts")
    n = sum((p[f].isNotNull()).cast("int") for f in ("raw", "city", "state", "country"))
    place = F.struct(p["city"].alias("city"), p["state"].alias("state"), p["country"].alias("country"), F.col("country_code").alias("country_code"))
    rank = F.struct(n.alias("n"), (-priority(F.col("source_type"))).alias("p"), (-F.col("ord")).alias("o"))
    return members.groupBy("group_id").agg(F.max_by(place, rank).alias("place"))


def fuse_provenance(members: DataFrame, fused: DataFrame) -> DataFrame:
    """``(group_id, provenance)``: lineage by field in order of time, with an entry for every conflict."""
    at = F.col("e.timestamp")
    own = members.select("group_id", "ord", F.posexplode("provenance").alias("pos", "e")).select("group_id", F.col("e.field").alias("field"), at.alias("t"), "ord", "pos", "e")
    grouped = own.groupBy("group_id", "field").agg(F.transform(F.array_sort(F.collect_list(F.struct("t", "ord", "pos", "e"))), lambda x: x["e"]).alias("entries"))
    resolved = F.struct(
        F.col("field"), F.col("winner_source").alias("source"), F.lit("conflict_resolution").alias("method"), F.lit(None).cast("string").alias("original_value"),
        F.col("winner").alias("normalized_value"), F.lit("merge").alias("processing_stage"), F.lit(1.0).alias("confidence"), F.lit(None).cast("timestamp").alias("timestamp"), F.col("reason"),
    )
    marks = conflicts(fused).select("group_id", "field", resolved.alias("mark"))
    both = grouped.join(marks, ["group_id", "field"], "full").select(
        "group_id", "field", F.when(F.col("mark").isNull(), F.col("entries")).otherwise(F.concat(F.coalesce("entries", F.slice(F.array("mark"), 1, 0)), F.array("mark"))).alias("entries")
    )
    return both.groupBy("group_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "entries")))).alias("provenance"))


def provenance_summary(members: DataFrame) -> DataFrame:
    """``(group_id, field, sources, stages, entry_count, latest_value)``."""
    own = members.select("group_id", "ord", F.posexplode("provenance").alias("pos", "e"))
    return own.groupBy("group_id", F.col("e.field").alias("field")).agg(
        F.array_sort(F.collect_set("e.source")).alias("sources"), F.array_sort(F.collect_set("e.processing_stage")).alias("stages"), F.count(F.lit(1)).alias("entry_count"),
        F.max_by("e.normalized_value", F.struct(F.col("e.timestamp"), F.col("ord"), F.col("pos"))).alias("latest_value"),
    )


def largest(members: DataFrame, *fields: str) -> DataFrame:
    """``(group_id, *fields)``: the largest value of number fields; NaN is no value, a group without one gives null."""
    kinds = {f.name: f.dataType.simpleString() for f in members.schema.fields}
    value = lambda f: real(F.col(f)) if kinds[f] in ("double", "float") else F.col(f)
    return members.groupBy("group_id").agg(*[F.max(value(f)).alias(f) for f in fields])


def several_records(members: DataFrame) -> DataFrame:
    """``(group_id, n)``: the groups of more than one record."""
    return members.groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def fuse(members: DataFrame, strategy: str = "source_priority", overrides: dict[str, str] | None = None, lists: tuple[str, ...] = LISTS) -> tuple[DataFrame, DataFrame]:
    """Golden records and the fused scalars they rest on (for conflicts and agreement). Of lists that are not asked for, ``list_facts`` only."""
    scalars = fuse_scalars(members, strategy, overrides)
    wide = scalars.groupBy("group_id").agg(
        *[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in SCALARS if f != "location"],
        *[F.max(F.when(F.col("field") == f, F.col("agreed"))).alias(f"{f}_agreed") for f in ("full_name", "headline", "location")],
        F.sum((~F.col("agreed")).cast("int")).alias("conflict_count"),
    )
    facts = largest(members, "years_of_experience", "github_stars", "github_repos").withColumnRenamed("years_of_experience", "years_experience")
    facts = facts.join(members.groupBy("group_id").agg(
        F.count(F.lit(1)).alias("merged_records"), F.array_sort(F.collect_set("source_type")).alias("source_types"), F.max("mapped_at").alias("updated_at"), F.min("mapped_at").alias("created_at"),
        F.sha2(F.concat_ws("|", F.array_sort(F.collect_set(F.concat_ws(":", "source_type", "record_id")))), 256).alias("candidate_id"),
    ), "group_id")
    out = facts.join(wide, "group_id", "left")
    parts = {
        "emails": lambda: ordered_union(members, "emails", key_email), "phones": lambda: ordered_union(members, "phones", key_phone),
        "certifications": lambda: ordered_union(members, "certifications", key_lower), "skills": lambda: fuse_skills(members),
        "experience": lambda: fuse_experience(members), "education": lambda: fuse_education(members), "links": lambda: fuse_links(members),
    }
    for f in LISTS:
        if f in lists:
            out = out.join(parts[f](), "group_id", "left")
    out = out.join(fuse_location(members), "group_id", "left")
    if rest := [f for f in LISTS if f not in lists]:
        out = out.join(list_facts(members, rest), "group_id", "left")
    return out, scalars


def first_rows(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group under an order; for reports, not for unbounded groups."""
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
