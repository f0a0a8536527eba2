"""Mapping of source rows to canonical records: delimited tables, vendor JSON, profile APIs, résumé text.

Column names resolve against the registry when the plan is built, so a mapping is one projection. JSON
of unknown shape is unnested to paths whose leaves resolve through the registry table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recfuse.functions import normalize as N
from recfuse.functions.text import null_blank
from recfuse.operators.nested import json_nodes
from recfuse.operators.registry import IGNORED_COLUMNS, FieldRegistry
from recfuse.schema import LIST_FIELDS, PROVENANCE, STRUCT_FIELDS, align

_REGISTRY = FieldRegistry.default()


def provenance(field: str, source: Column, method: str, original: Column, mapped: Column, confidence: float, at: Column, stage: str = "mapping") -> Column:
    """One lineage entry."""
    return F.struct(
        F.lit(field).alias("field"), source.cast("string").alias("source"), F.lit(method).alias("method"), original.cast("string").alias("original_value"),
        mapped.cast("string").alias("normalized_value"), F.lit(stage).alias("processing_stage"), F.lit(confidence).alias("confidence"),
        at.cast("timestamp").alias("timestamp"), F.lit(None).cast("string").alias("reason"),
    )


def _named(entry: Column, present: Column) -> Column:
    return F.when(present.isNotNull(), F.array(entry)).otherwise(F.array().cast(PROVENANCE))


def map_columns(
    df: DataFrame, source_type: str, record_id: str, ord_col: str, at: Column | None = None, label: Column | None = None,
    registry: FieldRegistry = _REGISTRY, renamed: dict[str, str] | None = None,
) -> DataFrame:
    """Canonical records of a flat table of strings.

    Blank cells are skipped; of several columns for one text field the last non-blank one counts, those
    of a list field are all kept; packed skills are split. Columns without a canonical field are named in
    ``unknown_fields``, those left out on purpose in ``ignored_fields``. ``renamed`` gives the source's
    own names where the table's columns differ from them.
    """
    at = F.lit(None).cast("timestamp") if at is None else at
    by_field: dict[str, list[tuple[str, str]]] = {}
    ignored, unknown = [], []
    for c in df.columns:
        shown = (renamed or {}).get(c, c)
        if c in (record_id, ord_col) or shown.strip().lower() in IGNORED_COLUMNS:
            ignored.append(shown)
            continue
        target = registry.resolve(shown)
        if target is None or target in STRUCT_FIELDS:
            unknown.append(shown)
        else:
            by_field.setdefault(target, []).append((c, shown))
    cols: dict[str, Column] = {}
    entries: list[Column] = []
    mapped: list[Column] = []
    src = F.lit(source_type)
    for target, sources in by_field.items():
        values = [null_blank(F.col(f"`{c}`").cast("string")) for c, _ in sources]
        if target in LIST_FIELDS:
            parts = [
                F.coalesce(N.split_skills(v), F.array().cast("array<string>")) if target == "skills" else F.filter(F.array(v), lambda x: x.isNotNull())
                for v in values
            ]
            cols[target] = F.concat(*parts)
            mapped.append(F.when(F.size(cols[target]) > 0, F.lit(target)))
        else:
            value = F.coalesce(*reversed(values))
            cols[target] = N.real(value.try_cast("double")) if target == "years_of_experience" else value
            mapped.append(F.when(value.isNotNull(), F.lit(target)))
        for (_, shown), v in zip(sources, values):
            method = "direct" if shown == target else "alias"
            entries.append(_named(provenance(target, src, method, v, v, 1.0, at), v))
    out = df.select(
        F.col(ord_col).cast("long").alias("ord"), F.col(record_id).cast("string").alias("record_id"), src.alias("source_type"),
        (F.lit(source_type) if label is None else label).alias("source_label"), *[c.alias(f) for f, c in cols.items()],
        F.concat(*entries).alias("provenance") if entries else F.array().cast(PROVENANCE).alias("provenance"),
        F.filter(F.array(*mapped), lambda x: x.isNotNull()).alias("mapped_fields") if mapped else F.array().cast("array<string>").alias("mapped_fields"),
        F.array(*[F.lit(x) for x in ignored]).cast("array<string>").alias("ignored_fields"),
        F.array(*[F.lit(x) for x in unknown]).cast("array<string>").alias("unknown_fields"), at.alias("mapped_at"),
    )
    return infer(align(out))


def infer(records: DataFrame) -> DataFrame:
    """Names from their parts or parts from the name, and the login from the profile link."""
    both = F.col("first_name").isNotNull() & F.col("last_name").isNotNull()
    neither = F.col("first_name").isNull() & F.col("last_name").isNull()
    joined = F.when(F.col("full_name").isNull() & both, F.concat_ws(" ", "first_name", "last_name"))
    parts = N.split_name(F.col("full_name"))
    login = F.when(F.col("github_username").isNull(), N.github_login(F.col("github_url")))
    made = F.concat(
        _named(provenance("full_name", F.col("source_type"), "inferred", joined, joined, 0.9, F.col("mapped_at")), joined),
        _named(provenance("github_username", F.col("source_type"), "inferred", F.col("github_url"), login, 0.95, F.col("mapped_at")), login),
    )
    return records.withColumns(
        {
            "full_name": F.coalesce("full_name", joined),
            "first_name": F.when(neither & F.col("full_name").isNotNull(), parts["first_name"]).otherwise(F.col("first_name")),
            "last_name": F.when(neither & F.col("full_name").isNotNull(), parts["last_name"]).otherwise(F.col("last_name")),
            "github_username": F.coalesce("github_username", login),
            "provenance": F.concat("provenance", made),
        }
    )


def map_profiles(ats: DataFrame, source_type: str = "ats", at: str = "updated_at") -> DataFrame:
    """Canonical records of structured ATS rows (nested positions, jobs and schools)."""
    t = F.col(at).cast("timestamp")
    own = lambda c: null_blank(F.col(c))
    one = lambda c: F.filter(F.array(own(c)), lambda x: x.isNotNull())
    job = lambda e: F.struct(
        e["company"].alias("company"), e["title"].alias("title"), e["start_date"].alias("start_date"), e["end_date"].alias("end_date"),
        F.lit(False).alias("is_current"), e["description"].alias("description"), e["location"].alias("location"), F.lit(None).cast("string").alias("url"),
    )
    school = lambda e: F.struct(
        e["institution"].alias("institution"), e["degree"].alias("degree"), F.lit(None).cast("string").alias("field"), e["field_of_study"].alias("field_of_study"),
        e["start_date"].alias("start_date"), e["end_date"].alias("end_date"), F.lit(None).cast("string").alias("gpa"), e["grade"].alias("grade"),
    )
    fields = {
        "first_name": own("first_name"), "last_name": own("last_name"), "emails": one("email"), "phones": one("phone"), "location": own("location"),
        "headline": own("headline"), "current_company": null_blank(F.col("current_position.company")), "current_title": null_blank(F.col("current_position.title")),
        "years_of_experience": N.real(F.col("years_experience").cast("double")), "skills": F.coalesce("skills", F.array().cast("array<string>")),
        "experience": F.transform(F.filter("experience", lambda e: e.isNotNull()), job), "education": F.transform(F.filter("education", lambda e: e.isNotNull()), school),
        "github_url": own("github_url"), "linkedin_url": own("linkedin_url"),
    }
    lists = ("emails", "phones", "skills", "experience", "education")
    present = [F.when((F.size(v) > 0) if k in lists else v.isNotNull(), F.lit(k)) for k, v in fields.items()]
    entries = [
        F.when(p.isNotNull(), F.array(provenance(k, F.lit(source_type), "nested", F.to_json(F.struct(v.alias("v"))) if k in lists else v, F.to_json(F.struct(v.alias("v"))) if k in lists else v, 1.0, t))).otherwise(F.array().cast(PROVENANCE))
        for (k, v), p in zip(fields.items(), present)
    ]
    out = ats.select(
        F.col("row_id").alias("ord"), F.col("row_id").cast("string").alias("record_id"), F.lit(source_type).alias("source_type"),
        F.col("source_file").alias("source_label"), *[v.alias(k) for k, v in fields.items()], F.concat(*entries).alias("provenance"),
        F.filter(F.array(*present), lambda x: x.isNotNull()).alias("mapped_fields"), t.alias("mapped_at"),
    )
    return infer(align(out))


# ---------------------------------------------------------------- vendor JSON


def vendor_schema(payload: Column) -> Column:
    """``greenhouse``, ``lever``, ``workday`` or ``generic``, by the members of the root object."""
    has = lambda k: F.array_contains(F.json_object_keys(payload), k)
    return (
        F.when(has("candidate") & (has("applications") | has("attachments")), "greenhouse")
        .when(has("applications") & has("stage"), "lever")
        .when(has("Worker") | has("worker") | has("workdayid"), "workday")
        .otherwise("generic")
    )


def _j(payload: Column, path: str) -> Column:
    return null_blank(F.get_json_object(payload, path))


def _values(payload: Column, path: str, member: str) -> Column:
    """Texts of an array: strings themselves, or ``member`` of its objects."""
    raw = F.from_json(F.get_json_object(payload, path), "array<string>")
    text = lambda x: F.when(x.rlike(r"^\s*\{"), F.get_json_object(x, f"$.{member}")).otherwise(x)
    out = F.filter(F.transform(raw, lambda x: null_blank(text(x))), lambda x: x.isNotNull())
    return F.coalesce(out, F.array().cast("array<string>"))


def _first_link(links: Column, kind: str) -> Column:
    return F.get(F.filter(links, lambda u: N.url_kind(u) == kind), F.lit(0))


def map_vendor_json(raw: DataFrame, key: str = "record_id", payload: str = "raw_fields", ord_col: str = "ord", at: Column | None = None, schema: str | None = None) -> DataFrame:
    """Canonical records of ATS payloads; the vendor shape is detected per row unless ``schema`` forces one."""
    p = F.col(payload)
    kind = vendor_schema(p) if schema is None else F.lit(schema)
    w = "$.Worker.Personal_Data"
    gh_links, lv_links = _values(p, "$.candidate.website_addresses", "value"), _values(p, "$.links", "url")
    strings = F.array().cast("array<string>")

    def pick(greenhouse=None, lever=None, workday=None):
        none = F.lit(None).cast("string")
        return F.when(F.col("vendor") == "greenhouse", none if greenhouse is None else greenhouse).when(
            F.col("vendor") == "lever", none if lever is None else lever
        ).when(F.col("vendor") == "workday", none if workday is None else workday)

    def pick_list(greenhouse, lever, workday):
        return F.when(F.col("vendor") == "greenhouse", greenhouse).when(F.col("vendor") == "lever", lever).when(F.col("vendor") == "workday", workday)

    one = lambda c: F.filter(F.array(c), lambda x: x.isNotNull())
    contact = f"{w}.Contact_Data"
    tags = _values(p, "$.tags", "value")
    known = raw.withColumn("vendor", kind).where(F.col("vendor") != "generic")
    fixed = known.select(
        F.col(ord_col).cast("long").alias("ord"), F.col(key).cast("string").alias("record_id"), F.lit("ats").alias("source_type"),
        F.col("vendor").alias("source_label"),
        pick(None, _j(p, "$.name")).alias("full_name"),
        pick(_j(p, "$.candidate.first_name"), None, _j(p, f"{w}.Name_Data.First_Name")).alias("first_name"),
        pick(_j(p, "$.candidate.last_name"), None, _j(p, f"{w}.Name_Data.Last_Name")).alias("last_name"),
        pick_list(
            _values(p, "$.candidate.email_addresses", "value"), _values(p, "$.emails", "value"),
            one(F.coalesce(_j(p, f"{contact}.Email_Address"), _j(p, f"{contact}.Primary_Email"))),
        ).alias("emails"),
        pick_list(
            _values(p, "$.candidate.phone_numbers", "value"), _values(p, "$.phones", "value"),
            one(F.coalesce(_j(p, f"{contact}.Phone_Number"), _j(p, f"{contact}.Primary_Phone"))),
        ).alias("phones"),
        pick(
            F.coalesce(_j(p, "$.candidate.addresses[0].value"), _j(p, "$.candidate.location.name")),
            F.coalesce(_j(p, "$.location.name"), _j(p, "$.location")),
            F.nullif(F.concat_ws(", ", _j(p, f"{contact}.Address_Data.City"), _j(p, f"{contact}.Address_Data.Country")), F.lit("")),
        ).alias("location"),
        pick(_j(p, "$.candidate.title"), _j(p, "$.headline")).alias("headline"),
        pick(None, _j(p, "$.summary")).alias("summary"),
        pick(_j(p, "$.candidate.company")).alias("current_company"),
        pick(_first_link(gh_links, "github"), _first_link(lv_links, "github")).alias("github_url"),
        pick(_first_link(gh_links, "linkedin"), _first_link(lv_links, "linkedin")).alias("linkedin_url"),
        pick(_first_link(gh_links, "website"), _first_link(lv_links, "website")).alias("website"),
        pick_list(tags, tags, strings).alias("skills"),
        (F.lit(None).cast("timestamp") if at is None else at).alias("mapped_at"),
    )
    generic = raw.withColumn("vendor", kind).where(F.col("vendor") == "generic")
    return infer(_with_marks(align(fixed))).unionByName(map_generic_json(generic, key, payload, ord_col, at))


def _with_marks(records: DataFrame) -> DataFrame:
    """Mapped fields and lineage of records whose columns are already canonical."""
    texts = ("full_name", "first_name", "last_name", "location", "headline", "summary", "current_company", "github_url", "linkedin_url", "website")
    marks = [F.when(F.col(c).isNotNull(), F.lit(c)) for c in texts] + [F.when(F.size(c) > 0, F.lit(c)) for c in LIST_FIELDS]
    entries = [_named(provenance(c, F.col("source_type"), "nested", F.col(c), F.col(c), 1.0, F.col("mapped_at")), F.col(c)) for c in texts]
    return records.withColumns({"mapped_fields": F.filter(F.array(*marks), lambda x: x.isNotNull()), "provenance": F.concat(*entries)})


def map_generic_json(raw: DataFrame, key: str, payload: str, ord_col: str, at: Column | None = None, registry: FieldRegistry = _REGISTRY) -> DataFrame:
    """Canonical records of JSON objects of any shape: every leaf whose name the registry knows counts.

    Text fields take the last leaf in document order, list fields collect all of them.
    """
    t = F.lit(None).cast("timestamp") if at is None else at
    base = raw.select(F.col(ord_col).cast("long").alias("ord"), F.col(key).cast("string").alias("record_id"), t.alias("mapped_at"), F.col(payload).alias("body"))
    nodes = json_nodes(base, ["ord", "record_id"], "body").where(F.col("kind").isin("string", "number", "boolean"))
    names = registry.as_table(raw.sparkSession)
    # An element of an array of strings bears the name of the array.
    leaf = F.lower(F.coalesce("key", F.regexp_extract("path", r"([^.\[\]]+)\[\d+\]$", 1)))
    lists = F.regexp_extract("path", r"\.(experience|employment|education|work_history|jobs|projects)\b", 1)
    leaves = nodes.withColumn("alias", leaf).where((lists == "") & null_blank(F.col("text")).isNotNull()).join(F.broadcast(names), "alias", "left")
    texts = [c for c, k in registry.kinds.items() if k in ("str", "float", "int")]
    value = null_blank(F.col("text"))
    aggs = [F.max_by(F.when(F.col("canonical") == c, value), F.when(F.col("canonical") == c, F.col("node_id"))).alias(c) for c in texts]
    for c in LIST_FIELDS:
        kept = F.when(F.col("canonical") == c, F.struct("node_id", value.alias("v")))
        aggs.append(F.transform(F.array_sort(F.collect_list(kept)), lambda x: x["v"]).alias(c))
    aggs.append(F.array_sort(F.collect_set("canonical")).alias("mapped_fields"))
    aggs.append(F.array_sort(F.collect_set(F.when(F.col("canonical").isNull(), F.col("alias")))).alias("unknown_fields"))
    found = leaves.groupBy("ord", "record_id").agg(*aggs)
    full = base.select("ord", "record_id", "mapped_at").join(found, ["ord", "record_id"], "left")
    packed = F.flatten(F.transform(F.coalesce("skills", F.array().cast("array<string>")), N.split_skills))
    out = full.withColumns(
        {"source_type": F.lit("ats"), "source_label": F.lit("generic"), "skills": packed, "years_of_experience": N.real(F.col("years_of_experience").try_cast("double")),
         "github_stars": F.col("github_stars").try_cast("long"), "github_repos": F.col("github_repos").try_cast("long"), "provenance": F.array().cast(PROVENANCE)}
    )
    return infer(align(out))


# ---------------------------------------------------------------- profile API


def map_github(payloads: DataFrame, key: str = "record_id", payload: str = "payload", ord_col: str = "ord", at: Column | None = None, max_repos: int = 20) -> DataFrame:
    """Canonical records of profile API answers ``{profile, repos, languages, topics, total_stars}``.

    Topics and languages become skills, the first ``max_repos`` own repositories become experience.
    """
    p = F.col(payload)
    t = F.lit(None).cast("timestamp") if at is None else at
    login = _j(p, "$.profile.login")
    blog = _j(p, "$.profile.blog")
    repos = F.from_json(
        F.get_json_object(p, "$.repos"), "array<struct<name string, description string, html_url string, language string, fork boolean, archived boolean>>"
    )
    own = F.slice(F.filter(repos, lambda r: ~F.coalesce(r["fork"], F.lit(False))), 1, max_repos)
    jobs = F.transform(
        own,
        lambda r: F.struct(
            F.concat(F.lit("github/"), login).alias("company"), r["name"].alias("title"), F.lit(None).cast("string").alias("start_date"),
            F.lit(None).cast("string").alias("end_date"), (~F.coalesce(r["archived"], F.lit(False))).alias("is_current"), r["description"].alias("description"),
            F.lit("Remote / Open Source").alias("location"), r["html_url"].alias("url"),
        ),
    )
    languages = F.from_json(F.get_json_object(p, "$.languages"), "map<string,int>")
    topics = F.coalesce(F.from_json(F.get_json_object(p, "$.topics"), "array<string>"), F.array().cast("array<string>"))
    names = F.coalesce(F.map_keys(languages), F.array().cast("array<string>"))
    ranked = F.transform(F.map_entries(languages), lambda e: F.struct(e["value"].alias("n"), e["key"].alias("k")))
    twitter = _j(p, "$.profile.twitter_username")
    out = payloads.select(
        F.col(ord_col).cast("long").alias("ord"), F.col(key).cast("string").alias("record_id"), F.lit("github").alias("source_type"), login.alias("source_label"),
        _j(p, "$.profile.name").alias("full_name"), F.filter(F.array(_j(p, "$.profile.email")), lambda x: x.isNotNull()).alias("emails"),
        _j(p, "$.profile.location").alias("location"), _j(p, "$.profile.bio").alias("summary"),
        F.regexp_replace(_j(p, "$.profile.company"), r"^@+", "").alias("current_company"), _j(p, "$.profile.html_url").alias("github_url"),
        login.alias("github_username"), F.when(blog.rlike(r"^https?://"), blog).otherwise(F.concat(F.lit("https://"), blog)).alias("website"),
        F.when(twitter.isNotNull(), F.create_map(F.lit("twitter"), twitter)).alias("other_links"),
        F.nullif(F.get_json_object(p, "$.total_stars").try_cast("long"), F.lit(0)).alias("github_stars"),
        F.nullif(F.get_json_object(p, "$.profile.public_repos").try_cast("long"), F.lit(0)).alias("github_repos"),
        F.array_max(ranked)["k"].alias("primary_language"), F.array_distinct(F.concat(topics, names)).alias("skills"), jobs.alias("experience"), t.alias("mapped_at"),
    )
    return infer(_with_marks(align(out)))


# ---------------------------------------------------------------- résumé text

#: Headers of résumé sections. Fixed values.
SECTIONS = {
    "SUMMARY": r"summary|professional\s+summary|objective|career\s+objective|profile|about\s+me|overview|introduction",
    "SKILLS": r"skills|technical\s+skills|core\s+skills|competencies|technologies|tech\s+stack|expertise|tools|programming\s+languages|languages\s+&\s+tools",
    "EXPERIENCE": r"experience|work\s+experience|professional\s+experience|employment|employment\s+history|work\s+history|career\s+history|positions?",
    "EDUCATION": r"education|academic|academics|qualifications|educational\s+background|degrees?|schooling",
    "PROJECTS": r"projects?|personal\s+projects?|side\s+projects?|open\s+source|portfolio",
    "CERTIFICATIONS": r"certifications?|certificates?|licen[sc]es?|professional\s+certifications?|awards?",
}
EMAIL_IN_TEXT = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
PHONE_IN_TEXT = r"\+?\d[\d\s\-().]{7,14}\d"
URL_IN_TEXT = r"""https?://[^\s"'<>]+"""
_RANGE = r"(?i)(\d{4})\s*[-–—]\s*(\d{4}|present|current|now)"
_BULLET = r"^[•\-*·–—]\s*"


def section_header(line: Column) -> Column:
    """Name of the section that a line opens, or null."""
    found = [F.when(line.rlike(rf"(?i)^\s*(?:{p})\s*:?\s*$"), F.lit(s)) for s, p in SECTIONS.items()]
    return F.coalesce(*found)


def section_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, section, lines)``: the lines of each section of each document, folded within the row.

    Lines before the first header are ``CONTACT``. A repeated header replaces the section's lines.
    """
    lines = F.split(F.col(text), r"\r?\n")
    tagged = F.transform(lines, lambda x: F.struct(section_header(x).alias("head"), x.alias("line")))
    at = F.transform(tagged, lambda t, i: F.when(t["head"].isNotNull(), F.struct(i.alias("i"), t["head"].alias("head"))))
    heads = F.concat(F.array(F.struct(F.lit(-1).alias("i"), F.lit("CONTACT").alias("head"))), F.filter(at, lambda h: h.isNotNull()))
    spans = F.transform(
        heads,
        lambda h, k: F.struct(
            h["head"].alias("section"), h["i"].alias("at"),
            F.slice(lines, h["i"] + 2, F.greatest(F.coalesce(F.get(heads, k + 1)["i"], F.size(lines)) - h["i"] - 1, F.lit(0))).alias("lines"),
        ),
    )
    rows = docs.select(F.col(key), F.explode(spans).alias("s")).select(key, "s.section", "s.at", "s.lines")
    return rows.groupBy(key, "section").agg(F.max_by("lines", "at").alias("lines")).where(
        F.exists("lines", lambda x: F.trim(x) != "") | (F.col("section") == "CONTACT")
    )


def _fold_jobs(lines: Column) -> Column:
    """Jobs of a section: a line with a range of years opens one, other lines describe it."""
    empty = F.array().cast("array<struct<title:string,company:string,start_date:string,end_date:string,is_current:boolean,description:string>>")

    def parts(x: Column) -> Column:
        return F.transform(F.split(x, r"(?i)\s+at\s+|\s*[|,–—]\s*"), lambda p: F.trim(p))

    def opened(x: Column) -> Column:
        end = F.regexp_extract(x, _RANGE, 2)
        dated = x.rlike(_RANGE)
        head = F.regexp_replace(F.regexp_replace(x, _RANGE, ""), r"^[ |\-–—]+|[ |\-–—]+$", "")
        p = parts(head)
        return F.struct(
            F.when(head != "", p[0]).alias("title"), F.get(p, F.lit(1)).alias("company"), F.when(dated, F.regexp_extract(x, _RANGE, 1)).alias("start_date"),
            F.when(dated & end.rlike(r"^\d"), end).alias("end_date"), (dated & ~end.rlike(r"^\d")).alias("is_current"), F.lit("").alias("description"),
        )

    def step(acc: Column, x: Column) -> Column:
        clean = F.regexp_replace(F.trim(x), _BULLET, "")
        last = F.element_at(acc, -1)
        longer = F.array_append(
            F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
            F.struct(last["title"].alias("title"), last["company"].alias("company"), last["start_date"].alias("start_date"), last["end_date"].alias("end_date"),
                     last["is_current"].alias("is_current"), F.trim(F.concat_ws(" ", last["description"], clean)).alias("description")),
        )
        return F.when(F.trim(x).rlike(_RANGE), F.array_append(acc, opened(F.trim(x)))).when(clean == "", acc).when(
            F.size(acc) == 0, F.array_append(acc, opened(clean))
        ).otherwise(longer)

    texts = F.filter(F.coalesce(lines, F.array().cast("array<string>")), lambda x: F.trim(x) != "")
    return F.when(F.size(texts) > 0, F.aggregate(texts, empty, step)).otherwise(empty)


_DEGREE = r"(?i)\b(?:B\.?S\.?|B\.?E\.?|B\.?Tech|B\.?Sc\.?|M\.?S\.?|M\.?E\.?|M\.?Tech|M\.?Sc\.?|MBA|Ph\.?D\.?|Bachelor|Master|Doctor)\b"


def _fold_schools(lines: Column) -> Column:
    """Schools of a section: a line with years or a degree opens one; the next line gives a missing degree."""
    kind = "array<struct<institution:string,degree:string,start_date:string,end_date:string>>"
    empty = F.array().cast(kind)

    def opened(x: Column) -> Column:
        dated = x.rlike(_RANGE)
        end = F.regexp_extract(x, _RANGE, 2)
        rest = F.when(dated, F.regexp_replace(F.regexp_replace(x, _RANGE, ""), r"^[ |\-–—]+|[ |\-–—]+$", "")).otherwise(x)
        p = F.transform(F.split(rest, r"\s*[|,–—]\s*"), lambda v: F.trim(v))
        marked = dated | x.rlike(_DEGREE)
        return F.struct(
            F.when(marked & (rest != ""), p[0]).when(~marked, x).alias("institution"), F.when(marked, F.get(p, F.lit(1))).alias("degree"),
            F.when(dated, F.regexp_extract(x, _RANGE, 1)).alias("start_date"), F.when(dated & end.rlike(r"^\d"), end).alias("end_date"),
        )

    def step(acc: Column, line: Column) -> Column:
        x = F.trim(line)
        last = F.element_at(acc, -1)
        filled = F.array_append(
            F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
            F.struct(last["institution"].alias("institution"), F.coalesce(last["degree"], F.regexp_replace(x, _BULLET, "")).alias("degree"),
                     last["start_date"].alias("start_date"), last["end_date"].alias("end_date")),
        )
        return F.when(x.rlike(_RANGE) | x.rlike(_DEGREE) | (F.size(acc) == 0), F.array_append(acc, opened(x))).otherwise(filled)

    texts = F.filter(F.coalesce(lines, F.array().cast("array<string>")), lambda x: F.trim(x) != "")
    return F.when(F.size(texts) > 0, F.aggregate(texts, empty, step)).otherwise(empty)


def map_resumes(docs: DataFrame, key: str = "record_id", text: str = "full_text", ord_col: str = "ord", at: Column | None = None) -> DataFrame:
    """Canonical records of résumé texts: contact lines, summary, skills, jobs, schools, certificates, projects."""
    t = F.lit(None).cast("timestamp") if at is None else at
    sections = section_lines(docs, key, text).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("section", "lines"))).alias("sections"))
    rows = docs.join(sections, key, "left")
    part = lambda s: F.element_at("sections", s)
    head = F.slice(part("CONTACT"), 1, 12)
    top = F.array_join(head, "\n")
    links = F.array_distinct(F.transform(F.regexp_extract_all(top, F.lit(f"({URL_IN_TEXT})"), F.lit(1)), lambda u: F.regexp_replace(u, r"[.,;)]+$", "")))
    bare = lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, EMAIL_IN_TEXT, ""), URL_IN_TEXT, ""), PHONE_IN_TEXT, ""))
    name = F.get(F.filter(F.transform(head, bare), lambda x: (x != "") & (F.length(x) < 60)), F.lit(0))
    unbulleted = lambda s: F.filter(F.transform(part(s), lambda x: F.regexp_replace(F.trim(x), _BULLET, "")), lambda x: x != "")
    jobs = F.transform(
        _fold_jobs(part("EXPERIENCE")),
        lambda e: F.struct(e["company"].alias("company"), e["title"].alias("title"), e["start_date"].alias("start_date"), e["end_date"].alias("end_date"),
                           e["is_current"].alias("is_current"), e["description"].alias("description"), F.lit(None).cast("string").alias("location"), F.lit(None).cast("string").alias("url")),
    )
    schools = F.transform(
        _fold_schools(part("EDUCATION")),
        lambda e: F.struct(e["institution"].alias("institution"), e["degree"].alias("degree"), F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("field_of_study"),
                           e["start_date"].alias("start_date"), e["end_date"].alias("end_date"), F.lit(None).cast("string").alias("gpa"), F.lit(None).cast("string").alias("grade")),
    )
    work = unbulleted("PROJECTS")
    projects = F.when(
        F.size(work) > 0,
        F.array(F.struct(work[0].alias("name"), F.array_join(F.slice(work, 2, 1 << 30), " ").alias("description"), F.lit(None).cast("string").alias("url"), F.array().cast("array<string>").alias("technologies"))),
    )
    out = rows.select(
        F.col(ord_col).cast("long").alias("ord"), F.col(key).cast("string").alias("record_id"), F.lit("resume").alias("source_type"), F.lit("resume").alias("source_label"),
        name.alias("full_name"), F.array_distinct(F.regexp_extract_all(top, F.lit(f"({EMAIL_IN_TEXT})"), F.lit(1))).alias("emails"),
        F.array_distinct(F.regexp_extract_all(F.regexp_replace(top, URL_IN_TEXT, " "), F.lit(f"({PHONE_IN_TEXT})"), F.lit(1))).alias("phones"),
        _first_link(links, "github").alias("github_url"), _first_link(links, "linkedin").alias("linkedin_url"), _first_link(links, "website").alias("website"),
        null_blank(F.array_join(F.transform(part("SUMMARY"), lambda x: F.trim(x)), " ")).alias("summary"),
        N.split_skills(F.array_join(unbulleted("SKILLS"), ",")).alias("skills"), unbulleted("CERTIFICATIONS").alias("certifications"),
        jobs.alias("experience"), schools.alias("education"), projects.alias("projects"), t.alias("mapped_at"),
    )
    return infer(_with_marks(align(out)))


def union_records(*parts: DataFrame) -> DataFrame:
    """Records of several sources as one table; an empty argument list is an error."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
