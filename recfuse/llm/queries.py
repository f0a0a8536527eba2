"""Queries of the training-data problems, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recfuse.llm import canonical, langid, matching, packing, pii, survivor, tokens, variants
from recfuse.session import durable, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_matches(spark, sf_dir).select("recruiter_row_id", "ats_row_id")


def p1_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matching rows with the marginal probability of the match."""
    return matching.match_people(table(spark, sf_dir, "recruiter_sample"), table(spark, sf_dir, "ats_sample"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = [table(spark, sf_dir, t) for t in ("recruiter_sample", "ats_sample")]
    found = pii.find_mentions(pii.texts_of(*tables), pii.fit_on(*tables))
    return found.select("tbl", "row_id", "start_pos", "kind")


def p3_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The free texts with typed placeholders in the place of personal information."""
    tables = [table(spark, sf_dir, t) for t in ("recruiter_sample", "ats_sample")]
    return pii.redact(pii.texts_of(*tables), pii.fit_on(*tables))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = variants.organisation_names(table(spark, sf_dir, "ats_sample"), table(spark, sf_dir, "recruiter_sample"))
    return variants.name_pairs(durable(variants.link_variants(names)))


def p4_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling with the number of its organisation and of the spellings that share it."""
    names = variants.organisation_names(table(spark, sf_dir, "ats_sample"), table(spark, sf_dir, "recruiter_sample"))
    linked = durable(variants.link_variants(names))
    sizes = linked.groupBy("kind", "cluster").agg(F.count(F.lit(1)).alias("n_spellings"))
    return linked.join(sizes, ["kind", "cluster"]).select("kind", "name", "cluster", "n_spellings")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = canonical.map_skills(table(spark, sf_dir, "output_default"), table(spark, sf_dir, "skill_ref"))
    return mapped.select("row_id", "skill_pos", "skill_id")


def p5_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the name, the entry's canonical name and the score."""
    return canonical.map_skills(table(spark, sf_dir, "output_default"), table(spark, sf_dir, "skill_ref"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = survivor.profile_claims(*[table(spark, sf_dir, t) for t in ("output_default", "output_ats_export")])
    return survivor.survivors(claims).select("group_id", "field", "row_id")


def p6_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One surviving profile per duplicate group."""
    tables = [table(spark, sf_dir, t) for t in ("output_default", "output_ats_export")]
    return survivor.surviving_profiles(*tables).select(
        "group_id", "full_name", "headline", "years_experience", F.array_join("emails", "; ").alias("emails")
    )


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, sf_dir, "documents"))


def p8_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its number of tokens, and whether decoding gives its text back."""
    docs = table(spark, sf_dir, "documents")
    decoded = tokens.decode_corpus(tokens.encode_corpus(docs))
    return docs.select("doc_id", "text").join(decoded, "doc_id").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"),
    )


def p9_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = tokens.encode_corpus(table(spark, sf_dir, "documents")).select("doc_id", F.size("ids").cast("long").alias("size"))
    return packing.pack(durable(sized), table(spark, sf_dir, "pack_capacity"))


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers of each capacity are."""
    return packing.fill_report(durable(p9_bins(spark, sf_dir)), table(spark, sf_dir, "pack_capacity"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.doubtful(langid.document_segments(table(spark, sf_dir, "documents"))).select("doc_id", "start_pos", "lang")


def p10_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every segment of every document, with its language and confidence."""
    return langid.document_segments(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_found": p1_found, "p1_matches": p1_matches, "p3_found": p3_found, "p3_redacted": p3_redacted, "p4_found": p4_found, "p4_clusters": p4_clusters, "p5_found": p5_found, "p5_mapped": p5_mapped, "p6_found": p6_found, "p6_survivors": p6_survivors, "p8_ids": p8_ids, "p8_round_trip": p8_round_trip, "p9_bins": p9_bins, "p9_fill": p9_fill, "p10_found": p10_found, "p10_segments": p10_segments}


_FILLERS = ", ".join("'" + f.replace("'", "''") + "'" for f in survivor.FILLERS)
_P6_SQL = rf"""
WITH raw AS (
  SELECT group_id, row_id, updated_at, f.field, f.v FROM output_default, LATERAL (VALUES ('full_name', full_name), ('headline', headline)) f(field, v) WHERE group_id IS NOT NULL),
kinds AS (SELECT *, lower(trim(regexp_replace(regexp_replace(v, '<[^<>]*>|&\w+;', ' ', 'g'), '[\s\x{{200b}}]+', ' ', 'g'))) AS k FROM raw),
good AS (SELECT group_id, row_id, updated_at, field, v, trim(regexp_replace(lower(v), '[\s.\x{{00a0}}…]+', ' ', 'g')) AS p FROM kinds
  WHERE v IS NOT NULL AND k NOT IN ({_FILLERS}) AND regexp_matches(k, '\p{{L}}') AND NOT regexp_matches(k, '@|://|\bwww\.|^\S+\.(?:com|org|net|example)(?:/\S*)?$') AND NOT (field = 'full_name' AND regexp_matches(v, '\d'))),
spellings AS (SELECT DISTINCT group_id, field, p FROM good),
short AS (SELECT DISTINCT a.group_id, a.field, a.p FROM spellings a JOIN spellings b ON a.group_id = b.group_id AND a.field = b.field AND a.p <> b.p
  WHERE (starts_with(b.p, a.p) AND length(a.p) >= CASE a.field WHEN 'full_name' THEN 2 ELSE 3 END)
    OR (a.field = 'full_name' AND regexp_full_match(b.p, '(?:\S+ )*' || array_to_string(list_transform(string_split(a.p, ' '), lambda t: CASE WHEN length(t) = 1 THEN t || '\S*' ELSE t END), ' (?:\S+ )*') || '(?: \S+)*'))),
usable AS (SELECT group_id, field, row_id, updated_at FROM good g WHERE NOT EXISTS (SELECT 1 FROM short s WHERE s.group_id = g.group_id AND s.field = g.field AND s.p = g.p)
  UNION ALL SELECT group_id, 'years_experience', row_id, updated_at FROM output_ats_export WHERE group_id IS NOT NULL AND years_experience BETWEEN 0 AND 60 AND NOT isnan(years_experience)),
many AS (SELECT group_id, 'd' AS t FROM output_default GROUP BY 1 HAVING count(*) >= 2 UNION ALL SELECT group_id, 'e' FROM output_ats_export GROUP BY 1 HAVING count(*) >= 2)
SELECT u.group_id, u.field, arg_max(u.row_id, (u.updated_at, -u.row_id)) AS row_id FROM usable u JOIN many m ON m.group_id = u.group_id AND m.t = CASE u.field WHEN 'years_experience' THEN 'e' ELSE 'd' END GROUP BY 1, 2
"""


def oracle_sql() -> dict[str, str]:
    return {"p6_found": _P6_SQL}
