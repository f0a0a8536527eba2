"""The canonical record, source priorities and weights, and enumerations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lower is more trusted; unknown sources come last. Fixed values.
SOURCE_PRIORITY = {"ats": 1, "github": 2, "csv": 3, "recruiter_notes": 4, "resume": 5}
UNKNOWN_PRIORITY = 99

#: Base confidence of a value by its source. Fixed values.
SOURCE_WEIGHT = {"ats": 0.90, "github": 0.85, "csv": 0.75, "recruiter_notes": 0.65, "resume": 0.60}
UNKNOWN_WEIGHT = 0.5

#: Weight of each profile field in the overall confidence. Fixed values.
FIELD_WEIGHT = {
    "full_name": 1.00, "emails": 1.00, "phones": 0.85, "location": 0.70, "headline": 0.50, "years_experience": 0.75,
    "skills": 0.90, "experience": 0.85, "education": 0.75, "links": 0.40,
}

MERGE_STRATEGIES = ("source_priority", "majority_vote", "most_recent", "manual")
MISSING_STRATEGIES = ("omit", "null", "error", "default")
MAPPING_METHODS = ("direct", "alias", "inferred", "nested", "section")

EXPERIENCE = T.ArrayType(
    T.StructType(
        [T.StructField(n, T.StringType()) for n in ("company", "title", "start_date", "end_date")]
        + [T.StructField("is_current", T.BooleanType())]
        + [T.StructField(n, T.StringType()) for n in ("description", "location", "url")]
    )
)
EDUCATION = T.ArrayType(
    T.StructType(
        [T.StructField(n, T.StringType()) for n in ("institution", "degree", "field", "field_of_study", "start_date", "end_date", "gpa", "grade")]
    )
)
PROJECTS = T.ArrayType(
    T.StructType(
        [T.StructField(n, T.StringType()) for n in ("name", "description", "url")] + [T.StructField("technologies", T.ArrayType(T.StringType()))]
    )
)
PROVENANCE = T.ArrayType(
    T.StructType(
        [T.StructField(n, T.StringType()) for n in ("field", "source", "method", "original_value", "normalized_value", "processing_stage")]
        + [T.StructField("confidence", T.DoubleType()), T.StructField("timestamp", T.TimestampType()), T.StructField("reason", T.StringType())]
    )
)
_S, _A = T.StringType(), T.ArrayType(T.StringType())

#: One source's view of a person. ``ord`` is the input position and breaks every tie.
CANONICAL = T.StructType(
    [
        T.StructField("ord", T.LongType()), T.StructField("record_id", _S), T.StructField("source_type", _S), T.StructField("source_label", _S),
        T.StructField("full_name", _S), T.StructField("first_name", _S), T.StructField("last_name", _S), T.StructField("emails", _A),
        T.StructField("phones", _A), T.StructField("location", _S), T.StructField("headline", _S), T.StructField("summary", _S),
        T.StructField("current_company", _S), T.StructField("current_title", _S), T.StructField("years_of_experience", T.DoubleType()),
        T.StructField("skills", _A), T.StructField("experience", EXPERIENCE), T.StructField("education", EDUCATION), T.StructField("certifications", _A),
        T.StructField("projects", PROJECTS), T.StructField("github_url", _S), T.StructField("github_username", _S), T.StructField("linkedin_url", _S),
        T.StructField("website", _S), T.StructField("other_links", T.MapType(_S, _S)), T.StructField("github_stars", T.LongType()),
        T.StructField("github_repos", T.LongType()), T.StructField("primary_language", _S), T.StructField("provenance", PROVENANCE),
        T.StructField("mapped_fields", _A), T.StructField("ignored_fields", _A), T.StructField("unknown_fields", _A),
        T.StructField("mapped_at", T.TimestampType()),
    ]
)
LIST_FIELDS = ("emails", "phones", "skills", "certifications")
#: Text in place of one of these is kept as an unknown field, never put among structs.
STRUCT_FIELDS = ("experience", "education", "projects")


def align(df: DataFrame) -> DataFrame:
    """``df`` with exactly the canonical columns: missing ones null, others dropped, types cast."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in CANONICAL.fields])
