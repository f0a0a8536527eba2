"""Small tables in the shape of the test data, and hard variants of them."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

JOB = "struct<company:string,title:string,start_date:string,end_date:string,description:string,location:string>"
SKILL = (
    "struct<name:string,normalized_name:string,aliases:array<string>,category:string,parent_domain:string,confidence:double,"
    "sources:array<string>,embedding_score:double>"
)
METRICS = "struct<overall_confidence:double,completeness:double,consistency:double,agreement:double,freshness:double>"
PROFILE = (
    "row_id long, candidate_id string, group_id long, full_name string, emails array<string>, phones array<string>,"
    " location struct<city:string,state:string,country:string,country_code:string>, headline string, {years}"
    f" skills array<{SKILL}>, {{jobs}} links array<struct<platform:string,url:string,verified:boolean>>, quality_metrics {METRICS},"
    " overall_confidence double, {created} updated_at timestamp, loaded_at timestamp"
)
SCHEMAS = {
    "recruiter_sample": "row_id long, first_name string, last_name string, email string, phone string, linkedin string, github string, current_company string,"
    " current_title string, skills string, location string, years_experience string, notes string, source_file string, exported_at timestamp, loaded_at timestamp",
    "ats_sample": f"row_id long, candidate_id string, first_name string, last_name string, email string, phone string, linkedin_url string, github_url string,"
    f" current_position {JOB}, experience array<{JOB}>, education array<struct<institution:string,degree:string,field_of_study:string,start_date:string,"
    "end_date:string,grade:string>>, skills array<string>, years_experience int, location string, headline string, source_file string, updated_at timestamp, received_at timestamp",
    "raw_record": "row_id long, record_id string, source string, source_type string, raw_fields string, metadata struct<checksum:string,file_size:long,mime:string,encoding:string>,"
    " candidate_hint string, created_at timestamp",
    "output_default": PROFILE.format(years="", jobs="", created="created_at timestamp,"),
    "output_ats_export": PROFILE.format(years="years_experience double,", jobs=f"experience array<{JOB}>,", created=""),
    "documents": "doc_id long, text string, lang string, source string, n_chars long, doc_type string, created_at timestamp, received_at timestamp",
    "skill_ref": "skill_id long, canonical_name string, category string, parent_domain string, aliases array<string>",
    "pack_capacity": "capacity_id long, capacity_name string, capacity_tokens long",
}

#: Names that the operators use inside; an input column of such a name must do no harm.
CLASHING = "pos key node value h a b i j name kind text ids block source rank n size entity side theta cluster root band path tbl field truth source_type ord".split()


def at(day: int) -> datetime:
    return datetime(2024, 1, day, tzinfo=timezone.utc)


def build(spark, table: str, rows: list[dict]):
    """A table of ``rows``; missing columns are null."""
    schema = spark.createDataFrame([], SCHEMAS[table]).schema
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)


def null_rows(spark, table: str, n: int = 3):
    """Rows that have nothing but their first column."""
    first = SCHEMAS[table].split()[0]
    return build(spark, table, [{first: i} for i in range(n)])


def with_clashes(df):
    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})
