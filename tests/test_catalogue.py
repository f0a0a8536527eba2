"""Every query with SQL against DuckDB, on small tables of the test data's shape."""

import math

import pandas as pd
import pytest
from tables import SCHEMAS, at, build

duckdb = pytest.importorskip("duckdb")

import __spark_entry__  # noqa: E402

_NEEDS_OTHER_TABLES = {"json_nested_get", "cosine_best_match", "event_windows"}


def _rows():
    job = lambda c, t, a, b: (c, t, a, b, None, "Pune")
    skill = lambda n, c=None: (n, c, [], "data" if c else None, None, 0.5, ["csv", ""], None)
    recruiters = [
        {"first_name": "Ada", "last_name": "Byron", "email": " Ada@x.example", "phone": "+1 (415) 555-0100", "linkedin": "www.linkedin.example/in/Ada.B/?x=1", "github": "github.example/ada?tab=x",
         "current_company": "Acme, Inc.", "current_title": "Dev", "skills": 'a, "b, c"; TCP/IP', "location": "Pune,  India", "notes": "mail a@b.example or +44 20 7946 0958"},
        {"first_name": "Ada", "last_name": "Byron", "email": "ada@x.example", "phone": "n/a", "skills": "['x, y', 'z']", "location": "Oslo (NO)", "current_company": "Tesco"},
        {"first_name": "Bo", "phone": "tel:+49-3237-956-216", "skills": "1) one 2) two", "notes": " ", "github": "the-bo", "linkedin": ""}, {},
    ]
    ats = [
        {"candidate_id": "c1", "first_name": "Ada", "email": "ADA@X.example", "phone": "+14155550100", "current_position": job("Acme", "Dev", "2020", None), "skills": ["a", "A", None, "b"],
         "experience": [job("Acme", "Dev", "2020-05", "3/2021"), None, job("", None, "2021", "2019")], "education": [("U", "BSc", "CS", "2010", "2014-06", "A")], "years_experience": 70, "updated_at": at(2)},
        {"candidate_id": "c1", "linkedin_url": "https://linkedin.example/in/ada.b", "experience": [], "updated_at": at(1)}, {},
    ]
    profile = [
        {"group_id": 1, "candidate_id": "p1", "full_name": "Ada Byron", "headline": "Dev | X", "emails": ["a@x.co", "A@x.co"], "phones": ["+14155550100"], "location": ("Pune", None, "IN", "IN"),
         "skills": [skill("Data  Modelling", "Data Modelling"), skill("q")], "links": [("github", "https://github.example/ada", True)], "overall_confidence": 0.7, "updated_at": at(3)},
        {"group_id": 1, "candidate_id": "p2", "full_name": "ADA BYRON", "headline": "Dev…", "emails": [], "phones": ["12"], "location": (None, None, None, None), "skills": [], "overall_confidence": 0.1, "updated_at": at(5)},
        {"group_id": 1, "candidate_id": "p3", "full_name": "A. Byron", "headline": "", "emails": ["b@x.co"], "skills": [skill("Q")], "links": [], "updated_at": at(4), "overall_confidence": 0.6},
        {"group_id": 2, "candidate_id": "p4", "full_name": " ", "emails": ["x"], "updated_at": at(1), "overall_confidence": 0.5},
    ]
    export = [{**p, "experience": [job("Acme", "Dev", "2020", "2019"), job("acme", "dev", "2020", None), job("Beta", "Ops", "1900", None)], "years_experience": y} for p, y in zip(profile, (5.0, -1.0, 70.0, None))]
    raw = [{"raw_fields": t} for t in ('{"candidate": {"name": "x", "employments": [{"company": "A"}, null]}, "applications": []}', "[]", "{", '{"name": "y", "experience": "[{\\"title\\": \\"t\\"}]"}', None)]
    docs = [{"doc_id": 1, "text": "intro\nWork Experience:\na\nb\nSkills\n \nWORK experience\nc"}, {"doc_id": 2}, {"doc_id": 3, "text": ""}]
    ref = [{"skill_id": 1, "canonical_name": "Data Modelling", "aliases": ["dimensional modelling"]}, {"skill_id": 2, "canonical_name": "Q"}]
    number = lambda rows, start: [{"row_id": start + i, **r} for i, r in enumerate(rows)]
    return {
        "recruiter_sample": number(recruiters, 1), "ats_sample": number(ats, 100), "output_default": number(profile, 300), "output_ats_export": number(export, 400),
        "raw_record": number(raw, 500), "documents": docs, "skill_ref": ref, "pack_capacity": [{"capacity_id": 1, "capacity_tokens": 8}],
    }


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("data")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name, rows in _rows().items():
        build(spark, name, rows).coalesce(1).write.parquet(f"{d}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{d}/{name}.parquet/*.parquet'")
    return str(d), con


def _values(df):
    def one(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return None
        return round(float(v), 6) if isinstance(v, float) else int(v) if hasattr(v, "item") and not isinstance(v.item(), bool) and isinstance(v.item(), int) else bool(v) if hasattr(v, "item") and isinstance(v.item(), bool) else one(v.item()) if hasattr(v, "item") else v

    df = df[sorted(df.columns)]
    return sorted((tuple(one(x) for x in r) for r in df.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(set(__spark_entry__.oracle_sql()) - _NEEDS_OTHER_TABLES))
def test_query_equals_sql(spark, data, name):
    d, con = data
    got = __spark_entry__.queries()[name](spark, d).toPandas()
    want = con.execute(__spark_entry__.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert _values(got) == _values(want)


def test_all_queries_have_tables():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(SCHEMAS) >= {"recruiter_sample", "documents"}
