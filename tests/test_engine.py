import json
import random

import pytest
from pyspark.sql import functions as F
from tables import build

from recfuse.operators import fusion, identity, mapping, quality, validation
from recfuse.operators.components import connected_components, edge_mark
from recfuse.operators.normalizing import NormalizationPipeline, normalize_skills, resolve_skills, skill_aliases
from recfuse.operators.projection import MINIMAL, RECRUITER_VIEW, Projection, condition, project, to_output_json
from recfuse.operators.registry import FieldRegistry
from recfuse.plans.catalogue import CSV_NAMES
from recfuse.plans.pipeline import PipelineConfig, run
from recfuse.sources import files

CSV = "First Name,Last Name,Email,Phone,LinkedIn,GitHub,Current Company,Current Title,Skills,Location,Years Experience,Notes\n"


def test_registry():
    r = FieldRegistry.default()
    assert len(r.kinds) == 23
    assert r.resolve("current title") == "headline" and r.resolve("Current_Title ") == "current_title"
    assert r.resolve("portfolio") == "projects" and r.resolve("city") == "location" and r.resolve("years experience") is None
    r.replace("headline", ("motto",))
    assert r.resolve("motto") == "headline" and r.resolve("role") is None


def test_components_against_union_find(spark):
    rng = random.Random(5)
    for n, m in ((1, 0), (30, 20), (300, 250), (200, 199)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] if m != 199 else [(i, i + 1) for i in range(199)]
        parent = list(range(n))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
        got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
        assert got == {v: find(v) for e in edges for v in e}
    none = spark.createDataFrame([(None, 1), (2, None), (3, 3)], "src long, dst long")
    assert [tuple(r) for r in connected_components(none).collect()] == [(3, 3)]


def test_mark_of_many_edges(spark):
    # The sum of so many hashes of 40 bits is no long any more.
    path = spark.range(1 << 25).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    n, h = edge_mark(path)
    assert n == 1 << 25 and edge_mark(path.where("a <> 7"))[1] != h
    assert edge_mark(path.repartition(3).where("a < 1000")) == edge_mark(path.where("a < 1000").orderBy(F.col("a").desc())) != edge_mark(path.where("a < 999"))


def _golden(spark, tmp_path):
    f = tmp_path / "people.csv"
    f.write_text(
        CSV
        + 'Ada,Byron,ada@x.org,+14155550100,https://linkedin.com/in/ada,https://github.com/ada,Acme Inc,Engineer,"Python, SQL","Pune, India",5,hi\n'
        + "\n"
        + "ada@x.org,,ada@x.org,+14155550100,,,,,,,,\n"
    )
    t = files.read_delimited(spark, str(f)).withColumn("_id", F.col("ord").cast("string"))
    return mapping.map_columns(t, "csv", "_id", "ord")


def test_golden_scores(spark, tmp_path):
    rec = _golden(spark, tmp_path)
    assert rec.count() == 2
    first = rec.orderBy("ord").first()
    assert first.full_name == "Ada Byron" and first.headline == "Engineer" and first.skills == ["Python", "SQL"] and first.github_username == "ada"
    assert "Years Experience" in first.unknown_fields and "Notes" in first.ignored_fields and first.years_of_experience is None
    p = run(rec, PipelineConfig()).profiles.collect()
    assert len(p) == 1 and p[0].merged_records == 2
    assert p[0].overall_confidence == 0.5799 and p[0].quality_metrics.completeness == 0.7 and p[0].quality_metrics.agreement == 1.0
    assert p[0].emails == ["ada@x.org"] and [x.platform for x in p[0].links] == ["github", "linkedin"] and p[0].location.country == "IN"
    empty = mapping.map_vendor_json(spark.createDataFrame([(0, "r", '{"candidates": []}')], "ord long, record_id string, raw_fields string"))
    e = run(empty, PipelineConfig()).profiles.first()
    assert e.overall_confidence == 0.0409 and e.quality_metrics.completeness == 0.1 and e.full_name is None


def records(spark, rows):
    base = [{"row_id": i, **r} for i, r in enumerate(rows)]
    t = build(spark, "recruiter_sample", base).select(F.col("row_id").alias("ord"), "row_id", *CSV_NAMES)
    return mapping.map_columns(t, "csv", "row_id", "ord", renamed=CSV_NAMES)


def test_identity(spark):
    r = records(
        spark,
        [
            {"first_name": "A", "last_name": "B", "email": "a@x.org", "phone": "N/A", "current_company": "Acme", "location": "Pune"},
            {"first_name": "A", "last_name": "B", "email": "A@x.org ", "phone": "+1 415 555 0100", "current_company": "Acme"},
            {"first_name": "C", "last_name": "D", "phone": "+14155550100"},
            {"first_name": "E", "last_name": "F", "phone": "n/a"},
            {"first_name": "A", "last_name": "B", "current_company": "Acme", "location": "Pune"},
            {},
        ],
    )
    got = {x.ord: x.group_id for x in identity.clusters(r).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 5}
    as_typed = identity.MatchSettings(least_phone_digits=0)
    assert {x.ord: x.group_id for x in identity.clusters(r, as_typed).collect()}[3] == 0
    strict = {x.ord: x.group_id for x in identity.clusters(r, identity.STRICT).collect()}
    assert strict[1] == 0 and strict[2] == 2
    s = {(x.a, x.b): x for x in identity.score_pairs(identity.key_pairs(identity.hard_keys(r)), r).collect()}
    assert abs(s[0, 1].score - 1.0) < 1e-9 and s[0, 1].signals == ["email_match", "name_company_match"] and abs(s[1, 2].score - 0.85) < 1e-9
    with pytest.raises(ValueError):
        identity.clusters(r, identity.MatchSettings(match=0.2))
    g = {x.group_id: x for x in identity.describe_groups(r, identity.clusters(r)).collect()}
    assert g[0].size == 3 and g[0].primary_ord == 0 and not g[0].needs_review and g[5].match_score == 1.0


def test_all_keys_equal_make_one_cluster_without_pairs(spark):
    r = records(spark, [{"email": "desk@x.org"}] * 500)
    pairs = identity.key_pairs(identity.hard_keys(r))
    assert pairs.count() == 499 and identity.clusters(r).select("group_id").distinct().count() == 1


def members(spark, rows):
    schema = "group_id long, ord long, source_type string, mapped_at timestamp, full_name string"
    return spark.createDataFrame(rows, schema)


def test_strategies(spark):
    from datetime import datetime

    t = lambda d: datetime(2024, 1, d)
    m = members(spark, [(1, 0, "csv", t(1), "Al Smith"), (1, 1, "csv", t(2), "AL SMITH"), (1, 2, "ats", t(1), "Albert Smith"), (1, 3, "resume", t(9), "A. Smith"), (2, 4, "csv", t(1), None)])
    pick = lambda **k: fusion.fuse_scalars(m, fields=("full_name",), **k).first()
    assert pick().value == "Albert Smith" and not pick().agreed and len(pick().discarded) == 2
    assert pick(strategy="majority_vote").value == "Al Smith" and pick(strategy="majority_vote").strategy == "majority_vote"
    assert pick(strategy="most_recent").value == "A. Smith"
    assert "manual" in pick(strategy="manual").reason and pick(strategy="manual").value == "Albert Smith"
    assert pick(overrides={"full_name": "most_recent"}).value == "A. Smith"
    assert fusion.fuse_scalars(m, fields=("full_name",)).count() == 1
    tie = members(spark, [(1, 0, "csv", t(1), "A"), (1, 1, "ats", t(1), "B")])
    assert fusion.fuse_scalars(tie, "majority_vote", fields=("full_name",)).first().strategy == "source_priority"


def test_quality_and_validation(spark):
    q = spark.range(1).select(
        quality.field_confidence(F.lit(True), F.array(F.lit("csv"), F.lit("ats")), F.lit(True)).alias("a"),
        quality.field_confidence(F.lit(False), F.array(F.lit("csv")), F.lit(True)).alias("b"),
        quality.field_confidence(F.lit(True), F.array(F.lit("zzz")), F.lit(False)).alias("c"),
    ).first()
    assert abs(q.a - 0.975) < 1e-9 and q.b == 0.0 and abs(q.c - 0.4) < 1e-9
    rows = [
        {"row_id": 1, "full_name": " ", "emails": ["a@b.co", "A@b.co", "x"], "phones": ["12"], "years_experience": -1.0, "overall_confidence": 0.1,
         "experience": [{"company": "A", "title": "B", "start_date": "2020", "end_date": "2019-05"}, {"start_date": "1900"}]},
        {"row_id": 2, "full_name": "Ok", "emails": ["a@b.co"], "overall_confidence": 0.9},
        {"row_id": 3},
    ]
    rows[0]["experience"] = [tuple(e.get(k) for k in ("company", "title", "start_date", "end_date", "description", "location")) for e in rows[0]["experience"]]
    v = validation.validate(build(spark, "output_ats_export", rows))
    got = {}
    for i in validation.issue_rows(v, "row_id").collect():
        got.setdefault(i.row_id, []).append(i.rule)
    assert sorted(got[1]) == sorted(["email_format", "phone_e164_format", "experience_dates_ordered", "experience_not_before_1900", "no_duplicate_emails", "years_experience_range", "min_confidence", "no_empty_name"])
    assert 2 not in got and got[3] == ["primary_email_present"]
    s = validation.statistics(v).first()
    assert (s.total, s.valid, s.invalid, s.pass_rate) == (3, 2, 1, round(2 / 3, 4))
    assert validation.validate(build(spark, "output_ats_export", rows), validation.LENIENT).where("NOT valid").count() == 0
    assert validation.statistics(validation.validate(build(spark, "output_ats_export", []))).first().pass_rate == 0.0


def test_projection(spark):
    df = build(spark, "output_default", [{"row_id": 1, "full_name": "ann lee", "emails": ["a@b.co", "c@d.co"], "overall_confidence": 0.6}, {"row_id": 2, "emails": []}])
    spec = Projection.of(
        {"fields": [
            {"source": "full_name", "output": "name", "transform": "title", "default": "?"}, {"source": "emails", "output": "first", "transform": "first"},
            {"source": "emails", "output": "last", "transform": "last"}, {"source": "emails", "output": "n", "transform": "count"},
            {"source": "emails", "output": "all", "transform": "join:|"}, {"source": "location.city"}, {"source": "nope.deep", "output": "gone"},
            {"source": "full_name", "output": "cut", "transform": "truncate:3", "condition": "overall_confidence >= 0.6"},
        ], "surprise": 1}
    )
    assert spec.unknown_keys == ["surprise"]
    a, b = project(df, spec).collect()
    assert (a.name, a.first, a.last, a.n, a.all, a.city, a.gone, a.cut) == ("Ann Lee", "a@b.co", "c@d.co", 2, "a@b.co|c@d.co", None, None, "ann")
    assert (b.name, b.first, b.n, b.cut) == ("?", None, 0, None)
    truth = lambda c: [r[0] for r in df.select(condition(df, c)).collect()]
    assert truth("full_name") == [True, False] and truth("not emails") == [False, True] and truth("full_name == ann lee") == [True, False]
    assert truth("full_name != ann lee") == [False, True] and truth("overall_confidence > 0.5") == [True, False] and truth("zip < 3") == [False, False]
    out = [json.loads(r.json) for r in to_output_json(project(df, MINIMAL), MINIMAL).collect()]
    assert out[0]["full_name"] == "ann lee" and "emails" not in out[1] and "full_name" not in out[1]
    keep = Projection(missing_field_strategy="null")
    assert json.loads(to_output_json(project(df.select("row_id", "full_name"), keep), keep).collect()[1].json) == {"row_id": 2, "full_name": None}
    assert "quality_metrics" not in project(df, RECRUITER_VIEW).columns
    with pytest.raises(ValueError):
        Projection.of({"missing_field_strategy": "zzz"})


def test_skills(spark):
    ref = build(spark, "skill_ref", [{"skill_id": 1, "canonical_name": "Data Modelling", "aliases": ["dimensional modelling"]}, {"skill_id": 2, "canonical_name": "Pluvio"}])
    names = spark.createDataFrame([("DATA  modelling",), ("Dimensional Modelling",), ("data modeling",), ("Juggling",), (None,), ("",)], "skill string")
    got = {r.skill: (r.canonical, r.method) for r in resolve_skills(names, skill_aliases(ref)).collect()}
    assert got["DATA  modelling"] == ("Data Modelling", "alias") and got["Dimensional Modelling"] == ("Data Modelling", "alias")
    assert got["data modeling"] == ("Data Modelling", "fuzzy") and got["Juggling"] == ("Juggling", "none") and None not in got
    r = normalize_skills(records(spark, [{"skills": "pluvio; Data Modeling, PLUVIO, x"}, {}]), ref)
    assert {x.ord: x.skills for x in r.collect()} == {0: ["Pluvio", "Data Modelling", "x"], 1: []}


def test_normalisation_pipeline(spark):
    r = records(spark, [{"first_name": "ada", "last_name": "BYRON", "email": "A@B.CO", "phone": "022 1234567", "location": " Pune ,  India", "linkedin": "linkedin.com/in/Ada/"}])
    x = NormalizationPipeline().run(r).first()
    assert (x.full_name, x.emails, x.phones, x.location, x.linkedin_url) == ("Ada Byron", ["a@b.co"], ["+91221234567"], "Pune, India", "https://linkedin.com/in/ada")
    assert {"emails", "full_name", "phones"} <= {p.field for p in x.provenance if p.processing_stage == "normalization"}
    off = NormalizationPipeline(disabled=("name",)).remove("url").add("mark", lambda d: d.withColumn("headline", F.lit("m")))
    y = off.run(r).first()
    assert y.full_name == "ada BYRON" and y.linkedin_url == "linkedin.com/in/Ada/" and y.headline == "m"


RESUME = """Ada Byron
ada@x.org | +1 415 555 0100 | https://github.com/ada

Summary
Builds engines.
Skills:
Python, SQL; Python
Work Experience
Engineer at Acme 2019 - present
- Wrote notes
Analyst, Babbage Ltd 2015-2018
Education
Univ of X, BSc 2010-2014
Certifications
• CKA
"""


def test_resume_github_and_vendors(spark):
    r = mapping.map_resumes(spark.createDataFrame([(0, "d", RESUME), (1, "e", ""), (2, "f", None)], "ord long, record_id string, full_text string")).orderBy("ord").collect()
    a = r[0]
    assert (a.full_name, a.emails, a.phones, a.github_username, a.summary, a.skills, a.certifications) == ("Ada Byron", ["ada@x.org"], ["+1 415 555 0100"], "ada", "Builds engines.", ["Python", "SQL"], ["CKA"])
    assert [(e.title, e.company, e.start_date, e.end_date, e.is_current, e.description) for e in a.experience] == [("Engineer", "Acme", "2019", None, True, "Wrote notes"), ("Analyst", "Babbage Ltd", "2015", "2018", False, "")]
    assert [(e.institution, e.degree, e.end_date) for e in a.education] == [("Univ of X", "BSc", "2014")]
    assert r[1].full_name is None and r[2].full_name is None
    payload = {"profile": {"login": "ada", "name": "Ada", "blog": "ada.org", "company": "@acme", "html_url": "https://github.com/ada", "public_repos": 2}, "languages": {"Go": 1, "C": 3},
               "topics": ["t"], "total_stars": 7, "repos": [{"name": "r", "fork": False, "archived": True}, {"name": "f", "fork": True}]}
    g = mapping.map_github(spark.createDataFrame([(0, "g", json.dumps(payload))], "ord long, record_id string, payload string")).first()
    assert (g.website, g.current_company, g.primary_language, g.github_stars, g.skills) == ("https://ada.org", "acme", "C", 7, ["t", "Go", "C"])
    assert [(e.title, e.is_current) for e in g.experience] == [("r", False)]
    docs = [
        {"candidate": {"first_name": "G", "last_name": "H", "email_addresses": [{"value": "g@h.co"}], "website_addresses": [{"value": "https://github.com/gh"}]}, "applications": [], "tags": ["a", "b"]},
        {"name": "L V", "emails": ["l@v.co"], "phones": [{"value": "+1"}], "stage": "x", "applications": [], "links": ["https://linkedin.com/in/lv"], "location": "Oslo"},
        {"Worker": {"Personal_Data": {"Name_Data": {"First_Name": "W", "Last_Name": "D"}, "Contact_Data": {"Email_Address": "w@d.co", "Address_Data": {"City": "Rome", "Country": "IT"}}}}},
        {"contact": {"email": "x@y.co", "mobile": "123"}, "name": "Gen Eric", "skills": ["p", "q; r"], "yoe": 4, "odd": 1},
    ]
    v = mapping.map_vendor_json(spark.createDataFrame([(i, str(i), json.dumps(x)) for i, x in enumerate(docs)], "ord long, record_id string, raw_fields string")).orderBy("ord").collect()
    assert [x.full_name for x in v] == ["G H", "L V", "W D", "Gen Eric"] and [x.emails for x in v] == [["g@h.co"], ["l@v.co"], ["w@d.co"], ["x@y.co"]]
    assert v[0].skills == ["a", "b"] and v[0].github_url == "https://github.com/gh" and v[1].linkedin_url.endswith("/lv") and v[2].location == "Rome, IT"
    assert v[3].skills == ["p", "q", "r"] and v[3].years_of_experience == 4.0 and v[3].phones == ["123"] and v[3].unknown_fields == ["odd"]


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfName; Email ;\nAda;a@b.co;x\n;;\nBob;;\n")
    t = files.read_delimited(spark, str(tmp_path / "a.csv"))
    assert t.columns == ["Name", "Email", "col_2", "ord"] and t.count() == 2
    assert files.sniff_delimiter("a\tb\nc\td") == "\t" and files.sniff_delimiter("abc") == "," and files.sniff_encoding("é".encode("latin-1")) == "latin-1"
    (tmp_path / "b.csv").write_text("1,2\n3,4\n")
    assert files.read_delimited(spark, str(tmp_path / "b.csv"), header=False).columns[:2] == ["col_0", "col_1"]
    (tmp_path / "c.json").write_text('[{"a": 1}, 2]')
    (tmp_path / "d.jsonl").write_text('{"a": 1}\n\n{"a": \n{"b": 2}\n')
    (tmp_path / "e.json").write_text('{"candidates": [{"a": 1}, {"a": 2}]}')
    raw = lambda n, **k: [json.loads(r.raw_fields) for r in files.read_json(spark, str(tmp_path / n), **k).orderBy("ord").collect()]
    assert raw("c.json") == [{"a": 1}, {"_value": "2"}] and raw("d.jsonl", lines=True) == [{"a": 1}, {"b": 2}]
    assert raw("e.json") == [{"candidates": [{"a": 1}, {"a": 2}]}] and raw("e.json", records_key="candidates") == [{"a": 1}, {"a": 2}]
    assert files.read(spark, str(tmp_path / "a.csv")).count() == 2
    with pytest.raises(ValueError):
        files.read(spark, "x.zzz")
    (tmp_path / "p.pdf").write_bytes(b"%PDF-1.4 broken")
    (tmp_path / "q.pdf").write_bytes(b"no")
    assert [r.extraction_method for r in files.read_pdf(spark, str(tmp_path / "*.pdf")).collect()] == ["failed"]
    repos = spark.createDataFrame([("a", "Go", 2, 1, ["x"]), ("a", "Go", 3, 0, ["y", "x"]), ("a", None, 0, 0, None), ("b", "C", 0, 0, [])], "login string, language string, stars int, forks int, topics array<string>")
    s = {r.login: r for r in files.profile_stats(repos).collect()}
    assert (s["a"].total_stars, s["a"].topics, s["a"].top_language, s["a"].n_repos) == (5, ["x", "y"], "Go", 3)
    flagged = files.flag_duplicates(t.unionByName(t.withColumn("ord", F.col("ord") + 100)), ["Name", "Email"])
    assert sum(r.duplicate_row for r in flagged.collect()) == 2


def test_cli(spark, tmp_path, capsys):
    from recfuse.cli import main

    f = tmp_path / "p.csv"
    f.write_text(CSV + "Ada,Byron,ada@x.org,+14155550100,,,Acme,Engineer,Python,Pune,5,\n")
    out, report = tmp_path / "o.json", tmp_path / "r.json"
    assert main([]) == 2
    assert main(["--csv", str(f), "--csv", str(tmp_path / "missing.csv"), "--output", str(out), "--report", str(report), "--format", "pretty"]) == 0
    docs = json.loads(out.read_text())
    assert len(docs) == 1 and docs[0]["full_name"] == "Ada Byron" and json.loads(report.read_text())["statistics"]["total"] == 1
