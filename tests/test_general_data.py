import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tables import build, null_rows, with_clashes

from recfuse.operators.nested import index_batch, is_whole_json, nested_elements, payload_elements
from recfuse.operators.packed import explode_packed

PACKED = [
    ('a, B;c | d / e', ["a", "B", "c", "d", "e"]),
    ('"x, y", TCP/IP and R&D', ["x, y", "TCP/IP", "R&D"]),
    ("1) one\n2) two", ["one", "two"]),
    ("1) one 2) two", ["one", "two"]),
    ("['a, b', 'c \"d\" e']", ["a, b", 'c "d" e']),
    ('["so-called \\"soft\\" skills", "q"]', ['so-called "soft" skills', "q"]),
    ('"so-called ""soft"" skills"; z', ['so-called "soft" skills', "z"]),
    ("Ternix (3 yrs, daily), b", ["Ternix (3 yrs, daily)", "b"]),
    ("• a • b\tc · d", ["a", "b", "c", "d"]),
    (",,a,, ,b, ,", ["a", "b"]),
    ("x, and y", ["x", "y"]),
    ("Children's books, a", ["Children's books", "a"]),
    ("a & b", ["a", "b"]),
]


def test_packed_values(spark):
    rows = [(i, s) for i, (s, _) in enumerate(PACKED)] + [(100 + i, s) for i, s in enumerate([None, "", " ", "n/a", "-", "[]", ",;|"])]
    got = {}
    for r in explode_packed(spark.createDataFrame(rows, "row_id long, skills string"), "row_id", "skills", "skill").collect():
        got.setdefault(r.row_id, {})[r.pos] = r.skill
    for i, (s, want) in enumerate(PACKED):
        assert [got[i][p] for p in range(len(want))] == want and len(got[i]) == len(want), s
    assert not any(k >= 100 for k in got)


def test_packed_hard_tables(spark):
    assert explode_packed(build(spark, "recruiter_sample", []), "row_id", "skills").count() == 0
    assert explode_packed(null_rows(spark, "recruiter_sample"), "row_id", "skills").count() == 0
    one = build(spark, "recruiter_sample", [{"row_id": 1, "skills": "a;b"}] * 2)
    assert explode_packed(with_clashes(one), "row_id", "skills").count() == 4
    long = build(spark, "recruiter_sample", [{"row_id": 1, "skills": ", ".join(f's{i} "q,{i}"' for i in range(3000))}])
    assert explode_packed(long, "row_id", "skills").count() == 3000


def _rebuild(cols):
    values = [None] * len(cols["node_id"])
    for i, kind in enumerate(cols["kind"]):
        t = cols["text"][i]
        values[i] = {} if kind == "object" else [] if kind == "array" else None if kind == "null" else t if kind == "string" else json.loads(t)
        p = cols["parent_id"][i]
        if p >= 0:
            if isinstance(values[p], dict):
                values[p][cols["key"][i]] = values[i]
            else:
                assert len(values[p]) == cols["pos"][i]
                values[p].append(values[i])
    return values[0]


_json = st.recursive(
    st.none() | st.booleans() | st.integers(-(10**6), 10**6) | st.text(max_size=8), lambda c: st.lists(c, max_size=4) | st.dictionaries(st.text(max_size=5), c, max_size=4), max_leaves=20
)


@settings(max_examples=150, deadline=None)
@given(st.lists(_json, min_size=1, max_size=5), st.sampled_from([None, 1]), st.booleans())
def test_index_round_trip(docs, indent, ascii_):
    texts = [json.dumps(d, indent=indent, ensure_ascii=ascii_) for d in docs]
    doc, cols = index_batch(texts)
    doc = np.array(doc)
    for i, d in enumerate(docs):
        lo, hi = np.searchsorted(doc, [i, i + 1])
        assert _rebuild({k: v[lo:hi] for k, v in cols.items()}) == d


@pytest.mark.parametrize("text,whole", [("{}", True), (' [1, "a"] ', True), ("", False), (None, False), ('{"a": 1', False), ("NaN", False), ("null", True)])
def test_whole_json(text, whole):
    assert is_whole_json(text) is whole


def test_payload_elements(spark):
    job = {"company": "A", "title": None}
    payloads = [
        {"candidate": {"name": "x", "employments": [job, None, {"company": " "}]}, "applications": []},
        {"candidates": [None, {"name": "y", "experience": {"items": [None, job], "total": 2}}, {"name": " "}]},
        [{"name": "z", "experience": json.dumps([job, job])}, {"name": "w", "experience": {"0": job, "2": job}}],
        {"Worker": {"Personal_Data": {"name": "v", "experience": job}}},
        {"applications": [], "stage": "lead", "data": {"name": "u", "work_history": ""}},
        {"name": "t", "experience": {}},
        {},
        [],
        None,
    ]
    rows = [{"row_id": i, "raw_fields": json.dumps(p)} for i, p in enumerate(payloads)] + [{"row_id": 90, "raw_fields": '{"name": "cut'}, {"row_id": 91}]
    got = {tuple(r) for r in payload_elements(build(spark, "raw_record", rows)).collect()}
    assert got == {
        (0, "candidate", 0, -1), (0, "experience", 0, 0), (1, "candidate", 1, -1), (1, "experience", 1, 1), (2, "candidate", 0, -1), (2, "experience", 0, 0),
        (2, "experience", 0, 1), (2, "candidate", 1, -1), (2, "experience", 1, 0), (2, "experience", 1, 2), (3, "candidate", 0, -1), (3, "experience", 0, 0),
        (4, "candidate", 0, -1), (5, "candidate", 0, -1),
    }


def test_nested_hard_tables(spark):
    names = ("ats_sample", "output_ats_export", "raw_record")
    for make in (lambda t: build(spark, t, []), lambda t: null_rows(spark, t), lambda t: with_clashes(null_rows(spark, t))):
        assert nested_elements(*map(make, names)).count() == 0
    blank = {"company": " ", "title": "", "start_date": None, "end_date": "\t", "description": None, "location": None}
    full = {**blank, "title": "x"}
    ats = build(spark, "ats_sample", [{"row_id": 1, "current_position": blank, "experience": [None, blank, full]}])
    export = build(spark, "output_ats_export", [{"row_id": 2, "skills": [None, {"name": "a", "sources": [None, "", "csv"]}]}])
    got = {tuple(r) for r in nested_elements(ats, export, build(spark, "raw_record", [])).collect()}
    assert got == {("ats_sample", 1, "experience", 2, -1), ("output_ats_export", 2, "source", 1, 2)}


def test_deep_and_long_payload(spark):
    deep = "[" * 300 + "1" + "]" * 300
    wide = json.dumps([{"name": f"n{i}", "experience": [{"title": "t"}] * (i % 3)} for i in range(4000)])
    rows = [{"row_id": 1, "raw_fields": deep}, {"row_id": 2, "raw_fields": wide}]
    got = payload_elements(build(spark, "raw_record", rows)).groupBy("node").count().collect()
    assert {r.node: r["count"] for r in got} == {"candidate": 4000, "experience": sum(i % 3 for i in range(4000))}


def test_splitting_matches_brute_force(spark):
    rng = random.Random(3)
    words = ["alpha", "TCP/IP", "R&D", "beta gamma", "delta.js"]
    rows, want = [], {}
    for i in range(200):
        vals = [rng.choice(words) for _ in range(rng.randint(1, 6))]
        rows.append((i, rng.choice([", ", ";", " | ", "\n", " / ", "\t"]).join(vals)))
        want[i] = vals
    df = explode_packed(spark.createDataFrame(rows, "row_id long, skills string"), "row_id", "skills")
    got = {r.row_id: [x.value for x in sorted(r.v, key=lambda x: x.pos)] for r in df.groupBy("row_id").agg(F.collect_list(F.struct("pos", "value")).alias("v")).collect()}
    assert got == want


def test_nan_is_no_number(spark):
    from recfuse.operators import fusion, quality, validation

    nan = float("nan")
    m = spark.createDataFrame([(1, nan), (1, 7.0), (2, nan), (3, None)], "group_id long, years_of_experience double")
    assert {r.group_id: r.years_of_experience for r in fusion.largest(m, "years_of_experience").collect()} == {1: 7.0, 2: None, 3: None}
    p = spark.createDataFrame([(nan,), (61.0,), (-1.0,)], "years_experience double")
    rules = [[i.rule for i in r.issues] for r in p.select(validation.issues_of(p).alias("issues")).collect()]
    assert rules == [[], ["years_experience_range"], ["years_experience_range"]]
    none = F.array().cast("array<struct<start_date:string,end_date:string>>")
    assert [r.n for r in p.select(quality.violations(none, none, F.col("years_experience")).alias("n")).collect()] == [0, 1, 1]


def test_list_defaults(spark):
    from recfuse.operators.projection import Projection, project

    t = spark.createDataFrame([(1, [], None), (2, ["a"], {"x": "y"}), (3, None, {})], "row_id long, emails array<string>, m map<string,string>")
    spec = Projection.of({"fields": [{"source": "row_id"}, {"source": "emails", "default": ["none"]}, {"source": "m", "default": {"k": "v"}}]})
    got = {r.row_id: (r.emails, r.m) for r in project(t, spec).collect()}
    assert got == {1: (["none"], {"k": "v"}), 2: (["a"], {"x": "y"}), 3: (["none"], {"k": "v"})}
