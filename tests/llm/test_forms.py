"""Shortened forms and many sources, against brute force."""

import random

from recfuse.llm import survivor


def test_long_names_have_shortened_forms_too(spark):
    rng = random.Random(4)
    full = "Ana Maria Luisa Rosa Elena Sofia de Souza Prado"
    words = full.lower().split()
    rows = [(0, full), (0, "Ana Prado"), (0, "A Souza P"), (0, "Prado Ana"), (0, "Ana Braga"), (1, "Ana Prado"), (2, "Ana Maria Prado"), (2, "Ana P")]
    for _ in range(60):
        rows.append((0, " ".join(w[:1] if rng.random() < 0.4 else w for w in rng.sample(words, rng.randint(1, 5)))))

    def short(v, f):
        left = iter(f.lower().split())
        return v.lower() != f.lower() and (all(any(w in (x, x[0]) for x in left) for w in v.lower().split()) or len(v) > 2 and f.lower().startswith(v.lower()))

    rows = sorted(set(rows))
    got = survivor.shortened(spark.createDataFrame([(g, "full_name", v, "good") for g, v in rows], "group_id long, field string, value string, kind string"))
    want = {(g, v) for g, v in rows if any(g == h and short(v, f) for h, f in rows)}
    assert {(r.group_id, r.value) for r in got.collect()} == want
    assert {(0, "Ana Prado"), (0, "A Souza P"), (2, "Ana P")} <= want and not {(0, "Prado Ana"), (1, "Ana Prado")} & want


def test_many_sources_are_judged_as_few(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(g, i, f"s{i}", "full_name", v, rng.choice(["good", "other"]) if v == "x" else "good") for g in range(40) for i in range(5) for v in [rng.choice("abx" if i else "ab")]]
    claims = spark.createDataFrame(rows, "group_id long, row_id long, source string, field string, value string, kind string")
    judged = lambda: {(r.group_id, r.value, r.kind): round(r.truth, 6) for r in survivor.judge(claims).collect()}
    few = judged()
    monkeypatch.setattr(survivor, "MAX_SOURCES", 2)
    assert judged() == few
