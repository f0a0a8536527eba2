import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tables import build, null_rows, with_clashes

from recfuse.llm import langid, packing, pii, tokens

DOCS = [
    (1, "Hello  world, it's 3.5°C\n\n <|endoftext|> naïve 😀 "), (2, ""), (3, None), (4, " "), (5, " \x1c á"), (6, "word " * 50_000), (7, "Hello  world"), (8, "a" * 20_000),
    (9, "Привет, мир! 12345678901234567890"), (9, "twice"),
]


def test_token_ids_match_the_library(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, list(r.ids)) for r in tokens.encode_corpus(docs).collect())
    assert got == sorted((i, t.encode(x, add_special_tokens=False).ids if x else []) for i, x in DOCS)
    back = tokens.decode_corpus(tokens.encode_corpus(docs)).collect()
    assert sorted(r.decoded for r in back) == sorted(x or "" for _, x in DOCS)


def test_tokens_hard_tables(spark):
    assert tokens.encode_corpus(build(spark, "documents", [])).count() == 0
    assert [list(r.ids) for r in tokens.encode_corpus(with_clashes(null_rows(spark, "documents"))).collect()] == [[], [], []]


def test_blocks_keep_every_word(spark, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_CHARS", 40)
    docs = [(i, f"word{i % 7} and tail {i}") for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(2)
    back = {r.doc_id: r.decoded for r in tokens.decode_corpus(tokens.encode_corpus(df)).collect()}
    assert back == dict(docs)


def test_fullest_against_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        room = rng.randint(1, 40)
        counts = {rng.randint(1, 25): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
        best = {0}
        for n, c in counts.items():
            best |= {b + n * k for b in best for k in range(c + 1) if b + n * k <= room}
        got = packing.fullest(room, sorted(counts, reverse=True), counts)
        assert sum(n * k for n, k in got.items()) == max(best) and all(k <= counts[n] for n, k in got.items())


def test_minimum_bin_slack_uses_everything():
    rng = random.Random(4)
    for cap in (10, 64, 257):
        hist = {n: rng.randint(0, 9) for n in range(1, cap + 1)}
        left = dict(hist)
        for pattern, times in packing.minimum_bin_slack(cap, hist):
            assert sum(n * k for n, k in pattern.items()) <= cap
            for n, k in pattern.items():
                left[n] -= k * times
        assert set(left.values()) <= {0}


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS_PER_SALT", 7)
    rng = random.Random(5)
    sizes = [rng.choice([0, 5, 5, 5, 17, 31, 64, 100, 129, 400, rng.randint(1, 90)]) for _ in range(600)]
    items = spark.createDataFrame([*enumerate(sizes), (900, None), (901, 5), (901, 5)], "doc_id long, size long")
    caps = build(spark, "pack_capacity", [{"capacity_id": 1, "capacity_tokens": 64}, {"capacity_id": 2, "capacity_tokens": 128}, {"capacity_id": 3}, {"capacity_id": 4, "capacity_tokens": 0}])
    rows = packing.pack(items, caps).collect()
    for cid, cap in ((1, 64), (2, 128)):
        own = [r for r in rows if r.capacity_id == cid]
        fill, docs = {}, {}
        for r in own:
            fill[r.bin_no] = fill.get(r.bin_no, 0) + r.size
            docs.setdefault(r.doc_id, []).append(r)
        assert max(fill.values()) <= cap and set(fill) == set(range(max(fill) + 1))
        for i, s in enumerate(sizes):
            assert sum(r.size for r in docs[i]) == s and len(docs[i]) == max(1, -(-s // cap))
        assert [r.size for r in docs[900]] == [0] and len(docs[901]) == 2
        assert len(fill) <= 1.02 * -(-sum(fill.values()) // cap) + 1
    assert {r.capacity_id for r in rows} == {1, 2}
    assert packing.pack(items.limit(0), caps).count() == 0 and packing.pack(items, caps.limit(0)).count() == 0
    report = {r.capacity_id: r for r in packing.fill_report(packing.pack(items, caps), caps).collect()}
    assert report[1].used > 0.95


SENTENCES = {
    "en": ["The meeting was moved to the next week because nobody had time.", "We are looking for somebody who can take over the work.", "She told me that the train would be late again."],
    "de": ["Die Besprechung wurde verschoben, weil niemand Zeit hatte.", "Wir suchen jemanden, der die Arbeit übernehmen kann.", "Sie sagte mir, dass der Zug wieder zu spät kommt."],
    "fr": ["La réunion a été déplacée parce que personne n'avait le temps.", "Nous cherchons quelqu'un qui puisse reprendre le travail.", "Elle m'a dit que le train serait encore en retard."],
    "es": ["La reunión se aplazó porque nadie tenía tiempo libre.", "Buscamos a alguien que pueda hacerse cargo del trabajo.", "Ella me dijo que el tren llegaría tarde otra vez."],
}


def corpus(n=240, seed=0):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        lang = rng.choice(list(SENTENCES))
        words = " ".join(rng.sample(SENTENCES[lang], 3))
        out.append((f"{words} {rng.randint(1, 99)}.", lang if rng.random() > 0.1 else rng.choice(list(SENTENCES))))
    return out


@pytest.fixture(scope="module")
def model():
    return langid.fit(corpus(), langid.TrainConfig(bits=14, epochs=6))


def test_languages_held_out(model):
    for lang, s in SENTENCES.items():
        for x in s:
            assert model.segments(x)[0][1] == lang and model.segments(x.upper())[0][1] == lang
    mixed = f"{SENTENCES['en'][0]} {SENTENCES['de'][1]}\n> {SENTENCES['fr'][2]} {SENTENCES['fr'][0]}"
    got = model.segments(mixed)
    assert [(a, b) for a, b, _ in got] == [(0, "en"), (mixed.index("Wir"), "de"), (mixed.index("Elle"), "fr")]
    assert all(0 < c <= 1 for *_, c in got)
    for empty in ("", " ", "123 456", "...?!", "<|endoftext|>", "https://jobs.example/r?id=12", "★★★"):
        assert model.segments(empty) == []
    assert len(model.segments(" ".join(SENTENCES["es"]) * 500)) == 1


def test_document_segments(spark, model):
    rows = [
        {"doc_id": 1, "text": " ".join(SENTENCES["en"]), "lang": "en-GB"}, {"doc_id": 2, "text": " ".join(SENTENCES["de"]), "lang": "xx"},
        {"doc_id": 3, "text": " ".join(SENTENCES["fr"]), "lang": "English"}, {"doc_id": 4, "text": f"{SENTENCES['en'][0]} {SENTENCES['es'][1]}", "lang": "en"},
        {"doc_id": 5}, {"doc_id": 6, "text": " "}, {"doc_id": 7, "text": "12 34", "lang": "de"}, {"doc_id": 2, "text": " ".join(SENTENCES["de"])},
    ]
    df = with_clashes(build(spark, "documents", rows))
    got = sorted((r.doc_id, r.start_pos, r.lang) for r in langid.doubtful(langid.document_segments(df, model=model)).collect())
    assert got == [(2, 0, "de"), (2, 0, "de"), (3, 0, "fr"), (4, 0, "en"), (4, rows[3]["text"].index("Buscamos"), "es")]
    assert langid.document_segments(build(spark, "documents", [])).count() == 0 and langid.document_segments(null_rows(spark, "documents")).count() == 0


def test_label_notations(spark):
    labels = ["en", "EN", "en_US", "eng", "English", "Deutsch", "français", "pt-PT", "русский", "xx", "", None, "und", "-", " sv ", "es (MX)"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "i int, v string").select("i", langid.label_language(F.col("v")).alias("o"))
    assert [r.o for r in sorted(df.collect())] == ["en"] * 5 + ["de", "fr", "pt", "ru", None, None, None, None, None, "sv", "es"]


GIVEN, FAMILY = frozenset("oscar joy will robert freja bartek yusuf".split()), frozenset("vetizek lamarup pevikiber".split())
NOTES = [
    ("Spoke to Oscar Vetizek about the backend opening.", [("name", "Oscar Vetizek")]),
    ("Joy to work with, says the panel. Will call back next week.", []),
    ("Mail bounced (a.b@x.example), use c_d[at]y.example.", [("email", "a.b@x.example"), ("email", "c_d[at]y.example")]),
    ("courriel : f.g (at) inboxly dot example", [("email", "f.g (at) inboxly dot example")]),
    ("Prefers command-line tooling @ scale.", []),
    ("Call back on +46 35941 60711 after 3 pm.", [("phone", "+46 35941 60711")]),
    ("Emergency contact Bartek A. Pevikiber (3864442481).", [("name", "Bartek A. Pevikiber"), ("phone", "3864442481")]),
    ("Asked us to strike (799) 819-2618 from the file.", [("phone", "(799) 819-2618")]),
    ("try four four three nine two zero seven eight instead", [("phone", "four four three nine two zero seven eight")]),
    ("File id 1905445308, batch 20123. REQ-2014-80442 closed, invoice 2016/40824 paid", []),
    ("Social security no 683.949.805-81. Badge ZPFYM4387R, cleared for the secure floor.", [("id_number", "683.949.805-81"), ("id_number", "ZPFYM4387R")]),
    ("passport QQ 01 38 92 E checked on 2024-08-14", [("id_number", "QQ 01 38 92 E")]),
    ("Lives at 108 rue des Quarrys, 14000 Quenstad, willing to relocate.", [("address", "108 rue des Quarrys")]),
    ("Wohnhaft C/ Weaver 62, 2º A, 31001 Aldereira.", [("address", "C/ Weaver 62")]),
    ("Vive en Am Tanneryhof 175b, Rosgrad, tel. +351 32086 20438", [("address", "Am Tanneryhof 175b"), ("phone", "+351 32086 20438")]),
    ("Adresse : heron lane 41; courriel : k_f @ lettera.example", [("address", "heron lane 41"), ("email", "k_f @ lettera.example")]),
    ("Documents to be sent c/o Yusuf, H.No. 2-143/4, Harrow Nagar, Cormhaven 511122", [("name", "Yusuf"), ("address", "H.No. 2-143/4, Harrow Nagar")]),
    ("Referee is Dr. Lamarup, Freja, reachable at x@y.example.", [("name", "Lamarup, Freja"), ("email", "x@y.example")]),
    ("Ms robert lamarup from the payroll desk confirmed notice period.", [("name", "robert lamarup")]),
    ("Mark as hold until 23.9.2024. shift 8:30 to 15:45 is fine", []),
]


@pytest.fixture(scope="module")
def finder():
    return pii.fit([t for t, _ in NOTES] * 20, GIVEN, FAMILY)


@pytest.mark.parametrize("text,want", NOTES)
def test_mentions(finder, text, want):
    got = [(k, text[a:b]) for a, b, k, _ in finder.mentions(text)]
    assert [(k, w if k != "address" else w) for k, w in want] == [(k, g[: len(dict_w)] if k == "address" else g) for (k, g), (_, dict_w) in zip(got, want)] and len(got) == len(want)


def test_redaction_and_hard_tables(spark, finder):
    rows = [{"row_id": i, "notes": t} for i, (t, _) in enumerate(NOTES)] + [{"row_id": 90}, {"row_id": 91, "notes": ""}, {"row_id": 92, "notes": NOTES[0][0] * 300}]
    texts = pii.texts_of(with_clashes(build(spark, "recruiter_sample", rows)), null_rows(spark, "ats_sample"))
    out = {(r.tbl, r.row_id): r.redacted for r in pii.redact(texts, finder).collect()}
    assert out["recruiter_sample", 0] == "Spoke to [NAME] about the backend opening." and out["recruiter_sample", 90] is None and out["recruiter_sample", 91] == ""
    assert out["recruiter_sample", 1] == NOTES[1][0] and out["recruiter_sample", 92].count("[NAME]") == 300
    found = pii.find_mentions(texts, finder)
    assert found.where("row_id = 92").count() == 300 and found.where("row_id IN (90, 91) OR tbl = 'ats_sample'").count() == 0
    empty = [build(spark, t, []) for t in ("recruiter_sample", "ats_sample")]
    assert pii.find_mentions(pii.texts_of(*empty), pii.fit_on(*empty)).count() == 0


def test_reliabilities_recover_good_labelers():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.4
    votes = []
    for right, speaks in ((0.95, 0.9), (0.9, 0.6), (0.55, 0.8)):
        v = np.where(rng.random(4000) < right, np.where(truth, 1, -1), np.where(truth, -1, 1))
        votes.append(np.where(rng.random(4000) < speaks, v, 0))
    p, rates = pii.reliabilities(np.array(votes).T, 20)
    assert ((p > 0.5) == truth).mean() > 0.9
    assert rates[1, 0, 2] > rates[1, 2, 2]


def test_undecided_texts_are_rejected(model):
    import numpy as np

    blank = langid.Model(np.zeros_like(model.scores), np.zeros(len(langid.LANGUAGES)), 1.0, model.config)
    assert blank.segments("Tohle je věta v jazyce, který model nezná. A ještě jedna taková věta.") == []
    at, buckets = langid.features("𐐀𐐁𐐂 x", 14)
    assert 0 in at and buckets.size > 4  # letters beyond the basic plane are letters


UNSEEN = [
    ("Please ask for Ada Byron at the reception.", "name", "Ada Byron"), ("Send the contract to z9.y@quickmail.example please.", "email", "z9.y@quickmail.example"),
    ("Best reached on +44 20 123456 before noon.", "phone", "+44 20 123456"), ("Parcel goes to 12 Kestrel Street, Ulmpur.", "address", "12 Kestrel Street"), ("Shown at the gate: passport 123-45-6789.", "id_number", "123-45-6789"),
]


@pytest.mark.parametrize("text,kind,item", UNSEEN)
def test_sentences_that_no_code_knows(finder, text, kind, item):
    text = text.replace("Ada Byron", f"{sorted(GIVEN)[0].title()} {sorted(FAMILY)[0].title()}") if kind == "name" else text
    found = [(a, k) for a, _, k, _ in finder.mentions(text)]
    at = text.index(item) if kind != "name" else text.index(sorted(GIVEN)[0].title())
    assert (at, kind) in found


def test_context_is_learned():
    # The general labelers say nothing of the fourth number; what stands around the others does.
    texts = [f"Tel. +44 20 {k:06d} is out of order." for k in range(100000, 100040)] + [f"{k:09d} is out of order." for k in range(7100000, 7100040)]
    learned = pii.fit(texts * 3, frozenset(), frozenset())
    blind = pii.fit(texts * 3, frozenset(), frozenset(), pii.FitConfig(rounds=0))
    span = next(s for s in pii.candidates(texts[-1], frozenset(), frozenset()) if s.kind == "phone")
    assert learned.score(texts[-1], span) > blind.score(texts[-1], span)
