import pytest
from pyspark.sql import functions as F

from recfuse.functions import normalize as N
from recfuse.functions import text as X
from recfuse.functions.distance import jaro_winkler, lcs_ratio, osa, token_sort_ratio


def apply(spark, fn, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", fn(F.col("v")).alias("o"))
    return [r.o for r in sorted(df.collect(), key=lambda r: r.i)]


CASES = {
    "email": (N.email, {" A@B.co ": "a@b.co", "x@y": None, "": None, None: None, "a b@c.de": None}),
    "name": (
        N.name,
        {"mary-jane o'neil": "Mary-Jane O'neil", "ludwig VAN beethoven": "Ludwig van Beethoven", "smith, JR": "Smith Jr", "j. r. mcdonald": "J. R. McDonald",
         "MACDONALD iii": "MacDonald III", "  ann   lee ": "Ann Lee", "de la cruz": "De la Cruz", "": "", None: None},
    ),
    "company": (
        N.company,
        {"Tesco": "Tes", "@acme Corp.": "Acme", "Foo Bar Pvt Ltd": "Foo Bar", "Zinc": "Z", "Acme, Inc.": "Acme", "IBM": "Ibm", "Deutsche Bank AG": "Deutsche Bank", None: None},
    ),
    "bounded company": (lambda c: N.company(c, word_boundary=True), {"Tesco": "Tesco", "Zinc Ltd": "Zinc"}),
    "date": (
        N.date,
        {"Present": None, "2020": "2020", "3/2021": "2021-03", "2021/13": "2021/13", "Jan 2024": "2024-01", "1 Jan 2024": "2024-01", "15 March 2019": "2019-03-15",
         "March 15, 2019": "2019-03-15", "2024-13": "2024-13", "2024-02-29": "2024-02-29", "03/25/2020": "2020-03-25", "25/03/2020": "2020-03-25", "foo": "foo", "": "", None: None},
    ),
    "url": (
        N.url,
        {"github.com/Foo/bar": "https://github.com/Foo", "http://www.linkedin.com/in/Ab-C/": "https://linkedin.com/in/ab-c", "HTTP://Ex.com/a/?utm_source=x&b=1": "https://ex.com/a?b=1",
         "ex.com": "https://ex.com/", "//ex.com/p/": "https://ex.com/p", "": "", None: None},
    ),
    "country": (N.country_code, {"usa": "US", "xx": "XX", "Germany": "DE", "Nowhere": None, "GBR": "GB", " uk ": "GB", None: None}),
    "phone": (N.phone, {"+1 (415) 555-0100": "+14155550100", "N/A": "N/A", "0049 30 1234567": "+49301234567", "030 123": "030 123", None: None}),
    "login": (N.github_login, {"https://github.com/ab-c/x": "ab-c", "foo": None}),
    "handle": (N.linkedin_handle, {"https://linkedin.com/in/A.b?x": "a.b", "foo": None}),
    "url kind": (N.url_kind, {"https://github.com/x": "github", "linkedin.com/in/y": "linkedin", "z.org": "website", " ": None}),
    "skill key": (N.skill_key, {" C++  (11)!": "c++ 11", "Node.JS": "node.js"}),
    "title": (X.title_case, {"o'neil 3d-foo": "O'Neil 3D-Foo"}),
    "key": (X.key_text, {" Ünï, Co! ": "ünï co"}),
    "key phone": (X.key_phone, {"+1 (2) 3": "+123", "N/A": "n/a"}),
    "key url": (X.key_url, {"HTTP://A.b//": "http://a.b"}),
    "nfc": (X.nfc, {"é": "é", "abc": "abc"}),
    "ascii": (X.ascii_fold, {"Ünï": "Uni", "abc": "abc"}),
}


@pytest.mark.parametrize("case", CASES)
def test_scalar(spark, case):
    fn, pairs = CASES[case]
    assert apply(spark, fn, list(pairs)) == list(pairs.values())


def test_region_phone(spark):
    assert apply(spark, lambda c: N.phone(c, F.lit("DE")), ["030 1234567", "+33 1 23456789"]) == ["+49301234567", "+33123456789"]
    assert apply(spark, N.region_of, ["Berlin, Germany", "Paris", None]) == ["DE", None, None]


def test_structures(spark):
    assert apply(spark, N.split_skills, ["a, B;a|c/ d\ne", "", None]) == [["a", "B", "c", "d", "e"], [], None]
    got = apply(spark, N.split_name, ["Doe, Jane", "Jane Q Doe", "Jane"])
    assert [(g.first_name, g.last_name) for g in got] == [("Jane", "Doe"), ("Jane", "Doe"), ("Jane", None)]
    loc = apply(spark, N.location, ["Berlin, Germany", "a, b, c, d", None])
    assert [(x.city, x.state, x.country, x.normalized) for x in loc] == [("Berlin", None, "DE", "Berlin, Germany"), ("a", "b", "c", "a, b, c"), (None, None, None, None)]
    res = apply(spark, N.date_result, ["2020", "x", "present"])
    assert [(r.confidence, r.changed) for r in res] == [(0.9, False), (0.0, False), (1.0, True)]


def test_distances():
    assert osa("abcd", "abdc", 2) == 1 and osa("abc", "abc", 1) == 0 and osa("abc", "xyz", 1) == 2 and osa("kitten", "sitting", 3) == 3
    assert osa("ab", "ba", 1) == 1 and osa("abcdef", "abdcfe", 2) == 2
    assert lcs_ratio("", "") == 1.0 and lcs_ratio("a", "") == 0.0 and abs(lcs_ratio("abcd", "abxd") - 0.75) < 1e-9
    assert token_sort_ratio("john smith", "smith john") == 1.0
    assert jaro_winkler("martha", "marhta") > 0.96 and jaro_winkler("a", "") == 0.0


def test_osa_against_plain_table():
    def plain(a, b):
        d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    import random

    rng = random.Random(1)
    for _ in range(3000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 7))) for _ in range(2))
        for limit in (1, 2, 3):
            assert osa(a, b, limit) == min(plain(a, b), limit + 1), (a, b, limit)
