"""Normalisers of e-mail, telephone, date, name, company, country, location, link and skill values.

Each takes a string column and returns an expression; ``*_result`` forms return the struct
``(original, normalized, method, confidence, changed)`` that provenance is made of. All are built-in
expressions and stay inside whole-stage code generation, but for Unicode composition of values that
need it.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from recfuse.functions.text import capitalize, collapse, nfc, null_blank, title_case

EMAIL_PATTERN = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"

#: Words that stand for "until now". Fixed values.
PRESENT_WORDS = ("present", "current", "now", "ongoing", "today", "till date", "till now", "to date", "to present", "–", "—", "-")

#: Parts of names that keep or change their case. Fixed values.
NAME_SUFFIXES = ("jr", "jr.", "sr", "sr.", "ii", "iii", "iv", "v", "esq", "esq.", "phd", "ph.d", "ph.d.", "md", "m.d.", "dds", "jd", "j.d.")
NAME_PARTICLES = (
    "de", "del", "della", "delle", "di", "du", "da", "das", "dos", "von", "van", "van den", "van der", "ten", "ter", "af", "av",
    "zu", "zum", "zur", "le", "la", "les", "el", "al", "bin", "binti", "ap", "ab", "ferch", "nic", "uí", "ui",
)

#: Legal forms at the end of company names. Fixed values.
LEGAL_SUFFIXES = (
    "private limited", r"pvt\.?\s*ltd", r"l\.l\.c", r"l\.l\.p", r"p\.l\.c", r"a\.g", r"s\.a\.s", r"s\.a", r"b\.v", r"n\.v", "llc", "llp", "plc",
    "incorporated", "corporation", "limited", "company", "inc", "corp", "ltd", "gmbh", "ag", "co",
)

#: Query parameters that only track. Fixed values.
TRACKING_PARAMETERS = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "utm_source_platform", "ref", "referer", "source",
    "campaign", "fbclid", "gclid", "dclid", "mc_cid", "mc_eid", "_hsenc", "_hsmi", "mkt_tok", "trk", "sc_channel", "sc_campaign", "sc_outcome",
)

#: Country names and their ISO 3166-1 codes. Fixed values; any two letters are a code by themselves.
COUNTRY_NAMES = {
    "usa": "US", "united states": "US", "united states of america": "US", "u.s.": "US", "u.s.a.": "US",
    "uk": "GB", "united kingdom": "GB", "great britain": "GB", "england": "GB", "britain": "GB",
    "india": "IN", "republic of india": "IN", "bharat": "IN", "china": "CN", "people's republic of china": "CN", "prc": "CN",
    "russia": "RU", "russian federation": "RU", "south korea": "KR", "korea": "KR", "republic of korea": "KR", "north korea": "KP",
    "uae": "AE", "united arab emirates": "AE", "singapore": "SG", "hong kong": "HK", "taiwan": "TW", "vietnam": "VN", "viet nam": "VN",
    "iran": "IR", "south africa": "ZA", "new zealand": "NZ", "australia": "AU", "canada": "CA", "germany": "DE", "france": "FR", "japan": "JP",
    "brazil": "BR", "brasil": "BR", "mexico": "MX", "netherlands": "NL", "holland": "NL", "sweden": "SE", "norway": "NO", "finland": "FI",
    "denmark": "DK", "italy": "IT", "spain": "ES", "portugal": "PT", "poland": "PL", "switzerland": "CH", "belgium": "BE", "austria": "AT",
    "ireland": "IE", "israel": "IL", "pakistan": "PK", "bangladesh": "BD", "sri lanka": "LK", "nepal": "NP", "malaysia": "MY", "indonesia": "ID",
    "philippines": "PH", "thailand": "TH", "nigeria": "NG", "egypt": "EG", "kenya": "KE", "ghana": "GH", "argentina": "AR", "colombia": "CO",
    "chile": "CL", "peru": "PE",
    # Three-letter codes of the same countries.
    "gbr": "GB", "ind": "IN", "chn": "CN", "rus": "RU", "kor": "KR", "prk": "KP", "are": "AE", "sgp": "SG", "hkg": "HK", "twn": "TW", "vnm": "VN",
    "irn": "IR", "zaf": "ZA", "nzl": "NZ", "aus": "AU", "can": "CA", "deu": "DE", "fra": "FR", "jpn": "JP", "bra": "BR", "mex": "MX", "nld": "NL",
    "swe": "SE", "nor": "NO", "fin": "FI", "dnk": "DK", "ita": "IT", "esp": "ES", "prt": "PT", "pol": "PL", "che": "CH", "bel": "BE", "aut": "AT",
    "irl": "IE", "isr": "IL",
}

#: Calling codes by country. Fixed values.
CALLING_CODES = {
    "US": "1", "CA": "1", "RU": "7", "EG": "20", "ZA": "27", "NL": "31", "BE": "32", "FR": "33", "ES": "34", "IT": "39", "CH": "41", "AT": "43",
    "GB": "44", "DK": "45", "SE": "46", "NO": "47", "PL": "48", "DE": "49", "PE": "51", "MX": "52", "AR": "54", "BR": "55", "CL": "56", "CO": "57",
    "MY": "60", "AU": "61", "ID": "62", "PH": "63", "NZ": "64", "SG": "65", "TH": "66", "JP": "81", "KR": "82", "VN": "84", "CN": "86", "IN": "91",
    "PK": "92", "LK": "94", "IR": "98", "GH": "233", "NG": "234", "KE": "254", "PT": "351", "IE": "353", "FI": "358", "HK": "852", "BD": "880",
    "TW": "886", "AE": "971", "IL": "972", "NP": "977", "KP": "850",
}


def real(c: Column) -> Column:
    """A number, or null for NaN, which would be the largest of all."""
    return F.when(~F.isnan(c), c)


def literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(sorted(values.items()))])


def result(original: Column, normalized: Column, method: str, confidence: Column) -> Column:
    """Normalisation result; ``changed`` compares null-safely."""
    return F.struct(
        original.alias("original"), normalized.alias("normalized"), F.lit(method).alias("method"),
        confidence.cast("double").alias("confidence"), (~normalized.eqNullSafe(original)).alias("changed"),
    )


def email(c: Column) -> Column:
    """Lower-cased address, or null if it is no valid one."""
    e = F.lower(F.trim(c))
    return F.when(e.rlike(EMAIL_PATTERN), e)


def email_result(c: Column) -> Column:
    ok = email(c)
    return result(c, ok, "email_lowercase", F.when(ok.isNotNull(), 1.0).otherwise(0.0))


def emails(c: Column) -> Column:
    """Valid addresses of an array, first occurrences in order."""
    return F.array_distinct(F.filter(F.transform(c, email), lambda e: e.isNotNull()))


def phone(c: Column, region: Column | None = None) -> Column:
    """``+`` and digits if the number is international or gets the calling code of ``region``; else as typed."""
    return phone_result(c, region)["normalized"]


def phone_result(c: Column, region: Column | None = None) -> Column:
    kept = F.regexp_replace(F.regexp_replace(c, r"(?i)^\s*tel:", ""), r"[^\d+\s\-().xX#,]", "")
    bare = F.regexp_replace(F.regexp_replace(kept, r"(?i)\s*(?:x|#|,).*$", ""), r"\(0\)", "")
    dialled = F.regexp_replace(F.regexp_replace(bare, r"[^\d+]", ""), r"^00", "+")
    codes = "|".join(sorted(set(CALLING_CODES.values()), key=lambda k: (-len(k), k)))
    international = dialled.rlike(rf"^\+(?:{codes})\d{{6,12}}$")
    out = F.when(international, dialled)
    if region is not None:
        code = F.element_at(literal_map(CALLING_CODES), F.upper(region))
        national = F.regexp_replace(dialled, r"^0+", "")
        local = F.concat(F.lit("+"), code, national)
        out = out.when(code.isNotNull() & ~dialled.startswith("+") & national.rlike(r"^\d{6,12}$"), local)
    return result(c, F.coalesce(out, c), "phone_e164", F.when(out.isNotNull(), 1.0).otherwise(0.0))


_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def date_result(c: Column) -> Column:
    """Date of the precision that is given: ``YYYY``, ``YYYY-MM`` or ``YYYY-MM-DD``; null for "until now".

    Day numbers of 1 give way to the month, a year is needed, and a text that is no date stays as it is.
    """
    s = F.trim(c)
    low = F.lower(s)
    month_of = F.element_at(literal_map({m: f"{i:02d}" for i, m in enumerate(_MONTHS, 1)}), F.substring(F.regexp_extract(low, r"([a-z]{3,9})", 1), 1, 3))
    named = low.rlike(r"^(?:\d{1,2}(?:st|nd|rd|th)?\s+)?(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?,?\s+(?:\d{1,2}(?:st|nd|rd|th)?,?\s+)?\d{4}$")
    year4 = F.regexp_extract(low, r"(\d{4})$", 1)
    day_text = F.regexp_extract(low, r"(?:^|\s)(\d{1,2})(?:st|nd|rd|th)?,?\s", 1)
    day = day_text.try_cast("int")
    named_date = F.when(
        (day > 1) & (day <= 31), F.concat_ws("-", year4, month_of, F.lpad(day_text, 2, "0"))
    ).otherwise(F.concat_ws("-", year4, month_of))
    # Month, day, year with slashes or points; a first number above 12 is the day.
    a, b = (F.regexp_extract(s, r"^(\d{1,2})[/.\-](\d{1,2})[/.\-](\d{4})$", i).try_cast("int") for i in (1, 2))
    y3 = F.regexp_extract(s, r"^\d{1,2}[/.\-]\d{1,2}[/.\-](\d{4})$", 1)
    month3, day3 = F.when(a > 12, b).otherwise(a), F.when(a > 12, a).otherwise(b)
    three = s.rlike(r"^\d{1,2}[/.\-]\d{1,2}[/.\-]\d{4}$") & month3.between(1, 12) & day3.between(1, 31)
    pad = lambda n: F.lpad(n.cast("string"), 2, "0")
    three_date = F.when(day3 > 1, F.concat_ws("-", y3, pad(month3), pad(day3))).otherwise(F.concat_ws("-", y3, pad(month3)))
    slash = s.rlike(r"^(?:\d{1,2}/\d{4}|\d{4}/\d{1,2})$")
    sy = F.regexp_extract(s, r"(\d{4})", 1)
    sm = F.coalesce(F.nullif(F.regexp_extract(s, r"^(\d{1,2})/", 1), F.lit("")), F.regexp_extract(s, r"/(\d{1,2})$", 1))
    in_range = lambda y: y.try_cast("int").between(1900, 2100)
    slash_ok = slash & sm.try_cast("int").between(1, 12) & in_range(sy)
    normalized = (
        F.when(low.isin(*PRESENT_WORDS), F.lit(None).cast("string"))
        .when(s.rlike(r"^\d{4}$"), s)
        .when(slash_ok, F.concat_ws("-", sy, F.lpad(sm, 2, "0")))
        .when(s.rlike(r"^\d{4}-\d{2}(?:-\d{2})?$"), s)
        .when(named & in_range(year4), named_date)
        .when(three & in_range(y3), three_date)
        .otherwise(c)
    )
    confidence = (
        F.when(c.isNull() | (s == ""), 0.0)
        .when(low.isin(*PRESENT_WORDS), 1.0)
        .when(s.rlike(r"^\d{4}$"), 0.9)
        .when(slash_ok, 0.95)
        .when(s.rlike(r"^\d{4}-\d{2}(?:-\d{2})?$"), 1.0)
        .when((named & in_range(year4)) | (three & in_range(y3)), 0.85)
        .otherwise(0.0)
    )
    return result(c, normalized, "date_iso8601", confidence)


def date(c: Column) -> Column:
    return date_result(c)["normalized"]


def _name_word(w: Column, first: Column) -> Column:
    low = F.lower(w)
    plain = (
        F.when(w.rlike(r"(?i)^mc."), F.concat(F.lit("Mc"), F.upper(F.substring(w, 3, 1)), F.lower(F.substring(w, 4, 1 << 30))))
        .when(w.rlike(r"(?i)^mac[a-z]"), F.concat(F.lit("Mac"), F.upper(F.substring(w, 4, 1)), F.lower(F.substring(w, 5, 1 << 30))))
        .otherwise(capitalize(w))
    )
    return (
        F.when(low.isin("ii", "iii", "iv", "v"), F.upper(w))
        .when(low.isin(*NAME_SUFFIXES), title_case(w))
        .when(low.isin(*NAME_PARTICLES) & ~first, low)
        .when(w.rlike(r"^\p{L}\.?$"), F.upper(w))
        .otherwise(plain)
    )


def name(c: Column) -> Column:
    """Person name in its usual case: particles low, initials, Mc and Mac, suffixes and hyphens minded."""
    clean = collapse(nfc(c))
    suffix_pattern = r"(?i),\s*(jr\.?|sr\.?|ii|iii|iv|v|esq\.?|phd|md)$"
    suffix = F.regexp_extract(clean, suffix_pattern, 1)
    base = F.regexp_replace(clean, suffix_pattern, "")
    words = F.split(base, " ")

    def cased(w: Column, i: Column) -> Column:
        parts = F.split(w, r"[-‐‑‒–—]")
        joined = F.array_join(F.transform(parts, lambda p: _name_word(p, F.lit(True))), "-")
        return F.when(w.rlike(r"[-‐‑‒–—]") & ~w.rlike(r"(?i)^mc."), joined).otherwise(_name_word(w, i == 0))

    out = F.array_join(F.transform(words, cased), " ")
    return F.when(clean == "", c).otherwise(F.concat(out, F.when(suffix != "", F.concat(F.lit(" "), title_case(suffix))).otherwise("")))


def strip_legal(c: Column, word_boundary: bool = False, rounds: int = 4) -> Column:
    """Company name without trailing legal forms. Without ``word_boundary`` a form may end a longer word."""
    gap = r"(?:,?\s+|,)" if word_boundary else r",?\s*"
    pattern = rf"(?i)(?<=.){gap}(?:{'|'.join(LEGAL_SUFFIXES)})\.?\s*$"
    out = c
    for _ in range(rounds):
        out = F.regexp_replace(F.regexp_replace(out, pattern, ""), r"[,\s]+$", "")
    return out


def company(c: Column, word_boundary: bool = False) -> Column:
    """Company name without handle sign and legal forms, in title case."""
    clean = collapse(F.regexp_replace(F.trim(c), r"^@+", ""))
    stripped = strip_legal(clean, word_boundary)
    return title_case(F.when(stripped != "", stripped).otherwise(clean))


def country_code(c: Column) -> Column:
    """Two-letter code of a country name or code, or null."""
    t = F.trim(c)
    return F.coalesce(F.element_at(literal_map(COUNTRY_NAMES), F.lower(t)), F.when(t.rlike(r"^\p{L}{2}$"), F.upper(t)))


def location(c: Column) -> Column:
    """Struct ``(raw, city, state, country, normalized)`` of a comma-separated place of up to three parts."""
    parts = F.slice(F.filter(F.transform(F.split(c, ","), collapse), lambda p: p != ""), 1, 3)
    n = F.size(parts)
    last = F.element_at(parts, -1)
    country = F.when(n > 0, F.coalesce(country_code(last), last))
    return F.struct(
        c.alias("raw"),
        F.when(n > 0, parts[0]).alias("city"),
        F.when(n >= 3, F.get(parts, F.lit(1))).alias("state"),
        F.when(c.isNotNull(), country).alias("country"),
        F.when(n > 0, F.array_join(parts, ", ")).alias("normalized"),
    )


def region_of(c: Column) -> Column:
    """Country code that a place names, trying its parts from the last."""
    codes = F.transform(F.reverse(F.split(c, ",")), country_code)
    return F.get(F.filter(codes, lambda x: x.isNotNull()), F.lit(0))


_GITHUB = r"(?i)^(?:https?://)?(?:www\.)?github\.(?:com|example)/([a-zA-Z0-9\-]+)(?:[/?].*)?$"
_LINKEDIN = r"(?i)^(?:https?://)?(?:[a-z]{2}\.|www\.)?linkedin\.(?:com|example)/in/([a-zA-Z0-9\-_%.]+?)/?(?:[/?].*)?$"


def url(c: Column) -> Column:
    """Canonical link: https, host in lower case, no tracking parameters and no trailing slash; profiles in short form."""
    u = F.trim(c)
    site = lambda p: F.lower(F.regexp_extract(u, p, 1))
    whole = F.when(u.startswith("//"), F.concat(F.lit("https:"), u)).when(u.contains("://"), u).otherwise(F.concat(F.lit("https://"), u))
    scheme = F.regexp_replace(F.lower(F.regexp_extract(whole, r"^([^:]+)://", 1)), r"^http$", "https")
    host = F.lower(F.regexp_extract(whole, r"^[^:]+://([^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_extract(whole, r"^[^:]+://[^/?#]*([^?#]*)", 1), r"/+$", "")
    query = F.regexp_extract(whole, r"\?([^#]*)", 1)
    kept = F.filter(
        F.split(query, "&"), lambda kv: (kv != "") & ~F.lower(F.substring_index(kv, "=", 1)).isin(*TRACKING_PARAMETERS)
    )
    fragment = F.regexp_extract(whole, r"(#.*)$", 1)
    generic = F.concat(
        scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path),
        F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""), fragment,
    )
    return (
        F.when(c.isNull() | (u == ""), c)
        .when(u.rlike(_GITHUB), F.concat(F.lit("https://"), F.lower(F.regexp_extract(u, r"(?i)(github\.(?:com|example))", 1)), F.lit("/"), F.regexp_extract(u, _GITHUB, 1)))
        .when(u.rlike(_LINKEDIN), F.concat(F.lit("https://"), F.lower(F.regexp_extract(u, r"(?i)(linkedin\.(?:com|example))", 1)), F.lit("/in/"), site(_LINKEDIN)))
        .otherwise(generic)
    )


def url_kind(c: Column) -> Column:
    return F.when(c.rlike(r"(?i)github\.(?:com|example)"), "github").when(c.rlike(r"(?i)linkedin\.(?:com|example)"), "linkedin").when(
        null_blank(c).isNotNull(), "website"
    )


def github_login(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(?i)github\.(?:com|example)/([a-zA-Z0-9\-]+)", 1), F.lit(""))


def linkedin_handle(c: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(c, r"(?i)linkedin\.(?:com|example)/in/([a-zA-Z0-9\-_%.]+)", 1), F.lit("")))


def skill_key(c: Column) -> Column:
    """Lower-case skill without signs other than ``. # + - /``."""
    return collapse(F.regexp_replace(F.lower(nfc(c)), r"[^\p{L}\p{N}_\s.#+\-/]", ""))


def split_skills(c: Column) -> Column:
    """Skills of a packed string: split at the usual delimiters, blanks and later repetitions dropped."""
    parts = F.filter(F.transform(F.split(c, r"[,;|/•·\n\r]+"), lambda p: F.trim(p)), lambda p: p != "")
    low = F.transform(parts, lambda p: F.lower(p))
    return F.filter(parts, lambda p, i: F.array_position(low, F.lower(p)) == i + 1)


def split_name(c: Column) -> Column:
    """Struct ``(first_name, last_name)``; ``Last, First`` is swapped, a single word is the first name."""
    clean = collapse(c)
    comma = clean.contains(",")
    a, b = F.trim(F.substring_index(clean, ",", 1)), F.trim(F.regexp_replace(clean, r"^[^,]*,", ""))
    words = F.split(clean, " ")
    return F.struct(
        F.when(comma, b).otherwise(words[0]).alias("first_name"),
        F.when(comma, a).when(F.size(words) > 1, F.element_at(words, -1)).alias("last_name"),
    )


def year_month(c: Column) -> Column:
    """Struct ``(y, m)`` of a ``YYYY[-MM...]`` text, zeros for missing parts; a sort key."""
    return F.struct(
        F.coalesce(F.regexp_extract(c, r"^(\d{4})", 1).try_cast("int"), F.lit(0)).alias("y"),
        F.coalesce(F.regexp_extract(c, r"^\d{4}-(\d{2})", 1).try_cast("int"), F.lit(0)).alias("m"),
    )


def backwards(e: Column) -> Column:
    """Whether an entry with both dates known ends before it begins."""
    a, b = year_month(e["start_date"]), year_month(e["end_date"])
    return (a["y"] > 0) & (b["y"] > 0) & (a > b)
