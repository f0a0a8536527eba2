"""Personal information in free text, found by weak supervision and replaced by typed placeholders.

Candidate spans come from generous patterns. Labelers (the shape of a span, gazetteers of given and
family names, words that name a kind, the place in the sentence) vote for or against each candidate, or
abstain. For every kind, expectation-maximisation estimates how reliable each labeler is and how probable
each candidate; what stands around the surer candidates is learned and votes too. With the resulting
probabilities as soft labels a logistic span classifier over hashed features is trained, which decides. Fitting sees a bounded sample of texts (``FitConfig.texts``) and bounded gazetteers
(``FitConfig.names``); classification reads every text whole, as one narrow stage.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recfuse.session import spread

KINDS = ("email", "phone", "id_number", "address", "name")


@dataclass(frozen=True)
class FitConfig:
    """``texts`` bounds the sample that is fitted on, ``names`` the entries of each gazetteer."""

    texts: int = 6000
    names: int = 20_000
    bits: int = 16
    epochs: int = 6
    rate: float = 0.5
    decay: float = 1e-6
    iterations: int = 15
    rounds: int = 2  # in which the context is learned and votes
    seed: int = 11


@dataclass(frozen=True)
class Span:
    start: int
    end: int
    kind: str
    shape: str


# ---------------------------------------------------------------- candidates

_AT = r"(?:\s?@\s?|\s?\[\s?at\s?\]\s?|\s?\(\s?at\s?\)\s?)"
_DOT = r"(?:\.|\s?\[\s?dot\s?\]\s?|\s?\(\s?dot\s?\)\s?|\sdot\s)"
_EMAIL = re.compile(rf"(?<![\w.+-])[\w][\w.+'-]*{_AT}[\w-]+(?:{_DOT}[\w-]+)*{_DOT}[A-Za-z]{{2,}}\b", re.I)

_DIGIT_WORDS = (
    "zero oh one two three four five six seven eight nine null eins zwei drei vier fünf sechs sieben acht neun"
    " zéro un deux trois quatre cinq sept huit neuf cero uno dos tres cuatro cinco seis siete ocho nueve"
).split()
_SPELLED = re.compile(rf"\b(?:{'|'.join(_DIGIT_WORDS)})(?:[\s-]+(?:{'|'.join(_DIGIT_WORDS)})){{5,}}\b", re.I)

_NUMBER = re.compile(
    r"(?<![\w.,/+-])(?:"
    r"\+\d{1,3}[\s-]?(?:\(0\)[\s-]?)?\d[\d\s./-]{4,}\d"
    r"|\(\d{2,5}\)[\s-]?\d[\d\s.-]{3,}\d"
    r"|[A-Z]{1,6}[\s-]?\d(?:[\s-]?\d){4,11}(?:[\s-]?[A-Z])?"
    r"|[A-Z]{3,6}\d{3,5}[A-Z]"
    r"|\d{5,}[\s-]?[A-Z]"
    r"|\d(?:[\s./-]?\d){5,14}(?:[\s-][A-Z])?"
    r")(?![\w@]|[.,/-]\d)"
)

#: Kinds of streets, by where the word stands. Fixed values.
_STREET_AFTER = "street|st|road|rd|lane|ln|avenue|ave|court|ct|close|terrace|drive|way|place|square|crescent|gardens|grove|row|nagar|marg|boulevard|blvd"
_STREET_BEFORE = (
    "rue|avenue|av\\.|boulevard|bd|place|chemin|impasse|allée|quai|via|viale|piazza|corso|calle|avenida|avda\\.?|paseo|plaza|rua|praça|travessa"
    "|largo|ulica|ul\\.|aleja|al\\.|ulitsa|улица|ул\\."
)
_STREET_END = "straße|strasse|str\\.|gatan|vägen|gränd|gasse|weg|platz|allee|ring|damm|ufer|laan|straat|plein|gracht|kade"
_CAP = r"[A-ZÀ-ÖØ-ÞА-Я][\w'’-]*"
_ADDRESSES = [
    ("flat", re.compile(rf"\b(?:Flat|Apt\.?|Apartment|Unit|Suite|Wohnung|Appt\.?)\s+\w{{1,4}},\s*\d{{1,4}}\w?\s+(?:[\w'’-]+\s+){{1,3}}(?:{_STREET_AFTER})\b\.?", re.I)),
    ("house", re.compile(rf"\bH\.?\s?No\.?\s*\d[\d/-]*,\s*(?:[\w'’-]+\s+){{1,3}}(?:{_STREET_AFTER})\b", re.I)),
    ("number_before", re.compile(rf"(?<![\w./-])\d{{1,4}}\s?[A-Za-z]?(?:\s(?:bis|ter))?,?\s+(?:{_STREET_BEFORE})\s+(?:(?:de\sla|del|della|des|du|de|da|do|di|la|le|les|los|las)\s+|[dl]['’])?[\w'’-]+", re.I)),
    ("number_street", re.compile(rf"(?<![\w./,-])\d{{1,4}}[A-Za-z]?\s+(?:{_CAP}\s+){{1,3}}(?i:{_STREET_AFTER})\b\.?")),
    ("street_number", re.compile(rf"(?<!\w)(?:C/|(?:{_STREET_BEFORE})\s)\s?(?:(?:de\sla|del|della|des|du|de|da|do|di)\s+)?{_CAP}(?:\s+{_CAP})?,?\s+\d{{1,4}}\b")),
    ("compound", re.compile(rf"(?<!\w)[A-ZÀ-ÞА-Я][\w-]*(?:{_STREET_END})\s+\d{{1,4}}\s?[a-z]?\b", re.I)),
    ("at_the", re.compile(rf"(?<!\w)(?:Am|Im|An\sder|Auf\sdem|In\sder|Zum|Zur)\s+{_CAP}\s+\d{{1,4}}\s?[a-z]?\b")),
    ("lane_number", re.compile(rf"(?<!\w)(?:[\w'’-]+)\s(?:{_STREET_AFTER})\s\d{{1,4}}\b", re.I)),
]

_WORD = re.compile(r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))*")

#: Words in front of a name that are no part of it. Fixed values.
TITLES = frozenset(
    "mr mrs ms miss mx dr prof sir madam herr herrn frau mme mlle m monsieur madame mademoiselle sr sra srta don doña señor señora"
    " sig signor signora ing dhr mevr pan pani".split()
)


#: Names that are common words too; before another word in small letters they are none.
_HOMOGRAPHS = frozenset("will may mark grace joy april june summer hope faith rose ray art drew guy sue pat rich jack dawn iris ruby".split())


#: Words in small letters that follow a name and are no part of it. Fixed values.
_FUNCTION_WORDS = frozenset(
    "about after and asked before came confirmed erreichbar formerly from have says said that their they this went were will with works would über nach sagt"
    " unter para pour dans avec dice dijo sobre préfère".split()
)


def _initial(text: str, a: int, b: int) -> bool:
    """One capital with a full stop, followed by no letter (J. Doe) but another initial (J.R.)."""
    if b - a != 1 or text[b : b + 1] != "." or not text[a].isupper():
        return False
    return not text[b + 1 : b + 2].isalpha() or text[b + 2 : b + 3] == "."


def name_runs(text: str, given: frozenset[str], family: frozenset[str]) -> list[Span]:
    """Runs of up to four words that could be a name: capitalised or in a gazetteer, with initials."""
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    out: list[Span] = []
    i = 0

    def fits(k: int) -> str:
        a, b = words[k]
        w, low = text[a:b], text[a:b].lower()
        if low in TITLES and (b - a > 1 or text[b : b + 1] != "."):
            return ""
        if _initial(text, a, b):
            return "I"
        if b - a < 2:
            return ""
        if low in _HOMOGRAPHS and w.islower() and not _NAME_LEFT.search(text[max(0, a - 40) : a]):
            follows = text[words[k + 1][0] : words[k + 1][1]].lower() if k + 1 < len(words) else ""
            if follows not in family:
                return ""
        code = "g" if low in given else "f" if low in family else "o"
        if w[0].isupper():
            return code.upper() if code != "o" else "C"
        return code if code != "o" else ""

    while i < len(words):
        shape = fits(i)
        if not shape:
            i += 1
            continue
        j, shapes = i, [shape]
        while j + 1 < len(words) and len(shapes) < 4:
            gap = text[words[j][1] : words[j + 1][0]]
            nxt = fits(j + 1)
            # After a given or family name a lower-case word of the other kind follows, in a text typed without capitals.
            if not nxt and gap == " " and shapes == ["g"] and words[j + 1][1] - words[j + 1][0] >= 4:
                word = text[words[j + 1][0] : words[j + 1][1]]
                nxt = "x" if word.islower() and word not in _FUNCTION_WORDS else ""
            if not nxt:
                break
            if gap == " " or (gap == ". " and shapes[-1] == "I") or (gap == "." and shapes[-1] == "I" and nxt == "I"):
                pass
            elif gap == ", " and "," not in shapes and len(shapes) == 1 and (nxt in "GgI"):
                shapes.append(",")
            else:
                break
            shapes.append(nxt)
            j += 1
            if nxt == "x":
                break
        if len(shapes) > 2 and shapes[0] == "C" and shapes[1] == "G" and "," not in shapes:
            # A place or the last word of a sentence stands before the name.
            i, shapes = i + 1, shapes[1:]
        end = words[j][1] + (1 if shapes[-1] == "I" else 0)
        out.append(Span(words[i][0], end, "name", "".join(shapes)))
        i = j + 1
    return out


def candidates(text: str, given: frozenset[str], family: frozenset[str]) -> list[Span]:
    """All candidate spans of a text, in no order; they may overlap, also within a kind."""
    out: list[Span] = []
    for m in _EMAIL.finditer(text):
        out.append(Span(m.start(), m.end(), "email", "plain" if re.search(r"\S@\S", m.group(0)) else "spaced"))
    for m in _SPELLED.finditer(text):
        out.append(Span(m.start(), m.end(), "phone", "spelled"))
    for m in _NUMBER.finditer(text):
        shape = re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", m.group(0)))
        digits = shape.count("9")
        if digits >= 7 and "A" not in shape:
            out.append(Span(m.start(), m.end(), "phone", shape))
        if digits >= 4:
            out.append(Span(m.start(), m.end(), "id_number", shape))
    for label, pattern in _ADDRESSES:
        for m in pattern.finditer(text):
            out.append(Span(m.start(), m.end(), "address", label))
    out += name_runs(text, given, family)
    return out


# ---------------------------------------------------------------- labelers

_DATE = re.compile(r"^(?:(?:19|20)\d\d[-./]\d{1,2}[-./]\d{1,2}|\d{1,2}[-./]\d{1,2}[-./](?:19|20)\d\d)$")
_PHONE_SHAPE = re.compile(
    r"^(?:\+9{1,3}.*|09{2,4}(?:\s9{2,4}){2,4}|\(9{2,5}\)[\s-]?9{2,4}[\s-]?9{2,6}|9{3}[. -]9{3}[. -]9{4}|9{3}\s9{3}\s9{2}\s9{2}"
    r"|09{2,4}/9{5,8}|09{2,4}-9{5,8}|[09]9{9,10}|spelled)$"
)
_ID_SHAPE = re.compile(
    r"^(?:9{3}-9{2}-9{4}|9{2}/9{3}/9{5}|9{6}-9{4}|9{3}\.9{3}\.9{3}-9{2}|9{4}\s9{4}\s9{4}|9{8}[- ]?A|A{1,3}9{6,8}A?|AA\s99\s99\s99\sA|A{5}9{4}A)$"
)
_NUMBER_NOT = re.compile(
    r"(?:\bfile\sid|\bbatch|\bticket|\binvoice|\brechnung|\bfacture|\breq(?:uisition)?|\bref(?:erence)?|\border|\bv\d[\d.]*|\broom|\bversion|\bcase|\bpo|\bjob)\W{0,3}$", re.I
)
#: Words that say what a number is, in several languages. Fixed values.
_PHONE_LEFT = re.compile(r"\b(?:tel\.?|phone|mob(?:ile)?|call|number|cell|fax|handy|telefon|téléphone|teléfono|whatsapp|text|ring|dial)\W{0,3}$", re.I)
_ID_LEFT = re.compile(
    r"\b(?:passport|security\sno|tax\s(?:no|number|id)|badge|ausweis(?:-?nr)?|documento|id|ssn|national\sid|licen[cs]e(?:\sno)?|identity\s\w+|personnummer|dni|nif|pesel)\W{0,4}$", re.I
)
_ADDRESS_LEFT = re.compile(r"(?:\bat|\baddress|\badresse|\bindirizzo|\badres|\bdirección|:|,)\s*$", re.I)
_ADDRESS_RIGHT = re.compile(rf"^\.?,\s*(?:\d\w?º\s?\w?,?\s*)?(?:\d{{3}}\s?\d{{2,3}}\s+)?{_CAP}")
_NAME_LEFT = re.compile(r"\b(?:with|mit|con|avec|by|contact:?|c/o|Dr|Mr|Mrs|Ms|Mme|Mlle|M|Prof|Herrn?|Frau|Sr|Sra)\.?\s$", re.I)
_NAME_RIGHT = re.compile(r"^\s?(?:<|\((?:\+|\(?\d))")
_NAME_NOT_LEFT = re.compile(r"\b(?:at|near|in|on|de|des|du|for|für|via|rue|avenue)\s$", re.I)
_NAME_NOT_RIGHT = re.compile(r"^(?:\s(?:AG|GmbH|Ltd|LLC|Inc|AB|B\.?V|S\.?A|S\.p\.A|Pvt)\b|,?\s\d{3,}|\s\d+[a-z]?,)", re.I)
_SENTENCE_START = re.compile(r"(?:^|[.!?:;\n•*|-])\s*$")


def _homograph(text: str, s: Span) -> bool:
    """A single word that is a common one too, before a word in small letters."""
    return text[s.start : s.end].lower() in _HOMOGRAPHS and re.match(r"\s+[a-z]{2,}", text[s.end : s.end + 20]) is not None


LABELERS = ("shape", "left", "right", "gazetteer", "not_left", "not_right", "start", "form")


def votes(text: str, s: Span) -> list[int]:
    """What each labeler says of a candidate: 1 for, -1 against, 0 nothing."""
    left, right = text[max(0, s.start - 40) : s.start], text[s.end : s.end + 40]
    body = text[s.start : s.end]
    v = dict.fromkeys(LABELERS, 0)
    if s.kind == "email":
        v["shape"] = 1
        v["form"] = 1 if re.search(r"\.[A-Za-z]{2,}$|dot\W+[A-Za-z]{2,}$", body, re.I) else -1
        v["left"] = 1 if re.search(r"(?:mail|to|contact|courriel|at|use|private|<|\()\W*$", left, re.I) else 0
    elif s.kind in ("phone", "id_number"):
        phone = s.kind == "phone"
        # A trunk prefix tells telephone numbers, but says nothing of identity numbers.
        dialled = _PHONE_SHAPE.match("0" + s.shape[1:] if body[0] == "0" else s.shape)
        known = _ID_SHAPE.match(s.shape)
        v["shape"] = 1 if (dialled and not known if phone else known) else -1
        v["left"] = 1 if (_PHONE_LEFT if phone else _ID_LEFT).search(left) else 0
        v["not_left"] = -1 if _NUMBER_NOT.search(left) or (_ID_LEFT if phone else _PHONE_LEFT).search(left) and not v["left"] else 0
        # Ten digits in a row may be anything; grouped digits say more.
        v["form"] = -1 if _DATE.match(body) else 1 if v["shape"] == 1 and not re.fullmatch(r"9+", s.shape) else 0
    elif s.kind == "address":
        v["shape"] = 1
        v["left"] = 1 if _ADDRESS_LEFT.search(left) else 0
        v["right"] = 1 if _ADDRESS_RIGHT.match(right) else 0
        v["form"] = -1 if re.search(r"\b(?:19|20)\d\d\b", body) and s.shape == "at_the" else 0
    else:
        shapes = s.shape.replace(",", "")
        # A name that is a common word too is no evidence before a word in small letters.
        common = _homograph(text, s)
        v["gazetteer"] = 1 if re.search("[gGfF]", shapes) and not common else 0
        v["form"] = 1 if len(shapes) > 1 and re.search("[gG]", shapes) else 0
        v["left"] = 1 if _NAME_LEFT.search(left) else 0
        v["right"] = 1 if _NAME_RIGHT.match(right) else 0
        v["not_left"] = -1 if _NAME_NOT_LEFT.search(left) and not v["left"] else 0
        v["not_right"] = -1 if _NAME_NOT_RIGHT.match(right) and not v["right"] else 0
        # Any word begins a sentence with a capital; one that is a name elsewhere says more.
        v["start"] = -1 if shapes[0] in "C" and _SENTENCE_START.search(left) else -1 if common else 0
        # Capitals alone are names of places and firms as well.
        v["shape"] = -1 if not v["gazetteer"] and not v["left"] else 0
    return [v[x] for x in LABELERS]


def _context(text: str, s: Span) -> list[str]:
    """The two tokens on either side of a candidate, by place and as pairs; digits are alike."""
    before = re.findall(r"\w+|[^\w\s]", text[max(0, s.start - 40) : s.start])[-2:]
    after = re.findall(r"\w+|[^\w\s]", text[s.end : s.end + 40])[:2]
    digits = lambda w: re.sub(r"\d", "9", w.lower())
    names = [f"b{k}={digits(w)}" for k, w in zip((2, 1), [None] * (2 - len(before)) + before) if w]
    names += [f"a{k}={digits(w)}" for k, w in zip((1, 2), after)]
    if len(before) == 2:
        names.append("bb=" + digits(" ".join(before)))
    if len(after) == 2:
        names.append("aa=" + digits(" ".join(after)))
    return names


def _hashed(kind: str, names: list[str], bits: int) -> np.ndarray:
    mask = (1 << bits) - 1
    return np.array([zlib.crc32(f"{kind}|{n}".encode()) & mask for n in names], np.int64)


def _features(text: str, s: Span, v: list[int], bits: int) -> np.ndarray:
    """Hashed features of a candidate: votes, shape, ends of its words, and the words around it."""
    body = text[s.start : s.end]
    names = [f"shape={s.shape if len(s.shape) < 20 else 'long'}", "any", *_context(text, s)]
    names += [f"{n}={x}" for n, x in zip(LABELERS, v)]
    if s.kind == "name":
        words = _WORD.findall(body)
        names += [f"end={w.lower()[-3:]}" for w in words]
        names += [f"w0={words[0].lower()}" if words else "w0="]
        names += [f"n={len(words)}", f"case={'u' if body.isupper() else 'l' if body.islower() else 'm'}"]
    return _hashed(s.kind, names, bits)


# ---------------------------------------------------------------- fitting


def reliabilities(ballots: np.ndarray, iterations: int) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each candidate and ``P(vote | class)`` of each labeler, by expectation-maximisation.

    Starts from the sum of the votes; pseudo-counts keep a labeler from being read the wrong way round.
    """
    n, m = ballots.shape
    p = 1 / (1 + np.exp(-2.0 * ballots.sum(1)))
    rates = np.zeros((2, m, 3))
    prior_counts = np.array([[6.0, 8.0, 2.0], [2.0, 8.0, 6.0]])  # class no: votes -1, 0, 1; class yes
    for _ in range(iterations):
        share = (p.sum() + 1) / (n + 2)
        for c, weight in ((0, 1 - p), (1, p)):
            for k, vote in enumerate((-1, 0, 1)):
                rates[c, :, k] = ((ballots == vote) * weight[:, None]).sum(0) + prior_counts[c, k]
            rates[c] /= rates[c].sum(1, keepdims=True)
        log_odds = np.log(share / (1 - share)) + sum(
            np.log(rates[1, j, ballots[:, j] + 1]) - np.log(rates[0, j, ballots[:, j] + 1]) for j in range(m)
        )
        p = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return p, rates


@dataclass
class Model:
    """Span classifier with the gazetteers that its candidates and features need."""

    weights: np.ndarray
    given: frozenset[str]
    family: frozenset[str]
    bits: int
    rates: dict[str, np.ndarray] = field(default_factory=dict)

    def score(self, text: str, s: Span) -> float:
        z = float(self.weights[_features(text, s, votes(text, s), self.bits)].sum())
        return 1 / (1 + np.exp(-max(-30.0, min(30.0, z))))

    def mentions(self, text: str) -> list[tuple[int, int, str, float]]:
        """``(start, end, kind, probability)`` of the accepted spans, in order, without overlaps.

        Of overlapping spans the surer kind (address and e-mail before numbers before names) stands,
        then the longer one.
        """
        rank = {"email": 0, "address": 1, "phone": 2, "id_number": 2, "name": 3}
        found = []
        for s in candidates(text, self.given, self.family):
            p = self.score(text, s)
            if p >= 0.5:
                found.append((rank[s.kind], -round(p, 3) if s.kind in ("phone", "id_number") else 0.0, s.start - s.end, s.start, s.end, s.kind, p))
        taken: list[tuple[int, int, str, float]] = []
        for _, _, _, a, b, kind, p in sorted(found):
            if all(b <= x or a >= y for x, y, _, _ in taken):
                taken.append((a, b, kind, p))
        return sorted(taken)


def _logistic(rows: list[np.ndarray], y: np.ndarray, cfg: FitConfig, rng: np.random.Generator) -> np.ndarray:
    """Weights of a logistic classifier on hashed features with soft labels, by adaptive gradient steps."""
    weights = np.zeros(1 << cfg.bits)
    squares = np.full(1 << cfg.bits, 1e-8)
    for _ in range(cfg.epochs):
        for i in rng.permutation(y.size):
            f = rows[i]
            g = 1 / (1 + np.exp(-np.clip(weights[f].sum(), -30, 30))) - y[i]
            squares[f] += g * g
            weights[f] -= cfg.rate * (g / np.sqrt(squares[f]) + cfg.decay * weights[f])
    return weights


def _context_votes(rows: list[np.ndarray], p: np.ndarray, texts: np.ndarray, cfg: FitConfig, rng: np.random.Generator) -> np.ndarray:
    """What the words around a candidate say, learned from the surer candidates of the other half of the texts."""
    out = np.zeros(p.size, int)
    for half in (0, 1):
        sure = np.flatnonzero((texts % 2 != half) & ((p > 0.8) | (p < 0.2)))
        asked = np.flatnonzero(texts % 2 == half)
        if not sure.size or not asked.size:
            continue
        w = _logistic([rows[i] for i in sure], p[sure], cfg, rng)
        z = np.array([w[rows[i]].sum() for i in asked])
        out[asked] = np.where(z > 1.5, 1, np.where(z < -1.5, -1, 0))
    return out


def fit(texts: list[str], given: frozenset[str], family: frozenset[str], cfg: FitConfig = FitConfig()) -> Model:
    """Fit the labelers' reliabilities and the span classifier on unlabelled texts.

    The first round of the general labelers teaches what stands around mentions of a kind; that context then
    votes as a labeler of its own, for which no words are given, and the second round's probabilities train the
    classifier.
    """
    rng = np.random.default_rng(cfg.seed)
    rates: dict[str, np.ndarray] = {}
    rows: list[np.ndarray] = []
    target: list[float] = []
    spans = [(k, t, s, votes(t, s)) for k, t in enumerate(texts) for s in candidates(t, given, family)]
    for kind in KINDS:
        own = [x for x in spans if x[2].kind == kind]
        if not own:
            continue
        ballots = np.array([v for *_, v in own])
        p, rates[kind] = reliabilities(ballots, cfg.iterations)
        around = [_hashed(kind, ["any", *_context(t, s)], cfg.bits) for _, t, s, _ in own]
        at = np.array([k for k, *_ in own])
        for _ in range(cfg.rounds):
            said = _context_votes(around, p, at, cfg, rng)
            p, rates[kind] = reliabilities(np.column_stack([ballots, said]), cfg.iterations)
        rows += [_features(t, s, v, cfg.bits) for _, t, s, v in own]
        target += p.tolist()
    weights = _logistic(rows, np.array(target), cfg, rng) if rows else np.zeros(1 << cfg.bits)
    return Model(weights.astype(np.float32), given, family, cfg.bits, rates)


def gazetteer(column_tables: list[tuple[DataFrame, str]], size: int) -> dict[str, int]:
    """The most frequent words of name columns, lower-cased, with counts; at most ``size`` of them reach the driver."""
    parts = [
        # Addresses, links and numbers in a name column are no names.
        df.where(~F.col(c).rlike(r"[@\d/:]|\.\w{2,}")).select(F.explode(F.regexp_extract_all(F.lower(F.col(c)), F.lit(r"([\p{L}]{2,})"), F.lit(1))).alias("w"))
        for df, c in column_tables
    ]
    words = parts[0]
    for p in parts[1:]:
        words = words.unionByName(p)
    top = words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n >= 3").orderBy(F.desc("n"), "w").limit(size)
    return {r["w"]: r["n"] for r in top.collect()}


def texts_of(recruiters: DataFrame, ats: DataFrame) -> DataFrame:
    """``(tbl, row_id, body)`` of the free-text fields of both tables."""
    return recruiters.select(F.lit("recruiter_sample").alias("tbl"), "row_id", F.col("notes").alias("body")).unionByName(
        ats.select(F.lit("ats_sample").alias("tbl"), "row_id", F.col("current_position.description").alias("body"))
    )


def fit_on(recruiters: DataFrame, ats: DataFrame, cfg: FitConfig = FitConfig()) -> Model:
    """Model for the tables: gazetteers from their name columns, a bounded draw of their texts."""
    firsts = gazetteer([(recruiters, "first_name"), (ats, "first_name")], cfg.names)
    lasts = gazetteer([(recruiters, "last_name"), (ats, "last_name")], cfg.names)
    # Columns get swapped: a word is of the kind that it is typed as more often.
    given = frozenset(w for w, n in firsts.items() if n > lasts.get(w, 0))
    family = frozenset(w for w, n in lasts.items() if n >= firsts.get(w, 0))
    bodies = texts_of(recruiters, ats).where(F.length("body") > 0)
    n = bodies.count()
    share = min(1.0, cfg.texts / max(1, n))
    draw = bodies.where(F.pmod(F.xxhash64("row_id", F.lit(cfg.seed)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    rows = draw.select("row_id", "body").limit(2 * cfg.texts).collect()
    return fit([r["body"] for r in sorted(rows, key=lambda r: (r["row_id"], r["body"]))], given, family, cfg)


def find_mentions(texts: DataFrame, model: Model) -> DataFrame:
    """``(tbl, row_id, start_pos, end_pos, kind, confidence)``, one row per mention.

    Null and empty texts give no row; texts of any length are read whole; a repeated row gives its
    mentions again.
    """
    shared = texts.sparkSession.sparkContext.broadcast(model)  # 2^bits weights and two bounded gazetteers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            rows, found = [], []
            for i, t in enumerate(batch.column(2).to_pylist()):
                got = m.mentions(t) if t else []
                rows += [i] * len(got)
                found += got
            take = pa.array(rows, pa.int64())
            cols = list(zip(*found)) if found else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(take), batch.column(1).take(take), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                    pa.array(cols[2], pa.string()), pa.array(cols[3], pa.float64()),
                ],
                names=["tbl", "row_id", "start_pos", "end_pos", "kind", "confidence"],
            )

    schema = "tbl string, row_id long, start_pos long, end_pos long, kind string, confidence double"
    picked = texts.select("tbl", F.col("row_id").cast("long").alias("row_id"), F.col("body").cast("string").alias("body"))
    return spread(picked).mapInArrow(run, schema)


def redact(texts: DataFrame, model: Model) -> DataFrame:
    """``(tbl, row_id, redacted)``: every text with ``[EMAIL]``, ``[PHONE]``, ... for its mentions; null stays null."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            out = []
            for t in batch.column(2).to_pylist():
                if t:
                    for a, b, kind, _ in reversed(m.mentions(t)):
                        t = f"{t[:a]}[{kind.upper()}]{t[b:]}"
                out.append(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["tbl", "row_id", "redacted"])

    picked = texts.select("tbl", F.col("row_id").cast("long").alias("row_id"), F.col("body").cast("string").alias("body"))
    return spread(picked).mapInArrow(run, "tbl string, row_id long, redacted string")
