"""Languages of documents and of the segments of mixed ones.

Classifier: every text unit is the average of hashed subword embeddings (character n-grams of words
with their boundaries) under a linear softmax, trained by stochastic gradient descent in numpy. Labels
are noisy, so training alternates with dropping documents and units that the model contradicts.
The temperature of the softmax is fitted on held-out units, and units whose best probability is low
are left undecided.

Fitting sees a bounded sample of labelled rows (``TrainConfig.docs_per_language``), taken by a hash of
the key, and of each at most ``units_per_doc`` units drawn from the whole text; classification covers every document, as one narrow stage. The model is a fixed-size table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recfuse.session import spread

LANGUAGES = ("en", "de", "fr", "es", "pt", "it", "nl", "pl", "sv", "ru")

#: Notations of languages: codes of two and three letters, English and own names. Fixed values.
NOTATIONS = {
    "en": ("en", "eng", "english"),
    "de": ("de", "ger", "deu", "german", "deutsch"),
    "fr": ("fr", "fre", "fra", "french", "français", "francais"),
    "es": ("es", "spa", "spanish", "español", "espanol", "castellano"),
    "pt": ("pt", "por", "portuguese", "português", "portugues"),
    "it": ("it", "ita", "italian", "italiano"),
    "nl": ("nl", "dut", "nld", "dutch", "nederlands"),
    "pl": ("pl", "pol", "polish", "polski"),
    "sv": ("sv", "swe", "swedish", "svenska"),
    "ru": ("ru", "rus", "russian", "русский"),
}


@dataclass(frozen=True)
class TrainConfig:
    """Parameters of the fit; ``docs_per_language`` bounds the sample that reaches the driver."""

    docs_per_language: int = 500
    units_per_doc: int = 6  # drawn from the whole of a training document; classification reads every unit
    features_per_unit: int = 200  # drawn from a training unit
    bits: int = 17
    dim: int = 12
    epochs: int = 5
    rounds: int = 2
    rate: float = 8.0
    batch: int = 128
    least_steps: int = 600  # small samples are passed over more often
    seed: int = 7
    min_probability: float = 0.6  # calibrated; below it a unit is undecided
    min_letters: int = 9  # a unit with fewer letters is undecided
    switch_cost: float = 2.0  # log odds that a change of language must outweigh


def label_language(label: Column) -> Column:
    """Language code that a label names in any notation (``en_US``, ``français``, ``Deutsch (CH)``), or null."""
    word = F.lower(F.regexp_extract(label, r"^\s*([\p{L}]+)", 1))
    names = F.create_map(*[F.lit(x) for code, all_ in NOTATIONS.items() for n in all_ for x in (n, code)])
    return F.element_at(names, F.nullif(word, F.lit("")))


_BREAK = re.compile(r"[.!?…][\"'’)\]»]*\s+(?=\S)|\s*[\r\n]+\s*|\s+[/|•]\s+|\s{2,}|\t")
#: A full stop of an abbreviation (S.A., B.V., Inc.) ends no sentence; a second one after it does.
_ABBREVIATION = re.compile(r"(?:(?<![^\W\d_])[^\W\d_](?:\.[^\W\d_]){1,2}|\b(?:Inc|INC|Dr|Mr|Ms|Mrs|Prof|Nr))\.\Z")
_MARKUP = re.compile(r"<[^<>\s]*>|&\w+;|https?://\S+|\S+@\S+|\[\w?\]")


def units(text: str) -> list[tuple[int, int]]:
    """Sentence-like spans of a text, in code points; together they cover it."""
    cuts = [0]
    for m in _BREAK.finditer(text):
        if m.group(0)[0] == "." and "\n" not in m.group(0) and _ABBREVIATION.search(text, max(0, m.start() - 8), m.start() + 1):
            continue
        cuts.append(m.end())
    cuts.append(len(text))
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: its lower case, or 0 if it is no letter."""
    low = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            x = c.lower()
            low[i] = ord(x) if len(x) == 1 else i
    return low, low > 0


_LOWER: list[tuple[np.ndarray, np.ndarray]] = []


def gram_runs(text: str, bits: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """``(positions, hashed buckets, weight)`` of the n-grams (1 to 5) and the words of a text, each in order of position.

    An n-gram has letters only, but for a word boundary at either end; boundaries are all alike. A word
    counts three times.
    """
    if not _LOWER:
        _LOWER.append(_tables())
    low = _LOWER[0][0]
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = low[cp].astype(np.uint64)
    letter = c > 0
    n = c.size
    runs: list[tuple[np.ndarray, np.ndarray, int]] = []
    mask = np.uint64((1 << bits) - 1)
    h = np.zeros(n, np.uint64)
    inner = np.ones(n, bool)  # all but the ends are letters
    for k in range(1, 6):
        m = n - k + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x9E3779B97F4A7C15) + c[k - 1 :] + np.uint64(1)
        if k > 2:
            inner = inner[:m] & letter[k - 2 : k - 2 + m]
        else:
            inner = inner[:m]
        ok = inner & (letter[:m] | letter[k - 1 :]) if k <= 2 else inner
        i = np.flatnonzero(ok)
        x = h[i] ^ (h[i] >> np.uint64(29))
        x = x * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(k)
        runs.append((i, ((x >> np.uint64(32)) & mask).astype(np.int64), 1))
    starts = np.flatnonzero(letter & ~np.concatenate(([False], letter[:-1])))
    if starts.size:
        inside = np.flatnonzero(letter)
        first = np.searchsorted(inside, starts)
        place = np.arange(inside.size) - np.repeat(first, np.diff(np.append(first, inside.size)))
        powers = np.cumprod(np.full(64, 0x100000001B3, np.uint64))
        x = np.add.reduceat(c[inside] * powers[place % 64], first)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        runs.append((starts, ((x >> np.uint64(32)) & mask).astype(np.int64), 3))
    return runs


def features(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashed buckets of the n-grams and words of a text, each as often as it counts."""
    runs = [(at, buckets) for at, buckets, weight in gram_runs(text, bits) for _ in range(weight)]
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([at for at, _ in runs]), np.concatenate([buckets for _, buckets in runs])


def _mask(text: str) -> str:
    """Blank out markup, links and addresses, keeping every position."""
    return _MARKUP.sub(lambda m: " " * (m.end() - m.start()), text)


@dataclass
class Model:
    """Scores of the buckets (embedding times output layer), bias and temperature."""

    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    config: TrainConfig

    def unit_logits(self, text: str, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated log-probabilities of each span, and its number of letters."""
        k = len(spans)
        starts = np.array([a for a, _ in spans])
        counts = np.zeros(k)
        sums = np.zeros((k, self.scores.shape[1]))
        for at, buckets, weight in gram_runs(text, self.config.bits):
            if not at.size:
                continue
            # Positions ascend, so the rows of a unit lie together.
            cut = np.append(np.searchsorted(at, starts), at.size)
            size = np.diff(cut)
            some = np.flatnonzero(size)
            counts += weight * size
            sums[some] += weight * np.add.reduceat(self.scores[buckets], cut[some], 0)
        z = (sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature
        z -= z.max(1, keepdims=True)
        z -= np.log(np.exp(z).sum(1, keepdims=True))
        ends = np.array([b for _, b in spans])
        is_letter = np.fromiter(map(str.isalpha, text), bool, len(text))
        upto = np.concatenate(([0], np.cumsum(is_letter)))
        return z, upto[ends] - upto[starts]

    def segments(self, text: str) -> list[tuple[int, str, float]]:
        """``(start_pos, language, confidence)`` of each segment; empty for a text without running words.

        The path of languages is the best one under the units' probabilities and a cost for every
        change; a segment begins at the first letter of its first decided unit, the first one at 0.
        """
        clean = _mask(text)
        spans = units(clean)
        if not spans:
            return []
        logp, letters = self.unit_logits(clean, spans)
        best = np.exp(logp.max(1))
        decided = (letters >= self.config.min_letters) & (best >= self.config.min_probability)
        if not decided.any():
            # A text of undecided units only: its sum may still decide.
            if letters.sum() < 2 * self.config.min_letters:
                return []
            whole, _ = self.unit_logits(clean, [(0, len(clean))])
            if np.exp(whole.max()) < self.config.min_probability:
                return []  # in none of the languages, as far as can be told
            decided = letters > 0
            logp = np.repeat(whole, len(spans), 0)
        use = np.flatnonzero(decided)
        emit = logp[use] * np.minimum(letters[use] / 25.0, 2.0)[:, None]
        score = emit[0].copy()
        back = np.zeros((use.size, score.size), np.int64)
        for i in range(1, use.size):
            j = int(score.argmax())
            stay, move = score, score[j] - self.config.switch_cost
            back[i] = np.where(stay >= move, np.arange(score.size), j)
            score = np.maximum(stay, move) + emit[i]
        path = np.empty(use.size, np.int64)
        path[-1] = int(score.argmax())
        for i in range(use.size - 1, 0, -1):
            path[i - 1] = back[i, path[i]]
        out: list[tuple[int, str, float]] = []
        begins = np.flatnonzero(np.concatenate(([True], path[1:] != path[:-1])))
        for b, e in zip(begins, [*begins[1:], use.size]):
            rows = use[b:e]
            weight = letters[rows]
            p = float((np.exp(logp[rows, path[b]]) * weight).sum() / weight.sum())
            a, z = spans[rows[0]]
            start = 0 if b == 0 else a + next(i for i, c in enumerate(clean[a:z]) if c.isalpha())
            out.append((start, LANGUAGES[path[b]], round(p, 6)))
        return out


def _softmax_fit(feats: list[np.ndarray], y: np.ndarray, cfg: TrainConfig, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Train the averaged embeddings; returns bucket scores and bias."""
    size, k, d = 1 << cfg.bits, len(LANGUAGES), cfg.dim
    emb = rng.normal(0, 1.0 / d, (size, d)).astype(np.float32)
    out = np.zeros((d, k), np.float32)
    bias = np.zeros(k, np.float32)
    share = np.bincount(y, minlength=k)
    weight = (share.sum() / np.maximum(share, 1) / k)[y].astype(np.float32)
    weight = np.minimum(weight, 5)
    per_epoch = (y.size + cfg.batch - 1) // cfg.batch
    epochs = max(cfg.epochs, -(-cfg.least_steps // per_epoch))
    steps = epochs * per_epoch
    step = 0
    for _ in range(epochs):
        order = rng.permutation(y.size)
        for s in range(0, y.size, cfg.batch):
            rate = cfg.rate * (1 - step / steps)
            step += 1
            rows = order[s : s + cfg.batch]
            ids = np.concatenate([feats[i] for i in rows])
            n = np.array([feats[i].size for i in rows])
            bounds = np.concatenate(([0], np.cumsum(n)[:-1]))
            mean = np.add.reduceat(emb[ids], bounds, 0) / n[:, None].astype(np.float32)
            z = mean @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(rows.size), y[rows]] -= 1
            p *= (weight[rows] / rows.size)[:, None]
            back = p @ out.T
            out -= rate * (mean.T @ p)
            bias -= rate * p.sum(0)
            grad = np.repeat((back / n[:, None] * (rate * 32)).astype(np.float32), n, 0)
            by = np.argsort(ids, kind="stable")
            ranked = ids[by]
            first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
            emb[ranked[first]] -= np.add.reduceat(grad[by], first, 0)
    return (emb @ out).astype(np.float32), bias


def _strip_accents(text: str) -> str:
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))


def fit(samples: list[tuple[str, str]], cfg: TrainConfig = TrainConfig()) -> Model:
    """Fit on ``(text, language)`` pairs whose languages may be wrong or incomplete."""
    rng = np.random.default_rng(cfg.seed)
    code = {c: i for i, c in enumerate(LANGUAGES)}
    feats: list[np.ndarray] = []
    y, doc = [], []
    for d, (text, lang) in enumerate(samples):
        clean = _mask(text)
        plain = _strip_accents(clean)
        for version in (clean, plain) if plain != clean else (clean,):
            at, buckets = features(version, cfg.bits)
            spans = units(version)
            unit = np.searchsorted(np.array([a for a, _ in spans]), at, "right") - 1 if spans else at
            size = np.bincount(unit, minlength=len(spans)) if spans else np.zeros(0, int)
            full = np.flatnonzero(size >= 40)
            for u in np.sort(rng.choice(full, min(full.size, cfg.units_per_doc), replace=False)):
                f = buckets[unit == u]
                if f.size > cfg.features_per_unit:
                    f = rng.choice(f, cfg.features_per_unit, replace=False)
                feats.append(f.astype(np.int32))
                y.append(code[lang])
                doc.append(d)
    if not feats:
        return Model(np.zeros((1 << cfg.bits, len(LANGUAGES)), np.float32), np.zeros(len(LANGUAGES), np.float32), 1.0, cfg)
    y, doc = np.array(y), np.array(doc)
    held = doc % 10 == 0
    keep = ~held
    scores, bias = None, None
    z = np.zeros((y.size, len(LANGUAGES)))
    for _ in range(cfg.rounds):
        rows = np.flatnonzero(keep)
        scores, bias = _softmax_fit([feats[i] for i in rows], y[rows], cfg, rng)
        z = np.stack([scores[f].mean(0) for f in feats]) + bias
        guess = z.argmax(1)
        agree = np.bincount(doc, guess == y, doc.max() + 1) / np.maximum(np.bincount(doc, minlength=doc.max() + 1), 1)
        # Documents that mostly contradict their label are mislabelled, single units foreign.
        keep = ~held & (guess == y) & (agree[doc] > 0.6)
        if not keep.any():
            keep = ~held
    good = held & (z.argmax(1) == y)
    if not good.any():
        good = np.ones(y.size, bool)
    best, temperature = np.inf, 1.0
    for t in np.geomspace(0.2, 5, 30):
        q = z[good] / t
        q = q - q.max(1, keepdims=True)
        q -= np.log(np.exp(q).sum(1, keepdims=True))
        # Label smoothing keeps the fit from certainty, since contradicted units were left out.
        loss = -(0.98 * q[np.arange(q.shape[0]), y[good]] + 0.02 * q.mean(1)).mean()
        if loss < best:
            best, temperature = loss, float(t)
    return Model(scores, bias, temperature, cfg)


def training_sample(docs: DataFrame, cfg: TrainConfig, key: str, text: str, label: str) -> list[tuple[str, str]]:
    """At most about ``docs_per_language`` labelled documents of each language, chosen by a hash of the key."""
    named = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), label_language(F.col(label)).alias("lang")).where(
        F.col("lang").isNotNull() & (F.length("t") >= 40)
    )
    sizes = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # ten rows
    if not sizes:
        return []
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, cfg.docs_per_language / n)))])
    draw = (F.pmod(F.xxhash64("k", F.lit(cfg.seed)), F.lit(1 << 30)) / float(1 << 30)) < F.element_at(share, F.col("lang"))
    rows = named.where(draw).select("k", "t", "lang")
    rows = rows.limit(2 * cfg.docs_per_language * len(LANGUAGES)).collect()  # the draw is random, the limit its hard bound
    return [(r["t"], r["lang"]) for r in sorted(rows, key=lambda r: (r["k"], r["t"]))]


def document_segments(
    docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", cfg: TrainConfig = TrainConfig(), model: Model | None = None
) -> DataFrame:
    """``(key, start_pos, lang, confidence, n_segments, label_lang)``: the segments of every document.

    Null, empty and wordless texts give no row; texts of any length are read whole; a repeated row
    gives its segments again. ``label_lang`` is the language that the label names, or null.
    """
    spark = docs.sparkSession
    fitted = model or fit(training_sample(docs, cfg, key, text, label), cfg)
    shared = spark.sparkContext.broadcast(fitted)  # 2^bits times 10 numbers, whatever the corpus
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            rows, found = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                segs = m.segments(t) if t else []
                rows += [i] * len(segs)
                found += [(*s, len(segs)) for s in segs]
            take = pa.array(rows, pa.int64())
            cols = list(zip(*found)) if found else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(take),
                    pa.array(cols[0], pa.int64()),
                    pa.array(cols[1], pa.string()),
                    pa.array(cols[2], pa.float64()),
                    pa.array(cols[3], pa.int32()),
                    batch.column(2).take(take),
                ],
                names=[key, "start_pos", "lang", "confidence", "n_segments", "label_lang"],
            )

    picked = docs.select(F.col(key), F.col(text).cast("string").alias("body"), label_language(F.col(label)).alias("label_lang"))
    return spread(picked).mapInArrow(
        run, f"`{key}` {key_type}, start_pos long, lang string, confidence double, n_segments int, label_lang string"
    )


def doubtful(segments: DataFrame) -> DataFrame:
    """Segments of documents whose label names no language or a wrong one, or with several languages."""
    label = F.col("label_lang")
    return segments.where(label.isNull() | (F.col("n_segments") > 1) | (label != F.col("lang")))
