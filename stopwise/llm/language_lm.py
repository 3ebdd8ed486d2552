"""Language identification by Kneser-Ney character models.

Each language has an interpolated Kneser-Ney model over characters, its letters in lower
case and everything between them one blank. The n-grams of all languages stand in one
sorted array of hashes per order, with a column of log-probabilities for each language, so
one search serves all of them. The language of the lowest cross-entropy per character is
predicted. A second slice of the labelled rows calibrates the score and sets, for every
language, the cross-entropy beyond which a text is marked as rejected.

The models are fitted on at most about ``TRAIN_ROWS`` labelled rows of each language, and
calibrated on ``CALIBRATION_ROWS``, taken by a hash of the doc_id. Texts are scored whole.

Null text and text without a letter give ``und`` with score 0. Languages of equal
cross-entropy: the first by name. Rows with a null language teach nothing; without any
labelled row every text is ``und``. Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .pretoken import LETTER, classes, code_points, portions
from .tables import free_name

ORDER = 4
TRAIN_ROWS = 3000            # labelled rows of each language to fit on, at most about
CALIBRATION_ROWS = 500
REJECT_QUANTILE = 0.999
PORTION_CHARS = 1 << 19
MAX_LANGUAGES = 1000
UNKNOWN = "und"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts in a row, each text led by a blank, and where texts begin."""
    lowered = [f" {t.lower()}" for t in texts]
    lengths = np.fromiter(map(len, lowered), np.int64, len(lowered))
    begins = np.cumsum(lengths) - lengths
    chars = code_points("".join(lowered))
    letter = classes()[chars] == LETTER
    first = np.zeros(len(chars), bool)
    first[begins] = True
    kept = letter | first
    kept[1:] |= letter[:-1]
    out = np.where(letter, chars, 32)[kept].astype(np.uint64)
    return out, (np.cumsum(kept) - 1)[begins]


def gram_hashes(chars: np.ndarray, order: int = ORDER) -> list[np.ndarray]:
    """For each length 1..order, the hash of the characters that end at each place."""
    out, rolled, power = [], np.zeros(len(chars), np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(order):
            shifted = np.zeros(len(chars), np.uint64)
            shifted[k:] = (chars[:len(chars) - k] if k else chars) + np.uint64(1)
            rolled = rolled + shifted * power
            power = power * _BASE
            h = (rolled ^ (rolled >> np.uint64(29))) * _MIX
            out.append(h ^ (h >> np.uint64(32)))
    return out


class HashArray:
    """Sorted hashes, entered by their leading bits."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.bits = max(1, int(len(keys)).bit_length())
        tops = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        self.first = np.searchsorted(tops, np.arange((1 << self.bits) + 1)).astype(np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, or -1."""
        out = np.full(len(hashes), -1, np.int32)
        if not len(self.keys):
            return out
        top = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.first[top], self.first[top + 1]
        live = np.flatnonzero(at < end)
        at, end, hashes = at[live], end[live], hashes[live]
        while len(live):
            hit = self.keys[at] == hashes
            out[live[hit]] = at[hit]
            at = at + 1
            more = ~hit & (at < end)
            live, at, end, hashes = live[more], at[more], end[more], hashes[more]
        return out


class LanguageModels:
    """Log-probabilities of all languages; see ``fit``."""

    def __init__(self, languages: list[str], counts: dict[str, np.ndarray]) -> None:
        """``counts``: distinct (lang, order, gram, prefix, suffix) with their number ``n``."""
        self.languages = languages
        self.order = ORDER
        self.grams, self.values, self.contexts, self.weights = [], [], [], []
        self.sharpness, self.limits = 1.0, np.full(len(languages), np.inf)
        width = len(languages)
        if not width:
            return
        lower = np.zeros((1, width), np.float32)
        for k in range(1, ORDER + 1):
            own = {c: v[counts["k"] == k] for c, v in counts.items()}
            amount = own["n"].astype(np.float64)
            if k < ORDER:      # continuation counts: different characters seen before
                longer = counts["k"] == k + 1
                amount = self._continuations(own, counts["lang"][longer],
                                             counts["suffix"][longer])
            keys, at = np.unique(own["gram"], return_inverse=True)
            one = np.zeros(len(keys), np.int64)
            one[at] = np.arange(len(at))             # a row of each gram
            before, context = np.unique(own["prefix"], return_inverse=True)
            cell = own["lang"] * len(before) + context
            total = np.bincount(cell, amount, width * len(before)).reshape(width, -1)
            kinds = np.bincount(cell, minlength=width * len(before)).reshape(width, -1)
            discount = np.array([self._discount(amount[own["lang"] == i]) for i in range(width)])
            left = np.where(total > 0, discount[:, None] * kinds / np.maximum(total, 1e-300), 1.0)
            if k == 1:
                base = np.full((len(keys), width), 1.0 / (len(keys) + 1))
            else:
                base = np.exp(lower[self.grams[-1].find(own["suffix"][one])])
            value = base * left.T[context[one]]
            value[at, own["lang"]] += np.maximum(amount - discount[own["lang"]], 0) \
                / total[own["lang"], context]
            lower = np.log(value).astype(np.float32)
            self.grams.append(HashArray(keys))
            self.values.append(lower)
            self.contexts.append(HashArray(before))
            self.weights.append(np.log(np.maximum(left.T, 1e-9)).astype(np.float32))
        # a character that no language has
        self.none = self.weights[0][0] - np.float32(np.log(len(self.grams[0].keys) + 1))

    @staticmethod
    def _discount(amount: np.ndarray) -> float:
        once, twice = (amount == 1).sum(), (amount == 2).sum()
        return float(once / (once + 2 * twice)) if once and twice else 0.5

    @staticmethod
    def _continuations(own, lang: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            salt = (np.arange(MAX_LANGUAGES, dtype=np.uint64) + np.uint64(1)) * _BASE
            keys, n = np.unique(suffix ^ salt[lang], return_counts=True)
            mine = own["gram"] ^ salt[own["lang"]]
        at = np.minimum(np.searchsorted(keys, mine), max(len(keys) - 1, 0))
        found = keys[at] == mine if len(keys) else np.zeros(len(mine), bool)
        return np.where(found, n[at] if len(n) else 0, 1).astype(np.float64)

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per character of every text under every language, and its characters."""
        chars, begins = symbols(texts)
        ends = np.append(begins[1:], len(chars))
        depth = np.arange(len(chars)) - np.repeat(begins, ends - begins)
        hashes = gram_hashes(chars)
        out = np.zeros((len(chars), len(self.languages)), np.float32)
        live = np.flatnonzero(depth > 0)
        for k in range(self.order, 0, -1):
            can = live[depth[live] >= k - 1]
            at = self.grams[k - 1].find(hashes[k - 1][can])
            seen = at >= 0
            out[can[seen]] += self.values[k - 1][at[seen]]
            missed = can[~seen]
            if k == 1:
                out[missed] += self.none
                break
            context = self.contexts[k - 1].find(hashes[k - 2][missed - 1])
            known = context >= 0
            out[missed[known]] += self.weights[k - 1][context[known]]
            short = live[depth[live] < k - 1]
            live = np.concatenate([short, missed]) if len(short) else missed
        sums = np.add.reduceat(out, begins, axis=0) if len(begins) else out
        n = ends - begins - 1
        return -sums / np.maximum(n, 1)[:, None], n

    def calibrate(self, entropies: np.ndarray, truth: np.ndarray) -> None:
        """Sharpness of the least log loss, and each language's limit of cross-entropy."""
        if not len(truth):
            return
        grid = 2.0 ** np.arange(0, 9, 0.5)
        losses = [-np.log(np.maximum(self._shares(entropies, s)[np.arange(len(truth)), truth],
                                     1e-12)).mean() for s in grid]
        self.sharpness = float(grid[int(np.argmin(losses))])
        for i in range(len(self.languages)):
            own = entropies[truth == i, i]
            if len(own):
                self.limits[i] = np.quantile(own, REJECT_QUANTILE)

    @staticmethod
    def _shares(entropies: np.ndarray, sharpness: float) -> np.ndarray:
        e = np.exp(-sharpness * (entropies - entropies.min(axis=1, keepdims=True)))
        return e / e.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy and rejection of every text."""
        names, scores, costs, rejected = [], [], [], []
        for a, b in portions(texts, PORTION_CHARS):
            if not self.languages:
                names += [UNKNOWN] * (b - a)
                scores.append(np.zeros(b - a))
                costs.append(np.zeros(b - a))
                rejected.append(np.ones(b - a, bool))
                continue
            entropies, n = self.entropies(texts[a:b])
            best = entropies.argmin(axis=1)
            cost = entropies[np.arange(b - a), best]
            share = self._shares(entropies, self.sharpness)[np.arange(b - a), best]
            names += [self.languages[i] if m else UNKNOWN for i, m in zip(best, n.tolist())]
            scores.append(np.where(n > 0, share, 0.0))
            costs.append(np.where(n > 0, cost, 0.0))
            rejected.append((n == 0) | (cost > self.limits[best]))
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0)
        return names, join(scores), join(costs), join(rejected)


def _count(languages: list[str]):
    place = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs) if x == lang]
                for a, b in portions(own, PORTION_CHARS):
                    yield from _counted(place[lang], own[a:b])

    return run


def _counted(lang: int, texts: list[str]) -> Iterator[pa.RecordBatch]:
    chars, begins = symbols(texts)
    depth = np.arange(len(chars)) - np.repeat(begins, np.diff(np.append(begins, len(chars))))
    hashes = gram_hashes(chars)
    for k in range(1, ORDER + 1):
        at = np.flatnonzero(depth >= max(k - 1, 1))
        grams, one, n = np.unique(hashes[k - 1][at], return_index=True, return_counts=True)
        last = at[one]
        prefix = hashes[k - 2][last - 1] if k > 1 else np.zeros(len(last), np.uint64)
        suffix = hashes[k - 2][last] if k > 1 else np.zeros(len(last), np.uint64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(n), lang, np.int32)), pa.array(np.full(len(n), k, np.int32)),
             *(pa.array(x.view(np.int64)) for x in (grams, prefix, suffix)),
             pa.array(n.astype(np.int64))], ["lang", "k", "gram", "prefix", "suffix", "n"])


def _slice(key: F.Column, low: F.Column | float, high: F.Column | float) -> F.Column:
    part = F.pmod(F.xxhash64(key), F.lit(1 << 20)) / float(1 << 20)
    return (part >= low) & (part < high)


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        rows: int = TRAIN_ROWS, calibration_rows: int = CALIBRATION_ROWS) -> LanguageModels:
    """Models of all languages in ``labelled``; n-grams are counted on the executors.

    What comes to the driver is the counted n-grams and the calibration texts' language
    scores, both bounded by the row parameters and the number of languages.
    """
    spark = labelled.sparkSession
    known = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = known.groupBy(F.col(lang).alias("lang")).count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(r["lang"] for r in sizes)
    names = ("lang", "k", "gram", "prefix", "suffix", "n")
    if not languages:
        return LanguageModels([], {c: np.zeros(0, np.uint64 if c in names[2:5] else np.int64)
                                   for c in names})
    share, second = {}, {}
    for r in sizes:
        share[r["lang"]] = min(0.8, rows / r["count"])
        second[r["lang"]] = min(1.0, share[r["lang"]] + max(0.2 * (rows >= r["count"]),
                                                            calibration_rows / r["count"]))
    pick = lambda d: F.create_map(*(F.lit(x) for kv in d.items() for x in kv))[F.col(lang)]
    low, high = pick(share), pick(second)
    sample = known.filter(_slice(F.col(doc_id), 0.0, low)).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = (sample.mapInArrow(
        _count(languages), "lang int, k int, gram long, prefix long, suffix long, n long")
        .groupBy("lang", "k", "gram").agg(F.first("prefix").alias("prefix"),
                                          F.first("suffix").alias("suffix"), F.sum("n").alias("n")))
    table = counted.select(*names).toArrow()
    counts = {c: table[c].to_numpy() for c in names}
    for c in ("gram", "prefix", "suffix"):
        counts[c] = counts[c].astype(np.int64).view(np.uint64)
    models = LanguageModels(languages, counts)
    shared, place = spark.sparkContext.broadcast(models), {x: i for i, x in enumerate(languages)}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in portions(texts, PORTION_CHARS):
                entropies, n = shared.value.entropies(texts[a:b])
                keep = np.flatnonzero(n > 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([place[langs[a + i]] for i in keep], pa.int32()),
                     pa.array(list(entropies[keep].astype(np.float64)),
                              pa.list_(pa.float64()))], ["truth", "entropies"])

    held = known.filter(_slice(F.col(doc_id), low, high)).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"))
    scored = held.mapInArrow(score, "truth int, entropies array<double>").toArrow()
    if scored.num_rows:
        models.calibrate(np.array(scored["entropies"].to_pylist()), scored["truth"].to_numpy())
    shared.unpersist()
    return models


RESULT = "lang_pred string, score double, cross_entropy double, rejected boolean"


def identify(docs: DataFrame, models: LanguageModels, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score``, ``cross_entropy`` and ``rejected``."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    @F.arrow_udf(RESULT)
    def run(column: pa.Array) -> pa.Array:
        names, scores, costs, rejected = shared.value.predict(
            [t or "" for t in column.to_pylist()])
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64()),
             pa.array(costs, pa.float64()), pa.array(rejected, pa.bool_())],
            ["lang_pred", "score", "cross_entropy", "rejected"])

    added = ("lang_pred", "score", "cross_entropy", "rejected")
    kept = [c for c in docs.columns if c not in added]
    name = free_name(docs, "language_")
    return docs.select(*kept, run(F.col(text)).alias(name)).select(
        *kept, *(F.col(f"{name}.{c}").alias(c) for c in added))
