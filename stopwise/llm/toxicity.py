"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of itself and its character n-grams, each hashed to a row of one
embedding table; a text is the average of its words' bags; a linear softmax over the
average gives the label. Table and softmax are trained together in numpy on a bounded
sample of labelled rows. A misspelling shares most n-grams with the word it hides, and so
its vector.

Averages shrink with the length of a text, so the softmax sees the average scaled by the
square root of the number of words. Words are runs of letters and digits in lower case.

Null and empty texts are scored by the bias alone. Repeated rows are scored alike. A label
other than 0 and 1, or null, teaches nothing. Without labels of both kinds every score is
the share of toxic rows, or 0 without any label.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

TRAIN_ROWS = 2500            # labelled rows of each label to fit on, at most about
BUCKETS = 1 << 17
DIMENSION = 8
GRAMS = (3, 5)
EPOCHS = 6
RATE = 0.5
HELD_WORDS = 1 << 19

_WORD = re.compile(r"[^\W_]+")
_P = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def subwords(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the bags of all words, one bag after another, and where each bag ends.

    All bags are made together: a word is a run of code points between two marks, and for
    every length the n-grams within each run are hashed in one go.
    """
    marked = [f"<{w}>" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    ends = np.cumsum(lengths)
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"),
                          np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(ends, lengths) - np.arange(len(chars))     # characters to the word's end
    owners, rows = [], []
    with np.errstate(over="ignore"):
        h = np.zeros(len(chars), np.uint64)
        for k in range(1, GRAMS[1] + 1):
            h = h[:len(chars) - k + 1] if k > 1 else h
            h = h * _P + chars[k - 1:] + np.uint64(1)
            if k >= GRAMS[0]:
                at = np.flatnonzero(left[:len(h)] >= k)
                owners.append(word[at])
                rows.append(h[at] * _MIX + np.uint64(k))
        # the whole word, by a sum over its characters and their places
        place = lengths[word] - left
        whole = np.zeros(len(words), np.uint64)
        np.add.at(whole, word, (chars + np.uint64(7)) * (
            (place.astype(np.uint64) * _MIX) | np.uint64(1)))
        owners.append(np.arange(len(words)))
        rows.append(whole * _MIX)
    owner = np.concatenate(owners)
    row = ((np.concatenate(rows) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return row[order], np.cumsum(np.bincount(owner, minlength=len(words)))


class ToxicityModel:
    """Embedding table and softmax; scores fold both into one number per word."""

    def __init__(self, table: np.ndarray, softmax: np.ndarray, bias: np.ndarray) -> None:
        self.weight = (table @ (softmax[1] - softmax[0])).astype(np.float32)
        self.bias = float(bias[1] - bias[0])
        self._known: dict[str, float] = {}

    @classmethod
    def train(cls, texts: list[str], labels: np.ndarray, prior: float | None = None,
              epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> ToxicityModel:
        """``prior``: share of toxic rows where the sample is drawn by label."""
        share = float(labels.mean()) if len(labels) else 0.0
        prior = share if prior is None else prior
        rng = np.random.default_rng(seed)
        table = rng.normal(0, 0.05, (BUCKETS, DIMENSION)).astype(np.float32)
        softmax = rng.normal(0, 0.5, (2, DIMENSION)).astype(np.float32)
        bias = np.zeros(2, np.float32)
        if not len(labels) or share in (0.0, 1.0):
            bias[1] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
            return cls(table * 0, softmax, bias)
        bags = cls._bags(texts)
        # rows of either label weigh as much as they do among all labelled rows
        weight = np.where(labels == 1, prior / share, (1 - prior) / (1 - share))
        table_sq = np.full(BUCKETS, 1e-6, np.float32)
        softmax_sq, bias_sq = np.full_like(softmax, 1e-6), np.full_like(bias, 1e-6)
        for epoch in range(epochs):
            step = rate * (1 - epoch / epochs)
            for i in rng.permutation(len(labels)):
                rows, part = bags[i]
                mean = part @ table[rows]
                score = softmax @ mean + bias
                p = np.exp(score - score.max())
                p /= p.sum()
                p[labels[i]] -= 1
                g = (p * weight[i]).astype(np.float32)
                back = g @ softmax
                bias_sq += g * g
                bias -= step * g / np.sqrt(bias_sq)
                gs = np.outer(g, mean)
                softmax_sq += gs * gs
                softmax -= step * gs / np.sqrt(softmax_sq)
                if len(rows):
                    table_sq[rows] += part * part * float(back @ back) / DIMENSION
                    table[rows] -= (step * part / np.sqrt(table_sq[rows]))[:, None] * back
        return cls(table, softmax, bias)

    @staticmethod
    def _bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for text in texts:
            counted = Counter(words_of(text))
            rows, ends = subwords(list(counted))
            sizes = np.diff(ends, prepend=0)
            n = np.fromiter(counted.values(), np.float64, len(counted))
            part = np.repeat(n / np.maximum(sizes, 1), sizes) / np.sqrt(max(n.sum(), 1))
            unique, at = np.unique(rows, return_inverse=True)
            out.append((unique, np.bincount(at, part, len(unique)).astype(np.float32)))
        return out

    def _learn(self, words: set[str]) -> None:
        if len(self._known) > HELD_WORDS:
            self._known.clear()
        fresh = [w for w in words if w not in self._known]
        if fresh:
            rows, ends = subwords(fresh)
            sums = np.add.reduceat(self.weight[rows].astype(np.float64),
                                   np.concatenate([[0], ends[:-1]]))
            self._known.update(zip(fresh, (sums / np.diff(ends, prepend=0)).tolist()))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            words = words_of(text)
            self._learn(set(words))
            total = sum(map(self._known.__getitem__, words))
            out[i] = self.bias + total / np.sqrt(max(len(words), 1))
        return 1 / (1 + np.exp(-np.clip(out, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Train on about ``rows`` labelled rows of either label, drawn by a hash of the doc_id.

    The sample is drawn from the labels alone; only its texts are fetched, and only they
    come to the driver.
    """
    known = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("labelled_id")).agg(
        F.max(label).alias("label"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    part = F.pmod(F.xxhash64("labelled_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = known.filter(
        ((F.col("label") == 1) & (part < min(1.0, rows / max(sizes.get(1, 0), 1))))
        | ((F.col("label") == 0) & (part < min(1.0, rows / max(sizes.get(0, 0), 1)))))
    given = docs.select(F.col(doc_id).alias("labelled_id"), F.col(text).alias("text"))
    # the sample has about 2 * rows ids at any size of the labels
    got = given.join(F.broadcast(sample), "labelled_id").select("text", "label", "labelled_id") \
        .orderBy("labelled_id", "text").toArrow()
    total = sum(sizes.values())
    return ToxicityModel.train(got["text"].to_pylist(), got["label"].to_numpy().astype(np.int64),
                               sizes.get(1, 0) / total if total else 0.0)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Add ``score`` and ``predicted``; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(column.to_pylist()), pa.float64())

    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*kept, run(F.col(text)).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
