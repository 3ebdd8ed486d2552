"""Brute-force versions and the rows with edge cases that the tests share."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # extra columns whose names the operators use as well
    T.StructField("row_tag", T.StringType()), T.StructField("kept", T.StringType()),
    T.StructField("ids", T.StringType()), T.StructField("n_words", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("shard", T.StringType())])

_WORDS = ("river stone garden window copper lantern meadow harbour thunder velvet winter "
          "saddle ribbon market needle forest candle mirror bridge anchor").split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(_WORDS) + str(rng.randrange(50)) for _ in range(n))


def edge_texts() -> list[str | None]:
    rng = random.Random(5)
    base = prose(rng, 120)
    near = base.replace("stone", "stane", 1)
    chain = prose(rng, 90)
    texts = [None, "", " \t\n ", "one", "one two three four", "one two three four five", "é" * 60,
             "!!! ??? ###", "word " * 80, "line one here\nline one here\n\nother line",
             base, base, near, f"{base} tail", chain, chain.upper(), "<|endoftext|> don't 's  x",
             "日本語 текст ١٢٣ 🙂 mixed", prose(rng, 20_000), "a" * 5000]
    for k in range(20):
        words = base.split()
        words[3 + 5 * k] = f"changed{k}"
        texts.append(" ".join(words))
    texts += [f"{prose(rng, 60)} {chain[:200]} {prose(rng, 40)}" for _ in range(6)]
    return texts


def rows() -> list[tuple]:
    texts = edge_texts()
    langs = ["en", "fr", None]
    out = [(k * 7 % 101 + 1, t, langs[k % 3], None if k % 9 == 8 else f"s{min(k % 5, 2)}", 1,
            "tag", "kept", "ids", "n", "score", "shard") for k, t in enumerate(texts)]
    out += [out[10], out[10], out[18]]                     # repeated rows
    out += [(None, texts[10], "en", "s0", 1) + out[0][5:], (None, None, None, None, None)
            + (None,) * 6]
    return out


def edge_docs(spark, given=None):
    return spark.createDataFrame(rows() if given is None else given, SCHEMA).repartition(3)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    w = words(text)
    grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    covered = {k + d for k, g in enumerate(grams) if grams.count(g) > 1 for d in range(3)} \
        if len(w) < 2000 else _covered(grams)
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered), failed)


def _covered(grams):
    seen = {}
    for k, g in enumerate(grams):
        seen.setdefault(g, []).append(k)
    return {k + d for places in seen.values() if len(places) > 1 for k in places for d in range(3)}


def shingles(text, n=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1)))


def classes(texts, threshold=0.8):
    """Class (as the smallest index) and number of links of every text."""
    sets = [shingles(t) for t in texts]
    head, links = list(range(len(texts))), [0] * len(texts)

    def find(k):
        while head[k] != k:
            k = head[k]
        return k

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if both >= threshold * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                    links[i] += 1
                    links[j] += 1
                    a, b = sorted((find(i), find(j)))
                    head[b] = a
    return [find(k) for k in range(len(texts))], links


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def cut_repeats(docs, width=50):
    """``(n_bytes, n_removed, n_spans, kept)`` of ``(doc_id, text)`` rows."""
    coded = [(d if d is not None else 1 << 63, (t or "").encode()) for d, t in docs]
    first = {}
    for d, b in coded:
        for k in range(len(b) - width + 1):
            g = b[k:k + width]
            first[g] = min(first.get(g, d), d)
    out = []
    for d, b in coded:
        gone = [False] * len(b)
        for k in range(len(b) - width + 1):
            if first[b[k:k + width]] < d:
                gone[k:k + width] = [True] * width
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out
