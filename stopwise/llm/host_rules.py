"""Quality rules per document, and verdicts on hosts with shrunken failure rates.

Words are runs of ``[^\\x20\\x09-\\x0D]``. A null text counts as empty. A document fails the
base rules with fewer than 50 words, or with more than half of its words in three-word
windows that the text holds twice or more. Repeated rows are judged like any others. A null
host shares no verdict: its documents stand for themselves.

Windows are found again by a 64-bit hash whose lowest bits give way to the position, so
that one sort of longs per document groups them; a chance meeting of two different windows
needs equal hashes of about 64 - log2(words) bits.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .tables import free_name, without

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.75

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SPACE = r"[ \t-\r]+"
_WINDOWS = """
    slice(zip_with(zip_with(h, slice(h, 2, n), (x, y) -> xxhash64(x, y)),
                   slice(h, 3, n), (x, y) -> xxhash64(x, y)), 1, n - 2)"""
_SORTED = """
    sort_array(transform(g, (x, i) -> shiftleft(shiftrightunsigned(x, b), b) | i))"""
# neighbours of equal hash, as (earlier, later) positions
_TWINS = """
    filter(zip_with(slice(s, 1, n - 3), slice(s, 2, n - 3), (x, y) ->
               IF(shiftrightunsigned(x ^ y, b) = 0, struct(x, y), NULL)),
           v -> v IS NOT NULL)"""
_STARTS = """
    sort_array(array_union(transform(p, v -> v.x & (shiftleft(1L, b) - 1)),
                           transform(p, v -> v.y & (shiftleft(1L, b) - 1))))"""
_COVERED = """
    aggregate(transform(q, (x, k) -> least(3L, coalesce(get(q, k + 1) - x, 3L))),
              0L, (a, x) -> a + x)"""


def score_documents(docs: DataFrame, text: str | F.Column = "text") -> DataFrame:
    """Add the five measures and ``base_failed``; columns of these names are replaced."""
    text = F.col(text) if isinstance(text, str) else text
    kept = [c for c in docs.columns if c not in (*MEASURES, "base_failed")]
    names = {k: free_name(docs, f"r_{k}") for k in "tlwnbhgspq"}

    def of(sql: str) -> F.Column:
        """The one-letter names of the expressions above, as columns."""
        return F.expr(re.sub(r"(?<![\w.])([tlwnbhgspq])(?![\w(])",
                             lambda m: f"`{names[m[1]]}`", sql))

    none = "CAST(array() AS array<bigint>)"
    t, w, lines = (F.col(names[k]) for k in "twl")
    out = docs.select(*kept, F.coalesce(text, F.lit("")).alias(names["t"]))
    out = out.select(
        *kept,
        F.split(F.btrim(t, F.lit(" \t\n\x0b\f\r")), _SPACE).alias(names["w"]),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^ \t-\r]")).alias(names["l"]),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"))
    # the text without words splits into one empty string
    out = out.withColumn(names["n"], F.when(F.get(w, 0) == "", 0).otherwise(F.size(w)))
    out = out.select(
        *kept, names["n"], "n_symbols",
        F.length(F.bin(names["n"])).alias(names["b"]),     # bits that a position needs
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        of(f"IF(n < 4, {none}, transform(w, x -> xxhash64(x)))").alias(names["h"]))
    out = out.withColumn(names["g"], of(f"IF(n < 4, {none}, {_WINDOWS})")).drop(names["h"])
    # most texts hold no window twice and are done here
    out = out.withColumn(names["s"], of(
        f"IF(size(array_distinct(g)) = size(g), {none}, {_SORTED})")).drop(names["g"])
    out = out.withColumn(names["p"], of(
        f"IF(size(s) = 0, CAST(array() AS array<struct<x: bigint, y: bigint>>), {_TWINS})"))
    out = out.withColumn(names["q"], of(_STARTS))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.select(
        *kept, F.col(names["n"]).cast("long").alias("n_words"), "word_chars", "n_symbols",
        "n_dup_lines", of(_COVERED).alias("n_repeat_words")).withColumn("base_failed", failed)


def host_verdicts(scored: DataFrame, host: str = "source",
                  max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: documents, failures, shrunken failure rate, verdict.

    The beta prior is fitted by the moments of beta-binomial counts: its mean is the pooled
    rate m, and of the spread v of K hosts' rates over N documents the part that chance alone
    makes is taken off, rho = (v N / (m (1 - m)) - K) / (N - K) within 0 and 1, strength = 1 / rho - 1.
    Where rho is 0 or unknown, as with one document a host, every host gets the pooled rate.
    """
    hosts = (scored.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host"))
             .agg(F.count("*").alias("n_docs"),
                  F.sum(F.col("base_failed").cast("long")).alias("n_failed")))
    mean = F.sum("n_failed") / F.sum("n_docs")
    # sum of n (r - m)^2 over sum of n, from sums over hosts
    spread = F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")) / F.sum("n_docs") \
        - mean * mean
    prior = hosts.agg(mean.alias("m"), spread.alias("v"), F.sum("n_docs").alias("all_docs"),
                      F.count("*").alias("hosts")).select("m", F.when(
        (F.col("m") * (1 - F.col("m")) > 0) & (F.col("all_docs") > F.col("hosts")),
        (F.col("v") * F.col("all_docs") / (F.col("m") * (1 - F.col("m"))) - F.col("hosts"))
        / (F.col("all_docs") - F.col("hosts"))).otherwise(0.0).alias("rho"))
    out = hosts.withColumn("m", prior.select("m").scalar()).withColumn(
        "rho", prior.select("rho").scalar())
    strength = F.greatest(F.lit(0.0), 1 / F.col("rho") - 1)
    rate = F.when(F.col("rho") <= 1e-12, F.col("m")).otherwise(
        (F.col("n_failed") + F.col("m") * strength) / (F.col("n_docs") + strength))
    return (out.withColumn("host_rate", F.round(rate, 9)).drop("m", "rho")
            .withColumn("host_failed", F.col("host_rate") > max_rate))


def apply_verdicts(scored: DataFrame, hosts: DataFrame, host: str = "source") -> DataFrame:
    """Join host verdicts back: ``host_failed`` and ``kept`` for every document.

    Only failed hosts take part in the join, so the side that Spark may broadcast or
    must shuffle is the short list of them.
    """
    scored = scored.drop("host_failed", "kept")
    key = free_name(scored, "failed_host")
    failed = hosts.filter("host_failed").select(F.col("host").alias(key))
    return (scored.join(failed, scored[host] == F.col(key), "left")
            .withColumn("host_failed", F.col(key).isNotNull())
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
            .drop(key))


def judge(docs: DataFrame, text: str | F.Column = "text", host: str = "source",
          max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Measures, host verdicts and ``kept`` for every row of ``docs``; all columns but the
    text, which is read here only, stay."""
    scored = score_documents(docs, text)
    if isinstance(text, str):
        scored = scored.drop(text)
    scored = stage(scored, "quality")
    return apply_verdicts(scored, host_verdicts(scored, host, max_rate), host)


def keep_good(docs: DataFrame, text: str = "text", host: str = "source",
              max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows that pass, with the columns of ``docs``, whatever their names."""
    narrow = docs.select(docs[text].alias("text"), docs[host].alias("source"))
    hosts = host_verdicts(score_documents(narrow).drop("text"), max_rate=max_rate)
    failed = stage(hosts.filter("host_failed").select("host"), "failed-hosts")
    # the texts are measured again rather than written with their measures
    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"),
                         docs[host].alias("source"))
    # a filter below the explode would take the measures' steps apart and repeat them
    scored = score_documents(packed, F.col("row")[text]).select(
        "row", "source", F.explode(F.array("base_failed")).alias("failed"))
    return without(scored.filter("NOT failed"), "source", failed).select("row.*")
