"""The registered queries of this subpackage: thin forms of its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import new_folder
from . import (bpe_lexicon, digest_index, hard_negatives, host_rules, html_density, language_lm,
               mixing, ngram_join, packing, sharding, suffix_dedup, toxicity,
               turn_trie)
from .tables import documents

Query = Callable[[SparkSession, str], DataFrame]

_ALL: dict[str, Query] = {}


TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def query(fn: Query) -> Query:
    _ALL[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_ALL)


@query
def op1_host_rules(spark, sf):
    judged = host_rules.judge(documents(spark, sf).select("doc_id", "source", "text"))
    return judged.select("doc_id", *host_rules.MEASURES, "base_failed", "host_failed", "kept")


@query
def op2_html_density(spark, sf):
    pages = spark.read.parquet(f"{sf.rstrip('/')}/pages.parquet").select("page_id", "url", "html")
    return html_density.extract(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op3_digest_index(spark, sf):
    index = digest_index.DigestIndex.create(spark, new_folder(spark, "digest-index"))
    return digest_index.find_duplicates(documents(spark, sf), index)


def _remainder(n: int) -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query
def op4_kneser_ney(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text", "lang")
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False))
    models = language_lm.fit(docs.filter(~held_out))
    return language_lm.identify(docs.select("doc_id", "text"), models).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


@query
def op5_bpe_lexicon(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    tokenizer = bpe_lexicon.BpeTokenizer(spark, tokenizer_path())
    tokenizer.fit_lexicon(docs)
    return tokenizer.round_trip(docs, bpe_lexicon.DIGESTS, bpe_lexicon.digests)


@query
def op6_subword_toxicity(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf.rstrip('/')}/labels.parquet").select("doc_id", "toxic")
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    model = toxicity.fit(docs, labels.filter(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op7_ngram_join(spark, sf):
    return ngram_join.join_classes(documents(spark, sf).select("doc_id", "text")).drop("stays")


@query
def op8_suffix_dedup(spark, sf):
    cut = suffix_dedup.remove_repeats(documents(spark, sf).select("doc_id", "text"))
    return cut.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_pfair_mix(spark, sf):
    return mixing.mix(documents(spark, sf)).drop("row_tag")


@query
def op10_extendible_shards(spark, sf):
    return sharding.assign_shards(documents(spark, sf))


@query
def op11_turn_trie(spark, sf):
    given = spark.read.parquet(f"{sf.rstrip('/')}/conversations.parquet")
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    turns, convs = turn_trie.with_shared_heads(*turn_trie.number_turns(given), 5, head, 8)
    nodes = turn_trie.with_end_digests(*turn_trie.prefix_trie(turns, convs))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                        "saved_tokens", "ends_sha256")


WORD_TOKENIZER = "word_bpe_49k.json"


@query
def op12_best_fit_packing(spark, sf):
    pieces = packing.cut_pieces(documents(spark, sf).select("doc_id", "text"),
                                tokenizer_path(WORD_TOKENIZER))
    return packing.Plan(pieces).place(pieces.select(
        "part", "nth", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


@query
def op13_hard_negatives(spark, sf):
    rows = spark.read.parquet(f"{sf.rstrip('/')}/embeddings.parquet").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
        .otherwise(F.col("label")).alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
