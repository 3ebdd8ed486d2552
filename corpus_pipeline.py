"""Training-data pipeline over the documents table, one operator per stage.

Quality rules, exact duplicates, near duplicates, mixing of sources, encoding. Each stage
is written as Parquet and read again as the documents of the next one, so a lost executor
costs no more than the tasks of the running stage.

Parquet read in parts keeps no order, so the last stage has each document's slot and place
in the mix as columns, and run() gives its rows in that order.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from stopwise.llm import bpe_lexicon, digest_index, host_rules, mixing, ngram_join
from stopwise.llm.catalog import tokenizer_path
from stopwise.llm.tables import documents, keyed
from stopwise.session import stage

VOCABULARY = os.environ.get("CORPUS_VOCABULARY")    # a tokenizer file; None: the public one


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host is not rejected."""
    return host_rules.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document of the largest doc_id."""
    return digest_index.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document of the smallest doc_id."""
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix."""
    return mixing.interleave(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count, digests of the ids and of the decoded text, and place in the mix, per document.

    Places follow from hashes and sizes alone, so they are those of the mixing stage.
    """
    rows, tag = keyed(docs, "doc_id", "text", "encoded-rows")
    places = mixing.places_of(rows, tag).withColumnRenamed("row_tag", "row_tag_of")
    tokenizer = bpe_lexicon.BpeTokenizer(spark, VOCABULARY or tokenizer_path())
    tokenizer.fit_lexicon(docs.select("doc_id", "text"))
    coded = tokenizer.round_trip(rows.select("doc_id", "text", F.col(tag).alias("row_tag")),
                                 bpe_lexicon.DIGESTS, bpe_lexicon.digests)
    return coded.join(places, F.col("row_tag") == F.col("row_tag_of")).drop(
        "row_tag", "row_tag_of")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: SQL has no tokenizer; tests compare run() with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoded documents in the order of the mix."""
    docs = documents(spark, sf_dir)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs.orderBy("slot", "place").drop("slot", "place")
