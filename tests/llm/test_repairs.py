"""Repeated batches and rows, columns named like the operators' own, odd targets, small hosts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from stopwise.llm import digest_index, host_rules, language_lm, mixing, ngram_join, sharding
from stopwise.session import new_folder

from .plain import SCHEMA, edge_docs, prose, rows


def verdicts(df):
    return sorted(map(str, (tuple(r) for r in df.select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())))


def test_a_batch_that_runs_again_keeps_the_same_rows(spark):
    index = digest_index.DigestIndex.create(spark, new_folder(spark, "index"), 3)
    first = verdicts(digest_index.find_duplicates(edge_docs(spark), index, batch="one"))
    again = verdicts(digest_index.find_duplicates(edge_docs(spark).repartition(5), index, batch="one"))
    assert again == first and any(", True, " in r for r in first)
    other = digest_index.find_duplicates(edge_docs(spark), index, batch="two")
    assert other.filter("kept").count() == 0


def test_a_batch_that_died_after_a_part_was_added(spark):
    index = digest_index.DigestIndex.create(spark, new_folder(spark, "index"), 3)
    whole = digest_index.DigestIndex.create(spark, new_folder(spark, "index"), 3)
    want = verdicts(digest_index.find_duplicates(edge_docs(spark), whole, batch="one"))
    digest_index.find_duplicates(edge_docs(spark, rows()[:12]), index, batch="one")
    assert verdicts(digest_index.find_duplicates(edge_docs(spark), index, batch="one")) == want
    kept = digest_index.drop_duplicates(edge_docs(spark), index, batch="one")
    assert kept.count() == sum(", True, " in r for r in want)


def test_deduplicating_alone_leaves_no_table_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    assert digest_index.drop_duplicates(edge_docs(spark)).count() > 0
    assert {t.name for t in spark.catalog.listTables()} == before


def test_write_shards_with_repeated_ids_and_rows(spark):
    docs = spark.createDataFrame([(1, "a" * 90), (1, "a" * 90), (1, "b" * 70), (None, None), (None, "c")],
                                 "doc_id long, text string")
    path = new_folder(spark, "shards")
    sharding.write_shards(docs, path, 100)
    written = spark.read.parquet(path)
    assert Counter((r["doc_id"], r["text"]) for r in written.collect()) == Counter(
        (r["doc_id"], r["text"]) for r in docs.collect())
    path = new_folder(spark, "shards")
    sharding.write_shards(edge_docs(spark), path, 3000)
    assert spark.read.parquet(path).count() == len(rows())


@pytest.mark.parametrize("targets", [{"s0": 1.0}, {"s0": 0.0, "s1": 0.0}, {}, {"s1": -3.0, None: 2.0}])
@pytest.mark.parametrize("direct", [1000, 1])
def test_mix_with_missing_zero_and_negative_targets(spark, targets, direct):
    got = mixing.mix(edge_docs(spark), targets=targets, block_chars=500, chunk_rows=2,
                     direct_sources=direct).collect()
    assert len({(r["slot"], r["place"]) for r in got}) == len(got) == len(rows())


def test_users_column_row_tag_is_theirs(spark):
    docs = edge_docs(spark)          # has a text column row_tag, the same in every row
    assert len(SCHEMA.names) > 5 and docs.select("row_tag").distinct().count() <= 2
    got = mixing.mix(docs, block_chars=500).collect()
    assert len({r["row_tag"] for r in got}) == len(rows())
    classes = ngram_join.join_classes(docs)
    assert classes.count() == len(rows()) and "row_tag" not in classes.columns
    assert ngram_join.keep_one(docs).columns == SCHEMA.names
    assert mixing.interleave(docs).columns == SCHEMA.names


def test_users_column_language_(spark):
    docs = spark.createDataFrame([(k, "tha ing er " * 5, "aa", "mine") for k in range(20)],
                                 "doc_id long, text string, lang string, language_ string")
    got = language_lm.identify(docs, language_lm.fit(docs))
    assert got.columns[:4] == docs.columns and got.filter("language_ = 'mine'").count() == 20


def _hosts(spark, given):
    scored = spark.createDataFrame(given, "source string, base_failed boolean")
    return {r["host"]: r for r in host_rules.host_verdicts(scored).collect()}


def test_hosts_of_one_document_get_the_pooled_rate(spark):
    found = _hosts(spark, [(f"h{k}", k < 300) for k in range(1000)])
    assert {r["host_rate"] for r in found.values()} == {0.3}
    assert not any(r["host_failed"] for r in found.values())


def test_small_hosts_are_shrunk_towards_the_pooled_rate(spark):
    given = [(f"good{k}", j % 10 == 0) for k in range(20) for j in range(50)]
    given += [(f"bad{k}", j % 10 != 0) for k in range(5) for j in range(50)] + [("tiny", True), ("pair", True), ("pair", True)]
    found = _hosts(spark, given)
    pooled = sum(f for _, f in given) / len(given)
    assert pooled < found["tiny"]["host_rate"] < found["pair"]["host_rate"] < 1
    assert found["bad0"]["host_failed"] and not found["good0"]["host_failed"]
    assert abs(found["bad0"]["host_rate"] - 0.9) < 0.03


def test_hosts_that_all_pass_or_all_fail(spark):
    for verdict, rate in ((False, 0.0), (True, 1.0)):
        found = _hosts(spark, [(f"h{k % 3}", verdict) for k in range(30)])
        assert {r["host_rate"] for r in found.values()} == {rate}
    assert _hosts(spark, [(None, True)]) == {}


def test_chance_alone_is_not_taken_for_a_difference(spark):
    """Hosts that differ no more than chance makes them are shrunk far."""
    given = [(f"h{k}", (j * 7 + k * 3) % 10 < 3) for k in range(50) for j in range(10)] + [("odd", True)] * 3
    found = _hosts(spark, given)
    assert not found["odd"]["host_failed"]
