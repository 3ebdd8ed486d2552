"""Quality rules, digest index, sharding and mixing: edge rows and brute force."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from stopwise.llm import digest_index, host_rules, mixing, sharding
from stopwise.session import new_folder

from .plain import SCHEMA, edge_docs, measures, prose, rows, sha


def test_measures_match_brute_force(spark):
    got = host_rules.score_documents(edge_docs(spark)).select(
        "doc_id", "text", *host_rules.MEASURES, "base_failed").collect()
    assert len(got) == len(rows())
    for r in got:
        assert tuple(r)[2:] == measures(r["text"]), r["doc_id"]


def test_failing_host_is_rejected_and_small_host_is_shrunk(spark):
    good = " ".join(f"w{k}" for k in range(60))
    given = [(k, good if k % 5 else "bad", f"h{k % 4}") for k in range(400)]
    given += [(1000 + k, "bad" if k % 20 else good, "spam") for k in range(200)]
    given += [(2000, "bad", "tiny"), (2001, good, None), (2002, None, None)]
    docs = spark.createDataFrame(given, "doc_id long, text string, source string")
    scored = host_rules.score_documents(docs)
    hosts = {r["host"]: r for r in host_rules.host_verdicts(scored).collect()}
    assert hosts["spam"]["host_failed"] and not hosts["h0"]["host_failed"]
    assert 0.3 < hosts["tiny"]["host_rate"] < 1.0 and None not in hosts
    judged = {r["doc_id"]: r for r in host_rules.judge(docs).collect()}
    assert len(judged) == len(given)
    assert not any(r["kept"] for r in judged.values() if r["source"] == "spam")
    assert judged[1]["kept"] and judged[2001]["kept"] and not judged[2002]["kept"]
    kept = host_rules.keep_good(edge_docs(spark))
    assert kept.columns == SCHEMA.names
    assert all(not measures(r["text"])[-1] for r in kept.collect())


def test_empty_tables(spark):
    none = edge_docs(spark, [])
    assert host_rules.judge(none).count() == 0 and host_rules.keep_good(none).count() == 0
    index = digest_index.DigestIndex.create(spark, new_folder(spark, "index"), 3)
    assert digest_index.find_duplicates(none, index).count() == 0
    assert sharding.assign_shards(none).count() == 0
    assert mixing.mix(none).count() == 0 and mixing.interleave(none).count() == 0


def test_digest_index_over_batches(spark):
    path = new_folder(spark, "index")
    index = digest_index.DigestIndex.create(spark, path, 3)
    got = digest_index.find_duplicates(edge_docs(spark), index).collect()
    assert len(got) == len(rows())
    groups = defaultdict(list)
    for r in rows():
        groups[sha(r[1] or "")].append(r[0])
    for r in got:
        own = groups[r["text_sha256"]]
        assert r["group_size"] == len(own)
        assert r["keep_id"] == max((x for x in own if x is not None), default=None)
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == dict.fromkeys(groups, 1)
    index.close()
    later = digest_index.DigestIndex.open(spark, path)
    again = digest_index.drop_duplicates(edge_docs(spark), later)
    assert again.count() == 0 and again.columns == SCHEMA.names
    fresh = spark.createDataFrame([(1, "new"), (2, "new"), (3, "")], "doc_id long, text string")
    small = later.compact(new_folder(spark, "index"))
    assert small.table().count() == len(groups)
    assert [r["doc_id"] for r in digest_index.drop_duplicates(fresh, small).collect()] == [2]
    plan = small.table().hint("merge").join(small.table().hint("merge"), "digest") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_kept_rows_once(spark):
    kept = digest_index.drop_duplicates(edge_docs(spark)).collect()
    assert Counter(sha(r["text"] or "") for r in kept) == Counter(
        {sha(r[1] or ""): 1 for r in rows()})


def test_shards_fit_and_cover(spark):
    limit = 3000
    got = sharding.assign_shards(edge_docs(spark), limit, spare_bits=1).collect()
    assert len(got) == len(rows())
    docs, size = Counter(r["shard"] for r in got), Counter()
    text_of = defaultdict(list)
    for r in rows():
        text_of[r[0]].append(len((r[1] or "").encode()))
    for r in got:
        assert len(r["shard"]) == r["depth"] and r["shard_docs"] == docs[r["shard"]]
        assert r["shard_bytes"] <= limit or r["shard_docs"] == 1
        size[r["shard"]] = r["shard_bytes"]
    assert sum(size.values()) == sum(len((r[1] or "").encode()) for r in rows())
    shards = sorted(docs)
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:]))     # a prefix code


def test_equal_rows_are_split_by_row(spark):
    docs = spark.range(1).select(F.lit(5).cast("long").alias("doc_id"), F.lit("x" * 100).alias("text"))
    for _ in range(5):
        docs = docs.union(docs)
    got = sharding.assign_shards(docs, 500).collect()
    assert len(got) == 32 and all(r["shard_bytes"] <= 500 for r in got)


def test_write_shards(spark):
    path = new_folder(spark, "shards")
    docs = spark.createDataFrame([(k, "y" * 50) for k in range(40)], "doc_id long, text string")
    directory = sharding.write_shards(docs, path, 400)
    written = spark.read.parquet(path)
    assert written.count() == 40 and directory.count() == written.select("shard").distinct().count()


def test_pfair_period_deviates_less_than_one_block():
    rng = random.Random(2)
    for _ in range(60):
        shares = {f"s{k}": rng.random() ** 3 for k in range(rng.randrange(1, 12))}
        weights = mixing.whole_quanta(shares, 60)
        assert sum(weights.values()) == 60 and min(weights.values()) >= 1
        done = Counter()
        for source, block, slot in mixing.pfair_period(weights):
            assert block == done[source]
            done[source] += 1
            assert all(abs(done[s] * 60 - w * (slot + 1)) < 60 for s, w in weights.items())
        assert done == weights


def test_mix_places_every_row(spark):
    got = mixing.mix(edge_docs(spark).drop("row_tag"), block_chars=500, chunk_rows=2).collect()
    assert len(got) == len(rows())
    assert len({(r["slot"], r["place"]) for r in got}) == len(rows())
    slot_of = {}
    for r in got:
        assert slot_of.setdefault(r["slot"], (r["source"], r["block"])) == (r["source"], r["block"])
    assert {r["source"] for r in got} == {r[3] for r in rows()}


def test_mix_follows_given_weights(spark):
    rng = random.Random(4)
    given = [(k, prose(rng, 20), "big" if k % 3 else "small") for k in range(900)]
    docs = spark.createDataFrame(given, "doc_id long, text string, source string")
    out = mixing.interleave(docs, targets={"big": 0.25, "small": 0.75}, block_chars=400)
    assert out.columns == docs.columns and out.count() == 900
    first = out.limit(200).collect()
    assert abs(sum(r["source"] == "small" for r in first) / 200 - 0.75) < 0.05


def _sources(n, blocks):
    """``blocks`` blocks of one source, and one each of ``n`` others."""
    given = [(k, "x" * 10, "big") for k in range(blocks)]
    return given + [(10_000 + k, "y" * 10, f"h{k}") for k in range(n)]


def test_mix_of_more_sources_than_quanta(spark):
    given = _sources(2600, 700)
    docs = spark.createDataFrame(given, "doc_id long, text string, source string").repartition(8)
    targets = {s: 0.5 if s == "big" else 0.5 / 2600 for _, _, s in given}
    got = mixing.mix(docs, targets=targets, block_chars=10).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in given)
    assert len({r["slot"] for r in got}) == len(given) and {r["place"] for r in got} == {1}
    share = 0.5 * 49 / 50 + 0.5 / 50 / 6       # the quantum each has goes evenly over groups
    for r in got:
        if r["source"] == "big":
            assert abs((r["slot"] + 0.5) * share - r["block"] - 0.5) < 0.05 * r["block"] + 2
    early = sum(r["slot"] < 650 for r in got if r["source"] != "big")
    assert 0.6 * 325 < early < 1.4 * 325       # the small ones are spread, not left to the end
    assert mixing.mix(docs, block_chars=10).count() == len(given)


def test_weights_hold_with_nearly_as_many_sources_as_quanta(spark):
    given = _sources(980, 400)
    docs = spark.createDataFrame(given, "doc_id long, text string, source string").repartition(8)
    targets = {s: 0.5 if s == "big" else 0.5 / 980 for _, _, s in given}
    got = mixing.mix(docs, targets=targets, block_chars=10).collect()
    assert len(got) == len(given)
    for r in got:
        if r["source"] == "big":
            assert abs(r["slot"] * 0.49 - r["block"]) < 0.02 * r["block"] + 2


def test_few_sources_keep_the_given_period():
    assert [mixing.period_slots(n) for n in (1, 20, 50, 51, 1000)] == [
        1000, 1000, 1000, 2550, 50_000]
