"""Near copies and repeated passages against brute force, and the whole pipeline."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from stopwise.llm import mixing, ngram_join, suffix_dedup
from stopwise.llm.components import components
from stopwise.llm.shingles import WORDS, shingle_sets

from .plain import SCHEMA, classes, cut_repeats, edge_docs, edge_texts, measures, prose, rows, sha, \
    shingles


def test_shingles_equal_plain_sets():
    texts = [t or "" for t in edge_texts()]
    got = shingle_sets(texts)
    seen = {}
    for text, s in zip(texts, got):
        want = shingles(text)
        assert len(s) == len(want) and (np.diff(s.astype(object)) > 0).all()
        seen.setdefault(frozenset(s.tolist()), want)
        assert seen[frozenset(s.tolist())] == want
    assert WORDS == 5


def test_bands_reach_the_recall():
    for recall in (0.9, 0.99, 0.999):
        bands, length = ngram_join.choose_bands(0.8, recall, 128)
        assert 1 - (1 - 0.8 ** length) ** bands >= recall and bands * length <= 128
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.8, 0.999999, 3)


@pytest.mark.parametrize("block", [512, 3])
def test_classes_match_brute_force(spark, block):
    given = rows()
    got = ngram_join.join_classes(edge_docs(spark).drop("row_tag"), block=block).collect()
    head, links = classes([r[1] for r in given])
    assert len(got) == len(given)
    want = []
    for k, r in enumerate(given):
        own = [given[j][0] for j in range(len(given)) if head[j] == head[k]]
        known = [x for x in own if x is not None]
        want.append((r[0], min(known, default=None), len(own), links[k]))
    assert Counter(tuple(r)[:4] for r in got) == Counter(want)
    assert sum(r["stays"] for r in got) == len(set(head))


def test_keep_one_keeps_columns(spark):
    kept = ngram_join.keep_one(edge_docs(spark))
    assert kept.columns == SCHEMA.names
    assert kept.count() == len(set(classes([r[1] for r in rows()])[0]))
    none = edge_docs(spark, [])
    assert ngram_join.keep_one(none).count() == 0 and ngram_join.join_classes(none).count() == 0


def test_components_of_long_chains(spark):
    rng = random.Random(9)
    names = list(range(120))
    rng.shuffle(names)
    edges = [(names[k], names[k + 1]) for k in range(99)] + [(names[100], names[101])]
    got = dict(components(spark.createDataFrame(edges, "a int, b int")).distinct().collect())
    assert {got[n] for n in names[:100]} == {min(names[:100])}
    assert got[names[100]] == got[names[101]] == min(names[100:102])
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_suffix_order():
    rng = random.Random(3)
    for _ in range(300):
        s = np.array([rng.choice([1, 2, 3][:rng.choice([1, 2, 3])])
                      for _ in range(rng.randrange(1, 60))])
        whole = suffix_dedup.suffix_order(s, 1000).tolist()
        assert whole == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        heads = [tuple(s[i:i + 5].tolist()) for i in suffix_dedup.suffix_order(s, 5)]
        assert heads == sorted(heads)


@pytest.mark.parametrize("options", [
    {}, {"hot_contexts": 1}, {"broadcast_anchors": 0, "broadcast_runs": 0}])
def test_repeats_match_brute_force(spark, options):
    given = [r for r in rows() if len(r[1] or "") < 20_000]
    rng = random.Random(7)
    passage = prose(rng, 40)
    for k in range(6):
        a, b = rng.randrange(60), rng.randrange(100, 200)
        given.append((500 + k, f"{prose(rng, 9)} é{passage[a:b]}é {prose(rng, 9)}") + given[0][2:])
    got = suffix_dedup.remove_repeats(edge_docs(spark, given), **options)
    assert got.columns == [c for c in SCHEMA.names if c != "kept"] + ["kept", "spans", "n_bytes"]
    want = cut_repeats([r[:2] for r in given])
    assert sum(w[1] for w in want) > 1000
    assert Counter((r["doc_id"], r["n_bytes"], sum(b - a for a, b in r["spans"]), len(r["spans"]),
                    bytes(r["kept"])) for r in got.collect()) \
        == Counter((r[0], *w) for r, w in zip(given, want))
    assert suffix_dedup.remove_repeats(edge_docs(spark, []), **options).count() == 0


def test_anchors_of_a_text_beyond_one_piece(monkeypatch):
    """Equal windows have equal anchors, wherever they stand."""
    text = prose(random.Random(2), 400).encode()
    h, own, low, high = suffix_dedup.anchors([text, b"x" * 77 + text])
    first = {k: int(a) for a, o, x, y in zip(h, own, low, high) if o == 0 for k in range(x, y + 1)}
    second = {k - len(text) - 77: int(a) for a, o, x, y in zip(h, own, low, high) if o == 1
              for k in range(x, y + 1)}
    assert len(first) == len(text) - 49 and all(second[k] == a for k, a in first.items())


def test_pipeline_matches_a_plain_version(spark, tmp_path):
    given = [r[:5] for r in rows()]
    rng = random.Random(12)
    for k in range(40):
        text = prose(rng, 70)
        given += [(300 + 3 * k, text, "en", f"s{k % 3}", 1), (301 + 3 * k, text, "en", "s1", 1),
                  (302 + 3 * k, text + " end", "en", "s2", 1)]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, "
                                        "n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    good = [r for r in given if not measures(r[1])[-1]]
    last = {}
    for r in good:
        if r[1] not in last or (r[0] or -1) > (last[r[1]][0] or -1):
            last[r[1]] = r
    single = list(last.values())
    head, _ = classes([r[1] for r in single])
    stays = {}
    for h, r in zip(head, single):
        if h not in stays or (r[0] is None, r[0]) < (stays[h][0] is None, stays[h][0]):
            stays[h] = r
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in stays.values():
        ids = library.encode(r[1], add_special_tokens=False).ids
        want.append((r[0], len(ids), sha(",".join(map(str, ids))), sha(r[1])))
    assert sorted(tuple(r) for r in got) == sorted(want)
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, str(tmp_path)).columns == columns, name


def test_pipeline_gives_the_order_of_the_mix(spark, tmp_path):
    """Three sources of several blocks, in the slots of the Pfair period."""
    rng = random.Random(21)
    given = [(k, prose(rng, 700), "en", f"s{min(k % 7, 2)}", 1) for k in range(350)]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, "
                                        "n_chars long").repartition(5)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(r[0] for r in given)
    size = Counter()
    for r in given:
        size[f"s:{r[3]}"] += len(r[1])
    weights = mixing.whole_quanta({s: n ** mixing.EXPONENT for s, n in size.items()})
    slots = {(s, j): slot for s, j, slot in mixing.pfair_period(weights)}
    key = {r[0]: int(hashlib.md5(str(r[0]).encode()).hexdigest()[:15], 16) for r in given}
    want, start = [], Counter()
    for r in sorted(given, key=lambda r: key[r[0]]):
        s = f"s:{r[3]}"
        want.append((slots[s, start[s] // mixing.BLOCK_CHARS], key[r[0]], r[0]))
        start[s] += len(r[1])
    assert len({w[0] for w in want}) > 10
    assert got == [w[2] for w in sorted(want)]
    last = corpus_pipeline.encode(spark, docs, str(tmp_path))
    assert last.columns[-2:] == ["slot", "place"]
    assert [r["doc_id"] for r in last.orderBy("slot", "place").collect()] == got


@pytest.mark.parametrize("gram", [18, 19, 20])
def test_contexts_that_share_a_window_are_sorted(gram):
    """None of them is left out of the suffix sort, and most others are."""
    rng = random.Random(gram)
    passage = "".join(rng.choice("abcdefgh") for _ in range(300))
    texts = []
    for _ in range(60):
        a = rng.randrange(240)
        cut = passage[a:a + rng.randrange(20, 110)]
        texts.append("".join(rng.choice("xyz") for _ in range(60)).encode() + cut.encode()
                     + "".join(rng.choice("uvw") for _ in range(60)).encode())
    h, _, low, high = suffix_dedup.anchors(texts, 50, gram)
    joined = b"".join(texts)
    rows = sorted({(int(a), joined[x:y + 50]) for a, x, y in zip(h.view(np.int64), low, high)})
    contexts = [c for _, c in rows]
    marked = suffix_dedup._may_share(contexts, np.array([a for a, _ in rows]), 50, gram)
    windows = [{c[i:i + 50] for i in range(len(c) - 49)} for c in contexts]
    seen = Counter(w for own in windows for w in own)
    shares = np.array([any(seen[w] > 1 for w in own) for own in windows])
    assert shares.sum() > 20 and marked[shares].all()
    assert (~marked).sum() > 20


def test_anchors_do_not_depend_on_blocks(monkeypatch):
    texts = [prose(random.Random(k), 300).encode() for k in range(6)]
    whole = suffix_dedup.anchors(texts)
    monkeypatch.setattr(suffix_dedup, "BLOCK_PLACES", 256)
    for a, b in zip(whole, suffix_dedup.anchors(texts)):
        assert a.tolist() == b.tolist()
