"""Prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F, types as T

from stopwise.llm import turn_trie as tt

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("digest", T.StringType()), T.StructField("depth", T.StringType()),
    T.StructField("part", T.StringType()), T.StructField("conv", T.StringType())])
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
           "ends_sha256")


def sequences(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, role, digest, text))
    return {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}


def rebuilt(own):
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def plain(convs):
    """The nodes by a dictionary of all prefixes."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p],
                    saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def built(spark, rows, heads=True, **options):
    given = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(3)
    turns, parts = tt.number_turns(given)
    if heads:
        turns, convs = tt.with_shared_heads(
            turns, parts, 5, F.crc32(F.col("conv").cast("string").cast("binary")) % 9, 8)
    else:
        turns, convs = tt.ordered(turns, parts)
    nodes = tt.with_end_digests(*tt.prefix_trie(turns, convs, **options))
    return sorted((tuple(r) for r in nodes.select(*COLUMNS).collect()), key=str)


def talk(n, seed, words=3, longest=12):
    rng = random.Random(seed)
    return [(c, k, "user" if k % 2 else None, rng.choice("abcdef"[:words]) * rng.randrange(1, 3))
            for c in range(n) for k in range(rng.randrange(0, longest))]


def edge_rows():
    rows = talk(60, 1)
    rows += [(100, None, "user", "first"), (100, 5, "user", "last"), (100, 5, "user", "last"), (100, 5, "assistant", None),
             (None, 1, "user", "lost"), (-7, 0, "ü", "é" * 50), (-5, 0, "ü", "é" * 50), (101, 0, "", "user:a"),
             (102, 0, "user", ":a"), (103, 0, None, None), (104, 1, "x" * 2000, "long " * 4000)]
    rows += [(500 + k, j, "user", f"same {j}") for k in range(40) for j in range(3)]       # copies
    rows += [(700, k, "user", f"turn {k % 7}") for k in range(90)]                         # one long
    rows += [(701, k, "user", f"turn {k % 7}") for k in range(70)] + [(702, k, "user", f"turn {k % 7}") for k in range(90)]
    rows += [(703, k, "user", f"turn {k % 7}" if k != 40 else "other") for k in range(95)]
    return rows


@pytest.mark.parametrize("heads", [True, False])
@pytest.mark.parametrize("options", [{}, {"most": 4, "shard_turns": 10}, {"most": 8, "shard_turns": 1}])
def test_against_all_prefixes(spark, heads, options, monkeypatch):
    monkeypatch.setattr(tt, "SHARD_ROWS", 40)
    own = sequences(edge_rows())
    assert built(spark, edge_rows(), heads, **options) == plain(rebuilt(own) if heads else own)


def test_shuffled_parents_and_single_rows(spark, monkeypatch):
    monkeypatch.setattr(tt, "NODE_ROWS", 0)
    assert built(spark, edge_rows(), most=16) == plain(rebuilt(sequences(edge_rows())))
    one = [(3, 0, "user", "hello")]
    assert built(spark, one) == plain(rebuilt(sequences(one)))
    assert built(spark, []) == []


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "only") for c in range(1, 40) if c % 5]
    got = built(spark, rows)
    assert got == plain(rebuilt(sequences(rows)))
    root = next(r for r in got if r[1] == 0)
    assert root[3] == len(rows) and root[7] != tt.EMPTY_SHA


def test_copies_are_counted_before_they_are_sorted(spark):
    rows = [(c, k, "user", f"t{k}") for c in range(3000) for k in range(2)]
    given = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)
    cut, chain = tt.cut_pieces(*tt.ordered(*tt.number_turns(given)))
    assert cut.count() == 3000 and chain.select("end_1", "end_2").distinct().count() == 1
    assert built(spark, rows, heads=False) == plain(sequences(rows))


def test_ternary_tree_keeps_siblings_balanced():
    rng = random.Random(6)
    items = sorted({tuple(rng.randrange(1000) for _ in range(rng.randrange(1, 4))) for _ in range(2000)})
    tree = tt.TernaryTree()
    ends = {}
    order = list(tt.median_order(len(items)))
    assert sorted(order) == list(range(len(items)))
    for k in order:
        ends[items[k]] = tree.insert(list(items[k]), [1] * len(items[k]), 1, k)[-1]
    assert len(set(ends.values())) == len(items)
    for item, node in ends.items():
        found = []
        while node:
            found.append(tree.code[node])
            node = tree.parent[node]
        assert tuple(found[::-1]) == item

    def height(node):
        deepest, stack = 0, [(node, 1)]
        while stack:
            at, h = stack.pop()
            if at >= 0:
                deepest = max(deepest, h)
                stack += ((tree.low[at], h + 1), (tree.high[at], h + 1))
        return deepest

    assert height(tree.equal[0]) <= 2 * len(items).bit_length()
