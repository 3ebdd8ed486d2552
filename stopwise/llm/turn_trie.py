"""Prefix trie of conversations: one node for every distinct run of first turns.

A turn is the pair of its role and text, known by a digest. The turns of a conversation are cut
into pieces of at most ``PIECE_TURNS``. Pieces that are equal and follow equal turns are counted
before anything is sorted, so copies, however many, are one row. The rows are then dealt out by
ranges of their digests: a shard holds a run of neighbouring sequences. It encodes its digests
by a sorted dictionary, inserts its sequences into a ternary search tree, the median first, so
that siblings are found in logarithmic time, and sums members, leaves and savings from the last
node to the first, without recursion.

Only nodes on the path of a shard's first or last sequence can lie in another shard too. These
boundary nodes, and the paths of conversations longer than a piece, leave the shard with what
the complete subtrees below them add up to, and are merged by key. Sums over the merged nodes
need no levels: every node adds its own part to one of the paths through it, a path is summed
from its end in two steps, by piece and within the piece, and the paths of a node are added.

A node's key is its depth and 128 bits: the digests of the full pieces before it, combined by
exclusive or, and the digest of what its own piece has so far. So keys need no walk along a
conversation, and a hot conversation is numbered, cut and summed in parts.

Rows. Turns are ordered by turn (null first), then role, then the digest of role and text; a
repeated row is a turn of its own. A null role or text is the empty string. Rows without conv_id
take no part. An empty table has no nodes, not even a root. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage

PIECE_TURNS = 1024       # turns of a piece, which a task holds as one row
SHARD_TURNS = 50_000     # turns of the sequences of one tree
SHARD_ROWS = 50_000      # pieces of a range that one task reads, about
NODE_ROWS = 1_000_000    # merged nodes that are broadcast
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
KEY = ["depth", "key_1", "key_2"]


def _halves(digest: Column) -> tuple[Column, Column]:
    """The two halves of an MD5 in hex as signed longs."""
    return tuple(F.conv(F.substring(digest, k, 16), 16, -10).cast("long") for k in (1, 17))


# -- turns in order ---------------------------------------------------------------------------

def number_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conv, part, local, digest, size) of all turns, and (conv, part, before, n) of the parts.

    Rows are dealt by ranges of their order and numbered within a part; a turn's number is
    ``before + local``. A conversation of any length is numbered in parts.
    """
    name, words = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    rows = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), name.alias("role"),
        F.md5(F.concat(F.length(name).cast("string"), F.lit(":"), name, words)).alias("digest"),
        F.octet_length(words).cast("long").alias("size"))
    order = [F.asc_nulls_first("turn"), F.col("role"), F.col("digest")]
    dealt = stage(rows.repartitionByRange("conv", *order).withColumn(
        "part", F.spark_partition_id()), "turns")
    local = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order))
    turns = dealt.select("conv", "part", local.cast("long").alias("local"), "digest", "size")
    parts = dealt.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1))
    parts = parts.withColumn("before", F.coalesce(before, F.lit(0)))
    return turns, stage(parts, "turn-parts")


def ordered(turns: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, pos, digest, size) with positions from 1, and (conv) of all conversations."""
    numbered = turns.join(parts.select("conv", "part", "before"), ["conv", "part"])
    return (numbered.select("conv", (F.col("before") + F.col("local")).alias("pos"), "digest", "size"),
            parts.select("conv").distinct())


def with_shared_heads(turns: DataFrame, parts: DataFrame, group: int, head: Column,
                      longest_head: int) -> tuple[DataFrame, DataFrame]:
    """As ``ordered``, after every conversation takes its first turns from its group's first one.

    Conversation c gets the first ``head`` turns (a column of conv) of conversation
    c - c % group, all if fewer, none if absent, then its own turns after its first ``head``.
    """
    convs = parts.groupBy("conv").agg(F.sum("n").alias("n")).select(
        "conv", "n", (F.col("conv") - F.col("conv") % group).alias("base"),
        head.cast("long").alias("head"))
    bases = convs.filter(F.col("conv") == F.col("base")).select(
        F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = stage(convs.join(bases, "base", "left").withColumn(
        "taken", F.least("head", F.coalesce("base_n", F.lit(0)))), "conversations")

    shift = parts.join(convs.select("conv", "head", "taken"), "conv").select(
        "conv", "part", "before", "head", "taken")
    numbered = turns.join(shift, ["conv", "part"]).withColumn("at", F.col("before") + F.col("local"))
    own = numbered.filter(F.col("at") > F.col("head")).select(
        "conv", (F.col("taken") + F.col("at") - F.col("head")).alias("pos"), "digest", "size")
    heads = numbered.filter((F.col("at") <= longest_head) & (F.col("conv") % group == 0)).select(
        F.col("conv").alias("base"), F.col("at").alias("pos"), "digest", "size")
    heads = heads.join(convs.select("conv", "base", "taken"), "base").filter(
        F.col("pos") <= F.col("taken")).select("conv", "pos", "digest", "size")
    return own.unionByName(heads), convs.select("conv")


# -- pieces ------------------------------------------------------------------------------------

def cut_pieces(turns: DataFrame, convs: DataFrame, most: int = PIECE_TURNS
               ) -> tuple[DataFrame, DataFrame]:
    """Written pieces (conv, piece, seq, sizes) and their chain, which is narrow.

    ``seq`` has the digests of the piece's turns. The chain has conv, piece, depth, the keys
    before (base) and after (end) the piece, and whether it is the last one.
    """
    placed = turns.withColumn("piece", F.floor((F.col("pos") - 1) / most).cast("long"))
    # at most `most` turns are gathered
    cut = placed.groupBy("conv", "piece").agg(F.sort_array(F.collect_list(
        F.struct("pos", "digest", "size"))).alias("turns")).select(
        "conv", "piece",
        F.unhex(F.array_join(F.transform("turns", lambda x: x["digest"]), "")).alias("seq"),
        F.transform("turns", lambda x: x["size"]).alias("sizes"))
    # a conversation without turns is one empty piece
    turnless = convs.join(turns.filter("pos = 1").select("conv"), "conv", "left_anti").select(
        "conv", F.lit(0).cast("long").alias("piece"), F.lit(b"").alias("seq"),
        F.array().cast("array<bigint>").alias("sizes"))
    cut = stage(cut.unionByName(turnless), "pieces")
    number = F.unhex(F.lpad(F.hex("piece"), 16, "0"))
    whole = F.octet_length("seq") > 0
    zero = F.lit(0).cast("long")
    own = [F.when(whole, half).otherwise(zero) for half in _halves(F.md5(F.concat(number, F.col("seq"))))]
    along = Window.partitionBy("conv").orderBy("piece")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    chain = cut.select("conv", "piece", own[0].alias("own_1"), own[1].alias("own_2"), (
        F.col("piece") * most + (F.octet_length("seq") / 16).cast("long")).alias("depth"))
    chain = chain.withColumns({
        **{f"base_{k}": F.coalesce(F.bit_xor(f"own_{k}").over(before), zero) for k in (1, 2)},
        "last": F.lead("piece").over(along).isNull()})
    return cut, stage(chain.select(
        "conv", "piece", "depth", "base_1", "base_2", "last",
        *(F.col(f"base_{k}").bitwiseXOR(F.col(f"own_{k}")).alias(f"end_{k}") for k in (1, 2))), "chain")


# -- shards ------------------------------------------------------------------------------------

class TernaryTree:
    """Sequences of codes; the siblings below a node are a binary search tree of their codes.

    Nodes are numbered as they are made, so a parent's number is below its children's.
    """

    def __init__(self) -> None:
        self.code, self.low, self.equal, self.high = [-1], [-1], [-1], [-1]
        self.parent, self.size = [-1], [0]
        self.members, self.smallest = [0], [None]

    def _new(self, code: int, parent: int, size: int) -> int:
        for values, first in ((self.code, code), (self.low, -1), (self.equal, -1), (self.high, -1),
                              (self.parent, parent), (self.size, size), (self.members, 0),
                              (self.smallest, None)):
            values.append(first)
        return len(self.code) - 1

    def insert(self, codes: list[int], sizes: list[int], members: int, smallest: int) -> list[int]:
        """The nodes of the sequence, the root first; they get its members."""
        at, path = 0, [0]
        for code, size in zip(codes, sizes):
            node, parent = self.equal[at], at
            if node < 0:
                node = self.equal[at] = self._new(code, parent, size)
            while self.code[node] != code:
                side = self.low if code < self.code[node] else self.high
                if side[node] < 0:
                    side[node] = self._new(code, parent, size)
                node = side[node]
            at = node
            path.append(node)
        for node in path:
            self.members[node] += members
            if self.smallest[node] is None or smallest < self.smallest[node]:
                self.smallest[node] = smallest
        return path


def median_order(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of every range before its halves."""
    ranges = [(0, n)]
    for first, last in ranges:
        if first < last:
            middle = (first + last) // 2
            yield middle
            ranges += ((first, middle), (middle + 1, last))


def node_keys(piece: int, base: tuple[int, int], digests: list[bytes]) -> list[tuple[int, int]]:
    """The keys of the nodes after each of the digests of a piece."""
    state, out = hashlib.md5(struct.pack(">q", piece)), []
    for digest in digests:
        state.update(digest)
        halves = struct.unpack(">qq", state.copy().digest())
        out.append((base[0] ^ halves[0], base[1] ^ halves[1]))
    return out


_NODES = ("depth long, key_1 long, key_2 long, up_1 long, up_2 long, conv_id long, up_conv long, "
          "n_convs long, n_children long, n_leaves long, saved_tokens long, size long, boundary boolean, "
          "ends_path boolean")


def _tree_rows(rows: list[dict], piece: int, base: tuple[int, int], most: int) -> Iterator[tuple]:
    """The nodes of sorted sequences that follow the turns of one key."""
    dictionary, codes = np.unique(
        np.frombuffer(b"".join(r["seq"] for r in rows), "S16"), return_inverse=True)
    dictionary = dictionary.tobytes()
    ends = np.cumsum([len(r["seq"]) // 16 for r in rows])
    tree, keys, states = TernaryTree(), {0: base}, {0: hashlib.md5(struct.pack(">q", piece))}
    boundary, path_ends = {0}, set()
    for k in median_order(len(rows)):
        r, n = rows[k], len(rows[k]["seq"]) // 16
        path = tree.insert(codes[ends[k] - n:ends[k]].tolist(), r["sizes"], r["members"], r["smallest"])
        # another shard can share the first and last path only; a longer conversation goes on
        if k in (0, len(rows) - 1) or r["goes_on"] or piece:
            boundary.update(path)
            if not r["goes_on"] and not piece:
                path_ends.add(path[-1])
    n = len(tree.code)
    depth, children, leaves, saved = [0] * n, [0] * n, [0] * n, [0] * n
    for node in range(1, n):
        parent = tree.parent[node]
        depth[node] = depth[parent] + 1
        state = states[parent].copy()
        state.update(dictionary[16 * tree.code[node]:16 * tree.code[node] + 16])
        states[node] = state
        halves = struct.unpack(">qq", state.digest())
        keys[node] = base[0] ^ halves[0], base[1] ^ halves[1]
    for node in range(n - 1, 0, -1):
        if node in boundary:
            continue
        parent = tree.parent[node]
        leaves[node] += not children[node]
        saved[node] += (tree.members[node] - 1) * tree.size[node]
        children[parent] += 1
        leaves[parent] += leaves[node]
        saved[parent] += saved[node]
    for node in range(n):
        parent = tree.parent[node]
        up = keys[parent] if node else (None, None)
        open_ = node in boundary
        counted = node or not piece     # the root of a later piece is counted by the piece before
        yield (piece * most + depth[node], *keys[node], *up,
               tree.smallest[node] if counted else None,
               None if not node or parent in boundary else tree.smallest[parent],
               tree.members[node] if counted else 0, children[node], leaves[node], saved[node],
               tree.size[node], open_, node in path_ends)


def _each(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[dict]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield from batch.slice(k, rows).to_pylist()


def _shards(most: int, shard_turns: int):
    names = [c.split()[0] for c in _NODES.split(", ")]
    kinds = [{"long": pa.int64(), "boolean": pa.bool_()}[c.split()[1]] for c in _NODES.split(", ")]

    def emit(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        first = rows[0]
        out = list(_tree_rows(rows, first["piece"], (first["base_1"], first["base_2"]), most))
        for k in range(0, len(out), 20_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out[k:k + 20_000]), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, turns = [], None, 0
        for r in _each(batches):
            now = r["piece"], r["base_1"], r["base_2"]
            if held and (now != key or turns >= shard_turns):
                yield from emit(held)
                held, turns = [], 0
            key = now
            held.append(r)
            turns += len(r["seq"]) // 16 + 1
        if held:
            yield from emit(held)

    return run


def _paths(most: int):
    """(path, depth, key_1, key_2) of all turns of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _each(batches):
            digests = [r["seq"][k:k + 16] for k in range(0, len(r["seq"]), 16)]
            keys = node_keys(r["piece"], (r["base_1"], r["base_2"]), digests)
            if not r["piece"]:
                keys.insert(0, (0, 0))
            depth = r["piece"] * most + (1 if r["piece"] else 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["conv"]] * len(keys), pa.int64()),
                 pa.array(range(depth, depth + len(keys)), pa.int64()),
                 pa.array([k[0] for k in keys], pa.int64()),
                 pa.array([k[1] for k in keys], pa.int64())], ["path", *KEY])

    return run


# -- the trie ----------------------------------------------------------------------------------

def _suffix_sums(rows: DataFrame, most: int, *values: str) -> DataFrame:
    """Adds to every row of a path the values of its deeper rows, by piece and within it."""
    rows = rows.withColumn("stretch", F.floor(F.col("depth") / most))
    whole = rows.groupBy("path", "stretch").agg(*(F.sum(v).alias(f"all_{v}") for v in values))
    later = Window.partitionBy("path").orderBy(F.desc("stretch")).rowsBetween(
        Window.unboundedPreceding, -1)
    whole = whole.select("path", "stretch", *(
        F.coalesce(F.sum(f"all_{v}").over(later), F.lit(0)).alias(f"later_{v}") for v in values))
    below = Window.partitionBy("path", "stretch").orderBy(F.desc("depth")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumns({f"in_{v}": F.sum(v).over(below) for v in values})
    return summed.join(whole, ["path", "stretch"]).withColumns(
        {v: F.col(f"in_{v}") + F.col(f"later_{v}") for v in values})


def _merged(boundary: DataFrame, paths: DataFrame, most: int) -> DataFrame:
    """Boundary nodes of all shards, one row a key, with the sums of their whole subtrees."""
    merged = boundary.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("own_children"), F.sum("n_leaves").alias("own_leaves"),
        F.sum("saved_tokens").alias("own_saved"), F.max("size").alias("size"),
        F.max("up_1").alias("up_1"), F.max("up_2").alias("up_2"))
    merged = stage(merged, "boundary-nodes")
    below = merged.filter(F.col("up_1").isNotNull()).groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("up_1").alias("key_1"),
        F.col("up_2").alias("key_2")).agg(F.count("*").alias("more"))
    nodes = stage(merged.join(below, KEY, "left").withColumn(
        "n_children", F.col("own_children") + F.coalesce("more", F.lit(0))).select(
        *KEY, "up_1", "up_2", "conv_id", "n_convs", "n_children",
        (F.col("own_leaves") + (F.col("n_children") == 0).cast("long")).alias("leaves"),
        (F.col("own_saved") + (F.col("n_convs") - 1) * F.col("size")).alias("saved")), "merged-nodes")
    paths = stage(paths, "paths")
    first = paths.groupBy(*KEY).agg(F.min("path").alias("first_path"))
    owned = nodes.select(*KEY, "leaves", "saved").join(first, KEY)
    here = F.col("path") == F.col("first_path")
    placed = paths.join(owned, KEY).select(
        "path", *KEY, *(F.when(here, F.col(v)).otherwise(F.lit(0)).alias(v) for v in ("leaves", "saved")))
    total = _suffix_sums(placed, most, "leaves", "saved").groupBy(*KEY).agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    return stage(nodes.drop("leaves", "saved").join(total, KEY), "summed-nodes")


def prefix_trie(turns: DataFrame, convs: DataFrame, most: int = PIECE_TURNS,
                shard_turns: int = SHARD_TURNS) -> tuple[DataFrame, DataFrame]:
    """Nodes, and the conversations that end at them.

    ``turns`` has conv, pos (from 1, without gaps), digest (hex) and size; ``convs`` every conv
    once. Nodes: depth, key_1, key_2, conv_id (smallest member), parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens. Ends: depth, key_1, key_2, conv.
    """
    cut, chain = cut_pieces(turns, convs, most)
    ends = chain.filter("last").select(
        "depth", F.col("end_1").alias("key_1"), F.col("end_2").alias("key_2"), "conv")
    pieces = cut.join(chain, ["conv", "piece"])
    # copies become one row before they are sorted
    same = pieces.groupBy("piece", "base_1", "base_2", "end_1", "end_2").agg(
        F.first("seq").alias("seq"), F.first("sizes").alias("sizes"), F.count("*").alias("members"),
        F.min("conv").alias("smallest"), F.max(~F.col("last")).alias("goes_on"))
    same = stage(same.drop("end_1", "end_2"), "distinct-pieces")
    ranges = max(1, -(-same.count() // SHARD_ROWS))
    order = ("piece", "base_1", "base_2", "seq")
    found = stage(same.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(
        _shards(most, shard_turns), _NODES), "shard-nodes")

    boundary = found.filter("boundary")
    long_ones = chain.filter(F.col("last") & (F.col("piece") > 0)).groupBy("end_1", "end_2").agg(
        F.min("conv").alias("conv")).select("conv")
    short_ones = found.filter("ends_path").select(F.col("conv_id").alias("conv"))
    chosen = long_ones.unionByName(short_ones).distinct()
    paths = pieces.join(chosen, "conv", "left_semi").mapInArrow(
        _paths(most), "path long, depth long, key_1 long, key_2 long")
    merged = _merged(boundary, paths, most)

    parents = merged.select((F.col("depth") + 1).alias("depth"), F.col("key_1").alias("up_1"),
                            F.col("key_2").alias("up_2"), F.col("conv_id").alias("merged_conv"))
    if parents.count() <= NODE_ROWS:
        parents = F.broadcast(parents)
    columns = (*KEY, "up_1", "up_2", "conv_id", "up_conv", "n_convs", "n_children", "n_leaves",
               "saved_tokens")
    nodes = found.filter(~F.col("boundary")).select(*columns).unionByName(
        merged.withColumn("up_conv", F.lit(None).cast("long")).select(*columns))
    nodes = nodes.join(parents, ["depth", "up_1", "up_2"], "left").select(
        *KEY, "conv_id", F.coalesce("up_conv", "merged_conv").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens")
    return nodes, ends


def digest_ends(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined conversations that end at a node, by node.

    A digest is made from its first id to its last, so a node's ids pass through one task, sorted
    and one after the other; none are gathered.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for *now, conv in zip(*(batch.column(c).to_pylist() for c in (*KEY, "conv"))):
                if now != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = now, hashlib.sha256(str(conv).encode())
                else:
                    state.update(b",%d" % conv)
            if done:
                yield _ended(done)
        if key is not None:
            yield _ended([(*key, state.hexdigest())])

    return ends.repartition(*KEY).sortWithinPartitions(*KEY, "conv").mapInArrow(
        run, "depth long, key_1 long, key_2 long, ends_sha256 string")


def _ended(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(),) * 3 + (pa.string(),))],
        [*KEY, "ends_sha256"])


def with_end_digests(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """Nodes with ``ends_sha256``; where none ends, that of the empty string."""
    return nodes.join(digest_ends(ends), KEY, "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)))
