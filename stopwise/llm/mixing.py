"""Mixing sources to target weights by Pfair scheduling of source blocks.

Every source's documents are put in hash order and cut into blocks of equal size. Weights
are whole quanta of 1/``quanta``. Block j of a source with p quanta is released at slot
floor(j Q / p) and due before slot ceil((j + 1) Q / p); each slot takes the released block
of the earliest deadline. The weights fill every slot, so all deadlines are met and each
source is at every slot less than one block away from its share. The schedule repeats after
Q slots, and so one period of it, whose size is bounded by Q, places any number of blocks.

Q is ``quanta`` while that leaves 20 to a source on average, and 50 times the sources beyond,
so that the one quantum each has at least does not level the weights. More than
``direct_sources`` sources are dealt by hash into groups: the period of the driver is one of
groups, and each group's turns are given to its sources by a period of their own, made in
tasks. A source is then less than two blocks away from its share.

Every document comes out once. While all sources last the mix has the target weights; a
source that ends early leaves its slots empty, and the others keep their order.

Null source is a source of its own. Null or empty text has size 1, so that it takes a place.
Equal hashes and repeated rows are ordered by doc_id. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage
from .sharding import hash_bits
from .tables import free_name, keyed, tagged

QUANTA = 1000            # resolution of a weight, and slots of a period, at least
FEW_QUANTA = 20          # to a source on average; below, the period is made longer
SOURCE_QUANTA = 50       # to a source on average in a longer period
DIRECT_SOURCES = 1000    # in one period of the driver; more are grouped
GROUP_SOURCES = 500      # of a group on average, while there are few enough groups
BLOCK_CHARS = 1 << 16
EXPONENT = 0.7           # default weights: a source's characters to this power
CHUNK_ROWS = 1024        # rows of one source that are ranked together
BROADCAST_ROWS = 1_000_000   # places, of 40 bytes each; more are joined by a shuffle
PLAN_ROWS = 200_000      # sources or turns, with names; more are joined by a shuffle


def whole_quanta(shares: dict[str, float], quanta: int = QUANTA) -> dict[str, int]:
    """At least one quantum each, the rest by largest remainder, ties by name."""
    if len(shares) > quanta:
        raise ValueError(f"{len(shares)} sources need more than {quanta} quanta")
    total = sum(shares.values())
    if shares and total <= 0:       # no source is wanted more than another
        shares, total = dict.fromkeys(shares, 1.0), float(len(shares))
    exact = {s: (quanta - len(shares)) * x / total for s, x in shares.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (-round(exact[s] - int(exact[s]), 9), s))
    for s in by_rest[:quanta - sum(out.values())]:
        out[s] += 1
    return out


def period_slots(sources: int, quanta: int = QUANTA) -> int:
    """Slots of a period in which the quantum that each source has at least is a small part."""
    return quanta if sources * FEW_QUANTA <= quanta else max(quanta, sources * SOURCE_QUANTA)


def pfair_period(weights: dict[str, int]) -> list[tuple[str, int, int]]:
    """``(source, block, slot)`` of one period: earliest deadline first among released blocks."""
    return list(_turns(weights))


def _turns(weights: dict[str, int]) -> Iterator[tuple[str, int, int]]:
    quanta = sum(weights.values())
    waiting = sorted((0, s, 0) for s in weights)
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    for slot in range(quanta):
        while waiting and waiting[0][0] <= slot:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * quanta // weights[s]), s, j))
        _, s, j = heapq.heappop(ready)
        yield s, j, slot
        if j + 1 < weights[s]:
            heapq.heappush(waiting, ((j + 1) * quanta // weights[s], s, j + 1))


def _share(found, targets: dict[str | None, float] | None) -> float:
    """A source's weight; one that the targets lack, or put below 0, has 0."""
    if targets is None:
        return found["size"] ** EXPONENT
    return max(0.0, float(targets.get(found["source"]) or 0.0))


_TURNS = "group long, share double, name string, quanta long, cycle long, turn long, at long"


def _group_turns(targets: dict[str | None, float] | None, quanta: int, block_chars: int):
    """The turns that the sources of one group have blocks for, in a period of the group."""
    def run(table: pa.Table) -> pa.Table:
        found = sorted(table.to_pylist(), key=lambda r: r["name"])
        shares = {r["name"]: _share(r, targets) for r in found}
        total = sum(shares.values())
        slots = period_slots(len(found), quanta)
        weights = whole_quanta(shares, slots)
        blocks = {r["name"]: min(weights[r["name"]], -(-r["size"] // block_chars)) for r in found}
        left, names, turns, at = sum(blocks.values()), [], [], []
        for name, turn, slot in _turns(weights):
            if turn < blocks[name]:
                names.append(name)
                turns.append(turn)
                at.append(slot)
                left -= 1
                if not left:
                    break
        n = len(names)
        return pa.table({
            "group": pa.array([found[0]["group"]] * n, pa.int64()),
            "share": pa.array([float(total)] * n, pa.float64()), "name": pa.array(names, pa.string()),
            "quanta": pa.array([weights[x] for x in names], pa.int64()),
            "cycle": pa.array([slots] * n, pa.int64()), "turn": pa.array(turns, pa.int64()),
            "at": pa.array(at, pa.int64())})

    return run


def _small(df: DataFrame, rows: int, bound: int = PLAN_ROWS) -> DataFrame:
    return F.broadcast(df) if rows <= bound else df


def mix(docs: DataFrame, targets: dict[str | None, float] | None = None, doc_id: str = "doc_id",
        text: str = "text", source: str = "source", quanta: int = QUANTA,
        block_chars: int = BLOCK_CHARS, chunk_rows: int = CHUNK_ROWS,
        direct_sources: int = DIRECT_SOURCES, tag: str | None = None) -> DataFrame:
    """Places of all rows: row_tag, doc_id, source, block, slot and place in the block.

    ``(slot, place)`` is the order of the mix. ``row_tag`` numbers the rows as they are
    read, or is the column that ``tag`` names, which must differ from row to row. A source
    without a target has the least weight there is, so its rows come out too.
    """
    spark = docs.sparkSession
    name = F.coalesce(F.concat(F.lit("s:"), F.col(source)), F.lit("null"))
    rows = docs.select(
        *([F.col(tag).alias("row_tag")] if tag else []),
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), name.alias("name"),
        hash_bits(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).alias("key"),
        F.greatest(F.coalesce(F.length(text), F.lit(1)), F.lit(1)).cast("long").alias("size"))
    rows = stage(rows, "sizes") if tag else tagged(rows, "sizes")[0]

    sizes = rows.groupBy("name").agg(F.sum("size").alias("size"), F.count("*").alias("n"),
                                     F.first("source").alias("source"))
    found = sizes.limit(direct_sources + 1).collect()
    outer = None
    if len(found) <= direct_sources:
        shares = {r["name"]: _share(r, targets) for r in found}
        slots = period_slots(len(found), quanta)
        weights = whole_quanta(shares, slots) if found else {}
        most = max((r["n"] for r in found), default=1)
        counts = F.broadcast(spark.createDataFrame(
            [(s, p, slots) for s, p in weights.items()], "name string, quanta long, cycle long"))
        period = F.broadcast(spark.createDataFrame(
            pfair_period(weights), "name string, turn long, at long"))
    else:
        sizes = stage(sizes, "sources")
        n, most = sizes.agg(F.count("*"), F.max("n")).first()
        groups = min(direct_sources, -(-n // GROUP_SOURCES))
        plan = stage(sizes.select("name", "source", "size", F.pmod(
            F.xxhash64("name"), F.lit(groups)).cast("long").alias("group")).groupBy("group")
            .applyInArrow(_group_turns(targets, quanta, block_chars), _TURNS), "turns")
        counts = _small(plan.filter("turn = 0").select("name", "quanta", "cycle", "group"), n)
        period = _small(plan.select("name", "turn", "at"), plan.count())
        shares = {r["group"]: r["share"] for r in plan.select("group", "share").distinct().collect()}
        slots = period_slots(len(shares), quanta)
        weights = whole_quanta(shares, slots)
        outer = F.broadcast(spark.createDataFrame(
            [(g, j, at, weights[g]) for g, j, at in pfair_period(weights)],
            "group long, group_turn long, group_at long, group_quanta long"))

    # rank in two steps, so that a source of any size is ranked in parts
    bits = max(0, (most // chunk_rows).bit_length())
    ranked = rows.withColumn("chunk", F.shiftrightunsigned("key", 60 - bits) if bits
                             else F.lit(0).cast("long"))
    order = ("key", "doc_id", "row_tag")
    before_in_chunk = F.sum("size").over(
        Window.partitionBy("name", "chunk").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1))
    chunks = ranked.groupBy("name", "chunk").agg(F.sum("size").alias("chunk_size"))
    chunks = chunks.withColumn("before", F.coalesce(F.sum("chunk_size").over(
        Window.partitionBy("name").orderBy("chunk")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("chunk_size")
    chunks = chunks.join(counts, "name")
    start = F.col("before") + F.coalesce(F.col("within"), F.lit(0))
    blocked = (ranked.withColumn("within", before_in_chunk).join(chunks, ["name", "chunk"])
               .withColumn("block", F.floor(start / block_chars).cast("long")))
    # a block spans few chunks; its rows are few, as each has a size
    place = F.row_number().over(Window.partitionBy("name", "block").orderBy(*order))
    placed = (blocked.withColumn("place", place.cast("long"))
              .withColumn("turn", F.col("block") % F.col("quanta")).join(period, ["name", "turn"])
              .withColumn("slot", F.floor(F.col("block") / F.col("quanta")).cast("long")
                          * F.col("cycle") + F.col("at")))
    if outer is not None:       # the slot so far counts the turns of the group
        own = outer.groupBy("group").agg(F.first("group_quanta").alias("group_quanta"))
        placed = (placed.join(F.broadcast(own), "group")
                  .withColumn("group_turn", F.col("slot") % F.col("group_quanta"))
                  .join(outer.drop("group_quanta"), ["group", "group_turn"])
                  .withColumn("slot", F.floor(F.col("slot") / F.col("group_quanta")).cast("long")
                              * slots + F.col("group_at")))
    return placed.select("row_tag", "doc_id", "source", "block", "slot", "place")


def places_of(rows: DataFrame, tag: str, doc_id: str = "doc_id", text: str = "text",
              source: str = "source", **options) -> DataFrame:
    """Written places of rows that ``tag`` tells apart: row_tag, slot and place."""
    given = rows.select(F.col(tag).alias("row_tag"), F.col(doc_id).alias("doc_id"),
                        F.col(text).alias("text"), F.col(source).alias("source"))
    places = stage(mix(given, tag="row_tag", **options).select("row_tag", "slot", "place"), "places")
    return _small(places, places.count(), BROADCAST_ROWS)


def interleave(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in the order of the mix, dealt out by ranges of slots."""
    names = {k: options.pop(k, k) for k in ("doc_id", "text", "source")}
    rows, tag = keyed(docs, names["doc_id"], names["text"], "mixed-rows")
    slot, place, key = (free_name(rows, c) for c in ("slot", "place", "row_tag_of"))
    places = places_of(rows, tag, **names, **options).toDF(key, slot, place)
    return rows.join(places, rows[tag] == F.col(key)).orderBy(slot, place).drop(
        tag, key, slot, place)
