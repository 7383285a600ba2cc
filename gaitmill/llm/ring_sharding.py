"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` points on a ring of 64-bit hashes; a document belongs to the
arc that its own hash falls on. A shard takes documents up to its load bound; what
overflows goes on clockwise to the next shard with room. All documents of an arc are
alike until they overflow, so the walk runs on arc counts (``shards * vnodes`` numbers,
whatever the data), and Spark gives each document its rank within its arc and with it
its shard and slot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaitmill.llm.ranking import ranked
from gaitmill.operators.shared import settle

VNODES = 64
#: Arcs that a plan may have; the driver and a broadcast hold that many rows.
MAX_POINTS = 1 << 18


@dataclass(frozen=True)
class Point:
    place: int
    shard: int


def ring(spark, shards: int, vnodes: int) -> list[Point]:
    """The points of the ring in clockwise order. They depend on the shard and the
    virtual node alone, so another shard adds points and moves none."""
    if shards < 1 or vnodes < 1 or shards * vnodes > MAX_POINTS:
        raise ValueError("shards times virtual nodes must be from 1 to MAX_POINTS")
    nodes = spark.range(shards * vnodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        F.xxhash64(
            F.lit("shard"), (F.col("id") % shards).cast("int"), F.expr(f"id div {shards}")
        ).alias("place"),
    )
    return sorted((Point(r["place"], r["shard"]) for r in nodes.collect()), key=lambda p: (p.place, p.shard))


def with_arc(rows: DataFrame, key: str, points: list[Point]) -> DataFrame:
    """Adds ``_arc``: the number of the first point at or after the key's hash, past the
    last point the first.

    The ring is cut in about as many equal slots as it has points; a broadcast table
    (``MAX_POINTS`` rows at most, twice over) has the few points of each slot.
    """
    bits = max(1, (len(points) - 1).bit_length())
    inside: dict[int, list[int]] = {}
    for p in points:
        inside.setdefault((p.place % (1 << 64)) >> (64 - bits), []).append(p.place)
    # Signed order starts at the smallest long: slots with the top bit set come first.
    half, first, slots = 1 << (bits - 1), 0, []
    for slot in [*range(half, 2 * half), *range(half)]:
        slots.append((slot, first, inside.get(slot, [])))
        first += len(inside.get(slot, []))
    table = rows.sparkSession.createDataFrame(
        slots, "_slot long, _first int, _inside array<bigint>"
    )
    hashed = F.xxhash64(F.col(key))
    passed = F.size(F.filter("_inside", lambda p: p < F.col("_hash")))
    return (
        rows.withColumn("_hash", hashed)
        .withColumn("_slot", F.shiftrightunsigned("_hash", 64 - bits))
        .join(F.broadcast(table), "_slot")
        .withColumn("_arc", F.pmod(F.col("_first") + passed, F.lit(len(points))))
        .drop("_slot", "_first", "_inside", "_hash")
    )


def load_bounds(total: int, shards: int, slack: float) -> list[int]:
    """Most documents of each shard. Without slack the bounds add up to ``total``, so
    every shard fills up and counts are at most one apart."""
    if slack > 0:
        return [int(-(-total * (1 + slack) // shards))] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def walk(points: list[Point], counts: dict[int, int], bounds: list[int]) -> list[tuple]:
    """Rows (arc, first rank, end rank, shard, slot of the first).

    In rounds: every arc offers what it still holds to its next shard clockwise, arcs
    in ring order; a shard takes what it has room for, lowest ranks first.
    """
    room, filled, rows = list(bounds), [0] * len(bounds), []
    pending = [(arc, 0, n) for arc, n in sorted(counts.items()) if n]
    step = 0
    while pending:
        if step >= len(points):
            raise ValueError("the load bounds are below the number of documents")
        left = []
        for arc, lo, hi in pending:
            shard = points[(arc + step) % len(points)].shard
            taken = min(room[shard], hi - lo)
            if taken:
                rows.append((arc, lo, lo + taken, shard, filled[shard]))
                room[shard] -= taken
                filled[shard] += taken
            if lo + taken < hi:
                left.append((arc, lo + taken, hi))
        pending, step = left, step + 1
    return rows


def shard_documents(
    docs: DataFrame,
    shards: int,
    *,
    key: str = "doc_id",
    text: str = "text",
    vnodes: int = VNODES,
    slack: float = 0.0,
) -> DataFrame:
    """``key``, ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``shard`` and ``slot``.

    Slots are gapless from 0 in each shard. ``slack`` 0 keeps counts at most one apart;
    a larger one bounds each shard by ``1 + slack`` times the mean and moves fewer
    documents. Null keys are a key like any other; null texts count as empty; repeated
    rows each get a slot and are interchangeable; an empty table gives an empty table.
    Other columns are ignored whatever their names.
    """
    spark = docs.sparkSession
    points = ring(spark, shards, vnodes)
    content = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(key).alias(key),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(F.encode(content, "UTF-8")).alias("text_crc32"),
    )
    # Equal rows are one row with a weight, so no key is large from here on.
    distinct = settle(
        with_arc(
            narrow.groupBy(key, "size", "text_crc32").agg(F.count(F.lit(1)).alias("_times")),
            key,
            points,
        )
    )
    counts = {r["_arc"]: r["n"] for r in distinct.groupBy("_arc").agg(F.sum("_times").alias("n")).collect()}
    rows = walk(points, counts, load_bounds(sum(counts.values()), shards, slack))
    plan = spark.createDataFrame(
        rows, "_plan_arc int, _lo long, _hi long, shard int, _slot long"
    )
    places = ranked(distinct, "_arc", [key, "size", "text_crc32"], weight="_times")
    each = F.explode(F.sequence(F.col("_rank"), F.col("_rank") + F.col("_times") - 1))
    return (
        places.withColumn("_rank", each)
        .join(
            F.broadcast(plan),  # at most MAX_POINTS rows and one for each full shard
            (F.col("_arc") == F.col("_plan_arc"))
            & (F.col("_rank") >= F.col("_lo"))
            & (F.col("_rank") < F.col("_hi")),
        )
        .select(
            key,
            "size",
            "text_crc32",
            "shard",
            (F.col("_slot") + F.col("_rank") - F.col("_lo")).alias("slot"),
        )
    )
