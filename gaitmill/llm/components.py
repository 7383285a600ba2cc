"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaitmill.operators.shared import settle

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) for all nodes of ``edges``.

    ``edges`` has ``u`` and ``v`` of one orderable type; order, repetitions and loops do
    not matter, edges with a null are left out. Every round links all larger neighbours
    of a node to its smallest one, then a node and its smaller neighbours; the number
    of edges never grows, and the number of rounds with the logarithm of the longest
    path. Each round is written to the shared folder, which cuts the lineage.
    """
    start = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = settle(start.where("u > v").distinct())
    seen = _fingerprint(now)
    for _ in range(MAX_ROUNDS):
        if seen[0] == 0:
            break
        now = settle(_small_star(_large_star(now)))
        last, seen = seen, _fingerprint(now)
        if last == seen:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """``edges`` (u > v): larger neighbours of each node, linked to its smallest."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return (
        both.join(lowest, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` (u > v): the node and its smaller neighbours, linked to the smallest."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = lowest.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).where("u > v").distinct()
