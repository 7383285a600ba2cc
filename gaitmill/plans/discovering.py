"""Queries over discovery: pairs, playlists, terrain lookup, limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaitmill.plans.registry import REGISTRY
from gaitmill.plans.tables import load
from gaitmill.sources import captures as cap


@REGISTRY.add(
    """SELECT d.lang AS category, d.doc_id AS recording_id, l.doc_id IS NOT NULL AS has_frames
FROM documents d LEFT JOIN labels l USING (doc_id)"""
)
def recording_pairs(spark, sf_dir):
    metas = load(spark, sf_dir, "documents").select(
        F.col("lang").alias("category"), F.col("doc_id").alias("recording_id")
    )
    labels = load(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("recording_id"), F.col("quality").cast("string").alias("path")
    )
    files = labels.join(metas, "recording_id")
    pairs, alone = cap.recording_pairs(metas, files)
    both = pairs.drop("frames_path").withColumn("has_frames", F.lit(True))
    return both.unionByName(alone.withColumn("has_frames", F.lit(False)))


SEGMENT_SCALE = {"BUILDING": 1.0, "HOUSEHOLD": 0.77, "MACHINERY": 0.77}


@REGISTRY.add(
    """SELECT c_mktsegment AS category, c_custkey AS recording_id,
  CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 1.0 ELSE 0.77 END AS DOUBLE) AS data_scale
FROM customer WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY')
ORDER BY sha256(concat_ws(chr(31), '5', c_mktsegment, c_custkey)), c_mktsegment, c_custkey LIMIT 40"""
)
def playlist(spark, sf_dir):
    pairs = load(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("category"), F.col("c_custkey").alias("recording_id")
    )
    return cap.playlist(pairs, SEGMENT_SCALE, limit=40, seed=5)


@REGISTRY.add(
    """WITH best AS (
  SELECT s_nationkey, arg_min(s_name, (CAST(floor(s_acctbal / 100) AS BIGINT), s_name)) AS path
  FROM supplier GROUP BY ALL)
SELECT c_custkey AS recording_id, CASE WHEN c_custkey % 10 = 0 THEN c_name ELSE path END AS terrain_path
FROM customer LEFT JOIN best ON s_nationkey = c_nationkey AND c_nationkey % 6 <> 0"""
)
def resolve_terrain(spark, sf_dir):
    """Suppliers of a customer's nation are the candidate files, by balance."""
    nation = F.col("c_nationkey")
    recordings = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("recording_id"),
        F.when(nation % 6 == 0, "").otherwise(nation.cast("string")).alias("terrain_ref"),
        F.when(F.col("c_custkey") % 10 == 0, F.col("c_name")).otherwise("").alias("explicit_terrain"),
    )
    candidates = load(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("string").alias("terrain_ref"),
        F.floor(F.col("s_acctbal") / 100).cast("long").alias("priority"),
        F.col("s_name").alias("path"),
    )
    found = cap.resolve_terrain(recordings, candidates)
    return found.select("recording_id", "terrain_path")


@REGISTRY.add(
    "SELECT o_orderstatus, o_orderkey FROM orders ORDER BY o_orderstatus, o_orderkey LIMIT 50"
)
def row_limit(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey")
    return cap.first_rows(rows, ["o_orderstatus", "o_orderkey"], 50)
