"""Queries over the minimum-duration and stationary-balance filter."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaitmill.operators import balance as b
from gaitmill.plans.registry import REGISTRY
from gaitmill.plans.tables import (
    COMMANDS_SQL,
    ORDERS_RULE,
    POSE_RULE,
    load,
    numbered_events,
)

# -- manifest pair: orders against the sums of their lines -------------------------

PAIR_SQL = """WITH s2 AS (
  SELECT o_orderkey AS seg_id, 1 + o_custkey % 7 AS n_frames, round(o_totalprice, 0) AS duration_s FROM orders),
s3 AS (
  SELECT CASE WHEN l_orderkey % 10 = 9 THEN -l_orderkey ELSE l_orderkey END AS seg_id, COUNT(*) AS n_frames,
         MIN(o_p + CASE WHEN l_orderkey % 3 = 0 THEN 0.5 ELSE 0.0 END) AS duration_s
  FROM lineitem LEFT JOIN (SELECT o_orderkey AS k, round(o_totalprice, 0) AS o_p FROM orders) ON k = l_orderkey
  GROUP BY ALL)"""


@REGISTRY.add(
    PAIR_SQL
    + """, p AS (
  SELECT COALESCE(s2.seg_id, s3.seg_id) AS seg_id,
    CASE WHEN s3.seg_id IS NULL THEN 'missing_stage3' WHEN s2.seg_id IS NULL THEN 'extra_stage3'
         WHEN s2.n_frames <> s3.n_frames THEN 'n_frames_differ'
         WHEN abs(s2.duration_s - s3.duration_s) > 1e-9 THEN 'duration_differs' END AS problem
  FROM s2 FULL OUTER JOIN s3 ON s2.seg_id = s3.seg_id)
SELECT * FROM p WHERE problem IS NOT NULL"""
)
def manifest_pair(spark, sf_dir):
    price = F.round("o_totalprice", 0)
    orders = load(spark, sf_dir, "orders")
    stage2 = orders.select(
        F.col("o_orderkey").alias("seg_id"),
        (1 + F.col("o_custkey") % 7).alias("n_frames"),
        price.alias("duration_s"),
    )
    order = F.col("l_orderkey")  # a tenth of the orders has lines under another number
    lines = load(spark, sf_dir, "lineitem").select(
        F.when(order % 10 == 9, -order).otherwise(order).alias("seg_id")
    )
    shift = F.when(F.col("seg_id") % 3 == 0, 0.5).otherwise(0.0)
    stage3 = (
        lines.groupBy("seg_id")
        .agg(F.count(F.lit(1)).alias("n_frames"))
        .join(stage2.select("seg_id", "duration_s"), "seg_id", "left")
        .withColumn("duration_s", F.col("duration_s") + shift)
    )
    return b.pair_problems(stage2, stage3)


@REGISTRY.add(
    """WITH e AS (SELECT vec_id // 10 AS seg, vec_id % 10 AS i, vec_id % 97 = 0 AS narrow, vec_id % 89 = 0 AS zero
  FROM embeddings),
m AS (SELECT DISTINCT seg AS seg_id, CASE WHEN seg % 13 = 0 THEN 9 ELSE 10 END AS n_frames FROM e),
p AS (SELECT CASE WHEN seg % 17 = 0 THEN -1 - seg ELSE seg END AS seg_id, COUNT(*) AS n, MIN(i) AS lo, MAX(i) AS hi,
  COUNT(*) FILTER (WHERE narrow) AS narrow, COUNT(*) FILTER (WHERE zero AND NOT narrow) AS zero FROM e GROUP BY ALL),
j AS (SELECT m.seg_id, CASE WHEN n IS NULL THEN 'missing_qpos' WHEN narrow > 0 THEN 'wrong_width'
  WHEN zero > 0 THEN 'zero_quaternion' WHEN NOT (lo = 0 AND hi = n - 1 AND n = n_frames) THEN 'frames_differ' END AS problem
  FROM m LEFT JOIN p USING (seg_id))
SELECT * FROM j WHERE problem IS NOT NULL"""
)
def descriptor_problems(spark, sf_dir):
    """Motions of ten vectors each: some without poses, too short ones, narrow and
    zero poses."""
    number = F.col("vec_id")
    motion = F.floor(number / 10).cast("long")
    pose = F.transform(F.slice("embedding", 1, b.QPOS_WIDTH), lambda v: v.cast("double"))
    zeroed = F.concat(F.slice(pose, 1, 3), F.array_repeat(F.lit(0.0), 4), F.slice(pose, 8, 29))
    rows = load(spark, sf_dir, "embeddings").select(
        motion.alias("motion"),
        F.when(motion % 17 == 0, -1 - motion).otherwise(motion).alias("seg_id"),
        (number % 10).alias("frame_idx"),
        F.when(number % 97 == 0, F.slice(pose, 1, b.QPOS_WIDTH - 1))
        .when(number % 89 == 0, zeroed)
        .otherwise(pose)
        .alias("q"),
    )
    motions = rows.select(
        F.col("motion").alias("seg_id"), F.when(F.col("motion") % 13 == 0, 9).otherwise(10).alias("n_frames")
    ).distinct()
    return b.pose_problems(motions, rows)


@REGISTRY.add(
    """WITH s2 AS (SELECT doc_id AS seg_id, n_chars AS n_frames FROM documents),
s3 AS (SELECT doc_id AS seg_id FROM labels),
p AS (SELECT COALESCE(s2.seg_id, s3.seg_id) AS seg_id,
    CASE WHEN s3.seg_id IS NULL THEN 'missing_stage3' WHEN s2.seg_id IS NULL THEN 'extra_stage3' END AS problem
  FROM s2 FULL OUTER JOIN s3 ON s2.seg_id = s3.seg_id)
SELECT * FROM p WHERE problem IS NOT NULL"""
)
def id_pair(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("seg_id"), F.lit(1).alias("n_frames"), F.lit(1.0).alias("duration_s")
    )
    labels = load(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("seg_id"), F.lit(1).alias("n_frames"), F.lit(1.0).alias("duration_s")
    )
    return b.pair_problems(docs, labels)


# -- descriptors: events as poses ---------------------------------------------------

FPS = 2.0

POSE_SQL = COMMANDS_SQL + """,
pose AS (
  SELECT category, recording_id AS seg_id, i AS frame_idx, value AS x, CAST(k AS DOUBLE) AS y,
         1.0 + value / 10.0 AS qw, k / 50.0 AS qx, CAST(event_id % 7 AS DOUBLE) AS qy, 0.5 AS qz,
         COUNT(*) OVER (PARTITION BY recording_id) AS n
  FROM cmd),
wide AS (
  SELECT *, greatest(CAST(round_even(CAST(2.5 * 2.0 AS DOUBLE), 0) AS BIGINT), 1) AS want FROM pose),
sized AS (SELECT *, least(want, n - 1) AS wf, sqrt(qw*qw + qx*qx + qy*qy + qz*qz) AS norm FROM wide),
pair AS (
  SELECT a.*, f.x AS x0, f.y AS y0, f.qw AS w0, f.qx AS a0, f.qy AS b0, f.qz AS c0, f.norm AS n0,
         z.x AS xw, z.y AS yw
  FROM sized a JOIN sized f ON f.seg_id = a.seg_id AND f.frame_idx = 0
  LEFT JOIN sized z ON z.seg_id = a.seg_id AND z.frame_idx = a.frame_idx + a.wf),
step AS (
  SELECT *, sqrt((x - x0) * (x - x0) + (y - y0) * (y - y0)) AS exc,
         sqrt((xw - x) * (xw - x) + (yw - y) * (yw - y)) / (wf / 2.0) AS speed,
         degrees(2 * acos(least(abs(qw*w0 + qx*a0 + qy*b0 + qz*c0) / (norm * n0), 1.0))) AS angle
  FROM pair),
described AS (
  SELECT seg_id, MIN(x0) AS start_x, MIN(y0) AS start_y, arg_max(x, frame_idx) AS end_x,
         arg_max(y, frame_idx) AS end_y, MAX(exc) AS max_excursion_m,
         quantile_cont(speed, 0.95) AS p95_window_speed, MAX(angle) AS max_rotation_deg,
         MIN(wf) AS window_frames
  FROM step GROUP BY ALL)"""


def _poses(spark, sf_dir):
    k = F.col("props.k")
    rows = numbered_events(spark, sf_dir).select(
        "category",
        F.col("recording_id").alias("seg_id"),
        "frame_idx",
        "n_frames",
        F.col("value").alias("x"),
        k.cast("double").alias("y"),
        (1.0 + F.col("value") / 10.0).alias("qw"),
        (k / 50.0).alias("qx"),
        (F.col("event_id") % 7).cast("double").alias("qy"),
        F.lit(0.5).alias("qz"),
    )
    motions = rows.where("frame_idx = 0").select("seg_id", "n_frames", F.lit(FPS).alias("fps"))
    return rows, motions


def _described(spark, sf_dir):
    return b.describe_motions(*_poses(spark, sf_dir), POSE_RULE)


@REGISTRY.add(
    POSE_SQL
    + """ SELECT seg_id, start_x, start_y, end_x, end_y, round(max_excursion_m, 6) AS max_excursion_m,
  round(p95_window_speed, 6) AS p95_window_speed, round(max_rotation_deg, 5) AS max_rotation_deg,
  CAST(window_frames AS BIGINT) AS window_frames FROM described"""
)
def motion_descriptor(spark, sf_dir):
    found = _described(spark, sf_dir).drop("bad_quaternions")
    places = {"max_excursion_m": 6, "p95_window_speed": 6, "max_rotation_deg": 5}
    return found.withColumns({c: F.round(c, p) for c, p in places.items()})


@REGISTRY.add(
    POSE_SQL + " SELECT seg_id, frame_idx, round(speed, 6) AS speed FROM step WHERE speed IS NOT NULL"
)
def window_speeds(spark, sf_dir):
    poses, motions = _poses(spark, sf_dir)
    window = b.window_frames(F.col("fps"), F.col("n_frames"), POSE_RULE.speed_window_s)
    speeds = b.window_speeds(poses, motions.withColumn("window_frames", window))
    return speeds.withColumn("speed", F.round("speed", 6))


@REGISTRY.add(
    POSE_SQL
    + """ SELECT seg_id, max_excursion_m < 300.0 AND p95_window_speed < 45.0
  AND max_rotation_deg < 120.0 AS stationary FROM described"""
)
def stationary_flag(spark, sf_dir):
    return _described(spark, sf_dir).select("seg_id", b.is_stationary(POSE_RULE).alias("stationary"))


# -- balance: orders as motions -------------------------------------------------------

MOTIONS_SQL = """WITH m AS (
  SELECT o_orderkey AS seg_id, o_orderstatus AS category, o_custkey AS source_recording,
         CASE WHEN o_orderpriority LIKE '4%' THEN '' ELSE o_orderpriority END AS terrain_ref,
         o_orderkey % 100 + 60 AS n_frames, o_totalprice / 6000.0 AS duration_s,
         o_totalprice / 5000.0 AS start_x, -(o_custkey % 90) * 1.0 AS start_y,
         o_orderkey % 10 < 6 AS stationary FROM orders),
t AS (
  SELECT *, CASE WHEN terrain_ref <> '' THEN terrain_ref ELSE '__no_terrain__/' || category END AS terrain_group,
         CASE WHEN duration_s < 5 THEN '3-5' WHEN duration_s < 10 THEN '5-10' WHEN duration_s < 20 THEN '10-20'
              WHEN duration_s < 60 THEN '20-60' ELSE '60+' END AS bin,
         CAST(floor(start_x / 25.0) AS BIGINT) AS cx, CAST(floor(start_y / 25.0) AS BIGINT) AS cy
  FROM m),
h AS (
  SELECT *, sha256(concat_ws(chr(31), '7', 'motion', seg_id)) AS hm,
         sha256(concat_ws(chr(31), '7', 'stratum', source_recording, bin, cx, cy)) AS hs,
         COUNT(*) FILTER (WHERE NOT stationary AND duration_s >= 3) OVER (PARTITION BY terrain_group) AS quota
  FROM t),
turn AS (
  SELECT *, row_number() OVER (
    PARTITION BY terrain_group, source_recording, bin, cx, cy ORDER BY hm, seg_id) AS rnd
  FROM h WHERE stationary AND duration_s >= 3),
pick AS (
  SELECT seg_id, quota, row_number() OVER (PARTITION BY terrain_group ORDER BY rnd, hs) AS pick FROM turn),
decided AS (
  SELECT h.*, CASE WHEN duration_s < 3 THEN 'duration_lt_min'
    WHEN h.stationary AND pick.pick > h.quota THEN 'stationary_balance_excess' END AS reject_reason
  FROM h LEFT JOIN pick USING (seg_id))"""


def _motions(spark, sf_dir):
    priority = F.col("o_orderpriority")
    rows = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seg_id"),
        F.col("o_orderstatus").alias("category"),
        F.col("o_custkey").alias("source_recording"),
        F.when(priority.startswith("4"), "").otherwise(priority).alias("terrain_ref"),
        (F.col("o_orderkey") % 100 + 60).alias("n_frames"),
        (F.col("o_totalprice") / 6000.0).alias("duration_s"),
        (F.col("o_totalprice") / 5000.0).alias("start_x"),
        (-(F.col("o_custkey") % 90) * 1.0).alias("start_y"),
        (F.col("o_orderkey") % 10 < 6).alias("stationary"),
    )
    group = b.terrain_group(F.col("category"), F.col("terrain_ref"))
    return rows.withColumn("terrain_group", group)


@REGISTRY.add(
    MOTIONS_SQL
    + """ SELECT seg_id, terrain_group, reject_reason,
  CASE WHEN reject_reason IS NULL THEN 'keep' ELSE 'reject' END AS decision FROM decided"""
)
def balance_select(spark, sf_dir):
    decided = b.decide(_motions(spark, sf_dir), ORDERS_RULE)
    return decided.select("seg_id", "terrain_group", "reject_reason", "decision")


def _scope(scope: str, name: str, group: str) -> str:
    parts = []
    for part, cond in (
        ("input", "TRUE"),
        ("duration_rejected", "reject_reason = 'duration_lt_min'"),
        ("balance_rejected", "reject_reason = 'stationary_balance_excess'"),
        ("output", "reject_reason IS NULL"),
    ):
        parts += [
            f"COUNT(*) FILTER (WHERE {cond}) AS {part}_motions",
            f"CAST(COALESCE(SUM(n_frames) FILTER (WHERE {cond}), 0) AS BIGINT) AS {part}_frames",
            f"round(COALESCE(SUM(duration_s) FILTER (WHERE {cond}), 0.0), 4) AS {part}_duration_s",
        ]
    parts += [
        "COUNT(*) FILTER (WHERE duration_s >= 3) AS eligible_motions",
        "COUNT(*) FILTER (WHERE duration_s >= 3 AND NOT stationary) AS moving_motions",
        "COUNT(*) FILTER (WHERE duration_s >= 3 AND stationary) AS stationary_motions",
    ]
    return f"SELECT '{scope}' AS scope, {name} AS name, {', '.join(parts)} FROM decided {group}"


@REGISTRY.add(
    MOTIONS_SQL
    + " "
    + " UNION ALL ".join(
        [
            _scope("global", "'all'", ""),
            _scope("category", "category", "GROUP BY category"),
            _scope("terrain", "terrain_group", "GROUP BY terrain_group"),
        ]
    )
)
def balance_summary(spark, sf_dir):
    summary = b.summaries(b.decide(_motions(spark, sf_dir), ORDERS_RULE))
    seconds = [c for c in summary.columns if c.endswith("_duration_s")]
    return summary.withColumns({c: F.round(c, 4) for c in seconds})


@REGISTRY.add(
    MOTIONS_SQL
    + """ SELECT reject_reason, category, COUNT(*) AS motions, CAST(SUM(n_frames) AS BIGINT) AS frames
  FROM decided WHERE reject_reason IS NOT NULL GROUP BY ALL"""
)
def balance_audit(spark, sf_dir):
    short, excess = b.audit_tables(b.decide(_motions(spark, sf_dir), ORDERS_RULE))
    return (
        short.unionByName(excess)
        .groupBy("reject_reason", "category")
        .agg(F.count(F.lit(1)).alias("motions"), F.sum("n_frames").alias("frames"))
    )
