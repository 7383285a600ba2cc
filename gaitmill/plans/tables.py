"""Roles that the given tables play for the operators.

``events`` are recordings: one per user, ordered by (ts, event_id), with a
one-dimensional position. ``orders`` and ``lineitem`` are segment manifests,
``embeddings`` are poses, ``part`` and ``orders`` placed terrain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaitmill.operators.balance import BalanceRule
from gaitmill.operators.clean import CleanRule, FrameColumns
from gaitmill.operators.track import Track
from gaitmill.operators.wash import CommandColumns, WashRule

EVENT_KEYS = ("category", "recording_id")
EVENT_ORDER = ("ts_us", "event_id")

EVENTS_AT = FrameColumns(
    keys=EVENT_KEYS, order=EVENT_ORDER, position=("value",), logged_dt="dt", counter="f"
)
# Speeds are value per hour here, so a metre is 1/3600 units.
EVENTS_RULE = CleanRule(
    stuck_dt=2_000.0,
    small_gap_dt=50_000.0,
    big_gap_dt=110_000.0,
    jump_speed=20.0,
    return_speed=20.0,
    min_frames=5,
    min_duration=150_000.0,
    target_dt=20_000.0,
    units_per_metre=1.0 / 3600.0,
)
WASH_AT = CommandColumns(
    keys=EVENT_KEYS, order=EVENT_ORDER, side="side", forward="forward",
    scale=("scale_x", "scale_y", "scale_z"),
)
WASH_RULE = WashRule(eps_side=0.6, eps_mag=0.9, min_frames=3, min_duration=60_000.0)
POSE_RULE = BalanceRule(
    speed_window_s=2.5, max_excursion_m=300.0, max_p95_speed=45.0, max_rotation_deg=120.0
)
ORDERS_RULE = BalanceRule(min_duration_s=3.0, xy_cell_m=25.0, seed=7)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw frames: seconds since 2024, value as position."""
    micros = F.expr(
        "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))"
    )
    k = F.from_json("props", "struct<k: int>")
    return load(spark, sf_dir, "events").select(
        F.concat(F.lit("cat_"), (F.col("user_id") % 5).cast("string")).alias("category"),
        F.col("user_id").alias("recording_id"),
        micros.alias("ts_us"),
        "event_id",
        (micros / 1e6).alias("t"),
        k["k"].cast("double").alias("dt"),
        F.col("event_id").alias("f"),
        "value",
        k.alias("props"),
        "event_type",
    )


EVENTS_SQL = """
ev AS (
  SELECT 'cat_' || CAST(user_id % 5 AS VARCHAR) AS category, user_id AS recording_id,
         epoch_us(ts) - 1704067200000000 AS ts_us, event_id,
         (epoch_us(ts) - 1704067200000000) / 1e6 AS t,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         value, event_type
  FROM events)"""

# decision of every event, with raw neighbours
LABELS_SQL = (
    "WITH "
    + EVENTS_SQL
    + """,
near AS (
  SELECT *, lag(t) OVER w AS t0, lag(value) OVER w AS p0,
         lead(t) OVER w AS t2, lead(value) OVER w AS p2
  FROM ev WINDOW w AS (PARTITION BY recording_id ORDER BY ts_us, event_id)),
speed AS (
  SELECT *, t - t0 AS dt,
         CASE WHEN t - t0 > 0.0001 THEN abs(value - p0) / (t - t0) / (1.0 / 3600.0) END AS sp,
         CASE WHEN t2 - t0 > 0.0001 THEN abs(p2 - p0) / (t2 - t0) / (1.0 / 3600.0) END AS back
  FROM near),
lab AS (
  SELECT *, CASE WHEN dt IS NULL THEN 'keep' WHEN dt < 2000 THEN 'drop_stuck'
       WHEN dt > 110000 THEN 'split' WHEN dt > 50000 THEN 'gap'
       WHEN sp > 20 AND back < 20 THEN 'drop_glitch' WHEN sp > 20 THEN 'split'
       ELSE 'keep' END AS decision
  FROM speed)"""
)

# kept events with their place, and the segments they form
LAYOUT_SQL = (
    LABELS_SQL
    + """,
kept AS (
  SELECT *, lag(t) OVER w AS ta, lag(event_id) OVER w AS ea,
         SUM(CASE WHEN decision = 'split' THEN 1 ELSE 0 END) OVER w AS segment
  FROM lab WHERE decision NOT IN ('drop_stuck', 'drop_glitch')
  WINDOW w AS (PARTITION BY recording_id ORDER BY ts_us, event_id)),
slotted AS (
  SELECT *, CASE WHEN decision = 'gap'
       THEN CAST(greatest(round_even((t - ta) / 20000.0, 0), 1) AS BIGINT) ELSE 1 END AS slots
  FROM kept),
placed AS (
  SELECT *, CAST(SUM(slots) OVER (PARTITION BY recording_id, segment ORDER BY ts_us, event_id)
                 AS BIGINT) - 1 AS place,
         CASE WHEN decision = 'split' THEN CAST(k AS DOUBLE) WHEN ta IS NULL THEN 0.0
              WHEN slots > 1 THEN t - (ta + (slots - 1) / slots * (t - ta))
              ELSE t - ta END AS dt_new
  FROM slotted),
segs AS (
  SELECT category, recording_id, CAST(segment AS BIGINT) AS segment,
         CAST(SUM(slots) AS BIGINT) AS n_frames,
         MAX(CASE WHEN decision = 'split' OR ta IS NULL THEN dt_new END)
           + arg_max(t, (ts_us, event_id)) - arg_min(t, (ts_us, event_id)) AS duration
  FROM placed GROUP BY ALL),
judged AS (
  SELECT *, n_frames >= 5 AND duration >= 150000 AS kept,
         CAST(SUM(CASE WHEN n_frames >= 5 AND duration >= 150000 THEN 1 ELSE 0 END)
              OVER (PARTITION BY recording_id ORDER BY segment) AS BIGINT) - 1 AS no
  FROM segs),
counts AS (
  SELECT category, recording_id, COUNT(*) AS n_in,
         COUNT(*) FILTER (WHERE decision = 'drop_stuck') AS n_stuck,
         COUNT(*) FILTER (WHERE decision = 'drop_glitch') AS n_glitch,
         COUNT(*) FILTER (WHERE decision = 'split') AS n_split,
         COUNT(*) FILTER (WHERE decision = 'gap') AS n_gap,
         COUNT(*) FILTER (WHERE decision <> 'keep') > 0 AS changed
  FROM lab GROUP BY ALL),
cut AS (
  SELECT recording_id, COUNT(*) AS total, COUNT(*) FILTER (WHERE kept) AS kept_n,
         CAST(COALESCE(SUM(n_frames) FILTER (WHERE kept), 0) AS BIGINT) AS out_n
  FROM judged GROUP BY ALL),
manifest AS (
  SELECT category, recording_id, n_in, n_stuck, n_glitch, n_split, n_gap, changed,
         CASE WHEN changed THEN total ELSE 1 END AS segs_total,
         CASE WHEN changed THEN kept_n ELSE 1 END AS segs_kept,
         CASE WHEN changed THEN out_n ELSE n_in END AS n_out_total
  FROM counts JOIN cut USING (recording_id)),
named AS (
  SELECT j.category, j.recording_id, segment, n_frames, duration, changed,
         CASE WHEN changed THEN CAST(recording_id AS VARCHAR) || '_c' || CAST(no AS VARCHAR)
              ELSE CAST(recording_id AS VARCHAR) END AS seg_id
  FROM judged j JOIN counts USING (recording_id) WHERE kept OR NOT changed),
originals AS (
  SELECT p.recording_id, seg_id, place AS frame_idx, t,
         CASE WHEN changed THEN dt_new ELSE CAST(k AS DOUBLE) END AS dt,
         CASE WHEN NOT changed OR decision = 'split' THEN event_id ELSE place END AS f,
         FALSE AS filled, value, k, slots, ta, ea
  FROM placed p JOIN named n USING (recording_id, segment)),
filled_in AS (
  SELECT recording_id, seg_id, frame_idx - slots + i AS frame_idx, ta + i / slots * (t - ta) AS t,
         (ta + i / slots * (t - ta))
           - CASE WHEN i = 1 THEN ta ELSE ta + (i - 1) / slots * (t - ta) END AS dt,
         frame_idx - slots + i AS f, TRUE AS filled,
         a.value + i / slots * (b.value - a.value) AS value,
         CASE WHEN i / slots < 0.5 THEN a.k ELSE b.k END AS k
  FROM originals b
  JOIN (SELECT event_id AS ea, value, k FROM ev) a USING (ea),
  UNNEST(generate_series(CAST(1 AS BIGINT), slots - 1)) u(i)
  WHERE slots > 1),
cleaned AS (
  SELECT recording_id, seg_id, frame_idx, t, dt, f, filled, value, k FROM originals
  UNION ALL SELECT recording_id, seg_id, frame_idx, t, dt, f, filled, value, k FROM filled_in)"""
)

# events numbered within their recording, with command flags
COMMANDS_SQL = (
    "WITH "
    + EVENTS_SQL
    + """,
cmd AS (
  SELECT *, event_type = 'error' AS crouch,
         CASE WHEN event_type = 'signup' THEN (k - 50) / 50.0 ELSE 0.0 END AS side,
         (value - 50) / 50.0 AS forward,
         CASE WHEN event_type <> 'view' THEN 0.7 + k / 1000.0 END AS scale_x,
         row_number() OVER (PARTITION BY recording_id ORDER BY ts_us, event_id) - 1 AS i
  FROM ev),
flag AS (
  SELECT *, abs(side) > 0.6 AND sqrt(side * side + forward * forward) > 0.9 AS steer
  FROM cmd),
bad AS (SELECT *, crouch OR steer AS is_bad FROM flag)"""
)


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as washed input: errors crouch, some signups steer."""
    k = F.col("props.k")
    kind = F.col("event_type")
    scale = F.when(kind != "view", 0.7 + k / 1000.0)
    return events(spark, sf_dir).withColumns(
        {
            "crouch": kind == "error",
            "side": F.when(kind == "signup", (k - 50) / 50.0).otherwise(0.0),
            "forward": (F.col("value") - 50) / 50.0,
            "scale_x": scale,
            "scale_y": scale + 0.01,
            "scale_z": scale - 0.01,
        }
    )


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``frame_idx``, and ``n_frames`` of their recording."""
    rows = commands(spark, sf_dir)
    track = Track.of(rows, EVENT_KEYS, EVENT_ORDER).numbered("frame_idx")
    return track.running(totals={"n_frames": F.lit(1).cast("long")}).result()
