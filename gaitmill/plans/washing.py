"""Queries over stage 2: bad frames, good runs, manifests and counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaitmill.operators import wash as w
from gaitmill.plans.registry import REGISTRY
from gaitmill.plans.tables import (
    COMMANDS_SQL,
    EVENT_KEYS,
    WASH_AT,
    WASH_RULE,
    commands,
    load,
    numbered_events,
)

PER_SQL = COMMANDS_SQL + """,
per AS (
  SELECT category, recording_id, COUNT(*) AS input_frames,
         arg_max(t, i) - arg_min(t, i) AS input_duration_s,
         COUNT(*) FILTER (WHERE crouch) AS crouch_frames, COUNT(*) FILTER (WHERE steer) AS steering_frames,
         COUNT(*) FILTER (WHERE crouch AND steer) AS overlap_frames,
         COUNT(*) FILTER (WHERE is_bad) AS bad_union_frames,
         COUNT(*) FILTER (WHERE NOT is_bad) AS good_frames,
         MIN(scale_x) AS min_x, MAX(scale_x) AS max_x,
         COUNT(*) FILTER (WHERE scale_x IS NULL) AS missing_frames
  FROM bad GROUP BY ALL)"""

RUNS_SQL = PER_SQL + """,
mark AS (
  SELECT *, CASE WHEN NOT is_bad AND COALESCE(lag(is_bad) OVER w, TRUE) THEN 1 ELSE 0 END AS starts
  FROM bad WINDOW w AS (PARTITION BY recording_id ORDER BY i)),
island AS (SELECT *, SUM(starts) OVER (PARTITION BY recording_id ORDER BY i) - 1 AS run_no FROM mark),
runs AS (
  SELECT category, recording_id, CAST(run_no AS BIGINT) AS run_no, MIN(i) AS i0, MAX(i) + 1 AS i1,
         COUNT(*) AS n_frames, arg_max(t, i) - arg_min(t, i) AS duration_s,
         printf('%s_seg%03d', CAST(recording_id AS VARCHAR), CAST(run_no AS BIGINT)) AS seg_id
  FROM island WHERE NOT is_bad GROUP BY ALL),
judged AS (SELECT *, n_frames >= 3 AND duration_s >= 60000 AS keep FROM runs)"""


def _runs(spark, sf_dir):
    rows = commands(spark, sf_dir)
    return w.composition(rows, WASH_AT, WASH_RULE), w.good_runs(rows, WASH_AT, WASH_RULE)


@REGISTRY.add(
    PER_SQL
    + """ SELECT category, recording_id, input_frames, input_duration_s, crouch_frames,
  steering_frames, overlap_frames, bad_union_frames, good_frames FROM per"""
)
def wash_composition(spark, sf_dir):
    return w.composition(commands(spark, sf_dir), WASH_AT, WASH_RULE).drop("mesh_scale")


@REGISTRY.add(
    PER_SQL
    + """ SELECT recording_id, min_x, max_x, min_x + 0.01 AS min_y, max_x - 0.01 AS max_z,
  missing_frames FROM per"""
)
def scale_minmax(spark, sf_dir):
    per = w.composition(commands(spark, sf_dir), WASH_AT, WASH_RULE)
    low, high = F.col("mesh_scale.min"), F.col("mesh_scale.max")
    return per.select(
        "recording_id",
        F.get(low, F.lit(0)).alias("min_x"),
        F.get(high, F.lit(0)).alias("max_x"),
        F.get(low, F.lit(1)).alias("min_y"),
        F.get(high, F.lit(2)).alias("max_z"),
        "mesh_scale.missing_frames",
    )


@REGISTRY.add(RUNS_SQL + " SELECT * FROM judged")
def wash_runs(spark, sf_dir):
    return _runs(spark, sf_dir)[1]


@REGISTRY.add(
    RUNS_SQL
    + """ SELECT j.category, j.recording_id, seg_id, i0, i1, n_frames, duration_s,
  CAST(50 + recording_id % 3 * 10 AS DOUBLE) AS fps_src, 'washed' AS status, CAST(0.6 AS DOUBLE) AS eps_side,
  min_x, missing_frames
  FROM judged j JOIN per USING (recording_id) WHERE keep"""
)
def wash_manifest(spark, sf_dir):
    per, runs = _runs(spark, sf_dir)
    rate = (50 + F.col("recording_id") % 3 * 10).cast("double")
    meta = per.select(*EVENT_KEYS, rate.alias("sample_rate_hz"))
    rows = w.accepted_manifest(runs, per, meta, WASH_AT, WASH_RULE)
    return rows.select(
        *EVENT_KEYS, "seg_id", "i0", "i1", "n_frames", "duration_s", "fps_src", "status",
        "wash.eps_side", F.get("mesh_scale.min", F.lit(0)).alias("min_x"), "mesh_scale.missing_frames",
    )


@REGISTRY.add(
    RUNS_SQL
    + """ SELECT seg_id, i0, i1, n_frames, 'crouch_steering_wash' AS reject_stage,
  'too_short_after_crouch_steering' AS reject_reason,
  'frames=' || n_frames || ' (min=3), duration=' || format('{:.6f}', duration_s)
    || 's (min=60000.000000s)' AS detail
  FROM judged WHERE NOT keep"""
)
def wash_rejects(spark, sf_dir):
    rejects = w.reject_manifest(_runs(spark, sf_dir)[1], WASH_RULE)
    return rejects.select("seg_id", "i0", "i1", "n_frames", "reject_stage", "reject_reason", "detail")


@REGISTRY.add(
    RUNS_SQL
    + """, agg AS (
  SELECT recording_id, COUNT(*) AS candidate_runs, COUNT(*) FILTER (WHERE keep) AS kept_segments,
         COUNT(*) FILTER (WHERE NOT keep) AS rejected_segments,
         SUM(n_frames) FILTER (WHERE keep) AS output_frames,
         SUM(duration_s) FILTER (WHERE keep) AS output_duration_s,
         SUM(n_frames) FILTER (WHERE NOT keep) AS rejected_good_frames,
         SUM(duration_s) FILTER (WHERE NOT keep) AS rejected_good_duration_s
  FROM judged GROUP BY ALL),
failed AS (SELECT category, COUNT(*) AS n FROM per WHERE recording_id % 4 = 0 GROUP BY ROLLUP (category)),
counted AS (SELECT category, COUNT(*) AS input_files, CAST(SUM(input_frames) AS BIGINT) AS input_frames,
  round(SUM(input_duration_s), 4) AS input_duration_s,
  CAST(SUM(crouch_frames) AS BIGINT) AS crouch_frames,
  CAST(SUM(steering_frames) AS BIGINT) AS steering_frames,
  CAST(SUM(overlap_frames) AS BIGINT) AS overlap_frames,
  CAST(SUM(bad_union_frames) AS BIGINT) AS bad_union_frames,
  CAST(SUM(good_frames) AS BIGINT) AS good_frames,
  CAST(SUM(candidate_runs) AS BIGINT) AS candidate_runs,
  CAST(SUM(kept_segments) AS BIGINT) AS kept_segments,
  CAST(SUM(rejected_segments) AS BIGINT) AS rejected_segments,
  CAST(SUM(output_frames) AS BIGINT) AS output_frames,
  round(SUM(output_duration_s), 4) AS output_duration_s,
  CAST(SUM(rejected_good_frames) AS BIGINT) AS rejected_good_frames,
  round(SUM(rejected_good_duration_s), 4) AS rejected_good_duration_s,
  COUNT(*) FILTER (WHERE bad_union_frames = 0) AS files_without_bad,
  COUNT(*) FILTER (WHERE COALESCE(kept_segments, 0) = 0) AS files_all_rejected
FROM per LEFT JOIN agg USING (recording_id) GROUP BY ROLLUP (category))
SELECT counted.*, COALESCE(failed.n, 0) AS parse_failures
FROM counted LEFT JOIN failed ON counted.category IS NOT DISTINCT FROM failed.category"""
)
def wash_counters(spark, sf_dir):
    per, runs = _runs(spark, sf_dir)
    # For every fourth recording one more that could not be read.
    number = F.col("recording_id")
    broken = per.where(number % 4 == 0).select("category", (-1 - number).alias("recording_id"))
    counters = w.wash_counters(per, runs, broken, WASH_AT)
    seconds = ("input_duration_s", "output_duration_s", "rejected_good_duration_s")
    return counters.withColumns({c: F.round(c, 4) for c in seconds})


@REGISTRY.add(
    RUNS_SQL
    + """ SELECT seg_id, i - i0 AS frame_idx, event_id, value FROM island
  JOIN judged USING (recording_id, run_no) WHERE keep AND NOT is_bad"""
)
def washed_frames(spark, sf_dir):
    numbered = numbered_events(spark, sf_dir)
    runs = w.good_runs(numbered, WASH_AT, WASH_RULE)
    rows = w.washed_frames(numbered, runs.where("keep"), EVENT_KEYS)
    return rows.select("seg_id", "frame_idx", "event_id", "value")


@REGISTRY.add(
    """WITH d AS (SELECT lang, source, doc_id, strpos(text, '@') > 0 AS broken FROM documents),
b AS (SELECT lang, source, COUNT(*) AS n FROM d WHERE broken GROUP BY ALL)
SELECT lang, source, 'source_parse_failed' AS reject_reason,
  n || ' unreadable frame(s)' AS detail, CAST(NULL AS BIGINT) AS readable FROM b
UNION ALL
SELECT lang, source, NULL, NULL, COUNT(*) FROM d
WHERE (lang, source) NOT IN (SELECT (lang, source) FROM b) GROUP BY ALL"""
)
def parse_isolation(spark, sf_dir):
    """A document with an @ stands for an unreadable line of its (lang, source)."""
    keys = ["lang", "source"]
    docs = load(spark, sf_dir, "documents").withColumn(
        "_corrupt", F.when(F.col("text").contains("@"), F.lit("bad"))
    )
    broken = w.parse_rejects(docs.select(*keys, "_corrupt"), "_corrupt", keys, name="source")
    rest = w.readable(docs.select(*keys, "doc_id"), broken, keys)
    good = rest.groupBy(*keys).agg(F.count(F.lit(1)).alias("readable"))
    rejects = broken.select(*keys, "reject_reason", "detail")
    return rejects.unionByName(good, allowMissingColumns=True)
