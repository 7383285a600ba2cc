"""Queries over stage 3: scales, pose checks, QA, and the forward-only filter."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaitmill.operators import forward as fw
from gaitmill.operators import stage3 as g
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

# -- scale inference: parts as segments, sizes as recorded mesh scales -----------

SCALE_SQL = """WITH s AS (
  SELECT p_partkey AS seg_id, p_brand AS category, p_size AS n_frames, p_retailprice AS duration_s,
         CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 0.603 + p_size * CAST(0.01 AS DOUBLE) END AS low,
         0.603 + p_size * CAST(0.01 AS DOUBLE) + (p_partkey % 4) * CAST(0.008 AS DOUBLE) AS high,
         CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END AS missing FROM part),
m AS (SELECT *, (low * 3 + high * 3) / 6 AS mean FROM s),
j AS (
  SELECT *, CASE WHEN low IS NULL OR missing > 0 THEN 'missing' WHEN high - low > 0.02 THEN 'drifts'
    WHEN abs(mean - 0.77) <= 0.05 OR abs(mean - 1.0) <= 0.05 THEN NULL ELSE 'unsupported' END AS problem
  FROM m)"""


def _scaled(spark, sf_dir):
    key = F.col("p_partkey")
    base = 0.603 + F.col("p_size") * F.lit(0.01)
    parts = load(spark, sf_dir, "part").select(
        key.alias("seg_id"),
        F.col("p_brand").alias("category"),
        F.col("p_size").cast("long").alias("n_frames"),
        F.col("p_retailprice").alias("duration_s"),
        F.when(key % 11 != 0, base).alias("low"),
        (base + (key % 4) * F.lit(0.008)).alias("high"),
        F.when(key % 7 == 0, 1).otherwise(0).alias("missing"),
    )
    return g.infer_scale(parts, [F.col("low")] * 3, [F.col("high")] * 3, F.col("missing"))


@REGISTRY.add(
    SCALE_SQL
    + """ SELECT seg_id, problem AS scale_problem,
  CASE WHEN problem IS NULL THEN round(mean, 6) END AS mesh_scale_observed,
  CAST(CASE WHEN problem IS NOT NULL THEN NULL WHEN abs(mean - 0.77) <= 0.05 THEN 1.0 ELSE 0.77 END
       AS DOUBLE) AS data_scale FROM j"""
)
def infer_scale(spark, sf_dir):
    return _scaled(spark, sf_dir).select(
        "seg_id",
        "scale_problem",
        F.round("mesh_scale_observed", 6).alias("mesh_scale_observed"),
        "data_scale",
    )


@REGISTRY.add(
    SCALE_SQL
    + """, r AS (
  SELECT seg_id, problem IS NULL AS ready,
         CASE WHEN problem IS NOT NULL THEN 'invalid_or_unknown_data_scale' END AS reject_reason,
         'mesh scale ' || problem AS detail FROM j)
SELECT ready, reject_reason, detail, COUNT(*) AS n FROM r GROUP BY ALL"""
)
def work_split(spark, sf_dir):
    ready, rejected = g.split_work(_scaled(spark, sf_dir))
    both = ready.withColumn("ready", F.lit(True)).unionByName(
        rejected.withColumn("ready", F.lit(False)), allowMissingColumns=True
    )
    return both.groupBy("ready", "reject_reason", "detail").agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add(
    SCALE_SQL
    + """ SELECT category, COUNT(*) AS segments, CAST(SUM(n_frames) AS BIGINT) AS frames,
  round(SUM(duration_s), 4) AS duration_s FROM j WHERE problem IS NULL GROUP BY ROLLUP (category)"""
)
def stage_stats(spark, sf_dir):
    ready, _ = g.split_work(_scaled(spark, sf_dir))
    return g.stage_stats(ready).withColumn("duration_s", F.round("duration_s", 4))


@REGISTRY.add(
    COMMANDS_SQL
    + """, mark AS (
  SELECT *, CASE WHEN NOT is_bad AND COALESCE(lag(is_bad) OVER w, TRUE) THEN 1 ELSE 0 END AS starts
  FROM bad WINDOW w AS (PARTITION BY recording_id ORDER BY i)),
island AS (SELECT *, SUM(starts) OVER (PARTITION BY recording_id ORDER BY i) - 1 AS run_no FROM mark),
runs AS (
  SELECT category, recording_id, run_no, COUNT(*) AS n, arg_max(t, i) - arg_min(t, i) AS d
  FROM island WHERE NOT is_bad GROUP BY ALL),
"""
    + SCALE_SQL.removeprefix("WITH ")
    + """
SELECT 'crouch_steering_wash' AS reject_stage, 'too_short_after_crouch_steering' AS reject_reason,
  category, COUNT(*) AS n FROM runs WHERE NOT (n >= 3 AND d >= 60000) GROUP BY ALL
UNION ALL
SELECT 'retarget', 'invalid_or_unknown_data_scale', category, COUNT(*) FROM j
WHERE problem IS NOT NULL GROUP BY ALL"""
)
def reject_union(spark, sf_dir):
    runs = w.good_runs(commands(spark, sf_dir), WASH_AT, WASH_RULE)
    washed = w.reject_manifest(runs, WASH_RULE).drop("recording_id")
    _, scaled = g.split_work(_scaled(spark, sf_dir))
    scaled = scaled.withColumn("seg_id", F.col("seg_id").cast("string"))
    union = g.final_rejects(washed, scaled.drop("low", "high", "missing"))
    return union.groupBy("reject_stage", "reject_reason", "category").agg(
        F.count(F.lit(1)).alias("n")
    )


# -- QA ------------------------------------------------------------------------------


@REGISTRY.add(
    """WITH e AS (
  SELECT event_id, CASE WHEN event_type <> 'view' THEN user_id || '_' || event_type END AS seg_id FROM events)
SELECT event_id, seg_id, seg_id IS NULL OR
  row_number() OVER (PARTITION BY seg_id ORDER BY event_id) > 1 AS bad_id FROM e"""
)
def qa_duplicates(spark, sf_dir):
    name = F.concat_ws("_", F.col("user_id").cast("string"), "event_type")
    rows = load(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "view", name).alias("seg_id")
    )
    return g.repeated_ids(rows, "seg_id", "event_id")


def _poses(spark, sf_dir, width: int = 64):
    """Embeddings as poses of a segment per label; some are cut short."""
    short = F.slice("embedding", 1, 63)
    cut = (F.col("label") == 3) & (F.col("vec_id") % 5 == 0)
    return load(spark, sf_dir, "embeddings").select(
        F.col("label").alias("seg_id"), F.when(cut, short).otherwise(F.col("embedding")).alias("q")
    )


POSES_SQL = """WITH p AS (
  SELECT label AS seg_id, CASE WHEN label = 3 AND vec_id % 5 = 0 THEN embedding[1:63] ELSE embedding END AS q
  FROM embeddings),
chk AS (
  SELECT seg_id, COUNT(*) AS pose_rows, bool_and(len(q) = 64) AS width_ok,
         bool_and(len(list_filter(q, lambda x: NOT isfinite(x))) = 0) AS finite_ok FROM p GROUP BY ALL)"""


@REGISTRY.add(POSES_SQL + " SELECT * FROM chk")
def qa_vectors(spark, sf_dir):
    return g.pose_check(_poses(spark, sf_dir), width=64)


def _work(spark, sf_dir):
    """Suppliers as a manifest: the nation is the segment, so ids repeat."""
    return load(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("seg_id"),
        F.col("s_suppkey").alias("row_no"),
        (49 + F.col("s_suppkey") % 5).alias("n_frames"),
    )


WORK_SQL = POSES_SQL + """,
man AS (SELECT s_nationkey AS seg_id, s_suppkey AS row_no, 49 + s_suppkey % 5 AS n_frames FROM supplier),
"""


@REGISTRY.add(
    WORK_SQL
    + """j AS (SELECT man.*, chk.* EXCLUDE (seg_id) FROM man JOIN chk USING (seg_id))
SELECT seg_id, row_no, CASE WHEN NOT width_ok THEN 'qpos_shape_mismatch'
  WHEN pose_rows <> n_frames THEN 'length_mismatch'
  WHEN NOT finite_ok THEN 'non_finite_qpos' END AS reject_reason FROM j"""
)
def failure_reasons(spark, sf_dir):
    checks = g.pose_check(_poses(spark, sf_dir), width=64)
    rows = _work(spark, sf_dir).join(checks, "seg_id")
    return g.failure_reason(rows).select("seg_id", "row_no", "reject_reason")


@REGISTRY.add(
    WORK_SQL
    + """done AS (
  SELECT seg_id FROM man JOIN chk USING (seg_id) WHERE width_ok AND finite_ok AND pose_rows = n_frames)
SELECT seg_id, row_no, n_frames FROM man WHERE seg_id NOT IN (SELECT seg_id FROM done)"""
)
def skip_existing(spark, sf_dir):
    return g.still_to_do(_work(spark, sf_dir), g.pose_check(_poses(spark, sf_dir), width=64))


QA_SQL = WORK_SQL + COMMANDS_SQL.removeprefix("WITH ") + """,
src AS (
  SELECT recording_id % 20 AS seg_id, COUNT(*) AS source_rows, COUNT(*) FILTER (WHERE is_bad) AS source_bad
  FROM bad GROUP BY ALL),
q AS (
  SELECT m.*, chk.pose_rows, chk.width_ok, chk.finite_ok, r.r_regionkey IS NOT NULL AS has_meta,
         src.source_rows, src.source_bad,
         row_number() OVER (PARTITION BY m.seg_id ORDER BY row_no) > 1 AS bad_id
  FROM man m LEFT JOIN chk USING (seg_id) LEFT JOIN region r ON r.r_regionkey = m.seg_id
  LEFT JOIN src ON src.seg_id = m.seg_id),
why AS (
  SELECT *, concat_ws(';',
    CASE WHEN bad_id THEN 'missing_or_duplicate_seg_id' END,
    CASE WHEN pose_rows IS NULL THEN 'missing_qpos' END,
    CASE WHEN NOT width_ok THEN 'qpos_shape' END,
    CASE WHEN pose_rows <> n_frames THEN 'length=' || pose_rows || ' expected=' || n_frames END,
    CASE WHEN NOT finite_ok THEN 'non_finite_qpos' END,
    CASE WHEN NOT has_meta THEN 'missing_segment_meta' END,
    CASE WHEN source_rows IS NULL THEN 'missing_washed_source' END,
    CASE WHEN source_rows <> n_frames THEN 'source_length=' || source_rows || ' expected=' || n_frames END,
    CASE WHEN source_bad > 0 THEN 'source_bad_frames=' || source_bad END) AS reasons
  FROM q)"""


def _judged(spark, sf_dir):
    sources = commands(spark, sf_dir).withColumn("seg_id", F.col("recording_id") % 20)
    metas = load(spark, sf_dir, "region").select(F.col("r_regionkey").alias("seg_id"))
    return g.qa_reasons(
        _work(spark, sf_dir),
        g.pose_check(_poses(spark, sf_dir), width=64),
        metas,
        g.source_check(sources, "seg_id", WASH_AT, WASH_RULE),
    )


@REGISTRY.add(QA_SQL + " SELECT row_no, seg_id, reasons FROM why")
def qa_reasons(spark, sf_dir):
    judged = _judged(spark, sf_dir)
    return judged.select("row_no", "seg_id", F.array_join("reasons", ";").alias("reasons"))


@REGISTRY.add(
    QA_SQL
    + """ SELECT COUNT(*) AS segments, COUNT(*) FILTER (WHERE NOT bad_id) AS unique_seg_ids,
  CAST(COALESCE(SUM(pose_rows), 0) AS BIGINT) AS qpos_frames_checked,
  CAST(COALESCE(SUM(source_rows), 0) AS BIGINT) AS source_frames_checked,
  COUNT(*) FILTER (WHERE reasons <> '') AS failures,
  CASE WHEN COUNT(*) FILTER (WHERE reasons <> '') = 0 THEN 'ok' ELSE 'failed' END AS status FROM why"""
)
def qa_summary(spark, sf_dir):
    return g.qa_summary(_judged(spark, sf_dir))


# -- forward-only filter: a short run of events is a motion ---------------------------

FORWARD_EPS = 0.99

MOTION_SQL = COMMANDS_SQL + """,
scan AS (
  SELECT recording_id AS seg_id, COUNT(*) AS frame_count,
         COUNT(*) FILTER (WHERE forward < -0.99) AS backward_frames,
         MIN(i) FILTER (WHERE forward < -0.99) AS first_backward_frame,
         MAX(i) FILTER (WHERE forward < -0.99) AS last_backward_frame,
         MIN(forward) AS min_forward_cmd, MAX(forward) AS max_forward_cmd,
         CAST(0 AS BIGINT) AS invalid_frames
  FROM cmd GROUP BY ALL),
man AS (
  SELECT category, recording_id AS seg_id, COUNT(*) AS n_frames, MAX(t) - MIN(t) AS duration_s
  FROM ev GROUP BY ALL),
jd AS (SELECT man.*, scan.* EXCLUDE (seg_id), backward_frames = 0 AS keep FROM man JOIN scan USING (seg_id))"""


def _forward(spark, sf_dir):
    frames = numbered_events(spark, sf_dir)
    scan = fw.scan_motion(
        frames.withColumnRenamed("recording_id", "seg_id"), ["seg_id"], "frame_idx", "forward", FORWARD_EPS
    )
    manifest = frames.groupBy(*EVENT_KEYS).agg(
        F.count(F.lit(1)).alias("n_frames"), (F.max("t") - F.min("t")).alias("duration_s")
    )
    return fw.judge(manifest.withColumnRenamed("recording_id", "seg_id"), scan)


@REGISTRY.add(
    COMMANDS_SQL
    + """, odd AS (SELECT * REPLACE (CASE WHEN event_id % 41 <> 0 THEN forward END AS forward) FROM cmd)
SELECT recording_id AS seg_id, COUNT(*) AS frame_count,
  COUNT(*) FILTER (WHERE forward < -0.99) AS backward_frames,
  MIN(i) FILTER (WHERE forward < -0.99) AS first_backward_frame,
  MAX(i) FILTER (WHERE forward < -0.99) AS last_backward_frame,
  MIN(forward) AS min_forward_cmd, MAX(forward) AS max_forward_cmd,
  COUNT(*) FILTER (WHERE forward IS NULL) AS invalid_frames FROM odd GROUP BY ALL"""
)
def forward_scan(spark, sf_dir):
    """Some frames have no command."""
    rows = numbered_events(spark, sf_dir).withColumnRenamed("recording_id", "seg_id")
    rows = rows.withColumn("forward", F.when(F.col("event_id") % 41 != 0, F.col("forward")))
    return fw.scan_motion(rows, ["seg_id"], "frame_idx", "forward", FORWARD_EPS)


@REGISTRY.add(
    MOTION_SQL
    + """ SELECT seg_id, keep, CASE WHEN NOT keep THEN 'contains_backward_cmd' END AS reject_reason,
  CASE WHEN NOT keep THEN 'backward frames=' || backward_frames || ', first=' || first_backward_frame
    || ', last=' || last_backward_frame END AS detail FROM jd"""
)
def forward_keep(spark, sf_dir):
    return _forward(spark, sf_dir).select("seg_id", "keep", "reject_reason", "detail")


@REGISTRY.add(
    MOTION_SQL
    + """ SELECT category, COUNT(*) AS input_motions, CAST(SUM(n_frames) AS BIGINT) AS input_frames,
  round(SUM(duration_s), 4) AS input_duration_s, COUNT(*) FILTER (WHERE keep) AS kept_motions,
  CAST(COALESCE(SUM(n_frames) FILTER (WHERE keep), 0) AS BIGINT) AS kept_frames,
  round(COALESCE(SUM(duration_s) FILTER (WHERE keep), 0.0), 4) AS kept_duration_s,
  COUNT(*) FILTER (WHERE NOT keep) AS backward_motions,
  CAST(COALESCE(SUM(n_frames) FILTER (WHERE NOT keep), 0) AS BIGINT) AS backward_motion_frames,
  round(COALESCE(SUM(duration_s) FILTER (WHERE NOT keep), 0.0), 4) AS backward_motion_duration_s,
  CAST(SUM(backward_frames) AS BIGINT) AS backward_frames FROM jd GROUP BY ROLLUP (category)"""
)
def forward_counters(spark, sf_dir):
    seconds = ("input_duration_s", "kept_duration_s", "backward_motion_duration_s")
    counters = fw.counters(_forward(spark, sf_dir))
    return counters.withColumns({c: F.round(c, 4) for c in seconds})


@REGISTRY.add(
    MOTION_SQL
    + """ SELECT keep, COUNT(*) AS n, round(SUM(duration_s) / 3600.0, 6) AS total_h,
  MIN(duration_s) AS min, round(AVG(duration_s), 5) AS mean, MAX(duration_s) AS max,
  round(median(duration_s), 7) AS median FROM jd GROUP BY ALL"""
)
def forward_durations(spark, sf_dir):
    places = {"total_h": 6, "mean": 5, "median": 7}
    found = fw.kept_and_lost_durations(_forward(spark, sf_dir))
    return found.withColumns({c: F.round(c, p) for c, p in places.items()})


SOLVED_SQL = """WITH a AS (SELECT doc_id AS seg_id FROM labels WHERE quality = 1),
r AS (SELECT doc_id AS seg_id FROM labels WHERE quality = 0),
g AS (SELECT CASE WHEN lang = 'de' THEN -1 - doc_id ELSE doc_id END AS seg_id, lang AS category,
  n_chars AS n_frames FROM documents)"""


def _solved(spark, sf_dir):
    """Good labels are accepted, bad ones rejected; documents are the poses, German ones
    under a number that nothing decided on."""
    labels = load(spark, sf_dir, "labels").withColumnRenamed("doc_id", "seg_id")
    number = F.when(F.col("lang") == "de", -1 - F.col("doc_id")).otherwise(F.col("doc_id"))
    solved = load(spark, sf_dir, "documents").select(
        number.alias("seg_id"), F.col("lang").alias("category"), F.col("n_chars").alias("n_frames")
    )
    return labels.where("quality = 1"), labels.where("quality = 0"), solved


@REGISTRY.add(
    SOLVED_SQL
    + """ SELECT seg_id, 'missing_qpos' AS problem FROM a WHERE seg_id NOT IN (SELECT seg_id FROM g)
  UNION ALL SELECT seg_id, 'not_decided' FROM g
  WHERE seg_id NOT IN (SELECT seg_id FROM a UNION ALL SELECT seg_id FROM r)"""
)
def subset_checks(spark, sf_dir):
    return fw.set_differences(*_solved(spark, sf_dir))


@REGISTRY.add(
    SOLVED_SQL
    + """ SELECT seg_id, category, n_frames, 'qa_ok_forward_only' AS status,
  'backward_motion_filter' AS version FROM g WHERE seg_id IN (SELECT seg_id FROM a)"""
)
def subset_solved(spark, sf_dir):
    accepted, _, solved = _solved(spark, sf_dir)
    kept = fw.subset_solved(solved, accepted)
    return kept.select("seg_id", "category", "n_frames", "status", "forward_only.version")


@REGISTRY.add(
    SOLVED_SQL
    + """ SELECT seg_id, category, n_frames, 'backward_motion_filter' AS reject_stage,
  'contains_backward_cmd' AS reject_reason FROM g WHERE seg_id IN (SELECT seg_id FROM r)"""
)
def solved_rejects(spark, sf_dir):
    _, rejected, solved = _solved(spark, sf_dir)
    return fw.solved_rejects(solved, rejected)
