"""Queries over stage 1: labels, segments, gap filling, dataset versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaitmill.operators import clean as c
from gaitmill.operators import versions
from gaitmill.operators.shared import settle
from gaitmill.plans.registry import REGISTRY
from gaitmill.plans.tables import (
    EVENT_KEYS,
    EVENTS_AT,
    EVENTS_RULE,
    EVENTS_SQL,
    LABELS_SQL,
    LAYOUT_SQL,
    events,
)


def _cleaned(spark, sf_dir, settled=False):
    rows = events(spark, sf_dir)
    return rows, c.clean(rows, EVENTS_AT, EVENTS_RULE, settled=settled)


def _cleaned_rows(spark, sf_dir):
    rows, cleaned = _cleaned(spark, sf_dir, settled=True)
    filled = c.cleaned_frames(rows, cleaned, EVENTS_AT, values=["value", "props"])
    return rows, cleaned, filled.withColumn("k", F.col("props.k").cast("long"))


@REGISTRY.add(LABELS_SQL + " SELECT recording_id, event_id, decision FROM lab")
def frame_labels(spark, sf_dir):
    labelled = c.label_frames(events(spark, sf_dir), EVENTS_AT, EVENTS_RULE)
    return labelled.result().select("recording_id", "event_id", "decision")


@REGISTRY.add(
    LABELS_SQL
    + """ SELECT category, recording_id, COUNT(*) AS n_in,
  COUNT(*) FILTER (WHERE decision = 'drop_stuck') AS n_stuck,
  COUNT(*) FILTER (WHERE decision = 'drop_glitch') AS n_glitch,
  COUNT(*) FILTER (WHERE decision = 'split') AS n_split,
  COUNT(*) FILTER (WHERE decision = 'gap') AS n_gap
  FROM lab GROUP BY ALL"""
)
def label_counts(spark, sf_dir):
    labelled = c.label_frames(events(spark, sf_dir), EVENTS_AT, EVENTS_RULE)
    return c.label_counts(labelled.df, EVENT_KEYS)


@REGISTRY.add(
    LAYOUT_SQL
    + """ SELECT recording_id, event_id, CAST(segment AS BIGINT) AS segment, slots, place, dt_new,
  CASE WHEN decision = 'split' THEN event_id ELSE place END AS f_new FROM placed"""
)
def frame_layout(spark, sf_dir):
    labelled = c.label_frames(events(spark, sf_dir), EVENTS_AT, EVENTS_RULE)
    laid_out = c.lay_out(labelled, EVENTS_AT, EVENTS_RULE).result()
    return laid_out.select(
        "recording_id", "event_id", "segment", "slots", "place", "dt_new", "f_new"
    )


@REGISTRY.add(
    LAYOUT_SQL
    + """ SELECT category, recording_id, segment, n_frames, round(duration, 6) AS duration, kept,
  CASE WHEN kept THEN no END AS kept_no FROM judged"""
)
def clean_segments(spark, sf_dir):
    segments = _cleaned(spark, sf_dir)[1].segments
    return segments.withColumn("duration", F.round("duration", 6))


@REGISTRY.add(
    LAYOUT_SQL
    + " SELECT recording_id, segment, seg_id, n_frames, round(duration, 6) AS duration FROM named"
)
def segment_filter(spark, sf_dir):
    kept = c.output_segments(_cleaned(spark, sf_dir)[1], EVENTS_AT)
    return kept.select(
        "recording_id", "segment", "seg_id", "n_frames", F.round("duration", 6).alias("duration")
    )


@REGISTRY.add(LAYOUT_SQL + " SELECT seg_id, frame_idx, t, dt, f, filled, value, k FROM cleaned")
def gap_fill(spark, sf_dir):
    filled = _cleaned_rows(spark, sf_dir)[2]
    return filled.select("seg_id", "frame_idx", "t", "dt", "f", "filled", "value", "k")


@REGISTRY.add(LAYOUT_SQL + " SELECT * FROM manifest")
def clean_manifest(spark, sf_dir):
    return _cleaned(spark, sf_dir)[1].manifest


@REGISTRY.add(
    LAYOUT_SQL
    + """ SELECT COUNT(*) AS files, COUNT(*) FILTER (WHERE changed) AS files_changed,
  COUNT(*) FILTER (WHERE NOT changed) AS files_unchanged,
  CAST(SUM(n_in) AS BIGINT) AS frames_in, CAST(SUM(n_out_total) AS BIGINT) AS frames_out,
  CAST(SUM(n_stuck) AS BIGINT) AS stuck, CAST(SUM(n_glitch) AS BIGINT) AS glitch,
  CAST(SUM(n_split) AS BIGINT) AS splits, CAST(SUM(n_gap) AS BIGINT) AS gaps,
  CAST(SUM(segs_total) AS BIGINT) AS segs_total,
  CAST(SUM(segs_total - segs_kept) AS BIGINT) AS segs_dropped FROM manifest"""
)
def clean_stats(spark, sf_dir):
    return _cleaned(spark, sf_dir)[1].stats


# -- dataset versions: recordings with no stuck frame stay as they are ---------


def _versions(spark, sf_dir):
    rows, cleaned, filled = _cleaned_rows(spark, sf_dir)
    manifest = settle(cleaned.manifest.withColumn("changed", F.col("n_stuck") > 2))
    columns = ["category", "recording_id", "seg_id", "t", "value"]
    raw = rows.withColumn("seg_id", F.col("recording_id").cast("string")).select(*columns)
    changed = manifest.where("changed").select(*EVENT_KEYS)
    segments = settle(filled.select(*columns).join(changed, list(EVENT_KEYS), "left_semi"))
    return raw, manifest, segments, c.output_segments(cleaned, EVENTS_AT)


VERSIONS_SQL = LAYOUT_SQL + """,
swapped AS (SELECT recording_id FROM manifest WHERE n_stuck > 2),
applied AS (
  SELECT CAST(recording_id AS VARCHAR) AS seg_id, value FROM ev
  WHERE recording_id NOT IN (SELECT recording_id FROM swapped)
  UNION ALL
  SELECT seg_id, value FROM cleaned WHERE recording_id IN (SELECT recording_id FROM swapped))"""


@REGISTRY.add(
    VERSIONS_SQL
    + " SELECT seg_id, COUNT(*) AS n_rows, round(SUM(value), 4) AS total FROM applied GROUP BY ALL"
)
def dataset_apply(spark, sf_dir):
    raw, manifest, segments, _ = _versions(spark, sf_dir)
    applied = versions.apply_cleaning(raw, manifest, segments, EVENT_KEYS)
    return applied.groupBy("seg_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 4).alias("total")
    )


@REGISTRY.add(
    VERSIONS_SQL
    + """ SELECT recording_id, 'removed' AS action, CAST(recording_id AS VARCHAR) AS item FROM swapped
  UNION ALL SELECT recording_id, 'placed', seg_id FROM named
  WHERE recording_id IN (SELECT recording_id FROM swapped)"""
)
def dataset_swaps(spark, sf_dir):
    _, manifest, _, names = _versions(spark, sf_dir)
    return versions.swap_manifest(manifest, names, EVENT_KEYS).select(
        "recording_id", "action", "item"
    )


@REGISTRY.add(
    "WITH " + EVENTS_SQL
    + """ SELECT CAST(recording_id AS VARCHAR) AS seg_id, COUNT(*) AS n_rows,
  round(SUM(value), 4) AS total FROM ev GROUP BY ALL"""
)
def dataset_rollback(spark, sf_dir):
    raw, manifest, segments, names = _versions(spark, sf_dir)
    applied = settle(versions.apply_cleaning(raw, manifest, segments, EVENT_KEYS))
    swaps = versions.swap_manifest(manifest, names, EVENT_KEYS)
    restored = versions.roll_back(applied, raw, swaps, EVENT_KEYS, "seg_id")
    return restored.groupBy("seg_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 4).alias("total")
    )
