"""Forward-only filter: a motion with any backward command is rejected whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaitmill.operators.shared import count_where, must_be_empty
from gaitmill.operators.stats import duration_summary

EPS_BACK = 0.2
# Texts that the manifests carry.
STAGE = "backward_motion_filter"
REASON = "contains_backward_cmd"
STATUS = "qa_ok_forward_only"
RULE = "reject entire motion if any cmd.move[1] < -eps_back"


def scan_motion(
    frames: DataFrame,
    keys: Sequence[str],
    position: str,
    forward: str,
    eps_back: float = EPS_BACK,
) -> DataFrame:
    """Per motion: frames, backward frames with first and last index, and the
    range of the forward command. ``invalid_frames`` have no usable command."""
    back = F.col(forward) < -eps_back
    return frames.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("frame_count"),
        count_where(back).alias("backward_frames"),
        F.min(F.when(back, F.col(position))).alias("first_backward_frame"),
        F.max(F.when(back, F.col(position))).alias("last_backward_frame"),
        F.min(forward).alias("min_forward_cmd"),
        F.max(forward).alias("max_forward_cmd"),
        count_where(F.col(forward).isNull()).alias("invalid_frames"),
    )


def judge(manifest: DataFrame, scan: DataFrame, key: str = "seg_id") -> DataFrame:
    """Manifest rows with their scan, ``keep`` and, on rejects, stage and reason."""
    rows = manifest.join(scan, key, "left")
    backward = F.col("backward_frames") > 0
    detail = F.format_string(
        "backward frames=%d, first=%d, last=%d",
        F.col("backward_frames"),
        F.col("first_backward_frame"),
        F.col("last_backward_frame"),
    )
    return rows.withColumns(
        {
            "keep": F.col("backward_frames") == 0,
            "reject_stage": F.when(backward, STAGE),
            "reject_reason": F.when(backward, REASON),
            "detail": F.when(backward, detail),
        }
    )


def validate(judged: DataFrame, key: str = "seg_id") -> None:
    """Raise on a repeated id, an empty or unusable motion, or a wrong length."""
    repeated = judged.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    must_be_empty(repeated, "duplicate seg_id", [key, "rows"])
    empty = judged.where(F.col("frame_count").isNull())
    must_be_empty(empty, "empty motion", [key])
    unusable = judged.where(F.col("invalid_frames") > 0)
    must_be_empty(unusable, "frames without a valid command", [key, "invalid_frames"])
    wrong = judged.where(F.col("frame_count") != F.col("n_frames"))
    must_be_empty(wrong, "frame count differs", [key, "n_frames", "frame_count"])


def set_differences(
    accepted: DataFrame, rejected: DataFrame, solved: DataFrame, key: str = "seg_id"
) -> DataFrame:
    """Ids that break the sets: accepted without poses, poses never decided on."""
    ids = [df.select(key) for df in (accepted, rejected, solved)]
    missing = ids[0].join(ids[2], key, "left_anti")
    unknown = ids[2].join(ids[0].unionByName(ids[1]), key, "left_anti")
    return missing.distinct().withColumn("problem", F.lit("missing_qpos")).unionByName(
        unknown.distinct().withColumn("problem", F.lit("not_decided"))
    )


def subset_solved(solved: DataFrame, accepted: DataFrame, key: str = "seg_id") -> DataFrame:
    """Stage-3 rows of the accepted motions, stamped with the filter."""
    kept = solved.join(accepted.select(key), key, "left_semi")
    stamp = F.struct(F.lit(STAGE).alias("version"), F.lit(RULE).alias("rule"))
    return kept.withColumns({"status": F.lit(STATUS), "forward_only": stamp})


def solved_rejects(solved: DataFrame, rejected: DataFrame, key: str = "seg_id") -> DataFrame:
    """Stage-3 rows of the rejected motions, as reject rows."""
    lost = solved.join(rejected.select(key), key, "left_semi")
    return lost.withColumns({"reject_stage": F.lit(STAGE), "reject_reason": F.lit(REASON)})


def counters(
    judged: DataFrame, category: str = "category", duration: str = "duration_s"
) -> DataFrame:
    """Input, kept and backward motions, frames and durations per category and in
    total (null category)."""
    keep = F.col("keep")
    kept = F.when(keep, F.col("n_frames"))
    lost = F.when(~keep, F.col("n_frames"))
    zero = F.lit(0)
    return judged.rollup(category).agg(
        F.count(F.lit(1)).alias("input_motions"),
        F.sum("n_frames").alias("input_frames"),
        F.sum(duration).alias("input_duration_s"),
        count_where(keep).alias("kept_motions"),
        F.coalesce(F.sum(kept), zero).alias("kept_frames"),
        F.coalesce(F.sum(F.when(keep, F.col(duration))), F.lit(0.0)).alias("kept_duration_s"),
        count_where(~keep).alias("backward_motions"),
        F.coalesce(F.sum(lost), zero).alias("backward_motion_frames"),
        F.coalesce(F.sum(F.when(~keep, F.col(duration))), F.lit(0.0)).alias(
            "backward_motion_duration_s"
        ),
        F.sum("backward_frames").alias("backward_frames"),
    )


def kept_and_lost_durations(judged: DataFrame, duration: str = "duration_s") -> DataFrame:
    """Duration summary of the kept and of the rejected motions."""
    return duration_summary(judged, duration, ["keep"])


def stamp_meta(meta: DataFrame, accepted: DataFrame, eps_back: float, key: str = "seg_id") -> DataFrame:
    """Meta rows of the kept motions with the filter record."""
    record = F.struct(
        F.lit(STAGE).alias("version"),
        F.lit(RULE).alias("rule"),
        F.lit(float(eps_back)).alias("eps_back"),
    )
    kept = meta.join(accepted.select(key), key, "left_semi")
    return kept.withColumns({"forward_only": F.lit(True), "backward_motion_filter": record})
