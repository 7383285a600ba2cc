"""Stage 3 without the solver: work list, pose checks and the QA summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaitmill.operators.shared import count_where
from gaitmill.operators.wash import CommandColumns, WashRule, with_flags
from gaitmill.schemas import QPOS_WIDTH

# Fixed values: (expected mesh scale, data scale), tolerances, reject reasons.
KNOWN_SCALES = ((0.77, 1.0), (1.0, 0.77))
SCALE_TOLERANCE = 0.05
SCALE_DRIFT = 0.02
SCALE_REASON = "invalid_or_unknown_data_scale"
SHAPE_REASON = "qpos_shape_mismatch"
LENGTH_REASON = "length_mismatch"
NUMBER_REASON = "non_finite_qpos"


def infer_scale(
    segments: DataFrame,
    low: Sequence[Column],
    high: Sequence[Column],
    missing: Column,
) -> DataFrame:
    """Add ``mesh_scale_observed``, ``data_scale`` and ``scale_problem``.

    ``low`` and ``high`` are the per-axis extremes of the recorded mesh scale. A
    missing extreme or frame, a range above 0.02, or a mean near neither known
    scale is a problem.
    """
    values = [*low, *high]
    absent = F.coalesce(missing, F.lit(0)) > 0
    for v in values:
        absent = absent | v.isNull()
    drift = F.greatest(*values) - F.least(*values) > SCALE_DRIFT
    mean = sum(values[1:], values[0]) / len(values)
    scale = F.lit(None).cast("double")
    for expected, factor in reversed(KNOWN_SCALES):
        near = F.abs(F.col("_mean") - expected) <= SCALE_TOLERANCE
        scale = F.when(near, factor).otherwise(scale)
    return (
        segments.withColumns({"_absent": absent, "_drift": drift, "_mean": mean})
        .withColumn("_scale", scale)
        .withColumn(
            "scale_problem",
            F.when(F.col("_absent"), "missing")
            .when(F.col("_drift"), "drifts")
            .when(F.col("_scale").isNull(), "unsupported"),
        )
        .withColumns(
            {
                "mesh_scale_observed": F.when(F.col("scale_problem").isNull(), F.col("_mean")),
                "data_scale": F.when(F.col("scale_problem").isNull(), F.col("_scale")),
            }
        )
        .drop("_absent", "_drift", "_mean", "_scale")
    )


def infer_manifest_scale(manifest: DataFrame) -> DataFrame:
    """:func:`infer_scale` on the ``mesh_scale`` struct of a wash manifest."""
    low = [F.col("mesh_scale.min")[i] for i in range(3)]
    high = [F.col("mesh_scale.max")[i] for i in range(3)]
    return infer_scale(manifest, low, high, F.col("mesh_scale.missing_frames"))


def split_work(scaled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ready, rejected) by the scale inference."""
    ready = scaled.where(F.col("scale_problem").isNull()).drop("scale_problem")
    rejected = scaled.where(F.col("scale_problem").isNotNull())
    return ready, rejected.withColumns(
        {
            "reject_stage": F.lit("retarget"),
            "reject_reason": F.lit(SCALE_REASON),
            "detail": F.concat(F.lit("mesh scale "), F.col("scale_problem")),
        }
    ).drop("scale_problem", "mesh_scale_observed", "data_scale")


def finite(values: Column) -> Column:
    """Every element is a number that is neither NaN nor infinite."""
    inf = F.lit(float("inf"))
    ok = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return F.coalesce(ok, F.lit(False))


def pose_check(
    poses: DataFrame, key: str = "seg_id", vector: str = "q", width: int = QPOS_WIDTH
) -> DataFrame:
    """Per segment: rows, and whether all rows have the width and are finite."""
    return poses.groupBy(key).agg(
        F.count(F.lit(1)).alias("pose_rows"),
        F.coalesce(F.bool_and(F.size(vector) == width), F.lit(False)).alias("width_ok"),
        F.bool_and(finite(F.col(vector))).alias("finite_ok"),
    )


def failure_reason(checked: DataFrame) -> DataFrame:
    """Add ``reject_reason`` of a solved segment; null when it passes. Expects
    the columns of :func:`pose_check` next to ``n_frames``."""
    return checked.withColumn(
        "reject_reason",
        F.when(~F.col("width_ok"), SHAPE_REASON)
        .when(F.col("pose_rows") != F.col("n_frames"), LENGTH_REASON)
        .when(F.coalesce("pose_rows", F.lit(0)) == 0, LENGTH_REASON)
        .when(~F.col("finite_ok"), NUMBER_REASON),
    )


def still_to_do(work: DataFrame, checks: DataFrame, key: str = "seg_id") -> DataFrame:
    """Work without the segments whose poses exist and pass."""
    joined = work.select(key, "n_frames").join(checks, key)
    done = failure_reason(joined).where(F.col("reject_reason").isNull()).select(key)
    return work.join(done, key, "left_anti")


def final_rejects(*manifests: DataFrame) -> DataFrame:
    """Union of the reject manifests of all stages, matched by column name."""
    union = manifests[0]
    for other in manifests[1:]:
        union = union.unionByName(other, allowMissingColumns=True)
    return union


def stage_stats(segments: DataFrame, category: str = "category") -> DataFrame:
    """Segments, frames and duration per category and in total (null)."""
    return segments.rollup(category).agg(
        F.count(F.lit(1)).alias("segments"),
        F.sum("n_frames").alias("frames"),
        F.sum(F.coalesce("duration_s", F.lit(0.0))).alias("duration_s"),
    )


# -- QA ----------------------------------------------------------------------


def repeated_ids(manifest: DataFrame, key: str, order: str) -> DataFrame:
    """Add ``bad_id``: no id, or not its first occurrence in manifest order.

    The first occurrence is a grouped minimum, so an id that repeats without end
    is aggregated map-side and never gathered in one task. The join back is on
    the first occurrence itself, which is unique.
    """
    named = manifest.where(F.col(key).cast("string") != "")
    firsts = named.groupBy(key).agg(F.min(order).alias(order)).select(order)
    marked = firsts.withColumn("_first", F.lit(True))
    return (
        manifest.join(marked, order, "left")
        .withColumn("bad_id", F.col("_first").isNull())
        .drop("_first")
    )


def source_check(
    frames: DataFrame,
    key: str,
    at: CommandColumns = CommandColumns(),
    rule: WashRule = WashRule(),
) -> DataFrame:
    """Re-scan of the washed frames: rows and bad rows per segment."""
    return with_flags(frames, at, rule).groupBy(key).agg(
        F.count(F.lit(1)).alias("source_rows"),
        count_where(F.col("is_bad")).alias("source_bad"),
    )


def qa_reasons(
    manifest: DataFrame,
    checks: DataFrame,
    metas: DataFrame | None = None,
    sources: DataFrame | None = None,
    *,
    key: str = "seg_id",
    order: str = "row_no",
) -> DataFrame:
    """Every manifest row with its array of ``reasons`` (empty when it passes)."""
    rows = repeated_ids(manifest, key, order).join(checks, key, "left")
    expected = F.coalesce(F.col("n_frames"), F.lit(-1))
    have = F.col("pose_rows").isNotNull()

    def reason(condition: Column, text: Column | str) -> Column:
        return F.when(condition, F.lit(text) if isinstance(text, str) else text)

    tests = [
        reason(F.col("bad_id"), "missing_or_duplicate_seg_id"),
        reason(~have, "missing_qpos"),
        reason(have & ~F.col("width_ok"), "qpos_shape"),
        reason(
            have & (F.col("pose_rows") != expected),
            F.format_string("length=%d expected=%d", F.col("pose_rows"), expected),
        ),
        reason(have & ~F.col("finite_ok"), "non_finite_qpos"),
    ]
    if metas is not None:
        known = metas.select(key).distinct().withColumn("_meta", F.lit(True))
        rows = rows.join(known, key, "left")
        tests.append(reason(F.col("_meta").isNull(), "missing_segment_meta"))
    if sources is not None:
        rows = rows.join(sources, key, "left")
        found = F.col("source_rows").isNotNull()
        tests += [
            reason(~found, "missing_washed_source"),
            reason(
                found & (F.col("source_rows") != expected),
                F.format_string(
                    "source_length=%d expected=%d", F.col("source_rows"), expected
                ),
            ),
            reason(
                F.col("source_bad") > 0,
                F.format_string("source_bad_frames=%d", F.col("source_bad")),
            ),
        ]
    reasons = F.filter(F.array(*tests), lambda r: r.isNotNull())
    return rows.withColumn("reasons", reasons).drop("_meta")


def qa_summary(judged: DataFrame, key: str = "seg_id") -> DataFrame:
    """One row: totals and ``status`` (ok or failed)."""
    failed = count_where(F.size("reasons") > 0)
    first = ~F.col("bad_id")
    source = (
        F.coalesce(F.sum("source_rows"), F.lit(0))
        if "source_rows" in judged.columns
        else F.lit(0).cast("long")
    )
    return judged.agg(
        F.count(F.lit(1)).alias("segments"),
        count_where(first).alias("unique_seg_ids"),
        F.coalesce(F.sum("pose_rows"), F.lit(0)).alias("qpos_frames_checked"),
        source.alias("source_frames_checked"),
        failed.alias("failures"),
        F.when(failed == 0, "ok").otherwise("failed").alias("status"),
    )
