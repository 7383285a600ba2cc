"""Stage 2: cut segments where the performer neither crouches nor steers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaitmill.operators.shared import count_where, same_key_join
from gaitmill.operators.track import MAX_ROWS, Track

# Texts that the manifests carry.
RULE_TEXT = "cmd.crouch OR lateral cmd.move[0]"
STAGE = "crouch_steering_wash"
TOO_SHORT = "too_short_after_crouch_steering"
PARSE_FAILED = "source_parse_failed"
DEFAULT_RATE_HZ = 60.0


@dataclass(frozen=True)
class WashRule:
    eps_side: float = 0.25
    eps_mag: float = 0.2
    min_frames: int = 60
    min_duration: float = 1.0


@dataclass(frozen=True)
class CommandColumns:
    keys: tuple[str, ...] = ("category", "recording_id")
    order: tuple[str, ...] = ("frame_idx",)
    time: str = "t"
    dt: str = "dt"
    crouch: str = "crouch"
    side: str = "move_right"
    forward: str = "move_forward"
    scale: tuple[str, ...] = ("scale_x", "scale_y", "scale_z")


def is_crouching(crouch: Column) -> Column:
    return F.coalesce(crouch, F.lit(False))


def is_steering(side: Column, forward: Column, rule: WashRule) -> Column:
    side = F.coalesce(side, F.lit(0.0))
    forward = F.coalesce(forward, F.lit(0.0))
    return (F.abs(side) > rule.eps_side) & (F.hypot(side, forward) > rule.eps_mag)


def with_flags(frames: DataFrame, at: CommandColumns, rule: WashRule) -> DataFrame:
    flagged = frames.withColumns(
        {
            "is_crouch": is_crouching(F.col(at.crouch)),
            "is_steer": is_steering(F.col(at.side), F.col(at.forward), rule),
        }
    )
    return flagged.withColumn("is_bad", F.col("is_crouch") | F.col("is_steer"))


def forward_step(dt: str) -> Column:
    """dt as it counts for a duration: never negative, 0 when missing."""
    return F.greatest(F.coalesce(F.col(dt), F.lit(0.0)), F.lit(0.0))


def span(time: str, dt: str, position: Column) -> Column:
    """Last minus first known time, never negative; without times, the sum of dt."""
    known = F.when(F.col(time).isNotNull(), position)
    times = F.max_by(time, known) - F.min_by(time, known)
    return F.coalesce(F.greatest(times, F.lit(0.0)), F.sum(forward_step(dt)))


def composition(frames: DataFrame, at: CommandColumns, rule: WashRule) -> DataFrame:
    """Per recording: frame counts by kind, duration, and the mesh scale range over
    all frames. One aggregation, no window."""
    flagged = with_flags(frames, at, rule)
    scale_missing = F.lit(False)
    for c in at.scale:
        scale_missing = scale_missing | F.col(c).isNull()
    ranges = [
        f(F.when(~scale_missing, F.col(c))).alias(f"{n}_{i}")
        for n, f in (("min", F.min), ("max", F.max))
        for i, c in enumerate(at.scale)
    ]
    per = flagged.groupBy(*at.keys).agg(
        F.count(F.lit(1)).alias("input_frames"),
        span(at.time, at.dt, F.struct(*at.order)).alias("input_duration_s"),
        count_where(F.col("is_crouch")).alias("crouch_frames"),
        count_where(F.col("is_steer")).alias("steering_frames"),
        count_where(F.col("is_crouch") & F.col("is_steer")).alias("overlap_frames"),
        count_where(F.col("is_bad")).alias("bad_union_frames"),
        count_where(~F.col("is_bad")).alias("good_frames"),
        count_where(scale_missing).alias("missing_frames"),
        *ranges,
    )
    axes = range(len(at.scale))
    all_missing = F.col("missing_frames") == F.col("input_frames")

    def ranged(name: str) -> Column:
        return F.when(~all_missing, F.array(*[F.col(f"{name}_{i}") for i in axes])).alias(name)

    record = F.struct(ranged("min"), ranged("max"), F.col("missing_frames"))
    return per.withColumn("mesh_scale", record).drop(
        "missing_frames", *[f"{n}_{i}" for n in ("min", "max") for i in axes]
    )


def good_frames(
    frames: DataFrame, at: CommandColumns, rule: WashRule, *, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Good frames with ``i`` (index in the recording), and ``run_no``, which
    counts every maximal run of good frames, also those too short to keep."""
    narrow = with_flags(frames, at, rule).select(
        *at.keys, *at.order, at.time, at.dt, "is_bad"
    )
    track = Track.of(narrow, at.keys, at.order, max_rows=max_rows)
    track = track.neighbours(before={"_was_bad": F.col("is_bad")})
    starts = ~F.col("is_bad") & F.coalesce("_was_bad", F.lit(True))
    track = track.pause().running(
        sums={"_run": F.when(starts, 1).otherwise(0), "_i": F.lit(1).cast("long")}
    )
    return (
        track.result()
        .where(~F.col("is_bad"))
        .withColumns({"i": F.col("_i") - 1, "run_no": F.col("_run") - 1})
        .drop("_i", "_run", "_was_bad", "is_bad")
    )


def good_runs(
    frames: DataFrame,
    at: CommandColumns = CommandColumns(),
    rule: WashRule = WashRule(),
    *,
    name: str = "recording_id",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Candidate runs ``[i0, i1)`` with size, duration, segment id and ``keep``."""
    good = good_frames(frames, at, rule, max_rows=max_rows)
    runs = good.groupBy(*at.keys, "run_no").agg(
        F.min("i").alias("i0"),
        (F.max("i") + 1).alias("i1"),
        F.count(F.lit(1)).alias("n_frames"),
        span(at.time, at.dt, F.col("i")).alias("duration_s"),
    )
    long_enough = (F.col("n_frames") >= rule.min_frames) & (
        F.col("duration_s") >= rule.min_duration
    )
    seg_id = F.format_string("%s_seg%03d", F.col(name).cast("string"), F.col("run_no"))
    return runs.withColumns({"seg_id": seg_id, "keep": long_enough})


def accepted_manifest(
    runs: DataFrame,
    per_recording: DataFrame,
    meta: DataFrame | None,
    at: CommandColumns = CommandColumns(),
    rule: WashRule = WashRule(),
) -> DataFrame:
    """Kept runs with provenance, source rate and the recording's mesh scale."""
    rows = runs.where("keep").drop("keep", "run_no")
    rows = same_key_join(rows, per_recording.select(*at.keys, "mesh_scale"), at.keys)
    rate = F.lit(None).cast("double")
    if meta is not None:
        rows = same_key_join(rows, meta.select(*at.keys, "sample_rate_hz"), at.keys)
        rate = F.col("sample_rate_hz").cast("double")
    record = F.struct(
        F.lit(rule.eps_side).alias("eps_side"),
        F.lit(rule.eps_mag).alias("eps_mag"),
        F.lit(RULE_TEXT).alias("rule"),
    )
    return rows.withColumns(
        {
            "fps_src": F.coalesce(rate, F.lit(DEFAULT_RATE_HZ)),
            "status": F.lit("washed"),
            "wash": record,
        }
    ).drop("sample_rate_hz")


def reject_manifest(runs: DataFrame, rule: WashRule = WashRule()) -> DataFrame:
    detail = F.format_string(
        f"frames=%d (min={rule.min_frames}), duration=%.6fs (min={rule.min_duration:.6f}s)",
        F.col("n_frames"),
        F.col("duration_s"),
    )
    return (
        runs.where(~F.col("keep"))
        .drop("keep", "run_no")
        .withColumns(
            {
                "reject_stage": F.lit(STAGE),
                "reject_reason": F.lit(TOO_SHORT),
                "detail": detail,
            }
        )
    )


def parse_rejects(
    frames: DataFrame, corrupt: str, keys: Sequence[str], *, name: str = "recording_id"
) -> DataFrame:
    """One reject row per recording that holds an unreadable frame."""
    broken = frames.where(F.col(corrupt).isNotNull()).groupBy(*keys)
    return broken.agg(
        F.col(name).cast("string").alias("seg_id"),
        F.lit(STAGE).alias("reject_stage"),
        F.lit(PARSE_FAILED).alias("reject_reason"),
        F.format_string("%d unreadable frame(s)", F.count(F.lit(1))).alias("detail"),
    )


def readable(frames: DataFrame, broken: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Frames of the recordings without an unreadable frame."""
    return frames.join(broken.select(*keys), list(keys), "left_anti")


COUNTERS = (
    "input_files",
    "input_frames",
    "input_duration_s",
    "crouch_frames",
    "steering_frames",
    "overlap_frames",
    "bad_union_frames",
    "good_frames",
    "candidate_runs",
    "kept_segments",
    "rejected_segments",
    "output_frames",
    "output_duration_s",
    "rejected_good_frames",
    "rejected_good_duration_s",
    "files_without_bad",
    "files_all_rejected",
    "parse_failures",
)


def wash_counters(
    per_recording: DataFrame,
    runs: DataFrame,
    broken: DataFrame | None = None,
    at: CommandColumns = CommandColumns(),
    *,
    category: str = "category",
) -> DataFrame:
    """The eighteen counters per category and in total (null category)."""
    kept = F.col("keep")
    by_run = runs.groupBy(*at.keys).agg(
        F.count(F.lit(1)).alias("candidate_runs"),
        count_where(kept).alias("kept_segments"),
        count_where(~kept).alias("rejected_segments"),
        F.sum(F.when(kept, F.col("n_frames"))).alias("output_frames"),
        F.sum(F.when(kept, F.col("duration_s"))).alias("output_duration_s"),
        F.sum(F.when(~kept, F.col("n_frames"))).alias("rejected_good_frames"),
        F.sum(F.when(~kept, F.col("duration_s"))).alias("rejected_good_duration_s"),
    )
    files = same_key_join(per_recording.drop("mesh_scale"), by_run, at.keys).withColumns(
        {
            "input_files": F.lit(1),
            "files_without_bad": (F.col("bad_union_frames") == 0).cast("int"),
            "files_all_rejected": (F.coalesce("kept_segments", F.lit(0)) == 0).cast("int"),
            "parse_failures": F.lit(0),
        }
    )
    if broken is not None:
        failed = broken.select(*at.keys, F.lit(1).alias("parse_failures"))
        files = files.unionByName(failed, allowMissingColumns=True)
    return files.rollup(category).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS]
    )


def washed_frames(
    frames: DataFrame,
    accepted: DataFrame,
    keys: Sequence[str],
    position: str = "frame_idx",
    *,
    page_rows: int = 100_000,
) -> DataFrame:
    """Full-width frames of the accepted runs, renumbered within the segment.

    ``position`` is the dense index of the frame in its recording. The ranges are
    spread over their frame indices, page by page, and met by an equi-join, so the
    wide rows are shuffled on (recording, frame) and no recording is hot.
    """
    pages = accepted.select(
        *keys,
        "seg_id",
        "i0",
        "i1",
        F.explode(
            F.sequence(
                F.floor(F.col("i0") / page_rows).cast("long"),
                F.floor((F.col("i1") - 1) / page_rows).cast("long"),
            )
        ).alias("_page"),
    ).repartition(*keys, "_page")
    first = F.greatest("i0", F.col("_page") * page_rows)
    last = F.least(F.col("i1"), (F.col("_page") + 1) * page_rows) - 1
    wanted = pages.select(
        *keys, "seg_id", "i0", F.explode(F.sequence(first, last)).alias(position)
    )
    rows = same_key_join(frames, wanted, [*keys, position], "inner")
    return rows.withColumn(position, F.col(position) - F.col("i0")).drop("i0")
