"""Stage 1: label raw frames, drop and split, fill small gaps, keep long segments."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaitmill.functions.blend import blend
from gaitmill.operators.shared import count_where, same_key_join, settle
from gaitmill.operators.track import MAX_ROWS, Track, attach

KEEP, STUCK, GLITCH, SPLIT, GAP = "keep", "drop_stuck", "drop_glitch", "split", "gap"
LABELS = (KEEP, STUCK, GLITCH, SPLIT, GAP)
TINY_DT = 1e-4


@dataclass(frozen=True)
class CleanRule:
    """Thresholds, in seconds, metres per second and frames."""

    stuck_dt: float = 0.005
    small_gap_dt: float = 0.05
    big_gap_dt: float = 0.1
    jump_speed: float = 10.0
    return_speed: float = 10.0
    min_frames: int = 60
    min_duration: float = 1.0
    target_dt: float = 1.0 / 60.0
    units_per_metre: float = 100.0


@dataclass(frozen=True)
class FrameColumns:
    """Where the operators find things in a frames table."""

    keys: tuple[str, ...] = ("category", "recording_id")
    order: tuple[str, ...] = ("frame_idx",)
    time: str = "t"
    position: tuple[str, ...] = ("px", "py", "pz")
    logged_dt: str = "dt"
    counter: str = "f"


def distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    squares = [(x - y) * (x - y) for x, y in zip(a, b)]
    return F.sqrt(functools.reduce(operator.add, squares))


def motion_track(
    frames: DataFrame, at: FrameColumns, *, max_rows: int = MAX_ROWS
) -> Track:
    """Narrow track (no joints) with the raw neighbours of every frame."""
    narrow = frames.select(
        *at.keys, *at.order, at.time, *at.position, at.logged_dt, at.counter
    )
    track = Track.of(narrow, at.keys, at.order, max_rows=max_rows)
    return track.neighbours(
        before={"_t0": F.col(at.time)}
        | {f"_p0{i}": F.col(c) for i, c in enumerate(at.position)},
        after={"_t2": F.col(at.time)}
        | {f"_p2{i}": F.col(c) for i, c in enumerate(at.position)},
    )


def step(at: FrameColumns) -> tuple[Column, Column]:
    """(dt, displacement) from the raw predecessor."""
    here = [F.col(c) for c in at.position]
    before = [F.col(f"_p0{i}") for i in range(len(here))]
    return F.col(at.time) - F.col("_t0"), distance(here, before)


def decision(at: FrameColumns, rule: CleanRule) -> Column:
    """One of the five labels. Comparisons with a missing value are not true."""
    dt, moved = step(at)
    before = [F.col(f"_p0{i}") for i in range(len(at.position))]
    after = [F.col(f"_p2{i}") for i in range(len(at.position))]
    speed = F.try_divide(moved, dt) / rule.units_per_metre
    jumped = (dt > TINY_DT) & (speed > rule.jump_speed)
    dt_back = F.col("_t2") - F.col("_t0")
    back_speed = F.try_divide(distance(after, before), dt_back) / rule.units_per_metre
    returns = (dt_back > TINY_DT) & (back_speed < rule.return_speed)
    return (
        F.when(dt.isNull(), KEEP)
        .when(dt < rule.stuck_dt, STUCK)
        .when(dt > rule.big_gap_dt, SPLIT)
        .when(dt > rule.small_gap_dt, GAP)
        .when(jumped & returns, GLITCH)
        .when(jumped, SPLIT)
        .otherwise(KEEP)
    )


def label_frames(
    frames: DataFrame,
    at: FrameColumns = FrameColumns(),
    rule: CleanRule = CleanRule(),
    *,
    max_rows: int = MAX_ROWS,
) -> Track:
    """Track of narrow frames with ``decision``."""
    track = motion_track(frames, at, max_rows=max_rows)
    labelled = track.columns(decision=decision(at, rule))
    helpers = [c for c in labelled.df.columns if c.startswith(("_t", "_p"))]
    return labelled.with_df(labelled.df.drop(*helpers))


def label_counts(labelled: DataFrame, by: Sequence[str]) -> DataFrame:
    return labelled.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_in"),
        count_where(F.col("decision") == STUCK).alias("n_stuck"),
        count_where(F.col("decision") == GLITCH).alias("n_glitch"),
        count_where(F.col("decision") == SPLIT).alias("n_split"),
        count_where(F.col("decision") == GAP).alias("n_gap"),
    )


def lay_out(labelled: Track, at: FrameColumns, rule: CleanRule) -> Track:
    """Kept frames with their place in the cleaned data.

    Adds ``segment`` (0-based, per recording), ``is_head``, ``gap_from`` (time of
    the kept predecessor across a small gap), ``slots`` (1 + rows to fill in before
    this frame), ``place`` (index in the segment), and the renumbered ``dt_new``
    and ``f_new``. The head of a split keeps the values it was logged with.
    """
    t = F.col(at.time)
    kept = labelled.where(~F.col("decision").isin(STUCK, GLITCH))
    kept = kept.pause().neighbours(
        before={
            "gap_from": t,
            "_has_prev": F.lit(True),
            **{f"prev_{c}": F.col(c) for c in at.order},
        }
    )
    first = F.col("_has_prev").isNull()
    intervals = F.greatest(F.rint((t - F.col("gap_from")) / rule.target_dt), F.lit(1.0))
    is_gap = (F.col("decision") == GAP) & ~first
    kept = kept.columns(
        is_head=first | (F.col("decision") == SPLIT),
        slots=F.when(is_gap, intervals).otherwise(1.0).cast("long"),
    )
    kept = kept.pause().running(
        sums={
            "segment": F.when(F.col("decision") == SPLIT, 1).otherwise(0),
            "_upto": F.col("slots"),
        }
    )
    before = F.col("_upto") - F.col("slots")
    kept = kept.pause().running(maxima={"_base": F.when(F.col("is_head"), before)})
    place = F.col("_upto") - 1 - F.col("_base")
    split_head = F.col("decision") == SPLIT
    gap = t - F.col("gap_from")
    last_fill = F.col("gap_from") + (F.col("slots") - 1) / F.col("slots") * gap
    dt_new = (
        F.when(split_head, F.col(at.logged_dt))
        .when(first, F.lit(0.0))
        .when(F.col("slots") > 1, t - last_fill)
        .otherwise(gap)
    )
    kept = kept.columns(
        place=place,
        dt_new=dt_new,
        f_new=F.when(split_head, F.col(at.counter)).otherwise(place),
    )
    return kept.with_df(kept.df.drop("_has_prev", "_upto", "_base"))


def segment_table(laid_out: Track, at: FrameColumns, rule: CleanRule) -> DataFrame:
    """One row per segment: size, duration, the length filter and kept number.

    The duration is the sum of the renumbered dt, so the logged dt of a split head
    counts. ``kept_no`` counts kept segments only.
    """
    order = F.struct(*at.order)
    t = F.col(at.time)
    segments = laid_out.df.groupBy(*at.keys, "segment").agg(
        F.sum("slots").alias("n_frames"),
        (
            F.max(F.when(F.col("is_head"), F.col("dt_new")))
            + F.max_by(t, order)
            - F.min_by(t, order)
        ).alias("duration"),
    )
    long_enough = (F.col("n_frames") >= rule.min_frames) & (
        F.col("duration") >= rule.min_duration
    )
    segments = segments.withColumn("kept", F.coalesce(long_enough, F.lit(False)))
    ranked = laid_out.coarser(segments, ["segment"]).running(
        sums={"_k": F.when(F.col("kept"), 1).otherwise(0)}
    )
    return ranked.result().select(
        *at.keys,
        "segment",
        "n_frames",
        "duration",
        "kept",
        F.when(F.col("kept"), F.col("_k") - 1).alias("kept_no"),
    )


def recording_manifest(
    labelled: DataFrame, segments: DataFrame, at: FrameColumns
) -> DataFrame:
    """Counts per recording. ``changed`` is false where nothing had to be fixed;
    such a recording is passed through whole, without the length filter."""
    counts = label_counts(labelled, at.keys)
    cut = segments.groupBy(*at.keys).agg(
        F.count(F.lit(1)).alias("_total"),
        count_where(F.col("kept")).alias("_kept"),
        F.coalesce(F.sum(F.when(F.col("kept"), F.col("n_frames"))), F.lit(0)).alias("_out"),
    )
    fixes = F.col("n_stuck") + F.col("n_glitch") + F.col("n_split") + F.col("n_gap")
    changed = fixes > 0
    return (
        same_key_join(counts, cut, at.keys)
        .withColumn("changed", changed)
        .select(
            *at.keys,
            "n_in",
            "n_stuck",
            "n_glitch",
            "n_split",
            "n_gap",
            "changed",
            F.when(changed, F.col("_total")).otherwise(1).alias("segs_total"),
            F.when(changed, F.col("_kept")).otherwise(1).alias("segs_kept"),
            F.when(changed, F.col("_out")).otherwise(F.col("n_in")).alias("n_out_total"),
        )
    )


def clean_stats(manifest: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The eleven counters over all recordings, or per ``by``."""
    dropped = F.col("segs_total") - F.col("segs_kept")
    return manifest.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"),
        count_where(F.col("changed")).alias("files_changed"),
        count_where(~F.col("changed")).alias("files_unchanged"),
        F.sum("n_in").alias("frames_in"),
        F.sum("n_out_total").alias("frames_out"),
        F.sum("n_stuck").alias("stuck"),
        F.sum("n_glitch").alias("glitch"),
        F.sum("n_split").alias("splits"),
        F.sum("n_gap").alias("gaps"),
        F.sum("segs_total").alias("segs_total"),
        F.sum(dropped).alias("segs_dropped"),
    )


@dataclass(frozen=True)
class Cleaned:
    """Lazily defined results of stage 1."""

    labelled: DataFrame
    layout: DataFrame
    segments: DataFrame
    manifest: DataFrame
    stats: DataFrame


def clean(
    frames: DataFrame,
    at: FrameColumns = FrameColumns(),
    rule: CleanRule = CleanRule(),
    *,
    max_rows: int = MAX_ROWS,
    settled: bool = False,
) -> Cleaned:
    """Define the results of stage 1.

    With ``settled`` the narrow labels and layout are written once to the shared
    folder. That pays when the cleaned frames are wanted too, since these read the
    layout several times.
    """
    labelled = label_frames(frames, at, rule, max_rows=max_rows)
    if settled:
        labelled = labelled.with_df(settle(labelled.df))
    laid_out = lay_out(labelled, at, rule)
    if settled:
        laid_out = laid_out.with_df(settle(laid_out.df))
    segments = segment_table(laid_out, at, rule)
    manifest = recording_manifest(labelled.df, segments, at)
    return Cleaned(
        labelled.result(), laid_out.result(), segments, manifest, clean_stats(manifest)
    )


def output_segments(
    cleaned: Cleaned, at: FrameColumns, *, name: str = "recording_id"
) -> DataFrame:
    """Segments of the output with ``seg_id``.

    Those of a changed recording are named ``<recording>_c<j>``; an unchanged
    recording is one segment that keeps its name.
    """
    changed = cleaned.manifest.select(*at.keys, "changed")
    stem = F.col(name).cast("string")
    cut = F.concat(stem, F.lit("_c"), F.col("kept_no").cast("string"))
    return (
        same_key_join(cleaned.segments, changed, at.keys, "inner")
        .where(F.col("kept") | ~F.col("changed"))
        .withColumn("seg_id", F.when(F.col("changed"), cut).otherwise(stem))
        .select(*at.keys, "segment", "seg_id", "n_frames", "duration", "changed")
    )


def output_rows(
    cleaned: Cleaned, at: FrameColumns, *, name: str = "recording_id"
) -> DataFrame:
    """Kept originals of the output with ``seg_id`` and their place.

    Frames of an unchanged recording keep their logged dt and counter.
    """
    chosen = output_segments(cleaned, at, name=name).drop("duration")
    rows = attach(cleaned.layout, chosen, [*at.keys, "segment"], "place", "n_frames")
    changed = F.col("changed")
    return rows.withColumns(
        {
            "dt_new": F.when(changed, F.col("dt_new")).otherwise(F.col(at.logged_dt)),
            "f_new": F.when(changed, F.col("f_new")).otherwise(F.col(at.counter)),
        }
    ).drop("changed", "n_frames")


def cleaned_frames(
    frames: DataFrame,
    cleaned: Cleaned,
    at: FrameColumns = FrameColumns(),
    *,
    name: str = "recording_id",
    records: str = "hold",
    values: Sequence[str] | None = None,
) -> DataFrame:
    """Full-width cleaned frames: the kept originals and the filled-in rows.

    Wide columns only meet the narrow layout here, in equi-joins on (keys, order),
    which no long recording can skew. Filled rows need two originals, and only
    those pairs are joined twice.
    """
    fields = {f.name: f.dataType for f in frames.schema.fields}
    fixed = {*at.keys, *at.order, at.time, at.logged_dt, at.counter}
    wide = [c for c in (values or fields) if c not in fixed]
    rows = output_rows(cleaned, at, name=name)
    cut = [*at.keys, *at.order]
    plan = rows.select(
        *cut, *[f"prev_{c}" for c in at.order], at.time, "gap_from", "seg_id",
        "place", "slots", "dt_new", "f_new",
    )
    payload = frames.select(*cut, *wide)
    placed = same_key_join(plan, payload, cut, "inner")
    originals = placed.select(
        *at.keys,
        "seg_id",
        F.col("place").alias("frame_idx"),
        at.time,
        F.col("dt_new").alias(at.logged_dt),
        F.col("f_new").alias(at.counter),
        F.lit(False).alias("filled"),
        *wide,
    )

    # filled rows: from the kept predecessor (a) to this frame (b)
    a, b = F.col("_a"), F.col("_b")
    gaps = placed.where(F.col("slots") > 1).select(
        *at.keys,
        *[F.col(f"prev_{c}").alias(c) for c in at.order],
        at.time,
        "gap_from",
        "seg_id",
        "place",
        "slots",
        F.struct(*wide).alias("_b"),
    )
    origin = payload.select(*cut, F.struct(*wide).alias("_a"))
    pairs = same_key_join(gaps, origin, cut, "inner").withColumn(
        "_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("slots") - 1))
    )
    u = F.col("_i") / F.col("slots")
    gap = F.col(at.time) - F.col("gap_from")
    t_new = F.col("gap_from") + u * gap
    t_before = F.when(F.col("_i") == 1, F.col("gap_from")).otherwise(
        F.col("gap_from") + (F.col("_i") - 1) / F.col("slots") * gap
    )
    position = F.col("place") - F.col("slots") + F.col("_i")
    fills = pairs.select(
        *at.keys,
        "seg_id",
        position.alias("frame_idx"),
        t_new.alias(at.time),
        (t_new - t_before).alias(at.logged_dt),
        position.alias(at.counter),
        F.lit(True).alias("filled"),
        *[
            blend(a.getField(c), b.getField(c), fields[c], u, name=c, records=records).alias(c)
            for c in wide
        ],
    )
    return originals.unionByName(fills)


def segment_meta(meta: DataFrame, segments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Meta rows of the output segments: frame count (only where one was given)
    and the cleaned flag."""
    joined = segments.select(*keys, "seg_id", "n_frames").join(meta, list(keys))
    count = F.when(F.col("num_frames").isNotNull(), F.col("n_frames"))
    if isinstance(meta.schema["num_frames"].dataType, T.IntegralType):
        count = count.cast(meta.schema["num_frames"].dataType)
    return joined.withColumns({"num_frames": count, "cleaned": F.lit(True)}).drop("n_frames")
