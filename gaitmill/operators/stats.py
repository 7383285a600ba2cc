"""Evaluation scans, distributions and before/after comparisons."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaitmill.operators.clean import TINY_DT, FrameColumns, motion_track, step
from gaitmill.operators.quantiles import REPORT_PERCENTILES, exact_quantiles, median
from gaitmill.operators.shared import count_where, percent, same_key_join
from gaitmill.operators.track import MAX_ROWS, Track

# Speed thresholds in m/s, and histogram edges in seconds.
SPEED_THRESHOLDS = (6.0, 8.0, 10.0, 15.0, 20.0, 30.0)
DURATION_EDGES = (0, 1, 2, 3, 5, 10, 20, 30, 60, 120, 300, 600, 1800, math.inf)
RETAINED_EDGES = (0, 3, 5, 10, 20, 30, 60, 120, 300, math.inf)
BOX_PROBABILITIES = (0.05, 0.25, 0.5, 0.75, 0.95)


def edge_labels(edges: Sequence[float], last: str = ">{0:g}") -> list[str]:
    """``<1``, ``1-2``, ..., and ``last`` for the open bin."""
    labels = [f"<{edges[1]:g}"]
    labels += [f"{lo:g}-{hi:g}" for lo, hi in zip(edges[1:-2], edges[2:-1])]
    return [*labels, last.format(edges[-2])]


# -- per recording ---------------------------------------------------------


def scan_recordings(
    frames: DataFrame,
    at: FrameColumns = FrameColumns(),
    *,
    thresholds: Sequence[float] = SPEED_THRESHOLDS,
    stuck_dt: float = 0.005,
    small_gap_dt: float = 0.05,
    big_gap_dt: float = 0.1,
    units_per_metre: float = 100.0,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Frames, duration, speed peak, dt median and maximum, gap counts, and
    ``hits``: frames above each threshold. Steps with a missing time or position
    on either side are left out."""
    track = motion_track(frames, at, max_rows=max_rows)
    dt, moved = step(at)
    dt = F.when(moved.isNotNull(), dt)
    speed = F.when(dt > TINY_DT, F.try_divide(moved, dt) / units_per_metre)
    steps = track.df.select(*at.keys, dt.alias("_dt"), speed.alias("_speed"))
    found = [
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("_dt"), F.lit(0.0)).alias("dur"),
        F.coalesce(F.max("_speed"), F.lit(0.0)).alias("max_speed"),
        F.coalesce(F.max("_dt"), F.lit(0.0)).alias("max_dt"),
        count_where(F.col("_dt") < stuck_dt).alias("n_stuck"),
        count_where((F.col("_dt") > small_gap_dt) & (F.col("_dt") <= big_gap_dt)).alias(
            "n_gap_small"
        ),
        count_where(F.col("_dt") > big_gap_dt).alias("n_gap_big"),
        F.array(*[count_where(F.col("_speed") > th) for th in thresholds]).alias("hits"),
    ]
    if not track.chunked:
        middle = F.coalesce(F.median("_dt"), F.lit(0.0)).alias("med_dt")
        return steps.groupBy(*at.keys).agg(*found, middle)
    scanned = steps.groupBy(*at.keys).agg(*found)
    middles = median(steps, at.keys, "_dt", "_m", max_values=max_rows)
    return (
        same_key_join(scanned, middles, at.keys)
        .withColumn("med_dt", F.coalesce("_m", F.lit(0.0)))
        .drop("_m")
    )


def threshold_hits(
    scan: DataFrame, thresholds: Sequence[float] = SPEED_THRESHOLDS, by: Sequence[str] = ()
) -> DataFrame:
    """Long form of ``hits``: one row per threshold (and ``by``)."""
    marks = F.array(*[F.lit(float(th)) for th in thresholds])
    each = scan.select(*by, F.explode(F.arrays_zip(marks.alias("th"), F.col("hits"))).alias("_h"))
    return each.groupBy(*by, F.col("_h.th").alias("threshold")).agg(
        F.sum("_h.hits").alias("frames_hit")
    )


def category_scan(scan: DataFrame, category: str = "category") -> DataFrame:
    """Files, frames, duration, peak and gap counts per category; the total has a
    null category."""
    return scan.rollup(category).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("n").alias("frames"),
        F.sum("dur").alias("dur"),
        F.max("max_speed").alias("max_speed"),
        F.max("max_dt").alias("max_dt"),
        F.sum("n_stuck").alias("n_stuck"),
        F.sum("n_gap_small").alias("n_gap_small"),
        F.sum("n_gap_big").alias("n_gap_big"),
    )


def scan_summary(scan: DataFrame) -> DataFrame:
    """One row: totals, and the medians of the per-recording medians and maxima."""
    totals = scan.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_frames"),
        (F.coalesce(F.sum("dur"), F.lit(0.0)) / 3600.0).alias("total_dur_h"),
        F.coalesce(F.max("max_speed"), F.lit(0.0)).alias("global_max_speed"),
        F.coalesce(F.max("max_dt"), F.lit(0.0)).alias("max_dt_global"),
        F.coalesce(F.sum("n_stuck"), F.lit(0)).alias("n_stuck"),
        F.coalesce(F.sum("n_gap_small"), F.lit(0)).alias("n_gap_small"),
        F.coalesce(F.sum("n_gap_big"), F.lit(0)).alias("n_gap_big"),
    )
    long = scan.select(
        F.explode(
            F.array(
                F.struct(F.lit("med").alias("m"), F.col("med_dt").alias("v")),
                F.struct(F.lit("max").alias("m"), F.col("max_dt").alias("v")),
            )
        ).alias("_x")
    ).select("_x.*")
    middles = median(long, ["m"], "v", "mid").agg(
        F.max(F.when(F.col("m") == "med", F.col("mid"))).alias("median_of_med_dt"),
        F.max(F.when(F.col("m") == "max", F.col("mid"))).alias("median_of_max_dt"),
    )
    # two one-row tables
    one = F.lit(1)
    return (
        totals.withColumn("_k", one)
        .join(middles.withColumn("_k", one), "_k")
        .drop("_k")
        .na.fill(0.0, ["median_of_med_dt", "median_of_max_dt"])
    )


def segment_durations(
    frames: DataFrame, keys: Sequence[str], order: str, time: str = "t"
) -> DataFrame:
    """Last time minus first time in row order; 0 when there is none."""
    span = F.max_by(time, order) - F.min_by(time, order)
    return frames.groupBy(*keys).agg(F.coalesce(span, F.lit(0.0)).alias("duration"))


# -- distributions ---------------------------------------------------------


def duration_summary(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """n, total hours, min, median, mean and max; zeros when empty."""
    basic = df.groupBy(*by).agg(
        F.count(value).alias("n"),
        (F.coalesce(F.sum(value), F.lit(0.0)) / 3600.0).alias("total_h"),
        F.coalesce(F.min(value), F.lit(0.0)).alias("min"),
        F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
        F.coalesce(F.max(value), F.lit(0.0)).alias("max"),
    )
    keyed = [*by, "_k"]
    middle = median(df, by, value, "median").withColumn("_k", F.lit(1))
    return (
        same_key_join(basic.withColumn("_k", F.lit(1)), middle, keyed)
        .drop("_k")
        .na.fill(0.0, ["median"])
    )


def duration_percentiles(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    percentiles: Sequence[float] = REPORT_PERCENTILES,
    **options,
) -> DataFrame:
    """Long form: one row per percentile, linear interpolation, exact."""
    found = exact_quantiles(df, by, value, [p / 100.0 for p in percentiles], "_q", **options)
    marks = F.array(*[F.lit(float(p)) for p in percentiles])
    pairs = F.explode(F.arrays_zip(marks.alias("percentile"), F.col("_q").alias("value")))
    return found.select(*by, pairs.alias("_x")).select(*by, "_x.percentile", "_x.value")


def histogram(
    df: DataFrame,
    value: str,
    edges: Sequence[float] = DURATION_EDGES,
    labels: Sequence[str] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Half-open bins; empty bins are listed; values below the first edge are in
    none. One aggregation: every bin is a conditional count."""
    labels = labels or edge_labels(edges)
    v = F.col(value)
    in_bin = [
        count_where((v >= float(lo)) & (v < float(hi)) if math.isfinite(hi) else v >= float(lo))
        for lo, hi in zip(edges[:-1], edges[1:])
    ]
    wide = df.groupBy(*by).agg(F.count(value).alias("_n"), F.array(*in_bin).alias("_c"))
    names = F.array(*[F.lit(x) for x in labels])
    bins = F.arrays_zip(names.alias("bin"), F.col("_c").alias("count"))
    return wide.select(*by, "_n", F.posexplode(bins).alias("bin_no", "_x")).select(
        *by,
        "bin_no",
        "_x.bin",
        "_x.count",
        percent(F.col("_x.count"), F.col("_n")).alias("percent"),
    )


def retained_histogram(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    labels = edge_labels(RETAINED_EDGES, last="{0:g}+")
    return histogram(df, value, RETAINED_EDGES, labels, by)


def box_numbers(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Whisker and quartile values per group (5, 25, 50, 75, 95 percent)."""
    found = exact_quantiles(df, by, value, BOX_PROBABILITIES, "_q")
    names = ("p05", "p25", "p50", "p75", "p95")
    return found.select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


# -- comparisons -----------------------------------------------------------


def long_metrics(one_row: DataFrame, stage: str, metrics: Sequence[str] | None = None) -> DataFrame:
    """(stage, metric, value) rows of a one-row statistics table."""
    names = list(metrics or one_row.columns)
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
            for n in names
        ]
    )
    return one_row.select(F.explode(pairs).alias("_x")).select(
        F.lit(stage).alias("stage"), "_x.metric", "_x.value"
    )


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Join of two long metric tables: change, and change in percent of before."""
    old = before.select("metric", F.col("value").alias("before"))
    new = after.select("metric", F.col("value").alias("after"))
    delta = F.col("after") - F.col("before")
    return old.join(new, "metric").select(
        "metric",
        "before",
        "after",
        delta.alias("delta"),
        percent(delta, F.col("before")).alias("delta_percent"),
    )


# -- attempts and dataset totals -------------------------------------------


def flag_runs(
    frames: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    flag: Column,
    *,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Number of maximal runs of ``flag`` per sequence, with frames and span."""
    rows = frames.withColumn("_flag", F.coalesce(flag, F.lit(False)))
    track = Track.of(rows.select(*keys, *order, "_flag"), keys, order, max_rows=max_rows)
    track = track.neighbours(before={"_was": F.col("_flag")})
    starts = F.col("_flag") & ~F.coalesce("_was", F.lit(False))
    return track.df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("frames"),
        count_where(F.col("_flag")).alias("flag_frames"),
        count_where(starts).alias("attempts"),
    )


def dataset_totals(per_recording: DataFrame, category: str = "category") -> DataFrame:
    """Clips, frames, hours and attempts per category and in total (null)."""
    return per_recording.rollup(category).agg(
        F.count(F.lit(1)).alias("clips"),
        F.sum("frames").alias("frames"),
        (F.sum("duration") / 3600.0).alias("hours"),
        F.sum("attempts").alias("attempts"),
    )
