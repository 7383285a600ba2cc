"""Minimum duration, and balance of stationary against moving motions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaitmill.functions.text import present, stable_hash
from gaitmill.operators.quantiles import exact_quantiles
from gaitmill.operators.shared import count_where, must_be_empty, salted_join, settle
from gaitmill.operators.track import MAX_ROWS, Track, attach

# Reject reasons, name of the group without terrain, strata bins.
TOO_SHORT = "duration_lt_min"
EXCESS = "stationary_balance_excess"
NO_TERRAIN = "__no_terrain__/"
STRATUM_BINS = ((5.0, "3-5"), (10.0, "5-10"), (20.0, "10-20"), (60.0, "20-60"))
LAST_STRATUM_BIN = "60+"
SPEED_PROBABILITY = 0.95
MIN_QUATERNION_NORM = 1e-8
DURATION_TOLERANCE = 1e-9


@dataclass(frozen=True)
class BalanceRule:
    min_duration_s: float = 3.0
    speed_window_s: float = 0.5
    max_excursion_m: float = 0.30
    max_p95_speed: float = 0.20
    max_rotation_deg: float = 20.0
    xy_cell_m: float = 1.0
    seed: int = 0


# -- manifest pair -----------------------------------------------------------


def pair_problems(
    stage2: DataFrame,
    stage3: DataFrame,
    key: str = "seg_id",
    frames: str = "n_frames",
    duration: str = "duration_s",
) -> DataFrame:
    """(id, problem) rows of two manifests that must describe the same motions."""

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy(key).agg(
            F.count(F.lit(1)).alias(f"rows_{tag}"),
            F.min(frames).alias(f"frames_{tag}"),
            F.min(duration).alias(f"duration_{tag}"),
        )

    both = side(stage2, "2").join(side(stage3, "3"), key, "full_outer")
    apart = F.abs(F.col("duration_2") - F.col("duration_3")) > DURATION_TOLERANCE
    problem = (
        F.when(F.col("rows_3").isNull(), "missing_stage3")
        .when(F.col("rows_2").isNull(), "extra_stage3")
        .when(F.col("rows_2") > 1, "duplicate_stage2")
        .when(F.col("rows_3") > 1, "duplicate_stage3")
        .when(F.col("frames_2") != F.col("frames_3"), "n_frames_differ")
        .when(apart, "duration_differs")
    )
    return both.select(key, problem.alias("problem")).where(F.col("problem").isNotNull())


def validate_pair(stage2: DataFrame, stage3: DataFrame, **names: str) -> None:
    problems = pair_problems(stage2, stage3, **names)
    must_be_empty(problems, "stage 2 and stage 3 differ", problems.columns)


QPOS_WIDTH = 36


def pose_problems(
    motions: DataFrame, poses: DataFrame, key: str = "seg_id", position: str = "frame_idx", q: str = "q"
) -> DataFrame:
    """(id, problem) rows of motions that cannot be judged by their poses: none at
    all, another number of frames, a wrong width, a number that is not finite, or a
    root quaternion of length zero. The first that holds is named."""
    finite = F.forall(q, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    norm = F.aggregate(F.slice(q, 4, 4), F.lit(0.0), lambda a, v: a + v * v)
    wide = F.coalesce(F.size(q) == QPOS_WIDTH, F.lit(False))
    per = poses.groupBy(key).agg(
        F.count(position).alias("_n"),
        F.min(position).alias("_from"),
        F.max(position).alias("_to"),
        F.count_distinct(position).alias("_distinct"),
        count_where(~wide).alias("_narrow"),
        count_where(wide & ~finite).alias("_odd"),
        count_where(wide & finite & (norm < MIN_QUATERNION_NORM**2)).alias("_zero"),
    )
    dense = (F.col("_from") == 0) & (F.col("_to") == F.col("_n") - 1)
    dense = dense & (F.col("_distinct") == F.col("_n")) & (F.col("_n") == F.col("n_frames"))
    problem = (
        F.when(F.coalesce(F.col("_n"), F.lit(0)) == 0, "missing_qpos")
        .when(F.col("_narrow") > 0, "wrong_width")
        .when(F.col("_odd") > 0, "not_finite")
        .when(F.col("_zero") > 0, "zero_quaternion")
        .when(~F.coalesce(dense, F.lit(False)), "frames_differ")
    )
    both = motions.select(key, "n_frames").join(per, key, "left")
    return both.select(key, problem.alias("problem")).where(F.col("problem").isNotNull())


def validate_poses(motions: DataFrame, poses: DataFrame, **names: str) -> None:
    problems = pose_problems(motions, poses, **names)
    must_be_empty(problems, "motions without a full descriptor", problems.columns)


def terrain_group(category: Column, terrain_ref: Column) -> Column:
    return F.coalesce(present(terrain_ref), F.concat(F.lit(NO_TERRAIN), category))


# -- motion descriptor -------------------------------------------------------


def window_frames(fps: Column, frames: Column, window_s: float) -> Column:
    """Speed window in frames: half-even rounding, at least 1, inside the motion."""
    wanted = F.greatest(F.rint(F.lit(window_s) * fps), F.lit(1.0))
    return F.least(wanted, frames - 1).cast("long")


def window_speeds(
    poses: DataFrame,
    motions: DataFrame,
    key: str = "seg_id",
    position: str = "frame_idx",
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """``speed`` between each frame and the one a window later.

    ``motions`` gives ``n_frames``, ``fps`` and ``window_frames`` per motion; the
    window differs per motion, so the later frame is found by an equi-join on
    (motion, index), which spreads long motions evenly.
    """
    sized = attach(
        poses.select(key, position, x, y),
        motions.select(key, "n_frames", "fps", "window_frames"),
        [key],
        position,
        "n_frames",
    )
    earlier = sized.withColumn("_to", F.col(position) + F.col("window_frames"))
    later = poses.select(
        F.col(key).alias("_k"),
        F.col(position).alias("_p"),
        F.col(x).alias("_x"),
        F.col(y).alias("_y"),
    )
    on = F.col(key).eqNullSafe(F.col("_k")) & (F.col("_to") == F.col("_p"))
    seconds = F.col("window_frames") / F.col("fps")
    moved = F.hypot(F.col("_x") - F.col(x), F.col("_y") - F.col(y))
    return earlier.join(later, on).select(key, position, F.try_divide(moved, seconds).alias("speed"))


def rotation_from_first(q: Sequence[Column], first: Sequence[Column]) -> Column:
    """Angle in degrees between two quaternions, q and -q being the same."""
    norm = F.sqrt(sum((c * c for c in q[1:]), q[0] * q[0]))
    norm0 = F.sqrt(sum((c * c for c in first[1:]), first[0] * first[0]))
    products = [a * b for a, b in zip(q, first)]
    dot = F.try_divide(sum(products[1:], products[0]), norm * norm0)
    return F.degrees(2.0 * F.acos(F.least(F.abs(dot), F.lit(1.0))))


def describe_motions(
    poses: DataFrame,
    motions: DataFrame,
    rule: BalanceRule = BalanceRule(),
    *,
    key: str = "seg_id",
    position: str = "frame_idx",
    xy: tuple[str, str] = ("x", "y"),
    quaternion: tuple[str, str, str, str] = ("qw", "qx", "qy", "qz"),
    max_values: int | None = None,
) -> DataFrame:
    """Start, end, excursion, p95 window speed and rotation per motion.

    ``poses`` are densely numbered; ``motions`` gives ``n_frames`` and ``fps``. A
    motion without a first pose has nulls for what cannot be said.
    The first pose reaches the other frames through a paged join.
    """
    x, y = xy
    sized = motions.select(
        key, "n_frames", "fps",
        window_frames(F.col("fps"), F.col("n_frames"), rule.speed_window_s).alias("window_frames"),
    )
    columns = [x, y, *quaternion]
    narrow = poses.select(key, position, *columns)
    first = (
        narrow.where(F.col(position) == 0)
        .select(key, *[F.col(c).alias(f"_{c}") for c in columns])
        .join(sized, key)
    )
    compared = attach(narrow, first, [key], position, "n_frames")
    excursion = F.hypot(F.col(x) - F.col(f"_{x}"), F.col(y) - F.col(f"_{y}"))
    angle = rotation_from_first(
        [F.col(c) for c in quaternion], [F.col(f"_{c}") for c in quaternion]
    )
    norm = F.sqrt(sum((F.col(c) * F.col(c) for c in quaternion[1:]),
                      F.col(quaternion[0]) * F.col(quaternion[0])))
    spread = compared.groupBy(key).agg(
        F.first(f"_{x}").alias("start_x"),
        F.first(f"_{y}").alias("start_y"),
        F.max_by(x, position).alias("end_x"),
        F.max_by(y, position).alias("end_y"),
        F.max(excursion).alias("max_excursion_m"),
        F.max(angle).alias("max_rotation_deg"),
        count_where(norm < MIN_QUATERNION_NORM).alias("bad_quaternions"),
        F.first("window_frames").alias("window_frames"),
    )
    speeds = window_speeds(poses, sized, key, position, x, y)
    options = {} if max_values is None else {"max_values": max_values}
    options["largest"] = motions.agg(F.max("n_frames")).first()[0] or 0
    p95 = exact_quantiles(speeds, [key], "speed", [SPEED_PROBABILITY], "_p", **options)
    p95 = p95.select(key, F.col("_p")[0].alias("p95_window_speed"))
    described = spread.drop("window_frames").join(p95, key, "left")
    return sized.select(key, "window_frames").join(described, key, "left")


def is_stationary(rule: BalanceRule) -> Column:
    """Strictly below all three limits; on a limit a motion is moving."""
    return (
        (F.col("max_excursion_m") < rule.max_excursion_m)
        & (F.col("p95_window_speed") < rule.max_p95_speed)
        & (F.col("max_rotation_deg") < rule.max_rotation_deg)
    )


# -- selection -----------------------------------------------------------------


def stratum_bin(duration: Column) -> Column:
    label = F.lit(LAST_STRATUM_BIN)
    for limit, name in reversed(STRATUM_BINS):
        label = F.when(duration < limit, name).otherwise(label)
    return label


def cell(value: Column, size: float) -> Column:
    return F.floor(value / size).cast("long")


def group_quotas(motions: DataFrame, group: str, stationary: str = "stationary") -> DataFrame:
    """Moving and stationary motions per terrain group; the quota is the former."""
    return motions.groupBy(group).agg(
        count_where(~F.col(stationary)).alias("quota"),
        count_where(F.col(stationary)).alias("n_stationary"),
    )


def pick_round_robin(
    candidates: DataFrame,
    group: str,
    stratum: Sequence[str],
    key: str,
    seed: int,
    *,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add ``pick``, the turn (from 1) of every candidate within its group.

    Strata take turns in hash order; within a stratum motions come in hash order.
    So the order is (round, stratum hash), where the round is the rank within the
    stratum. Both ranks are exact for groups of any size, and ties end at the key.
    """
    hashed = candidates.withColumns(
        {
            "_hm": stable_hash(seed, F.lit("motion"), key),
            "_hs": stable_hash(seed, F.lit("stratum"), *stratum),
        }
    )
    hashed = settle(hashed)  # sizes, rounds and turns all read it
    rounds = Track.of(hashed, [group, *stratum], ["_hm", key], max_rows=max_rows)
    turns = rounds.numbered("_round").result()
    order = ["_round", "_hs", *stratum]
    ranked = Track.of(turns, [group], order, max_rows=max_rows).numbered("pick", start=1)
    return ranked.result().drop("_hm", "_hs", "_round")


def decide(
    motions: DataFrame,
    rule: BalanceRule = BalanceRule(),
    *,
    key: str = "seg_id",
    group: str = "terrain_group",
    source: str = "source_recording",
    duration: str = "duration_s",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add ``decision`` and ``reject_reason`` to described motions.

    Only groups with more stationary than moving motions are ranked at all. A motion
    long enough but neither stationary nor moving is an error.
    """
    short = F.col(duration) < rule.min_duration_s
    eligible = motions.where(~short)
    quotas = group_quotas(eligible, group)
    crowded = quotas.where(F.col("n_stationary") > F.col("quota"))
    candidates = eligible.where("stationary").select(
        key,
        group,
        F.col(source).cast("string").alias("_source"),
        stratum_bin(F.col(duration)).alias("_bin"),
        cell(F.col("start_x"), rule.xy_cell_m).alias("_cx"),
        cell(F.col("start_y"), rule.xy_cell_m).alias("_cy"),
    )
    candidates = salted_join(candidates, crowded.select(group, "quota"), [group], key)
    picked = pick_round_robin(
        candidates, group, ["_source", "_bin", "_cx", "_cy"], key, rule.seed, max_rows=max_rows
    )
    excess = picked.where(F.col("pick") > F.col("quota")).select(key, F.lit(True).alias("_excess"))
    unknown = F.raise_error(F.concat(F.lit("not described: "), F.col(key).cast("string")))
    reason = (
        F.when(short, TOO_SHORT)
        .when(F.col("stationary").isNull(), unknown.cast("string"))
        .when(F.col("_excess"), EXCESS)
    )
    return (
        motions.join(excess, key, "left")
        .withColumn("reject_reason", reason)
        .withColumn("decision", F.when(F.col("reject_reason").isNull(), "keep").otherwise("reject"))
        .drop("_excess")
    )


def summaries(
    decided: DataFrame,
    category: str = "category",
    group: str = "terrain_group",
    duration: str = "duration_s",
) -> DataFrame:
    """The fifteen totals: overall, per category and per terrain group, in one
    aggregation over grouping sets. ``scope`` says which."""
    short = F.coalesce(F.col("reject_reason") == TOO_SHORT, F.lit(False))
    excess = F.coalesce(F.col("reject_reason") == EXCESS, F.lit(False))
    keep = F.col("decision") == "keep"
    parts = {
        "input": F.lit(True),
        "duration_rejected": short,
        "balance_rejected": excess,
        "output": keep,
    }
    totals = []
    for name, condition in parts.items():
        totals += [
            count_where(condition).alias(f"{name}_motions"),
            F.coalesce(F.sum(F.when(condition, F.col("n_frames"))), F.lit(0)).alias(
                f"{name}_frames"
            ),
            F.coalesce(F.sum(F.when(condition, F.col(duration))), F.lit(0.0)).alias(
                f"{name}_duration_s"
            ),
        ]
    totals += [
        count_where(~short).alias("eligible_motions"),
        count_where(~short & ~F.col("stationary")).alias("moving_motions"),
        count_where(~short & F.col("stationary")).alias("stationary_motions"),
    ]
    level = F.grouping_id(category, group)
    scope = F.when(level == 3, "global").when(level == 1, "category").otherwise("terrain")
    name = F.when(level == 3, "all").when(level == 1, F.col(category)).otherwise(F.col(group))
    sets = [[], [F.col(category)], [F.col(group)]]
    return (
        decided.groupingSets(sets, category, group)
        .agg(scope.alias("scope"), name.alias("name"), *totals)
        .drop(category, group)
    )


def audit_tables(decided: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(duration rejects, balance rejects)."""
    reason = F.col("reject_reason")
    return decided.where(reason == TOO_SHORT), decided.where(reason == EXCESS)


def with_filter_record(kept: DataFrame, rule: BalanceRule, status: str) -> DataFrame:
    """Kept rows with their new status and the rule that let them pass."""
    values = {
        "min_duration_s": rule.min_duration_s,
        "speed_window_s": rule.speed_window_s,
        "max_excursion_m": rule.max_excursion_m,
        "max_p95_speed_mps": rule.max_p95_speed,
        "max_rotation_deg": rule.max_rotation_deg,
        "xy_cell_m": rule.xy_cell_m,
    }
    record = F.struct(
        *[F.lit(v).alias(n) for n, v in values.items()], F.lit(rule.seed).alias("seed")
    )
    return kept.withColumns(
        {
            "status": F.lit(status),
            "min3_static_balanced": F.lit(True),
            "min_duration_static_balance": record,
        }
    )
