"""Cross-dataset metrics, ordering and sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaitmill.functions.text import stable_hash
from gaitmill.operators.quantiles import exact_quantiles
from gaitmill.operators.shared import count_where, same_key_join
from gaitmill.operators.smoothing import steps
from gaitmill.operators.track import MAX_ROWS, Track

MM_PER_M = 1000.0
FINGERPRINT_PAGE = 1024
JUMP_LIMIT = 0.01
JUMPS_SHOWN = 12

# Names that stand for another point, and group labels by body part.
HUMAN_ALIASES = {"LeftFootMod": "foot_l", "RightFootMod": "foot_r"}
ROBOT_ALIASES = {
    "left_hip_yaw_link": "left_hip_pitch_link",
    "right_hip_yaw_link": "right_hip_pitch_link",
    "left_shoulder_yaw_link": "left_shoulder_pitch_link",
    "right_shoulder_yaw_link": "right_shoulder_pitch_link",
}
PART_LABELS = {
    "pelvis": "pelvis",
    "thigh": "hip",
    "calf": "knee",
    "foot": "ankle",
    "upperarm": "shoulder",
    "lowerarm": "elbow",
    "hand": "hand",
}


def point_distance(left: str = "h", right: str = "r") -> Column:
    squares = [(F.col(f"{left}{c}") - F.col(f"{right}{c}")) ** 2 for c in "xyz"]
    return F.sqrt(squares[0] + squares[1] + squares[2])


def _renamed(points: DataFrame, keys: Sequence[str], joint: str, prefix: str, name: str) -> DataFrame:
    return points.select(*keys, F.col(joint).alias(name), *[F.col(c).alias(f"{prefix}{c}") for c in "xyz"])


def pair_error(
    human: DataFrame, robot: DataFrame, pairs: Mapping[str, str], keys: Sequence[str]
) -> DataFrame:
    """Mean distance over the mapped (human -> robot) joints per frame, in mm.

    The joint map is configuration of a dozen rows, applied as a literal.
    """
    table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    h = _renamed(human, keys, "joint", "h", "_human").where(F.col("_human").isin(*pairs))
    h = h.withColumn("_robot", F.try_element_at(table, F.col("_human"))).drop("_human")
    r = _renamed(robot, keys, "joint", "r", "_robot")
    both = h.join(r, [*keys, "_robot"])
    return both.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pairs"), (F.avg(point_distance()) * MM_PER_M).alias("error_mm")
    )


def offset_summary(
    human: DataFrame, robot: DataFrame, joint: str, keys: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Median, p95 and maximum distance of one joint between the two skeletons."""
    h = _renamed(human.where(F.col("joint") == joint), keys, "joint", "h", "_j").drop("_j")
    r = _renamed(robot.where(F.col("joint") == joint), keys, "joint", "r", "_j").drop("_j")
    both = h.join(r, list(keys)).select(*by, point_distance().alias("d"))
    found = exact_quantiles(both, by, "d", [0.5, 0.95, 1.0], "_q")
    return found.select(
        *by, *[F.col("_q")[i].alias(n) for i, n in enumerate(("median", "p95", "max"))]
    )


def foot_height_summary(
    joints: DataFrame, feet: Sequence[str], keys: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Lower foot per frame, then its minimum, median and maximum."""
    lowest = joints.where(F.col("joint").isin(*feet)).groupBy(*keys).agg(F.min("z").alias("_z"))
    found = exact_quantiles(lowest, by, "_z", [0.0, 0.5, 1.0], "_q")
    return found.select(
        *by, *[F.col("_q")[i].alias(n) for i, n in enumerate(("min", "median", "max"))]
    )


def grounding_residual(
    feet: DataFrame, *, human_offset: float, robot_offset: float, by: Sequence[str] = ()
) -> DataFrame:
    """Mean and maximum of the remaining ground difference per side."""
    out = []
    for side in "lr":
        robot = F.col(f"toe_{side}") - robot_offset
        rest = F.abs(robot - (F.col(f"ball_{side}") - human_offset))
        out += [F.avg(rest).alias(f"mean_{side}"), F.max(rest).alias(f"max_{side}")]
    return feet.groupBy(*by).agg(*out)


def position_matches(spark: SparkSession, config: Mapping) -> DataFrame:
    """Correspondences with a positive position weight in either match table.

    A robot body matched to two human joints is an error; so is a joint that
    belongs to no body part.
    """
    rows = [
        (robot, str(entry[0]), float(entry[1]))
        for table in ("ik_match_table1", "ik_match_table2")
        for robot, entry in config.get(table, {}).items()
    ]
    entries = spark.createDataFrame(rows, "target_robot string, target_human string, weight double")
    used = entries.where("weight > 0")
    conflicts = used.groupBy("target_robot").agg(F.countDistinct("target_human").alias("n"))
    clash = conflicts.where("n > 1").limit(1).collect()
    if clash:
        raise ValueError(f"{clash[0]['target_robot']} maps to several human joints")

    def alias(column: str, names: Mapping[str, str]) -> Column:
        table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
        return F.coalesce(F.try_element_at(table, F.col(column)), F.col(column))

    group = F.lit(None).cast("string")
    for part, label in reversed(PART_LABELS.items()):
        group = F.when(F.lower("target_human").contains(part), label).otherwise(group)
    matches = used.select("target_robot", "target_human").distinct().withColumns(
        {
            "human": alias("target_human", HUMAN_ALIASES),
            "robot": alias("target_robot", ROBOT_ALIASES),
            "body_part": group,
        }
    )
    if not matches.where(F.col("body_part").isNull()).isEmpty():
        raise ValueError("a matched joint belongs to no body part")
    if matches.isEmpty():
        raise ValueError("no position matches")
    return matches


# -- order and sampling ------------------------------------------------------------


def frame_offsets(
    motions: DataFrame, order: Sequence[str], length: str = "n_frames", *, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Exclusive running sum of the lengths over all motions."""
    narrow = motions.select(*order, F.col(length).cast("long").alias(length))
    track = Track.of(narrow, [], order, max_rows=max_rows).running(sums={"_upto": F.col(length)})
    return track.result().withColumn("frame_offset", F.col("_upto") - F.col(length)).drop("_upto")


def frames_at(
    frames: DataFrame, motions: DataFrame, clock_s: float, keys: Sequence[str], position: str = "frame_idx"
) -> DataFrame:
    """The frame every (looping) motion shows at a clock time: a point lookup."""
    index = F.floor(F.lit(float(clock_s)) * F.col("fps")).cast("long") % F.col("n_frames")
    wanted = motions.where("n_frames > 0").select(*keys, index.alias(position))
    return frames.join(wanted, [*keys, position], "left_semi")


def seeded_sample(rows: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """``k`` rows without replacement, reproducible, in sampled order."""
    hashed = rows.withColumn("_h", stable_hash(seed, key))
    return hashed.orderBy("_h", key).limit(k).drop("_h")


def fingerprint(
    rows: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    signature: Column,
    *,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """SHA-256 over ordered signatures, as a tree: pages of signatures are hashed,
    then the page hashes, so no group is gathered whole. The size of a page is part
    of the definition: it is no argument."""
    narrow = rows.select(*by, *order, signature.alias("_sig"))
    ranked = Track.of(narrow, by, order, max_rows=max_rows).numbered("_i").result()

    def digest(level: DataFrame, keys: Sequence[str]) -> DataFrame:
        items = F.sort_array(F.collect_list(F.struct("_i", "_sig")))
        text = F.array_join(F.transform(items, lambda s: s["_sig"]), "\n")
        return level.groupBy(*keys).agg(F.sha2(text, 256).alias("_sig"))

    page = F.floor(F.col("_i") / FINGERPRINT_PAGE).cast("long")
    pages = digest(ranked.withColumn("_page", page), [*by, "_page"])
    books = pages.withColumn("_book", F.floor(F.col("_page") / FINGERPRINT_PAGE).cast("long"))
    books = digest(books.withColumnRenamed("_page", "_i"), [*by, "_book"])
    top = digest(books.withColumnRenamed("_book", "_i"), by)
    return top.withColumnRenamed("_sig", "fingerprint")


# -- diagnostics --------------------------------------------------------------------


def smoothness(
    rows: DataFrame,
    keys: Sequence[str],
    position: str,
    value: str,
    *,
    limit: float = JUMP_LIMIT,
    shown: int = JUMPS_SHOWN,
) -> tuple[DataFrame, DataFrame]:
    """(summary, first jumps): size of the frame-to-frame change per sequence, how
    often it exceeds ``limit``, and the first frames before such a jump."""
    stepped = steps(rows, keys, position, value).where(F.col("step").isNotNull())
    sized = stepped.withColumn("size", F.abs("step"))
    found = exact_quantiles(sized, keys, "size", [0.5], "_q")
    counts = sized.groupBy(*keys).agg(
        F.max("size").alias("max_step"), count_where(F.col("size") > limit).alias("jumps")
    )
    summary = same_key_join(counts, found, keys)
    summary = summary.withColumn("median_step", F.col("_q")[0]).drop("_q")
    jumps = sized.where(F.col("size") > limit).select(
        *keys, (F.col(position) - 1).alias("frame"), "size"
    )
    return summary, first_rows(jumps, keys, "frame", shown)


def first_rows(
    rows: DataFrame, keys: Sequence[str], order: str, k: int, *, pages: int = 64
) -> DataFrame:
    """The first ``k`` rows per sequence, in two steps: first within a hash slice
    of the sequence, then among the survivors, at most ``k * pages`` per sequence."""
    sliced = rows.withColumn("_slice", F.pmod(F.xxhash64(order), F.lit(pages)))
    local = Window.partitionBy(*keys, "_slice").orderBy(order)
    few = sliced.withColumn("_r", F.row_number().over(local)).where(F.col("_r") <= k)
    whole = Window.partitionBy(*keys or (F.lit(0),)).orderBy(order)
    return (
        few.withColumn("rank", F.row_number().over(whole))
        .where(F.col("rank") <= k)
        .drop("_r", "_slice")
    )
