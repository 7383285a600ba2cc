"""Geometry of poses.

A pose is one row per frame with an array of joint structs
``(joint, x, y, z, qw, qx, qy, qz)``. Everything that looks at the joints of one
frame is an array expression on that row, so none of it shuffles, and only
:func:`joint_table` explodes, when joint rows are what is wanted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaitmill.functions import rotation as rot
from gaitmill.functions.rotation import Quat, Rigid, Vec
from gaitmill.operators.track import attach

# Bone names with a role, and heights in metres.
ROOT = "pelvis"
HEAD, FOOT_L, FOOT_R, BALL_L, BALL_R = "head", "foot_l", "foot_r", "ball_l", "ball_r"
FOOT_TARGETS = {"LeftFootMod": (FOOT_L, BALL_L), "RightFootMod": (FOOT_R, BALL_R)}
HEAD_ABOVE = 0.09
DEFAULT_HEAD_Z = 1.7
GROUND_CLEARANCE = 0.1
SOLE_OFFSET = 0.031
MESH_YAW_DEGREES = -90.0


def position(j: Column) -> Vec:
    return Vec(j["x"], j["y"], j["z"])


def orientation(j: Column) -> Quat:
    return Quat(j["qw"], j["qx"], j["qy"], j["qz"])


def joint(name: Column, p: Vec, q: Quat) -> Column:
    values = {"joint": name, "x": p.x, "y": p.y, "z": p.z}
    values |= {"qw": q.w, "qx": q.x, "qy": q.y, "qz": q.z}
    return F.struct(*[c.alias(n) for n, c in values.items()])


def moved(j: Column, p: Vec) -> Column:
    return joint(j["joint"], p, orientation(j))


def find(pose: Column, name: str) -> Column:
    """The joint of that name, or null."""
    return F.get(F.filter(pose, lambda j: j["joint"] == name), F.lit(0))


def map_positions(pose: Column, change: Callable[[Vec], Vec]) -> Column:
    return F.transform(pose, lambda j: moved(j, change(position(j))))


# -- capture to pose -----------------------------------------------------------


def world_pose(joints: Column) -> Column:
    """Pose of the recorded world positions and rotations (cm, left-handed)."""
    return F.transform(
        joints, lambda j: joint(j["n"], rot.vec(j["wp"]), rot.quat_xyzw(j["wq"]))
    )


def component_poses(
    frames: DataFrame, *, keep_height: bool = False, ground_cm: float = 0.0
) -> DataFrame:
    """Add ``pose`` in world axes (cm) from the component space of ``joints``: the
    mesh is turned by -90 degrees against the actor (``root``). The height is
    pinned to 0 unless kept."""
    actor = rot.unit(rot.quat_xyzw(F.col("root")["q"]))
    frames = frames.withColumns({f"_a{n}": c for n, c in zip("wxyz", actor)})
    mesh = rot.multiply(Quat(*rot.named("_a", "wxyz")), rot.yaw(MESH_YAW_DEGREES))
    frames = frames.withColumns({f"_m{n}": c for n, c in zip("wxyz", mesh)})
    mesh = Quat(*rot.named("_m", "wxyz"))
    turned = {f"_r{i}": F.array(*row) for i, row in enumerate(rot.matrix(mesh))}
    at = rot.vec(F.col("root")["p"])
    height = at.z - ground_cm if keep_height else F.lit(0.0)
    frames = frames.withColumns(turned | {"_ox": at.x, "_oy": at.y, "_oz": height})
    rows = [rot.vec(F.col(f"_r{i}")) for i in range(3)]
    origin = Vec(*rot.named("_o"))

    def place(j: Column) -> Column:
        p = rot.add(rot.transform(rows, rot.vec(j["cp"])), origin)
        return joint(j["n"], p, rot.multiply(mesh, rot.unit(rot.quat_xyzw(j["cq"]))))

    helpers = [f"_a{n}" for n in "wxyz"] + [f"_m{n}" for n in "wxyz"]
    helpers += [*turned, "_ox", "_oy", "_oz"]
    return frames.withColumn("pose", F.transform("joints", place)).drop(*helpers)


def scaled_pose(pose: Column, factor: Column | float) -> Column:
    return map_positions(pose, lambda p: rot.times(p, factor))


def robot_pose(pose: Column) -> Column:
    """Metres in right-handed axes, rotations included."""
    return F.transform(
        pose,
        lambda j: joint(
            j["joint"], rot.to_robot_axes(position(j)), rot.swap_rotation(orientation(j))
        ),
    )


def aligned_pose(
    pose: Column, align: Rigid, delta: Mapping[str, Sequence[float]] | None = None
) -> Column:
    """Global rigid alignment, then the constant rotation (wxyz) of each bone.
    ``delta`` is the skeleton's own table, one entry per bone."""
    table = literal_table({n: tuple(q) for n, q in (delta or {}).items()}, 4)

    def place(j: Column) -> Column:
        q = align.turn_rotation(orientation(j))
        if table is not None:
            own = F.coalesce(
                F.try_element_at(table, j["joint"]), F.array(*map(F.lit, (1.0, 0.0, 0.0, 0.0)))
            )
            q = rot.multiply(q, rot.quat_wxyz(own))
        return joint(j["joint"], align.apply(position(j)), q)

    return F.transform(pose, place)


def literal_table(values: Mapping[str, Sequence[float]], width: int) -> Column | None:
    """A small configuration table as a map literal: no join, no shuffle."""
    if not values:
        return None
    pairs = []
    for name, row in values.items():
        if len(row) != width:
            raise ValueError(f"{name}: expected {width} values")
        pairs += [F.lit(name), F.array(*[F.lit(float(v)) for v in row])]
    return F.create_map(*pairs)


def joint_table(poses: DataFrame, keys: Sequence[str], pose: str = "pose") -> DataFrame:
    """One row per joint."""
    exploded = poses.select(*keys, F.posexplode(pose).alias("joint_idx", "_j"))
    return exploded.select(*keys, "joint_idx", "_j.*")


# -- targets ---------------------------------------------------------------------


def with_foot_targets(pose: Column) -> Column:
    """Append the synthetic feet: ankle position with the ball's rotation."""
    extra = []
    for name, (ankle, ball) in FOOT_TARGETS.items():
        a, b = find(pose, ankle), find(pose, ball)
        both = a.isNotNull() & b.isNotNull()
        extra.append(F.when(both, joint(F.lit(name), position(a), orientation(b))))
    return F.concat(pose, F.filter(F.array(*extra), lambda j: j.isNotNull()))


def root_xy(pose: Column, root: str = ROOT) -> tuple[Column, Column]:
    at = find(pose, root)
    return F.coalesce(at["x"], F.lit(0.0)), F.coalesce(at["y"], F.lit(0.0))


def recentred(pose: Column, x: Column, y: Column) -> Column:
    """Subtract a horizontal offset; add it back with negated arguments."""
    return map_positions(pose, lambda p: Vec(p.x - x, p.y - y, p.z))


def with_root(poses: DataFrame, pose: str = "pose", root: str = ROOT) -> DataFrame:
    """Add the root position as ``root_x, root_y, root_z``, looked up once."""
    found = poses.withColumn("_root", find(F.col(pose), root))
    return found.withColumns(
        {f"root_{n}": F.col("_root")[n] for n in "xyz"}
    ).drop("_root")


def scaled_about_root(
    pose: Column, factors: Mapping[str, float], centre: Vec, root: str = ROOT
) -> Column:
    """``(p - root) * s + s_root * root``; joints outside the table are dropped.
    ``centre`` is the root position, as columns of the row."""
    table = literal_table({n: (s,) for n, s in factors.items()}, 1)
    anchor = rot.times(centre, F.lit(float(factors[root])))

    def place(j: Column) -> Column:
        s = F.get(F.try_element_at(table, j["joint"]), F.lit(0))
        return moved(j, rot.add(rot.times(rot.subtract(position(j), centre), s), anchor))

    known = F.filter(pose, lambda j: F.try_element_at(table, j["joint"]).isNotNull())
    return F.transform(known, place)


def scaled_toe(pose: Column, ball: str, factor: float, root_factor: float, root: str = ROOT) -> Vec:
    """A toe scaled like its foot, although toes are not in the scale table."""
    centre, toe = position(find(pose, root)), position(find(pose, ball))
    local = rot.times(rot.subtract(toe, centre), factor)
    return rot.add(local, rot.times(centre, root_factor))


def offset_locally(
    pose: Column, offsets: Mapping[str, tuple[Sequence[float], Sequence[float]]]
) -> Column:
    """Turn each joint by its offset (wxyz), then shift it along its new axes.
    ``offsets`` maps a joint to (shift, turn)."""
    table = literal_table({n: (*p, *q) for n, (p, q) in offsets.items()}, 7)

    def place(j: Column) -> Column:
        row = F.try_element_at(table, j["joint"])
        turn = Quat(*[F.get(row, F.lit(i)) for i in range(3, 7)])
        q = rot.multiply(orientation(j), rot.unit(turn))
        return joint(j["joint"], rot.add(position(j), rot.rotate(q, rot.vec(row))), q)

    known = F.filter(pose, lambda j: F.try_element_at(table, j["joint"]).isNotNull())
    return F.transform(known, place)


def height_factors(factors: Mapping[str, float], actual: float, assumed: float) -> dict[str, float]:
    return {name: s * actual / assumed for name, s in factors.items()}


def standing_height(pose: Column) -> Column:
    """Head above the lower foot, plus what is above the head joint."""
    head = F.coalesce(find(pose, HEAD)["z"], F.lit(DEFAULT_HEAD_Z))
    feet = [F.coalesce(find(pose, n)["z"], F.lit(0.0)) for n in (FOOT_L, FOOT_R)]
    return head - F.least(*feet) + HEAD_ABOVE


def lowest_foot(pose: Column) -> Column:
    feet = F.filter(pose, lambda j: j["joint"].contains("foot") | j["joint"].contains("Foot"))
    return F.array_min(F.transform(feet, lambda j: j["z"]))


def dropped_to_ground(pose: Column) -> Column:
    lowest = lowest_foot(pose)
    return map_positions(pose, lambda p: Vec(p.x, p.y, p.z - lowest + GROUND_CLEARANCE))


def raised(pose: Column, by: Column) -> Column:
    """Add to the height; a constant ground offset is a negative ``by``."""
    return map_positions(pose, lambda p: Vec(p.x, p.y, p.z + by))


def lower_ball(pose: Column) -> Column:
    return F.least(find(pose, BALL_L)["z"], find(pose, BALL_R)["z"])


def ball_shift(before: Column, after: Column, sole: float = SOLE_OFFSET) -> Column:
    """Height to add so that the lower ball stands where it stood before."""
    return lower_ball(before) - sole - lower_ball(after)


# -- clips and orientation -----------------------------------------------------


def clip_view(
    poses: DataFrame, motions: DataFrame, key: str = "seg_id", at: str = "frame_idx", q: str = "q"
) -> DataFrame:
    """Root track of a clip moved to start at the origin: position, rotation as
    xyzw and the horizontal forward axis. ``motions`` gives ``n_frames``."""
    array = F.col(q)
    here, turn = rot.vec(array), Quat(*[F.get(array, F.lit(i)) for i in range(3, 7)])
    narrow = poses.select(key, at, *[c.alias(n) for n, c in zip("xyz", here)],
                          *[c.alias(f"q{n}") for n, c in zip("wxyz", turn)])
    first = narrow.where(F.col(at) == 0).select(
        key, F.col("x").alias("_x0"), F.col("y").alias("_y0")
    )
    rows = attach(narrow, first.join(motions.select(key, "n_frames"), key), [key], at, "n_frames")
    ahead = rot.forward_axis(rot.unit(Quat(*[F.col(f"q{n}") for n in "wxyz"])))
    return rows.select(
        key,
        at,
        (F.col("x") - F.col("_x0")).alias("x"),
        (F.col("y") - F.col("_y0")).alias("y"),
        "z",
        *[f"q{n}" for n in "xyzw"],
        ahead.x.alias("forward_x"),
        ahead.y.alias("forward_y"),
    )


def relative_euler(base: Quat, other: Quat) -> Vec:
    """Roll, pitch, yaw (degrees) of one orientation seen from another."""
    return rot.euler_xyz(rot.multiply(rot.conjugate(rot.unit(base)), rot.unit(other)))


def neck_angles(spine: Quat, head: Quat) -> tuple[Column, Column]:
    """(yaw, pitch) of the neck in radians."""
    angles = relative_euler(spine, head)
    return F.radians(-angles.y), F.radians(angles.x)
