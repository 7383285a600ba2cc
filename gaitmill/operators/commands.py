"""Command table: what the player asked for, in robot conventions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaitmill.functions import rotation as rot
from gaitmill.functions.rotation import CM_TO_M, Quat, Rigid, Vec

BUTTONS = ("jump", "crouch", "sprint", "walk")


def body_velocity(q: Quat, velocity: Vec) -> tuple[Column, Column]:
    """(forward, leftward) velocity in m/s from world cm/s; zeros when the
    rotation is unusable."""
    local = rot.rotate(rot.conjugate(rot.unit(q)), velocity)
    usable = rot.norm(q) > 0

    def or_zero(c: Column) -> Column:
        return F.when(usable & c.isNotNull(), c).otherwise(F.lit(0.0))

    return or_zero(local.x * CM_TO_M), or_zero(-local.y * CM_TO_M)


def look_heading(yaw_degrees: Column, align: Rigid) -> tuple[Column, Column]:
    """Horizontal look direction in robot axes, not normalised again."""
    angle = F.radians(yaw_degrees)
    ahead = Vec(F.sin(angle), F.cos(angle), F.lit(0.0))  # x and y swapped
    turned = align.turn(ahead)
    return turned.x, turned.y


def command_table(frames: DataFrame, keys: Sequence[str], align: Rigid) -> DataFrame:
    """One row per frame from the ``cmd`` and ``root`` structs."""
    cmd, root = F.col("cmd"), F.col("root")
    zero = F.lit(0.0)
    move = [F.coalesce(F.get(cmd["move"], F.lit(i)), zero) for i in (0, 1)]
    still = F.array(*[F.lit(0.0)] * 3)
    upright = F.array(*[F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)])
    velocity = body_velocity(
        rot.quat_xyzw(F.coalesce(root["q"], upright)),
        rot.vec(F.coalesce(root["lv"], still)),
    )
    look = look_heading(F.coalesce(cmd["lookY"], zero), align)
    values = {
        "look_x": look[0],
        "look_y": look[1],
        "move_forward": move[1],
        "move_right": move[0],
        "vel_forward": velocity[0],
        "vel_left": velocity[1],
        "yaw_rate": -F.coalesce(cmd["desYR"], zero),
    }
    return frames.select(
        *keys,
        *[c.cast("float").alias(n) for n, c in values.items()],
        *[F.coalesce(cmd[b], F.lit(False)).alias(b) for b in BUTTONS],
    )


def align_lengths(commands: DataFrame, motion: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the frames both sides have: both count from 0, so an inner join on
    (motion, index) is the cut to the shorter one."""
    return commands.join(motion.select(*keys), list(keys), "left_semi")
