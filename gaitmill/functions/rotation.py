"""Vectors and quaternions as tuples of columns, JVM-side arithmetic only."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Vec(NamedTuple):
    x: Column
    y: Column
    z: Column


class Quat(NamedTuple):
    w: Column
    x: Column
    y: Column
    z: Column


def vec(array: Column) -> Vec:
    return Vec(*[F.get(array, F.lit(i)) for i in range(3)])


def quat_xyzw(array: Column) -> Quat:
    x, y, z, w = [F.get(array, F.lit(i)) for i in range(4)]
    return Quat(w, x, y, z)


def quat_wxyz(array: Column) -> Quat:
    return Quat(*[F.get(array, F.lit(i)) for i in range(4)])


def constant(values: Sequence[float], kind=Vec):
    return kind(*[F.lit(float(v)) for v in values])


def add(a: Vec, b: Vec) -> Vec:
    return Vec(*[i + j for i, j in zip(a, b)])


def subtract(a: Vec, b: Vec) -> Vec:
    return Vec(*[i - j for i, j in zip(a, b)])


def times(a: Vec, factor) -> Vec:
    return Vec(*[i * factor for i in a])


def scaled(a: Vec, b: Vec) -> Vec:
    return Vec(*[i * j for i, j in zip(a, b)])


def dot(a: Sequence[Column], b: Sequence[Column]) -> Column:
    products = [i * j for i, j in zip(a, b)]
    return sum(products[1:], products[0])


def cross(a: Vec, b: Vec) -> Vec:
    return Vec(
        a.y * b.z - a.z * b.y,
        a.z * b.x - a.x * b.z,
        a.x * b.y - a.y * b.x,
    )


def norm(a: Sequence[Column]) -> Column:
    return F.sqrt(dot(a, a))


def unit(q: Quat) -> Quat:
    """Unit quaternion; null components where the norm is 0."""
    length = norm(q)
    return Quat(*[F.try_divide(c, length) for c in q])


def conjugate(q: Quat) -> Quat:
    return Quat(q.w, -q.x, -q.y, -q.z)


def multiply(a: Quat, b: Quat) -> Quat:
    return Quat(
        a.w * b.w - a.x * b.x - a.y * b.y - a.z * b.z,
        a.w * b.x + a.x * b.w + a.y * b.z - a.z * b.y,
        a.w * b.y - a.x * b.z + a.y * b.w + a.z * b.x,
        a.w * b.z + a.x * b.y - a.y * b.x + a.z * b.w,
    )


def rotate(q: Quat, v: Vec) -> Vec:
    """Rotate by a unit quaternion: v + 2w(u x v) + 2u x (u x v)."""
    u = Vec(q.x, q.y, q.z)
    once = times(cross(u, v), 2.0)
    twice = cross(u, once)
    return Vec(*[p + q.w * o + t for p, o, t in zip(v, once, twice)])


Matrix = tuple[Vec, Vec, Vec]


def matrix(q: Quat) -> Matrix:
    """Rows of the rotation matrix of a unit quaternion.

    Turning many vectors by one rotation: compute these nine columns once per row
    and refer to them, rather than to the quaternion.
    """
    w, x, y, z = q
    return (
        Vec(1.0 - 2.0 * (y * y + z * z), 2.0 * (x * y - w * z), 2.0 * (x * z + w * y)),
        Vec(2.0 * (x * y + w * z), 1.0 - 2.0 * (x * x + z * z), 2.0 * (y * z - w * x)),
        Vec(2.0 * (x * z - w * y), 2.0 * (y * z + w * x), 1.0 - 2.0 * (x * x + y * y)),
    )


def transform(rows: Matrix, v: Vec) -> Vec:
    return Vec(*[dot(row, v) for row in rows])


def named(prefix: str, names: str = "xyz") -> list[Column]:
    return [F.col(f"{prefix}{n}") for n in names]


def angle_degrees(q: Quat) -> Column:
    """Rotation angle of a unit quaternion, 0 to 180."""
    return F.degrees(2.0 * F.acos(F.least(F.abs(q.w), F.lit(1.0))))


def yaw(degrees: float) -> Quat:
    half = math.radians(degrees) / 2.0
    return constant((math.cos(half), 0.0, 0.0, math.sin(half)), Quat)


def euler_xyz(q: Quat) -> Vec:
    """Roll, pitch and yaw in degrees about fixed x, y, z axes."""
    roll = F.atan2(2.0 * (q.w * q.x + q.y * q.z), 1.0 - 2.0 * (q.x * q.x + q.y * q.y))
    sine = 2.0 * (q.w * q.y - q.z * q.x)
    pitch = F.asin(F.greatest(F.least(sine, F.lit(1.0)), F.lit(-1.0)))
    turn = F.atan2(2.0 * (q.w * q.z + q.x * q.y), 1.0 - 2.0 * (q.y * q.y + q.z * q.z))
    return Vec(*[F.degrees(a) for a in (roll, pitch, turn)])


def forward_axis(q: Quat) -> Vec:
    """First column of the rotation matrix: where the local x axis points."""
    return Vec(
        1.0 - 2.0 * (q.y * q.y + q.z * q.z),
        2.0 * (q.x * q.y + q.w * q.z),
        2.0 * (q.x * q.z - q.w * q.y),
    )


# -- frames of reference ------------------------------------------------------

CM_TO_M = 0.01


def to_robot_axes(v: Vec, factor: float = CM_TO_M) -> Vec:
    """Left-handed centimetres to right-handed metres: swap x and y."""
    return times(Vec(v.y, v.x, v.z), factor)


def swap_rotation(q: Quat) -> Quat:
    """The same rotation after swapping x and y (a reflection, so the sense of
    rotation turns around as well)."""
    return Quat(q.w, -q.y, -q.x, -q.z)


class Rigid(NamedTuple):
    """Global alignment: a driver-side rotation matrix and translation."""

    rotation: tuple[tuple[float, float, float], ...]
    translation: tuple[float, float, float]
    quaternion: tuple[float, float, float, float]

    @classmethod
    def from_wxyz(cls, wxyz: Sequence[float], translation: Sequence[float]) -> Rigid:
        length = math.sqrt(sum(c * c for c in wxyz))
        w, x, y, z = (c / length for c in wxyz)
        matrix = (
            (1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)),
            (2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)),
            (2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)),
        )
        return cls(matrix, tuple(float(t) for t in translation), (w, x, y, z))

    def turn(self, v: Vec) -> Vec:
        return Vec(*[dot([F.lit(c) for c in row], v) for row in self.rotation])

    def apply(self, v: Vec) -> Vec:
        return add(self.turn(v), constant(self.translation))

    def turn_rotation(self, q: Quat) -> Quat:
        return multiply(constant(self.quaternion, Quat), q)
