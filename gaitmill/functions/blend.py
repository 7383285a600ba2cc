"""Interpolation between two values of the same nested type."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaitmill.schemas import QUATERNION_FIELDS

SNAP = 0.5
NEARLY_PARALLEL = 0.9995
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATS = (T.FloatType, T.DoubleType)


def lerp_array(a: Column, b: Column, u: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + u * (y - x))


def dot_array(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x
    )


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def slerp(a: Column, b: Column, u: Column) -> Column:
    """Spherical interpolation along the shorter arc; near-parallel: unit lerp."""

    def flat(sign: Column) -> Column:
        straight = F.zip_with(a, b, lambda x, y: x + u * (sign * y - x))

        def normalised(s: Column) -> Column:
            unit = bound(
                F.sqrt(dot_array(s, s)),
                lambda n: F.when(n > 0, F.transform(s, lambda x: F.try_divide(x, n))),
            )
            return F.coalesce(unit, a)

        return bound(straight, normalised)

    def arc(cosine: Column, sign: Column) -> Column:
        def weights(angle: Column) -> Column:
            sine = F.sin(angle)
            return F.struct(
                F.try_divide(F.sin((1 - u) * angle), sine).alias("a"),
                (sign * F.try_divide(F.sin(u * angle), sine)).alias("b"),
            )

        pair = bound(F.acos(F.least(cosine, F.lit(1.0))), weights)
        return bound(pair, lambda w: F.zip_with(a, b, lambda x, y: w["a"] * x + w["b"] * y))

    def along(d: Column) -> Column:
        sign = F.when(d < 0, -1.0).otherwise(1.0)
        return F.when(F.abs(d) > NEARLY_PARALLEL, flat(sign)).otherwise(arc(F.abs(d), sign))

    return bound(dot_array(a, b), along)


def blend(
    a: Column,
    b: Column,
    kind: T.DataType,
    u: Column,
    *,
    name: str = "",
    records: str = "hold",
) -> Column:
    """Value at fraction ``u`` between ``a`` and ``b``, chosen by declared type.

    Structs go field by field; arrays of floats are slerped under a quaternion
    name and lerped otherwise; booleans and integers snap at the middle; floats
    lerp; anything else keeps ``a``. A value missing on one side is taken from the
    other. Arrays of structs (the joints) are held at ``a``; ``records="blend"``
    interpolates them element by element instead.
    """
    mixed = _both_present(a, b, kind, u, name, records)
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(mixed)


def _both_present(a, b, kind, u, name, records):
    if isinstance(kind, T.StructType):
        return F.struct(
            *[
                blend(
                    a.getField(f.name),
                    b.getField(f.name),
                    f.dataType,
                    u,
                    name=f.name,
                    records=records,
                ).alias(f.name)
                for f in kind.fields
            ]
        )
    if isinstance(kind, T.ArrayType):
        mixed = _arrays(a, b, kind.elementType, u, name, records)
        return a if mixed is None else F.when(F.size(a) == F.size(b), mixed).otherwise(a)
    if isinstance(kind, (T.BooleanType, *INTEGERS)):
        return F.when(u < SNAP, a).otherwise(b)
    if isinstance(kind, FLOATS):
        return (a + u * (b - a)).cast(kind)
    return a


def _arrays(a, b, element, u, name, records):
    if isinstance(element, (*FLOATS, *INTEGERS)):
        mixed = lerp_array(a, b, u)
        if name in QUATERNION_FIELDS:
            mixed = F.when(F.size(a) == 4, slerp(a, b, u)).otherwise(mixed)
        return mixed.cast(T.ArrayType(element))
    if isinstance(element, T.StructType) and records == "blend":
        return F.zip_with(
            a, b, lambda x, y: blend(x, y, element, u, records=records)
        )
    return None
