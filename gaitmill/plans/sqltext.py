"""Pieces of SQL for the geometry queries."""

from __future__ import annotations

from collections.abc import Sequence


def lit(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def rotated(q: Sequence[str], v: Sequence[str]) -> tuple[str, str, str]:
    """Rotation of v by a unit quaternion (w, x, y, z), through its matrix."""
    w, x, y, z = q
    a, b, c = v
    return (
        f"((1-2*({y}*{y}+{z}*{z}))*{a} + 2*({x}*{y}-{w}*{z})*{b} + 2*({x}*{z}+{w}*{y})*{c})",
        f"(2*({x}*{y}+{w}*{z})*{a} + (1-2*({x}*{x}+{z}*{z}))*{b} + 2*({y}*{z}-{w}*{x})*{c})",
        f"(2*({x}*{z}-{w}*{y})*{a} + 2*({y}*{z}+{w}*{x})*{b} + (1-2*({x}*{x}+{y}*{y}))*{c})",
    )


def product(a: Sequence[str], b: Sequence[str]) -> tuple[str, str, str, str]:
    """Quaternion product (w, x, y, z)."""
    aw, ax, ay, az = a
    bw, bx, by, bz = b
    return (
        f"({aw}*{bw} - {ax}*{bx} - {ay}*{by} - {az}*{bz})",
        f"({aw}*{bx} + {ax}*{bw} + {ay}*{bz} - {az}*{by})",
        f"({aw}*{by} - {ax}*{bz} + {ay}*{bw} + {az}*{bx})",
        f"({aw}*{bz} + {ax}*{by} - {ay}*{bx} + {az}*{bw})",
    )


def linear(matrix: Sequence[Sequence[float]], v: Sequence[str]) -> tuple[str, ...]:
    return tuple("(" + " + ".join(f"{lit(m)}*{c}" for m, c in zip(row, v)) + ")" for row in matrix)
