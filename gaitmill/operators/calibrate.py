"""Calibration: rigid fit per frame, best-frame search, per-bone differences."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaitmill.functions import rotation as rot
from gaitmill.functions.rotation import Quat
from gaitmill.operators.shared import salted_join

MIN_ANCHORS = 3
TRUSTED_DEGREES, DOUBTFUL_DEGREES = 2.0, 10.0
AXES = "xyz"


def shared_anchors(points: DataFrame, reference: DataFrame, bone: str = "bone") -> DataFrame:
    """Reference anchors that the points have too; fewer than three is an error.

    The reference is one skeleton in one pose; Spark broadcasts it where its size
    allows that.
    """
    known = points.select(bone).distinct()
    shared = reference.join(known, bone, "left_semi")
    n = shared.count()
    if n < MIN_ANCHORS:
        raise ValueError(f"need {MIN_ANCHORS} shared anchor bones, found {n}")
    return shared


def pair_moments(
    points: DataFrame,
    reference: DataFrame,
    keys: Sequence[str],
    bone: str = "bone",
) -> DataFrame:
    """Sums that determine the rigid fit of each frame: count, both centroids, the
    3x3 cross sums and both squared lengths. Partial sums combine map-side."""
    anchors = reference.select(bone, *[F.col(a).alias(f"d{a}") for a in AXES])
    both = points.join(anchors, bone)
    src = [F.col(a) for a in AXES]
    dst = [F.col(f"d{a}") for a in AXES]
    return both.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(c) for c in src]).alias("src_mean"),
        F.array(*[F.avg(c) for c in dst]).alias("dst_mean"),
        F.array(*[F.sum(s * d) for s in src for d in dst]).alias("cross"),
        F.sum(rot.dot(src, src)).alias("src_square"),
        F.sum(rot.dot(dst, dst)).alias("dst_square"),
    )


FIT = T.StructType(
    [
        T.StructField("rotation", T.ArrayType(T.DoubleType())),
        T.StructField("translation", T.ArrayType(T.DoubleType())),
        T.StructField("rms", T.DoubleType()),
        T.StructField("angle_deg", T.DoubleType()),
    ]
)


@F.pandas_udf(FIT)
def fit_rigid(
    n: pd.Series,
    src_mean: pd.Series,
    dst_mean: pd.Series,
    cross: pd.Series,
    src_square: pd.Series,
    dst_square: pd.Series,
) -> pd.DataFrame:
    """Batched 3x3 SVD: proper rotation and translation with the least RMS."""
    count = n.to_numpy(dtype=float)
    a = np.stack(src_mean.to_numpy()).astype(float)
    b = np.stack(dst_mean.to_numpy()).astype(float)
    h = np.stack(cross.to_numpy()).astype(float).reshape(-1, 3, 3)
    h = h - count[:, None, None] * a[:, :, None] * b[:, None, :]
    u, s, vt = np.linalg.svd(h)
    v, ut = np.swapaxes(vt, 1, 2), np.swapaxes(u, 1, 2)
    sign = np.where(np.linalg.det(v @ ut) < 0, -1.0, 1.0)
    v[:, :, 2] *= sign[:, None]
    r = v @ ut
    shift = b - np.einsum("nij,nj->ni", r, a)
    spread_a = src_square.to_numpy() - count * (a * a).sum(1)
    spread_b = dst_square.to_numpy() - count * (b * b).sum(1)
    gain = s[:, 0] + s[:, 1] + sign * s[:, 2]
    rms = np.sqrt(np.maximum(spread_a + spread_b - 2.0 * gain, 0.0) / count)
    cosine = np.clip((np.trace(r, axis1=1, axis2=2) - 1.0) / 2.0, -1.0, 1.0)
    return pd.DataFrame(
        {
            "rotation": list(r.reshape(-1, 9)),
            "translation": list(shift),
            "rms": rms,
            "angle_deg": np.degrees(np.arccos(cosine)),
        }
    )


def fit_frames(
    points: DataFrame, reference: DataFrame, keys: Sequence[str], bone: str = "bone"
) -> DataFrame:
    """Rotation (row-major), translation, RMS and rotation angle per frame."""
    moments = pair_moments(points, shared_anchors(points, reference, bone), keys, bone)
    fit = fit_rigid("n", "src_mean", "dst_mean", "cross", "src_square", "dst_square")
    return moments.withColumn("_fit", fit).select(*keys, "n", "_fit.*")


def best_frames(
    points: DataFrame,
    reference: DataFrame,
    frame: str,
    *,
    bone: str = "bone",
    stride: int = 1,
    max_frames: int | None = None,
    top_k: int = 5,
) -> DataFrame:
    """The ``top_k`` candidate frames with the least RMS, ties by frame."""
    candidates = points.where(F.col(frame) % max(1, stride) == 0)
    if max_frames is not None:
        candidates = candidates.where(F.col(frame) < max_frames)
    fits = fit_frames(candidates, reference, [frame], bone)
    return fits.orderBy("rms", frame).limit(top_k)


def quaternion(prefix: str) -> Quat:
    return Quat(*[F.col(f"{prefix}{c}") for c in "wxyz"])


def bone_deltas(
    captured: DataFrame, reference: DataFrame, keys: Sequence[str] = (), bone: str = "bone"
) -> DataFrame:
    """Constant rotation per bone from the captured to the reference pose, with
    its angle. Both sides hold ``qw, qx, qy, qz``."""
    other = reference.select(bone, *[F.col(f"q{c}").alias(f"r{c}") for c in "wxyz"])
    both = captured.join(other, bone)
    d = rot.multiply(rot.conjugate(rot.unit(quaternion("q"))), rot.unit(quaternion("r")))
    out = both.select(*keys, bone, *[c.alias(f"d{n}") for n, c in zip("wxyz", d)])
    return out.withColumn("angle_deg", rot.angle_degrees(quaternion("d")))


def spread_verdict(degrees: Column) -> Column:
    return (
        F.when(degrees < TRUSTED_DEGREES, "OK")
        .when(degrees < DOUBTFUL_DEGREES, "WARN")
        .otherwise("BAD")
    )


def delta_spread(deltas: DataFrame, frame: str, bone: str = "bone") -> DataFrame:
    """Largest angle between a bone's difference in its first sampled frame and in
    the others; bones with a single frame are left out.

    The first difference is a grouped minimum, one row per bone of the skeleton,
    and comes back by a salted join: there are few bones and many frames.
    """
    parts = [F.col(f"d{c}") for c in "wxyz"]
    firsts = deltas.groupBy(bone).agg(
        F.min_by(F.struct(*parts), frame).alias("_first"), F.count(F.lit(1)).alias("frames")
    )
    n = firsts.where("frames > 1").select(bone, "_first", "frames")
    both = salted_join(deltas, n, [bone], frame)
    first = Quat(*[F.col("_first")[f"d{c}"] for c in "wxyz"])
    between = rot.multiply(rot.conjugate(first), quaternion("d"))
    spread = both.groupBy(bone).agg(
        F.max(rot.angle_degrees(between)).alias("spread_deg"), F.max("frames").alias("frames")
    )
    return spread.withColumn("verdict", spread_verdict(F.col("spread_deg")))
