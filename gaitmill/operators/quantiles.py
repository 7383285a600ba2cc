"""Exact quantiles with linear interpolation, per group, at any group size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaitmill.operators.shared import group_sizes
from gaitmill.operators.track import Track

MAX_VALUES = 1_000_000

# The percentiles of every duration report.
REPORT_PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 95, 99)


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    name: str = "quantiles",
    *,
    max_values: int = MAX_VALUES,
    largest: int | None = None,
) -> DataFrame:
    """One row per group: the keys and an array aligned with ``probabilities``.

    Groups within ``max_values`` rows use the built-in ``percentile``, which keeps
    a group's values in one buffer. Beyond that the values are counted, ranked by
    a running sum that is cut into chunks, and the ranks looked up. ``largest``
    is a known bound of the group size and saves counting.
    """
    by = list(by)
    present = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"))
    probabilities = [float(p) for p in probabilities]
    if largest is None:
        largest = group_sizes(present, by)[0]
    if largest <= max_values:
        wanted = F.array(*[F.lit(p) for p in probabilities])
        return present.groupBy(*by).agg(F.percentile("_v", wanted).alias(name))
    return _ranked(present, by, probabilities, name, max_values)


def _ranked(
    present: DataFrame,
    by: list[str],
    probabilities: list[float],
    name: str,
    max_values: int,
) -> DataFrame:
    counted = present.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranked = (
        Track.of(counted, by, ["_v"], max_rows=max_values)
        .running(sums={"_upto": F.col("_c")}, totals={"_n": F.col("_c")})
        .df
    )
    targets = F.array(
        *[
            F.struct(F.lit(i).alias("i"), (F.lit(p) * (F.col("_n") - 1)).alias("at"))
            for i, p in enumerate(probabilities)
        ]
    )
    first = F.col("_upto") - F.col("_c")

    def holds(rank):
        return (rank >= first) & (rank < F.col("_upto"))

    hits = ranked.select(
        *by,
        "_v",
        F.explode(
            F.filter(
                F.transform(
                    targets,
                    lambda s: F.struct(
                        s["i"].alias("i"),
                        (s["at"] - F.floor(s["at"])).alias("part"),
                        holds(F.floor(s["at"])).alias("low"),
                        holds(F.ceil(s["at"])).alias("high"),
                    ),
                ),
                lambda s: s["low"] | s["high"],
            )
        ).alias("_hit"),
    )
    low = F.max(F.when(F.col("_hit.low"), F.col("_v")))
    high = F.max(F.when(F.col("_hit.high"), F.col("_v")))
    part = F.max("_hit.part")
    at = hits.groupBy(*by, F.col("_hit.i").alias("_i")).agg(
        F.when(part == 0, low).otherwise(low * (1 - part) + high * part).alias("_q")
    )
    # len(probabilities) rows per group
    ordered = F.sort_array(F.collect_list(F.struct("_i", "_q")))
    return at.groupBy(*by).agg(F.transform(ordered, lambda s: s["_q"]).alias(name))


def median(df: DataFrame, by: Sequence[str], value: str, name: str, **options) -> DataFrame:
    found = exact_quantiles(df, by, value, [0.5], "_q", **options)
    return found.select(*by, F.col("_q")[0].alias(name))
