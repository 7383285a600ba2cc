"""Ranks within classes of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked(rows: DataFrame, cls: str, order: list[str], weight: str | None = None):
    """Adds ``_rank``: the place of each row in its class ``cls``, gapless from 0.

    A class is cut by a hash of ``order`` into as many lots as Spark has shuffle
    partitions; lots are counted first, then rows are ranked within their lot, so no
    task holds a class. With ``weight`` a row takes that many places. Rows equal in
    ``order`` are interchangeable. No null in ``cls`` is allowed.
    """
    lots = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = F.col(weight) if weight else F.lit(1)
    cut = rows.withColumn("_lot", F.pmod(F.xxhash64(*order), F.lit(lots)))
    before = Window.partitionBy(cls).orderBy("_lot").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        cut.groupBy(cls, "_lot")
        .agg(F.sum(size).alias("_n"))
        .select(cls, "_lot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    within = Window.partitionBy(cls, "_lot").orderBy(*order)
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    place = F.coalesce(F.sum(size).over(earlier), F.lit(0))
    return (
        cut.withColumn("_place", place)
        .join(bases, [cls, "_lot"])
        .withColumn("_rank", (F.col("_base") + F.col("_place")).cast("long"))
        .drop("_lot", "_place", "_base")
    )
