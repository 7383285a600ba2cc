"""Tables, manifests and statistics as files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaitmill.operators.shared import must_be_empty

# Sort orders of the manifests.
MANIFEST_ORDER = ("category", "source_clean_jsonl", "i0")


def write_frames(
    frames: DataFrame,
    path: str,
    *,
    key: str = "seg_id",
    position: str = "frame_idx",
    page_rows: int = 100_000,
    mode: str = "errorifexists",
) -> None:
    """Frame-level table (segments, commands, skeleton, poses): one directory per
    category, files clustered by segment and page."""
    page = F.floor(F.col(position) / page_rows)
    (
        frames.repartition("category", key, page)
        .sortWithinPartitions("category", key, position)
        .write.partitionBy("category")
        .mode(mode)
        .parquet(path)
    )


def write_json_rows(rows: DataFrame, path: str, order: Sequence[str] = MANIFEST_ORDER) -> None:
    """Manifest as JSON lines, sorted, with sorted keys. The sort is a range
    partitioning: many files, in order."""
    known = [c for c in order if c in rows.columns]
    rows.select(*sorted(rows.columns)).orderBy(*known).write.mode("overwrite").json(path)


def write_stats(stats: DataFrame, path: str) -> None:
    """A handful of statistics rows as one JSON file."""
    stats.coalesce(1).write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Terrain and other tables."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def copy_accepted(
    frames: DataFrame,
    accepted: DataFrame,
    path: str,
    *,
    key: str = "seg_id",
    position: str = "frame_idx",
) -> None:
    """Copy the frames of accepted motions to a dataset that only ever grows.

    Motions already there are reused when they have the expected number of
    frames; another number is an error.
    """
    spark = frames.sparkSession
    kept = frames.join(accepted.select(key), key, "left_semi")
    try:
        there = spark.read.parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        write_frames(kept, path, key=key, position=position)
        return
    sizes = there.groupBy(key).agg(F.count(F.lit(1)).alias("rows_there"))
    both = accepted.select(key, "n_frames").join(sizes, key)
    differing = both.where(F.col("rows_there") != F.col("n_frames"))
    must_be_empty(differing, "existing motions differ", [key, "n_frames", "rows_there"])
    fresh = kept.join(sizes, key, "left_anti")
    write_frames(fresh, path, key=key, position=position, mode="append")
