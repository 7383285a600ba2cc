"""Dataset versions: swap recordings for their cleaned segments, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_cleaning(
    raw: DataFrame, manifest: DataFrame, cleaned: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Changed recordings leave, their segments enter, the rest stays."""
    changed = manifest.where("changed").select(*keys)
    untouched = raw.join(changed, list(keys), "left_anti")
    return untouched.unionByName(cleaned, allowMissingColumns=True)


def swap_manifest(
    manifest: DataFrame, segments: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """(recording, action, item) rows: what was removed and what was placed.

    Long form, so that a recording with very many segments needs no array.
    """
    changed = manifest.where("changed").select(*keys)
    placed = segments.join(changed, list(keys), "left_semi")
    name = F.col(keys[-1]).cast("string")
    return changed.select(*keys, F.lit("removed").alias("action"), name.alias("item")).unionByName(
        placed.select(*keys, F.lit("placed").alias("action"), F.col("seg_id").alias("item"))
    )


def roll_back(
    current: DataFrame,
    backup: DataFrame,
    swaps: DataFrame,
    keys: Sequence[str],
    item: str,
) -> DataFrame:
    """Drop the placed segments, restore the removed recordings from the backup."""
    placed = swaps.where(F.col("action") == "placed").select(F.col("item").alias(item))
    removed = swaps.where(F.col("action") == "removed").select(*keys)
    kept = current.join(placed, item, "left_anti").select(*current.columns)
    return kept.unionByName(
        backup.join(removed, list(keys), "left_semi"), allowMissingColumns=True
    )
