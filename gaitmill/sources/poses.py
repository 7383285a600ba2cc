"""Solved robot poses from ``.npy`` files."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_BATCH = 8192
POSE_ROWS = "seg_id string, category string, frame_idx long, q array<double>, problem string"


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A file becomes one row per frame; an unreadable file one row that says so."""
    for files in batches:
        for seg_id, category, content in files.itertuples(index=False):
            try:
                poses = np.load(io.BytesIO(content), allow_pickle=False)
                poses = np.atleast_2d(poses).astype(float)
            except Exception as error:
                yield pd.DataFrame(
                    {"seg_id": [seg_id], "category": [category], "frame_idx": [None],
                     "q": [None], "problem": [f"{type(error).__name__}: {error}"]}
                )
                continue
            for at in range(0, len(poses), ROWS_PER_BATCH):
                part = poses[at : at + ROWS_PER_BATCH]
                yield pd.DataFrame(
                    {"seg_id": seg_id, "category": category,
                     "frame_idx": np.arange(at, at + len(part)),
                     "q": list(part), "problem": None}
                )


def read_poses(spark: SparkSession, root: str) -> DataFrame:
    """Pose table of ``<root>/<category>/<segment>_frames.npy``."""
    files = spark.read.format("binaryFile").load(f"{root}/*/*_frames.npy")
    pattern = r"([^/]+)/([^/]+)_frames\.npy$"
    named = files.select(
        F.regexp_extract("path", pattern, 2).alias("seg_id"),
        F.regexp_extract("path", pattern, 1).alias("category"),
        "content",
    )
    return named.mapInPandas(_decode, POSE_ROWS)
