"""Segment and reject manifests (one JSON object per line)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaitmill.schemas import SEGMENT
from gaitmill.sources.captures import CORRUPT


def read_manifest(
    spark: SparkSession, path: str, schema: T.StructType = SEGMENT, *, strict: bool = True
) -> DataFrame:
    """Manifest rows. A bad line fails the read, or, when not ``strict``, stays as
    a row with ``_corrupt_record`` and ``source_file``."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(wide).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path).withColumn("source_file", F.col("_metadata.file_path"))
