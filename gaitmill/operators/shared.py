"""Small building blocks shared by the operators."""

from __future__ import annotations

import atexit
import functools
import operator
import shutil
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dir: dict[str, str] = {}
#: Paths that ``settle`` wrote inside each running ``tidy`` call.
_written: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, _own_dir[app], ignore_errors=True)
    return _own_dir[app]


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, and fixes values that depend on the physical layout.
    """
    path = f"{shared_folder(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _written:
        _written[-1].append(path)
    return df.sparkSession.read.parquet(path)


def tidy(stage: Callable) -> Callable:
    """A stage that writes all its output before it returns: the tables that it
    settled on the way are deleted when it ends, also after an error."""

    @functools.wraps(stage)
    def run(spark: SparkSession, *args, **kwargs):
        _written.append([])
        try:
            return stage(spark, *args, **kwargs)
        finally:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path
            for written in _written.pop():
                path = hadoop(written)
                files = path.getFileSystem(spark._jsc.hadoopConfiguration())
                files.delete(path, True)

    return run


def same_key_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join on ``keys`` where a null key equals a null key."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = functools.reduce(
        operator.and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    )
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def salted_join(
    rows: DataFrame,
    per_group: DataFrame,
    keys: Sequence[str],
    spread_by: str,
    *,
    how: str = "inner",
    salts: int | None = None,
) -> DataFrame:
    """Join many rows with one record per group where a group may be huge.

    The record is repeated ``salts`` times (unless given, the number of shuffle
    partitions, which follows the size of the data) and the rows pick one by the hash of
    ``spread_by``, so a group spreads over as many tasks, and the result is not
    partitioned by the group alone, which a later window could settle for. Spark
    still broadcasts the records when they are small.
    """
    if salts is None:
        salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    records = per_group.withColumn("_salt", every)
    salted = rows.withColumn("_salt", F.pmod(F.hash(spread_by), F.lit(salts)))
    return same_key_join(salted, records, [*keys, "_salt"], how).drop("_salt")


def group_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """(rows in the largest group, rows in total); one narrow aggregation."""
    row = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.max("_n").alias("largest"), F.sum("_n").alias("total"))
        .first()
    )
    return int(row["largest"] or 0), int(row["total"] or 0)


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, and 0 where the whole is 0 or missing."""
    return F.coalesce(F.try_divide(100.0 * part, whole), F.lit(0.0))


def must_be_empty(df: DataFrame, problem: str, show: Sequence[str]) -> None:
    """Raise when a validation query finds rows; shows the first five."""
    found = df.select(*show).orderBy(*show).limit(5).collect()
    if found:
        raise ValueError(f"{problem}: {[tuple(r) for r in found]}")
