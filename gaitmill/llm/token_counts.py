"""Token counts with a digest cache.

Texts are normalised (null: empty; a tokenizer that folds its input can be given the
same folding, so that more texts share a count), digested, and joined with stored
counts under the tokenizer-version digest. Only one text per distinct missing digest is
encoded; the new counts are appended to the cache.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from gaitmill.llm import bpe
from gaitmill.operators.shared import shared_folder

CACHE_SCHEMA = "version string, digest binary, n_tokens long"


@functools.cache
def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file: another file never meets old counts."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()[:32]


def null_as_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def new_cache(spark) -> str:
    """Path of an empty cache in the shared folder."""
    return f"{shared_folder(spark)}/token-counts-{uuid.uuid4().hex}"


def read_cache(spark, path: str) -> DataFrame:
    """The stored counts; empty where nothing was stored yet."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    cache: str,
    *,
    ranks: str | None = None,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    normalise: Callable[[Column], Column] = null_as_empty,
) -> DataFrame:
    """``keep`` columns, ``n_bytes`` (UTF-8 of the text) and ``n_tokens`` of every row.

    ``cache`` is a Parquet folder all executors share. ``ranks`` names the same
    vocabulary as tiktoken ranks (faster, same counts). ``normalise`` must not change
    what the tokenizer counts. Null texts count as empty; an empty text has 0 bytes
    and, for byte-level files, 0 tokens; repeated rows stay; an empty table gives an
    empty table. Other columns of ``docs`` are ignored whatever their names.

    The texts move once, to a join that leaves one of each missing digest. Copies go
    to the same task by their digest only as 16-byte digests, pre-aggregated.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    source = docs.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
        normalise(F.col(text)).alias("_text"),
        F.octet_length(null_as_empty(F.col(text))).cast("long").alias("_bytes"),
    )
    digest = F.unhex(F.md5(F.encode("_text", "UTF-8")))
    digested = source.withColumn("_digest", digest)
    known = read_cache(spark, cache).where(F.col("version") == version)
    stored = known.groupBy(F.col("digest").alias("_digest")).agg(
        F.min("n_tokens").alias("n_tokens")
    )
    # The marker of a text is a hash of its whole row, so copies spread over tasks.
    marked = digested.withColumn("_mark", F.xxhash64(*[f"_k{i}" for i in range(len(keep))]))
    misses = (
        marked.join(stored, "_digest", "left_anti")
        .groupBy("_digest")
        .agg(F.min("_mark").alias("_mark"))
    )
    first = marked.select("_digest", "_mark", "_text").join(
        misses, ["_mark", "_digest"], "left_semi"
    )
    counted = first.select("_digest", "_text").mapInArrow(
        functools.partial(_encode, tokenizer, ranks), "digest binary, n_tokens long"
    )
    counted.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")).select(
        F.lit(version).alias("version"), "digest", "n_tokens"
    ).write.mode("append").parquet(cache)
    counts = (
        read_cache(spark, cache)
        .where(F.col("version") == version)
        .groupBy(F.col("digest").alias("_digest"))
        .agg(F.min("n_tokens").alias("n_tokens"))
    )
    return digested.drop("_text").join(counts, "_digest").select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        F.col("_bytes").alias("n_bytes"),
        "n_tokens",
    )


def _encode(
    tokenizer: str, ranks: str | None, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    count = bpe.counter(tokenizer, ranks)
    for batch in batches:
        counts = [count(t) for t in bpe.texts(batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"]
        )
