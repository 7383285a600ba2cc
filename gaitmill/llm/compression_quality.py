"""Quality of whole texts by compression: two zstandard dictionaries, one difference.

One dictionary is built from pieces of good training texts, one from pieces of bad ones. A
text is compressed under both, block by block, so that a dictionary tells as much at the
end of a long text as at its start. The difference of the two sizes, per byte of text, is
the only feature; a logistic curve fitted on rows that built no dictionary turns it into a
score.

Dictionaries and curve are fitted on at most about ``SAMPLE`` labelled rows and ``PIECES``
pieces a class, chosen by hash; every row of the table is scored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaitmill.llm import bpe
from gaitmill.operators.shared import settle

#: Labelled rows to fit on; a hash threshold makes it so many in the mean.
SAMPLE = 12_000
#: Most pieces of each class that build its dictionary, and their bytes.
PIECES, PIECE = 4_000, 2_048
#: Part of the sample, in fifths, that fits the curve instead of building dictionaries.
CALIBRATION_FIFTHS = 2
DICTIONARY = 65_536
LEVEL = 3
#: Bytes that are compressed at once.
BLOCK = 4_096


def build_dictionary(pieces: list[bytes]) -> bytes:
    """A dictionary trained on ``pieces``; too few of them are one as they stand."""
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY:]


@functools.lru_cache(maxsize=8)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    prepared = zstandard.ZstdCompressionDict(dictionary)
    prepared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        dict_data=prepared, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False
    )


def size_difference(text: str, good: bytes, bad: bytes) -> float:
    """Bytes that ``bad`` needs more than ``good``, per byte of ``text``; 0 if empty."""
    raw = text.encode("utf-8", "surrogatepass")
    under_good, under_bad = _compressor(good), _compressor(bad)
    more = 0
    for lo in range(0, len(raw), BLOCK):
        block = raw[lo : lo + BLOCK]
        more += len(under_bad.compress(block)) - len(under_good.compress(block))
    return more / max(1, len(raw))


def difference_column(text: Column, good: bytes, bad: bytes) -> Column:
    @F.arrow_udf("double")
    def measured(texts: pa.Array) -> pa.Array:
        return pa.array([size_difference(t, good, bad) for t in bpe.texts(texts)], pa.float64())

    return measured(text)


@dataclass(frozen=True)
class Model:
    """Score 1 / (1 + exp(-(``slope`` * difference + ``intercept``))). Without two classes
    in the training rows the dictionaries are None and ``share``, the smoothed share of
    good rows, is the score of every text."""

    good: bytes | None
    bad: bytes | None
    slope: float
    intercept: float
    share: float

    def score(self, text: Column) -> Column:
        """Score of each text from 0 to 1; null texts count as empty."""
        if self.good is None:
            return F.lit(self.share)
        difference = difference_column(text, self.good, self.bad)
        return 1 / (1 + F.exp(-(self.slope * difference + self.intercept)))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for good, text in zip(batch.column(0).to_pylist(), bpe.texts(batch.column(1))):
            raw = text.encode("utf-8", "surrogatepass")
            pieces = [raw[lo : lo + PIECE] for lo in range(0, len(raw), PIECE)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([good] * len(pieces), pa.int32()), pa.array(pieces, pa.binary())],
                ["good", "piece"],
            )


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``good`` and ``text`` of at most about ``sample`` labelled documents.

    Of conflicting labels of a document the bad one counts, of several texts the
    smallest; null labels and documents without a number do not. The labels that are
    looked up are bounded by the sample, so they are broadcast and texts stay in place.
    """
    known = (
        labels.where("quality is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min(F.when(F.col("quality") > 0, 1).otherwise(0)).alias("good"))
    )
    part = min(1.0, sample / max(1, known.count()))
    hashed = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1 << 20))
    picked = known.where(hashed < int(part * (1 << 20)) + 1)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(picked), "doc_id")
    return found.groupBy("doc_id", "good").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on rows of ``labels`` (``doc_id``, ``quality``) that have a text in ``docs``."""
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(5))
    rows = settle(labelled_sample(docs, labels, sample).withColumn("fold", fold))
    n, good = rows.agg(F.count("*"), F.coalesce(F.sum("good"), F.lit(0))).first()
    share = (good + 1) / (n + 2)
    if good in (0, n):
        return Model(None, None, 0.0, 0.0, share)
    building = rows.where(F.col("fold") >= CALIBRATION_FIFTHS)
    rest = rows.where(F.col("fold") < CALIBRATION_FIFTHS)
    if min(part.select("good").distinct().count() for part in (building, rest)) < 2:
        building = rest = rows  # too few rows for two parts
    pieces = building.select("good", "text").mapInArrow(_cut, "good int, piece binary")
    chosen = [
        pieces.where(F.col("good") == kind).select("piece").distinct()
        .orderBy(F.xxhash64("piece"), "piece").limit(PIECES).toArrow()
        for kind in (1, 0)
    ]
    dictionaries = [build_dictionary(c.column(0).to_pylist()) for c in chosen]
    if not all(dictionaries):  # a class of empty texts only
        return Model(None, None, 0.0, 0.0, share)
    measured = rest.select(
        F.col("good").cast("double").alias("label"),
        array_to_vector(F.array(difference_column(F.col("text"), *dictionaries))).alias("features"),
    )
    curve = LogisticRegression(regParam=1e-4, maxIter=50).fit(settle(measured).coalesce(4))
    return Model(*dictionaries, float(curve.coefficients[0]), float(curve.intercept), share)


def held_out(key: Column) -> Column:
    """Whether labels of the row must not be learned from: crc32 of the number, mod 3."""
    return F.crc32(key.cast("string").cast("binary")) % 3 == 1


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row.

    Null and empty texts get the score of a difference of 0; repeated rows stay; a row
    without number is not held out; an empty table gives an empty table, and without
    labels every score is one half. Other columns are ignored whatever their names.
    """
    known = labels.select("doc_id", "quality").where(~held_out(F.col("doc_id")))
    model = fit(docs, known)
    return docs.select("doc_id", model.score(F.col("text")).alias("score")).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
