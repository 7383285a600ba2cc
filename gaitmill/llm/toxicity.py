"""Toxicity of whole texts: boosted trees over dense features, isotonic calibration.

A lexicon is learned first: words and word beginnings that stand in toxic training texts
far more often than in others. Features are densities of its hits (plain, as beginnings,
behind obfuscation), how near they are to second-person words, and rates of capitals,
punctuation, digits and signs inside words and stretched letters.

Lexicon, trees and calibration are fitted on at most about ``SAMPLE`` labelled rows,
chosen by hash; every row of the table is scored.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaitmill.llm import bpe
from gaitmill.operators.shared import settle

#: Labelled rows to fit on; a hash threshold makes it so many in the mean.
SAMPLE = 12_000
#: Part of the sample, in fifths, that calibrates instead of growing trees.
CALIBRATION_FIFTHS = 1
#: Most terms of the lexicon, fewest toxic texts with a term, least share of toxic texts.
LEXICON, SUPPORT, PRECISION = 400, 6, 0.75
PREFIXES = (4, 5, 6)
NEAR = 3
STORE = 200_000

# Second-person words of English, German, French and Spanish.
YOU = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer sie ihnen tu te toi ton ta"
    " tes vous votre vos usted ustedes tú ti tuyo vosotros os".split()
)
PLAIN = str.maketrans("013457@$!*", "oieastasi ")
FEATURES = (
    "lexicon_per_100", "lexicon_hits", "prefix_per_100", "prefix_hits", "hidden_per_100",
    "hidden_hits", "near_you_share", "near_you_hits", "you_per_100", "capitals", "exclaiming",
    "asking", "punctuation", "digits", "signs_in_words", "stretched", "log_words",
)

_SPLIT = str.maketrans({c: " " for c in ".,;:!?\"()[]{}<>|/\\*#&%$@~^=+_«»„“”…—–\n\t\r"})
_MASKED = re.compile(r"(?<!\S)(?=\S*[^\W\d_])(?=\S*[\d@$*])[\w@$*!]+")


@dataclass(frozen=True)
class Lexicon:
    words: frozenset[str]
    prefixes: frozenset[str]

    def kind(self, word: str) -> int:
        """1 for a word, 2 for a beginning, 3 for a second-person word, else 0."""
        if word in self.words:
            return 1
        if any(word[:n] in self.prefixes for n in PREFIXES if len(word) >= n):
            return 2
        return 3 if word in YOU else 0


class _Kinds(dict):
    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        if len(self) >= STORE:
            self.clear()
        self[word] = kind = self.lexicon.kind(word)
        return kind


@functools.lru_cache(maxsize=4)
def _kinds(lexicon: Lexicon) -> _Kinds:
    return _Kinds(lexicon)


def dense_features(text: str, kinds: _Kinds) -> list[float]:
    """The values of ``FEATURES``; all 0 for a text without characters."""
    low = text.lower()
    words = low.translate(_SPLIT).split()
    n = max(1, len(words))
    found = np.fromiter(map(kinds.__getitem__, words), np.int8, len(words))
    toxic = np.flatnonzero((found == 1) | (found == 2))
    you = np.flatnonzero(found == 3)
    near = 0
    if len(toxic) and len(you):
        at = np.searchsorted(you, toxic)
        left = np.abs(toxic - you[np.maximum(at - 1, 0)])
        right = np.abs(you[np.minimum(at, len(you) - 1)] - toxic)
        near = int((np.minimum(left, right) <= NEAR).sum())
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    count = np.bincount(raw, minlength=256)
    size = max(1, len(raw))
    masked = hidden = 0
    if count[48:58].sum() + count[36] + count[42] + count[64]:
        for m in _MASKED.finditer(low):
            masked += 1
            hidden += kinds.lexicon.kind(m[0].translate(PLAIN).replace(" ", "")) in (1, 2)
    same = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & (raw[2:] > 64)
    plain, begun = int((found == 1).sum()), int((found == 2).sum())
    return [
        100 * plain / n,
        float(plain),
        100 * begun / n,
        float(begun),
        100 * hidden / n,
        float(hidden),
        near / max(1, len(toxic)),
        float(near),
        100 * len(you) / n,
        count[65:91].sum() / size,
        count[33] / size,
        count[63] / size,
        (count[33:48].sum() + count[58:65].sum()) / size,
        count[48:58].sum() / size,
        100 * masked / n,
        same.sum() / size,
        float(np.log1p(len(words))),
    ]


def feature_column(text: Column, lexicon: Lexicon) -> Column:
    @F.arrow_udf("array<double>")
    def measured(texts: pa.Array) -> pa.Array:
        kinds = _kinds(lexicon)
        return pa.array(
            [dense_features(t, kinds) for t in bpe.texts(texts)], pa.list_(pa.float64())
        )

    return measured(text)


def learn_lexicon(labelled: DataFrame) -> Lexicon:
    """Terms of ``labelled`` (``text``, ``toxic``) that mark toxic texts.

    A term counts once a text. Beginnings are taken where they mark toxic texts and the
    word alone does not say it all.
    """
    words = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"))
    kinds = [F.transform("w", lambda w: F.concat(F.lit("="), w))]
    for n in PREFIXES:
        longer = F.filter("w", lambda w, n=n: F.length(w) >= n)
        kinds.append(F.array_distinct(F.transform(longer, lambda w, n=n: F.substring(w, 1, n))))
    counted = (
        labelled.select("toxic", words.alias("w"))
        .select("toxic", F.explode(F.concat(*kinds)).alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").alias("bad"), F.count("*").alias("all"))
        .where((F.col("bad") >= SUPPORT) & (F.col("bad") >= PRECISION * (F.col("all") + 1)))
    )
    top = counted.orderBy(F.desc("bad"), "term").limit(LEXICON).collect()
    terms = {r["term"] for r in top}
    return Lexicon(
        frozenset(t[1:] for t in terms if t[0] == "=" and len(t) > 1),
        frozenset(t for t in terms if t[0] != "="),
    )


@dataclass(frozen=True)
class Model:
    """``trees`` and ``calibration`` are None where one class or no row was labelled; the
    share of toxic rows, smoothed, is then the score of every text."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float

    def score(self, docs: DataFrame, text: str = "text", into: str = "score") -> DataFrame:
        """``docs`` with a score from 0 to 1 for each row. Null texts count as empty."""
        if self.trees is None:
            return docs.select("*", F.lit(self.share).alias(into))
        names = docs.columns
        rows = docs.toDF(*[f"c{i}" for i in range(len(names))])  # no name can clash
        features = feature_column(F.col(f"c{names.index(text)}"), self.lexicon)
        measured = rows.withColumn("_features", array_to_vector(features))
        calibrated = self.calibration.transform(_boosted(self.trees, measured))
        score = F.least(F.greatest(F.col("_calibrated"), F.lit(0.0)), F.lit(1.0))
        return calibrated.select(*rows.columns, score).toDF(*names, into)


def _boosted(trees: GBTClassificationModel, measured: DataFrame) -> DataFrame:
    return trees.transform(measured).withColumn(
        "_margin", F.element_at(vector_to_array("_probability"), 2)
    )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on rows of ``labels`` (``doc_id``, ``toxic``) that have a text in ``docs``.

    Of conflicting labels of a document the toxic one counts; null labels and documents
    without a number do not. The labels that are looked up are bounded by the sample, so
    they are broadcast and texts are not moved.
    """
    known = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    )
    total = known.count()
    part = min(1.0, sample / max(1, total))
    hashed = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20))
    picked = known.where(hashed < int(part * (1 << 20)) + 1)
    texts = docs.select("doc_id", F.col("text").alias("text"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(5))
    labelled = settle(texts.join(F.broadcast(picked), "doc_id").withColumn("fold", fold))
    n, bad = labelled.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = (bad + 1) / (n + 2)
    if bad in (0, n):
        return Model(Lexicon(frozenset(), frozenset()), None, None, share)
    growing = labelled.where(F.col("fold") >= CALIBRATION_FIFTHS)
    lexicon = learn_lexicon(growing)
    measured = settle(
        labelled.select("toxic", "fold", feature_column(F.col("text"), lexicon).alias("f"))
    ).select(F.col("toxic").cast("double").alias("_label"), "fold", array_to_vector("f").alias("_features"))
    grow = measured.where(F.col("fold") >= CALIBRATION_FIFTHS).coalesce(4)
    rest = measured.where(F.col("fold") < CALIBRATION_FIFTHS)
    if grow.select("_label").distinct().count() < 2 or rest.limit(1).count() == 0:
        grow = rest = measured.coalesce(4)  # too few rows for two parts
    booster = GBTClassifier(
        featuresCol="_features", labelCol="_label", predictionCol="_predicted",
        maxIter=15, maxDepth=3, stepSize=0.3, maxBins=32, seed=7,
    )
    trees = booster.setRawPredictionCol("_raw").setProbabilityCol("_probability").fit(grow)
    calibration = IsotonicRegression(
        featuresCol="_margin", labelCol="_label", predictionCol="_calibrated"
    ).fit(_boosted(trees, rest))
    return Model(lexicon, trees, calibration, share)


def held_out(key: Column) -> Column:
    """Whether labels of the row must not be learned from: crc32 of the number, mod 5."""
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", "toxic").where(~held_out(F.col("doc_id")))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row.

    Null and empty texts get the score of a text without words; repeated rows stay; a
    row without number is not held out; an empty table gives an empty table.
    """
    model = fit(docs, training_labels(labels))
    return model.score(docs.select("doc_id", "text")).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with the rows that score below 0.5, all columns as they were."""
    model = fit(docs, training_labels(labels))
    names = docs.columns
    scored = model.score(docs).toDF(*[f"c{i}" for i in range(len(names))], "score")
    return scored.where("score < 0.5").drop("score").toDF(*names)
