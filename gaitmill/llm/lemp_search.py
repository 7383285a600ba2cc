"""Ranked search of documents by LEMP: impact vectors ordered by length, buckets, bounds.

A document is the vector of its terms' impacts, an item the set of its terms, and a score
their inner product in integers. Vectors are ordered by length and cut into buckets of
similar ones. For an item whose tenth best score so far is known, Cauchy-Schwarz passes
over whole buckets and over the shorter end of a bucket; inside, the item's largest
coordinates are added up and what the others can add at most decides which documents are
scored at all. Survivors are scored exactly.

The longest vectors are searched first; the scores that they leave are where the search of
all others starts, in parallel.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaitmill.llm import bpe
from gaitmill.operators.shared import settle

BEST = 10
#: Bytes of item texts that are searched for at once; more items go block by block, each
#: fetched, searched, written and released before the next.
BLOCK_BYTES = 4 << 20
#: Vectors and coordinates of a bucket: what one task holds at a time.
BUCKET, COORDINATES = 2_048, 1 << 20
#: Longest vectors, about so many, that are searched first.
FIRST = 16_384
#: Relative room for rounding in bounds, which are doubles; scores are integers.
ROOM = 1e-9

VECTOR = "doc_id {key}, lot int, n long, ids array<int>, tfs array<int>"
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


def terms(text: str) -> list[bytes]:
    """Runs of letters and digits of ASCII and of all other characters, in order, as
    UTF-8; only A to Z are lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


@dataclass
class Items:
    """One block of items: their terms as numbers, known to every task."""

    number: dict[bytes, int] = field(default_factory=dict)
    keys: list = field(default_factory=list)
    terms: list[np.ndarray] = field(default_factory=list)

    def add(self, key, text: str) -> None:
        ids = {self.number.setdefault(t, len(self.number)) for t in terms(text)}
        self.keys.append(key)
        self.terms.append(np.array(sorted(ids), np.int64))


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[Items]:
    """The items in blocks of about ``BLOCK_BYTES``, dealt by hash, one at a time."""
    rows = items.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = math.ceil(size / BLOCK_BYTES)
    for b in range(blocks):
        block = Items()
        for r in rows.where(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)) == b).collect():
            block.add(r["key"], r["text"])
        yield block


def vectors(docs: DataFrame, key: str, text: str, number) -> DataFrame:
    """Term counts of the documents that have a term: ``n`` for all terms, ``ids`` and
    ``tfs`` for those of the items (``number``, a broadcast). ``lot`` counts the rows of
    a task, so that equal vectors can be told apart where they are dealt out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lot = number.value, 0
        for batch in batches:
            rows, lots, sizes, ids, tfs, ends = [], [], [], [], [], [0]
            for i, t in enumerate(bpe.texts(batch.column(1))):
                found = terms(t)
                if found:
                    counted = Counter(filter(known.__contains__, found))
                    ids.extend(map(known.__getitem__, counted))
                    tfs.extend(counted.values())
                    rows.append(i)
                    lots.append(lot)
                    sizes.append(len(found))
                    ends.append(len(ids))
                    lot += 1
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (ids, tfs)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int32())),
                    pa.array(lots, pa.int32()),
                    pa.array(sizes, pa.int64()),
                    *lists,
                ],
                ["doc_id", "lot", "n", "ids", "tfs"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        count, VECTOR.format(key=kind)
    )


def impacts(ids: np.ndarray, tfs: np.ndarray, m: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Coordinates of vectors: weight times damped count, in integers."""
    return weights[ids] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m))


def lengths(counted: DataFrame, total: tuple[int, int], weights) -> DataFrame:
    """``counted`` with ``m`` for a document's size and ``length`` of its vector."""
    documents, occurrences = total
    m = F.expr(f"10 + (90L * n * {documents}L) div {max(1, occurrences)}L")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tfs, starts, owner = _flat(batch.column(3), batch.column(4))
            sizes = batch.column(2).to_numpy(zero_copy_only=False)
            values = impacts(ids, tfs, sizes[owner], weights.value).astype(np.float64)
            squares = np.bincount(owner, values * values, minlength=len(starts) - 1)
            length = pa.array(np.sqrt(squares))
            yield pa.RecordBatch.from_arrays([*batch.columns, length], [*batch.schema.names, "length"])

    sized = counted.where(F.size("ids") > 0).select("doc_id", "lot", m.alias("m"), "ids", "tfs")
    kind = counted.schema["doc_id"].dataType.simpleString()
    return sized.mapInArrow(
        measure, f"doc_id {kind}, lot int, m long, ids array<int>, tfs array<int>, length double"
    )


def _flat(ids: pa.ListArray, tfs: pa.ListArray):
    """(ids, tfs, start of each row, row of each coordinate) of list columns."""
    starts = ids.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    lo, hi = starts[0], starts[-1]
    starts = starts - lo
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    flat = [np.asarray(x.values[lo:hi].to_numpy(zero_copy_only=False), np.int64) for x in (ids, tfs)]
    return *flat, starts, owner


class Bucket:
    """Vectors of similar length, by coordinate."""

    def __init__(self, keys: list, ids, owner, values, length):
        order = np.argsort(ids, kind="stable")
        self.keys, self.length = keys, length
        self.owner, self.values = owner[order], values[order]
        self.ids, first = np.unique(ids[order], return_index=True)
        self.ends = np.append(first, len(order))
        self.most = np.maximum.reduceat(self.values, first) if len(first) else self.values[:0]

    def search(self, wanted: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows, and their scores, that reach ``least`` (at least 1) for the item with the
        terms ``wanted``."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        size = len(wanted)
        reach = math.sqrt(size) * (1 + ROOM)
        if not len(self.length) or reach * self.length.max() < least:
            return none
        at = np.flatnonzero(np.isin(self.ids, wanted))
        at = at[np.argsort(-self.most[at], kind="stable")]
        # What the smaller coordinates can add at most; a row without any of the larger
        # ones cannot reach the threshold.
        beyond = np.append(np.cumsum(self.most[at][::-1])[::-1], 0)
        focus = int(np.searchsorted(-beyond, -least, side="right"))
        if not focus:
            return none
        part = np.zeros(len(self.length))
        squares = np.zeros(len(self.length))
        for c in at[:focus]:
            rows, values = self._list(c)
            part[rows] += values
            squares[rows] += np.square(values, dtype=np.float64)
        left = np.sqrt(np.maximum(np.square(self.length) * (1 + ROOM) - squares, 0))
        rest = np.minimum(beyond[focus], math.sqrt(max(0, size - focus)) * left)
        live = (part > 0) & ((part + rest) * (1 + ROOM) >= least) & (reach * self.length >= least)
        rows = np.flatnonzero(live)
        if not len(rows):
            return none
        place = np.full(len(self.length), -1)
        place[rows] = np.arange(len(rows))
        scores = np.zeros(len(rows), np.int64)
        for c in at:
            found, values = self._list(c)
            to = place[found]
            scores[to[to >= 0]] += values[to >= 0]
        return rows[scores >= least], scores[scores >= least]

    def _list(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.ends[c], self.ends[c + 1]
        return self.owner[lo:hi], self.values[lo:hi]


class Best:
    """The best rows of each item so far, ties to the smaller key, null keys last."""

    def __init__(self, least: list[int], keep: int):
        self.least, self.keep = list(least), keep
        self.found: list[list[tuple]] = [[] for _ in least]

    def add(self, item: int, keys: list, scores: np.ndarray) -> None:
        if len(scores) > self.keep:  # ties at the last place stay for now
            last = np.partition(scores, len(scores) - self.keep)[len(scores) - self.keep]
            chosen = np.flatnonzero(scores >= last)
            keys, scores = [keys[i] for i in chosen], scores[chosen]
        rows = self.found[item] + [(-s, k is None, k) for s, k in zip(scores.tolist(), keys)]
        rows.sort(key=lambda r: r[:2] if r[1] else r)
        self.found[item] = rows[: self.keep]
        if len(rows) >= self.keep:
            self.least[item] = max(self.least[item], -rows[self.keep - 1][0])


def search(ordered: DataFrame, items, weights, least: list[int], keep: int) -> DataFrame:
    """``item``, ``doc_id`` and ``score``: of each task the best rows of each item among
    those that reach ``least``."""
    kind = ordered.schema["doc_id"].dataType.simpleString()
    key_type = ordered.limit(0).select("doc_id").toArrow().schema.field(0).type
    size = BUCKET

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(least, keep)
        for bucket in _buckets(batches, weights.value, size):
            for i, wanted in enumerate(items.value.terms):
                rows, scores = bucket.search(wanted, best.least[i])
                if len(rows):
                    best.add(i, [bucket.keys[r] for r in rows.tolist()], scores)
        flat = [(i, k, -s) for i, rows in enumerate(best.found) for s, _, k in rows]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, *_ in flat], pa.int32()),
                pa.array([k for _, k, _ in flat], key_type),
                pa.array([s for *_, s in flat], pa.int64()),
            ],
            ["item", "doc_id", "score"],
        )

    return ordered.select("doc_id", "m", "ids", "tfs", "length").mapInArrow(
        run, f"item int, doc_id {kind}, score long"
    )


def _buckets(batches: Iterator[pa.RecordBatch], weights: np.ndarray, size: int) -> Iterator[Bucket]:
    for batch in batches:
        lo, ends = 0, batch.column(2).offsets.to_numpy()
        while lo < batch.num_rows:
            within = int(np.searchsorted(ends, ends[lo] + COORDINATES, side="right")) - 1
            hi = max(lo + 1, min(lo + size, within, batch.num_rows))
            part = batch.slice(lo, hi - lo)
            ids, tfs, _, owner = _flat(
                pa.ListArray.from_arrays(part.column(2).offsets, part.column(2).values),
                pa.ListArray.from_arrays(part.column(3).offsets, part.column(3).values),
            )
            m = part.column(1).to_numpy(zero_copy_only=False)
            values = impacts(ids, tfs, m[owner], weights)
            length = part.column(4).to_numpy(zero_copy_only=False)
            yield Bucket(part.column(0).to_pylist(), ids, owner, values, length)
            lo = hi


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(f"rank <= {keep}")


def _search_block(spark: SparkSession, docs: DataFrame, block: Items, key: str, text: str, keep: int):
    sc = spark.sparkContext
    number, items = sc.broadcast(block.number), sc.broadcast(block)
    counted = settle(vectors(docs, key, text, number))
    documents, occurrences = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(block.number), np.int64)
    for r in counted.select(F.explode("ids").alias("id")).groupBy("id").count().collect():
        holding[r["id"]] = r["count"]
    weights = sc.broadcast(np.array([weight(documents, int(h)) for h in holding], np.int64))
    # Longest first. Equal lengths are dealt out by lot, so copies are not one task.
    longest = F.desc("length")
    measured = lengths(counted, (documents, occurrences), weights)
    ordered = settle(measured.repartitionByRange(longest, "lot").sortWithinPartitions(longest))
    least = [1] * len(block.keys)
    cut = None
    if documents > 2 * FIRST:
        share = 1 - FIRST / documents
        cut = ordered.agg(F.percentile_approx("length", F.lit(share), F.lit(1000))).first()[0]
    found = []
    if cut is not None:
        first = settle(_ranked(search(ordered.where(F.col("length") >= cut), items, weights, least, keep), keep))
        for r in first.where(f"rank = {keep}").collect():
            least[r["item"]] = r["score"]
        found.append(first.select("item", "doc_id", "score"))
        ordered = ordered.where(F.col("length") < cut)
    # No item is reached by vectors shorter than this: the scan leaves them out.
    reach = min(
        (s / (math.sqrt(max(1, len(t))) * (1 + ROOM)) for s, t in zip(least, block.terms)), default=0.0
    )
    rest = search(ordered.where(F.col("length") >= reach * (1 - ROOM)), items, weights, least, keep)
    for more in found:
        rest = rest.unionByName(more)
    best = settle(_ranked(rest, keep))
    for shared in (number, items, weights):
        shared.unpersist()
    return best


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    keep: int = BEST,
) -> DataFrame:
    """The ``keep`` best documents of each item: ``item_key``, ``rank`` from 1, ``key``
    and ``score``.

    Null texts have no terms; an item without terms, or whose terms no document has, has
    no rows; scores are above 0. Ties go to the smaller key, null keys last; repeated
    documents and items each count as rows of their own; empty tables give an empty
    result. Other columns are ignored whatever their names.
    """
    spark = docs.sparkSession
    item_kind = items.schema[item_key].dataType
    out = None
    for block in item_blocks(items, item_key, item_text):
        best = _search_block(spark, docs, block, key, text, keep)
        names = spark.createDataFrame(
            list(enumerate(block.keys)), f"item int, name {item_kind.simpleString()}"
        )
        named = best.join(names, "item").select(
            F.col("name").alias(item_key), "rank", F.col("doc_id").alias(key), "score"
        )
        out = named if out is None else out.unionByName(named)
    if out is None:
        kind = docs.schema[key].dataType.simpleString()
        out = spark.createDataFrame(
            [], f"{item_key} {item_kind.simpleString()}, rank int, {key} {kind}, score long"
        )
    return out
