"""Near-duplicate classes with Order MinHash.

A document is the sequence of its five-word k-mers, each labelled with its occurrence:
the third time a k-mer comes is another element than the first. Under each of ``TABLES``
hash orders a sketch keeps the smallest labelled k-mers and puts them in text order, so
two documents meet where they share k-mers in the same order. Candidates are verified by
a banded alignment of the same sequences, so repetitions count as often as they come.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaitmill.llm import bpe
from gaitmill.llm.components import components
from gaitmill.operators.shared import settle

WORDS = 5
SIMILARITY = 0.8
#: At a similarity of 0.8 a sketch of two is shared with probability 0.63, so 16 tables
#: share none in about one of 8,000,000 cases.
TABLES = 16
#: Labelled k-mers of a sketch.
DEPTH = 2
#: Buckets up to this size give all their pairs; members of larger ones are linked to the
#: smallest, and joined exactly (see ``across``).
SMALL = 24
STORE = 250_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xC2B2AE3D27D4EB4F)
_SEEDS = np.array(
    [xxhash.xxh64_intdigest(f"order {i}") | 1 for i in range(TABLES)], dtype=np.uint64
)


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= STORE:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHashes()


def plain_kmers(text: str) -> np.ndarray:
    """64-bit hashes of the k-mers of a text in order.

    Words are split at white space and lower-cased. A text of one to four words has one
    k-mer, a text without words none.
    """
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    word = np.fromiter(map(_hashes.__getitem__, words), np.uint64, n)
    size = min(n, WORDS)
    kmers = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        kmers = kmers * _FOLD + word[i : n - size + 1 + i]
    return kmers ^ (kmers >> np.uint64(29))


def labelled_kmers(text: str) -> np.ndarray:
    """The k-mers of a text in order, each hashed with its occurrence, so all differ."""
    kmers = plain_kmers(text)
    order = np.argsort(kmers, kind="stable")
    at = np.arange(len(kmers))
    again = np.zeros(len(kmers), bool)
    again[1:] = kmers[order[1:]] == kmers[order[:-1]]
    occurrence = np.empty(len(kmers), np.uint64)
    occurrence[order] = at - np.maximum.accumulate(np.where(again, 0, at))
    labelled = (kmers + occurrence * _MIX) * _FOLD
    return labelled ^ (labelled >> np.uint64(31))


def sketches(text: str) -> np.ndarray:
    """Keys of all ``TABLES``: signed 64 bits; none for a text without words."""
    kmers = labelled_kmers(text)
    return _keys(kmers, _SEEDS) if len(kmers) else np.empty(0, np.int64)


def _keys(kmers: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    n = len(kmers)
    keep = min(n, DEPTH)
    block = max(1, 262_144 // n)
    keys = np.empty(len(seeds), np.uint64)
    for lo in range(0, len(seeds), block):
        hashed = (kmers ^ seeds[lo : lo + block, None]) * _MIX
        hashed ^= hashed >> np.uint64(32)
        hashed *= _FOLD
        if n > keep:
            least = np.argpartition(hashed, keep - 1, axis=1)[:, :keep]
        else:
            least = np.broadcast_to(np.arange(n), (len(hashed), n))
        in_text_order = np.sort(least, axis=1)
        key = np.full(len(hashed), DEPTH, np.uint64)
        for c in range(keep):
            key = (key ^ (key >> np.uint64(31))) * _FOLD + kmers[in_text_order[:, c]]
        keys[lo : lo + block] = key
    return keys.view(np.int64)


def aligned_similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Share of aligned k-mers, ``m / (len(a) + len(b) - m)``; 0 where below ``least``.

    Labelled k-mers occur once, so the best alignment is the longest increasing run of
    the places that b's k-mers have in a. An alignment that reaches
    ``least`` strays from the diagonal by no more than the longer text has unaligned
    k-mers: matches outside that band are left out.
    """
    total = len(a) + len(b)
    need = int(np.ceil(total * least / (1 + least) - 1e-9))
    band = max(len(a), len(b)) - need
    if not len(a) or not len(b) or min(len(a), len(b)) < need:
        return 0.0
    order = np.argsort(a)
    at = np.minimum(np.searchsorted(a[order], b), len(a) - 1)
    places = order[at]
    matched = np.flatnonzero((a[places] == b) & (np.abs(places - np.arange(len(b))) <= band))
    if len(matched) < need:
        return 0.0
    m = _longest_increasing(places[matched])
    return m / (total - m) if m >= need else 0.0


def _longest_increasing(places: np.ndarray) -> int:
    if (np.diff(places) > 0).all():
        return len(places)
    from bisect import bisect_left

    tails: list[int] = []
    for p in places.tolist():
        i = bisect_left(tails, p)
        if i == len(tails):
            tails.append(p)
        else:
            tails[i] = p
    return len(tails)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, flat = [], []
        for digest, text in zip(batch.column(0).to_pylist(), bpe.texts(batch.column(1))):
            keys = sketches(text)
            if len(keys):
                digests.append(digest)
                flat.append(keys)
        values = pa.array(np.concatenate(flat) if flat else np.empty(0, np.int64))
        offsets = pa.array(np.arange(len(digests) + 1, dtype=np.int32) * TABLES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.binary()), pa.ListArray.from_arrays(offsets, values)],
            ["node", "keys"],
        )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        u, v = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        similar, last, a = [], None, None
        texts = zip(bpe.texts(batch.column(2)), bpe.texts(batch.column(3)))
        for node, (left, right) in zip(u, texts):
            if node != last:  # neighbours in a batch often share their left side
                last, a = node, labelled_kmers(left)
            similar.append(aligned_similarity(a, labelled_kmers(right)))
        keep = [i for i, s in enumerate(similar) if s]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([u[i] for i in keep], pa.binary()),
                pa.array([v[i] for i in keep], pa.binary()),
                pa.array([similar[i] for i in keep], pa.float64()),
            ],
            ["u", "v", "similarity"],
        )


def _kmers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = bpe.texts(batch.column(2))
        for node, root, text in zip(batch.column(0), batch.column(1), texts):
            kmers = labelled_kmers(text)
            n = len(kmers)
            for lo in range(0, n, 65_536):
                part = pa.array(kmers[lo : lo + 65_536].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(node, len(part)),
                        pa.repeat(root, len(part)),
                        pa.repeat(pa.scalar(n, pa.int32()), len(part)),
                        part,
                    ],
                    ["node", "root", "n", "kmer"],
                )


def candidates(sketched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs ``u`` < ``v`` of ``sketched`` (``node``, ``keys``) that share a bucket, and
    the documents (``node``) with a large bucket, see ``across``.

    Buckets of ``SMALL`` at most give all their pairs, larger ones link their members to
    the smallest. No bucket is gathered in one task before its size is known to be small.
    """
    members = sketched.select("node", F.posexplode("keys").alias("t", "key"))
    keyed = members.select("node", F.xxhash64("t", "key").alias("bucket"))
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("pivot"))
    sizes = settle(sizes.where("n > 1"))
    small = keyed.join(sizes.where(f"n <= {SMALL}"), "bucket")
    lists = small.groupBy("bucket").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    u = lists.select("nodes", F.posexplode("nodes").alias("i", "u"))
    v = u.select("u", F.explode(F.expr("slice(nodes, i + 2, size(nodes))")).alias("v"))
    large = settle(keyed.join(sizes.where(f"n > {SMALL}"), "bucket").select("node", "pivot"))
    star = large.where("node > pivot").select(F.col("pivot").alias("u"), F.col("node").alias("v"))
    pairs = v.where("u < v").select("u", "v").unionByName(star)
    return pairs.distinct(), large.select("node").distinct()


def prefixes(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """The first k-mers (``node``, ``n``, ``rest``, ``kmer``) of ``texts`` (``_node``,
    ``_text``): similar texts in different ``groups`` share one of them.

    k-mers have one order: first those that only one group has, then by how many texts
    have them. Of two similar texts of n k-mers and more, at most a fifth of either is
    not in the other, so their first common k-mer is in that first part of both. What
    only one group has takes its place there and meets nothing, so copies that are
    linked already cost no pairs, and lines that are in very many texts come last.
    """
    labelled = texts.join(groups.withColumnRenamed("node", "_node"), "_node", "left")
    kmers = labelled.select("_node", F.coalesce("root", "_node").alias("root"), "_text").mapInArrow(
        _kmers, "node binary, root binary, n int, kmer long"
    )
    shared = kmers.groupBy("kmer").agg(
        F.count("*").alias("df"), F.min("root").alias("_least"), F.max("root").alias("_most")
    )
    shared = settle(shared.where("_least != _most").select("kmer", "df"))
    listed = (
        kmers.join(shared, "kmer")
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "kmer"))).alias("k"))
    )
    longest = f"n - cast(ceil(n * {SIMILARITY} - 1e-6) as int) + 1"
    first = F.expr(f"slice(k, 1, greatest(0, {longest} - (n - size(k))))")
    placed = listed.select("node", "n", F.size("k").alias("common"), F.posexplode(first))
    return placed.select(
        "node", "n", F.expr("common - pos").alias("rest"), F.col("col.kmer").alias("kmer")
    )


def across(first: DataFrame, groups: DataFrame, *, every: bool) -> DataFrame:
    """Pairs that share one of their ``first`` k-mers (see ``prefixes``) and are in
    different ``groups``: ``every`` such pair that has enough k-mers left to be similar,
    or only those with the hub of the k-mer, the member with the largest part of its own
    k-mers left: of copies of one text the least edited, to which most others are near."""
    labelled = first.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sides = [
        labelled.select("kmer", *[F.col(c).alias(side + c) for c in ("node", "root", "n", "rest")])
        for side in "uv"
    ]
    if not every:
        order = F.struct(F.col("vrest") / F.col("vn"), F.xxhash64("vnode", "kmer"))
        hub = F.max_by(F.struct("*"), order).alias("d")
        sides[1] = sides[1].groupBy("kmer").agg(hub).select("d.*")
    # A pair is similar only if it has enough common k-mers from its first one on.
    enough = f"least(urest, vrest) >= (un + vn) * {SIMILARITY / (1 + SIMILARITY)} - 1e-6"
    order = "unode < vnode" if every else "true"
    on = (sides[0]["kmer"] == sides[1]["kmer"]) & F.expr(f"{order} and uroot != vroot and {enough}")
    met = sides[0].join(sides[1], on)
    return met.select(F.least("unode", "vnode").alias("u"), F.greatest("unode", "vnode").alias("v")).distinct()


def with_digest(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_node``, the digest of its text; null texts count as empty."""
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn("_node", F.unhex(F.md5(content)))


def texts_of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """One text of each of ``nodes`` (``node``), from ``rows`` (``_node``, ``_text``).

    Texts move once: copies become one where they are read, before any shuffle, and the
    join with ``nodes`` finds them dealt by digest already.
    """
    one = rows.groupBy("_node").agg(F.min("_text").alias("_text"))
    return one.join(nodes.withColumnRenamed("node", "_node"), "_node", "left_semi")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``u``, ``v``, ``similarity``: the pairs whose alignment is good enough."""
    left = texts.select(F.col("_node").alias("u"), F.col("_text").alias("_left"))
    right = texts.select(F.col("_node").alias("v"), F.col("_text").alias("_right"))
    both = pairs.join(right, "v").join(left, "u").select("u", "v", "_left", "_right")
    return both.mapInArrow(_verify, "u binary, v binary, similarity double")


def search(docs: DataFrame, text: str = "text") -> DataFrame:
    """``node`` and ``root``, joined by links, for digests of texts that have any.

    Sketches are made where the texts are read. Texts move once, and only those of
    candidates go on to the verification, one of each digest.

    Documents with a large bucket are then joined exactly where they are not in one
    group yet. First they meet the hub of each k-mer, which leaves few groups, and only
    then all that are still in other groups. All other documents have small buckets
    only, which give all their pairs.
    """
    rows = with_digest(docs.select(F.col(text).alias("_text")), "_text")
    sketched = settle(
        rows.select("_node", "_text")
        .mapInArrow(_sketch, "node binary, keys array<long>")
        .groupBy("node")
        .agg(F.min("keys").alias("keys"))
    )
    pairs, crowd = candidates(sketched)
    crowd = settle(crowd)
    pairs = settle(pairs)
    nodes = pairs.select(F.col("u").alias("node")).unionByName(
        pairs.select(F.col("v").alias("node"))
    )
    texts = settle(texts_of(rows, nodes.unionByName(crowd).distinct()))
    found = settle(verified(pairs, texts).select("u", "v"))
    groups = components(found)
    if crowd.limit(1).count() == 0:
        return groups
    crowded = settle(texts.join(crowd.withColumnRenamed("node", "_node"), "_node", "left_semi"))
    first = settle(prefixes(crowded, groups))
    for every in (False, True):
        more = settle(verified(settle(across(first, groups, every=every)), crowded).select("u", "v"))
        # The groups as stars stand for all links found so far.
        stars = groups.select(F.col("node").alias("u"), F.col("root").alias("v"))
        groups = components(stars.unionByName(more))
    return groups


def near_duplicate_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, ``class_id`` and ``class_size``.

    ``class_id`` is the smallest key among documents joined by a chain of links (equal
    texts, or aligned labelled five-word k-mers with a similarity of 0.8 or more); null only
    where no document of the class has a key. Null texts count as empty; texts without
    words are similar to equal texts only. Repeated rows stay and count. An empty table
    gives an empty table. Other columns are ignored whatever their names.
    """
    groups = search(docs, text)
    rows = with_digest(docs.select(F.col(key).alias("key"), F.col(text).alias("_text")), "_text")
    nodes = rows.groupBy("_node").agg(F.min("key").alias("_key"), F.count("*").alias("_n"))
    grouped = nodes.join(groups.withColumnRenamed("node", "_node"), "_node", "left").withColumn(
        "root", F.coalesce("root", "_node")
    )
    grouped = settle(grouped)
    classes = grouped.groupBy("root").agg(
        F.min("_key").alias("class_id"), F.sum("_n").alias("class_size")
    )
    of_node = grouped.join(classes, "root").select("_node", "class_id", "class_size")
    rows = rows.select(F.col("key").alias(key), "_node")
    return rows.join(of_node, "_node").select(key, "class_id", "class_size")


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each class, with all its columns.

    The row with the smallest key stays, null keys last, then the one with the smallest
    digest of its text; rows that agree in key and text are one row.
    """
    names = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])  # no name can clash
    key, text = (f"c{names.index(c)}" for c in (key, text))
    groups = search(rows, text).withColumnRenamed("node", "_node")
    rows = with_digest(rows, text)
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "_node")
    nodes = rows.select(key, "_node").groupBy("_node").agg(F.min(order).alias("_first"))
    kept = (
        nodes.join(groups, "_node", "left")
        .groupBy(F.coalesce("root", "_node").alias("root"))
        .agg(F.min("_first").alias("f"))
        .select(F.col("f._node").alias("_node"), F.col("f.key").alias("_kept"))
    )
    same = F.col(key).eqNullSafe(F.col("_kept"))
    staying = rows.join(settle(kept), "_node").where(same)
    return staying.dropDuplicates(["_node"]).drop("_node", "_kept").toDF(*names)
