"""Phrase collocations, word by word longer: tasks report hashes, then phrases are counted.

A task cuts what it reads into shards of about ``SHARD`` words of one language, and reports
once, for all of them, the hash of each phrase and how often it has it. Sums over the tasks
say which phrases can have the support; only where both shorter ones are among these is a
longer one looked at, and in the end only these are counted exactly.

Candidates travel as a bitmap of fixed size. It may let others through, never fewer, and
what is counted in the end are phrases, not hashes: results do not depend on the bitmap.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaitmill.operators.shared import settle

SUPPORT, LONGEST, KEEP = 30, 4, 2_000
#: Part of a phrase's count, in percent, that a longer one has to have to stand for it.
WITHIN = 80
#: Words of a shard, which bounds a task's memory; a longer text is a shard of its own.
SHARD = 1_500_000
#: Hashes, and phrases with their counts, that a task holds before it reports the language
#: with most of them.
MOST_HASHES, MOST_PHRASES = 1 << 23, 1 << 20
#: Bits of a bitmap, as a power of two: 8 MB whatever the data.
BITS = 26
#: Ranges of hashes whose reports are summed apart: by the bytes of the largest language,
#: and no more than leave about a thousand phrases of a full shard in each.
RANGE_BYTES, LEAST_RANGES, MOST_RANGES = 4 << 20, 16, 1_024
#: Places that are hashed or looked up at once.
CHUNK = 65_536
#: Words whose hash a Python worker remembers; beyond it the store starts anew.
STORE = 250_000

_FOLD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOWER = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c == 9 else 255 if c in b".,;:!?\n\x0b\x0c\r" else c
    for c in range(256)
)
#: No UTF-8 text has this byte: it ends a piece.
_END = b"\xff"


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= STORE:
            self.clear()
        value = 0 if word == _END else xxhash.xxh64_intdigest(word) or 1
        self[word] = value
        return value


_hashes = _WordHashes()


def words(text: bytes) -> list[bytes]:
    """Lower-cased words of a text (UTF-8); ``_END`` after each piece."""
    found = text.translate(_LOWER).replace(_END, b" \xff ").split()
    found.append(_END)
    return found


class Shard:
    """Texts of one language as one array of word hashes; where ``named``, also as one
    run of bytes with the place of each word. No object is kept for a word."""

    def __init__(self, lang: str, named: bool = True):
        self.lang, self.size, self.named = lang, 0, named
        self.parts: list[tuple[np.ndarray, np.ndarray | None]] = []
        self.run = bytearray()
        self.salt = np.uint64(xxhash.xxh64_intdigest(lang))

    def add(self, text: bytes) -> None:
        found = words(text)
        n = len(found)
        self.size += n
        ends = None
        if self.named:
            ends = len(self.run) + np.cumsum(np.fromiter(map(len, found), np.int64, n) + 1)
            self.run += b" ".join(found) + b" "
        self.parts.append((np.fromiter(map(_hashes.__getitem__, found), np.uint64, n), ends))

    def close(self) -> None:
        self.hashes = np.concatenate([h for h, _ in self.parts])
        if self.named:
            self.starts = np.concatenate([[0], *[e for _, e in self.parts]])
        self.parts.clear()
        #: Words from each place to the end of its piece, ``LONGEST`` at most; 0 at an end.
        self.left = np.zeros(len(self.hashes), np.int8)
        inside = self.hashes != 0
        more = inside.copy()
        for _ in range(LONGEST):
            self.left += more
            more[:-1] = inside[:-1] & more[1:]

    def name(self, at: int, k: int) -> bytes:
        """The ``k`` words from ``at`` on, joined by spaces."""
        return bytes(self.run[self.starts[at] : self.starts[at + k] - 1])

    def phrases(self, k: int, shorter: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Places of the phrases of ``k`` words whose parts of ``k - 1`` words are all in
        the bitmap ``shorter``, and their hashes."""
        at = np.flatnonzero(self.left >= k)
        if shorter is not None:
            found = self.left >= k - 1
            found[found] = _holds(shorter, self._hashed(np.flatnonzero(found), k - 1))
            at = at[found[at] & found[at + 1]]
        return at, self._hashed(at, k)

    def _hashed(self, at: np.ndarray, k: int) -> np.ndarray:
        out = np.empty(len(at), np.uint64)
        for lo in range(0, len(at), CHUNK):  # what is computed on the way stays small
            some = at[lo : lo + CHUNK]
            value = np.full(len(some), self.salt ^ np.uint64(k))
            for i in range(k):
                value = (value ^ (value >> np.uint64(29))) * _FOLD + self.hashes[some + i]
            value = (value ^ (value >> np.uint64(32))) * _MIX
            out[lo : lo + CHUNK] = value ^ (value >> np.uint64(29))
        return out


def _holds(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    out = np.empty(len(hashes), bool)
    for lo in range(0, len(hashes), CHUNK):
        slot = hashes[lo : lo + CHUNK] >> np.uint64(65 - (64 * len(bitmap)).bit_length())
        bits = bitmap[(slot >> np.uint64(6)).astype(np.int64)]
        out[lo : lo + CHUNK] = (bits >> (slot & np.uint64(63))) & np.uint64(1) == 1
    return out


def shards(batches: Iterator[pa.RecordBatch], size: int, named: bool) -> Iterator[Shard]:
    """Shards of about ``size`` words from rows of ``lang`` and ``text``."""
    open_: dict[str, Shard] = {}
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            shard = open_.get(lang)
            if shard is None:
                shard = open_[lang] = Shard(lang, named)
            before = shard.size
            shard.add(text.as_py())
            held += shard.size - before
            if held >= size:  # the largest goes, so memory is bounded for many languages
                full = max(open_.values(), key=lambda s: s.size)
                held -= full.size
                del open_[full.lang]
                full.close()
                yield full
    for lang in list(open_):
        last = open_.pop(lang)
        last.close()
        yield last


def packed(keys: np.ndarray, counts: np.ndarray, ranges: int, most: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """Counts of sorted 32-bit ``keys`` in ``ranges`` equal parts (a power of two) that are
    not empty: the part, keys per page of 65,536, low halves of the keys, and their counts,
    none above ``most``."""
    pages = np.bincount(keys >> np.uint32(16), minlength=1 << 16).astype(np.uint32)
    low = keys.astype(np.uint16)
    few = np.minimum(counts, most).astype(np.min_scalar_type(most))
    width = (1 << 16) // ranges
    ends = np.append(0, np.cumsum(pages.reshape(ranges, width).sum(axis=1), dtype=np.int64))
    for r in np.flatnonzero(np.diff(ends)).tolist():
        part = slice(ends[r], ends[r + 1])
        yield r, pages[r * width : (r + 1) * width].tobytes(), low[part].tobytes(), few[part].tobytes()


def unpacked(pages: bytes, low: bytes, counts: bytes, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys, counted from the start of their range, and counts of a part of ``packed``."""
    of_page = np.frombuffer(pages, np.uint32)
    high = np.repeat(np.arange(len(of_page), dtype=np.uint32), of_page)
    return high << np.uint32(16) | np.frombuffer(low, np.uint16), np.frombuffer(counts, np.min_scalar_type(most))


def gathered(parts: Iterator[tuple[str, object]], most: int) -> Iterator[tuple[str, list]]:
    """All parts of a language, or of a large task some at a time: those of the language
    with most elements as soon as ``most`` are held."""
    open_: dict[str, list] = {}
    held: dict[str, int] = {}
    for lang, part in parts:
        open_.setdefault(lang, []).append(part)
        held[lang] = held.get(lang, 0) + len(part)
        while sum(held.values()) >= most:
            full = max(held, key=held.get)
            del held[full]
            yield full, open_.pop(full)
    yield from open_.items()


def reported(
    shards: Iterator[Shard], k: int, shorter: np.ndarray | None, ranges: int, most: int
) -> Iterator[tuple[str, int, bytes, bytes, bytes]]:
    """Language, and what ``packed`` makes of 32 bits of the hashes of its phrases of ``k``
    words: a phrase once for all shards that were gathered."""

    def hashed():
        for shard in shards:
            yield shard.lang, (shard.phrases(k, shorter)[1] >> np.uint64(32)).astype(np.uint32)

    for lang, parts in gathered(hashed(), MOST_HASHES):
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        for part in packed(keys, counts, ranges, most):
            yield lang, *part


def batched(rows: Iterator[tuple], fields: dict[str, pa.DataType], size: int) -> Iterator[pa.RecordBatch]:
    while some := list(itertools.islice(rows, size)):
        columns = [pa.array(c, t) for c, t in zip(zip(*some), fields.values())]
        yield pa.RecordBatch.from_arrays(columns, list(fields))


def mined(spark: SparkSession, texts: DataFrame, k: int, shorter, support: int, ranges: int) -> np.ndarray:
    """Bitmap of the phrases of ``k`` words that can have ``support``, given the bitmap of
    those of ``k - 1`` words (a broadcast, or None).

    Reports of a task are packed in as many rows as there are ``ranges`` of hashes; a range
    of a language is summed in one task. A count of ``support`` is enough by itself, so no
    larger one travels.
    """

    size, bits = SHARD, BITS

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = reported(shards(batches, size, False), k, shorter and shorter.value, ranges, support)
        fields = dict.fromkeys(("pages", "low", "counts"), pa.binary())
        yield from batched(rows, {"lang": pa.string(), "range": pa.int32()} | fields, ranges)

    def add(part: pa.Table) -> pa.Table:
        start = part.column("range")[0].as_py()
        rows = zip(*(part.column(c).to_pylist() for c in ("pages", "low", "counts")))
        read = [unpacked(*row, support) for row in rows]
        keys, counts = (np.concatenate(c) for c in zip(*read))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sums = np.add.reduceat(counts[order], first, dtype=np.int64)
        possible = keys[first[sums >= support]].astype(np.int64)
        slots = (possible + start * ((1 << 32) // ranges)) >> (32 - bits)
        at, group = np.unique(slots >> 6, return_inverse=True)
        table = np.zeros(len(at), np.uint64)
        np.bitwise_or.at(table, group, np.uint64(1) << (slots & 63).astype(np.uint64))
        return pa.table({"at": at, "bits": table.view(np.int64)})

    told = texts.mapInArrow(mine, "lang string, range int, pages binary, low binary, counts binary")
    words = told.groupBy("lang", "range").applyInArrow(add, "at long, bits long")
    table = words.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(1 << (BITS - 6), np.uint64)
    bitmap[table.column("at").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return bitmap


def phrases_of(shard: Shard, bitmaps: list[np.ndarray]) -> Iterator[pa.Table]:
    """``hash``, ``phrase`` and ``f`` of the phrases of a shard that are in ``bitmaps`` (one
    for each length, as the tables); the empty phrase has the number of all words, and no
    hash."""

    def table(hashes: np.ndarray, names: list[bytes], counts: np.ndarray) -> pa.Table:
        return pa.table({"hash": hashes, "phrase": pa.array(names, pa.binary()), "f": counts})

    yield table(np.zeros(1, np.uint64), [b""], np.array([(shard.left > 0).sum()]))
    for k, bitmap in enumerate(bitmaps, 1):
        at, hashes = shard.phrases(k, None if k == 1 else bitmaps[k - 2])
        inside = _holds(bitmap, hashes)
        at, hashes = at[inside], hashes[inside]
        # Equal hashes of different phrases are told apart by their words.
        keys, first, group = np.unique(hashes, return_index=True, return_inverse=True)
        same = np.ones(len(at), bool)
        for i in range(k):
            same &= shard.hashes[at + i] == shard.hashes[at[first][group] + i]
        others = np.flatnonzero(~same)
        names = [shard.name(i, k) for i in at[first].tolist() + at[others].tolist()]
        counts = np.bincount(group[same], minlength=len(first))
        yield table(
            np.concatenate([keys, hashes[others]]), names, np.concatenate([counts, np.ones(len(others), np.int64)])
        )


def summed(tables: list[pa.Table], keys: list[str]) -> pa.Table:
    """The sum of ``f`` for each of ``keys``."""
    sums = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([("f", "sum")])
    return sums.select([*keys, "f_sum"]).rename_columns([*keys, "f"])


def listed(
    shards: Iterator[Shard], bitmaps: list[np.ndarray], ranges: int
) -> Iterator[tuple[str, int, bytes, bytes]]:
    """Language, range of hashes, and its phrases (a line each) and their counts, compressed:
    a phrase once for all shards that were gathered."""
    packer = zstandard.ZstdCompressor()
    found = ((shard.lang, table) for shard in shards for table in phrases_of(shard, bitmaps))
    for lang, parts in gathered(found, MOST_PHRASES):
        sums = summed(parts, ["hash", "phrase"]).sort_by("hash")
        ends = (np.arange(1, ranges, dtype=np.uint64)) << np.uint64(65 - ranges.bit_length())
        ends = [0, *np.searchsorted(sums["hash"].to_numpy(), ends).tolist(), len(sums)]
        for r, (lo, hi) in enumerate(itertools.pairwise(ends)):
            if lo < hi:
                part = sums.slice(lo, hi - lo)
                counts = part["f"].to_numpy()
                counts = counts.astype(np.min_scalar_type(counts.max()))
                lines = b"\n".join(part["phrase"].to_pylist())
                yield lang, r, packer.compress(lines), packer.compress(counts.tobytes())


def unlisted(lines: bytes, counts: bytes) -> pa.Table:
    """``phrase`` and ``f`` of a part of ``listed``."""
    text = pa.array([zstandard.decompress(lines)], pa.binary()).cast(pa.string())
    phrase = pc.split_pattern(text, "\n").flatten()
    numbers = zstandard.decompress(counts)
    kind = np.dtype(f"u{len(numbers) // len(phrase)}")
    return pa.table({"phrase": phrase, "f": np.frombuffer(numbers, kind).astype(np.int64)})


def counted(texts: DataFrame, bitmaps, support: int, ranges: int) -> DataFrame:
    """``lang``, ``k``, ``phrase`` and ``f``, the exact count of the phrases in ``bitmaps``
    (one for each length, a broadcast) that have ``support``; of length 0 all words.

    As in ``mined`` a range of hashes of a language is summed in one task, but by phrases.
    """

    size = SHARD

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = listed(shards(batches, size, True), bitmaps.value, ranges)
        fields = dict.fromkeys(("lines", "counts"), pa.binary())
        yield from batched(rows, {"lang": pa.string(), "range": pa.int32()} | fields, ranges)

    def add(part: pa.Table) -> pa.Table:
        rows = zip(part.column("lines").to_pylist(), part.column("counts").to_pylist())
        sums = summed([unlisted(*row) for row in rows], ["phrase"])
        empty = pc.equal(sums["phrase"], "")
        sums = sums.filter(pc.or_(pc.greater_equal(sums["f"], support), empty))
        k = pc.add(pc.count_substring(sums["phrase"], " "), 1)
        k = pc.if_else(pc.equal(sums["phrase"], ""), 0, k).cast(pa.int32())
        lang = pa.array([part.column("lang")[0].as_py()] * len(sums), pa.string())
        return pa.table({"lang": lang, "k": k, "phrase": sums["phrase"], "f": sums["f"]})

    told = texts.mapInArrow(count, "lang string, range int, lines binary, counts binary")
    return told.groupBy("lang", "range").applyInArrow(add, "lang string, k int, phrase string, f long")


def scored(frequent: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``a``, ``l``, ``r`` and ``score`` of the phrases of two words
    and more in ``frequent`` (with all their parts) that no longer one stands for."""
    longer = frequent.where("k >= 2").withColumn("w", F.split("phrase", " ", -1))
    part = "concat_ws(' ', slice(w, {}, {}))".format
    cuts = longer.select(
        "lang", "phrase", F.col("f").alias("a"), "w", F.explode(F.expr("sequence(1, k - 1)")).alias("cut")
    ).selectExpr(
        "lang", "phrase", "a", "cut", part(1, "cut") + " as first", part("cut + 1", "size(w) - cut") + " as rest"
    )
    left = frequent.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = "cast({} as decimal(20, 0))".format
    score = f"(cast(2000000 as decimal(7, 0)) * {wide('a')}) div ({wide('l')} + {wide('r')})"
    lowest = (
        cuts.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .withColumn("score", F.expr(score))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("lowest"))
    )
    inner = longer.where("k >= 3").withColumn("size", F.explode(F.expr("sequence(2, k - 1)")))
    inner = inner.withColumn("start", F.explode(F.expr("sequence(1, k - size + 1)")))
    covers = (
        inner.selectExpr("lang", part("start", "size") + " as phrase", "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("cover"))
    )
    stands = F.expr(f"cover is not null and 100 * {wide('cover')} >= {WITHIN} * {wide('a')}")
    kept = lowest.join(covers, ["lang", "phrase"], "left").where(~stands)
    return kept.select("lang", "phrase", "a", "lowest.l", "lowest.r", "lowest.score")


def _first(rows: DataFrame, keep: int) -> DataFrame:
    """The best ``keep`` of each language with their rank, in two steps: a language is cut
    into lots whose best ones meet."""
    lots = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = rows.withColumn("_lot", F.pmod(F.xxhash64("phrase"), F.lit(lots)))
    of_lot = Window.partitionBy("lang", "_lot").orderBy(*order)
    some = dealt.withColumn("rank", F.row_number().over(of_lot)).where(f"rank <= {keep}")
    best = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return some.withColumn("rank", best).where(f"rank <= {keep}").drop("_lot")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", support: int = SUPPORT, keep: int = KEEP
) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``,
    ``r``, ``n`` and ``score``.

    Null texts count as empty, a null language as ``und``; repeated rows count each.
    Pieces end at ``.,;:!?`` and line ends, words at spaces and tabs; only A to Z are
    lower-cased. Ties are ordered by count, then phrase (bytes). An empty table, or none
    with ``support`` equal phrases, gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    sizes = texts.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("total"))
    total = sizes.agg(F.max("total")).first()[0] or 1
    ranges = min(MOST_RANGES, max(LEAST_RANGES, 1 << (total // RANGE_BYTES).bit_length()))
    bitmaps, shared = [], None
    for k in range(1, LONGEST + 1):
        bitmaps.append(mined(spark, texts, k, shared, support, ranges))
        if shared is not None:
            shared.unpersist()
        shared = spark.sparkContext.broadcast(bitmaps[-1])
    shared.unpersist()
    every = spark.sparkContext.broadcast(bitmaps)
    counts = settle(counted(texts, every, support, ranges))
    every.unpersist()
    best = _first(scored(counts.where("k > 0")), keep)
    totals = counts.where("k = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
