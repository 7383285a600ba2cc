"""Best-fit packing of token sequences with a dominance reduction in front.

Lengths are whole numbers up to the capacity, so an instance is a histogram with at
most ``capacity`` entries however many documents there are. The reduction and the
best fit work on that histogram, whole size classes at a time, and give a plan:
"pieces number r of length s go to sequence .. at offset ..". Spark ranks the pieces
of each length (``ranked``) and looks every piece up in the plan.
"""

from __future__ import annotations

import functools
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaitmill.llm import bpe
from gaitmill.llm.ranking import ranked
from gaitmill.operators.shared import settle

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"
Bin = tuple[tuple[int, ...], int]  # lengths that share a sequence, how many such


class Sizes:
    """Counts by length with the lengths that are left in ascending order."""

    def __init__(self, counts: dict[int, int]):
        self.count = {s: n for s, n in counts.items() if n}
        self.left = sorted(self.count)

    def take(self, size: int, n: int) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            self.left.remove(size)

    def largest_within(self, room: int, without: int) -> int | None:
        """Largest length up to ``room``; one item of length ``without`` is in use."""
        i = bisect_right(self.left, room) - 1
        if i >= 0 and self.left[i] == without and self.count[without] == 1:
            i -= 1
        return self.left[i] if i >= 0 else None

    def smallest(self, k: int, without: int) -> list[int]:
        """The ``k`` smallest items besides one of length ``without``."""
        found: list[int] = []
        for s in self.left:
            n = self.count[s] - (s == without)
            found += [s] * min(n, k - len(found))
            if len(found) >= k:
                break
        return found

    def best_pair(self, room: int, without: int) -> tuple[int, int] | None:
        """Two items with the largest sum up to ``room``, the larger one first."""
        best: tuple[int, int] | None = None
        for a in reversed(self.left[: bisect_right(self.left, room)]):
            spare = self.count[a] - (a == without)
            if spare < 1:
                continue
            if best and 2 * a <= sum(best):
                break
            i = bisect_right(self.left, min(a, room - a)) - 1
            while i >= 0:
                b = self.left[i]
                if self.count[b] - (b == without) - (b == a) >= 1:
                    if best is None or a + b > sum(best):
                        best = (a, b)
                    break
                i -= 1
        return best


def reduce_by_dominance(sizes: Sizes, capacity: int) -> list[Bin]:
    """Fixes sets that dominate every alternative, and takes them out of ``sizes``.

    For an item j and the room it leaves, in the order of decreasing j: alone if
    nothing fits; with its largest partner if that fills the room, if no two items fit
    together, or if at most two fit and no pair of them exceeds the partner; with a
    pair if at most two fit, the pair fills the room and holds the largest partner.
    Such a set can replace whatever an optimal packing puts next to j, so some optimal
    packing holds it. Runs until no rule applies.
    """
    fixed: list[Bin] = []
    changed = True
    while changed:
        changed = False
        for j in list(reversed(sizes.left)):
            while sizes.count.get(j):
                chosen = _dominating(sizes, j, capacity - j)
                if chosen is None:
                    break
                items = (j, *chosen)
                n = min(sizes.count[s] // items.count(s) for s in set(items))
                for s in set(items):
                    sizes.take(s, n * items.count(s))
                fixed.append((items, n))
                changed = True
    return fixed


def _dominating(sizes: Sizes, j: int, room: int) -> tuple[int, ...] | None:
    partner = sizes.largest_within(room, j)
    if partner is None:
        return ()
    if partner == room:
        return (partner,)
    small = sizes.smallest(3, j)
    if len(small) < 2 or small[0] + small[1] > room:
        return (partner,)
    if len(small) < 3 or sum(small) > room:
        pair = sizes.best_pair(room, j)
        if pair is None or partner >= sum(pair):
            return (partner,)
        if pair[0] == partner and sum(pair) == room:
            return pair
    return None


def best_fit(sizes: Sizes, capacity: int) -> list[Bin]:
    """Best fit by decreasing length over whole size classes."""
    open_bins: dict[int, list[Bin]] = defaultdict(list)
    rooms: list[int] = []

    def put(room: int, filled: Bin) -> None:
        if not open_bins[room]:
            insort(rooms, room)
        open_bins[room].append(filled)

    for size in reversed(sizes.left):
        n = sizes.count[size]
        while n:
            i = bisect_left(rooms, size)
            if i < len(rooms):
                room = rooms[i]
                items, many = open_bins[room].pop()
                if not open_bins[room]:
                    rooms.pop(i)
            else:
                room, items, many = capacity, (), n
            each = min(room // size, n)
            used = min(many, n // each)
            put(room - each * size, (items + (size,) * each, used))
            if items and many > used:
                put(room, (items, many - used))
            n -= used * each
    return [filled for room in open_bins.values() for filled in room]


def packing_plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, copies in a sequence, first sequence, offset).

    At most some tens of rows per length, whatever the counts.
    """
    sizes = Sizes(counts)
    bins = reduce_by_dominance(sizes, capacity)
    bins += best_fit(sizes, capacity)
    rows, sequence, used = [], 0, defaultdict(int)
    for items, n in bins:
        offset = 0
        for s in sorted(set(items), reverse=True):
            copies = items.count(s)
            rows.append((s, used[s], copies, sequence, offset))
            used[s] += copies * n
            offset += copies * s
        sequence += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def token_pieces(
    docs: DataFrame, tokenizer: str, ranks: str, capacity: int, end_id: int = 0
) -> DataFrame:
    """Documents as token ids and ``end_id``, cut where longer than ``capacity``.

    All pieces of a document but the first have the full length. Null texts are empty
    and give one piece with the end id alone.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")
    ).mapInArrow(functools.partial(_cut, tokenizer, ranks, capacity, end_id), PIECES)


def _cut(
    tokenizer: str, ranks: str, capacity: int, end_id: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    encoder = bpe.wordwise(tokenizer, ranks)
    end = int(end_id).to_bytes(4, "little")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32())]
        + [(c, pa.int64()) for c in ("start", "length", "ids_crc32")]
    )
    for batch in batches:
        out: list[tuple[int | None, int, int, int, int]] = []
        for doc, text in zip(batch.column(0).to_pylist(), bpe.texts(batch.column(1))):
            ids = encoder.packed(text) + end
            total = len(ids) // 4
            stop = total % capacity or capacity
            for piece, lo in enumerate([0, *range(stop, total, capacity)]):
                hi = min(stop + piece * capacity, total)
                crc = zlib.crc32(ids[4 * lo : 4 * hi])
                out.append((doc, piece, lo, hi - lo, crc))
        columns = list(zip(*out)) or [()] * 5
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, ranks: str, capacity: int = 2048, end_id: int = 0
) -> DataFrame:
    """One row per piece with its sequence and offset there.

    Whole documents where they fit, best-fit over what the dominance reduction leaves.
    Repeated rows are packed each; pieces that are equal in document, number and ids
    are interchangeable. An empty table gives an empty table. Other columns are not
    looked at. The driver holds the histogram (``capacity`` rows) and the plan.
    """
    pieces = settle(token_pieces(docs, tokenizer, ranks, capacity, end_id))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = packing_plan(counts, capacity)
    order = ["doc_id", "piece", "start", "ids_crc32"]
    return ranked(pieces, "length", order).mapInPandas(functools.partial(_place, plan), PACKED)


def _place(plan: np.ndarray, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    length, first, copies, sequence, offset = plan.T
    shift = np.int64(1) << 44  # more ranks than any length can have
    keys = length * shift + first
    for frame in frames:
        rank = frame["_rank"].to_numpy()
        size = frame["length"].to_numpy()
        at = np.searchsorted(keys, size * shift + rank, side="right") - 1
        since = rank - first[at]
        yield frame.assign(
            sequence_id=sequence[at] + since // copies[at],
            offset=offset[at] + since % copies[at] * size,
        )[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]
