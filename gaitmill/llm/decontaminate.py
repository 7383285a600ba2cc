"""Test items in documents, up to a number of edits.

Pigeonhole: an item with k edits, cut into k + 1 pieces, keeps one piece unharmed. All
pieces of all items are found exactly by one automaton over each whole document; around
a hit Myers' bit-parallel edit distance decides.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Edits allowed per character of an item.
ERROR_RATE = 0.07
#: Shortest piece; short items get fewer edits instead of shorter pieces.
PIECE = 12
#: Bytes of items in one automaton. Larger benchmarks are searched block by block.
BLOCK_BYTES = 1 << 20

MATCH = "array<struct<item_id: bigint, distance: int, start: bigint, end: bigint>>"
_MATCH_TYPE = pa.list_(
    pa.struct(
        [("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]
    )
)


def normalised(text: str | None) -> str:
    """Lower case, white space as single spaces, none at the ends; null is empty."""
    return " ".join((text or "").lower().split())


def budget(length: int, rate: float = ERROR_RATE) -> int:
    """Edits allowed for an item of ``length`` characters."""
    return max(0, min(int(length * rate), length // PIECE - 1))


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """``edits`` + 1 pieces with their offsets, lengths at most one apart."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(lo, item[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]


class Myers:
    """Smallest edit distance of a pattern to any part of a text, bit-parallel."""

    def __init__(self, pattern: str):
        self.length = len(pattern)
        self.masks: dict[str, int] = defaultdict(int)
        for i, c in enumerate(pattern):
            self.masks[c] |= 1 << i
        self.masks.default_factory = None

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end of the first part that has it)."""
        all_ones, high = (1 << self.length) - 1, 1 << (self.length - 1)
        up, down, score = all_ones, 0, self.length
        best, end, masks = score, 0, self.masks
        for at, c in enumerate(text, 1):
            same = masks.get(c, 0)
            diagonal = (((same & up) + up) ^ up) | same | down
            right = down | (all_ones & ~(diagonal | up))
            left = up & diagonal
            if right & high:
                score += 1
            elif left & high:
                score -= 1
            right = (right << 1) & all_ones
            left = (left << 1) & all_ones
            up = left | (all_ones & ~(diagonal | right))
            down = right & diagonal
            if score < best:
                best, end = score, at
        return best, end


@dataclass(frozen=True)
class Item:
    item_id: int | None
    text: str  # normalised
    edits: int


class Searcher:
    """Finds the items of one block in normalised texts."""

    def __init__(self, items: tuple[Item, ...]):
        import ahocorasick

        self.items = items
        self.forward = [Myers(i.text) for i in items]
        self.backward = [Myers(i.text[::-1]) for i in items]
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, item in enumerate(items):
            for offset, piece in pieces(item.text, item.edits):
                where[piece].append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in where.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[dict]:
        """The best match of every item within its budget, the first one of equals."""
        starts: dict[int, list[int]] = defaultdict(list)
        for last, (size, uses) in self.automaton.iter(text):
            for n, offset in uses:
                starts[n].append(last + 1 - size - offset)
        found = []
        for n, at in starts.items():
            item, best = self.items[n], None
            for lo, hi in _windows(at, len(item.text), item.edits):
                lo = max(lo, 0)
                distance, end = self.forward[n].best(text[lo:hi])
                if distance <= item.edits and (best is None or distance < best[0]):
                    best = (distance, lo + end)
            if best is not None:
                distance, end = best
                lo = max(0, end - len(item.text) - item.edits)
                size = self.backward[n].best(text[lo:end][::-1])[1]
                found.append(
                    {"item_id": item.item_id, "distance": distance, "start": end - size, "end": end}
                )
        return found


def _windows(starts: list[int], length: int, edits: int) -> list[tuple[int, int]]:
    """Parts of the text that any match around the hits lies in, merged."""
    merged: list[tuple[int, int]] = []
    for s in sorted(set(starts)):
        lo, hi = s - edits, s + length + edits
        if merged and lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], hi)
        else:
            merged.append((lo, hi))
    return merged


@lru_cache(maxsize=4)
def _searcher(items: tuple[Item, ...]) -> Searcher:
    return Searcher(items)


def item_blocks(
    items: DataFrame, key: str = "item_id", text: str = "text", rate: float = ERROR_RATE
) -> list[tuple[Item, ...]]:
    """The items in blocks of about ``BLOCK_BYTES``, cut by hash.

    The size is summed first; each block is fetched on its own. Items that are null or
    empty when normalised can be in every text and in none: they take no part.
    """
    chosen = items.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).where("text is not null")
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    out = []
    for b in range(blocks):
        rows = chosen.where(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)) == b).collect()
        texts = sorted(
            ((r["key"], normalised(r["text"])) for r in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1])
        )
        block = tuple(Item(k, t, budget(len(t), rate)) for k, t in texts if t)
        if block:
            out.append(block)
    return out


def matches(text: Column, blocks: list[tuple[Item, ...]]) -> Column:
    """Array of (item_id, distance, start, end) for the items found in ``text``.

    ``start`` and ``end`` count code points of the normalised text.
    """

    def finder(block: tuple[Item, ...]) -> Column:
        @F.arrow_udf(MATCH)
        def find(texts: pa.Array) -> pa.Array:
            searcher = _searcher(block)
            return pa.array([searcher.find(normalised(t.as_py())) for t in texts], _MATCH_TYPE)

        return find(text)

    if not blocks:
        return F.array().cast(MATCH)
    return F.concat(*[finder(b) for b in blocks])


def contaminated(
    docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document and item found in it: ``key``, ``item_id``, ``distance``,
    ``start``, ``end``.

    Null and empty texts hold nothing; an item is reported once a document, at its best
    match; equal items and repeated documents each have their rows; empty tables give an
    empty result. Documents are not moved. Other columns are ignored.
    """
    found = docs.select(
        F.col(key).alias(key), F.explode(matches(F.col(text), item_blocks(items))).alias("m")
    )
    return found.select(key, "m.item_id", "m.distance", "m.start", "m.end")


def without_contaminated(docs: DataFrame, items: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with the rows that hold no item. All columns stay."""
    return docs.where(F.size(matches(F.col(text), item_blocks(items))) == 0)
