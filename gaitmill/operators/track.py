"""Ordered scans over sequences of any length.

A *sequence* is the rows that share the keys, in a total order. While every
sequence is small, one window partition per sequence is the cheapest plan: one
shuffle serves all lags and running sums. A sequence above ``max_rows`` must not
land in one task, so then the rows are cut into chunks that follow the order:

* with a dense position column, ``position div max_rows`` is the chunk;
* otherwise the rows are range-partitioned by (keys, order) and written once, so
  that the chunk number, the range partition, stays the same ever after.

Windows then run per (keys, chunk), and a second, tiny table with one row per
(keys, chunk) carries values across the chunk borders.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gaitmill.operators.shared import group_sizes, same_key_join, settle

MAX_ROWS = 2_000_000
CHUNK = "_chunk"


@dataclass(frozen=True)
class Track:
    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    chunked: bool
    max_rows: int = MAX_ROWS

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        *,
        max_rows: int = MAX_ROWS,
        position: str | None = None,
    ) -> Track:
        largest, total = group_sizes(df, keys)
        keys, order = tuple(keys), tuple(order)
        if largest <= max_rows:
            return cls(df, keys, order, False, max_rows)
        if position is not None:
            chunk = F.floor(F.col(position) / F.lit(max_rows)).cast("int")
            return cls(df.withColumn(CHUNK, chunk), keys, order, True, max_rows)
        parts = 2 * (total // max_rows + 1)
        ranged = df.repartitionByRange(parts, *keys, *order)
        cut = settle(ranged.withColumn(CHUNK, F.spark_partition_id()))
        return cls(cut, keys, order, True, max_rows)

    # -- windows -----------------------------------------------------------

    @property
    def groups(self) -> tuple[str, ...]:
        return (*self.keys, CHUNK) if self.chunked else self.keys

    def window(self) -> WindowSpec:
        groups = self.groups or (F.lit(0),)
        return Window.partitionBy(*groups).orderBy(*self.order)

    def with_df(self, df: DataFrame) -> Track:
        return replace(self, df=df)

    def where(self, condition: Column) -> Track:
        return self.with_df(self.df.where(condition))

    def columns(self, **columns: Column) -> Track:
        return self.with_df(self.df.withColumns(columns))

    def pause(self) -> Track:
        """Write the rows out when chunked, before they are scanned twice again."""
        return self.with_df(settle(self.df)) if self.chunked else self

    def coarser(self, df: DataFrame, order: Sequence[str]) -> Track:
        """Track over ``df``, which has at most one row per row of this track."""
        if self.chunked:
            return Track.of(df, self.keys, order, max_rows=self.max_rows)
        return Track(df, self.keys, tuple(order), False, self.max_rows)

    def result(self) -> DataFrame:
        return self.df.drop(CHUNK)

    # -- scans -------------------------------------------------------------

    def neighbours(
        self,
        before: dict[str, Column] | None = None,
        after: dict[str, Column] | None = None,
    ) -> Track:
        """Add values of the previous row (``before``) and next row (``after``)."""
        before, after = before or {}, after or {}
        w = self.window()
        if not self.chunked:
            added = {name: F.lag(c).over(w) for name, c in before.items()}
            added |= {name: F.lead(c).over(w) for name, c in after.items()}
            return self.with_df(self.df.withColumns(added))

        position = F.struct(*self.order)
        prev_row = F.struct(*[c.alias(n) for n, c in before.items()] or [F.lit(1)])
        next_row = F.struct(*[c.alias(n) for n, c in after.items()] or [F.lit(1)])
        borders = self.df.groupBy(*self.groups).agg(
            F.max_by(prev_row, position).alias("_last"),
            F.min_by(next_row, position).alias("_first"),
        )
        across = Window.partitionBy(*self.keys or (F.lit(0),)).orderBy(CHUNK)
        borders = borders.select(
            *self.groups,
            F.lag("_last").over(across).alias("_in_last"),
            F.lead("_first").over(across).alias("_in_first"),
        )
        local = self.df.withColumns(
            {"_prev": F.lag(prev_row).over(w), "_next": F.lead(next_row).over(w)}
        )
        joined = same_key_join(local, borders, self.groups)
        prev = F.coalesce("_prev", "_in_last")
        nxt = F.coalesce("_next", "_in_first")
        added = {n: prev.getField(n) for n in before}
        added |= {n: nxt.getField(n) for n in after}
        return self.with_df(
            joined.withColumns(added).drop("_prev", "_next", "_in_last", "_in_first")
        )

    def running(
        self,
        sums: dict[str, Column] | None = None,
        maxima: dict[str, Column] | None = None,
        totals: dict[str, Column] | None = None,
    ) -> Track:
        """Add inclusive running sums and maxima, and totals of the sequence."""
        sums, maxima, totals = sums or {}, maxima or {}, totals or {}
        w = self.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = Window.partitionBy(*self.groups or (F.lit(0),))
        if not self.chunked:
            added = {n: F.sum(c).over(w) for n, c in sums.items()}
            added |= {n: F.max(c).over(w) for n, c in maxima.items()}
            added |= {n: F.sum(c).over(whole) for n, c in totals.items()}
            return self.with_df(self.df.withColumns(added))

        borders = self.df.groupBy(*self.groups).agg(
            F.lit(1).alias("_one"),
            *[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()],
            *[F.max(c).alias(f"_m_{n}") for n, c in maxima.items()],
            *[F.sum(c).alias(f"_t_{n}") for n, c in totals.items()],
        )
        across = Window.partitionBy(*self.keys or (F.lit(0),)).orderBy(CHUNK)
        earlier = across.rowsBetween(Window.unboundedPreceding, -1)
        everywhere = Window.partitionBy(*self.keys or (F.lit(0),))
        borders = borders.select(
            *self.groups,
            *[F.sum(f"_s_{n}").over(earlier).alias(f"_s_{n}") for n in sums],
            *[F.max(f"_m_{n}").over(earlier).alias(f"_m_{n}") for n in maxima],
            *[F.sum(f"_t_{n}").over(everywhere).alias(f"_t_{n}") for n in totals],
        )
        local = self.df.withColumns(
            {f"_l_{n}": F.sum(c).over(w) for n, c in sums.items()}
            | {f"_l_{n}": F.max(c).over(w) for n, c in maxima.items()}
        )
        joined = same_key_join(local, borders, self.groups)
        # Null only where the sequence had no value yet, in this chunk or before it.
        both = {n: (F.col(f"_l_{n}"), F.col(f"_s_{n}")) for n in sums}
        added = {
            n: F.coalesce(local + earlier, local, earlier) for n, (local, earlier) in both.items()
        }
        added |= {n: F.greatest(f"_l_{n}", f"_m_{n}") for n in maxima}
        added |= {n: F.col(f"_t_{n}") for n in totals}
        helpers = [f"_l_{n}" for n in (*sums, *maxima)]
        helpers += [f"_s_{n}" for n in sums] + [f"_m_{n}" for n in maxima]
        helpers += [f"_t_{n}" for n in totals]
        return self.with_df(joined.withColumns(added).drop(*helpers))

    def numbered(self, name: str, start: int = 0) -> Track:
        """Add the position in the sequence, counted from ``start``."""
        if not self.chunked:
            rank = F.row_number().over(self.window()).cast("long")
            return self.with_df(self.df.withColumn(name, rank + (start - 1)))
        ranked = self.running(sums={name: F.lit(1).cast("long")})
        return ranked.columns(**{name: F.col(name) + (start - 1)})


def halo(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    reach: int,
    page_rows: int = 500_000,
) -> tuple[DataFrame, WindowSpec, Column]:
    """Pages of a densely numbered sequence, with ``reach`` extra rows around.

    Returns the rows (border rows copied into the neighbour page), the window
    that sees one page, and the condition that keeps every row exactly once. One
    shuffle, no hot key, no size check: a page has at most
    ``page_rows + 2 * reach`` rows.
    """
    if reach >= page_rows:
        raise ValueError("reach must be smaller than a page")
    at = F.col(position)

    def page_of(offset: int) -> Column:
        return F.floor((at + offset) / F.lit(page_rows)).cast("long")

    pages = F.array_distinct(F.array(page_of(-reach), page_of(0), page_of(reach)))
    paged = df.withColumn("_page", F.explode(pages))
    window = Window.partitionBy(*keys, "_page").orderBy(position)
    return paged, window, F.col("_page") == page_of(0)


def attach(
    rows: DataFrame,
    per_sequence: DataFrame,
    keys: Sequence[str],
    position: str,
    length: str,
    page_rows: int = 500_000,
) -> DataFrame:
    """Inner join of rows with one record per sequence, without a hot key.

    ``length`` is a column of ``per_sequence``. The record is repeated once per
    page of its sequence, so a long sequence spreads over many tasks. Spark still
    broadcasts the records when they are small.
    """
    last = F.greatest(F.ceil(F.col(length) / page_rows) - 1, F.lit(0))
    records = per_sequence.withColumn(
        "_page", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long")))
    )
    paged = rows.withColumn(
        "_page", F.floor(F.col(position) / page_rows).cast("long")
    )
    return same_key_join(paged, records, [*keys, "_page"], "inner").drop("_page")
