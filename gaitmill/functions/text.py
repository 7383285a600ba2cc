"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: joins the parts of a hashed key.
SEPARATOR = "\x1f"


def stable_hash(seed: int, *parts: Column | str) -> Column:
    """Hex SHA-256 of the seed and the parts, joined by a unit separator."""
    texts = [F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("None")).cast("string")
             for p in parts]
    return F.sha2(F.concat_ws(SEPARATOR, F.lit(str(seed)), *texts), 256)


def present(text: Column) -> Column:
    """The text, or null when empty."""
    return F.when(text != "", text)
