"""LEFT JOIN of a large fact table onto a dimension that is usually small.

The dimension is measured first. Within the bounds it is broadcast, so facts are never
shuffled. Beyond them both sides are sorted and merged, never broadcast; run-time skew
handling splits the facts of an item that holds a third of all rows over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class LookupBounds:
    # Proven limits for a broadcast side: its rows and the bytes of their values.
    rows: int = 500_000
    bytes: int = 64 * 1024 * 1024


def lookup_join(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    columns: list[str],
    bounds: LookupBounds = LookupBounds(),
) -> DataFrame:
    """facts LEFT JOIN dimension on `key`, adding `columns`.

    Unmatched and NULL keys keep their row with NULLs; a repeated dimension key repeats
    the row.
    """
    dimension = dimension.select(key, *columns)
    if fits(dimension, bounds):
        return facts.join(F.broadcast(dimension), key, "left")
    return facts.join(dimension.hint("merge"), key, "left")


def fits(dimension: DataFrame, bounds: LookupBounds) -> bool:
    """Measure the side: one narrow scan with map-side totals, one row to the driver."""
    width = reduce(
        add, [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in dimension.columns]
    )
    seen = dimension.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    return seen["rows"] <= bounds.rows and seen["bytes"] <= bounds.bytes
