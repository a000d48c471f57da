"""Element-wise sums of arrays per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cells_of(partials: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return partials.select(*keys, F.posexplode(column).alias("cell", "value"))


def from_cells(cells: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Arrays again. Their length is that of one array, whatever the number of rows summed."""
    ordered = F.sort_array(F.collect_list(F.struct("cell", "value")))
    return cells.groupBy(*keys).agg(F.transform(ordered, lambda c: c["value"]).alias(column))


def add_up(partials: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Element-wise sum per key, combined before the shuffle."""
    sums = cells_of(partials, keys, column).groupBy(*keys, "cell").agg(F.sum("value").alias("value"))
    return from_cells(sums, keys, column)
