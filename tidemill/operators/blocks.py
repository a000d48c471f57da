"""Window functions over series of any length.

``Window.partitionBy(series)`` puts a whole series into one task, and
``Window.orderBy(ts)`` the whole table. Here a series is cut instead:

1. the table is range partitioned by series, time, tie columns and, last, scan position, and
   sorted within the partitions; partitions are counted by series, and a window over the
   counts (a row for each series and partition) gives the number of rows before each, so every
   row gets its exact position. Rows of one series, even of one moment, are cut wherever the
   ranges end;
2. *blocks* of ``block_rows`` consecutive positions are windowed independently, each one
   carrying copies of the ``lookback`` rows before it. The copies are filtered out again.

The result equals the single window. The largest unit in one task is a range or a
block, whatever share of the rows one series holds. With ``chunk`` ("hour", "day", "month", ...)
rows are counted by *buckets* of time instead, which needs no written table but puts a bucket of
one series into one task. ``block_rows=None`` is the plain
window, one shuffle cheaper, for series known to be short (a daily calendar of a
century has 36,525 rows).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import scalar
from ..session import write_settled

BLOCK_ROWS = 100_000
CHUNK = None

_BUCKET = "_bucket"
_BEFORE = "_before"
_PART = "_part"
_INDEX = "_index"
_FIRST = "_first"
_ID_BITS = 33  # of monotonically_increasing_id, that count within a partition


def truncate(unit: str, ts: str | Column, like: str = "timestamp_ntz") -> Column:
    """Start of the ``unit`` a time falls in, by the UTC clock, in the type of the time (``like``).

    The built-in goes through the session zone, which can move hours around a clock change;
    here times are taken apart and put together without a zone.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    if like == "timestamp":
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, truncate(unit, scalar.without_zone(c))))
    if like != "timestamp_ntz":
        return truncate(unit, c.cast("timestamp_ntz")).cast(like)
    day = F.to_date(c)
    start = day.cast("timestamp_ntz")
    if unit == "day":
        return start
    if unit == "hour":
        return F.timestamp_add("HOUR", F.hour(c), start)
    if unit == "minute":
        return F.timestamp_add("MINUTE", F.hour(c) * 60 + F.minute(c), start)
    if unit == "second":
        return F.timestamp_add("SECOND", F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c), start)
    return F.trunc(day, unit).cast("timestamp_ntz")


def settle(df: DataFrame) -> DataFrame:
    """Materialise a table that several later steps read; see ``session.write_settled``."""
    return write_settled(df)


def _ts_type(df: DataFrame, ts_col: str) -> str:
    return df.schema[ts_col].dataType.simpleString()


def _carry(
    df: DataFrame,
    series_cols: Sequence[str],
    ts_col: str,
    chunk: str,
    totals: Mapping[str, Column],
) -> DataFrame:
    """Add, for each aggregate in ``totals``, its sum over all earlier buckets of the series."""
    keyed = df.withColumn(_BUCKET, truncate(chunk, F.col(ts_col), _ts_type(df, ts_col)))
    per_bucket = keyed.groupBy(*series_cols, _BUCKET).agg(
        *[expr.alias(name) for name, expr in totals.items()]
    )
    earlier = (
        Window.partitionBy(*(series_cols or [F.lit(0)]))
        .orderBy(_BUCKET)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = per_bucket.select(
        *series_cols,
        _BUCKET,
        *[F.sum(name).over(earlier).alias(name) for name in totals],
    )
    return keyed.join(carried, [*series_cols, _BUCKET], "left")


def _ranged(
    df: DataFrame,
    series_cols: Sequence[str],
    ts_col: str,
    order_cols: Sequence[str],
    totals: Mapping[str, Column],
) -> DataFrame:
    """``df`` in order, with ``_part``, the row's ``_index`` there, the ``_first`` index of its series there,
    and for each aggregate in ``totals`` its sum over all earlier partitions of the series.

    Written once, so that a row keeps its place when tasks are run again.
    """
    tie = "_scan"
    keys = [*series_cols, ts_col, *order_cols, tie]
    ordered = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = settle(ordered.drop(tie).withColumn(_INDEX, F.monotonically_increasing_id()))
    part = F.shiftright(_INDEX, _ID_BITS).cast("int")
    placed = placed.withColumns({_PART: part, _INDEX: F.col(_INDEX).bitwiseAND(F.lit((1 << _ID_BITS) - 1))})
    per_part = placed.groupBy(*series_cols, _PART).agg(
        F.min(_INDEX).alias(_FIRST), *[expr.alias(name) for name, expr in totals.items()]
    )
    earlier = (
        Window.partitionBy(*(series_cols or [F.lit(0)])).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = per_part.select(*series_cols, _PART, _FIRST, *[F.sum(name).over(earlier).alias(name) for name in totals])
    return placed.join(carried, [*series_cols, _PART], "left")


def with_position(
    df: DataFrame,
    series_cols: Sequence[str],
    ts_col: str,
    out: str = "position",
    order_cols: Sequence[str] = (),
    chunk: str | None = CHUNK,
    block_rows: int | None = BLOCK_ROWS,
) -> DataFrame:
    """1-based position of each row in its series by time (ties: ``order_cols``)."""
    if block_rows is None:
        plain = Window.partitionBy(*(series_cols or [F.lit(0)])).orderBy(ts_col, *order_cols)
        return df.withColumn(out, F.row_number().over(plain).cast("bigint"))
    if chunk is None:
        ranged = _ranged(df, series_cols, ts_col, order_cols, {_BEFORE: F.count(F.lit(1))})
        position = F.col(_INDEX) - F.col(_FIRST) + 1 + F.coalesce(F.col(_BEFORE), F.lit(0))
        return ranged.withColumn(out, position.cast("bigint")).select(*df.columns, out)
    carried = _carry(df, series_cols, ts_col, chunk, {_BEFORE: F.count(F.lit(1))})
    inside = Window.partitionBy(*series_cols, _BUCKET).orderBy(ts_col, *order_cols)
    position = F.row_number().over(inside).cast("bigint") + F.coalesce(F.col(_BEFORE), F.lit(0))
    return carried.withColumn(out, position).select(*df.columns, out)


def _with_copies(placed: DataFrame, position: str, lookback: int, block_rows: int) -> DataFrame:
    """Assign rows to blocks of at least ``lookback`` rows, whose last ones also go to the next block."""
    block_rows = max(block_rows, lookback)
    offset = F.col(position) - 1
    in_tail = F.pmod(offset, F.lit(block_rows)) >= block_rows - lookback
    both = F.array("_home", F.col("_home") + 1)
    return placed.withColumn("_home", F.floor(offset / block_rows).cast("bigint")).withColumn(
        "_block", F.explode(F.when(in_tail, both).otherwise(F.array("_home")))
    )


def over_blocks(
    df: DataFrame,
    series_cols: Sequence[str],
    ts_col: str,
    lookback: int,
    build: Callable[[WindowSpec], Mapping[str, Column]],
    order_cols: Sequence[str] = (),
    chunk: str | None = CHUNK,
    block_rows: int | None = BLOCK_ROWS,
    position_col: str | None = None,
) -> DataFrame:
    """Add window columns that look at most ``lookback`` rows back.

    ``build`` receives the ordered window and returns the columns to add. The row's
    position is added too when ``position_col`` names it.
    """
    position = position_col or "_position"
    if block_rows is None:
        window = Window.partitionBy(*(series_cols or [F.lit(0)])).orderBy(ts_col, *order_cols)
        added = dict(build(window))
        if position_col:
            added[position_col] = F.row_number().over(window).cast("bigint")
        return df.select("*", *[c.alias(n) for n, c in added.items()])
    placed = with_position(df, series_cols, ts_col, position, order_cols, chunk, block_rows)
    kept = [*df.columns, position] if position_col else list(df.columns)
    blocked = _with_copies(placed, position, lookback, block_rows)
    window = Window.partitionBy(*series_cols, "_block").orderBy(position)
    added = build(window)
    return (
        blocked.select("*", *[c.alias(n) for n, c in added.items()])
        .filter(F.col("_block") == F.col("_home"))
        .select(*kept, *added)
    )


def is_whole(layout: Mapping) -> bool:
    """Whether the layout declares series short enough for one task each."""
    return layout.get("block_rows", BLOCK_ROWS) is None


def map_blocks(
    df: DataFrame,
    series_cols: Sequence[str],
    ts_col: str,
    lookback: int,
    reduce_block: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame],
    schema: str,
    order_cols: Sequence[str] = (),
    chunk: str | None = CHUNK,
    block_rows: int | None = BLOCK_ROWS,
) -> DataFrame:
    """Reduce each block, in time order, with a numpy function on the executors.

    ``reduce_block(rows, own)`` gets the block's rows with their ``_position`` and a mask of
    the rows that are its own (the others are copies from the block before), and returns
    rows of ``schema``; the series keys are put in front.
    """
    keys = list(series_cols)
    types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    out = f"{types}, {schema}" if keys else schema

    def with_keys(found: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        for i, k in enumerate(keys):
            found.insert(i, k, rows[k].iloc[0])
        return found

    if block_rows is None:

        def whole(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values([ts_col, *order_cols])
            rows["_position"] = np.arange(1, len(rows) + 1)
            return with_keys(reduce_block(rows, np.ones(len(rows), dtype=bool)), rows)

        return df.groupBy(*keys).applyInPandas(whole, out)

    def part(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_position")
        own = (rows["_block"] == rows["_home"]).to_numpy()
        return with_keys(reduce_block(rows, own), rows)

    placed = with_position(df, keys, ts_col, "_position", order_cols, chunk, block_rows)
    copied = _with_copies(placed, "_position", lookback, block_rows)
    return copied.groupBy(*keys, "_block").applyInPandas(part, out)


def running_sum(
    df: DataFrame,
    series_cols: Sequence[str],
    ts_col: str,
    sums: Mapping[str, str],
    order_cols: Sequence[str] = (),
    chunk: str | None = CHUNK,
    block_rows: int | None = BLOCK_ROWS,
) -> DataFrame:
    """Add ``out = running sum of column`` for each ``{out: column}``, nulls counting as nothing."""
    if block_rows is None:
        whole = (
            Window.partitionBy(*(series_cols or [F.lit(0)]))
            .orderBy(ts_col, *order_cols)
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        return df.withColumns({out: F.sum(c).over(whole) for out, c in sums.items()})
    totals = {f"_before_{out}": F.sum(c) for out, c in sums.items()}
    if chunk is None:
        carried = _ranged(df, series_cols, ts_col, order_cols, totals)
        inside = Window.partitionBy(*series_cols, _PART).orderBy(_INDEX)
    else:
        carried = _carry(df, series_cols, ts_col, chunk, totals)
        inside = Window.partitionBy(*series_cols, _BUCKET).orderBy(ts_col, *order_cols)
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)

    def total(out: str, column: str) -> Column:
        here, before = F.sum(column).over(inside), F.col(f"_before_{out}")
        return F.when(here.isNull(), before).otherwise(here + F.coalesce(before, F.lit(0)))

    return carried.select(*df.columns, *[total(o, c).alias(o) for o, c in sums.items()])
