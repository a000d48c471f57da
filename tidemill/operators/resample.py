"""Dense calendars, resampling and differencing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks


def _interval(unit: str) -> Column:
    return F.expr("INTERVAL 3 MONTH" if unit == "quarter" else f"INTERVAL 1 {unit}")


def calendar_spine(
    df: DataFrame, ts_col: str, series_cols: Sequence[str] = (), unit: str = "day", out: str | None = None
) -> DataFrame:
    """Every ``unit`` step from the first to the last row of each series.

    Built from two numbers per series; the steps are generated on the executors.
    """
    out = out or ts_col
    step = blocks.truncate(unit, ts_col, blocks._ts_type(df, ts_col))
    spans = df.groupBy(*series_cols).agg(F.min(step).alias("_first"), F.max(step).alias("_last"))
    steps = F.sequence("_first", "_last", _interval(unit))
    return spans.select(*series_cols, F.explode(steps).alias(out))


def resample_mean(
    df: DataFrame,
    ts_col: str,
    columns: Sequence[str],
    series_cols: Sequence[str] = (),
    unit: str = "day",
    **layout,
) -> DataFrame:
    """Mean per calendar step; steps without rows appear with nulls.

    Partial means are combined before the shuffle, so one row per step and series is
    left, however many rows a step had.
    """
    step = blocks.truncate(unit, ts_col, blocks._ts_type(df, ts_col)).alias(ts_col)
    means = df.groupBy(*series_cols, step).agg(*[F.avg(c).alias(c) for c in columns])
    return fill_calendar(means, ts_col, columns, series_cols, unit, **layout)


def fill_calendar(
    df: DataFrame,
    ts_col: str,
    columns: Sequence[str],
    series_cols: Sequence[str] = (),
    unit: str = "day",
    **layout,
) -> DataFrame:
    """Add the missing steps, with nulls, to a table that has at most one row per step.

    Each row fills the gap between it and the row before it, which needs no join with a
    calendar. A caller whose series are short (an hourly calendar of a century has 876,600
    rows) may say so with ``block_rows=None``.
    """
    layout.setdefault("chunk", "year")
    narrow = df.select(*series_cols, ts_col, *columns)
    if not blocks.is_whole(layout):
        # One row per step and series, read twice by the cut windows below.
        narrow = blocks.settle(narrow)
    followed = blocks.over_blocks(
        narrow, series_cols, ts_col, 1, lambda w: {"_before": F.lag(ts_col).over(w)}, **layout
    )
    one = _interval(unit)
    first = F.coalesce(F.col("_before") + one, F.col(ts_col))
    filled = followed.withColumn("_step", F.explode(F.sequence(first, F.col(ts_col), one)))
    present = F.col("_step") == F.col(ts_col)
    return filled.select(
        *series_cols,
        F.col("_step").alias(ts_col),
        *[F.when(present, F.col(c)).alias(c) for c in columns],
    )


def per_step(
    df: DataFrame,
    ts_col: str,
    columns: Sequence[str],
    series_cols: Sequence[str] = (),
    keep_first: bool = False,
    **layout,
) -> DataFrame:
    """Cumulative readings to per-step values: row minus the row before, first row dropped.

    Positional, like a shift: a gap in time is one step, and a null makes two nulls.
    """
    passed = [c for c in df.columns if c not in columns]
    diffed = blocks.over_blocks(
        df,
        series_cols,
        ts_col,
        1,
        lambda w: {f"_step_{c}": F.col(c) - F.lag(c).over(w) for c in columns},
        position_col="_position",
        **layout,
    )
    if not keep_first:
        diffed = diffed.filter(F.col("_position") > 1)
    return diffed.select(*passed, *[F.col(f"_step_{c}").alias(c) for c in columns])


def daily_use(
    df: DataFrame,
    ts_col: str,
    columns: Sequence[str],
    series_cols: Sequence[str] = (),
    mode: str = "diff_of_mean",
    **layout,
) -> DataFrame:
    """Daily values of cumulative meters.

    ``diff_of_mean``: difference of the day's mean readings.
    ``sum_of_diff``: sum of the steps inside each day (the energy actually used).
    """
    if mode == "diff_of_mean":
        daily = resample_mean(df, ts_col, columns, series_cols, **layout)
        return per_step(daily, ts_col, columns, series_cols, **layout)
    if mode == "sum_of_diff":
        steps = per_step(df, ts_col, columns, series_cols, **layout)
        day = blocks.truncate("day", ts_col, blocks._ts_type(df, ts_col)).alias(ts_col)
        return steps.groupBy(*series_cols, day).agg(*[F.sum(c).alias(c) for c in columns])
    raise ValueError(f"unknown mode {mode!r}")
