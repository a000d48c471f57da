"""Joins on time and on calendar dimensions.

No broadcast hint is given for a table whose size is not known: Spark's size estimate
(static and adaptive) decides, and hot keys are split by the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar
from ..functions.scalar import utc_clock


def left_join_on_time(
    left: DataFrame, right: DataFrame, ts_col: str, series_cols: Sequence[str] = ()
) -> DataFrame:
    """Left equi-join on the series keys and time; duplicate right rows multiply."""
    keys = [*series_cols, ts_col]
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    return left.join(right, keys, "left")


def left_join_all(
    left: DataFrame, rights: Sequence[DataFrame], ts_col: str, series_cols: Sequence[str] = ()
) -> DataFrame:
    """Chain of left joins on the same key, which share one partitioning of the left side."""
    for right in rights:
        left = left_join_on_time(left, right, ts_col, series_cols)
    return left


def align_on_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Column-wise concatenation aligned on the key: full outer join."""
    return left.join(right, list(keys), "full")


def rows_of(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in the other table."""
    return df.join(other.select(*keys), list(keys), "left_semi")


def holiday_or_weekend(
    df: DataFrame,
    ts_col: str,
    holidays: DataFrame,
    match: str = "date",
    out: str = "is_holiday_or_weekend",
) -> DataFrame:
    """Weekend flag, or-ed with membership of the date in ``holidays(holiday)``.

    ``match="date"`` compares dates; ``match="none"`` ignores the holidays, which is what
    comparing zoned times with midnight dates amounts to.
    """
    if match == "none":
        return df.withColumn(out, calendar.is_weekend(ts_col))
    if match != "date":
        raise ValueError(f"unknown match {match!r}")
    days = holidays.select(F.col("holiday").alias("_holiday")).distinct()
    flagged = df.join(days, F.to_date(utc_clock(ts_col)) == F.col("_holiday"), "left")
    flag = F.col("_holiday").isNotNull() | calendar.is_weekend(ts_col)
    return flagged.select(*df.columns, flag.alias(out))


def daylight_from_dimension(
    df: DataFrame,
    ts_col: str,
    location_col: str,
    twilight: DataFrame,
    out: str = "daylight_flag",
) -> DataFrame:
    """``dawn <= ts <= dusk`` by lookup in ``twilight(location, day, dawn, dusk)``."""
    found = df.withColumn("_day", F.to_date(utc_clock(ts_col))).join(
        twilight.select(
            F.col(location_col), F.col("day").alias("_day"), F.col("dawn"), F.col("dusk")
        ),
        [location_col, "_day"],
        "left",
    )
    inside: Column = utc_clock(ts_col).between(F.col("dawn"), F.col("dusk"))
    return found.select(*df.columns, F.coalesce(inside, F.lit(False)).alias(out))


def parameter_grid(df: DataFrame, grid: dict[str, Sequence[float]]) -> DataFrame:
    """Every combination of the parameter values for each row, first list slowest.

    The lists are literals, so the product is an explode, not a join.
    """
    for name, values in grid.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(float(v)) for v in values])))
    return df
