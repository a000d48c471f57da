"""Completeness: null counts, trimming, runs of missing rows, profiles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks


def nulls_in_row(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, (F.col(c).isNull().cast("int") for c in columns))


def is_complete(columns: Sequence[str], share: float = 0.2) -> Column:
    """At most ``floor(share * number of columns)`` nulls in the row."""
    return nulls_in_row(columns) <= math.floor(share * len(columns))


def trim_to_complete(
    df: DataFrame, columns: Sequence[str], ts_col: str, series_cols: Sequence[str] = (), share: float = 0.2
) -> DataFrame:
    """Keep the rows from the first to the last complete row, incomplete ones between included."""
    complete = F.when(is_complete(columns, share), F.col(ts_col))
    bounds = F.struct(F.min(complete).alias("first"), F.max(complete).alias("last"))
    if not series_cols:
        span = df.agg(bounds.alias("span")).scalar()
        return df.filter(F.col(ts_col).between(span["first"], span["last"]))
    spans = df.groupBy(*series_cols).agg(bounds.alias("_span"))
    return (
        df.join(spans, list(series_cols))
        .filter(F.col(ts_col).between(F.col("_span.first"), F.col("_span.last")))
        .select(*df.columns)
    )


def between_times(df: DataFrame, ts_col: str, start: str, end: str) -> DataFrame:
    """Both ends included. Compared in the column's own type, so Parquet can skip row groups."""
    kind = df.schema[ts_col].dataType.simpleString()
    return df.filter(F.col(ts_col).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def _year_start(df: DataFrame, ts_col: str, year: int) -> Column:
    return F.lit(f"{year:04d}-01-01 00:00:00").cast(df.schema[ts_col].dataType.simpleString())


def in_years(df: DataFrame, ts_col: str, first: int, stop: int) -> DataFrame:
    """Years ``first`` to ``stop - 1``, written as a time range for pushdown."""
    ts = F.col(ts_col)
    return df.filter((ts >= _year_start(df, ts_col, first)) & (ts < _year_start(df, ts_col, stop)))


def in_test_year(df: DataFrame, ts_col: str, year: int) -> Column:
    ts = F.col(ts_col)
    return (ts >= _year_start(df, ts_col, year)) & (ts < _year_start(df, ts_col, year + 1))


def split_by_year(df: DataFrame, ts_col: str, year: int) -> tuple[DataFrame, DataFrame]:
    """Train is every other year (later ones too), test the given year."""
    test = in_test_year(df, ts_col, year)
    return df.filter(~test), df.filter(test)


def from_first_of(
    df: DataFrame, other: DataFrame, ts_col: str, series_cols: Sequence[str] = ()
) -> DataFrame:
    """Rows at or after the earliest time of ``other`` (per series)."""
    if not series_cols:
        return df.filter(F.col(ts_col) >= other.agg(F.min(ts_col)).scalar())
    starts = other.groupBy(*series_cols).agg(F.min(ts_col).alias("_start"))
    return df.join(starts, list(series_cols)).filter(F.col(ts_col) >= F.col("_start")).drop("_start")


def null_counts(df: DataFrame, columns: Sequence[str], series_cols: Sequence[str] = ()) -> DataFrame:
    """Nulls per column, long form, one pass."""
    counted = df.groupBy(*series_cols).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot(list(series_cols), list(columns), "column_name", "nulls")


def nulls_per_day(
    df: DataFrame, column: str, ts_col: str, series_cols: Sequence[str] = ()
) -> DataFrame:
    return df.groupBy(*series_cols, blocks.truncate("day", ts_col, blocks._ts_type(df, ts_col)).alias("day")).agg(
        F.count_if(F.col(column).isNull()).alias("missing")
    )


def null_days(df: DataFrame, column: str, ts_col: str, series_cols: Sequence[str] = ()) -> DataFrame:
    """Distinct days holding at least one null."""
    return (
        df.filter(F.col(column).isNull())
        .select(*series_cols, blocks.truncate("day", ts_col, blocks._ts_type(df, ts_col)).alias("day"))
        .distinct()
    )


def kept_share(df: DataFrame, columns: Sequence[str], series_cols: Sequence[str] = (), share: float = 0.2) -> DataFrame:
    kept = F.count_if(is_complete(columns, share))
    rows = F.count(F.lit(1))
    return df.groupBy(*series_cols).agg(
        kept.alias("kept_rows"),
        rows.alias("total_rows"),
        F.try_divide(kept * 100.0, rows).alias("kept_pct"),
    )


def time_bounds(df: DataFrame, ts_col: str, series_cols: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*series_cols).agg(F.min(ts_col).alias("first_ts"), F.max(ts_col).alias("last_ts"))


def shape(df: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*series_cols).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Occurrences per non-null value."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def run_ids(
    df: DataFrame,
    flag: Column,
    ts_col: str,
    series_cols: Sequence[str] = (),
    out: str = "run_id",
    flag_col: str = "missing",
    **layout,
) -> DataFrame:
    """Number the runs of equal flag values, from 1, in time order."""
    flagged = df.withColumn(flag_col, flag)
    changed = blocks.over_blocks(
        flagged,
        series_cols,
        ts_col,
        1,
        lambda w: {"_changed": (~F.col(flag_col).eqNullSafe(F.lag(flag_col).over(w))).cast("bigint")},
        position_col="_position",
        **layout,
    )
    # Two passes read the flags next; when the series is cut, those are written once first.
    if not blocks.is_whole(layout):
        changed = blocks.settle(changed)
    # The first row always starts run 1, also when its flag is null.
    first = changed.withColumn(
        "_changed", F.when(F.col("_position") == 1, F.lit(1).cast("bigint")).otherwise(F.col("_changed"))
    )
    return blocks.running_sum(first, series_cols, ts_col, {out: "_changed"}, **layout).select(
        *flagged.columns, out
    )


def missing_runs(
    df: DataFrame, column: str, ts_col: str, series_cols: Sequence[str] = (), **layout
) -> DataFrame:
    """Length and span of each run of rows whose column is null."""
    numbered = run_ids(
        df.select(*series_cols, ts_col, column), F.col(column).isNull(), ts_col, series_cols, **layout
    )
    return (
        numbered.filter("missing")
        .groupBy(*series_cols, "run_id")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min(ts_col).alias("first_ts"),
            F.max(ts_col).alias("last_ts"),
        )
    )


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-null count and type of each column, one pass."""
    types = dict(df.dtypes)
    counted = df.agg(*[F.count(c).alias(c) for c in columns])
    type_of = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    return counted.unpivot([], list(columns), "column_name", "non_null").withColumn(
        "data_type", type_of[F.col("column_name")]
    )
