"""Lag features and sequence samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks


def lag_features(
    df: DataFrame,
    ts_col: str,
    target: str,
    lags: Sequence[int],
    series_cols: Sequence[str] = (),
    drop_incomplete: bool = True,
    **layout,
) -> DataFrame:
    """Add ``lag_k`` of the target, then drop rows with any null."""
    lagged = blocks.over_blocks(
        df,
        series_cols,
        ts_col,
        max(lags),
        lambda w: {f"lag_{k}": F.lag(target, k).over(w) for k in lags},
        **layout,
    )
    return lagged.dropna("any") if drop_incomplete else lagged


def lagged_split(
    df: DataFrame,
    ts_col: str,
    target: str,
    lags: Sequence[int],
    is_test: str,
    categorical: Sequence[str] = (),
    series_cols: Sequence[str] = (),
    **layout,
) -> DataFrame:
    """Lags of every measure over train and test together.

    Current measures are dropped except the target; the first test rows get their lags
    from the end of train; rows with nulls are dropped in train only.
    """
    fixed = {*series_cols, ts_col, is_test, *categorical}
    measures = sorted(c for c in df.columns if c not in fixed)
    lagged = blocks.over_blocks(
        df,
        series_cols,
        ts_col,
        max(lags),
        lambda w: {f"{c}_lag_{k}": F.lag(c, k).over(w) for c in measures for k in lags},
        **layout,
    )
    names = [f"{c}_lag_{k}" for c in measures for k in lags]
    kept = lagged.select(*series_cols, ts_col, is_test, *categorical, target, *names)
    complete = ~_any_null([*categorical, target, *names])
    return kept.filter(F.col(is_test) | complete)


def _any_null(columns: Sequence[str]) -> Column:
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return missing


def sequences(
    df: DataFrame,
    ts_col: str,
    target: str,
    features: Sequence[str],
    future: Sequence[str],
    k: int,
    series_cols: Sequence[str] = (),
    keep: Sequence[str] = (),
    **layout,
) -> DataFrame:
    """Samples of ``k`` past rows of ``features``, one row of ``future`` and the label.

    ``past`` is oldest first, nulls kept in place. A sample belongs to the split of its
    target row, so carry the split flag in ``keep``.
    """

    def past(w) -> Column:
        rows = [F.array(*[F.lag(c, back).over(w) for c in features]) for back in range(k, 0, -1)]
        return F.array(*rows)

    built = blocks.over_blocks(
        df, series_cols, ts_col, k, lambda w: {"past": past(w)}, position_col="_position", **layout
    )
    return built.filter(F.col("_position") > k).select(
        *series_cols,
        ts_col,
        *keep,
        "past",
        F.array(*[F.col(c).cast("double") for c in future]).alias("future"),
        F.col(target).alias("label"),
    )


def first_rows(
    df: DataFrame, ts_col: str, n: int, series_cols: Sequence[str] = (), order_cols: Sequence[str] = ()
) -> DataFrame:
    """The first n rows by time, of the table or of each series."""
    return _edge(df, ts_col, n, series_cols, order_cols, True)


def last_rows(
    df: DataFrame, ts_col: str, n: int, series_cols: Sequence[str] = (), order_cols: Sequence[str] = ()
) -> DataFrame:
    """The last n rows by time, of the table or of each series."""
    return _edge(df, ts_col, n, series_cols, order_cols, False)


def _edge(df, ts_col, n, series_cols, order_cols, ascending: bool) -> DataFrame:
    order = [F.asc(c) if ascending else F.desc(c) for c in (ts_col, *order_cols)]
    if not series_cols:
        return df.orderBy(*order).limit(n)
    from pyspark.sql import Window

    # The rank filter is pushed below the shuffle (WindowGroupLimit): a task sends at
    # most n rows per series, whatever the length of the series.
    window = Window.partitionBy(*series_cols).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def slice_rows(
    df: DataFrame,
    ts_col: str,
    series_cols: Sequence[str] = (),
    skip_first: int = 0,
    skip_last: int = 0,
    **layout,
) -> DataFrame:
    """Drop the first and the last rows of each series by position."""
    placed = blocks.with_position(df, series_cols, ts_col, "_position", **layout)
    chosen = placed.filter(F.col("_position") > skip_first)
    if skip_last:
        if series_cols:
            sizes = df.groupBy(*series_cols).agg(F.count(F.lit(1)).alias("_rows"))
            chosen = chosen.join(sizes, list(series_cols))
        else:
            chosen = chosen.withColumn("_rows", df.agg(F.count(F.lit(1))).scalar())
        chosen = chosen.filter(F.col("_position") <= F.col("_rows") - skip_last)
    return chosen.select(*df.columns)
