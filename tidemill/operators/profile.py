"""Correlations, histograms and autocorrelations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import arrays, blocks


def safe_corr(a: str, b: str) -> Column:
    """Pearson correlation over rows where both are present; null for a constant column."""
    both_a = F.when(F.col(b).isNotNull(), F.col(a))
    both_b = F.when(F.col(a).isNotNull(), F.col(b))
    return F.try_divide(F.covar_pop(both_a, both_b), F.stddev_pop(both_a) * F.stddev_pop(both_b))


def correlation_matrix(
    df: DataFrame, columns: Sequence[str], series_cols: Sequence[str] = ()
) -> DataFrame:
    """Long form ``(column_a, column_b, corr)``, both triangles and the diagonal.

    One aggregation holds all pairs of columns; the symmetric half is filled in after it.
    """
    pairs = list(combinations(columns, 2))
    stats = df.groupBy(*series_cols).agg(
        *[safe_corr(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)],
        *[F.stddev_pop(c).alias(f"_s{i}") for i, c in enumerate(columns)],
    )

    def cell(a: str, b: str, value: Column) -> Column:
        return F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), value.alias("corr"))

    cells = [cell(c, c, F.when(F.col(f"_s{i}") > 0, F.lit(1.0))) for i, c in enumerate(columns)]
    for i, (a, b) in enumerate(pairs):
        cells += [cell(a, b, F.col(f"_c{i}")), cell(b, a, F.col(f"_c{i}"))]
    return stats.select(*series_cols, F.explode(F.array(*cells)).alias("cell")).select(
        *series_cols, "cell.*"
    )


def correlation_with(
    df: DataFrame, columns: Sequence[str], target: str, series_cols: Sequence[str] = ()
) -> DataFrame:
    """Correlation of each other column with the target, with its rank by absolute value."""
    others = [c for c in columns if c != target]
    stats = df.groupBy(*series_cols).agg(*[safe_corr(c, target).alias(c) for c in others])
    long = stats.unpivot(list(series_cols), others, "column_name", "corr")
    order = Window.partitionBy(*(series_cols or [F.lit(0)])).orderBy(
        F.desc_nulls_last(F.abs("corr")), "column_name"
    )
    return long.withColumn("rank", F.row_number().over(order).cast("bigint"))


def _bins(bins: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))


def histogram(
    df: DataFrame, columns: Sequence[str], bins: int = 15, series_cols: Sequence[str] = ()
) -> DataFrame:
    """Equal-width histogram of every column, empty bins included.

    The last bin is closed on the right; a constant column is widened by one half each way.
    Two passes: the ranges first, then the counts, combined before their shuffle.
    """
    keys = [*series_cols, "column_name"]
    aggs = [e for c in columns for e in (F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}"))]
    # The ranges, one row per series, are needed by the binning and by the empty bins.
    found = blocks.settle(df.groupBy(*series_cols).agg(*aggs))
    if series_cols:
        ranged = df.join(found, list(series_cols))
    else:
        packed = found.select(F.struct("*")).scalar()
        ranged = df.withColumn("_range", packed).select("*", "_range.*")

    def low(c: str) -> Column:
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        return F.when(lo == hi, lo - 0.5).otherwise(lo).cast("double")

    def high(c: str) -> Column:
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        return F.when(lo == hi, hi + 0.5).otherwise(hi).cast("double")

    def bin_of(c: str) -> Column:
        raw = F.floor((F.col(c) - low(c)) / (high(c) - low(c)) * bins)
        return F.when(raw.isNotNull(), F.least(raw, F.lit(bins - 1))).cast("bigint")

    counted = (
        ranged.select(*series_cols, *[bin_of(c).alias(c) for c in columns])
        .unpivot(list(series_cols), list(columns), "column_name", "bin")
        .filter(F.col("bin").isNotNull())
        .groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    edges = [
        F.struct(F.lit(c).alias("column_name"), low(c).alias("lo"), high(c).alias("hi")) for c in columns
    ]
    spine = (
        found.select(*series_cols, F.explode(F.array(*edges)).alias("e"))
        .select(*series_cols, "e.*", F.explode(_bins(bins)).alias("bin"))
        .filter(F.col("lo").isNotNull())
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return spine.join(counted, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("lo") + width * F.col("bin")).alias("bin_start"),
        (F.col("lo") + width * (F.col("bin") + 1)).alias("bin_end"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )


def with_series_stats(
    df: DataFrame, series_cols: Sequence[str], stats: dict[str, Column]
) -> DataFrame:
    """Add aggregates of each series to its rows by joining a small table of them."""
    if series_cols:
        small = df.groupBy(*series_cols).agg(*[e.alias(n) for n, e in stats.items()])
        return df.join(small, list(series_cols))
    packed = df.agg(F.struct(*[e.alias(n) for n, e in stats.items()])).scalar()
    return df.withColumn("_stats", packed).select(*df.columns, "_stats.*")


def lagged_products(
    df: DataFrame, ts_col: str, column: str, max_lag: int, series_cols: Sequence[str] = (), squares: bool = False, **layout
) -> DataFrame:
    """Per series: ``n``, and ``products``: sum(z_t * z_(t-k)) for k = 0..max_lag, z = centred value.

    ``squares`` adds the sum of the squared running sums of z. Each block is reduced to one
    short array by vector products, and the arrays are added up; a pair with a null counts
    as nothing.
    """
    keys = list(series_cols)
    rows = df.select(*keys, ts_col, F.col(column).cast("double").alias("_x"))
    whole = blocks.is_whole(layout)
    if not whole:
        rows = with_series_stats(rows, keys, {"_mean": F.avg("_x")})
        if squares:
            rows = rows.withColumn("_z", F.col("_x") - F.col("_mean"))
            rows = blocks.settle(blocks.running_sum(rows, keys, ts_col, {"_running": "_z"}, **layout))

    def reduce_block(part: pd.DataFrame, own: np.ndarray) -> pd.DataFrame:
        x = part["_x"].to_numpy(dtype=float)
        known = own & ~np.isnan(x)
        z = x - (np.nanmean(x) if known.any() else 0.0) if whole else x - part["_mean"].to_numpy(dtype=float)
        z = np.nan_to_num(z)
        mine = np.where(own, z, 0.0)
        sums = [float(mine[k:] @ z[: len(z) - k]) if k < len(z) else 0.0 for k in range(max_lag + 1)]
        total = 0.0
        if squares:
            running = np.cumsum(z) if whole else np.where(own, part["_running"].to_numpy(dtype=float), 0.0)
            total = float(np.nansum(running * running))
        return pd.DataFrame({"cells": [[float(known.sum()), total, *sums]]})

    partials = blocks.map_blocks(rows, keys, ts_col, max(max_lag, 1), reduce_block, "cells array<double>", **layout)
    summed = partials if whole else arrays.add_up(partials, keys, "cells")
    extra = [F.col("cells")[1].alias("squares")] if squares else []
    return summed.select(
        *keys,
        F.col("cells")[0].cast("bigint").alias("n"),
        F.slice("cells", 3, max_lag + 1).alias("products"),
        *extra,
    )


def acf_arrays(
    df: DataFrame, ts_col: str, column: str, max_lag: int = 100, series_cols: Sequence[str] = (), **layout
) -> DataFrame:
    """Per series: ``n`` and the biased autocorrelations of lags 0 to ``max_lag``."""
    sums = lagged_products(df, ts_col, column, max_lag, series_cols, **layout)
    scaled = F.transform("products", lambda p: F.try_divide(p, F.col("products")[0]))
    return sums.select(*series_cols, "n", scaled.alias("r"))


def acf(
    df: DataFrame, ts_col: str, column: str, max_lag: int = 100, series_cols: Sequence[str] = (), **layout
) -> DataFrame:
    """``(lag, acf, bound)``: bound is the 5% half-width by Bartlett's formula."""
    arrays = acf_arrays(df, ts_col, column, max_lag, series_cols, **layout)
    rows = arrays.select(*series_cols, "n", F.posexplode("r").alias("lag", "acf"))
    # At most max_lag + 1 rows per series reach this window.
    earlier = (
        Window.partitionBy(*(series_cols or [F.lit(0)])).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    )
    squares = F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(earlier)
    variance = (F.lit(1.0) + F.coalesce(squares, F.lit(0.0)) * 2) / F.col("n")
    bound = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(F.sqrt(variance) * 1.959963984540054)
    return rows.select(*series_cols, F.col("lag").cast("bigint").alias("lag"), "acf", bound.alias("bound"))


def pacf(
    df: DataFrame, ts_col: str, column: str, max_lag: int = 100, series_cols: Sequence[str] = (), **layout
) -> DataFrame:
    """``(lag, pacf, bound)`` by the Yule-Walker equations on the biased autocorrelations.

    The Durbin-Levinson recursion folds over the one array each series is reduced to.
    """
    arrays = acf_arrays(df, ts_col, column, max_lag, series_cols, **layout)
    fold = """
        aggregate(
          sequence(1, {K}),
          named_struct('phi', cast(array() as array<double>), 'out', array(cast(1.0 as double))),
          (s, k) -> transform(array(
              try_divide(
                r[k] - aggregate(sequence(1, k), cast(0.0 as double),
                                 (t, j) -> t + if(j < k, s.phi[j - 1] * r[k - j], 0.0)),
                1.0 - aggregate(sequence(1, k), cast(0.0 as double),
                                (t, j) -> t + if(j < k, s.phi[j - 1] * r[j], 0.0)))),
            p -> named_struct(
              'phi', concat(transform(s.phi, (f, i) -> f - p * s.phi[k - 2 - i]), array(p)),
              'out', concat(s.out, array(p))))[0],
          s -> s.out)
    """.format(K=max_lag)
    rows = arrays.select(*series_cols, "n", F.posexplode(F.expr(fold)).alias("lag", "pacf"))
    bound = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(F.lit(1.959963984540054) / F.sqrt("n"))
    return rows.select(*series_cols, F.col("lag").cast("bigint").alias("lag"), "pacf", bound.alias("bound"))
