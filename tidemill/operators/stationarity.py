"""Unit-root and stationarity tests per series.

Rows with a null value are left out; the tests see the remaining values in time order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar
from ..models import gram
from . import arrays, blocks, profile

# MacKinnon (1994) response surface for the Dickey-Fuller t, constant only.
ADF_MIN, ADF_MAX, ADF_STAR = -18.83, 2.74, -1.61
ADF_SMALL_P = [2.1659, 1.4412, 0.038269]
ADF_LARGE_P = [1.7339, 0.93202, -0.12745, -0.010368]
# KPSS (1992) table 1, level stationarity: critical value and its p.
KPSS_TABLE = [(0.347, 0.10), (0.463, 0.05), (0.574, 0.025), (0.739, 0.01)]


def adf_p_value(statistic: float) -> float:
    if statistic > ADF_MAX:
        return 1.0
    if statistic < ADF_MIN:
        return 0.0
    surface = ADF_SMALL_P if statistic <= ADF_STAR else ADF_LARGE_P
    z = sum(c * statistic**i for i, c in enumerate(surface))
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def _adf_solve(stages, max_lag: int) -> tuple[float, float, int, int] | None:
    """Lag by AIC on the common sample, then the statistic on all rows that lag allows."""
    sums = {int(s["stage"]): gram.square(s["cells"]) for s in stages}
    full = sums.get(max_lag + 2)
    if max_lag < 0 or full is None:
        return None
    n, last = full[0, 0], full.shape[0] - 1
    scored = []
    for lag in range(max_lag + 1):
        cols = [*range(2 + lag), last]
        part = full[np.ix_(cols, cols)]
        loss = gram.loss_sum(part, gram.solve(part[:-1, :-1], part[:-1, -1]))
        if loss <= 0:
            return None
        scored.append((n * (math.log(loss / n) + math.log(2 * math.pi) + 1) + 2 * (2 + lag), lag))
    lag = min(scored)[1]
    cols = [*range(2 + lag), last]
    total = sum(m for stage, m in sums.items() if stage >= lag + 2)[np.ix_(cols, cols)]
    rows, width = total[0, 0], 2 + lag
    beta = gram.solve(total[:-1, :-1], total[:-1, -1])
    variance = gram.loss_sum(total, beta) / (rows - width)
    error = math.sqrt(variance * np.linalg.inv(total[:-1, :-1])[1, 1])
    statistic = float(beta[1] / error)
    return statistic, adf_p_value(statistic), lag, int(rows)


ADF_RESULT = T.StructType(
    [
        T.StructField("statistic", T.DoubleType()),
        T.StructField("p_value", T.DoubleType()),
        T.StructField("used_lag", T.LongType()),
        T.StructField("n_obs", T.LongType()),
    ]
)


@F.pandas_udf(ADF_RESULT)
def _adf_udf(stages: pd.Series, max_lags: pd.Series) -> pd.DataFrame:
    rows = [
        _adf_solve(s, int(m)) or (None, None, None, None) for s, m in zip(stages, max_lags, strict=True)
    ]
    return pd.DataFrame(rows, columns=["statistic", "p_value", "used_lag", "n_obs"])


def _max_lag(n: int) -> int:
    return int(min(n // 2 - 2, math.ceil(12.0 * (n / 100.0) ** 0.25)))


def adf(
    df: DataFrame, ts_col: str, column: str, series_cols: Sequence[str] = (), **layout
) -> DataFrame:
    """Augmented Dickey-Fuller test, constant only, lag chosen by AIC.

    All candidate regressions are nested and share one matrix of sums of products per
    series, so the rows are read once whatever the number of lags. A series too short for
    any regression has a row of nulls.
    """
    keys = list(series_cols)
    series = df.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    known = df.filter(F.col(column).isNotNull()).select(*keys, ts_col, F.col(column).cast("double").alias("_x"))
    whole = blocks.is_whole(layout)
    lookback = 1
    if not whole:
        # How many rows to copy between blocks: one number, the length of the longest series.
        longest = known.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        lookback = max(_max_lag(longest), 0) + 1
        stats = {"_n": F.count("_x"), "_mean": F.avg("_x"), "_sd": F.stddev_pop("_x")}
        known = profile.with_series_stats(known, keys, stats)

    def reduce_block(rows: pd.DataFrame, own: np.ndarray) -> pd.DataFrame:
        x = rows["_x"].to_numpy()
        n, mean, sd = (len(x), x.mean(), x.std()) if whole else rows[["_n", "_mean", "_sd"]].iloc[0]
        # The statistic does not change with location and scale; this keeps the sums well conditioned.
        x = (x - mean) / (sd if sd > 0 else 1.0)
        top = _max_lag(int(n))
        if top < 0 or len(x) < 2:
            return pd.DataFrame({"m": np.zeros(0, np.int64), "stage": np.zeros(0, np.int64), "cells": np.zeros(0, object)})
        steps = np.concatenate([np.zeros(top + 1), np.diff(x)])
        level = np.concatenate([[0.0], x[:-1]])
        at = np.arange(len(x))
        z = np.column_stack(
            [np.ones(len(x)), level, *[steps[at + top - j] for j in range(1, top + 1)], steps[at + top]]
        )
        position = rows["_position"].to_numpy()
        used = own & (position >= 2)
        stage = np.minimum(position, top + 2)
        # The rows before the common sample (fewer than the maximal lag) keep their own sums,
        # because a shorter lag lets some of them in.
        found = [
            (top, int(s), gram.triangle(z[used & (stage == s)].T @ z[used & (stage == s)]).tolist())
            for s in np.unique(stage[used])
        ]
        return pd.DataFrame(found, columns=["m", "stage", "cells"])

    partials = blocks.map_blocks(
        known, keys, ts_col, lookback, reduce_block, "m bigint, stage bigint, cells array<double>", **layout
    )
    sums = partials if whole else arrays.add_up(partials, [*keys, "m", "stage"], "cells")
    per_series = sums.groupBy(*keys, "m").agg(F.collect_list(F.struct("stage", "cells")).alias("stages"))
    tested = per_series.select(*keys, _adf_udf("stages", "m").alias("r"))
    found = series.join(tested, keys, "left") if keys else series.join(tested, how="left")
    return found.select(*keys, "r.*")


def _weighted(upto: Column, weight) -> Column:
    """Sum over lags 1..upto of weight(i) * products[i]."""
    terms = F.transform(
        F.slice("products", F.lit(2), F.greatest(upto, F.lit(0)).cast("int")),
        lambda p, i: p * weight(i + 1),
    )
    return F.aggregate(terms, F.lit(0.0), lambda s, v: s + v)


def kpss(
    df: DataFrame,
    ts_col: str,
    column: str,
    series_cols: Sequence[str] = (),
    first_lags: int = 60,
    **layout,
) -> DataFrame:
    """KPSS test of level stationarity; the lag follows Hobijn, Franses and Ooms (1998).

    One pass collects the autocovariances of the first ``first_lags`` lags and the squared
    running sums. The lag each series needs follows from them; only if some series needs
    more lags is the pass repeated with as many.
    """
    keys = list(series_cols)
    known = df.filter(F.col(column).isNotNull()).select(*keys, ts_col, F.col(column).cast("double").alias("_x"))
    n = F.col("n").cast("double")
    short = F.floor(F.pow(n, F.lit(2.0 / 9.0))).cast("bigint")

    def sums(lags: int) -> DataFrame:
        found = profile.lagged_products(known, ts_col, "_x", lags, keys, squares=True, **layout)
        return blocks.settle(found)

    def widest(found: DataFrame, wanted: Column) -> int:
        return int(found.agg(F.max(wanted)).first()[0] or 0)

    s0 = F.col("products")[0] / n + _weighted(short, lambda i: F.lit(1.0)) / (n / 2)
    s1 = _weighted(short, lambda i: i.cast("double")) / (n / 2)
    ratio = F.try_divide(s1, s0)
    gamma = F.pow(ratio * ratio, F.lit(1.0 / 3.0)) * 1.1447
    chosen = F.least(F.floor(gamma * F.pow(n, F.lit(1.0 / 3.0))).cast("bigint"), F.col("n") - 1)
    # A constant series has no variance to correct: lag 0, null statistic.
    used = F.when(ratio.isNotNull(), chosen).otherwise(F.lit(0))

    found = sums(first_lags)
    if widest(found, short) > first_lags:
        found = sums(widest(found, short))
    held = found.select(F.size("products")).first()
    if held is not None and widest(found, used) > held[0] - 1:
        found = sums(widest(found, used))
    lagged = found.withColumn("used_lag", used)
    long_run = F.col("products")[0] / n + _weighted(
        F.col("used_lag"), lambda i: (F.lit(1.0) - i / (F.col("used_lag") + 1)) * 2.0
    ) / n
    statistic = F.try_divide(F.col("squares") / (n * n), long_run)
    tested = lagged.select(*keys, statistic.alias("statistic"), "used_lag", F.col("n").alias("n_obs"))
    return tested.withColumn("p_value", kpss_p_value(F.col("statistic")))


def kpss_p_value(statistic: Column) -> Column:
    """Linear interpolation in the table, held at 0.10 and 0.01 outside it."""
    p = F.when(statistic <= KPSS_TABLE[0][0], F.lit(KPSS_TABLE[0][1]))
    for (low, p_low), (high, p_high) in zip(KPSS_TABLE, KPSS_TABLE[1:], strict=False):
        slope = (p_high - p_low) / (high - low)
        p = p.when(statistic <= high, (statistic - low) * slope + p_low)
    return p.when(statistic.isNotNull(), F.lit(KPSS_TABLE[-1][1]))


def adf_verdict(p_value: Column) -> Column:
    p = scalar.python_round(p_value, 3)
    return F.when(p <= 0.05, "Stationary").when(p > 0.05, "Non-stationary")


def kpss_verdict(p_value: Column) -> Column:
    p = scalar.python_round(p_value, 3)
    return F.when(p <= 0.05, "Non-stationary").when(p > 0.05, "Stationary")


def combined_reading(adf_text: Column, kpss_text: Column) -> Column:
    """Both tests together."""
    by_adf, by_kpss = adf_text == "Stationary", kpss_text == "Stationary"
    return (
        F.when(by_adf & by_kpss, "stationary")
        .when(by_adf & ~by_kpss, "difference-stationary")
        .when(~by_adf & by_kpss, "trend-stationary")
        .when(~by_adf & ~by_kpss, "non-stationary")
    )
