"""Error tables per run and comparisons between runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import errors


def evaluation(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """MSE, RMSE, MAE and the number of pairs, one row per run."""
    return df.groupBy(*keys).agg(
        errors.mse(actual, predicted).alias("mse"),
        errors.rmse(actual, predicted).alias("rmse"),
        errors.mae(actual, predicted).alias("mae"),
        errors.pairs(actual, predicted).alias("n"),
    )


def compare_runs(log: DataFrame, runs: Sequence[str], metric: str, keys: Sequence[str] = ()) -> DataFrame:
    """One column per run with the metric's value at its last step."""
    chosen = log.filter(F.col("metric") == metric)
    return chosen.groupBy(*keys).pivot("run", list(runs)).agg(F.max_by("value", "step"))
