"""One-hot encoding fitted on training rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Categorical columns by resolution.
CATEGORICAL = {
    "daily": ["is_holiday_or_weekend", "season"],
    "hourly": ["daylight_flag", "time_of_day", "is_holiday_or_weekend", "season"],
}


def as_category(df: DataFrame, column: str) -> Column:
    """Text of the category; booleans are written True and False."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, T.BooleanType):
        return F.when(c, "True").when(~c, "False")
    return c.cast("string")


@dataclass(frozen=True)
class OneHot:
    """Categories seen in training; the first of each column (in text order) is dropped."""

    categories: Mapping[str, Sequence[str]]

    @property
    def names(self) -> list[str]:
        return [f"{c}_{v}" for c, values in self.categories.items() for v in values[1:]]

    def apply(self, df: DataFrame) -> DataFrame:
        """Replace the categorical columns; unknown or null values become all zeros."""
        passed = [c for c in df.columns if c not in self.categories]
        encoded = [
            F.when(as_category(df, c) == v, F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{c}_{v}")
            for c, values in self.categories.items()
            for v in values[1:]
        ]
        return df.select(*passed, *encoded)


def fit_one_hot(train: DataFrame, columns: Sequence[str], max_categories: int | None = None) -> OneHot:
    """Find the categories in one job. Every category becomes a column; a caller who wants no
    more than ``max_categories`` for any one column gets an error beyond, not a truncation."""
    long = train.select(*[as_category(train, c).alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "category"
    )
    found = long.filter(F.col("category").isNotNull()).distinct().collect()
    categories = {c: sorted(r.category for r in found if r.column_name == c) for c in columns}
    if max_categories is not None and any(len(v) > max_categories for v in categories.values()):
        raise ValueError(f"more than {max_categories} categories in one of {list(columns)}")
    return OneHot(categories)


def encode_for_additive(
    df: DataFrame,
    encoder: OneHot,
    ts_col: str,
    target: str,
    series_cols: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(ds, y, encoded columns)`` only: measures and weather are dropped."""
    encoded = encoder.apply(df.select(*series_cols, ts_col, target, *keep, *encoder.categories))
    return encoded.withColumnsRenamed({ts_col: "ds", target: "y"}).withColumn(
        "ds", F.col("ds").cast("timestamp_ntz")
    )
