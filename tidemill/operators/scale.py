"""Min-max scaling fitted on training rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MinMax:
    """Lazy fit: ``stats`` holds one row of minima and maxima per series (or one in all)."""

    columns: tuple[str, ...]
    series_cols: tuple[str, ...]
    stats: DataFrame

    def _with_stats(self, df: DataFrame) -> DataFrame:
        if self.series_cols:
            return df.join(self.stats, list(self.series_cols), "left")
        # One row: an uncorrelated scalar subquery, evaluated once.
        packed = self.stats.select(F.struct("*").alias("s")).scalar()
        return df.withColumn("_fit", packed).select(*df.columns, "_fit.*")

    @staticmethod
    def _range(c: str) -> Column:
        """Zero range counts as 1, so a constant column maps to 0."""
        span = F.col(f"_max_{c}") - F.col(f"_min_{c}")
        return F.when(span == 0, F.lit(1.0)).otherwise(span)

    def apply(self, df: DataFrame) -> DataFrame:
        """Scale in place; values outside the training range leave [0, 1], nulls stay null."""
        scaled = {
            c: ((F.col(c) - F.col(f"_min_{c}")) / self._range(c)).alias(c) for c in self.columns
        }
        return self._with_stats(df).select(*[scaled.get(c, F.col(c)) for c in df.columns])

    def invert(self, df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
        """Bring ``columns``, given in the scale of ``target``, back to its units."""
        restored = {
            c: (F.col(c) * self._range(target) + F.col(f"_min_{target}")).alias(c) for c in columns
        }
        return self._with_stats(df).select(*[restored.get(c, F.col(c)) for c in df.columns])

    def stretch(self, df: DataFrame, target: str, powers: dict[str, int]) -> DataFrame:
        """Bring differences in the scale of ``target`` (power 1), or their squares (2), to its units."""
        restored = {c: (F.col(c) * F.pow(self._range(target), F.lit(float(k)))).alias(c) for c, k in powers.items()}
        return self._with_stats(df).select(*[restored.get(c, F.col(c)) for c in df.columns])


def fit_min_max(train: DataFrame, columns: Sequence[str], series_cols: Sequence[str] = ()) -> MinMax:
    """Minimum and maximum of each column, one aggregation."""
    stats = train.groupBy(*series_cols).agg(
        *[
            e
            for c in columns
            for e in (
                F.min(c).cast("double").alias(f"_min_{c}"),
                F.max(c).cast("double").alias(f"_max_{c}"),
            )
        ]
    )
    return MinMax(tuple(columns), tuple(series_cols), stats)


def design(df: DataFrame, label: str, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Label and one array of features per row."""
    return df.select(
        *keys,
        F.col(label).cast("double").alias("label"),
        F.array(*[F.col(c).cast("double") for c in features]).alias("features"),
    )
