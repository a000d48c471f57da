"""Selecting, dropping and renaming columns by name."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _select(df: DataFrame, keys: Sequence[str], chosen: Sequence[str]) -> DataFrame:
    return df.select(*keys, *[c for c in chosen if c not in keys])


def select_matching(df: DataFrame, pattern: str, keys: Sequence[str] = ()) -> DataFrame:
    """Keys plus the columns whose name matches the regular expression somewhere."""
    return _select(df, keys, [c for c in df.columns if re.search(pattern, c)])


def select_prefix(df: DataFrame, prefix: str, keys: Sequence[str] = ()) -> DataFrame:
    return _select(df, keys, [c for c in df.columns if c.startswith(prefix)])


def select_containing(df: DataFrame, text: str, keys: Sequence[str] = ()) -> DataFrame:
    return _select(df, keys, [c for c in df.columns if text in c])


def names_without(columns: Sequence[str], texts: Sequence[str]) -> list[str]:
    """Names that contain none of the texts."""
    return [c for c in columns if not any(t in c for t in texts)]


def select_without(df: DataFrame, texts: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    return _select(df, keys, names_without(df.columns, texts))


def drop_prefix_or_word(df: DataFrame, prefix: str, word: str) -> DataFrame:
    """Drop columns that start with ``prefix`` or contain ``word`` in any case."""
    return df.drop(
        *[c for c in df.columns if c.startswith(prefix) or word.lower() in c.lower()]
    )


def remove_from_names(df: DataFrame, text: str) -> DataFrame:
    """Remove every occurrence of a literal text from all column names."""
    return df.toDF(*[c.replace(text, "") for c in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def with_target(df: DataFrame, source: str, target: str = "energy_demand") -> DataFrame:
    """Add the target as a copy of another column."""
    return df.withColumn(target, F.col(source))


def target_first(df: DataFrame, target: str, keys: Sequence[str] = ()) -> DataFrame:
    rest = [c for c in df.columns if c != target and c not in keys]
    return df.select(*keys, target, *rest)


def regressor_names(columns: Sequence[str], excluded: Sequence[str] = ("ds", "y")) -> list[str]:
    """All names but the excluded ones, sorted."""
    return sorted(set(columns) - set(excluded))


def to_long(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    name_col: str = "series",
    value_col: str = "value",
) -> DataFrame:
    """One row per key and column."""
    return df.unpivot(list(keys), list(columns), name_col, value_col)


def event_rows(df: DataFrame, ts_col: str, names: Column, name_col: str = "feature") -> DataFrame:
    """One ``(date, name)`` row per element of an array column."""
    return df.select(F.col(ts_col).alias("date"), F.explode(names).alias(name_col))
