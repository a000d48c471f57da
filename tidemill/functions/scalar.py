"""Column-level helpers: text, null and arithmetic expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def remove_text(column: str | Column, text: str) -> Column:
    """Remove every occurrence of a literal text."""
    return F.replace(column if isinstance(column, Column) else F.col(column), F.lit(text), F.lit(""))


def words(column: str | Column) -> Column:
    """Whitespace-separated words; edge and repeated blanks give no empty word."""
    return F.array_remove(F.split(column, r"\s+"), "")


def run_ends(values: str) -> Column:
    """For a column of sorted arrays: the positions after which a run of equal values ends."""
    n = F.size(values)
    ends = lambda i: (i > 0) & ((i == n) | (F.get(values, i - 1) != F.get(values, i)))
    return F.filter(F.sequence(F.lit(0), n), ends)


def run_counts(values: str, ends: str) -> Column:
    """``value`` and ``n`` for each run of a column of sorted arrays, given its :func:`run_ends`."""
    begin = lambda j: F.coalesce(F.get(ends, j - 1), F.lit(0))
    return F.transform(ends, lambda i, j: F.struct(F.get(values, i - 1).alias("value"), (i - begin(j)).cast("long").alias("n")))


def contains_ignoring_case(column: str | Column, text: str) -> Column:
    """Case-insensitive substring test; null counts as no match."""
    found = F.lower(column).contains(text.lower())
    return F.coalesce(found, F.lit(False))


def is_filled(column: str | Column) -> Column:
    """Neither null nor the empty text."""
    c = F.col(column) if isinstance(column, str) else column
    return c.isNotNull() & (c != "")


def null_flag(column: str) -> Column:
    return F.col(column).isNull().cast("int")


def flag_as_int(flag: Column) -> Column:
    return flag.cast("int")


def row_sum(columns: Sequence[str]) -> Column:
    """Null-skipping sum across columns; 0 when all are null."""
    return reduce(lambda a, b: a + b, (F.coalesce(F.col(c), F.lit(0.0)) for c in columns))


def energy_balance(imported: str, produced: str, exported: str) -> Column:
    """``import + production - export``; null if any is null."""
    return F.col(imported) + F.col(produced) - F.col(exported)


def residual(actual: str, predicted: str) -> Column:
    return F.col(actual) - F.col(predicted)


def percentage(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100.0, whole)


def python_round(column: Column, digits: int) -> Column:
    """Round half to even."""
    return F.bround(column, digits)


def without_zone(column: str | Column) -> Column:
    """Drop the zone of a UTC timestamp, keeping the UTC wall clock."""
    c = F.col(column) if isinstance(column, str) else column
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(c.cast("timestamp")), epoch)


def utc_clock(column: str | Column) -> Column:
    """The UTC wall clock of a time: an instant is converted, a zone-free time is taken as it is."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(F.typeof(c) == "timestamp", without_zone(c)).otherwise(c.cast("timestamp_ntz"))


def parse_timestamp(column: str | Column) -> Column:
    """Text to a zone-free UTC timestamp: takes ``Z``, any offset, and bare forms (taken as UTC)."""
    c = F.col(column) if isinstance(column, str) else column
    zoned = c.rlike(r"\d:\d\d.*(Z|[+-]\d\d:?\d\d)$")
    instant = F.regexp_replace(c, r"([+-]\d\d)(\d\d)$", "$1:$2").cast("timestamp")
    return F.when(zoned, without_zone(instant)).otherwise(c.cast("timestamp_ntz"))
