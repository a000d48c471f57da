"""Holiday and twilight dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar
from ..functions.scalar import utc_clock

# Public holidays of Baden-Wuerttemberg, Germany.
# (name, month, day) on the same date every year.
BW_FIXED = [
    ("New Year", 1, 1),
    ("Epiphany", 1, 6),
    ("Labour Day", 5, 1),
    ("German Unity Day", 10, 3),
    ("All Saints", 11, 1),
    ("Christmas Day", 12, 25),
    ("Second Christmas Day", 12, 26),
]
# (name, days after Easter Sunday).
BW_EASTER = [
    ("Good Friday", -2),
    ("Easter Monday", 1),
    ("Ascension", 39),
    ("Whit Monday", 50),
    ("Corpus Christi", 60),
]
# (name, date) observed once.
BW_ONCE = [("Reformation Day", "2017-10-31")]


def holiday_dimension(
    years: DataFrame,
    fixed: Sequence[tuple[str, int, int]] = tuple(BW_FIXED),
    easter: Sequence[tuple[str, int]] = tuple(BW_EASTER),
    once: Sequence[tuple[str, str]] = tuple(BW_ONCE),
) -> DataFrame:
    """``(year, name, holiday)`` for a table with a ``year`` column of distinct years.

    One row per year becomes one row per holiday; size is years times holidays.
    """
    year = F.col("year").cast("int")
    rows = [
        F.struct(F.lit(name).alias("name"), F.make_date(year, F.lit(month), F.lit(day)).alias("holiday"))
        for name, month, day in fixed
    ]
    rows += [
        F.struct(
            F.lit(name).alias("name"),
            F.date_add(F.col("_easter"), days).alias("holiday"),
        )
        for name, days in easter
    ]
    rows += [
        F.struct(
            F.lit(name).alias("name"),
            F.when(year == int(date[:4]), F.lit(date).cast("date")).alias("holiday"),
        )
        for name, date in once
    ]
    return (
        years.select(year.alias("year"))
        .withColumn("_easter", calendar.easter_sunday(year))
        .select("year", F.explode(F.array(*rows)).alias("row"))
        .select("year", "row.name", "row.holiday")
        .filter(F.col("holiday").isNotNull())
    )


def years_of(df: DataFrame, ts_col: str) -> DataFrame:
    """The years from the first to the last row, one row each."""
    return df.agg(F.min(F.year(utc_clock(ts_col))).alias("a"), F.max(F.year(utc_clock(ts_col))).alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("year")
    )


def twilight_dimension(
    places_and_days: DataFrame,
    location_col: str,
    latitude: str = "latitude",
    longitude: str = "longitude",
    depression: float = calendar.CIVIL_DEPRESSION,
) -> DataFrame:
    """Dawn and dusk for each distinct ``(location, day)``; null on polar days and nights."""
    distinct = places_and_days.select(location_col, latitude, longitude, "day").distinct()
    day, lat, lon = F.col("day"), F.col(latitude), F.col(longitude)
    return distinct.select(
        location_col,
        "day",
        calendar.dawn(day, lat, lon, depression).alias("dawn"),
        calendar.dusk(day, lat, lon, depression).alias("dusk"),
    )
