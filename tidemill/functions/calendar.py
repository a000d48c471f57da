"""Calendar, holiday and daylight expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import utc_clock

# Civil twilight: the sun's centre this many degrees below the horizon.
CIVIL_DEPRESSION = 6.0


def _local(ts: str | Column, tz: str) -> Column:
    clock = utc_clock(ts)
    return clock if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), clock)


def time_of_day(ts: str | Column, tz: str = "UTC") -> Column:
    """night 0-5, morning 6-11, afternoon 12-17, evening 18-23 (UTC unless ``tz`` is given)."""
    hour = F.hour(_local(ts, tz))
    return (
        F.when(hour < 6, "night")
        .when(hour < 12, "morning")
        .when(hour < 18, "afternoon")
        .when(hour < 24, "evening")
    )


def season(ts: str | Column, tz: str = "UTC") -> Column:
    """Meteorological season of the month."""
    month = F.month(_local(ts, tz))
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.isin(3, 4, 5), "spring")
        .when(month.isin(6, 7, 8), "summer")
        .when(month.isin(9, 10, 11), "autumn")
    )


def is_weekend(ts: str | Column) -> Column:
    return F.weekday(utc_clock(ts)) >= 5


def date_parts(ts: str) -> dict[str, Column]:
    return {
        "date": F.to_date(utc_clock(ts)),
        "year": F.year(utc_clock(ts)),
        "month": F.month(utc_clock(ts)),
        "hour": F.hour(utc_clock(ts)),
        "weekday": F.weekday(utc_clock(ts)),
    }


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by the anonymous (Meeus/Jones/Butcher) computus."""

    def div(a: Column, b: int) -> Column:
        return F.floor(a / b).cast("int")

    golden = year % 19
    century, in_century = div(year, 100), year % 100
    leap_skips, century_rest = div(century, 4), century % 4
    moon_shift = div(century - div(century + 8, 25) + 1, 3)
    epact = (golden * 19 + century - leap_skips - moon_shift + 15) % 30
    leap, rest = div(in_century, 4), in_century % 4
    to_sunday = (century_rest * 2 + leap * 2 - epact - rest + 32) % 7
    late = div(golden + epact * 11 + to_sunday * 22, 451)
    days = epact + to_sunday - late * 7 + 114
    return F.make_date(year, div(days, 31), days % 31 + 1)


def _solar_terms(day: Column) -> tuple[Column, Column]:
    """Equation of time (minutes) and declination (radians) at UTC noon.

    The published NOAA solar calculator equations, with Julian centuries since J2000.
    """
    centuries = (F.datediff(day, F.lit("2000-01-01").cast("date")).cast("double")) / 36525.0
    mean_long = F.pmod(280.46646 + centuries * (36000.76983 + centuries * 0.0003032), F.lit(360.0))
    anomaly = F.radians(357.52911 + centuries * (35999.05029 - centuries * 0.0001537))
    eccentricity = 0.016708634 - centuries * (0.000042037 + centuries * 0.0000001267)
    centre = (
        F.sin(anomaly) * (1.914602 - centuries * (0.004817 + centuries * 0.000014))
        + F.sin(anomaly * 2) * (0.019993 - centuries * 0.000101)
        + F.sin(anomaly * 3) * 0.000289
    )
    node = F.radians(125.04 - centuries * 1934.136)
    apparent = F.radians(mean_long + centre - 0.00569 - F.sin(node) * 0.00478)
    tilt = F.radians(
        23.439291111
        - centuries * (0.0130041667 + centuries * (0.0000001639 - centuries * 0.0000005036))
        + F.cos(node) * 0.00256
    )
    declination = F.asin(F.sin(tilt) * F.sin(apparent))
    y = F.pow(F.tan(tilt / 2), F.lit(2.0))
    long_rad = F.radians(mean_long)
    equation = F.degrees(
        y * F.sin(long_rad * 2)
        - eccentricity * F.sin(anomaly) * 2
        + eccentricity * y * F.sin(anomaly) * F.cos(long_rad * 2) * 4
        - y * y * F.sin(long_rad * 4) * 0.5
        - eccentricity * eccentricity * F.sin(anomaly * 2) * 1.25
    ) * 4
    return equation, declination


def _twilight_minutes(day: Column, latitude: Column, longitude: Column, depression: float, sign: int) -> Column:
    equation, declination = _solar_terms(day)
    lat = F.radians(latitude)
    sun_height = F.sin(F.radians(F.lit(-float(depression))))
    cosine = F.try_divide(
        sun_height - F.sin(lat) * F.sin(declination), F.cos(lat) * F.cos(declination)
    )
    # No solution on polar days and nights: null.
    hour_angle = F.when(cosine.between(-1.0, 1.0), F.degrees(F.acos(cosine)))
    return F.lit(720.0) - longitude * 4 - equation + hour_angle * (4 * sign)


def _at_minutes(day: Column, minutes: Column) -> Column:
    seconds = F.round(minutes * 60).cast("int")
    return F.timestamp_add("SECOND", seconds, day.cast("timestamp_ntz"))


def dawn(day: Column, latitude: Column, longitude: Column, depression: float = CIVIL_DEPRESSION) -> Column:
    """UTC dawn of the date at the place, null when the sun never crosses the depression."""
    return _at_minutes(day, _twilight_minutes(day, latitude, longitude, depression, -1))


def dusk(day: Column, latitude: Column, longitude: Column, depression: float = CIVIL_DEPRESSION) -> Column:
    return _at_minutes(day, _twilight_minutes(day, latitude, longitude, depression, 1))


def daylight_flag(
    ts: str, latitude: Column, longitude: Column, depression: float = CIVIL_DEPRESSION
) -> Column:
    """``dawn <= ts <= dusk`` of the same UTC date; false where there is no dawn or dusk."""
    clock = utc_clock(ts)
    day = F.to_date(clock)
    inside = clock.between(
        dawn(day, latitude, longitude, depression), dusk(day, latitude, longitude, depression)
    )
    return F.coalesce(inside, F.lit(False))
