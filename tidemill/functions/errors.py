"""Forecast error aggregates. Pairs with a null on either side are skipped."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mse(actual: str, predicted: str) -> Column:
    return F.avg(F.pow(F.col(actual) - F.col(predicted), F.lit(2.0)))


def rmse(actual: str, predicted: str) -> Column:
    return F.sqrt(mse(actual, predicted))


def mae(actual: str, predicted: str) -> Column:
    return F.avg(F.abs(F.col(actual) - F.col(predicted)))


def mape(actual: str, predicted: str) -> Column:
    """Percentage; rows whose actual is zero have no percentage and are left out."""
    return F.avg(F.abs(F.try_divide(F.col(actual) - F.col(predicted), F.col(actual)))) * 100.0


def pairs(actual: str, predicted: str) -> Column:
    return F.count_if(F.col(actual).isNotNull() & F.col(predicted).isNotNull())


def zero_actuals(actual: str, predicted: str) -> Column:
    """Number of pairs that :func:`mape` leaves out."""
    return F.count_if((F.col(actual) == 0) & F.col(predicted).isNotNull())
