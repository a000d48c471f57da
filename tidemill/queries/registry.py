"""The registered queries: a Spark function and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship


@dataclass(frozen=True)
class Tables:
    """The tables of one folder; nothing is read but the columns a query uses."""

    spark: SparkSession
    folder: str

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(ship(spark), folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def big(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")
