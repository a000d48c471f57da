"""Time-series views over the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import blocks, resample
from .registry import Tables

TYPES = ["click", "error", "purchase", "signup", "view"]
TEST_YEAR = 2001

# How the views are cut for window functions.
# Raw events: a series, and a moment of it, can be of any length.
RAW: dict = {}
# One table-wide series on a calendar: cut as well, so that no task gets the whole table.
ONE_SERIES = {"chunk": "year"}
# Many series, one row per day each: 36,525 rows per century, a plain window per series.
DAILY = {"block_rows": None}


def hourly_wide(t: Tables) -> DataFrame:
    """V1: one row per hour, one column per event type, nulls where nothing happened."""
    hour = blocks.truncate("hour", "ts").alias("ts")
    return t("events").groupBy(hour).pivot("event_type", TYPES).agg(F.sum("value"))


def meter_cum(t: Tables) -> DataFrame:
    """V2: running total of the value per event type, one row per event."""
    narrow = t("events").select("event_type", "ts", "event_id", "value")
    return blocks.running_sum(
        narrow, ["event_type"], "ts", {"value_cum": "value"}, ["event_id"], chunk="hour"
    ).drop("value")


def daily_orders(t: Tables) -> DataFrame:
    """V3: revenue and number of orders per day."""
    day = blocks.truncate("day", "o_orderdate").alias("day")
    return t("orders").groupBy(day).agg(
        F.sum("o_totalprice").alias("revenue"), F.count(F.lit(1)).alias("n_orders")
    )


def daily_ship(t: Tables) -> DataFrame:
    """V4: shipped quantity and mean discount per day."""
    day = blocks.truncate("day", "l_shipdate").alias("day")
    return t("lineitem").groupBy(day).agg(
        F.sum("l_quantity").alias("quantity"), F.avg("l_discount").alias("avg_discount")
    )


def segment_daily(t: Tables) -> DataFrame:
    """V5: revenue and number of orders per market segment and day.

    The join is left to Spark's sizes; a hot customer key is split by the adaptive skew
    join, and the aggregation combines before its shuffle.
    """
    orders = t("orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customers = t("customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    day = blocks.truncate("day", "o_orderdate").alias("day")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("segment", day)
        .agg(F.sum("o_totalprice").alias("revenue"), F.count(F.lit(1)).alias("n_orders"))
    )


def segment_dense(t: Tables) -> DataFrame:
    """V5 on a dense daily calendar per segment, revenue only."""
    return resample.fill_calendar(segment_daily(t), "day", ["revenue"], ["segment"], block_rows=None)


def predictions(t: Tables) -> DataFrame:
    """V6: the dense daily revenue with the value a week before as its prediction.

    p10 and p90 are the prediction -/+ 1.2816 residual standard deviations of the segment.
    """
    paired = blocks.over_blocks(
        segment_dense(t),
        ["segment"],
        "day",
        7,
        lambda w: {"prediction": F.lag("revenue", 7).over(w)},
        **DAILY,
    ).filter(F.col("revenue").isNotNull() & F.col("prediction").isNotNull())
    # The rows are already partitioned by segment, a day each: no further shuffle.
    whole = Window.partitionBy("segment")
    sigma = F.stddev_pop(F.col("revenue") - F.col("prediction")).over(whole)
    reach = F.col("_sigma") * 1.2815515655446004
    return paired.withColumn("_sigma", sigma).select(
        "segment",
        "day",
        F.col("revenue").alias("actual"),
        "prediction",
        (F.col("prediction") - reach).alias("p10"),
        (F.col("prediction") + reach).alias("p90"),
    )


# --- the same views in SQL -------------------------------------------------------------

SQL_VIEWS = {
    "hourly_wide": "SELECT date_trunc('hour', ts)::TIMESTAMP AS ts, "
    + ", ".join(f"sum(value) FILTER (event_type = '{e}') AS \"{e}\"" for e in TYPES)
    + " FROM events GROUP BY 1",
    "meter_cum": """SELECT event_type, ts, event_id, sum(value) OVER (PARTITION BY event_type
        ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value_cum FROM events""",
    "daily_orders": """SELECT date_trunc('day', o_orderdate)::TIMESTAMP AS day,
        sum(o_totalprice) AS revenue, count(*) AS n_orders FROM orders GROUP BY 1""",
    "daily_ship": """SELECT date_trunc('day', l_shipdate)::TIMESTAMP AS day,
        sum(l_quantity) AS quantity, avg(l_discount) AS avg_discount FROM lineitem GROUP BY 1""",
    "segment_daily": """SELECT c_mktsegment AS segment, date_trunc('day', o_orderdate)::TIMESTAMP AS day,
        sum(o_totalprice) AS revenue, count(*) AS n_orders
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
    "segment_dense": """SELECT s.segment, s.day, d.revenue FROM
        (SELECT segment, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day
         FROM segment_daily GROUP BY segment) s
        LEFT JOIN segment_daily d ON s.segment = d.segment AND s.day = d.day""",
    "predictions": """SELECT segment, day, actual, prediction,
          prediction - 1.2815515655446004 * sigma AS p10, prediction + 1.2815515655446004 * sigma AS p90
        FROM (SELECT *, stddev_pop(actual - prediction) OVER (PARTITION BY segment) AS sigma FROM
          (SELECT segment, day, revenue AS actual,
                  lag(revenue, 7) OVER (PARTITION BY segment ORDER BY day) AS prediction FROM segment_dense)
          WHERE actual IS NOT NULL AND prediction IS NOT NULL)""",
}
SQL_NEEDS = {"segment_dense": ["segment_daily"], "predictions": ["segment_daily", "segment_dense"]}


def with_views(body: str, *names: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """``body`` preceded by the named views and any extra common table expressions."""
    ordered: list[str] = []
    for name in names:
        for needed in [*SQL_NEEDS.get(name, []), name]:
            if needed not in ordered:
                ordered.append(needed)
    parts = [f"{n} AS ({SQL_VIEWS[n]})" for n in ordered]
    parts += [f"{n} AS ({q})" for n, q in (extra or {}).items()]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ", ".join(parts) + " " if parts else "") + body
