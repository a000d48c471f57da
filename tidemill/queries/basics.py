"""Sources, projections, filters, joins, ordering, set operations, scalars, dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar, scalar
from ..operators import blocks, columns, dimensions, joins, lags, quality, resample
from ..session import scratch_path, write_settled
from ..sources import sinks, tables
from . import views
from .registry import Tables, big, query, rounded
from .views import DAILY, ONE_SERIES, TEST_YEAR, TYPES, with_views

METERS = ", ".join(f"round({e}, 4) AS {e}" for e in TYPES)

# --- sources and sinks -----------------------------------------------------------------


@query("s1_read_timeseries", with_views(f"SELECT ts, {METERS} FROM hourly_wide", "hourly_wide"))
def s1(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "s1")
    zoned = views.hourly_wide(t).withColumn("ts", F.concat(F.col("ts").cast("string"), F.lit("Z")))
    tables.write_table(zoned, path, "csv")
    return rounded(tables.read_timeseries(t.spark, path, ["ts", *TYPES], "ts"), 4, *TYPES)


@query(
    "s1_quarantine",
    """SELECT CASE WHEN p IS NULL THEN o_orderkey END AS key, CASE WHEN p IS NULL THEN CAST(o_orderdate AS TIMESTAMP) END AS ts,
         CASE WHEN p IS NULL THEN round(o_totalprice, 2) END AS price, p AS problem,
         CASE p WHEN 'record' THEN o_orderkey || CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE ',2000-01-01T00:00:00Z,n/a' END WHEN 'time' THEN 'soon' END AS rejected
       FROM (SELECT *, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 'record' WHEN o_orderkey % 13 = 0 THEN 'time' END AS p FROM orders)""",
)
def s1_quarantine(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "s1q")
    key, time = F.col("o_orderkey").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd'T00:00:00Z'")
    line = (
        F.when(F.col("o_orderkey") % 7 == 0, key)
        .when(F.col("o_orderkey") % 11 == 0, F.concat(key, F.lit(",2000-01-01T00:00:00Z,n/a")))
        .when(F.col("o_orderkey") % 13 == 0, F.concat(key, F.lit(",soon,"), F.round("o_totalprice", 2).cast("string")))
        .otherwise(F.concat_ws(",", key, time, F.round("o_totalprice", 2).cast("string")))
    )
    t("orders").select(line.alias("value")).write.text(path)
    found = tables.read_checked(t.spark, path, ["key", "ts", "price"], "ts", {"key": "bigint"}, header=False)
    return found.withColumn("price", F.round("price", 2))


@query(
    "s2_read_cast_time",
    with_views("SELECT day, round(revenue, 4) AS revenue, n_orders FROM daily_orders", "daily_orders"),
)
def s2(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "s2")
    text = views.daily_orders(t).withColumn("day", F.concat(F.col("day").cast("string"), F.lit("+00:00")))
    tables.write_table(text, path, "csv")
    timed = tables.cast_time(tables.read_text_table(t.spark, path), "day")
    return timed.select(
        "day", F.round(F.col("revenue").cast("double"), 4).alias("revenue"), big("n_orders").alias("n_orders")
    )


@query(
    "s3_write_merged",
    with_views(
        """SELECT 'daily' AS resolution, count(*) AS n, round(sum(revenue), 2) AS total
             FROM daily_orders LEFT JOIN daily_ship USING (day)
           UNION ALL SELECT 'hourly', count(*), round(sum(click), 2) FROM hourly_wide""",
        "hourly_wide",
        "daily_orders",
        "daily_ship",
    ),
)
def s3(t: Tables) -> DataFrame:
    daily = joins.left_join_on_time(views.daily_orders(t), views.daily_ship(t), "day")
    root = scratch_path(t.spark, "s3")
    written = {
        "daily": (tables.write_table(daily, f"{root}/daily"), "revenue"),
        "hourly": (tables.write_table(views.hourly_wide(t), f"{root}/hourly"), "click"),
    }
    parts = [
        t.spark.read.parquet(path)
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(column), 2).alias("total"))
        .select(F.lit(name).alias("resolution"), "n", "total")
        for name, (path, column) in written.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "s4_write_splits",
    with_views(
        """SELECT 'daily' AS resolution, CASE WHEN year(day) = 2001 THEN 'test' ELSE 'train' END AS split,
                  count(*) AS n, round(sum(revenue), 2) AS total FROM daily_orders GROUP BY 1, 2
           UNION ALL
           SELECT 'hourly', CASE WHEN ts >= '2024-01-25' THEN 'test' ELSE 'train' END,
                  count(*), round(sum(click), 2) FROM hourly_wide GROUP BY 1, 2""",
        "daily_orders",
        "hourly_wide",
    ),
)
def s4(t: Tables) -> DataFrame:
    daily, hourly = views.daily_orders(t), views.hourly_wide(t)
    root = scratch_path(t.spark, "s4")
    tables.write_splits(daily, f"{root}/daily", quality.in_test_year(daily, "day", TEST_YEAR))
    tables.write_splits(
        hourly, f"{root}/hourly", F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz")
    )

    def totals(resolution: str, column: str) -> DataFrame:
        return (
            t.spark.read.parquet(f"{root}/{resolution}")
            .groupBy(F.lit(resolution).alias("resolution"), "split")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(column), 2).alias("total"))
        )

    return totals("daily", "revenue").unionByName(totals("hourly", "click"))


@query(
    "s4_staged_splits",
    with_views(
        """SELECT CASE WHEN year(day) = 2001 THEN 'test' ELSE 'train' END AS split, count(*) AS n, round(sum(revenue), 2) AS total
           FROM daily_orders GROUP BY 1""",
        "daily_orders",
    ),
)
def s4_staged(t: Tables) -> DataFrame:
    """The splits written, written again, and made anew from what they hold: one copy at the end."""
    daily = views.daily_orders(t)
    path = f"{scratch_path(t.spark, 's4s')}/daily"
    labelled = daily.withColumn("split", F.when(quality.in_test_year(daily, "day", TEST_YEAR), "test").otherwise("train"))
    for _ in range(2):
        sinks.write_staged(labelled, path, partition_by=["split"])
    sinks.write_staged(t.spark.read.parquet(path), path, partition_by=["split"])
    found = t.spark.read.parquet(path).groupBy("split")
    return found.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("revenue"), 2).alias("total"))


@query(
    "s5_read_back",
    with_views(
        "SELECT day, round(quantity, 4) AS quantity, round(avg_discount, 6) AS avg_discount FROM daily_ship", "daily_ship"
    ),
)
def s5(t: Tables) -> DataFrame:
    shipped = views.daily_ship(t)
    path = tables.write_table(shipped, scratch_path(t.spark, "s5"))
    return rounded(rounded(tables.read_back(t.spark, path, shipped), 4, "quantity"), 6, "avg_discount")


@query(
    "s6_prediction_sink",
    with_views(
        """SELECT segment, day AS date, round(actual, 4) AS "actual_kWh", round(prediction, 4) AS "predicted_kWh",
             round(actual - prediction, 4) AS error FROM predictions""",
        "predictions",
    ),
)
def s6(t: Tables) -> DataFrame:
    table = tables.prediction_table(views.predictions(t), "day", "actual", "prediction", ["segment"])
    path = tables.write_table(table, scratch_path(t.spark, "s6"))
    return rounded(t.spark.read.parquet(path), 4, "actual_kWh", "predicted_kWh", "error")


@query(
    "s6_runs_replaced",
    with_views(
        """SELECT segment AS run, day AS date, round(actual, 4) AS "actual_kWh", round(p, 4) AS "predicted_kWh",
             round(actual - p, 4) AS error FROM
           (SELECT *, CASE WHEN segment < 'C' THEN prediction + 1 ELSE prediction END AS p FROM predictions)""",
        "predictions",
    ),
)
def s6_runs(t: Tables) -> DataFrame:
    """A run per segment, all written twice, then some again with other values, which replace only them."""
    path = scratch_path(t.spark, "s6r")
    made = blocks.settle(views.predictions(t).withColumnRenamed("segment", "run"))
    table = tables.prediction_table(made, "day", "actual", "prediction", ["run"])
    for _ in range(2):
        sinks.write_runs(table, path)
    moved = made.filter(F.col("run") < "C").withColumn("prediction", F.col("prediction") + 1)
    sinks.write_runs(tables.prediction_table(moved, "day", "actual", "prediction", ["run"]), path)
    return rounded(sinks.read_runs(t.spark, path, table.schema), 4, "actual_kWh", "predicted_kWh", "error")


@query(
    "s7_metric_log",
    with_views(
        """SELECT segment AS run, 'val/mae' AS metric, 0::BIGINT AS step,
             round(avg(abs(actual - prediction)), 4) AS value FROM predictions GROUP BY 1
           UNION ALL SELECT segment, 'val/mse', 0::BIGINT, round(avg(pow(actual - prediction, 2)), 1)
             FROM predictions GROUP BY 1""",
        "predictions",
    ),
)
def s7(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "s7")
    for rows in _metric_parts(t):
        tables.append_metrics(rows, path)
    return t.spark.read.parquet(path)


def _metric_parts(t: Tables) -> list[DataFrame]:
    from ..functions import errors

    wide = views.predictions(t).groupBy("segment").agg(
        F.round(errors.mae("actual", "prediction"), 4).alias("mae"),
        F.round(errors.mse("actual", "prediction"), 1).alias("mse"),
    )
    named = {"mae": "val/mae", "mse": "val/mse"}
    return [tables.metric_rows(wide, F.col("segment"), F.lit(0), {c: metric}) for c, metric in named.items()]


@query(
    "s7_metrics_once",
    with_views(
        """SELECT segment AS run, 'val/mae' AS metric, 0::BIGINT AS step,
             round(avg(abs(actual - prediction)), 4) AS value FROM predictions GROUP BY 1
           UNION ALL SELECT segment, 'val/mse', 0::BIGINT, round(avg(pow(actual - prediction, 2)), 1)
             FROM predictions GROUP BY 1""",
        "predictions",
    ),
)
def s7_once(t: Tables) -> DataFrame:
    """The log of a job that was tried again: every run's metric once."""
    path = scratch_path(t.spark, "s7o")
    parts = _metric_parts(t)
    for rows in [parts[0], *parts]:
        sinks.log_metrics(rows, path)
    return sinks.read_runs(t.spark, path, parts[0].schema)


@query(
    "s8_run_names",
    """SELECT DISTINCT c_mktsegment AS segment,
         c_mktsegment || '_lr0.001_seq[1, ' || c_nationkey || ']' AS lag_run,
         CASE WHEN c_nationkey < 5 THEN 'configured ' || c_nationkey
              ELSE c_mktsegment || '_c_scale' || (c_nationkey / 10.0) || '_s_scale0.1' END AS run
       FROM customer""",
)
def s8(t: Tables) -> DataFrame:
    arch, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    configured = F.when(nation < 5, F.concat(F.lit("configured "), nation.cast("string")))
    pairs = t("customer").select(arch, nation).distinct()
    return pairs.select(
        arch.alias("segment"),
        tables.lag_run_name(arch, F.lit(0.001), F.array(F.lit(1), nation)).alias("lag_run"),
        tables.run_name(
            configured, tables.additive_run_name(arch, nation / F.lit(10.0), F.lit(0.1))
        ).alias("run"),
    )


# --- projections -----------------------------------------------------------------------


@query("p1_select_matching", "SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders")
def p1(t: Tables) -> DataFrame:
    return columns.select_matching(t("orders"), "^o_order")


@query(
    "p2_select_prefix",
    "SELECT l_shipdate, l_orderkey, l_returnflag, l_linestatus FROM lineitem",
)
def p2(t: Tables) -> DataFrame:
    kept = columns.select_prefix(t("lineitem"), "l_", ["l_shipdate"])
    return kept.select("l_shipdate", "l_orderkey", "l_returnflag", "l_linestatus")


@query("p3_select_containing", "SELECT ts, event_id, event_type FROM events")
def p3(t: Tables) -> DataFrame:
    return columns.select_containing(t("events"), "event", ["ts"])


@query(
    "p4_select_without",
    with_views("SELECT ts, round(click, 4) AS click, round(error, 4) AS error FROM hourly_wide", "hourly_wide"),
)
def p4(t: Tables) -> DataFrame:
    kept = columns.select_without(views.hourly_wide(t), ["purch", "sign", "view"], ["ts"])
    return rounded(kept, 4, "click", "error")


@query("p5_drop_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def p5(t: Tables) -> DataFrame:
    return t("customer").drop("c_name", "c_acctbal")


@query("p6_drop_prefix_or_word", "SELECT o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def p6(t: Tables) -> DataFrame:
    return columns.drop_prefix_or_word(t("orders"), "o_order" + "k", "CUSTK")


@query(
    "p7_remove_from_names",
    "SELECT s_suppkey AS uppkey, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier",
)
def p7(t: Tables) -> DataFrame:
    # Every occurrence goes: "s_s" of the first name is cut by the second pass.
    return columns.remove_from_names(columns.remove_from_names(t("supplier"), "s_s"), "s_")


@query("p8_rename", "SELECT o_orderkey, o_orderdate AS ds, o_totalprice AS y FROM orders")
def p8(t: Tables) -> DataFrame:
    narrow = t("orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return columns.rename(narrow, {"o_orderdate": "ds", "o_totalprice": "y"})


@query("p9_target_copy", "SELECT o_orderkey, o_totalprice, o_totalprice AS energy_demand FROM orders")
def p9(t: Tables) -> DataFrame:
    return columns.with_target(t("orders").select("o_orderkey", "o_totalprice"), "o_totalprice")


@query("p10_target_first", "SELECT o_totalprice, o_orderkey, o_custkey, o_orderdate FROM orders")
def p10(t: Tables) -> DataFrame:
    narrow = t("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return columns.target_first(narrow, "o_totalprice")


@query("p11_single_column", "SELECT o_totalprice FROM orders")
def p11(t: Tables) -> DataFrame:
    return t("orders").select("o_totalprice")


@query("p13_without_zone", "SELECT event_id, ts AS ds FROM events")
def p13(t: Tables) -> DataFrame:
    # An instant with zone first (the wall clock read in the session zone), then without.
    zoned = t("events").select(
        "event_id",
        F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp").alias("ts"),
    )
    return zoned.select("event_id", scalar.without_zone("ts").alias("ds"))


@query(
    "p14_energy_balance",
    with_views("SELECT ts, round(purchase + view - error, 4) AS demand FROM hourly_wide", "hourly_wide"),
)
def p14(t: Tables) -> DataFrame:
    demand = scalar.energy_balance("purchase", "view", "error")
    return views.hourly_wide(t).select("ts", F.round(demand, 4).alias("demand"))


@query(
    "p15_row_sum",
    with_views(
        "SELECT ts, round(coalesce(click, 0) + coalesce(signup, 0) + coalesce(view, 0), 4) AS appliances FROM hourly_wide",
        "hourly_wide",
    ),
)
def p15(t: Tables) -> DataFrame:
    wide = views.hourly_wide(t)
    appliances = columns.names_without(TYPES, ["error", "purchase"])
    return wide.select("ts", F.round(scalar.row_sum(appliances), 4).alias("appliances"))


@query(
    "p16_residual",
    with_views("SELECT segment, day, round(actual - prediction, 4) AS error FROM predictions", "predictions"),
)
def p16(t: Tables) -> DataFrame:
    return views.predictions(t).select(
        "segment", "day", F.round(scalar.residual("actual", "prediction"), 4).alias("error")
    )


@query(
    "p17_null_flag",
    with_views("SELECT ts, CAST(signup IS NULL AS INTEGER) AS signup_missing FROM hourly_wide", "hourly_wide"),
)
def p17(t: Tables) -> DataFrame:
    return views.hourly_wide(t).select("ts", scalar.null_flag("signup").alias("signup_missing"))


@query(
    "p18_regressor_names",
    with_views(
        """SELECT ts AS ds, round(click, 4) AS y, round(error, 4) AS error, round(purchase, 4) AS purchase,
             round(signup, 4) AS signup, round(view, 4) AS view FROM hourly_wide""",
        "hourly_wide",
    ),
)
def p18(t: Tables) -> DataFrame:
    named = columns.rename(views.hourly_wide(t), {"ts": "ds", "click": "y"})
    names = columns.regressor_names(named.columns)
    return rounded(named.select("ds", "y", *names), 4, "y", *names)


@query(
    "p19_event_rows",
    """SELECT o_orderdate AS date, unnest(string_split(o_orderpriority, '-')) AS feature FROM orders""",
)
def p19(t: Tables) -> DataFrame:
    return columns.event_rows(t("orders"), "o_orderdate", F.split("o_orderpriority", "-"))


# --- filters ---------------------------------------------------------------------------

NULLS = " + ".join(f"CAST({e} IS NULL AS INTEGER)" for e in TYPES)


@query(
    "f1_complete_rows",
    with_views(f"SELECT ts, {METERS} FROM hourly_wide WHERE {NULLS} <= 1", "hourly_wide"),
)
def f1(t: Tables) -> DataFrame:
    return rounded(views.hourly_wide(t).filter(quality.is_complete(TYPES)), 4, *TYPES)


@query(
    "f2_trim_to_complete",
    with_views(
        f"""SELECT ts, {METERS} FROM hourly_wide WHERE ts BETWEEN
          (SELECT min(ts) FROM hourly_wide WHERE {NULLS} <= 1) AND
          (SELECT max(ts) FROM hourly_wide WHERE {NULLS} <= 1)""",
        "hourly_wide",
    ),
)
def f2(t: Tables) -> DataFrame:
    return rounded(quality.trim_to_complete(views.hourly_wide(t), TYPES, "ts"), 4, *TYPES)


@query(
    "f2_trim_per_series",
    with_views(
        """SELECT d.segment, d.day, d.revenue FROM
             (SELECT segment, day, round(revenue, 4) AS revenue FROM segment_dense) d JOIN
             (SELECT segment, min(day) AS a, max(day) AS b FROM segment_dense WHERE revenue IS NOT NULL GROUP BY 1) s
             ON d.segment = s.segment WHERE d.day BETWEEN a AND b""",
        "segment_dense",
    ),
)
def f2_series(t: Tables) -> DataFrame:
    trimmed = quality.trim_to_complete(views.segment_dense(t), ["revenue"], "day", ["segment"])
    return rounded(trimmed, 4, "revenue")


@query(
    "f3_between_times",
    "SELECT event_id, ts, value FROM events WHERE ts BETWEEN '2024-01-05 00:00:00' AND '2024-01-20 12:00:00'",
)
def f3(t: Tables) -> DataFrame:
    narrow = t("events").select("event_id", "ts", "value")
    return quality.between_times(narrow, "ts", "2024-01-05 00:00:00", "2024-01-20 12:00:00")


@query("f4_in_years", "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) IN (1996, 1997, 1998)")
def f4(t: Tables) -> DataFrame:
    return quality.in_years(t("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", 1996, 1999)


@query(
    "f5_null_filter",
    with_views(
        "SELECT ts, round(click, 4) AS click FROM hourly_wide WHERE signup IS NULL AND click IS NOT NULL",
        "hourly_wide",
    ),
)
def f5(t: Tables) -> DataFrame:
    wide = views.hourly_wide(t).filter(F.col("signup").isNull() & F.col("click").isNotNull())
    return rounded(wide.select("ts", "click"), 4, "click")


@query(
    "f6_split_by_year",
    """SELECT CASE WHEN year(o_orderdate) = 2001 THEN 'test' ELSE 'train' END AS split, o_orderkey
       FROM orders""",
)
def f6(t: Tables) -> DataFrame:
    narrow = t("orders").select("o_orderkey", "o_orderdate")
    train, test = quality.split_by_year(narrow, "o_orderdate", TEST_YEAR)
    return train.select(F.lit("train").alias("split"), "o_orderkey").unionByName(
        test.select(F.lit("test").alias("split"), "o_orderkey")
    )


@query(
    "f7_contains_ignoring_case",
    "SELECT doc_id, lang FROM documents WHERE coalesce(contains(lower(text), 'license'), false)",
)
def f7(t: Tables) -> DataFrame:
    return t("documents").filter(scalar.contains_ignoring_case("text", "License")).select("doc_id", "lang")


@query("f8_filled", "SELECT doc_id, source FROM documents WHERE source IS NOT NULL AND source <> ''")
def f8(t: Tables) -> DataFrame:
    return t("documents").filter(scalar.is_filled("source")).select("doc_id", "source")


@query(
    "f9_drop_incomplete",
    with_views(
        f"SELECT ts, {METERS} FROM hourly_wide WHERE " + " AND ".join(f"{e} IS NOT NULL" for e in TYPES),
        "hourly_wide",
    ),
)
def f9(t: Tables) -> DataFrame:
    return rounded(views.hourly_wide(t).dropna("any"), 4, *TYPES)


@query(
    "f10_filter_aggregate",
    with_views(
        """SELECT date_trunc('day', ts)::TIMESTAMP AS day, count(*) FILTER (signup IS NULL) AS missing
           FROM hourly_wide GROUP BY 1 HAVING count(*) FILTER (signup IS NULL) > 0""",
        "hourly_wide",
    ),
)
def f10(t: Tables) -> DataFrame:
    return quality.nulls_per_day(views.hourly_wide(t), "signup", "ts").filter("missing > 0")


@query(
    "f11_per_category",
    "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1",
)
def f11(t: Tables) -> DataFrame:
    return t("events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


@query(
    "f12_from_first_of_test",
    with_views(
        """SELECT segment, day, round(prediction, 4) AS prediction FROM predictions p WHERE day >=
           (SELECT min(day) FROM predictions q WHERE year(q.day) = 2001 AND q.segment = p.segment)""",
        "predictions",
    ),
)
def f12(t: Tables) -> DataFrame:
    forecast = views.predictions(t)
    _, test = quality.split_by_year(forecast, "day", TEST_YEAR)
    kept = quality.from_first_of(forecast.select("segment", "day", "prediction"), test, "day", ["segment"])
    return rounded(kept, 4, "prediction")


@query(
    "f13_masked_rows",
    with_views("SELECT ts FROM hourly_wide WHERE signup IS NULL", "hourly_wide"),
)
def f13(t: Tables) -> DataFrame:
    return views.hourly_wide(t).withColumn("mask", F.col("signup").isNull()).filter("mask").select("ts")


# --- joins -----------------------------------------------------------------------------


@query(
    "j1_left_join_hourly",
    """SELECT m.event_type, m.ts, round(m.used, 4) AS used, round(w.temperature, 6) AS temperature FROM
         (SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS ts, sum(value) AS used FROM events GROUP BY 1, 2) m
       LEFT JOIN (SELECT date_trunc('hour', ts)::TIMESTAMP AS ts, avg(value) AS temperature FROM events
          WHERE event_type = 'error' GROUP BY 1) w ON m.ts = w.ts""",
)
def j1(t: Tables) -> DataFrame:
    hour = blocks.truncate("hour", "ts").alias("ts")
    events = t("events")
    meters = events.groupBy("event_type", hour).agg(F.sum("value").alias("used"))
    weather = events.filter("event_type = 'error'").groupBy(hour).agg(F.avg("value").alias("temperature"))
    joined = joins.left_join_on_time(meters, weather, "ts")
    return rounded(rounded(joined, 4, "used"), 6, "temperature")


@query(
    "j2_left_join_daily",
    with_views(
        """SELECT s.segment, s.day, round(s.revenue, 4) AS revenue, round(w.quantity, 4) AS quantity
           FROM segment_dense s LEFT JOIN daily_ship w ON s.day = w.day""",
        "segment_dense",
        "daily_ship",
    ),
)
def j2(t: Tables) -> DataFrame:
    weather = views.daily_ship(t).select("day", "quantity")
    return rounded(
        joins.left_join_on_time(views.segment_dense(t), weather, "day"), 4, "revenue", "quantity"
    )


@query(
    "j3_join_back_features",
    """SELECT event_id, ts, value, CASE WHEN month(ts) IN (12, 1, 2) THEN 'winter'
         WHEN month(ts) < 6 THEN 'spring' WHEN month(ts) < 9 THEN 'summer' ELSE 'autumn' END AS season,
         isodow(ts) > 5 AS weekend FROM events""",
)
def j3(t: Tables) -> DataFrame:
    # Features of the same rows are columns, not a join.
    return t("events").select("event_id", "ts", "value").withColumns(
        {"season": calendar.season("ts"), "weekend": calendar.is_weekend("ts")}
    )


@query(
    "j4_three_way_left",
    with_views(
        """SELECT o.day, round(o.revenue, 4) AS revenue, round(w.quantity, 4) AS quantity,
             b.segment, round(b.revenue, 4) AS house
           FROM daily_orders o LEFT JOIN daily_ship w ON o.day = w.day
           LEFT JOIN segment_daily b ON o.day = b.day WHERE year(o.day) BETWEEN 1996 AND 1999""",
        "daily_orders",
        "daily_ship",
        "segment_daily",
    ),
)
def j4(t: Tables) -> DataFrame:
    grid = quality.in_years(views.daily_orders(t).select("day", "revenue"), "day", 1996, 2000)
    weather = views.daily_ship(t).select("day", "quantity")
    house = views.segment_daily(t).select("day", "segment", F.col("revenue").alias("house"))
    return rounded(joins.left_join_all(grid, [weather, house], "day"), 4, "revenue", "quantity", "house")


@query(
    "j5_align_on_key",
    with_views(
        """SELECT coalesce(o.day, w.day) AS day, round(o.revenue, 4) AS revenue, round(w.quantity, 4) AS quantity
           FROM daily_orders o FULL JOIN daily_ship w ON o.day = w.day""",
        "daily_orders",
        "daily_ship",
    ),
)
def j5(t: Tables) -> DataFrame:
    left = views.daily_orders(t).select("day", "revenue")
    right = views.daily_ship(t).select("day", "quantity")
    return rounded(joins.align_on_key(left, right, ["day"]), 4, "revenue", "quantity")


@query(
    "j6_rows_of_other",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate IN (SELECT o_orderdate FROM orders)",
)
def j6(t: Tables) -> DataFrame:
    lines = t("lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("day"))
    days = t("orders").select(F.col("o_orderdate").alias("day")).distinct()
    return joins.rows_of(lines, days, ["day"]).drop("day")


EASTER = """(SELECT y, make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS easter FROM
  (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM
    (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM
      (SELECT *, (19 * a + b - d - g + 15) % 30 AS h, c // 4 AS i, c % 4 AS k FROM
        (SELECT *, b // 4 AS d, b % 4 AS e, (b - (b + 8) // 25 + 1) // 3 AS g FROM
          (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years))))))"""
HOLIDAYS = f"""SELECT y AS year, name, holiday FROM (
    SELECT y, name, make_date(y, m, d) AS holiday FROM years, (VALUES ('New Year', 1, 1), ('Epiphany', 1, 6),
      ('Labour Day', 5, 1), ('German Unity Day', 10, 3), ('All Saints', 11, 1), ('Christmas Day', 12, 25),
      ('Second Christmas Day', 12, 26)) f(name, m, d)
    UNION ALL SELECT y, name, easter + days FROM {EASTER}, (VALUES ('Good Friday', -2), ('Easter Monday', 1),
      ('Ascension', 39), ('Whit Monday', 50), ('Corpus Christi', 60)) f(name, days)
    UNION ALL SELECT y, 'Reformation Day', DATE '2017-10-31' FROM years WHERE y = 2017)"""
YEARS = "SELECT unnest(generate_series((SELECT min(year(o_orderdate)) FROM orders), (SELECT max(year(o_orderdate)) FROM orders))) AS y"


def orders_holidays(t: Tables) -> DataFrame:
    return dimensions.holiday_dimension(dimensions.years_of(t("orders"), "o_orderdate"))


@query(
    "j7_holiday_or_weekend",
    with_views(
        """SELECT day, coalesce(isodow(day) > 5 OR EXISTS (SELECT 1 FROM holidays h WHERE h.holiday = day::DATE), false)
             AS is_holiday_or_weekend FROM daily_orders""",
        "daily_orders",
        extra={"years": YEARS, "holidays": HOLIDAYS},
    ),
)
def j7(t: Tables) -> DataFrame:
    return joins.holiday_or_weekend(views.daily_orders(t).select("day"), "day", orders_holidays(t))


@query(
    "j7_weekend_only",
    with_views("SELECT day, isodow(day) > 5 AS is_holiday_or_weekend FROM daily_orders", "daily_orders"),
)
def j7_none(t: Tables) -> DataFrame:
    return joins.holiday_or_weekend(
        views.daily_orders(t).select("day"), "day", orders_holidays(t), match="none"
    )


# Solar equations in SQL: day -> equation of time and declination -> dawn and dusk.
SOLAR = """SELECT location, day,
    day::TIMESTAMP + to_seconds(round((noon - 4 * angle) * 60)::BIGINT) AS dawn,
    day::TIMESTAMP + to_seconds(round((noon + 4 * angle) * 60)::BIGINT) AS dusk FROM
  (SELECT *, 720 - 4 * longitude - eqt AS noon,
     CASE WHEN cosh BETWEEN -1 AND 1 THEN degrees(acos(CASE WHEN cosh BETWEEN -1 AND 1 THEN cosh END)) END AS angle FROM
    (SELECT *, (sin(radians(-6)) - sin(radians(latitude)) * sin(decl)) / (cos(radians(latitude)) * cos(decl)) AS cosh FROM
      (SELECT *, asin(sin(tilt) * sin(radians(l0 + centre - 0.00569 - 0.00478 * sin(node)))) AS decl,
         4 * degrees(yy * sin(2 * radians(l0)) - 2 * ecc * sin(m) + 4 * ecc * yy * sin(m) * cos(2 * radians(l0))
           - 0.5 * yy * yy * sin(4 * radians(l0)) - 1.25 * ecc * ecc * sin(2 * m)) AS eqt FROM
        (SELECT *, pow(tan(tilt / 2), 2) AS yy FROM
          (SELECT *, sin(m) * (1.914602 - c * (0.004817 + 0.000014 * c)) + sin(2 * m) * (0.019993 - 0.000101 * c)
               + 0.000289 * sin(3 * m) AS centre,
             radians(23.439291111 - c * (0.0130041667 + c * (0.0000001639 - c * 0.0000005036)) + 0.00256 * cos(node)) AS tilt FROM
            (SELECT *, (280.46646 + c * (36000.76983 + c * 0.0003032)) % 360 AS l0,
               radians(357.52911 + c * (35999.05029 - 0.0001537 * c)) AS m,
               0.016708634 - c * (0.000042037 + 0.0000001267 * c) AS ecc, radians(125.04 - 1934.136 * c) AS node FROM
              (SELECT *, date_diff('day', DATE '2000-01-01', day)::DOUBLE / 36525.0::DOUBLE AS c FROM places)))))))"""
PLACE_COLUMNS = "n_nationkey AS location, (n_nationkey * 6 - 72)::DOUBLE AS latitude, (n_nationkey * 14 - 170)::DOUBLE AS longitude"
USER_PLACES = f"""SELECT DISTINCT {PLACE_COLUMNS}, ts::DATE AS day FROM events
    JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
USER_EVENTS = """SELECT event_id, ts, n_nationkey AS location FROM events
    JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def located_events(t: Tables) -> DataFrame:
    """Events at the coordinates of the user's nation; the latitudes reach the polar circles."""
    nations = t("nation").select(
        F.col("n_nationkey").alias("location"),
        (F.col("n_nationkey") * 6 - 72).cast("double").alias("latitude"),
        (F.col("n_nationkey") * 14 - 170).cast("double").alias("longitude"),
    )
    users = t("customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("location"))
    return t("events").select("event_id", "ts", "user_id").join(users, "user_id").join(nations, "location")


@query(
    "j8_daylight_lookup",
    with_views(
        """SELECT e.event_id, e.ts, coalesce(e.ts BETWEEN s.dawn AND s.dusk, false) AS daylight_flag
           FROM located e LEFT JOIN solar s ON e.location = s.location AND e.ts::DATE = s.day""",
        extra={"places": USER_PLACES, "located": USER_EVENTS, "solar": SOLAR},
    ),
)
def j8(t: Tables) -> DataFrame:
    located = located_events(t)
    twilight = dimensions.twilight_dimension(located.withColumn("day", F.to_date("ts")), "location")
    flagged = joins.daylight_from_dimension(located, "ts", "location", twilight)
    return flagged.select("event_id", "ts", "daylight_flag")


@query(
    "j9_parameter_grid",
    """SELECT segment, c AS changepoint_prior_scale, s AS seasonality_prior_scale FROM
         (SELECT DISTINCT c_mktsegment AS segment FROM customer),
         (VALUES (0.001::DOUBLE), (0.01), (0.1), (0.5), (5), (10)) a(c),
         (VALUES (0.01::DOUBLE), (0.1), (1), (10)) b(s)""",
)
def j9(t: Tables) -> DataFrame:
    segments = t("customer").select(F.col("c_mktsegment").alias("segment")).distinct()
    return joins.parameter_grid(
        segments,
        {
            "changepoint_prior_scale": [0.001, 0.01, 0.1, 0.5, 5, 10],
            "seasonality_prior_scale": [0.01, 0.1, 1.0, 10.0],
        },
    )


# --- ordering --------------------------------------------------------------------------


@query(
    "t1_sort_by_time",
    with_views(
        "SELECT row_number() OVER (ORDER BY day) AS position, day, round(revenue, 4) AS revenue FROM daily_orders",
        "daily_orders",
    ),
)
def t1(t: Tables) -> DataFrame:
    placed = blocks.with_position(views.daily_orders(t).select("day", "revenue"), [], "day", **ONE_SERIES)
    return rounded(placed, 4, "revenue").orderBy("day")


@query(
    "t3_first_rows",
    "SELECT event_id, ts, event_type FROM events ORDER BY ts, event_id LIMIT 24",
)
def t3(t: Tables) -> DataFrame:
    return lags.first_rows(t("events").select("event_id", "ts", "event_type"), "ts", 24, (), ["event_id"])


@query(
    "t4_last_rows",
    with_views(
        """SELECT segment, day, round(actual, 4) AS actual, round(prediction, 4) AS prediction FROM
           (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY day DESC) AS rn FROM predictions) WHERE rn <= 24""",
        "predictions",
    ),
)
def t4(t: Tables) -> DataFrame:
    narrow = views.predictions(t).select("segment", "day", "actual", "prediction")
    return rounded(lags.last_rows(narrow, "day", 24, ["segment"]), 4, "actual", "prediction")


@query(
    "t5_last_of_forecast",
    with_views(
        """SELECT segment, max(day) AS day, round(arg_max(prediction, day), 4) AS prediction
           FROM predictions GROUP BY 1""",
        "predictions",
    ),
)
def t5(t: Tables) -> DataFrame:
    return views.predictions(t).groupBy("segment").agg(
        F.max("day").alias("day"), F.round(F.max_by("prediction", "day"), 4).alias("prediction")
    )


@query(
    "t6_drop_first",
    with_views(
        """SELECT segment, day, round(revenue, 4) AS revenue FROM
           (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY day) AS rn FROM segment_dense) WHERE rn > 1""",
        "segment_dense",
    ),
)
def t6(t: Tables) -> DataFrame:
    sliced = lags.slice_rows(views.segment_dense(t), "day", ["segment"], skip_first=1, **DAILY)
    return rounded(sliced, 4, "revenue")


@query(
    "t7_middle_slice",
    with_views(
        """SELECT segment, day, round(revenue, 4) AS revenue FROM
           (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY day) AS rn,
              count(*) OVER (PARTITION BY segment) AS n FROM segment_dense) WHERE rn > 30 AND rn <= n - 60""",
        "segment_dense",
    ),
)
def t7(t: Tables) -> DataFrame:
    sliced = lags.slice_rows(views.segment_dense(t), "day", ["segment"], 30, 60, **DAILY)
    return rounded(sliced, 4, "revenue")


@query("t8_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def t8(t: Tables) -> DataFrame:
    return quality.value_counts(t("events"), "event_type").orderBy(F.desc("n"), "event_type")


# --- set operations --------------------------------------------------------------------


@query(
    "u1_union_splits",
    with_views(
        """SELECT day, round(revenue, 4) AS revenue, CASE WHEN year(day) = 2001 THEN 'test' ELSE 'train' END AS split
           FROM daily_orders""",
        "daily_orders",
    ),
)
def u1(t: Tables) -> DataFrame:
    train, test = quality.split_by_year(views.daily_orders(t).select("day", "revenue"), "day", TEST_YEAR)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return rounded(both, 4, "revenue")


# --- scalars ---------------------------------------------------------------------------


@query("c1_remove_text", "SELECT c_custkey, replace(c_name, 'Customer#', '') AS name FROM customer")
def c1(t: Tables) -> DataFrame:
    return t("customer").select("c_custkey", scalar.remove_text("c_name", "Customer#").alias("name"))


@query(
    "c2_words",
    r"""SELECT doc_id, word, count(*) AS n FROM
         (SELECT doc_id, unnest(regexp_split_to_array(text, '[ \t\n\f\r\x0B]+')) AS word FROM documents)
       WHERE word <> '' GROUP BY 1, 2""",
)
def c2(t: Tables) -> DataFrame:
    # A row's words are counted in the row, which moves nothing; only ids that stand in several rows
    # are summed up. They are written first: their size decides whether texts are shuffled to find them.
    docs = t("documents").select("doc_id", "text")
    several = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(F.col("doc_id").alias("id"))
    several = write_settled(several, "several")
    same = F.col("doc_id").eqNullSafe(F.col("id"))
    once, more = (_word_counts(docs.join(several, same, how)) for how in ("left_anti", "left_semi"))
    return once.unionByName(more.groupBy("doc_id", "word").agg(F.sum("n").alias("n")))


def _word_counts(docs: DataFrame) -> DataFrame:
    words = docs.select("doc_id", F.sort_array(scalar.words("text")).alias("words"))
    runs = words.withColumn("ends", scalar.run_ends("words"))
    return runs.select("doc_id", F.inline(scalar.run_counts("words", "ends")).alias("word", "n"))


@query(
    "c3_text_tests",
    """SELECT doc_id, contains(lower(text), 'the') AS has_the, starts_with(text, 'The') AS starts, lower(lang) AS lang
       FROM documents""",
)
def c3(t: Tables) -> DataFrame:
    return t("documents").select(
        "doc_id",
        scalar.contains_ignoring_case("text", "THE").alias("has_the"),
        F.col("text").startswith("The").alias("starts"),
        F.lower("lang").alias("lang"),
    )


@query("c4_parse_timestamp", "SELECT event_id, ts AS parsed FROM events")
def c4(t: Tables) -> DataFrame:
    zones = F.when(F.col("event_id") % 3 == 0, "Z").when(F.col("event_id") % 3 == 1, "+00:00").otherwise("")
    text = F.concat(F.col("ts").cast("string"), zones)
    return t("events").select("event_id", scalar.parse_timestamp(text).alias("parsed"))


@query(
    "c5_date_parts",
    """SELECT event_id, date_trunc('day', ts)::TIMESTAMP AS date, year(ts) AS year, month(ts) AS month,
         hour(ts) AS hour, isodow(ts) - 1 AS weekday FROM events""",
)
def c5(t: Tables) -> DataFrame:
    parts = calendar.date_parts("ts")
    return t("events").select(
        "event_id",
        parts.pop("date").cast("timestamp_ntz").alias("date"),
        *[big(c).alias(name) for name, c in parts.items()],
    )


@query(
    "c6_holiday_flag_events",
    """WITH years AS (SELECT unnest(generate_series((SELECT min(year(ts)) FROM events), (SELECT max(year(ts)) FROM events))) AS y),
       holidays AS (""" + HOLIDAYS + """)
       SELECT event_id, isodow(ts) > 5 OR ts::DATE IN (SELECT holiday FROM holidays) AS is_holiday_or_weekend FROM events""",
)
def c6(t: Tables) -> DataFrame:
    events = t("events").select("event_id", "ts")
    holidays = dimensions.holiday_dimension(dimensions.years_of(events, "ts"))
    return joins.holiday_or_weekend(events, "ts", holidays).drop("ts")


@query(
    "c7_time_of_day",
    """SELECT event_id, CASE WHEN hour(ts) < 6 THEN 'night' WHEN hour(ts) < 12 THEN 'morning'
         WHEN hour(ts) < 18 THEN 'afternoon' ELSE 'evening' END AS time_of_day FROM events""",
)
def c7(t: Tables) -> DataFrame:
    return t("events").select("event_id", calendar.time_of_day("ts").alias("time_of_day"))


@query(
    "c8_season",
    """SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter'
         WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring'
         WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season FROM orders""",
)
def c8(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", calendar.season("o_orderdate").alias("season"))


@query(
    "c9_daylight_flag",
    with_views(
        """SELECT e.event_id, coalesce(e.ts BETWEEN s.dawn AND s.dusk, false) AS daylight_flag
           FROM located e LEFT JOIN solar s ON e.location = s.location AND e.ts::DATE = s.day""",
        extra={"places": USER_PLACES, "located": USER_EVENTS, "solar": SOLAR},
    ),
)
def c9(t: Tables) -> DataFrame:
    # Dawn and dusk are expressions of the row's own date and place: no join needed.
    flag = calendar.daylight_flag("ts", F.col("latitude"), F.col("longitude"))
    return located_events(t).select("event_id", flag.alias("daylight_flag"))


@query(
    "c10_arithmetic",
    with_views(
        """SELECT segment, day, round(abs(actual - prediction), 4) AS abs_error,
             round(sqrt(abs(actual)), 6) AS root, round(pow(actual / 1000, 2), 4) AS square FROM predictions""",
        "predictions",
    ),
)
def c10(t: Tables) -> DataFrame:
    actual = F.col("actual")
    return views.predictions(t).select(
        "segment",
        "day",
        F.round(F.abs(scalar.residual("actual", "prediction")), 4).alias("abs_error"),
        F.round(F.sqrt(F.abs(actual)), 6).alias("root"),
        F.round(F.pow(actual / 1000, F.lit(2.0)), 4).alias("square"),
    )


@query(
    "c11_rounding",
    """SELECT o_orderkey, floor(o_totalprice * 0.2)::BIGINT AS fifth,
         round_even(o_totalprice, 1)::DOUBLE AS even FROM orders""",
)
def c11(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    return t("orders").select(
        "o_orderkey", F.floor(price * 0.2).alias("fifth"), scalar.python_round(price, 1).alias("even")
    )


@query("c12_flag_as_int", "SELECT l_orderkey, l_linenumber, CAST(l_discount > 0.05 AS INTEGER) AS discounted FROM lineitem")
def c12(t: Tables) -> DataFrame:
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", scalar.flag_as_int(F.col("l_discount") > 0.05).alias("discounted")
    )


@query(
    "c13_percentage",
    "SELECT o_orderpriority, round(count(*) FILTER (o_orderstatus = 'F') * 100.0 / count(*), 6)::DOUBLE AS pct FROM orders GROUP BY 1",
)
def c13(t: Tables) -> DataFrame:
    share = scalar.percentage(F.count_if(F.col("o_orderstatus") == "F"), F.count(F.lit(1)))
    return t("orders").groupBy("o_orderpriority").agg(F.round(share, 6).alias("pct"))


# --- dimensions ------------------------------------------------------------------------


@query(
    "d1_holidays",
    f"WITH years AS ({YEARS}), holidays AS ({HOLIDAYS}) SELECT year::INTEGER AS year, name, holiday::TIMESTAMP AS holiday FROM holidays",
)
def d1(t: Tables) -> DataFrame:
    return orders_holidays(t).withColumn("holiday", F.col("holiday").cast("timestamp_ntz"))


ORDER_PLACES = f"""SELECT DISTINCT {PLACE_COLUMNS}, o_orderdate::DATE AS day FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


@query(
    "d2_twilight",
    with_views(
        "SELECT location, day::TIMESTAMP AS day, dawn, dusk FROM solar",
        extra={"places": ORDER_PLACES, "solar": SOLAR},
    ),
)
def d2(t: Tables) -> DataFrame:
    nation = F.col("c_nationkey")
    places = (
        t("orders")
        .select("o_custkey", F.to_date("o_orderdate").alias("day"))
        .join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            nation.alias("location"),
            "day",
            (nation * 6 - 72).cast("double").alias("latitude"),
            (nation * 14 - 170).cast("double").alias("longitude"),
        )
    )
    return dimensions.twilight_dimension(places, "location").withColumn("day", F.col("day").cast("timestamp_ntz"))


@query(
    "d3_calendar_spine",
    with_views("SELECT segment, day FROM segment_dense", "segment_dense"),
)
def d3(t: Tables) -> DataFrame:
    return resample.calendar_spine(views.segment_daily(t), "day", ["segment"])


