"""Aggregations, windows, statistics, feature preparation and report feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar, errors, scalar
from ..models import evaluate
from ..operators import blocks, columns, dimensions, encode, joins, lags, profile, quality, resample, scale
from ..sources import tables
from . import basics, views
from .registry import Tables, big, query, rounded
from .views import DAILY, ONE_SERIES, RAW, TEST_YEAR, TYPES, with_views

NULLS = " + ".join(f"CAST({e} IS NULL AS INTEGER)" for e in TYPES)

# --- aggregations ----------------------------------------------------------------------


@query(
    "a1_resample_dense",
    with_views("SELECT segment, day, round(revenue, 4) AS revenue FROM segment_dense", "segment_dense"),
)
def a1(t: Tables) -> DataFrame:
    return rounded(views.segment_dense(t), 4, "revenue")


@query(
    "a1_resample_events_daily",
    """SELECT e.event_type, e.day AS ts, round(v.value, 6) AS value FROM
         (SELECT event_type, unnest(generate_series(min(date_trunc('day', ts)::TIMESTAMP), max(date_trunc('day', ts)::TIMESTAMP), INTERVAL 1 DAY)) AS day
          FROM events GROUP BY 1) e LEFT JOIN
         (SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS day, avg(value) AS value FROM events GROUP BY 1, 2) v
         ON e.event_type = v.event_type AND e.day = v.day""",
)
def a1_events(t: Tables) -> DataFrame:
    return rounded(resample.resample_mean(t("events"), "ts", ["value"], ["event_type"], **DAILY), 6, "value")


@query(
    "a2_null_counts",
    with_views(
        " UNION ALL ".join(
            f"SELECT '{e}' AS column_name, count(*) FILTER ({e} IS NULL) AS nulls FROM hourly_wide" for e in TYPES
        ),
        "hourly_wide",
    ),
)
def a2(t: Tables) -> DataFrame:
    return quality.null_counts(views.hourly_wide(t), TYPES)


@query(
    "a3_nulls_per_day",
    with_views(
        "SELECT date_trunc('day', ts)::TIMESTAMP AS day, count(*) FILTER (signup IS NULL) AS missing FROM hourly_wide GROUP BY 1",
        "hourly_wide",
    ),
)
def a3(t: Tables) -> DataFrame:
    return quality.nulls_per_day(views.hourly_wide(t), "signup", "ts")


@query(
    "a4_kept_share",
    with_views(
        f"""SELECT count(*) FILTER ({NULLS} <= 1) AS kept_rows, count(*) AS total_rows,
              round(count(*) FILTER ({NULLS} <= 1) * 100.0::DOUBLE / count(*), 6) AS kept_pct FROM hourly_wide""",
        "hourly_wide",
    ),
)
def a4(t: Tables) -> DataFrame:
    return rounded(quality.kept_share(views.hourly_wide(t), TYPES), 6, "kept_pct")


@query(
    "a5_time_bounds",
    "SELECT event_type, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1",
)
def a5(t: Tables) -> DataFrame:
    return quality.time_bounds(t("events"), "ts", ["event_type"])


@query("a6_shape", "SELECT count(*) AS n_rows, 11::BIGINT AS n_columns FROM lineitem")
def a6(t: Tables) -> DataFrame:
    return quality.shape(t("lineitem"))


@query("a7_value_counts", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def a7(t: Tables) -> DataFrame:
    return quality.value_counts(t("lineitem"), "l_returnflag").orderBy(F.desc("n"), "l_returnflag")


@query(
    "a8_null_days",
    with_views("SELECT segment, day FROM segment_dense WHERE revenue IS NULL", "segment_dense"),
)
def a8(t: Tables) -> DataFrame:
    return quality.null_days(views.segment_dense(t), "revenue", "day", ["segment"]).orderBy("segment", "day")


RUNS = """SELECT {key} {ts}, {flag} AS missing, sum(CASE WHEN prev IS NOT DISTINCT FROM {flag} AND rn > 1 THEN 0 ELSE 1 END)
   OVER (PARTITION BY {part} ORDER BY {ts} ROWS UNBOUNDED PRECEDING)::BIGINT AS run_id FROM
   (SELECT *, lag({flag}) OVER (PARTITION BY {part} ORDER BY {ts}) AS prev,
      row_number() OVER (PARTITION BY {part} ORDER BY {ts}) AS rn FROM {table})"""
SEGMENT_RUNS = RUNS.format(key="segment,", ts="day", part="segment", flag="(revenue IS NULL)", table="segment_dense")
HOUR_RUNS = RUNS.format(key="", ts="ts", part="1", flag="(signup IS NULL)", table="hourly_wide")


@query(
    "a9_missing_runs",
    with_views(
        """SELECT segment, run_id, count(*) AS n_rows, min(day) AS first_ts, max(day) AS last_ts
           FROM runs WHERE missing GROUP BY 1, 2""",
        "segment_dense",
        extra={"runs": SEGMENT_RUNS},
    ),
)
def a9(t: Tables) -> DataFrame:
    return quality.missing_runs(views.segment_dense(t), "revenue", "day", ["segment"], **DAILY)


SQL_CORR = {
    (a, b): f"""covar_pop(a."{a}", a."{b}") FILTER (a."{a}" IS NOT NULL AND a."{b}" IS NOT NULL) / nullif(
      (stddev_pop(a."{a}") FILTER (a."{b}" IS NOT NULL)) * (stddev_pop(a."{b}") FILTER (a."{a}" IS NOT NULL)), 0)"""
    for a in TYPES
    for b in TYPES
    if a != b
}


@query(
    "a10_correlation_matrix",
    with_views(
        " UNION ALL ".join(
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, round({expr}, 6) AS corr FROM hourly_wide a"
            for (a, b), expr in SQL_CORR.items()
        )
        + "".join(f" UNION ALL SELECT '{e}', '{e}', 1.0::DOUBLE" for e in TYPES),
        "hourly_wide",
    ),
)
def a10(t: Tables) -> DataFrame:
    return rounded(profile.correlation_matrix(views.hourly_wide(t), TYPES), 6, "corr")


@query(
    "a11_correlation_ranked",
    with_views(
        """SELECT column_name, round(corr, 6) AS corr, row_number() OVER (ORDER BY abs(corr) DESC, column_name) AS rank FROM ("""
        + " UNION ALL ".join(
            f"SELECT '{e}' AS column_name, {SQL_CORR[(e, 'click')]} AS corr FROM hourly_wide a"
            for e in TYPES
            if e != "click"
        )
        + ")",
        "hourly_wide",
    ),
)
def a11(t: Tables) -> DataFrame:
    return rounded(profile.correlation_with(views.hourly_wide(t), TYPES, "click"), 6, "corr")


def _histogram_sql(table: str, cols: list[str]) -> str:
    part = """SELECT '{c}' AS column_name, b AS bin, round(lo + (hi - lo) / 15 * b, 6) AS bin_start,
        round(lo + (hi - lo) / 15 * (b + 1), 6) AS bin_end,
        count({c}) FILTER (least(floor(({c} - lo) / (hi - lo) * 15), 14) = b) AS n
      FROM (SELECT min({c}) AS lo, max({c}) AS hi FROM {t}), range(15) r(b), {t} GROUP BY b, lo, hi"""
    return " UNION ALL ".join(part.format(c=c, t=table) for c in cols)


@query(
    "a12_histogram",
    _histogram_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]),
)
def a12(t: Tables) -> DataFrame:
    found = profile.histogram(t("lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return rounded(found, 6, "bin_start", "bin_end")


@query(
    "a12_histogram_hourly",
    with_views(_histogram_sql("hourly_wide", TYPES), "hourly_wide"),
)
def a12_hourly(t: Tables) -> DataFrame:
    return rounded(profile.histogram(views.hourly_wide(t), TYPES), 6, "bin_start", "bin_end")


ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}


@query(
    "a13_column_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null, '{k}' AS data_type FROM orders"
        for c, k in ORDER_TYPES.items()
    ),
)
def a13(t: Tables) -> DataFrame:
    return quality.column_profile(t("orders"), list(ORDER_TYPES))


def _error_query(name: str, sql: str, build, digits: int) -> None:
    @query(name, with_views(f"SELECT segment, {sql} FROM predictions GROUP BY segment", "predictions"))
    def run(t: Tables) -> DataFrame:
        return views.predictions(t).groupBy("segment").agg(
            F.round(build("actual", "prediction"), digits).alias(name.split("_", 1)[1])
        )


_error_query("a14_mse", "round(avg(pow(actual - prediction, 2)), 1) AS mse", errors.mse, 1)
_error_query("a15_rmse", "round(sqrt(avg(pow(actual - prediction, 2))), 4) AS rmse", errors.rmse, 4)
_error_query("a16_mae", "round(avg(abs(actual - prediction)), 4) AS mae", errors.mae, 4)


@query(
    "a17_mape",
    """SELECT event_type, round(avg(abs((value - prev) / nullif(value, 0))) * 100, 4) AS mape,
         count(*) FILTER (value = 0 AND prev IS NOT NULL) AS zero_actuals
       FROM (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev FROM events)
       GROUP BY 1""",
)
def a17(t: Tables) -> DataFrame:
    events = t("events").select("event_type", "ts", "event_id", "value")
    paired = blocks.over_blocks(
        events, ["event_type"], "ts", 1, lambda w: {"prev": F.lag("value").over(w)}, ["event_id"], **RAW
    )
    return paired.groupBy("event_type").agg(
        F.round(errors.mape("value", "prev"), 4).alias("mape"),
        errors.zero_actuals("value", "prev").alias("zero_actuals"),
    )


# --- windows ---------------------------------------------------------------------------


@query(
    "w1_diff",
    with_views(
        """SELECT event_type, ts, round(value_cum - prev, 4) AS value_cum FROM
         (SELECT event_type, ts, value_cum, lag(value_cum) OVER (PARTITION BY event_type ORDER BY ts) AS prev,
            row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn FROM meter_cum) WHERE rn > 1""",
        "meter_cum",
    ),
)
def w1(t: Tables) -> DataFrame:
    cumulative = views.meter_cum(t).select("event_type", "ts", "value_cum")
    return rounded(resample.per_step(cumulative, "ts", ["value_cum"], ["event_type"], **RAW), 4, "value_cum")


@query(
    "w1_diff_wide",
    with_views(
        "SELECT ts, "
        + ", ".join(f"round({e} - lag({e}) OVER (ORDER BY ts), 4) AS {e}" for e in TYPES)
        + " FROM hourly_wide QUALIFY row_number() OVER (ORDER BY ts) > 1",
        "hourly_wide",
    ),
)
def w1_wide(t: Tables) -> DataFrame:
    return rounded(resample.per_step(views.hourly_wide(t), "ts", TYPES, **ONE_SERIES), 4, *TYPES)


@query(
    "w1_daily_diff_of_mean",
    with_views(
        """SELECT event_type, day AS ts, round(value_cum - lag(value_cum) OVER (PARTITION BY event_type ORDER BY day), 4) AS value_cum
           FROM (SELECT e.event_type, e.day, v.value_cum FROM
             (SELECT event_type, unnest(generate_series(min(date_trunc('day', ts)::TIMESTAMP), max(date_trunc('day', ts)::TIMESTAMP), INTERVAL 1 DAY)) AS day
              FROM meter_cum GROUP BY 1) e LEFT JOIN
             (SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS day, avg(value_cum) AS value_cum FROM meter_cum GROUP BY 1, 2) v
             ON e.event_type = v.event_type AND e.day = v.day)
           QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY day) > 1""",
        "meter_cum",
    ),
)
def w1_diff_of_mean(t: Tables) -> DataFrame:
    return rounded(
        resample.daily_use(views.meter_cum(t), "ts", ["value_cum"], ["event_type"], **DAILY), 4, "value_cum"
    )


@query(
    "w1_daily_sum_of_diff",
    with_views(
        """SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS ts, round(sum(d), 4) AS value_cum FROM
           (SELECT event_type, ts, value_cum - lag(value_cum) OVER (PARTITION BY event_type ORDER BY ts) AS d FROM meter_cum)
           GROUP BY 1, 2""",
        "meter_cum",
    ),
)
def w1_sum_of_diff(t: Tables) -> DataFrame:
    cumulative = views.meter_cum(t).select("event_type", "ts", "value_cum")
    return rounded(
        resample.daily_use(cumulative, "ts", ["value_cum"], ["event_type"], mode="sum_of_diff", **RAW), 4, "value_cum"
    )


@query(
    "w2_lag_features",
    with_views(
        """SELECT segment, day, round(revenue, 4) AS revenue, round(lag_1, 4) AS lag_1, round(lag_7, 4) AS lag_7 FROM
           (SELECT *, lag(revenue, 1) OVER w AS lag_1, lag(revenue, 7) OVER w AS lag_7 FROM segment_dense
            WINDOW w AS (PARTITION BY segment ORDER BY day))
           WHERE revenue IS NOT NULL AND lag_1 IS NOT NULL AND lag_7 IS NOT NULL""",
        "segment_dense",
    ),
)
def w2(t: Tables) -> DataFrame:
    lagged = lags.lag_features(views.segment_dense(t), "day", "revenue", [1, 7], ["segment"], **DAILY)
    return rounded(lagged, 4, "revenue", "lag_1", "lag_7")


def _featured(t: Tables) -> DataFrame:
    """Daily measures of V3 and V4 with calendar features and the split flag."""
    merged = views.daily_orders(t).join(views.daily_ship(t), "day", "left")
    return merged.withColumns(
        {
            "n_orders": F.col("n_orders").cast("double"),
            "is_holiday_or_weekend": calendar.is_weekend("day"),
            "season": calendar.season("day"),
            "is_test": quality.in_test_year(merged, "day", TEST_YEAR),
        }
    )


FEATURED = """SELECT o.day, revenue, n_orders::DOUBLE AS n_orders, quantity, avg_discount, isodow(o.day) > 5 AS is_holiday_or_weekend,
    CASE WHEN month(o.day) IN (12, 1, 2) THEN 'winter' WHEN month(o.day) < 6 THEN 'spring'
         WHEN month(o.day) < 9 THEN 'summer' ELSE 'autumn' END AS season, year(o.day) = 2001 AS is_test
  FROM daily_orders o LEFT JOIN daily_ship s ON o.day = s.day"""
MEASURES = ["avg_discount", "n_orders", "quantity", "revenue"]


@query(
    "w3_lagged_split",
    with_views(
        "SELECT day, is_test, season, round(revenue, 4) AS revenue, "
        + ", ".join(f"round({m}_lag_{k}, 4) AS {m}_lag_{k}" for m in MEASURES for k in (1, 2))
        + " FROM (SELECT *, "
        + ", ".join(f"lag({m}, {k}) OVER (ORDER BY day) AS {m}_lag_{k}" for m in MEASURES for k in (1, 2))
        + " FROM featured) WHERE is_test OR (revenue IS NOT NULL AND "
        + " AND ".join(f"{m}_lag_{k} IS NOT NULL" for m in MEASURES for k in (1, 2))
        + ")",
        "daily_orders",
        "daily_ship",
        extra={"featured": FEATURED},
    ),
)
def w3(t: Tables) -> DataFrame:
    lagged = lags.lagged_split(
        _featured(t).drop("is_holiday_or_weekend"), "day", "revenue", [1, 2], "is_test", ["season"], **ONE_SERIES
    )
    return rounded(lagged, 4, "revenue", *[f"{m}_lag_{k}" for m in MEASURES for k in (1, 2)])


@query("w4_run_ids", with_views("SELECT ts, missing, run_id FROM runs", "hourly_wide", extra={"runs": HOUR_RUNS}))
def w4(t: Tables) -> DataFrame:
    narrow = views.hourly_wide(t).select("ts", "signup")
    return quality.run_ids(narrow, F.col("signup").isNull(), "ts", **ONE_SERIES).drop("signup")


@query(
    "w4_run_ids_per_series",
    with_views("SELECT segment, day, missing, run_id FROM runs", "segment_dense", extra={"runs": SEGMENT_RUNS}),
)
def w4_series(t: Tables) -> DataFrame:
    dense = views.segment_dense(t)
    return quality.run_ids(dense, F.col("revenue").isNull(), "day", ["segment"], **DAILY).drop("revenue")


SAMPLES = """SELECT *, row_number() OVER (ORDER BY day) AS rn, {lags} FROM featured""".format(
    lags=", ".join(f"lag({c}, {k}) OVER (ORDER BY day) AS {c}_{k}" for c in ("revenue", "quantity") for k in (1, 2, 3))
)


@query(
    "w5_sequences",
    with_views(
        " UNION ALL ".join(
            f"""SELECT day, is_test, round(revenue, 4) AS label, n_orders AS known, {3 - k}::BIGINT AS step,
                  round(revenue_{k}, 4) AS revenue, round(quantity_{k}, 4) AS quantity FROM samples WHERE rn > 3"""
            for k in (3, 2, 1)
        ),
        "daily_orders",
        "daily_ship",
        extra={"featured": FEATURED, "samples": SAMPLES},
    ),
)
def w5(t: Tables) -> DataFrame:
    built = lags.sequences(
        _featured(t), "day", "revenue", ["revenue", "quantity"], ["n_orders"], 3, keep=["is_test"], **ONE_SERIES
    )
    steps = built.select("*", F.posexplode("past").alias("step", "row"))
    return steps.select(
        "day",
        "is_test",
        F.round("label", 4).alias("label"),
        F.col("future")[0].alias("known"),
        big("step").alias("step"),
        F.round(F.col("row")[0], 4).alias("revenue"),
        F.round(F.col("row")[1], 4).alias("quantity"),
    )


@query(
    "w6_sample_split",
    with_views(
        """SELECT is_test, count(*) AS samples, min(day) AS first_target FROM
           (SELECT *, row_number() OVER (ORDER BY day) AS rn FROM featured) WHERE rn > 3 GROUP BY 1""",
        "daily_orders",
        "daily_ship",
        extra={"featured": FEATURED},
    ),
)
def w6(t: Tables) -> DataFrame:
    built = lags.sequences(_featured(t), "day", "revenue", ["revenue"], ["n_orders"], 3, keep=["is_test"], **ONE_SERIES)
    return built.groupBy("is_test").agg(F.count(F.lit(1)).alias("samples"), F.min("day").alias("first_target"))


@query(
    "w7_position",
    "SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS position FROM events",
)
def w7(t: Tables) -> DataFrame:
    narrow = t("events").select("event_type", "event_id", "ts")
    return blocks.with_position(narrow, ["event_type"], "ts", "position", ["event_id"], **RAW).drop("ts")


@query(
    "w7_running_total",
    with_views("SELECT event_type, event_id, ts, round(value_cum, 2) AS value_cum FROM meter_cum", "meter_cum"),
)
def w7_running(t: Tables) -> DataFrame:
    return rounded(views.meter_cum(t), 2, "value_cum")


def _acf_sql(max_lag: int) -> str:
    """Autocorrelations of segment_dense.revenue as (segment, n, lag, r)."""
    return f"""SELECT segment, n, k AS lag, c / first_value(c) OVER (PARTITION BY segment ORDER BY k) AS r FROM
      (SELECT a.segment, max(a.n) AS n, k, coalesce(sum(a.z * b.z), 0) AS c
       FROM z a CROSS JOIN range({max_lag + 1}) r(k) LEFT JOIN z b ON b.segment = a.segment AND b.rn = a.rn - k
       GROUP BY a.segment, k)"""


Z = """SELECT segment, row_number() OVER (PARTITION BY segment ORDER BY day) AS rn,
    revenue - avg(revenue) OVER (PARTITION BY segment) AS z, count(revenue) OVER (PARTITION BY segment) AS n
  FROM segment_dense"""


@query(
    "w9_acf",
    with_views(
        """SELECT segment, lag, round(r, 6) AS acf, round(CASE WHEN lag = 0 THEN 0 ELSE 1.959963984540054 *
             sqrt((1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN r * r END) OVER
               (PARTITION BY segment ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END, 6) AS bound
           FROM acf""",
        "segment_dense",
        extra={"z": Z, "acf": _acf_sql(100)},
    ),
)
def w9(t: Tables) -> DataFrame:
    found = profile.acf(views.segment_dense(t), "day", "revenue", 100, ["segment"], **DAILY)
    return rounded(found, 6, "acf", "bound")


PACF = """SELECT segment, n, r, 0 AS k, []::DOUBLE[] AS phi, 1.0::DOUBLE AS pacf FROM arrays
  UNION ALL
  SELECT segment, n, r, k + 1, list_append(list_transform(phi, lambda f, i: f - p * phi[k + 1 - i]), p), p FROM
    (SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(phi, lambda f, i: f * r[k + 2 - i])), 0))
       / (1 - coalesce(list_sum(list_transform(phi, lambda f, i: f * r[i + 1])), 0)) AS p
     FROM levinson WHERE k < 100)"""


@query(
    "w10_pacf",
    with_views(
        """SELECT segment, k::BIGINT AS lag, round(pacf, 6) AS pacf,
             round(CASE WHEN k = 0 THEN 0 ELSE 1.959963984540054 / sqrt(n) END, 6) AS bound FROM levinson""",
        "segment_dense",
        extra={
            "z": Z,
            "acf": _acf_sql(100),
            "arrays": "SELECT segment, max(n) AS n, list(r ORDER BY lag) AS r FROM acf GROUP BY 1",
            "levinson": PACF,
        },
        recursive=True,
    ),
)
def w10(t: Tables) -> DataFrame:
    found = profile.pacf(views.segment_dense(t), "day", "revenue", 100, ["segment"], **DAILY)
    return rounded(found, 6, "pacf", "bound")


# --- feature preparation ---------------------------------------------------------------

ONE_HOT = "is_holiday_or_weekend_True season_spring season_summer season_winter".split()
ONE_HOT_SQL = """CAST(is_holiday_or_weekend AS DOUBLE) AS "is_holiday_or_weekend_True",
  CAST(season = 'spring' AS DOUBLE) AS season_spring, CAST(season = 'summer' AS DOUBLE) AS season_summer,
  CAST(season = 'winter' AS DOUBLE) AS season_winter"""


@query(
    "m1_one_hot",
    with_views(
        f"SELECT day, is_test, round(revenue, 4) AS revenue, {ONE_HOT_SQL} FROM featured",
        "daily_orders",
        "daily_ship",
        extra={"featured": FEATURED},
    ),
)
def m1(t: Tables) -> DataFrame:
    featured = _featured(t).drop("n_orders", "quantity", "avg_discount")
    encoder = encode.fit_one_hot(featured.filter(~F.col("is_test")), encode.CATEGORICAL["daily"])
    return rounded(encoder.apply(featured), 4, "revenue")


@query(
    "m2_encode_additive",
    with_views(
        f"SELECT day AS ds, round(revenue, 4) AS y, {ONE_HOT_SQL} FROM featured",
        "daily_orders",
        "daily_ship",
        extra={"featured": FEATURED},
    ),
)
def m2(t: Tables) -> DataFrame:
    featured = _featured(t)
    encoder = encode.fit_one_hot(featured.filter(~F.col("is_test")), encode.CATEGORICAL["daily"])
    return rounded(encode.encode_for_additive(featured, encoder, "day", "revenue"), 4, "y")


@query(
    "m3_one_hot_hourly",
    with_views(
        """SELECT e.event_id, CAST(coalesce(e.ts BETWEEN s.dawn AND s.dusk, false) AS DOUBLE) AS "daylight_flag_True",
             CAST(isodow(e.ts) > 5 OR EXISTS (SELECT 1 FROM holidays h WHERE h.holiday = e.ts::DATE) AS DOUBLE) AS "is_holiday_or_weekend_True",
             CAST(hour(e.ts) BETWEEN 18 AND 23 AS DOUBLE) AS time_of_day_evening,
             CAST(hour(e.ts) BETWEEN 6 AND 11 AS DOUBLE) AS time_of_day_morning,
             CAST(hour(e.ts) < 6 AS DOUBLE) AS time_of_day_night
           FROM located e LEFT JOIN solar s ON e.location = s.location AND e.ts::DATE = s.day""",
        extra={
            "places": basics.USER_PLACES,
            "located": basics.USER_EVENTS,
            "solar": basics.SOLAR,
            "years": "SELECT DISTINCT year(ts) AS y FROM events",
            "holidays": basics.HOLIDAYS,
        },
    ),
)
def m3(t: Tables) -> DataFrame:
    holidays = dimensions.holiday_dimension(dimensions.years_of(t("events"), "ts"))
    events = joins.holiday_or_weekend(basics.located_events(t), "ts", holidays).select(
        "event_id",
        "ts",
        "is_holiday_or_weekend",
        calendar.daylight_flag("ts", F.col("latitude"), F.col("longitude")).alias("daylight_flag"),
        calendar.time_of_day("ts").alias("time_of_day"),
        calendar.season("ts").alias("season"),
    )
    # The events are of one season, whose single category is the dropped first one.
    train = events.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return encode.fit_one_hot(train, encode.CATEGORICAL["hourly"]).apply(events).drop("ts")


@query(
    "m4_min_max_matrix",
    with_views(
        """SELECT day, is_test, round((revenue - a) / (b - a), 6) AS label, round((n_orders - c) / (d - c), 6) AS x0,
             round((quantity - e) / (f - e), 6) AS x1 FROM featured,
           (SELECT min(revenue) a, max(revenue) b, min(n_orders) c, max(n_orders) d, min(quantity) e, max(quantity) f
            FROM featured WHERE NOT is_test)""",
        "daily_orders",
        "daily_ship",
        extra={"featured": FEATURED},
    ),
)
def m4(t: Tables) -> DataFrame:
    featured = _featured(t).select("day", "is_test", "revenue", "n_orders", "quantity")
    scaler = scale.fit_min_max(featured.filter(~F.col("is_test")), ["revenue", "n_orders", "quantity"])
    matrix = scale.design(scaler.apply(featured), "revenue", ["n_orders", "quantity"], ["day", "is_test"])
    x = F.col("features")
    return matrix.select(
        "day",
        "is_test",
        F.round("label", 6).alias("label"),
        F.round(x[0], 6).alias("x0"),
        F.round(x[1], 6).alias("x1"),
    )


@query(
    "m5_min_max_per_series",
    with_views(
        """SELECT d.segment, day, round((revenue - a) / (b - a), 6) AS revenue FROM segment_dense d JOIN
           (SELECT segment, min(revenue) a, max(revenue) b FROM segment_dense WHERE year(day) <> 2001 GROUP BY 1) s
           ON d.segment = s.segment""",
        "segment_dense",
    ),
)
def m5(t: Tables) -> DataFrame:
    dense = views.segment_dense(t)
    train, _ = quality.split_by_year(dense, "day", TEST_YEAR)
    return rounded(scale.fit_min_max(train, ["revenue"], ["segment"]).apply(dense), 6, "revenue")


@query(
    "m6_inverse_target",
    with_views("SELECT segment, day, round(revenue, 2) AS revenue FROM segment_dense", "segment_dense"),
)
def m6(t: Tables) -> DataFrame:
    dense = views.segment_dense(t)
    train, _ = quality.split_by_year(dense, "day", TEST_YEAR)
    scaler = scale.fit_min_max(train, ["revenue"], ["segment"])
    return rounded(scaler.invert(scaler.apply(dense), "revenue", ["revenue"]), 2, "revenue")


@query(
    "m7_label_and_features",
    "SELECT l_orderkey, l_linenumber, l_extendedprice AS label, l_quantity AS x0, l_discount AS x1 FROM lineitem",
)
def m7(t: Tables) -> DataFrame:
    matrix = scale.design(
        t("lineitem"), "l_extendedprice", ["l_quantity", "l_discount"], ["l_orderkey", "l_linenumber"]
    )
    x = F.col("features")
    return matrix.select("l_orderkey", "l_linenumber", "label", x[0].alias("x0"), x[1].alias("x1"))


# --- report feeds ----------------------------------------------------------------------


@query(
    "g1_line_feed",
    with_views(
        " UNION ALL ".join(f"SELECT ts, '{e}' AS series, round({e}, 4) AS value FROM hourly_wide" for e in TYPES),
        "hourly_wide",
    ),
)
def g1(t: Tables) -> DataFrame:
    return rounded(columns.to_long(views.hourly_wide(t), ["ts"], TYPES), 4, "value")


@query(
    "g2_actual_vs_predicted",
    with_views(
        """SELECT segment, row_number() OVER (PARTITION BY segment ORDER BY day) - 1 AS step, 'actual' AS series,
             round(actual, 4) AS value FROM predictions
           UNION ALL SELECT segment, row_number() OVER (PARTITION BY segment ORDER BY day) - 1, 'predicted',
             round(prediction, 4) FROM predictions""",
        "predictions",
    ),
)
def g2(t: Tables) -> DataFrame:
    narrow = views.predictions(t).select(
        "segment", "day", "actual", F.col("prediction").alias("predicted")
    )
    stepped = blocks.with_position(narrow, ["segment"], "day", "step", **DAILY).withColumn("step", F.col("step") - 1)
    return rounded(columns.to_long(stepped, ["segment", "step"], ["actual", "predicted"]), 4, "value")


WORDS = r"""SELECT doc_id, unnest(regexp_split_to_array(replace(text, '<', ''), '[ \t\n\f\r\x0B]+')) AS word FROM documents"""


@query(
    "g3_marker_counts",
    f"""SELECT feature, count(*) AS n FROM (SELECT replace(word, 'license', '') AS feature FROM ({WORDS})
          WHERE contains(lower(word), 'license')) WHERE feature <> '' GROUP BY 1""",
)
def g3(t: Tables) -> DataFrame:
    # Remove a prefix, split into words, keep those of one entity, strip it, count.
    # A text without the entity has no such word, so it is not split at all.
    stripped = t("documents").select(scalar.remove_text("text", "<").alias("text"))
    marked = stripped.filter(scalar.contains_ignoring_case("text", "license"))
    word = F.explode(scalar.words("text")).alias("word")
    mine = marked.select(word).filter(scalar.contains_ignoring_case("word", "license"))
    named = mine.select(scalar.remove_text("word", "license").alias("feature")).filter(scalar.is_filled("feature"))
    return quality.value_counts(named, "feature").orderBy(F.desc("n"), "feature")


@query(
    "g4_marker_timeline",
    """SELECT ts AS date, unnest(regexp_split_to_array(replace(props, '"', ''), ' +')) AS feature FROM events""",
)
def g4(t: Tables) -> DataFrame:
    return columns.event_rows(t("events"), "ts", scalar.words(scalar.remove_text("props", '"')))


@query(
    "g5_correlation_heatmap",
    """SELECT a AS column_a, b AS column_b, round(c, 6) AS corr FROM (
         SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, corr(l_quantity, l_extendedprice) AS c FROM lineitem
         UNION ALL SELECT 'l_extendedprice', 'l_quantity', corr(l_quantity, l_extendedprice) FROM lineitem
         UNION ALL SELECT 'l_quantity', 'l_quantity', 1.0::DOUBLE
         UNION ALL SELECT 'l_extendedprice', 'l_extendedprice', 1.0::DOUBLE)""",
)
def g5(t: Tables) -> DataFrame:
    return rounded(profile.correlation_matrix(t("lineitem"), ["l_quantity", "l_extendedprice"]), 6, "corr")


@query(
    "g6_completeness_timeline",
    with_views(f"SELECT ts, CAST({NULLS} <= 1 AS INTEGER) AS keep FROM hourly_wide", "hourly_wide"),
)
def g6(t: Tables) -> DataFrame:
    return views.hourly_wide(t).select("ts", scalar.flag_as_int(quality.is_complete(TYPES)).alias("keep"))


@query(
    "g7_scatter",
    with_views(
        "SELECT round(click, 4) AS x, round(view, 4) AS y FROM hourly_wide WHERE signup IS NOT NULL", "hourly_wide"
    ),
)
def g7(t: Tables) -> DataFrame:
    present = views.hourly_wide(t).filter(F.col("signup").isNotNull())
    return present.select(F.round("click", 4).alias("x"), F.round("view", 4).alias("y"))


@query(
    "g8_overlay",
    with_views(
        """SELECT segment, day, CASE WHEN year(day) = 2001 THEN 'test' ELSE 'train' END AS part, round(actual, 4) AS value FROM predictions
           UNION ALL SELECT segment, day, 'forecast', round(prediction, 4) FROM predictions""",
        "predictions",
    ),
)
def g8(t: Tables) -> DataFrame:
    served = views.predictions(t)
    train, test = quality.split_by_year(served, "day", TEST_YEAR)

    def part(df: DataFrame, label: str, column: str) -> DataFrame:
        return df.select("segment", "day", F.lit(label).alias("part"), F.round(column, 4).alias("value"))

    return (
        part(train, "train", "actual")
        .unionByName(part(test, "test", "actual"))
        .unionByName(part(served, "forecast", "prediction"))
    )


@query(
    "x15_horizon_metrics",
    with_views(
        """SELECT segment, round(avg(abs(actual - prediction)), 4) AS mae, round(sqrt(avg(pow(actual - prediction, 2))), 4) AS rmse,
             round(avg(abs((actual - prediction) / nullif(actual, 0))) * 100, 4) AS mape, count(*) AS n FROM
           (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY day DESC) AS rn FROM predictions) WHERE rn <= 168
           GROUP BY segment""",
        "predictions",
    ),
)
def x15(t: Tables) -> DataFrame:
    horizon = lags.last_rows(views.predictions(t), "day", 168, ["segment"])
    return horizon.groupBy("segment").agg(
        F.round(errors.mae("actual", "prediction"), 4).alias("mae"),
        F.round(errors.rmse("actual", "prediction"), 4).alias("rmse"),
        F.round(errors.mape("actual", "prediction"), 4).alias("mape"),
        errors.pairs("actual", "prediction").alias("n"),
    )


@query(
    "x13_compare_runs",
    with_views(
        """SELECT segment, round(avg(abs(r - l1)) FILTER (l1 IS NOT NULL), 4) AS lag_1, round(avg(abs(r - l7)), 4) AS lag_7 FROM
           (SELECT segment, revenue AS r, lag(revenue, 1) OVER w AS l1, lag(revenue, 7) OVER w AS l7 FROM segment_dense
            WINDOW w AS (PARTITION BY segment ORDER BY day)) GROUP BY 1""",
        "segment_dense",
    ),
)
def x13(t: Tables) -> DataFrame:
    lagged = lags.lag_features(
        views.segment_dense(t), "day", "revenue", [1, 7], ["segment"], drop_incomplete=False, **DAILY
    )
    log = lagged.groupBy("segment").agg(
        *[errors.mae("revenue", f"lag_{k}").alias(f"lag_{k}") for k in (1, 7)]
    )
    rows = [
        tables.metric_rows(log, F.lit(run), F.lit(0), {run: "val/mae"}, ["segment"])
        for run in ("lag_1", "lag_7")
    ]
    wide = evaluate.compare_runs(rows[0].unionByName(rows[1]), ["lag_1", "lag_7"], "val/mae", ["segment"])
    return rounded(wide, 4, "lag_1", "lag_7")
