"""End-to-end chains of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import errors
from ..models import additive
from ..operators import blocks, dimensions
from ..plans import household
from ..session import scratch_path
from . import views
from .basics import HOLIDAYS, SOLAR
from .registry import Tables, query, rounded
from .views import ONE_SERIES, TYPES, with_views


@query(
    "flow_naive_errors",
    with_views(
        """SELECT segment, round(avg(pow(actual - prediction, 2)), 2) AS mse,
             round(sqrt(avg(pow(actual - prediction, 2))), 4) AS rmse,
             round(avg(abs(actual - prediction)), 4) AS mae, count(*) AS n
           FROM predictions GROUP BY segment""",
        "predictions",
    ),
)
def flow_naive_errors(t: Tables) -> DataFrame:
    scored = views.predictions(t).groupBy("segment").agg(
        errors.mse("actual", "prediction").alias("mse"),
        errors.rmse("actual", "prediction").alias("rmse"),
        errors.mae("actual", "prediction").alias("mae"),
        errors.pairs("actual", "prediction").alias("n"),
    )
    return rounded(rounded(scored, 2, "mse"), 4, "rmse", "mae")


# --- events dressed as a household: cumulative meters, a weather table -----------------

SITE = household.Site(target_source="purchase", dropped=("signup",), layout=ONE_SERIES)
METERS = [e for e in TYPES if e not in ("purchase", "signup")]
CUTOFF = "2024-01-25 00:00:00"


def _household(t: Tables) -> DataFrame:
    wide = views.hourly_wide(t).withColumnsRenamed({"ts": "utc_timestamp"})
    summed = blocks.running_sum(wide, [], "utc_timestamp", {f"_{e}": e for e in TYPES}, **ONE_SERIES)
    prefix = "DE_KN_residential4_"
    missing = [F.when(F.col(e).isNull(), prefix + e) for e in TYPES]
    raw = summed.select(
        "utc_timestamp",
        F.col("utc_timestamp").cast("string").alias("cet_cest_timestamp"),
        *[F.when(F.col(e).isNotNull(), F.col(f"_{e}")).alias(prefix + e) for e in TYPES],
        F.concat_ws(" ", *missing).alias("interpolated"),
    )
    return blocks.settle(raw)  # stands for a table on disk


def _weather(t: Tables) -> DataFrame:
    hour = blocks.truncate("hour", "ts").alias("utc_timestamp")
    return t("events").groupBy(hour).agg(
        F.avg("value").alias("DE_temperature"), F.max("value").alias("FR_temperature")
    )


NULLS = " + ".join(f"CAST({e} IS NULL AS INTEGER)" for e in TYPES)
BASE = {
    "cum": "SELECT ts, "
    + ", ".join(f"CASE WHEN {e} IS NOT NULL THEN sum({e}) OVER (ORDER BY ts) END AS {e}" for e in TYPES)
    + " FROM hourly_wide",
    "trimmed": f"""SELECT * FROM cum WHERE ts BETWEEN (SELECT min(ts) FROM cum WHERE {NULLS} <= 1)
        AND (SELECT max(ts) FROM cum WHERE {NULLS} <= 1)""",
    "weather": "SELECT date_trunc('hour', ts)::TIMESTAMP AS ts, avg(value) AS temperature FROM events GROUP BY 1",
    "years": "SELECT unnest(generate_series((SELECT min(year(ts)) FROM events), (SELECT max(year(ts)) FROM events))) AS y",
    "holidays": HOLIDAYS,
}
CALENDAR = """isodow(u.ts) > 5 OR u.ts::DATE IN (SELECT holiday FROM holidays) AS is_holiday_or_weekend,
    CASE WHEN month(u.ts) IN (12, 1, 2) THEN 'winter' WHEN month(u.ts) < 6 THEN 'spring'
         WHEN month(u.ts) < 9 THEN 'summer' ELSE 'autumn' END AS season"""


def _holidays(t: Tables) -> DataFrame:
    return dimensions.holiday_dimension(dimensions.years_of(t("events"), "ts"))


@query(
    "flow_features_hourly",
    with_views(
        f"""SELECT u.ts AS utc_timestamp, round(purchase, 3) AS energy_demand, {', '.join(f'round({m}, 3) AS {m}' for m in METERS)},
              round(temperature, 6) AS temperature, {CALENDAR}, coalesce(u.ts BETWEEN dawn AND dusk, false) AS daylight_flag,
              CASE WHEN hour(u.ts) < 6 THEN 'night' WHEN hour(u.ts) < 12 THEN 'morning' WHEN hour(u.ts) < 18 THEN 'afternoon'
                   ELSE 'evening' END AS time_of_day
            FROM used u LEFT JOIN weather w ON u.ts = w.ts LEFT JOIN solar s ON u.ts::DATE = s.day""",
        "hourly_wide",
        extra={
            **BASE,
            "used": "SELECT ts, "
            + ", ".join(f"{e} - lag({e}) OVER (ORDER BY ts) AS {e}" for e in TYPES)
            + " FROM trimmed QUALIFY row_number() OVER (ORDER BY ts) > 1",
            "places": "SELECT DISTINCT 0 AS location, 47.66::DOUBLE AS latitude, 9.18::DOUBLE AS longitude, ts::DATE AS day FROM events",
            "solar": SOLAR,
        },
    ),
)
def flow_features_hourly(t: Tables) -> DataFrame:
    readings = household.building_readings(_household(t), SITE)
    merged = household.merged(readings, household.country_weather(_weather(t), SITE), SITE, daily=False)
    found = household.features(merged, SITE, _holidays(t), daily=False)
    return rounded(rounded(found, 3, "energy_demand", *METERS), 6, "temperature")


def _daily(t: Tables) -> DataFrame:
    readings = household.building_readings(_household(t), SITE)
    merged = household.merged(readings, household.country_weather(_weather(t), SITE), SITE, daily=True)
    return household.features(merged, SITE, _holidays(t), daily=True)


# Means of 24 amounts in cents often lie exactly between two rounded values, where the last bit
# of a sum decides. Times this factor they do not, so the comparison sees the values.
SPREAD = 0.7390851332151607


@query(
    "flow_features_daily",
    with_views(
        f"""SELECT u.ts AS utc_timestamp, round(purchase * {SPREAD}, 3) AS energy_demand_spread, {', '.join(f'round({m} * {SPREAD}, 3) AS {m}_spread' for m in METERS)},
              round(temperature, 6) AS temperature, {CALENDAR} FROM used u LEFT JOIN outside w ON u.ts = w.ts""",
        "hourly_wide",
        extra={
            **BASE,
            "days": """SELECT unnest(generate_series((SELECT min(date_trunc('day', ts)::TIMESTAMP) FROM trimmed),
                (SELECT max(date_trunc('day', ts)::TIMESTAMP) FROM trimmed), INTERVAL 1 DAY)) AS ts""",
            "means": "SELECT date_trunc('day', ts)::TIMESTAMP AS ts, "
            + ", ".join(f"avg({e}) AS {e}" for e in TYPES)
            + " FROM trimmed GROUP BY 1",
            "used": "SELECT d.ts, "
            + ", ".join(f"{e} - lag({e}) OVER (ORDER BY d.ts) AS {e}" for e in TYPES)
            + " FROM days d LEFT JOIN means m ON d.ts = m.ts QUALIFY row_number() OVER (ORDER BY d.ts) > 1",
            "outside": "SELECT date_trunc('day', ts)::TIMESTAMP AS ts, avg(temperature) AS temperature FROM weather GROUP BY 1",
        },
    ),
)
def flow_features_daily(t: Tables) -> DataFrame:
    daily = rounded(_daily(t), 6, "temperature")
    names = ["energy_demand", *METERS]
    spread = {f"{c}_spread": F.round(F.col(c) * SPREAD, 3) for c in names}
    return daily.withColumns(spread).drop(*names)


@query(
    "flow_interpolated",
    with_views(
        " UNION ALL ".join(f"SELECT ts AS date, '{e}' AS feature FROM hourly_wide WHERE {e} IS NULL" for e in TYPES),
        "hourly_wide",
    ),
)
def flow_interpolated(t: Tables) -> DataFrame:
    return household.interpolated_features(_household(t), SITE)


@query("flow_additive_experiment")
def flow_additive_experiment(t: Tables) -> DataFrame:
    test = F.col("utc_timestamp") >= F.lit(CUTOFF).cast("timestamp_ntz")
    spec = additive.Spec(changepoint_prior_scale=5.0)
    return household.additive_experiment(_daily(t), test, SITE, spec)["metrics"]


@query("flow_lag_experiment")
def flow_lag_experiment(t: Tables) -> DataFrame:
    test = F.col("utc_timestamp") >= F.lit(CUTOFF).cast("timestamp_ntz")
    return household.lag_experiment(_daily(t), test, SITE, [1, 2])["predictions"]


@query("flow_lag_contemporaneous")
def flow_lag_contemporaneous(t: Tables) -> DataFrame:
    """The lag experiment with the other meters' readings of the predicted day."""
    test = F.col("utc_timestamp") >= F.lit(CUTOFF).cast("timestamp_ntz")
    return household.lag_experiment(_daily(t), test, SITE, [1, 2], contemporaneous=True)["predictions"]


@query("flow_sequence_experiment")
def flow_sequence_experiment(t: Tables) -> DataFrame:
    """Losses and errors of every epoch, and the predictions' errors as step -1: those of the last epoch."""
    test = F.col("utc_timestamp") >= F.lit(CUTOFF).cast("timestamp_ntz")
    found = household.sequence_experiment(_daily(t), test, SITE, steps=2)
    return found["history"].unionByName(found["metrics"].withColumn("step", F.lit(-1).cast("bigint")))


@query("flow_additive_minmax")
def flow_additive_minmax(t: Tables) -> DataFrame:
    test = F.col("utc_timestamp") >= F.lit(CUTOFF).cast("timestamp_ntz")
    spec = additive.Spec(changepoint_prior_scale=0.01, seasonality_prior_scale=0.1)
    return household.additive_experiment(_daily(t), test, SITE, spec, target_scaling="minmax")["predictions"]


@query(
    "flow_feature_tables",
    with_views(
        f"""SELECT 'hourly' AS resolution, CASE WHEN ts >= '{CUTOFF}' THEN 'test' ELSE 'train' END AS split,
              count(*) AS n, round(sum(purchase), 2) AS total FROM hourly_used GROUP BY 1, 2
            UNION ALL SELECT 'daily', CASE WHEN ts >= '{CUTOFF}' THEN 'test' ELSE 'train' END, count(*), round(sum(purchase), 2)
            FROM daily_used GROUP BY 1, 2""",
        "hourly_wide",
        extra={
            "cum": BASE["cum"],
            "trimmed": BASE["trimmed"],
            "hourly_used": """SELECT ts, purchase - lag(purchase) OVER (ORDER BY ts) AS purchase FROM trimmed
                QUALIFY row_number() OVER (ORDER BY ts) > 1""",
            "days": """SELECT unnest(generate_series((SELECT min(date_trunc('day', ts)::TIMESTAMP) FROM trimmed),
                (SELECT max(date_trunc('day', ts)::TIMESTAMP) FROM trimmed), INTERVAL 1 DAY)) AS ts""",
            "means": "SELECT date_trunc('day', ts)::TIMESTAMP AS ts, avg(purchase) AS purchase FROM trimmed GROUP BY 1",
            "daily_used": """SELECT d.ts, purchase - lag(purchase) OVER (ORDER BY d.ts) AS purchase
                FROM days d LEFT JOIN means m ON d.ts = m.ts QUALIFY row_number() OVER (ORDER BY d.ts) > 1""",
        },
    ),
)
def flow_feature_tables(t: Tables) -> DataFrame:
    """Both feature tables written by split, and what a reader finds there."""
    readings = household.building_readings(_household(t), SITE)
    weather = household.country_weather(_weather(t), SITE)
    made = {
        name: household.features(household.merged(readings, weather, SITE, daily), SITE, _holidays(t), daily)
        for name, daily in {"hourly": False, "daily": True}.items()
    }
    test = F.col("utc_timestamp") >= F.lit(CUTOFF).cast("timestamp_ntz")
    paths = household.write_feature_tables(made["hourly"], made["daily"], scratch_path(t.spark, "features"), dict.fromkeys(made, test))
    found = [
        t.spark.read.parquet(path)
        .groupBy(F.lit(name).alias("resolution"), "split")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("energy_demand"), 2).alias("total"))
        for name, path in paths.items()
    ]
    return found[0].unionByName(found[1])
