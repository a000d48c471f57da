"""Small tables with the expected rows written out."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from tidemill.functions import calendar, errors, scalar
from tidemill.operators import (
    columns,
    dimensions,
    encode,
    joins,
    lags,
    profile,
    quality,
    resample,
    scale,
    stationarity,
)
from tidemill.sources import tables


def series(frame, values, start="2024-01-01", step_hours=1, kind="double"):
    t0 = dt.datetime.fromisoformat(start)
    rows = [(str(t0 + dt.timedelta(hours=i * step_hours)), v) for i, v in enumerate(values)]
    return frame(rows, f"ts timestamp_ntz, x {kind}")


def values(df, column, order="ts"):
    return [r[0] for r in df.orderBy(order).select(column).collect()]


@pytest.mark.parametrize("layout", [{}, {"block_rows": None}, {"block_rows": 2, "chunk": "hour"}])
@pytest.mark.parametrize(
    ("flags", "ids"), [("TTFT", [1, 1, 2, 3]), ("FTFT", [1, 2, 3, 4])]
)
def test_run_ids(frame, flags, ids, layout):
    df = series(frame, [None if f == "T" else 1.0 for f in flags])
    assert values(quality.run_ids(df, F.col("x").isNull(), "ts", **layout), "run_id") == ids
    runs = {r.run_id: r.n_rows for r in quality.missing_runs(df, "x", "ts", **layout).collect()}
    assert runs == ({1: 2, 3: 1} if flags == "TTFT" else {2: 1, 4: 1})


@pytest.mark.parametrize("layout", [{}, {"block_rows": None}, {"block_rows": 1, "chunk": "hour"}])
def test_per_step(frame, layout):
    df = series(frame, [1.0, None, 4.0, 6.0])
    assert values(resample.per_step(df, "ts", ["x"], **layout), "x") == [None, None, 2.0]


def test_resample_fills_days(frame):
    rows = [("2024-01-01 00:00:00", 1.0), ("2024-01-01 01:00:00", 2.0), ("2024-01-03 01:00:00", 5.0)]
    df = frame(rows, "ts timestamp_ntz, x double")
    for layout in ({}, {"block_rows": None}):
        assert values(resample.resample_mean(df, "ts", ["x"], **layout), "x") == [1.5, None, 5.0]


def test_daily_modes(frame):
    df = series(frame, [float(t * t) for t in range(72)])
    assert values(resample.daily_use(df, "ts", ["x"]), "x") == [1128.0, 2280.0]
    assert values(resample.daily_use(df, "ts", ["x"], mode="sum_of_diff"), "x") == [529.0, 1680.0, 2832.0]


def test_row_arithmetic(frame):
    df = frame([(1.0, 2.0), (None, 3.0), (None, None)], "a double, b double")
    assert [r[0] for r in df.select(scalar.row_sum(["a", "b"])).collect()] == [3.0, 3.0, 0.0]
    assert [r[0] for r in df.select(F.col("a") + F.col("b")).collect()] == [3.0, None, None]


def test_words(frame):
    df = frame([(" a  b ",), ("",), (None,)], "x string")
    assert [r[0] for r in df.select(F.explode(scalar.words("x"))).collect()] == ["a", "b"]


def test_complete_rows(frame):
    names = [f"c{i}" for i in range(9)]
    rows = [(1.0,) * 9, (None,) + (1.0,) * 8, (None, None) + (1.0,) * 7]
    df = frame(rows, ", ".join(f"{n} double" for n in names))
    assert [r[0] for r in df.select(quality.is_complete(names)).collect()] == [True, True, False]


def test_trim_keeps_interior(frame):
    df = series(frame, [None, 1.0, None, 2.0, None])
    assert values(quality.trim_to_complete(df, ["x"], "ts"), "x") == [1.0, None, 2.0]


def test_slice_is_inclusive(frame):
    df = series(frame, [0.0, 1.0, 2.0, 3.0, 4.0])
    kept = quality.between_times(df, "ts", "2024-01-01 01:00:00", "2024-01-01 03:00:00")
    assert values(kept, "x") == [1.0, 2.0, 3.0]


def test_correlation_with_constant(frame):
    df = frame([(1.0, 2.0, 1.0), (2.0, 1.0, 1.0), (3.0, None, 1.0), (None, 9.0, 1.0)], "x double, y double, k double")
    found = {(r.column_a, r.column_b): r["corr"] for r in profile.correlation_matrix(df, ["x", "y", "k"]).collect()}
    assert found[("x", "y")] == pytest.approx(-1.0)
    assert found[("x", "k")] is None and found[("k", "k")] is None


def test_histogram(frame):
    spread = frame([(v,) for v in (0.0, 1.0, 2.0, 3.0, 3.0)], "x double")
    assert values(profile.histogram(spread, ["x"], 3), "n", "bin") == [1, 1, 3]
    constant = frame([(2.0,), (2.0,)], "x double")
    found = profile.histogram(constant, ["x"], 3).orderBy("bin").collect()
    assert [r.n for r in found] == [0, 2, 0]
    assert (found[0].bin_start, found[2].bin_end) == (1.5, 2.5)


def test_errors(frame):
    df = frame([(1.0, 1.0), (2.0, 1.0), (3.0, 5.0)], "a double, p double")
    mse, rmse, mae = df.agg(errors.mse("a", "p"), errors.rmse("a", "p"), errors.mae("a", "p")).first()
    assert (mse, round(rmse, 6), mae) == (pytest.approx(5 / 3), 1.290994, 1.0)
    zero = frame([(0.0, 1.0), (1.0, 1.0)], "a double, p double")
    assert tuple(zero.agg(errors.mape("a", "p"), errors.zero_actuals("a", "p")).first()) == (0.0, 1)


def test_holiday_modes(frame):
    df = frame([("2015-12-25 05:00:00",)], "ts timestamp_ntz")
    holidays = dimensions.holiday_dimension(dimensions.years_of(df, "ts"))
    flag = "is_holiday_or_weekend"
    assert joins.holiday_or_weekend(df, "ts", holidays).first()[flag] is True
    assert joins.holiday_or_weekend(df, "ts", holidays, match="none").first()[flag] is False


@pytest.mark.parametrize(
    ("year", "day"),
    [(2015, "2015-04-05"), (2016, "2016-03-27"), (2017, "2017-04-16"), (2000, "2000-04-23"), (2038, "2038-04-25")],
)
def test_easter(frame, year, day):
    df = frame([(year,)], "year int")
    assert str(df.select(calendar.easter_sunday(F.col("year"))).first()[0]) == day


def test_one_off_holiday(frame):
    df = frame([(2016,), (2017,)], "year int")
    names = [(r.year, r.name) for r in dimensions.holiday_dimension(df).collect() if r.name == "Reformation Day"]
    assert names == [(2017, "Reformation Day")]
    assert dimensions.holiday_dimension(df).count() == 25


def test_time_of_day_and_season(frame):
    hours = frame([(f"2024-01-01 {h:02d}:00:00",) for h in (0, 5, 6, 11, 12, 17, 18, 23)], "ts timestamp_ntz")
    assert values(hours, calendar.time_of_day("ts")) == [
        "night", "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening",
    ]
    months = frame([(f"2024-{m:02d}-15 00:00:00",) for m in (2, 3, 5, 6, 8, 9, 11, 12)], "ts timestamp_ntz")
    assert values(months, calendar.season("ts")) == [
        "winter", "spring", "spring", "summer", "summer", "autumn", "autumn", "winter",
    ]


def test_twilight_at_equinox_and_polar_day(frame):
    df = frame([("2024-03-20", 47.66, 9.18), ("2024-06-21", 75.0, 0.0)], "day date, la double, lo double")
    place = F.col("day"), F.col("la"), F.col("lo")
    rows = df.select(calendar.dawn(*place).alias("dawn"), calendar.dusk(*place).alias("dusk")).collect()
    # Sunrise in Konstanz that day is about 05:27 UTC and sunset about 17:35; civil twilight is half an hour.
    assert dt.datetime(2024, 3, 20, 4, 50) < rows[0].dawn < dt.datetime(2024, 3, 20, 5, 5)
    assert dt.datetime(2024, 3, 20, 17, 55) < rows[0].dusk < dt.datetime(2024, 3, 20, 18, 15)
    assert rows[1].dawn is None and rows[1].dusk is None


def test_remove_from_names(frame):
    df = frame([(1,)], "DE_X_DE_y int")
    assert columns.remove_from_names(df, "DE_").columns == ["X_y"]


@pytest.mark.parametrize("layout", [{}, {"block_rows": None}, {"block_rows": 2, "chunk": "hour"}])
def test_sequences_keep_nulls(frame, layout):
    df = series(frame, [1.0, None, 3.0, 4.0]).withColumn("known", F.lit(1.0))
    found = lags.sequences(df, "ts", "x", ["x"], ["known"], 2, **layout).orderBy("ts").collect()
    assert [[v[0] for v in r.past] for r in found] == [[1.0, None], [None, 3.0]]
    assert [r.label for r in found] == [3.0, 4.0]


def test_lags_across_split(frame):
    df = series(frame, [1.0, 2.0, 3.0, 4.0]).withColumn("is_test", F.hour("ts") >= 2)
    found = lags.lagged_split(df, "ts", "x", [1], "is_test").orderBy("ts").collect()
    assert [(r.x, r.x_lag_1) for r in found] == [(2.0, 1.0), (3.0, 2.0), (4.0, 3.0)]


def test_min_max(frame):
    train = frame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    test = frame([(5.0, 7.0), (None, 5.0)], "x double, k double")
    scaler = scale.fit_min_max(train, ["x", "k"])
    assert [tuple(r) for r in scaler.apply(train).collect()] == [(0.0, 0.0), (1.0, 0.0)]
    assert [tuple(r) for r in scaler.apply(test).collect()] == [(2.0, 2.0), (None, 0.0)]
    back = scaler.invert(scaler.apply(test), "x", ["x"])
    assert [r.x for r in back.collect()] == [5.0, None]


def test_one_hot(frame):
    train = frame([(s, b) for s, b in zip(("winter", "autumn", "spring", "summer"), (True, False) * 2)], "season string, flag boolean")
    encoder = encode.fit_one_hot(train, ["season", "flag"])
    assert encoder.names == ["season_spring", "season_summer", "season_winter", "flag_True"]
    test = frame([("monsoon", None), ("winter", True)], "season string, flag boolean")
    assert [tuple(r) for r in encoder.apply(test).collect()] == [(0.0,) * 4, (0.0, 0.0, 1.0, 1.0)]
    with pytest.raises(ValueError, match="more than 3"):
        encode.fit_one_hot(train, ["season"], max_categories=3)


def test_verdicts_round_first(frame):
    df = frame([(0.0504,), (0.0506,)], "p double")
    found = df.select(
        stationarity.adf_verdict(F.col("p")).alias("a"), stationarity.kpss_verdict(F.col("p")).alias("k")
    ).collect()
    assert [tuple(r) for r in found] == [("Stationary", "Non-stationary"), ("Non-stationary", "Stationary")]


@pytest.mark.parametrize("layout", [{}, {"block_rows": None}, {"block_rows": 2, "chunk": "hour"}])
def test_acf_and_pacf(frame, layout):
    df = series(frame, [1.0, 2.0, 3.0, 4.0])
    assert values(profile.acf(df, "ts", "x", 2, **layout), F.round("acf", 6), "lag") == [1.0, 0.25, -0.3]
    assert values(profile.pacf(df, "ts", "x", 1, **layout), F.round("pacf", 6), "lag") == [1.0, 0.25]


def test_parse_timestamp(frame):
    df = frame([("2015-10-01T00:00:00Z",), ("2015-10-01 00:00:00+00:00",), ("2015-10-01 00:00:00",)], "x string")
    assert {r[0] for r in df.select(scalar.parse_timestamp("x")).collect()} == {dt.datetime(2015, 10, 1)}


def test_run_names(frame):
    df = frame([(0.001, None), (0.5, "mine")], "lr double, name string")
    generated = tables.lag_run_name(F.lit("Net"), F.col("lr"), F.array(F.lit(1), F.lit(2)))
    found = [r[0] for r in df.select(tables.run_name(F.col("name"), generated)).collect()]
    assert found == ["Net_lr0.001_seq[1, 2]", "mine"]


def test_metric_names_are_a_contract(frame):
    df = frame([(1.0,)], "loss double")
    with pytest.raises(ValueError, match="unknown metric"):
        tables.metric_rows(df, F.lit("r"), F.lit(0), {"loss": "loss"})


def test_country_grid_columns(frame):
    from tidemill.plans import household

    df = frame([("2020-01-01 00:00:00", 1.0, 2.0, 3.0, 4.0)],
               "utc_timestamp timestamp_ntz, DE_load double, DE_LU_price double, DE_Wind_onshore double, FR_load double")
    assert household.country_grid(df, household.Site()).columns == ["utc_timestamp", "load"]


def test_rows_with_an_open_day_cross_clock_changes(spark, frame):
    """Truncation does not depend on the session zone."""
    from tidemill.operators import blocks

    df = frame([("2024-03-10 02:30:00",)], "ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = df.select(*[blocks.truncate(u, "ts") for u in ("minute", "hour", "day", "month", "year")]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [str(v) for v in found] == [
        "2024-03-10 02:30:00", "2024-03-10 02:00:00", "2024-03-10 00:00:00", "2024-03-01 00:00:00", "2024-01-01 00:00:00",
    ]
