"""Cut windows equal single windows, and sums of products equal direct fits."""

import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F
from tidemill.models import additive, gram, lagged, walkforward
from tidemill.operators import blocks, profile, resample, stationarity

LAYOUTS = [
    {"chunk": "minute", "block_rows": 3},
    {"chunk": "hour", "block_rows": 5},
    {"chunk": "day", "block_rows": 100_000},
    {"block_rows": None},
]


def table(frame, rng, sizes, missing=0.2, minutes=17):
    rows = []
    for key, n in sizes.items():
        at = dt.datetime(2024, 1, 1)
        for i in range(n):
            at += dt.timedelta(minutes=int(rng.integers(1, minutes)))
            value = None if rng.random() < missing else float(np.round(rng.normal(), 3))
            rows.append((key, str(at), i, value))
    return frame(rows, "k string, ts timestamp_ntz, i int, x double")


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("keys", [["k"], []])
def test_windows(frame, layout, keys):
    df = table(frame, np.random.default_rng(1), {"a": 40, "b": 1, "c": 13})
    order = ["ts", "k"]
    whole = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order)
    lag = blocks.over_blocks(
        df, keys, "ts", 3, lambda w: {"l1": F.lag("x", 1).over(w), "l3": F.lag("x", 3).over(w)}, ["k"],
        position_col="pos", **layout,
    )
    plain = df.withColumns(
        {"l1": F.lag("x", 1).over(whole), "l3": F.lag("x", 3).over(whole), "pos": F.row_number().over(whole).cast("bigint")}
    )
    names = [*df.columns, "l1", "l3", "pos"]
    assert same(lag.select(*names), plain.select(*names))
    ints = df.withColumn("x", F.col("i").cast("bigint"))
    total = blocks.running_sum(ints, keys, "ts", {"s": "x"}, ["k"], **layout)
    direct = ints.withColumn("s", F.sum("x").over(whole.rowsBetween(Window.unboundedPreceding, 0)))
    assert same(total.select("k", "ts", "s"), direct.select("k", "ts", "s"))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-1000, 1000), min_size=2, max_size=30), st.sampled_from(LAYOUTS))
def test_diff_undoes_running_sum(frame, numbers, layout):
    rows = [(str(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=40 * i)), v) for i, v in enumerate(numbers)]
    df = frame(rows, "ts timestamp_ntz, x bigint")
    summed = blocks.running_sum(df, [], "ts", {"s": "x"}, **layout).drop("x")
    steps = resample.per_step(summed, "ts", ["s"], **layout).orderBy("ts").collect()
    assert [r.s for r in steps] == numbers[1:]


@pytest.mark.parametrize("layout", LAYOUTS[1:])
def test_tests_do_not_depend_on_layout(frame, layout):
    rng = np.random.default_rng(3)
    df = table(frame, rng, {"a": 150, "b": 90}, missing=0.05)
    reference = {"block_rows": None}
    wide = {**layout, "block_rows": 40} if layout.get("block_rows") else layout
    for test in (stationarity.adf, stationarity.kpss):
        one = {r.k: r for r in test(df, "ts", "x", ["k"], **reference).collect()}
        two = {r.k: r for r in test(df, "ts", "x", ["k"], **(wide if test is stationarity.adf else {**wide, "block_rows": wide["block_rows"] and 70})).collect()}
        assert one.keys() == two.keys()
        for k in one:
            assert one[k].statistic == pytest.approx(two[k].statistic, rel=1e-9)
            assert one[k].used_lag == two[k].used_lag and one[k].n_obs == two[k].n_obs


def test_adf_separates_walk_from_noise(frame):
    rng = np.random.default_rng(5)
    noise = rng.normal(size=400)
    rows = [
        (k, str(dt.datetime(2020, 1, 1) + dt.timedelta(days=i)), float(v))
        for k, xs in {"noise": noise, "walk": np.cumsum(noise)}.items()
        for i, v in enumerate(xs)
    ]
    df = frame(rows, "k string, ts timestamp_ntz, x double")
    found = {r.k: r for r in stationarity.adf(df, "ts", "x", ["k"], block_rows=None).collect()}
    assert found["noise"].p_value < 0.01 < 0.05 < found["walk"].p_value


def direct_kpss(x):
    n, z = len(x), x - x.mean()
    product = [float(z[k:] @ z[: n - k]) for k in range(n)]
    short = int(n ** (2 / 9))
    s0 = product[0] / n + sum(product[i] / (n / 2) for i in range(1, short + 1))
    s1 = sum(i * product[i] / (n / 2) for i in range(1, short + 1))
    lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    variance = product[0] + 2 * sum(product[i] * (1 - i / (lags + 1)) for i in range(1, lags + 1))
    return float(np.sum(np.cumsum(z) ** 2)) / n**2 / (variance / n), lags


@pytest.mark.parametrize("first_lags", [1, 3, 60])
def test_kpss_against_direct_sums(frame, first_lags):
    """Also when the first pass holds too few lags and is repeated."""
    rng = np.random.default_rng(12)
    made = {"noise": rng.normal(size=200), "drift": np.arange(200) * 0.05 + rng.normal(size=200)}
    rows = [
        (k, str(dt.datetime(2020, 1, 1) + dt.timedelta(days=i)), float(v)) for k, xs in made.items() for i, v in enumerate(xs)
    ]
    df = frame(rows, "k string, ts timestamp_ntz, x double")
    found = {r.k: r for r in stationarity.kpss(df, "ts", "x", ["k"], first_lags=first_lags, block_rows=None).collect()}
    for k, xs in made.items():
        statistic, lags = direct_kpss(xs)
        assert found[k].statistic == pytest.approx(statistic, rel=1e-9) and found[k].used_lag == lags
    assert found["noise"].p_value == 0.10 and found["drift"].p_value == 0.01


def test_adf_against_direct_regression(frame):
    rng = np.random.default_rng(11)
    x = np.cumsum(rng.normal(size=120)) * 0.3 + rng.normal(size=120)
    rows = [(str(dt.datetime(2020, 1, 1) + dt.timedelta(days=i)), float(v)) for i, v in enumerate(x)]
    found = stationarity.adf(frame(rows, "ts timestamp_ntz, x double"), "ts", "x", chunk="month", block_rows=50).first()
    top = int(np.ceil(12 * (len(x) / 100) ** 0.25))
    d = np.diff(x)

    def regress(lag, start):
        t = np.arange(start, len(d))
        z = np.column_stack([np.ones(len(t)), x[t], *[d[t - j] for j in range(1, lag + 1)]])
        beta, *_ = np.linalg.lstsq(z, d[t], rcond=None)
        loss = float(np.sum((d[t] - z @ beta) ** 2))
        return z, beta, loss, len(t)

    scores = []
    for lag in range(top + 1):
        _, _, loss, n = regress(lag, top)
        scores.append((n * np.log(loss / n) + 2 * (2 + lag), lag))
    best = min(scores)[1]
    z, beta, loss, n = regress(best, best)
    error = np.sqrt(loss / (n - 2 - best) * np.linalg.inv(z.T @ z)[1, 1])
    assert (found.used_lag, found.n_obs) == (best, n)
    assert found.statistic == pytest.approx(beta[1] / error, rel=1e-8)


def daily(frame, keys, n, make):
    rows = []
    for k in keys:
        for i in range(n):
            day = dt.datetime(2020, 1, 1) + dt.timedelta(days=i)
            rows.append((k, str(day), *make(k, i)))
    return frame(rows, "k string, ds timestamp_ntz, y double, w double, is_test boolean")


def test_additive_recovers_trend_and_wave(frame):
    df = daily(
        frame, "ab", 400,
        lambda k, i: (
            (2.0 if k == "a" else 5.0) * i + 100 * math.sin(2 * math.pi * (18262 + i) / 7.0), 0.0, i >= 350
        ),
    )
    spec = additive.Spec(changepoints=0, yearly_order=0, weekly_order=1, noise=1e-6)
    fitted = additive.fit(df.filter("NOT is_test"), spec, series_cols=["k"])
    worst = additive.predict(fitted, df, interval=True).agg(F.max(F.abs(F.col("y") - F.col("yhat")))).first()[0]
    assert worst < 1e-3
    parts = additive.components(fitted, df.select("k", "ds")).groupBy("k", "ds").agg(F.sum("value").alias("s"))
    gap = parts.join(additive.predict(fitted, df), ["k", "ds"]).agg(F.max(F.abs(F.col("s") - F.col("yhat")))).first()[0]
    assert gap < 1e-6


@pytest.mark.parametrize("block_rows", [7, 5000])
@pytest.mark.parametrize("horizon", [1.0, 1.5])
def test_walk_forward_equals_refits(frame, block_rows, horizon):
    rng = np.random.default_rng(2)
    df = daily(
        frame, "ab", 60,
        lambda k, i: (None if i in (10, 45) else float(50 + i + 10 * rng.normal()), float(i % 7 > 4), i >= 40),
    )
    spec = additive.Spec(regressors=("w",), changepoints=3, yearly_order=0, weekly_order=1)
    found = {
        (r.k, r.ds): r
        for r in walkforward.walk_forward(
            df, "is_test", spec, series_cols=["k"], horizon=horizon, block_rows=block_rows, chunk="month"
        ).collect()
    }
    rows = sorted(df.collect(), key=lambda r: (r.k, r.ds))
    assert len(found) == 40
    design = additive.terms(spec, horizon)
    penalty = np.array(additive.penalty_numbers(spec, design))
    for k in "ab":
        mine = [r for r in rows if r.k == k]
        first = mine[0].ds
        size = max(abs(r.y) for r in mine if not r.is_test and r.y is not None)

        def vector(r):
            t = (r.ds - first).days / 39.0
            days = (r.ds - dt.datetime(1970, 1, 1)).days
            knots = [max(t - d.knot, 0.0) for d in design if d.knot is not None]
            angle = days * 2 * np.pi / 7.0
            return np.array([1.0, t, *knots, np.sin(angle), np.cos(angle), r.w])

        for i, r in enumerate(mine):
            if not r.is_test:
                continue
            past = [p for p in mine[:i] if p.y is not None]
            z = np.array([vector(p) for p in past])
            y = np.array([p.y / size for p in past])
            t = vector(r)[1]
            live = [
                j for j, d in enumerate([None, *design])
                if d is None or d.knot is None or int(d.name.split("_")[1]) <= 3 or d.knot <= 0.8 * t
            ]
            beta = np.linalg.solve(z[:, live].T @ z[:, live] + np.diag(penalty[live]), z[:, live].T @ y)
            got = found[(k, r.ds)]
            assert got.yhat == pytest.approx(float(vector(r)[live] @ beta) * size, rel=1e-8)
            assert got.n_train == len(past) and got.actual == r.y


def test_grid_equals_separate_fits(frame):
    rng = np.random.default_rng(4)
    df = daily(frame, "a", 80, lambda k, i: (float(i + 5 * rng.normal()), 0.0, i >= 60))
    spec = additive.Spec(changepoints=4, yearly_order=0, weekly_order=1)
    grid = {"changepoint_prior_scale": [0.01, 1.0], "seasonality_prior_scale": [0.1, 10.0]}
    found = additive.grid_search(df, "is_test", spec, grid, series_cols=["k"]).collect()
    assert sorted(r.rank for r in found) == [1, 2, 3, 4]
    for r in found:
        one = additive.Spec(
            changepoints=4, yearly_order=0, weekly_order=1,
            changepoint_prior_scale=r.changepoint_prior_scale, seasonality_prior_scale=r.seasonality_prior_scale,
        )
        fitted = additive.fit(df.filter("NOT is_test"), one, series_cols=["k"])
        scored = additive.predict(fitted, df.filter("is_test"))
        assert r.mse == pytest.approx(scored.agg(F.avg((F.col("y") - F.col("yhat")) ** 2)).first()[0], rel=1e-6)


def test_elastic_net_without_penalty_is_least_squares():
    rng = np.random.default_rng(6)
    z = np.column_stack([np.ones(50), rng.normal(size=(50, 2))])
    y = z @ np.array([1.0, 2.0, -3.0]) + 0.01 * rng.normal(size=50)
    both = np.column_stack([z, y])
    packed = gram.triangle(both.T @ both)
    assert np.allclose(gram.square(packed), both.T @ both)
    import pandas as pd

    free = gram.elastic_net(0.0, 0.0).func(pd.Series([packed]))[0]
    assert np.allclose(free, np.linalg.lstsq(z, y, rcond=None)[0], atol=1e-6)
    shrunk = gram.elastic_net(10.0, 0.0).func(pd.Series([packed]))[0]
    assert shrunk[1] == 0 and shrunk[2] == 0


def test_pooled_estimator_and_history(frame):
    from pyspark.ml.regression import LinearRegression

    rng = np.random.default_rng(8)
    df = daily(frame, "ab", 60, lambda k, i: (float(10 * np.sin(i) + rng.normal()), float(i % 7 > 4), i >= 45))
    prepared = lagged.prepare_lags(df, "ds", "y", [1, 2], "is_test", ["w"], ["k"], block_rows=None)
    model, found = lagged.pooled(prepared, LinearRegression(solver="l-bfgs"))
    assert found.count() == 30
    assert lagged.objective_history(df.sparkSession, model).count() >= 2
    history = lagged.training_history(prepared, epochs=5).orderBy("k", "step").collect()
    losses = [r["train/loss"] for r in history if r.k == "a"]
    assert len(losses) == 5 and losses == sorted(losses, reverse=True)


def test_lagged_products_match_layouts(frame):
    df = table(frame, np.random.default_rng(9), {"a": 30, "b": 5}, missing=0.1)
    one = profile.lagged_products(df, "ts", "x", 4, ["k"], squares=True, block_rows=None)
    two = profile.lagged_products(df, "ts", "x", 4, ["k"], squares=True, chunk="hour", block_rows=6)
    two = {r.k: r for r in two.collect()}
    for r in one.collect():
        assert r.n == two[r.k].n
        assert r.products == pytest.approx(two[r.k].products, abs=1e-9)
        assert r.squares == pytest.approx(two[r.k].squares, rel=1e-9)
