"""Positions by range, models as functions, rolling origins and growing fits."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemill.models import additive, gram, per_series
from tidemill.operators import blocks
from tidemill.sources import tables


@pytest.fixture(scope="module")
def crowded(spark):
    """Half of all rows are one moment of one series; the rest is spread over short series."""
    hot = spark.range(4000).selectExpr("'hot' AS s", "TIMESTAMP_NTZ '2024-01-01 05:00:00' AS ts", "id AS tie", "CAST(id % 7 AS DOUBLE) AS v")
    more = spark.range(4000).selectExpr(
        "concat('s', id % 40) AS s", "timestampadd(MINUTE, CAST(id * 37 % 5000 AS INT), TIMESTAMP_NTZ '2024-01-01') AS ts", "id AS tie", "CAST(id AS DOUBLE) AS v"
    )
    return hot.union(more).repartition(6)


def test_positions_cut_one_moment(crowded):
    placed = blocks.with_position(crowded, ["s"], "ts", "position", ["tie"])
    want = crowded.toPandas().sort_values(["s", "ts", "tie"])
    want["position"] = want.groupby("s").cumcount() + 1
    found = placed.toPandas().sort_values(["s", "ts", "tie"])
    assert found["position"].tolist() == want["position"].tolist()
    ranged = blocks._ranged(crowded, ["s"], "ts", ["tie"], {"n": F.count(F.lit(1))})
    if len(ranged.select("_part").distinct().collect()) > 1:  # small tables may be coalesced to one
        assert ranged.where("s = 'hot'").select("_part").distinct().count() > 1
    whole = blocks.with_position(crowded, [], "ts", "position", ["s", "tie"])
    assert sorted(r.position for r in whole.collect()) == list(range(1, 8001))
    assert blocks.with_position(crowded.where("false"), ["s"], "ts").count() == 0


def test_running_sum_by_range(crowded, spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        summed = blocks.running_sum(crowded, ["s"], "ts", {"total": "v"}, ["tie"]).toPandas().sort_values(["s", "ts", "tie"])
        parts = blocks._ranged(crowded, ["s"], "ts", ["tie"], {"n": F.count(F.lit(1))}).where("s = 'hot'").select("_part").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts > 1
    assert np.allclose(summed["total"], summed.groupby("s")["v"].cumsum())


def _level_model():
    """Functions made here travel to the executors by value."""

    def chain(rows, state):
        """Order matters: an exponentially weighted level."""
        level = state
        for v in rows["v"]:
            level = v if level is None else 0.9 * level + 0.1 * v
        return level

    return chain, lambda model, rows: rows[["s", "ts", "tie"]].assign(level=model)


@pytest.mark.parametrize("block_rows", [700, 100_000])
def test_chained_models(crowded, block_rows):
    chain, levels = _level_model()
    rows = crowded.withColumn("is_test", F.col("tie") % 10 == 9)
    found = per_series.per_series(
        rows, "is_test", chain, levels, "s string, ts timestamp_ntz, tie bigint, level double", "ts", ["s"], None, ["tie"], block_rows
    ).toPandas()
    frame = rows.toPandas().sort_values(["s", "ts", "tie"])
    want = {s: chain(g, None) for s, g in frame[~frame["is_test"]].groupby("s")}
    assert len(found) == int(frame["is_test"].sum())
    assert np.allclose(found["level"], found["s"].map(want), equal_nan=True)  # one series is all test: no model


def test_merged_models_and_unknown_series(crowded):
    fit = lambda rows, state: [(len(rows), rows["tie"].iloc[0])]
    models = per_series.fit_series(crowded, fit, "ts", ["s"], lambda a, b: a + b, ["tie"], 150)
    import pickle

    parts = {r.s: pickle.loads(r.model) for r in models.collect()}
    assert [n for n, _ in parts["hot"]] == [150] * 26 + [100] and [t for _, t in parts["hot"]] == list(range(0, 4000, 150))
    assert sum(n for x in parts.values() for n, _ in x) == 8000
    none = lambda model, rows: rows[["s", "ts", "tie"]].assign(known=model is not None)
    rows = crowded.where("s = 's1'").union(crowded.where("s = 's2'").withColumn("s", F.lit("new")))
    found = per_series.predict_series(models, rows, none, "s string, ts timestamp_ntz, tie bigint, known boolean", "ts", ["s"], ["tie"])
    assert {(r.s, r.known) for r in found.collect()} == {("s1", True), ("new", False)}


def test_growing_equals_full_solve():
    rng = np.random.default_rng(2)
    p = 40
    x = np.column_stack((np.ones(900), rng.normal(size=(900, p - 1))))
    x[:, -1] = x[:, 1] + 1e-6 * rng.normal(size=900)  # nearly collinear
    y = x @ rng.normal(size=p) + rng.normal(size=900)
    rows = np.column_stack((x, y))
    penalty = np.full(p, 1e-4)
    model = gram.Growing(rows[:30].T @ rows[:30], penalty, range(p - 5))
    for i in range(30, 900):
        if i == 400:
            model.choose(range(p))
        live = model.columns
        if i % 37 == 0:
            total = rows[:i].T @ rows[:i]
            full = gram.solve(total[np.ix_(live, live)], total[live, -1], penalty[live])
            assert np.allclose(x[:, live] @ model.beta()[live], x[:, live] @ full, rtol=1e-8, atol=1e-8)
        model.learn(rows[i])


def test_rolling_origins(spark):
    rng = np.random.default_rng(8)
    days = pd.date_range("2020-01-01", periods=500)
    frame = pd.concat(
        [pd.DataFrame({"s": s, "ds": days, "y": 50 + 0.02 * np.arange(500) * k + 5 * np.sin(2 * np.pi * np.arange(500) / 7) + rng.normal(0, 1, 500)}) for k, s in enumerate("ab")]
    )
    frame.loc[frame.index % 50 == 0, "y"] = np.nan
    rows = spark.createDataFrame(frame).withColumn("ds", F.col("ds").cast("timestamp_ntz")).withColumn("y", F.when(~F.isnan("y"), F.col("y")))
    spec = additive.Spec(changepoints=4, yearly_order=0, weekly_order=2)
    grid = {"changepoint_prior_scale": [0.01, 1.0], "seasonality_prior_scale": [0.1, 10.0]}
    origins = ["2020-09-01", "2020-11-01", "2021-01-15"]
    found = {(r.s, r.changepoint_prior_scale, r.seasonality_prior_scale): r for r in additive.rolling_grid_search(rows, origins, spec, grid, series_cols=["s"]).collect()}
    assert len(found) == 8 and {r.folds for r in found.values()} == {2}
    at = [dt.datetime.fromisoformat(o) for o in origins]
    for (s, c, z), r in found.items():
        # Refit in full at each origin, with the scaling of the rows before the first.
        own = rows.filter(F.col("s") == s).filter(F.col("ds") < at[-1])
        chosen = additive.replace(spec, changepoint_prior_scale=c, seasonality_prior_scale=z)
        scales = additive.scaling(own.filter(F.col("ds") < at[0]), "ds", "y")
        errors = []
        for a, b in zip(at, at[1:]):
            g = additive._grams(own.filter(F.col("ds") < a), chosen, "ds", "y", [], scales, [])
            model = additive.Fitted(chosen, "ds", "y", [], g.withColumn("beta", gram.ridge("gram", additive.penalties(chosen, additive.terms(chosen)))).withColumn("sigma", F.lit(0.0)))
            test = own.filter((F.col("ds") >= a) & (F.col("ds") < b) & F.col("y").isNotNull())
            errors += [(q.y - q.yhat) ** 2 for q in additive.predict(model, test).collect()]
        assert r.mse == pytest.approx(np.mean(errors), rel=1e-8)
        if (c, z) != (0.01, 0.1):
            break


def _objective(xx, xy, l2, l1, b):
    return b @ xx @ b / 2 - b @ xy + (l2 * b * b).sum() / 2 + (l1 * abs(b)).sum()


@pytest.mark.parametrize("seed", range(6))
def test_sparse_solve_is_the_minimum(seed):
    """No subgradient is left, and no nearby point is better, also with hinges that are nearly alike or repeated."""
    rng = np.random.default_rng(seed)
    t = np.sort(rng.random(300))
    x = np.column_stack([np.ones(300), t, *(np.maximum(t - k, 0) for k in np.linspace(0.05, 0.8, 12)), np.maximum(t - 0.8, 0), np.zeros(300)])
    y = 2 * t + 3 * np.maximum(t - 0.4, 0) + rng.normal(0, 0.1, 300)
    xx, xy = x.T @ x, x.T @ y
    l2, l1 = np.r_[0.01, 0.01, np.zeros(14)], np.r_[0.0, 0.0, np.full(14, 0.2)]
    b = gram.sparse_solve(xx, xy, l2, l1)
    slope = xy - xx @ b - l2 * b
    assert np.abs(slope[:2]).max() < 1e-7
    moved = b[2:] != 0
    assert np.allclose(slope[2:][moved], 0.2 * np.sign(b[2:][moved]), atol=1e-7) and np.abs(slope[2:]).max() < 0.2 + 1e-7
    assert 0 < moved.sum() < 8
    best = _objective(xx, xy, l2, l1, b)
    for _ in range(200):
        assert _objective(xx, xy, l2, l1, b + rng.normal(0, 10.0 ** rng.integers(-6, 0), 16)) >= best - 1e-9
    assert gram.sparse_solve(xx, xy, l2, l1, sweeps=0) is None
    assert not gram.sparse_solve(xx, xy, l2, np.r_[0.0, 0.0, np.full(14, 1e6)])[2:].any()


def test_laplace_changepoints(spark):
    """One bend is found near its place; a series that does not settle is flagged and null, and harms no other."""
    rows = spark.range(1000).selectExpr(
        "concat('s', id % 2) AS s", "timestampadd(DAY, CAST(id DIV 2 AS INT), TIMESTAMP_NTZ '2020-01-01') AS ds",
        "IF(id % 2 = 0, greatest(id DIV 2 - 200, 0) * 3.0D, 5.0D) + sin(id) AS y",
    )
    spec = additive.Spec(yearly_order=0, changepoint_prior="laplace")
    fitted = additive.fit(rows, spec, series_cols=["s"])
    moved = additive.changepoints(fitted, moved_only=True).toPandas()
    assert additive.changepoints(fitted).count() == 50
    bend = moved[moved["s"] == "s0"]
    # The prior draws changes towards zero; the slope after the bend is right nevertheless.
    assert len(bend) < 10 and 2.5 < bend["slope_change"].sum() < 3.0
    late = additive.predict(fitted, rows).where("s = 's0' AND ds IN (TIMESTAMP_NTZ '2020-12-18', TIMESTAMP_NTZ '2021-05-07')").orderBy("ds")
    first, last = (r["yhat"] for r in late.collect())
    assert (last - first) / 140 == pytest.approx(3.0, rel=0.02)
    top = bend.loc[bend["slope_change"].idxmax(), "at"]
    assert abs((top - pd.Timestamp("2020-07-19")).days) <= 20
    assert [r["settled"] for r in fitted.models.select("settled").collect()] == [True, True]
    broken = F.when(F.col("s") == "s0", F.transform("gram", lambda v: v * float("nan"))).otherwise(F.col("gram"))
    half = fitted.models.drop("beta", "settled", "sigma").withColumn("gram", broken).withColumn("f", additive.solved(spec)).select("s", "f.*")
    assert {r["s"]: (r["beta"] is None, r["settled"]) for r in half.collect()} == {"s0": (True, False), "s1": (False, True)}
    with pytest.raises(ValueError):
        additive.Spec(changepoint_prior="cauchy")


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    """Lines in are rows out and rows in quarantine, whichever columns are asked for."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("ts,v,n\n2024-01-01T00:00:00Z,1.5,1\n2024-01-01T01:00:00Z,,2\n2024-01-01T02:00:00Z,x,3\n2024-01-01T03:00:00Z\n")
    (tmp_path / "in/b.csv").write_text("ts,v,n\nnever,1.0,5\n,2.0,6\n2024-01-01T04:00:00Z,3.0,7,8\n\"2024-01-01T05:00:00Z\",4.0,9\n")
    (tmp_path / "in/c.csv").write_text("ts,v,n\n")
    checked = tables.read_checked(spark, str(tmp_path / "in"), ["ts", "v", "n"], "ts", {"n": "bigint"})
    assert checked.count() == 8
    good = tables.load_checked(checked, str(tmp_path / "bad"))
    assert sorted((r["v"] or 0.0, r["n"]) for r in good.collect()) == [(0.0, 2), (1.5, 1), (4.0, 9)]
    assert good.select("n").count() == good.count() == 3 and good.columns == ["ts", "v", "n"]
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted((r["problem"], r["rejected"], r["file"][-5:]) for r in bad) == [
        ("record", "2024-01-01T02:00:00Z,x,3", "a.csv"), ("record", "2024-01-01T03:00:00Z", "a.csv"), ("record", "2024-01-01T04:00:00Z,3.0,7,8", "b.csv"),
        ("time", "", "b.csv"), ("time", "never", "b.csv"),
    ]


def test_unsettled_elastic_fit_is_null(spark):
    df = spark.createDataFrame([("a", [2.0, 1.0, 3.0, 1.0, 2.0, 5.0])], "s string, gram array<double>")
    found = df.select(gram.elastic_net(0.0, 0.1, sweeps=1)("gram").alias("none"), gram.elastic_net(0.0, 0.1)("gram").alias("some")).first()
    assert found["none"] is None and len(found["some"]) == 2
