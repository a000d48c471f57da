"""Writes that are tried again, intervals from sketches, permuted columns, training in rounds."""

import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.models import additive, importance, intervals, lagged
from tidemill.plans import household
from tidemill.sources import sinks


def _visible(folder):
    return sorted(os.listdir(folder)) if os.path.exists(folder) else []


def _failing(spark, rows=4):
    """A table whose last task fails after others have written."""
    bad = F.when(F.col("id") == rows - 1, F.raise_error(F.lit("lost"))).otherwise(F.lit("ok"))
    return spark.range(0, rows, 1, rows).select("id", bad.alias("note"))


def test_staged_write(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="lost"):
        sinks.write_staged(_failing(spark), path)
    assert _visible(tmp_path) == []
    first = spark.range(5)
    sinks.write_staged(first, path)
    sinks.write_staged(first, path)  # again: one copy
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(Exception, match="lost"):
        sinks.write_staged(_failing(spark), path)
    assert spark.read.parquet(path).count() == 5 and _visible(tmp_path) == ["t"]
    # The new table may be made from the old one.
    grown = spark.read.parquet(path).union(spark.range(5, 7))
    sinks.write_staged(grown, path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(7))
    with pytest.raises(FileExistsError):
        sinks.write_staged(first, path, replace=False)
    sinks.write_staged(first.where("false"), path)  # an empty table replaces too
    assert spark.read.parquet(path).count() == 0 and _visible(tmp_path) == ["t"]


def test_rename_that_fails_puts_the_old_table_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.write_staged(spark.range(3), path)
    plain, calls = sinks._rename, []

    def second_fails(files, source, target):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("no")
        plain(files, source, target)

    monkeypatch.setattr(sinks, "_rename", second_fails)
    with pytest.raises(OSError, match="no"):
        sinks.write_staged(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3 and _visible(tmp_path) == ["t"]


def test_runs_are_kept_once(spark, tmp_path):
    path = str(tmp_path / "runs")
    df = spark.createDataFrame([("007", 1, 0.5), ("007", 2, 0.25), ("a/b=c", 1, 1.5)], "run string, step int, value double")
    for _ in range(2):
        sinks.write_runs(df, path)
    found = sinks.read_runs(spark, path, df.schema)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, df.collect()))
    assert found.schema["run"].dataType.simpleString() == "string"
    sinks.write_runs(df.where("run = '007' AND step = 1").withColumn("value", F.lit(9.0)), path)
    assert sorted(map(tuple, sinks.read_runs(spark, path, df.schema).collect())) == [("007", 1, 9.0), ("a/b=c", 1, 1.5)]
    broken = _failing(spark).select(F.lit("007").alias("run"), F.col("id").cast("int").alias("step"), F.length("note").cast("double").alias("value"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_runs(broken, path)
    assert sinks.read_runs(spark, path, df.schema).count() == 2
    for name in (None, ""):
        with pytest.raises(Exception, match="a run needs a name"):
            sinks.write_runs(spark.createDataFrame([(name, 1, 1.0)], df.schema), path)
    plan = found.where("run = '007'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run" in plan


def test_metrics_are_logged_once(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("r", "val/mae", 0, 1.0), ("r", "val/mse", 0, 2.0)], "run string, metric string, step bigint, value double")
    for part in (rows.where("metric = 'val/mae'"), rows.where("metric = 'val/mse'"), rows):
        sinks.log_metrics(part, path)
    found = sinks.read_runs(spark, path, rows.schema)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.collect()))


def _errors(spark, n=3000, seed=3):
    rng = np.random.default_rng(seed)
    rows = [
        ("s" if i % 3 else "t", i % 2 + 1, f"2024-{i % 5 + 1:02d}-01", float(np.round(rng.exponential(), 4)), 0.0)
        for i in range(n)
    ]
    rows += [("s", 1, "2024-01-02", None, 1.0), ("u", 1, "2024-06-01", 1.0, None), ("s", 1, "2024-05-02", float("nan"), 1.0)]
    return spark.createDataFrame(rows, "k string, h int, day string, y double, p double").withColumn("day", F.col("day").cast("timestamp_ntz"))


def test_intervals_are_the_quantiles_of_earlier_errors(spark):
    df = _errors(spark)
    found = intervals.earlier_intervals(df, "day", "y", "p", ["k", "h"], 0.1, 0.9)
    assert found.count() == df.count()
    rows = df.toPandas()
    for r in found.dropDuplicates(["k", "h", "day"]).collect():
        month = r.day.replace(day=1)
        mine = rows[(rows.k == r.k) & (rows.h == r.h) & (rows.day < month)]
        errors = np.sort((mine.y - mine.p).dropna().to_numpy())
        assert r.n_errors == len(errors)
        if not len(errors) or r.p is None:
            assert r.p_low is None and r.normal_high is None
            continue
        at = [errors[max(1, int(np.ceil(q * len(errors)))) - 1] for q in (0.1, 0.9)]
        assert [r.p_low - r.p, r.p_high - r.p] == pytest.approx(at, abs=1e-12)
        assert r.normal_high - r.p == pytest.approx(1.2815515655446004 * errors.std(), rel=1e-9)


def test_sketches_add_up_within_their_rank_error(spark):
    rng = np.random.default_rng(5)
    values = rng.lognormal(size=40_000)
    df = spark.createDataFrame([(int(i % 16), float(v), 0.0) for i, v in enumerate(values)], "b int, y double, p double")
    parts = intervals.error_sketches(df, "y", "p", ["b"], 512)
    whole = intervals.add(parts, [], 512).select("n", *[c.alias(f"q{i}") for i, c in enumerate(intervals.quantiles([0.1, 0.5, 0.9]))])
    row = whole.collect()[0]
    assert row.n == 40_000
    for q, value in zip((0.1, 0.5, 0.9), row[1:]):
        assert abs(np.mean(values <= value) - q) < 2 * 2.4 / 512**0.94
    assert intervals.error_sketches(df.where("false"), "y", "p", ["b"]).count() == 0


def _wave(spark, n=240):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(n):
        a, b, c = rng.normal(size=3)
        rows.append(("hot" if i < n * 2 // 3 else "cold", i, float(a), float(b), float(c), float(3 * a + b * b)))
    rows.append(("hot", n, None, 0.0, 0.0, 1.0))
    return spark.createDataFrame(rows, "k string, i int, a double, b double, c double, y double")


def test_permutation_importance_is_that_of_brute_force(spark):
    df, features, repeats, seed = _wave(spark), ["a", "b", "c"], 3, 5

    def predict(t):
        return t.withColumn("predicted", 3 * F.col("a") + F.col("b") * F.col("b") + 0.1)

    found = importance.permutation_importance(df, predict, features, "y", ["i"], ["k"], repeats, seed)
    rows = df.toPandas().dropna()
    want = {}
    for k, part in rows.groupby("k"):
        part = part.sort_values("i").reset_index(drop=True)
        for f in features:
            scores = []
            for r in range(repeats):
                order = sorted(part.i, key=lambda i: hashlib.md5(f"{seed}|{r}|{i}".encode()).hexdigest())
                shuffled = part.copy()
                shuffled[f] = part.set_index("i").loc[order, f].to_numpy()
                scores.append(float(np.mean((3 * shuffled.a + shuffled.b**2 + 0.1 - shuffled.y) ** 2)))
            want[k, f] = (0.01, np.mean(scores), np.mean(scores) - 0.01, np.std(scores))
    got = {(r.k, r.feature): tuple(r)[2:] for r in found.collect()}
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-9)
    assert got["hot", "c"][2] == pytest.approx(0.0) and got["hot", "a"][2] > got["hot", "b"][2] > 0.5


def test_permuted_uses_each_value_once(spark):
    df = _wave(spark).dropna()
    found = importance.permuted(df, ["a", "c"], ["i"], [], repeats=2, seed=1)
    assert found.count() == df.count() * (1 + 2 * 2)
    values = sorted(r.a for r in df.collect())
    for repeat in (0, 1):
        part = found.where(f"_feature = 'a' AND _repeat = {repeat}")
        assert sorted(r.a for r in part.collect()) == values
        assert part.join(df.select("i", F.col("c").alias("c0"), F.col("a").alias("a0")), "i").where("c = c0").count() == df.count()
    assert importance.permuted(df.where("false"), ["a"], ["i"]).count() == 0


def _prepared(spark, n=300):
    rng = np.random.default_rng(2)
    rows = []
    for k, count in (("a", n), ("b", 40), ("none", 3)):
        for i in range(count):
            y = float(50 + 20 * np.sin(i / 5) + rng.normal())
            rows.append((k, f"2024-{1 + i // 28 % 12:02d}-{1 + i % 28:02d}", i, y if i % 37 else None, float(i % 7 > 4), i >= count * 3 // 4 and k != "none"))
    df = spark.createDataFrame(rows, "k string, ds string, i int, y double, w double, is_test boolean")
    df = df.withColumn("ds", F.expr("date_add(DATE '2020-01-01', i)").cast("timestamp_ntz"))
    return lagged.prepare_lags(df, "ds", "y", [1, 2], "is_test", ["w"], ["k"], block_rows=None)


def test_rounds_are_plain_batch_steps_and_their_last_epoch_predicts(spark):
    prepared = _prepared(spark)
    models = lagged.fit_rounds(prepared, batches=4, epochs=6, seed=3)
    found = {r.k: r for r in models.collect()}
    rows = prepared.rows.toPandas().dropna()
    for k, part in rows[~rows.is_test].groupby("k"):
        z = np.column_stack([np.ones(len(part)), part[prepared.features].to_numpy(float)])
        y = part.y.to_numpy()
        batch = np.array([int(hashlib.md5(f"3|{d:%Y-%m-%d %H:%M:%S}".encode()).hexdigest()[:8], 16) % 4 for d in part.ds])
        present = sorted(set(batch))
        step = 1.0 / max(np.mean(np.sum(z[batch == b] ** 2, axis=1)) for b in present)
        beta, path = np.zeros(z.shape[1]), []
        for epoch in range(6):
            for b in sorted(present, key=lambda b: hashlib.md5(f"3|{epoch}|{b}".encode()).hexdigest()):
                mine = batch == b
                beta = beta - step * z[mine].T @ (z[mine] @ beta - y[mine]) / mine.sum()
            path.append(beta)
        assert np.allclose(found[k].path, path, atol=1e-10)
        assert list(found[k].beta) == list(found[k].path[-1])
    # The last step of the history is the error of the predictions, in the same units.
    history = {(r.k, r.step): r for r in lagged.history(prepared, models, real_units=True).collect()}
    predicted = lagged.predict(prepared, models).toPandas().dropna()
    for k, part in predicted.groupby("k"):
        error = part.actual - part.predicted
        last = history[k, 5]
        assert last["val/mae"] == pytest.approx(error.abs().mean(), rel=1e-9)
        assert last["val/mse"] == pytest.approx((error**2).mean(), rel=1e-9)
        assert last["val/rmse"] == pytest.approx(np.sqrt((error**2).mean()), rel=1e-9)
        assert last["train/loss"] < history[k, 0]["train/loss"]


def test_rounds_without_rows(spark):
    prepared = _prepared(spark)
    from dataclasses import replace

    empty = replace(prepared, rows=prepared.rows.where("false"))
    models = lagged.fit_rounds(empty, batches=4, epochs=3)
    assert models.count() == 0 and lagged.history(empty, models).count() == 0
    alone = replace(empty, series_cols=[])
    assert lagged.fit_rounds(alone, batches=4, epochs=3).count() == 0


SITE = household.Site(building="b", ts_col="ts", series_cols=("k",), layout={"block_rows": None})


def _days(spark, n=150):
    rng = np.random.default_rng(4)
    rows = []
    for k in ("a", "b"):
        meter = rng.normal(size=n)
        for i in range(n):
            rows.append((k, i, float(30 + 2 * meter[i] + 5 * (i % 7 > 4)), float(meter[i]), i % 7 > 4, ("winter", "spring", "summer")[i // 50]))
    df = spark.createDataFrame(rows, "k string, i int, energy_demand double, meter double, is_holiday_or_weekend boolean, season string")
    return df.withColumn("ts", F.expr("date_add(DATE '2023-01-01', i)").cast("timestamp_ntz"))


def test_sequence_experiment(spark):
    df = _days(spark)
    found = household.sequence_experiment(df.drop("i"), F.col("ts") >= "2023-04-20", SITE, steps=2, epochs=8, batches=4, seed=1)
    predictions = found["predictions"].toPandas()
    assert len(predictions) == df.where("ts >= '2023-04-20'").count() and predictions.predicted_kWh.notna().all()
    rows = df.toPandas().set_index(["k", "ts"]).energy_demand
    assert np.allclose(predictions.actual_kWh, [rows[k, d] for k, d in zip(predictions.k, predictions.date)])
    # metrics = what the predictions say = the last step of the history, in one unit
    metrics = {(r.k, r.metric): r.value for r in found["metrics"].collect()}
    last = {(r.k, r.metric): r.value for r in found["history"].where("step = 7").collect()}
    for (k, metric), value in metrics.items():
        mine = predictions[predictions.k == k].error
        assert value == pytest.approx({"val/mae": mine.abs().mean(), "val/mse": (mine**2).mean(), "val/rmse": np.sqrt((mine**2).mean())}[metric])
        assert last[k, metric] == pytest.approx(value, rel=1e-9)
    assert found["history"].count() == 2 * 8 * 5
    assert {r.run for r in found["history"].select("run").distinct().collect()} == {"sequence_lr1.0_seq[1, 2]"}


def test_contemporaneous_meters_explain_the_target(spark):
    df = _days(spark).drop("i")
    test = F.col("ts") >= "2023-04-20"
    blind = household.lag_experiment(df, test, SITE, [1], epochs=2)["predictions"].toPandas()
    seeing = household.lag_experiment(df, test, SITE, [1], contemporaneous=True, epochs=2)["predictions"].toPandas()
    assert blind.error.abs().mean() > 1 and seeing.error.abs().max() < 1e-3


def test_minmax_target_in_units_of_the_target(spark):
    df = _days(spark).drop("i")
    spec = additive.Spec(changepoints=3, yearly_order=0)
    test = F.col("ts") >= "2023-05-20"
    one = household.additive_experiment(df, test, SITE, spec)
    two = household.additive_experiment(df, test, SITE, spec, target_scaling="minmax")
    a, b = (x["predictions"].toPandas().sort_values(["k", "date"]).reset_index(drop=True) for x in (one, two))
    assert np.allclose(a.actual_kWh, b.actual_kWh) and b.predicted_kWh.notna().all()
    assert np.abs(a.predicted_kWh - b.predicted_kWh).max() < 0.5  # weak priors: nearly the same fit
    served = two["served"].toPandas()
    assert (served.p10 < served.prediction).all() and served.prediction.between(20, 45).all()
    with pytest.raises(ValueError, match="minmax"):
        household.additive_experiment(df, test, SITE, spec, target_scaling="log")
