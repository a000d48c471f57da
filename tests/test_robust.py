"""Rows that can't be predicted, short series, session zones, offsets, wide encoders."""

import datetime as dt
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tidemill.functions import calendar, scalar
from tidemill.models import additive, gram, lagged, walkforward
from tidemill.operators import encode, quality, resample, stationarity
from tidemill.session import scratch_path, write_settled

DAY0 = dt.datetime(2020, 1, 1)


def _series(spark, names, n=60, train=40):
    rows = [(s, DAY0 + dt.timedelta(days=i), float(i % 7 + k), float(i), i >= train) for k, s in enumerate(names) for i in range(n)]
    return spark.createDataFrame(rows, "s string, ds timestamp_ntz, y double, r double, is_test boolean")


def _spec():
    return additive.Spec(changepoints=3, yearly_order=0, regressors=("r",))


@pytest.fixture
def berlin(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", before)


def test_no_row_is_lost(spark):
    rows = _series(spark, ["a", "only_test", "no_target"])
    rows = rows.where("s <> 'only_test' OR is_test").withColumn("y", F.expr("CASE WHEN s <> 'no_target' THEN y END"))
    gap = F.expr("s = 'a' AND ds = TIMESTAMP_NTZ '2020-02-15 00:00:00'")
    rows = rows.withColumn("r", F.when(~gap, F.col("r")))
    tested = rows.where("is_test").count()
    folds = walkforward.walk_forward(rows, "is_test", _spec(), series_cols=["s"])
    found = {(r["s"], r["ds"]): r for r in folds.collect()}
    assert len(found) == tested
    assert [k for k, r in found.items() if k[0] == "a" and r["yhat"] is None] == [("a", dt.datetime(2020, 2, 15))]
    assert all(r["yhat"] is None and r["beta"] is None for k, r in found.items() if k[0] != "a")
    fitted = additive.fit(rows.where("NOT is_test"), _spec(), series_cols=["s"])
    predicted = additive.predict(fitted, rows.where("is_test"), interval=True).collect()
    assert len(predicted) == tested
    assert {r["s"] for r in predicted if r["yhat"] is None} == {"a", "only_test", "no_target"}
    prepared = lagged.prepare_lags(rows, "ds", "y", [1], "is_test", series_cols=["s"])
    scored = lagged.predict(prepared, lagged.fit(prepared)).collect()
    assert len([r for r in scored if r["s"] == "only_test"]) == 19  # its first row has no lag
    assert all(r["predicted"] is None for r in scored if r["s"] != "a")


def test_fit_moves_no_rows(spark):
    plan = gram.gram(_series(spark, ["a"]), ["s"], gram.row_vector([F.col("r")], F.col("y")), 3)
    text = plan._jdf.queryExecution().executedPlan().toString()
    below = text[text.rindex("MapInArrow") :]
    assert "Exchange" not in below


def test_matrices_are_handed_on(spark, monkeypatch):
    monkeypatch.setattr(gram, "HELD_BYTES", 100)
    rows = _series(spark, list("abcdefgh")).repartition(3)
    packed = gram.gram(rows, ["s"], gram.row_vector([F.col("r")], F.col("y")), 3).collect()
    assert sorted(r["s"] for r in packed) == list("abcdefgh") and all(r["gram"][0] == 60 for r in packed)


@pytest.mark.parametrize("layout", [{"block_rows": None}, {"chunk": "month", "block_rows": 10}])
def test_short_series(spark, layout):
    rows = _series(spark, ["a", "b"]).where("s = 'a' OR ds = TIMESTAMP_NTZ '2020-01-03 00:00:00'")
    rows = rows.withColumn("y", F.col("y") + F.rand(3))
    found = {r["s"]: r for r in stationarity.adf(rows, "ds", "y", ["s"], **layout).collect()}
    assert set(found) == {"a", "b"} and found["a"]["statistic"] is not None and found["b"]["statistic"] is None


def test_offsets(berlin):
    texts = ["2015-06-01T00:00:00+02:00", "2015-06-01T00:00:00Z", "2015-06-01 00:00:00", "2015-06-01T00:00:00-0330", "2015-06-01", None]
    df = berlin.createDataFrame([(t,) for t in texts], "t string").select(scalar.parse_timestamp("t").alias("u"))
    at = lambda d, h, m=0: dt.datetime(2015, *d, h, m)
    assert [r["u"] for r in df.collect()] == [at((5, 31), 22), at((6, 1), 0), at((6, 1), 0), at((6, 1), 3, 30), at((6, 1), 0), None]


def test_calendar_is_utc_in_any_session(berlin):
    df = berlin.sql("SELECT timestamp '2020-06-30T22:30:00Z' AS at, timestamp_ntz '2020-06-30 22:30:00' AS clock")
    for c in ("at", "clock"):
        found = df.select(
            calendar.time_of_day(c).alias("d"), calendar.season(c).alias("s"), calendar.date_parts(c)["hour"].alias("h"),
            calendar.time_of_day(c, "Europe/Berlin").alias("local"),
            calendar.daylight_flag(c, F.lit(47.66), F.lit(9.17)).alias("light"),
        ).first()
        assert tuple(found) == ("evening", "summer", 22, "night", False)
    weekend = berlin.sql("SELECT timestamp '2020-06-05T22:30:00Z' AS at").select(calendar.is_weekend("at")).first()[0]
    assert weekend is False  # Friday in UTC, Saturday in Berlin


def test_steps_keep_the_type(berlin):
    rows = berlin.sql("SELECT explode(array(timestamp '2020-01-05T23:30:00Z', timestamp '2020-08-05T01:00:00Z')) AS ts, 1.0D AS x")
    for unit, n in (("quarter", 3), ("month", 8), ("day", 214)):
        spine = resample.calendar_spine(rows, "ts", unit=unit)
        assert dict(spine.dtypes)["ts"] == "timestamp" and spine.count() == n
        dense = resample.resample_mean(rows, "ts", ["x"], unit=unit)
        assert dict(dense.dtypes)["ts"] == "timestamp" and dense.count() == n
    assert dict(quality.nulls_per_day(rows, "x", "ts").dtypes)["day"] == "timestamp"
    first = resample.calendar_spine(rows, "ts").agg(F.unix_seconds(F.min("ts"))).first()[0]
    assert first == 1578182400  # midnight UTC, not Berlin's


def test_many_categories(spark):
    df = spark.range(1500).select(F.concat(F.lit("c"), "id").alias("c"))
    assert len(encode.fit_one_hot(df, ["c"]).names) == 1499
    with pytest.raises(ValueError):
        encode.fit_one_hot(df, ["c"], max_categories=1000)


def test_package_travels(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(__file__.rpartition('/tests/')[0])!r})
from tidemill.session import local_session
from tidemill.queries import catalog
spark = local_session("2", "far", 2)
print("rows", catalog.QUERIES["x5_walk_forward"](spark, "/root/testdata/sf0.001").count())
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]


def test_settled_tables_keep_sizes(spark):
    df = write_settled(spark.range(1000).withColumn("x", F.lit(1)))
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,5)" in df.where("id > 5").select("id")._jdf.queryExecution().executedPlan().toString()
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_words_are_counted_in_the_row(spark, tmp_path):
    """Only ids of several rows are summed up; where there are none, no word is shuffled."""
    from collections import Counter

    from tidemill.queries import catalog

    rows = [(1, "b a  b\ta"), (2, ""), (3, None), (4, "é a E\n"), (5, " ")]
    for name, more in (("once", []), ("several", [(1, "b c"), (None, "x y"), (None, "y"), (4, None), (6, "z")])):
        spark.createDataFrame(rows + more, "doc_id long, text string").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        found = catalog.QUERIES["c2_words"](spark, f"{tmp_path}/{name}")
        want = Counter((d, w) for d, text in rows + more for w in (text or "").split())
        assert {(r.doc_id, r.word): r.n for r in found.collect()} == want
        assert found.count() == len(want)
        final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert ("Exchange hashpartitioning" in final) == bool(more)
