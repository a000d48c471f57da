"""Stationarity tests, forecasts, walk-forward evaluation, tuning and evaluation tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar
from ..models import additive, evaluate, importance, intervals, lagged, per_series, walkforward
from ..operators import blocks, columns, joins, lags, quality, stationarity
from ..sources import tables
from . import basics, views
from .registry import Tables, query, rounded
from .views import DAILY, ONE_SERIES, RAW, TEST_YEAR, with_views

GRID = {
    "changepoint_prior_scale": [0.001, 0.01, 0.1, 0.5, 5, 10],
    "seasonality_prior_scale": [0.01, 0.1, 1.0, 10.0],
}


def _series(t: Tables) -> DataFrame:
    """Dense daily revenue per segment as (segment, ds, y), weekend regressor and split flag."""
    dense = columns.rename(views.segment_dense(t), {"day": "ds", "revenue": "y"})
    flagged = dense.withColumns(
        {
            "weekend": calendar.is_weekend("ds").cast("double"),
            "is_test": quality.in_test_year(dense, "ds", TEST_YEAR),
        }
    )
    # A day per row: small next to the orders it comes from, and read several times.
    return blocks.settle(flagged)


SERIES = """SELECT segment, day AS ds, revenue AS y, CAST(isodow(day) > 5 AS DOUBLE) AS weekend,
    year(day) = 2001 AS is_test FROM segment_dense"""


def ridge_sql(p: int, penalty: str, key: str = "segment", design: str = "design", tag: str = "") -> dict[str, str]:
    """CTEs that solve the ridge system of ``design(key, x)``, x = [1, features..., label], by
    Gauss-Jordan elimination; ``penalty`` is a SQL list of p numbers. Result: beta{tag}(key, beta)."""
    return {
        f"sums{tag}": f"""SELECT {key}, i, j, sum(x[i] * x[j]) AS v FROM {design}, range(1, {p + 1}) a(i),
            range(1, {p + 2}) b(j) GROUP BY ALL""",
        f"matrix{tag}": f"""SELECT {key}, list(cells ORDER BY i) AS m FROM (SELECT {key}, i,
            list(v + CASE WHEN i = j THEN ({penalty})[i] ELSE 0 END ORDER BY j) AS cells FROM sums{tag} GROUP BY ALL)
            GROUP BY ALL""",
        **eliminate_sql(str(p), key, tag),
    }


def eliminate_sql(p: str, key: str, tag: str = "", keep: str = "") -> dict[str, str]:
    return {
        f"steps{tag}": f"""SELECT {key}{keep}, m, 1 AS k FROM matrix{tag} UNION ALL
            SELECT {key}{keep}, list_transform(m, lambda cells, r: CASE WHEN r = k
                THEN list_transform(cells, lambda v: v / m[k][k])
                ELSE list_transform(cells, lambda v, c: v - cells[k] * m[k][c] / m[k][k]) END), k + 1
            FROM steps{tag} WHERE k <= {p}""",
        f"beta{tag}": f"""SELECT {key}{keep}, list_transform(m, lambda cells: cells[{p} + 1]) AS beta
            FROM steps{tag} WHERE k = {p} + 1""",
    }


DOT = "list_dot_product({}, {})"

# --- stationarity ----------------------------------------------------------------------

KNOWN = """SELECT segment, (revenue - avg(revenue) OVER s) / stddev_pop(revenue) OVER s AS x,
    row_number() OVER (PARTITION BY segment ORDER BY day) AS t, count(*) OVER s AS n
  FROM segment_dense WHERE revenue IS NOT NULL WINDOW s AS (PARTITION BY segment)"""
PHI = """(0.5 + z / 6000 / sqrt(2 * pi()) * list_sum(list_transform(range(0, 2001),
    lambda i: CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * exp(-pow(z * i / 2000, 2) / 2))))"""
ADF_CTES = {
    "known": KNOWN,
    "xs": """SELECT segment, list(x ORDER BY t) AS x, max(n) AS n,
        least(max(n) // 2 - 2, ceil(12 * pow(max(n) / 100.0, 0.25)))::BIGINT AS top FROM known GROUP BY 1""",
    "vectors": """SELECT k.segment, k.t, top, list_concat([1.0::DOUBLE, xs.x[k.t - 1]], list_transform(range(1, top + 1),
        lambda j: xs.x[k.t - j] - xs.x[k.t - j - 1]), [xs.x[k.t] - xs.x[k.t - 1]]) AS z
      FROM known k JOIN xs ON k.segment = xs.segment WHERE k.t >= 2""",
    # Candidate regressions on the common sample: columns 1..2+lag and the label (last).
    "cells1": """SELECT segment, top, i, j, sum(z[i] * z[j]) AS v, count(*) AS n FROM vectors, range(1, 60) a(i), range(1, 60) b(j)
        WHERE t >= top + 2 AND i <= top + 3 AND j <= top + 3 GROUP BY ALL""",
    "matrix1": """SELECT segment, lag, list(cells ORDER BY i) AS m FROM (SELECT segment, lag, i, list(v ORDER BY j) AS cells
        FROM cells1, range(60) l(lag) WHERE lag <= top AND i <= 2 + lag AND (j <= 2 + lag OR j = top + 3)
        GROUP BY segment, lag, i) GROUP BY segment, lag""",
    **eliminate_sql("(2 + lag)", "segment, lag", "1"),
    "losses": """SELECT b.segment, b.lag, max(c.n) AS n, sum(v) FILTER (i = top + 3) - sum(v * beta[i]) FILTER (i <= 2 + lag) AS loss
      FROM beta1 b JOIN cells1 c ON b.segment = c.segment AND c.j = top + 3 GROUP BY b.segment, b.lag""",
    "best": """SELECT segment, arg_min(lag, n * (ln(loss / n) + ln(2 * pi()) + 1) + 2 * (2 + lag)) AS lag FROM losses GROUP BY 1""",
    "cells2": """SELECT v.segment, lag, i, j, sum(z[CASE WHEN i = 3 + lag THEN len(z) ELSE i END] * z[CASE WHEN j = 3 + lag THEN len(z) ELSE j END]) AS v,
        count(*) AS n FROM vectors v JOIN best b ON v.segment = b.segment, range(1, 60) a(i), range(1, 60) c(j)
        WHERE t >= lag + 2 AND i <= 3 + lag AND j <= 3 + lag GROUP BY ALL""",
    # A second right-hand side, the unit vector of the level, gives its variance factor.
    "matrix2": """SELECT segment, lag, list(cells ORDER BY i) AS m FROM (SELECT segment, lag, i,
        list_append(list(v ORDER BY j), CASE WHEN i = 2 THEN 1.0 ELSE 0.0 END) AS cells FROM cells2 WHERE i <= 2 + lag GROUP BY segment, lag, i)
        GROUP BY segment, lag""",
    **eliminate_sql("(2 + lag)", "segment, lag", "2"),
    "factors": """SELECT segment, lag, m[2][4 + lag] AS factor FROM steps2 WHERE k = 3 + lag""",
    "tests": """SELECT b.segment, b.lag, max(c.n) AS n, any_value(beta[2]) / sqrt(any_value(factor) *
        (sum(v) FILTER (i = 3 + b.lag) - sum(v * beta[i]) FILTER (i <= 2 + b.lag)) / (max(c.n) - 2 - b.lag)) AS s
      FROM beta2 b JOIN cells2 c ON b.segment = c.segment AND c.j = 3 + b.lag JOIN factors f ON f.segment = b.segment GROUP BY b.segment, b.lag""",
    "surface": """SELECT *, CASE WHEN s <= -1.61 THEN 2.1659 + 1.4412 * s + 0.038269 * s * s
        ELSE 1.7339 + 0.93202 * s - 0.12745 * s * s - 0.010368 * s * s * s END AS z FROM tests""",
}


@query(
    "k1_adf",
    with_views(
        f"""SELECT segment, round(s, 6) AS statistic, round(CASE WHEN s > 2.74 THEN 1 WHEN s < -18.83 THEN 0 ELSE {PHI} END, 6) AS p_value,
              lag AS used_lag, n AS n_obs FROM surface""",
        "segment_dense",
        extra=ADF_CTES,
        recursive=True,
    ),
)
def k1(t: Tables) -> DataFrame:
    found = stationarity.adf(views.segment_dense(t), "day", "revenue", ["segment"], **DAILY)
    return rounded(found, 6, "statistic", "p_value")


KPSS_CTES = {
    "zs": """SELECT segment, revenue - avg(revenue) OVER s AS z, row_number() OVER (PARTITION BY segment ORDER BY day) AS t,
        count(*) OVER s AS n FROM segment_dense WHERE revenue IS NOT NULL WINDOW s AS (PARTITION BY segment)""",
    "prods": """SELECT a.segment, k, max(a.n) AS n, sum(a.z * b.z) AS c FROM zs a CROSS JOIN range(100) r(k)
        JOIN zs b ON a.segment = b.segment AND b.t = a.t - k GROUP BY 1, 2""",
    "auto": """SELECT segment, max(n) AS nn, least(floor(1.1447 * pow(pow(
          sum(CASE WHEN k >= 1 AND k <= floor(pow(n, 2.0 / 9)) THEN k * c ELSE 0 END) / (max(n) / 2.0) /
          (sum(CASE WHEN k = 0 THEN c ELSE 0 END) / max(n) + sum(CASE WHEN k >= 1 AND k <= floor(pow(n, 2.0 / 9)) THEN c ELSE 0 END) / (max(n) / 2.0)), 2),
          1.0 / 3) * pow(max(n), 1.0 / 3)), max(n) - 1)::BIGINT AS lags FROM prods GROUP BY 1""",
    "variance": """SELECT p.segment, nn AS n, lags, sum(CASE WHEN k = 0 THEN c WHEN k <= lags THEN 2 * c * (1 - k / (lags + 1.0)) ELSE 0 END) / nn AS v
        FROM prods p JOIN auto a ON p.segment = a.segment GROUP BY p.segment, nn, lags""",
    "eta": """SELECT segment, sum(s * s) AS eta FROM (SELECT segment, sum(z) OVER (PARTITION BY segment ORDER BY t) AS s FROM zs) GROUP BY 1""",
    "kpss": """SELECT v.segment, eta / pow(n, 2) / v AS s, lags, n FROM variance v JOIN eta e ON v.segment = e.segment""",
}


@query(
    "k2_kpss",
    with_views(
        """SELECT segment, round(s, 6) AS statistic, lags AS used_lag, n AS n_obs, round(CASE WHEN s <= 0.347 THEN 0.10
             WHEN s <= 0.463 THEN 0.10 + (s - 0.347) * (0.05 - 0.10) / (0.463 - 0.347)
             WHEN s <= 0.574 THEN 0.05 + (s - 0.463) * (0.025 - 0.05) / (0.574 - 0.463)
             WHEN s <= 0.739 THEN 0.025 + (s - 0.574) * (0.01 - 0.025) / (0.739 - 0.574) ELSE 0.01 END, 6) AS p_value FROM kpss""",
        "segment_dense",
        extra=KPSS_CTES,
    ),
)
def k2(t: Tables) -> DataFrame:
    found = stationarity.kpss(views.segment_dense(t), "day", "revenue", ["segment"], **DAILY)
    return rounded(found, 6, "statistic", "p_value")


@query(
    "k3_verdicts",
    """SELECT adf, kpss, count(*) AS n FROM (SELECT
         CASE WHEN round(p, 3) <= 0.05 THEN 'Stationary' ELSE 'Non-stationary' END AS adf,
         CASE WHEN round(p, 3) <= 0.05 THEN 'Non-stationary' ELSE 'Stationary' END AS kpss
         FROM (SELECT l_discount * 0.9 + 0.0002 AS p FROM lineitem)) GROUP BY 1, 2""",
)
def k3(t: Tables) -> DataFrame:
    p = F.col("l_discount") * 0.9 + 0.0002
    labelled = t("lineitem").select(
        stationarity.adf_verdict(p).alias("adf"), stationarity.kpss_verdict(p).alias("kpss")
    )
    return labelled.groupBy("adf", "kpss").agg(F.count(F.lit(1)).alias("n"))


@query(
    "k4_combined_reading",
    """SELECT reading, count(*) AS n FROM (SELECT CASE WHEN a AND k THEN 'stationary' WHEN a THEN 'difference-stationary'
         WHEN k THEN 'trend-stationary' ELSE 'non-stationary' END AS reading FROM
         (SELECT round(l_discount * 0.9 + 0.0002, 3) <= 0.05 AS a, NOT (round(l_tax + 0.0102, 3) <= 0.05) AS k FROM lineitem)) GROUP BY 1""",
)
def k4(t: Tables) -> DataFrame:
    reading = stationarity.combined_reading(
        stationarity.adf_verdict(F.col("l_discount") * 0.9 + 0.0002),
        stationarity.kpss_verdict(F.col("l_tax") + 0.0102),
    )
    return t("lineitem").groupBy(reading.alias("reading")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "k4_tests_per_series",
    with_views(
        f"""SELECT segment, CASE WHEN a THEN 'Stationary' ELSE 'Non-stationary' END AS adf,
              CASE WHEN k THEN 'Stationary' ELSE 'Non-stationary' END AS kpss,
              CASE WHEN a AND k THEN 'stationary' WHEN a THEN 'difference-stationary' WHEN k THEN 'trend-stationary'
                   ELSE 'non-stationary' END AS reading
            FROM (SELECT u.segment, round(CASE WHEN u.s > 2.74 THEN 1 WHEN u.s < -18.83 THEN 0 ELSE {PHI} END, 3) <= 0.05 AS a,
                    k.s < 0.463 - (0.0005 / 0.05) * (0.463 - 0.347) AS k
                  FROM surface u JOIN kpss k ON u.segment = k.segment)""",
        "segment_dense",
        extra={**ADF_CTES, **KPSS_CTES},
        recursive=True,
    ),
)
def k4_series(t: Tables) -> DataFrame:
    dense = views.segment_dense(t)
    unit_root = stationarity.adf(dense, "day", "revenue", ["segment"], **DAILY)
    level = stationarity.kpss(dense, "day", "revenue", ["segment"], **DAILY)
    both = unit_root.select("segment", stationarity.adf_verdict(F.col("p_value")).alias("adf")).join(
        level.select("segment", stationarity.kpss_verdict(F.col("p_value")).alias("kpss")), "segment"
    )
    return both.withColumn("reading", stationarity.combined_reading(F.col("adf"), F.col("kpss")))


# --- lag regressions -------------------------------------------------------------------


def _lag_rows(t: Tables) -> lagged.Prepared:
    return lagged.prepare_lags(
        _series(t), "ds", "y", [1, 7], "is_test", ["weekend"], ["segment"], across_split=False, **DAILY
    )


def _scaled(c: str) -> str:
    return f"({c} - lo_{c}) / CASE WHEN hi_{c} = lo_{c} THEN 1 ELSE hi_{c} - lo_{c} END"


def _limits(cols: list[str], table: str, key: str | None = "segment") -> str:
    inner = ", ".join(f"min({c}) FILTER (NOT is_test) AS lo_{c}, max({c}) FILTER (NOT is_test) AS hi_{c}" for c in cols)
    return f"SELECT {key + ',' if key else ''} {inner} FROM {table}" + (f" GROUP BY {key}" if key else "")


LAG_COLUMNS = ["weekend", "lag_1", "lag_7", "y"]
LAG_CTES = {
    "series": SERIES,
    "lagged": """SELECT * FROM (SELECT *, lag(y, 1) OVER w AS lag_1, lag(y, 7) OVER w AS lag_7 FROM series
        WINDOW w AS (PARTITION BY segment, is_test ORDER BY ds)) WHERE y IS NOT NULL AND lag_1 IS NOT NULL AND lag_7 IS NOT NULL""",
    "limits": _limits(LAG_COLUMNS, "lagged"),
    "vectors": "SELECT l.segment, ds, y, is_test, lo_y, hi_y, [1.0::DOUBLE, "
    + ", ".join(_scaled(c) for c in LAG_COLUMNS)
    + "] AS x FROM lagged l JOIN limits m ON l.segment = m.segment",
    "design": "SELECT * FROM vectors WHERE NOT is_test",
    **ridge_sql(4, "[0, 1e-6, 1e-6, 1e-6]"),
}
LAG_SQL = {"recursive": True, "extra": LAG_CTES}


@query(
    "x1_lag_forecast",
    with_views(
        """SELECT v.segment, ds, round(y, 2) AS actual,
             round(list_dot_product(beta, x[1:4]) * (hi_y - lo_y) + lo_y, 1) AS predicted
           FROM vectors v JOIN beta b ON v.segment = b.segment WHERE is_test""",
        "segment_dense",
        **LAG_SQL,
    ),
)
def x1(t: Tables) -> DataFrame:
    prepared = _lag_rows(t)
    found = lagged.predict(prepared, lagged.fit(prepared))
    return rounded(rounded(found, 2, "actual"), 1, "predicted")


@query(
    "x1_coefficients",
    with_views(
        """SELECT segment, unnest(['intercept', 'weekend', 'lag_1', 'lag_7']) AS feature,
             unnest(list_transform(beta, lambda v: round(v, 5))) AS coefficient FROM beta""",
        "segment_dense",
        **LAG_SQL,
    ),
)
def x1_coefficients(t: Tables) -> DataFrame:
    prepared = _lag_rows(t)
    return rounded(lagged.coefficients(prepared, lagged.fit(prepared)), 5, "coefficient")


def _two_measures(t: Tables) -> DataFrame:
    """Daily revenue and shipped quantity, weekend flag, as one series without a key."""
    merged = views.daily_orders(t).join(views.daily_ship(t), "day", "left")
    return merged.select(
        F.col("day").alias("ds"),
        F.col("revenue").alias("y"),
        "quantity",
        calendar.is_weekend("day").cast("double").alias("weekend"),
        quality.in_test_year(merged, "day", TEST_YEAR).alias("is_test"),
    )


def _sequence_rows(t: Tables) -> lagged.Prepared:
    return lagged.prepare_sequences(
        _two_measures(t), "ds", "y", ["y", "quantity"], ["weekend"], 2, "is_test", **ONE_SERIES
    )


SEQUENCE_CTES = {
    "base": """SELECT o.day AS ds, revenue AS y, quantity, CAST(isodow(o.day) > 5 AS DOUBLE) AS weekend,
        year(o.day) = 2001 AS is_test FROM daily_orders o LEFT JOIN daily_ship s ON o.day = s.day""",
    "limits": _limits(["y", "quantity", "weekend"], "base", None),
    "scaled": f"SELECT ds, is_test, lo_y, hi_y, {_scaled('y')} AS y, {_scaled('quantity')} AS q, {_scaled('weekend')} AS w FROM base, limits",
    "samples": """SELECT *, lag(y, 2) OVER w2 AS y2, lag(q, 2) OVER w2 AS q2, lag(y, 1) OVER w2 AS y1, lag(q, 1) OVER w2 AS q1,
        row_number() OVER w2 AS rn FROM scaled WINDOW w2 AS (ORDER BY ds)""",
    "vectors": """SELECT 1 AS segment, ds, is_test, lo_y, hi_y, [1.0::DOUBLE, y2, q2, y1, q1, w, y] AS x FROM samples
        WHERE rn > 2""",
    "design": """SELECT * FROM vectors WHERE NOT is_test AND len(list_filter(x, lambda v: v IS NULL)) = 0""",
    **ridge_sql(6, "[0, 1e-6, 1e-6, 1e-6, 1e-6, 1e-6]"),
}


@query(
    "x2_sequence_forecast",
    with_views(
        """SELECT ds, round(x[7] * (hi_y - lo_y) + lo_y, 2) AS actual,
             CASE WHEN len(list_filter(x[1:6], lambda v: v IS NULL)) = 0 THEN
               round(list_dot_product(beta, list_transform(x[1:6], lambda v: coalesce(v, 0))) * (hi_y - lo_y) + lo_y, 0) END AS predicted
           FROM vectors, beta WHERE is_test""",
        "daily_orders",
        "daily_ship",
        extra=SEQUENCE_CTES,
        recursive=True,
    ),
)
def x2(t: Tables) -> DataFrame:
    prepared = _sequence_rows(t)
    found = lagged.predict(prepared, lagged.fit(prepared))
    return rounded(rounded(found, 2, "actual"), 0, "predicted")


@query("x2_sequence_elastic")
def x2_elastic(t: Tables) -> DataFrame:
    prepared = _sequence_rows(t)
    return lagged.predict(prepared, lagged.fit_elastic(prepared, l1=0.001, l2=0.01))


class Periodic:
    """A model a user may bring: the mean of each weekday and season, beside that of the series."""

    @staticmethod
    def fit(rows, state):
        """Sums and counts by cell, going on from those of the rows before."""
        cells = dict(state or {})
        known = rows[rows["y"].notna()]
        for cell, values in known.groupby([known["ds"].dt.dayofweek, known["ds"].dt.month % 12 // 3])["y"]:
            total, n = cells.get(cell, (0.0, 0))
            cells[cell] = (total + float(values.sum()), n + len(values))
        return cells

    @staticmethod
    def merge(a, b):
        return {c: tuple(x + y for x, y in zip(a.get(c, (0.0, 0)), b.get(c, (0.0, 0)), strict=True)) for c in {*a, *b}}

    @staticmethod
    def predict(cells, rows):
        found = rows[["segment", "ds", "y"]].rename(columns={"y": "actual"})
        total = sum(t for t, _ in cells.values()) if cells else 0.0
        n = sum(n for _, n in cells.values()) if cells else 0
        whole = total / n if n else None
        own = [(cells or {}).get(cell) for cell in zip(rows["ds"].dt.dayofweek, rows["ds"].dt.month % 12 // 3)]
        found["predicted"] = [c[0] / c[1] if c else whole for c in own]
        return found


@query(
    "x2_user_model",
    with_views(
        """SELECT t.segment, t.ds, round(t.y, 2) AS actual, round(coalesce(c.m, w.m), 2) AS predicted FROM series t
           LEFT JOIN (SELECT segment, isodow(ds) AS d, month(ds) % 12 // 3 AS q, avg(y) AS m FROM series WHERE NOT is_test GROUP BY ALL) c
             ON t.segment = c.segment AND isodow(t.ds) = c.d AND month(t.ds) % 12 // 3 = c.q
           LEFT JOIN (SELECT segment, avg(y) AS m FROM series WHERE NOT is_test GROUP BY ALL) w ON t.segment = w.segment WHERE is_test""",
        "segment_dense",
        extra={"series": SERIES},
    ),
)
def x2_user(t: Tables) -> DataFrame:
    rows = _series(t).select("segment", "ds", "y", "is_test")
    schema = "segment string, ds timestamp_ntz, actual double, predicted double"
    found = per_series.per_series(rows, "is_test", Periodic.fit, Periodic.predict, schema, "ds", ["segment"], Periodic.merge)
    return rounded(found, 2, "actual", "predicted")


@query("x1_pooled_linear")
def x1_pooled(t: Tables) -> DataFrame:
    from pyspark.ml.regression import LinearRegression

    _, found = lagged.pooled(_lag_rows(t), LinearRegression(regParam=0.001, elasticNetParam=0.5))
    return found


@query("x14_tree_importance")
def x14_tree(t: Tables) -> DataFrame:
    from pyspark.ml.regression import GBTRegressor

    prepared = _lag_rows(t)
    model, _ = lagged.pooled(prepared, GBTRegressor(seed=7))
    return lagged.pooled_importance(t.spark, prepared, model)


@query(
    "x14_importance",
    with_views(
        """SELECT segment, unnest(['weekend', 'lag_1', 'lag_7']) AS feature,
             unnest(list_transform(w, lambda v: round(v / list_sum(w), 5))) AS importance FROM
           (SELECT d.segment, [abs(any_value(beta[2])) * stddev_pop(x[2]), abs(any_value(beta[3])) * stddev_pop(x[3]),
              abs(any_value(beta[4])) * stddev_pop(x[4])] AS w FROM design d JOIN beta b ON d.segment = b.segment GROUP BY 1)""",
        "segment_dense",
        **LAG_SQL,
    ),
)
def x14(t: Tables) -> DataFrame:
    prepared = _lag_rows(t)
    return rounded(lagged.importance(prepared, lagged.fit(prepared)), 5, "importance")


@query(
    "x14_permutation",
    with_views(
        """SELECT segment, feature, round(any_value(base), 7) AS base_mse, round(avg(mse), 7) AS permuted_mse,
             round(avg(mse) - any_value(base), 7) AS importance, round(stddev_pop(mse), 7) AS spread FROM
           (SELECT n.segment, j, ['weekend', 'lag_1', 'lag_7'][j] AS feature, r,
              avg(pow(list_dot_product(beta, n.x[1:4]) - n.x[5], 2)) AS base,
              avg(pow(list_dot_product(beta, n.x[1:4]) + beta[j + 1] * (h.x[j + 1] - n.x[j + 1]) - n.x[5], 2)) AS mse
            FROM numbered n JOIN hashed h ON n.segment = h.segment AND n.p = h.q JOIN beta b ON b.segment = n.segment, range(1, 4) js(j)
            GROUP BY n.segment, j, r) GROUP BY segment, feature""",
        "segment_dense",
        recursive=True,
        extra={
            **LAG_CTES,
            "numbered": "SELECT *, row_number() OVER (PARTITION BY segment ORDER BY ds) AS p FROM vectors WHERE is_test",
            "hashed": """SELECT segment, r, x, row_number() OVER (PARTITION BY segment, r
                ORDER BY md5('7|' || r || '|' || CAST(ds AS VARCHAR))) AS q FROM numbered, range(3) t(r)""",
        },
    ),
)
def x14_permutation(t: Tables) -> DataFrame:
    """Permutation importance of the lag model on the test rows, three shuffles, in scaled units."""
    prepared = _lag_rows(t)
    predict = lagged.predictor(prepared, blocks.settle(lagged.fit(prepared)))
    tested = prepared.rows.filter("is_test")
    found = importance.permutation_importance(tested, predict, prepared.features, "y", ["ds"], ["segment"], 3, 7)
    return rounded(found, 7, "base_mse", "permuted_mse", "importance", "spread")


HISTORY_CTES = {
    **{k: v for k, v in LAG_CTES.items() if k in ("series", "lagged", "limits", "vectors")},
    "halves": """SELECT segment, is_test, i, j, avg(x[i] * x[j]) AS v FROM vectors, range(1, 6) a(i), range(1, 6) b(j) GROUP BY ALL""",
    "squares": """SELECT segment, is_test, list(cells ORDER BY i) AS m FROM (SELECT segment, is_test, i, list(v ORDER BY j) AS cells
        FROM halves GROUP BY ALL) GROUP BY ALL""",
    "descent": """SELECT segment, -1::BIGINT AS step, [0.0, 0, 0, 0]::DOUBLE[] AS beta, m FROM squares WHERE NOT is_test UNION ALL
        SELECT segment, step + 1, list_transform(beta, lambda b, i: b - (list_dot_product(m[i][1:4], beta) - m[i][5]) / (m[1][1] + m[2][2] + m[3][3] + m[4][4])), m
        FROM descent WHERE step < 49""",
    "losses": """SELECT d.segment, step, s.is_test, s.m[5][5] - 2 * list_dot_product(beta, s.m[5][1:4])
        + list_sum(list_transform(beta, lambda b, i: b * list_dot_product(s.m[i][1:4], beta))) AS loss
        FROM descent d JOIN squares s ON d.segment = s.segment WHERE step >= 0""",
    "maes": """SELECT d.segment, step, avg(abs(x[5] - list_dot_product(beta, x[1:4]))) AS mae FROM descent d JOIN vectors v
        ON d.segment = v.segment WHERE is_test AND step >= 0 GROUP BY 1, 2""",
}


@query(
    "x12_training_history",
    with_views(
        " UNION ALL ".join(
            [
                "SELECT segment, step, 'train/loss' AS metric, round(loss, 7) AS value FROM losses WHERE NOT is_test",
                "SELECT segment, step, 'val/loss', round(loss, 7) FROM losses WHERE is_test",
                "SELECT segment, step, 'val/mse', round(loss, 7) FROM losses WHERE is_test",
                "SELECT segment, step, 'val/rmse', round(sqrt(loss), 7) FROM losses WHERE is_test",
                "SELECT segment, step, 'val/mae', round(mae, 7) FROM maes",
            ]
        ),
        "segment_dense",
        extra=HISTORY_CTES,
        recursive=True,
    ),
)
def x12(t: Tables) -> DataFrame:
    history = lagged.training_history(_lag_rows(t), epochs=50)
    names = {m: m for m in tables.METRIC_NAMES}
    rows = tables.metric_rows(history, F.col("segment"), F.col("step"), names).withColumnRenamed("run", "segment")
    # A series without test rows has no validation values.
    return rounded(rows, 7, "value").filter(F.col("value").isNotNull())


# Training in rounds: the forecast and the history of one model.
ROUNDS = {"batches": 8, "epochs": 20, "seed": 3}
ROUND_CTES = {
    **{k: v for k, v in LAG_CTES.items() if k in ("series", "lagged", "limits", "vectors")},
    "dealt": """SELECT *, CAST('0x' || md5('3|' || CAST(ds AS VARCHAR))[1:8] AS BIGINT) % 8 AS batch FROM vectors WHERE NOT is_test""",
    "cells": "SELECT segment, batch, i, j, avg(x[i] * x[j]) AS v FROM dealt, range(1, 6) a(i), range(1, 6) b(j) GROUP BY ALL",
    "squares": """SELECT segment, batch, list(row_cells ORDER BY i) AS m FROM (SELECT segment, batch, i, list(v ORDER BY j) AS row_cells
        FROM cells GROUP BY ALL) GROUP BY ALL""",
    "traces": "SELECT segment, max(m[1][1] + m[2][2] + m[3][3] + m[4][4]) AS trace FROM squares GROUP BY 1",
    "turns": """SELECT segment, m, epoch, row_number() OVER (PARTITION BY segment ORDER BY epoch, md5('3|' || epoch || '|' || batch)) AS turn
        FROM squares, range(20) e(epoch)""",
    "walk": """SELECT segment, 0::BIGINT AS turn, [0.0, 0, 0, 0]::DOUBLE[] AS beta FROM traces UNION ALL
        SELECT w.segment, w.turn + 1, list_transform(w.beta, lambda b, i: b - (list_dot_product(t.m[i][1:4], w.beta) - t.m[i][5]) / c.trace)
        FROM walk w JOIN turns t ON t.segment = w.segment AND t.turn = w.turn + 1 JOIN traces c ON c.segment = w.segment""",
    "epochs": """SELECT w.segment, t.epoch, w.beta FROM walk w JOIN turns t ON t.segment = w.segment AND t.turn = w.turn
        QUALIFY row_number() OVER (PARTITION BY w.segment, t.epoch ORDER BY w.turn DESC) = 1""",
}


@query(
    "x1_rounds_forecast",
    with_views(
        """SELECT v.segment, ds, round(y, 2) AS actual,
             round(list_dot_product(beta, x[1:4]) * (hi_y - lo_y) + lo_y, 1) AS predicted
           FROM vectors v JOIN epochs e ON v.segment = e.segment AND e.epoch = 19 WHERE is_test""",
        "segment_dense",
        extra=ROUND_CTES,
        recursive=True,
    ),
)
def x1_rounds(t: Tables) -> DataFrame:
    prepared = _lag_rows(t)
    found = lagged.predict(prepared, lagged.fit_rounds(prepared, **ROUNDS))
    return rounded(rounded(found, 2, "actual"), 1, "predicted")


@query(
    "x12_rounds_history",
    with_views(
        """SELECT l.segment, epoch AS step, round(l.train, 7) AS "train/loss", round(l.test, 7) AS "val/loss",
             round(l.test * pow(s.hi - s.lo, 2), 0) AS "val/mse", round(sqrt(l.test) * (s.hi - s.lo), 2) AS "val/rmse", round(l.mae * (s.hi - s.lo), 2) AS "val/mae"
           FROM (SELECT e.segment, epoch, avg(pow(d, 2)) FILTER (NOT is_test) AS train, avg(pow(d, 2)) FILTER (is_test) AS test, avg(abs(d)) FILTER (is_test) AS mae
                 FROM (SELECT e.segment, epoch, is_test, x[5] - list_dot_product(beta, x[1:4]) AS d FROM epochs e JOIN vectors v ON e.segment = v.segment) e
                 GROUP BY 1, 2) l
           JOIN (SELECT segment, any_value(lo_y) AS lo, any_value(CASE WHEN hi_y = lo_y THEN lo_y + 1 ELSE hi_y END) AS hi FROM vectors GROUP BY 1) s ON s.segment = l.segment""",
        "segment_dense",
        extra=ROUND_CTES,
        recursive=True,
    ),
)
def x12_rounds(t: Tables) -> DataFrame:
    """Losses in the scale of the fit, errors in the units of the forecast; the last step is its model."""
    prepared = _lag_rows(t)
    found = lagged.history(prepared, lagged.fit_rounds(prepared, **ROUNDS), real_units=True)
    return rounded(rounded(rounded(found, 7, "train/loss", "val/loss"), 2, "val/rmse", "val/mae"), 0, "val/mse")


# --- additive forecasts ----------------------------------------------------------------

PLAIN = additive.Spec()
WITH_REGRESSORS = additive.with_regressors(PLAIN, ["weekend"])


def additive_ctes(changepoints: int, yearly: int, weekly: int, regressors: list[str]) -> dict[str, str]:
    """``vectors(segment, ds, y, is_test, x, size, start, span)`` of the additive design."""
    days = "(epoch(ds) / 86400.0::DOUBLE)"

    def waves(period: str, order: int) -> str:
        return f"""flatten(list_transform(range(1, {order + 1}), lambda k: [sin({days} * (2 * pi() * k / {period})), cos({days} * (2 * pi() * k / {period}))]))"""

    parts = ["[1.0::DOUBLE, tau]"]
    if changepoints:
        parts.append(f"list_transform(range(1, {changepoints + 1}), lambda i: greatest(tau - 0.8 / {changepoints} * i, 0))")
    if yearly:
        parts.append(waves("365.25", yearly))
    if weekly:
        parts.append(waves("7.0", weekly))
    if regressors:
        parts.append("[" + ", ".join(regressors) + "]")
    # A missing label is written 0 here; such rows are left out of every fit below.
    parts.append("[coalesce(y / size, 0)]")
    return {
        "series": SERIES,
        "scales": f"""SELECT segment, min({days}) AS start, max({days}) - min({days}) AS span, max(abs(y)) AS size
            FROM series WHERE NOT is_test AND y IS NOT NULL GROUP BY 1""",
        "vectors": f"""SELECT segment, ds, y, is_test, size, start, span, list_concat({', '.join(parts)}) AS x FROM
            (SELECT s.*, size, start, span, ({days} - start) / span AS tau FROM series s JOIN scales c ON s.segment = c.segment)""",
    }


def penalty_sql(spec: additive.Spec, c: str | None = None, s: str | None = None) -> str:
    c = c or str(spec.changepoint_prior_scale)
    s = s or str(spec.seasonality_prior_scale)
    waves = 2 * (spec.yearly_order + spec.weekly_order)
    parts = ["0.0004::DOUBLE, 0.0004"]
    parts += ["0.0" if spec.changepoint_prior == "laplace" else f"0.01 / (2 * {c} * {c})"] * spec.changepoints
    parts += [f"0.01 / ({s} * {s})"] * waves
    parts += ["0.0001"] * len(spec.regressors)
    return "[" + ", ".join(parts) + "]"


def _width(spec: additive.Spec) -> int:
    return 2 + spec.changepoints + 2 * (spec.yearly_order + spec.weekly_order) + len(spec.regressors)


def fitted_ctes(spec: additive.Spec) -> dict[str, str]:
    return {
        **additive_ctes(spec.changepoints, spec.yearly_order, spec.weekly_order, list(spec.regressors)),
        "design": "SELECT segment, x FROM vectors WHERE NOT is_test AND y IS NOT NULL",
        **ridge_sql(_width(spec), penalty_sql(spec)),
    }


def _forecast_sql(spec: additive.Spec) -> str:
    p = _width(spec)
    return with_views(
        f"""SELECT v.segment, ds, is_test, round(y, 2) AS y, round(list_dot_product(beta, x[1:{p}]) * size, 0) AS yhat
            FROM vectors v JOIN beta b ON v.segment = b.segment""",
        "segment_dense",
        extra=fitted_ctes(spec),
        recursive=True,
    )


def _forecast(t: Tables, spec: additive.Spec) -> DataFrame:
    rows = _series(t)
    fitted = additive.fit(rows.filter(~F.col("is_test")), spec, series_cols=["segment"])
    found = additive.predict(fitted, rows.select("segment", "ds", "is_test", "y", *spec.regressors))
    return rounded(rounded(found.drop(*spec.regressors), 2, "y"), 0, "yhat")


@query("x3_additive_forecast", _forecast_sql(PLAIN))
def x3(t: Tables) -> DataFrame:
    return _forecast(t, PLAIN)


@query("x4_additive_regressors", _forecast_sql(WITH_REGRESSORS))
def x4(t: Tables) -> DataFrame:
    return _forecast(t, WITH_REGRESSORS)


def _fitted(t: Tables) -> additive.Fitted:
    return additive.fit(_series(t).filter(~F.col("is_test")), WITH_REGRESSORS, series_cols=["segment"])


@query(
    "x8_regressor_coefficients",
    with_views(
        f"""SELECT b.segment, 'weekend' AS regressor, round(beta[{_width(WITH_REGRESSORS)}] * size, 1) AS coefficient
            FROM beta b JOIN scales s ON b.segment = s.segment""",
        "segment_dense",
        extra=fitted_ctes(WITH_REGRESSORS),
        recursive=True,
    ),
)
def x8(t: Tables) -> DataFrame:
    return rounded(additive.regressor_coefficients(_fitted(t)), 1, "coefficient")


@query(
    "x9_components",
    with_views(
        " UNION ALL ".join(
            f"""SELECT v.segment, ds, '{name}' AS component, round(list_dot_product(beta[{a}:{b}], x[{a}:{b}]) * size, -2) AS value
                FROM vectors v JOIN beta b ON v.segment = b.segment"""
            for name, a, b in [("trend", 1, 27), ("yearly", 28, 47), ("weekly", 48, 53), ("regressors", 54, 54)]
        ),
        "segment_dense",
        extra=fitted_ctes(WITH_REGRESSORS),
        recursive=True,
    ),
)
def x9(t: Tables) -> DataFrame:
    found = additive.components(_fitted(t), _series(t).select("segment", "ds", "weekend"))
    # Adding zero turns a rounded -0.0 into 0.0.
    return found.drop("weekend").withColumn("value", F.round("value", -2) + 0.0)


@query(
    "x10_changepoints",
    with_views(
        """SELECT segment, 'knot_' || i AS changepoint,
             TIMESTAMP '1970-01-01' + to_seconds(round((start + 0.8 / 25 * i * span) * 86400)::BIGINT) AS at,
             round(beta[2 + i] * size / span, 2) AS slope_change
           FROM (SELECT b.segment, beta, start, span, size, unnest(range(1, 26)) AS i FROM beta b JOIN scales s ON b.segment = s.segment)""",
        "segment_dense",
        extra=fitted_ctes(WITH_REGRESSORS),
        recursive=True,
    ),
)
def x10(t: Tables) -> DataFrame:
    return rounded(additive.changepoints(_fitted(t)), 2, "slope_change")


# Laplace prior: columns in the order intercept, slope, waves, regressor, then knots. The first 29
# are eliminated, which leaves a matrix over the knots; accelerated proximal steps find which
# knots move and which way, and elimination over those gives their exact values.
LAPLACE = replace(WITH_REGRESSORS, changepoint_prior="laplace")
_P, _K = _width(LAPLACE), LAPLACE.changepoints
_A = _P - _K
_L1 = LAPLACE.noise**2 / LAPLACE.changepoint_prior_scale
LAPLACE_CTES = {
    **{k: v for k, v in fitted_ctes(LAPLACE).items() if k in ("series", "scales", "vectors")},
    "design": f"""SELECT segment, list_concat(x[1:2], x[{3 + _K}:{_P}], x[3:{2 + _K}], x[{_P + 1}:{_P + 1}]) AS x
        FROM vectors WHERE NOT is_test AND y IS NOT NULL""",
    **{k: v for k, v in ridge_sql(_P, f"list_concat(({penalty_sql(LAPLACE)})[1:2], ({penalty_sql(LAPLACE)})[{3 + _K}:{_P}], list_transform(range({_K}), lambda i: 0.0::DOUBLE))").items() if k in ("sums", "matrix")},
    "steps": eliminate_sql(str(_A), "segment")["steps"],
    "reduced": f"""SELECT segment, m, list_transform(m[{_A + 1}:{_P}], lambda cells: cells[{_A + 1}:{_P}]) AS s,
        list_transform(m[{_A + 1}:{_P}], lambda cells: cells[{_P + 1}]) AS q FROM steps WHERE k = {_A + 1}""",
    "moves": f"""SELECT segment, s, q, list_transform(s, lambda r: list_sum(list_transform(r, lambda v: abs(v)))) AS d,
          list_transform(q, lambda v: 0.0::DOUBLE) AS b, list_transform(q, lambda v: 0.0::DOUBLE) AS z, 0 AS k FROM reduced
        UNION ALL SELECT segment, s, q, d, n, list_transform(n, lambda v, i: v + (k / (k + 3.0::DOUBLE)) * (v - b[i])), k + 1 FROM (
          SELECT *, list_transform(g, lambda v, i: sign(v) * greatest(abs(v) - {_L1} / d[i], 0)) AS n FROM (
            SELECT *, list_transform(s, lambda r, i: z[i] + (q[i] - list_dot_product(r, z)) / d[i]) AS g FROM moves WHERE k < 3000))""",
    "support": "SELECT segment, s, q, list_transform(b, lambda v: sign(v)) AS u FROM moves WHERE k = 3000",
    "matrix2": f"""SELECT segment, list_transform(s, lambda r, i: list_concat(
          list_transform(r, lambda v, j: CASE WHEN u[i] != 0 AND u[j] != 0 THEN v WHEN i = j THEN 1.0 ELSE 0.0 END),
          [CASE WHEN u[i] != 0 THEN q[i] - {_L1} * u[i] ELSE 0.0 END])) AS m FROM support""",
    **eliminate_sql(str(_K), "segment", "2"),
    "beta": f"""SELECT i.segment, b.beta AS knots, list_transform(i.m[1:{_A}],
        lambda cells: cells[{_P + 1}] - list_dot_product(cells[{_A + 1}:{_P}], b.beta)) AS rest FROM reduced i JOIN beta2 b ON i.segment = b.segment""",
}


@query(
    "x3_laplace_forecast",
    with_views(
        f"""SELECT v.segment, ds, is_test, round(y, 2) AS y, round(list_dot_product(list_concat(rest[1:2], knots, rest[3:{_A}]), x[1:{_P}]) * size, 0) AS yhat
            FROM vectors v JOIN beta b ON v.segment = b.segment""",
        "segment_dense",
        extra=LAPLACE_CTES,
        recursive=True,
    ),
)
def x3_laplace(t: Tables) -> DataFrame:
    return _forecast(t, LAPLACE)


@query(
    "x10_sparse_changepoints",
    with_views(
        """SELECT segment, 'knot_' || i AS changepoint,
             TIMESTAMP '1970-01-01' + to_seconds(round((start + 0.8 / 25 * i * span) * 86400)::BIGINT) AS at,
             round(knots[i] * size / span, 2) AS slope_change
           FROM (SELECT b.segment, knots, start, span, size, unnest(range(1, 26)) AS i FROM beta b JOIN scales s ON b.segment = s.segment)
           WHERE knots[i] != 0""",
        "segment_dense",
        extra=LAPLACE_CTES,
        recursive=True,
    ),
)
def x10_sparse(t: Tables) -> DataFrame:
    fitted = additive.fit(_series(t).filter(~F.col("is_test")), LAPLACE, series_cols=["segment"])
    return rounded(additive.changepoints(fitted, moved_only=True), 2, "slope_change")


GRID_CTES = {
    **{k: v for k, v in fitted_ctes(WITH_REGRESSORS).items() if k in ("series", "scales", "vectors", "design")},
    "settings": """SELECT c, s FROM (VALUES (0.001::DOUBLE), (0.01), (0.1), (0.5), (5), (10)) a(c),
        (VALUES (0.01::DOUBLE), (0.1), (1), (10)) b(s)""",
    "sums": f"""SELECT segment, i, j, sum(x[i] * x[j]) AS v FROM design, range(1, {_width(WITH_REGRESSORS) + 1}) a(i),
        range(1, {_width(WITH_REGRESSORS) + 2}) b(j) GROUP BY ALL""",
    "matrix": f"""SELECT segment, c, s, list(cells ORDER BY i) AS m FROM (SELECT segment, c, s, i,
        list(v + CASE WHEN i = j THEN ({penalty_sql(WITH_REGRESSORS, 'c', 's')})[i] ELSE 0 END ORDER BY j) AS cells
        FROM sums, settings GROUP BY ALL) GROUP BY ALL""",
    **eliminate_sql(str(_width(WITH_REGRESSORS)), "segment, c, s"),
    "scores": f"""SELECT v.segment, c, s, avg(pow(y - list_dot_product(beta, x[1:{_width(WITH_REGRESSORS)}]) * size, 2)) AS mse
        FROM vectors v JOIN beta b ON v.segment = b.segment WHERE is_test AND y IS NOT NULL GROUP BY ALL""",
}


@query(
    "x7_grid_search",
    with_views(
        """SELECT segment, c AS changepoint_prior_scale, s AS seasonality_prior_scale, round(mse / 1e6, 2) AS mse FROM scores""",
        "segment_dense",
        extra=GRID_CTES,
        recursive=True,
    ),
)
def x7(t: Tables) -> DataFrame:
    found = additive.grid_search(_series(t), "is_test", WITH_REGRESSORS, GRID, series_cols=["segment"])
    return found.drop("rank").withColumn("mse", F.round(F.col("mse") / 1e6, 2))


# Four stretches of the training years: before 2000, three of four months each.
ORIGINS = ["2000-01-01", "2000-05-01", "2000-09-01", "2001-01-01"]
ROLLING_CTES = {
    "series": GRID_CTES["series"],
    "scales": GRID_CTES["scales"].replace("NOT is_test", "ds < TIMESTAMP '2000-01-01'"),
    **{k: GRID_CTES[k] for k in ("vectors", "settings")},
    "folded": f"""SELECT segment, x, size, {' + '.join(f"(ds >= TIMESTAMP '{o}')::INT" for o in ORIGINS[:-1])} AS fold
        FROM vectors WHERE y IS NOT NULL AND NOT is_test""",
    "pieces": f"""SELECT segment, fold, i, j, sum(x[i] * x[j]) AS v FROM folded, range(1, {_width(WITH_REGRESSORS) + 1}) a(i),
        range(1, {_width(WITH_REGRESSORS) + 2}) b(j) GROUP BY ALL""",
    "sums": """SELECT segment, i, j, fold + 1 AS fold, sum(v) OVER (PARTITION BY segment, i, j ORDER BY fold) AS v FROM pieces QUALIFY fold < 3""",
    "matrix": GRID_CTES["matrix"].replace("segment, c, s", "segment, c, s, fold"),
    **eliminate_sql(str(_width(WITH_REGRESSORS)), "segment, c, s, fold"),
    "scores": f"""SELECT v.segment, c, s, count(DISTINCT fold) AS folds,
          avg(pow((x[{_width(WITH_REGRESSORS) + 1}] - list_dot_product(beta, x[1:{_width(WITH_REGRESSORS)}])) * size, 2)) AS mse
        FROM folded v JOIN beta b USING (segment, fold) GROUP BY ALL""",
}


@query(
    "x7_rolling_origin",
    with_views(
        """SELECT segment, c AS changepoint_prior_scale, s AS seasonality_prior_scale, round(mse / 1e6, 2) AS mse, folds,
             row_number() OVER (PARTITION BY segment ORDER BY mse, c, s) AS rank FROM scores""",
        "segment_dense",
        extra=ROLLING_CTES,
        recursive=True,
    ),
)
def x7_rolling(t: Tables) -> DataFrame:
    found = additive.rolling_grid_search(_series(t), ORIGINS, WITH_REGRESSORS, GRID, series_cols=["segment"])
    return found.withColumn("mse", F.round(F.col("mse") / 1e6, 2))


@query(
    "t2_best_setting",
    with_views(
        """SELECT segment, c AS changepoint_prior_scale, s AS seasonality_prior_scale, round(mse / 1e6, 2) AS mse,
             row_number() OVER (PARTITION BY segment ORDER BY mse, c, s) AS rank FROM scores""",
        "segment_dense",
        extra=GRID_CTES,
        recursive=True,
    ),
)
def t2(t: Tables) -> DataFrame:
    found = additive.grid_search(_series(t), "is_test", WITH_REGRESSORS, GRID, series_cols=["segment"])
    return found.withColumn("mse", F.round(F.col("mse") / 1e6, 2))


# --- walk-forward ----------------------------------------------------------------------

# As the walk-forward experiment has it: all seasonal terms, all daily regressors, a loose trend.
SEASONS = ("spring", "summer", "winter")  # autumn is the dropped first
FULL = additive.with_regressors(
    additive.Spec(changepoint_prior_scale=5.0), ["is_holiday_or_weekend_True", *(f"season_{s}" for s in SEASONS)]
)
P = _width(FULL)


def _featured_series(t: Tables) -> DataFrame:
    """The series with the encoded daily regressors: holiday or weekend, and seasons."""
    rows = joins.holiday_or_weekend(_series(t), "ds", basics.orders_holidays(t), out="_free")
    flags = {f"season_{s}": (calendar.season("ds") == s).cast("double") for s in SEASONS}
    flagged = rows.withColumns({"is_holiday_or_weekend_True": F.col("_free").cast("double"), **flags})
    return blocks.settle(flagged.drop("_free", "weekend"))


FULL_SERIES = """SELECT segment, day AS ds, revenue AS y, year(day) = 2001 AS is_test,
    CAST(isodow(day) > 5 OR EXISTS (SELECT 1 FROM holidays h WHERE h.holiday = day::DATE) AS DOUBLE) AS "is_holiday_or_weekend_True",
    CAST(month(day) IN (3, 4, 5) AS DOUBLE) AS season_spring, CAST(month(day) IN (6, 7, 8) AS DOUBLE) AS season_summer,
    CAST(month(day) IN (12, 1, 2) AS DOUBLE) AS season_winter FROM segment_dense"""

# The inverse of the training matrix, then one rank-one update a test row.
WALK_CTES = {
    "years": basics.YEARS,
    "holidays": basics.HOLIDAYS,
    **additive_ctes(25, 10, 3, [f'"{r}"' for r in FULL.regressors]),
    "series": FULL_SERIES,
    "design": "SELECT segment, x FROM vectors WHERE NOT is_test AND y IS NOT NULL",
    "sums": f"SELECT segment, i, j, sum(x[i] * x[j]) AS v FROM design, range(1, {P + 2}) a(i), range(1, {P + 2}) b(j) GROUP BY ALL",
    "matrix": f"""SELECT segment, list(list_concat(cells, list_transform(range(1, {P + 1}), lambda c: CASE WHEN c = i THEN 1.0::DOUBLE ELSE 0 END)) ORDER BY i) AS m
        FROM (SELECT segment, i, list(v + CASE WHEN i = j THEN ({penalty_sql(FULL)})[i] ELSE 0 END ORDER BY j) AS cells
              FROM sums WHERE i <= {P} AND j <= {P} GROUP BY ALL) GROUP BY ALL""",
    "steps": eliminate_sql(str(P), "segment")["steps"],
    "first": f"""SELECT s.segment, list_transform(o.m, lambda cells: cells[1:{P}]) AS sys,
          list_transform(s.m, lambda cells: cells[{P + 1}:{2 * P}]) AS inv, xy, yy, n FROM steps s JOIN matrix o ON s.segment = o.segment
        JOIN (SELECT segment, list(v ORDER BY i) FILTER (i <= {P} AND j = {P + 1}) AS xy, max(v) FILTER (i = {P + 1} AND j = {P + 1}) AS yy,
              max(v) FILTER (i = 1 AND j = 1)::BIGINT AS n FROM sums GROUP BY 1) l ON s.segment = l.segment WHERE k = {P + 1}""",
    "tests": f"""SELECT segment, ds, y, size, x[1:{P}] AS v, x[{P + 1}] AS label, row_number() OVER (PARTITION BY segment ORDER BY ds) AS t
        FROM vectors WHERE is_test""",
    "runs": """SELECT segment, 1::BIGINT AS t, sys, inv, xy, yy, n FROM first UNION ALL
        SELECT segment, t + 1,
          CASE WHEN y IS NULL THEN sys ELSE list_transform(sys, lambda row, i: list_transform(row, lambda c, j: c + v[i] * v[j])) END,
          CASE WHEN y IS NULL THEN inv ELSE
            list_transform(inv, lambda row, i: list_transform(row, lambda c, j: c - g[i] * g[j] / (1 + list_dot_product(g, v)))) END,
          CASE WHEN y IS NULL THEN xy ELSE list_transform(xy, lambda c, i: c + v[i] * label) END,
          CASE WHEN y IS NULL THEN yy ELSE yy + label * label END, CASE WHEN y IS NULL THEN n ELSE n + 1 END FROM
        (SELECT r.*, s.y, s.v, s.label, list_transform(inv, lambda row: list_dot_product(row, s.v)) AS g
         FROM runs r JOIN tests s ON r.segment = s.segment AND r.t = s.t)""",
    # One step of refinement takes out what the updates of the inverse have rounded away.
    "solved": """SELECT segment, t, xy, yy, n, list_transform(b, lambda c, i: c + list_dot_product(inv[i], short)) AS beta FROM
        (SELECT *, list_transform(xy, lambda c, i: c - list_dot_product(sys[i], b)) AS short FROM
          (SELECT *, list_transform(inv, lambda row: list_dot_product(row, xy)) AS b FROM runs))""",
    "folds": f"""SELECT s.segment, s.ds, y AS actual, beta, size, n AS n_train, list_dot_product(beta, v) * size AS yhat,
        size * sqrt((yy - list_dot_product(beta, xy) - list_sum(list_transform(beta, lambda b, i: b * b * ({penalty_sql(FULL)})[i]))) / n) AS sigma
        FROM tests s JOIN solved r ON s.segment = r.segment AND s.t = r.t""",
}
WALK_SQL = {"extra": WALK_CTES, "recursive": True}


def _folds(t: Tables) -> DataFrame:
    return walkforward.walk_forward(_featured_series(t), "is_test", FULL, series_cols=["segment"], **DAILY)


@query(
    "x5_walk_forward",
    with_views(
        "SELECT segment, ds, round(actual, 2) AS actual, round(yhat, 0) AS yhat, round(sigma, 0) AS sigma, n_train FROM folds",
        "segment_dense",
        **WALK_SQL,
    ),
)
def x5(t: Tables) -> DataFrame:
    return rounded(rounded(_folds(t).drop("beta"), 2, "actual"), 0, "yhat", "sigma")


@query(
    "x6_served_predictions",
    with_views(
        """SELECT segment, ds AS datetime, round(actual, 2) AS actual, round(yhat, 0) AS prediction,
             round(yhat - 1.2815515655446004 * sigma, 0) AS p10, round(yhat + 1.2815515655446004 * sigma, 0) AS p90 FROM folds""",
        "segment_dense",
        **WALK_SQL,
    ),
)
def x6(t: Tables) -> DataFrame:
    found = walkforward.served(_folds(t), series_cols=["segment"])
    return rounded(rounded(found, 2, "actual"), 0, "prediction", "p10", "p90")


HORIZONS = (1, 7, 28)


@query(
    "x6_empirical_interval",
    with_views(
        """SELECT r.segment, r.horizon, r.day, round(actual, 2) AS actual, round(prediction, 2) AS prediction,
             round(prediction + q10, 2) AS p_low, round(prediction + q90, 2) AS p_high,
             round(prediction - 1.2815515655446004 * sd, 1) AS normal_low, round(prediction + 1.2815515655446004 * sd, 1) AS normal_high,
             coalesce(n, 0) AS n_errors
           FROM naive r LEFT JOIN spans s ON r.segment = s.segment AND r.horizon = s.horizon AND date_trunc('month', r.day) = s.month
           WHERE year(r.day) = 2001""",
        "segment_dense",
        extra={
            "naive": " UNION ALL ".join(
                f"SELECT segment, {h} AS horizon, day, revenue AS actual, lag(revenue, {h}) OVER (PARTITION BY segment ORDER BY day) AS prediction FROM segment_dense"
                for h in HORIZONS
            ),
            "known": "SELECT *, actual - prediction AS e FROM naive WHERE actual IS NOT NULL AND prediction IS NOT NULL",
            "months": "SELECT DISTINCT date_trunc('month', day) AS month FROM naive WHERE year(day) = 2001",
            "sorted": """SELECT segment, horizon, month, list(e ORDER BY e) AS es, count(*) AS n, stddev_pop(e) AS sd
                FROM known JOIN months ON day < month GROUP BY ALL""",
            "spans": """SELECT segment, horizon, month, n, sd, es[CAST(greatest(1, ceil(0.1::DOUBLE * n)) AS BIGINT)] AS q10,
                es[CAST(greatest(1, ceil(0.9::DOUBLE * n)) AS BIGINT)] AS q90 FROM sorted""",
        },
    ),
)
def x6_empirical(t: Tables) -> DataFrame:
    """Persistence at three horizons with intervals from the errors of the months before."""
    wide = lags.lag_features(
        views.segment_dense(t), "day", "revenue", HORIZONS, ["segment"], drop_incomplete=False, **DAILY
    )
    each = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"lag_{h}").alias("prediction")) for h in HORIZONS]))
    long = wide.select("segment", "day", F.col("revenue").alias("actual"), each.alias("f")).select("*", "f.*").drop("f")
    found = intervals.earlier_intervals(blocks.settle(long), "day", "actual", "prediction", ["segment", "horizon"])
    limits = ["actual", "prediction", "p_low", "p_high"]
    tested = found.filter(F.year("day") == TEST_YEAR)
    return rounded(rounded(tested, 2, *limits), 1, "normal_low", "normal_high")


@query(
    "x11_evaluation",
    with_views(
        """SELECT segment, round(avg(pow(actual - yhat, 2)) / 1e6, 2) AS mse, round(sqrt(avg(pow(actual - yhat, 2))), 1) AS rmse,
             round(avg(abs(actual - yhat)), 1) AS mae, count(actual) AS n FROM folds GROUP BY 1""",
        "segment_dense",
        **WALK_SQL,
    ),
)
def x11(t: Tables) -> DataFrame:
    found = evaluate.evaluation(_folds(t), "actual", "yhat", ["segment"])
    return found.select(
        "segment",
        F.round(F.col("mse") / 1e6, 2).alias("mse"),
        F.round("rmse", 1).alias("rmse"),
        F.round("mae", 1).alias("mae"),
        "n",
    )


@query(
    "u3_stitched",
    with_views(
        f"""SELECT v.segment, v.ds, 'train' AS part, round(v.y, 2) AS actual, round(list_dot_product(l.beta, x[1:{P}]) * v.size, 0) AS yhat
            FROM vectors v JOIN (SELECT segment, arg_max(beta, ds) AS beta FROM folds GROUP BY 1) l ON v.segment = l.segment WHERE NOT is_test
            UNION ALL SELECT segment, ds, 'test', round(actual, 2), round(yhat, 0) FROM folds""",
        "segment_dense",
        **WALK_SQL,
    ),
)
def u3(t: Tables) -> DataFrame:
    rows = _featured_series(t)
    folds = walkforward.walk_forward(rows, "is_test", FULL, series_cols=["segment"], **DAILY)
    found = walkforward.stitched(rows, folds, "is_test", FULL, series_cols=["segment"])
    return rounded(rounded(found, 2, "actual"), 0, "yhat")


def _mean_of_cents():
    """A mean whose sum is rounded to cents, as the rounded mean itself may be a tie."""
    n = F.col("n_train").cast("double")
    return F.try_divide(F.round(F.col("predicted") * n, 2), n).alias("predicted")


@query(
    "w8_expanding_window",
    """SELECT event_type, event_id, n_train, CASE WHEN n_train > 0 THEN round(predicted * n_train, 2) / n_train END AS predicted FROM
         (SELECT event_type, event_id, count(value) OVER w AS n_train, avg(value) OVER w AS predicted FROM events
          WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
)
def w8(t: Tables) -> DataFrame:
    events = t("events").select("event_type", "event_id", "ts", "value")
    found = walkforward.expanding_mean(events, "ts", "value", ["event_type"], ["event_id"], **RAW)
    return found.select("event_type", "event_id", "n_train", _mean_of_cents())


@query(
    "u2_growing_train",
    with_views(
        """SELECT segment, ds, n_train, CASE WHEN n_train > 0 THEN round(predicted * n_train, 2) / n_train END AS predicted FROM (SELECT segment, ds, is_test,
             count(y) OVER w AS n_train, avg(y) OVER w AS predicted FROM series
             WINDOW w AS (PARTITION BY segment ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE is_test""",
        "segment_dense",
        extra={"series": SERIES},
    ),
)
def u2(t: Tables) -> DataFrame:
    # Train grows by the observed row before each test row.
    found = walkforward.expanding_mean(_series(t), "ds", "y", ["segment"], **DAILY).filter("is_test")
    return found.select("segment", "ds", "n_train", _mean_of_cents())


