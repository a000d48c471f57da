"""Additive forecasts: piecewise-linear trend, seasonality and regressors, as penalised least squares.

The model is ``y = trend + weekly + yearly (+ daily) + regressors``. Priors become
penalties: a coefficient with prior deviation ``s`` is penalised by ``(noise / s)^2``
on scaled values. Slope changes have a Laplace prior (``changepoint_prior="laplace"``: most are
exactly zero) or the normal prior of the same variance (``2 * scale^2``), which has a closed
form. Knots are evenly spaced over the first part of the training span. This solves the same task as a Bayesian additive model; it does not
reproduce such a model's numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import utc_clock
from ..operators import blocks
from . import gram

# Half-width, in deviations, of the central 80% of a normal distribution.
Z80 = 1.2815515655446004
SECONDS_PER_DAY = 86400.0


@dataclass(frozen=True)
class Spec:
    """What the model contains and how strongly each part is held back."""

    regressors: tuple[str, ...] = ()
    changepoints: int = 25
    changepoint_range: float = 0.8
    yearly_order: int = 10
    weekly_order: int = 3
    daily_order: int = 0
    changepoint_prior_scale: float = 0.05
    seasonality_prior_scale: float = 10.0
    regressor_prior_scale: float = 10.0
    trend_prior_scale: float = 5.0
    noise: float = 0.1
    changepoint_prior: str = "normal"  # or "laplace"

    def __post_init__(self):
        if self.changepoint_prior not in ("normal", "laplace"):
            raise ValueError(f"changepoint_prior is normal or laplace, not {self.changepoint_prior!r}")

    def knots(self, beyond: float = 1.0) -> list[float]:
        """Knot positions in units of the training span, on to ``beyond`` at the same spacing."""
        if not self.changepoints:
            return []
        gap = self.changepoint_range / self.changepoints
        count = self.changepoints
        if beyond > 1.0:
            count = max(count, int(math.floor(beyond * self.changepoint_range / gap + 1e-9)))
        return [gap * (i + 1) for i in range(count)]


@dataclass(frozen=True)
class Term:
    """A column of the design, as SQL over rows that carry ``_days``, ``_start`` and ``_span``."""

    component: str
    name: str
    sql: str
    knot: float | None = None


def terms(spec: Spec, beyond: float = 1.0) -> list[Term]:
    """The columns of the design after the intercept."""
    t = "((_days - _start) / _span)"
    out = [Term("trend", "slope", t)]
    for i, knot in enumerate(spec.knots(beyond), 1):
        out.append(Term("trend", f"knot_{i}", f"greatest({t} - {knot!r}D, 0.0D)", knot))
    for component, period, order in (
        ("yearly", 365.25, spec.yearly_order),
        ("weekly", 7.0, spec.weekly_order),
        ("daily", 1.0, spec.daily_order),
    ):
        for k in range(1, order + 1):
            turn = 2.0 * math.pi * k / period
            for wave in ("sin", "cos"):
                out.append(Term(component, f"{component}_{wave}_{k}", f"{wave}(_days * {turn!r}D)"))
    out += [Term("regressors", r, f"CAST(`{r}` AS DOUBLE)") for r in spec.regressors]
    return out


def with_days(df: DataFrame, ts_col: str) -> DataFrame:
    """Add ``_days``: days since 1970, with fraction."""
    return df.withColumn("_days", _epoch_seconds(ts_col) / SECONDS_PER_DAY)


def features(design: Sequence[Term]) -> Column:
    return F.expr("array(1.0D, " + ", ".join(d.sql for d in design) + ")")


def vector(spec: Spec, design: Sequence[Term], target: str) -> Column:
    """``[1, features..., scaled target]``, null when the target or a regressor is."""
    present = " AND ".join(f"`{c}` IS NOT NULL" for c in (target, *spec.regressors))
    parts = ", ".join(["1.0D", *[d.sql for d in design], f"CAST(`{target}` / _size AS DOUBLE)"])
    return F.expr(f"CASE WHEN {present} THEN array({parts}) END")


def linear(design: Sequence[Term], chosen: Sequence[int], intercept: bool) -> Column:
    """Part of the prediction: the chosen terms (1-based) times their coefficients."""
    parts = ["beta[0]"] if intercept else []
    parts += [f"beta[{i}] * {design[i - 1].sql}" for i in chosen]
    return F.expr("(" + " + ".join(parts) + ") * _size")


def _epoch_seconds(ts_col: str) -> Column:
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", origin, utc_clock(ts_col)).cast("double")


def penalty_list(spec: Spec, design: Sequence[Term], changepoint_scale, seasonality_scale) -> list:
    """Penalty per coefficient, intercept first; the two scales are numbers or columns."""
    variance = spec.noise**2

    def of(term: Term):
        if term.knot is not None:
            return 0.0 if spec.changepoint_prior == "laplace" else variance / (changepoint_scale * changepoint_scale * 2.0)
        if term.component == "trend":
            return variance / spec.trend_prior_scale**2
        if term.component == "regressors":
            return variance / spec.regressor_prior_scale**2
        return variance / (seasonality_scale * seasonality_scale)

    return [variance / spec.trend_prior_scale**2, *[of(term) for term in design]]


def penalty_numbers(spec: Spec, design: Sequence[Term]) -> list[float]:
    return penalty_list(spec, design, spec.changepoint_prior_scale, spec.seasonality_prior_scale)


def penalties(
    spec: Spec,
    design: Sequence[Term],
    changepoint_scale: Column | None = None,
    seasonality_scale: Column | None = None,
) -> Column:
    """The penalties as an array; the two scales may be columns of a grid."""
    c = changepoint_scale if changepoint_scale is not None else F.lit(spec.changepoint_prior_scale)
    s = seasonality_scale if seasonality_scale is not None else F.lit(spec.seasonality_prior_scale)
    listed = penalty_list(spec, design, c, s)
    return F.array(*[v if isinstance(v, Column) else F.lit(v) for v in listed])


def solved(
    spec: Spec,
    changepoint_scale: Column | None = None,
    seasonality_scale: Column | None = None,
) -> Column:
    """``beta`` and ``settled`` of the column ``gram``; the two scales may be columns of a grid."""
    design = terms(spec)
    squared = penalties(spec, design, changepoint_scale, seasonality_scale)
    if spec.changepoint_prior == "normal":
        return F.struct(gram.ridge("gram", squared).alias("beta"), F.lit(True).alias("settled"))
    scale = changepoint_scale if changepoint_scale is not None else F.lit(spec.changepoint_prior_scale)
    knots = [F.lit(spec.noise**2) / scale if d.knot is not None else F.lit(0.0) for d in design]
    return gram.sparse("gram", squared, F.array(F.lit(0.0), *knots))


def scaling(train: DataFrame, ts_col: str, target: str, series_cols: Sequence[str] = ()) -> DataFrame:
    """Start, span (days) and size of the training rows that have a target, one row per series."""
    known = F.when(F.col(target).isNotNull(), _epoch_seconds(ts_col) / SECONDS_PER_DAY)
    span = F.max(known) - F.min(known)
    size = F.max(F.abs(target))
    return train.groupBy(*series_cols).agg(
        F.min(known).alias("_start"),
        F.when(span > 0, span).otherwise(F.lit(1.0)).alias("_span"),
        F.when(size > 0, size).otherwise(F.lit(1.0)).cast("double").alias("_size"),
    )


def _attach(df: DataFrame, small: DataFrame, series_cols: Sequence[str]) -> DataFrame:
    """All rows, with nulls where ``small`` lacks their series."""
    if series_cols:
        return df.join(small, list(series_cols), "left")
    packed = small.select(F.struct("*").alias("m")).scalar()
    return df.withColumn("_m", packed).select(*df.columns, "_m.*")


@dataclass(frozen=True)
class Fitted:
    spec: Spec
    ts_col: str
    target: str
    series_cols: list[str]
    models: DataFrame  # series, _start, _span, _size, gram, beta, settled, sigma

    def terms(self) -> list[Term]:
        return terms(self.spec)

    def attach(self, rows: DataFrame) -> DataFrame:
        """Rows with the model of their series."""
        small = self.models.select(*self.series_cols, "_start", "_span", "_size", "beta", "sigma")
        return with_days(_attach(rows, small, self.series_cols), self.ts_col)


def _grams(
    rows: DataFrame, spec: Spec, ts_col: str, target: str, keys: Sequence[str], scales: DataFrame,
    series_cols: Sequence[str],
) -> DataFrame:
    """Matrices by key; the scaling of the series rides along as part of the key."""
    narrow = rows.select(*dict.fromkeys([*keys, ts_col, target, *spec.regressors]))
    design = terms(spec)
    z = vector(spec, design, target)
    carried = [*keys, "_start", "_span", "_size"]
    placed = with_days(_attach(narrow, scales, series_cols), ts_col)
    return gram.gram(placed, carried, z, len(design) + 2)


@F.pandas_udf(T.DoubleType())
def residual_deviation(grams: pd.Series, betas: pd.Series) -> pd.Series:
    return pd.Series(
        [
            None if b is None else math.sqrt(gram.loss_sum(gram.square(g), np.asarray(b, dtype=float)) / g[0])
            for g, b in zip(grams, betas, strict=True)
        ],
        dtype="float64",
    )


def fit(
    train: DataFrame,
    spec: Spec,
    ts_col: str = "ds",
    target: str = "y",
    series_cols: Sequence[str] = (),
) -> Fitted:
    """One model per series; lazy, and one pass over the rows after the scaling.

    ``settled`` tells whether the coefficients were found; where not, they and all that follows
    from them are null, and the other series are not affected.
    """
    scales = scaling(train, ts_col, target, series_cols)
    grams = _grams(train, spec, ts_col, target, series_cols, scales, series_cols)
    found = grams.withColumn("_found", solved(spec)).select(*grams.columns, "_found.*")
    models = found.withColumn("sigma", residual_deviation("gram", "beta"))
    return Fitted(spec, ts_col, target, list(series_cols), models)


def predict(fitted: Fitted, rows: DataFrame, interval: bool = False) -> DataFrame:
    """``yhat`` for each row (train, test or future), with p10 and p90 if asked.

    Rows of a series without a model, or with a null regressor, have null predictions.
    """
    design = fitted.terms()
    out = fitted.attach(rows).withColumn("yhat", linear(design, range(1, len(design) + 1), True))
    if interval:
        reach = F.col("sigma") * F.col("_size") * Z80
        out = out.withColumns({"p10": F.col("yhat") - reach, "p90": F.col("yhat") + reach})
    extra = ["yhat", "p10", "p90"] if interval else ["yhat"]
    return out.select(*rows.columns, *extra)


def components(fitted: Fitted, rows: DataFrame) -> DataFrame:
    """Long ``(component, value)`` rows per row; the values add up to ``yhat``."""
    design = fitted.terms()
    members: dict[str, list[int]] = {}
    for i, term in enumerate(design, 1):
        members.setdefault(term.component, []).append(i)
    cells = [
        F.struct(F.lit(name).alias("component"), linear(design, chosen, name == "trend").alias("value"))
        for name, chosen in members.items()
    ]
    exploded = fitted.attach(rows).select(*rows.columns, F.explode(F.array(*cells)).alias("c"))
    return exploded.select(*rows.columns, "c.*")


def _cells(fitted: Fitted, chosen: list[tuple[int, Term]], *extra: str) -> DataFrame:
    cells = [
        F.struct(
            F.lit(term.name).alias("name"),
            F.lit(term.knot if term.knot is not None else 0.0).alias("knot"),
            F.col("beta")[i].alias("beta"),
        )
        for i, term in chosen
    ]
    return fitted.models.select(*fitted.series_cols, *extra, F.explode(F.array(*cells)).alias("c"))


def regressor_coefficients(fitted: Fitted) -> DataFrame:
    """``(series, regressor, coefficient)`` in units of the target."""
    chosen = [(i, d) for i, d in enumerate(fitted.terms(), 1) if d.component == "regressors"]
    return _cells(fitted, chosen, "_size").select(
        *fitted.series_cols,
        F.col("c.name").alias("regressor"),
        (F.col("c.beta") * F.col("_size")).alias("coefficient"),
    )


def changepoints(fitted: Fitted, moved_only: bool = False) -> DataFrame:
    """``(series, changepoint, at, slope_change)``: change of slope in target units per day.

    ``moved_only`` leaves out those that are exactly zero, which a Laplace prior makes most of them.
    """
    chosen = [(i, d) for i, d in enumerate(fitted.terms(), 1) if d.knot is not None]
    at = F.timestamp_add(
        "SECOND",
        F.round((F.col("_start") + F.col("c.knot") * F.col("_span")) * SECONDS_PER_DAY).cast("bigint"),
        F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
    )
    cells = _cells(fitted, chosen, "_start", "_span", "_size")
    if moved_only:
        cells = cells.filter(F.col("c.beta") != 0)
    return cells.select(
        *fitted.series_cols,
        F.col("c.name").alias("changepoint"),
        at.alias("at"),
        (F.col("c.beta") * F.col("_size") / F.col("_span")).alias("slope_change"),
    )


def grid_search(
    rows: DataFrame,
    is_test: str,
    spec: Spec,
    grid: dict[str, Sequence[float]],
    ts_col: str = "ds",
    target: str = "y",
    series_cols: Sequence[str] = (),
) -> DataFrame:
    """Test MSE of every setting of the two prior scales, ranked per series.

    ``is_test`` names the rows that score: the test rows reproduce tuning on the test
    period; flag a validation part of train instead to keep the test period unseen.
    The rows are read once: a setting only changes the penalties, and the score of its
    coefficients follows from the matrix of the scoring rows.
    """
    from ..operators import joins

    train = rows.filter(~F.col(is_test))
    scales = scaling(train, ts_col, target, series_cols)
    both = _grams(rows, spec, ts_col, target, [*series_cols, is_test], scales, series_cols)
    both = blocks.settle(both)
    fitting = both.filter(~F.col(is_test)).select(*series_cols, "_size", "gram")
    scoring = both.filter(F.col(is_test)).select(*series_cols, F.col("gram").alias("test_gram"))
    settings = joins.parameter_grid(_attach(fitting, scoring, series_cols), grid)
    scales_of = (F.col(c) if c in grid else None for c in ("changepoint_prior_scale", "seasonality_prior_scale"))
    scored = settings.withColumn("beta", solved(spec, *scales_of)["beta"]).select(
        *series_cols,
        *grid,
        (gram.mean_loss("test_gram", "beta") * F.col("_size") * F.col("_size")).alias("mse"),
    )
    # As many rows per series as there are settings.
    order = Window.partitionBy(*(series_cols or [F.lit(0)])).orderBy(F.asc_nulls_last("mse"), *grid)
    return scored.withColumn("rank", F.row_number().over(order).cast("bigint"))


def rolling_grid_search(
    rows: DataFrame,
    origins: Sequence,
    spec: Spec,
    grid: dict[str, Sequence[float]],
    ts_col: str = "ds",
    target: str = "y",
    series_cols: Sequence[str] = (),
) -> DataFrame:
    """MSE of every setting over several forecast origins, ranked per series; the test period stays unseen.

    At each origin (a time) the model is fitted on all earlier rows and scored on the rows up to
    the next origin, the last origin only closing the range: rows from it on are not read.
    Rows are read once: they are summed into a matrix for each stretch between origins, the
    matrix to fit at an origin is the sum of those before, and the settings only change
    penalties. Scaling and knots come from the rows before the first origin.
    ``mse`` is over all scored rows, ``folds`` how many origins could be scored; a series
    without a row before the first origin, or without a scored row, has no result.
    """
    from ..operators import joins

    at = [F.lit(o).cast("timestamp_ntz") for o in sorted(origins)]
    clock = utc_clock(ts_col)
    fold = sum(((clock >= o).cast("int") for o in at), F.lit(0))
    rows = rows.filter(clock < at[-1])
    keys = list(series_cols)
    scales = scaling(rows.filter(clock < at[0]), ts_col, target, keys)
    # A stretch of a series without usable rows has no matrix and scores nothing.
    pieces = blocks.settle(_grams(rows.withColumn("_fold", fold), spec, ts_col, target, [*keys, "_fold"], scales, keys))
    fitting = gram.prefix_grams(pieces.select(*keys, "_fold", "gram"), keys, "_fold")
    scoring = pieces.filter(F.col("_fold") > 0).select(*keys, "_fold", "_size", F.col("gram").alias("test_gram"))
    settings = joins.parameter_grid(scoring.join(fitting, [*keys, "_fold"]), grid)
    scales_of = (F.col(c) if c in grid else None for c in ("changepoint_prior_scale", "seasonality_prior_scale"))
    loss = gram.mean_loss("test_gram", "beta") * F.col("_size") * F.col("_size")
    n = F.col("test_gram")[0]
    scored = settings.withColumn("beta", solved(spec, *scales_of)["beta"]).withColumns({"_loss": loss * n, "_n": n})
    found = scored.groupBy(*keys, *grid).agg((F.sum("_loss") / F.sum("_n")).alias("mse"), F.count("_loss").alias("folds"))
    order = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(F.asc_nulls_last("mse"), *grid)  # as many rows per series as settings
    return found.withColumn("rank", F.row_number().over(order).cast("bigint"))


def with_regressors(spec: Spec, names: Sequence[str]) -> Spec:
    return replace(spec, regressors=tuple(sorted(names)))
