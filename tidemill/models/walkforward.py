"""Walk-forward evaluation: before each test row, refit on everything earlier, predict one step.

The coefficients of every refit are a function of the sums of products of the rows before
it, so the rows are cut into blocks, each block gets the summed matrix of the blocks
before it, and adds its own rows one by one. Each test row is predicted by the exact fit on
the rows before it, whose inverse follows every row by a rank-one update (:class:`gram.Growing`):
O(p^2) a row instead of a solve. No row is copied to other folds, and blocks run in parallel.
Scaling and knots are set by the training rows; as the window grows past them, further
knots at the same spacing become active once they lie in the leading part of it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import blocks
from . import additive, gram

FOLD_BLOCK = 5_000


def walk_forward(
    rows: DataFrame,
    is_test: str,
    spec: additive.Spec,
    ts_col: str = "ds",
    target: str = "y",
    series_cols: Sequence[str] = (),
    horizon: float = 1.0,
    block_rows: int = FOLD_BLOCK,
    **layout,
) -> DataFrame:
    """``(series, ts, actual, yhat, sigma, n_train, beta)`` per test row.

    ``horizon`` is how far the rows reach, in training spans, where knots are to be added;
    1 keeps the training knots only. Rows without a target are predicted but not learned.
    Every test row comes out; ``yhat``, ``sigma`` and ``beta`` are null where it can't be
    predicted (a null regressor, or nothing before it to learn from). Slope changes have the
    normal prior, as refits by rank-one updates need a closed form.
    """
    if spec.changepoint_prior != "normal":
        raise ValueError("walk_forward refits in closed form: changepoint_prior must be normal")
    keys = list(series_cols)
    scales = additive.scaling(rows.filter(~F.col(is_test)), ts_col, target, keys)
    design = additive.terms(spec, horizon)
    narrow = rows.select(*dict.fromkeys([*keys, ts_col, is_test, target, *spec.regressors]))
    placed = blocks.with_position(narrow, keys, ts_col, "_position", **layout).withColumn(
        "_block", F.floor((F.col("_position") - 1) / block_rows)
    )
    # Read twice below, for the block sums and for the folds.
    scaled = blocks.settle(additive.with_days(additive._attach(placed, scales, keys), ts_col))
    width = len(design) + 2
    # A row without a target adds nothing, but keeps its block in the chain of sums.
    nothing = F.array_repeat(F.lit(0.0), width)
    z = F.coalesce(additive.vector(spec, design, target), nothing)
    block_keys = [*keys, "_block"]
    before = gram.prefix_grams(gram.gram(scaled, block_keys, z, width), keys, "_block")
    vectors = scaled.select(
        *block_keys, ts_col, is_test, "_position", "_size",
        additive.features(design).alias("x"), F.col(target).cast("double").alias("actual"),
    )
    knots = [(i, d.knot) for i, d in enumerate(design, 1) if d.knot is not None]
    fixed = [i for i, d in enumerate(design, 1) if d.knot is None]
    base = spec.changepoints
    share = spec.changepoint_range
    columns = [*keys, ts_col]

    penalty = np.array(additive.penalty_numbers(spec, design))
    names = [*columns, "actual", "yhat", "sigma", "n_train", "beta"]

    def live_columns(at: float) -> list[int]:
        """Knots of the training fit, and later ones inside the leading share of the window."""
        active = [i for n, (i, knot) in enumerate(knots) if n < base or knot <= share * at]
        return sorted([0, *fixed, *active])

    def folds(part: pd.DataFrame, carried: pd.DataFrame) -> pd.DataFrame:
        if part.empty:
            return pd.DataFrame(columns=names)
        part = part.sort_values("_position")
        total = gram.square(carried["gram"].iloc[0])
        size = float(part["_size"].fillna(np.nan).iloc[0])  # NaN: no training row has a target
        x = np.array(part["x"].tolist(), dtype=float)
        actual = part["actual"].to_numpy(dtype=float, na_value=np.nan)
        y = actual / size
        usable = ~np.isnan(x).any(axis=1)
        out = []
        tested = part[is_test].to_numpy(dtype=bool)
        keys_of = part[columns].itertuples(index=False, name=None)
        live = live_columns(float(x[0, 1]))
        model = gram.Growing(total, penalty, live)
        for i, key in enumerate(keys_of):
            n_train = int(model.total[0, 0])
            if tested[i] and not (usable[i] and n_train > 0):
                out.append((*key, actual[i], None, None, n_train, None))
            elif tested[i]:
                if live != (wanted := live_columns(float(x[i, 1]))):
                    live = wanted
                    model.choose(live)
                beta = model.beta()
                sigma = np.sqrt(gram.loss_sum(model.total, beta) / n_train)
                row = (actual[i], float(beta @ x[i]) * size, sigma * size, n_train, beta.tolist())
                out.append((*key, *row))
            if usable[i] and not np.isnan(y[i]):
                model.learn(np.append(x[i], y[i]))
        found = pd.DataFrame(out, columns=names)
        for c in ("actual", "yhat", "sigma"):
            found[c] = found[c].astype(object).where(found[c].notna(), None)
        return found

    schema = ", ".join(
        [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns]
        + ["actual double, yhat double, sigma double, n_train bigint, beta array<double>"]
    )
    # Blocks without a test row have nothing to predict and are not sent. The window has
    # the partitioning of the groups, so it costs no shuffle.
    block = Window.partitionBy(*block_keys)
    tested = vectors.withColumn("_tested", F.max(is_test).over(block)).filter("_tested").drop("_tested")
    # Fresh names keep the two sides, which come from the same rows, apart.
    carried_keys = [F.col(k).alias(f"_carried_{k}") for k in block_keys]
    carried = before.select(*carried_keys, "gram")
    return (
        tested.groupBy(*block_keys)
        .cogroup(carried.groupBy(*[f"_carried_{k}" for k in block_keys]))
        .applyInPandas(folds, schema)
    )


def expanding_mean(
    df: DataFrame, ts_col: str, target: str, series_cols: Sequence[str] = (), order_cols: Sequence[str] = (), **layout
) -> DataFrame:
    """The simplest expanding-window forecaster: the mean of all earlier values."""
    counted = df.withColumns(
        {"_one": F.col(target).isNotNull().cast("bigint"), "_value": F.col(target).cast("double")}
    )
    summed = blocks.running_sum(
        counted, series_cols, ts_col, {"_n": "_one", "_total": "_value"}, order_cols, **layout
    )
    n_train = F.col("_n") - F.col("_one")
    total = F.coalesce(F.col("_total"), F.lit(0.0)) - F.coalesce(F.col("_value"), F.lit(0.0))
    return summed.select(
        *df.columns, n_train.alias("n_train"), F.try_divide(total, n_train.cast("double")).alias("predicted")
    )


def stitched(
    rows: DataFrame,
    folds: DataFrame,
    is_test: str,
    spec: additive.Spec,
    ts_col: str = "ds",
    target: str = "y",
    series_cols: Sequence[str] = (),
    horizon: float = 1.0,
) -> DataFrame:
    """In-sample values of the last refit over train, followed by the one-step predictions."""
    keys = list(series_cols)
    folds = blocks.settle(folds)
    train = rows.filter(~F.col(is_test))
    last = folds.groupBy(*keys).agg(F.max_by("beta", ts_col).alias("beta"))
    scales = additive.scaling(train, ts_col, target, keys)
    fitted = additive.with_days(additive._attach(additive._attach(train, scales, keys), last, keys), ts_col)
    design = additive.terms(spec, horizon)
    yhat = additive.linear(design, range(1, len(design) + 1), True)
    inside = fitted.select(*keys, ts_col, F.col(target).alias("actual"), yhat.alias("yhat"), F.lit("train").alias("part"))
    outside = folds.select(*keys, ts_col, "actual", "yhat", F.lit("test").alias("part"))
    return inside.unionByName(outside)


def served(folds: DataFrame, ts_col: str = "ds", series_cols: Sequence[str] = ()) -> DataFrame:
    """``(series, datetime, actual, prediction, p10, p90)``: normal 80% interval."""
    reach = F.col("sigma") * additive.Z80
    return folds.select(
        *series_cols,
        F.col(ts_col).alias("datetime"),
        "actual",
        F.col("yhat").alias("prediction"),
        (F.col("yhat") - reach).alias("p10"),
        (F.col("yhat") + reach).alias("p90"),
    )
