"""Models given as Python functions, one per series, whatever the series' length.

The library's own fits are sums of products; this is the way for any other model: nonlinear
ones, or a class of the user. A series is cut into blocks of ``block_rows`` consecutive rows,
and no task sees more than a block. The model is a column of bytes (``pickle`` of whatever
the functions return), so it can be written, joined and read like any other value.

* With ``merge`` every block is fitted alone and in parallel, and the blocks' models of a series
  are merged in a tree of ``FAN`` at a time.
* Without it the model of a block continues from that of the block before it (``fit`` receives
  it), one Spark job for each block of the longest series: a chain can't be shorter.

Each round is written to the shared folder, so a lost executor costs a round's part, not the
chain.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blocks
from ..session import drop_settled

BLOCK_ROWS = 100_000
FAN = 16

_BLOCK = "_block"
_STATE = "_state"

Fit = Callable[[pd.DataFrame, Any], Any]
Merge = Callable[[Any, Any], Any]
Predict = Callable[[Any, pd.DataFrame], pd.DataFrame]


def _types(df: DataFrame, names: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names)


def _fitted(keys: list[str], ts_col: str, fit: Fit):
    """A block's rows in time order, and the model so far if there is one, become a model."""

    def run(rows: pd.DataFrame, before: pd.DataFrame | None = None) -> pd.DataFrame:
        state = pickle.loads(before[_STATE].iloc[0]) if before is not None and len(before) else None
        if rows.empty:
            return pd.DataFrame(columns=[*keys, _BLOCK, _STATE])
        found = fit(rows.sort_values("_position").drop(columns=["_position", _BLOCK]).reset_index(drop=True), state)
        head = {c: [rows[c].iloc[0]] for c in [*keys, _BLOCK]}
        return pd.DataFrame({**head, _STATE: [pickle.dumps(found)]})

    return run


def _placed(rows: DataFrame, keys: list[str], ts_col: str, order_cols: Sequence[str], block_rows: int) -> DataFrame:
    placed = blocks.with_position(rows, keys, ts_col, "_position", order_cols)
    return placed.withColumn(_BLOCK, F.floor((F.col("_position") - 1) / block_rows).cast("bigint"))


def fit_series(
    train: DataFrame,
    fit: Fit,
    ts_col: str,
    series_cols: Sequence[str],
    merge: Merge | None = None,
    order_cols: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(series, model)``: the pickled model of each series with a row in ``train``.

    ``fit(rows, state)`` gets rows in time order (ties: ``order_cols``) and returns a model;
    ``state`` is the model of the rows before, or None. ``merge(a, b)`` joins the models of two
    stretches, the earlier first. Series keys and times should not be null.
    """
    keys = list(series_cols)
    placed = blocks.settle(_placed(train, keys, ts_col, order_cols, block_rows))
    schema = f"{_types(placed, keys)}, {_BLOCK} bigint, {_STATE} binary"
    run = _fitted(keys, ts_col, fit)
    last = placed.agg(F.max(_BLOCK)).first()[0] or 0
    if merge is not None:
        states = blocks.settle(placed.groupBy(*keys, _BLOCK).applyInPandas(lambda p: run(p), schema))

        def joined(parts: pd.DataFrame) -> pd.DataFrame:
            parts = parts.sort_values(_BLOCK)
            models = [pickle.loads(x) for x in parts[_STATE]]
            whole = models[0]
            for more in models[1:]:
                whole = merge(whole, more)
            head = {c: [parts[c].iloc[0]] for c in keys}
            return pd.DataFrame({**head, _BLOCK: [parts[_BLOCK].iloc[0] // FAN], _STATE: [pickle.dumps(whole)]})

        while last > 0:
            above = states.withColumn("_up", F.floor(F.col(_BLOCK) / FAN))
            up = blocks.settle(above.groupBy(*keys, "_up").applyInPandas(lambda p: joined(p.drop(columns="_up")), schema))
            drop_settled(states)
            states, last = up, last // FAN
    else:
        states = None
        for block in range(last + 1):
            own = placed.filter(F.col(_BLOCK) == block).groupBy(*keys)
            if states is None:
                states = blocks.settle(own.applyInPandas(lambda p: run(p), schema))
                continue
            # Series that have ended keep their model; the others continue from it.
            fresh_keys = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
            before = states.filter(F.col(_BLOCK) == block - 1).select(*fresh_keys, _STATE).groupBy(*[f"_k{i}" for i in range(len(keys))])
            went_on = own.cogroup(before).applyInPandas(lambda p, q: run(p, q), schema)
            ended = states.join(placed.filter(F.col(_BLOCK) == block).select(*keys).distinct(), keys, "left_anti")
            further = blocks.settle(went_on.unionByName(ended))
            drop_settled(states)
            states = further
    drop_settled(placed)
    return states.select(*keys, F.col(_STATE).alias("model"))


def predict_series(
    models: DataFrame,
    rows: DataFrame,
    predict: Predict,
    schema: str,
    ts_col: str,
    series_cols: Sequence[str],
    order_cols: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``schema`` for each block of ``rows``: what ``predict(model, rows)`` returns, series keys included.

    Rows of a series without a model are given to ``predict`` with None.
    """
    keys = list(series_cols)
    placed = blocks.settle(_placed(rows, keys, ts_col, order_cols, block_rows))
    there = placed.select(*keys, _BLOCK).distinct()
    fresh = [F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, _BLOCK])]
    carried = there.join(models, keys, "left").select(*fresh, "model")

    def run(part: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        packed = model["model"].iloc[0] if len(model) else None
        part = part.sort_values("_position").drop(columns=["_position", _BLOCK]).reset_index(drop=True)
        return predict(pickle.loads(packed) if packed is not None else None, part)

    right = carried.groupBy(*[f"_k{i}" for i in range(len(keys) + 1)])
    return placed.groupBy(*keys, _BLOCK).cogroup(right).applyInPandas(run, schema)


def per_series(
    rows: DataFrame,
    is_test: str,
    fit: Fit,
    predict: Predict,
    schema: str,
    ts_col: str,
    series_cols: Sequence[str],
    merge: Merge | None = None,
    order_cols: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Fit every series on its training rows and predict its test rows."""
    models = fit_series(rows.filter(~F.col(is_test)), fit, ts_col, series_cols, merge, order_cols, block_rows)
    test = rows.filter(F.col(is_test))
    return predict_series(models, test, predict, schema, ts_col, series_cols, order_cols, block_rows)
