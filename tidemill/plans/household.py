"""The whole way from raw wide tables to feature tables and forecasts.

Tables that several later steps read (the trimmed readings, the merged tables, the
encoded table of an experiment) are settled in the shared checkpoint folder, so that a
long chain reads its source a fixed number of times.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar, scalar
from ..models import additive, evaluate, lagged, walkforward
from ..operators import blocks, columns, encode, joins, quality, resample, scale
from ..sources import sinks, tables


@dataclass(frozen=True)
class Site:
    """What is fixed about one building and its place."""

    site_prefix: str = "DE_KN_"
    building: str = "residential4"
    country: str = "DE"
    ts_col: str = "utc_timestamp"
    local_time: str = "cet_cest_timestamp"
    latitude: float = 47.66
    longitude: float = 9.18
    target_source: str = "grid_import"
    dropped: tuple[str, ...] = ("refrigerator",)
    series_cols: tuple[str, ...] = ()
    layout: dict = field(default_factory=dict)


def building_readings(household: DataFrame, site: Site) -> DataFrame:
    """The building's meters under short names, from the first to the last complete row."""
    short = columns.remove_from_names(household, site.site_prefix).drop(site.local_time)
    keys = [*site.series_cols, site.ts_col]
    mine = columns.select_matching(short, f"^{site.building}_", keys)
    named = columns.remove_from_names(mine, f"{site.building}_")
    meters = [c for c in named.columns if c not in keys]
    return blocks.settle(quality.trim_to_complete(named, meters, site.ts_col, site.series_cols))


def interpolated_features(household: DataFrame, site: Site) -> DataFrame:
    """``(date, feature)`` for every reading of the building the source marks as interpolated."""
    word = F.explode(scalar.words(scalar.remove_text("interpolated", site.site_prefix)))
    marked = household.filter(scalar.contains_ignoring_case("interpolated", site.building))
    words = marked.select(F.col(site.ts_col).alias("date"), word.alias("feature"))
    mine = words.filter(scalar.contains_ignoring_case("feature", site.building))
    named = mine.withColumn("feature", scalar.remove_text("feature", f"{site.building}_"))
    return named.filter(scalar.is_filled("feature"))


def country_weather(weather: DataFrame, site: Site) -> DataFrame:
    mine = columns.select_matching(weather, f"^{site.country}_", [site.ts_col])
    return columns.remove_from_names(mine, f"{site.country}_")


def country_grid(grid: DataFrame, site: Site) -> DataFrame:
    """Grid series of the country without the neighbour zone and the wind columns."""
    mine = columns.select_matching(grid, f"^{site.country}_", [site.ts_col])
    return columns.drop_prefix_or_word(columns.remove_from_names(mine, f"{site.country}_"), "LU", "wind")


def merged(readings: DataFrame, weather: DataFrame, site: Site, daily: bool) -> DataFrame:
    """Per-step use joined with the weather, hourly or daily."""
    keys = [*site.series_cols, site.ts_col]
    meters = [c for c in readings.columns if c not in keys]
    if daily:
        used = resample.daily_use(readings, site.ts_col, meters, site.series_cols, **site.layout)
        facts = [c for c in weather.columns if c != site.ts_col]
        weather = resample.resample_mean(weather, site.ts_col, facts, **site.layout)
    else:
        used = resample.per_step(readings, site.ts_col, meters, site.series_cols, **site.layout)
    return blocks.settle(joins.left_join_on_time(used, weather, site.ts_col).drop(*site.dropped))


def features(table: DataFrame, site: Site, holidays: DataFrame, daily: bool) -> DataFrame:
    """Target first, then measures, then calendar features (daylight and time of day hourly)."""
    keys = [*site.series_cols, site.ts_col]
    target = columns.with_target(table, site.target_source).drop(site.target_source)
    flagged = joins.holiday_or_weekend(target, site.ts_col, holidays)
    if not daily:
        place = F.lit(site.latitude), F.lit(site.longitude)
        flagged = flagged.withColumns(
            {
                "daylight_flag": calendar.daylight_flag(site.ts_col, *place),
                "time_of_day": calendar.time_of_day(site.ts_col),
            }
        )
    named = flagged.withColumn("season", calendar.season(site.ts_col))
    return columns.target_first(named, "energy_demand", keys)


def write_feature_tables(hourly: DataFrame, daily: DataFrame, path: str, is_test: dict[str, Column]) -> dict[str, str]:
    """Both resolutions with train and test as partition directories, each in the place of an earlier one."""
    written = {}
    for name, df in {"hourly": hourly, "daily": daily}.items():
        split = F.when(is_test[name], "test").otherwise("train")
        written[name] = sinks.write_staged(df.withColumn("split", split), f"{path}/{name}", partition_by=["split"])
    return written


def additive_experiment(
    table: DataFrame,
    is_test: Column,
    site: Site,
    spec: additive.Spec,
    resolution: str = "daily",
    arch: str = "additive",
    configured_name: str | None = None,
    target_scaling: str = "absmax",
) -> dict[str, DataFrame]:
    """Encode, walk forward one step at a time, and return predictions, metrics and served rows.

    The model sees the target over its largest training size (``absmax``), or from 0 to 1 by the
    training rows' limits (``minmax``), which holds back its parts by the range instead.
    Results are in the target's units either way.
    """
    if target_scaling not in ("absmax", "minmax"):
        raise ValueError(f"target_scaling is absmax or minmax, not {target_scaling!r}")
    keys = list(site.series_cols)
    flagged = blocks.settle(table.withColumn("is_test", is_test))
    encoder = encode.fit_one_hot(flagged.filter(~F.col("is_test")), encode.CATEGORICAL[resolution])
    encoded = encode.encode_for_additive(flagged, encoder, site.ts_col, "energy_demand", keys, ["is_test"])
    known = columns.regressor_names(encoded.columns, ("ds", "y", "is_test", *keys))
    scaler = None
    if target_scaling == "minmax":
        scaler = scale.fit_min_max(encoded.filter(~F.col("is_test")), ["y"], keys)
        encoded = scaler.apply(encoded)
    folds = walkforward.walk_forward(
        encoded, "is_test", additive.with_regressors(spec, known), series_cols=keys, **site.layout
    )
    if scaler is not None:
        folds = scaler.stretch(scaler.invert(folds, "y", ["actual", "yhat"]), "y", {"sigma": 1})
    name = tables.run_name(
        F.lit(configured_name),
        tables.additive_run_name(
            F.lit(arch), F.lit(spec.changepoint_prior_scale), F.lit(spec.seasonality_prior_scale)
        ),
    )
    return _results(folds, "ds", "actual", "yhat", name, keys) | {
        "served": walkforward.served(folds, series_cols=keys)
    }


def lag_experiment(
    table: DataFrame,
    is_test: Column,
    site: Site,
    lag_list: Sequence[int],
    resolution: str = "daily",
    contemporaneous: bool = False,
    arch: str = "lagged",
    rate: float = 1.0,
    epochs: int = 50,
) -> dict[str, DataFrame]:
    """Encode, add lags of the target, scale, fit, and return predictions, metrics and history.

    ``contemporaneous`` also feeds every other meter's reading at the predicted time, which
    a real forecast does not have.
    """
    keys = list(site.series_cols)
    flagged = blocks.settle(table.withColumn("is_test", is_test))
    encoder = encode.fit_one_hot(flagged.filter(~F.col("is_test")), encode.CATEGORICAL[resolution])
    encoded = encoder.apply(flagged)
    fixed = {*keys, site.ts_col, "is_test", "energy_demand"}
    chosen = [c for c in encoded.columns if c not in fixed] if contemporaneous else encoder.names
    prepared = lagged.prepare_lags(
        encoded, site.ts_col, "energy_demand", lag_list, "is_test", chosen, keys, across_split=False, **site.layout
    )
    found = lagged.predict(prepared, lagged.fit(prepared))
    name = tables.lag_run_name(F.lit(arch), F.lit(rate), F.array(*[F.lit(k) for k in lag_list]))
    history = lagged.training_history(prepared, epochs, rate)
    steps = tables.metric_rows(history, name, F.col("step"), {m: m for m in tables.METRIC_NAMES}, keys)
    return _results(found, site.ts_col, "actual", "predicted", name, keys) | {"history": steps}


def sequence_experiment(
    table: DataFrame,
    is_test: Column,
    site: Site,
    steps: int = 2,
    resolution: str = "daily",
    arch: str = "sequence",
    rate: float = 1.0,
    epochs: int = 50,
    batches: int = 16,
    seed: int = 0,
    configured_name: str | None = None,
) -> dict[str, DataFrame]:
    """Encode, scale, cut windows, train in rounds of batches, and return predictions, metrics, history and models.

    A row is predicted from the ``steps`` rows before it, with all their columns, and from its own
    calendar columns, which are known ahead; test windows reach back into the training rows only where
    those come just before. The history is that of the model that predicts: its last step has
    the errors that ``metrics`` has, in the units of the target.
    """
    keys = list(site.series_cols)
    flagged = blocks.settle(table.withColumn("is_test", is_test))
    encoder = encode.fit_one_hot(flagged.filter(~F.col("is_test")), encode.CATEGORICAL[resolution])
    encoded = encoder.apply(flagged)
    fixed = {*keys, site.ts_col, "is_test", "energy_demand", *encoder.names}
    past = ["energy_demand", *[c for c in encoded.columns if c not in fixed], *encoder.names]
    prepared = lagged.prepare_sequences(
        encoded, site.ts_col, "energy_demand", past, encoder.names, steps, "is_test", keys, **site.layout
    )
    models = lagged.fit_rounds(prepared, batches, epochs, rate, seed)
    found = blocks.settle(lagged.predict(prepared, models))
    generated = tables.lag_run_name(F.lit(arch), F.lit(rate), F.sequence(F.lit(1), F.lit(steps)))
    name = tables.run_name(F.lit(configured_name), generated)
    logged = lagged.history(prepared, models, real_units=True)
    rows = tables.metric_rows(logged, name, F.col("step"), {m: m for m in tables.METRIC_NAMES}, keys)
    return _results(found, site.ts_col, "actual", "predicted", name, keys) | {"history": rows, "models": models}


def _results(
    found: DataFrame, ts_col: str, actual: str, predicted: str, name: Column, keys: list[str]
) -> dict[str, DataFrame]:
    scores = evaluate.evaluation(found, actual, predicted, keys)
    names = {"mse": "val/mse", "rmse": "val/rmse", "mae": "val/mae"}
    return {
        "predictions": tables.prediction_table(found, ts_col, actual, predicted, keys),
        "metrics": tables.metric_rows(scores, name, F.lit(0), names, keys),
    }
