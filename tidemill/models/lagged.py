"""One-step-ahead regressions on lags, per series or pooled over series."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import blocks, lags, scale
from . import gram


@dataclass(frozen=True)
class Prepared:
    """Scaled rows ready for a linear fit, with what is needed to undo the scaling."""

    rows: DataFrame
    features: list[str]
    target: str
    is_test: str
    ts_col: str
    series_cols: list[str]
    scaler: scale.MinMax

    def vectors(self) -> tuple[Column, int]:
        z = gram.row_vector([F.col(c) for c in self.features], F.col(self.target))
        return z, len(self.features) + 2

    def train(self) -> DataFrame:
        return self.rows.filter(~F.col(self.is_test))

    def grams(self, part: DataFrame) -> DataFrame:
        z, width = self.vectors()
        return gram.gram(part, self.series_cols, z, width)

    def grams_by_split(self) -> DataFrame:
        z, width = self.vectors()
        return gram.gram(self.rows, [*self.series_cols, self.is_test], z, width)

    def unscale(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        return self.scaler.invert(df, self.target, columns)


def prepare_lags(
    df: DataFrame,
    ts_col: str,
    target: str,
    lag_list: Sequence[int],
    is_test: str,
    features: Sequence[str] = (),
    series_cols: Sequence[str] = (),
    across_split: bool = True,
    **layout,
) -> Prepared:
    """Lags of the target plus the given columns of the row itself, min-max scaled.

    ``features`` read at the predicted time are only honest when they are known ahead
    (calendar columns). ``across_split=False`` computes the lags of train and test apart,
    so each test period loses its first rows.
    """
    keys = [*series_cols, ts_col]
    narrow = df.select(*keys, is_test, target, *features)
    within = [*series_cols] if across_split else [*series_cols, is_test]
    # Read by the scaling, the fit, the prediction and the history.
    lagged = blocks.settle(lags.lag_features(narrow, ts_col, target, lag_list, within, **layout))
    names = [*features, *[f"lag_{k}" for k in lag_list]]
    scaler = scale.fit_min_max(lagged.filter(~F.col(is_test)), [target, *names], series_cols)
    return Prepared(
        scaler.apply(lagged), names, target, is_test, ts_col, list(series_cols), scaler
    )


def prepare_sequences(
    df: DataFrame,
    ts_col: str,
    target: str,
    past: Sequence[str],
    future: Sequence[str],
    k: int,
    is_test: str,
    series_cols: Sequence[str] = (),
    **layout,
) -> Prepared:
    """The k past rows of ``past`` flattened, plus the ``future`` columns of the row itself.

    Scaled before the windows are cut, with limits from the training rows.
    """
    narrow = blocks.settle(df.select(*dict.fromkeys([*series_cols, ts_col, is_test, target, *past, *future])))
    columns = list(dict.fromkeys([target, *past, *future]))
    scaler = scale.fit_min_max(narrow.filter(~F.col(is_test)), columns, series_cols)
    samples = lags.sequences(
        scaler.apply(narrow), ts_col, target, past, future, k, series_cols, [is_test], **layout
    )
    named = {
        f"{c}_back_{k - step}": F.col("past")[step][i] for step in range(k) for i, c in enumerate(past)
    }
    known = {f"{c}_now": F.col("future")[i] for i, c in enumerate(future)}
    rows = blocks.settle(
        samples.select(
            *series_cols,
            ts_col,
            is_test,
            F.col("label").alias(target),
            *[c.alias(n) for n, c in {**named, **known}.items()],
        )
    )
    return Prepared(
        rows, [*named, *known], target, is_test, ts_col, list(series_cols), scaler
    )


def fit(prepared: Prepared, penalty: float = 1e-6) -> DataFrame:
    """``(series, gram, beta)`` by ridge on the training rows; the intercept is free."""
    penalties = F.array(F.lit(0.0), *[F.lit(float(penalty)) for _ in prepared.features])
    return prepared.grams(prepared.train()).withColumn("beta", gram.ridge("gram", penalties))


def fit_elastic(prepared: Prepared, l1: float, l2: float) -> DataFrame:
    return prepared.grams(prepared.train()).withColumn("beta", gram.elastic_net(l1, l2)("gram"))


def predict(prepared: Prepared, models: DataFrame, test_only: bool = True) -> DataFrame:
    """``(series, ts, actual, predicted)`` in the units of the target.

    Rows of a series without a model have null predictions.
    """
    rows = prepared.rows.filter(F.col(prepared.is_test)) if test_only else prepared.rows
    fitted = _with_model(rows, models.select(*prepared.series_cols, "beta"), prepared.series_cols)
    scored = fitted.select(
        *prepared.series_cols,
        prepared.ts_col,
        F.col(prepared.target).alias("actual"),
        gram.dot(F.col("beta"), [F.col(c) for c in prepared.features]).alias("predicted"),
    )
    return prepared.unscale(scored, ["actual", "predicted"])


def _with_model(rows: DataFrame, models: DataFrame, series_cols: Sequence[str]) -> DataFrame:
    """Attach the small per-series model table; one model alone is a scalar subquery."""
    if series_cols:
        return rows.join(models, list(series_cols), "left")
    packed = models.select(F.struct("*").alias("m")).scalar()
    return rows.withColumn("_model", packed).select("*", "_model.*").drop("_model")


def coefficients(prepared: Prepared, models: DataFrame) -> DataFrame:
    """``(series, feature, coefficient)`` in the scaled units."""
    cells = [
        F.struct(F.lit(name).alias("feature"), F.col("beta")[i].alias("coefficient"))
        for i, name in enumerate(["intercept", *prepared.features])
    ]
    return models.select(*prepared.series_cols, F.explode(F.array(*cells)).alias("c")).select(
        *prepared.series_cols, "c.*"
    )


def importance(prepared: Prepared, models: DataFrame) -> DataFrame:
    """Share of each feature in the sum of absolute standardised coefficients.

    The deviations come from the same matrix as the fit: cell (0, j) is the sum of
    feature j and cell (j, j) its sum of squares.
    """
    width = len(prepared.features) + 2

    def cell(i: int, j: int) -> Column:
        return F.col("gram")[i * width - i * (i - 1) // 2 + (j - i)]

    n = cell(0, 0)
    weights = [
        F.abs(F.col("beta")[j]) * F.sqrt(F.greatest(cell(j, j) / n - F.pow(cell(0, j) / n, F.lit(2.0)), F.lit(0.0)))
        for j in range(1, width - 1)
    ]
    rows = models.select(*prepared.series_cols, F.array(*weights).alias("w")).withColumn(
        "total", F.aggregate("w", F.lit(0.0), lambda s, v: s + v)
    )
    cells = [
        F.struct(F.lit(name).alias("feature"), F.try_divide(F.col("w")[i], F.col("total")).alias("importance"))
        for i, name in enumerate(prepared.features)
    ]
    return rows.select(*prepared.series_cols, F.explode(F.array(*cells)).alias("c")).select(
        *prepared.series_cols, "c.*"
    )


def training_history(prepared: Prepared, epochs: int = 50, rate: float = 1.0) -> DataFrame:
    """Losses of a full-batch gradient fit after every epoch; see :func:`history`."""
    return history(prepared, prepared.grams(prepared.train()).withColumn("path", gram.descent(epochs, rate)("gram")))


def fit_rounds(
    prepared: Prepared, batches: int = 16, epochs: int = 50, rate: float = 1.0, seed: int = 0, id_cols: Sequence[str] = ()
) -> DataFrame:
    """``(series, gram, path, beta)`` by gradient steps on batches; ``beta`` is the last epoch's.

    A training row belongs to the batch its time and ``id_cols`` hash to, so a row keeps its batch
    in every run. The order of batches changes with the epoch. Rows are read once: tasks add up
    one matrix per series and batch, and a series' matrices (``batches`` of them) are stepped through together.
    Batches without rows are left out, a series without complete training rows has no model.
    """
    keys = prepared.series_cols
    named = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in (prepared.ts_col, *id_cols)])
    batch = F.pmod(F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("bigint"), F.lit(batches)).cast("int")
    z, width = prepared.vectors()
    parts = gram.gram(prepared.train().withColumn("_batch", batch), [*keys, "_batch"], z, width)
    listed = F.sort_array(F.collect_list(F.struct("_batch", "gram"))).alias("_parts")
    gathered = parts.groupBy(*keys).agg(listed)
    if not keys:
        gathered = gathered.filter(F.size("_parts") > 0)
    cells = F.col("_parts.gram")
    # The matrix of all training rows is the sum of the batches'.
    total = F.aggregate(cells, F.array_repeat(F.lit(0.0), width * (width + 1) // 2), lambda s, g: F.zip_with(s, g, lambda a, b: a + b))
    stepped = gathered.select(
        *keys, total.alias("gram"), gram.rounds(epochs, rate, seed)(F.col("_parts._batch"), cells).alias("path")
    )
    return blocks.settle(stepped.withColumn("beta", F.element_at("path", -1)))


def history(prepared: Prepared, paths: DataFrame, real_units: bool = False) -> DataFrame:
    """``(series, step, train/loss, val/loss, val/mse, val/rmse, val/mae)`` of coefficients after every epoch.

    ``paths`` has the matrix of the training rows as ``gram`` and the coefficients as ``path``.
    Squared losses come from the train and test matrices; the absolute error needs the
    test rows, each of which adds one number per epoch to a running array of sums. ``real_units`` gives the
    ``val/mse``, ``val/rmse`` and ``val/mae`` in units of the target, as evaluations have them; losses stay as
    the fit sees them. A series without test rows has null ``val/`` values.
    """
    keys = prepared.series_cols
    paths = blocks.settle(paths.select(*keys, F.col("gram").alias("train_gram"), "path"))
    tested = prepared.rows.filter(F.col(prepared.is_test))
    test = prepared.grams(tested).select(*keys, F.col("gram").alias("test_gram"))
    joined = paths.join(test, keys, "left") if keys else _with_model(paths, test, [])
    per_epoch = joined.select(*keys, "train_gram", "test_gram", F.posexplode("path").alias("step", "beta"))
    squared = per_epoch.select(
        *keys,
        "step",
        gram.mean_loss("train_gram", "beta").alias("train/loss"),
        gram.mean_loss("test_gram", "beta").alias("val/loss"),
    )
    rows = _with_model(tested, paths.select(*keys, "path"), keys)
    features = [F.col(c) for c in prepared.features]
    each = F.transform("path", lambda beta: F.abs(F.col(prepared.target) - gram.dot(beta, features)))
    epochs = F.col("_errors")
    longest = paths.agg(F.max(F.size("path"))).first()[0] or 0
    sums = [F.avg(F.get(epochs, F.lit(i))).alias(f"_{i}") for i in range(longest)]
    if sums:
        one = rows.select(*keys, each.alias("_errors")).groupBy(*keys).agg(*sums)
        maes = one.select(*keys, F.posexplode(F.array(*[f"_{i}" for i in range(longest)])).alias("step", "val/mae"))
    else:
        maes = squared.select(*keys, "step", F.lit(None).cast("double").alias("val/mae"))
    found = squared.withColumns({"val/mse": F.col("val/loss"), "val/rmse": F.sqrt("val/loss")}).join(
        maes, [*keys, "step"], "left"
    )
    if real_units:
        found = prepared.scaler.stretch(found, prepared.target, {"val/mse": 2, "val/rmse": 1, "val/mae": 1})
    return found.withColumn("step", F.col("step").cast("bigint"))


def predictor(prepared: Prepared, models: DataFrame):
    """A function that adds ``predicted`` to rows like ``prepared.rows``, in their scale."""

    def predict_rows(rows: DataFrame) -> DataFrame:
        fitted = _with_model(rows, models.select(*prepared.series_cols, "beta"), prepared.series_cols)
        found = gram.dot(F.col("beta"), [F.col(c) for c in prepared.features])
        return fitted.select(*rows.columns, found.alias("predicted"))

    return predict_rows


def pooled(prepared: Prepared, estimator: Estimator):
    """Fit any Spark ML regressor on all series together; returns the model and predictions.

    The estimator is the extension point for other model classes; it sees ``features``
    and ``label``.
    """
    assembler = VectorAssembler(inputCols=prepared.features, outputCol="features")
    complete = prepared.rows.dropna("any", subset=[prepared.target, *prepared.features])
    ready = assembler.transform(complete).withColumn("label", F.col(prepared.target))
    model = estimator.fit(ready.filter(~F.col(prepared.is_test)))
    scored = model.transform(ready.filter(F.col(prepared.is_test))).select(
        *prepared.series_cols,
        prepared.ts_col,
        F.col("label").alias("actual"),
        F.col("prediction").alias("predicted"),
    )
    return model, prepared.unscale(scored, ["actual", "predicted"])


def pooled_importance(spark, prepared: Prepared, model) -> DataFrame:
    """Feature importances of a tree model, one row per feature."""
    values = [float(v) for v in model.featureImportances.toArray()]
    return spark.createDataFrame(list(zip(prepared.features, values, strict=True)), "feature string, importance double")


def objective_history(spark, model) -> DataFrame:
    """Objective per iteration of a Spark ML linear fit, as ``train/loss`` rows."""
    values = [(i, "train/loss", float(v)) for i, v in enumerate(model.summary.objectiveHistory)]
    return spark.createDataFrame(values, "step bigint, metric string, value double")
