"""Reading and writing time-series tables, predictions and metric logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar

# The metric names every run logs.
METRIC_NAMES = ["train/loss", "val/loss", "val/mse", "val/rmse", "val/mae"]


def read_timeseries(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    ts_col: str,
    types: dict[str, str] | None = None,
) -> DataFrame:
    """CSV with a header and a UTC time column; other columns are doubles unless typed.

    The schema is explicit: no inference pass over the files, and a column that is empty
    in some file keeps its type.
    """
    raw = spark.read.schema(_schema(columns, ts_col, types or {})).option("header", True).csv(path)
    return raw.withColumn(ts_col, scalar.parse_timestamp(ts_col))


def _schema(columns: Sequence[str], ts_col: str, types: dict[str, str]) -> T.StructType:
    kinds = {c: T.StringType() if c == ts_col else _field_type(types.get(c, "double")) for c in columns}
    return T.StructType([T.StructField(c, kind) for c, kind in kinds.items()])


def read_checked(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    ts_col: str,
    types: dict[str, str] | None = None,
    header: bool = True,
) -> DataFrame:
    """As :func:`read_timeseries`, with every line of the files and what is wrong with it.

    ``problem`` is null for a good line, ``record`` where fields are missing, too many or not of
    their type, and ``time`` where the time is empty or can't be read; ``rejected`` then holds the
    line, or the time, and all else is null. An empty field is a missing value, not a problem.
    A line is judged as a whole, whichever columns are asked for. A time without an offset is
    taken in the session's zone.
    """
    # Read as text and cast here: the reader checks the types of only those columns a query uses.
    types = types or {}
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, "_line")])
    options = {"header": header, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line", "columnPruning": False}
    raw = spark.read.schema(schema).options(**options).csv(path)
    typed = {c: F.col(c).try_cast("timestamp" if c == ts_col else _field_type(types.get(c, "double"))) for c in columns}
    wrong = F.lit(False)
    for c in columns:
        wrong = wrong | (F.col(c).isNotNull() & typed[c].isNull() if c != ts_col else F.lit(False))
    problem = F.when(F.col("_line").isNotNull() | wrong, "record").when(typed[ts_col].isNull(), "time")
    rejected = F.when(wrong, F.to_csv(F.struct(*columns))).otherwise(F.coalesce(ts_col, F.lit("")))
    rejected = F.when(problem.isNotNull(), F.coalesce("_line", rejected))
    good = F.col("problem").isNull()
    checked = raw.withColumns({"problem": problem, "rejected": rejected})
    typed[ts_col] = scalar.without_zone(typed[ts_col])
    return checked.select(*(F.when(good, typed[c]).alias(c) for c in columns), "problem", "rejected")


def load_checked(checked: DataFrame, quarantine: str, mode: str = "append") -> DataFrame:
    """The good rows of :func:`read_checked`; the others are written to ``quarantine`` by problem.

    Rows in are rows out and rows written; an input without problems writes no file.
    """
    bad = checked.where("problem IS NOT NULL").select("rejected", F.input_file_name().alias("file"), "problem")
    write_table(bad, quarantine, partition_by=["problem"], mode=mode)
    return checked.where("problem IS NULL").drop("problem", "rejected")


def _field_type(name: str) -> T.DataType:
    known = {
        "double": T.DoubleType(),
        "string": T.StringType(),
        "boolean": T.BooleanType(),
        "bigint": T.LongType(),
        "int": T.IntegerType(),
    }
    return known[name]


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column as text, for casting by name afterwards."""
    return spark.read.option("header", True).csv(path)


def cast_time(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, scalar.parse_timestamp(column))


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "errorifexists"
) -> str:
    """Write Parquet (or CSV for interchange), creating the directory."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_splits(df: DataFrame, path: str, is_test: Column, fmt: str = "parquet") -> str:
    """Full, train and test in one write: the split is a partition directory, so reading
    train or test alone prunes the other, and reading the root gives the full table."""
    labelled = df.withColumn("split", F.when(is_test, "test").otherwise("train"))
    return write_table(labelled, path, fmt, ["split"])


def read_back(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """Re-read a written table and check its column names and types."""
    found = spark.read.parquet(path)
    if dict(found.dtypes) != dict(expected.dtypes):
        raise ValueError(f"{path}: {found.dtypes} differs from {expected.dtypes}")
    return found.select(*expected.columns)


def prediction_table(
    df: DataFrame, ts_col: str, actual: str, predicted: str, series_cols: Sequence[str] = ()
) -> DataFrame:
    """``(date, actual_kWh, predicted_kWh, error)`` plus the series keys."""
    return df.select(
        *series_cols,
        F.col(ts_col).alias("date"),
        F.col(actual).alias("actual_kWh"),
        F.col(predicted).alias("predicted_kWh"),
        scalar.residual(actual, predicted).alias("error"),
    )


def metric_rows(wide: DataFrame, run: Column, step: Column, names: dict[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """Long ``(run, metric, step, value)`` rows from columns, with contract names only."""
    unknown = set(names.values()) - set(METRIC_NAMES)
    if unknown:
        raise ValueError(f"unknown metric names {sorted(unknown)}")
    named = wide.select(
        *keys, run.alias("run"), step.cast("bigint").alias("step"), *[F.col(c).alias(m) for c, m in names.items()]
    )
    return named.unpivot([*keys, "run", "step"], list(names.values()), "metric", "value")


def append_metrics(rows: DataFrame, path: str) -> str:
    return write_table(rows, path, mode="append")


def lag_run_name(arch: Column, lr: Column, lags: Column) -> Column:
    """``{arch}_lr{lr}_seq[l1, l2]``"""
    listed = F.concat(F.lit("["), F.array_join(lags.cast("array<string>"), ", "), F.lit("]"))
    return F.concat(arch, F.lit("_lr"), lr.cast("string"), F.lit("_seq"), listed)


def additive_run_name(arch: Column, changepoint_scale: Column, seasonality_scale: Column) -> Column:
    """``{arch}_c_scale{c}_s_scale{s}``"""
    return F.concat(
        arch,
        F.lit("_c_scale"),
        changepoint_scale.cast("string"),
        F.lit("_s_scale"),
        seasonality_scale.cast("string"),
    )


def run_name(configured: Column, generated: Column) -> Column:
    """The configured name unless it is null or empty."""
    return F.coalesce(F.when(configured != "", configured), generated)
