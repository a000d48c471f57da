"""Writes that may be tried again: a table appears whole or not at all, a run is kept once.

Two forms. A *staged* write fills a hidden folder beside the target and renames it when every
task has succeeded, so a failed or repeated attempt never leaves half a table. A *run* table holds
many runs in one folder, and writing a run replaces exactly the partitions it writes.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import write_table


def _files(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def write_staged(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), replace: bool = True
) -> str:
    """Write ``df`` so that ``path`` holds all of it, or what it held before.

    With ``replace`` an earlier table goes once the new one is written in full (``df`` may read it);
    without it an earlier table is an error, found before anything is written. Between two renames
    a reader may find no table for a moment; on stores that copy to rename, as long as a copy takes.
    """
    spark = df.sparkSession
    target, files = _files(spark, path)
    if not replace and files.exists(target):
        raise FileExistsError(path)
    parent, name, token = target.getParent(), target.getName(), uuid.uuid4().hex

    def beside(what: str):
        # Readers skip names that begin with an underscore.
        return spark._jvm.org.apache.hadoop.fs.Path(parent, f"_{name}-{what}-{token}")

    staged, earlier = beside("staged"), beside("earlier")
    try:
        write_table(df, staged.toString(), fmt, partition_by)
        had = files.exists(target)
        if had:
            _rename(files, target, earlier)
        try:
            _rename(files, staged, target)
        except BaseException:
            if had:
                _rename(files, earlier, target)
            raise
        if had:
            files.delete(earlier, True)
    finally:
        files.delete(staged, True)
    return path


def _rename(files, source, target) -> None:
    # A rename onto an existing folder would move into it.
    if files.exists(target) or not files.rename(source, target):
        raise OSError(f"could not rename {source.toString()} to {target.toString()}")


def write_runs(df: DataFrame, path: str, run_cols: Sequence[str] = ("run",)) -> str:
    """Add runs to a table, in the place of earlier rows of the same runs.

    ``run_cols`` become partition folders. Only the runs in ``df`` are replaced, when the whole
    write has succeeded; a failed attempt leaves the table as it was, and other runs may be
    written at the same time. A run with no rows in ``df`` stays. Empty and null names, which
    folders can't tell apart, are an error.
    """
    named = df.withColumns({c: _named(c, df.schema[c].dataType) for c in run_cols})
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*run_cols).parquet(path)
    return path


def _named(column: str, kind: T.DataType) -> Column:
    filled = F.col(column).isNotNull() & (F.col(column).cast("string") != "")
    problem = F.raise_error(F.lit(f"{column}: a run needs a name")).cast(kind)
    return F.when(filled, F.col(column)).otherwise(problem)


def read_runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of :func:`write_runs` with the columns and types of ``schema``.

    The schema is given, as names of folders would otherwise be guessed: run ``007`` is text.
    A filter on a run column reads only its folders.
    """
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def log_metrics(rows: DataFrame, path: str) -> str:
    """Rows of ``tables.metric_rows``: one copy of each run's metric, however often it is logged."""
    return write_runs(rows, path, ["run", "metric"])
