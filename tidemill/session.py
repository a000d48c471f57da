"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "tidemill", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is only ever used when the master itself is local.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    made = spark.sparkContext.getCheckpointDir()  # set by setCheckpointDir alone
    if made is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        made = tempfile.mkdtemp(prefix="tidemill-")
        spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so nothing is overwritten."""
    return f"{shared_dir(spark)}/tidemill/{name}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, once per application, as a zip in the shared folder."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        here = os.path.dirname(os.path.abspath(__file__))
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as archive:
            for folder, _, names in os.walk(here):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.relpath(full, os.path.dirname(here)))
        path = f"{scratch_path(spark, 'package')}/tidemill.zip"
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        out = files.create(target)
        out.write(packed.getvalue())
        out.close()
        spark.sparkContext.addPyFile(files.makeQualified(target).toString())
        _SHIPPED.add(app)
    return spark


_WRITTEN: list[tuple[SparkSession, str]] = []


def write_settled(df: DataFrame, name: str = "settled", rows: int = 0) -> DataFrame:
    """Write a table once as Parquet under the shared folder and read it back.

    Cuts the lineage, survives lost executors, and keeps sizes, column pruning and filter
    pushdown, which a checkpoint does not. The files go when the application ends, or
    earlier through :func:`drop_settled`. A task begins a new file after each ``rows`` rows, if given;
    a file of under 100 rows is a single row group, which one task reads whole.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.option("maxRecordsPerFile", rows) if rows else df.write).parquet(path)
    _WRITTEN.append((spark, path))
    found = spark.read.schema(df.schema).parquet(path)
    found._settled_path = path
    return found


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def drop_settled(*tables: DataFrame) -> None:
    """Remove tables of :func:`write_settled` that nothing will read any more."""
    gone = {df._settled_path for df in tables}
    for spark, path in [w for w in _WRITTEN if w[1] in gone]:
        _remove(spark, path)
        _WRITTEN.remove((spark, path))


def _clean_up() -> None:
    for spark, path in _WRITTEN:
        if spark.sparkContext._jsc is not None:
            _remove(spark, path)
    _WRITTEN.clear()


atexit.register(_clean_up)
