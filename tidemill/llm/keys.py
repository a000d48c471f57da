"""Names of texts, and how they are handed to Python."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = "1000"


def short_batches(spark: SparkSession) -> SparkSession:
    """Texts are long rows: unless the session says otherwise, fewer of them go to Python at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":  # Spark's default
        spark.conf.set(name, BATCH_ROWS)
    return spark


def text_key() -> list[Column]:
    """128 bits, ``_h1`` and ``_h2``, that name the column ``text``; null and empty alike."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(F.lit(1), text).alias("_h1"), F.xxhash64(F.lit(2), text).alias("_h2")]
