"""A corpus pipeline: each stage takes documents and returns documents (the last one, packed pieces)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import minhash, mixing, packing, repeats, toxicity
from tidemill.llm.keys import short_batches
from tidemill.session import drop_settled, ship, write_settled


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    return toxicity.without_toxic(docs, short_batches(ship(spark)).read.parquet(f"{sf_dir}/labels.parquet"))


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    short_batches(ship(spark))
    return minhash.without_near_duplicates(docs)


def _suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 200 or more that occur twice are taken out of the texts.

    Passages of 50 words are some 300 bytes long (280 to 400 for most in the test corpus), and two
    of them share only what their edges leave; 200 finds them and is far from chance.
    """
    short_batches(ship(spark))
    return repeats.without_repeats(docs, length=200, core=100)


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, or left out, so that sources meet their target sizes."""
    short_batches(ship(spark))
    return mixing.repeated(docs)


def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    short_batches(ship(spark))
    return packing.pack(docs)


STAGES = [
    ("toxicity", _toxicity),
    ("MinHash near-dedup", _near_dedup),
    ("suffix-array dedup", _suffix_dedup),
    ("mixing sources", _mix),
    ("best-fit packing", _pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read back for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[DataFrame] = []
    for name, stage in STAGES:
        docs = write_settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop_settled(*before)
        before = [docs]
    return docs


ORACLE_SQL = None  # near duplicates, suffix order and the trees are beyond SQL; tests hold the stages against brute force
