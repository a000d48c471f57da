"""The queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from .keys import short_batches
from . import fingerprints, identifiers, maxscore, minhash, mixing, packing, quality, repeats, search, sharding, toxicity, vectorcodes, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Callable[[str], DataFrame]], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(
            lambda table: short_batches(ship(spark)).read.parquet(f"{folder}/{table}.parquet")
        )
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_sharding")
def op1(table):
    return sharding.shard(table("documents"))


@query("op2_mixing", mixing.SQL)
def op2(table):
    return mixing.mix(table("documents").select("doc_id", "text", "source")).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )


@query("op10_minhash")
def op10(table):
    return minhash.near_duplicates(table("documents"), shingle=3, percent=85).drop("_h1", "_h2")


@query("op8_fingerprints")
def op8(table):
    return fingerprints.fingerprint(table("documents"))


@query("op4_suffix_dedup")
def op4(table):
    # Strings of 400 bytes are removed; most passages of 50 words are shorter, they stay and n_shared shows them.
    return repeats.deduplicated(table("documents"), shown=240)


@query("op7_toxicity")
def op7(table):
    return toxicity.scores(table("documents"), table("labels"))


@query("op9_packing")
def op9(table):
    return packing.pack(table("documents"))


@query("op5_quality")
def op5(table):
    return quality.scores(table("documents"), table("labels"))


@query("op3_merkle_audit", warc.SQL)
def op3(table):
    found = warc.audit(table("pages").select("page_id", "url", "html"), warc.damaged(97, 5, F.col("page_id")))
    return found.select("page_id", "start", "end", "ours", "theirs")


@query("op6_topk_search")
def op6(table):
    docs = table("documents").select(F.col("doc_id").alias("id"), "text")
    return search.search(docs, docs.where("id % 20 = 0"))


@query("op11_identifiers")
def op11(table):
    return identifiers.report(table("documents"))


@query("op12_vector_codes", vectorcodes.SQL)
def op12(table):
    return vectorcodes.compress(table("embeddings"))


@query("op13_ranked_search", maxscore.SQL)
def op13(table):
    docs = table("documents").select(F.expr("try_cast(doc_id AS bigint)").alias("id"), "text")
    items = table("benchmark").select(F.expr("try_cast(item_id AS bigint)").alias("id"), "text")
    found = maxscore.search(docs, items)
    return found.select(F.col("query_id").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")
