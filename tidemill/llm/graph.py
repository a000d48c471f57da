"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_settled, write_settled


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for each node with a link.

    ``links`` has columns ``a`` and ``b``. Alternating stars: every node hands its larger
    neighbours, then its smaller ones, on to the least it knows, until nothing changes; rounds
    grow with the logarithm of the longest chain. Only minima are grouped, so a node with very
    many links is pre-aggregated, and its rows are joined back as an ordinary skewed join.
    """
    edges = write_settled(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = write_settled(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        handed = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = write_settled(least.withColumnRenamed("m", "b").union(handed).distinct(), "edges")
        drop_settled(edges, large)
        edges, before, mark = small, mark, _mark(small)
        if mark == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
