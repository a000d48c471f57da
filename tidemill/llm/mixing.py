"""Mixing sources to target weights.

Tokens are summed per source (one partial aggregation), targets and repetition rates follow
from the table of sources, and every document is emitted floor(rate) times plus one copy
drawn with probability equal to the fraction. The draw is a hash of the seed and the row, so
reruns agree, and no shuffle of the documents is needed: the sources' table is joined back
(Spark broadcasts it below its own size limit, else the adaptive join splits a hot source).

Targets: sources in code point order, null last, weigh ``weights`` in turn and share
``budget`` of all sizes; a target stops at ``most`` times the source's size, and the excess
is shared again by weight until none is above. That is a water level: with sources in the
order of their limit by weight, those below the level are full, and the others get level
times weight. Both orders come from :func:`order.positions`, so a table of very many
sources (hosts, say) is never sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import drop_settled, write_settled
from .order import END, ROW, positions

WORDS = r"[^\x20\x09-\x0D]+"
SEED = "mix"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], budget: float, most: int) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from rows of ``source`` and ``size``."""
    sources = write_settled(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = positions(sources, [F.col("source")], "source_size")
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    weighed = ranked.withColumn("_w", F.element_at(cycle, (F.col(ROW) % len(weights) + 1).cast("int"))).drop(ROW, END)
    weighed = weighed.withColumn("_limit", F.col("source_size") * most)
    total, all_weights = weighed.agg(F.sum("source_size"), F.sum("_w")).first()
    ratio = F.col("_limit") / F.col("_w")
    keys = [ratio, F.col("source")]
    by_limit = positions(weighed, keys, "_limit").withColumnRenamed(END, "_full")
    by_limit = positions(by_limit.drop(ROW), keys, "_w")
    # The level if exactly the sources before this one are full; the first not above its own limit holds.
    level = (F.lit((total or 0) * budget) - (F.col("_full") - F.col("_limit"))) / (
        F.lit(all_weights or 0) - (F.col(END) - F.col("_w"))
    )
    found = by_limit.withColumn("_level", level)
    held = found.where(F.col("_level") <= F.col("_limit") / F.col("_w")).agg(F.min(F.struct(ROW, "_level"))).first()[0]
    above = F.lit(None).cast("double") if held is None else F.lit(held["_level"]) * F.col("_w")
    target = F.when(F.lit(held is not None) & (F.col(ROW) >= (held[ROW] if held else 0)), above).otherwise(
        F.col("_limit").cast("double")
    )
    settled = write_settled(found.select("source", "source_size", target.alias("target")), "targets")
    drop_settled(sources)
    return settled


def copies(rate: Column, doc_id: Column, text: Column, seed: str) -> Column:
    """floor(rate), plus one with probability rate - floor(rate), by a hash of the row.

    Rows without an id draw by their text.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")))))
    draw = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
    whole = F.floor(rate)
    return (whole + F.when(draw < rate - whole, 1).otherwise(0)).cast("long")


def mix(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), budget: float = 1.5, most: int = 2, seed: str = SEED
) -> DataFrame:
    """``docs`` with ``_size``, ``_source_size``, ``_target`` and ``_copies``, one row for each row.

    Needs ``doc_id``, ``text`` and ``source``. Words are runs of other than ASCII white space;
    a null text has none. A null source is a source. Sources without words take none. Repeated
    rows draw alike (the same row is the same document). An empty table gives an empty one.
    """
    sizes = docs.select("source", n_words(F.col("text")).alias("size"))
    goal = targets(sizes, weights, budget, most).select(
        F.col("source").alias("_of"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target")
    )
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(0.0))
    return (
        docs.withColumn("_size", n_words(F.col("text")))
        .join(goal, F.col("source").eqNullSafe(F.col("_of")), "left")
        .drop("_of")
        .withColumn("_copies", copies(rate, F.col("doc_id"), F.col("text"), seed))
    )


def repeated(docs: DataFrame, **settings) -> DataFrame:
    """The mixed corpus itself: each document as often as the mix takes it."""
    mixed = mix(docs, **settings).where("_copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)


SQL = r"""
WITH sized AS (
    SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, ([3, 1, 2])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, 2 * source_size AS most FROM totals
), levels AS (
    SELECT *, row_number() OVER o AS k,
        (1.5::DOUBLE * (SELECT sum(source_size) FROM totals)::DOUBLE - (sum(most) OVER o - most)::DOUBLE)
            / ((SELECT sum(w) FROM weighed) - (sum(w) OVER o - w))::DOUBLE AS level
    FROM weighed WINDOW o AS (ORDER BY most::DOUBLE / w::DOUBLE, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), held AS (
    SELECT k, level FROM levels WHERE level <= most::DOUBLE / w::DOUBLE ORDER BY k LIMIT 1
), goals AS (
    SELECT source, source_size, CASE WHEN k >= (SELECT k FROM held) THEN (SELECT level FROM held) * w::DOUBLE
        ELSE most::DOUBLE END AS target FROM levels
), rated AS (
    SELECT d.*, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size::DOUBLE ELSE 0 END AS rate,
        ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT::DOUBLE
            / 4503599627370496::DOUBLE AS draw
    FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
    (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""
