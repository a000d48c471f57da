"""Merkle fixity audit of archived records.

Pages become WARC response records; in the order of their ids each has a row number and an
offset range in the archive. A replica is audited by hashing what it has in the archive's
ranges, or as an archive of its own: leaves are the records' SHA-256, and a node of the tree hashes the offset range it
covers and its up to ``FAN`` children in order. Trees of both replicas are built level by
level, each level ``FAN`` times smaller. The audit compares the roots and, from the top, looks
only below the nodes that differ, down to the records.

Only hashes and offsets are ordered and shuffled; record bytes stay in the scan that reads
them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import drop_settled, write_settled
from .order import END, ROW, positions

FAN = 16
EOL = "\r\n"


def record(url: Column, html: Column) -> Column:
    """A page as a WARC response record; a null url or body is empty."""
    body = F.coalesce(html, F.lit(""))
    header = [
        F.lit("WARC/1.1" + EOL + "WARC-Type: response" + EOL + "WARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit(EOL + "Content-Type: text/html" + EOL + "Content-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(EOL + EOL),
    ]
    return F.concat(*header, body, F.lit(EOL + EOL))


def records(pages: DataFrame) -> DataFrame:
    """``page_id`` and ``record`` of each page."""
    return pages.select("page_id", record(F.col("url"), F.col("html")).alias("record"))


def _level(below: DataFrame, relative: bool) -> DataFrame:
    ranges = ("start", "end", "their_start", "their_end")

    def spanned(x: str) -> Column:
        if relative and x.endswith("end"):  # lengths of the children, one after the other
            return F.aggregate(f"c.{x}", F.lit(0).cast("long"), lambda s, v: s + F.coalesce(v, F.lit(0))).alias(x)
        return (F.array_min if x.endswith("start") else F.array_max)(f"c.{x}").alias(x)

    children = F.array_sort(F.collect_list(F.struct("node", *ranges, "ours", "theirs")))
    grouped = below.groupBy(F.floor(F.col("node") / FAN).cast("long").alias("node")).agg(children.alias("c"))
    grouped = grouped.select("node", "c", *map(spanned, ranges))

    def joined(side: str, start: str, end: str) -> Column:
        hashes = F.col(f"c.{side}")
        covered = F.concat(F.col(start).cast("string"), F.lit("-"), F.col(end).cast("string"), F.lit(":"), F.array_join(hashes, "", "-"))
        return F.when(F.array_max(hashes).isNotNull(), F.sha2(covered, 256)).alias(side)

    return grouped.select("node", *ranges, joined("ours", "start", "end"), joined("theirs", "their_start", "their_end"))


def trees(leaves: DataFrame, relative: bool = False) -> list[DataFrame]:
    """Levels of both trees over ``node``, the ranges, ``ours``, ``theirs``; the last has one node.

    With ``relative`` a leaf's range is 0 to its length, and a node's 0 to the sum of its children's.
    """
    levels = [leaves]
    while levels[-1].limit(2).count() > 1:
        levels.append(write_settled(_level(levels[-1], relative), "tree"))
    return levels


def _differs() -> Column:
    same = F.col("ours").eqNullSafe(F.col("theirs"))
    return ~(same & F.col("start").eqNullSafe(F.col("their_start")) & F.col("end").eqNullSafe(F.col("their_end")))


RANGES = 32  # stretches of a level told apart before it is read


def _under(found: DataFrame, below: DataFrame) -> Column:
    """A filter on ``node`` that holds for all children of ``found``, for the scan of ``below`` to skip files by.

    The level is cut into ``RANGES`` stretches, and those with a differing parent (``RANGES`` numbers at
    most) are told to the scan, neighbours as one range.
    """
    width = -(-max(below.count(), 1) // RANGES)
    first, last = F.col("node") * FAN, F.col("node") * FAN + (FAN - 1)
    touched = F.explode(F.sequence(F.floor(first / width), F.floor(last / width))).alias("stretch")
    stretches = sorted(r["stretch"] for r in found.select(touched).distinct().collect() if r["stretch"] < RANGES)
    ranges: list[list[int]] = []
    for at in stretches:
        if ranges and ranges[-1][1] == at:
            ranges[-1][1] = at + 1
        else:
            ranges.append([at, at + 1])
    kept = F.lit(False)
    for low, high in ranges:
        kept = kept | ((F.col("node") >= low * width) & (F.col("node") < high * width))
    return kept


def descend(levels: list[DataFrame]) -> DataFrame:
    """The leaves that differ, found from the root through differing nodes only.

    Of each level only the stretches with children of differing nodes are read, and only those children compared.
    """
    found = levels[-1].where(_differs())
    for below in reversed(levels[:-1]):
        found = write_settled(found.select("node"), "differing")
        parents = found.select(F.col("node").alias("_parent"))
        under = F.floor(F.col("node") / FAN).cast("long")
        children = below.where(_under(found, below)).join(parents, under == F.col("_parent"), "left_semi")
        found = children.where(_differs())
    return found


def _archived(rows: DataFrame, *more: Column) -> DataFrame:
    """Hashes of ``record``, in the order of ids, each with its row and offset range."""
    size, sha = F.octet_length("record").cast("long").alias("size"), F.sha2("record", 256).alias("sha")
    hashed = write_settled(rows.select("page_id", size, sha, *more), "records")
    placed = positions(hashed, [F.col("page_id"), F.col("sha")], "size")
    drop_settled(hashed)
    return placed.select(F.col(ROW).alias("node"), "page_id", (F.col(END) - F.col("size")).alias("start"), F.col(END).alias("end"), *placed.columns[2:-2])


SALTS = 16


def _copies(archive: DataFrame) -> DataFrame:
    """``archive`` with ``nth``, the number from 0 of a row among those of its ``page_id``.

    Only repeated ids are looked up, and each in ``SALTS`` places, as one may hold most rows.
    """
    many = archive.groupBy("page_id").agg(F.min("node").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    many = many.select(F.col("page_id").alias("_id"), "_first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("node") % SALTS == F.col("_salt"))
    nth = F.when(F.col("_first").isNull(), F.lit(0)).otherwise(F.col("node") - F.col("_first")).cast("long")
    return archive.join(many, same, "left").withColumn("nth", nth).drop("_id", "_first", "_salt")


def _audit_by_id(own: DataFrame, other: DataFrame) -> DataFrame:
    names = {x: f"their_{x}" for x in ("page_id", "nth", "start", "end")} | {"sha": "theirs"}
    mine, others = _copies(own).drop("node"), _copies(other).drop("node").withColumnsRenamed(names)
    same = F.col("page_id").eqNullSafe(F.col("their_page_id")) & (F.col("nth") == F.col("their_nth"))
    both = mine.join(others, same, "full_outer")
    is_ours = F.col("nth").isNotNull()
    page_id = F.when(is_ours, F.col("page_id")).otherwise(F.col("their_page_id")).alias("page_id")
    paired = both.select(
        page_id, F.coalesce("nth", "their_nth").alias("nth"), F.col("sha").alias("ours"), "theirs",
        F.col("start").alias("at"), F.col("their_start").alias("their_at"),
        F.when(is_ours, F.lit(0)).cast("long").alias("start"), (F.col("end") - F.col("start")).alias("end"),
        F.when(F.col("their_nth").isNotNull(), F.lit(0)).cast("long").alias("their_start"),
        (F.col("their_end") - F.col("their_start")).alias("their_end"), F.lit(1).cast("long").alias("_one"),
    )
    paired = write_settled(paired, "leaves")
    leaves = positions(paired, [F.col("page_id"), F.col("nth")], "_one").withColumnRenamed(ROW, "node").drop(END, "_one", "nth")
    drop_settled(paired)
    found = descend(trees(leaves, relative=True))
    return found.select(
        "page_id", F.col("at").alias("start"), (F.col("at") + F.col("end")).alias("end"), "ours", "theirs",
        F.col("their_at").alias("their_start"), (F.col("their_at") + F.col("their_end")).alias("their_end"),
    )


def audit(pages: DataFrame, replica: DataFrame | Callable[[Column], Column], align: str = "place") -> DataFrame:
    """``page_id``, ``start``, ``end``, ``ours``, ``theirs``, ``their_start`` and ``their_end`` of each record that differs.

    Needs ``page_id``, ``url`` and ``html``. ``replica`` is a table of ``page_id`` and ``record``, an
    archive with its own order and offsets, or a function that gives the replica's record from ours
    as read in the same range (null: lost). Trees are compared row by row of the archives: a lost,
    additional or longer record shifts what follows, and all of that is reported. Where one side
    has no record its hash and range are null; ``page_id`` is then the other side's. Null ids come
    last in an archive; repeated rows are records of their own; a null record is none. Equal trees
    and empty tables give an empty result.

    ``align="id"`` (for tables) sets records of the same id side by side instead, copies of an id by their
    hash, and trees cover lengths in place of offsets: a lost, additional, cut or longer record is reported
    alone, and records that only moved are not.
    """
    if align not in ("place", "id"):
        raise ValueError(f"align is place or id, not {align!r}")
    if isinstance(replica, DataFrame) and align == "id":
        return _audit_by_id(_archived(records(pages)), _archived(replica.where("record IS NOT NULL")))
    if isinstance(replica, DataFrame):
        own = _archived(records(pages)).withColumnRenamed("sha", "ours")
        names = {"page_id": "their_id", "start": "their_start", "end": "their_end", "sha": "theirs"}
        other = _archived(replica.where("record IS NOT NULL")).withColumnsRenamed(names)
        page_id = F.when(F.col("ours").isNull(), F.col("their_id")).otherwise(F.col("page_id")).alias("page_id")
        both = own.join(other, "node", "full_outer")
        leaves = write_settled(both.select("node", page_id, "start", "end", "ours", "theirs", "their_start", "their_end"), "leaves")
    else:
        theirs = F.sha2(replica(F.col("record")), 256).alias("theirs")
        there = lambda x: F.when(F.col("theirs").isNotNull(), F.col(x)).alias(f"their_{x}")
        own = _archived(records(pages), theirs).withColumnRenamed("sha", "ours")
        leaves = own.select("node", "page_id", "start", "end", "ours", "theirs", there("start"), there("end"))
    return descend(trees(leaves)).drop("node")


def damaged(every: int, which: int, page_id: Column) -> Callable[[Column], Column]:
    """A replica in which the last visible byte of every so-manieth page's record reads ``#``."""
    hit = F.coalesce(page_id % every == which, F.lit(False))
    return lambda whole: F.when(hit, F.concat(F.substr(whole, F.lit(1), F.char_length(whole) - 5), F.lit("#"), F.substr(whole, F.char_length(whole) - 3))).otherwise(whole)


SQL = r"""
WITH bytes AS (
    SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: '
        || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
        || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
        || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM pages
), placed AS (
    SELECT *, sum(strlen(record)) OVER (ORDER BY page_id NULLS LAST, sha256(record) ROWS UNBOUNDED PRECEDING)::BIGINT AS "end" FROM bytes
)
SELECT page_id, "end" - strlen(record) AS start, "end", sha256(record) AS ours,
    sha256(substr(record, 1, (length(record) - 5)::BIGINT) || '#' || substr(record, (length(record) - 3)::BIGINT)) AS theirs
FROM placed WHERE page_id % 97 = 5
"""
