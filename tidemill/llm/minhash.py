"""b-bit MinHash near-duplicate detection with exact confirmation.

1. Each text becomes its set of distinct word shingles (64-bit hashes). Texts with the same
   set are one class (copies are never expanded into pairs); a class is named by 128 bits of
   its set.
2. Classes get ``BANDS * ROWS`` minima. Each band of minima is a key; of the minima only the
   low ``BITS`` bits are kept, packed into a signature. With 32 bands of 4, a pair at 0.85
   escapes every band with probability below 1e-10 (0.8: below 1e-7).
3. Each band's bucket links its members to one leader, the member that shares most with others
   (a star: no pairs within the group). Pairs whose similarity, estimated from equal low bits
   and corrected for chance collisions, is more than ``SIGMAS`` standard errors below the
   threshold are set aside; the others are confirmed on full sets.
4. Connected components by alternating stars, in rounds of joins.
5. What stars can have missed: groups (all members of a leader's buckets) that still hold
   different components. There, members outside the largest component meet all others in cells
   of bounded size, and full sets decide. So no link between different texts is lost, and a
   tight group of any size costs nothing here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import drop_settled, write_settled
from . import graph, textbytes
from .keys import text_key

BANDS, ROWS, BITS = 32, 4, 4
SIGMAS = 6
CELL = 1_000

_ODD = (np.random.default_rng(7).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def minima(members: np.ndarray, block: int = 4096) -> np.ndarray:
    """The least of each hash function over a set of 64-bit numbers: the high 32 bits of odd multiples."""
    low = np.full(len(_ODD), 0xFFFFFFFF, np.uint64)
    for i in range(0, len(members), block):
        part = members[i : i + block, None] * _ODD[None, :]
        low = np.minimum(low, part.min(axis=0) >> np.uint64(32))
    return low


def packed(low: np.ndarray) -> bytes:
    """The low ``BITS`` bits of each minimum, after mixing, as bytes."""
    bits = textbytes.mixed(low + np.uint64(1)) & np.uint64((1 << BITS) - 1)
    return np.packbits((bits[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).tobytes()


def least_equal(threshold: float) -> int:
    """Equal values below which a pair is set aside: ``SIGMAS`` standard errors below the mean.

    Two unlike minima agree by chance once in 2^BITS; that is the correction for collisions.
    """
    p = 2.0**-BITS + (1 - 2.0**-BITS) * threshold
    n = BANDS * ROWS
    return int(np.floor(n * p - SIGMAS * np.sqrt(n * p * (1 - p))))


_NIBBLES = 0x1111111111111111


def _equal(a: Column, b: Column) -> Column:
    """How many low-bit values of two signatures (arrays of longs, 16 values each) agree."""
    total = F.lit(0)
    for i in range(BANDS * ROWS * BITS // 64):
        x = a[i].bitwiseXOR(b[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseOR(F.shiftrightunsigned(x, 3))
        total = total + 16 - F.bit_count(x.bitwiseAND(F.lit(_NIBBLES)))
    return total


def _equal_rows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same for all rows of ``a`` against all of ``b`` (bytes): a small matrix."""
    total = np.full((len(a), len(b)), BANDS * ROWS, np.int16)
    for i in range(a.shape[1]):
        x = a[:, None, i] ^ b[None, :, i]
        total -= ((x & 0xF0) != 0).astype(np.int16)
        total -= ((x & 0x0F) != 0).astype(np.int16)
    return total


def _fingerprints(docs: DataFrame, shingle: int, also: list[str]) -> DataFrame:
    """For each row its text's name, set size, class (null if the set is empty), band keys and signature.

    The columns ``also``, longs, are kept.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    kept = ["doc_id", "_h1", "_h2", *also]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = textbytes.buffer(batch.column("text"))
            sizes, names, bands, signatures = [], [], [], []
            for i, j in textbytes.slices(starts):
                for members in textbytes.shingle_sets(data[starts[i] : starts[j]], starts[i : j + 1] - starts[i], shingle):
                    sizes.append(len(members))
                    if not len(members):
                        names.append(None), bands.append(None), signatures.append(None)
                        continue
                    low = minima(members)
                    names.append(hashlib.blake2b(members.tobytes(), digest_size=16).digest())
                    keys = np.zeros(BANDS, np.uint64)
                    for column in low.reshape(BANDS, ROWS).T:
                        keys = textbytes.mixed(keys * np.uint64(31) + column)
                    bands.append(keys.astype(np.int64))
                    signatures.append(np.frombuffer(packed(low), np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    pa.array(sizes, pa.int64()),
                    pa.array(names, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(signatures, pa.list_(pa.int64())),
                ],
                names=[*kept, "n_shingles", "cid", "bands", "sig"],
            )

    more = "".join(f", {c} long" for c in also)
    return docs.select("doc_id", *text_key(), *also, "text").mapInArrow(
        label,
        f"doc_id {kind}, _h1 long, _h2 long{more}, n_shingles long, cid binary, bands array<long>, sig array<long>",
    )


def _sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``cid`` and ``members``, the full set, of the classes in ``wanted`` (a row of text each)."""
    texts = docs.select(F.col("doc_id").alias("_id"), *text_key(), "text")
    texts = texts.withColumnsRenamed({"_h1": "_t1", "_h2": "_t2"})
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_t1") == F.col("_h1")) & (F.col("_t2") == F.col("_h2"))
    found = wanted.join(texts, same).select("cid", "text")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = textbytes.buffer(batch.column("text"))
            for i, j in textbytes.slices(starts):
                sets = textbytes.shingle_sets(data[starts[i] : starts[j]], starts[i : j + 1] - starts[i], shingle)
                members = pa.array([m.astype(np.int64) for m in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("cid").slice(i, j - i), members], names=["cid", "members"])

    return found.mapInArrow(expand, "cid binary, members array<long>").dropDuplicates(["cid"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    a = sets.select(F.col("cid").alias("a"), F.col("members").alias("_a"))
    b = sets.select(F.col("cid").alias("b"), F.col("members").alias("_b"))
    common = F.size(F.array_intersect("_a", "_b"))
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", (F.size("_a") + F.size("_b")).alias("_all"), common.alias("_common"))
    return joined.where(F.col("_common") * 100 >= (F.col("_all") - F.col("_common")) * percent).select("a", "b")


def _missed(groups: DataFrame, roots: DataFrame, least: int, percent: int) -> DataFrame:
    """Links between classes of one leader's group that are in different components so far.

    The group's largest component need not meet itself: the rest are dealt into cells of
    ``CELL``, all members into others, and each two cells meet in a task, where the estimate
    sorts out what is far below the threshold and full sets decide. A cell gives one link for
    each two components at most.
    """
    spark = groups.sparkSession
    rows = groups.join(roots.withColumnsRenamed({"node": "cid"}), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    by_root = rows.groupBy("leader", "root").agg(F.count("*").alias("m"))
    sized = by_root.groupBy("leader").agg(F.max(F.struct("m", "root")).alias("top"), F.count("*").alias("roots"), F.sum("m").alias("n"))
    sized = sized.where("roots > 1").select("leader", F.col("top.root").alias("main"), (F.col("n") - F.col("top.m")).alias("rest"), "n")
    rows = rows.join(sized, "leader")
    cells = lambda n: F.ceil(F.col(n) / F.lit(CELL)).cast("int")
    deal = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "cid"), cells(n)).cast("int")
    every_cell = lambda n: F.explode(F.sequence(F.lit(0), cells(n) - 1))
    data = ["cid", "root", "sig", "members"]
    left = rows.where("root <> main").select("leader", deal(1, "rest").alias("i"), every_cell("n").alias("j"), *data, F.lit(True).alias("left"))
    right = rows.select("leader", every_cell("rest").alias("i"), deal(2, "n").alias("j"), *data, F.lit(False).alias("left"))

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        sides = [cell[cell["left"]], cell[~cell["left"]]]
        if not len(sides[0]) or not len(sides[1]):
            return pd.DataFrame({"a": [], "b": []})
        sig = [np.stack(list(x["sig"])).astype(np.int64).view(np.uint8) for x in sides]
        own, ids = (list(x["members"]) for x in sides)
        size = np.array([len(x) for x in ids])
        known, flat = np.unique(np.concatenate(ids), return_inverse=True)
        at = np.concatenate(([0], np.cumsum(size)))
        cid, root = ([x[c].to_numpy() for x in sides] for c in ("cid", "root"))
        united: dict[bytes, bytes] = {}

        def find(x: bytes) -> bytes:
            while x in united:
                x = united[x]
            return x

        found = []
        inside = np.zeros(len(known), bool)
        for k in range(len(own)):
            n = len(own[k])
            near = (np.minimum(size, n) * 100 >= np.maximum(size, n) * percent) & (root[1] != root[0][k])
            to = np.flatnonzero(near)
            to = to[_equal_rows(sig[0][k : k + 1], sig[1][to])[0] >= least] if len(to) else to
            to = np.array([y for y in to if find(root[1][y]) != find(root[0][k])], np.int64)
            if not len(to):
                continue
            place = np.searchsorted(known, own[k])
            place = place[(place < len(known)) & (known[np.minimum(place, len(known) - 1)] == own[k])]
            inside[place] = True
            common = np.array([np.count_nonzero(inside[flat[at[y] : at[y + 1]]]) for y in to])
            inside[place] = False
            for y in to[common * 100 >= (size[to] + n - common) * percent]:
                x_root, y_root = find(root[0][k]), find(root[1][y])
                if x_root != y_root:
                    united[max(x_root, y_root)] = min(x_root, y_root)
                    found.append((cid[0][k], cid[1][y]))
        return pd.DataFrame(found, columns=["a", "b"])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # few bytes, much work: not to be coalesced
    both = left.union(right).repartition(tasks, "leader", "i", "j")
    return both.groupBy("leader", "i", "j").applyInPandas(compare, "a binary, b binary")


def _components(docs: DataFrame, shingle: int, percent: int, also: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of ``_fingerprints``, and for each class its component: ``cid``, ``least_id``, ``root``."""
    least = least_equal(percent / 100)
    rows = write_settled(_fingerprints(docs, shingle, also), "fingerprints")
    kinds = rows.where("cid IS NOT NULL").groupBy("cid").agg(
        F.min("doc_id").alias("least_id"),
        F.min(F.struct("doc_id", "_h1", "_h2")).alias("rep"),
        F.first("bands").alias("bands"),
        F.first("sig").alias("sig"),
    )
    kinds = write_settled(kinds, "classes")
    banded = kinds.select("cid", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = write_settled(banded.join(buckets, ["band", "key"]), "members")
    # The member that shares most leads: the text a group was copied from, if it is there.
    shared = members.groupBy("cid").agg(F.sum("n").alias("shared"))
    leaders = members.join(shared, "cid").groupBy("band", "key").agg(F.max(F.struct("shared", "cid")).alias("top"))
    leaders = leaders.select("band", "key", F.col("top.cid").alias("leader"))
    groups = write_settled(members.join(leaders, ["band", "key"]).select("leader", "cid").distinct(), "groups")
    wanted = groups.select("cid").distinct().join(kinds.select("cid", "rep.*", "sig"), "cid")
    sets = write_settled(_sets(docs, wanted.drop("sig"), shingle).join(wanted.select("cid", "sig"), "cid"), "sets")
    sig = kinds.select("cid", "sig")
    pairs = groups.where("cid <> leader").select(F.col("cid").alias("a"), F.col("leader").alias("b"))
    pairs = pairs.join(sig.select(F.col("cid").alias("a"), F.col("sig").alias("_a")), "a")
    pairs = pairs.join(sig.select(F.col("cid").alias("b"), F.col("sig").alias("_b")), "b")
    pairs = pairs.where(_equal(F.col("_a"), F.col("_b")) >= least).select("a", "b")
    links = write_settled(_confirmed(pairs, sets, percent), "links")
    roots = graph.components(links)
    more = write_settled(_missed(groups.join(sets, "cid"), roots, least, percent), "links")
    roots = graph.components(links.union(more))
    placed = kinds.select("cid", "least_id").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    placed = write_settled(placed.select("cid", "least_id", F.coalesce("root", "cid").alias("root")), "placed")
    drop_settled(members, groups, sets, kinds, links, more)
    return rows, placed


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for each row of ``docs``.

    Needs ``doc_id`` and ``text``; other columns are ignored. A-Z is lower-cased, words are
    runs of other than ASCII white space. Texts with fewer words than ``shingle`` have the
    whole sequence as their one shingle; null, empty and blank texts have none, and are their
    own component. ``component_id`` is the least id reachable over links of similarity
    ``percent`` / 100 or more. Repeated rows are one class and get the same result each. A row
    whose id is null reaches others as any row does; if no row of its component has an id,
    ``component_id`` is null and the row is kept. An empty table gives an empty result.
    """
    rows, placed = _components(docs, shingle, percent, [])
    smallest = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = placed.join(smallest, "root").select("cid", "component_id")
    found = rows.select("doc_id", "n_shingles", "cid", "_h1", "_h2").join(named, "cid", "left")
    component = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "_h1", "_h2"
    )


def without_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group: one of the least id, or of no id if no row has one.

    Rows are numbered and written first, so that repeated rows, and rows without an id, are told
    apart. Texts without words belong to no group and stay.
    """
    numbered = write_settled(docs.select(F.struct(*docs.columns).alias("_doc"), F.monotonically_increasing_id().alias("_row")), "numbered")
    texts = numbered.select("_doc.doc_id", "_doc.text", "_row")
    rows, placed = _components(texts, shingle, percent, ["_row"])
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    by_class = rows.where("cid IS NOT NULL").groupBy("cid").agg(first.alias("first"))
    least = by_class.join(placed, "cid").groupBy("root").agg(F.min("first").alias("first"))
    kept = least.select("first._row").union(rows.where("cid IS NULL").select("_row"))
    kept = write_settled(kept, "kept")
    drop_settled(rows, placed)
    return numbered.join(kept, "_row", "left_semi").select("_doc.*")
