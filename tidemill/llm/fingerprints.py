"""Document fingerprints by consistent weighted sampling, in DataFrame expressions only.

Terms are pairs of neighbouring words (the last word with nothing), weighted by how often
they occur, so a weight is a whole number w and a term stands for the w items (term, 1) to
(term, w). Each of the ``SAMPLES`` samples gives every item of the text a rank of its own,
Exp(1), and draws the item of least rank. Two texts draw the same item with probability equal
to their generalised Jaccard similarity, sum of least weights by sum of greatest, however
skewed the weights are, and each text with words has all samples.

The ranks of an item in all samples are one Poisson process of rate ``SAMPLES`` whose arrivals
are dealt evenly to the samples (the first arrival of each is its rank there). Arrivals come in
order from hashes of item and number, and only those before a time that depends on the text's
number of words are looked at: up to about ``ENOUGH`` arrivals a sample are expected there, and
where a sample has none the text is done again up to ``CERTAIN`` (none is then left out but with
a probability below 1e-17). So the cost of a text is its words and a fixed number of arrivals,
not words times samples. A fingerprint is the array of (sample, hash of item), 30 bits an entry.

Everything happens inside the row, on sorted arrays of longs: no rows are exploded, nothing
is shuffled, and memory is that of one text's words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_settled, write_settled

SAMPLE_BITS = 6
SAMPLES = 1 << SAMPLE_BITS
ENOUGH, CERTAIN = 9, 45
_ID_BITS, _A_BITS = 24, 33


def _draw(item: Column, number: Column) -> Column:
    """The ``number``-th arrival of an item: low bits name its sample, the others its waiting time."""
    return F.xxhash64(item, number)


def _wait(draw: Column) -> Column:
    return -F.log((F.shiftrightunsigned(draw, 24) + F.lit(0.5)) / F.lit(float(1 << 40)))


def _arrivals(items: Column, n: Column, each: int) -> Column:
    """All arrivals before the time at which ``each`` a sample are expected, as longs that sort by sample, then time."""
    end = F.lit(float(each * SAMPLES)) / n
    least = F.floor(F.exp(-end) * F.lit(float(1 << 40)) - 1)  # first draws below it wait longer
    early = F.filter(items, lambda x: F.shiftrightunsigned(_draw(x, F.lit(1)), 24) >= least)
    begun = F.transform(early, lambda x: F.struct(x.alias("x"), F.lit(0.0).alias("t"), F.lit(0).cast("long").alias("d")))
    none = F.array().cast("array<bigint>")

    def named(a: Column) -> Column:
        sample = a["d"].bitwiseAND(F.lit(SAMPLES - 1))
        time = (a["t"] / end * F.lit(float((1 << _A_BITS) - 1))).cast("long")
        item = a["x"].bitwiseAND(F.lit((1 << _ID_BITS) - 1))
        return F.shiftleft(sample, _A_BITS + _ID_BITS).bitwiseOR(F.shiftleft(time, _ID_BITS)).bitwiseOR(item)

    def step(state: Column, number: Column) -> Column:
        drawn = F.transform(state["live"], lambda a: F.struct(a["x"].alias("x"), a["t"].alias("t"), _draw(a["x"], number).alias("d")))
        moved = F.transform(drawn, lambda a: F.struct(a["x"].alias("x"), (a["t"] + _wait(a["d"])).alias("t"), a["d"].alias("d")))
        live = F.filter(moved, lambda a: a["t"] < end)
        # What is live before a step arrived in the step before it.
        arrived = F.when(number > 1, F.concat(state["found"], F.transform(state["live"], named))).otherwise(state["found"])
        return F.struct(live.alias("live"), arrived.alias("found"))

    rounds = F.ceil(end + 9 * F.sqrt(end) + 20).cast("int")  # more arrivals of one item: below 1e-12
    state = F.struct(begun.alias("live"), none.alias("found"))
    return F.aggregate(F.sequence(F.lit(1), rounds), state, step, lambda x: x["found"])


def _samples(arrivals: str) -> Column:
    """The first arrival of each sample, from sorted arrivals."""
    sample = lambda v: F.shiftright(v, _A_BITS + _ID_BITS)
    least = F.filter(arrivals, lambda v, i: ~sample(v).eqNullSafe(sample(F.get(F.col(arrivals), i - 1))))
    return F.transform(
        least, lambda v: F.shiftleft(sample(v), _ID_BITS).bitwiseOR(v.bitwiseAND(F.lit((1 << _ID_BITS) - 1)))
    )


def with_samples(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the fingerprint of a not null text column as ``array<long>``; empty if it has no words."""
    w, s, p, q, a = (f"_{out}_{x}" for x in "wspqa")
    spaced = F.translate(F.col(text), "\t\n\x0b\x0c\r", "     ")
    df = df.withColumn(w, F.array_remove(F.split(spaced, " "), ""))
    df = df.withColumn(s, F.sort_array(F.transform(w, lambda x, i: F.xxhash64(x, F.get(F.col(w), i + 1)))))
    begins = F.filter(
        F.sequence(F.lit(0), F.size(s) - 1), lambda i: ~F.get(F.col(s), i).eqNullSafe(F.get(F.col(s), i - 1))
    )
    df = df.withColumn(p, F.when(F.size(s) > 0, begins).otherwise(F.array().cast("array<int>")))
    items = F.transform(
        p,
        lambda i, j: F.transform(
            F.sequence(F.lit(1), F.coalesce(F.get(F.col(p), j + 1), F.size(F.col(s))) - i),
            lambda c: F.xxhash64(F.get(F.col(s), i), c),
        ),
    )
    df = df.withColumn(q, F.flatten(items))
    n = F.size(q)
    few = lambda each: F.sort_array(_arrivals(F.col(q), n.cast("double"), each))
    none = F.array().cast("array<bigint>")
    df = df.withColumn(a, F.when(n > 0, few(ENOUGH)).otherwise(none))
    df = df.withColumn(out, _samples(a))
    short = (n > 0) & (F.size(out) < SAMPLES)
    df = df.withColumn(a, F.when(short, few(CERTAIN)).otherwise(none))
    return df.withColumn(out, F.when(short, _samples(a)).otherwise(F.col(out))).drop(w, s, p, q, a)


def spelled(samples: Column) -> Column:
    """A fingerprint as text, eight hexadecimal digits an entry."""
    return F.array_join(F.transform(samples, lambda v: F.lpad(F.lower(F.hex(v)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; 1 if neither has words."""
    either = F.greatest(F.size(a), F.size(b))
    return F.when(either > 0, F.size(F.array_intersect(a, b)) / either).otherwise(F.lit(1.0))


def _followers(keys: DataFrame) -> DataFrame:
    """``keys`` with ``_next_id`` and ``_next_h``: the next in descending id, after the last the first.

    Range partitions are numbered and written; each finds its followers by itself, and its last
    row takes the first row of the next partition (one row for each partition).
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("_h").asc()]
    parts = write_settled(
        keys.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged"
    )
    own = Window.partitionBy("_part").orderBy(*order)
    here = parts.withColumns(
        {"_rank": F.row_number().over(own), "_follower": F.lead(F.struct("_id", "_h")).over(own)}
    )
    heads = here.where("_rank = 1").select("_part", F.struct("_id", "_h").alias("_head"))
    by_part = Window.orderBy("_part")  # a row for each partition
    first = F.first("_head").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("_part", F.coalesce(F.lead("_head").over(by_part), first).alias("_after"))
    found = here.join(heads, "_part").withColumn("_follower", F.coalesce("_follower", "_after"))
    settled = write_settled(
        found.select(
            "doc_id", "_id", "_h", "_copies", "n_chars", F.col("_follower._id").alias("_next_id"), F.col("_follower._h").alias("_next_h")
        ),
        "followers",
    )
    drop_settled(parts)
    return settled


def fingerprint(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_chars``, and the fingerprints of each text and of its edited text.

    Needs ``doc_id`` and ``text``; other columns are ignored. A null text is empty; without
    words a fingerprint is the empty string. The edited text has its last third of code points
    replaced by as many of the next document's first, in descending ``doc_id`` (null last; rows
    of one id by a hash of their text). Rows that repeat both id and text are one document in
    that order, and each gets the result. A single document follows itself.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # A key without nulls, so that grouping and both joins agree on one partitioning of the texts.
    base = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_id"),
        F.xxhash64(text).alias("_h"),
        text.alias("text"),
    )
    keys = write_settled(
        base.groupBy("doc_id", "_id", "_h").agg(
            F.count("*").alias("_copies"), F.max(F.char_length("text")).cast("long").alias("n_chars")
        ),
        "keys",
    )
    pairs = _followers(keys)
    texts = with_samples(base.select("_id", "_h", "text"), "text", "_samples")
    texts = texts.groupBy("_id", "_h").agg(F.first("text").alias("text"), F.first("_samples").alias("_samples"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    after = pairs.select(
        F.col("_id").alias("_for_id"), F.col("_h").alias("_for_h"), F.col("_next_id").alias("_id"), F.col("_next_h").alias("_h"), third.alias("_m")
    )
    begin = texts.join(after, ["_id", "_h"]).select(
        F.col("_for_id").alias("_id"), F.col("_for_h").alias("_h"), F.substr("text", F.lit(1), F.col("_m")).alias("_begin"), F.col("_samples").alias("_next")
    )
    both = texts.join(pairs.select("doc_id", "_id", "_h", "_copies", "n_chars"), ["_id", "_h"]).join(begin, ["_id", "_h"])
    kept = F.substr("text", F.lit(1), F.col("n_chars").cast("int") - third)
    edited = with_samples(both.withColumn("_edited", F.concat(kept, "_begin")), "_edited", "_edited_samples")
    found = edited.select(
        "doc_id",
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        spelled(F.col("_samples")).alias("fingerprint"),
        spelled(F.col("_edited_samples")).alias("edited_fingerprint"),
        likeness(F.col("_samples"), F.col("_edited_samples")).alias("near_edited"),
        likeness(F.col("_samples"), F.col("_next")).alias("near_next"),
        "_copies",
    )
    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copy", "_copies")
