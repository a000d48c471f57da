"""Permutation importance of any model: how much worse it predicts when one column is shuffled."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blocks

Predict = Callable[[DataFrame], DataFrame]


def permuted(
    rows: DataFrame, features: Sequence[str], id_cols: Sequence[str], keys: Sequence[str] = (), repeats: int = 1, seed: int = 0
) -> DataFrame:
    """Every row once with ``_feature`` null, and once per feature and ``_repeat`` with that column's
    value of another row of the same keys.

    The row at place i by ``id_cols`` gets the value of the row at place i by a hash of them, so each
    value is used once and the same seed gives the same shuffle. Both places come from range
    partitions with counts, and the join is on key and place: no task sorts or holds a whole series.
    ``id_cols`` must tell the rows of a key apart (equal ids are put in an arbitrary order).
    """
    seeded = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("_repeat").cast("string"), *[F.col(c).cast("string") for c in id_cols]))
    placed = blocks.with_position(rows, keys, id_cols[0], "_place", id_cols[1:], chunk=None)
    many = rows.select(
        *keys, *id_cols, *[F.col(c).alias(f"_other_{c}") for c in features],
        F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("_repeat"),
    ).withColumn("_hash", seeded)
    others = blocks.with_position(many, [*keys, "_repeat"], "_hash", "_place", id_cols, chunk=None)
    others = others.select(*keys, "_repeat", "_place", *[f"_other_{c}" for c in features])
    paired = placed.join(others, [*keys, "_place"])
    # One narrow expansion for all features; the plain rows come from the first repeat.
    which = [F.lit(None).cast("string"), *[F.lit(c) for c in features]]
    kept = F.when(F.col("_repeat") == 0, F.array(*which)).otherwise(F.array(*which[1:]))
    expanded = paired.withColumn("_feature", F.explode(kept))
    swapped = {c: F.when(F.col("_feature") == c, F.col(f"_other_{c}")).otherwise(F.col(c)) for c in features}
    return expanded.withColumns(swapped).select(*rows.columns, "_feature", "_repeat")


def permutation_importance(
    rows: DataFrame,
    predict: Predict,
    features: Sequence[str],
    actual: str,
    id_cols: Sequence[str],
    keys: Sequence[str] = (),
    repeats: int = 5,
    seed: int = 0,
) -> DataFrame:
    """``(keys, feature, base_mse, permuted_mse, importance, spread)``.

    ``predict`` takes a table and returns it with a column ``predicted``, keeping the others.
    ``importance`` is the mean of the permuted errors less the plain error, ``spread`` the standard deviation over
    repeats. Rows with a null label or feature take no part; a key without rows has no result.
    """
    complete = rows.dropna("any", subset=[actual, *features])
    scored = predict(permuted(complete, features, id_cols, keys, repeats, seed))
    error = F.col("predicted") - F.col(actual)
    per_repeat = scored.groupBy(*keys, "_feature", "_repeat").agg(F.avg(error * error).alias("mse"))
    per_feature = per_repeat.groupBy(*keys, "_feature").agg(
        F.avg("mse").alias("mse"), F.stddev_pop("mse").alias("spread")
    )
    # A dozen rows per key: the plain error meets the others by aggregation, not by a second scan.
    listed = F.collect_list(
        F.when(F.col("_feature").isNotNull(), F.struct(F.col("_feature").alias("feature"), "mse", "spread"))
    )
    base = F.max(F.when(F.col("_feature").isNull(), F.col("mse")))
    gathered = per_feature.groupBy(*keys).agg(base.alias("base_mse"), listed.alias("_features"))
    return gathered.select(*keys, "base_mse", F.explode("_features").alias("f")).select(
        *keys,
        "f.feature",
        "base_mse",
        F.col("f.mse").alias("permuted_mse"),
        (F.col("f.mse") - F.col("base_mse")).alias("importance"),
        "f.spread",
    )
