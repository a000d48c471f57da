"""Global positions and running sums, without ever sorting a table in one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_settled, write_settled

PART = "_part"
ROW = "_row"
END = "_end"  # running sum, the row itself included


def positions(df: DataFrame, order: Sequence[Column], weight: str) -> DataFrame:
    """``df`` with ``_row``, the rank from 0 over the whole table, and ``_end``, the running
    sum of the long column ``weight`` (not null), both ascending in ``order``, nulls last.

    The table is range partitioned by the order and, last, by its scan position, so that
    even rows equal in everything are spread; each task counts within its own partition, and
    the partitions' totals (one row each) are summed up and added. An empty table stays one.
    """
    names = [f"_k{i}" for i in range(len(order) + 1)]
    keys = [F.col(n).asc_nulls_last() for n in names]
    keyed = df.withColumns(dict(zip(names, [*order, F.monotonically_increasing_id()])))
    ranged = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*names)
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.LongType()) for n in (PART, ROW, END))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, rows, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            ends = np.cumsum(np.asarray(batch.column(weight), dtype=np.int64)) + total
            own = [np.full(n, part, np.int64), np.arange(rows, rows + n, dtype=np.int64), ends]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, own)], [*batch.schema.names, PART, ROW, END]
            )
            rows, total = rows + n, int(ends[-1]) if n else total

    local = write_settled(ranged.mapInArrow(count, schema), "positions")
    totals = local.groupBy(PART).agg(F.count("*").alias("_n"), F.max(END).alias("_sum"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = totals.select(
        PART,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"),
    )
    found = (
        local.join(offsets, PART)
        .withColumns({ROW: F.col(ROW) + F.col("_rows_before"), END: F.col(END) + F.col("_sum_before")})
        .drop(PART, "_rows_before", "_sum_before")
    )
    settled = write_settled(found, "positions")
    drop_settled(local)
    return settled
