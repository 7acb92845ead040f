"""Positions of rows in a total order, and batch numbers for a whole backlog, in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.operators.incremental import processing_order
from tideline.session import stage
from tideline.specs import DEFAULT_BATCH_SIZE, TableSpec

ROW_BITS = 33  # fixed value: monotonically_increasing_id keeps the row index in the low 33 bits


def number_rows(
    df: DataFrame, order: Sequence[Column], columns: Sequence[str] = (), descending: Sequence[bool] = ()
) -> DataFrame:
    """``columns`` (by default all) with ``row_no``, from 1, in the order of the expressions ``order``.

    Rows are range-partitioned and each partition is numbered where it lies; only the partitions' sizes
    are ordered in one place.  The numbered rows are staged, since a second evaluation could draw other boundaries.
    """
    columns = list(columns) or df.columns
    keys = [f"_k{i}" for i in range(len(order))]
    down = list(descending) or [False] * len(keys)
    sort = [F.col(k).desc() if d else F.col(k).asc() for k, d in zip(keys, down, strict=True)]
    keyed = df.select(*columns, *(c.alias(k) for c, k in zip(order, keys, strict=True)))
    numbered = stage(
        keyed.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .select(*columns, F.monotonically_increasing_id().alias("_at")),
        "numbered",
    ).select(
        *columns,
        F.shiftright("_at", ROW_BITS).alias("_part"),
        F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_row"),
    )
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return numbered.join(F.broadcast(starts), "_part").select(
        *columns, (F.col("_start") + F.col("_row") + 1).alias("row_no")
    )


def assign_batches(
    df: DataFrame, spec: TableSpec, batch_size: int = DEFAULT_BATCH_SIZE, keep: Sequence[str] = ()
) -> DataFrame:
    """``df`` with ``row_no`` (from 1) and ``batch_no`` (from 0) in processing order.

    ``batch_no`` k holds what the k-th limited pull of a drain would return.  The
    rows are range-partitioned by (timestamp, identifier), so one timestamp shared
    by most of the table still spreads over many tasks; each partition is numbered
    where it lies and shifted by the size of the partitions before it.  Only those
    sizes, one row per partition, are ever ordered in one place.

    The numbered partitions are staged in the scratch folder, since a second
    evaluation could draw other range boundaries.  ``keep`` limits what is staged.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    columns = list(keep) or df.columns
    numbered = number_rows(df, processing_order(df.schema, spec), columns)
    return numbered.withColumn("batch_no", F.expr(f"(row_no - 1) div {int(batch_size)}"))
