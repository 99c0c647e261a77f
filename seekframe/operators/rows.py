"""Dense record ids in load order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.operators.skew import row_hash
from seekframe.session import materialise

_ROW_BITS = 33  # layout of monotonically_increasing_id: task number, then row number in the task


def assign_row_id(df: DataFrame, order_by: list[Column] | None = None, column: str = "_id",
                  start: int | Column = 1) -> DataFrame:
    """Number the rows ``start``, ``start + 1``, … without gaps.

    Without ``order_by`` the order is that of the scan and no row is shuffled. With it, rows are
    range-partitioned; ties are broken by the row's values and then its position in the scan, so
    even a key that owns a third of the rows is split over tasks. The placed rows are written once,
    which fixes the numbers before the per-task counts are turned into offsets.
    """
    if order_by:
        keys = [*order_by, F.col("_hash"), F.col("_arrived")]
        df = (df.withColumn("_hash", row_hash(df))
              .withColumn("_arrived", F.monotonically_increasing_id())
              .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_hash", "_arrived"))
    placed = materialise(df.withColumn("_slot", F.monotonically_increasing_id()), "row-id")
    task = F.shiftright("_slot", _ROW_BITS)
    sizes = placed.groupBy(task.alias("_task")).agg(F.count("*").alias("_rows"))
    # One row per write task: the window and the broadcast are bounded by the partition count.
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
                           .alias("_before"))
    first = start if isinstance(start, Column) else F.lit(start)
    in_task = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = placed.withColumn("_task", task).join(F.broadcast(offsets), "_task")
    return numbered.withColumn(column, (first + F.col("_before") + in_task).cast("long")) \
        .drop("_slot", "_task", "_before")
