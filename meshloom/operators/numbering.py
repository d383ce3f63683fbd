"""Dense row numbers without a single-partition sort, and the batches made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialise

#: monotonically_increasing_id keeps the partition above this many bits and the row in the partition below.
ROW_BITS = 33


def dense_row_id(df: DataFrame, order: list[Column | str], name: str = "__row_id", partitions: int | None = None) -> DataFrame:
    """df with 0, 1, 2, ... in the given order (rows equal in all keys: in any order).

    Rows are dealt by range, sorted in their partitions and written; the only rows that meet in one task are one count a partition.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    # written once: another run of the range partitioning could draw other bounds
    placed = materialise(placed, "numbering").withColumn("__part", F.shiftright("__at", ROW_BITS)).withColumn("__at", F.col("__at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(F.col("__part").alias("__p")).agg(F.count("*").alias("__n"))
    offsets = counts.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    joined = placed.join(F.broadcast(offsets), F.col("__part") == F.col("__p"))
    return joined.withColumn(name, F.col("__before") + F.col("__at")).drop("__at", "__part", "__p", "__before")


def batch_id(row_id: Column | str, size: int) -> Column:
    """1 for the first ``size`` rows, and so on."""
    row_id = F.col(row_id) if isinstance(row_id, str) else row_id
    return (F.floor(row_id / F.lit(size)) + 1).cast("int")
