"""Row numbers over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.sources.staging import stage


def number_rows(df: DataFrame, order: list, column: str = "position") -> DataFrame:
    """Add 1-based positions in the given order, which must be total.

    Each range partition is sorted and counted on its own; the counts (one row
    per partition) give every partition its offset. The sorted rows are staged
    first, because a second run could cut the ranges at other places.
    """
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_range", F.spark_partition_id())
        # The low 33 bits count rows inside the partition.
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    staged = stage(ranged, "numbered")
    # One row per range partition: bounded by the number of shuffle partitions.
    counts = staged.groupBy("_range").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    return (
        staged.join(F.broadcast(offsets), "_range")
        .withColumn(column, (F.col("_offset") + F.col("_at") + 1).cast("bigint"))
        .drop("_range", "_at", "_offset")
    )
