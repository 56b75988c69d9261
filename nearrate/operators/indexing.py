"""Dense 1-based index over the distinct values of a column, distributed.

The values are range-partitioned, numbered inside each partition, and shifted
by the sizes of the partitions before them (a table with one row per
partition, so it is broadcast with a proven bound). The numbered frame is
checkpointed to the shared checkpoint folder, so that a lost executor cannot
renumber part of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from nearrate.session import checkpoint_dir


def dense_index(df: DataFrame, col: str, name: str = "idx") -> DataFrame:
    checkpoint_dir(df.sparkSession)
    keys = df.select(col).distinct().repartitionByRange(col)
    parts = keys.withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    sizes = parts.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy("_pid").orderBy(col))
    return (parts.withColumn("_local", local)
            .join(F.broadcast(offsets), "_pid")
            .select(col, (F.col("_local") + F.col("_off")).cast("bigint").alias(name)))
