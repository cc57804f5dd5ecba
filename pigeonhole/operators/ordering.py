"""Places of rows in an order within groups of any size (used by S2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pigeonhole.columns import field
from pigeonhole.sources import files

# Bits below the partition in a value of ``monotonically_increasing_id``.
PARTITION_SHIFT = 33


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "rank") -> DataFrame:
    """The rows with their place, from 0, in the order of their group, which must not be null.

    A group may hold most rows: rows are dealt by ranges of group and order, so it spreads over
    as many tasks as its share asks for. A row's place is its number in its task plus what lies
    before: a prefix sum over one small row for each task and group in it. Rows that are equal
    in ``order`` come in any order.

    The dealt rows are written to the shared folder, as their numbers only hold once they are.
    """
    spark = df.sparkSession
    keys = [field(c) for c in (*group, *order)]
    path = files.scratch_path(spark, "ordered-rows")
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = rows.withColumn("__at", F.monotonically_increasing_id())
    rows.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    rows = rows.withColumn("__task", F.shiftright("__at", PARTITION_SHIFT))
    tasks = rows.groupBy(*group, "__task").agg(
        F.min("__at").alias("__first"), F.count("*").alias("__n")
    )
    before = F.sum("__n").over(W.partitionBy(*group).orderBy("__task")) - F.col("__n")
    tasks = tasks.select(*group, "__task", (before - F.col("__first")).alias("__shift"))
    placed = rows.join(tasks, [*group, "__task"]).withColumn(name, F.col("__at") + F.col("__shift"))
    return placed.drop("__at", "__task", "__shift")
