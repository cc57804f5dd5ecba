"""Places of rows in an order within groups of any size, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pigeonhole.llm.tables import written

#: Bits below the partition in a value of ``monotonically_increasing_id``.
PARTITION_SHIFT = 33


def group_key(source: Column) -> Column:
    """A text that is never null, in the order of the sources' UTF-8 bytes, null first."""
    return F.coalesce(F.concat(F.lit(":"), source.cast("string")), F.lit(""))


def ranked(df: DataFrame, group: str, order: Sequence[Column]) -> DataFrame:
    """The rows with ``rank`` (from 0, within their group, by ``order``) and ``members`` of the group.

    A group may hold most rows: rows are dealt by ranges of group and order, so it spreads over
    as many tasks as its share asks for. A row's place in its partition is its number there; what
    lies before the partition is a prefix sum over one small row a group and partition.
    ``group`` must not be null. Rows that are equal in ``order`` rank in any order.

    ``df`` should be a written table, as its rows are sampled before they are sorted.
    """
    rows = df.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    # Numbers hold only once they are written.
    rows = written(rows.withColumn("_at", F.monotonically_increasing_id()), "ordered-rows")
    rows = rows.withColumn("_part", F.shiftright("_at", PARTITION_SHIFT))
    parts = rows.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    here = W.partitionBy(group)
    before = F.sum("_n").over(here.orderBy("_part")) - F.col("_n")
    parts = parts.select(group, "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(here).alias("members"))
    return rows.join(parts, [group, "_part"]).withColumn("rank", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")
