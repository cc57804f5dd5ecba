"""Resharding, hash slices and capacity checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pigeonhole.columns import field, long_lit
from pigeonhole.functions import hashing
from pigeonhole.operators.attributes import ITEM

# The store's limits.
MAX_SHARDS = 100
MAX_VALUE_BYTES = 1024
MAX_ITEM_BYTES = 1024 * 1024


def reshard(df: DataFrame, num_shards: int) -> DataFrame:
    """Routed rows with the shard they have in a table of ``num_shards`` shards.

    Decodes the stored item hash, so keys are not hashed again.
    """
    position = hashing.text_position(F.col("item_hash"))
    return df.withColumn("shard", hashing.shard_of_position(position, num_shards))


def hash_slices(df: DataFrame, num_shards: int, num_slices: int) -> DataFrame:
    """R2: add ``slice``, one of ``num_slices`` equal hash ranges inside the row's shard."""
    position = hashing.text_position(F.col("item_hash"))
    index = hashing.slice_of_position(position, F.col("shard"), num_shards, num_slices)
    return df.withColumn("slice", index)


def by_slice(df: DataFrame, num_shards: int, num_slices: int) -> DataFrame:
    """R2: slices as units of parallel work; rows of a slice end up in the same task."""
    return hash_slices(df, num_shards, num_slices).repartition("shard", "slice")


def slice_filter(shard: int, index: int, num_shards: int, num_slices: int) -> Column:
    """R2 as a predicate: rows of one slice, as ranges of item-hash text.

    Made of literals only, so it prunes shard directories and is pushed down to the
    files, which are sorted by item hash. Text order among negative hashes is reversed;
    the bounds take that into account.
    """
    hashing.check_num_shards(num_shards)
    width = hashing.HASH_RANGE // num_shards
    start = shard * width
    low = start + -(-index * width // num_slices)
    if index < num_slices - 1:
        high = start + -(-(index + 1) * width // num_slices) - 1
    else:
        high = hashing.HASH_MASK if shard == num_shards - 1 else start + width - 1
    low, high = low - hashing.SIGN_OFFSET, high - hashing.SIGN_OFFSET
    ranges = []
    if low < 0:
        ranges.append((f"0{-min(high, -1):010d}", f"0{-low:010d}"))
    if high >= 0:
        ranges.append((f"1{max(low, 0):010d}", f"1{high:010d}"))
    text = F.lit(False)
    for first, last in ranges:
        text = text | F.col("item_hash").between(first, last)
    return (F.col("shard") == shard) & text


def capacity_violations(
    df: DataFrame,
    key: str,
    attributes: Sequence[str],
    max_value_bytes: int = MAX_VALUE_BYTES,
    max_item_bytes: int = MAX_ITEM_BYTES,
) -> DataFrame:
    """R4 over wide text rows: ``(problem, item_name, name, size, allowed)``.

    One pass without a shuffle; the size of an item is its name plus its attribute names
    and values.
    """
    size = {a: F.octet_length(field(a)).cast("bigint") for a in [key, *attributes]}

    def violation(problem: str, name: str | None, amount: Column, allowed: int) -> Column:
        return F.when(
            amount > allowed,
            F.struct(
                F.lit(problem).alias("problem"),
                field(key).alias(ITEM),
                F.lit(name).cast("string").alias("name"),
                amount.alias("size"),
                long_lit(allowed).alias("allowed"),
            ),
        )

    item_size = size[key]
    for a in attributes:
        named = size[a] + long_lit(len(a.encode()))
        item_size = item_size + F.coalesce(named, long_lit(0))
    found = [violation("value", a, size[a], max_value_bytes) for a in attributes]
    found.append(violation("item", None, item_size, max_item_bytes))
    return df.select(F.inline(F.array_compact(F.array(*found))))


def attribute_capacity_violations(
    attrs: DataFrame,
    max_value_bytes: int = MAX_VALUE_BYTES,
    max_item_bytes: int = MAX_ITEM_BYTES,
) -> DataFrame:
    """R4 over long rows; item sizes are summed before the shuffle."""
    size = F.octet_length("value").cast("bigint")
    values = attrs.where(size > max_value_bytes).select(
        F.lit("value").alias("problem"),
        ITEM,
        "name",
        size.alias("size"),
        long_lit(max_value_bytes).alias("allowed"),
    )
    pair = F.octet_length("name").cast("bigint") + size
    items = (
        attrs.groupBy(ITEM)
        .agg(F.sum(pair).alias("pairs"))
        .withColumn("size", F.col("pairs") + F.octet_length(ITEM).cast("bigint"))
        .where(F.col("size") > max_item_bytes)
        .select(
            F.lit("item").alias("problem"),
            ITEM,
            F.lit(None).cast("string").alias("name"),
            "size",
            long_lit(max_item_bytes).alias("allowed"),
        )
    )
    return values.unionByName(items)


def shard_count_violations(shards: DataFrame, max_shards: int = MAX_SHARDS) -> DataFrame:
    """R4 for tables: rows of ``(table_name, num_shards)`` that have too many shards."""
    return shards.where(F.col("num_shards") > max_shards).select(
        "table_name", "num_shards", F.lit(max_shards).alias("allowed")
    )
