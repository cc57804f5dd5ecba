"""Per-shard statistics (M6): the counters of a shard's metadata and its last change.

The hidden item hash counts as an attribute of every item, as it does in the store.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pigeonhole.columns import field, long_lit
from pigeonhole.operators.attributes import ITEM

HASH_NAME = "item_hash"
HASH_BYTES = 11
MODIFIED = "modified"

COUNTERS = (
    "items",
    "attribute_values",
    "attribute_names",
    "item_names_bytes",
    "attribute_values_bytes",
    "attribute_names_bytes",
)


def shard_stats(
    df: DataFrame,
    key: str,
    attributes: Sequence[str],
    count_hash: bool = True,
    modified: str | None = None,
) -> DataFrame:
    """M6 over routed wide rows: one aggregate, one row per shard and task shuffled.

    ``modified`` names a column with the time of a row's last change; the latest one of the
    shard is then the seventh figure. Tables take it from their files instead.
    """
    items = F.count("*")
    hidden = 1 if count_hash else 0

    def total(terms: list[Column], per_item: int) -> Column:
        return reduce(add, terms, items * long_lit(per_item * hidden))

    def used(name: str) -> Column:
        return F.max(field(name).isNotNull().cast("bigint"))

    names = reduce(add, [used(a) for a in attributes], long_lit(hidden))
    name_bytes = reduce(
        add,
        [used(a) * long_lit(len(a.encode())) for a in attributes],
        long_lit(len(HASH_NAME) * hidden),
    )
    return df.groupBy("shard").agg(
        items.alias("items"),
        total([F.count(field(a)) for a in attributes], 1).alias("attribute_values"),
        names.alias("attribute_names"),
        F.sum(F.octet_length(field(key)).cast("bigint")).alias("item_names_bytes"),
        total([_bytes(field(a)) for a in attributes], HASH_BYTES).alias(
            "attribute_values_bytes"
        ),
        name_bytes.alias("attribute_names_bytes"),
        *([] if modified is None else [F.max(field(modified)).alias("modified")]),
    )


def attribute_stats(attrs: DataFrame, count_hash: bool = True) -> DataFrame:
    """M6 over routed long rows (a set of ``shard, item_name, name, value``).

    Rows are reduced to one per item, and separately to one per attribute name, each with
    partial sums before its shuffle; no distinct count over raw rows is needed.
    """
    hidden = 1 if count_hash else 0
    per_item = attrs.groupBy("shard", ITEM).agg(
        F.count("*").alias("values"), _bytes(F.col("value")).alias("bytes")
    )
    items = per_item.groupBy("shard").agg(
        F.count("*").alias("items"),
        (F.sum("values") + F.count("*") * long_lit(hidden)).alias("attribute_values"),
        F.sum(F.octet_length(ITEM).cast("bigint")).alias("item_names_bytes"),
        (F.sum("bytes") + F.count("*") * long_lit(HASH_BYTES * hidden)).alias(
            "attribute_values_bytes"
        ),
    )
    names = (
        attrs.select("shard", "name")
        .distinct()
        .groupBy("shard")
        .agg(
            (F.count("*") + long_lit(hidden)).alias("attribute_names"),
            (
                F.sum(F.octet_length("name").cast("bigint"))
                + long_lit(len(HASH_NAME) * hidden)
            ).alias("attribute_names_bytes"),
        )
    )
    return items.join(names, "shard").select("shard", *COUNTERS)


def every_shard(stats: DataFrame, num_shards: int) -> DataFrame:
    """Counters with a row of zeros for each shard that has no items; it has no time of change."""
    shards = stats.sparkSession.range(num_shards).select(F.col("id").cast("int").alias("shard"))
    counters = [c for c in stats.columns if c not in ("shard", MODIFIED)]
    return shards.join(stats, "shard", "left").select(
        "shard",
        *[F.coalesce(c, long_lit(0)).alias(c) for c in counters],
        *[c for c in stats.columns if c == MODIFIED],
    )


def _bytes(value: Column) -> Column:
    return F.coalesce(F.sum(F.octet_length(value).cast("bigint")), long_lit(0))
