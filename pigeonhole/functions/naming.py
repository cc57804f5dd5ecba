"""Shard names ``<table>-<i>-of-<n>``, i from 1 (H4-H6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the shape of a shard name (table, number, count).
SHARD_NAME_PATTERN = r"^(.+)-(\d+)-of-(\d+)\z"


def shard_name(table: Column, shard: Column, num_shards: int | Column) -> Column:
    """Name of the shard with this 0-based index."""
    count = F.lit(num_shards) if isinstance(num_shards, int) else num_shards
    return F.format_string("%s-%d-of-%d", table, shard + 1, count)


def shard_names(table: Column, num_shards: int) -> Column:
    """H4: all shard names of a table, as an array in shard order."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(num_shards - 1)),
        lambda i: shard_name(table, i, num_shards),
    )


def shard_table(name: Column) -> Column:
    """Table part of a shard name, null if the name is not one."""
    part = F.regexp_extract(name, SHARD_NAME_PATTERN, 1)
    return F.when(part != "", part)


def _part(name: Column, group: int, table: Column | None) -> Column:
    ok = name.rlike(SHARD_NAME_PATTERN)
    if table is not None:
        ok = ok & (F.regexp_extract(name, SHARD_NAME_PATTERN, 1) == table)
    number = F.regexp_extract(name, SHARD_NAME_PATTERN, group).try_cast("int")
    return F.when(ok, F.coalesce(number, F.lit(-1))).otherwise(F.lit(-1))


def shard_number(name: Column, table: Column | None = None) -> Column:
    """H5: the 1-based shard number, -1 if malformed or of another table."""
    return _part(name, 2, table)


def shard_count(name: Column, table: Column | None = None) -> Column:
    """H6: the shard count n, -1 if malformed or of another table."""
    return _part(name, 3, table)
