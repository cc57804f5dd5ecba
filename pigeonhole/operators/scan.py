"""Counts, limits and lookups over routed rows.

"Routed" rows carry the columns ``item_hash`` and ``shard`` beside the scheme fields, as
read from a table or added by :func:`pigeonhole.scheme.route`. Predicates are applied
before these functions, with :meth:`Scheme.where`, so Catalyst pushes them to the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pigeonhole.columns import field, int_div, long_lit
from pigeonhole.functions import hashing, naming
from pigeonhole.scheme import NO_LIMIT, bad_key, route

# A count up to this limit stops early: each task gives at most so many empty rows to the one that
# counts. Beyond it, counting all rows where they are is the cheaper plan.
STOP_EARLY = 1 << 20

# Literal keys that a lookup puts into the scan's filter.
FEW_KEYS = 256

# Upper bound on the rows of the small "what to keep" table that balanced_limit broadcasts.
MAX_KEEP_ROWS = 65536


def count_by_shard(df: DataFrame) -> DataFrame:
    """A1: matching rows per shard; a partial count per task, then one row per shard."""
    return df.groupBy("shard").agg(F.count("*").alias("items"))


def count_items(df: DataFrame, limit: int = NO_LIMIT) -> DataFrame:
    """A1/A2: matching rows of the whole table, capped at ``limit`` if there is one.

    With a limit, a task stops reading after so many matches, whatever is left of its files.
    """
    if NO_LIMIT < limit <= STOP_EARLY:
        df = df.select(F.lit(None).alias("nothing")).limit(limit)
    return df.agg(capped(F.count("*"), limit).alias("items"))


def capped_count_by_shard(df: DataFrame, limit: int) -> DataFrame:
    """A2 per shard of rows that are not stored by shard: one pass over all of them."""
    return df.groupBy("shard").agg(capped(F.count("*"), limit).alias("items"))


def capped_count_of_shards(shards: Mapping[int, DataFrame], limit: int) -> DataFrame:
    """A2 per shard of a stored table, whose shards are read apart.

    Each shard's rows are counted under a limit of their own, so a shard with many matches is
    read until it has given them and no further. Shards without a match are left out.
    """
    counts = [
        count_items(rows, limit).select(F.lit(shard).alias("shard"), "items")
        for shard, rows in sorted(shards.items())
    ]
    return reduce(DataFrame.unionByName, counts).where("items > 0")


def capped(count: Column, limit: int) -> Column:
    """A count, but no more than the limit, if there is one."""
    return count if limit == NO_LIMIT else F.least(count, long_lit(limit))


def first_rows(df: DataFrame, key: str, limit: int) -> DataFrame:
    """Exactly ``limit`` rows (if there are that many), the first ones by key text."""
    return df.orderBy(field(key)).limit(limit)


def item_lookup(df: DataFrame, key: str, value: str, num_shards: int) -> DataFrame:
    """S3: the row of one key.

    Shard and item hash of the literal key are added as literals: the shard prunes
    partition directories, and the hash, by which files are sorted, prunes row groups.
    """
    return df.where(
        (F.col("shard") == hashing.literal_shard(value, num_shards))
        & (F.col("item_hash") == hashing.literal_item_hash(value))
        & (field(key) == value)
    )


def wanted_keys(keys: DataFrame, key: str, num_shards: int) -> DataFrame:
    """Keys (one column of any name) as ``key, item_hash, shard``, each once; null and empty ones
    are no keys."""
    (name,) = keys.columns
    wanted = keys.select(field(name).cast("string").alias(key)).where(~bad_key(field(key)))
    return route(wanted.distinct(), key, num_shards)


def items_lookup(df: DataFrame, key: str, keys: DataFrame, num_shards: int) -> DataFrame:
    """S3 for a table of keys (one column): the rows whose key is listed.

    The keys are routed too and joined on shard, hash and key, so a small key list turns into a
    broadcast join with dynamic partition pruning on ``shard``. Where Spark makes a runtime
    filter of a larger list, it is one over the stored hashes.
    """
    wanted = wanted_keys(keys, key, num_shards)
    found = df.join(wanted, ["shard", "item_hash", key], "left_semi")
    return found.select(*[field(c) for c in df.columns])


def of_hashes(hashes: Sequence[str]) -> Column:
    """Rows of one of these item hashes, as single comparisons with literals.

    Each is pushed to the files, where it is tested against the least and greatest hash of a row
    group or page and its Bloom filter. The comparisons are combined pairwise, so the expression
    is as deep as the logarithm of their number.
    """
    tests = [F.col("item_hash") == h for h in sorted(set(hashes))] or [F.lit(False)]
    while len(tests) > 1:
        tests = [reduce(or_, tests[i : i + 2]) for i in range(0, len(tests), 2)]
    return tests[0]


def shard_quotas(counts: DataFrame, num_shards: int, limit: int) -> DataFrame:
    """The fold of E3: one row ``(shard, quota)`` per shard, from ``(shard, items)``.

    Shards are visited in order; each gets ``left / shards still to come`` (integer), at
    most what it has. At most one small row per shard is involved.
    """
    found = F.map_from_entries(F.collect_list(F.struct("shard", "items")))
    one_row = counts.agg(found.alias("found"))
    start = F.struct(
        long_lit(limit).alias("left"), F.array().cast("array<bigint>").alias("quotas")
    )

    def visit(state: Column, shard: Column) -> Column:
        share = int_div(state["left"], (F.lit(num_shards) - shard).cast("bigint"))
        has = F.coalesce(F.try_element_at(F.col("found"), shard), long_lit(0))
        quota = F.least(share, has)
        return F.struct(
            (state["left"] - quota).alias("left"),
            F.concat(state["quotas"], F.array(quota)).alias("quotas"),
        )

    shards = F.sequence(F.lit(0), F.lit(num_shards - 1))
    quotas = F.aggregate(shards, start, visit, lambda s: s["quotas"])
    return one_row.select(F.posexplode(quotas).alias("shard", "quota"))


def shard_plan(
    df: DataFrame, num_shards: int, limit: int = NO_LIMIT, table: str | None = None
) -> DataFrame:
    """The shards that have matching rows, how many, and how many will be read.

    ``quota`` is -1 without a limit; with one, shards whose quota is 0 are left out.
    """
    counts = count_by_shard(df)
    if limit == NO_LIMIT:
        plan = counts.withColumn("quota", long_lit(NO_LIMIT))
    else:
        quotas = shard_quotas(counts, num_shards, limit).where("quota > 0")
        plan = counts.join(F.broadcast(quotas), "shard")
    cols = [F.col("shard"), F.col("items"), F.col("quota")]
    if table is not None:
        cols.insert(1, naming.shard_name(F.lit(table), F.col("shard"), num_shards).alias("name"))
    return plan.select(*cols)


def balanced_limit(df: DataFrame, key: str, num_shards: int, limit: int) -> DataFrame:
    """The quota of every shard, taken from the start of its hash range.

    Within a shard rows are ordered by hash position, then key. Counting rows per hash
    slice shows which slices lie wholly inside the quota and which one is cut, so no
    shard is ever sorted as a whole: whole slices are filtered, and only the rows of cut ones
    are shuffled, spread over shards. The result is exact for any limit. The broadcast side has at most
    ``max(num_shards, MAX_KEEP_ROWS)`` rows of three numbers, whatever the data size.
    """
    if limit == NO_LIMIT:
        return df
    num_slices = max(1, MAX_KEEP_ROWS // num_shards)
    position = hashing.text_position(F.col("item_hash"))
    index = hashing.slice_of_position(position, F.col("shard"), num_shards, num_slices)
    sliced = df.withColumn("__slice", index)
    counts = sliced.groupBy("shard", "__slice").agg(F.count("*").alias("items"))
    totals = counts.groupBy("shard").agg(F.sum("items").alias("items"))
    quotas = shard_quotas(totals, num_shards, limit)
    before = F.sum("items").over(W.partitionBy("shard").orderBy("__slice")) - F.col("items")
    keep = (
        counts.withColumn("__before", before)
        .join(F.broadcast(quotas), "shard")
        .select(
            "shard",
            "__slice",
            F.least("items", F.col("quota") - F.col("__before")).alias("__take"),
            (F.col("quota") - F.col("__before") >= F.col("items")).alias("__whole"),
        )
        .where("__take > 0")
    )
    names = [field(c) for c in df.columns]
    whole = keep.where("__whole").select("shard", "__slice")
    taken = sliced.join(F.broadcast(whole), ["shard", "__slice"], "left_semi").select(*names)
    # At most one slice of a shard is cut; only its rows are shuffled and ranked.
    in_slice = W.partitionBy("shard", "__slice").orderBy(position, field(key))
    cut = (
        sliced.join(F.broadcast(keep.where("not __whole")), ["shard", "__slice"])
        .withColumn("__rank", F.row_number().over(in_slice))
        .where("__rank <= __take")
        .select(*names)
    )
    return taken.unionByName(cut)
