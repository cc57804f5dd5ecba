"""Merging incoming rows into a table's rows by key.

Rows are routed wide rows: scheme fields as text, ``item_hash``, ``shard``. Attributes the
incoming rows do not have as a column are left alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pigeonhole.columns import field, int_div, long_lit
from pigeonhole.functions import hashing
from pigeonhole.scheme import Scheme, route

ROUTING = ("item_hash", "shard")
SLICED = (*ROUTING, "slice")
# Bits of the map of incoming hashes; broadcast as up to 2^20 words, some 30 MB.
MET_BITS = 1 << 26


def latest_by_key(
    df: DataFrame, key: str, order_by: Sequence[str], null_deletes: bool = False
) -> DataFrame:
    """One row per key: the last non-null value of every attribute in the given order.

    With ``null_deletes`` a null counts as a value, so the last one wins even if null.
    Equal order values are settled by the attribute value, so the result is well defined.
    ``max_by`` is combined before the shuffle: a key with very many rows is reduced to one
    row per task first. Columns of ``order_by`` are dropped unless they are attributes.
    """
    order = [field(c) for c in order_by]
    attributes = [c for c in df.columns if c != key and c not in order_by]

    def last(name: str) -> Column:
        rank = F.struct(*order, field(name).alias("__tie"))
        if not null_deletes:
            rank = F.when(field(name).isNotNull(), rank)
        return F.max_by(field(name), rank).alias(name)

    return df.groupBy(field(key).alias(key)).agg(*[last(c) for c in attributes])


def single_by_key(df: DataFrame, key: str) -> DataFrame:
    """The rows unchanged, failing the job if a key occurs twice."""
    others = [c for c in df.columns if c != key]
    grouped = df.groupBy(field(key).alias(key)).agg(
        F.count("*").alias("__rows"), *[F.first(field(c)).alias(c) for c in others]
    )
    return grouped.select(_once(key), *[field(c) for c in others])


def _once(key: str) -> Column:
    """The key, or an error if ``__rows`` counts more than one row of it."""
    message = F.concat(F.lit("key occurs more than once in one write: "), field(key))
    checked = F.when(F.col("__rows") <= 1, field(key)).otherwise(F.raise_error(message))
    return checked.alias(key)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; only the key column is read and shuffled."""
    return df.groupBy(field(key).alias(key)).agg(F.count("*").alias("rows")).where("rows > 1")


def merge(
    existing: DataFrame, incoming: DataFrame, key: str, null_deletes: bool = False
) -> DataFrame:
    """K1 as one full outer join on the key; both sides must hold a key once.

    Spark shuffles each side once. Keys are unique on both sides, so no key can make a
    partition large.
    """
    joined = existing.alias("o").join(
        incoming.alias("n"), field(key, "o") == field(key, "n"), "full_outer"
    )
    return joined.select(*_merged_columns(existing, incoming, key, null_deletes))


def merge_few(
    existing: DataFrame, incoming: DataFrame, key: str, null_deletes: bool = False
) -> DataFrame:
    """K1 when ``incoming`` is known to be small: it is broadcast, the table never shuffled.

    Same rows as :func:`merge`. Updated rows come from a left join against the broadcast
    side; new rows are the incoming ones whose key a key-only scan did not meet. The
    caller has to check the size of ``incoming`` first.
    """
    few = F.broadcast(incoming)
    updated = (
        existing.alias("o")
        .join(few.alias("n"), field(key, "o") == field(key, "n"), "left_outer")
        .select(*_merged_columns(existing, incoming, key, null_deletes))
    )
    met = existing.select(field(key)).join(
        F.broadcast(incoming.select(field(key))), key, "left_semi"
    )
    # `met` is a subset of the keys of `incoming`, hence no larger than it.
    new = incoming.join(F.broadcast(met), key, "left_anti")
    return updated.unionByName(new, allowMissingColumns=True).select(
        *[field(c) for c in updated.columns]
    )


def merge_sliced(
    existing: DataFrame,
    incoming: DataFrame,
    key: str,
    null_deletes: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """K1 in one shuffle, for rows that are to be written by shard and slice.

    Both sides carry a ``slice`` (see :func:`pigeonhole.operators.maintenance.hash_slices`).
    Their union is partitioned by shard and slice; the group-by on shard, slice, hash and
    key is satisfied by that, and so is a write that wants slices together, in the order
    the group-by leaves them. A key has at most one old and one new row (a second new one
    fails the job), and keys are spread evenly over slices by their hash. Each side is
    evaluated once. ``partitions`` is the number of shuffle partitions, if not the
    session's.
    """
    fields = [c for c in existing.columns if c not in SLICED]
    fields += [c for c in incoming.columns if c not in fields and c not in SLICED]
    both = existing.withColumn("__new", F.lit(False)).unionByName(
        incoming.withColumn("__new", F.lit(True)), allowMissingColumns=True
    )
    written = set(incoming.columns)

    def pick(name: str) -> Column:
        old = F.max(F.when(~F.col("__new"), field(name)))
        if name not in written:
            return old.alias(name)
        new = F.max(F.when(F.col("__new"), field(name)))
        if null_deletes:
            return F.when(F.max("__new"), new).otherwise(old).alias(name)
        return F.coalesce(new, old).alias(name)

    spread = ["shard", "slice"] if partitions is None else [partitions, "shard", "slice"]
    return (
        both.repartition(*spread)
        .groupBy("shard", "slice", "item_hash", field(key).alias(key))
        .agg(
            F.count_if("__new").alias("__rows"), *[pick(c) for c in fields if c != key]
        )
        .select(
            *[_once(key) if c == key else field(c) for c in fields], *SLICED
        )
    )


def met(existing: DataFrame, incoming: DataFrame, bits: int = MET_BITS) -> DataFrame:
    """Routed existing rows with ``met``: false only if no incoming row has their key.

    The hash positions of the incoming rows set bits of a map of ``bits`` bits, which is kept in
    words of 64 and broadcast: at most ``bits`` / 64 rows of two numbers, and no more than there
    are incoming rows. A row whose bit is not set cannot be met.
    """

    def place(rows: DataFrame) -> Column:
        return hashing.text_position(field("item_hash")) % bits

    position = incoming.select(place(incoming).alias("p"))
    words = position.groupBy(int_div(F.col("p"), 64).alias("__word")).agg(
        F.bit_or(F.call_function("shiftleft", long_lit(1), (F.col("p") % 64).cast("int"))).alias("__bits")
    )
    marked = existing.withColumn("__word", int_div(place(existing), 64))
    joined = marked.join(F.broadcast(words), "__word", "left")
    hit = F.getbit(F.col("__bits"), (place(existing) % 64).cast("int")) == 1
    return joined.withColumn("met", F.coalesce(hit, F.lit(False))).drop("__word", "__bits")


def settle(
    df: DataFrame,
    scheme: Scheme,
    num_shards: int,
    order_by: Sequence[str] | None = None,
    null_deletes: bool = False,
) -> DataFrame:
    """Raw rows to routed rows with one row per key.

    With ``order_by`` repeated keys are combined, otherwise they fail the job. Routing
    comes after, so a key is hashed once however often it occurs.
    """
    if order_by:
        hidden = {f"__order{i}": field(c) for i, c in enumerate(order_by)}
        rows = latest_by_key(
            scheme.encode(df.withColumns(hidden), keep=list(hidden)),
            scheme.key,
            list(hidden),
            null_deletes,
        )
    else:
        rows = single_by_key(scheme.encode(df), scheme.key)
    return route(rows, scheme.key, num_shards)


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    scheme: Scheme,
    num_shards: int,
    order_by: Sequence[str] | None = None,
    null_deletes: bool = False,
) -> DataFrame:
    """K1/R5 from raw incoming rows into routed existing rows."""
    rows = settle(incoming, scheme, num_shards, order_by, null_deletes)
    return merge(existing, rows, scheme.key, null_deletes)


def _merged_columns(
    existing: DataFrame, incoming: DataFrame, key: str, null_deletes: bool
) -> list[Column]:
    old, new = set(existing.columns), set(incoming.columns)
    hit = field(key, "n").isNotNull()

    def pick(name: str) -> Column:
        if name not in new:
            return field(name, "o").alias(name)
        if name not in old:
            return field(name, "n").alias(name)
        if null_deletes and name != key and name not in ROUTING:
            chosen = F.when(hit, field(name, "n")).otherwise(field(name, "o"))
        else:
            chosen = F.coalesce(field(name, "n"), field(name, "o"))
        return chosen.alias(name)

    names = [c for c in existing.columns if c not in ROUTING]
    names += [c for c in incoming.columns if c not in old and c not in ROUTING]
    return [pick(c) for c in names] + [pick(c) for c in ROUTING if c in old | new]
