"""Key hash, item-hash text, shard index and hash slices (H1-H3, R2).

The key hash is Jenkins' one-at-a-time hash over the UTF-8 bytes of the key, in 32-bit
wrapping arithmetic. Spark runs in ANSI mode, where 32-bit overflow raises, so every step
works on ``bigint`` and masks back to 32 bits. Everything here is a built-in expression:
no UDF, no Python worker. The hash is evaluated once per written row and stored as
``item_hash``; all later work (resharding, slicing, limits) decodes that text instead of
walking the key bytes again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pigeonhole.columns import int_div, long_lit

# 32-bit hash space, and the range that is divided among the shards.
HASH_MASK = 0xFFFFFFFF
SIGN_OFFSET = 2**31
HASH_RANGE = 2**32 - 1
HASH_DIGITS = 10
# Keys of up to this many bytes are hashed in compiled code by :func:`with_unsigned_hash`.
SHORT_KEY = 12


# -- columns ---------------------------------------------------------------------------


def unsigned_hash(key: Column) -> Column:
    """H1 as an unsigned 32-bit number in a ``bigint``; null for a null key.

    One ``aggregate`` pass over the bytes. ISO-8859-1 maps each byte to one character, so
    ``ascii`` gives unsigned bytes. The accumulator holds the value *before* the xor-shift
    of its step, which lets the next step use it as a lambda variable instead of
    evaluating the step twice. The empty key yields one zero byte, which leaves 0 at 0.
    """
    chars = F.split(F.decode(F.encode(key, "UTF-8"), "ISO-8859-1"), "")
    mask = long_lit(HASH_MASK)

    def settle(acc: Column) -> Column:
        return acc.bitwiseXOR(F.shiftright(acc, 6))

    def step(acc: Column, char: Column) -> Column:
        # x + (x << 10) is x * 1025
        return ((settle(acc) + F.ascii(char)) * long_lit(1025)).bitwiseAND(mask)

    def finish(acc: Column) -> Column:
        # x + (x << 3) is x * 9, x + (x << 15) is x * 32769
        h = (settle(acc) * long_lit(9)).bitwiseAND(mask)
        return (h.bitwiseXOR(F.shiftright(h, 11)) * long_lit(32769)).bitwiseAND(mask)

    return F.aggregate(chars, long_lit(0), step, finish)


def with_unsigned_hash(df: DataFrame, key: Column, name: str) -> DataFrame:
    """The rows with :func:`unsigned_hash` of ``key``, for rows that are written or shuffled next.

    A projection a byte instead of an ``aggregate``, which Spark does not compile: some three times
    as fast for keys of up to ``SHORT_KEY`` bytes; others go the plain way. A filter on the hash
    would be pushed below the projections and grow threefold at each, so use the plain one there.
    """
    mask = long_lit(HASH_MASK)
    chars, size, h = (F.col(c) for c in ("__chars", "__size", name))

    def settle(shift: int) -> Column:
        return h.bitwiseXOR(F.shiftright(h, shift))

    def advanced(step: Column) -> Column:
        return step.bitwiseAND(mask)

    out = df.withColumn("__chars", F.decode(F.encode(key, "UTF-8"), "ISO-8859-1"))
    out = out.withColumn("__size", F.length(chars)).withColumn(name, long_lit(0))
    for i in range(1, SHORT_KEY + 1):
        step = advanced((settle(6) + F.ascii(F.substring(chars, i, 1))) * long_lit(1025))
        out = out.withColumn(name, F.when(size >= i, step).otherwise(h))
    out = out.withColumn(name, advanced(settle(6) * long_lit(9)))
    out = out.withColumn(name, advanced(settle(11) * long_lit(32769)))
    long_key = F.when(size > SHORT_KEY, unsigned_hash(key))
    return out.withColumn(name, F.when(size <= SHORT_KEY, h).otherwise(long_key)).drop("__chars", "__size")


def signed_hash(unsigned: Column) -> Column:
    """The hash as the signed 32-bit integer it stands for."""
    return (
        F.when(unsigned >= long_lit(SIGN_OFFSET), unsigned - long_lit(2**32))
        .otherwise(unsigned)
        .cast("int")
    )


def hash_text(unsigned: Column) -> Column:
    """H2: ``0`` for a negative hash or ``1``, then the magnitude padded to ten digits."""
    negative = unsigned >= long_lit(SIGN_OFFSET)
    magnitude = F.when(negative, long_lit(2**32) - unsigned).otherwise(unsigned)
    return F.concat(
        F.when(negative, F.lit("0")).otherwise(F.lit("1")),
        F.lpad(magnitude.cast("string"), HASH_DIGITS, "0"),
    )


def hash_position(unsigned: Column) -> Column:
    """Distance of the signed hash from the smallest one: 0 .. 2^32 - 1."""
    return (unsigned + long_lit(SIGN_OFFSET)).bitwiseAND(long_lit(HASH_MASK))


def text_position(item_hash: Column) -> Column:
    """:func:`hash_position` recovered from a stored item-hash text."""
    sign = F.when(F.startswith(item_hash, F.lit("0")), long_lit(-1)).otherwise(long_lit(1))
    return F.substring(item_hash, 2, HASH_DIGITS).cast("bigint") * sign + long_lit(SIGN_OFFSET)


def shard_of_position(position: Column, num_shards: int) -> Column:
    """H3: equal hash ranges, the few positions left over by the division in the last one."""
    check_num_shards(num_shards)
    return F.least(
        int_div(position, HASH_RANGE // num_shards), long_lit(num_shards - 1)
    ).cast("int")


def slice_of_position(
    position: Column, shard: Column, num_shards: int, num_slices: int
) -> Column:
    """R2: which of ``num_slices`` equal hash ranges *inside its shard* a row falls into."""
    check_num_shards(num_shards)
    width = HASH_RANGE // num_shards
    start = shard.cast("bigint") * long_lit(width)
    return F.least(
        int_div((position - start) * long_lit(num_slices), width), long_lit(num_slices - 1)
    ).cast("int")


def key_hash(key: Column) -> Column:
    return signed_hash(unsigned_hash(key))


def item_hash(key: Column) -> Column:
    return hash_text(unsigned_hash(key))


def shard_index(key: Column, num_shards: int) -> Column:
    return shard_of_position(hash_position(unsigned_hash(key)), num_shards)


# -- one literal key -------------------------------------------------------------------


def literal_hash(key: str) -> int:
    """The unsigned hash of one key, for building pruning literals on the driver."""
    h = 0
    for byte in key.encode("utf-8"):
        h = (h + byte) * 1025 & HASH_MASK
        h ^= h >> 6
    h = h * 9 & HASH_MASK
    h ^= h >> 11
    return h * 32769 & HASH_MASK


def literal_item_hash(key: str) -> str:
    h = literal_hash(key)
    return f"0{2**32 - h:010d}" if h >= SIGN_OFFSET else f"1{h:010d}"


def literal_shard(key: str, num_shards: int) -> int:
    check_num_shards(num_shards)
    position = (literal_hash(key) + SIGN_OFFSET) & HASH_MASK
    return min(position // (HASH_RANGE // num_shards), num_shards - 1)


def check_num_shards(num_shards: int) -> None:
    if num_shards < 1:
        raise ValueError(f"a table needs at least one shard, got {num_shards}")
