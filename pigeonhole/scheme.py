"""The scheme of a table: ordered field names, one key field, optional query and limit.

Covers sink projection, key validation and text encoding (K4-K6) and the typed read-back
(P3). Everything is stored as text; null is the absence of an attribute.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pigeonhole.columns import field, quoted
from pigeonhole.functions import hashing

NO_LIMIT = -1
# Column names the storage layout uses itself.
RESERVED = ("shard", "num_shards", "slice", "item_hash", "v")

# All text that a cast to an integer type accepts.
INTEGER_TEXT = r"^[\s\p{Cntrl}]*[+-]?[0-9]+[\s\p{Cntrl}]*\z"

_QUOTED_OR_ITEM_NAME = re.compile(
    r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`(?:[^`]|``)*`|\bitemName\s*\(\s*\)""",
    re.IGNORECASE | re.DOTALL,
)


@dataclass(frozen=True)
class Scheme:
    """Field names of a table and which one is the key.

    ``query`` and ``limit`` only matter when reading.
    """

    fields: tuple[str, ...]
    key: str
    query: str = ""
    limit: int = NO_LIMIT

    def __init__(
        self,
        fields: Sequence[str],
        key: str | Sequence[str],
        query: str = "",
        limit: int = NO_LIMIT,
    ):
        names = tuple(fields)
        keys = (key,) if isinstance(key, str) else tuple(key)
        if not names:
            raise ValueError("a scheme needs at least one field")
        if len(keys) != 1:
            raise ValueError(f"a scheme has exactly one key field, got {list(keys)}")
        if keys[0] not in names:
            raise ValueError(f"key field {keys[0]!r} is not among the scheme fields")
        # Spark resolves column names without regard to case.
        lower = [n.lower() for n in names]
        if len(set(lower)) != len(names):
            raise ValueError("scheme fields must differ in more than case")
        clash = sorted(set(lower) & set(RESERVED))
        if clash:
            raise ValueError(f"reserved field names: {clash}")
        object.__setattr__(self, "fields", names)
        object.__setattr__(self, "key", keys[0])
        object.__setattr__(self, "query", clean_query(query))
        object.__setattr__(self, "limit", limit)

    @property
    def attributes(self) -> tuple[str, ...]:
        return tuple(f for f in self.fields if f != self.key)

    def with_query(self, query: str) -> Scheme:
        return replace(self, query=query)

    def with_limit(self, limit: int) -> Scheme:
        return replace(self, limit=limit)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f, T.StringType()) for f in self.fields])

    # -- reading -----------------------------------------------------------------------

    def project(self, df: DataFrame) -> DataFrame:
        """The scheme's fields, in order; a field the rows do not have is null."""
        present = set(df.columns)
        return df.select(
            *[
                field(f) if f in present else F.lit(None).cast("string").alias(f)
                for f in self.fields
            ]
        )

    def where(self, df: DataFrame, query: str | Column | None = None) -> DataFrame:
        """The rows matching a text predicate; ``itemName()`` means the key."""
        if isinstance(query, Column):
            return df.where(query)
        text = self.query if query is None else clean_query(query)
        return df.where(F.expr(bind_item_name(text, self.key))) if text else df

    # -- writing -----------------------------------------------------------------------

    def encode(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """K4-K6: scheme fields only, as text, with a checked key.

        The check is part of the key column itself, so column pruning cannot drop it.
        Columns in ``keep`` pass through untouched.
        """
        cols = [self._checked_key(df) if f == self.key else as_text(df, f) for f in self.fields]
        return df.select(*cols, *[field(c) for c in keep])

    def split_valid(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """K5 without failing: (rows with a usable key, rows without one)."""
        bad = bad_key(field(self.key))
        return df.where(~bad), df.where(bad)

    def _checked_key(self, df: DataFrame) -> Column:
        key = as_text(df, self.key)
        message = F.lit(f"row without a value for the key field {self.key}")
        return F.when(bad_key(key), F.raise_error(message)).otherwise(key).alias(self.key)


def bad_key(key: Column) -> Column:
    return key.isNull() | (F.length(key.cast("string")) == 0)


def as_text(df: DataFrame, name: str) -> Column:
    """A field as text. Nested types have no agreed text form and are refused."""
    data_type = df.schema[name].dataType
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        raise TypeError(f"field {name!r} of type {data_type.simpleString()} has no text form")
    return field(name).cast("string").alias(name)


def typed(df: DataFrame, schema: T.StructType, permissive: bool = False) -> DataFrame:
    """Text columns cast to the declared types; ``permissive`` turns bad text into null."""
    cast = _try_cast if permissive else Column.cast
    return df.select(*[cast(field(f.name), f.dataType).alias(f.name) for f in schema.fields])


def _try_cast(text: Column, data_type: T.DataType) -> Column:
    """``try_cast``, which costs an exception per bad value: most of those are sorted out
    by a pattern first where the target is an integer."""
    value = text.try_cast(data_type)
    return F.when(text.rlike(INTEGER_TEXT), value) if isinstance(data_type, T.IntegralType) else value


def route(df: DataFrame, key: str, num_shards: int, compiled: bool = False) -> DataFrame:
    """Add ``item_hash`` and ``shard``. The hash is evaluated once and used for both.

    ``compiled`` is for rows that are written or shuffled next; see
    :func:`pigeonhole.functions.hashing.with_unsigned_hash`.
    """
    if compiled:
        hashed = hashing.with_unsigned_hash(df, field(key), "__hash")
    else:
        hashed = df.withColumn("__hash", hashing.unsigned_hash(field(key)))
    return hashed.select(
        *[field(c) for c in df.columns],
        hashing.hash_text(F.col("__hash")).alias("item_hash"),
        hashing.shard_of_position(hashing.hash_position(F.col("__hash")), num_shards).alias(
            "shard"
        ),
    )


def clean_query(query: str | None) -> str:
    text = (query or "").strip()
    if text.lower().split(None, 1)[:1] == ["where"]:
        raise ValueError(f"a query must not start with 'where': {text}")
    return text


def bind_item_name(query: str, key: str) -> str:
    """Replace ``itemName()`` by the key field, except inside quoted text."""
    return _QUOTED_OR_ITEM_NAME.sub(
        lambda m: quoted(key) if m.group().lower().startswith("itemname") else m.group(), query
    )
