"""Keyed, attribute-style tables, hash-split into shards, on Spark."""

from pigeonhole.scheme import NO_LIMIT, Scheme
from pigeonhole.sources.store import (
    AttributeTable,
    ItemTable,
    NoSuchTable,
    Store,
    TableExists,
)

__all__ = [
    "NO_LIMIT",
    "AttributeTable",
    "ItemTable",
    "NoSuchTable",
    "Scheme",
    "Store",
    "TableExists",
]
