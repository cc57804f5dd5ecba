"""Small column helpers shared by every module."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """``name`` as a backticked identifier, so any field name can be used."""
    return "`" + name.replace("`", "``") + "`"


def field(name: str, side: str | None = None) -> Column:
    """Column of exactly this name (dots and punctuation included)."""
    return F.col(quoted(name) if side is None else f"{side}.{quoted(name)}")


def long_lit(value: int) -> Column:
    return F.lit(value).cast("bigint")


def int_div(numerator: Column, denominator: Column | int) -> Column:
    """Integer division on bigint, without a detour through double."""
    if isinstance(denominator, int):
        denominator = long_lit(denominator)
    return F.call_function("div", numerator, denominator)
