"""Questions about a catalog of shard names (M2, M4, M5, M7).

A catalog is any DataFrame with a column ``name`` of shard names, as listed by
:meth:`pigeonhole.sources.store.Store.shards` or taken from elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pigeonhole.functions import naming

# What can be wrong with the shards of a table.
NO_SUCH_NUMBER = "shard number out of range"
DIFFERENT_COUNTS = "shards with different total counts"
MISSING = "missing shard"


def list_shards(catalog: DataFrame, limit: int | None = None) -> DataFrame:
    """M4: shard names in name order, at most ``limit`` of them."""
    names = catalog.select("name").distinct()
    return names if limit is None else names.orderBy("name").limit(limit)


def shard_counts(catalog: DataFrame) -> DataFrame:
    """M7 for all tables: ``(table_name, num_shards, problem, first_missing)``.

    ``num_shards`` is null and ``problem`` says why if the shards of a table do not agree.
    Names that are not shard names are ignored; repeated names count once.
    """
    parts = (
        catalog.select(
            naming.shard_table(F.col("name")).alias("table_name"),
            naming.shard_number(F.col("name")).alias("number"),
            naming.shard_count(F.col("name")).alias("total"),
        )
        .where("table_name is not null")
        .distinct()
    )
    # A number is absent after one whose successor in order is neither it nor the next. Window
    # and aggregate use one partitioning; a table has no more rows than shard names.
    in_order = W.partitionBy("table_name").orderBy("number", "total")
    after = F.lead("number").over(in_order)
    stepped = parts.withColumn("after", after)
    gap = F.col("after").isNull() | (F.col("after") > F.col("number") + 1)
    seen = stepped.groupBy("table_name").agg(
        F.min("total").alias("low"),
        F.max("total").alias("high"),
        F.min("number").alias("first"),
        F.count("*").alias("found"),
        F.max(F.expr("number > total")).alias("beyond"),
        F.min(F.when(gap, F.col("number") + 1)).alias("gap"),
    )
    problem = (
        F.when((F.col("first") < 1) | F.col("beyond"), F.lit(NO_SUCH_NUMBER))
        .when(F.col("low") != F.col("high"), F.lit(DIFFERENT_COUNTS))
        .when(F.col("found") < F.col("low"), F.lit(MISSING))
    )
    missing = F.when(F.col("first") > 1, F.lit(1)).otherwise(F.col("gap"))
    return seen.withColumn("problem", problem).select(
        "table_name",
        F.when(F.col("problem").isNull(), F.col("low")).alias("num_shards"),
        "problem",
        F.when(F.col("problem") == MISSING, missing).alias("first_missing"),
    )


def infer_num_shards(catalog: DataFrame, table: str) -> int:
    """M7 for one table: its shard count, 0 if it has no shards, an error if they disagree."""
    mine = catalog.where(naming.shard_table(F.col("name")) == table)
    row = shard_counts(mine).first()
    if row is None:
        return 0
    if row.problem is not None:
        detail = f" #{row.first_missing}" if row.first_missing is not None else ""
        raise ValueError(f"table {table}: {row.problem}{detail}")
    return row.num_shards


def missing_shards(catalog: DataFrame, tables: DataFrame, num_shards: int) -> DataFrame:
    """M2: expected shard names ``(table_name, name)`` that the catalog does not list."""
    expected = tables.select("table_name").distinct().select(
        "table_name", F.explode(naming.shard_names(F.col("table_name"), num_shards)).alias("name")
    )
    return expected.join(catalog.select("name").distinct(), "name", "left_anti").select(
        "table_name", "name"
    )


def tables_exist(catalog: DataFrame, tables: DataFrame, num_shards: int) -> DataFrame:
    """M2 for many tables: ``(table_name, table_exists)``, true if every shard is listed."""
    asked = tables.select("table_name").distinct()
    incomplete = missing_shards(catalog, asked, num_shards).select("table_name").distinct()
    incomplete = incomplete.withColumn("__missing", F.lit(True))
    return asked.join(incomplete, "table_name", "left").select(
        "table_name", F.col("__missing").isNull().alias("table_exists")
    )


def without_table(catalog: DataFrame, table: str) -> DataFrame:
    """M3 on a catalog: everything but the shards of exactly this table."""
    owner = naming.shard_table(F.col("name"))
    return catalog.where(owner.isNull() | (owner != table))


def last_modified(shards: DataFrame) -> DataFrame:
    """M5: latest ``modified`` per ``table_name`` over its shards."""
    return shards.groupBy("table_name").agg(F.max("modified").alias("modified"))
