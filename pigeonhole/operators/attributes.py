"""Items as bags of multi-valued attributes.

The canonical form is *long*: one row ``(item_name, name, value)`` per attribute value, as
a set. It holds items of any size, spreads over tasks by value, and every operation is a
join or an aggregate. The *item* form (one row with a ``map<string, array<string>>``) and
the *wide* form (one column per field, first value only) are derived from it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pigeonhole.columns import field, int_div
from pigeonhole.operators import ordering
from pigeonhole.sources import files

ITEM = "item_name"
LONG = (ITEM, "name", "value")
# How many rows an item has.
COUNT = "num_values"
# Listed items up to this many are broadcast.
FEW_ITEMS = 100_000
# Fixed value: error code of a put whose condition does not hold.
CONDITION_FAILED = "ConditionalCheckFailed"
# What a conditional put knows of a value, one bit each; lacking is a required one not held.
HELD, PUT, REPLACE, REQUIRED, EXCLUDED, LACKING = 1, 2, 4, 8, 16, 32
# Conditions on up to this many names read the rows of these only.
FEW_NAMES = 256
# What a row says in a change, in the order in which the rows of one value decide about it.
SAYS_GONE, SAYS_DROP, SAYS_PUT, SAYS_HELD = 0, 1, 2, 3


# -- shapes ----------------------------------------------------------------------------


def to_attributes(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Wide text rows to long form; null fields and null keys give no row."""
    names = [field(f) for f in fields if f != key]
    if not names:
        nothing = F.lit(None).cast("string")
        return df.select(
            field(key).alias(ITEM), nothing.alias("name"), nothing.alias("value")
        ).where(F.lit(False))
    return (
        df.unpivot([field(key).alias(ITEM)], names, "name", "value")
        .where(f"value is not null and {ITEM} is not null")
        .select(*LONG)
    )


def to_wide(
    attrs: DataFrame, key: str, fields: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """Long form to one row per item with the first value of every field.

    "First" is the smallest text. ``min`` combines before the shuffle, so neither a huge
    item nor many copies of a value reach one task unreduced. Columns in ``carry`` follow
    from the item (its hash, its shard) and are kept.
    """
    names = [f for f in fields if f != key]
    if names:
        wide = attrs.groupBy(ITEM, *carry).pivot("name", names).agg(F.min("value"))
    else:
        wide = attrs.select(ITEM, *carry).distinct()
    return wide.select(
        *[field(ITEM).alias(f) if f == key else field(f) for f in fields], *carry
    )


def item_form(
    attrs: DataFrame,
    parts: int | None = None,
    is_set: bool = False,
    among: DataFrame | None = None,
    size: int | None = None,
) -> DataFrame:
    """Rows ``(item_name, part, attributes)``, values sorted.

    With ``size``, the values of an item, in the order of name and value, are cut into parts of
    that many: part 0 has the first ``size`` values, and so on; an item of fewer is one row. Items
    are counted first. Those that fit one row are gathered in one exchange; the rows of the others
    are sorted in ranges of item, name and value, so an item may hold any share of them and no
    task or row more than ``size`` values of it.

    With ``parts``, the values of every item are dealt over up to that many rows by their hash.
    Without either, every item is one row with part 0, whatever it holds: only for items known to
    be small. Use :func:`values_of` and :func:`first_values`, or the long form, for answers that
    do not depend on the parts.

    ``is_set`` skips removing repeated rows, for input known to have none. ``among`` (one
    column, items listed once) restricts the result to these items; beside it, a column ``COUNT``
    may say how many rows an item has, so that they are not counted again.
    """
    if size is not None and (parts is not None or size < 1):
        raise ValueError(f"size must be positive and stand alone, got size {size}, parts {parts}")
    attrs = attrs.select(*LONG).where(f"{ITEM} is not null")
    if size is not None:
        if not is_set:
            attrs = attrs.distinct()
        return _sized_form(attrs, among, size)
    if among is not None:
        attrs = attrs.join(among.toDF(ITEM), ITEM, "left_semi")
    if not is_set:
        attrs = attrs.distinct()
    if parts is not None and parts > 1:
        part = F.pmod(F.xxhash64("name", "value"), F.lit(parts))
        placed = attrs.withColumn("part", part.cast("bigint"))
    else:
        placed = attrs.withColumn("part", F.lit(0).cast("bigint"))
    # One shuffle serves both aggregates.
    return _gathered(placed.repartition(ITEM, "part"))


def _gathered(placed: DataFrame) -> DataFrame:
    """Rows with their ``part``, those of an item and part in one task, to the item form."""
    by_name = placed.groupBy(ITEM, "part", "name").agg(
        F.array_sort(F.collect_set("value")).alias("values")
    )
    return by_name.groupBy(ITEM, "part").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "values")))).alias(
            "attributes"
        )
    )


def _sized_form(attrs: DataFrame, among: DataFrame | None, size: int) -> DataFrame:
    """:func:`item_form` of unique rows with a ``size``; ``among`` as there.

    What is known of the items goes to the shared folder: of all, if they are chosen, else of those
    above ``size``. Items above it stay out of the exchange by item.
    """
    spark = attrs.sparkSession
    if among is None or COUNT not in among.columns:
        counts = attrs.groupBy(ITEM).agg(F.count("*").alias(COUNT))
        if among is not None:
            counts = counts.join(among.toDF(ITEM), ITEM, "left_semi")
    else:
        counts = among.select(ITEM, COUNT)
    if among is None:
        counts = counts.where(F.col(COUNT) > size)
    path = files.scratch_path(spark, "counted-items")
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    large = counts.where(F.col(COUNT) > size).select(ITEM)
    chosen, many = counts.select(ITEM), large.count()
    if many > FEW_ITEMS:
        found = attrs if among is None else attrs.join(chosen, ITEM, "left_semi")
        return _ranged(found, size)
    small = attrs.join(F.broadcast(large), ITEM, "left_anti") if many else attrs
    if among is not None:
        few = counts.count() <= FEW_ITEMS
        small = small if few else small.repartition(ITEM)
        small = small.join(_hint(chosen, few), ITEM, "left_semi")
    if among is None or few:
        small = small.repartition(ITEM)
    items = _gathered(small.withColumn("part", F.lit(0).cast("bigint")))
    if many:
        items = items.unionByName(
            _ranged(attrs.join(F.broadcast(large), ITEM, "left_semi"), size)
        )
    return items


def _ranged(attrs: DataFrame, size: int) -> DataFrame:
    placed = ordering.ranked(attrs, [ITEM], ["name", "value"], "part")
    placed = placed.withColumn("part", int_div(F.col("part"), size))
    return _gathered(placed.repartition(ITEM, "part"))


def attribute(attributes: Column, name: str) -> Column:
    """S4 on a row of the item form: its values of one attribute, null if absent."""
    return F.try_element_at(attributes, F.lit(name))


def values_of(items: DataFrame, name: str) -> DataFrame:
    """S4 on the item form, whatever its parts: ``(item_name, value)``, a row per value."""
    return items.select(ITEM, F.explode(attribute(F.col("attributes"), name)).alias("value"))


def first_values(attrs: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per item with the first (smallest) value of each name, null if absent."""
    return attrs.where(f"{ITEM} is not null").groupBy(ITEM).agg(
        *[F.min(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names]
    )


def matching_items(
    attrs: DataFrame,
    conditions: Mapping[str, tuple[str, str | Column]],
    query: str | Column,
    counted: bool = False,
) -> DataFrame:
    """E1 on bags: items (one column) for which ``query`` holds.

    ``conditions`` gives names to tests of single values: ``{"late": ("state", "value > 'D'")}``,
    a Spark SQL expression or a boolean column over ``value``. A test holds for an item if *any* value of the
    attribute passes it. ``query`` combines the names with and, or and not. The tests are
    aggregated per item with partial sums, so an item of any size is one small row. ``counted``
    adds how many rows it has, as ``COUNT``.
    """
    seen = [
        F.coalesce(F.bool_or((F.col("name") == name) & (F.expr(test) if isinstance(test, str) else test)), F.lit(False)).alias(label)
        for label, (name, test) in conditions.items()
    ]
    rows = [F.count("*").alias(COUNT)] if counted else []
    found = attrs.where(f"{ITEM} is not null").groupBy(ITEM).agg(*seen, *rows)
    return found.where(query).select(ITEM, *[COUNT for _ in rows])


def attribute_lookup(attrs: DataFrame, item: str, name: str) -> DataFrame:
    """S4 on the long form: one row per value; no row if absent."""
    return attrs.where((F.col(ITEM) == item) & (F.col("name") == name))


# -- puts ------------------------------------------------------------------------------


def put_attributes(existing: DataFrame, incoming: DataFrame, few: bool = False) -> DataFrame:
    """Add attribute values of many items.

    A boolean column ``replace`` in ``incoming`` marks values that take the place of all
    present values of their item and name; unmarked ones (or all, without the column) are
    added to them. ``few`` says the caller has checked that ``incoming`` is small: it is
    then broadcast and the existing rows are not shuffled.
    """
    # Beside LONG, columns that follow from the item (its hash, its shard) are carried along.
    shared = [c for c in existing.columns if c in incoming.columns]
    incoming = incoming.where("value is not null")
    put = incoming.select(*shared)
    kept = existing.select(*shared)
    if "replace" in incoming.columns:
        replaced = incoming.where("replace").select(ITEM, "name").distinct()
        kept = kept.join(_hint(replaced, few), [ITEM, "name"], "left_anti")
    if not few:
        return kept.unionByName(put).distinct()
    # Present rows equal to a put one give way to it: one pass over the table.
    put = put.distinct()
    return kept.join(F.broadcast(put.select(*LONG)), list(LONG), "left_anti").unionByName(put)


def check_conditions(
    existing: DataFrame, conditions: DataFrame, few: bool = False
) -> DataFrame:
    """The conditions of K9 with a column ``holds``.

    A condition ``(item_name, cond_name, cond_value, must_exist)`` holds if the attribute
    has that value, or, with ``must_exist`` false, if the item has no such attribute.

    The existing rows are read once. A row counts for its attribute's presence and, if some
    condition asks for its value, for that value; both are partial sums per item and
    attribute, so an attribute with very many values makes no large partition. ``few`` (size
    checked by the caller) first reduces the existing rows by a broadcast.
    """
    asked = conditions.select(ITEM, "cond_name", "cond_value", "must_exist").distinct()
    state = existing.select(field(ITEM), F.col("name").alias("cond_name"), "value")
    if few:
        pairs = asked.select(ITEM, "cond_name").distinct()
        state = state.join(F.broadcast(pairs), [ITEM, "cond_name"], "left_semi")
    by = [ITEM, "cond_name", "cond_value"]
    # Rows of the table by value, once more as "any value", and the conditions beside them.
    keys = F.explode(F.array("value", F.lit(None).cast("string"))).alias("cond_value")
    present = state.select(ITEM, "cond_name", keys, F.lit(True).alias("__have")).distinct()
    wanted = asked.select(
        ITEM, "cond_name", F.when(F.col("must_exist"), F.col("cond_value")).alias("cond_value"),
        F.col("cond_value").alias("__value"), "must_exist", F.lit(False).alias("__have"),
    )
    both = wanted.unionByName(present, allowMissingColumns=True)
    grouped = both.groupBy(*by).agg(
        F.bool_or("__have").alias("__hit"),
        F.collect_set(
            F.when(
                F.col("must_exist").isNotNull(),
                F.struct(F.col("__value").alias("v"), F.col("must_exist").alias("m")),
            )
        ).alias("__asked"),
    )
    one = grouped.select(ITEM, "cond_name", "__hit", F.explode("__asked").alias("c"))
    must = F.col("c.m")
    # A required null value matches nothing.
    holds = F.when(must, F.col("__hit") & F.col("c.v").isNotNull()).otherwise(~F.col("__hit"))
    return one.select(
        ITEM, "cond_name", F.col("c.v").alias("cond_value"), must.alias("must_exist"),
        holds.alias("holds"),
    )


def among_names(names: DataFrame) -> Column | None:
    """Whether the ``name`` of a row, null too, is one of these (one column); None if they are many."""
    found = names.distinct().limit(FEW_NAMES + 1).collect()  # bounded
    if len(found) > FEW_NAMES:
        return None
    listed = F.col("name").isin([r[0] for r in found if r[0] is not None])
    unnamed = F.lit(any(r[0] is None for r in found))
    return F.when(F.col("name").isNull(), unnamed).otherwise(listed)


def failed_items(existing: DataFrame, conditions: DataFrame, few: bool = False) -> DataFrame:
    """Items of K9 with a condition that does not hold, each once.

    Unless ``few``, only the present rows of attributes that are asked about (where these have
    few names) go through the exchange, each once and as it is.
    """
    if few:
        held = check_conditions(existing, conditions, few)
        return held.where("not holds").select(ITEM).distinct()
    named = among_names(conditions.select("cond_name"))
    if named is not None:
        existing = existing.where(named)
    state = existing.select(*LONG, F.lit(HELD).alias("marks"))
    marked = state.unionByName(_asked(conditions.where("must_exist is not null")))
    values = marked.where(f"{ITEM} is not null").groupBy(*LONG).agg(F.bit_or("marks").alias("marks"))
    return _of_names(values).where(_fails()).select(ITEM).distinct()


def conditional_put(
    existing: DataFrame, incoming: DataFrame, conditions: DataFrame
) -> DataFrame:
    """K9: the state after putting the items all of whose conditions hold, in one read of each input.

    State, puts and conditions become rows of one shape, and one exchange by item, name and value
    brings together what concerns a value: whether it is held, put, replacing, required. From
    these follows for every attribute whether a condition on it fails, hence for every item
    whether its puts are refused, and each value then stays, goes or comes. The exchange is made
    once and read by both steps; values are unique in it, attributes come after partial sums, and
    the last join, by item and name, is open to splitting, so no attribute has to fit a task.

    Items without a condition are put; rows without an item or a name are nothing. Columns that both ``existing`` and ``incoming`` have (the
    item's hash, its shard) are carried along. ``replace`` as in :func:`put_attributes`.
    """
    carried = [c for c in existing.columns if c in incoming.columns and c not in LONG]
    replacing = F.coalesce(F.col("replace"), F.lit(False)) if "replace" in incoming.columns else F.lit(False)
    same = [*LONG, *carried]
    put = F.when(replacing, F.lit(PUT | REPLACE)).otherwise(F.lit(PUT))
    asked = _asked(conditions)
    marked = (
        existing.select(*same, F.lit(HELD).alias("marks"))
        .unionByName(incoming.where("value is not null").select(*same, put.alias("marks")))
        .unionByName(asked, allowMissingColumns=True)
        # Said here, for all, what joins below imply for one side: the exchange is then the same.
        .where(f"{ITEM} is not null and name is not null")
    )
    # What follows from the item is null in conditions; the others agree on it.
    values = marked.groupBy(*LONG).agg(
        F.bit_or("marks").alias("marks"), *[F.max(c).alias(c) for c in carried]
    )

    names = _of_names(values)
    refused = names.where(_fails()).select(ITEM).distinct().withColumn("refused", F.lit(True))
    decided = (
        names.where(_has(PUT))
        .join(refused, ITEM, "left")
        .where("refused is null")
        .select(ITEM, "name", _has(REPLACE).alias("replaced"))
    )
    accepted = F.col("replaced").isNotNull()
    stays = _has(HELD) & ~F.coalesce(F.col("replaced"), F.lit(False))
    comes = _has(PUT) & accepted
    return values.join(decided, [ITEM, "name"], "left").where(stays | comes).select(*same)


def rejected(incoming: DataFrame, failed: DataFrame, few: bool = False) -> DataFrame:
    """K9: the incoming rows of the items from :func:`failed_items`, with an ``error`` column."""
    return incoming.join(_hint(failed, few), ITEM, "left_semi").withColumn(
        "error", F.lit(CONDITION_FAILED)
    )


def _asked(conditions: DataFrame) -> DataFrame:
    """Conditions as marked rows."""
    wanted = F.when(F.col("must_exist"), F.lit(REQUIRED)).otherwise(F.lit(EXCLUDED))
    # A required null is a value that nothing holds.
    value = F.when(F.col("must_exist"), F.col("cond_value")).alias("value")
    return conditions.select(ITEM, F.col("cond_name").alias("name"), value, wanted.alias("marks"))


def _of_names(values: DataFrame) -> DataFrame:
    """What is known of attributes, from what is known of their values."""
    lacking = F.when(_has(REQUIRED) & ~_has(HELD), F.lit(LACKING)).otherwise(F.lit(0))
    return values.groupBy(ITEM, "name").agg(
        F.bit_or(F.col("marks").bitwiseOR(lacking)).alias("marks")
    )


def _fails() -> Column:
    return _has(LACKING) | (_has(EXCLUDED) & _has(HELD))


def _has(mark: int) -> Column:
    return F.col("marks").bitwiseAND(F.lit(mark)) != 0


# -- deletes ---------------------------------------------------------------------------


def delete_items(existing: DataFrame, items: DataFrame, few: bool = False) -> DataFrame:
    """Drop all rows of the listed items (column ``item_name``)."""
    gone = items.select(ITEM).distinct()
    return existing.join(_hint(gone, few), ITEM, "left_anti")


def delete_attributes(existing: DataFrame, deletions: DataFrame, few: bool = False) -> DataFrame:
    """Drop attributes ``(item_name, name, value)``; a null value drops all values.

    An item none of whose values is left is gone.
    """
    all_values = deletions.where("value is null").select(ITEM, "name").distinct()
    one_value = deletions.where("value is not null").select(*LONG).distinct()
    # Rows are unique in item, name and value, so the first join has no large groups. The
    # second may, and is last: nothing relies on its partitioning, so adaptive execution
    # is free to split them.
    return existing.join(_hint(one_value, few), list(LONG), "left_anti").join(
        _hint(all_values, few), [ITEM, "name"], "left_anti"
    )


# -- many changes ----------------------------------------------------------------------
#
# State and change as rows of one shape, ``(item_name, name, value, says)`` and what follows from
# the item. Where rows of an item may be in several tasks, the rows without a value, which speak of
# a whole attribute or item, are to be in each. Each step below is without an exchange of state.


def said_by_puts(incoming: DataFrame, dense: bool = True) -> DataFrame:
    """K7, K8, K10, many: see :func:`put_attributes`.

    Where puts are ``dense``, with many to an attribute or copies, what is equal is combined first;
    else it is left to :func:`decided`, which takes copies as one.
    """
    carried = [c for c in incoming.columns if c not in (*LONG, "replace")]
    incoming = incoming.where("value is not null")
    if dense:
        incoming = incoming.distinct()
    said = incoming.select(*LONG, *carried, F.lit(SAYS_PUT).alias("says"))
    if "replace" not in incoming.columns:
        return said
    replaced = incoming.where("replace and name is not null").select(ITEM, "name", *carried)
    return said.unionByName(_all_gone(replaced.distinct() if dense else replaced))


def said_by_item_deletions(items: DataFrame) -> DataFrame:
    """K11, many, items listed once: see :func:`delete_items`."""
    return _all_gone(items.withColumn("name", F.lit(None).cast("string")))


def said_by_deletions(deletions: DataFrame) -> DataFrame:
    """K12, many, deletions listed once: see :func:`delete_attributes`."""
    named = deletions.where("name is not null")
    dropped = named.where("value is not null").withColumn("says", F.lit(SAYS_DROP))
    return dropped.unionByName(_all_gone(named.where("value is null").drop("value")))


def _all_gone(rows: DataFrame) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return rows.withColumns({"value": nothing, "says": F.lit(SAYS_GONE)})


def decided(said: DataFrame, dealt: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The rows that are there after a change.

    The rows of an item are together in ``dealt``, by which the tasks are dealt. A row without a
    value speaks of all present rows with its ``by``, and comes first there; of the rows of one
    value the first decides. One sort, which a write can use, and one pass.
    """
    rest = [c for c in LONG if c not in by]
    place = W.partitionBy(*dealt, *by).orderBy(*rest, "says")
    before = F.lag(F.struct("says", "name", "value")).over(place)
    first = F.first("says").over(place.rowsBetween(W.unboundedPreceding, W.currentRow))
    seen = said.withColumns({"__before": before, "__first": first})
    repeated = (
        F.col("__before").isNotNull()
        & F.col("__before.name").eqNullSafe(F.col("name"))
        & F.col("__before.value").eqNullSafe(F.col("value"))
    )
    stays = (F.col("says") == SAYS_HELD) & (F.col("__first") != SAYS_GONE)
    there = F.col("value").isNotNull() & ~repeated & (stays | (F.col("says") == SAYS_PUT))
    return seen.where(there).drop("__before", "__first", "says")


def _hint(df: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(df) if few else df
