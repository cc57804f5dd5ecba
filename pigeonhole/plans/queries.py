"""The registered queries: every operator over whole given tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. Queries about durable tables write
to a fresh path in the shared folder of the session first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pigeonhole.functions import hashing, naming, sortable
from pigeonhole.operators import attributes as attrs_ops
from pigeonhole.operators import maintenance, scan, shards, stats, upsert
from pigeonhole.scheme import Scheme, route, typed
from pigeonhole.sources import files
from pigeonhole.sources.store import Store, TableExists

Query = Callable[[SparkSession, str], DataFrame]

N = 20
# Values of an item in one row of the item form; orders have fewer.
VALUES = 1000
ORDERS = Scheme(["id", "customer", "status", "priority"], "id")
PEOPLE = Scheme(["name", "nation", "segment"], "name")


# -- inputs ----------------------------------------------------------------------------


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )


def routed(df: DataFrame, scheme: Scheme, num_shards: int = N) -> DataFrame:
    return route(scheme.encode(df), scheme.key, num_shards)


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent orders lose their customer and get status X; pending ones spawn new items."""
    o = orders(spark, sf_dir)
    changed = o.where("priority = '1-URGENT'").select(
        F.col("id").cast("string").alias("id"),
        F.lit(None).cast("bigint").alias("customer"),
        F.lit("X").alias("status"),
    )
    new = o.where("status = 'P'").select(
        F.concat(F.lit("new-"), F.col("id")).alias("id"), "customer", F.lit("N").alias("status")
    )
    return changed.unionByName(new)


CHANGES = Scheme(["id", "customer", "status"], "id")


def line_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flags, states and suppliers of lines as attributes of their orders, with copies."""
    lines = given(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("state"),
        F.col("l_suppkey").cast("string").alias("supplier"),
    )
    return attrs_ops.to_attributes(lines, "id", ["id", "flag", "state", "supplier"])


def order_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-valued attributes of orders: the flags, states and suppliers of their lines."""
    return line_attributes(spark, sf_dir).distinct()


def order_puts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Puts for all orders: their priority, and a flag whose value is their status."""
    o = orders(spark, sf_dir).select(F.col("id").cast("string").alias("id"), "priority", "status")
    named = o.select("id", "priority", F.col("status").alias("flag"))
    return attrs_ops.to_attributes(named, "id", ["priority", "flag"])


def fresh_store(spark: SparkSession) -> Store:
    return Store(spark, files.scratch_path(spark, "tables"))


# -- H1-H6, M7 -------------------------------------------------------------------------


def item_hash(spark, sf_dir):
    names = given(spark, sf_dir, "customer").select(F.col("c_name").alias("key"))
    urls = given(spark, sf_dir, "pages").select(F.col("url").alias("key"))
    hashed = names.unionByName(urls).withColumn("u", hashing.unsigned_hash(F.col("key")))
    return hashed.select(
        "key",
        hashing.signed_hash(F.col("u")).alias("key_hash"),
        hashing.hash_text(F.col("u")).alias("item_hash"),
    )


def shard_index(spark, sf_dir):
    keys = given(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    placed = keys.withColumn("p", hashing.hash_position(hashing.unsigned_hash(F.col("id"))))
    return placed.select(
        "id",
        *[hashing.shard_of_position(F.col("p"), n).alias(f"of_{n}") for n in (1, 3, 4, 20, 100)],
    )


def shard_names(spark, sf_dir):
    tables = given(spark, sf_dir, "supplier").select(F.col("s_name").alias("table_name"))
    return tables.select(
        "table_name", F.explode(naming.shard_names(F.col("table_name"), 4)).alias("name")
    )


def _name_samples(spark, sf_dir):
    """Good, foreign, malformed and odd shard names, one per customer."""
    c = given(spark, sf_dir, "customer")
    key, table = F.col("c_custkey"), F.col("c_mktsegment")
    number, kind = key % 20 + 1, key % 5
    name = (
        F.when(kind == 0, F.concat(table, F.lit("-x-"), number, F.lit("-of-20")))
        .when(kind == 1, F.concat(table, F.lit("-"), number, F.lit("-of-")))
        .when(kind == 2, F.concat(table, F.lit("-"), number, F.lit("-of-20 ")))
        .otherwise(F.concat(table, F.lit("-"), number, F.lit("-of-20")))
    )
    return c.select(key.alias("id"), table.alias("table_name"), name.alias("name"))


def parse_shard_names(spark, sf_dir):
    name, table = F.col("name"), F.col("table_name")
    return _name_samples(spark, sf_dir).select(
        "id",
        "name",
        naming.shard_number(name).alias("number"),
        naming.shard_count(name).alias("total"),
        naming.shard_number(name, table).alias("number_in_table"),
        naming.shard_count(name, table).alias("total_in_table"),
    )


def _nation_catalog(spark, sf_dir):
    """Shard names of one table per nation: those its customers fall into, of 20.

    Nation 24 claims other totals for some, nation 23 a number beyond the total.
    """
    placed = routed(people(spark, sf_dir), PEOPLE)
    total = F.when((F.col("nation") == "24") & (F.col("shard") > 9), 10).otherwise(20)
    number = F.col("shard") + F.when(F.col("nation") == "23", 2).otherwise(1)
    table = F.concat(F.lit("nation-"), F.col("nation"))
    return placed.select(
        table.alias("table_name"),
        F.concat(table, F.lit("-"), number, F.lit("-of-"), total).alias("name"),
    )


def infer_num_shards(spark, sf_dir):
    return shards.shard_counts(_nation_catalog(spark, sf_dir))


# -- S1, S3, S5, P1, E1-E4, A1, A2 -------------------------------------------------------


def sharded_scan(spark, sf_dir):
    table = fresh_store(spark).write("orders", orders(spark, sf_dir), ORDERS, N)
    return table.matching()


def scheme_projection(spark, sf_dir):
    table = fresh_store(spark).write("orders", orders(spark, sf_dir), ORDERS, N)
    return table.read(Scheme(["status", "id", "clerk"], "id"))


def where_scan(spark, sf_dir):
    table = fresh_store(spark).write("orders", orders(spark, sf_dir), ORDERS, N)
    return table.read(ORDERS.with_query('`status` = "P"'))


def key_like_scan(spark, sf_dir):
    scheme = PEOPLE.with_query("itemName() like 'Customer#%7' and segment != 'itemName()'")
    return scheme.where(scheme.encode(people(spark, sf_dir)))


def text_order_scan(spark, sf_dir):
    scheme = PEOPLE.with_query("nation > '5' and nation between '10' and '7'")
    return scheme.where(scheme.encode(people(spark, sf_dir)))


def item_lookup(spark, sf_dir):
    table = fresh_store(spark).write("people", people(spark, sf_dir), PEOPLE, N)
    return table.lookup("Customer#000000042")


def items_lookup(spark, sf_dir):
    keys = given(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(
        F.format_string("Customer#%09d", "o_custkey").alias("wanted")
    )
    found = scan.items_lookup(routed(people(spark, sf_dir), PEOPLE), "name", keys, N)
    return found.select("name", "nation", "shard")


def balanced_limit(spark, sf_dir):
    found = ORDERS.where(routed(orders(spark, sf_dir), ORDERS), "status = 'P'")
    return scan.balanced_limit(found, "id", N, 1000)


def balanced_limit_scarce(spark, sf_dir):
    found = PEOPLE.where(routed(people(spark, sf_dir), PEOPLE), "nation = '3'")
    return scan.balanced_limit(found, "name", N, 60)


def shard_plan(spark, sf_dir):
    found = PEOPLE.where(routed(people(spark, sf_dir), PEOPLE), "nation = '3'")
    return scan.shard_plan(found, N, 60, "people")


def shard_plan_unlimited(spark, sf_dir):
    found = ORDERS.where(routed(orders(spark, sf_dir), ORDERS), "status = 'P'")
    return scan.shard_plan(found, N, table="orders")


def plain_limit(spark, sf_dir):
    found = ORDERS.where(ORDERS.encode(orders(spark, sf_dir)), "status = 'P'")
    return scan.first_rows(found, "id", 100)


def count_by_shard(spark, sf_dir):
    return scan.count_by_shard(
        ORDERS.where(routed(orders(spark, sf_dir), ORDERS), "status = 'P'")
    )


def count_total(spark, sf_dir):
    return scan.count_items(ORDERS.where(ORDERS.encode(orders(spark, sf_dir)), "status = 'P'"))


def count_capped(spark, sf_dir):
    """A2 of a written table: each shard is read until it has given 700 matches."""
    table = fresh_store(spark).write("orders", orders(spark, sf_dir), ORDERS, N)
    return table.count_by_shard("status != 'P'", 700)


def count_capped_rows(spark, sf_dir):
    """A2 of rows that are not stored by shard."""
    found = ORDERS.where(routed(orders(spark, sf_dir), ORDERS), "status != 'P'")
    return scan.capped_count_by_shard(found, 700)


def table_count(spark, sf_dir):
    """A1 and A2 of a whole written table, with and without a query."""
    table = fresh_store(spark).write("orders", orders(spark, sf_dir), ORDERS, 4)
    asked = [
        ("all", table.count()),
        ("all, up to 100", table.count(limit=100)),
        ("pending", table.count("status = 'P'")),
        ("pending, up to 50", table.count("status = 'P'", 50)),
        ("filled, up to 1000000", table.count("status = 'F'", 1_000_000)),
    ]
    counts = [c.select(F.lit(name).alias("asked"), "items") for name, c in asked]
    return reduce(DataFrame.unionByName, counts)


# -- K1-K6, R5 ---------------------------------------------------------------------------


def upsert_rows(spark, sf_dir):
    existing = routed(orders(spark, sf_dir), ORDERS)
    return upsert.upsert(existing, order_changes(spark, sf_dir), CHANGES, N)


def upsert_null_deletes(spark, sf_dir):
    existing = routed(orders(spark, sf_dir), ORDERS)
    changes = order_changes(spark, sf_dir)
    return upsert.upsert(existing, changes, CHANGES, N, null_deletes=True)


def _event_changes(spark, sf_dir):
    return given(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("status"),
        F.col("props").alias("props"),
        "ts",
        "event_id",
    )


def upsert_dedup(spark, sf_dir):
    """Many events per user: the last non-null values win, merged into orders by key."""
    return upsert.upsert(
        routed(orders(spark, sf_dir), ORDERS),
        _event_changes(spark, sf_dir),
        Scheme(["id", "status", "props"], "id"),
        N,
        order_by=["ts", "event_id"],
    )


def table_update(spark, sf_dir):
    """K1 through files: write, update, read back."""
    store = fresh_store(spark)
    store.write("orders", orders(spark, sf_dir), ORDERS, N)
    return store.write("orders", order_changes(spark, sf_dir), CHANGES, N).matching()


def table_update_bulk(spark, sf_dir):
    """The same in one pass over many changes, without staging them."""
    store = fresh_store(spark)
    store.write("orders", orders(spark, sf_dir), ORDERS, N)
    changes = order_changes(spark, sf_dir)
    return store.write("orders", changes, CHANGES, N, bulk=True).matching()


def table_update_ordered(spark, sf_dir):
    """Upsert of repeated keys through files, into a new table and again into itself."""
    store = fresh_store(spark)
    scheme = Scheme(["id", "status", "props"], "id")
    changes = _event_changes(spark, sf_dir)
    store.write("users", changes, scheme, N, order_by=["ts", "event_id"])
    return store.write("users", changes, scheme, N, order_by=["ts", "event_id"]).read()


def replace_table(spark, sf_dir):
    store = fresh_store(spark)
    store.write("t", people(spark, sf_dir), PEOPLE, 4)
    return store.write("t", orders(spark, sf_dir), ORDERS, N, mode="replace").matching()


def keep_table(spark, sf_dir):
    store = fresh_store(spark)
    table = store.write("t", people(spark, sf_dir), PEOPLE, N, mode="keep")
    try:
        store.write("t", people(spark, sf_dir).where("nation = 3"), PEOPLE, N, mode="keep")
    except TableExists:
        return table.read()
    raise AssertionError("a KEEP write replaced a table")


def key_validation(spark, sf_dir):
    """Orders keyed by a sometimes missing or empty customer segment."""
    c = given(spark, sf_dir, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit(""))
        .otherwise(F.col("c_name"))
        .alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    good, rejected = PEOPLE.split_valid(c)
    return good.withColumn("valid", F.lit(True)).unionByName(
        rejected.withColumn("valid", F.lit(False))
    )


def encode_strings(spark, sf_dir):
    """K6: numbers, booleans and times as text; null attributes are not written."""
    rows = given(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.col("l_linenumber").alias("line"),
        (F.col("l_quantity") > 25).alias("bulk"),
        F.col("l_shipdate").alias("shipped"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
    )
    scheme = Scheme(["id", "line", "bulk", "shipped", "flag"], "id")
    return attrs_ops.to_attributes(scheme.encode(rows), "id", scheme.attributes)


_LINE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("line", T.IntegerType()),
        T.StructField("bulk", T.BooleanType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("flag", T.StringType()),
    ]
)


def _typed_lines(spark, sf_dir):
    return given(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line"),
        (F.col("l_quantity") > 25).alias("bulk"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("flag"),
    )


def typed_roundtrip(spark, sf_dir):
    return typed(Scheme(_LINE.names, "id").encode(_typed_lines(spark, sf_dir)), _LINE)


def typed_permissive(spark, sf_dir):
    """Text that is not a number reads as null when permissive."""
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("flag", T.IntegerType())]
    )
    rows = _typed_lines(spark, sf_dir).select(
        "id",
        F.when(F.col("bulk"), F.col("flag"))
        .otherwise(F.col("line").cast("string"))
        .alias("flag"),
    )
    return typed(Scheme(["id", "flag"], "id").encode(rows), schema, permissive=True)


# -- S2, S4, P2, P4, K7-K12 ----------------------------------------------------------------


def to_long(spark, sf_dir):
    rows = people(spark, sf_dir).withColumn(
        "segment", F.when(F.col("segment") != "BUILDING", F.col("segment"))
    )
    return attrs_ops.to_attributes(PEOPLE.encode(rows), "name", PEOPLE.fields)


def _as_text(column):
    pairs = F.transform(
        F.array_sort(F.map_entries(column)),
        lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ",")),
    )
    return F.array_join(pairs, ";")


def to_item_map(spark, sf_dir):
    items = attrs_ops.item_form(order_attributes(spark, sf_dir), is_set=True, size=VALUES)
    return items.select("item_name", "part", _as_text(F.col("attributes")).alias("attributes"))


def select_items(spark, sf_dir):
    """S2 with a predicate: whole bags of the items whose first flag and state match."""
    attrs = order_attributes(spark, sf_dir)
    scheme = Scheme(["id", "flag", "state"], "id", "flag = 'A' and state != 'F'")
    found = scheme.where(attrs_ops.to_wide(attrs, scheme.key, scheme.fields)).select("id")
    items = attrs_ops.item_form(attrs, is_set=True, among=found, size=VALUES)
    return items.select("item_name", "part", _as_text(F.col("attributes")).alias("attributes"))


_ANY_VALUE = {
    "returned": ("flag", "value = 'R'"),
    "open": ("state", "value = 'O'"),
    "far": ("supplier", "value >= '9'"),
}


def select_any_value(spark, sf_dir):
    """Items any of whose flags is R and any of whose states is O, or with a supplier from 9 on."""
    attrs = order_attributes(spark, sf_dir)
    found = attrs_ops.matching_items(attrs, _ANY_VALUE, "(returned and open) or far")
    items = attrs_ops.item_form(attrs, is_set=True, among=found, size=VALUES)
    return items.select("item_name", "part", _as_text(F.col("attributes")).alias("attributes"))


def item_ranges(spark, sf_dir):
    """S2 with hot items: all lines of a return flag as one item, in parts of 50 values in order."""
    lines = given(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("item_name"),
        F.col("l_linestatus").alias("name"),
        F.concat_ws("-", "l_shipdate", "l_suppkey").alias("value"),
    )
    items = attrs_ops.item_form(lines, size=50)
    return items.select("item_name", "part", _as_text(F.col("attributes")).alias("attributes"))


def item_parts(spark, sf_dir):
    """Items dealt over parts; no value is lost or repeated."""
    items = attrs_ops.item_form(order_attributes(spark, sf_dir), parts=3, is_set=True)
    return items.select("item_name", F.explode("attributes").alias("name", "values")).select(
        "item_name", "name", F.explode("values").alias("value")
    )


def to_wide(spark, sf_dir):
    return attrs_ops.to_wide(
        order_attributes(spark, sf_dir), "id", ["id", "flag", "state", "supplier", "none"]
    )


def first_value(spark, sf_dir):
    """First flag, all suppliers and an attribute that no item has."""
    attrs = order_attributes(spark, sf_dir)
    first = attrs_ops.first_values(attrs, ["flag", "none"])
    items = attrs_ops.item_form(attrs.where("name = 'supplier'"), parts=2, is_set=True)
    suppliers = attrs_ops.values_of(items, "supplier").groupBy("item_name").agg(
        F.array_join(F.array_sort(F.collect_list("value")), ",").alias("suppliers")
    )
    return first.join(suppliers, "item_name", "left").select(
        F.col("item_name").alias("id"), "flag", "suppliers", "none"
    )


def attribute_lookup(spark, sf_dir):
    return attrs_ops.attribute_lookup(order_attributes(spark, sf_dir), "7", "supplier")


def put_append(spark, sf_dir):
    return attrs_ops.put_attributes(order_attributes(spark, sf_dir), order_puts(spark, sf_dir))


def put_replace(spark, sf_dir):
    puts = order_puts(spark, sf_dir).withColumn("replace", F.lit(True))
    return attrs_ops.put_attributes(order_attributes(spark, sf_dir), puts)


def batch_put(spark, sf_dir):
    """Flags are replaced for even orders, added for odd ones."""
    puts = order_puts(spark, sf_dir).withColumn(
        "replace", F.col("item_name").cast("bigint") % 2 == 0
    )
    return attrs_ops.put_attributes(order_attributes(spark, sf_dir), puts)


def _order_conditions(spark, sf_dir):
    """The order has a returned line (even orders) or no state at all (odd)."""
    even = F.col("id") % 2 == 0
    return orders(spark, sf_dir).select(
        F.col("id").cast("string").alias("item_name"),
        F.when(even, "flag").otherwise("state").alias("cond_name"),
        F.when(even, "R").alias("cond_value"),
        even.alias("must_exist"),
    )


def conditional_put(spark, sf_dir):
    puts = order_puts(spark, sf_dir).withColumn("replace", F.lit(True))
    attrs = order_attributes(spark, sf_dir)
    return attrs_ops.conditional_put(attrs, puts, _order_conditions(spark, sf_dir))


def conditional_put_rejected(spark, sf_dir):
    failed = attrs_ops.failed_items(
        order_attributes(spark, sf_dir), _order_conditions(spark, sf_dir)
    )
    return attrs_ops.rejected(order_puts(spark, sf_dir), failed)


def delete_item(spark, sf_dir):
    gone = orders(spark, sf_dir).where("status = 'F'").select(
        F.col("id").cast("string").alias("item_name")
    )
    return attrs_ops.delete_items(order_attributes(spark, sf_dir), gone)


def delete_attribute(spark, sf_dir):
    gone = orders(spark, sf_dir).where("status = 'F'").select(
        F.col("id").cast("string").alias("item_name"),
        F.lit("supplier").alias("name"),
        F.lit(None).cast("string").alias("value"),
    )
    return attrs_ops.delete_attributes(order_attributes(spark, sf_dir), gone)


def delete_value(spark, sf_dir):
    """Flag R goes from all orders, and all states from urgent ones."""
    o = orders(spark, sf_dir).select(F.col("id").cast("string").alias("item_name"), "priority")
    flags = o.select("item_name", F.lit("flag").alias("name"), F.lit("R").alias("value"))
    states = o.where("priority = '1-URGENT'").select(
        "item_name", F.lit("state").alias("name"), F.lit(None).cast("string").alias("value")
    )
    return attrs_ops.delete_attributes(
        order_attributes(spark, sf_dir), flags.unionByName(states)
    )


def table_put(spark, sf_dir):
    """K7/K8 through files: append, then replace flags of even orders."""
    table = fresh_store(spark).create_attributes("attrs", N)
    table.put(line_attributes(spark, sf_dir))
    table.put(
        order_puts(spark, sf_dir).withColumn(
            "replace", F.col("item_name").cast("bigint") % 2 == 0
        )
    )
    return table.attributes()


def _written_attributes(spark, sf_dir):
    table = fresh_store(spark).create_attributes("attrs", N)
    table.put(line_attributes(spark, sf_dir))
    return table


def table_conditional_put(spark, sf_dir):
    """K9 through files: the rejected rows and, without an error, those of the new state."""
    table = _written_attributes(spark, sf_dir)
    puts = order_puts(spark, sf_dir).withColumn("replace", F.lit(True))
    rejected = table.conditional_put(puts, _order_conditions(spark, sf_dir)).drop("replace")
    state = table.attributes().withColumn("error", F.lit(None).cast("string"))
    return state.unionByName(rejected.select(*state.columns))


def table_delete(spark, sf_dir):
    """K11, K12 through files: items of filled orders, flag R, all states of urgent orders."""
    table = _written_attributes(spark, sf_dir)
    o = orders(spark, sf_dir).select(
        F.col("id").cast("string").alias("item_name"), "status", "priority"
    )
    table.delete_items(o.where("status = 'F'").select("item_name"))
    flags = o.select("item_name", F.lit("flag").alias("name"), F.lit("R").alias("value"))
    states = o.where("priority = '1-URGENT'").select(
        "item_name", F.lit("state").alias("name"), F.lit(None).cast("string").alias("value")
    )
    table.delete(flags.unionByName(states))
    return table.attributes()


def table_items(spark, sf_dir):
    """S2 through files: bags of items with an R flag and an O state among their values."""
    table = _written_attributes(spark, sf_dir)
    items = table.select(_ANY_VALUE, "returned and open", size=VALUES)
    return items.select("item_name", "part", _as_text(F.col("attributes")).alias("attributes"))


def table_attribute(spark, sf_dir):
    """S4 through files, and S3: one item's suppliers beside its first flag."""
    table = _written_attributes(spark, sf_dir)
    first = table.read(Scheme(["id", "flag"], "id", "itemName() = '7'")).select("flag")
    return table.attribute("7", "supplier").crossJoin(F.broadcast(first.limit(1)))


def table_stats(spark, sf_dir):
    """M6 of a written table; that a shard's time is there, as the time itself is the run's."""
    table = fresh_store(spark).write("people", people(spark, sf_dir), PEOPLE, N)
    found = table.stats()
    return found.withColumn("modified", F.col("modified").isNotNull())


def table_lookup_few(spark, sf_dir):
    """S3 for a few keys: the customers named like a nation's number times 57, some of them there."""
    table = fresh_store(spark).write("people", people(spark, sf_dir), PEOPLE, N)
    keys = given(spark, sf_dir, "nation").select(
        F.format_string("Customer#%09d", F.col("n_nationkey").cast("int") * 57).alias("wanted")
    )
    return table.lookup_all(keys)


def table_lookup_all(spark, sf_dir):
    """S3 for many keys and K11 on a wide table: urgent orders after filled ones are deleted."""
    table = fresh_store(spark).write("orders", orders(spark, sf_dir), ORDERS, 4)
    table.delete_items(orders(spark, sf_dir).where("status = 'F'").select("id"))
    urgent = orders(spark, sf_dir).where("priority = '1-URGENT'").select("id")
    return table.lookup_all(urgent)


def table_plan(spark, sf_dir):
    """S5 and A1 of a written table."""
    table = fresh_store(spark).write("orders", orders(spark, sf_dir), ORDERS, N)
    plan = table.plan(ORDERS.with_query("status = 'P'").with_limit(500))
    return plan.join(table.count_by_shard().withColumnRenamed("items", "stored"), "shard")


# -- M1-M6 ---------------------------------------------------------------------------------


def create_table(spark, sf_dir):
    """Every shard of a created and then written table, with its item count."""
    store = fresh_store(spark)
    store.create("people", PEOPLE, N)
    table = store.write("people", people(spark, sf_dir), PEOPLE, N)
    counts = stats.every_shard(table.count_by_shard(), N)
    return counts.select(
        naming.shard_name(F.lit("people"), F.col("shard"), N).alias("name"), "items"
    )


def table_exists(spark, sf_dir):
    catalog = _nation_catalog(spark, sf_dir)
    tables = given(spark, sf_dir, "nation").select(
        F.concat(F.lit("nation-"), F.col("n_nationkey")).alias("table_name")
    )
    return shards.tables_exist(catalog.select("name"), tables, N)


def missing_shards(spark, sf_dir):
    catalog = _nation_catalog(spark, sf_dir)
    return shards.missing_shards(catalog.select("name"), catalog, N)


def drop_table(spark, sf_dir):
    """Dropping a table leaves one whose name starts the same; its rows are returned."""
    store = fresh_store(spark)
    store.write("people", people(spark, sf_dir), PEOPLE, 4)
    store.write("people2", people(spark, sf_dir), PEOPLE, 3)
    store.drop("people")
    placed = store.table("people2").rows().withColumn(
        "shard_name", naming.shard_name(F.lit("people2"), F.col("shard"), 3)
    )
    catalog = store.shards().withColumnRenamed("name", "shard_name")
    return placed.join(catalog, "shard_name").select("name", "shard_name")


def list_tables(spark, sf_dir):
    """Shard names of two written tables beside the catalog of the nations' tables."""
    store = fresh_store(spark)
    store.write("people", people(spark, sf_dir), PEOPLE, N)
    store.write("orders", orders(spark, sf_dir), ORDERS, 4)
    listed = store.shards().unionByName(_nation_catalog(spark, sf_dir).select("name"))
    return shards.list_shards(shards.without_table(listed, "nation-1"))


def list_tables_max(spark, sf_dir):
    return shards.list_shards(_nation_catalog(spark, sf_dir).select("name"), 100)


def last_modified(spark, sf_dir):
    """One table per event type, sharded by user; its shards change with their events."""
    events = given(spark, sf_dir, "events").select(
        F.col("event_type").alias("table_name"),
        hashing.shard_index(F.col("user_id").cast("string"), N).alias("shard"),
        "ts",
    )
    per_shard = events.groupBy("table_name", "shard").agg(F.max("ts").alias("modified"))
    return shards.last_modified(per_shard)


def shard_stats(spark, sf_dir):
    rows = people(spark, sf_dir).withColumn(
        "segment", F.when(F.col("segment") != "BUILDING", F.col("segment"))
    )
    return stats.shard_stats(routed(rows, PEOPLE), "name", PEOPLE.attributes)


def shard_stats_modified(spark, sf_dir):
    """M6 with the time of the last change: orders by shard, the newest order of each."""
    rows = given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("changed"),
    )
    return stats.shard_stats(route(rows, "id", N), "id", ["status"], modified="changed")


def attribute_stats(spark, sf_dir):
    placed = route(order_attributes(spark, sf_dir), "item_name", N)
    return stats.attribute_stats(placed)


# -- R1-R4 -----------------------------------------------------------------------------------


def reshard(spark, sf_dir):
    moved = maintenance.reshard(routed(orders(spark, sf_dir), ORDERS), 7)
    return moved.select("id", "item_hash", "shard")


def table_reshard(spark, sf_dir):
    table = fresh_store(spark).write("orders", orders(spark, sf_dir), ORDERS, 4)
    table.reshard(7)
    return table.matching()


def hash_slices(spark, sf_dir):
    sliced = maintenance.by_slice(routed(orders(spark, sf_dir), ORDERS), N, 8)
    return sliced.select("id", "shard", "slice")


def slice_scan(spark, sf_dir):
    """One hash slice of a written table, read by a pushed-down range of item hashes."""
    table = fresh_store(spark).write("orders", orders(spark, sf_dir), ORDERS, 4)
    return table.rows().where(maintenance.slice_filter(1, 2, 4, 3)).select("id", "shard")


def sortable_encode(spark, sf_dir):
    parts = given(spark, sf_dir, "customer")
    exact = F.col("c_acctbal").cast("decimal(18,2)")
    text = sortable.encode_number(exact, 12, 2)
    return parts.select(
        F.col("c_custkey").alias("id"),
        sortable.encode_number(F.col("c_custkey") - 700).alias("key_text"),
        text.alias("balance_text"),
        sortable.decode_number(text, "decimal(18,2)").cast("double").alias("balance"),
        sortable.decode_number(sortable.encode_number(F.col("c_custkey") - 700)).alias("key"),
    )


def sortable_doubles(spark, sf_dir):
    """R3 for doubles: prices and changes of sign of them, ranked in their order by their text."""
    lines = given(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line"),
        (F.col("l_extendedprice") * F.when(F.col("l_linenumber") % 2 == 0, -1.0).otherwise(1.0) / 7)
        .alias("value"),
    )
    coded = lines.withColumn("text", sortable.encode_double(F.col("value")))
    in_order = Window.partitionBy("id").orderBy("text", "line")
    return coded.select(
        "id",
        "line",
        "text",
        sortable.decode_double(F.col("text")).alias("value"),
        F.row_number().over(in_order).cast("bigint").alias("place"),
    )


_DOCS = Scheme(["id", "text", "lang", "source"], "id")


def _documents(spark, sf_dir):
    return _DOCS.encode(
        given(spark, sf_dir, "documents").select(
            F.col("doc_id").alias("id"), "text", "lang", "source"
        )
    )


def capacity_check(spark, sf_dir):
    return maintenance.capacity_violations(
        _documents(spark, sf_dir), "id", _DOCS.attributes, max_item_bytes=20000
    )


def attribute_capacity_check(spark, sf_dir):
    attrs = attrs_ops.to_attributes(_documents(spark, sf_dir), "id", _DOCS.fields)
    return maintenance.attribute_capacity_violations(attrs, max_item_bytes=20000)


def shard_count_check(spark, sf_dir):
    """R4, the shard count: as if every part were a table with three shards per unit of size."""
    tables = given(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("table_name"),
        (F.col("p_size") * 3).cast("bigint").alias("num_shards"),
    )
    return maintenance.shard_count_violations(tables)


# -- the whole flow ----------------------------------------------------------------------------


def contact_flow(spark, sf_dir):
    """Write a table, read up to 1000 pending rows, change them, write them back."""
    store = fresh_store(spark)
    table = store.write("orders", orders(spark, sf_dir), ORDERS, N)
    pending = table.read(ORDERS.with_query('`status` = "P"').with_limit(1000))
    store.write("orders", pending.withColumn("status", F.lit("F")), ORDERS, N)
    return table.rows().groupBy("shard", "status").agg(F.count("*").alias("items"))


QUERIES: dict[str, Query] = {
    "item_hash": item_hash,
    "shard_index": shard_index,
    "shard_names": shard_names,
    "parse_shard_names": parse_shard_names,
    "infer_num_shards": infer_num_shards,
    "sharded_scan": sharded_scan,
    "scheme_projection": scheme_projection,
    "where_scan": where_scan,
    "key_like_scan": key_like_scan,
    "text_order_scan": text_order_scan,
    "item_lookup": item_lookup,
    "items_lookup": items_lookup,
    "balanced_limit": balanced_limit,
    "balanced_limit_scarce": balanced_limit_scarce,
    "shard_plan": shard_plan,
    "shard_plan_unlimited": shard_plan_unlimited,
    "plain_limit": plain_limit,
    "count_by_shard": count_by_shard,
    "count_total": count_total,
    "count_capped": count_capped,
    "count_capped_rows": count_capped_rows,
    "table_count": table_count,
    "upsert": upsert_rows,
    "upsert_null_deletes": upsert_null_deletes,
    "upsert_dedup": upsert_dedup,
    "table_update": table_update,
    "table_update_bulk": table_update_bulk,
    "table_update_ordered": table_update_ordered,
    "replace_table": replace_table,
    "keep_table": keep_table,
    "key_validation": key_validation,
    "encode_strings": encode_strings,
    "typed_roundtrip": typed_roundtrip,
    "typed_permissive": typed_permissive,
    "to_long": to_long,
    "to_item_map": to_item_map,
    "select_items": select_items,
    "select_any_value": select_any_value,
    "item_ranges": item_ranges,
    "item_parts": item_parts,
    "to_wide": to_wide,
    "first_value": first_value,
    "attribute_lookup": attribute_lookup,
    "put_append": put_append,
    "put_replace": put_replace,
    "batch_put": batch_put,
    "conditional_put": conditional_put,
    "conditional_put_rejected": conditional_put_rejected,
    "delete_item": delete_item,
    "delete_attribute": delete_attribute,
    "delete_value": delete_value,
    "table_put": table_put,
    "table_conditional_put": table_conditional_put,
    "table_delete": table_delete,
    "table_items": table_items,
    "table_attribute": table_attribute,
    "table_stats": table_stats,
    "table_lookup_few": table_lookup_few,
    "table_lookup_all": table_lookup_all,
    "table_plan": table_plan,
    "create_table": create_table,
    "table_exists": table_exists,
    "missing_shards": missing_shards,
    "drop_table": drop_table,
    "list_tables": list_tables,
    "list_tables_max": list_tables_max,
    "last_modified": last_modified,
    "shard_stats": shard_stats,
    "shard_stats_modified": shard_stats_modified,
    "attribute_stats": attribute_stats,
    "reshard": reshard,
    "table_reshard": table_reshard,
    "hash_slices": hash_slices,
    "slice_scan": slice_scan,
    "sortable_encode": sortable_encode,
    "sortable_doubles": sortable_doubles,
    "capacity_check": capacity_check,
    "attribute_capacity_check": attribute_capacity_check,
    "shard_count_check": shard_count_check,
    "contact_flow": contact_flow,
}
