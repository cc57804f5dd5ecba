import plans
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pigeonhole import NoSuchTable, Scheme, TableExists
from pigeonhole.scheme import typed
from pigeonhole.sources import files
from pigeonhole.sources import store as store_module

KV = Scheme(["key", "value"], "key")


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "key string, value string")


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


def total(stats, name):
    return stats.agg(F.sum(name)).first()[0]


def test_dropped_field_and_statistics(store, made):
    source = made(["key", "rank", "value", "extra"], 10)
    scheme = Scheme(["key", "rank", "value"], "key")
    table = store.write("t", source, scheme, 4)
    stats = table.stats()
    assert stats.count() == 4
    assert total(stats, "items") == 10
    assert total(stats, "attribute_values") == 30
    assert total(stats, "attribute_values_bytes") == 360
    assert as_set(table.read()) == as_set(source.select("key", "rank", "value"))


def test_update_replaces_a_value(store, spark):
    store.write("t", pairs(spark, ("key-0", "value-0")), KV, 1)
    table = store.write("t", pairs(spark, ("key-0", "value-1")), KV, 1)
    assert as_set(table.read()) == [("key-0", "value-1")]


def test_two_writes_add_up(store, spark):
    store.write("t", pairs(spark, ("key-0", "value-0")), KV, 1)
    table = store.write("t", pairs(spark, ("key-1", "value-1")), KV, 1)
    row = table.stats().first()
    assert (row["items"], row["attribute_values"], row["attribute_values_bytes"]) == (2, 4, 36)
    assert as_set(table.lookup("key-1")) == [("key-1", "value-1")]


def test_write_then_read(store, made):
    source = made(["key", "value"], 100)
    table = store.write("t", source, KV, 1)
    assert as_set(table.read()) == as_set(source)


def test_type_round_trip(store, spark):
    schema = T.StructType(
        [
            T.StructField("key", T.StringType()),
            T.StructField("booleanValue", T.BooleanType()),
            T.StructField("intValue", T.IntegerType()),
            T.StructField("longValue", T.LongType()),
            T.StructField("doubleValue", T.DoubleType()),
        ]
    )
    source = spark.createDataFrame([("key", True, 100, 2**63 - 1, 1.0)], schema)
    table = store.write("t", source, Scheme(schema.names, "key"), 1)
    assert [f.dataType for f in table.read().schema.fields] == [T.StringType()] * 5
    assert typed(table.read(), schema).collect() == source.collect()


def test_limit_over_shards(store, made):
    table = store.write("t", made(["key", "value"], 10), KV, 5)
    assert table.read(KV.with_limit(2)).count() == 2
    assert table.read(KV.with_limit(10)).count() == 8  # what the quotas give
    assert table.read(KV).count() == 10


def test_key_predicate_with_special_names(store, made):
    fields = ["key-<&;>", "value-<&;>"]
    scheme = Scheme(fields, fields[0], "itemName() like 'key-<&;>-value-1%'")
    table = store.write("t", made(fields, 11), scheme, 1)
    assert [r[0] for r in as_set(table.read(scheme))] == ["key-<&;>-value-1", "key-<&;>-value-10"]


def test_readme_flow(store, spark):
    people = spark.range(5000).select(
        F.concat(F.lit("p"), "id").alias("name"),
        F.lit("1980-01-01").alias("birthday"),
        F.lit("clerk").alias("occupation"),
        F.when(F.col("id") % 2 == 0, "NOT_CONTACTED").otherwise("DONE").alias("status"),
    )
    scheme = Scheme(["name", "birthday", "occupation", "status"], "name")
    table = store.write("people", people, scheme, 20)
    wanted = scheme.with_query('`status` = "NOT_CONTACTED"').with_limit(1000)
    batch = table.read(wanted)
    assert batch.count() == 1000
    store.write("people", batch.withColumn("status", F.lit("CONTACTED")), scheme, 20)
    counts = {r["status"]: r["count"] for r in table.read().groupBy("status").count().collect()}
    assert counts == {"CONTACTED": 1000, "NOT_CONTACTED": 1500, "DONE": 2500}


def test_modes(store, spark):
    store.write("t", pairs(spark, ("a", "1"), ("b", "2")), KV, 3)
    with pytest.raises(TableExists):
        store.write("t", pairs(spark, ("c", "3")), KV, 3, mode="keep")
    table = store.write("t", pairs(spark, ("c", "3")), KV, 2, mode="replace")
    assert as_set(table.read()) == [("c", "3")]
    assert table.manifest().num_shards == 2
    with pytest.raises(ValueError, match="unknown mode"):
        store.write("t", pairs(spark), KV, 2, mode="append")
    with pytest.raises(ValueError, match="exists with 2 shards"):
        store.write("t", pairs(spark), KV, 5)


def test_failed_write_changes_nothing(store, spark):
    table = store.write("t", pairs(spark, ("a", "1")), KV, 3)
    for bad in [(None, "x"), ("", "x")]:
        for mode in ["update", "replace"]:
            with pytest.raises(PySparkException, match="key field"):
                store.write("t", pairs(spark, ("b", "2"), bad), KV, 3, mode=mode)
    for mode in ["update", "replace"]:
        with pytest.raises((ValueError, PySparkException), match="more than once"):
            store.write("t", pairs(spark, ("b", "2"), ("b", "3")), KV, 3, mode=mode)
    assert as_set(table.read()) == [("a", "1")]
    assert table.manifest().number == 1


def test_repeated_keys_with_an_order(store, spark):
    rows = spark.createDataFrame(
        [("a", "1", None, 1), ("a", None, "y", 3), ("a", "2", "x", 2), ("b", None, "z", 1)],
        "key string, p string, q string, at int",
    )
    scheme = Scheme(["key", "p", "q"], "key")
    table = store.write("t", rows, scheme, 4, order_by=["at"])
    assert as_set(table.read().where("key = 'a'")) == [("a", "2", "y")]
    table.update(rows.where("at = 3"), scheme, order_by=["at"], null_deletes=True)
    assert table.read().where("key = 'a'").first()["p"] is None


@pytest.mark.parametrize("few_bytes,bulk", [(0, False), (1 << 30, False), (0, True)])
def test_update_leaves_other_attributes_alone(store, spark, monkeypatch, few_bytes, bulk):
    monkeypatch.setattr(store_module, "FEW_BYTES", few_bytes)
    base = spark.range(200).select(
        F.concat(F.lit("k"), "id").alias("key"), F.lit("a").alias("p"), F.lit("b").alias("q")
    )
    table = store.write("t", base, Scheme(["key", "p", "q"], "key"), 7)
    new = spark.range(150, 250).select(
        F.concat(F.lit("k"), "id").alias("key"),
        F.when(F.col("id") % 2 == 0, "z").alias("p"),
        F.lit("n").alias("r"),
    )
    table.update(new, Scheme(["key", "p", "r"], "key"), bulk=bulk)
    got = {r["key"]: (r["p"], r["q"], r["r"]) for r in table.read().collect()}
    assert len(got) == 250
    for i in range(250):
        old, touched = i < 200, i >= 150
        p = "z" if touched and i % 2 == 0 else ("a" if old else None)
        assert got[f"k{i}"] == (p, "b" if old else None, "n" if touched else None)
    assert table.rows().select("key").distinct().count() == 250
    table.update(new, Scheme(["key", "p", "r"], "key"), bulk=bulk)
    assert table.read().count() == 250
    number = table.manifest().number
    with pytest.raises((ValueError, PySparkException), match="more than once"):
        table.update(new.unionByName(new), Scheme(["key", "p", "r"], "key"), bulk=bulk)
    assert table.manifest().number == number


def test_update_rewrites_only_touched_shards(store, made, spark):
    table = store.write("t", made(["key", "value"], 100), KV, 10)
    before = table.manifest().versions
    table.update(pairs(spark, ("key-value-5", "new")))
    after = table.manifest().versions
    assert sum(before[s] != after[s] for s in before) == 1
    assert table.read().count() == 100
    assert as_set(table.lookup("key-value-5")) == [("key-value-5", "new")]
    wanted = spark.createDataFrame([("key-value-5",), ("none",), ("key-value-7",)], "k string")
    assert as_set(table.lookup_all(wanted)) == [
        ("key-value-5", "new"),
        ("key-value-7", "value-value-7"),
    ]


def test_a_table_of_keys_only(store, made):
    scheme = Scheme(["key"], "key")
    store.write("t", made(["key", "value"], 10), scheme, 3)
    table = store.write("t", made(["key"], 12), scheme, 3)
    assert table.read().count() == 12
    assert total(table.stats(), "attribute_values") == 12


def test_deleting_the_last_row_of_a_shard(store, made):
    source = made(["key", "value"], 10)
    table = store.write("t", source, KV, 5)
    assert sorted(table.manifest().versions) == ["0", "3", "4"]
    table.delete_items(source.select("key").where("key in ('key-value-0', 'key-value-1')"))
    assert sorted(table.manifest().versions) == ["0", "4"]
    assert table.read().count() == 8
    table.delete_items(source.select("key"))
    assert table.read().count() == 0
    assert total(table.stats(), "items") == 0
    assert table.stats().count() == 5


def test_reshard_keeps_the_rows(store, made):
    source = made(["key", "value"], 200)
    table = store.write("t", source, KV, 3)
    for n in (8, 1, 100):
        table.reshard(n)
        assert as_set(table.read()) == as_set(source)
        assert table.manifest().num_shards == n
        placed = table.rows()
        from pigeonhole.functions import hashing

        wrong = placed.where(F.col("shard") != hashing.shard_index(F.col("key"), n))
        assert wrong.count() == 0


def test_catalog(store, spark, made):
    source = made(["key", "value"], 20)
    store.write("people", source, KV, 3)
    store.write("people2", source, KV, 2)
    store.create("empty", KV, 4)
    assert store.tables() == ["empty", "people", "people2"]
    assert store.exists("people") and store.exists("people", 3)
    assert not store.exists("people", 4) and not store.exists("peop")
    names = [r["name"] for r in store.shards().collect()]
    assert len(names) == 9 and "people2-2-of-2" in names
    assert store.shards(2).count() == 2
    assert store.infer_num_shards("people") == 3
    assert store.infer_num_shards("nobody") == 0
    assert store.drop("people") and not store.drop("people")
    assert store.tables() == ["empty", "people2"]  # not by prefix
    assert store.table("empty").read().count() == 0
    with pytest.raises(NoSuchTable):
        store.table("people")
    with pytest.raises(ValueError):
        store.create("../x", KV, 1)


def test_last_modified_and_prune(store, spark, made):
    table = store.write("t", made(["key", "value"], 20), KV, 3)
    first = table.last_modified().first()["modified"]
    table.update(pairs(spark, ("key-value-3", "new")))
    second = table.last_modified().first()["modified"]
    assert second >= first
    before = as_set(table.read())
    assert table.files().select("shard").distinct().count() == 3
    table.reshard(2)
    assert len(table.prune()) == 2
    assert as_set(table.read()) == before
    assert store.create("none", KV, 2).last_modified().first()["modified"] is not None


def test_plan_and_counts(store, made):
    table = store.write("t", made(["key", "value"], 10), KV, 5)
    plan = {r["name"]: (r["items"], r["quota"]) for r in table.plan(KV.with_limit(7)).collect()}
    assert plan == {"t-1-of-5": (4, 1), "t-4-of-5": (2, 2), "t-5-of-5": (4, 4)}
    assert {r["quota"] for r in table.plan(KV).collect()} == {-1}
    assert table.count().first()[0] == 10
    assert table.count(limit=1).first()[0] == 1
    assert table.count("value like '%-1'").first()[0] == 1
    assert sum(r["items"] for r in table.count_by_shard().collect()) == 10


LONG = "item_name string, name string, value string"


def rows_of(table):
    return sorted(tuple(r) for r in table.attributes().collect())


@pytest.mark.parametrize("few_bytes", [0, 1 << 30])
def test_attribute_table(store, spark, monkeypatch, few_bytes):
    monkeypatch.setattr(store_module, "FEW_BYTES", few_bytes)
    table = store.create_attributes("attrs", 6)
    first = [("item1", "attr1", "item1-attr1-<&;>-value1"), ("item1", "attr2", "v2")]
    table.put(spark.createDataFrame(first, LONG))
    assert rows_of(table) == first
    more = [("item1", "attr2", "v3"), ("item1", "attr2", "v2"), ("item2", "a", "b")]
    table.put(spark.createDataFrame(more, LONG))
    assert rows_of(table) == sorted(first + [("item1", "attr2", "v3"), ("item2", "a", "b")])
    (item,) = table.item("item1").collect()
    assert item["attributes"] == {"attr1": ["item1-attr1-<&;>-value1"], "attr2": ["v2", "v3"]}
    assert table.items().count() == 2
    assert [r["value"] for r in table.attribute("item1", "attr2").orderBy("value").collect()] == [
        "v2",
        "v3",
    ]
    assert table.attribute("item1", "none").count() == 0
    replace = spark.createDataFrame(
        [("item1", "attr2", "v9", True), ("item1", "attr1", "w", False)], LONG + ", replace boolean"
    )
    table.put(replace)
    assert rows_of(table) == sorted(
        [first[0], ("item1", "attr1", "w"), ("item1", "attr2", "v9"), ("item2", "a", "b")]
    )
    wide = table.read(Scheme(["id", "attr2", "other"], "id"))
    assert as_set(wide.where("id = 'item1'")) == [("item1", "v9", None)]
    table.delete(spark.createDataFrame([("item1", "attr1", "w"), ("item2", "a", None)], LONG))
    assert rows_of(table) == sorted([first[0], ("item1", "attr2", "v9")])
    assert total(table.stats(), "items") == 1
    table.delete_items(spark.createDataFrame([("item1",)], "item_name string"))
    assert rows_of(table) == []
    with pytest.raises(PySparkException, match="item name"):
        table.put(spark.createDataFrame([(None, "a", "b")], LONG))


@pytest.fixture
def written(monkeypatch):
    """What later writes of tables moved and wrote: rows of each exchange, rows of each task."""
    seen = []
    write = store_module._ShardedTable._write_version

    def noting(self, rows, num_shards, gather):
        arranged = self._arranged(rows, num_shards, gather).withColumn("task", F.spark_partition_id())
        tasks = arranged.groupBy("task").count()
        per_task = [r["count"] for r in tasks.collect()]
        seen.append((plans.rows_exchanged(tasks), per_task))
        return write(self, rows, num_shards, gather)

    def start(few_bytes=0):
        monkeypatch.setattr(store_module, "FEW_BYTES", few_bytes)
        monkeypatch.setattr(store_module._ShardedTable, "_write_version", noting)
        return seen

    return start


def many_attributes(spark, hot=False):
    item = "if(id % 3 = 0, 'hot', string(id % 1000))" if hot else "string(id % 1000)"
    return spark.range(6000).selectExpr(f"{item} as item_name", "'n' || id % 2 as name", "string(id) as value")


def times_moved(exchanges, rows):
    return sum(1 for n in exchanges if n >= 0.9 * rows)


@pytest.mark.parametrize("hot", [False, True])
def test_a_large_put_moves_present_rows_once(store, spark, written, monkeypatch, hot):
    monkeypatch.setattr(store_module, "LEAST_SLICE", 100)
    table = store.create_attributes("t", 4)
    rows = many_attributes(spark, hot)
    table.put(rows)
    seen = written()
    puts = rows.where("value % 5 = 0").selectExpr(
        "item_name", "name", "if(value % 2 = 0, value, 'new') as value", "name = 'n1' as replace"
    )
    table.put(puts.unionByName(puts))
    ((exchanges, tasks),) = seen
    assert times_moved(exchanges, 6000) == 1
    assert max(tasks) < 6000 / 3 / 2
    put = {tuple(r) for r in puts.collect()}
    gone = {r[:2] for r in put if r[3]}
    left = {r for r in map(tuple, rows.collect()) if r[:2] not in gone}
    assert rows_of(table) == sorted(left | {r[:3] for r in put})


@pytest.mark.parametrize("most", [False, True])
def test_a_large_put_moves_rows_of_its_names_only(store, spark, written, monkeypatch, most):
    monkeypatch.setattr(store_module, "LEAST_SLICE", 100)
    table = store.create_attributes("t", 4)
    rows = spark.range(6000).selectExpr(
        "string(id % 1000) as item_name", "'n' || id % 3 as name", "string(id) as value"
    )
    table.put(rows)
    seen = written()
    names = "name <> 'n0'" if most else "name = 'n0'"
    puts = rows.where(f"{names} and value % 5 = 0").selectExpr(
        "item_name", "name", "if(value % 2 = 0, value, 'new') as value", "item_name % 20 = 0 as replace"
    )
    with_null = puts.unionByName(spark.createDataFrame([("7", None, "v", False)], puts.schema))
    table.put(with_null)
    ((exchanges, tasks),) = seen
    put = {tuple(r) for r in puts.collect()}
    replaced = puts.where("replace").count()
    # Rows of other names stay where they are if they are most rows; puts go through one exchange.
    moved = 6000 if most else 2000
    assert sum(n for n in exchanges if n > 100) == moved + puts.count() + 1 + replaced
    gone = {r[:2] for r in put if r[3]}
    left = {r for r in map(tuple, rows.collect()) if r[:2] not in gone}
    expected = left | {r[:3] for r in put}
    assert set(map(tuple, table.attributes().where("name is not null").collect())) == expected
    assert table.attributes().count() == len(expected) + 1
    assert as_set(table.attribute("7", "n1")) == sorted(r for r in expected if r[:2] == ("7", "n1"))
    assert total(table.stats(), "items") == 1000
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_dense_puts_are_combined_before_they_move(store, spark, written):
    table = store.create_attributes("t", 4)
    rows = many_attributes(spark).where("value < 2000")
    table.put(rows)
    seen = written()
    new = spark.range(20000).selectExpr(
        "string(id % 1000) as item_name", "'n0' as name", "string(id % 2) as value", "true as replace"
    )
    table.put(new)
    ((exchanges, _),) = seen
    # Twenty copies of each put: present rows, puts and what they replace move once combined.
    assert sum(exchanges) < 2000 + 8 * 3000
    left = [r for r in map(tuple, rows.collect()) if r[1] != "n0"]
    assert rows_of(table) == sorted(left + [tuple(r)[:3] for r in new.distinct().collect()])


@pytest.mark.parametrize("hot", [False, True])
def test_large_deletes_move_present_rows_once(store, spark, written, monkeypatch, hot):
    monkeypatch.setattr(store_module, "LEAST_SLICE", 100)
    table = store.create_attributes("t", 4)
    rows = many_attributes(spark, hot)
    table.put(rows)
    seen = written()
    values = rows.where("value % 7 = 0 and name = 'n0'")
    names = rows.where("value % 11 = 0 and name = 'n1'").withColumn("value", F.lit(None).cast("string"))
    table.delete(values.unionByName(names).unionByName(values))
    gone, dropped = {tuple(r)[:2] for r in names.collect()}, set(map(tuple, values.collect()))
    left = {r for r in map(tuple, rows.collect()) if r[:2] not in gone and r not in dropped}
    assert rows_of(table) == sorted(left)
    items = rows.where("value % 13 = 0").select("item_name")
    table.delete_items(items)
    gone = {r[0] for r in items.collect()}
    assert rows_of(table) == sorted(r for r in left if r[0] not in gone)
    (first, _), (second, _) = seen
    assert times_moved(first, 6000) == 1 and times_moved(second, len(left)) == 1


@pytest.mark.parametrize("hot", [False, True])
def test_a_first_put_moves_rows_once(store, spark, written, monkeypatch, hot):
    monkeypatch.setattr(store_module, "LEAST_SLICE", 100)
    table = store.create_attributes("t", 4)
    rows = many_attributes(spark, hot)
    puts = rows.unionByName(rows.where("value % 5 = 0"))
    seen = written()
    table.put(puts)
    ((exchanges, tasks),) = seen
    # Where an item crowds a slice, copies are removed by value before.
    assert times_moved(exchanges, 6000) == (2 if hot else 1)
    assert sum(tasks) == 6000 and max(tasks) < 6000 / 4
    assert rows_of(table) == sorted(map(tuple, rows.collect()))


def test_copies_in_a_first_put_are_combined_before_they_move(store, spark, written, monkeypatch):
    monkeypatch.setattr(store_module, "LEAST_SLICE", 100)
    table = store.create_attributes("t", 4)
    rows = many_attributes(spark).where("value < 1000")
    one = spark.range(20000).selectExpr("'7' as item_name", "'n' as name", "'v' as value")
    seen = written()
    table.put(rows.unionByName(one))
    ((exchanges, _),) = seen
    assert max(exchanges) < 2000
    assert rows_of(table) == sorted([*map(tuple, rows.collect()), ("7", "n", "v")])


def test_large_deletes_move_what_is_deleted_once(store, spark, written):
    table = store.create_attributes("t", 4)
    rows = many_attributes(spark)
    table.put(rows)
    seen = written()
    table.delete(rows.where("value % 2 = 0").withColumn("value", F.lit(None).cast("string")))
    table.delete_items(rows.where("value % 1000 < 500").select("item_name"))
    (first, _), (second, _) = seen
    assert [sum(n for n in moved if n > 100) for moved in (first, second)] == [6000 + 500, 3000 + 500]
    assert rows_of(table) == sorted(r for r in map(tuple, rows.collect()) if int(r[2]) % 2 and int(r[2]) % 1000 >= 500)


def test_rows_and_attributes_in_one_table(store, made, spark):
    scheme = Scheme(["key", "rank", "value"], "key")
    table = store.create_attributes("t", 5)
    table.write(made(["key", "rank", "value", "extra"], 10), scheme)
    assert total(table.stats(), "attribute_values_bytes") == 360
    table.put(spark.createDataFrame([("key-value-1", "value", "a second")], LONG))
    rows = {r["key"]: (r["rank"], r["value"]) for r in table.read(scheme).collect()}
    assert len(rows) == 10 and rows["key-value-1"] == ("rank-value-1", "a second")
    assert table.read(scheme.with_limit(10)).count() == 8
    found = table.read(scheme.with_query("itemName() like '%-1' and rank like 'rank%'"))
    assert [r["key"] for r in found.collect()] == ["key-value-1"]
    table.put(spark.createDataFrame([("lone", "other", "1")], LONG))
    assert as_set(table.read(scheme).where("key = 'lone'")) == [("lone", None, None)]
    assert table.read(Scheme(["key"], "key")).count() == 11
    table.delete_items(spark.createDataFrame([("lone",)], "item_name string"))
    (item,) = table.items(scheme.with_query("itemName() like '%-1'")).collect()
    assert item["attributes"]["value"] == ["a second", "value-value-1"]
    late = spark.createDataFrame(
        [("key-value-1", "x", 1), ("key-value-1", "y", 2)], "key string, value string, at int"
    )
    table.write(late, Scheme(["key", "value"], "key"), order_by=["at"])
    assert [r["value"] for r in table.attribute("key-value-1", "value").collect()] == ["y"]
    assert table.attribute("key-value-1", "rank").count() == 1
    with pytest.raises(PySparkException, match="more than once"):
        table.write(late, Scheme(["key", "value"], "key"))


def test_partitions_grow_with_the_table(store, made, monkeypatch):
    table = store.write("t", made(["key", "value"], 50), KV, 3)
    at = table.manifest()
    assert table._partitions(at) == 8
    monkeypatch.setattr(store_module, "PARTITION_BYTES", 100)
    monkeypatch.setattr(store_module, "FEW_BYTES", 0)
    assert table._partitions(at) > table._partitions(at, [0]) > 8
    table.update(made(["key", "value"], 60), KV)
    assert as_set(table.read()) == as_set(made(["key", "value"], 60))


def test_conditional_put(store, spark):
    table = store.create_attributes("attrs", 3)
    table.put(spark.createDataFrame([("item1", "attr1", "value1")], LONG))
    terms = "item_name string, cond_name string, cond_value string, must_exist boolean"

    def put(value, cond_value, must_exist):
        puts = spark.createDataFrame(
            [("item1", "attr1", value, True)], LONG + ", replace boolean"
        )
        asked = spark.createDataFrame([("item1", "attr1", cond_value, must_exist)], terms)
        return table.conditional_put(puts, asked).collect()

    assert put("value2", "value1", True) == []
    assert rows_of(table) == [("item1", "attr1", "value2")]
    (rejected,) = put("value3", None, False)
    assert rejected["error"] == "ConditionalCheckFailed"
    assert rows_of(table) == [("item1", "attr1", "value2")]


def test_a_put_between_check_and_put_makes_it_fail(store, spark, monkeypatch):
    table = store.create_attributes("attrs", 3)
    table.put(spark.createDataFrame([("i", "a", "1")], LONG))
    puts = spark.createDataFrame([("i", "a", "2", True)], f"{LONG}, replace boolean")
    asked = spark.createDataFrame(
        [("i", "a", "1", True)], "item_name string, cond_name string, cond_value string, must_exist boolean"
    )
    check = store_module.attrs_ops.failed_items

    def with_a_writer(*args):
        found = check(*args)
        monkeypatch.setattr(store_module.attrs_ops, "failed_items", check)
        table.put(spark.createDataFrame([("i", "a", "9", True)], f"{LONG}, replace boolean"))
        return found

    monkeypatch.setattr(store_module.attrs_ops, "failed_items", with_a_writer)
    with pytest.raises(files.AlreadyThere):
        table.conditional_put(puts, asked)
    assert as_set(table.attributes()) == [("i", "a", "9")]
    assert len(table.conditional_put(puts, asked).collect()) == 1


def test_a_lookup_keeps_to_one_state(store, made, monkeypatch):
    table = store.write("t", made(["key", "value"], 20), KV, 3)
    read = table.manifest

    def then_reshard():
        found = read()
        monkeypatch.setattr(table, "manifest", read)
        table.reshard(7)
        return found

    monkeypatch.setattr(table, "manifest", then_reshard)
    assert table.lookup("key-value-3").count() == 1


def test_a_reshard_does_not_lose_a_write(store, made, spark, monkeypatch):
    table = store.write("t", made(["key", "value"], 20), KV, 3)
    move = store_module.maintenance.reshard

    def with_a_writer(*args):
        table.update(pairs(spark, ("new", "1")), KV)
        return move(*args)

    monkeypatch.setattr(store_module.maintenance, "reshard", with_a_writer)
    with pytest.raises(files.AlreadyThere):
        table.reshard(7)
    assert table.read().count() == 21


def test_a_manifest_appears_whole(store, made, spark):
    table = store.write("t", made(["key", "value"], 3), KV, 2)
    folder = f"{table.path}/manifests"
    open(f"{folder}/.half-written", "w").close()
    assert table.read().count() == 3
    with pytest.raises(files.AlreadyThere):
        files.create_text(spark, f"{folder}/000000000001.json", "{}")
    assert [n for n in files.names(spark, folder) if n[0] != "."] == ["000000000001.json"]


def test_a_failed_first_write_can_be_tried_again(store, spark):
    with pytest.raises(PySparkException, match="key field"):
        store.write("t", pairs(spark, (None, "1")), KV, 3, mode="keep")
    assert not store.exists("t") and store.tables() == []
    store.write("t", pairs(spark, ("a", "1")), KV, 3, mode="keep")
    assert store.table("t").read().count() == 1


def test_a_lost_shard_is_seen(store, made, spark):
    table = store.write("t", made(["key", "value"], 50), KV, 3)
    at = table.manifest()
    assert store.exists("t", 3) and store.infer_num_shards("t") == 3
    assert files.delete(spark, f"{table.path}/data/v={at.versions['1']}/shard=1")
    assert not store.exists("t")
    with pytest.raises(ValueError, match="missing shard #2"):
        store.infer_num_shards("t")
    assert store.shards(0).count() == 0 and store.shards().count() == 2


def test_small_updates_keep_few_files(store, made, spark):
    table = store.write("t", made(["key", "value"], 200), KV, 2)
    for k in range(10):
        table.update(spark.range(20).select(F.concat(F.lit("key-value-"), F.col("id") + k).alias("key"), F.lit("x").alias("value")), KV)
    assert table.files().count() <= 4
    assert table.read().where("value = 'x'").count() == 29
    assert len(table.manifest_names()) <= store_module.KEEP_MANIFESTS + 1
