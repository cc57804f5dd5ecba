import random

import plans
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pigeonhole import Scheme
from pigeonhole.operators import attributes as ops
from pigeonhole.operators import maintenance, scan, shards, stats, upsert
from pigeonhole.scheme import NO_LIMIT, bind_item_name, route, typed

KV = Scheme(["key", "value"], "key")
LONG = "item_name string, name string, value string"


def bag(df):
    return sorted(tuple(r) for r in df.collect())


def keyed(made, count, num_shards):
    return route(made(["key", "value"], count), "key", num_shards)


# -- scheme ----------------------------------------------------------------------------


def test_scheme_checks():
    for fields, key in [([], "a"), (["a", "b", "c"], ["a", "d"]), (["a", "b", "c"], "d")]:
        with pytest.raises(ValueError):
            Scheme(fields, key)
    with pytest.raises(ValueError):
        Scheme(["a", "shard"], "a")
    with pytest.raises(ValueError):
        Scheme(["a", "a"], "a")
    with pytest.raises(ValueError):
        Scheme(["a", "A"], "a")
    with pytest.raises(ValueError):
        KV.with_query("  where key = 'a'")
    assert KV.with_query(" a = 'b' ").query == "a = 'b'"
    assert KV.limit == NO_LIMIT


def test_item_name_is_bound_outside_quotes():
    query = "itemName() like 'itemName()%' and \"itemName()\" != `itemName()` or ITEMNAME( ) = 'it''s'"
    assert bind_item_name(query, "a`b") == (
        "`a``b` like 'itemName()%' and \"itemName()\" != `itemName()` or `a``b` = 'it''s'"
    )


def test_nested_fields_are_refused(spark):
    df = spark.range(1).select(F.lit("k").alias("key"), F.array(F.lit(1)).alias("value"))
    with pytest.raises(TypeError):
        KV.encode(df)


def test_typed_reading_of_bad_text(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([("1", "x")], "key string, value string")
    schema = T.StructType(
        [T.StructField("key", T.IntegerType()), T.StructField("value", T.IntegerType())]
    )
    assert tuple(typed(df, schema, permissive=True).first()) == (1, None)
    with pytest.raises(PySparkException):
        typed(df, schema).collect()


def test_permissive_integers_are_those_of_try_cast(spark):
    from pyspark.sql import types as T

    texts = ["1", " 2 ", "+3", "-4", "\t5\n", "\x1f6\x00", "", " ", "x", "1.5", "1e3", "--1", "+", "007",
             "2147483648", "9" * 30, "1\n\n", "٣", "1 2", "2020-01-01", None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    schema = T.StructType([T.StructField("value", T.IntegerType())])
    plain = [r[0] for r in df.select(F.col("value").try_cast("int")).collect()]
    assert [r[0] for r in typed(df, schema, permissive=True).collect()] == plain


# -- limits and counts -------------------------------------------------------------------


@pytest.mark.parametrize(
    "limit,quotas",
    [(2, [0, 0, 0, 1, 1]), (7, [1, 0, 0, 2, 4]), (10, [2, 0, 0, 2, 4]), (20, [4, 0, 0, 2, 4])],
)
def test_quotas(spark, made, limit, quotas):
    rows = keyed(made, 10, 5)
    got = scan.shard_quotas(scan.count_by_shard(rows), 5, limit).orderBy("shard").collect()
    assert [r["quota"] for r in got] == quotas
    taken = scan.balanced_limit(rows, "key", 5, limit).groupBy("shard").count().collect()
    assert {r["shard"]: r["count"] for r in taken} == {i: q for i, q in enumerate(quotas) if q}


@pytest.mark.parametrize("shard,expected", [(0, 5), (1, 10)])
def test_late_shards_do_not_give_back(spark, shard, expected):
    rows = spark.range(10).select(
        F.col("id").cast("string").alias("key"),
        F.format_string("0%010d" if shard == 0 else "1%010d", "id").alias("item_hash"),
        F.lit(shard).alias("shard"),
    )
    assert scan.balanced_limit(rows, "key", 2, 10).count() == expected


def test_balanced_limit_against_brute_force(spark, made, monkeypatch):
    monkeypatch.setattr(scan, "MAX_KEEP_ROWS", 12)
    rows = keyed(made, 500, 4).cache()
    everything = rows.collect()
    for limit in (0, 1, 3, 50, 123, 499, 500, 900):
        left, expected = limit, []
        for i in range(4):
            mine = [r for r in everything if r["shard"] == i]
            mine.sort(key=lambda r: (int(r["item_hash"][1:]) * (1 if r["item_hash"][0] == "1" else -1), r["key"]))
            quota = min(left // (4 - i), len(mine))
            left -= quota
            expected += [r["key"] for r in mine[:quota]]
        got = [r["key"] for r in scan.balanced_limit(rows, "key", 4, limit).collect()]
        assert sorted(got) == sorted(expected)
    assert scan.balanced_limit(rows, "key", 4, NO_LIMIT) is rows


def test_limit_of_no_rows(made):
    rows = keyed(made, 10, 5).where("key = 'none'")
    assert scan.balanced_limit(rows, "key", 5, 7).count() == 0
    assert scan.shard_plan(rows, 5, 7).count() == 0


def test_capped_counts(made):
    rows = keyed(made, 10, 5)
    assert scan.count_items(rows).first()[0] == 10
    assert scan.count_items(rows, 1).first()[0] == 1
    assert {r["items"] for r in scan.capped_count_by_shard(rows, 3).collect()} == {3, 2}


def test_lookup_reads_one_key(made):
    rows = keyed(made, 50, 5)
    assert [r["value"] for r in scan.item_lookup(rows, "key", "key-value-7", 5).collect()] == [
        "value-value-7"
    ]
    assert scan.item_lookup(rows, "key", "nobody", 5).count() == 0


# -- upserts -------------------------------------------------------------------------------


def test_three_merges_agree(spark, made):
    existing = keyed(made, 300, 6)
    incoming = route(
        spark.range(250, 400).select(
            F.concat(F.lit("key-value-"), "id").alias("key"),
            F.when(F.col("id") % 3 > 0, "new").alias("value"),
            F.lit("x").alias("extra"),
        ),
        "key",
        6,
    )
    for null_deletes in (False, True):
        columns = ["key", "value", "extra", "item_hash", "shard"]
        merged = upsert.merge(existing, incoming, "key", null_deletes).select(columns)
        few = upsert.merge_few(existing, incoming, "key", null_deletes).select(columns)
        sliced = upsert.merge_sliced(
            maintenance.hash_slices(existing, 6, 3),
            maintenance.hash_slices(incoming, 6, 3),
            "key",
            null_deletes,
        ).select(columns)
        rows = sorted(map(str, merged.collect()))
        assert len(rows) == 400
        assert rows == sorted(map(str, few.collect())) == sorted(map(str, sliced.collect()))
        kept = merged.where("key = 'key-value-252'").first()["value"]
        assert kept == (None if null_deletes else "value-value-252")


def test_repeated_keys_fail_without_an_order(spark):
    rows = spark.createDataFrame([("a", "1"), ("a", "2")], "key string, value string")
    with pytest.raises(PySparkException, match="more than once"):
        upsert.settle(rows, KV, 3).collect()


def test_one_key_with_a_third_of_all_rows(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("value"),
        F.col("id").alias("at"),
    )
    got = upsert.settle(rows, KV, 4, order_by=["at"])
    assert got.count() == 20001
    assert got.where("key = 'hot'").first()["value"] == "29997"
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


# -- attributes ----------------------------------------------------------------------------


@pytest.fixture
def skewed(spark):
    """Item ``hot`` holds a third of the rows, most of them values of one attribute."""
    return spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("item_name"),
        F.when(F.col("id") % 30 == 0, "b").otherwise("a").alias("name"),
        F.col("id").cast("string").alias("value"),
    )


def test_parts_are_for_every_item_alike(skewed):
    copies = skewed.unionByName(skewed)
    items = ops.item_form(copies, parts=30)
    sizes = items.select(
        "item_name", "part", F.expr("aggregate(map_values(attributes), 0, (s, v) -> s + size(v))").alias("n")
    ).collect()
    hot = [r for r in sizes if r["item_name"] == "hot"]
    assert len(hot) == 30 and sum(r["n"] for r in hot) == 3000 and max(r["n"] for r in hot) < 200
    assert len([r for r in sizes if r["item_name"] != "hot"]) == 6000
    back = items.select("item_name", F.explode("attributes").alias("name", "values")).select(
        "item_name", "name", F.explode("values").alias("value")
    )
    assert bag(back) == bag(skewed)
    assert ops.item_form(copies).where("item_name = 'hot'").count() == 1
    assert bag(ops.values_of(items, "b")) == bag(skewed.where("name = 'b'").select("item_name", "value"))


def test_a_large_item_has_one_first_value(spark):
    """What an item of 20,000 values answers does not depend on its size or its parts."""
    large = spark.range(20_000).select(
        F.lit("i").alias("item_name"), F.lit("s").alias("name"), F.format_string("%05d", "id").alias("value")
    )
    attrs = large.unionByName(spark.createDataFrame([("i", "flag", "A"), ("j", "flag", "B")], LONG))
    want = [("i", "A", "00000"), ("j", "B", None)]
    assert bag(ops.first_values(attrs, ["flag", "s"])) == want
    assert ops.item_form(attrs).where("item_name = 'i'").count() == 1
    assert ops.values_of(ops.item_form(attrs, parts=7), "s").count() == 20_000


def test_a_predicate_holds_if_any_value_passes(spark):
    rows = [("i", "status", "A"), ("i", "status", "B"), ("j", "status", "A"), ("k", "n", "1")]
    attrs = spark.createDataFrame(rows, LONG)
    tests = {"b": ("status", "value = 'B'"), "n": ("n", F.col("value") > "0")}
    assert bag(ops.matching_items(attrs, tests, "b")) == [("i",)]
    assert bag(ops.matching_items(attrs, tests, "b or n")) == [("i",), ("k",)]
    assert bag(ops.matching_items(attrs, tests, "not b")) == [("j",), ("k",)]


def test_item_form_matches_a_loop(spark):
    rows = [("i", "a", "2"), ("i", "a", "1"), ("i", "b", "1"), ("j", "a", "1"), ("i", "a", "2")]
    items = ops.item_form(spark.createDataFrame(rows, LONG)).orderBy("item_name").collect()
    assert [(r["item_name"], r["attributes"]) for r in items] == [
        ("i", {"a": ["1", "2"], "b": ["1"]}),
        ("j", {"a": ["1"]}),
    ]
    wide = ops.to_wide(spark.createDataFrame(rows, LONG), "k", ["a", "k", "z"])
    assert bag(wide) == [("1", "i", None), ("1", "j", None)] and wide.columns == ["a", "k", "z"]


def test_few_and_many_agree_on_skewed_items(skewed, spark):
    puts = spark.range(0, 60).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("item_name"),
        F.when(F.col("id") % 4 == 0, "c").otherwise("a").alias("name"),
        F.concat(F.lit("v"), "id").alias("value"),
    )
    flagged = puts.withColumn("replace", F.col("item_name") != "hot")
    gone = spark.createDataFrame([("hot", "a", None), ("hot", "b", "30"), ("1", "a", "1")], LONG)
    items = spark.createDataFrame([("hot",), ("2",), ("none",)], "item_name string")
    asked = spark.createDataFrame(
        [("hot", "a", "3", True), ("1", "a", "x", True), ("31", "zz", None, False), ("33", "a", None, False)],
        "item_name string, cond_name string, cond_value string, must_exist boolean",
    )
    rows = {tuple(r) for r in skewed.collect()}
    put_rows = {tuple(r) for r in puts.collect()}
    replaced = {(i, n) for i, n, _ in put_rows if i != "hot"}
    expected = {
        "append": rows | put_rows,
        "flagged": {r for r in rows if r[:2] not in replaced} | put_rows,
        "deleted": {r for r in rows if r[:2] != ("hot", "a") and r not in {("hot", "b", "30"), ("1", "a", "1")}},
        "items": {r for r in rows if r[0] not in ("hot", "2")},
    }
    for few in (False, True):
        assert bag(ops.put_attributes(skewed, puts, few)) == sorted(expected["append"])
        assert bag(ops.put_attributes(skewed, flagged, few)) == sorted(expected["flagged"])
        assert bag(ops.delete_attributes(skewed, gone, few)) == sorted(expected["deleted"])
        assert bag(ops.delete_items(skewed, items, few)) == sorted(expected["items"])
        held = ops.check_conditions(skewed, asked, few).select("item_name", "holds")
        assert bag(held) == [("1", False), ("31", True), ("33", True), ("hot", True)]
        failed = ops.failed_items(skewed, asked, few)
        assert {r["item_name"] for r in ops.rejected(puts, failed, few).collect()} == {"1"}
    assert ops.conditional_put(skewed, puts, asked).count() == 9000 + 59


def test_items_in_parts_of_a_stated_size(spark):
    """An item with most rows is cut in the order of its values; others are one row."""
    hot = spark.range(5000).select(
        F.lit("hot").alias("item_name"),
        F.concat(F.lit("n"), F.col("id") % 3).alias("name"),
        F.format_string("v%05d", "id").alias("value"),
    )
    small = spark.createDataFrame([("s", "b", "2"), ("s", "a", "1"), ("s", "b", "2"), (None, "a", "x")], LONG)
    items = ops.item_form(hot.unionByName(hot).unionByName(small).repartition(7), size=300)
    rows = {(r["item_name"], r["part"]): r["attributes"] for r in items.collect()}
    assert rows[("s", 0)] == {"a": ["1"], "b": ["2"]}
    order = sorted((r["name"], r["value"]) for r in hot.collect())
    for part in range(17):
        got = rows.pop(("hot", part))
        assert [(n, v) for n in sorted(got) for v in got[n]] == order[part * 300 : (part + 1) * 300]
    assert list(rows) == [("s", 0)]
    with pytest.raises(ValueError):
        ops.item_form(hot, parts=2, size=3)


def test_conditions_read_only_what_they_ask_about(spark):
    """Rows of other attributes take no part in the exchanges, the others take part once."""
    rows = spark.range(3000).selectExpr("string(id div 3) as item_name", "'n' || id % 3 as name", "string(id) as value")
    asked = spark.createDataFrame(
        [(str(i), "n1", str(3 * i + 1 + i % 2), True) for i in range(1000)]
        + [("5", "zz", None, False), ("7", "n1", None, False), ("9", "n1", None, True), ("no", None, None, False)],
        "item_name string, cond_name string, cond_value string, must_exist boolean",
    )
    failed = ops.failed_items(rows, asked)
    assert {r[0] for r in failed.collect()} == {str(i) for i in range(1, 1000, 2)}
    assert max(plans.rows_exchanged(failed)) <= 1000 + asked.count()
    assert bag(failed) == bag(ops.failed_items(rows, asked, True))


def test_only_large_items_are_ranked(spark, monkeypatch):
    seen = []
    rank = ops.ordering.ranked
    monkeypatch.setattr(ops.ordering, "ranked", lambda df, *a: seen.append(df.count()) or rank(df, *a))
    rows = spark.range(900).selectExpr(
        "if(id < 100, 'large', string(id % 80)) as item_name", "'n' as name", "string(id) as value"
    )
    large = rows.where("item_name = 'large'")
    for among in (None, rows.select("item_name").distinct().where("item_name != '7'")):
        items = ops.item_form(rows, is_set=True, among=among, size=30)
        want = 84 if among is None else 83
        found = items.collect()
        assert len(found) == want and seen.pop() == large.count() and not seen
        assert sum(len(r["attributes"]["n"]) for r in found) == (900 if among is None else 890)
    assert ops.item_form(rows, is_set=True, size=100).count() == 81 and not seen
    monkeypatch.setattr(ops, "FEW_ITEMS", 0)
    assert ops.item_form(rows, is_set=True, size=30).count() == 84 and seen.pop() == 900
    assert ops.item_form(rows, is_set=True, among=among, size=100).count() == 80 and not seen


def test_no_task_holds_a_hot_item(spark, monkeypatch):
    """The ranges of a hot item lie in all tasks of the sort."""
    seen = []
    ranked = ops.ordering.ranked

    def noted(df, *args):
        rows = df.repartitionByRange(8, "item_name", "name", "value")
        seen.extend(r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect())
        return ranked(df, *args)

    monkeypatch.setattr(ops.ordering, "ranked", noted)
    hot = spark.range(20_000).selectExpr("'hot' as item_name", "'n' as name", "string(id) as value")
    items = ops.item_form(hot, size=1000)
    assert items.selectExpr("max(size(attributes['n']))", "count(*)").first()[:] == (1000, 20)
    assert len(seen) == 8 and max(seen) < 5000


def put_if(rows, puts, conditions):
    """K9 plainly: the rows after the puts of the items whose conditions hold."""
    refused = set()
    for item, name, value, must in conditions:
        holds = value is not None and (item, name, value) in rows if must else all(r[:2] != (item, name) for r in rows)
        if not holds:
            refused.add(item)
    put = [p for p in puts if p[0] not in refused and p[2] is not None]
    replaced = {p[:2] for p in put if p[3]}
    return {r for r in rows if r[:2] not in replaced} | {p[:3] for p in put}


def test_conditional_put_against_plain_rules(spark):
    draw = random.Random(4)
    for _ in range(4):
        items = ["hot"] * 5 + [f"i{k}" for k in range(8)]
        rows = {(draw.choice(items), draw.choice("ab"), f"v{draw.randrange(40)}") for _ in range(150)}
        puts = [
            (draw.choice(items), draw.choice("abc"), draw.choice([None, *[f"v{k}" for k in range(40)]]), draw.choice([True, False, None]))
            for _ in range(40)
        ]
        asked = [
            (draw.choice(items[4:]), draw.choice("abc"), draw.choice([None, *[f"v{k}" for k in range(40)]]), draw.random() < 0.6)
            for _ in range(draw.randrange(1, 6))
        ]
        state = ops.conditional_put(
            spark.createDataFrame(sorted(rows), LONG),
            spark.createDataFrame(puts, f"{LONG}, replace boolean"),
            spark.createDataFrame(asked, "item_name string, cond_name string, cond_value string, must_exist boolean"),
        )
        assert bag(state) == sorted(put_if(rows, puts, asked))


def test_conditional_put_reads_each_input_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([("i", "a", "1"), ("j", "a", "2")], LONG).write.parquet(path)
    asked = spark.createDataFrame([("i", "a", "1", True)], "item_name string, cond_name string, cond_value string, must_exist boolean")
    puts = spark.createDataFrame([("i", "a", "9", True)], f"{LONG}, replace boolean")
    state = ops.conditional_put(spark.read.parquet(path), puts, asked)
    assert bag(state) == [("i", "a", "9"), ("j", "a", "2")]
    assert sum(n.metrics().get("numOutputRows").get().value() for n in plans.scans(state)) == 2


def test_null_values_are_not_put(spark):
    existing = spark.createDataFrame([("i", "a", "1")], LONG)
    puts = spark.createDataFrame([("i", "a", None), ("i", "b", None)], LONG)
    assert bag(ops.put_attributes(existing, puts)) == [("i", "a", "1")]


def test_map_lookups(spark):
    item = ops.item_form(spark.createDataFrame([("i", "a", "2"), ("i", "a", "1")], LONG))
    bag_col = F.col("attributes")
    row = item.select(
        ops.attribute(bag_col, "a"), ops.attribute(bag_col, "b"),
    ).first()
    assert tuple(row) == (["1", "2"], None)


# -- statistics ------------------------------------------------------------------------------


def test_wide_and_long_statistics_agree(made):
    rows = route(
        made(["key", "rank", "value"], 40).withColumn(
            "rank", F.when(F.col("key") != "key-value-3", F.col("rank"))
        ),
        "key",
        3,
    )
    long = route(ops.to_attributes(rows, "key", ["key", "rank", "value"]), "item_name", 3)
    columns = ["shard", *stats.COUNTERS]
    for count_hash in (True, False):
        wide = stats.shard_stats(rows, "key", ["rank", "value"], count_hash).select(columns)
        assert bag(wide) == bag(stats.attribute_stats(long, count_hash).select(columns))


# -- catalogs --------------------------------------------------------------------------------


def test_shard_counts(spark):
    names = (
        [f"good-{i}-of-3" for i in (1, 2, 3)]
        + ["gap-1-of-4", "gap-2-of-4", "gap-4-of-4", "late-2-of-2", "two-1-of-2", "two-1-of-3"]
        + ["zero-0-of-1", "high-3-of-2", "plain", "far-7-of-2000000000"]
    )
    catalog = spark.createDataFrame([(n,) for n in names + names[:2]], "name string")
    got = {r[0]: tuple(r[1:]) for r in shards.shard_counts(catalog).collect()}
    assert got == {
        "good": (3, None, None),
        "gap": (None, shards.MISSING, 3),
        "late": (None, shards.MISSING, 1),
        "two": (None, shards.DIFFERENT_COUNTS, None),
        "zero": (None, shards.NO_SUCH_NUMBER, None),
        "high": (None, shards.NO_SUCH_NUMBER, None),
        "far": (None, shards.MISSING, 1),
    }
    assert shards.infer_num_shards(catalog, "good") == 3
    assert shards.infer_num_shards(catalog, "goo") == 0
    with pytest.raises(ValueError, match="missing shard #3"):
        shards.infer_num_shards(catalog, "gap")
    tables = spark.createDataFrame([("good",), ("gap",), ("none",)], "table_name string")
    assert bag(shards.tables_exist(catalog, tables, 3)) == [
        ("gap", False), ("good", True), ("none", False)
    ]
    assert shards.without_table(catalog, "go").count() == catalog.count()
    assert shards.list_shards(catalog, 2).count() == 2


# -- maintenance -----------------------------------------------------------------------------


@pytest.mark.parametrize("num_shards,num_slices", [(1, 1), (1, 4), (3, 5), (4, 2)])
def test_slices_partition_the_rows(made, num_shards, num_slices):
    rows = maintenance.hash_slices(keyed(made, 300, num_shards), num_shards, num_slices).cache()
    total = 0
    for shard in range(num_shards):
        for index in range(num_slices):
            found = rows.where(maintenance.slice_filter(shard, index, num_shards, num_slices))
            keys = {(r["shard"], r["slice"]) for r in found.collect()}
            assert keys <= {(shard, index)}
            total += found.count()
    assert total == 300


def test_capacity(spark):
    rows = spark.createDataFrame(
        [("a", "x" * 1025, "é" * 600), ("b", "x" * 1024, None), ("c", None, None)],
        "key string, p string, q string",
    )
    found = maintenance.capacity_violations(rows, "key", ["p", "q"], max_item_bytes=2000)
    expected = [("item", "a", None, 2228, 2000), ("value", "a", "p", 1025, 1024), ("value", "a", "q", 1200, 1024)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    long = ops.to_attributes(rows, "key", ["key", "p", "q"])
    again = maintenance.attribute_capacity_violations(long, max_item_bytes=2000)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(expected, key=str)
    shards_df = spark.createDataFrame([("t", 100), ("u", 101)], "table_name string, num_shards int")
    assert [r[0] for r in maintenance.shard_count_violations(shards_df).collect()] == ["u"]


def test_reshard_there_and_back(made):
    rows = keyed(made, 100, 3)
    back = maintenance.reshard(maintenance.reshard(rows, 50), 3)
    assert bag(back) == bag(rows)
