"""Early ends of counts, lookups of many keys, resharding in place and stored counters."""

import math
import random
import struct
from collections import Counter
from itertools import groupby

import plans
import pytest
from pyspark.sql import functions as F

from pigeonhole import Scheme
from pigeonhole.functions import hashing, sortable
from pigeonhole.operators import maintenance, scan, stats

PAIRS = Scheme(["id", "kind"], "id")
ROWS = 200_000


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    """200,000 rows in 2 shards, a thousandth of them rare."""
    from pigeonhole import Store

    rows = spark.range(ROWS).select(
        F.concat(F.lit("key-"), "id").alias("id"),
        F.when(F.col("id") % 1000 == 0, "rare").otherwise("common").alias("kind"),
    )
    return Store(spark, str(tmp_path_factory.mktemp("large"))).write("t", rows, PAIRS, 2)


# -- A2 --------------------------------------------------------------------------------


def test_a_capped_count_reads_little(large):
    found = large.count_by_shard("kind = 'common'", 10)
    assert [tuple(r) for r in found.orderBy("shard").collect()] == [(0, 10), (1, 10)]
    whole = large.count("kind = 'common'", 10)
    for df in (large.count_by_shard("kind = 'common'", 10), whole):
        df.collect()
        assert "LocalLimitExec" in plans.names(df)
        assert plans.rows_scanned(df) < ROWS // 4
    assert whole.first()["items"] == 10


def test_capped_counts_equal_full_ones(large, spark):
    full = {r["shard"]: r["items"] for r in large.count_by_shard("kind = 'rare'").collect()}
    assert sum(full.values()) == ROWS // 1000
    for limit in (1, 99, 100, 150, 10**7):
        got = {r["shard"]: r["items"] for r in large.count_by_shard("kind = 'rare'", limit).collect()}
        assert got == {s: min(n, limit) for s, n in full.items()}
        assert large.count("kind = 'rare'", limit).first()["items"] == min(ROWS // 1000, limit)
    assert large.count("kind = 'none'", 5).first()["items"] == 0
    assert large.count_by_shard("kind = 'none'", 5).collect() == []
    assert large.count("kind = 'rare'", 0).first()["items"] == 0
    one = large.rows().where("kind = 'rare'")
    assert scan.count_items(one, scan.STOP_EARLY + 1).first()["items"] == ROWS // 1000


def test_counts_of_an_empty_table(store):
    table = store.create("t", PAIRS, 3)
    assert table.count().first()["items"] == 0
    assert table.count(limit=4).first()["items"] == 0
    assert table.count_by_shard("kind = 'x'", 4).collect() == []
    assert table.count_by_shard().collect() == []


# -- S3 --------------------------------------------------------------------------------


def test_a_few_keys_read_a_few_pages(large, spark):
    keys = spark.createDataFrame([("key-7",), ("key-7",), ("key-123456",), ("absent",), ("",), (None,)], "k string")
    found = large.lookup_all(keys)
    assert sorted(tuple(r) for r in found.collect()) == [("key-123456", "common"), ("key-7", "common")]
    assert plans.rows_scanned(found) < ROWS // 3


def test_many_keys_are_joined_on_shard_hash_and_key(large, spark):
    keys = spark.range(0, ROWS, 7).select(F.concat(F.lit("key-"), "id").alias("wanted"))
    found = large.lookup_all(keys)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join LeftSemi" in line)
    assert all(name in join for name in ("shard", "item_hash", "id"))
    assert found.count() == len(range(0, ROWS, 7))


def test_no_keys_and_no_table_rows(large, store, spark):
    none = spark.createDataFrame([], "k string")
    assert large.lookup_all(none).collect() == []
    assert store.create("t", PAIRS, 3).lookup_all(spark.createDataFrame([("a",)], "k string")).collect() == []


def test_equal_hashes_of_other_keys_are_no_matches(store, spark):
    """Keys that share their hash are told apart by themselves."""
    by_hash = {}
    for i in range(200_000):
        key = f"k{i}"
        other = by_hash.setdefault(hashing.literal_hash(key), key)
        if other != key:
            break
    assert other != key
    table = store.write("t", spark.createDataFrame([(key, "a")], "id string, kind string"), PAIRS, 2)
    assert table.lookup_all(spark.createDataFrame([(other,)], "k string")).collect() == []
    assert table.lookup_all(spark.createDataFrame([(key,), (other,)], "k string")).count() == 1


# -- R1 --------------------------------------------------------------------------------


@pytest.mark.parametrize("old, new", [(4, 8), (4, 7), (7, 4), (3, 1), (1, 20)])
def test_resharding_moves_no_row_to_another_task(store, made, old, new, monkeypatch):
    table = store.write("t", made(["k", "a"], 3000), Scheme(["k", "a"], "k"), old)
    before = Counter(tuple(r) for r in table.read().collect())
    seen = []
    arranged = type(table)._arranged

    def noted(self, rows, num_shards, gather):
        seen.append(arranged(self, rows, num_shards, gather))
        return seen[-1]

    monkeypatch.setattr(type(table), "_arranged", noted)
    table.reshard(new)
    (written,) = seen
    written.collect()
    assert not [n for n in plans.names(written) if "Exchange" in n]
    rows = table.rows().collect()
    assert Counter((r["k"], r["a"]) for r in rows) == before
    assert all(r["shard"] == hashing.literal_shard(r["k"], new) for r in rows)
    assert table.manifest().num_shards == new
    # Files are still sorted, so that lookups read little.
    files = table.rows().withColumn("f", F.input_file_name())
    for _, own in groupby(files.collect(), key=lambda r: r["f"]):
        hashes = [r["item_hash"] for r in own]
        assert hashes == sorted(hashes)


# -- K1 --------------------------------------------------------------------------------


def written_plans(monkeypatch, table):
    """The rows of each write of a table, as they are arranged for it."""
    seen = []
    arranged = type(table)._arranged

    def noted(self, rows, num_shards, gather):
        seen.append(arranged(self, rows, num_shards, gather))
        return seen[-1]

    monkeypatch.setattr(type(table), "_arranged", noted)
    return seen


def exchanged(df):
    """Rows that went through exchanges, broadcasts aside."""
    found = [n for n in plans.nodes(df) if n.getClass().getSimpleName() == "ShuffleExchangeExec"]
    return sum(n.metrics().get("shuffleRecordsWritten").get().value() for n in found)


@pytest.mark.parametrize("null_deletes", [False, True])
def test_a_large_update_moves_what_comes_in_and_what_it_meets(store, spark, monkeypatch, null_deletes):
    from pigeonhole.sources import store as store_module

    old = spark.range(20_000).selectExpr("concat('k', id) as k", "string(id) as a", "'x' as b")
    new = spark.range(19_800, 20_100).selectExpr(
        "concat('k', id) as k", "if(id % 2 = 0, 'new', null) as a", "string(id) as c"
    )
    table = store.write("t", old, Scheme(["k", "a", "b"], "k"), 4)
    monkeypatch.setattr(store_module, "FEW_BYTES", 0)
    seen = written_plans(monkeypatch, table)
    # Rows are arranged while the staged ones are there, so they are counted in the write.
    publish = type(table)._publish_shards
    moved = []

    def counted(self, before, rows, *args, **more):
        df = rows.select("*")
        df.collect()
        moved.append(exchanged(df))
        return publish(self, before, rows, *args, **more)

    monkeypatch.setattr(type(table), "_publish_shards", counted)
    table.update(new, Scheme(["k", "a", "c"], "k"), null_deletes=null_deletes)
    assert seen and 500 <= moved[-1] < 2000
    got = {r["k"]: (r["a"], r["b"], r["c"]) for r in table.read().collect()}
    for i in range(20_100):
        put = "new" if i % 2 == 0 else None
        if i < 19_800:
            want = (str(i), "x", None)
        elif i < 20_000:
            want = (put if put or null_deletes else str(i), "x", str(i))
        else:
            want = (put, None, str(i))
        assert got[f"k{i}"] == want
    assert len(got) == 20_100


def test_few_changes_move_no_present_row(store, spark, monkeypatch):
    old = spark.range(20_000).selectExpr("concat('k', id) as k", "string(id) as a")
    table = store.write("t", old, Scheme(["k", "a"], "k"), 4)
    publish = type(table)._publish_shards
    moved = []

    def counted(self, before, rows, touched, *args, gather=True, **more):
        df = self._arranged(rows, before.num_shards, gather)
        df.collect()
        moved.append(exchanged(df))
        return publish(self, before, rows, touched, *args, gather=gather, **more)

    monkeypatch.setattr(type(table), "_publish_shards", counted)
    store.write("t", spark.createDataFrame([("k5", "y"), ("new", "z")], "k string, a string"), Scheme(["k", "a"], "k"), 4)
    table.delete_items(spark.createDataFrame([("k6",), ("k7",)], "k string"))
    assert len(moved) == 2 and max(moved) < 100
    assert table.read().count() == 19_999
    assert table.lookup("k5").first()["a"] == "y"


def test_met_rows_are_never_missed(spark):
    from pigeonhole.operators import upsert
    from pigeonhole.scheme import route

    rows = route(spark.range(3000).selectExpr("concat('k', id) as k"), "k", 4)
    some = rows.where("k like '%7'")
    found = upsert.met(rows, some, bits=1 << 10)
    keys = {r["k"] for r in found.where("met").collect()}
    assert {r["k"] for r in some.collect()} <= keys
    assert upsert.met(rows, some).where("met").count() == some.count()
    assert found.count() == 3000
    assert upsert.met(rows, rows.where("false")).where("met").count() == 0


# -- M6 --------------------------------------------------------------------------------


def scanned(table):
    at = table.manifest()
    found = stats.shard_stats(table.rows(at=at), at.key, [f for f in at.fields if f != at.key])
    return sorted(tuple(r) for r in stats.every_shard(found, at.num_shards).collect())


def stored(table):
    return sorted(tuple(r)[:-1] for r in table.stats().collect())


def test_counters_follow_every_write(store, made, spark):
    scheme = Scheme(["k", "a"], "k")
    table = store.write("t", made(["k", "a"], 500), scheme, 6)
    assert stored(table) == scanned(table)
    one = spark.createDataFrame([("k-value-7", None, "é"), ("new", "x", None)], "k string, a string, w string")
    table = store.write("t", one, Scheme(["k", "a", "w"], "k"), 6)
    assert stored(table) == scanned(table)
    table.delete_items(made(["k"], 100))
    assert stored(table) == scanned(table)
    store.write("t", made(["k", "a"], 450), scheme, 6, bulk=True)
    assert stored(table) == scanned(table)
    for n in (12, 5):
        table.reshard(n)
        assert stored(table) == scanned(table)
    store.write("t", made(["k", "a"], 30), scheme, 3, mode="replace")
    assert stored(table) == scanned(table)
    table.prune()
    assert stored(table) == scanned(table)
    assert table.count().first()["items"] == 30
    assert table.count(limit=7).first()["items"] == 7


def test_statistics_read_no_data(store, made, spark):
    table = store.write("t", made(["k", "a"], 500), Scheme(["k", "a"], "k"), 6)
    for df in (table.stats(), table.count(), table.count_by_shard()):
        df.collect()
        paths = [n.relation().location().rootPaths().mkString(" ") for n in plans.scans(df)]
        assert paths and all("/stats/" in p and "/data/" not in p for p in paths)


def test_counters_of_attributes_are_noted_when_first_asked(store, spark):
    table = store.create_attributes("t", 3)
    rows = [(f"i{i}", n, v) for i in range(40) for n, v in (("a", "x"), ("a", f"y{i}"), ("bé", "z"))]
    table.put(spark.createDataFrame(rows, "item_name string, name string, value string"))
    want = stats.every_shard(stats.attribute_stats(table.rows()), 3).collect()
    for _ in range(2):
        assert stored(table) == sorted(tuple(r) for r in want)
    again = table.stats()
    again.collect()
    assert all("/stats/" in n.relation().location().rootPaths().mkString(" ") for n in plans.scans(again))


# -- R3 --------------------------------------------------------------------------------


def bits(x):
    return struct.pack(">d", x)


def test_sortable_doubles(spark):
    draw = random.Random(1)
    values = [struct.unpack(">d", draw.randbytes(8))[0] for _ in range(4000)]
    values = [v for v in values if not math.isnan(v)]
    values += [s * 2.0**e * f for s in (-1, 1) for e in range(-1074, 1024, 3) for f in (1.0, 1.0 + 2**-52, 1.5)]
    values += [s * (2.0**e - 2.0 ** (e - 53)) for s in (-1, 1) for e in range(-1000, 1024, 7)]
    values += [0.0, -0.0, math.inf, -math.inf, 5e-324, -5e-324, 2.0**-1022, 1.7976931348623157e308, 1.0, -1.0, 0.1]
    df = spark.createDataFrame([(v,) for v in [*values, math.nan, None]], "v double")
    df = df.withColumn("t", sortable.encode_double(F.col("v")))
    rows = df.withColumn("back", sortable.decode_double(F.col("t"))).where("t is not null").orderBy("t").collect()
    assert len(rows) == len(values) + 1
    assert math.isnan(rows[-1]["v"]) and math.isnan(rows[-1]["back"])
    assert all(bits(r["v"]) == bits(r["back"]) for r in rows[:-1])
    assert all(len(r["t"]) == 17 for r in rows)
    assert [r["v"] for r in rows[:-1]] == sorted(values)
    zeros = [bits(r["v"]) for r in rows if r["v"] == 0]
    assert zeros == [bits(-0.0), bits(0.0)]
    assert df.where("v is null").first()["t"] is None


def test_slices_of_a_resharded_table(store, made):
    """Pushed-down hash ranges find the same rows after the shards have moved."""
    table = store.write("t", made(["k", "a"], 2000), Scheme(["k", "a"], "k"), 4)
    table.reshard(7)
    parts = [table.rows().where(maintenance.slice_filter(s, i, 7, 2)).count() for s in range(7) for i in range(2)]
    assert sum(parts) == 2000


# -- M4 --------------------------------------------------------------------------------


def test_many_tables_are_listed_by_tasks(store, spark, tmp_path, monkeypatch):
    """Manifests are read by Spark; the driver lists the root only."""
    import json
    import os

    from pigeonhole.sources import files

    for i in range(300):
        folder = os.path.join(store.root, f"t{i}", "manifests")
        os.makedirs(folder)
        for number in (1, 2):
            state = {"num_shards": number + i % 3, "versions": {}}
            with open(f"{folder}/{number:012d}.json", "w") as f:
                json.dump(state, f)
    os.makedirs(os.path.join(store.root, "no-table", "data"))
    calls = []
    for name in ("names", "read_text"):
        call = getattr(files, name)
        monkeypatch.setattr(files, name, lambda *a, call=call: calls.append(a) or call(*a))
    assert len(store.tables()) == 300
    names = {r["name"] for r in store.shards().collect()}
    assert len(calls) == 3  # of the root, for each index that is made
    assert len(names) == sum(2 + i % 3 for i in range(300))
    assert "t5-4-of-4" in names and "t5-5-of-5" not in names


def test_lost_shards_are_not_listed(store, made):
    import shutil

    table = store.write("t", made(["k", "a"], 200), Scheme(["k", "a"], "k"), 4)
    store.create("u", Scheme(["k", "a"], "k"), 2)
    assert store.shards().count() == 6
    version = table.manifest().versions["2"]
    shutil.rmtree(f"{table.path}/data/v={version}/shard=2")
    assert sorted(r["name"] for r in store.shards().collect()) == ["t-1-of-4", "t-2-of-4", "t-4-of-4", "u-1-of-2", "u-2-of-2"]
