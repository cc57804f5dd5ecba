import random
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pigeonhole.functions import hashing, naming, sortable

GOLDEN = [
    ("", 0, "10000000000", 2),
    ("a", -902917054, "00902917054", 1),
    ("test", 1064684737, "11064684737", 2),
    ("key-0", -320561460, "00320561460", 1),
    ("key-1", 1347184026, "11347184026", 3),
    ("key-value-0", 615414537, "10615414537", 2),
    ("key-value-1", 895556722, "10895556722", 2),
    ("key-value-9", -2105100636, "02105100636", 0),
    ("Customer#000000000", -449169839, "00449169839", 1),
    ("é", -1366949649, "01366949649", 0),
    ("日本", -2107730618, "02107730618", 0),
    ("0", 1849449579, "11849449579", 3),
    ("1", -2140438327, "02140438327", 0),
    ("42", 1942662376, "11942662376", 3),
]


def test_golden_hashes(spark):
    df = spark.createDataFrame([(g[0],) for g in GOLDEN], "k string")
    k = F.col("k")
    got = df.select(
        k, hashing.key_hash(k), hashing.item_hash(k), hashing.shard_index(k, 4)
    ).collect()
    assert sorted(tuple(r) for r in got) == sorted(GOLDEN)
    for key, _, text, shard in GOLDEN:
        assert hashing.literal_item_hash(key) == text
        assert hashing.literal_shard(key, 4) == shard
    assert df.select(hashing.key_hash(F.lit(None).cast("string"))).first()[0] is None


def test_compiled_hashes_are_the_same(spark):
    keys = [None, "", "\x00", "a" * 12, "a" * 13, "\u00e9" * 6, "\u00e9" * 7, "x\U0001f600", *(g[0] for g in GOLDEN)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    both = hashing.with_unsigned_hash(df, F.col("k"), "h").withColumn("g", hashing.unsigned_hash(F.col("k")))
    assert both.columns == ["k", "h", "g"]
    rows = both.collect()
    assert len(rows) == len(keys) and all(r["h"] == r["g"] for r in rows)


def test_last_positions_are_clamped(spark):
    df = spark.createDataFrame([("09531419",)], "k string")
    assert df.select(hashing.shard_index(F.col("k"), 100)).first()[0] == 99
    assert hashing.literal_shard("09531419", 100) == 99
    top = spark.range(2**32 - 200, 2**32).select(
        F.max(hashing.shard_of_position(F.col("id"), 100)),
        F.max(hashing.slice_of_position(F.col("id"), F.lit(99), 100, 7)),
    )
    assert tuple(top.first()) == (99, 6)


def test_smallest_hash_has_eleven_digits(spark):
    text = spark.range(1).select(hashing.hash_text(F.lit(2**31).cast("bigint"))).first()[0]
    assert text == "02147483648"


def test_text_keeps_the_position(spark):
    rng = random.Random(1)
    edges = [0, 1, 2**31 - 1, 2**31, 2**31 + 1, 2**32 - 1]
    values = edges + [rng.randrange(2**32) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "u bigint")
    wrong = df.where(
        hashing.text_position(hashing.hash_text(F.col("u"))) != hashing.hash_position(F.col("u"))
    )
    assert wrong.count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(min_size=1, max_size=40), min_size=1, max_size=60))
def test_column_and_literal_hash_agree(spark, keys):
    keys = [k for k in keys if not any(0xD800 <= ord(c) < 0xE000 for c in k)] or ["x"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for row in df.select("k", hashing.unsigned_hash(F.col("k")).alias("u")).collect():
        assert row["u"] == hashing.literal_hash(row["k"])


def test_shard_count_is_checked():
    for n in (0, -1):
        with pytest.raises(ValueError):
            hashing.literal_shard("a", n)


def test_shard_names_round_trip(spark):
    names = spark.range(1).select(F.explode(naming.shard_names(F.lit("base"), 10)).alias("name"))
    got = names.select(
        naming.shard_number(F.col("name")), naming.shard_count(F.col("name"), F.lit("base"))
    )
    assert [tuple(r) for r in got.collect()] == [(i, 10) for i in range(1, 11)]


@pytest.mark.parametrize(
    "name,number,total,in_x",
    [
        ("x-1-of-3", 1, 3, 1),
        ("x-y-1-of-3", 1, 3, -1),
        ("x", -1, -1, -1),
        ("x-1-of-", -1, -1, -1),
        ("-1-of-3", -1, -1, -1),
        ("x-1-of-3\n", -1, -1, -1),
        ("x-01-of-03", 1, 3, 1),
        ("x-1-of-3-2-of-9", 2, 9, -1),
    ],
)
def test_shard_name_parsing(spark, name, number, total, in_x):
    c = F.lit(name)
    got = spark.range(1).select(
        naming.shard_number(c), naming.shard_count(c), naming.shard_number(c, F.lit("x"))
    )
    assert tuple(got.first()) == (number, total, in_x)


def test_sortable_numbers(spark):
    values = [-(2**63), -100, -99, -2, -1, 0, 1, 2, 10, 99, 100, 2**63 - 1]
    df = spark.createDataFrame([(v,) for v in values], "v bigint").withColumn(
        "t", sortable.encode_number(F.col("v"))
    )
    rows = df.orderBy("t").select("v", "t", sortable.decode_number(F.col("t")).alias("b")).collect()
    assert [r["v"] for r in rows] == values
    assert [r["b"] for r in rows] == values
    assert {len(r["t"]) for r in rows} == {20}


def test_sortable_decimals(spark):
    values = [Decimal(v) for v in ("-10.50", "-10.49", "-0.01", "0.00", "0.01", "9.99", "10.00")]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(10,2)").withColumn(
        "t", sortable.encode_number(F.col("v"), 5, 2)
    )
    back = sortable.decode_number(F.col("t"), "decimal(10,2)").alias("b")
    assert [r["b"] for r in df.orderBy("t").select(back).collect()] == values
    with pytest.raises(PySparkException):
        df.select(sortable.encode_number(F.col("v"), 1, 2)).collect()
    null = spark.range(1).select(sortable.encode_number(F.lit(None).cast("int"))).first()[0]
    assert null is None
