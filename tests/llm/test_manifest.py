import zlib

import brute
import pytest
from pyspark.sql import functions as F

from pigeonhole.llm import merkle, queries
from pigeonhole.llm.ordering import ranked
from pigeonhole.llm.tables import configured

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def fifth(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def check(spark, rows, extra=False):
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    if extra:
        docs = docs.selectExpr("*", "1 as tree", "'x' as idx", "2 as n", "'y' as digest", "3 as run", "'z' as path", "4 as _at")
    got = merkle.manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    assert rows_of(got) == sorted(brute.merkle(rows, fifth), key=repr)


def test_sizes_around_the_powers_of_the_arity(spark):
    sizes = {"a": 1, "b": 2, "c": 16, "d": 17, "é": 33, "z": 257, "": 3}
    check(spark, [(i * 7 % 1009, s, "en", i, f"Text {i} of {s}") for s, n in sizes.items() for i in range(n)])


def test_nulls_ties_repeated_rows_long_texts_and_other_columns(spark):
    rows = [(i, None, None, None, None) for i in range(20)]
    rows += [(None, "s", "en", 1, "No id A"), (None, "s", "en", 1, "No id B"), (5, "s", None, 3, "")]
    rows += [(5, "s", "en", 3, "Twice")] * 3 + [(5, "s", "en", 3, "Other"), (-7, "s", "de", -1, "ÄÖ Upper É")]
    rows += [(10, "t", "en", 9, "LONG word " * 100_000)]
    check(spark, rows, extra=True)


def test_one_row_and_none(spark):
    check(spark, [(1, "s", "en", 1, "A")])
    check(spark, [])


def test_tampering_is_found_and_only_where_it_changes_a_text(spark):
    rows = [(i, "s", "en", 1, "lower" if i % 2 else "Upper") for i in range(100)]
    docs = spark.createDataFrame(rows, DOCS)
    found = {r["doc_id"]: r["verified"] for r in merkle.manifest(docs, F.col("doc_id") < 50).collect()}
    assert found == {i: i % 2 == 1 or i >= 50 for i in range(100)}
    assert all(r["verified"] for r in merkle.manifest(docs).collect())


def test_other_arities(spark):
    rows = [(i, f"s{i % 3}", "en", 1, f"T{i}") for i in range(50)]
    docs = spark.createDataFrame(rows, DOCS)
    for arity in (2, 3):
        want = sorted(brute.merkle(rows, fifth, arity), key=repr)
        assert rows_of(merkle.manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 5 == 0, arity)) == want


def test_levels_are_joined_without_another_exchange(spark):
    nodes = spark.range(1 << 30).selectExpr("string(id % 3) as tree", "id as idx", "id as n", "unhex(sha2(string(id), 256)) as digest")
    with configured(spark, merkle.BY_SOME_KEYS, "false"):
        plan = merkle.siblings(nodes)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "REPARTITION_BY_COL" in plan and "ENSURE_REQUIREMENTS" not in plan


def test_ranks_of_a_group_with_most_rows(spark):
    rows = [("hot", i * 7 % 5000) for i in range(5000)] + [("cold", i) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, v bigint").repartition(7)
    got = {(r["g"], r["v"]): (r["rank"], r["members"]) for r in ranked(df, "g", [F.col("v")]).collect()}
    assert got == {(g, v): (v, 5000 if g == "hot" else 10) for g, v in rows}


def test_query_equals_brute_force(spark, sf_dir, documents):
    rows = [tuple(r) for r in documents[["doc_id", "source", "lang", "n_chars", "text"]].itertuples(index=False)]
    got = queries.QUERIES["op11_merkle"](spark, sf_dir)
    assert rows_of(got) == sorted(brute.merkle(rows, fifth), key=repr)
    assert not all(r["verified"] for r in got.collect())


@pytest.mark.parametrize("name", ["op11_merkle", "op13_mixing"])
def test_query_equals_sql(spark, sf_dir, name):
    from compare import connect

    df = queries.QUERIES[name](spark, sf_dir)
    want = connect(sf_dir).execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(want.fetchall())
