import collections

import brute
import pytest

from pigeonhole.llm import mixing, queries


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(3)


def mixed(df, **more):
    rows = mixing.mix(df, **more).collect()
    assert all(r["taken"] == r["copies"] * r["size"] for r in rows)
    return sorted((tuple(r)[:5] for r in rows), key=repr)


def same(got, want):
    want = sorted(want, key=repr)
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])


def words(n):
    return " ".join(f"w{i}" for i in range(n))


def test_sources_of_all_sizes_against_fractions(spark):
    counts = {"a": 400, "b": 3, "c": 50, "d": 1, "Z": 20, "é": 5, None: 7}
    rows = [(i, s, words(1 + i * 37 % 90)) for s, n in counts.items() for i in range(n)]
    same(mixed(table(spark, rows)), brute.mixed(rows))
    same(mixed(table(spark, rows), weights=(1,), most=2, seed=4), brute.mixed(rows, (1,), 2, 4))


def test_taken_words_come_near_the_target(spark):
    rows = [(i, f"s{i % 8}", words(1 + i * i % 211)) for i in range(3000)]
    taken, target, largest = collections.Counter(), {}, collections.Counter()
    for r, source in ((r, f"s{r['doc_id'] % 8}") for r in mixing.mix(table(spark, rows)).collect()):
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
        target[source] = r["target"]
        largest[source] = max(largest[source], r["size"])
    assert all(abs(taken[s] - target[s]) < largest[s] for s in target)
    assert sum(target.values()) == pytest.approx(sum(len(t.split()) for _, _, t in rows))


def test_a_source_with_most_rows_on_any_partitions(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 30}", words(i % 50)) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = [mixed(docs.repartition(n)) for n in (1, 13)]
    assert got[0] == got[1]
    same(got[0], brute.mixed(rows))


def test_nulls_empty_texts_repeated_rows_and_other_columns(spark):
    rows = [(None, None, None), (1, "s", ""), (1, "s", " \t\n"), (2, "s", "a b"), (2, "s", "a b"), (2, "s", "c d e"), (3, "void", None)]
    rows += [(4, "t", "a b\x0bc\x1cd")]
    docs = table(spark, rows).selectExpr("*", "1 as size", "'x' as rank", "2 as target", "3 as source_key", "4 as members", "'y' as _at")
    got = mixed(docs)
    same(got, brute.mixed(rows))
    assert [r for r in got if r[0] == 3] == [(3, 0, 0, 0.0, 0)]
    assert mixed(table(spark, [])) == []
    same(mixed(table(spark, rows[:2])), brute.mixed(rows[:2]))


def test_main_path_has_no_python(spark, sf_dir):
    plan = queries.QUERIES["op13_mixing"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_equals_brute_force(spark, sf_dir, documents):
    rows = [tuple(r) for r in documents[["doc_id", "source", "text"]].itertuples(index=False)]
    got = [(r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in queries.QUERIES["op13_mixing"](spark, sf_dir).collect()]
    same(sorted(got, key=repr), [(i, n, w, t, c * n) for i, n, w, t, c in brute.mixed(rows)])
