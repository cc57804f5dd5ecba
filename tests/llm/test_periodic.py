import hashlib
import zlib

import brute
import numpy as np
import pytest

from pigeonhole.llm import periodic, queries


def runs_by_id(docs, **more):
    return {r["doc_id"]: ([tuple(x) for x in r["runs"]], r["collapsed"], r["n_words"]) for r in periodic.collapse(docs, **more).collect()}


def expected(text, **more):
    words = [] if text is None else [w.decode() for w in text.encode().split()]
    runs = brute.periodic_runs(words, **more)
    return runs, brute.collapsed(words, runs), len(words)


def test_texts_against_brute_force(spark, docs_of):
    rng = np.random.default_rng(5)
    texts = [None, "", "  \t ", "one", "a " * 23, "a " * 24, "a b " * 12, "x " + "a b c " * 9 + "a y", "a b " * 30, "a\x0bb\x0c" * 20]
    for _ in range(120):
        parts = []
        for _ in range(rng.integers(1, 6)):
            p = int(rng.integers(1, 25))
            unit = [f"w{x}" for x in rng.integers(0, rng.integers(1, 6), p)]
            parts += (unit * 12)[: int(rng.integers(1, 8 * p + 2))] + [f"v{x}" for x in rng.integers(0, 40, rng.integers(0, 30))]
        texts.append(" ".join(parts))
    got = runs_by_id(docs_of(texts))
    assert got == {i: expected(t) for i, t in enumerate(texts)}
    assert sum(len(r) for r, _, _ in got.values()) > 100


def test_nested_runs_and_thresholds_of_the_caller(spark, docs_of):
    inner = "a " * 9 + "b "
    texts = [inner * 4, inner * 2, "q r s " * 3, "q r s " * 2]
    for least, times in ((24, 3), (8, 2), (9, 3)):
        got = runs_by_id(docs_of(texts), least=least, times=times)
        assert got == {i: expected(t, least=least, times=times) for i, t in enumerate(texts)}


def test_wrong_hashes_are_found_out(monkeypatch):
    rng = np.random.default_rng(2)
    word = np.concatenate([np.tile(rng.integers(0, 3, p), 5) for p in (7, 9, 4, 30)])
    want = [(a, a + n, q) for a, n, q in brute.periodic_runs(word.tolist())]
    monkeypatch.setattr(periodic.Prefixes, "equal", lambda self, a, b, n: np.ones(len(a), bool))
    start, stop, period = periodic.find(word, np.array([0, len(word)]))
    assert list(zip(start, stop, period, strict=True)) == want


def test_segments_have_no_rare_word():
    rng = np.random.default_rng(3)
    word, of_doc = rng.integers(0, 60, 4000), np.array([0, 1500, 1500, 4000])
    starts, stops = periodic.segments(word, of_doc)
    assert len(starts) and (stops - starts >= 24).all() and (starts[1:] >= stops[:-1]).all()
    for a, b in zip(starts, stops, strict=True):
        assert np.bincount(word[a:b])[word[a:b]].min() >= 3


def test_very_long_texts(spark, docs_of):
    texts = ["same " * 300_000, "tick tock " * 100_000 + "end", " ".join(f"w{i % 977}" for i in range(200_000))]
    got = runs_by_id(docs_of(texts))
    assert got[0] == ([(0, 300_000, 1)], "same", 300_000)
    assert got[1] == ([(0, 200_000, 2)], "tick tock end", 200_001)
    assert got[2] == ([(0, 200_000, 977)], " ".join(f"w{i}" for i in range(977)), 200_000)


def test_repeated_ids_empty_tables_and_other_columns(spark, docs_of):
    text = "x y " * 20
    docs = docs_of([(1, text), (1, text), (1, "z"), (None, text)]).selectExpr("*", "1 as runs", "2 as n_words", "3 as collapsed")
    got = sorted(((r["doc_id"], len(r["runs"])) for r in periodic.collapse(docs, queries._planted).collect()), key=repr)
    assert got == [(1, 0), (1, 1), (1, 1), (None, 1)]
    assert periodic.collapse(docs_of([])).collect() == []


def query_row(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute.periodic_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = brute.collapsed(words, runs)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return doc_id, len(runs), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, left))


@pytest.mark.parametrize("size", ["sf0.001"])
def test_query_equals_brute_force(spark, size):
    import pandas as pd

    sf_dir = f"/root/testdata/{size}"
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, sf_dir).collect()}
    assert got == {r.doc_id: query_row(r.doc_id, r.text) for r in docs.itertuples()}
    assert sum(r[1] for r in got.values()) > 10
