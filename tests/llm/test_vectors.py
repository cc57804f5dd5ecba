"""Operators 4 and 8 against brute force."""

import numpy as np
import pandas as pd
import pytest

from pigeonhole.llm import nearest, queries, topk


def best(ids, score, own, k=10):
    """The k candidates with the least score, ties to smaller ids."""
    order = [j for j in np.lexsort((ids, score)) if ids[j] != own]
    return [ids[j] for j in order[:k]]


@pytest.fixture(scope="module")
def given_vectors(sf_dir):
    table = pd.read_parquet(f"{sf_dir}/embeddings.parquet").sort_values("vec_id")
    return table.vec_id.to_numpy(), np.stack(table.embedding).astype(float)


def test_top_k_query(spark, sf_dir, given_vectors):
    ids, x = given_vectors
    v = np.floor(1024 * x).astype(int)
    rows = queries.QUERIES["op4_top_k"](spark, sf_dir).collect()
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows)
    want = []
    for a in np.flatnonzero(ids % 100 == 0):
        score = v @ v[a]
        by = dict(zip(ids, score, strict=True))
        want += [(ids[a], k + 1, i, by[i]) for k, i in enumerate(best(ids, -score, ids[a]))]
    assert got == sorted(want)


def test_nearest_query(spark, sf_dir, given_vectors):
    ids, x = given_vectors
    rows = queries.QUERIES["op8_nearest"](spark, sf_dir).toPandas()
    found = total = 0
    for a in np.flatnonzero(ids % 100 == 0):
        distance = np.sqrt(((x - x[a]) ** 2).sum(1))
        own = rows[rows.query_id == ids[a]].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11))
        assert np.allclose(own.score, distance[np.searchsorted(ids, own.vec_id)], rtol=1e-12)
        assert (own.score.diff().dropna() >= 0).all()
        found += len(set(best(ids, distance, ids[a])) & set(own.vec_id))
        total += 10
    assert found / total >= 0.9


def test_nearest_with_all_ranges(vectors_of, given_vectors):
    """3,000 rows have the 40 ranges of production; components in another order make further rows."""
    ids, x = given_vectors
    r = np.random.default_rng(4)
    x = np.concatenate([x[:, r.permutation(x.shape[1])] for _ in range(-(-3_000 // len(x)))])[:3_000]
    assert len(nearest.thinned(np.arange(nearest.RANGES - 1), len(x))) == nearest.RANGES - 1
    rows = nearest.nearest(vectors_of(list(enumerate(x.tolist())))).toPandas()
    hits = []
    for a in range(0, len(x), 100):
        distance = np.sqrt(((x - x[a]) ** 2).sum(1))
        own = rows[rows.query_id == a].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11))
        hits.append(len(set(best(np.arange(len(x)), distance, a)) & set(own.vec_id)))
    print("recall with 40 ranges:", np.mean(hits) / 10)
    assert np.mean(hits) / 10 >= 0.9


ODD = [
    (0, [1.0, 2.0]), (100, [1.0, 2.0]), (100, [1.0, 2.0]), (3, [1.0, 2.0]), (4, None), (5, [None, 1.0]), (200, [float("nan"), 1.0]),
    (6, [float("inf"), 1.0]), (7, [0.0, 0.0]), (8, [1.0]), (300, [2.0]), (400, []), (9, [-3.0, 0.5]), (None, [1.0, 1.0]),
]


@pytest.mark.parametrize("block_rows", [8192, 2])
def test_odd_vectors(vectors_of, block_rows):
    rows = topk.top_k(vectors_of(ODD), block_rows=block_rows).collect()
    own = {r["query_id"] for r in rows}
    assert own == {0, 100, 300}
    first = sorted((r["rank"], r["vec_id"], r["score"]) for r in rows if r["query_id"] == 0)
    square = 1024 * 1024 + 2048 * 2048
    assert first == [(1, 3, square), (2, 100, square), (3, 100, square), (4, 7, 0), (5, 9, -3 * 1024 * 1024 + 512 * 2048)]
    near = nearest.nearest(vectors_of(ODD), block_rows=block_rows).collect()
    zero = sorted((r["rank"], r["vec_id"], r["score"]) for r in near if r["query_id"] == 0)
    assert [z[1] for z in zero] == [3, 100, 9] and [z[2] for z in zero[:2]] == [0.0, 0.0]
    assert all(r["vec_id"] != 7 and r["query_id"] != r["vec_id"] for r in near)
    assert topk.top_k(vectors_of([])).count() == 0 and nearest.nearest(vectors_of([])).count() == 0


@pytest.mark.parametrize("block_rows", [8192, 16])
def test_every_query_row_has_its_own_top_k(vectors_of, block_rows):
    """Ids 100 and 200 come twelve times with one vector, 300 with two; id 7 comes twelve times as a candidate."""
    r = np.random.default_rng(3)
    rows = [(i, np.float32(r.normal(size=8)).tolist()) for i in range(301)]
    rows += [rows[100], rows[200]] * 11 + [(300, np.float32(r.normal(size=8)).tolist())] + [(7, [9.0] * 8)] * 12
    ids, v = np.array([i for i, _ in rows]), np.floor(1024 * np.array([x for _, x in rows])).astype(int)
    want = []
    for a in np.flatnonzero(ids % 100 == 0):
        score = v @ v[a]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[a]][:10]
        want += [(ids[a], n + 1, ids[j], score[j]) for n, j in enumerate(order)]
    got = topk.top_k(vectors_of(rows), block_rows=block_rows).collect()
    assert sorted((x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in got) == sorted(want)


def test_many_equal_vectors(vectors_of):
    """A third of the rows share one vector: ties go to the smallest ids."""
    r = np.random.default_rng(0)
    rows = [(i, [1.0] * 8 if i % 3 == 0 else r.normal(size=8).tolist()) for i in range(600)]
    for search in (topk.top_k, nearest.nearest):
        found = search(vectors_of(rows), block_rows=64)
        own = [x["vec_id"] for x in found.where("query_id = 300").orderBy("rank").collect()]
        if search is nearest.nearest:
            assert own == [0, 3, 6, 9, 12, 15, 18, 21, 24, 27]
        assert len(own) == 10


def test_bounds_hold():
    r = np.random.default_rng(2)
    q, x = np.floor(r.normal(size=(20, 50)) * 1024), np.floor(r.normal(size=(300, 50)) * 1024)
    x[:30] = q[0] + r.integers(-50, 50, (30, 50))
    exact = q @ x.T
    for n in topk.LEVELS:
        assert (topk.statistics(q, n) @ topk.statistics(x, n).T >= exact - 1e-3).all()
    qi, xi = np.arange(20) + 1000, np.arange(300)
    a, b, s = topk.search(q, qi, x, xi, 10)
    for k in range(20):
        assert xi[b[a == k]].tolist() == best(xi, -exact[k], -1)


def test_every_query_row_has_its_own_neighbours(vectors_of):
    """Two rows of id 100 lie far from each other; each finds what is around it."""
    rows = [(100, [0.5]), (100, [100.0]), (100, [100.0])] + [(i, [float(i)]) for i in range(1, 10)] + [(i, [90.0 + i]) for i in range(11, 20)]
    found = nearest.nearest(vectors_of(rows), k=3).collect()
    lists = {}
    for r in sorted(found, key=lambda r: (r["rank"], r["score"], r["vec_id"])):
        lists.setdefault((r["query_id"], r["rank"]), []).append((r["vec_id"], r["score"]))
    assert lists[100, 1] == [(1, 0.5), (11, 1.0), (11, 1.0)]
    assert lists[100, 2] == [(2, 1.5), (12, 2.0), (12, 2.0)]
    assert len(found) == 9


def test_scores_beyond_64_bits_are_the_largest_ones(vectors_of):
    big = 3.0e38
    rows = [(0, [big, 1.0]), (1, [big, 0.0]), (2, [big, 5.0]), (3, [-big, 0.0]), (4, [0.0, 1.0])]
    found = [(r["vec_id"], r["score"]) for r in topk.top_k(vectors_of(rows)).orderBy("rank").collect()]
    top = np.iinfo(np.int64)
    assert found == [(1, top.max), (2, top.max), (4, 1024 * 1024), (3, top.min)]
