"""Exact top-k by integer inner product with multi-resolution segment statistics (operator 4).

Queries and candidates are dealt into blocks of bounded size, and every pair of blocks is one
group of a cogroup, so that each task holds one block of either. Within a pair, candidates
come in runs. A vector is cut into 4, then 8, then 16 segments; segment means and deviations
give a lower bound of the distance, so an upper bound of the inner product. Coarse to fine,
pairs whose bound is below the query's k-th best score so far drop out; exact products are
taken of the survivors, pair by pair where they are few and as a matrix product where they
are many. Both ways give the same integers.

Defined cases: vectors that are null or hold null or non-finite components take no part;
vectors are compared with those of their own length only; ids that repeat are candidates each
for itself, but never for a query of the same id; empty tables give no rows; other columns
are ignored. A score beyond 64 bits counts as the largest or least number of 64 bits, and a
component beyond the range of doubles once scaled as the largest one; ties still go by id.

Every query row has its own ranks from 1. An id with several query rows has so many results, one
after the other under the same query_id; rows with equal vectors have equal results. Equal rows
are searched once, and as candidates count as often as they come, up to k times.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pigeonhole.llm.tables import written
from pigeonhole.llm.vectors import ids, is_query, keep_best, matrix, ranked, usable

LEVELS = (4, 8, 16)
BLOCK_ROWS, RUN_ROWS = 8_192, 1_024
#: Below this share of survivors exact products are taken pair by pair.
FEW = 0.05


def statistics(v: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of equal segments, scaled so that a product of rows bounds the inner product."""
    width = max(1, -(-v.shape[1] // segments))
    padded = np.zeros((len(v), width * segments))
    padded[:, : v.shape[1]] = v
    cut = padded.reshape(len(v), segments, width)
    return np.concatenate([cut.mean(2), cut.std(2)], 1) * np.sqrt(width)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows, as integers."""
    reach = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(a.shape[1], 1)
    if reach < 2**53:
        return np.rint(a @ b.T).astype(np.int64)
    whole = np.array([[int(x) for x in r] for r in a], object).reshape(a.shape) @ np.array([[int(x) for x in r] for r in b], object).reshape(b.shape).T
    return np.clip(whole, np.iinfo(np.int64).min, np.iinfo(np.int64).max).astype(np.int64)


def _whole(table: pa.Table) -> np.ndarray:
    """floor(1024 x) of all components."""
    with np.errstate(over="ignore"):
        v = np.floor(matrix(table) * 1024)
    return np.clip(v, -np.finfo(float).max, np.finfo(float).max)


def search(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Query index, row index and score of each query's k best among the rows."""
    with np.errstate(over="ignore", invalid="ignore"):
        return _search(queries, query_ids, rows, row_ids, k)


def _search(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    nq = len(queries)
    best_q, best_r, best_s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    limit = np.full(nq, -np.inf)
    coarse = [statistics(queries, n) for n in LEVELS]
    size = np.sqrt((queries**2).sum(1))
    small = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(rows.shape[1], 1) < 2**53
    start, step = 0, 64
    while start < len(rows):
        run = rows[start : start + step]
        # Rounding of the bounds is far below a part in 10^9 of the vectors' lengths.
        slack = 1e-9 * size[:, None] * np.sqrt((run**2).sum(1))[None, :] + 1e-6
        live = np.ones((nq, len(run)), bool)
        for level, n in enumerate(LEVELS):
            share = live.mean()
            if share < FEW:
                q, r = np.nonzero(live)
                own = statistics(run, n)
                bound = (coarse[level][q] * own[r]).sum(1)
                live[q, r] = ~(bound + slack[q, r] < limit[q])
            else:
                # A bound that is no number, of components beyond all measure, drops nothing.
                live &= ~(coarse[level] @ statistics(run, n).T + slack < limit[:, None])
        live &= query_ids[:, None] != row_ids[None, start : start + step]
        if small and live.mean() < FEW:
            q, r = np.nonzero(live)
            score = np.rint((queries[q] * run[r]).sum(1)).astype(np.int64)
            kept = score >= limit[q]
            q, r, score = q[kept], r[kept], score[kept]
        else:
            every = exact(queries, run)
            q, r = np.nonzero(live & (every >= limit[:, None]))
            score = every[q, r]
        best_q, best_r = np.concatenate([best_q, q]), np.concatenate([best_r, r + start])
        best_s = np.concatenate([best_s, score])
        kept = keep_best(best_q, -best_s, row_ids[best_r], k)
        best_q, best_r, best_s = best_q[kept], best_r[kept], best_s[kept]
        full = np.bincount(best_q, minlength=nq) >= k
        last = np.full(nq, np.inf)
        np.minimum.at(last, best_q, best_s)
        limit = np.where(full, last, -np.inf)
        start += step
        step = min(step * 4, RUN_ROWS)
    return best_q, best_r, best_s


def _pair(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_row", "times", "query_id", "vec_id", "score"]
        if rows.num_rows == 0 or queries.num_rows == 0:
            empty = pa.array([], pa.int64())
            return pa.Table.from_arrays([empty] * 5, names)
        q, r = _whole(queries), _whole(rows)
        qi, ri = ids(queries), ids(rows)
        a, b, s = search(q, qi, r, ri, k)
        of_query = [queries.column(c).combine_chunks().take(pa.array(a)) for c in ("row", "times")]
        return pa.Table.from_arrays([*of_query, pa.array(qi[a]), pa.array(ri[b]), pa.array(s)], names)

    return run


def top_k(vectors: DataFrame, k: int = 10, queries: Column | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k largest inner products of floor(1024 x)."""
    distinct = usable(vectors, zero=True).groupBy("vec_id", "dim", "v").agg(F.count("*").alias("times"))
    # Numbers of rows hold only once they are written.
    distinct = written(distinct.withColumn("row", F.monotonically_increasing_id()), "distinct-vectors")
    asked = distinct.where(is_query() if queries is None else queries)
    copies = F.least("times", F.lit(k))
    n, m = distinct.agg(F.coalesce(F.sum(copies), F.lit(0))).first()[0], asked.count()
    blocks, parts = max(1, -(-n // block_rows)), max(1, -(-m // block_rows))
    all_rows = distinct.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))

    def dealt(df: DataFrame, by: list[str], own: str, count: int, other: str, times: int) -> DataFrame:
        df = df.withColumn(own, F.pmod(F.xxhash64(*by), F.lit(count)).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(times - 1))))

    c = dealt(all_rows, ["row", "copy"], "c_block", blocks, "q_block", parts).groupBy("dim", "c_block", "q_block")
    q = dealt(asked, ["row"], "q_block", parts, "c_block", blocks).groupBy("dim", "c_block", "q_block")
    found = c.cogroup(q).applyInArrow(_pair(k), "query_row bigint, times bigint, query_id bigint, vec_id bigint, score bigint")
    top = ranked(found, F.desc("score"), k, "query_row", "times")
    return top.withColumn("time", F.explode(F.sequence(F.lit(1).cast("bigint"), "times"))).drop("time", "times")
