"""Approximate nearest neighbours along shifted space-filling curves (operator 8).

Each of ``CURVES`` curves projects vectors onto a few random directions, shifts and scales
them, and orders them along a Hilbert curve. A curve's order is cut at quantiles of its keys
into ``RANGES`` key ranges; a query looks at its own range and ``REACH`` ranges on either side.
Ranges are dealt into blocks of bounded size (by how many rows they really hold, so a vector
that a third of all rows share is split), and each block with its queries is one cogroup, in
which exact distances pick the best. The windows of all curves are merged and ranked.

A window is a share of the rows, so recall does not fall with the number of rows. A table of fewer
than ``RANGES * LEAST_ROWS`` (2,560) rows has rows // ``LEAST_ROWS`` ranges, one at least, so its
windows are larger shares and its recall says nothing of ``RANGES`` ranges. Projections
use a scale from a bounded statistic (mean and deviation of each component over all rows).

Defined cases: vectors that are null, zero or hold null or non-finite components take no part;
vectors are compared with those of their own length only; an id that repeats is a candidate
once for each query, with its least distance, and never for a query of the same id; every query
row has its own ranks, so an id with several query rows has so many lists, equal ones for equal
vectors; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pigeonhole.llm.tables import written
from pigeonhole.llm.vectors import ids, is_query, keep_best, matrix, ranked, usable

CURVES, RANGES, REACH = 16, 40, 2
DIRECTIONS, BITS = 6, 8
BLOCK_ROWS = 8_192
#: Rows of a range at least; a small table has fewer ranges, and one of few rows is searched whole.
LEAST_ROWS = 64


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of integer points, by the public transpose algorithm."""
    x = [c.astype(np.int64) for c in cells.T]
    n, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[i] & q) > 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    t, q = np.zeros_like(x[0]), top
    while q > 1:
        t = np.where((x[-1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ t) >> b) & 1)
    return key


def curve_keys(v: np.ndarray, mean: np.ndarray, scale: float) -> np.ndarray:
    """One key a curve for every row."""
    out = np.zeros((len(v), CURVES), np.int64)
    d = v.shape[1]
    for c in range(CURVES):
        random = np.random.default_rng([c, d])
        directions = np.linalg.qr(random.normal(size=(d, min(d, DIRECTIONS))))[0]
        z = (v - mean) @ directions / scale + random.uniform(-0.5, 0.5, directions.shape[1])
        cells = np.clip((z + 4) / 8 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
        out[:, c] = hilbert(cells, BITS)
    return out


def thinned(cuts: np.ndarray, rows: int) -> np.ndarray:
    """Distinct cuts, so few that a range has about LEAST_ROWS; none if all rows are one range."""
    ranges = max(1, min(RANGES, rows // LEAST_ROWS))
    return np.unique(cuts[np.arange(1, ranges) * RANGES // ranges - 1])


def _pair(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_row", "query_id", "vec_id", "score"]
        found: list[list[np.ndarray]] = [[], [], [], []]
        if rows.num_rows and queries.num_rows:
            q, r, qi, ri = matrix(queries), matrix(rows), ids(queries), ids(rows)
            own_row = queries.column("row").combine_chunks().to_numpy()
            order = np.argsort(ri, kind="stable")
            r, ri = r[order], ri[order]
            square = (r**2).sum(1)
            for start in range(0, len(q), 256):
                part, own, number = (x[start : start + 256] for x in (q, qi, own_row))
                rough = (part**2).sum(1)[:, None] + square[None, :] - 2 * part @ r.T
                rough[own[:, None] == ri[None, :]] = np.inf
                # All whose rough distance may be among the best are measured exactly.
                edge = np.partition(rough, min(k, len(r)) - 1, axis=1)[:, min(k, len(r)) - 1]
                slack = 1e-9 * ((part**2).sum(1) + square.max())
                a, b = np.nonzero(np.isfinite(rough) & (rough <= (edge + slack)[:, None]))
                exact = np.sqrt(((part[a] - r[b]) ** 2).sum(1))
                kept = keep_best(a, exact, ri[b], k)
                for to, x in zip(found, (number[a[kept]], own[a[kept]], ri[b[kept]], exact[kept]), strict=True):
                    to.append(x)
        kinds = (np.int64, np.int64, np.int64, float)
        return pa.Table.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, t)) for x, t in zip(found, kinds, strict=True)], names)

    return run


def nearest(vectors: DataFrame, k: int = 10, queries: Column | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest found, by Euclidean distance."""
    all_rows = usable(vectors, zero=False)
    asked = is_query() if queries is None else queries
    spread = all_rows.select("dim", F.posexplode("v").alias("i", "x")).groupBy("dim", "i")
    moments = spread.agg(F.avg("x").alias("mean"), F.var_pop("x").alias("var")).collect()  # one row a component
    centre = {}
    for dim in {r["dim"] for r in moments}:
        own = sorted((r["i"], r["mean"], r["var"]) for r in moments if r["dim"] == dim)
        centre[dim] = np.array([m for _, m, _ in own]), max(float(np.sqrt(np.mean([v for *_, v in own]))), 1e-300)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims):
                own = pa.Table.from_batches([b.filter(pa.array(dims == dim))])
                key = curve_keys(matrix(own), *centre[dim])
                lists = pa.FixedSizeListArray.from_arrays(pa.array(key.ravel()), CURVES).cast(pa.list_(pa.int64()))
                columns = [own.column(c).combine_chunks() for c in ("vec_id", "dim", "v")]
                yield pa.RecordBatch.from_arrays([*columns, lists], ["vec_id", "dim", "v", "keys"])

    keyed = all_rows.select("vec_id", "dim", "v").mapInArrow(keys, "vec_id bigint, dim int, v array<double>, keys array<bigint>")
    # Numbers of rows hold only once they are written.
    keyed = written(keyed.withColumn("row", F.monotonically_increasing_id()), "curve-keys")
    along = keyed.select("dim", F.posexplode("keys").alias("curve", "key")).groupBy("dim", "curve")
    quantiles = F.percentile_approx("key", [i / RANGES for i in range(1, RANGES)], 10_000)
    cuts = along.agg(quantiles.alias("cuts"), F.count("*").alias("n")).collect()  # RANGES - 1 numbers a curve
    cut = {(r["dim"], r["curve"]): thinned(np.array(r["cuts"]), r["n"]) for r in cuts}

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, lists = b.column("dim").to_numpy(), b.column("keys")
            key = lists.flatten().to_numpy().reshape(-1, CURVES)
            out = np.zeros((len(dims), CURVES), np.int32)
            for dim in np.unique(dims):
                own = dims == dim
                for c in range(CURVES):
                    out[own, c] = np.searchsorted(cut[dim, c], key[own, c])
            made = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), CURVES).cast(pa.list_(pa.int32()))
            own = [b.column(c) for c in ("row", "vec_id", "dim", "v")]
            yield pa.RecordBatch.from_arrays([*own, made], ["row", "vec_id", "dim", "v", "ranges"])

    ranged = keyed.mapInArrow(ranges, "row bigint, vec_id bigint, dim int, v array<double>, ranges array<int>")
    rows = ranged.select("row", "vec_id", "dim", "v", F.posexplode("ranges").alias("curve", "range"))
    sizes = rows.groupBy("dim", "curve", "range").agg(F.count("*").alias("n"), F.sum(asked.cast("int")).alias("m"))
    sizes = sizes.select("dim", "curve", "range", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"))
    sizes = F.broadcast(sizes)  # one row a range of a curve
    salt = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    c = rows.join(sizes, ["dim", "curve", "range"]).withColumn("block", salt)
    near = F.sequence(F.greatest(F.col("range") - REACH, F.lit(0)), F.col("range") + REACH)
    q = rows.where(asked).withColumn("range", F.explode(near)).join(sizes, ["dim", "curve", "range"])
    q = q.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    by = ["dim", "curve", "range", "block"]
    kept = ["vec_id", "v", *by]
    q = q.select([F.col(x).alias(x) for x in ("row", *kept)])  # columns of its own, as both sides come from one table
    found = c.select(kept).groupBy(by).cogroup(q.groupBy(by)).applyInArrow(_pair(k), "query_row bigint, query_id bigint, vec_id bigint, score double")
    merged = found.groupBy("query_row", "query_id", "vec_id").agg(F.min("score").alias("score"))
    return ranked(merged, F.asc("score"), k, "query_row")
