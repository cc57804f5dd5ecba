"""What the vector searches share: usable vectors, blocks of them, and merging of best lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pigeonhole.llm.tables import ship


def usable(vectors: DataFrame, zero: bool) -> DataFrame:
    """vec_id, v (array of double) and dim of vectors without null or non-finite components.

    ``zero`` says whether vectors of length 0 take part.
    """
    ship(vectors.sparkSession)
    v = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine)
    if not zero:
        v = v.where(F.exists("v", lambda x: x != 0))
    return v.withColumn("dim", F.size("v"))


def is_query() -> Column:
    """The stated query set: every hundredth id."""
    return F.col("vec_id") % 100 == 0


def matrix(table: pa.Table, column: str = "v") -> np.ndarray:
    """Rows of equal length as a matrix."""
    if table.num_rows == 0:
        return np.zeros((0, 0))
    lists = table.column(column).combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(table.num_rows, -1)


def ids(table: pa.Table) -> np.ndarray:
    return table.column("vec_id").combine_chunks().to_numpy().astype(np.int64)


def keep_best(query: np.ndarray, value: np.ndarray, vec: np.ndarray, k: int) -> np.ndarray:
    """Indices of each query's k entries with least value, ties to the smaller id, in that order."""
    order = np.lexsort((vec, value, query))
    q = query[order]
    new = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, int)
    place = np.arange(len(q)) - np.repeat(new, np.diff(np.append(new, len(q))))
    return order[place < k]


def ranked(found: DataFrame, best_first: Column, k: int, by: str = "query_id", *also: str) -> DataFrame:
    """Each query's k best of (query_id, vec_id, score) rows, with ranks from 1; ``by`` tells queries apart."""
    order = Window.partitionBy(by).orderBy(best_first, "vec_id")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", *also)
