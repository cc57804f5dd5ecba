"""The bounded sample of labelled rows on which classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pigeonhole.llm.tables import texts

#: A classifier is fitted on this many labelled rows at most, however often ids or rows repeat.
SAMPLE_ROWS = 20_000


def labelled(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text and y of the sampled labelled rows; rows without id or label take no part.

    ``usable`` is a condition on doc_id. An id with several labels has the least one. Up to
    ``rows`` labelled ids are picked, those with the least hash; of their rows each text of an id
    counts once, and ``rows`` of these stay at most, those with the least hash of id and text.
    So neither what is broadcast nor the result grows with the tables.
    """
    y = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
    y = y.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).where(usable)
    y = y.groupBy("doc_id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    own = texts(docs).withColumn("_content", F.xxhash64("text"))
    keys = own.select("doc_id", "_content").join(F.broadcast(y), "doc_id").distinct()
    keys = keys.orderBy(F.xxhash64("doc_id", "_content"), "doc_id", "_content").limit(rows)
    sample = own.join(F.broadcast(keys), ["doc_id", "_content"])
    # A row that repeats is one after this, combined in the tasks that read it.
    return sample.groupBy("doc_id", "_content", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y")
