"""Reading the given tables, and tables written on the way."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import pigeonhole
from pigeonhole.llm.text import flat, pieces
from pigeonhole.sources import files

_SHIPPED: set[str] = set()


#: Rows and bytes of texts handed to Python at once, where the session leaves Spark's defaults.
#: A default batch of 10,000 texts takes tens of MB in the JVM and again in every worker.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8388608b")}


def ship(spark: SparkSession) -> None:
    """Prepare an application for the Python steps: bounded batches, and this library for the workers."""
    app = spark.sparkContext.applicationId
    for name, (default, value) in BATCH.items():
        if spark.conf.get(name, default) == default:
            spark.conf.set(name, value)
    if app in _SHIPPED or not os.path.isdir(os.path.dirname(pigeonhole.__file__)):
        return
    top = os.path.dirname(os.path.abspath(pigeonhole.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="pigeonhole-code-"), "pigeonhole_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)



def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts its lineage."""
    path = files.scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.scratch = path
    return back


def dropped(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more: all that came of them has been written."""
    for t in tables:
        files.delete(t.sparkSession, t.scratch)


@contextmanager
def configured(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the plans that are made and run inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def cleaned(spark: SparkSession):
    """Inside, shuffle files go once what they were for has run; else they stay until the driver's next large collection."""
    return configured(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def settled(df: DataFrame, label: str) -> DataFrame:
    """``written``, and then without the shuffle files it took."""
    with cleaned(df.sparkSession):
        return written(df, label)


def remainder(key: str, by: int) -> Column:
    """crc32 of an id as text, modulo ``by``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(by)


def texts(docs: DataFrame) -> DataFrame:
    """Only id and text, under those names, whatever else a table holds."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def kept(docs: DataFrame, test: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """The rows, with all their columns, for whose texts a test of flat texts holds."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            yield piece.filter(pa.array(test(*flat(piece.column("text")))))

    return docs.mapInArrow(run, docs.schema)
