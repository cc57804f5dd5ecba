import pytest
from pyspark.sql import types as T

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts, or from (id, text) pairs."""

    def make(texts):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    import pandas as pd

    return pd.read_parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def vectors_of(spark):
    schema = T.StructType(
        [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.StringType())]
    )

    def make(rows):
        return spark.createDataFrame([(i, v, "x") for i, v in rows], schema)

    return make
