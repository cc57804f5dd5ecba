import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("pigeonhole-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    from pigeonhole import Store

    return Store(spark, str(tmp_path / "tables"))


@pytest.fixture
def made(spark):
    """Rows 0..n-1 whose field f holds ``<f>-value-<i>``."""

    def make(fields, count):
        rows = [tuple(f"{f}-value-{i}" for f in fields) for i in range(count)]
        from pyspark.sql import types as T

        schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
        return spark.createDataFrame(rows, schema)

    return make
