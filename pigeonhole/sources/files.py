"""The few file-system calls the table layer needs, through Hadoop's FileSystem.

Works on whatever file system the path names. Only metadata goes through here; rows are
read and written by Spark.
"""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a directory, empty if there is no such directory."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))


def modified_millis(spark: SparkSession, path: str) -> int:
    fs, p = _open(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    fs, p = _open(spark, path)
    return fs.getContentSummary(p).getLength()


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.delete(p, True)


class AlreadyThere(RuntimeError):
    """A file that may not be replaced exists."""


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file that readers see whole or not at all; an error if it exists.

    The text is written under a hidden name first. On a local file system a link to it makes
    the file appear, elsewhere a rename that may not overwrite. Both are atomic where the file
    system's are (local disks, HDFS); object stores check first and rename then, so tables
    there need a single writer at a time.
    """
    fs, p = _open(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            paths = spark._jvm.java.nio.file.Paths
            none = spark.sparkContext._gateway.new_array(spark._jvm.String, 0)
            at = [paths.get(x.toUri().getPath(), none) for x in (p, hidden)]
            spark._jvm.java.nio.file.Files.createLink(*at)
        else:
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), spark._jsc.hadoopConfiguration()
            )
            option = spark._jvm.org.apache.hadoop.fs.Options.Rename
            kinds = spark.sparkContext._gateway.new_array(option, 1)
            kinds[0] = option.NONE
            context.rename(hidden, p, kinds)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            raise AlreadyThere(path) from e
        raise
    finally:
        fs.delete(hidden, False)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, for intermediate results.

    The one the session names in ``spark.checkpoint.dir``. Only where none is set, as in
    local tests, a temporary one is made and set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pigeonhole-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
