"""Durable sharded tables on Parquet.

Layout of a table below the root of a :class:`Store`::

    <table>/data/v=<version>/shard=<i>/*.parquet
    <table>/stats/v=<version>/*.parquet
    <table>/manifests/<number>.json

A write puts the new rows of the shards it touches under a new version, then creates the
next manifest, which says for every shard in which version its rows are. Readers take the
newest manifest once per operation, so an unfinished or failed write is never seen, no
operation mixes two states, a running reader keeps its files, and shards that are not
touched are not rewritten. A manifest appears whole or not at all and never replaces
another: of two racing writers one fails with ``files.AlreadyThere``.

Inside a shard, files are ranges of the item hash and are sorted by it, so a key lookup or
a hash slice reads few row groups, and other shards are ranges of the same files. Where a change
leaves rows aside, a file may hold several such ranges, one after another.

The counters of a version's shards are written beside its data. They hold for as long as the
version does, so statistics and plain counts read them and no data.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pigeonhole.columns import field, quoted
from pigeonhole.functions import hashing, naming
from pigeonhole.operators import attributes as attrs_ops
from pigeonhole.operators import maintenance, scan, shards, stats, upsert
from pigeonhole.scheme import NO_LIMIT, Scheme, bad_key, route
from pigeonhole.sources import files

# Incoming rows up to this size in memory are broadcast instead of shuffling the table.
FEW_BYTES = 64 * 1024 * 1024
# Bytes assumed per row beside its text, when sizes are compared with FEW_BYTES.
ROW_OVERHEAD = 200

# Bytes on disk that one shuffle partition of a merge should hold.
PARTITION_BYTES = 64 * 1024 * 1024

# Rows that a task of a large change should get, and how many it may get however few there are.
SLICE_ROWS = 2_000_000
LEAST_SLICE = 10_000

# One of so many values is counted, to learn how many copies there are.
SOME = 256

# Files that a task which sorts nothing may write at a time.
OPEN_FILES = 32

# Manifests that stay beside the newest one; older ones are deleted by later writes.
KEEP_MANIFESTS = 16

# Item hashes have a Bloom filter in each row group, as large as their number asks for.
BLOOM = {
    "parquet.bloom.filter.enabled#item_hash": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}

# Paths of a store: manifests, and data files.
MANIFEST_FILE = r"([^/]+)/manifests/([0-9]+)\.json$"
DATA_FILE = r"([^/]+)/data/v=([^/]+)/shard=([0-9]+)/[^/]+$"

# No field of a table has this name.
MODIFIED_AT = "v"

COUNTERS = T.StructType(
    [T.StructField("version", T.StringType()), T.StructField("shard", T.IntegerType())]
    + [T.StructField(c, T.LongType()) for c in stats.COUNTERS]
    + [T.StructField(stats.MODIFIED, T.TimestampType())]
)

ROUTING = T.StructType(
    [T.StructField("item_hash", T.StringType()), T.StructField("shard", T.IntegerType())]
)

# Where a row is after an exchange by hash slice, in the order in which it is written.
DEALT = ("shard", "slice", "item_hash")


class NoSuchTable(LookupError):
    """The table does not exist."""


class TableExists(RuntimeError):
    """A KEEP write met a table that is already there."""


@dataclass(frozen=True)
class Manifest:
    number: int
    layout: str
    num_shards: int
    key: str
    fields: list[str]
    versions: dict[str, str]


class Store:
    """All tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- M1-M3 -------------------------------------------------------------------------

    def create(self, name: str, scheme: Scheme, num_shards: int) -> ItemTable:
        """M1: an empty table of wide rows; returns the present one if it fits."""
        return self._create(ItemTable, name, num_shards, scheme.key, list(scheme.fields))

    def create_attributes(self, name: str, num_shards: int) -> AttributeTable:
        """M1: an empty table of multi-valued attributes."""
        return self._create(
            AttributeTable, name, num_shards, attrs_ops.ITEM, list(attrs_ops.LONG)
        )

    def _create(self, kind, name: str, num_shards: int, key: str, fields: list[str]):
        hashing.check_num_shards(num_shards)
        path = self._path(name)
        table = kind(self, name, path)
        if self._known(name):
            have = table.manifest()
            if (have.layout, have.num_shards, have.key) != (kind.layout, num_shards, key):
                raise ValueError(
                    f"table {name} exists with {have.num_shards} shards, key {have.key}, "
                    f"layout {have.layout}"
                )
            return table
        table.publish(Manifest(1, kind.layout, num_shards, key, fields, {}))
        return table

    def table(self, name: str) -> ItemTable:
        return self._opened(ItemTable, name)

    def attribute_table(self, name: str) -> AttributeTable:
        return self._opened(AttributeTable, name)

    def _opened(self, kind, name: str):
        table = kind(self, name, self._path(name))
        if table.manifest().layout != kind.layout:
            raise ValueError(f"table {name} has layout {table.manifest().layout}")
        return table

    def exists(self, name: str, num_shards: int | None = None) -> bool:
        """M2: all shards are stored; with ``num_shards``, exactly those of that many."""
        if not self._known(name):
            return False
        table = ItemTable(self, name, self._path(name))
        at = table.manifest()
        return num_shards in (None, at.num_shards) and not table.lost_shards(at)

    def _known(self, name: str) -> bool:
        """Whether there is a table of this name, complete or not."""
        return bool(ItemTable(self, name, self._path(name)).manifest_names())

    def drop(self, name: str) -> bool:
        """M3: delete this table and no other; false if it does not exist."""
        return files.delete(self.spark, self._path(name)) if self._known(name) else False

    # -- M4, M7 ------------------------------------------------------------------------

    def tables(self) -> list[str]:
        """Names of all tables, in order."""
        rows = self._manifests().select("table_name").distinct().collect()  # one row a table
        return sorted(r["table_name"] for r in rows)

    def shards(self, limit: int | None = None) -> DataFrame:
        """M4: ``name`` of every shard that is stored, of every table.

        A shard without rows has no files and is stored by being in the manifest; one whose
        files are gone is not listed. Tasks list the tables' folders and read the manifests.
        """
        state = F.from_json(
            F.max_by(F.col("content").cast("string"), "number"),
            "num_shards int, versions map<string, string>",
        )
        tables = self._manifests().groupBy("table_name").agg(state.alias("state"))
        tables = tables.select("table_name", "state.*")
        placed = tables.select(
            "table_name", F.explode("versions").alias("shard", "version")
        ).select("table_name", F.col("shard").cast("int").alias("shard"), "version")
        there = self._listed("*", DATA_FILE, "table_name", "version", "shard").select(
            "table_name", "version", F.col("shard").cast("int").alias("shard")
        )
        lost = placed.join(there.distinct(), ["table_name", "version", "shard"], "left_anti")
        every = F.explode(F.sequence(F.lit(0), F.col("num_shards") - 1)).alias("shard")
        stored = tables.select("table_name", "num_shards", every).join(
            lost.select("table_name", "shard"), ["table_name", "shard"], "left_anti"
        )
        catalog = stored.select(
            naming.shard_name(F.col("table_name"), F.col("shard"), F.col("num_shards")).alias("name")
        )
        return shards.list_shards(catalog, limit)

    def _manifests(self) -> DataFrame:
        """``table_name, number, content`` of the manifests of all tables, a few for each."""
        found = self._listed("*.json", MANIFEST_FILE, "table_name", "number")
        return found.withColumn("number", F.col("number").cast("bigint"))

    def _listed(self, glob: str, pattern: str, *groups: str) -> DataFrame:
        """``content`` and the named parts of the path of files of all tables.

        The driver names the tables' folders; Spark lists what is in them, in tasks if there are
        many, and reads contents only if they are asked for.
        """
        names = [n for n in files.names(self.spark, self.root) if n[0] not in "._"]
        if not names:
            fields = [T.StructField(g, T.StringType()) for g in groups]
            schema = T.StructType([T.StructField("content", T.BinaryType()), *fields])
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        listed = reader.option("pathGlobFilter", glob).load([f"{self.root}/{n}" for n in names])
        return listed.where(F.col("path").rlike(pattern)).select(
            "content",
            *[F.regexp_extract("path", pattern, i).alias(g) for i, g in enumerate(groups, 1)],
        )

    def infer_num_shards(self, name: str) -> int:
        """M7: shard count of a table, 0 if it does not exist."""
        return shards.infer_num_shards(self.shards(), name)

    # -- writing -----------------------------------------------------------------------

    def write(
        self,
        name: str,
        df: DataFrame,
        scheme: Scheme,
        num_shards: int,
        mode: str = "update",
        order_by: Sequence[str] | None = None,
        null_deletes: bool = False,
        bulk: bool = False,
    ) -> ItemTable:
        """The sink: ``update`` (default), ``replace`` or ``keep``; see :class:`ItemTable`."""
        if mode not in ("update", "replace", "keep"):
            raise ValueError(f"unknown mode {mode!r}")
        known = self._known(name)
        if mode == "keep" and known:
            raise TableExists(f"table {name} already exists")
        table = ItemTable(self, name, self._path(name))
        at = None
        if not known:
            # Not published: the table appears together with its first rows.
            hashing.check_num_shards(num_shards)
            at = Manifest(0, table.layout, num_shards, scheme.key, list(scheme.fields), {})
        elif mode == "update":
            table = self.create(name, scheme, num_shards)
        if mode == "update":
            table.update(df, scheme, order_by, null_deletes, bulk, at)
        else:
            table.replace(df, scheme, num_shards, order_by, at)
        return table

    def _path(self, name: str) -> str:
        if not name or "/" in name or name[0] in "._" or name != name.strip():
            raise ValueError(f"not a table name: {name!r}")
        return f"{self.root}/{name}"


class _ShardedTable:
    """Versioned shards of one table: what both layouts share."""

    layout: str
    # Whether a write also writes the counters of its shards; else the first question does.
    counted_on_write = False

    def __init__(self, store: Store, name: str, path: str):
        self.store, self.name, self.path = store, name, path
        self.spark = store.spark

    def manifest(self) -> Manifest:
        """The newest manifest. A table that is not there is an error."""
        found = self.manifest_names()
        if not found:
            raise NoSuchTable(self.name)
        return Manifest(**json.loads(files.read_text(self.spark, self._manifest_path(found[-1]))))

    def manifest_names(self) -> list[str]:
        found = files.names(self.spark, f"{self.path}/manifests")
        return [n for n in found if n.endswith(".json") and n[0] not in "._"]

    def publish(self, manifest: Manifest) -> None:
        text = json.dumps(asdict(manifest))
        files.create_text(self.spark, self._manifest_path(f"{manifest.number:012d}.json"), text)
        old = manifest.number - 1 - KEEP_MANIFESTS
        if old > 0:
            files.delete(self.spark, self._manifest_path(f"{old:012d}.json"))

    def lost_shards(self, at: Manifest) -> list[int]:
        """Shards whose rows the manifest places in a directory that is not there.

        One listing per version, however many shards it has.
        """
        found = {
            v: set(files.names(self.spark, self._data_path(v))) for v in set(at.versions.values())
        }
        return sorted(int(s) for s, v in at.versions.items() if f"shard={s}" not in found[v])

    def _manifest_path(self, file_name: str) -> str:
        return f"{self.path}/manifests/{file_name}"

    def _data_path(self, version: str) -> str:
        return f"{self.path}/data/v={version}"

    def rows(
        self,
        touched: Sequence[int] | None = None,
        at: Manifest | None = None,
        extra: Sequence[Column] = (),
    ) -> DataFrame:
        """Routed rows of the table, or of some of its shards, in its state ``at``.

        The schema is given, never inferred; ``shard`` is a partition column, so filters
        on it prune directories. ``extra`` columns may speak of the files.
        """
        manifest = at or self.manifest()
        schema = T.StructType(
            [T.StructField(f, T.StringType()) for f in manifest.fields] + ROUTING.fields
        )
        paths = [
            f"{self._data_path(version)}/shard={shard}"
            for shard, version in sorted(manifest.versions.items(), key=lambda e: int(e[0]))
            if touched is None or int(shard) in touched
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*paths).select(*[quoted(f.name) for f in schema.fields], *extra)

    def _partitions(self, at: Manifest, touched: Sequence[int] | None = None) -> int:
        """Shuffle partitions for work on these shards: the session's number, or more where
        that would give partitions of more than PARTITION_BYTES on disk."""
        size = sum(
            files.size(self.spark, f"{self._data_path(v)}/shard={s}")
            for s, v in at.versions.items()
            if touched is None or int(s) in touched
        )
        return max(
            int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES)
        )

    @staticmethod
    def _sliced(rows: DataFrame, num_shards: int, partitions: int) -> DataFrame:
        """Routed rows with a ``slice``: about one slice of one shard per partition."""
        return maintenance.hash_slices(rows, num_shards, max(1, -(-partitions // num_shards)))

    def _merged_slices(self, before, incoming, key, null_deletes, touched=None) -> DataFrame:
        partitions = self._partitions(before, touched)
        configured = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return upsert.merge_sliced(
            self._sliced(self.rows(touched, before), before.num_shards, partitions),
            self._sliced(incoming, before.num_shards, partitions),
            key,
            null_deletes,
            # The session's own number stays open to adaptive coalescing.
            partitions if partitions > configured else None,
        )

    def _merged_rows_met(self, before, staged, key, null_deletes) -> DataFrame:
        """K1 where the table is much larger than what comes in.

        Only the incoming rows and the present ones that they may meet change their task, to be
        merged by shard and slice; all others are written by the task that reads them.
        """
        present = upsert.met(self.rows(staged.touched, before), staged.rows)
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        merged = upsert.merge_sliced(
            self._sliced(present.where("met").drop("met"), before.num_shards, partitions),
            self._sliced(staged.rows, before.num_shards, partitions),
            key,
            null_deletes,
        ).drop("slice")
        others = present.where("not met").drop("met")
        return merged.unionByName(others, allowMissingColumns=True)

    def _checked_slices(self, incoming: DataFrame, at: Manifest) -> DataFrame:
        """Incoming rows by shard and slice, for a first write; a repeated key is an error.

        The check is part of the exchange that the write needs anyway.
        """
        nothing = Manifest(0, at.layout, at.num_shards, at.key, at.fields, {})
        return self._merged_slices(nothing, incoming, at.key, False)

    def _arranged(self, rows: DataFrame, num_shards: int, gather: bool) -> DataFrame:
        """Routed rows in the tasks and the order in which they are written.

        ``gather`` brings each hash slice of a shard together first. Rebalancing lets
        adaptive execution merge small slices and split large ones into files of the
        advisory size, so neither the shard count nor a large shard, nor an item with very
        many attribute values, bounds parallelism. Without it rows stay in the tasks they
        are in.
        """
        if gather:
            partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            rows = self._sliced(rows, num_shards, partitions)
            rows = rows.hint("rebalance", F.col("shard"), F.col("slice"))
        order = [c for c in ("shard", "slice", "item_hash") if c in rows.columns]
        return rows.sortWithinPartitions(*order).drop("slice")

    def _write_version(self, rows: DataFrame, num_shards: int, gather: bool) -> dict[str, str]:
        """Write routed rows under a new version; returns the shards that have rows."""
        version = f"r{uuid.uuid4().hex}"
        arranged = self._arranged(rows, num_shards, gather)
        arranged.write.options(**BLOOM).partitionBy("shard").parquet(self._data_path(version))
        return self._placed_in(version)

    def _write_beside(self, rows: DataFrame, new: Mapping[str, str]) -> dict[str, str]:
        """Write rows of a table to a version that is not published yet, as they are read."""
        version = next(iter(new.values()), f"r{uuid.uuid4().hex}")
        with self._unsorted():
            added = rows.write.mode("append").options(**BLOOM).partitionBy("shard")
            added.parquet(self._data_path(version))
        return self._placed_in(version)

    def _placed_in(self, version: str) -> dict[str, str]:
        written = files.names(self.spark, self._data_path(version))
        return {n.split("=", 1)[1]: version for n in written if n.startswith("shard=")}

    @contextmanager
    def _unsorted(self) -> Iterator[None]:
        """Writes keep a file open for each shard they meet, so that a task need not sort its rows."""
        name = "spark.sql.maxConcurrentOutputFileWriters"
        was = self.spark.conf.get(name)
        self.spark.conf.set(name, OPEN_FILES)
        try:
            yield
        finally:
            self.spark.conf.set(name, was)

    def _publish_shards(
        self,
        before: Manifest,
        rows: DataFrame,
        touched: Sequence[int] | None,
        fields: Sequence[str] | None = None,
        num_shards: int | None = None,
        gather: bool = True,
        beside: DataFrame | None = None,
    ) -> None:
        """New version of the touched shards (all if None), then the next manifest.

        Rows ``beside`` the others are written as they are read.
        """
        count = num_shards or before.num_shards
        new = self._write_version(rows, count, gather)
        if beside is not None:
            new = self._write_beside(beside, new)
        kept = {}
        if touched is not None:
            gone = {str(s) for s in touched}
            kept = {s: v for s, v in before.versions.items() if s not in gone}
        state = Manifest(
            before.number + 1,
            self.layout,
            count,
            before.key,
            list(fields or before.fields),
            {**kept, **new},
        )
        if self.counted_on_write and new:
            self._note_counters(state, next(iter(new.values())))
        self.publish(state)

    @staticmethod
    def _refuse_repeated(df: DataFrame, key: str) -> None:
        repeated = upsert.repeated_keys(df, key).agg(F.min(field(key))).first()[0]
        if repeated is not None:
            raise ValueError(f"key occurs more than once in one write: {repeated}")

    @contextmanager
    def _stage(self, df: DataFrame) -> Iterator[_Staged]:
        """Incoming rows as a written table in the shared folder, deleted afterwards.

        They are evaluated once, however often the merge reads them, survive the loss of
        executors, and have a known size.
        """
        path = files.scratch_path(self.spark, "incoming")
        try:
            df.write.parquet(path)
            rows = self.spark.read.schema(df.schema).parquet(path)
            text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
            size = reduce(add, [F.coalesce(F.octet_length(field(c)), F.lit(0)) for c in text])
            found = (
                rows.groupBy("shard")
                .agg(F.count("*").alias("rows"), F.sum(size.cast("bigint")).alias("bytes"))
                .collect()  # one row per shard
            )
            count = sum(r["rows"] for r in found)
            total = sum(r["bytes"] for r in found) + ROW_OVERHEAD * count
            yield _Staged(rows, sorted(r["shard"] for r in found), total <= FEW_BYTES, count)
        finally:
            files.delete(self.spark, path)

    def files(self, at: Manifest | None = None) -> DataFrame:
        """``(shard, file_name, bytes, modified)`` of every data file, from listings only."""
        manifest = at or self.manifest()
        schema = "shard int, file_name string, bytes bigint, modified timestamp"
        paths = [f"{self._data_path(v)}/shard={s}" for s, v in manifest.versions.items()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        listed = self.spark.read.format("binaryFile").option(
            "basePath", f"{self.path}/data"
        ).load(paths)
        return listed.select(
            F.col("shard").cast("int").alias("shard"),
            F.col("path").alias("file_name"),
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("modified"),
        )

    def last_modified(self) -> DataFrame:
        """M5: one row ``(table_name, modified)``: the latest change of any shard."""
        at = self.manifest()
        created = files.modified_millis(
            self.spark, self._manifest_path(f"{at.number:012d}.json")
        )
        changes = self.files(at).select(F.lit(self.name).alias("table_name"), "modified")
        published = self.spark.range(1).select(
            F.lit(self.name).alias("table_name"),
            F.timestamp_millis(F.lit(created)).alias("modified"),
        )
        return shards.last_modified(changes.unionByName(published))

    def prune(self, keep: int = 1) -> list[str]:
        """Delete data that none of the ``keep`` newest manifests uses, and older manifests.

        Also deletes what conditional puts noted down for their callers. Not while a reader of
        an older state or a writer is running.
        """
        found = self.manifest_names()
        used = set()
        for n in found[-keep:]:
            used.update(
                json.loads(files.read_text(self.spark, self._manifest_path(n)))[
                    "versions"
                ].values()
            )
        for n in found[:-keep]:
            files.delete(self.spark, self._manifest_path(n))
        stale = [
            n
            for n in files.names(self.spark, f"{self.path}/data")
            if n.startswith("v=") and n[2:] not in used
        ]
        for n in stale:
            files.delete(self.spark, f"{self.path}/data/{n}")
            files.delete(self.spark, f"{self.path}/stats/{n}")
        files.delete(self.spark, f"{self.path}/_failed")
        return stale

    # -- M6 ----------------------------------------------------------------------------

    def stats(self) -> DataFrame:
        """M6: counters and time of the last change of every shard, empty ones included.

        Reads the counters written beside the data, one small row a shard.
        """
        at = self.manifest()
        return stats.every_shard(self._counters(at), at.num_shards)

    def _measure(self, at: Manifest) -> DataFrame:
        """The counters of the rows in a state, and the time of their last change, by shard."""
        raise NotImplementedError

    def _counters(self, at: Manifest) -> DataFrame:
        """The counters of the shards that have rows; versions without any are counted first."""
        current = self.spark.createDataFrame(
            [(v, int(s)) for s, v in at.versions.items()], "version string, shard int"
        )
        for version in set(at.versions.values()):
            if not files.names(self.spark, self._stats_path(version)):
                self._note_counters(at, version)
        paths = [self._stats_path(v) for v in set(at.versions.values())]
        if not paths:
            return self.spark.createDataFrame([], COUNTERS).drop("version")
        noted = self.spark.read.schema(COUNTERS).parquet(*paths)
        # A version may have more shards than those that still use it.
        return noted.join(F.broadcast(current), ["version", "shard"]).drop("version")

    def _note_counters(self, at: Manifest, version: str) -> None:
        """Count the shards of a version, of which ``at`` has the fields, and write that down."""
        own = {s: v for s, v in at.versions.items() if v == version}
        found = self._measure(Manifest(**asdict(at) | {"versions": own}))
        found = found.withColumn("version", F.lit(version)).select(*COUNTERS.names)
        found.coalesce(1).write.mode("overwrite").parquet(self._stats_path(version))

    def _stats_path(self, version: str) -> str:
        return f"{self.path}/stats/v={version}"


@dataclass(frozen=True)
class _Staged:
    rows: DataFrame
    touched: list[int]
    few: bool
    count: int


class ItemTable(_ShardedTable):
    """A table of wide rows: one row per key, one text column per field."""

    layout = "wide"
    counted_on_write = True

    # -- source ------------------------------------------------------------------------

    def read(self, scheme: Scheme | None = None) -> DataFrame:
        """The scheme's fields of the rows matching its query and limit."""
        found = self.matching(scheme)
        return found.drop(*ROUTING.names) if scheme is None else scheme.project(found)

    def matching(self, scheme: Scheme | None = None) -> DataFrame:
        """Like :meth:`read`, but all table columns with ``item_hash`` and ``shard``."""
        at = self.manifest()
        scheme = scheme or self.scheme(at)
        found = scheme.where(self.rows(at=at))
        return scan.balanced_limit(found, scheme.key, at.num_shards, scheme.limit)

    def scheme(self, at: Manifest | None = None) -> Scheme:
        manifest = at or self.manifest()
        return Scheme(manifest.fields, manifest.key)

    def lookup(self, value: str) -> DataFrame:
        """S3: the row of one key, read from one shard."""
        manifest = self.manifest()
        shard = hashing.literal_shard(value, manifest.num_shards)
        found = self.rows([shard], manifest)
        rows = scan.item_lookup(found, manifest.key, value, manifest.num_shards)
        return self.scheme(manifest).project(rows)

    def lookup_all(self, keys: DataFrame) -> DataFrame:
        """S3 for a table of keys (one column): a join on shard, item hash and key.

        Up to ``scan.FEW_KEYS`` keys become literals: only their shards are listed, and row
        groups and pages that cannot hold one of their hashes are not read. More keys prune
        shards while running.
        """
        at = self.manifest()
        wanted = scan.wanted_keys(keys, at.key, at.num_shards)
        few = wanted.limit(scan.FEW_KEYS + 1).collect()  # bounded
        if len(few) <= scan.FEW_KEYS:
            wanted = self.spark.createDataFrame(few, wanted.schema)
            rows = self.rows(sorted({r["shard"] for r in few}), at)
            rows = rows.where(scan.of_hashes([r["item_hash"] for r in few]))
        else:
            rows = self.rows(at=at)
        found = rows.join(wanted, ["shard", "item_hash", at.key], "left_semi")
        return self.scheme(at).project(found)

    def count(self, query: str | Column | None = None, limit: int = NO_LIMIT) -> DataFrame:
        """A1/A2: one row ``items``; without a query it is known from the counters."""
        at = self.manifest()
        if query is None:
            items = F.coalesce(F.sum("items"), F.lit(0).cast("bigint"))
            return self._counters(at).agg(scan.capped(items, limit).alias("items"))
        return scan.count_items(self.scheme(at).where(self.rows(at=at), query), limit)

    def count_by_shard(
        self, query: str | Column | None = None, limit: int = NO_LIMIT
    ) -> DataFrame:
        """A1/A2 for each shard that has a match; a limit ends the reading of a shard early."""
        at = self.manifest()
        if query is None:
            return self._counters(at).select("shard", scan.capped(F.col("items"), limit).alias("items"))
        found = self.scheme(at).where(self.rows(at=at), query)
        if limit == NO_LIMIT or not at.versions:
            return scan.count_by_shard(found)
        stored = sorted(int(s) for s in at.versions)
        return scan.capped_count_of_shards({s: found.where(F.col("shard") == s) for s in stored}, limit)

    def plan(self, scheme: Scheme) -> DataFrame:
        """Shards with matches, and what a read with this scheme takes from each."""
        at = self.manifest()
        found = scheme.where(self.rows(at=at))
        return scan.shard_plan(found, at.num_shards, scheme.limit, self.name)

    def _measure(self, at: Manifest) -> DataFrame:
        changed = F.col("_metadata.file_modification_time").alias(MODIFIED_AT)
        return stats.shard_stats(
            self.rows(at=at, extra=[changed]),
            at.key,
            [f for f in at.fields if f != at.key],
            modified=MODIFIED_AT,
        )

    # -- sink --------------------------------------------------------------------------

    def replace(
        self,
        df: DataFrame,
        scheme: Scheme,
        num_shards: int | None = None,
        order_by: Sequence[str] | None = None,
        at: Manifest | None = None,
    ) -> None:
        """K2: the rows become the whole table, with new fields and shard count if given."""
        before = at or self.manifest()
        count = num_shards or before.num_shards
        hashing.check_num_shards(count)
        state = asdict(before) | {"key": scheme.key, "fields": list(scheme.fields)}
        before = Manifest(**state | {"num_shards": count})
        rows = self._incoming(df, scheme, count, order_by, False)
        if not order_by:
            rows = self._checked_slices(rows, before)
        self._publish_shards(before, rows, None, gather=bool(order_by))

    def update(
        self,
        df: DataFrame,
        scheme: Scheme | None = None,
        order_by: Sequence[str] | None = None,
        null_deletes: bool = False,
        bulk: bool = False,
        at: Manifest | None = None,
    ) -> None:
        """Insert new keys, set the written attributes of present ones.

        Only shards that receive rows are read and written. Few incoming rows (checked
        size) are broadcast and the table is not shuffled. More are shuffled together with the
        present rows whose hash is among theirs, and the rest of the table stays where it is
        read. Only if they are so many that they meet most of a table is all of it shuffled; one
        shuffle then serves the merge and the write.

        ``bulk`` says the incoming rows are many and go to every shard: they are then not
        staged to learn that, but evaluated once, inside that shuffle.
        """
        before = at or self.manifest()
        scheme = scheme or self.scheme(before)
        if scheme.key != before.key:
            raise ValueError(f"table {self.name} has key {before.key}, not {scheme.key}")
        fields = before.fields + [f for f in scheme.fields if f not in before.fields]
        incoming = self._incoming(df, scheme, before.num_shards, order_by, null_deletes)
        if not before.versions:
            if not order_by:
                incoming = self._checked_slices(incoming, before)
            self._publish_shards(before, incoming, None, fields, gather=bool(order_by))
            return
        if bulk:
            merged = self._merged_slices(before, incoming, scheme.key, null_deletes)
            self._publish_shards(before, merged, None, fields, gather=False)
            return
        with self._stage(incoming) as staged:
            if not staged.touched:
                return
            if staged.few:
                if not order_by:
                    self._refuse_repeated(staged.rows, scheme.key)
                existing = self.rows(staged.touched, before)
                merged = upsert.merge_few(existing, staged.rows, scheme.key, null_deletes)
            elif staged.count <= upsert.MET_BITS // 4:
                merged = self._merged_rows_met(before, staged, scheme.key, null_deletes)
            else:
                merged = self._merged_slices(
                    before, staged.rows, scheme.key, null_deletes, staged.touched
                )
            # Every row is in the task that read it or in that of its slice.
            self._publish_shards(before, merged, staged.touched, fields, gather=False)

    def delete_items(self, keys: DataFrame) -> None:
        """Remove the rows whose key is listed (one column)."""
        before = self.manifest()
        (name,) = keys.columns
        wanted = keys.select(field(name).cast("string").alias(before.key)).distinct()
        with self._stage(route(wanted, before.key, before.num_shards)) as staged:
            gone = staged.rows.select(field(before.key))
            left = self.rows(staged.touched, before).join(
                F.broadcast(gone) if staged.few else gone, before.key, "left_anti"
            )
            if staged.touched:
                self._publish_shards(before, left, staged.touched, gather=not staged.few)

    def reshard(self, num_shards: int) -> None:
        """The same rows over another number of shards.

        Shards of either number are ranges of hashes, and so is what a task reads: it cuts its
        range at the new borders and writes each piece where it belongs. No row changes its
        task.
        """
        hashing.check_num_shards(num_shards)
        before = self.manifest()
        rows = maintenance.reshard(self.rows(at=before), num_shards)
        self._publish_shards(before, rows, None, num_shards=num_shards, gather=False)

    @staticmethod
    def _incoming(df, scheme, num_shards, order_by, null_deletes) -> DataFrame:
        if order_by:
            return upsert.settle(df, scheme, num_shards, order_by, null_deletes)
        return route(scheme.encode(df), scheme.key, num_shards)


class AttributeTable(_ShardedTable):
    """A table of multi-valued attributes: one row per item, name and value."""

    layout = "attributes"

    # -- reading -----------------------------------------------------------------------

    def attributes(self, at: Manifest | None = None) -> DataFrame:
        """All rows ``(item_name, name, value)``."""
        return self.rows(at=at).select(*attrs_ops.LONG)

    def items(
        self, scheme: Scheme | None = None, parts: int | None = None, size: int | None = None
    ) -> DataFrame:
        """Items in item form; with a scheme, those matching its query and limit.

        ``parts`` and ``size`` as in :func:`pigeonhole.operators.attributes.item_form`.
        """
        at = self.manifest()
        among = None if scheme is None else self._wide(scheme, at).select(field(scheme.key))
        return attrs_ops.item_form(self.attributes(at), parts, True, among, size)

    def select(
        self,
        conditions: Mapping[str, tuple[str, str | Column]],
        query: str | Column,
        parts: int | None = None,
        size: int | None = None,
    ) -> DataFrame:
        """Whole items for which a query over their bags holds.

        A test of an attribute holds if any of its values passes; see
        :func:`pigeonhole.operators.attributes.matching_items`.
        """
        attrs = self.attributes()
        found = attrs_ops.matching_items(attrs, conditions, query, counted=True)
        return attrs_ops.item_form(attrs, parts, True, found, size)

    def item(self, item: str, parts: int | None = None, size: int | None = None) -> DataFrame:
        """S3: one item in item form, read from one shard."""
        return attrs_ops.item_form(self._item_rows(item), parts, True, size=size)

    def attribute(self, item: str, name: str) -> DataFrame:
        """The values of one attribute of one item, one per row."""
        return attrs_ops.attribute_lookup(self._item_rows(item), item, name)

    def read(self, scheme: Scheme) -> DataFrame:
        """One row per item, first value of each field of the scheme.

        Query and limit of the scheme apply to the wide rows, so to first values; use
        :meth:`select` for tests of any value. Items that have none of the fields are rows
        of nulls.
        """
        return scheme.project(self._wide(scheme, self.manifest()))

    def _wide(self, scheme: Scheme, at: Manifest) -> DataFrame:
        wide = attrs_ops.to_wide(
            self.rows(at=at), scheme.key, scheme.fields, carry=[f.name for f in ROUTING.fields]
        )
        return scan.balanced_limit(scheme.where(wide), scheme.key, at.num_shards, scheme.limit)

    def _measure(self, at: Manifest) -> DataFrame:
        changed = self.files(at).groupBy("shard").agg(F.max("modified").alias(stats.MODIFIED))
        return stats.attribute_stats(self.rows(at=at)).join(changed, "shard", "left")

    def _item_rows(self, item: str) -> DataFrame:
        at = self.manifest()
        rows = self.rows([hashing.literal_shard(item, at.num_shards)], at)
        found = scan.item_lookup(rows, attrs_ops.ITEM, item, at.num_shards)
        return found.select(*attrs_ops.LONG)

    # -- writing -----------------------------------------------------------------------

    def put(self, puts: DataFrame, at: Manifest | None = None) -> None:
        """See :func:`pigeonhole.operators.attributes.put_attributes`."""
        before = at or self.manifest()
        if before.versions:
            shape = [c for c in (*attrs_ops.LONG, "replace") if c in puts.columns]
            self._apply(
                puts.select(*shape),
                attrs_ops.put_attributes,
                attrs_ops.said_by_puts,
                at=before,
                once=False,
            )
            return
        self._publish_shards(before, self._first_rows(puts, before.num_shards), None, gather=False)

    def _first_rows(self, puts: DataFrame, num_shards: int) -> DataFrame:
        """Puts as the rows of a table that has none, by hash slice.

        The puts are evaluated twice: counted by slice, then moved in one exchange, in which equal
        ones meet. Where most of them are copies, or copies might crowd a task, they are removed by
        value in an exchange before, which combines them first.
        """
        puts = puts.select(*attrs_ops.LONG).where("value is not null")
        rows = self._placed(puts)
        fine, counts = self._counted(rows, num_shards, F.xxhash64(*attrs_ops.LONG))
        held = {at: r["n"] for at, r in counts.items()}
        if self._dense(counts, held):
            rows = self._placed(puts.distinct())
        return self._dealt(rows, held, fine, num_shards, unique=True)

    def _dense(self, counts: Mapping, rows: Mapping[int, int]) -> bool:
        """Whether values occur more than twice on average, or a slice has more rows than a task should."""
        total = sum(rows.values())
        crowded = max(rows.values(), default=0) > max(LEAST_SLICE, total // self._wanted_tasks(total))
        copied = sum(r["some"] for r in counts.values()) > 2 * sum(r["values"] for r in counts.values())
        return crowded or copied

    def write(
        self, df: DataFrame, scheme: Scheme, order_by: Sequence[str] | None = None
    ) -> None:
        """K1 for this layout: each written attribute of a row replaces its present values."""
        at = self.manifest()
        if order_by:
            rows = upsert.settle(df, scheme, at.num_shards, order_by)
        else:
            rows = upsert.single_by_key(scheme.encode(df), scheme.key)
        puts = attrs_ops.to_attributes(rows, scheme.key, scheme.fields)
        self.put(puts.withColumn("replace", F.lit(True)), at)

    def delete_items(self, items: DataFrame) -> None:
        """Remove the listed items (column ``item_name``)."""
        self._apply(
            items.select(attrs_ops.ITEM).distinct(),
            attrs_ops.delete_items,
            attrs_ops.said_by_item_deletions,
            by=(attrs_ops.ITEM,),
        )

    def delete(self, deletions: DataFrame) -> None:
        """Remove attributes or single values."""
        self._apply(
            deletions.select(*attrs_ops.LONG).distinct(),
            attrs_ops.delete_attributes,
            attrs_ops.said_by_deletions,
        )

    def conditional_put(self, puts: DataFrame, conditions: DataFrame) -> DataFrame:
        """K9: put the items whose conditions hold; returns the rejected rows.

        Check and put work on one state and publish the one after it, so a writer that comes
        in between makes this fail and nothing is put. The failed items are noted below the
        table, as the rejected rows depend on the state before the put; :meth:`prune` deletes
        them.
        """
        before = self.manifest()
        failed_path = f"{self.path}/_failed/{uuid.uuid4().hex}"
        with self._stage(self._routed(conditions, before)) as staged:
            failed = attrs_ops.failed_items(
                self.rows(staged.touched, before), staged.rows, staged.few
            )
            failed.write.parquet(failed_path)
        failed = self.spark.read.schema(f"{attrs_ops.ITEM} string").parquet(failed_path)
        self.put(puts.join(failed, attrs_ops.ITEM, "left_anti"), before)
        rejected = puts.join(failed, attrs_ops.ITEM, "left_semi")
        return rejected.withColumn("error", F.lit(attrs_ops.CONDITION_FAILED))

    @staticmethod
    def _checked(df: DataFrame) -> DataFrame:
        item = field(attrs_ops.ITEM)
        message = F.lit("row without an item name")
        checked = F.when(bad_key(item), F.raise_error(message)).otherwise(item)
        return df.withColumn(attrs_ops.ITEM, checked)

    @classmethod
    def _routed(cls, df: DataFrame, at: Manifest) -> DataFrame:
        return route(cls._checked(df), attrs_ops.ITEM, at.num_shards, compiled=True)

    @classmethod
    def _placed(cls, df: DataFrame) -> DataFrame:
        """Rows with the ``position`` of their item's hash."""
        hashed = hashing.with_unsigned_hash(cls._checked(df), field(attrs_ops.ITEM), "position")
        return hashed.withColumn("position", hashing.hash_position(F.col("position")))

    def _apply(
        self,
        change: DataFrame,
        operation,
        said_by,
        by: Sequence[str] = (attrs_ops.ITEM, "name"),
        at: Manifest | None = None,
        once: bool = True,
    ) -> None:
        """Stage the change, apply it to the shards it touches, publish them.

        A small change is broadcast to ``operation`` and present rows stay in the tasks that read
        them. Otherwise present rows and what ``said_by`` makes of the change meet in one exchange,
        which serves the write too; if the change speaks of few names and most present rows have
        others, these stay where they are read. Without ``once`` the change may list things again,
        and ``said_by`` is told whether it does so much.
        """
        before = at or self.manifest()
        with self._stage(self._routed(change, before)) as staged:
            if not staged.touched:
                return
            present, beside = self.rows(staged.touched, before), None
            if staged.few:
                result = operation(present, staged.rows, True)
            else:
                # Numbers move in the place of what is written for them.
                position = hashing.text_position(F.col("item_hash")).alias("position")
                present, change = (
                    r.select(*[c for c in r.columns if c not in ROUTING.names], position)
                    for r in (present, staged.rows)
                )
                named = attrs_ops.among_names(change.select("name")) if "name" in by else None
                spoken_of = F.lit(True) if named is None else named
                about = F.lit(None).cast("bigint") if once else F.xxhash64(attrs_ops.ITEM, "name")
                places = present.select(
                    "position", spoken_of.alias("moves"), F.lit(None).cast("bigint").alias("about")
                ).unionByName(
                    change.select("position", F.lit(True).alias("moves"), about.alias("about"))
                )
                fine, counts = self._counted(places, before.num_shards, F.col("about"), F.col("moves"))
                rows = {at: r["n"] for at, r in counts.items()}
                moving = {at: r["moves"] for at, r in counts.items()}
                staying = sum(rows.values()) - sum(moving.values())
                held = present.withColumn("says", F.lit(attrs_ops.SAYS_HELD))
                if 2 * staying > sum(rows.values()) - staged.count:
                    beside = self.rows(staged.touched, before).where(~spoken_of)
                    held, rows = held.where(spoken_of), moving
                said = said_by(change) if once else said_by(change, self._dense(counts, rows))
                dealt = self._dealt(held.unionByName(said), rows, fine, before.num_shards)
                result = attrs_ops.decided(dealt, DEALT, by)
            self._publish_shards(before, result, staged.touched, gather=False, beside=beside)

    @staticmethod
    def _slice_of(num_shards: int, slices: int) -> Column:
        """Number of the hash slice of a ``position``, over all shards."""
        position = F.col("position")
        shard = hashing.shard_of_position(position, num_shards)
        return shard * slices + hashing.slice_of_position(position, shard, num_shards, slices)

    def _counted(
        self,
        places: DataFrame,
        num_shards: int,
        value: Column,
        moves: Column | None = None,
    ) -> tuple[int, dict]:
        """Fine slices a shard, and by slice how many rows are there (``n``) and how many of them move.

        Of the hash of a ``value`` (null: none) also how many rows there are of ``some`` values, one of
        ``SOME``, and ``values``, how many these are.
        """
        fine = 64
        while fine * num_shards < 4 * int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            fine *= 2
        at = self._slice_of(num_shards, fine).alias("slice")
        some = F.when(F.pmod(value, F.lit(SOME)) == 0, value)
        of_some = F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)
        moving = (F.lit(True) if moves is None else moves).alias("moves")
        found = places.select(at, some.alias("value"), moving).groupBy("slice", "value")
        counts = found.agg(F.count("*").alias("n"), F.count_if("moves").alias("moves"))
        counts = counts.groupBy("slice").agg(
            *[F.sum(c).alias(c) for c in ("n", "moves")],
            F.sum(of_some).alias("some"),
            F.count("value").alias("values"),
        )
        counts = counts.collect()  # one row a fine slice
        return fine, {r["slice"]: r for r in counts}

    def _wanted_tasks(self, rows: int) -> int:
        """The session's number, fewer for few rows, more for very many."""
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return max(1, min(partitions, rows // LEAST_SLICE), -(-rows // SLICE_ROWS))

    def _dealt(
        self,
        said: DataFrame,
        counts: Mapping[int, int],
        fine: int,
        num_shards: int,
        unique: bool = False,
    ) -> DataFrame:
        """Rows with a ``position`` by hash slice, a slice a task, in one exchange: with ``DEALT``.

        ``counts`` says how many rows each of ``fine`` slices a shard has. A slice that holds far
        more than its share, because of an item with very many values, is dealt over several
        tasks by value; rows without a value go to each. ``unique`` leaves one of equal rows,
        which all have a value.
        """
        rows = sum(counts.values())
        wanted = self._wanted_tasks(rows)
        slices = fine
        while slices % 2 == 0 and slices // 2 * num_shards >= wanted:
            slices //= 2
        total = num_shards * slices
        held: Counter[int] = Counter()
        for at, n in counts.items():
            # Fine slices divide coarse ones.
            held[at * slices // fine] += n
        share = max(2 * -(-rows // total), LEAST_SLICE)
        hot, first = {}, total
        for at, n in sorted(held.items()):
            if n > share:
                hot[at] = (first, -(-n // share))
                first += hot[at][1]
        placed = said.withColumn("slice", self._slice_of(num_shards, slices))
        if hot:
            # Looked up in arrays: a join, or a filter that follows from the generator below, would
            # be traced through the projections of a hash, whose size it takes threefold at each.
            to, tasks = (
                F.get(F.array(*[F.lit(hot.get(at, (at, 1))[i]) for at in range(total)]), F.col("slice"))
                for i in (0, 1)
            )
            one = F.pmod(F.xxhash64("name", "value"), tasks.cast("bigint")).cast("int")
            if unique:
                placed = placed.withColumn("slice", to + one)
            else:
                every = F.when(F.col("value").isNull(), F.sequence(to, to + tasks - 1))
                placed = placed.withColumn("slice", F.explode(every.otherwise(F.array(to + one))))
        position = F.col("position")
        moved = placed.repartitionById(first, F.col("slice"))
        if unique:
            moved = moved.dropDuplicates()
        return moved.withColumns(
            {
                "shard": hashing.shard_of_position(position, num_shards),
                # A position's own position is the hash.
                "item_hash": hashing.hash_text(hashing.hash_position(position)),
            }
        ).drop("position")
