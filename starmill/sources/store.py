"""Layer tables in a folder all executors share."""

from __future__ import annotations

import atexit
import contextlib
import hashlib
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of source files per bucket. Spark allows 100,000 buckets, which is 1 GiB each up to about
# 98 TiB; beyond that buckets grow with the data, and spark.sql.sources.bucketing.maxBuckets can be
# raised.
BUCKET_BYTES = 1024**3

_scratch: dict[str, str] = {}
_leaving: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _scratch:
        _scratch[application] = tempfile.mkdtemp(prefix="starmill-")
    return _scratch[application]


def remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Delete a folder of scratch files when the program ends, once per folder."""
    if folder in _leaving:
        return
    _leaving.add(folder)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def remove() -> None:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        # Where Spark's JVM has gone before, nothing can be reached any more.
        with contextlib.suppress(Exception):
            path.getFileSystem(conf).delete(path, True)

    atexit.register(remove)


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder, for files that go when the program ends."""
    application = spark.sparkContext.applicationId
    folder = f"{shared_folder(spark).rstrip('/')}/starmill-{application}"
    remove_at_exit(spark, folder)
    return f"{folder}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: a small table whose size Spark knows."""
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_state(spark: SparkSession, paths: Sequence[str]) -> tuple[str, int]:
    """Digest of all files under the paths, which may be globs, with their sizes and times of
    change, and the sum of the sizes."""
    conf = spark._jsc.hadoopConfiguration()
    files = []
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        fs = path.getFileSystem(conf)
        found = fs.globStatus(path)
        if not found:
            raise FileNotFoundError(name)
        for top in found:
            listing = fs.listFiles(top.getPath(), True)
            while listing.hasNext():
                file = listing.next()
                state = file.getLen(), file.getModificationTime()
                files.append((file.getPath().toString(), *state))
    text = "\n".join(f"{name} {size} {time}" for name, size, time in sorted(files))
    return hashlib.sha256(text.encode()).hexdigest()[:12], sum(size for _, size, _ in files)


def bucket_count(spark: SparkSession, input_bytes: int) -> int:
    """Buckets for tables derived from that many bytes: at least one per core, at most what
    Spark allows."""
    wanted = max(spark.sparkContext.defaultParallelism, -(-input_bytes // BUCKET_BYTES))
    return min(wanted, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))


def quoted(text: str) -> str:
    """A text as a literal of Spark SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class LayerStore:
    """Writes each layer table once, whole, and hands back the written table.

    A written table cuts the lineage: a lost executor costs its own tasks, not the layers below.
    Tables keyed by the landing row are bucketed by that key with one bucket count, so joins,
    groupings and windows on it need no shuffle. Tables that are looked up by other keys stay
    unbucketed: their file size tells Spark whether to broadcast them, and when it is too large
    AQE can split the lookups of a key that holds a large part of the rows.
    """

    def __init__(
        self,
        spark: SparkSession,
        namespace: str,
        buckets: int,
        location: str | None = None,
        comment: str = "",
    ):
        """Tables of database ``namespace`` under ``location``; by default in the shared folder,
        which suits tables that nobody needs after the run."""
        self.spark = spark
        self.namespace = namespace
        self.buckets = buckets
        self.location = (location or f"{shared_folder(spark).rstrip('/')}/{namespace}").rstrip("/")
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {namespace} COMMENT {quoted(comment)} "
            f"LOCATION {quoted(self.location)}"
        )

    def drop_at_exit(self) -> None:
        """Drop the tables and their files when the program ends."""
        remove_at_exit(self.spark, self.location)

    def write(
        self,
        df: DataFrame,
        name: str,
        key: str | None = None,
        equal_to_key: tuple[str, ...] = (),
        in_place: bool = False,
        comment: str | None = None,
    ) -> DataFrame:
        """Replace table ``name``, bucketed by ``key`` if given.

        Columns that always equal the key are left out and come back as aliases of it, so the
        table is bucketed by each of them. ``in_place`` says that ``df`` comes out of operators
        on bucketed tables with that key, so each task already holds one bucket and the rows are
        written where they are; any other ``df`` is shuffled to its buckets first.

        The new rows go to a folder of their own. Only when they are all there the table is
        pointed at it, and then the former folder goes. So a table can be refreshed from itself,
        and a write that fails leaves the former table as it was.
        """
        stored = self._dealt(df, key, equal_to_key, in_place)
        table, version = f"{self.namespace}.{name}", uuid.uuid4().hex
        fresh, folder = f"{table}__{version}", f"{self.location}/{name}/{version}"
        writer = stored.write.bucketBy(self.buckets, key) if key else stored.write
        try:
            writer.option("path", folder).saveAsTable(fresh)
        except BaseException:
            self.spark.sql(f"DROP TABLE IF EXISTS {fresh}")
            self._delete(folder)
            raise
        self._publish(table, fresh, folder)
        self._leave_only(f"{self.location}/{name}", version)
        if comment:
            self.spark.sql(f"COMMENT ON TABLE {table} IS {quoted(comment)}")
        return self.read(name, key, equal_to_key)

    def append(
        self,
        df: DataFrame,
        name: str,
        key: str | None = None,
        equal_to_key: tuple[str, ...] = (),
        in_place: bool = False,
    ) -> DataFrame:
        """Add rows to table ``name``, to the buckets they belong to; the files that are there stay
        as they are. Spark shows the new files when all are written."""
        stored = self._dealt(df, key, equal_to_key, in_place)
        table = f"{self.namespace}.{name}"
        # By name, so that the order of columns doesn't matter.
        stored = stored.select(*[F.col(f"`{c}`") for c in self.spark.table(table).columns])
        writer = stored.write.bucketBy(self.buckets, key) if key else stored.write
        writer.mode("append").format("parquet").saveAsTable(table)
        return self.read(name, key, equal_to_key)

    def drop(self, name: str) -> None:
        """Remove a table and its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.namespace}.{name}")
        self._delete(f"{self.location}/{name}")

    def _dealt(self, df: DataFrame, key: str | None, equal_to_key, in_place: bool) -> DataFrame:
        stored = df.drop(*equal_to_key)
        return stored if in_place or not key else stored.repartition(self.buckets, key)

    def _publish(self, table: str, fresh: str, folder: str) -> None:
        """Point ``table`` at the files of ``fresh``: in one step of the catalog where both have
        the same columns and buckets, else by giving ``fresh`` the name of the former table. No
        file is touched by either."""
        sql = self.spark.sql
        if not self.spark.catalog.tableExists(table):
            sql(f"ALTER TABLE {fresh} RENAME TO {table}")
        elif self._shape(table) == self._shape(fresh):
            sql(f"ALTER TABLE {table} SET LOCATION {quoted(folder)}")
            sql(f"DROP TABLE {fresh}")
        else:
            former = f"{table}__former"
            sql(f"DROP TABLE IF EXISTS {former}")
            sql(f"ALTER TABLE {table} RENAME TO {former}")
            sql(f"ALTER TABLE {fresh} RENAME TO {table}")
            sql(f"DROP TABLE {former}")
        self.spark.catalog.refreshTable(table)

    def _shape(self, table: str) -> tuple:
        """Columns of a table with their metadata, and how it is bucketed."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
        buckets = [tuple(r)[:2] for r in described if r.col_name in ("Num Buckets", "Bucket Columns")]
        return self.spark.table(table).schema.json(), buckets

    def _leave_only(self, folder: str, version: str) -> None:
        """Delete what lies in a table's folder beside its current version."""
        path, fs = self._path(folder)
        for found in fs.listStatus(path):
            if found.getPath().getName() != version:
                fs.delete(found.getPath(), True)

    def _delete(self, folder: str) -> None:
        path, fs = self._path(folder)
        fs.delete(path, True)

    def _path(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def read(
        self, name: str, key: str | None = None, equal_to_key: tuple[str, ...] = ()
    ) -> DataFrame:
        """A table written before, with the aliases of its key in front."""
        table = self.spark.table(f"{self.namespace}.{name}")
        return table.select(*[F.col(key).alias(c) for c in equal_to_key], "*")
