"""Tables in shared storage, and the folder for intermediate ones."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's spark.checkpoint.dir.

    Without that setting it lies below the warehouse, which all share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return f"{named.rstrip('/')}/wayside/{spark.sparkContext.applicationId}"


#: What other readers call the schemes that Hadoop names its own way.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme: one without lies in Spark's default file system, not on a local disk."""
    files, found = _hadoop(spark, path)
    return found.makeQualified(files.getUri(), files.getWorkingDirectory()).toString()


def open_folder(root: str):
    """File system and path of a qualified folder or file, for tasks that read or write bytes themselves."""
    from pyarrow import fs

    scheme, apart, rest = root.partition(":/")
    if not apart:
        raise ValueError(f"{root} names no file system")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:/{rest}")


def folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders in another, one level only."""
    files, path = _hadoop(spark, root)
    found = files.listStatus(path) if files.exists(path) else []
    names = [f.getPath().getName() for f in found if f.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file, by the file system through which Spark reaches the path."""
    files, target = _hadoop(spark, path)
    out = files.create(target, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def make_folder(spark: SparkSession, root: str) -> None:
    files, path = _hadoop(spark, root)
    files.mkdirs(path)


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write an intermediate result once and read it back.

    Cuts the lineage, survives lost executors, and pins values (float sums, task
    numbers) that a second evaluation could give differently. Being columnar, it
    still prunes columns, which a row checkpoint does not.
    """
    path = fresh_folder(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame with its row count observed while it is written.

    The observation sits on top of the plan, so in the writing stage: Spark counts
    each of its tasks once, also when earlier stages run again.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


class TableStore:
    """Parquet tables below one root, each a plain folder; a rebuilt one is moved into the old one's place."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, schema: StructType | None = None) -> DataFrame:
        """A table; name the schema where it may hold no file yet."""
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(self.path(name))

    def exists(self, name: str) -> bool:
        files, path = _hadoop(self.spark, self.path(name))
        return files.exists(path)

    def drop(self, name: str) -> None:
        files, path = _hadoop(self.spark, self.path(name))
        files.delete(path, True)

    def rebuild(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """Replace the whole table once the new one is complete; gives the row count of the same pass."""
        return self._write(name, df, "overwrite", partition_by, "static")

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ("dt",)) -> int:
        return self._write(name, df, "append", partition_by, "static")

    def reload_days(self, name: str, df: DataFrame, partition_by: Sequence[str] = ("dt",)) -> int:
        """Replace only the partitions present in the frame; a rerun is a no-op."""
        return self._write(name, df, "overwrite", partition_by, "dynamic")

    def _write(self, name, df, mode, partition_by, overwrite) -> int:
        # Only a partitioned layout is shuffled for the writer: rebalancing gives each
        # day few files and splits a day that holds a third of the rows. Other tables
        # keep the partitions adaptive execution sized, and their sort order.
        frame, seen = counted(df.hint("rebalance", *partition_by) if partition_by else df)
        writer = frame.write.option("partitionOverwriteMode", overwrite)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if (mode, overwrite) == ("overwrite", "static"):
            self._replace(name, writer)
        else:
            writer.mode(mode).parquet(self.path(name))
        return seen.get["rows"]

    def _replace(self, name: str, writer) -> None:
        # The old table stays until the new one is complete.
        staged = f"{self.root}/_staged-{uuid.uuid4().hex}"
        writer.parquet(staged)
        _swap(self.spark, staged, self.path(name))


class VersionedStore(TableStore):
    """Tables whose readers always find a whole one, on an object store too.

    Every rebuild writes a folder of its own, and counts once it is complete: an empty file with
    its number appears, and readers take the highest number. Nothing is renamed or
    replaced. The version before the newest stays for jobs that still read it; older ones go.
    """

    def _versions(self, name: str) -> list[str]:
        files, path = _hadoop(self.spark, f"{self.root}/{name}/_versions")
        return sorted(f.getPath().getName() for f in files.listStatus(path)) if files.exists(path) else []

    def path(self, name: str) -> str:
        """The folder of the newest complete version."""
        found = self._versions(name)
        return f"{self.root}/{name}/{found[-1]}" if found else f"{self.root}/{name}"

    def _replace(self, name: str, writer) -> None:
        found = self._versions(name)
        number = int(found[-1].split("-")[0]) + 1 if found else 1
        version = f"{number:012}-{uuid.uuid4().hex}"
        writer.parquet(f"{self.root}/{name}/{version}")
        write_bytes(self.spark, f"{self.root}/{name}/_versions/{version}", b"")
        for old in found[:-1]:
            for gone in (f"{name}/_versions/{old}", f"{name}/{old}"):
                files, path = _hadoop(self.spark, f"{self.root}/{gone}")
                files.delete(path, True)


def _hadoop(spark: SparkSession, path: str):
    """The file system and path object by which Spark itself reaches a path."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished folder in another one's place."""
    files, target = _hadoop(spark, path)
    source, old = (_hadoop(spark, p)[1] for p in (staged, f"{staged}-replaced"))
    files.mkdirs(target.getParent())
    if files.exists(target):
        files.rename(target, old)
    if not files.rename(source, target):
        files.rename(old, target)
        raise OSError(f"{staged} could not be moved to {path}")
    files.delete(old, True)
    spark.catalog.refreshByPath(path)
