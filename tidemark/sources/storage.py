"""Files on the cluster's storage, through the Hadoop file system Spark itself uses."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.mkdirs(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under `path`; empty when it does not exist."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def files_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under `path` but hidden ones; empty when it does not exist."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isFile()]
    return sorted(n for n in names if not n.startswith("."))


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def create_exclusively(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its text, unless it exists; of several writers exactly one succeeds.

    The text is written aside first, so that nobody reads half of it. The rename that follows fails on a
    distributed file system if the name is taken; a local one would overwrite, so there the name is
    linked.
    """
    fs, target = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    fs.mkdirs(target.getParent())
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if fs.getScheme() != "file":
        taken = not fs.rename(aside, target)
        if taken:
            fs.delete(aside, False)
        return not taken
    plain = [jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath() for p in (target, aside)]
    try:
        jvm.java.nio.file.Files.createLink(*plain)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        return False
    finally:
        fs.delete(aside, False)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path or glob."""
    fs, target = _fs(spark, path)
    return sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(target) or [])


def files_under(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(URI, bytes) of the data files under a path or glob, in the order of their names."""
    fs, target = _fs(spark, path)
    found = []
    for status in fs.globStatus(target) or []:
        own = status.getPath().toUri().getPath().rstrip("/")
        listed = fs.listFiles(status.getPath(), True)
        while listed.hasNext():
            file = listed.next()
            inside = file.getPath().toUri().getPath()[len(own) :]
            if not any(n.startswith(("_", ".")) for n in inside.split("/")):
                found.append((file.getPath().toString(), file.getLen()))
    return sorted(found)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the first-level Hive partitions under `path`."""
    prefix = f"{column}="
    return [n[len(prefix):] for n in subfolders(spark, path) if n.startswith(prefix)]


# Input per shuffle task.
SHUFFLE_BYTES = 128 * 1024 * 1024


def size_shuffles(spark: SparkSession, *paths: str) -> int:
    """Raise the number of shuffle partitions to what the stored input asks for.

    A fixed number is wrong for either a day or the whole history. It is never lowered: adaptive
    execution merges partitions that turn out small, but it cannot make large ones fit.
    """
    needed = -(-sum(stored_bytes(spark, p) for p in paths) // SHUFFLE_BYTES)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chosen = max(current, needed)
    spark.conf.set("spark.sql.shuffle.partitions", str(chosen))
    return chosen


@contextmanager
def visible_as(df: DataFrame, name: str) -> Iterator[str]:
    """Make a frame readable from SQL under `name` for the length of a block."""
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)


class Snapshots:
    """A small table kept as numbered, complete snapshots; readers see the newest finished one.

    Replacing a table while reading it would lose it, and a folder only counts once Spark has
    committed it, so a write that dies half-way leaves the previous snapshot in place.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keep: int = 2) -> None:
        self.spark, self.path, self.schema, self.keep = spark, path, schema, keep

    def _finished(self) -> list[str]:
        return [
            name
            for name in subfolders(self.spark, self.path)
            if exists(self.spark, f"{self.path}/{name}/_SUCCESS")
        ]

    def current(self) -> str | None:
        """Name of the newest finished snapshot; its content never changes."""
        finished = self._finished()
        return finished[-1] if finished else None

    def read(self) -> DataFrame:
        finished = self._finished()
        if not finished:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{finished[-1]}")

    def replace(self, df: DataFrame) -> None:
        everything = subfolders(self.spark, self.path)
        number = int(everything[-1].split("-")[1]) + 1 if everything else 1
        df.select(*self.schema.fieldNames()).write.parquet(f"{self.path}/v-{number:09d}")
        for name in self._finished()[: -self.keep]:
            delete(self.spark, f"{self.path}/{name}")
