"""Tables in partitions that are replaced together: rows are written once, then one file switches over."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.storage import (
    create_exclusively, delete, exists, files_in, partition_values, read_small, subfolders,
)

Folders = tuple[str, ...]
VERSIONS = "_versions"


class ConflictError(RuntimeError):
    """Another load has replaced a partition in the meantime; this one can be run again."""


@dataclass(frozen=True)
class Section:
    """One set of partitions; `order` is how rows lie in a file."""

    schema: T.StructType
    partition: str
    order: tuple[str, ...] = ()


@dataclass(frozen=True)
class State:
    """Which folders hold each partition of each section, as of a version."""

    version: int = 0
    folders: dict[str, dict[int, Folders]] = field(default_factory=dict)

    def of(self, section: str) -> dict[int, Folders]:
        return self.folders.get(section, {})


@dataclass(frozen=True)
class Load:
    """Rows that are written but not seen yet."""

    folder: str
    values: frozenset[int]

    @property
    def folders(self) -> dict[int, Folders]:
        return {v: (self.folder,) for v in self.values}


class PartitionedTable:
    """Sections of one table under a path: `<section>/<load>/<partition>=<value>/*.parquet`, and versions.

    A version names the folders of every partition. A load writes its rows to a folder of its own, and
    becomes visible, whole, with the next version, a small file that is created exclusively. So readers
    see the state before or after a load, a load that dies leaves no trace but an unnamed folder, and
    two loads that replace the same partition can't both win. The folders of the version before stay for
    those who still read them.
    """

    def __init__(self, spark: SparkSession, path: str, sections: Mapping[str, Section]) -> None:
        self.spark, self.path, self.sections = spark, path.rstrip("/"), dict(sections)

    # -- versions

    def _file(self, version: int) -> str:
        return f"{self.path}/{VERSIONS}/v-{version:09d}.json"

    def _versions(self) -> list[int]:
        names = files_in(self.spark, f"{self.path}/{VERSIONS}")
        return sorted(int(n[2:-5]) for n in names if n.startswith("v-") and n.endswith(".json"))

    def _state(self, version: int) -> State:
        kept = json.loads(read_small(self.spark, self._file(version)))
        return State(version, {s: {int(v): tuple(f) for v, f in own.items()} for s, own in kept.items()})

    def state(self) -> State:
        versions = self._versions()
        return self._state(versions[-1]) if versions else State()

    # -- rows

    def _schema(self, section: str) -> T.StructType:
        own = self.sections[section]
        if own.partition in own.schema.fieldNames():
            return own.schema
        return T.StructType([*own.schema.fields, T.StructField(own.partition, T.IntegerType())])

    def open(self, section: str, folders: Mapping[int, Folders]) -> DataFrame:
        """The rows of partitions, by the folders that hold them."""
        schema, own = self._schema(section), self.sections[section]
        paths = [f"{self.path}/{section}/{f}/{own.partition}={v}" for v, fs in sorted(folders.items()) for f in fs]
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("load", T.StringType())]))
        return reader.option("basePath", f"{self.path}/{section}").parquet(*paths).select(*schema.fieldNames())

    def read(self, section: str, values: Iterable[int] | None = None, state: State | None = None) -> DataFrame:
        """The rows of a section, or of some of its partitions."""
        folders = (state or self.state()).of(section)
        if values is not None:
            folders = {v: folders[v] for v in set(values) & set(folders)}
        return self.open(section, folders)

    def write(self, section: str, rows: DataFrame, dealt: bool = True) -> Load:
        """Write rows to a folder of their own, in partitions; nobody sees them yet.

        Unless `dealt`, the rows of a partition aren't brought together first. That saves a shuffle, and
        each task writes a file for each partition that it has rows of, so there should be few.
        """
        own, folder = self.sections[section], f"load={uuid4().hex[:12]}"
        path = f"{self.path}/{section}/{folder}"
        rows = rows.select(*self._schema(section).fieldNames())
        (
            (rows.hint("rebalance", own.partition) if dealt else rows)
            # Keys of an entity lie together in a file, so a scan for one skips most row groups.
            .sortWithinPartitions(own.partition, *own.order)
            .write.partitionBy(own.partition).parquet(path)
        )
        values = partition_values(self.spark, path, own.partition)
        if "__HIVE_DEFAULT_PARTITION__" in values:
            delete(self.spark, path)
            raise ValueError(f"{self.path}: {own.partition} must not be null")
        return Load(folder, frozenset(int(v) for v in values))

    # -- the switch

    def publish(self, base: State, changes: Mapping[str, Mapping[int, Folders]]) -> State:
        """Make partitions consist of the given folders, all at once; without folders a partition ends.

        `base` is the state that the changes were worked out from.
        """
        while True:
            now = self.state()
            for section, own in changes.items():
                moved = [v for v in own if now.of(section).get(v) != base.of(section).get(v)]
                if moved:
                    raise ConflictError(f"{self.path}: another load has replaced {sorted(moved)} of {section}")
            folders = {s: dict(own) for s, own in now.folders.items()}
            for section, own in changes.items():
                merged = folders.setdefault(section, {})
                merged.update(own)
                folders[section] = {v: tuple(f) for v, f in merged.items() if f}
            new = State(now.version + 1, folders)
            text = json.dumps({s: {str(v): list(f) for v, f in own.items()} for s, own in folders.items()})
            if create_exclusively(self.spark, self._file(new.version), text):
                self._forget(new)
                return new

    def _forget(self, newest: State) -> None:
        """Remove the version before the last one, and the folders that only it names."""
        old = newest.version - 2
        if old < 1 or not exists(self.spark, self._file(old)):
            return
        named = {(s, v, f) for kept in (newest, self._state(newest.version - 1)) for s, own in kept.folders.items() for v, fs in own.items() for f in fs}
        for section, own in self._state(old).folders.items():
            for value, folders in own.items():
                for folder in folders:
                    if (section, value, folder) not in named:
                        delete(self.spark, f"{self.path}/{section}/{folder}/{self.sections[section].partition}={value}")
        delete(self.spark, self._file(old))

    def vacuum(self) -> list[str]:
        """Remove folders that no version names, such as loads that died; not while a load is running."""
        named = {(s, f) for v in self._versions() for s, own in self._state(v).folders.items() for fs in own.values() for f in fs}
        lost = [
            f"{self.path}/{section}/{folder}"
            for section in self.sections
            for folder in subfolders(self.spark, f"{self.path}/{section}")
            if (section, folder) not in named
        ]
        for path in lost:
            delete(self.spark, path)
        return lost


def survivors(old: DataFrame, new: DataFrame, key: Iterable[str]) -> DataFrame | None:
    """The rows of `old` whose key `new` doesn't have; None if there are none, found out on the keys alone."""
    key = list(key)
    if old.select(*key).join(new.select(*key), key, "left_anti").isEmpty():
        return None
    return old.join(new.select(*key), key, "left_anti").select(*old.columns)


def content_key(*columns: str):
    """A short key of some columns, for an index."""
    return F.unhex(F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})))
