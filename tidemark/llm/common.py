"""Helpers that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources.storage import delete

# A side is broadcast only if it is known to have at most so many rows; its rows are narrow.
BROADCAST_ROWS = 400_000


def fold_case(text: Column) -> Column:
    """A-Z become a-z and nothing else changes; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def staged(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: lineage ends here, and a lost
    executor costs a read instead of a recomputation."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


class Scratch:
    """Intermediate tables of one call, removed when it ends. What a result still reads is `staged`."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            delete(self.spark, path)

    def staged(self, frame: DataFrame, label: str) -> DataFrame:
        self.paths.append(scratch_path(self.spark, label))
        frame.write.parquet(self.paths[-1])
        return self.spark.read.schema(frame.schema).parquet(self.paths[-1])


#: Bytes of rows that go to a Python worker at once; a longer row goes alone.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the batches of this session for Python workers, unless they are bounded closer already: what
    the executor and its workers hold follows from them, whatever the rows are like."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(setting).rstrip("bB")
    if not held.isdigit() or int(held) > BATCH_BYTES:
        spark.conf.set(setting, str(BATCH_BYTES))


def narrow_side(frame: DataFrame, rows: int | None = None) -> DataFrame:
    """A join side of narrow rows: broadcast when it is counted to be small, else left to a shuffle."""
    rows = frame.count() if rows is None else rows
    return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
