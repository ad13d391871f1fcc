"""Incremental landing: documents that arrived since the last run, flattened once.

Silver needs the whole history of an entity, but parsing every old document again for it is the
costly part. A file stream keeps track of the documents already seen; their candidate rows stay as
Parquet, and Silver is built from those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import iso_day
from tidemark.plans.silver import candidates, newest_with_features
from tidemark.sources.registry import DOCUMENT, get_source
from tidemark.sources.storage import partition_values

BATCH = "batch"


def land_candidates(
    spark: SparkSession,
    source: str,
    bronze_path: str,
    flat_path: str,
    checkpoint: str,
    files_per_batch: int = 10_000,
) -> None:
    """Flatten the documents that are new under `bronze_path` and return when all are done.

    A batch that is repeated after a failure replaces its own output.
    """
    spec = get_source(source)

    def write(documents: DataFrame, batch: int) -> None:
        dated = documents.withColumn("logical_date", iso_day(F.col("logical_date")))
        rows = candidates(dated, spec)
        rows.write.mode("overwrite").parquet(f"{flat_path}/{BATCH}={batch}")

    arriving = (
        spark.readStream.schema(spec.bronze_schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(bronze_path)
        .withColumn(DOCUMENT, F.col("_metadata.file_path"))
        .where(F.col("source") == source)
    )
    query = (
        arriving.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def silver_from_candidates(
    spark: SparkSession, source: str, flat_path: str, bronze_path: str | None = None
) -> DataFrame:
    """Silver over everything landed so far, as `to_silver` makes it of the same documents.

    Landing a day again replaces its files. With `bronze_path`, rows of files that are gone from there
    don't count any more, whichever day, place or part of a pull they were of.
    """
    batches = partition_values(spark, flat_path, BATCH)
    if not batches:
        return spark.createDataFrame([], get_source(source).silver_schema)
    rows = spark.read.parquet(flat_path).drop(BATCH)
    if bronze_path is not None:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(bronze_path)
        # Names only: the content of the files is not read.
        present = listed.select(F.col("_metadata.file_path").alias(DOCUMENT))
        rows = rows.join(present, DOCUMENT, "left_semi")
    return newest_with_features(rows, source)
