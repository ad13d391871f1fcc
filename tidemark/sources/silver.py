"""Silver: typed flat datasets as partitioned Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_silver(
    df: DataFrame, path: str, partition_cols: Sequence[str], full_refresh: bool = False
) -> None:
    """Write Parquet partitioned by `partition_cols`.

    By default only the partitions present in `df` are replaced. With `full_refresh` the whole
    dataset is, which also clears partitions all of whose rows moved elsewhere. Rebalancing first
    gives each partition few, evenly sized files and splits a partition that holds most rows.
    """
    mode = "static" if full_refresh else "dynamic"
    (
        df.hint("rebalance", *partition_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def read_silver(spark: SparkSession, source: str, path: str) -> DataFrame:
    """Read a Silver dataset with its contract's columns and order."""
    from tidemark.sources.registry import get_source

    schema = get_source(source).silver_schema
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
