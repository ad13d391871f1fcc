"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Beyond this many rows a LIMIT/OFFSET runs as a distributed sort instead of a top-k heap per task.
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
}

# Read from the environment so that credentials never appear in code or on a command line.
S3A_ENV = {
    "AWS_ENDPOINT_URL": "spark.hadoop.fs.s3a.endpoint",
    "AWS_ACCESS_KEY_ID": "spark.hadoop.fs.s3a.access.key",
    "AWS_SECRET_ACCESS_KEY": "spark.hadoop.fs.s3a.secret.key",
}


def object_store_settings(env: Mapping[str, str]) -> dict[str, str]:
    """S3A settings for the variables that are present; empty when none is."""
    found = {option: env[name] for name, option in S3A_ENV.items() if env.get(name)}
    if "AWS_ENDPOINT_URL" in env:
        found["spark.hadoop.fs.s3a.path.style.access"] = "true"
        tls = env["AWS_ENDPOINT_URL"].startswith("https")
        found["spark.hadoop.fs.s3a.connection.ssl.enabled"] = str(tls).lower()
    return found


def build_session(
    app_name: str,
    master: str | None = None,
    env: Mapping[str, str] | None = None,
    extra: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with the library's settings; `master` is left to spark-submit when None."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    env = os.environ if env is None else env
    for option, value in {**SETTINGS, **object_store_settings(env), **(extra or {})}.items():
        builder = builder.config(option, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime SQL settings on a session somebody else built."""
    for option, value in SETTINGS.items():
        spark.conf.set(option, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_root(spark: SparkSession) -> str:
    """Where this application keeps its scratch tables; of no use once it ends."""
    return f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing else writes there."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
