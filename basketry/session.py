"""Spark session settings and the shared working folder."""

from __future__ import annotations

import tempfile
from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import SparkSession

# What every job of the library expects from its session. AQE re-plans joins from the real shuffle sizes and
# splits hot partitions; the timestamps of the data model are UTC.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # call sites in error messages cost a round trip per column expression
    "spark.sql.dataFrameQueryContext.enabled": "false",
    # wide projections generate methods the JVM will not compile beyond 8000 bytes; smaller ones are faster
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # keys in hex hold half the bits of their text, which zstd leaves out and snappy does not
    "spark.sql.parquet.compression.codec": "zstd",
}


def object_store(
    endpoint: str,
    access_key: str | None = None,
    secret_key: str | None = None,
    region: str | None = None,
    multipart_bytes: int = 100 * 1024 * 1024,
    timeout_ms: int = 600_000,
    attempts: int = 20,
) -> dict[str, str]:
    """Session settings for an S3-compatible store. Keys left out fall to the cluster's credential provider."""
    settings = {
        "fs.s3a.endpoint": endpoint,
        "fs.s3a.endpoint.region": region,
        "fs.s3a.access.key": access_key,
        "fs.s3a.secret.key": secret_key,
        "fs.s3a.path.style.access": "true",
        "fs.s3a.connection.ssl.enabled": str(not endpoint.startswith("http://")).lower(),
        "fs.s3a.multipart.size": str(multipart_bytes),
        "fs.s3a.connection.timeout": str(timeout_ms),
        "fs.s3a.attempts.maximum": str(attempts),
    }
    return {f"spark.hadoop.{key}": value for key, value in settings.items() if value is not None}


def build_session(
    app_name: str = "basketry", master: str | None = None, extra: Mapping[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the library's SQL settings on a session somebody else started."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir()


@lru_cache(maxsize=1)
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="basketry-")
