"""Expiry of stored tables: old month partitions are dropped whole, only the month of the limit is rewritten.

What stays is what ``expire`` keeps. Months before the limit are folders that are deleted unread; months after it are
not touched. The month in which the limit lies is filtered into a folder beside the table, and from there it replaces
its partition by dynamic partition overwrite. A run that stops in between leaves that folder; the next one finishes what
it holds before anything else, so at no time is the only copy of a row in a table that is being overwritten.

A table without month folders, such as a dimension, is filtered and replaced as a whole in the same way.

The partitions must be those of the time column that expires (``write_by_month``). Readers of the months concerned
should not run at the same time: files they listed go.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from basketry.operators.versioned import MART_DAYS, RAW_DAYS, expire
from basketry.plans.mart import MART_KEYS
from basketry.schemas import RAW_TABLES
from basketry.sources.partitions import NO_VALUE, Folder, drop_partitions, partition_values

MONTH = "load_month"


@dataclass(frozen=True)
class Expiry:
    """What a run did to a table: the months it dropped, and the one it rewrote, if any."""

    dropped: tuple[str, ...] = ()
    rewritten: str | None = None


def _instant(as_of: date | datetime | None) -> datetime:
    if as_of is None:
        return datetime.now(timezone.utc)
    if isinstance(as_of, datetime):
        return as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
    return datetime.combine(as_of, time(), timezone.utc)


def expire_stored(
    spark: SparkSession, path: str, days: int, as_of: date | datetime | None = None, ts: str = "load_date"
) -> Expiry:
    """Remove the rows that are ``days`` or more days old at ``as_of`` from the table at ``path``.

    A rerun with the same ``as_of`` finds nothing left to do.
    """
    as_of = _instant(as_of)
    staged = f"{path.rstrip('/')}.kept"
    if Folder(spark, staged).exists("_SUCCESS"):
        _replace(spark, path, staged)
    months = partition_values(spark, path, MONTH)
    if not months:
        return _expire_whole(spark, path, staged, days, as_of, ts)
    border = f"{as_of - timedelta(days=days):%Y%m}"
    # rows without a time are none that the filter keeps
    old = [month for month in months if month < border or month == NO_VALUE]
    rewritten = None
    if border in months:
        stored = spark.read.option("basePath", path).parquet(f"{path}/{MONTH}={border}")
        stored = stored.withColumn(MONTH, F.col(MONTH).cast("string"))
        kept = expire(stored, ts, days, as_of)
        before, after = stored.count(), kept.count()
        if after == 0:
            old.append(border)
        elif after < before:
            kept.write.mode("overwrite").partitionBy(MONTH).parquet(staged)
            _replace(spark, path, staged)
            rewritten = border
    drop_partitions(spark, path, MONTH, old)
    return Expiry(tuple(sorted(old)), rewritten)


def _expire_whole(spark: SparkSession, path: str, staged: str, days: int, as_of: datetime, ts: str) -> Expiry:
    stored = spark.read.parquet(path)
    kept = expire(stored, ts, days, as_of)
    if kept.count() < stored.count():
        kept.write.mode("overwrite").parquet(staged)
        _replace(spark, path, staged)
    return Expiry()


def _replace(spark: SparkSession, path: str, staged: str) -> None:
    """Put the staged rows in the place of the partitions they belong to, or of the table if it has none."""
    rows = spark.read.parquet(staged)
    writer = rows.write.mode("overwrite")
    if MONTH in rows.columns:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(MONTH)
    writer.parquet(path)
    Folder(spark, staged).drop()


def expire_layers(spark: SparkSession, work: str, as_of: date | datetime | None = None) -> dict[str, Expiry]:
    """Expire the raw and mart tables that ``plans.pipeline`` writes under ``work``."""
    as_of = _instant(as_of)
    done = {}
    for table in RAW_TABLES.values():
        done[table] = expire_stored(spark, f"{work}/raw/{table}", RAW_DAYS, as_of)
    for table in MART_KEYS:
        done[table] = expire_stored(spark, f"{work}/mart/{table}", MART_DAYS, as_of)
    return done

