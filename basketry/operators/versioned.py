"""Versioned rows: the last version of a key wins, old rows expire."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Retention in days: fixed values.
RAW_DAYS = 180
MART_DAYS = 365


def _sortable(dtype: T.DataType) -> bool:
    return not isinstance(dtype, (T.MapType, T.VariantType))


def latest_version(
    df: DataFrame,
    keys: Sequence[str],
    version: str = "version",
    tie_break: Sequence[str] | None = None,
    ties: str = "one",
) -> DataFrame:
    """The rows with the highest version of their key.

    ``ties="one"`` keeps one row per key; among equal versions the highest values of ``tie_break`` win (all other
    columns, unless some are named), so the result does not depend on row order. Spark cuts each map partition to
    one row per key before the shuffle, so a key that holds many of the rows is no burden.

    ``ties="all"`` keeps every row of the highest version. That is a join with the aggregated maximum, since a
    window would hold a hot key in one task, while AQE can split it in a join.
    """
    keys = list(keys)
    if ties == "all":
        newest = df.groupBy(*keys).agg(F.max(version).alias(version))
        return df.join(newest, [*keys, version], "inner").select(*df.columns)
    if ties != "one":
        raise ValueError(f"ties must be 'one' or 'all', not {ties!r}")
    if tie_break is None:
        tie_break = [
            f.name for f in df.schema.fields if f.name not in (*keys, version) and _sortable(f.dataType)
        ]
    order = [F.col(version).desc_nulls_last(), *[F.col(name).desc_nulls_last() for name in tie_break]]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def expire(df: DataFrame, ts: str, days: int, as_of: date | datetime | None = None) -> DataFrame:
    """Drop rows that are ``days`` or more days old at ``as_of``. A plain comparison, so it reaches the scan."""
    if as_of is None:
        limit = F.current_timestamp() - F.make_dt_interval(F.lit(days))
    else:
        limit = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return df.filter(F.col(ts) > limit.cast(df.schema[ts].dataType))


def version_stamp(load_date: Column) -> Column:
    """Version of a row: the second it was loaded."""
    return F.unix_timestamp(load_date.cast("timestamp"))
