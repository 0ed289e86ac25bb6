"""Quality gates and the counts behind the monitoring of each layer."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REASONS = "_reasons"
DUPLICATE_ALERT_PERCENT = 50.0


def filled(*names: str) -> dict[str, Column]:
    """Rules: these text columns are neither missing nor empty."""
    return {f"{name} is empty": F.col(name) != "" for name in names}


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the names of the broken rules. A rule that cannot be decided (NULL) is broken."""
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn(REASONS, F.array_compact(F.array(*broken)))


def accepted(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that pass every rule; plain conditions, so they reach the scan."""
    return df.filter(reduce(lambda a, b: a & b, rules.values()))


def rejected(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break a rule, with the reasons."""
    return with_reasons(df, rules).filter(F.size(REASONS) > 0)


def quality_gate(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split into accepted rows and rejected rows with reasons. No row is lost."""
    return accepted(df, rules), rejected(df, rules)


def duplicate_ratio(
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]], threshold: float = DUPLICATE_ALERT_PERCENT
) -> DataFrame:
    """Per table: rows, distinct keys, percent of duplicates, and whether that is above the threshold."""
    parts = []
    for name, (df, keys) in tables.items():
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
                F.count(F.lit(1)).alias("distinct_keys"),
            ).select(F.lit(name).alias("table_name"), "total_rows", "distinct_keys")
        )
    share = F.coalesce(F.try_divide(F.col("distinct_keys"), F.col("total_rows")), F.lit(1.0))
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("duplicate_percent", F.round((1 - share) * 100, 4))
        .withColumn("alert", F.col("duplicate_percent") > threshold)
    )


def dataset_stats(spark: SparkSession, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]) -> DataFrame:
    """Per table: number of rows and whether it is empty. A table that cannot be opened gets its error instead."""
    parts = []
    for name, table in tables.items():
        error = None
        try:
            df = table() if callable(table) else table
            counted = df.agg(F.count(F.lit(1)).alias("total_documents"))
        except PySparkException as problem:
            error = str(problem).splitlines()[0]
            counted = spark.range(1).select(F.lit(0).cast("bigint").alias("total_documents"))
        parts.append(
            counted.select(
                F.lit(name).alias("name"),
                "total_documents",
                (F.col("total_documents") == 0).alias("is_empty"),
                F.lit(error).cast("string").alias("error"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def sample_documents(
    tables: Mapping[str, DataFrame], n: int = 3, keys: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """A few documents of each table as JSON, for a look at the data: those whose ``keys`` have the smallest hashes.

    The same documents however the table is partitioned or ordered. Each task keeps its ``n`` smallest, so only these
    are sent anywhere. Tables without named keys are taken by the whole document.
    """
    parts = []
    for name, df in tables.items():
        document = F.to_json(F.struct("*"))
        columns = (keys or {}).get(name)
        key = document if columns is None else F.concat_ws("\u0001", *(F.col(c).cast("string") for c in columns))
        rows = df.select(F.md5(key.cast("binary")).alias("_hash"), document.alias("document"))
        parts.append(rows.orderBy("_hash", "document").limit(n).select(F.lit(name).alias("name"), "document"))
    return reduce(DataFrame.unionByName, parts)


def require_rows(stats: DataFrame) -> int:
    """Total over all tables; an empty total is an error."""
    total = stats.agg(F.sum("total_documents")).first()[0] or 0
    if total == 0:
        raise ValueError("no documents in any table")
    return total
