"""Tables kept in buckets of a key, so that what is done by that key needs no shuffle.

A bucket is the file of the rows whose key hashes to it, the same hash by which Spark would shuffle them. Tables with
equal numbers of buckets join bucket by bucket; the last version of a key, or a sum by it, is found within one. Purchases
and their items, both by purchase, are the pair this is for: they are shuffled once, when they are written, and not
again by each job that reads them.

The number of buckets is the number of tasks that read the table; take it so that a bucket holds some 200 MB.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from basketry.plans.prepare import MartInputs

PURCHASE = "purchase_pk"


def write_buckets(df: DataFrame, name: str, path: str, key: str, buckets: int, mode: str = "overwrite") -> DataFrame:
    """Write a table in buckets of ``key``, sorted by it, under ``path``, and return it as a table of the session.

    Rows are brought together by key first, so a load adds one file to each bucket, not one per task.
    """
    rows = df.repartition(buckets, key).write.format("parquet").mode(mode)
    rows.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def open_buckets(spark: SparkSession, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A table that another session wrote; its number of buckets is not in its files and must be told."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    spark.sql(
        f"CREATE TABLE `{name}` ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def by_purchase(inputs: MartInputs, purchases: DataFrame, items: DataFrame) -> MartInputs:
    """Mart inputs with purchases and items in buckets of the purchase.

    The key of an item is made of its purchase among others, so its versions are found within the purchase.
    """
    return replace(inputs, purchases=purchases, items=items, item_keys=(PURCHASE, "item_pk"))
