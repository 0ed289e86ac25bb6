"""Raw and mart tables as parquet or JDBC, and the projections the feature job reads."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column and its name in the projection; timestamps are read as text.
PROJECTIONS: dict[str, dict[str, str]] = {
    "customers_details": {
        "customer_pk": "customer_pk",
        "customer_id": "customer_id",
        "registration_date": "registration_date",
        "is_loyalty_member": "is_loyalty_member",
        "version": "version",
    },
    "purchases_details": {
        "purchase_pk": "purchase_pk",
        "customer_pk": "customer_pk",
        "store_pk": "store_pk",
        "delivery_address_id": "delivery_address_id",
        "total_amount": "total_amount",
        "payment_method_id": "payment_method_id",
        "is_delivery": "is_delivery",
        "purchase_datetime": "purchase_datetime",
        "version": "version",
    },
    "dim_delivery_addresses": {
        "delivery_address_id": "delivery_address_id",
        "city_id": "delivery_city_id",
        "version": "version",
    },
    "dim_payment_method": {
        "payment_method_id": "payment_method_id",
        "payment_method_name": "payment_method_name",
        "version": "version",
    },
    "products_details": {
        "product_pk": "product_pk",
        "name": "product_name",
        "price": "price",
        "is_organic": "is_organic",
        "product_id": "product_id",
        "category_id": "category_id",
        "version": "version",
    },
    "dim_categories": {
        "category_id": "category_id",
        "clear_category_name": "category_name",
        "version": "version",
    },
    "stores_details": {
        "store_pk": "store_pk",
        "delivery_available": "store_delivery_available",
        "location_id": "location_id",
        "version": "version",
    },
    "dim_address": {"address_id": "address_id", "city_id": "store_city_id", "version": "version"},
    "purchase_item_details": {
        "item_pk": "item_pk",
        "purchase_pk": "purchase_pk",
        "product_pk": "product_pk",
        "quantity": "quantity",
        "total_price": "total_price",
        "version": "version",
    },
}


def _readable(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    return column


def project_mart(df: DataFrame, table: str) -> DataFrame:
    """The columns the feature job needs of a mart table, renamed; tables without a projection stay whole."""
    projection = PROJECTIONS.get(table)
    if projection is None:
        return df
    return df.select(*[_readable(df, name).alias(alias) for name, alias in projection.items()])


def normalize_unsigned(df: DataFrame) -> DataFrame:
    """Unsigned 64-bit columns, which come as decimal(20,0), to bigint in two's complement: no key is lost."""
    top = F.lit(str(2**64)).cast("decimal(20,0)")
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType) and (field.dataType.precision, field.dataType.scale) == (20, 0):
            signed = F.when(column > 2**63 - 1, column - top).otherwise(column)
            column = signed.cast("bigint").alias(field.name)
        columns.append(column)
    return df.select(*columns)


Reader = Callable[[str], DataFrame]


def parquet_reader(spark: SparkSession, root: str) -> Reader:
    return lambda table: spark.read.parquet(f"{root}/{table}")


@dataclass(frozen=True)
class Split:
    """How to read a JDBC table in parallel: a numeric column, its range and the number of reads."""

    column: str
    lower: int
    upper: int
    partitions: int


def jdbc_options(
    url: str, table: str, split: Split | None = None, fetch_size: int = 10_000, **extra: str
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options


def jdbc_reader(
    spark: SparkSession,
    url: str,
    splits: Mapping[str, Split] | None = None,
    prefix: str = "",
    **extra: str,
) -> Reader:
    """Tables over JDBC. Spark sends the projections and filters to the database; a table with a split is read by
    that many tasks instead of one."""

    def read(table: str) -> DataFrame:
        options = jdbc_options(url, f"{prefix}{table}", (splits or {}).get(table), **extra)
        return spark.read.format("jdbc").options(**options).load()

    return read


def read_mart(reader: Reader, table: str) -> DataFrame:
    """A mart table as the feature job reads it."""
    return normalize_unsigned(project_mart(reader(table), table))


def write_by_month(
    df: DataFrame, path: str, mode: str = "append", ts: str = "load_date", *, rebalance: bool = False
) -> None:
    """Write partitioned by load month, so that expired months can be dropped and pruned whole.

    Rows go to the files of their month straight from the task that made them, so a month with most of the rows
    does not pass through one task. ``rebalance`` shuffles first, for loads of many months that would leave many
    small files; AQE splits large months and merges small ones.
    """
    dated = df.withColumn("load_month", F.date_format(ts, "yyyyMM"))
    if rebalance:
        dated = dated.hint("rebalance", "load_month")
    dated.write.mode(mode).partitionBy("load_month").parquet(path)


def read_by_month(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Read back a table written by month; ``since`` (yyyyMM) prunes older months."""
    df = spark.read.parquet(path)
    df = df.withColumn("load_month", F.col("load_month").cast("string"))
    return df if since is None else df.filter(F.col("load_month") >= since)
