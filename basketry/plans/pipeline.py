"""The whole job: document folders to raw tables, mart tables, and the exported matrix.

Each layer is written to a table in a folder all executors share, so a lost executor costs one layer at most.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.pii import SENSITIVE_TOPICS, mask_pii, stamp
from basketry.plans.features import FeatureSpec, feature_matrix, require_customers
from basketry.plans.mart import DETAILS, MART_KEYS, MartContext, mart_table
from basketry.plans.prepare import MartInputs
from basketry.plans.raw import FLATTEN
from basketry.schemas import RAW_TABLES
from basketry.sources.documents import load_all
from basketry.sources.export import export_csv
from basketry.sources.tables import Reader, parquet_reader, write_by_month


def documents_to_raw(documents: Mapping[str, DataFrame], load_ts: Column | None = None) -> dict[str, DataFrame]:
    """Raw tables straight from documents, masked, without the topic hop."""
    raw = {}
    for topic, df in documents.items():
        stamped = stamp(df, load_ts) if "kafka_send_date" not in df.columns else df
        masked = mask_pii(stamped) if topic in SENSITIVE_TOPICS else stamped
        raw[RAW_TABLES[topic]] = FLATTEN[topic](masked, load_ts)
    return raw


def raw_to_mart(raw: Mapping[str, DataFrame], context: MartContext) -> dict[str, DataFrame]:
    return {target: mart_table(target, raw, context) for target in MART_KEYS}


def mart_reader(mart: Mapping[str, DataFrame]) -> Reader:
    return lambda table: mart[table]


def write_layers(
    spark: SparkSession, documents: Mapping[str, DataFrame], work: str, context: MartContext, load_ts: Column | None
) -> Reader:
    """Write the raw and mart tables under ``work`` and return a reader of the mart."""
    for table, df in documents_to_raw(documents, load_ts).items():
        write_by_month(df, f"{work}/raw/{table}", mode="overwrite")
    read_raw = parquet_reader(spark, f"{work}/raw")
    raw = {table: read_raw(table) for table in RAW_TABLES.values()}
    for target, df in raw_to_mart(raw, context).items():
        path = f"{work}/mart/{target}"
        if target in DETAILS:
            write_by_month(df, path, mode="overwrite")
        else:
            df.write.mode("overwrite").parquet(path)
    return parquet_reader(spark, f"{work}/mart")


def run(
    spark: SparkSession,
    folders: Mapping[str, str],
    work: str,
    as_of: date,
    context: MartContext | None = None,
    spec: FeatureSpec | None = None,
    *,
    one_per_file: bool = True,
    prefix: str = "analytics",
) -> str:
    """Load, mask, flatten, clean, compute the flags and export them. Returns the path of the matrix."""
    context = context or MartContext(as_of=as_of)
    loaded = load_all(spark, folders, f"{work}/documents", one_per_file=one_per_file)
    documents = {topic: spark.read.parquet(path) for topic, path in loaded.items()}
    load_ts = F.current_timestamp()
    reader = write_layers(spark, documents, work, context, load_ts)
    inputs = MartInputs.read(reader)
    require_customers(inputs)
    return export_csv(feature_matrix(inputs, as_of, spec), work, as_of, prefix)
