"""Folders of JSON documents."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.clean import parse_json
from basketry.schemas import CORRUPT, DOCUMENTS


@dataclass(frozen=True)
class Documents:
    """What a folder held: the documents, and the files that could not be read."""

    good: DataFrame
    rejected: DataFrame


def read_documents(
    spark: SparkSession, path: str, collection: str | T.StructType, *, one_per_file: bool = True
) -> Documents:
    """Read every ``.json`` file of a folder with a fixed schema.

    ``one_per_file`` reads one document per file, as the source keeps them; without it every line is a document,
    which splits large files over tasks. Documents that cannot be read as JSON or are not UTF-8 go to ``rejected``
    with their text and file name. A missing or empty folder gives no rows.
    """
    schema = DOCUMENTS[collection] if isinstance(collection, str) else collection
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    try:
        texts = spark.read.text(path, wholetext=one_per_file, pathGlobFilter="*.json")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return _nothing(spark, schema)
    named = texts.select("value", F.col("_metadata.file_name").alias("_source_file"))
    parsed = parse_json(named, wide)
    readable = F.col(CORRUPT).isNull() & F.is_valid_utf8("value")
    columns = [f"`{name}`" for name in schema.fieldNames()]
    loaded_at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("_loaded_at")
    good = parsed.filter(readable).select(*columns, loaded_at, "_source_file")
    bad = parsed.filter(~readable).select("_source_file", F.make_valid_utf8("value").alias("document"))
    return Documents(good, bad)


def _nothing(spark: SparkSession, schema: T.StructType) -> Documents:
    text = T.StringType()
    good = T.StructType([*schema.fields]).add("_loaded_at", text).add("_source_file", text)
    bad = T.StructType().add("_source_file", text).add("document", text)
    return Documents(spark.createDataFrame([], good), spark.createDataFrame([], bad))


def load_all(
    spark: SparkSession,
    folders: Mapping[str, str],
    target: str,
    *,
    full_refresh: bool = True,
    one_per_file: bool = True,
) -> dict[str, str]:
    """Load the document folders into parquet collections under ``target``; a full refresh replaces them."""
    mode = "overwrite" if full_refresh else "append"
    paths = {}
    for collection, folder in folders.items():
        documents = read_documents(spark, folder, collection, one_per_file=one_per_file)
        paths[collection] = f"{target}/{collection}"
        documents.good.write.mode(mode).parquet(paths[collection])
        documents.rejected.write.mode(mode).parquet(f"{target}/_rejected/{collection}")
    return paths
