"""Topics: streams of (topic, value), where value is a JSON document."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.pii import SENSITIVE_TOPICS, mask_pii, stamp
from basketry.functions.variant import MOST_DEPTH, mask_variant, parse_variant, stamped_variant

MESSAGE = "topic string, value string"
#: messages in a file of a topic folder; a batch of a stream takes some files, so this bounds what a batch holds
FILE_MESSAGES = 100_000


def publish(
    documents: DataFrame,
    topic: str,
    load_ts: Column | None = None,
    sensitive: Sequence[str] = SENSITIVE_TOPICS,
) -> DataFrame:
    """Documents as messages: stamped, masked if the topic is sensitive, written as JSON in plain UTF-8."""
    stamped = stamp(documents, load_ts)
    if topic in sensitive:
        stamped = mask_pii(stamped)
    return stamped.select(F.lit(topic).alias("topic"), F.to_json(F.struct("*")).alias("value"))


def publish_texts(
    texts: DataFrame,
    topic: str,
    load_ts: Column | None = None,
    sensitive: Sequence[str] = SENSITIVE_TOPICS,
    depth: int = MOST_DEPTH,
) -> DataFrame:
    """Documents that are JSON text (column ``value``) as messages, with every field they have, known or not.

    What ``publish`` does to documents of a schema, at any depth up to ``depth``. A text that is no JSON object, or is
    nested deeper, becomes a message without a value that ``unpublished`` finds; nothing of it is sent unmasked. What is
``readable`` is told by the document as it was read, so a filter masks nothing.
    """
    sent = F.current_timestamp() if load_ts is None else load_ts
    # through inline, so that a filter on what was read reads no text a second time
    read = F.struct(stamped_variant(parse_variant(F.col("value"), depth), sent).alias("_document"))
    documents = texts.select(F.col("value").alias("_text"), F.inline(F.array(read)))
    document = F.col("_document")
    masked = mask_variant(document, depth=depth) if topic in sensitive else document
    return documents.select(
        F.lit(topic).alias("topic"),
        F.to_json(masked).alias("value"),
        F.when(document.isNull(), F.col("_text")).alias("unreadable"),
        document.isNotNull().alias("readable"),
    )


def published(messages: DataFrame) -> DataFrame:
    """The messages of ``publish_texts`` that can be sent."""
    return messages.filter("readable").select("topic", "value")


def unpublished(messages: DataFrame) -> DataFrame:
    """The texts that ``publish_texts`` could make no message of, as the reject table of a topic keeps them."""
    bad = messages.filter("NOT readable")
    return bad.select("topic", F.col("unreadable").alias("value"), F.lit("no JSON object, or too deep").alias("reason"))


def write_topic_folder(messages: DataFrame, path: str, mode: str = "append", file_messages: int = FILE_MESSAGES) -> None:
    """Append messages to a topic kept as JSON files.

    Messages repeat their field names, so files are compressed to about a twentieth. Those cannot be split; a file ends
    after ``file_messages``.
    """
    writer = messages.select("topic", "value").write.mode(mode).option("maxRecordsPerFile", file_messages)
    writer.json(path, compression="gzip")


def write_kafka(messages: DataFrame, options: Mapping[str, str]) -> None:
    """Send messages to a broker. Needs the Kafka connector on the class path."""
    messages.select("topic", "value").write.format("kafka").options(**options).save()


def subscribe_folder(spark: SparkSession, path: str, *, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(MESSAGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def subscribe_kafka(spark: SparkSession, servers: str, topics: Sequence[str], **options: str) -> DataFrame:
    """Messages of the topics from the earliest on; the query's checkpoint holds the position after that."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
    )
    return reader.options(**options).load().select("topic", F.col("value").cast("string").alias("value"))
