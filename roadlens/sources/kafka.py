"""Stream sources and message codecs: S1-S4, S6, S7.

The Kafka connector jar is optional: the same functions accept a file source
with the Kafka column layout (key, value, topic, partition, offset, timestamp).
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadlens.schemas import (
    ALERTS_TOPIC,
    STREAM_ENVELOPE,
    TOPIC_SCHEMAS,
    TOPICS,
)

# Source option defaults (earliest offsets, no failure on data
# loss, 10,000 offsets per trigger).
KAFKA_DEFAULTS = {
    "startingOffsets": "earliest",
    "failOnDataLoss": "false",
    "maxOffsetsPerTrigger": "10000",
}

JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "ignoreNullFields": "false",
}

KAFKA_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]


def read_stream(
    spark: SparkSession,
    topics: str | Iterable[str],
    *,
    source: str = "kafka",
    servers: str | None = None,
    path: str | None = None,
    options: dict | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming read of one or more topics.

    ``source="kafka"`` subscribes with the given bootstrap servers.
    ``source="files"`` reads Parquet files laid out like Kafka records from
    ``path`` and keeps the requested topics (filter pushed to the scan).
    """
    topic_list = [topics] if isinstance(topics, str) else list(topics)
    if source == "kafka":
        opts = {**KAFKA_DEFAULTS, **(options or {})}
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(topic_list))
        )
        for k, v in opts.items():
            if v is not None:  # None takes a default away: no cap per trigger, loss fails
                reader = reader.option(k, v)
        return reader.load().select(*KAFKA_COLUMNS)
    if source == "files":
        reader = spark.readStream.schema(STREAM_ENVELOPE)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        df = reader.parquet(path)
        return df.filter(F.col("topic").isin(topic_list)).select(*KAFKA_COLUMNS)
    raise ValueError(f"unknown source {source!r}")


def read_batch(
    spark: SparkSession,
    topics: str | Iterable[str],
    *,
    source: str = "files",
    servers: str | None = None,
    path: str | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Batch counterpart of :func:`read_stream` (bounded offsets or files)."""
    topic_list = [topics] if isinstance(topics, str) else list(topics)
    if source == "kafka":
        reader = (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(topic_list))
            .option("startingOffsets", "earliest")
            .option("endingOffsets", "latest")
        )
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        return reader.load().select(*KAFKA_COLUMNS)
    df = spark.read.schema(STREAM_ENVELOPE).parquet(path)
    return df.filter(F.col("topic").isin(topic_list)).select(*KAFKA_COLUMNS)


def telemetry_topics() -> list[str]:
    """Every sensor topic (alerts and processed are not consumed)."""
    return [t for t in TOPICS.values() if t != ALERTS_TOPIC]


def parse_messages(df: DataFrame, schema: StructType, columns: Iterable[str] | None = None) -> DataFrame:
    """S3: decode JSON values against ``schema``, or only its ``columns`` (and
    vehicle_id): the others are skipped over, not decoded.

    Keeps topic/partition/offset, flattens the payload and drops rows whose
    vehicle_id is null (malformed JSON decodes to all nulls).
    """
    if columns is not None:
        schema = StructType([f for f in schema.fields if f.name in {"vehicle_id", *columns}])
    data = F.from_json(F.col("value").cast("string"), schema, JSON_OPTIONS)
    # ``inline`` of a one-element array flattens the decoded struct through a
    # Generate. Filters on the decoded fields (this one and every sanity
    # filter downstream) cannot be pushed below a Generate, so each message
    # is decoded once; a plain projection would let the optimizer substitute
    # the decoder into every predicate and decode the value once per predicate.
    return (
        df.select("topic", "partition", "offset", F.inline(F.array(data)))
        .filter(F.col("vehicle_id").isNotNull())
    )


def parse_topic(df: DataFrame, topic: str) -> DataFrame:
    """Route a multi-topic frame to one topic and decode with its schema."""
    if topic not in TOPIC_SCHEMAS:
        raise ValueError(f"no schema for topic {topic!r}")
    return parse_messages(df.filter(F.col("topic") == topic), TOPIC_SCHEMAS[topic])


def route_by_topic(df: DataFrame) -> dict[str, DataFrame]:
    """One decoded frame per known topic. Unknown topics are not routed."""
    return {topic: parse_topic(df, topic) for topic in TOPIC_SCHEMAS}


def decode_stats(df: DataFrame) -> DataFrame:
    """Received and parse-error counts per topic.

    A message is a parse error when its value is not a JSON object with a
    vehicle_id (the same rule as :func:`parse_messages`).
    """
    vid = F.get_json_object(F.col("value").cast("string"), "$.vehicle_id")
    return df.groupBy("topic").agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(vid.isNull()).alias("parse_errors"),
        F.count_if(vid.isNotNull()).alias("decoded"),
    )


def quarantine(df: DataFrame) -> DataFrame:
    """The messages that no decoder takes, whole, with the reason: a
    topic without a schema, or a value that is not a JSON object with a
    vehicle_id. The same on batches and streams."""
    value = F.col("value").cast("string")
    reason = F.when(~F.col("topic").isin(list(TOPIC_SCHEMAS)), "unknown topic").when(
        F.get_json_object(value, "$.vehicle_id").isNull(), "malformed")
    return df.select("topic", "offset", F.col("key").cast("string").alias("key"), value.alias("value"),
                     reason.alias("reason")).filter("reason IS NOT NULL")


def to_messages(df: DataFrame, topic: str | Column | None = None) -> DataFrame:
    """Key (vehicle_id bytes) + JSON value + topic for a frame of readings.

    Without ``topic`` the topic is looked up from ``sensor_type``.
    """
    payload = [c for c in df.columns if c not in ("topic", "partition", "offset")]
    if topic is None:
        mapping = F.create_map(*[x for kv in TOPICS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
        topic_col = mapping[F.col("sensor_type")]
    elif isinstance(topic, str):
        topic_col = F.lit(topic)
    else:
        topic_col = topic
    return df.select(
        topic_col.alias("topic"),
        F.col("vehicle_id").cast("binary").alias("key"),
        F.to_json(F.struct(*payload), JSON_OPTIONS).cast("binary").alias("value"),
    )


def publish(df: DataFrame, *, servers: str | None = None, path: str | None = None) -> None:
    """Batch publish to Kafka, or append to a Kafka-shaped file folder."""
    if servers:
        df.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    else:
        df.write.mode("append").parquet(path)
