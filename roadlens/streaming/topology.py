"""One decode, many sinks.

``Landing`` runs one streaming query. Every micro-batch is read and decoded
once and lands in stored tables (``sources.store``): the enriched readings, the
readings that break a declared constraint, the messages that no decoder takes,
the flagged anomalies, the alert candidates and the counters of the batch.

Each append is named by the landing and the batch, so a batch that is run again
after a failure stores nothing twice, wherever the failure fell; events that
come again in a later batch are known by their key. A new checkpoint starts its
batches from 0 and needs a landing of another ``name``.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions.time import time_parts
from roadlens.operators import alerts as A
from roadlens.operators.enrich import enrich, enrich_gps, snapshot
from roadlens.operators.validate import deduplicate, filter_invalid, with_violations
from roadlens.schemas import SENSOR_SCHEMAS, SENSOR_TYPES, TOPICS
from roadlens.sources.kafka import parse_messages, quarantine
from roadlens.sources.store import BUCKETS, StoredTable
from roadlens.streaming.jobs import DEFAULT_TRIGGER

READINGS = ("gps", "imu", "can_bus")
#: sink -> (key, time column)
SINKS = {
    **{s: (("event_id",), "timestamp") for s in READINGS},
    "violations": (("event_id", "sensor_type"), "timestamp"),
    "quarantine": (("topic", "partition", "offset"), "timestamp"),
    "anomalies": (("event_id",), "timestamp"),
    "candidates": (("rule", "event_id"), "ts"),
    "counters": (("batch_id", "topic"), "newest"),
}


@dataclass(frozen=True)
class Landing:
    """``scorer`` adds ``anomaly_score`` and ``is_anomaly`` to can_bus readings
    (M13); without it there are no anomalies. ``rules``: the alert rules."""

    root: str
    name: str = "landing"
    scorer: Callable[[DataFrame], DataFrame] | None = None
    rules: list | None = None
    buckets: int = BUCKETS

    def sink(self, name: str) -> StoredTable:
        key, time_col = SINKS[name]
        return StoredTable(f"{self.root}/{name}", key=key, time_cols=(time_col,), buckets=self.buckets)

    def rows(self, spark: SparkSession, name: str) -> DataFrame:
        return self.sink(name).rows(spark)

    def process(self, messages: DataFrame, batch_id: int) -> dict[str, int]:
        """Lands one micro-batch and returns the new rows of each sink."""
        held = [messages.persist()]
        try:
            decoded = {}
            for sensor in SENSOR_TYPES:
                topic = messages.filter(F.col("topic") == TOPICS[sensor])
                decoded[sensor] = parse_messages(topic, SENSOR_SCHEMAS[sensor]).persist()
                held.append(decoded[sensor])
            frames = {
                "violations": reduce(DataFrame.unionByName, [violations(df, s) for s, df in decoded.items()]),
                "quarantine": unread(messages),
                "counters": counters(messages, batch_id),
            }
            readings = {s: processed(decoded[s], s) for s in READINGS}
            frames.update(readings)
            if self.scorer is not None:
                readings["can_bus"] = self.scorer(readings["can_bus"])
                frames["anomalies"] = readings["can_bus"].filter("is_anomaly")
            frames["candidates"] = A.candidates(snapshot(*readings.values()), self.rules)
            # The sinks don't wait for each other's small jobs.
            with ThreadPoolExecutor(len(frames)) as pool:
                appends = {s: pool.submit(self.sink(s).append, df, f"{self.name}-{batch_id}") for s, df in frames.items()}
            return {s: done.result() for s, done in appends.items()}
        finally:
            for df in reversed(held):
                df.unpersist()

    def start(self, raw: DataFrame, checkpoint: str, trigger: dict | None = None):
        """The streaming query over Kafka-shaped messages."""
        return (raw.writeStream.queryName(self.name).option("checkpointLocation", checkpoint)
                .foreachBatch(lambda batch, batch_id: self.process(batch, batch_id) and None)
                .trigger(**(trigger or DEFAULT_TRIGGER)).start())


def processed(decoded: DataFrame, sensor: str) -> DataFrame:
    """The readings that pass T1-T4, one per event, enriched, with time parts."""
    df = deduplicate(filter_invalid(decoded, sensor))
    df = enrich_gps(df, as_of=F.col("ingested_at")) if sensor == "gps" else enrich(df, sensor)
    return time_parts(df)


def violations(decoded: DataFrame, sensor: str) -> DataFrame:
    """The events that break a declared constraint, with the names of these."""
    broken = with_violations(decoded, sensor).filter(F.size("violations") > 0)
    return deduplicate(broken).select("event_id", F.lit(sensor).alias("sensor_type"), "vehicle_id", "timestamp", "violations")


def unread(messages: DataFrame) -> DataFrame:
    """The messages that no decoder takes, with their place and time."""
    place = F.struct("partition", "offset", "timestamp")
    return quarantine(messages.withColumn("offset", place)).select("topic", "offset.*", "key", "value", "reason")


def counters(messages: DataFrame, batch_id: int) -> DataFrame:
    """Per topic of one batch the messages received, decoded and not
    decoded, and the newest message's time."""
    vehicle = F.get_json_object(F.col("value").cast("string"), "$.vehicle_id")
    return messages.groupBy("topic").agg(
        F.count(F.lit(1)).alias("received"), F.count_if(vehicle.isNull()).alias("parse_errors"),
        F.count_if(vehicle.isNotNull()).alias("decoded"), F.max("timestamp").alias("newest"),
    ).withColumn("batch_id", F.lit(batch_id).cast("long"))
