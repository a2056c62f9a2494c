"""A store of stream progress.

``ProgressLog`` listens to a session's streaming queries and appends, for every
micro-batch, one row per source and partition: where the batch began and ended,
the newest offset the source knew, and the batch's rows, state rows and late
drops. The rows are a handful a micro-batch; ``lag`` and ``totals`` are Spark
aggregates over what is stored.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = ("query_id string, run_id string, query string, batch_id long, at timestamp, source_id int, source string, "
          "topic string, partition string, start_offset long, end_offset long, latest_offset long, "
          "input_rows long, state_rows long, dropped_by_watermark long, first boolean")


def offsets(given) -> dict[tuple[str | None, str], int]:
    """A source's offsets by (topic, partition): ``{topic: {partition: n}}``, or
    the single number of another source under its own name."""
    given = json.loads(given) if isinstance(given, str) and given[:1] == "{" else given
    if not isinstance(given, dict):
        return {} if given is None else {(None, "offset"): int(given)}
    out = {}
    for name, value in given.items():
        if isinstance(value, dict):
            out.update({(name, part): int(n) for part, n in value.items()})
        elif value is not None:
            out[(None, name)] = int(value)
    return out


def progress_rows(progress: dict) -> list[tuple]:
    """The rows of one progress report. Rows read are known by source, state by
    query: ``first`` marks the row of a source, and of a query, that carries them."""
    ops = progress.get("stateOperators") or []
    state = sum(int(op.get("numRowsTotal", 0)) for op in ops)
    late = sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in ops)
    rows = []
    for i, src in enumerate(progress.get("sources") or []):
        start, end, latest = (offsets(src.get(k)) for k in ("startOffset", "endOffset", "latestOffset"))
        places = sorted(start.keys() | end.keys() | latest.keys(), key=str) or [(None, "offset")]
        for j, at in enumerate(places):
            rows.append((
                str(progress["id"]), str(progress["runId"]), progress.get("name"), int(progress["batchId"]),
                progress["timestamp"], i, src.get("description"), *at, start.get(at), end.get(at), latest.get(at),
                int(src.get("numInputRows", 0)) if j == 0 else 0,
                state if i == j == 0 else 0, late if i == j == 0 else 0, j == 0,
            ))
    return rows


class ProgressLog(StreamingQueryListener):
    """Appends every report to the Parquet folder ``path``. ``with`` registers it
    and, at the end, takes it off again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def __enter__(self):
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_):
        self.spark.streams.removeListener(self)

    def _end(self, run_id) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        rows = progress_rows(json.loads(event.progress.json))
        if rows:
            text = SCHEMA.replace("at timestamp", "at string")
            stored = self.spark.createDataFrame(rows, text).withColumn("at", F.to_timestamp("at"))
            stored.coalesce(1).write.mode("append").parquet(self.path)

    def onQueryTerminated(self, event):
        self._end(event.runId).set()

    def wait(self, query, timeout: float = 60) -> None:
        """Until the reports of a query that has ended are stored."""
        if not self._end(query.runId).wait(timeout):
            raise TimeoutError(f"no end of {query.runId} was reported")

    def rows(self) -> DataFrame:
        """The stored reports; a batch that was run again counts once."""
        newest = Window.partitionBy("query_id", "batch_id", "source_id", "topic", "partition").orderBy(F.desc("at"), "run_id")
        stored = self.spark.read.schema(SCHEMA).parquet(self.path)
        # Partitioned by batch: a handful of rows each.
        return stored.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def totals(progress: DataFrame) -> DataFrame:
    """Per query: micro-batches, rows read and rows that came too late."""
    return progress.groupBy("query").agg(
        F.count_distinct("batch_id").alias("batches"), F.sum("input_rows").alias("input_rows"),
        F.sum("dropped_by_watermark").alias("dropped_by_watermark"), F.max("state_rows").alias("most_state_rows"))


def lag(progress: DataFrame) -> DataFrame:
    """G20, live: per query, source and partition the last offset read and how
    far behind the source's newest it is (null where the source names none)."""
    newest = F.max_by(F.struct("end_offset", "latest_offset"), "batch_id").alias("p")
    return progress.groupBy("query", "source", "topic", "partition").agg(newest).select(
        "query", "source", "topic", "partition", F.col("p.end_offset").alias("end_offset"),
        (F.col("p.latest_offset") - F.col("p.end_offset")).alias("lag"))
