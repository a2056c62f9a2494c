"""Parquet landing, tables and catalog: S10-S17.

The single-process batching writer of the ingest path becomes one partitioned
DataFrame write; the embedded-database table functions become Parquet-backed
tables and views in the Spark catalog.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from roadlens.schemas import TableDef
from roadlens.session import whole_plans
from roadlens.sources.store import StoredTable

LANDING_KEYS = ("sensor_type", "year", "month", "day", "vehicle_id")
# Rows per file and row group of the landing zone.
MAX_RECORDS_PER_FILE = 100_000


def landing_columns(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """S10 partition values: zero-padded year/month/day strings."""
    return df.withColumns(
        {
            "year": F.date_format(ts_col, "yyyy"),
            "month": F.date_format(ts_col, "MM"),
            "day": F.date_format(ts_col, "dd"),
        }
    )


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    *,
    mode: str = "append",
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> None:
    """Partitioned Parquet write with few files per partition.

    The ``rebalance`` hint clusters rows by the partition keys so each folder
    gets few files, and lets adaptive execution split a hot partition (one
    vehicle with a third of the rows) over several tasks instead of one.
    """
    (
        df.hint("rebalance", *keys)
        .write.mode(mode)
        .partitionBy(*keys)
        .option("maxRecordsPerFile", max_records_per_file)
        .option("compression", "snappy")
        .parquet(path)
    )


def write_landing(readings: DataFrame, path: str, **kw) -> None:
    """Raw landing layout sensor/year/month/day/vehicle."""
    write_partitioned(landing_columns(readings), path, LANDING_KEYS, **kw)


def landing_report(spark: SparkSession, path: str, payload: StructType | None = None) -> DataFrame:
    """S10 report: rows per landing partition, read back from the files.

    Partition values are read as strings (zero padding kept) by declaring
    them in the read schema.
    """
    payload = payload or StructType([StructField("event_id", StringType())])
    schema = StructType(list(payload.fields) + [StructField(k, StringType()) for k in LANDING_KEYS])
    df = spark.read.schema(schema).parquet(path)
    return df.groupBy(*LANDING_KEYS).agg(F.count(F.lit(1)).alias("rows"))


def align(df: DataFrame, table: TableDef) -> DataFrame:
    """Align a frame to a table schema by name: extra columns dropped,
    missing ones null, types cast to the declared ones; ``default now``
    columns are filled with the current time."""
    cols = []
    present = set(df.columns)
    for f in table.schema.fields:
        if f.name in present:
            c = F.col(f.name).cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        if f.name in table.default_now:
            c = F.coalesce(c, F.current_timestamp())
        cols.append(c.alias(f.name))
    return df.select(*cols)


def enforce_not_null(df: DataFrame, table: TableDef) -> tuple[DataFrame, DataFrame]:
    """S12 NOT NULL: (accepted rows, rejected rows)."""
    ok = F.lit(True)
    for c in table.not_null:
        ok = ok & F.col(c).isNotNull()
    return df.filter(ok), df.filter(~ok)


def load_table(spark: SparkSession, path: str, table: TableDef) -> DataFrame:
    """Read a Hive-partitioned Parquet folder (partition discovery) and
    align it to ``table`` by name."""
    return align(spark.read.parquet(path), table)


def serving_store(table: TableDef, path: str) -> StoredTable:
    """The folder of a serving table: its key, and its time columns."""
    times = [f.name for f in table.schema.fields if f.dataType.typeName() == "timestamp"]
    lead = [c for c in ("timestamp", "window_start") if c in times][:1]
    return StoredTable(path.rstrip("/"), table.key, tuple(lead + [c for c in times if c not in lead]))


def _rejects(table: TableDef, path: str) -> StoredTable:
    return replace(serving_store(table, f"{path.rstrip('/')}_rejects"), key=())


def table_rows(spark: SparkSession, table: TableDef, path: str) -> DataFrame:
    """The committed rows of a serving table, in its columns."""
    return align(serving_store(table, path).rows(spark), table)


def rejected_rows(spark: SparkSession, table: TableDef, path: str) -> DataFrame:
    """The rows that appends turned away."""
    return align(_rejects(table, path).rows(spark), table)


def append(df: DataFrame, table: TableDef, path: str, batch: str | None = None, look_first: bool = True) -> int:
    """Append a frame to a serving table, aligned by name. Returns the
    rows that became visible; ``batch`` names the append, so that a repeated
    one stores nothing twice.

    Rows that break a NOT NULL rule are kept beside the table (see
    ``rejected_rows``), written only where there are any. A key is kept once
    (S12): within the batch the row of least (time, whole row), and no row whose
    key is already stored, under whatever time.

    A load may bring many rows that are stored already: it looks for them before
    it writes. A few rows for a very large table are cheaper without ``look_first``."""
    batch = batch or uuid.uuid4().hex[:12]
    aligned = align(df, table)
    broken = enforce_not_null(aligned, table)[1]
    counted = Observation("append")
    absent = F.lit(False)
    for c in table.not_null:
        absent = absent | F.col(c).isNull()
    seen = aligned.observe(counted, F.count_if(absent).alias("broken"))

    def keep_rejects() -> None:
        if counted.get["broken"]:
            _rejects(table, path).append(broken, batch)

    # Counted while the rows are written, also where none is left to write, and kept before they are committed.
    with whole_plans(df.sparkSession):
        return serving_store(table, path).append(enforce_not_null(seen, table)[0], batch, before_commit=keep_rejects,
                                                 look_first=look_first)


def register_views(spark: SparkSession, paths: dict[str, str]) -> None:
    """Expose table folders as temporary views for SQL."""
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(name)


def query(spark: SparkSession, sql: str, params: Iterable | dict | None = None) -> DataFrame:
    """Parameterised SQL; values are bound, never spliced into the text."""
    if params is None:
        return spark.sql(sql)
    if isinstance(params, dict):
        return spark.sql(sql, args=params)
    return spark.sql(sql, args=list(params))


def list_tables(spark: SparkSession) -> list[str]:
    """S15."""
    return [t.name for t in spark.catalog.listTables()]


def training_scan(spark: SparkSession, path: str, features: Sequence[str], fraction: float = 1.0,
                  seed: int = 42, key: str = "event_id") -> DataFrame:
    """Read only the available feature columns, drop rows with a null,
    and sample reproducibly by a hash of the row key (the same rows under any
    partitioning)."""
    df = spark.read.parquet(path)
    avail = [c for c in features if c in df.columns]
    cols = avail + ([key] if key in df.columns and key not in avail else [])
    out = df.select(*cols).dropna(subset=avail)
    if fraction < 1.0:
        digest = F.md5(F.concat_ws("|", F.lit(seed).cast("string"), F.col(key).cast("string")))
        out = out.filter(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") < int(fraction * 2**32))
    return out


def partition_catalog(readings: DataFrame) -> DataFrame:
    """One row per (sensor, day, vehicle, hour) partition with keys
    ``sensor#yyyy#mm#dd`` and ``vehicle#hh``, row count and time range."""
    keys = ["sensor_type", "year", "month", "day", "vehicle_id", "hour"]
    return readings.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
    ).withColumns(
        {
            "partition_key": F.concat_ws(
                "#", "sensor_type", F.col("year").cast("string"),
                F.lpad(F.col("month").cast("string"), 2, "0"),
                F.lpad(F.col("day").cast("string"), 2, "0"),
            ),
            "sort_key": F.concat_ws("#", "vehicle_id", F.lpad(F.col("hour").cast("string"), 2, "0")),
        }
    )
