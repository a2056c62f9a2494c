"""Stored tables with keys, a commit record and a zone map: S12, S13, S17, and
the anchors of T7.

A table is a folder of ordinary Parquet tables:

* ``rows``: the rows of every batch, in ``batch=/year=/month=/day=`` folders;
* ``keys``: the keys of the rows, in ``batch=/bucket=`` folders by key hash. An
  append reads only the buckets that its own keys fall into, or, where it looks
  before it writes, all keys;
* ``zones``: per batch, day and hour the row count and the least and greatest
  value of every time column. Zones of batches add up, so the catalog of the
  table is never computed from its rows;
* ``commits``: one row per batch, written last. Readers see committed batches
  only, so a broken append leaves the table as it was, and the same batch
  appended again replaces what the broken one left, or does nothing if it had
  been committed.

Commits are metadata, one narrow row per append until the next ``compact``.
Two writers may append at once: before it commits, an append looks again and
leaves out the keys that others have committed meanwhile. Only commits within
the time of that last look can pass each other; writers that must exclude this
too need a lock of their own.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = ("year", "month", "day")
#: Key folders per batch; a table of billions of keys wants more.
BUCKETS = 64
COMMIT_SCHEMA = "batch string, rows long, replaces array<string>, drop_before date"


def day_key() -> Column:
    """yyyymmdd of the day folders."""
    return F.col("year") * 10000 + F.col("month") * 100 + F.col("day")


@dataclass(frozen=True)
class Timed:
    """Rows with the zone map of the table that holds them."""

    rows: DataFrame
    zones: DataFrame


@dataclass(frozen=True)
class StoredTable:
    """``key``: columns whose values occur once (none: rows aren't compared).
    ``time_cols``: the first one gives the day folders; rows without it lie in
    the null day. All of them are in the zone map."""

    path: str
    key: tuple[str, ...] = ()
    time_cols: tuple[str, ...] = ("timestamp",)
    buckets: int = BUCKETS

    # -- commits ---------------------------------------------------------

    def _stored(self, spark: SparkSession, part: str, schema=None) -> DataFrame | None:
        reader = spark.read.schema(schema) if schema else spark.read
        try:
            return reader.parquet(f"{self.path}/{part}")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def commits(self, spark: SparkSession) -> DataFrame:
        found = self._stored(spark, "commits", COMMIT_SCHEMA)
        return spark.createDataFrame([], COMMIT_SCHEMA) if found is None else found

    def _state(self, spark: SparkSession) -> tuple[dict[str, int], set[str], object]:
        """Visible batches with their rows, all committed names, and the day
        before which rows have expired."""
        records = self.commits(spark).collect()
        gone = {b for r in records for b in r.replaces}
        expired = max((r.drop_before for r in records if r.drop_before), default=None)
        live = {r.batch: r.rows for r in records if r.rows is not None and r.batch not in gone}
        return live, {r.batch for r in records} | gone, expired

    def _commit(self, spark: SparkSession, batch: str, rows: int | None, replaces=(), drop_before=None) -> None:
        record = spark.createDataFrame([(batch, rows, list(replaces), drop_before)], COMMIT_SCHEMA)
        record.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def _visible(self, spark: SparkSession, part: str, batches=None, state=None) -> DataFrame | None:
        """Rows of a part in the committed batches (folders are pruned)."""
        live, _, expired = state or self._state(spark)
        live = [b for b, n in live.items() if n and (batches is None or b in batches)]
        found = self._stored(spark, part) if live else None
        if found is None:
            return None
        out = found.filter(F.col("batch").isin(live)).drop("batch")
        if expired and "day" in out.columns:
            out = out.filter(day_key().isNull() | (day_key() >= expired.year * 10000 + expired.month * 100 + expired.day))
        return out

    # -- reading ---------------------------------------------------------

    def rows(self, spark: SparkSession, state=None) -> DataFrame:
        out = self._visible(spark, "rows", state=state)
        if out is None:
            raise ValueError(f"nothing is committed in {self.path}")
        return out

    def zones(self, spark: SparkSession, state=None) -> DataFrame:
        """The catalog: per day and hour the rows and the span of each time
        column, added up over the batches' own zones."""
        out = self._visible(spark, "zones", state=state)
        if out is None:
            raise ValueError(f"nothing is committed in {self.path}")
        spans = [f(f"{side}_{c}").alias(f"{side}_{c}") for c in self.time_cols for side, f in (("first", F.min), ("last", F.max))]
        return out.groupBy(*DAY, "hour").agg(F.sum("rows").alias("rows"), *spans)

    def timed(self, spark: SparkSession) -> Timed:
        """Rows and zone map of one state of the table."""
        state = self._state(spark)
        return Timed(self.rows(spark, state), self.zones(spark, state))

    # -- writing ---------------------------------------------------------

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _held(self, spark: SparkSession, batch: str, batches) -> DataFrame | None:
        """The keys that the given batches hold in the key folders that those
        of ``batch`` fall into. The driver gets at most ``buckets`` numbers."""
        if not self._count(spark, batch):
            return None
        held = self._visible(spark, "keys", batches)
        if held is None:
            return None
        buckets = [r.bucket for r in self._batch(spark, "keys", batch).select("bucket").distinct().collect()]
        return held.filter(F.col("bucket").isin(buckets)).select(*self.key)

    def _once(self, df: DataFrame) -> DataFrame:
        """One row per key: the least by time, then by the whole row."""
        others = [c for c in df.columns if c not in self.key]
        lead = [c for c in self.time_cols if c in others]
        order = F.struct(*[F.col(c) for c in [*lead, *[c for c in others if c not in lead]]])
        return df.groupBy(*self.key).agg(F.min(order).alias("_r")).select(
            *[F.col(c) if c in self.key else F.col(f"_r.{c}").alias(c) for c in df.columns])

    def append(self, df: DataFrame, batch: str | None = None,
               before_commit: Callable[[], None] | None = None, look_first: bool = False) -> int:
        """Stores ``df`` and returns the rows that are new. ``batch`` names the
        append: one that was committed under this name is not stored again.

        The rows are written first, out of sight, and their keys are compared
        with the batches committed so far, then with those committed meanwhile.
        Only where a key is taken are the other rows written once more.

        With ``look_first`` the keys committed so far are compared before, while
        the rows still lie by key: taken ones are neither dealt out by day nor
        written. That reads the keys of the whole table, which a small append of
        new keys need not do. Keys committed meanwhile are compared as above."""
        spark = df.sparkSession
        batch = self._name(batch)
        spark.createDataFrame([], COMMIT_SCHEMA).write.mode("ignore").parquet(f"{self.path}/commits")
        state = self._state(spark)
        if batch in state[1]:
            return 0
        rows = self._once(df) if self.key else df
        known, left = set(), []
        if look_first and self.key:
            known, taken = set(state[0]), self._visible(spark, "keys", state=state)
            if taken is not None:
                rows = rows.join(taken.select(*self.key), list(self.key), "left_anti")
        self._write(rows, batch)
        while self.key and (later := set(self._state(spark)[0]) - known):
            known |= later
            held = self._held(spark, batch, later)
            if held is None or self._batch(spark, "keys", batch).join(held, list(self.key), "left_semi").isEmpty():
                continue
            left.append(batch)
            free = self._batch(spark, "rows", batch).drop("batch").join(held, list(self.key), "left_anti")
            batch = f"{left[0]}-{len(left)}"
            self._write(free, batch)
        if before_commit:
            before_commit()
        n = self._count(spark, batch)
        self._commit(spark, batch, n, left)
        return n

    @staticmethod
    def _name(batch: str | None) -> str:
        name = f"b-{uuid.uuid4().hex[:12]}" if batch is None else f"b-{batch}"
        if not re.fullmatch("[A-Za-z0-9_-]+", name):
            raise ValueError(f"not a batch name: {batch!r}")
        return name

    def _batch(self, spark: SparkSession, part: str, batch: str) -> DataFrame:
        return spark.read.option("basePath", f"{self.path}/{part}").parquet(f"{self.path}/{part}/batch={batch}")

    def _count(self, spark: SparkSession, batch: str) -> int:
        return self._batch(spark, "zones", batch).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def _write(self, df: DataFrame, batch: str) -> None:
        """Rows, then keys and zones from the columns of the written rows."""
        from roadlens.sources.landing import write_partitioned

        spark, first = df.sparkSession, F.col(self.time_cols[0])
        parts = {"year": F.year(first), "month": F.month(first), "day": F.dayofmonth(first)}
        target = f"{self.path}/rows/batch={batch}"
        write_partitioned(df.withColumns(parts), target, DAY, mode="overwrite")
        # An empty batch leaves no day folder: its schema is then the frame's.
        schema = df.withColumns(parts).schema
        rows = spark.read.schema(schema).parquet(target)
        spans = [f(c).alias(f"{side}_{c}") for c in self.time_cols for side, f in (("first", F.min), ("last", F.max))]
        (rows.groupBy(*DAY, F.hour(self.time_cols[0]).alias("hour")).agg(F.count(F.lit(1)).alias("rows"), *spans)
         .coalesce(1).write.mode("overwrite").parquet(f"{self.path}/zones/batch={batch}"))
        if self.key:
            # Buckets are few: where a batch is large, several tasks write one.
            (rows.select(*self.key, self._bucket().alias("bucket")).hint("rebalance", "bucket")
             .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/keys/batch={batch}"))

    # -- upkeep ----------------------------------------------------------

    def compact(self, spark: SparkSession) -> int:
        """The rows of all batches so far in few files, as one batch.
        A single commit record swaps it for them: a reader sees either. Returns
        the rows. The replaced folders stay for readers that run meanwhile;
        ``replaced`` names them."""
        live, _, _ = self._state(spark)
        if len(live) < 2:
            return sum(live.values())
        batch = self._name(None)
        self._write(self._visible(spark, "rows", set(live)), batch)
        n = self._count(spark, batch)
        self._commit(spark, batch, n, sorted(live))
        return n

    def replaced(self, spark: SparkSession) -> list[str]:
        """Folders that no reader of the table's present state needs."""
        gone = sorted({b for r in self.commits(spark).collect() for b in r.replaces})
        return [f"{self.path}/{part}/batch={b}" for b in gone for part in ("rows", "keys", "zones")]

    def expire(self, spark: SparkSession, before) -> None:
        """Hides whole days before the date ``before``, rows and zones alike.
        Keys of expired rows stay taken."""
        self._commit(spark, self._name(None), None, (), before)
