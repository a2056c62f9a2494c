"""Operator 1: mix sources to target weights by Pfair scheduling.

Each source is cut into blocks of ``block_docs`` documents. Block k (from 0)
of a source with weight w is released at slot ``floor(k / w)`` and due by slot
``ceil((k + 1) / w)``; in each slot the released block with the earliest
deadline runs. The weights sum to one, so every block meets its window, and at
every slot each source is less than one block away from its target share.

Weights are whole numbers of ``1 / resolution`` (at least one), fine enough
that windows follow the target weights over all blocks of the data: after S
slots of n sources the distance they add is below ``S * (1 + n) / (2 *
resolution)`` blocks.

The schedule holds until the first source has no block left for a slot that
goes to it; from there no weights can be met, and the blocks left follow in the
order of their deadlines. A schedule is a sequence: each slot depends on those
before. It is made on the driver, which holds one number per source and
``CHUNK_SLOTS`` slots at a time (one number per block of documents, written to
the shared folder as it goes). What touches documents, and the order of the
blocks left, is DataFrame functions.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlens.llm.common import grouped_rank, kept_table, read, stable_hash
from roadlens.session import scratch_path

BLOCK_DOCS = 64
RESOLUTION = 10_000_000_000
ALPHA = 0.7
#: Blocks of a source unfolded at a time, and slots per row of the schedule.
CHUNK = 4096
#: Slots that the driver holds before it writes them.
CHUNK_SLOTS = 1 << 20
#: Blocks that one task puts in order.
BLOCKS_PER_PART = 500_000
#: Tables of blocks up to this many rows are sent to every executor.
BROADCAST_BLOCKS = 200_000
SEED = 7
#: Stands for a null source: no text, so no clash with a real name.
NULL_SOURCE = "\x00null"


def quotas(docs: DataFrame, source_col: str, weights: dict | None, resolution: int, alpha: float) -> DataFrame:
    """One row per source: ``source`` (null as ``NULL_SOURCE``), ``n`` and ``quota``."""
    counted = (docs.groupBy(F.coalesce(F.col(source_col).cast("string"), F.lit(NULL_SOURCE)).alias("source"))
               .agg(F.count(F.lit(1)).alias("n")))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(alpha))
    else:
        table = F.create_map(*[F.lit(x) for k, v in weights.items()
                               for x in (NULL_SOURCE if k is None else str(k), float(v))]) if weights else None
        weight = F.coalesce(table[F.col("source")] if weights else F.lit(None), F.lit(0.0))
    return (counted.withColumn("weight", weight)
            .withColumn("total", F.sum("weight").over(Window.partitionBy()))  # one row per source
            .withColumn("share", F.when(F.col("total") > 0, F.col("weight") / F.col("total")))
            .select("source", "n", F.greatest(F.lit(1), F.round(F.coalesce(F.col("share"), F.lit(0.0)) * resolution))
                    .cast("long").alias("quota")))


def earliest_deadline_first(quota: list[int], blocks: list[int], ran: list[int]) -> Iterator[int]:
    """For each slot the source that runs (its index in ``quota``), until one
    has no block left for its slot; ``ran`` counts the blocks. A heap of released
    blocks by (deadline, index) and one of those to come: logarithmic in the
    sources per slot."""
    period, slot = sum(quota), 0
    coming, released = [(0, i) for i in range(len(quota))], []
    while quota:
        while coming and coming[0][0] <= slot:
            i = heapq.heappop(coming)[1]
            heapq.heappush(released, (-(-(ran[i] + 1) * period // quota[i]), i))
        i = heapq.heappop(released)[1]
        if ran[i] == blocks[i]:
            return
        yield i
        ran[i] += 1
        slot += 1
        heapq.heappush(coming, (ran[i] * period // quota[i], i))


def scheduled(spark: SparkSession, quota: list[int], blocks: list[int], ran: list[int]) -> tuple[DataFrame, int]:
    """The written schedule, one row per slot (i, block, slot), and its length."""
    path = scratch_path(spark, "schedule")
    schema = "first long, i array<int>, block array<long>"
    spark.createDataFrame([], schema).write.parquet(path)
    rows, slot = [], 0
    picked, block = [], []

    def flush():
        spark.createDataFrame(rows, schema).write.mode("append").parquet(path)
        rows.clear()

    for i in earliest_deadline_first(quota, blocks, ran):
        picked.append(i)
        block.append(ran[i])
        slot += 1
        if len(picked) == CHUNK:
            rows.append((slot - CHUNK, picked, block))
            picked, block = [], []
            if len(rows) * CHUNK >= CHUNK_SLOTS:
                flush()
    if picked:
        rows.append((slot - len(picked), picked, block))
    if rows:
        flush()
    stored = spark.read.schema(schema).parquet(path)
    return (stored.select("first", F.posexplode(F.arrays_zip("i", "block")).alias("at", "x"))
            .select("x.i", "x.block", (F.col("first") + F.col("at")).alias("slot"))), slot


def blocks_of(spark: SparkSession, quota: DataFrame, block_docs: int) -> DataFrame:
    """One row per block of a source: source, block, slot, ``start`` (the
    documents before it in the mix) and balanced."""
    sources = sorted(((r.source, r.n, r.quota) for r in quota.collect()), key=lambda r: r[0].encode())
    quotas_, counts = [q for _, _, q in sources], [-(-n // block_docs) for _, n, _ in sources]
    ran = [0] * len(sources)
    by_plan, dry = scheduled(spark, quotas_, counts, ran)
    table = kept_table(spark.createDataFrame(
        [(i, s, n, q, b, r) for i, ((s, n, q), b, r) in enumerate(zip(sources, counts, ran))],
        "i int, source string, n long, quota long, blocks long, ran long"), "sources")
    # The blocks left, in chunks: no task unfolds a whole source. Before them the
    # schedule's, whose slot stands for the deadline.
    left = (table.filter("ran < blocks").withColumn("chunk", F.explode(F.expr(f"sequence(ran, blocks - 1, {CHUNK}L)")))
            .repartition("source", "chunk")
            .withColumn("block", F.explode(F.expr(f"sequence(chunk, least(blocks - 1, chunk + {CHUNK - 1}L))")))
            .select("i", "block", F.lit(True).alias("late"),
                    F.expr(f"((block + 1) * {sum(quotas_)}L + quota - 1) DIV quota").alias("due")))
    order = ["late", "due", "i"]
    parts = max(1, -(-sum(counts) // BLOCKS_PER_PART))
    dealt = (by_plan.select("i", "block", F.lit(False).alias("late"), F.col("slot").alias("due")).unionByName(left)
             .join(table.select("i", "source", "n"), "i")
             .withColumn("docs", F.expr(f"least({block_docs}L, n - block * {block_docs})"))
             .repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    # Written, so that a part's number is not dealt again.
    dealt = kept_table(dealt, "dealt")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)

    def ahead(col: str, window) -> Column:
        return F.coalesce(F.sum(col).over(window), F.lit(0).cast("long"))

    firsts = (dealt.groupBy("part").agg(F.count(F.lit(1)).alias("c"), F.sum("docs").alias("d"))
              .select("part", ahead("c", before.orderBy("part")).alias("slots"), ahead("d", before.orderBy("part")).alias("first")))
    within = Window.partitionBy("part").orderBy(*order)
    return (dealt.withColumns({"at": F.row_number().over(within) - 1,
                               "inside": ahead("docs", within.rowsBetween(Window.unboundedPreceding, -1))})
            .join(firsts, "part")
            .select("source", "block", (F.col("slots") + F.col("at")).alias("slot"),
                    (F.col("first") + F.col("inside")).alias("start"), (~F.col("late")).alias("balanced")))


def mix(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", weights: dict | None = None,
        block_docs: int = BLOCK_DOCS, resolution: int = RESOLUTION, alpha: float = ALPHA,
        seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``source_col``, ``block`` (of
    the source), ``slot``, ``position`` (its place in the whole mix, 0 to N-1
    without gaps) and ``balanced``.

    Without ``weights`` a source weighs its document count to the power of
    ``alpha``; a source that ``weights`` doesn't name gets the least quota.
    Within a source documents are in a seeded hash order. Slots count from 0
    without gaps. No document is dropped or repeated; the less-than-one-block
    bound holds for the rows with ``balanced``, and the others follow by their
    blocks' deadlines. Null sources form a source of their own; rows that repeat
    an id get places of their own. An empty table gives no rows."""
    rows = docs.select(F.col(id_col).alias("__id"), F.col(source_col).alias("__source"))
    blocks = kept_table(blocks_of(docs.sparkSession, quotas(rows, "__source", weights, resolution, alpha), block_docs), "blocks")
    if blocks.count() <= BROADCAST_BLOCKS:
        blocks = F.broadcast(blocks)
    keyed = (rows.withColumn("source", F.coalesce(F.col("__source").cast("string"), F.lit(NULL_SOURCE)))
             .withColumn("__hash", stable_hash(F.lit(seed), F.col("__id"))))
    ranked = grouped_rank(keyed, "source", "__hash", ["__id"], "__rank")
    placed = ranked.withColumn("block", F.expr(f"__rank DIV {block_docs}")).join(blocks, ["source", "block"])
    return placed.select(
        F.col("__id").alias(id_col), F.col("__source").alias(source_col), "block", "slot",
        F.expr(f"start + __rank - block * {block_docs}").alias("position"), "balanced")


def with_position(docs: DataFrame, position_col: str, *, id_col: str = "doc_id", **settings) -> DataFrame:
    """``docs``, all rows and columns, with their position in ``mix``, in any
    order; rows that repeat an id share its first position."""
    places = (mix(docs, id_col=id_col, **settings).groupBy(F.col(id_col).alias("__mixed"))
              .agg(F.min("position").alias("__position")))
    return (docs.join(places, docs[id_col].eqNullSafe(places["__mixed"]))
            .select(*[docs[c] for c in docs.columns], F.col("__position").alias(position_col)))


def in_mixed_order(docs: DataFrame, *, id_col: str = "doc_id", **settings) -> DataFrame:
    """``docs``, all rows and columns, sorted by their position in ``mix``;
    rows that repeat an id stand together at its first position."""
    placed = with_position(docs, "__place", id_col=id_col, **settings)
    return placed.orderBy("__place").select(*[f"`{c}`" for c in docs.columns])


def op1_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))


ORACLE_SQL = f"""
WITH RECURSIVE counted AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
q AS (SELECT source, n, (n + {BLOCK_DOCS - 1}) // {BLOCK_DOCS} AS blocks, row_number() OVER (ORDER BY source) AS i,
        greatest(1, CAST(round(pow(n, {ALPHA}) / (SELECT sum(pow(n, {ALPHA})) FROM counted) * {RESOLUTION}) AS BIGINT)) AS quota
      FROM counted),
p AS (SELECT CAST(sum(quota) AS BIGINT) AS period, list(quota ORDER BY i) AS quotas, list(blocks ORDER BY i) AS sizes FROM q),
edf AS (
  SELECT CAST(-1 AS BIGINT) AS slot, CAST(NULL AS BIGINT) AS i, list_transform(quotas, lambda x: CAST(0 AS BIGINT)) AS done,
         CAST(NULL AS BIGINT) AS block FROM p
  UNION ALL
  SELECT slot + 1, pick, list_transform(done, lambda d, j: CASE WHEN j = pick THEN d + 1 ELSE d END), done[pick]
  FROM (SELECT slot, done, sizes, list_min(list_filter(list_transform(quotas, lambda w, j:
          CASE WHEN done[j] * period // w <= slot + 1
               THEN ((done[j] * period + period + w - 1) // w) * 100000 + j END), lambda x: x IS NOT NULL)) % 100000 AS pick
        FROM edf, p)
  WHERE done[pick] < sizes[pick]),
dry AS (SELECT slot + 1 AS dry, done FROM edf ORDER BY slot DESC LIMIT 1),
late AS (SELECT i, k AS block, dry + row_number() OVER (ORDER BY ((k + 1) * period + quota - 1) // quota, i) - 1 AS slot
         FROM (SELECT i, quota, done, dry, unnest(range(done[i], blocks)) AS k FROM q, dry), p),
slots AS (SELECT i, block, slot, true AS balanced FROM edf WHERE i IS NOT NULL
          UNION ALL SELECT i, block, slot, false FROM late),
starts AS (SELECT q.source, s.block, s.slot, s.balanced,
             sum(least({BLOCK_DOCS}, q.n - s.block * {BLOCK_DOCS})) OVER (ORDER BY s.slot)
               - least({BLOCK_DOCS}, q.n - s.block * {BLOCK_DOCS}) AS start
           FROM slots s JOIN q ON q.i = s.i),
ranked AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY
             CAST('0x' || substr(md5('{SEED}|' || doc_id), 1, 15) AS BIGINT), doc_id) - 1 AS r FROM documents)
SELECT d.doc_id, d.source, s.block, s.slot,
  CAST(s.start + d.r - s.block * {BLOCK_DOCS} AS BIGINT) AS position, s.balanced
FROM ranked d JOIN starts s ON s.source IS NOT DISTINCT FROM d.source AND s.block = d.r // {BLOCK_DOCS}
"""
