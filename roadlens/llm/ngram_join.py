"""Operator 5: n-gram Jaccard join with token-combination prefixes.

Documents with the same shingle set are one class. Classes link when
``100 * |A & B| >= 80 * |A | B|``. In any fixed order of the tokens, two
linked sets share a token among their first ``p = |X| // 5 + 1`` tokens, and
two of them among the first ``p + 1``. The order here is: rare tokens, then
frequent ones, by hash within a class. Hash order alone already gives each
set's first tokens without counting anything, so only a little more than p
tokens of a set (``SLACK``) are counted and looked up:

1. Tokens are counted over all classes; one that more than ``FREQUENT``
   classes hold is frequent. A set with p rare tokens among those looked at is
   *light*: its prefix is known. The others are *heavy*, and all their tokens
   are looked up.
2. Light-light and light-heavy pairs share a rare prefix token, so single rare
   tokens are joined. The places of the shared tokens bound the overlap, which
   drops nearly all pairs that don't link; the rest is verified on whole sets.
3. Heavy-heavy pairs use counts among the heavy sets: single tokens for rare
   ones, and for frequent ones combinations of two tokens of the prefix
   extended by one (single tokens for very long sets, whose combinations would
   be too many). Sets that a chain of shared combinations connects form a
   family, which is verified block against block on whole sets, in bands of
   size so that blocks whose sizes can't link are never paired.

Every step is exact; no candidate is capped or sampled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlens.llm.common import kept_table, read, ship_package, small_enough
from roadlens.llm.graph import components
from roadlens.llm.shingles import digest, sets

FREQUENT = 16
SLACK = 32
#: Sets up to this size use combinations; from 0.8 of it on, single tokens too.
COMBINED_SIZE = 500
BLOCK = 256
#: Sizes of a band differ by less than this factor.
BAND = 1.1


def shingle_table(docs: DataFrame) -> DataFrame:
    """``__id``, n, digest and ``tokens`` (the first p + ``SLACK`` in hash
    order) of (``__id``, ``__text``) rows."""
    def batches(it):
        for batch in it:
            n, marks, out = [], [], []
            for s in sets(batch.column(1)):
                n.append(len(s))
                marks.append(digest(s))
                out.append(s[:len(s) // 5 + 1 + SLACK])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(marks, pa.binary()), token_lists(out)],
                ["__id", "n", "digest", "tokens"])

    kind = docs.schema["__id"].dataType.simpleString()
    return docs.mapInArrow(batches, f"__id {kind}, n long, digest binary, tokens array<long>")


def token_lists(arrays: list) -> pa.ListArray:
    ends = np.cumsum([0] + [len(s) for s in arrays])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def prefix_size(n: str = "n") -> str:
    return f"({n} DIV 5 + 1)"


def whole_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n, tokens) of ``nodes`` (a written table of node, rep, digest),
    from the texts of their documents. A document that the table holds twice
    comes twice."""
    wanted = docs.join(small_enough(nodes), F.col("__id") == F.col("rep")).select("__text", "node", "digest")

    def batches(it):
        for batch in it:
            found = list(sets(batch.column(0)))
            same = [i for i, (s, d) in enumerate(zip(found, batch.column(2).to_pylist())) if digest(s) == d]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(pa.array(same, pa.int64())), pa.array([len(found[i]) for i in same], pa.int64()),
                 token_lists([found[i] for i in same])], ["node", "n", "tokens"])

    return wanted.mapInArrow(batches, "node long, n long, tokens array<long>")


def sized(a: str, b: str) -> str:
    return f"100 * least({a}, {b}) >= 80 * greatest({a}, {b})"


def candidate_pairs(left: DataFrame, right: DataFrame, same: bool, tails: bool = True) -> DataFrame:
    """Pairs (x, y) of index rows (token, node, n, at) that share a token and
    may link. ``at`` counts from 0 in an order that both sides share, and every
    token up to the last shared one is in the index of both: what isn't shared
    up to there differs, and linked sets differ in at most (n + m) / 9. With
    ``tails`` the index ends with the p-th token, so the rest of the list that
    ends first differs, too."""
    a = left.select("token", *[F.col(c).alias(f"a_{c}") for c in ("node", "n", "at")])
    b = right.select("token", *[F.col(c).alias(f"b_{c}") for c in ("node", "n", "at")])
    on = F.expr(sized("a_n", "b_n") + (" AND a_node < b_node" if same else ""))
    pairs = (a.join(b, (a["token"] == b["token"]) & on)
             .groupBy("a_node", "b_node").agg(F.count(F.lit(1)).alias("s"), F.max("a_at").alias("a_at"),
                                              F.max("b_at").alias("b_at"), F.first("a_n").alias("a_n"),
                                              F.first("b_n").alias("b_n")))
    tail = f"+ least({prefix_size('a_n')} - a_at, {prefix_size('b_n')} - b_at) - 1" if tails else ""
    return pairs.filter(f"9 * (a_at + b_at + 2 - 2 * s {tail}) <= a_n + b_n").select(
        F.col("a_node").alias("x"), F.col("b_node").alias("y"))


def verified(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """The pairs (x, y) whose whole sets link."""
    left = full.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("tokens").alias("tx"))
    right = full.select(F.col("node").alias("y"), F.col("n").alias("ny"), F.col("tokens").alias("ty"))
    both = F.size(F.array_intersect("tx", "ty"))
    return (pairs.join(left, "x").join(right, "y").withColumn("both", both)
            .filter("100 * both >= 80 * (nx + ny - both)").select("x", "y"))


def heavy_keys(ranked: DataFrame) -> DataFrame:
    """(key, node) of frequent tokens in extended prefixes: combinations of
    two, and single tokens of very long sets."""
    frequent = ranked.filter(f"c > {FREQUENT} AND at <= {prefix_size()}")  # places 0 to p
    held = frequent.groupBy("node", "n").agg(F.sort_array(F.collect_list("token")).alias("t"))
    pairs = (held.filter(f"n <= {COMBINED_SIZE}").select("node", F.explode(F.expr(
        """flatten(transform(t, (a, i) -> transform(slice(t, i + 2, size(t)), b -> xxhash64(a, b))))""")).alias("key")))
    singles = frequent.filter(f"10 * n >= 8 * {COMBINED_SIZE}").select("node", F.col("token").alias("key"))
    return pairs.unionByName(singles)


def family_links(family: DataFrame, full: DataFrame) -> DataFrame:
    """Links (x, y) within families (``node``, ``family``): enough of them to
    connect all that link. Sets are dealt by hash into blocks of about
    ``BLOCK`` within bands of their size, and blocks meet each other where
    their sizes can link. Only counts per band are needed, so no family is
    sorted or numbered in one task."""
    banded = (family.join(full.select("node", "n"), "node")
              .withColumn("band", F.expr(f"cast(floor(ln(n) / ln({BAND})) AS long)")))
    counts = banded.groupBy("family", "band").agg(F.count(F.lit(1)).alias("in_band"))
    # A block's number grows with its band, so a later block's sets aren't smaller.
    blocked = banded.join(counts, ["family", "band"]).withColumn("block", F.expr(
        f"shiftleft(band, 40) + pmod(xxhash64(node), (in_band + {BLOCK - 1}) DIV {BLOCK})")).drop("band", "in_band")
    blocked = kept_table(blocked, "blocks")
    spans = blocked.groupBy("family", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    meets = (spans.select(F.col("family").alias("fam"), F.col("block").alias("i"), F.col("hi").alias("top"))
             .join(spans.select(F.col("family").alias("fam"), F.col("block").alias("j"), "lo"), "fam")
             .filter("i <= j AND 100 * top >= 80 * lo").select("fam", "i", "j"))
    sides = [blocked.join(meets, F.expr(f"family = fam AND block = {side}"))
             .select("family", "i", "j", "node", F.lit(side).alias("side")) for side in ("i", "j")]
    rows = sides[0].unionByName(sides[1].filter("i < j")).join(full, "node")

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        same = pdf["i"].iat[0] == pdf["j"].iat[0]
        a = pdf[pdf["side"] == "i"].sort_values("node")
        b = a if same else pdf[pdf["side"] == "j"].sort_values("node")
        tokens = np.concatenate(b["tokens"].to_list())
        owner = np.repeat(np.arange(len(b)), b["n"].to_numpy())
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        xs, ys = a["node"].to_numpy(), b["node"].to_numpy()
        group = {v: v for v in (*xs.tolist(), *ys.tolist())}

        def top(v):
            while group[v] != v:
                group[v] = v = group[group[v]]
            return v

        out = []
        sizes_b = b["n"].to_numpy()
        for x, n, t in zip(xs.tolist(), a["n"].to_list(), a["tokens"]):
            lo, hi = np.searchsorted(tokens, t, "left"), np.searchsorted(tokens, t, "right")
            width = hi - lo
            at = np.repeat(lo - np.concatenate(([0], np.cumsum(width)[:-1])), width) + np.arange(width.sum())
            both = np.bincount(owner[at], minlength=len(ys))
            for y in ys[(100 * both >= 80 * (n + sizes_b - both)) & (ys != x)].tolist():
                p, q = top(x), top(y)
                if p != q:
                    group[p] = q
                    out.append((x, y))
        return pd.DataFrame(out, columns=["x", "y"]).astype("int64")

    return rows.groupBy("family", "i", "j").applyInPandas(meet, "x long, y long")


def join_ngrams(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_shingles``, ``component_id``
    (the least id reachable by links, itself included).

    Null, empty and wordless texts have no shingles and link with nothing.
    Rows that repeat an id are one vertex; rows with a null id link with
    nothing. An empty table gives no rows."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    table = kept_table(shingle_table(rows).withColumn("row", F.monotonically_increasing_id()), "shingles")
    usable = table.filter("n > 0 AND __id IS NOT NULL")
    # A class is known by the row of its least id.
    nodes = kept_table(usable.groupBy("digest").agg(F.min(F.struct("__id", "row")).alias("first"), F.first("n").alias("n"))
                       .select(F.col("first.row").alias("node"), F.col("first.__id").alias("rep"), "digest", "n"), "classes")
    copies = kept_table(usable.select("row").join(nodes.select(F.col("node").alias("row")), "row", "left_anti"), "copies")

    entries = (usable.join(small_enough(copies), "row", "left_anti")
               .select(F.col("row").alias("node"), "n", F.posexplode("tokens").alias("pos", "token")))
    counts = entries.groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = kept_table(entries.join(counts, "token"), "shared")

    # Rare tokens first: a token's place is its place by hash less the frequent ones before it.
    place = Window.partitionBy("node").orderBy("pos")
    frequent = F.when(F.col("c") > FREQUENT, 1).otherwise(0)
    placed = (shared.withColumn("f", F.sum(frequent).over(place.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("all_f", F.sum(frequent).over(Window.partitionBy("node")))
              .withColumn("heavy", F.expr(f"least(n, {prefix_size()} + {SLACK}) - all_f < {prefix_size()}"))
              .withColumn("at", F.col("pos") - F.col("f")))
    light = placed.filter(f"NOT heavy AND c <= {FREQUENT} AND at < {prefix_size()}").select("token", "node", "n", "at")
    heavy = kept_table(placed.filter("heavy").select("node").distinct().join(nodes, "node"), "heavy")

    heavy_full = kept_table(whole_sets(rows, heavy.select("node", "rep", "digest")).dropDuplicates(["node"]), "heavy-sets")
    tokens = heavy_full.select("node", "n", F.posexplode("tokens").alias("pos", "token"))
    known = shared.filter(f"c > {FREQUENT}").select("token").distinct().withColumn("known", F.lit(True))
    rare = tokens.join(known, "token", "left").filter("known IS NULL")
    published = (rare.withColumn("at", F.row_number().over(place) - 1).filter(f"at < {prefix_size()}")
                 .select("token", "node", "n", "at"))
    pairs = candidate_pairs(light, light, True).unionByName(candidate_pairs(light, published, False))

    # Among heavy sets, the order is by their own counts.
    own = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c"))
    by_count = Window.partitionBy("node").orderBy("c", "token")
    ranked = kept_table(tokens.join(own, "token").withColumn("at", F.row_number().over(by_count) - 1)
                        .filter(f"c > 1 AND at <= {prefix_size()}").select("token", "node", "n", "c", "at"), "heavy-prefixes")
    single = ranked.filter(f"c <= {FREQUENT}")
    pairs = kept_table(pairs.unionByName(candidate_pairs(single, single, True, tails=False)).distinct(), "candidates")
    keys = kept_table(heavy_keys(ranked), "combinations")
    least = keys.groupBy("key").agg(F.min("node").alias("b"))
    family = components(keys.join(least, "key").select(F.col("node").alias("a"), "b").distinct())
    inside = family_links(family.select(F.col("v").alias("node"), F.col("root").alias("family")), heavy_full)

    used = pairs.select(F.col("x").alias("node")).unionByName(pairs.select(F.col("y").alias("node"))).distinct()
    used = kept_table(nodes.join(used, "node").select("node", "rep", "digest"), "used")
    full = kept_table(whole_sets(rows, used), "sets")
    links = verified(pairs, full).unionByName(inside)
    named = nodes.select("node", "rep")
    edges = (links.join(named.select(F.col("node").alias("x"), F.col("rep").alias("a")), "x")
             .join(named.select(F.col("node").alias("y"), F.col("rep").alias("b")), "y").select("a", "b"))
    roots = components(edges)
    labelled = (nodes.join(roots.withColumnRenamed("v", "rep"), "rep", "left")
                .select("digest", F.coalesce("root", "rep").alias("component")))
    return (table.select("__id", "n", "digest").join(labelled, "digest", "left")
            .select(F.col("__id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("__id").isNotNull(), F.coalesce("component", "__id")).alias("component_id")))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that ``join_ngrams`` links with one of a
    smaller id. Rows with a null id stay."""
    joined = join_ngrams(docs, id_col=id_col, text_col=text_col)
    gone = joined.filter(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)


def op5_ngram_combination_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_ngrams(read(spark, sf_dir, "documents"))


ORACLE_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x09-\\x0D ]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o >= 80 * (p.n + q.n - o)),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT documents.doc_id, coalesce(n.n, 0) AS n_shingles, least(documents.doc_id, coalesce(m.y, documents.doc_id)) AS component_id
FROM documents LEFT JOIN n ON n.doc_id = documents.doc_id
LEFT JOIN (SELECT x, min(y) AS y FROM r GROUP BY x) m ON m.x = documents.doc_id
"""
