"""Operator 11: divergence audit of the sources of each language.

Terms are runs of letters (``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``), A-Z
lower-cased. They are tagged with their language and vectorised by Spark ML's
``CountVectorizer`` with ``minDF`` and the largest integer ``vocabSize``: the
tag makes a term's document frequency its language's own, so one fit is one per
language. It reads every document's distinct terms. What becomes an exact sparse
vector is the terms that occur equally often in the documents of a (language,
source) that are held at a time: counts add up, so the vector times that number
is the documents' own. A term is vectorised once there, not once an occurrence.
The fit holds its vocabulary at the driver. Therefore terms are dealt by hash
into as many shards as keep a shard under ``SHARD_TERMS`` terms, each fitted and
vectorised by itself; one shard is the usual case. The number of shards follows
from the terms of one part in ``SAMPLE`` of the hash range that occur ``minDF``
times; it does not touch the result.

The vectors, each times its number, are summed per (language, source) without
making them dense, batch by batch and then across tasks. Pairs of sources are
evaluated on the sparse sums: terms are dealt into blocks of about
``BLOCK_ENTRIES`` sums, each block adds up the terms that either source has, and
the terms that neither has count alike, so their number times one value is the
rest. The table of pairs is as large as the result asks for.

Counts and probabilities are integers (decimals where a product passes 64
bits), so every value is exact.

Nulls: a null text, language or source is ''. Repeated rows count again. A
group without terms keeps its pairs; a language without kept terms has pairs of
value 0. An empty table gives none. Texts of any length are read whole. Other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlens.llm.common import UPPER, kept_table, read, ship_package, small_enough

MIN_DF = 10
TOP = 10
SCALE = 1_000_000_000
MAX_VOCABULARY = 2**31 - 1
SHARD_TERMS = 1 << 20
SAMPLE = 64
SUM_RUN = 1 << 12
BLOCK_ENTRIES = 200_000
#: Cells of a block's dense working table (8 bytes each).
TILE = 1 << 20
#: Sources are compared in stripes of about so many.
STRIPE = 256
BATCH_TERMS = 3 << 20
#: Texts that are split at a time.
SPLIT_TEXTS = 500
#: Bytes of text that hold about one term.
TERM_BYTES = 8
#: Terms in a row of ``alike`` at most.
ROW_TERMS = 1 << 16
#: Entries of vectors that a task sums at a time.
SUM_CELLS = 1 << 21
_LOW = 0xFFFFFFFF
_KEYS = [pa.field("lang", pa.string()), pa.field("source", pa.string())]
_ROWS = [pa.field("terms", pa.list_(pa.string())), pa.field("alike", pa.list_(pa.string())), pa.field("times", pa.int64())]
_TAG = b"\0"  # no term holds it
_LETTERS = b"abcdefghijklmnopqrstuvwxyz"
#: A-Z lower-cased, the other ASCII characters that are no letters as spaces.
_TERM_BYTES = bytes(b if b > 127 or b in _LETTERS else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts (bytes, one after another), and where each text's
    terms begin among them, with the end. Every byte of a character beyond
    ASCII belongs to a term."""
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = (texts.buffers()[2] or pa.py_buffer(b""))[at[0]:at[-1]].to_pybytes().translate(_TERM_BYTES)
    at = at - at[0]
    letter = np.frombuffer(data, np.uint8) != 32
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    heads, tails = at[:-1][at[:-1] < at[1:]], at[1:][at[:-1] < at[1:]] - 1
    first[heads], last[tails] = letter[heads], letter[tails]
    first, last = np.flatnonzero(first), np.flatnonzero(last)
    offsets = np.append(0, np.cumsum(last - first + 1)).astype(np.int32)
    letters = pa.py_buffer(data.translate(None, b" "))
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), letters]), np.searchsorted(first, at)


def _term_rows(batches: Iterator[pa.RecordBatch], batch_terms: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``tagged``, from texts of ``TERM_BYTES * batch_terms`` bytes
    (or one text) at a time."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64)
        part = 0
        while part < len(batch):
            end = part + max(1, int(np.searchsorted(np.cumsum(size[part:]), TERM_BYTES * batch_terms, "right")))
            yield from _combined(batch.slice(part, end - part))
            part = end


def _combined(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    texts = batch.column("text").cast(pa.binary())
    parts = [terms_of(texts.slice(i, SPLIT_TEXTS)) for i in range(0, len(texts), SPLIT_TEXTS)]
    size = np.concatenate([np.diff(ends) for _, ends in parts])
    terms = pa.chunked_array([t for t, _ in parts]).dictionary_encode().combine_chunks()
    del parts
    words = terms.dictionary
    code = terms.indices.to_numpy().astype(np.int64)
    del terms
    yield _document_rows(batch, size, code, words)
    yield _group_rows(batch, size, code, words)


def _changes(key: np.ndarray) -> np.ndarray:
    """True where a sorted key differs from the one before it."""
    out = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=out[1:])
    return out


def _rows(batch: pa.RecordBatch, row: np.ndarray, **given: pa.Array) -> pa.RecordBatch:
    row = pa.array(row)
    return pa.RecordBatch.from_arrays([batch.column(k.name).take(row) for k in _KEYS]
                                      + [given.get(f.name, pa.nulls(len(row), f.type)) for f in _ROWS],
                                      schema=pa.schema(_KEYS + _ROWS))


def _listed(batch: pa.RecordBatch, ends: np.ndarray, row: np.ndarray, code: np.ndarray, words: pa.Array) -> pa.Array:
    """Lists of the terms ``code``, each with the language of row ``row`` before it."""
    tags = batch.column("lang").cast(pa.binary()).take(pa.array(row))
    terms = pc.binary_join_element_wise(tags, words.take(pa.array(code)), _TAG)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), terms.cast(pa.string()))


def _document_rows(batch: pa.RecordBatch, size: np.ndarray, code: np.ndarray, words: pa.Array) -> pa.RecordBatch:
    """Each document's distinct terms."""
    key = np.repeat(np.arange(len(batch)) << 32, size)
    key |= code
    key.sort()
    key = key[_changes(key)]
    row, code = (key >> 32).astype(np.int32), (key & _LOW).astype(np.int32)
    del key
    ends = np.searchsorted(row, np.arange(len(batch) + 1))
    return _rows(batch, np.arange(len(batch)), terms=_listed(batch, ends, row, code, words))


def _group_rows(batch: pa.RecordBatch, size: np.ndarray, code: np.ndarray, words: pa.Array) -> pa.RecordBatch:
    """Each group's terms, those of one count in a row."""
    keys = pd.MultiIndex.from_arrays([batch.column(k.name).cast(pa.binary()).to_pandas() for k in _KEYS])
    group = pd.factorize(keys)[0].astype(np.int64)
    first = np.unique(group, return_index=True)[1]
    key = np.repeat(group << 32, size)
    key |= code
    key.sort()
    begin = np.flatnonzero(_changes(key))
    count = np.diff(np.append(begin, len(key)))
    key = key[begin]
    alike = key >> 32 << 32 | count
    order = np.argsort(alike)
    key, alike = key[order], alike[order]
    starts = np.flatnonzero(_changes(alike) | (np.arange(len(alike)) % ROW_TERMS == 0))
    return _rows(batch, first[alike[starts] >> 32], times=pa.array(alike[starts] & _LOW), alike=_listed(
        batch, np.append(starts, len(alike)), first[key >> 32], key & _LOW, words))


def tagged(docs: DataFrame, text_col: str, lang_col: str, source_col: str,
           batch_terms: int = BATCH_TERMS) -> DataFrame:
    """Terms with their language before them, in rows of two kinds: ``terms``
    holds a document's distinct terms; ``alike`` holds terms of a (lang, source)
    that each occur ``times`` times in some of its documents. Over all rows of
    the second kind, ``times`` adds up to a term's occurrences."""
    def given(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    return docs.select(given(lang_col).alias("lang"), given(source_col).alias("source"), given(text_col).alias("text")
                       ).mapInArrow(lambda batches: _term_rows(batches, batch_terms),
                                    "lang string, source string, terms array<string>, alike array<string>, times long")


def _group_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the sparse vectors of each (lang, source), each as often as its
    row says, of batches of about ``SUM_CELLS`` entries together."""
    held, cells = [], 0
    for batch in batches:
        held.append(batch)
        cells += len(batch.column("vector").field("indices").flatten())
        if cells >= SUM_CELLS:
            yield from _summed(held)
            held, cells = [], 0
    yield from _summed(held)


def _summed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pa.Table.from_batches(held).combine_chunks().to_batches() if held else []:
        groups = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], ["lang", "source"])
        keys = pd.MultiIndex.from_arrays([batch.column("lang").to_pandas(), batch.column("source").to_pandas()])
        code, _ = pd.factorize(keys)
        vectors = batch.column("vector")
        at, value = vectors.field("indices"), vectors.field("values")
        size = np.diff(at.offsets.to_numpy())
        index = at.flatten().to_numpy().astype(np.int64)
        count = value.flatten().to_numpy().astype(np.int64) * np.repeat(batch.column("times").to_numpy(), size)
        key = np.repeat(code.astype(np.int64), size) << 32 | index
        order = np.argsort(key)
        key, count = key[order], count[order]
        begin = np.flatnonzero(_changes(key))
        key, total = key[begin], np.add.reduceat(count, begin) if len(begin) else count
        # One row per group and run of SUM_RUN indices.
        index = key & 0xFFFFFFFF
        run = key >> 32 << 32 | index // SUM_RUN
        starts = np.flatnonzero(_changes(run))
        ends = pa.array(np.append(starts, len(run)).astype(np.int32))
        first = np.unique(code, return_index=True)[1]
        yield pa.RecordBatch.from_arrays(
            [*groups.take(pa.array(first[run[starts] >> 32])).flatten(), pa.array((index[starts] // SUM_RUN).astype(np.int32)),
             pa.ListArray.from_arrays(ends, pa.array(index.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(total))],
            names=["lang", "source", "run", "indices", "counts"])


def sparse_sums(docs: DataFrame, min_df: int = MIN_DF, shard_terms: int = SHARD_TERMS) -> tuple[DataFrame, DataFrame]:
    """(lang, source, index, count) of the kept terms, counts above 0, of what
    ``tagged`` gives; (index, term). An index is one of a term of one language."""
    spark = docs.sparkSession
    alike = docs.filter("times IS NOT NULL").select("lang", "source", "times", F.col("alike").alias("terms"))
    docs = docs.filter("terms IS NOT NULL").select("terms")
    sample = (alike.select(F.explode("terms").alias("t"), "times")
              .filter(F.pmod(F.xxhash64(F.lit("sample"), "t"), F.lit(SAMPLE)) == 0)
              .groupBy("t").agg(F.sum("times").alias("n")).filter(F.col("n") >= min_df).count())
    shards = max(1, math.ceil(1.25 * sample * SAMPLE / shard_terms))
    out, names, known = None, None, 0
    for s in range(shards):
        # Document frequencies need a document's distinct terms only.
        once, part = [df if shards == 1 else df.withColumn(
            "terms", F.filter("terms", lambda x: F.pmod(F.xxhash64(x), F.lit(shards)) == s))  # noqa: B023
            for df in (docs, alike)]
        model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_df),
                                vocabSize=MAX_VOCABULARY).fit(once)
        vocabulary = model.vocabulary
        if not vocabulary:
            continue
        sums = (model.transform(part).select("lang", "source", "times", "vector")
                .mapInArrow(_group_sums, "lang string, source string, run int, indices array<int>, counts array<long>")
                # Shuffled as arrays; summing by index needs no further exchange.
                .repartition("lang", "source", "run")
                .select("lang", "source", "run", F.inline(F.arrays_zip("indices", "counts")).alias("index", "count"))
                .groupBy("lang", "source", "run", "index").agg(F.sum("count").alias("count")))
        sums = kept_table(sums.select("lang", "source", (F.col("index") + F.lit(known).cast("long")).alias("index"), "count"),
                          "divergence-sums")
        terms = kept_table(spark.createDataFrame(pa.table({
            "index": pa.array(np.arange(known, known + len(vocabulary), dtype=np.int64)),
            "term": pa.array([w.rsplit(_TAG.decode(), 1)[1] for w in vocabulary], pa.string())})), "divergence-names")
        known += len(vocabulary)
        out, names = (sums, terms) if out is None else (out.unionByName(sums), names.unionByName(terms))
    if out is None:
        out = spark.createDataFrame([], "lang string, source string, index long, count long")
        names = spark.createDataFrame([], "index long, term string")
    return out, names


def scaled(count: str, n: str, v: str) -> Column:
    """p = 1 + floor(1000000000 (count + 2) / (n + 2 v)); null if nothing is kept."""
    return F.expr(f"""CASE WHEN {v} > 0 AND {count} < 9000000000 THEN 1L + ({SCALE}L * ({count} + 2)) div ({n} + 2 * {v})
                      WHEN {v} > 0 THEN 1L + (cast({SCALE} AS decimal(10,0)) * cast({count} + 2 AS decimal(19,0)))
                      div cast({n} + 2 * {v} AS decimal(19,0)) END""")


def divergence(p: str, q: str) -> Column:
    """f = floor((p - q)^2 / (p + q)); p and q are at most 1000000001."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _pair_sums(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
    """Of one block of a language's terms and two stripes of its sources: for
    each pair of sources, one of each stripe, the number of terms that either
    has, and the sum of f over them. A row of index -1 names a source and the p
    of the terms that it lacks."""
    heads = block[block["index"] < 0].sort_values("source")
    names, p0, stripe = heads["source"].to_numpy(), heads["p"].to_numpy(np.int64), heads["stripe"].to_numpy()
    cells = block[block["index"] >= 0]
    row = np.searchsorted(names, cells["source"].to_numpy())
    col = pd.factorize(cells["index"])[0]
    p = cells["p"].to_numpy(np.int64)
    by_row = np.argsort(row, kind="stable")
    bounds = np.searchsorted(row[by_row], np.arange(len(names) + 1))
    width = int(col.max()) + 1 if len(col) else 0
    size = np.zeros((len(names), len(names)), np.int64)  # terms of a that b has
    one, both = size.copy(), size.copy()  # f over the terms of a; over those that b has too
    step = max(1, TILE // max(1, width))
    for lo in range(0, len(names), step):
        hi = min(len(names), lo + step)
        table = np.repeat(p0[lo:hi, None], width, axis=1)
        has = np.zeros(table.shape, bool)
        mine = by_row[bounds[lo]:bounds[hi]]
        table[row[mine] - lo, col[mine]] = p[mine]
        has[row[mine] - lo, col[mine]] = True
        for a in range(len(names)):
            own = by_row[bounds[a]:bounds[a + 1]]
            other, shared = table[:, col[own]], has[:, col[own]]
            apart = other - p[own]
            f = apart * apart // (other + p[own])
            one[a, lo:hi] = f.sum(axis=1)
            both[a, lo:hi] = (f * shared).sum(axis=1)
            size[a, lo:hi] = shared.sum(axis=1)
    a, b = np.triu_indices(len(names), 1)
    if key[2] != key[3]:
        a, b = a[stripe[a] != stripe[b]], b[stripe[a] != stripe[b]]
    held = np.diff(bounds)
    return pd.DataFrame({"lang": key[0], "a": names[a], "b": names[b], "terms": held[a] + held[b] - size[a, b],
                         "value": one[a, b] + one[b, a] - both[a, b]})


def audit(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_df: int = MIN_DF, top: int = TOP, shard_terms: int = SHARD_TERMS,
          block_entries: int = BLOCK_ENTRIES, stripe_sources: int = STRIPE,
          batch_terms: int = BATCH_TERMS) -> DataFrame:
    """See ``op11_source_divergence`` for the columns."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = kept_table(tagged(docs, text_col, lang_col, source_col, batch_terms), "divergence-documents")
    counts, names = sparse_sums(rows, min_df, shard_terms)
    whole = kept_table(counts.groupBy("lang", "index").agg(F.sum("count").alias("lang_count")), "divergence-terms")
    langs = kept_table(whole.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_count").alias("lang_n")),
                       "divergence-langs")
    sizes = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("entries"))
    # One row per group, with the p of the terms that it lacks, and the blocks of its language.
    groups = (rows.filter("times IS NULL").select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
              .fillna(0, ["n", "entries", "v", "lang_n"]).withColumn("zero", F.lit(0).cast("long"))
              .withColumn("p0", scaled("zero", "n", "v")))
    blocks = F.ceil(F.sum("entries").over(Window.partitionBy("lang")) / F.lit(block_entries))
    stripes = F.ceil(F.count(F.lit(1)).over(Window.partitionBy("lang")) / F.lit(stripe_sources)).cast("int")
    groups = (groups.withColumns({"blocks": F.greatest(F.lit(1), blocks).cast("int"), "stripes": stripes}).drop("zero")
              .withColumn("stripe", F.pmod(F.xxhash64("source"), "stripes").cast("int")))
    groups = kept_table(groups, "divergence-groups")
    cells = kept_table(counts.join(groups, ["lang", "source"]).withColumn("p", scaled("count", "n", "v")).select(
        "lang", "source", "index", "p", "stripe", "stripes",
        F.pmod(F.xxhash64("index"), "blocks").cast("int").alias("block")), "divergence-cells")

    heads = groups.filter("v > 0").select(
        "lang", "source", F.lit(-1).cast("long").alias("index"), F.col("p0").alias("p"), "stripe", "stripes",
        F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))
    # Every two stripes meet once in a block.
    met = (cells.unionByName(heads).withColumn("other", F.explode(F.expr("sequence(0, stripes - 1)")))
           .select("lang", "block", F.least("stripe", "other").alias("lo"), F.greatest("stripe", "other").alias("hi"),
                   "source", "index", "p", "stripe"))
    summed = (met.groupBy("lang", "block", "lo", "hi")
              .applyInPandas(_pair_sums, "lang string, a string, b string, terms long, value long")
              .groupBy("lang", "a", "b").agg(F.sum("terms").alias("terms"), F.sum("value").alias("value")))
    a = groups.select("lang", F.col("source").alias("a"), F.col("p0").alias("pa"), "v")
    b = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("pb"))
    # The result's own rows: every two sources of a language.
    value = F.expr("CASE WHEN v = 0 THEN 0L ELSE value + (v - terms) * (((pa - pb) * (pa - pb)) div (pa + pb)) END")
    pairs = (a.join(b, "lang").filter("a < b").join(summed, ["lang", "a", "b"], "left").withColumn("value", value)
             .select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                               F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
                     .alias("x"), "value").select("lang", "x.source", "x.item", "value"))
    overall = whole.join(small_enough(langs), "lang").select("index", scaled("lang_count", "lang_n", "v").alias("q"))
    groups_of = Window.partitionBy("lang", "source")
    # Only terms that can be among the first, ties with the last of them too, are named.
    terms = (cells.select("lang", "source", "index", "p").join(overall, "index").filter("p > q")
             .select("lang", "source", "index", divergence("p", "q").alias("value"))
             .withColumn("least", F.rank().over(groups_of.orderBy(F.desc("value")))).filter(F.col("least") <= top)
             .join(names, "index").select("lang", "source", F.col("term").alias("item"), "value"))
    order = groups_of.orderBy(F.desc("value"), "item")
    ranked = [t.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit(part))
              for part, t in (("pair", pairs), ("term", terms))]
    return ranked[0].unionByName(ranked[1].filter(F.col("rank") <= top)).select(
        "lang", "source", "part", "item", "value", "rank")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang, source, part, item, value, rank of all ``documents``."""
    return audit(read(spark, sf_dir, "documents"))


def _oracle() -> str:
    term = "regexp_extract_all(translate(text, '{0}', '{1}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    p = f"1 + {SCALE}::HUGEINT * ({{0}} + 2) // ({{1}} + 2 * v)"
    f = "(({0} - {1}) * ({0} - {1}) // ({0} + {1}))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
           coalesce(source, '') AS source FROM documents),
w AS (SELECT r, lang, source, unnest({term.format(UPPER, UPPER.lower())}) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lc FROM w GROUP BY ALL HAVING count(DISTINCT r) >= {MIN_DF}),
l AS (SELECT lang, count(*) AS v, sum(lc) AS ln FROM k GROUP BY lang),
c AS (SELECT w.lang, source, term, count(*) AS c FROM w JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM (SELECT DISTINCT lang, source FROM d)
      LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, {p.format('coalesce(c.c, 0)', 'g.n')} AS p,
      {p.format('lc', 'ln')} AS q
      FROM g JOIN k ON k.lang = g.lang JOIN l ON l.lang = g.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum({f.format('a.p', 'b.p')}) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, CAST({f.format('p', 'q')} AS BIGINT) FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER w AS INTEGER) AS rank FROM o
WINDOW w AS (PARTITION BY lang, source, part ORDER BY value DESC, item)
QUALIFY part = 'pair' OR rank <= {TOP}
"""


ORACLE_SQL = _oracle()
