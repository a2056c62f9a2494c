"""Operator 12: phrase collocations from sharded FM-indexes.

Texts are lower-cased (A-Z only) and split into pieces at ``[.,;:!?\\n-\\r]``
and words at spaces and tabs. Every task cuts its rows into shards of at most
``SHARD_WORDS`` words (plus one text) and indexes each shard's word ids with a
bidirectional FM-index whose rows are ordered by their first ``DEPTH`` symbols.
That order is enough for exact intervals of patterns up to ``DEPTH``. From the
interval of a word, backward steps in the forward index give its left
extensions, steps in the reverse index its right extensions; both intervals are
kept in step. Counts are summed across shards.

A phrase can only be frequent if its parts are. Three passes use this: words;
pairs of frequent words; triples whose two pairs are frequent. The frequent
parts reach the tasks as a bit set of at most ``2^MAX_BITS`` bits: a chance hit
costs a row that the exact sum removes, and nothing frequent is ever lost.

Nulls: a null text is empty, a null language is ``und``. Texts without words
and empty tables give no rows. Repeated rows count again. Other columns are not
read. A text of any length is indexed whole.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlens.llm.common import kept_table, read, ship_package

MIN_COUNT = 10
COVERED_PERCENT = 50
TOP = 2000
DEPTH = 3
SHARD_WORDS = 1 << 19
PACKED_SYMBOLS = 1 << 21
#: The bit set of frequent parts holds 16 bits a part, at most 2^27 (16 MB).
MIN_BITS, MAX_BITS = 20, 27
SCALE = 1_000_000
RANK_PARTS = 64
#: Tables of counts up to this size are sent to every executor.
SENT_ROWS, SENT_BYTES = 500_000, 1 << 24
UNDEFINED = "und"

#: Bytes of a text: A-Z lower-cased, piece ends as \\n, tabs as spaces.
_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t",
                         b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")


def tokens_of(text: bytes) -> list[bytes]:
    """The words of a text in order, and ``\\n`` wherever a piece ends."""
    return [w for w in text.translate(_BYTES).replace(b"\n", b" \n ").split(b" ") if w]


def _order(key: np.ndarray) -> np.ndarray:
    """A stable argsort. Where the key leaves room for the place beside it,
    plain sorting of both together is several times as fast."""
    bits = len(key).bit_length()
    if len(key) and int(key.max()) < 1 << (63 - bits):
        packed = key << bits | np.arange(len(key))
        packed.sort()
        return packed & ((1 << bits) - 1)
    return np.argsort(key, kind="stable")


class ShardIndex:
    """Bidirectional FM-index over ``ids``: symbols up to ``sigma``, 0 between
    pieces. The text is cyclic, and 0 at its start keeps both ends apart. Each
    side is built when it is first extended."""

    def __init__(self, ids: np.ndarray, sigma: int):
        self.ids, self.sigma, self.sides = ids, sigma, {}
        self.counts = np.bincount(ids, minlength=sigma + 1)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])[:-1]

    def side(self, side: str) -> tuple[np.ndarray, np.ndarray]:
        """Of the forward (left) or reverse (right) index: its last column, and
        for each row where its last symbol's rows begin plus the symbol's rank,
        the row that one step leads to."""
        if side not in self.sides:
            way, base = -1 if side == "left" else 1, np.int64(self.sigma + 1)
            one, two = np.roll(self.ids, way), np.roll(self.ids, 2 * way)
            # Three symbols fit a key unless one text brings millions of words.
            rows = (np.argsort((self.ids * base + one) * base + two) if base < PACKED_SYMBOLS else
                    np.lexsort((two, one, self.ids)))
            last = np.roll(self.ids, -way)[rows]
            step = np.empty(len(last), np.int64)
            step[_order(last)] = np.arange(len(last))
            self.sides[side] = last, step
        return self.sides[side]

    def words(self, keep: np.ndarray) -> dict:
        """Intervals of the single symbols that ``keep`` allows."""
        symbols = np.flatnonzero(keep & (self.counts > 0))
        symbols = symbols[symbols > 0]
        return {"fwd": self.first[symbols], "rev": self.first[symbols], "n": self.counts[symbols],
                "phrase": symbols[:, None]}

    def extend(self, at: dict, side: str, keep: np.ndarray) -> dict:
        """All one-symbol extensions of the intervals ``at`` on one side by
        symbols that ``keep`` allows, with their counts."""
        own, other = ("fwd", "rev") if side == "left" else ("rev", "fwd")
        last, step = self.side(side)
        starts = np.cumsum(at["n"]) - at["n"]
        parent = np.repeat(np.arange(len(at["n"])), at["n"])
        rows = np.arange(len(parent)) + np.repeat(at[own] - starts, at["n"])
        key = parent * np.int64(self.sigma + 1) + last[rows]
        order = _order(key)
        key = key[order]
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        counts = np.diff(np.concatenate([begin, [len(key)]]))
        parent, symbol = parent[order[begin]], key[begin] % (self.sigma + 1)
        # The stable order makes each group's first row its least: one step
        # from it leads to the start of the longer pattern's interval.
        out = {own: step[rows[order[begin]]], other: at[other][parent] + begin - starts[parent], "n": counts,
               "phrase": np.concatenate([symbol[:, None], at["phrase"][parent]] if side == "left" else
                                        [at["phrase"][parent], symbol[:, None]], axis=1)}
        ok = (symbol > 0) & keep[symbol]
        return {k: v[ok] for k, v in out.items()}


def _hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang + b"\0" + word, 42)


def _word_hash(word: Column) -> Column:
    """The same hash in Spark."""
    return F.xxhash64(F.concat("lang", F.lit("\0"), word))


def _pair_hash(a, b):
    """Of two word hashes; the same on columns and on arrays."""
    return a.bitwiseXOR(F.shiftleft(b, 1)) if isinstance(a, Column) else a ^ (b << 1)


def bit_set(parts: DataFrame, hashed: Column) -> np.ndarray:
    """The low bits of ``hashed`` of all ``parts`` as a packed bit set, built in
    Spark; the driver gets its ``2^bits / 8`` bytes."""
    bits = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(16 * max(1, parts.count())))))
    at = hashed.bitwiseAND(F.lit((1 << bits) - 1))
    rows = (parts.select(F.shiftright(at, 15).alias("page"), at.bitwiseAND(F.lit(32767)).alias("bit"))
            .groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bytes")).collect())
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in rows:
        out[r.page * 4096:r.page * 4096 + len(r.bytes)] = np.frombuffer(r.bytes, np.uint8)
    return out


def _in(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.int64(len(bits) * 8 - 1)
    return (bits[at >> 3] >> (at & 7)) & 1 == 1


class _Shard:
    """The words of the texts added so far, as ids of (language, word)."""

    def __init__(self):
        count = itertools.count(1)
        self.ids = defaultdict(lambda: defaultdict(count.__next__, {b"\n": 0}))
        self.runs, self.size = [np.zeros(1, np.int64)], 0

    def add(self, lang: bytes, text: bytes) -> None:
        tokens = tokens_of(text) + [b"\n"]
        self.runs.append(np.fromiter(map(self.ids[lang].__getitem__, tokens), np.int64, len(tokens)))
        self.size += len(tokens)

    def phrases(self, length: int, word_bits, pair_bits) -> pa.RecordBatch:
        sigma = sum(len(ids) - 1 for ids in self.ids.values())
        words, langs = [b""] * (sigma + 1), [b""] * (sigma + 1)
        for lang, ids in self.ids.items():
            for w, i in ids.items():
                words[i], langs[i] = w, lang
        text = np.concatenate(self.runs)
        if length == 1:
            found = np.arange(1, sigma + 1)[:, None]
            counts = np.bincount(text, minlength=sigma + 1)[1:]
        else:
            h = np.array([0, *map(_hash, langs[1:], words[1:])], np.uint64).view(np.int64)
            keep = _in(word_bits, h)
            index = ShardIndex(text, sigma)
            at = index.extend(index.words(keep), "left", keep)
            if length == 3:
                pairs = _in(pair_bits, _pair_hash(h[at["phrase"][:, 0]], h[at["phrase"][:, 1]]))
                at = index.extend({k: v[pairs] for k, v in at.items()}, "right", keep)
                pairs = _in(pair_bits, _pair_hash(h[at["phrase"][:, 1]], h[at["phrase"][:, 2]]))
                at = {k: v[pairs] for k, v in at.items()}
            found, counts = at["phrase"], at["n"]
        words, langs = pa.array(words, pa.large_binary()), pa.array(langs, pa.large_binary())
        parts = [words.take(pa.array(found[:, j])) for j in range(length)]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if length > 1 else parts[0]
        return pa.RecordBatch.from_arrays(
            [langs.take(pa.array(found[:, 0])).cast(pa.large_string()).cast(pa.string()),
             phrase.cast(pa.large_string()).cast(pa.string()), pa.array(counts.astype(np.int64))],
            names=["lang", "phrase", "n"])


def _sharded(batches: Iterator[pa.RecordBatch], length: int, shard_words: int, word_bits,
             pair_bits) -> Iterator[pa.RecordBatch]:
    shard = _Shard()
    for batch in batches:
        langs, texts = batch.column("lang").cast(pa.binary()), batch.column("text").cast(pa.binary())
        for lang, text in zip(langs.to_pylist(), texts):
            shard.add(lang, text.as_py())
            if shard.size >= shard_words:
                yield from _slices(shard.phrases(length, word_bits, pair_bits))
                shard = _Shard()
    if shard.size:
        yield from _slices(shard.phrases(length, word_bits, pair_bits))


def _slices(batch: pa.RecordBatch, rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def phrase_counts(docs: DataFrame, length: int, word_bits=None, pair_bits=None,
                  shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, phrase, n): the occurrences of all phrases of ``length`` words
    that the bit sets allow, summed across shards. ``docs``: lang, text."""
    sc = docs.sparkSession.sparkContext
    sent = sc.broadcast((word_bits, pair_bits))
    return (docs.mapInArrow(lambda batches: _sharded(batches, length, shard_words, *sent.value),
                            "lang string, phrase string, n long")
            .groupBy("lang", "phrase").agg(F.sum("n").alias("n")))


def sent_if_small(table: DataFrame) -> DataFrame:
    """``table`` (written; lang, phrase, n) with a broadcast hint if its rows and
    bytes are counted and few; beyond that the join shuffles both sides."""
    size = table.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("lang") + F.octet_length("phrase")).alias("bytes")).first()
    return F.broadcast(table) if size.rows <= SENT_ROWS and (size.bytes or 0) <= SENT_BYTES else table


def _word(i: int) -> Column:
    return F.get(F.split("phrase", " "), F.lit(i))


def _cut(l: str, r: str) -> Column:
    """The score of a cut: floor(1000000 a a / (l r)), exact."""
    return F.expr(f"""(cast({SCALE} AS decimal(7,0)) * (cast(a AS decimal(15,0)) * cast(a AS decimal(15,0))))
                      div (cast({l} AS decimal(15,0)) * cast({r} AS decimal(15,0)))""")


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 top: int = TOP, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The ``top`` phrases of two or three words per language; see
    ``op12_phrase_collocations`` for the columns."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNDEFINED)).alias("lang"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = kept_table(phrase_counts(rows, 1, shard_words=shard_words), "phrase-words")
    total = words.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = words.filter(F.col("n") >= min_count)
    word_bits = bit_set(frequent, _word_hash(F.col("phrase")))
    pairs = phrase_counts(rows, 2, word_bits, shard_words=shard_words).filter(F.col("n") >= min_count)
    pairs = kept_table(pairs, "phrase-pairs")
    pair_bits = bit_set(pairs, _pair_hash(_word_hash(_word(0)), _word_hash(_word(1))))
    triples = phrase_counts(rows, 3, word_bits, pair_bits, shard_words).filter(F.col("n") >= min_count)
    triples = kept_table(triples, "phrase-triples")

    def part(table: DataFrame, name: str, count: str) -> DataFrame:
        return sent_if_small(table).select("lang", F.col("phrase").alias(name), F.col("n").alias(count))

    single = kept_table(frequent, "phrase-frequent")
    two = (pairs.withColumnRenamed("n", "a").withColumns({"x": _word(0), "y": _word(1)})
           .join(part(single, "x", "l"), ["lang", "x"]).join(part(single, "y", "r"), ["lang", "y"])
           .withColumn("score", _cut("l", "r")))
    three = (triples.withColumnRenamed("n", "a")
             .withColumns({"x": _word(0), "z": _word(2), "xy": F.concat_ws(" ", _word(0), _word(1)),
                           "yz": F.concat_ws(" ", _word(1), _word(2))})
             .join(part(single, "x", "l1"), ["lang", "x"]).join(part(pairs, "yz", "r1"), ["lang", "yz"])
             .join(part(pairs, "xy", "l2"), ["lang", "xy"]).join(part(single, "z", "r2"), ["lang", "z"])
             .withColumns({"s1": _cut("l1", "r1"), "s2": _cut("l2", "r2")})
             .withColumn("cut", F.expr("""CASE WHEN s1 <= s2 THEN struct(l1 AS l, r1 AS r, s1 AS score)
                                          ELSE struct(l2 AS l, r2 AS r, s2 AS score) END""")))
    # The extensions of a pair: the triples it begins or ends.
    longest = (three.select("lang", F.explode(F.array("xy", "yz")).alias("phrase"), "a")
               .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = (two.join(longest, ["lang", "phrase"], "left")
            .filter(F.expr(f"longer IS NULL OR 100 * longer < {COVERED_PERCENT} * a"))
            .select("lang", "phrase", "a", "l", "r", "score")
            .unionByName(three.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")))
    # The best of each part of a language first, so that no task sorts all of them.
    best = [F.desc("score"), F.desc("a"), "phrase"]
    parts = Window.partitionBy("lang", "part").orderBy(*best)
    kept = (kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
            .withColumn("rank", F.row_number().over(parts)).filter(F.col("rank") <= top).drop("part", "rank"))
    order = Window.partitionBy("lang").orderBy(*best)
    return (kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .join(total, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                    F.col("total").alias("n"), "score"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the whole ``documents``."""
    return collocations(read(spark, sf_dir, "documents"))


ORACLE_SQL = f"""
WITH p AS (SELECT coalesce(lang, '{UNDEFINED}') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
g AS (SELECT lang, 1 AS k, unnest(ws) AS phrase FROM w UNION ALL
      SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w UNION ALL
      SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1),
                                            lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w),
f AS (SELECT lang, k, phrase, count(*) AS c FROM g GROUP BY ALL),
t AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS s FROM f WHERE k > 1 AND c >= {MIN_COUNT}),
cuts AS (SELECT c.lang, c.k, c.phrase, c.a, j, array_to_string(s[1:j], ' ') AS lp, array_to_string(s[j + 1:], ' ') AS rp
         FROM c, (VALUES (1), (2)) v(j) WHERE j < c.k),
s AS (SELECT cuts.*, fl.c AS l, fr.c AS r,
        CAST({SCALE}::HUGEINT * a * a // (fl.c::HUGEINT * fr.c) AS BIGINT) AS score
      FROM cuts JOIN f fl ON fl.lang = cuts.lang AND fl.phrase = lp AND fl.k = j
                JOIN f fr ON fr.lang = cuts.lang AND fr.phrase = rp AND fr.k = cuts.k - j),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
d AS (SELECT DISTINCT b.lang, b.phrase FROM b JOIN c ON c.k = 3 AND b.k = 2 AND c.lang = b.lang
      AND b.phrase IN (c.s[1] || ' ' || c.s[2], c.s[2] || ' ' || c.s[3]) AND 100 * c.a >= {COVERED_PERCENT} * b.a)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase,
       a, l, r, n, score
FROM b JOIN t ON t.lang = b.lang LEFT JOIN d ON d.lang = b.lang AND d.phrase = b.phrase WHERE d.phrase IS NULL
QUALIFY rank <= {TOP}
"""
