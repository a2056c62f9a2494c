"""Operator 4: best-fit packing by exact-complement hashing.

Texts become token ids, cut into pieces of at most ``size`` tokens. Only the
lengths matter for packing, and there are at most ``size`` of them: the whole
corpus is summed to a count per length, and the plan is made on these counts.
From the longest length down, a gap is looked up among single lengths, sums of
two and sums of three; combinations that fill it exactly are consumed as often
as the counts allow. What finds no exact complement is filled best-fit, the
largest length that fits first. A plan row says that the pieces of a length
with ranks from..to go to certain sequences at a certain offset; each piece
finds its row by its rank among the pieces of its length. Ranks are counted in
hash buckets, so a length that a third of all pieces share stays distributed.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm.common import grouped_rank, kept_table, read, ship_package, stable_hash

SIZE = 1024
END_ID = 2
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
CACHED_PIECES = 300_000

#: The vocabulary's word pattern, for texts of ASCII and Latin-1 letters only.
LATIN_TEXT = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
_S, _L = "\t-\r ", "A-Za-zÀ-ÖØ-öø-ÿ"
LATIN_WORD = re.compile(
    f"'(?:[sdmt]|ll|ve|re)| ?[{_L}]+| ?[0-9]+| ?[^{_S}{_L}0-9]+|[{_S}]+(?![^{_S}])|[{_S}]+")


def vocabulary_path() -> str:
    """The rank file of the byte-level vocabulary ``byte_bpe_50k.json``, on
    every machine that has the public tokenizer files installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder(dict):
    """Token ids as little-endian bytes; equal to the ids of the ``tokenizers``
    library without special tokens added. A dict from word to its bytes, so
    that frequent words are encoded once; at most ``CACHED_PIECES`` are kept."""

    _loaded: dict = {}

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})

    @classmethod
    def load(cls, path: str) -> "Encoder":
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.encoding.encode_ordinary(word), "<u4").tobytes()
        if len(self) < CACHED_PIECES:
            self[word] = ids
        return ids

    def ordinary(self, text: str) -> bytes:
        if LATIN_TEXT.fullmatch(text):
            return b"".join(map(self.__getitem__, LATIN_WORD.findall(text)))
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        special = np.array([SPECIAL_ID], "<u4").tobytes()
        return special.join(self.ordinary(part) for part in text.split(SPECIAL))


def tokenise(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
             end_id: int = END_ID, path: str | None = None, order_col: str | None = None) -> DataFrame:
    """The pieces of every document: ``__id``, piece, start, length, ids_crc32
    and, where ``order_col`` names a column, its value as ``__order``. A null
    text is empty; a longer document's first piece holds the remainder."""
    ship_package(docs.sparkSession)
    path = path or vocabulary_path()
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"),
                       *([F.col(order_col).cast("long").alias("__order")] if order_col else []))
    end = np.array([end_id], "<u4").tobytes()

    def batches(it):
        encoder = Encoder.load(path)
        for batch in it:
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = encoder.encode(text.as_py() or "") + end
                n = len(ids) // 4
                at = 0
                while at < n:
                    to = at + ((n % size or size) if at == 0 else size)
                    row.append(i)
                    piece.append(-(-at // size))
                    start.append(at)
                    length.append(to - at)
                    crc.append(zlib.crc32(ids[4 * at:4 * to]))
                    at = to
            of = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(of), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                 *([batch.column(2).take(of)] if order_col else [])],
                ["__id", "piece", "start", "length", "ids_crc32", *(["__order"] if order_col else [])])

    kind = rows.schema["__id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"__id {kind}, piece int, start long, length long, ids_crc32 long"
                           + (", __order long" if order_col else ""))


def exact_fill(left: np.ndarray, gap: int) -> tuple[int, ...]:
    """One, two or three available lengths that sum to ``gap``, longest first;
    empty if there are none."""
    if gap <= 0:
        return ()
    if left[gap]:
        return (gap,)
    have = left > 0
    for most, parts in ((gap - 1, 2), (gap - 2, 3)):
        for a in np.flatnonzero(have[:most + 1])[::-1]:
            rest = gap - int(a)
            if parts == 2:
                found = [rest] if have[rest] else []
            else:
                both = np.flatnonzero(have[1:rest] & have[rest - 1:0:-1])
                found = [int(both[-1]) + 1, rest - int(both[-1]) - 1] if both.size else []
            if found and copies(left, (int(a), *found)) > 0:
                return (int(a), *found)
    return ()


def copies(left: np.ndarray, lengths: tuple[int, ...]) -> int:
    """How often all of ``lengths`` can be taken together."""
    return min(int(left[x]) // lengths.count(x) for x in set(lengths))


def plan(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths, how many such sequences). Each step uses up a
    length, so there are a few rows per length whatever the counts are."""
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out = []

    def use(lengths, n):
        for x in lengths:
            left[x] -= n
        out.append((lengths, n))

    for longest in range(size, 0, -1):
        while left[longest]:
            left[longest] -= 1  # the sequence's own piece, while its complement is looked up
            fill = exact_fill(left, size - longest)
            left[longest] += 1
            if not fill and longest < size:  # best fit: the largest that fits, until nothing does
                taken, gap = [longest], size - longest
                left[longest] -= 1
                while gap > 0 and (fits := np.flatnonzero(left[:gap + 1])).size:
                    x = int(fits[-1])
                    taken.append(x)
                    left[x] -= 1
                    gap -= x
                    if (rest := exact_fill(left, gap)):
                        taken += rest
                        for y in rest:
                            left[y] -= 1
                        gap = 0
                for x in taken:
                    left[x] += 1
                use(tuple(taken), max(1, copies(left, tuple(taken))))
            else:
                use((longest, *fill), max(1, copies(left, (longest, *fill))))
    return out


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
         end_id: int = END_ID, path: str | None = None, order_col: str | None = None) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id and
    offset. Every row of ``docs`` is packed, also those that repeat an id; an
    empty table gives no rows.

    Pieces of a length are taken in a hash order. With ``order_col`` (places
    from 0, not null) they are taken in that order instead, and sequences are
    numbered by the earliest place they hold."""
    pieces = kept_table(tokenise(docs, id_col=id_col, text_col=text_col, size=size, end_id=end_id, path=path,
                                 order_col=order_col), "pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= size rows
    used = dict.fromkeys(counts, 0)
    rows, sequence = [], 0
    for lengths, n in plan(counts, size):
        offset = 0
        for x in lengths:
            rows.append((x, used[x], used[x] + n, sequence - used[x], offset))
            used[x] += n
            offset += x
        sequence += n
    table = docs.sparkSession.createDataFrame(
        rows, "length long, from_rank long, to_rank long, shift long, offset long").coalesce(1)
    if order_col:  # places spread over the 60 bits that ranks are counted in
        last = pieces.agg(F.max("__order")).first()[0] or 0
        hashed = F.col("__order") * F.lit(2**60 // (last + 1))
    else:
        hashed = stable_hash(F.col("__id"), F.col("piece"))
    ranked = grouped_rank(pieces.withColumn("__hash", hashed), "length", "__hash", ["__id", "piece"], "__rank")
    at = (ranked.join(F.broadcast(table), "length").filter("__rank >= from_rank AND __rank < to_rank")
          .withColumn("__sequence", F.col("__rank") + F.col("shift")))
    if order_col:
        at = kept_table(at.select("__id", "piece", "start", "length", "ids_crc32", "__sequence", "offset", "__hash"), "placed")
        first = at.groupBy("__sequence").agg(F.min("__hash").alias("__hash")).withColumn("__all", F.lit(0))
        numbered = grouped_rank(first, "__all", "__hash", ["__sequence"], "sequence_id", rows_per_bucket=2_000)
        at = at.join(numbered.select("__sequence", "sequence_id"), "__sequence")
    else:
        at = at.withColumn("sequence_id", F.col("__sequence"))
    return at.select(F.col("__id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
