"""Operator 13: subword lattice likelihood.

The pieces and their scores come from an existing vocabulary file. A word's
lattice has an edge for every piece (and every single byte, by the vocabulary's
byte pieces) that matches it somewhere, so a word's probability is the sum over
all its segmentations. The forward recursion adds them in log space. Pieces
never reach over a word's start, so a text's probability is the product over
its words and its end, and every distinct word is computed once.

A piece's probability starts from the vocabulary's score (a merge rank r: Zipf
weight 1 / (r + ``ZIPF``)) and is learned from the training documents: each of
``ROUNDS`` rounds weights all segmentations of every distinct training word by
the probabilities so far (forward and backward), sums the expected counts, and
adds the vocabulary's weights as ``PRIOR`` pseudo-counts.

Words are counted over all documents. The words that fill most of the text, at
most ``FREQUENT``, go to every task; the others, each of which is rare, are
joined. No word or document is left out.

Nulls: a null text is empty: it has its end only. A null id counts as '' when
documents are dealt to training. Repeated rows are scored one by one, and count
again. Without training documents the vocabulary's weights decide alone. An
empty table gives none. Texts of any length are scored whole. Other columns are
not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlens.llm.common import kept_table, read, ship_package

FOLDS, HELD_FOLD = 7, 2
ZIPF = 2.7
PRIOR = 1000.0
ROUNDS = 2
FREQUENT = 200_000
#: Words counted together before they are handed on.
COUNTED_WORDS = 500_000
#: A word's start: in the vocabulary file, and here as a byte that no word holds.
SPACE_MARK, MARK = "▁", b" "
NEVER = -math.inf
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def vocabulary_path() -> str:
    """A subword vocabulary with scores, on every machine that has the public
    tokenizer files installed."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased; split at space, tab and the four line ends."""
    return text.translate(_LOWER).split()


def initial_scores(path: str) -> tuple[list[bytes], np.ndarray]:
    """The pieces as bytes, the end last, and the log of their normalised
    weights. Control pieces and pieces that join words are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weight: dict[bytes, float] = {}
    size = model.vocab_size()
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i) or SPACE_MARK in piece[1:]:
            continue
        key = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE_MARK, MARK.decode()).encode()
        rank = size if model.is_byte(i) else -model.get_score(i)
        weight[key] = weight.get(key, 0.0) + 1 / (rank + ZIPF)
    for b in range(256):  # a vocabulary without byte pieces
        weight.setdefault(bytes([b]), 1 / (size + ZIPF))
    pieces = sorted(weight)
    weights = np.array([weight[p] for p in pieces] + [1 / ZIPF])
    return pieces, np.log(weights / weights.sum())


class Lattice:
    """Segmentations of words into pieces with log probabilities."""

    def __init__(self, pieces: list[bytes], logs: np.ndarray):
        #: A piece to its log probability; a mere start of longer ones to 1.
        self.logs: dict[bytes, float] = {p[:j]: 1.0 for p in pieces for j in range(1, len(p))}
        self.logs.update(zip(pieces, logs.tolist()))
        self.number = {p: i for i, p in enumerate(pieces)}

    def forward(self, word: bytes) -> float:
        """The log of the summed probability of all segmentations."""
        exp, log1p, get, n = math.exp, math.log1p, self.logs.get, len(word)
        alpha = [NEVER] * (n + 1)
        alpha[0] = 0.0
        for i in range(n):
            here = alpha[i]
            for j in range(i + 1, n + 1):
                log = get(word[i:j])
                if log is None:
                    break
                if log <= 0:
                    x, y = here + log, alpha[j]
                    if y == NEVER:
                        alpha[j] = x
                    else:
                        alpha[j] = x + log1p(exp(y - x)) if x > y else y + log1p(exp(x - y))
        return alpha[n]

    def expected(self, word: bytes, times: float, out: dict[bytes, float]) -> None:
        """Adds the expected number of each piece in ``times`` occurrences."""
        exp, log1p, get, n = math.exp, math.log1p, self.logs.get, len(word)
        alpha, beta = [NEVER] * (n + 1), [NEVER] * (n + 1)
        alpha[0] = beta[n] = 0.0
        edges = []
        for i in range(n):
            here = alpha[i]
            for j in range(i + 1, n + 1):
                piece = word[i:j]
                log = get(piece)
                if log is None:
                    break
                if log <= 0:
                    edges.append((i, j, piece, log))
                    x, y = here + log, alpha[j]
                    if y == NEVER:
                        alpha[j] = x
                    else:
                        alpha[j] = x + log1p(exp(y - x)) if x > y else y + log1p(exp(x - y))
        total = alpha[n]
        for i, j, piece, log in reversed(edges):
            x, y = beta[j] + log, beta[i]
            out[piece] += times * exp(alpha[i] + x - total)
            if y == NEVER:
                beta[i] = x
            else:
                beta[i] = x + log1p(exp(y - x)) if x > y else y + log1p(exp(x - y))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n, c): occurrences in all and in the training texts."""
    def rows():
        for held, counted in counts.items():
            n = pa.array(counted.values(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(counted, pa.binary()).cast(pa.string()), n, pa.array([0] * len(n), pa.int64()) if held else n],
                names=["word", "n", "c"])
            counted.clear()

    counts = {True: Counter(), False: Counter()}
    for batch in batches:
        for text, held in zip(batch.column("text").cast(pa.binary()), batch.column("held_out").to_pylist()):
            counts[held].update(words_of(text.as_py()))
            if len(counts[held]) >= COUNTED_WORDS:
                yield from rows()
    yield from rows()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n, c) of ``docs`` (text, held_out)."""
    return (docs.select("text", "held_out").mapInArrow(_counted, "word string, n long, c long")
            .groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c")))


def learn(words: DataFrame, n_training: int, path: str, rounds: int = ROUNDS) -> tuple[list[bytes], np.ndarray]:
    """The pieces and their learned log probabilities, the end's last. The
    driver holds one number per piece of the vocabulary."""
    pieces, logs = initial_scores(path)
    prior = PRIOR * np.exp(logs)
    for _ in range(rounds):
        sent = words.sparkSession.sparkContext.broadcast((pieces, logs))

        def e_step(batches):
            lattice, out = Lattice(*sent.value), defaultdict(float)
            for batch in batches:
                for word, c in zip(batch.column("word").cast(pa.binary()).to_pylist(), batch.column("c").to_pylist()):
                    lattice.expected(MARK + word, c, out)
            yield pa.RecordBatch.from_arrays([pa.array([lattice.number[p] for p in out], pa.int64()),
                                              pa.array(out.values(), pa.float64())], names=["piece", "expected"])

        rows = (words.filter("c > 0").select("word", "c").mapInArrow(e_step, "piece long, expected double")
                .groupBy("piece").agg(F.sum("expected").alias("expected")).collect())
        counts = prior.copy()
        counts[-1] += n_training
        for r in rows:
            counts[r.piece] += r.expected
        # Rounded, so that the order of the sums above doesn't show.
        logs = np.round(np.log(counts / counts.sum()), 9)
    return pieces, logs


def _frequent(words: DataFrame, most: int) -> Column:
    """Holds for at most ``most`` words: those above a count, found from a
    histogram of rounded logarithms (some hundred rows)."""
    level = F.floor(F.log2("n") * 8)
    running = Window.orderBy(F.desc("level"))  # over the histogram
    fits = (words.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("k"))
            .withColumn("k", F.sum("k").over(running)).filter(F.col("k") <= most).agg(F.min("level")).first()[0])
    return F.lit(False) if fits is None else level >= fits


def score_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                rounds: int = ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs``; see ``op13_lattice_likelihood`` for the
    columns. ``path`` names a vocabulary file with scores."""
    spark = docs.sparkSession
    ship_package(spark)
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    held = F.crc32(key.cast("binary")) % FOLDS == HELD_FOLD
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       held.alias("held_out"))
    words = kept_table(count_words(rows), "lattice-words")
    n_training = rows.filter(~F.col("held_out")).count()
    known = words.filter("c > 0").agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    total, distinct = known.n + n_training, known.v + (n_training > 0)
    pieces, logs = learn(words, n_training, path or vocabulary_path(), rounds)
    model = spark.sparkContext.broadcast((pieces, logs))
    floor = math.log10(total + distinct + 1)

    def of_words(batches):
        lattice = Lattice(*model.value)
        for batch in batches:
            score = [lattice.forward(MARK + w) / math.log(10) for w in batch.column("word").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())],
                                             names=["word", "n", "c", "score"])

    scored = kept_table(words.mapInArrow(of_words, "word string, n long, c long, score double")
                        .withColumn("base", F.log10(F.col("c") + 1) - F.lit(floor)), "lattice-scores")
    often = _frequent(words, frequent)
    top = {r.word.encode(): (r.c > 0, r.base, r.score)
           for r in scored.filter(often).select("word", "c", "base", "score").collect()}
    sent = spark.sparkContext.broadcast(top)
    end = (n_training > 0, math.log10(n_training + 1) - floor, float(logs[-1]) / math.log(10))

    def of_texts(batches):
        get = sent.value.get
        for batch in batches:
            out = []
            for text in batch.column("text").cast(pa.binary()):
                words = words_of(text.as_py())
                n_known, base, score = end
                rare = []
                for w, k in Counter(words).items():
                    hit = get(w)
                    if hit is None:
                        rare.append({"word": w, "k": k})
                    else:
                        known, b, s = hit
                        n_known += k * known
                        base += k * b
                        score += k * s
                out.append((len(words) + 1, int(n_known), base, score, rare))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), batch.column("held_out"),
                 *[pa.array([o[j] for o in out], t) for j, t in enumerate(
                     [pa.int64(), pa.int64(), pa.float64(), pa.float64()])],
                 pa.array([o[4] for o in out], pa.list_(pa.struct([("word", pa.string()), ("k", pa.int64())])))],
                names=["row", "id", "held_out", "n_tokens", "n_known", "base", "score", "rare"])

    id_type = docs.schema[id_col].dataType.simpleString()
    partial = kept_table(
        rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            of_texts, f"row long, id {id_type}, held_out boolean, n_tokens long, n_known long, base double, "
                      "score double, rare array<struct<word: string, k: long>>"), "lattice-texts")
    others = (partial.select("row", F.inline("rare"))
              .join(scored.filter(~often).select("word", "c", F.col("base").alias("b"), F.col("score").alias("s")), "word")
              .groupBy("row").agg(F.sum(F.expr("if(c > 0, k, 0L)")).alias("more"), F.sum(F.expr("k * b")).alias("b"),
                                  F.sum(F.expr("k * s")).alias("s")))
    none = F.lit(0)
    return partial.drop("rare").join(others, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", none)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("b", none)).alias("base_score"),
        (F.col("score") + F.coalesce("s", none)).alias("score"))


def op13_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    (log10) of all ``documents``."""
    return score_texts(read(spark, sf_dir, "documents"))
