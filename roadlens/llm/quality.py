"""Operator 7: quality rules, and a hashed n-gram likelihood ratio.

Word unigrams and bigrams are hashed to ``BUCKETS`` multinomial cells. A
document's score is the mean, over its n-grams, of the log ratio between the
trusted-target and the raw-corpus model. The raw model counts every document;
the target model counts the trusted rows of the label table (at most
``TRUSTED_ROWS`` of them, taken in hash order). The ratio of a cell is
``ln((c + PRIOR) / (e + PRIOR))``, c the target count and e the count expected
from the raw model: cells with little evidence say nothing. Ratios are rounded
to 1/10,000 and summed as integers, so every document's score and verdict are
the same in any partitioning.

Only DataFrame functions. The model is one row of ``BUCKETS`` integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm.common import read, stable_hash

SPACE = " \t\n\x0b\f\r"
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
BUCKETS = 1 << 16
TRUSTED_ROWS = 20_000
PRIOR = 10.0
SCALE = 10_000
#: A document is dropped when its mean log ratio lies below this.
THRESHOLD = -0.2


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t-\\r]+", -1), lambda w: w != "")


def pairs(hashes: str, apart: int) -> Column:
    """The joint hashes of the entries that lie ``apart`` from each other."""
    n = f"greatest(0, size({hashes}) - {apart})"
    return F.expr(f"""zip_with(slice({hashes}, 1, {n}), slice({hashes}, {apart + 1}, {n}),
                      (a, b) -> xxhash64(a, b))""")


def hashed(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``words``, their hashes ``uni`` and the hashes ``bi`` of
    neighbouring pairs."""
    return (docs.withColumn("words", words_of(F.col(text)))
            .withColumn("uni", F.expr("transform(words, w -> xxhash64(w))"))
            .withColumn("bi", pairs("uni", 1)))


def with_base(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``n_words`` and the base figures to what ``hashed`` gives."""
    t = F.col(text)
    lines = F.filter(F.split(t, "\n", -1), lambda s: F.btrim(s, F.lit(SPACE)) != "")
    # An 8-word window is four word pairs. One that occurs again repeats five
    # 4-word windows, so most texts are done after those.
    out = (docs.withColumn("n_words", F.size("words").cast("long"))
           .withColumn("lines", lines)
           .withColumn("fours", pairs("bi", 2))
           .withColumn("near", F.expr("size(fours) - size(array_distinct(fours)) >= 5"))
           .withColumn("windows", F.when(F.col("near"), pairs("fours", 4)))
           .withColumn("again", F.expr("coalesce(size(array_distinct(windows)) < size(windows), false)")))
    out = out.withColumn("sorted", F.expr(
        "CASE WHEN again THEN array_sort(transform(windows, (h, i) -> named_struct('h', h, 'i', i))) END"))
    out = out.withColumn("places", F.expr("""array_sort(transform(filter(sorted, (s, j) ->
        s.h = get(sorted, j - 1).h OR s.h = get(sorted, j + 1).h), s -> s.i))"""))
    covered = F.expr(f"""CASE WHEN again THEN aggregate(places, named_struct('sum', 0L, 'end', 0),
        (a, p) -> named_struct('sum', a.sum + {REPEAT_WINDOW} - greatest(0, a.end - p), 'end', p + {REPEAT_WINDOW}),
        a -> a.sum) ELSE 0L END""")
    return (out.withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
            .withColumn("n_symbols", F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long"))
            .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
            .withColumn("n_repeat_words", covered)
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))))


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality",
                most: int = TRUSTED_ROWS) -> DataFrame:
    """Ids of trusted rows (``quality`` 1), ``most`` in hash order."""
    return (labels.select(F.col(id_col).alias("__trusted"), F.col(quality_col).alias("__q"))
            .filter("__q = 1 AND __trusted IS NOT NULL").select("__trusted").distinct()
            .orderBy(stable_hash(F.col("__trusted")), "__trusted").limit(most))


def fit(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The model: one row, ``model`` an array of ``BUCKETS`` scaled log ratios.
    Counts all of ``docs``. Without trusted rows every ratio is zero."""
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    # At most TRUSTED_ROWS ids.
    flagged = rows.join(F.broadcast(trusted.withColumn("__good", F.lit(1))),
                        F.col("__id") == F.col("__trusted"), "left")
    counted = (hashed(flagged, "__text")
               .select("__good", F.explode(F.concat("uni", "bi")).alias("h"))
               .select("__good", F.expr(f"cast(pmod(h, {BUCKETS}) AS int)").alias("cell"))
               .groupBy("cell").agg(F.count(F.lit(1)).alias("raw"), F.sum("__good").alias("good")))
    spark = docs.sparkSession
    full = (spark.range(BUCKETS).select(F.col("id").cast("int").alias("cell")).join(counted, "cell", "left")
            .fillna(0, ["raw", "good"]))
    one = full.agg(F.sum("raw").alias("n_raw"), F.sum("good").alias("n_good"),
                   F.sort_array(F.collect_list(F.struct("cell", "raw", "good"))).alias("all"))
    return one.select(F.expr(f"""transform(all, c -> CASE WHEN n_good = 0 THEN 0 ELSE cast(round({SCALE} *
        ln((c.good + {PRIOR}D) / (c.raw * (cast(n_good AS double) / n_raw) + {PRIOR}D))) AS int) END)""").alias("model"))


def assess(docs: DataFrame, model: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           threshold: float = THRESHOLD, carry: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id, the base figures, ``score`` and
    ``kept``. A null text counts as empty (it fails the base rule). ``carry``
    names a column to keep."""
    more = [carry] if carry else []
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"), *more)
    scored = (with_base(hashed(rows, "__text"), "__text").withColumn("model", model.scalar()))
    total = F.expr(" + ".join(f"aggregate({x}, 0L, (a, h) -> a + model[cast(pmod(h, {BUCKETS}) AS int)])"
                              for x in ("uni", "bi")))
    n = F.expr("size(uni) + size(bi)")
    scored = scored.withColumn("score", F.when(n > 0, total / (n * F.lit(float(SCALE)))))
    kept = ~F.col("base_failed") & (F.col("score") >= threshold)
    # A generator, so that no filter on the verdict is pushed into the steps above.
    return scored.select(F.inline(F.array(F.struct(
        F.col("__id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", kept.alias("kept"), "score", *more))))


def quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
            threshold: float = THRESHOLD) -> DataFrame:
    """Base rules and likelihood-ratio verdict of every row of ``docs``; see
    ``assess``. Repeated rows are judged alike; an empty table gives none."""
    model = fit(docs, trusted_ids(labels), id_col=id_col, text_col=text_col)
    return assess(docs, model, id_col=id_col, text_col=text_col, threshold=threshold)


def keep_good(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns."""
    model = fit(docs, trusted_ids(labels), id_col=id_col, text_col=text_col)
    packed = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"),
                         F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    judged = assess(packed, model, id_col="__id", text_col="__text", carry="__row")
    return judged.filter("kept").select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns])


def op7_target_ratio_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
