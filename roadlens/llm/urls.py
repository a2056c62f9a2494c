"""Operator 6: URL filters.

Rules (host and path prefix) decide where one fits, the longest first. For all
other pages a logistic regression on hashed character n-grams of host and path
decides, trained from a small labelled URL table (at most ``LABELLED_ROWS``
rows of it). Features and scoring are DataFrame functions and Spark ML.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm.common import ascii_lower, read

#: Fixed rules: (host/path, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
PARTS = "://([^/?#]*)([^?#]*)"
FEATURES = 1 << 12
GRAMS = (3, 4)
REGULARISATION = 0.01
LABELLED_ROWS = 10_000
#: Fixed labelled table: 1 marks a page to block.
LABELLED = (
    ("https://www.example.com/en/1042", 0), ("https://blog.example.org/en/77", 0), ("http://news.example.com/es/310", 0),
    ("https://docs.example.org/de/12.html", 0), ("https://m.example.com/fr/998", 0), ("http://shop.example.com/en/5/", 0),
    ("https://library.example.org/en/2024", 0), ("https://wiki.example.com/en/871.html", 0),
    ("http://weather.example.org/es/64", 0), ("https://school.example.com/en/430", 0),
    ("https://museum.example.org/de/155", 0), ("https://travel.example.com/es/703", 0),
    ("https://spam-farm.example.org/en/17", 1), ("http://spam-farm.example.com/de/903", 1),
    ("https://cheap-pills.example.com/en/55", 1), ("https://www.cheap-pills.example.org/es/610", 1),
    ("https://casino-bonus.example.com/en/3", 1), ("http://free-casino.example.org/en/88.html", 1),
    ("https://hot-singles.example.com/en/419", 1), ("http://xxx-videos.example.org/es/72", 1),
    ("https://adult-cams.example.com/en/240", 1), ("http://win-prizes.example.org/en/free-money", 1),
    ("https://replica-watches.example.com/en/cheap", 1), ("http://payday-loans.example.org/en/cash", 1),
)


def with_parts(pages: DataFrame, url: str) -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; empty without ``://``."""
    part = [F.coalesce(F.regexp_extract(url, PARTS, i), F.lit("")) for i in (1, 2)]
    return pages.withColumn("host", ascii_lower(part[0])).withColumn("path", part[1])


def rule_of(rules) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path``, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def grams(part: str, mark: str, n: int) -> Column:
    """Character n-grams of a part with its ends marked."""
    text = f"concat('^', {part}, '$')"
    return F.expr(f"""CASE WHEN length({text}) >= {n} THEN transform(sequence(1, length({text}) - {n - 1}),
        i -> concat('{mark}', substring({text}, i, {n}))) ELSE cast(array() AS array<string>) END""")


def with_features(parts: DataFrame) -> DataFrame:
    """Adds the hashed n-gram vector ``features`` of ``host`` and ``path``."""
    every = F.concat(*[grams(part, mark, n) for part, mark in (("host", "h"), ("path", "p")) for n in GRAMS])
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="__grams", outputCol="features").transform(
        parts.withColumn("__grams", every)).drop("__grams")


def train(labelled: DataFrame, *, url_col: str = "url", label_col: str = "block") -> LogisticRegressionModel | None:
    """The classifier, fitted to at most ``LABELLED_ROWS`` rows of ``labelled``
    (in url order); None if they don't hold both labels."""
    rows = (labelled.select(F.col(url_col).alias("url"), F.col(label_col).cast("double").alias("label"))
            .filter("label IN (0, 1)").orderBy("url", "label").limit(LABELLED_ROWS).coalesce(1))
    if rows.select("label").distinct().count() < 2:
        return None
    return LogisticRegression(regParam=REGULARISATION, maxIter=50, standardization=False).fit(
        with_features(with_parts(rows, "url")).select("features", "label"))


def filter_urls(pages: DataFrame, model: LogisticRegressionModel | None, *, id_col: str = "page_id",
                url_col: str = "url", rules=RULES, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict and ``score``
    (the classifier's chance of block). Null urls and urls without ``://`` have
    empty parts and no rule; without a model what no rule fits is allowed;
    repeated rows are judged alike."""
    rows = with_parts(pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url")), "__url")
    rule, says = rule_of(rules)
    if model is None:
        scored = rows.withColumn("score", F.lit(0.0))
    else:
        model = model.setFeaturesCol("features")
        scored = model.transform(with_features(rows)).withColumn("score", vector_to_array("probability")[1])
    return scored.select(F.col("__id").alias(id_col), "host", "path", rule.alias("rule"),
                         F.coalesce(says, F.when(F.col("score") >= threshold, "block").otherwise("allow"))
                         .alias("verdict"), "score")


def labelled_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LABELLED), "url string, block int")


def op6_url_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"), train(labelled_table(spark)))
