"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept. ``run`` writes every stage's rows as Parquet to the shared checkpoint
folder and reads them again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm import mixing, ngram_join, packing, quality, secrets
from roadlens.llm.common import kept_table, read


#: Target weights of the mix by source; None: operator 1's own.
MIX_WEIGHTS: dict | None = None
#: The column that carries a document's place in the mix to the packing, with
#: as many underscores behind it as set it apart from the table's own columns.
MIX_POSITION = "mix_position"


def position_columns(docs: DataFrame) -> list[str]:
    """The columns named like the place in the mix, the latest given last."""
    return sorted((c for c in docs.columns if c.lower().rstrip("_") == MIX_POSITION), key=len)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: rejected documents go."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def ngram_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of linked documents the one of least id stays."""
    return ngram_join.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: secrets are masked in the text; n_chars follows it."""
    masked = secrets.mask_secrets(docs)
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: all documents, with their place in the mix."""
    taken = position_columns(docs)
    return mixing.with_position(docs, f"{taken[-1]}_" if taken else MIX_POSITION, weights=MIX_WEIGHTS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the pieces of the documents and their places in sequences,
    which follow the mix where the documents carry it."""
    return packing.pack(docs, order_col=next(reversed(position_columns(docs)), None))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_dedup", ngram_dedup),
    ("mask_secrets", mask_secrets),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Token ids and the quality model are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
