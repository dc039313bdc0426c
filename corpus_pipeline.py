"""Training-corpus pipeline: ``documents`` to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps; its result
is written as Parquet and read back as the next stage's ``docs``. All but the
last return the columns of ``documents``.

1. toxicity: documents predicted toxic go;
2. exact dedup: of equal texts the largest ``doc_id`` stays;
3. n-gram Jaccard join: of each group of near copies the smallest ``doc_id`` stays;
4. mixing: documents are taken 0, 1 or 2 times to meet the sources' targets;
5. packing: pieces of at most 2048 ids in as few sequences as can be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import exact_dedup, jaccard_join, mixing, packing, toxicity
from fleetlens.llm.common import load, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.score(docs, load(spark, sf_dir, "labels"))
    return scored.filter(F.col("__score") < 0.5).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Boosted trees and the tokenizer cannot be written in SQL; the stages are
#: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each written and reread."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
