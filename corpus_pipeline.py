"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return the
columns of documents, so that every decision shows as rows that stay, go or repeat:

1. toxicity: documents that the classifier rejects go (fitted on all labelled documents).
2. exact_dedup: of equal texts (A-Z lower-cased) the one with the largest doc_id stays.
3. simhash_dedup: of each component of near copies the one with the smallest doc_id stays.
4. mixing: a document that the mix takes n times appears n times; one not taken goes.
5. best_fit_packing: pieces with their places in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faregrid.llm import exact_dedup, mixing, packing, simhash_dedup, toxicity
from faregrid.llm.common import materialize
from faregrid.llm.queries import table, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below the threshold. Texts without words and documents without an id stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased, null as empty) the row with the largest id; see ``exact_dedup.keep_one``."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the row with the smallest id; see ``simhash_dedup.keep_one``."""
    return simhash_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; documents without words have nothing to give and go."""
    return mixing.repeat_taken(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its place; documents without text have a piece of one id; see ``packing.pack``."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# Fitted weights, XXH64 fingerprints and a tokenizer are beyond SQL: tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs


