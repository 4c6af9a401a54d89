"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregrid.llm import (embedding_dedup, exact_dedup, language_id, license_scan, lm, mixing, packing, simhash_dedup, substring_dedup, token_alignment,
                          toxicity, turn_repair, url_filter)
from faregrid.llm.common import fold
from faregrid.llm.oracles import ORACLES  # noqa: F401

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 3) == 1
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "n_sentences", F.transform("offending", lambda s: s["sentence"]).alias("offending"),
    )


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_tables(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_by_source(table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = fold("doc_id", 10)
    scored = lm.score(docs, part != 0, part == 1)
    return scored.select(
        "doc_id", (part == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("repeats")


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.scan(table(spark, sf_dir, "documents")))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turn_repair.repair_all(turns, turn_repair.damage(turns))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_and_score(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_TOKENIZER))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_toxicity, op2_url_filters, op3_language_id, op4_best_fit_packing, op5_exact_dedup, op6_mixing, op7_lm_scoring,
              op8_embedding_dedup, op9_substring_dedup, op10_simhash_dedup, op11_license_scan, op12_turn_repair, op13_token_alignment)
}
