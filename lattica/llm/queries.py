"""The queries of this subpackage: each operator over its whole table, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm import bpe, lm_scoring, oracles, packing, quality_classifier, quality_rules, secrets, simhash, topk, toxicity, warc
from lattica.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    vocab = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(table(spark, sf_dir, "documents"), vocab, public_tokenizers.PATTERN)
    out = bpe.decode(ids, vocab, public_tokenizers.PATTERN)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows for every vector whose id is divisible by 20, against all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, packed into sequences of 1024."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, end_id=2, capacity=1024, special=bpe.added_tokens(public_tokenizers.path("byte_bpe_50k.json")))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, seed=42, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probability of every document."""
    return quality_classifier.graded(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and linked secret spans of every document."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select(
        "own.doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in secrets.BASE],
        F.sha2(secrets.written(base), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    found = quality_rules.judged(table(spark, sf_dir, "documents"))
    return found.select("own.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, normalised and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document; learnt from all but those of fold 2 of 7."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 7) == 2
    model, counts = lm_scoring.train_model(docs, ~held_out)
    return lm_scoring.score(docs, model, counts).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")


QUERIES: dict[str, Query] = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_warc_round_trip": op4_warc_round_trip,
    "op5_toxicity": op5_toxicity,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_secret_scan": op8_secret_scan,
    "op9_quality_rules": op9_quality_rules,
    "op10_lm_scoring": op10_lm_scoring,
}

ORACLES: dict[str, str] = {"op2_exact_top_k": oracles.OP2, "op4_warc_round_trip": oracles.OP4, "op8_secret_scan": oracles.OP8, "op9_quality_rules": oracles.OP9}
