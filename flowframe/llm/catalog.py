"""Queries over the driver's tables, one per operator, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.llm import bpe, decontaminate, fingerprints, html_text, mixing, periodic, quality, simhash_dedup, spelling, token_counts, topk, toxicity, url_filter
from flowframe.llm.common import fold, ship, table
from flowframe.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = build
    return build


#: Places of the public vocabularies (parameters of the operators).
WORD_PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: Folds whose labels are never learned from: (folds, the one held out).
TOXIC_FOLD, QUALITY_FOLD = (3, 1), (4, 2)


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy longest-match pieces of every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, token_counts.sentencepiece_pieces(WORD_PIECES)).select("doc_id", "n_words", "n_tokens")


@query
def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every whole text, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, WORD_BPE, decoded="decoded")
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def learnable(labels: DataFrame, folds: tuple[int, int]) -> DataFrame:
    """Labels outside the held-out fold."""
    return labels.where(fold(F.col("doc_id"), folds[0]) != folds[1])


def judged(scored: DataFrame, folds: tuple[int, int]) -> DataFrame:
    return scored.select("doc_id", (fold(F.col("doc_id"), folds[0]) == folds[1]).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(toxicity.train_and_score(docs, learnable(table(spark, sf_dir, "labels"), TOXIC_FOLD)), TOXIC_FOLD)


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, learnable(table(spark, sf_dir, "labels"), QUALITY_FOLD))
    return judged(quality.score(docs, model), QUALITY_FOLD)


@query
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract_pages(table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.char_length("text").cast("bigint"))


@query
def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth vector against all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


SQL["op3_exact_top_k"] = topk.ORACLE

@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rules over every page's url."""
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), url_filter.rules_table(spark, url_filter.RULES))


SQL["op5_url_filter"] = url_filter.ORACLE

@query
def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts and their edited texts; other documents within 3 bits."""
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"), radius=3)


MIX_SEED = 11


@query
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Square-root damped source weights, one expected pass over the corpus."""
    return mixing.mix(table(spark, sf_dir, "documents"), seed=MIX_SEED)


SQL["op8_mix_sources"] = mixing.ORACLE


@query
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word 3-shingles, links at 3 or fewer differing bits."""
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)


def contamination_digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Windows of ten words; ``n_near`` items have a window with at most one other word in it."""
    found = decontaminate.contamination(docs, items, window=10, slop=1)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
                        F.size("near_items").cast("bigint").alias("n_near"))


@query
def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    return contamination_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op11_benchmark_decontamination"] = decontaminate.ORACLE


def run_digests(docs: DataFrame) -> DataFrame:
    """Runs of the edited texts, the longest one, and digests of the runs and of what is left."""
    edited = docs.select("doc_id", periodic.repeat_tail(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic.find_runs(edited).withColumn("best", periodic.longest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
                        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least 24 words and three periods in every whole text."""
    return run_digests(table(spark, sf_dir, "documents"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of six letters and five occurrences in all whole texts."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


SQL["op12_spelling_variants"] = spelling.ORACLE


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def staged(spark: SparkSession, sf_dir: str, stages: list) -> DataFrame:
    """Apply ``stages`` to ``documents``; every result is a Parquet table in the shared
    checkpoint folder, which the next stage reads."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stages-{uuid.uuid4().hex}"
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(stages):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
