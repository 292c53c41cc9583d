"""Corpus pipeline: quality, toxicity, near-duplicates, source mixing, tokens.

Each stage takes the rows that its predecessor kept, as a Parquet table read again.
Empty tables pass through; a null or empty text has quality 0 and goes in the first
stage; further columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.llm import bpe, catalog, mixing, quality, simhash_dedup, toxicity
from flowframe.llm.common import free_name, table

#: A document scores at least this to be kept (quality) or rejected (toxicity).
THRESHOLD = 0.7


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = catalog.learnable(table(spark, sf_dir, "labels"), catalog.QUALITY_FOLD)
    out = free_name(docs, "quality_score")
    scored = quality.score(docs, quality.train(docs, labels), out=out)
    return scored.where(F.col(out) >= THRESHOLD).drop(out)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    It learns from all labelled documents, those that an earlier stage rejected included;
    documents to judge without labels of both classes are an error.
    """
    labels = catalog.learnable(table(spark, sf_dir, "labels"), catalog.TOXIC_FOLD)
    out = free_name(docs, "toxic_score")
    net = toxicity.train(table(spark, sf_dir, "documents"), labels)
    if not net.trained and not docs.isEmpty():
        raise ValueError("the toxicity stage needs labelled documents of both classes")
    scored = toxicity.score(docs, net, out=out)
    return scored.where(F.col(out) < THRESHOLD).drop(out)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays."""
    return simhash_dedup.deduplicate(docs, shingle=3, distance=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, shuffled."""
    return mixing.mix(docs, seed=catalog.MIX_SEED).select(*[F.col(f"`{c}`") for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and the text decoded from them."""
    ids, decoded = free_name(docs, "ids"), free_name(docs, "decoded")
    return bpe.encode(docs, catalog.WORD_BPE, ids=ids, decoded=decoded)


STAGES = [
    ("quality classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("simhash near-dedup", near_duplicates),
    ("mixing sources", mix_sources),
    ("bpe encoding", encode),
]

#: The stages hold fitted classifiers and a tokenizer, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written and read again."""
    return catalog.staged(spark, sf_dir, STAGES)
