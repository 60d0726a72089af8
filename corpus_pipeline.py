"""A corpus pipeline of operators from ledgermill.llm, stage by stage over whole tables.

Stages take tables with nulls in any column, repeated rows and ids, extra columns of any name, or no rows (then none come
out); all but the last keep the columns. What a stage makes of odd rows stands with it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgermill.llm import exact_dedup, langid, mixing, ngram_join, packing
from ledgermill.llm.common import alone, dropped, saved, table  # noqa: F401

#: No SQL: the stages train a classifier, hash shingles and run a tokenizer.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without letters (null and empty ones too), or that look like no learned language, go. Rows without
    an id or a language are judged by their text like all others; repeated rows stay or go together."""
    return langid.accepted(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the document with the smallest id stays, null ids last; of rows equal in id too, one."""
    return exact_dedup.deduplicated(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of linked documents the one with the smallest id stays. Rows without an id, and texts
    without words, stay."""
    return ngram_join.representatives(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: documents in training order, repeated or cut as their source's target asks. A null
    source is a source, the last; a document without words has no place in the mix. A cut row's n_chars is its own."""
    return mixing.trained(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the documents' tokens as pieces of training windows, with their ids. Each row is packed for itself, so the copies
    that mixing makes are too; a null text is empty."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [("language ID", known_language), ("exact dedup", without_copies), ("n-gram Jaccard join", without_near_copies), ("mixing", mixed), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents, each one's result written and read again. What a stage was made from goes then."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, alone(spark, lambda: stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if k:
            dropped(before)
    return docs
