"""A training corpus from ``documents``: five stages, each over all that the one before kept.

Toxic documents go; repeated lines go, and with them documents that consist of nothing else; of near
duplicates one document stays; documents that leak benchmark items go; what is left is tokenized.

In every stage a null text counts as empty, a null id is an id like any other, further columns travel along
whatever they are called, texts may be of any length, and an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweft.llm import bpe, leaks, lines, simhash, tables, toxicity
from logweft.sources.scratch import settle


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a toxicity score under 0.5, by a model learned from the labelled training rows.

    Repeated rows score alike; a score of just 0.5 rejects.
    """
    model = toxicity.Model.fit(toxicity.training_rows(docs, tables.read(spark, sf_dir, "labels")))
    return toxicity.without_toxic(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document, or an earlier place, has alike.

    Earlier is by id, nulls first, then by place; documents that share an id come in the order of their
    texts' hashes, and repeated rows lose the same lines.  Empty documents stay as they are.
    """
    kept = lines.without_copies(docs)
    return kept.withColumn("n_chars", F.length("text")) if "n_chars" in docs.columns else kept


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id.

    Null ids come last, ties go by text hash, and of equal rows one stays.  Texts without words are alike.
    """
    tables.ship(spark)
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; repeated rows stay or go together."""
    return leaks.without_leaks(docs, tables.read(spark, sf_dir, "benchmark"))


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each document; an empty text has no tokens."""
    tables.ship(spark)
    return bpe.digests(tables.texts(docs))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", tokenization),
]

#: Model fitting, signatures and merges have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again for the next."""
    docs = tables.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
