"""Corpus preparation: quality, toxicity, near-duplicates, repeated passages, packing.

``STAGES`` is a list of (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is
stored as Parquet and read again as the next one's docs.  All stages but the last return the columns of ``documents``.

The classifiers are fitted on labelled rows of the original documents (see ``churnlens.llm.labelled`` for the bound and
for the rows that are never learnt from).  A null text is scored as the empty text and passes on as it is.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from churnlens.llm import minhash, packing, quality, substring_dedup, toxicity
from churnlens.llm.textops import saved

GOOD = 0.7  # documents below this quality score go
TOXIC = 0.3  # documents from this toxicity score on go


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    model = quality.fit(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model, GOOD)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar doesn't reject."""
    model = toxicity.fit(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model, TOXIC)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.drop_near_duplicates(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller doc_id has."""
    return substring_dedup.drop_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("near-duplicates", near_dedup_stage),
    ("substring dedup", substring_dedup_stage),
    ("packing", packing_stage),
]

#: No SQL states the classifiers' fits or the tokenizer; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each stored in the shared folder."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
