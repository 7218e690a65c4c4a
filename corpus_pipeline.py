"""The corpus pipeline: five stages over documents, each written as Parquet and read again.

1. Documents whose language is not recognised go.
2. Later copies of line runs that repeat in the corpus are deleted; emptied documents go.
3. One document of each near-duplicate group stays.
4. Sources are mixed to their target weights; documents repeat or go as the mix asks.
5. The mix is packed into sequences.

Stages 1 to 4 return the columns they are given. Null texts and texts without a letter go in stage 1;
empty tables pass. Texts of any length are read whole, and stage 4 gives or leaves out whole
documents. Repeated rows are one document in stage 2 (same id and text) and go in stage 3; of a group
of near copies the smallest id stays.

Stage 1 bounds the batches that go to Python workers (``shared.bound_batches``) for the session.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from windrow.llm import langid, linededup, minhash, mixing, packing
from windrow.llm.shared import bound_batches, table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return langid.accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.representatives(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [(f.__name__, f) for f in (language_id, line_dedup, near_dedup, source_mix, best_fit_packing)]

# A trained network, a tokenizer and hash orders decide: no SQL form. The tests hold the stages
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
