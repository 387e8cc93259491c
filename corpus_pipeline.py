"""Cleans and packs a corpus: toxicity, language, near copies, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. The classifiers learn from the tables in
sf_dir, outside the folds that the queries hold out, and judge the docs given.
The Python workers live on from stage to stage, so all stages hand them short batches.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martworks.llm import language, toxicity
from martworks.llm.common import fold, ready, short_batches, staged, table
from martworks.llm.ngram_join import one_of_each
from martworks.llm.packing import pack
from martworks.llm.repeats import without_repeats


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores 0.5 or more go."""
    short_batches(spark)
    learn = fold("doc_id", 5) != 0
    pair = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn)
    return toxicity.not_toxic(docs, pair)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model rejects go: no letter, or a probability below the calibrated bound."""
    short_batches(spark)
    model = language.train(table(spark, sf_dir, "documents"), fold("doc_id", 5) != 0)
    return language.in_a_language(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles the one with the smallest id stays."""
    short_batches(spark)
    return one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 bytes and more that a smaller doc_id also holds."""
    short_batches(spark)
    return without_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    short_batches(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", drop_unknown_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("packing", pack_sequences),
]
# no stage can be written in SQL; the tests hold each against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads the written result of the one before."""
    docs = table(ready(spark), sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs)
    return docs
