"""A corpus pipeline over ``documents``: toxicity, quality, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's docs. The filters keep the columns of documents. Labels are learned from the rows that a stage
is given, leaving out the same folds as the single queries do. Rows that repeat a doc_id are one document and stay together.

Defined cases, for every stage: a null or empty text is scored like an empty one, has no near-duplicate and is packed as its end token; rows with a
null doc_id have no label and no near-duplicate and are kept unless their text is rejected; texts of any length are read whole; of equal texts the smallest
doc_id stays; columns of other names, those that clash with an operator's own included, go through the filters unchanged; without labels nothing is
rejected; an empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dealspark.llm import kernels, minhash, packing, quality, toxicity
from dealspark.session import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 for toxicity."""
    return toxicity.without_toxic(docs, toxicity.learn(docs, toxicity.training_labels(spark, sf_dir)))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least 0.5 for quality."""
    return quality.without_low_quality(docs, quality.learn(docs, quality.training_labels(spark, sf_dir)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words a shingle, similarity of 0.8 or more."""
    rejected = minhash.near_duplicates(docs, size=5, percent=80).where("not kept").select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti").select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack_sequences),
]

#: The learned stages and the packing have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = kernels.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
