"""Applying a model of whole texts to a table of documents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from dealspark.llm import kernels as K


def scored(docs: DataFrame, model) -> DataFrame:
    """doc_id and score for each row; ``model.scores`` maps an array of texts to numbers from 0 to 1."""
    K.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a size set by the model's parameters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.scores(b.column(1)), pa.float64())], names=["doc_id", "score"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(run, "doc_id long, score double")


def score_column(docs: DataFrame, model) -> Column:
    """The score as a column of ``docs``, for filters that keep all other columns as they are."""
    K.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(texts), pa.float64())

    return score(docs["text"])


def labelled(labels: DataFrame, label: str) -> DataFrame:
    """doc_id and label of all rows of the two classes (0 and 1)."""
    return labels.where(F.col(label).isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"))


#: Cells of the sieve for each label, and most words of 64 cells, which are broadcast; beyond 4 million labels it lets more rows through.
CELLS, WORDS = 16, 1 << 20


def _cell(words: int) -> tuple[Column, Column]:
    """The word of a doc_id in the sieve, and its bit there."""
    h = F.xxhash64("doc_id")
    return F.pmod(h, F.lit(words)), F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 58).cast("int"))


def sieved(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id (long) may be among the labelled ones: all that are, and a few that are not."""
    words = min(WORDS, max(1, labels.count() * CELLS // 64))
    word, bit = _cell(words)
    sieve = labels.where("doc_id is not null").groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    # long rows meet a table of a bounded size before they are shuffled
    return docs.withColumn("word", word).join(F.broadcast(sieve), "word").where(F.col("bits").bitwiseAND(bit) != 0).drop("word", "bits")


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """doc_id, text, label of the labelled rows. The texts are shuffled, but only theirs, and for tables of any size alike."""
    marks = labelled(labels, label)
    texts = sieved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), marks)
    return texts.join(marks.hint("shuffle_hash"), "doc_id")
