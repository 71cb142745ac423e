"""Toxicity: a sparse linear model over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, scratch, small_batches, table, tidy
from .ftrl import Settings, fit, sampled, scorer


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer([shared.value])
        for batch in batches:
            (p,), _ = score(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], names=["doc_id", "score"])

    return run


def learn(docs: DataFrame, labels: DataFrame, settings: Settings | None = None):
    """The compact model: buckets, weights, bias."""
    s = settings or Settings()
    with scratch(docs.sparkSession):
        return fit(sampled(docs, labels, s.bound), ("toxic",), settings=s, what="toxic-sample")[0]


def toxicity(docs: DataFrame, model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score and predicted for every whole text.

    Null and empty texts get the score of a text without features.  Rows are
    scored one by one, so repeated rows repeat; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as many weights as L1 leaves, at most 2**BITS
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    scored = small_batches(rows).mapInArrow(tidy(_scores(shared)), "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn(docs, labels.where(fold("doc_id", 5) != 0))
    return toxicity(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
