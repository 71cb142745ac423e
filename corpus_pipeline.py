"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet in the shared folder and reads it again for the next stage.  All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sliceworks.llm import op2_mixing, op5_exact, op7_jaccard, op9_language, op10_pack
from sliceworks.llm.common import free, quoted, removed, scratch, table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null and empty texts, and texts without a letter.

    Where nothing can be learned (no row with a language outside the held-out
    part) a letter is enough to stay.  Repeated rows stay or go together, extra
    columns stay whatever their names, an empty table gives none.
    """
    model = op9_language.learned(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    safe = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # no name that the operator's own columns have
    found = op9_language.identify(safe, model, text=f"c{docs.columns.index('text')}", keep=tuple(safe.columns))
    return found.where(F.col("lang_pred") != op9_language.NONE).select(*safe.columns).toDF(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays, that with the largest id; null counts as empty.

    Of rows that repeat this id with the text any one stays, of a text with null
    ids alone as well.  Extra columns stay whatever their names; an empty table
    gives none.
    """
    sha, keep = free("sha", docs), free("keep_id", docs)
    stay = op5_exact.groups(docs).select(F.col("text_sha256").alias(sha), F.col("keep_id").alias(keep))
    rows = docs.withColumn(sha, F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    kept = rows.join(stay.hint("merge"), sha).where(F.col("doc_id").eqNullSafe(F.col(keep)))
    return kept.dropDuplicates([sha]).select(*map(quoted, docs.columns))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links hold together the one with the smallest id stays.

    An id is one document: rows that repeat it stay together or go together, by
    what any of their texts links to.  Rows with a null id and texts without
    words stay.  Extra columns stay whatever their names; an empty table gives none.
    """
    found = op7_jaccard.jaccard_join(docs.select("doc_id", "text"))
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*map(quoted, docs.columns))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn with the rates that bring the domains to their target weights.

    The draw is a hash of the id, so equal rows stay or go together, and null ids
    all have the same chance.  Null and empty texts weigh nothing and are drawn
    by the rate of a text without features.  Without labels all rates are alike.
    Extra columns stay whatever their names; an empty table gives none.
    """
    return op2_mixing.drawn(docs, table(spark, sf_dir, "labels"), tokenizer=op10_pack.tokenizer_path())


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with the sequence and the offset that they take.

    Null and empty texts are one piece, the end token alone; repeated rows and
    null ids are packed each; an empty table gives none, other columns go.
    """
    return op10_pack.pack(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language", language),
    ("exact dedup", exact),
    ("near duplicates", near),
    ("source mixing", mixing),
    ("packing", packing),
]

#: No SQL: language ID, mixing and packing are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, paths = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with scratch(spark):  # a stage's own tables go when its result is written, its input as well
            docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"), stays=True, paths=paths)
        for path in paths[-2:-1]:
            removed(spark, path)
    return docs
