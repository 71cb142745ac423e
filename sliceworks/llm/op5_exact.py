"""Exact dedup by Grace hashing.

Texts are dealt to buckets by a hash.  The sizes of all buckets are measured
first; a bucket larger than a table may be is dealt out again by another hash,
and what is still too large again, so that one shuffle then puts every text in
its final bucket (Spark's shuffle files are the spill files; a partition holds
many buckets, sorted).  Before it, each
task keeps one of equal texts, so copies of one text, however many, meet as a few
rows.  Each bucket then goes through an open-addressing table that compares
complete contents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slots, small_batches, table, tidy, written

#: Bytes of text a bucket may have before it is dealt out again.
BUCKET_BYTES = 64 << 20
#: Buckets of a deal, at most; as many large ones are broadcast, more are joined.
MOST_BUCKETS = 1 << 16
#: Times that a bucket is dealt out again; what is still too large has one text again and again.
DEPTH = 3
#: Bytes of distinct texts a task gathers before it passes them on.
LOCAL_BYTES = 32 << 20


class OpenTable:
    """Open addressing with linear probing; a slot is taken only by equal content."""

    def __init__(self, size: int = 1 << 12):
        self.slot = np.full(size, -1, np.int64)
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.keep: list[int | None] = []
        self.count: list[int] = []
        self.bytes = 0

    def add(self, h: int, text: bytes, doc: int | None, n: int) -> None:
        mask = len(self.slot) - 1
        at = h & mask
        while (k := self.slot[at]) >= 0:
            if self.hashes[k] == h and self.texts[k] == text:
                self.count[k] += n
                if doc is not None and (self.keep[k] is None or doc > self.keep[k]):
                    self.keep[k] = doc
                return
            at = (at + 1) & mask
        self.slot[at] = len(self.texts)
        self.hashes.append(h), self.texts.append(text), self.keep.append(doc), self.count.append(n)
        self.bytes += len(text)
        if 2 * len(self.texts) > len(self.slot):
            self.grow()

    def grow(self) -> None:
        self.slot = np.full(2 * len(self.slot), -1, np.int64)
        mask = len(self.slot) - 1
        for k, h in enumerate(self.hashes):
            at = h & mask
            while self.slot[at] >= 0:
                at = (at + 1) & mask
            self.slot[at] = k


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each distinct text of what a task has in hand."""

    def out(t: OpenTable) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(bucket_of, pa.int64()), pa.array(t.hashes, pa.int64()), pa.array(t.texts, pa.binary()), pa.array(t.keep, pa.int64()), pa.array(t.count, pa.int64())], names=["bucket", "h", "text", "doc_id", "n"])

    t, bucket_of = OpenTable(), []
    for batch in batches:
        for bucket, h, text, doc in zip(*(batch.column(i).to_pylist() for i in range(4))):
            t.add(h, text, doc, 1)
            if len(t.texts) > len(bucket_of):
                bucket_of.append(bucket)
            if t.bytes > LOCAL_BYTES:
                yield out(t)
                t, bucket_of = OpenTable(), []
    if t.texts:
        yield out(t)


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets come one after the other; each has a table of its own."""

    def out(t: OpenTable) -> pa.RecordBatch:
        sha = [hashlib.sha256(x).hexdigest() for x in t.texts]
        if len(set(sha)) < len(sha):
            raise ValueError("different texts with the same sha256")
        return pa.RecordBatch.from_arrays([pa.array(sha, pa.string()), pa.array(t.keep, pa.int64()), pa.array(t.count, pa.int64())], names=["text_sha256", "keep_id", "group_size"])

    t, now = OpenTable(), None
    for batch in batches:
        for bucket, h, text, doc, n in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if bucket != now and t.texts:
                yield out(t)
                t = OpenTable()
            now = bucket
            t.add(h, text, doc, n)
    if t.texts:
        yield out(t)


def _deal(level: int, n: Column | int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1000 + level), "text"), F.lit(n) if isinstance(n, int) else n)


def buckets(rows: DataFrame, bucket_bytes: int = BUCKET_BYTES, depth: int = DEPTH) -> DataFrame:
    """``rows`` with the final bucket of each text.

    Too large buckets are a table (bucket, fan), at most as many as the corpus
    has times the bucket size; a new bucket's number is a hash of the old one and
    the new deal.
    """
    size = F.octet_length("text").cast("long")
    total = rows.agg(F.sum(size)).first()[0] or 0
    first = int(min(MOST_BUCKETS, max(1, -(-2 * total // bucket_bytes))))
    dealt = rows.withColumn("bucket", _deal(0, first).cast("long")).withColumn("moved", F.lit(True))
    for level in range(1, depth + 1):
        sizes = dealt.where("moved").groupBy("bucket").agg(F.sum(size).alias("size")).where(F.col("size") > bucket_bytes)
        fan = F.least(F.lit(MOST_BUCKETS), F.ceil(2 * F.col("size") / bucket_bytes)).cast("long").alias("fan")
        large = written(sizes.select("bucket", fan), "large-buckets")
        if not (n := large.count()):
            break
        again = dealt.join(F.broadcast(large) if n <= MOST_BUCKETS else large, "bucket", "left")
        anew = F.xxhash64(F.lit(level), "bucket", _deal(level, F.col("fan")))
        dealt = again.select(*rows.columns, F.when(F.col("fan").isNotNull(), anew).otherwise(F.col("bucket")).alias("bucket"), F.col("fan").isNotNull().alias("moved"))
    return dealt.drop("moved")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per distinct text: text_sha256, keep_id (the largest id), group_size."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = buckets(rows, bucket_bytes).select("bucket", F.xxhash64(F.lit(7), "text").alias("h"), F.col("text").cast("binary").alias("text"), "doc_id")
    once = small_batches(dealt).mapInArrow(tidy(_local), "bucket long, h long, text binary, doc_id long, n long")
    placed = once.repartition(2 * slots(docs.sparkSession), "bucket").sortWithinPartitions("bucket")
    return small_batches(placed).mapInArrow(tidy(_resolve), "text_sha256 string, keep_id long, group_size long")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null counts as empty; texts are equal when identical.  Of equal texts the
    largest doc_id stays; rows that repeat this id with the same text are all
    marked as kept.  A group of null ids alone has a null keep_id and is kept.
    Ids meet their group by the digest of the text, a join that Spark splits
    where one group is large.  Other columns are not read.
    """
    found = groups(docs, doc_id, text, bucket_bytes)
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256).alias("text_sha256"))
    same = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return ids.join(found.hint("merge"), "text_sha256").select("doc_id", "keep_id", "group_size", same.alias("kept"), "text_sha256")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
