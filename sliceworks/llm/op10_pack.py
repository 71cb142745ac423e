"""Best-fit packing planned on the histogram of lengths.

Documents are tokenised and cut once; what is left of the corpus for the plan is
a count per length, at most ``capacity`` numbers.  Best-fit decreasing runs over
these counts and gives intervals: the documents of a length with ranks from
``rank_lo`` on take sequences from ``seq_lo`` on, at one offset.  A document
finds its slot by its rank among those of its length, which is its rank in its
own task plus the number in earlier tasks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, table, tidy, written

CAPACITY = 1024
END = 2


def tokenizer_path(path: str | None = None) -> str:
    import public_tokenizers

    return path or public_tokenizers.path("byte_bpe_50k.json")


#: How ``tokenizers`` splits texts before its byte-level merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Spaces that start a pre-token, and those that need not.
CUT, ODD = re.compile(r" (?=\S)"), re.compile(r" (?=\s|\Z)")
#: Parts of texts whose counts a worker remembers, and their most characters: about 20 MB.
MEMO, MEMO_CHARS = 200_000, 64


class Ids:
    """Token ids as ``tokenizers`` gives them for the file at ``path``.

    ``tiktoken`` gives the same ids several times faster where the file is a plain
    byte-level one: split by ``SPLIT``, nothing normalised, and merges in the order
    of their results' ids, each of which is made by one merge.  That is read from
    the file; any other file, and texts with a special string, go through
    ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.fast = None
        if self.plain(file):
            byte = self.byte_of()
            ranks = {bytes(byte[c] for c in word): i for word, i in file["model"]["vocab"].items() if word not in self.specials}
            self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
            self.known = Known(self.fast.encode_ordinary)

    def plain(self, file: dict) -> bool:
        model, split, byte = file["model"], file.get("pre_tokenizer") or {}, self.byte_of()
        if model.get("type") != "BPE" or file.get("normalizer") or file.get("truncation") or file.get("padding"):
            return False
        if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            return False
        if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            return False
        words = {w: i for w, i in model["vocab"].items() if w not in self.specials}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [words.get(a + b) for a, b in pairs]
        single = sum(len(w) == 1 for w in words)
        return None not in made and made == sorted(set(made)) and single == 256 and len(words) == single + len(made) and all(c in byte for w in words for c in w)

    @staticmethod
    def byte_of() -> dict[str, int]:
        """The usual naming of bytes by printable characters."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        named = {chr(b): b for b in plain}
        rest = [b for b in range(256) if b not in plain]
        return named | {chr(256 + i): b for i, b in enumerate(rest)}

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.specials):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False)


    def count(self, text: str) -> int:
        """How many ids ``encode`` gives.  A space before a character that is none starts a pre-token of ``SPLIT``, so the counts of what lies between add up."""
        if self.fast is None or any(s in text for s in self.specials):
            return len(self.encode(text)) if text else 0
        first, *rest = CUT.split(text) if ODD.search(text) else text.split(" ")
        return len(self.fast.encode_ordinary(first)) + sum(map(self.known.__getitem__, rest))


class Known(dict):
    """Ids of a space and what follows it, bounded by ``MEMO`` strings of ``MEMO_CHARS`` characters."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, part: str) -> int:
        n = len(self.encode(" " + part))
        if len(part) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[part] = n
        return n


@lru_cache(2)
def ids_of(path: str) -> Ids:
    return Ids(path)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, but for a shorter first."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity
    return ([(0, head)] if head else []) + [(s, capacity) for s in range(head, n, capacity)]


def _pieces(path: str, capacity: int, end: int, keep_ids: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_for, task = ids_of(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(ids_for.encode(text) if text else np.zeros(0, np.uint32), np.uint32(end)).astype("<u4")
                for k, (at, n) in enumerate(cuts(len(ids), capacity)):
                    part = ids[at : at + n]
                    rows.append((doc, k, at, n, zlib.crc32(part.tobytes()), task, int(seen[n])) + ((part.astype(np.int32),) if keep_ids else ()))
                    seen[n] += 1
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"] + ["ids"] * keep_ids)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out
        ids_of.cache_clear()  # the worker goes on to other stages

    return run


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, end: int = END, keep_ids: bool = False) -> DataFrame:
    """Every document's tokens and ``end``, cut to pieces; with the rank of a piece among its task's pieces of that length."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long" + ", ids array<int>" * keep_ids
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return small_batches(rows).mapInPandas(tidy(_pieces(tokenizer_path(path), capacity, end, keep_ids)), schema)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, rank_lo, rank_hi, seq_lo, offset), rank_hi exclusive.

    Open sequences are kept as ranges of numbers by the room they have left.  Of
    a length's documents each goes where the least sufficient room is, which for
    a whole range of sequences with equal room is one step.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    out, fresh = [], 0

    def fill(length: int, rank: int, left: int, lo: int, n: int, space: int) -> int:
        """Puts up to ``left`` documents into n sequences with equal space, as many in each as fit; returns how many."""
        each = space // length
        full, over = divmod(min(left, n * each), each)
        for count, start, items in ((full, lo, each), (1 if over else 0, lo + full, over)):
            for j in range(items if count else 0):
                out.append((length, rank + j * count, rank + (j + 1) * count, start, capacity - space + j * length))
            if count:
                rank += items * count
                room.setdefault(space - items * length, []).append((start, count))
        used = full + bool(over)
        if used < n:
            room.setdefault(space, []).append((lo + used, n - used))
        return full * each + over

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            space = min((r for r in room if r >= length and room[r]), default=None)
            if space is None:
                each = capacity // length
                n = -(-left // each)
                lo, fresh, space = fresh, fresh + n, capacity
            else:
                lo, n = room[space].pop()
                if not room[space]:
                    del room[space]
            done = fill(length, rank, left, lo, n, space)
            rank, left = rank + done, left - done
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, **how) -> DataFrame:
    """All pieces of all documents with the sequence and the offset they take.

    Null and empty texts are one piece, the end token alone.  Repeated rows are
    packed each; equal lengths are told apart by rank, so ties have one slot
    each.  An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    cut = written(pieces(docs, capacity=capacity, **how), "pieces")
    counts = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    columns = ["length", "rank_lo", "rank_hi", "seq_lo", "offset"]
    # as Arrow: rows of Python objects would take workers of their own on every executor
    slots = spark.createDataFrame(pa.table(dict(zip(columns, np.array(plan(histogram, capacity), np.int64).reshape(-1, 5).T))))
    ranked = cut.join(earlier, ["task", "length"]).withColumn("rank", F.col("earlier") + F.col("nth"))
    # the plan has a few intervals per length, whatever the corpus holds
    placed = ranked.join(F.broadcast(slots), (ranked["length"] == slots["length"]) & (ranked["rank"] >= slots["rank_lo"]) & (ranked["rank"] < slots["rank_hi"])).drop(slots["length"])
    return placed.withColumn("sequence_id", F.col("seq_lo") + F.col("rank") - F.col("rank_lo")).drop("task", "nth", "earlier", "rank", "rank_lo", "rank_hi", "seq_lo")


def op10_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
