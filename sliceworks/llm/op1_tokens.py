"""Token counts with a whole-token shortcut.

A text is a chain of pre-tokens: a run of word-start marks and what follows up
to the next mark.  No vocabulary string holds a mark after another character, so
no merge crosses that border and the pre-tokens' counts add up.  ``prove`` runs
every vocabulary string through the library once and keeps those that come out
as one token; a pre-token among them counts 1 at once, all others are merged by
the library, each distinct one once per worker.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

MARK = "\u2581"
LIMIT = 4096
#: Distinct merged pre-tokens that a worker remembers before it starts anew, and the characters up to which it
#: remembers one; so a worker's memory is bounded by about 400,000 strings of 64 characters.
MEMO = 400_000
MEMO_CHARS = 64


def model_path(path: str | None = None) -> str:
    import public_tokenizers

    return path or public_tokenizers.path("piece_bpe_32k.model")


class Counter(dict):
    """Pre-token (without its first mark) -> tokens.  ``whole``: those proven to be one token."""

    def __init__(self, path: str):
        import sentencepiece

        super().__init__()
        self.encoder = sentencepiece.SentencePieceProcessor(model_file=path)
        sp = self.encoder
        plain = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        pieces = [sp.id_to_piece(i) for i in plain]
        assert not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces), "a merge may cross a pre-token's start"
        #: Characters of which no longer vocabulary string is made; no merge touches them.
        self.joined = {c for p in pieces if len(p) > 1 for c in p}
        #: Line ends part a pre-token further if no string of several characters holds one.
        self.parts = "\n" not in self.joined
        self.line_end = len(sp.encode("\n\n")) - len(sp.encode("\n"))
        #: Tokens of a mark alone.
        self.mark = len(sp.encode("\n")) - self.line_end
        self.whole = self.prove(pieces)
        self.reset()

    def prove(self, pieces: list[str]) -> list[str]:
        starts = [p[1:] for p in pieces if p[0] == MARK and MARK not in p[1:]]
        texts = [p for p in starts if p]
        return [p for p, ids in zip(texts, self.encoder.encode(texts, num_threads=1)) if len(ids) == 1]

    def reset(self):
        self.clear()
        self.tails: dict[str, int] = {}
        self.update(dict.fromkeys(self.whole, 1))

    def __missing__(self, pre: str) -> int:
        n = self.merged(pre)
        if len(pre) > MEMO_CHARS:
            return n
        if len(self) + len(self.tails) > len(self.whole) + MEMO:
            self.reset()
        self[pre] = n
        return n

    def merged(self, pre: str) -> int:
        if self.parts and "\n" in pre:
            head, *rest = pre.split("\n")
            n = self[head] if head else self.mark
            for line in rest:
                n += self.line_end + (self.tail(line) if line else 0)
            return n
        return len(self.encoder.encode(pre.replace(MARK, " ")))

    def tail(self, line: str) -> int:
        """Tokens of what follows a line end: no mark before it."""
        n = self.tails.get(line)
        if n is None:
            n = len(self.encoder.encode("\n" + line)) - self.mark - self.line_end
            if len(line) <= MEMO_CHARS:
                self.tails[line] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(" ", MARK)
        if text[0] != MARK and text[-1] != MARK and MARK + MARK not in text:
            return sum(map(self.__getitem__, text.split(MARK)))
        return sum(self[p[1:]] if len(p) > 1 else self.mark for p in re.findall(f"{MARK}+[^{MARK}]*", MARK + text))


@lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``: the library's count for the whole text.

    Null and empty texts have 0 tokens.  Each row is counted for itself, so ties,
    repeated rows and other columns pass unchanged; an ``n_tokens`` that is
    already there is replaced.
    """
    path = model_path(path)

    count = F.pandas_udf(_counting(path), "long")
    return small_batches(docs).withColumn("n_tokens", count(F.coalesce(F.col(text), F.lit(""))))


def _counting(path: str):
    from collections.abc import Iterator

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(path)
        for texts in batches:
            yield pd.Series([c.count(t) if t else 0 for t in texts], dtype="int64")

    count.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return count


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs).select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
    )
