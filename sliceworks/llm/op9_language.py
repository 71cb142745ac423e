"""Language ID by mixtures: proportions by expectation-maximisation.

Learned from labelled documents: per language the frequencies of hashed byte
n-grams.  A document's n-gram counts are then explained as a mixture of the
languages' distributions.  Expectation-maximisation finds the proportions.  The
language with the smallest proportion is tried without: if that costs less
likelihood than the penalty it leaves the set and the next is tried, else the
set stands (a penalised likelihood over language sets, searched from all
languages down).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_sample, fold, small_batches, table, tidy
from .hashing import buffers

BITS = 16
SIZES = (1, 2, 3)
#: Labelled documents per language of which the frequencies are learned, about.
LEARN = 1500
#: Languages that a model tells apart, at most.
LANGUAGES = 128
ROUNDS = 12
#: Nats per further language, times the logarithm of the number of n-grams.
PENALTY = 4.0
NONE = "und"

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_LOWER[[9, 10, 11, 12, 13]] = 32
_LOWER[48:58] = 48


def grams(raw: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Buckets of all n-grams of a text's bytes; letters in small form, digits alike."""
    b = _LOWER[raw]
    out, h = [], np.zeros(len(b), np.uint32)
    for n in range(1, max(SIZES) + 1):
        if len(b) < n:
            break
        h = (h[: len(b) - n + 1] * np.uint32(257) + b[n - 1 :] + np.uint32(1)).astype(np.uint32)
        if n in SIZES:
            out.append((h * np.uint32(0x9E3779B1) + np.uint32(n)) >> np.uint32(32 - bits))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def _texts(batch: pa.RecordBatch, column: str):
    data, off = buffers(batch.column(batch.schema.get_field_index(column)))
    for lo, hi in zip(off[:-1], off[1:]):
        yield data[lo:hi]


def _gather(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, raw in zip(batch.column(0).to_pylist(), _texts(batch, "text")):
                n = np.bincount(grams(raw, bits), minlength=1 << bits)
                sums[lang] = sums.get(lang, 0) + n
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))], names=["lang", "bucket", "n"])

    return run


class Model:
    """Languages and, per bucket, their smoothed probabilities."""

    def __init__(self, langs: list[str], p: np.ndarray):
        self.langs, self.p = langs, p

    @staticmethod
    def of(counts: pd.DataFrame, bits: int = BITS) -> Model:
        langs = sorted(counts["lang"].unique())
        n = np.zeros((1 << bits, len(langs)))
        n[counts["bucket"].to_numpy(), np.searchsorted(langs, counts["lang"].to_numpy().astype(str))] = counts["n"].to_numpy()
        n += 0.5
        return Model(langs, n / n.sum(axis=0))

    def mixture(self, raw: np.ndarray) -> tuple[list[int], np.ndarray]:
        """The chosen languages (by index) and their proportions."""
        counts = np.bincount(grams(raw, int(len(self.p)).bit_length() - 1))
        at = np.flatnonzero(counts)
        c, p = counts[at].astype(np.float64), self.p[at]
        total = c.sum()
        chosen = list(range(len(self.langs)))
        fee = PENALTY * max(len(SIZES), 1) * np.log(total + 1)
        share, like = em(c, p, total)
        while len(chosen) > 1:
            k = int(np.argmin(share))
            rest = [i for i in range(len(chosen)) if i != k]
            fewer = p[:, rest]
            share2, like2 = em(c, fewer, total, share[rest])
            if like - like2 > fee:
                break
            chosen, p, share, like = [chosen[i] for i in rest], fewer, share2, like2
        return chosen, share


def em(c: np.ndarray, p: np.ndarray, total: float, start: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Proportions of p's columns that make the counts likeliest, and the log-likelihood."""
    k = p.shape[1]
    share = np.full(k, 1 / k) if start is None else (start + 1e-3) / (start + 1e-3).sum()
    if k > 1:
        for _ in range(ROUNDS):
            new = share * (p.T @ (c / (p @ share))) / total
            still = np.abs(new - share).max() < 1e-4
            share = new
            if still:
                break
    return share, float(c @ np.log(p @ share))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", bound: int = LEARN, bits: int = BITS) -> Model | None:
    """A model of about ``bound`` documents of each language, whole texts; None without any.

    The ``LANGUAGES`` with the most documents are learned, which bounds what is
    collected and broadcast: 2**bits numbers for each.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.col(doc_id).alias("doc_id"))
    rows = bounded_sample(rows, "doc_id", bound, "lang", LANGUAGES).select("lang", "text")
    sums = small_batches(rows).mapInArrow(tidy(_gather(bits)), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = sums.toPandas()  # at most 2**bits rows a language, of LANGUAGES
    return Model.of(counts, bits) if len(counts) else None


def _predict(shared, text: str, kept: list[str]):
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            letters = batch.column(batch.num_columns - 1).to_pylist()
            best, score, parts = [], [], []
            for ok, raw in zip(letters, _texts(batch, text)):
                if not ok or model is None:
                    best.append(NONE), score.append(0.0), parts.append([])
                    continue
                chosen, share = model.mixture(raw)
                k = int(np.argmax(share))  # ties: the first in alphabetical order
                best.append(model.langs[chosen[k]])
                score.append(float(min(max(share[k], 0.0), 1.0)))
                parts.append([{"lang": model.langs[i], "share": float(s)} for i, s in zip(chosen, share)])
            found = [pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(parts, kind)]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in kept] + found, names=[*kept, "lang_pred", "score", "languages"])

    return run


def identify(docs: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, lang_pred, score, languages (array of language and share) for every whole text.

    Null texts, texts without a letter and any text when nothing could be learned
    are ``und`` with score 0.  Equal shares go to the alphabetically first
    language.  Repeated rows give repeated results; columns of ``docs`` named as
    the result's are not kept.
    """
    kept = [c for c in keep if c not in ("lang_pred", "score", "languages")]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers a language
    rows = docs.select(*dict.fromkeys([*kept, text]), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("has letter"))
    share = T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())])
    new = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("languages", T.ArrayType(share))]
    out = T.StructType([*docs.select(*kept).schema.fields, *new])
    return small_batches(rows).mapInArrow(tidy(_predict(shared, text, kept)), out)


def learned(docs: DataFrame, part: int = 4, out: int = 2, **how) -> Model | None:
    """Learns from the documents whose crc32 fold is not held out."""
    return learn(docs.where(fold("doc_id", part) != out), **how)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learned(docs))
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
