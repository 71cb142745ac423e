"""Mixing sources to target weights by soft membership.

Classifiers learned from the labelled table give every document a posterior over
domains (good or poor, toxic or not).  Each document gets a rate, not negative,
such that the expected token totals of the domains, sum of rate * tokens *
posterior, come as near to their targets as they can: least squares with a slight
pull of every rate to 1.  Its solution is a rate of 1 less the posterior times one
slope per domain, projected on the bounds.  The slopes are found by steps scaled
with the k x k matrix of the documents between the bounds; a step needs that matrix
and one total per domain, summed over all documents.  The steps end when the
residual is small, and the achieved totals come with the result.  A document's rate
follows from its posterior and the slopes alone, so no rate is ever stored.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, small_batches, table, tidy, written
from .ftrl import Settings, fit, sampled, scorer
from .op10_pack import ids_of, tokenizer_path

DOMAINS = ("good", "poor", "good_toxic", "poor_toxic")
TARGETS = {"good": 0.90, "poor": 0.07, "good_toxic": 0.02, "poor_toxic": 0.01}
#: Pull of every rate towards 1.
PULL = 3e-4
#: Largest residual of a domain, relative to its target, at which the slopes stand still.
STILL = 1e-6
#: Passes after which the solve fails; it takes about 2 to 25.
PASSES = 200
#: Part of its target that a domain of the drawn documents may miss without a warning.
MISS = 0.05
#: Least share of a domain that weights and residuals count with.
RARE = 1e-4
#: Least budget that is taken where none is given, of all tokens: a rare main domain does not throw the corpus away.
LEAST = 0.25


@dataclass
class Mix:
    """Classifiers and one slope per domain; with them any document's rate can be told.

    ``targets`` and ``totals`` (achieved) are shares of all tokens; ``residual`` is that of the last step.
    """

    models: list
    slopes: np.ndarray
    most: float | None
    targets: np.ndarray
    totals: np.ndarray
    residual: float = 0.0
    passes: int = 0

    def rates(self, p: np.ndarray) -> np.ndarray:
        return np.clip(1 - p @ self.slopes, 0, self.most)

    def achieved(self) -> dict[str, tuple[float, float]]:
        """Per domain the target and the achieved total."""
        return {d: (float(t), float(a)) for d, t, a in zip(DOMAINS, self.targets, self.totals)}


log = logging.getLogger(__name__)


def posteriors(score, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text the posterior of each domain, and its words."""
    (good, toxic), n = score(column)
    return np.stack([good * (1 - toxic), (1 - good) * (1 - toxic), good * toxic, (1 - good) * toxic], axis=1), n


def _memberships(models, counted: bool, tokenizer: str | None, keep: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(models.value)
        for batch in batches:
            p, n = posteriors(score, batch.column(1))
            if counted:
                n = batch.column(2).fill_null(0).to_numpy()
            elif tokenizer:
                n = np.array([ids_of(tokenizer).count(t) for t in batch.column(1).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *map(pa.array, p.T)], names=["doc_id", "n_tokens", *DOMAINS])
        if not keep:
            ids_of.cache_clear()  # the worker goes on to other stages

    return run


def _matrix(batch: pa.RecordBatch, first: int) -> np.ndarray:
    return np.stack([batch.column(first + i).to_numpy() for i in range(len(DOMAINS))], axis=1)


def _names() -> list[str]:
    k = len(DOMAINS)
    return ["n", "cost", *(f"r{i}" for i in range(k)), *(f"t{i}" for i in range(k)), *(f"s{i}" for i in range(k * k))]


def _totals(mix: Mix):
    """Per task the tokens, the cost of the rates, the domains' totals whole and at the present rates, and the matrix of documents between the bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, most = len(DOMAINS), np.inf if mix.most is None else mix.most
        cost, tokens = 0.0, 0.0
        whole, total, square = np.zeros(k), np.zeros(k), np.zeros((k, k))
        for batch in batches:
            n, p = batch.column(0).to_numpy(), _matrix(batch, 1)
            u = 1 - p @ mix.slopes
            r = np.clip(u, 0, mix.most)
            cost += float((n * r) @ (u - r / 2))  # the integral of the projected rate
            whole += n @ p
            total += (n * r) @ p
            square += (p * (n * ((u >= 0) & (u <= most)))[:, None]).T @ p
            tokens += n.sum()
        yield pa.RecordBatch.from_arrays([pa.array([float(x)]) for x in (tokens, cost, *whole, *total, *square.ravel())], names=_names())

    return run


def _sums(members: DataFrame, mix: Mix) -> np.ndarray:
    names = _names()
    per_task = members.select("n_tokens", *DOMAINS).mapInArrow(tidy(_totals(replace(mix, models=[]))), ", ".join(f"{c} double" for c in names))
    row = per_task.agg(*[F.sum(c).alias(c) for c in names]).first()
    return np.array([x or 0.0 for x in row])


def fit_rates(members: DataFrame, models: list, targets: dict[str, float] | None = None, budget: float | None = None, most: float | None = None) -> Mix:
    """The slopes that lead from rates of 1 to the least squares.

    ``targets``: shares of the domains.  ``budget``: their sum as a multiple of
    all tokens; None takes that with which the domain with the largest share is
    used once, whole, and no less than ``LEAST``.
    ``most``: an upper bound of the rates.
    Where targets are out of reach the least squares still exist; ``achieved``
    tells how near they come.  A solve that does not end raises.
    """
    k = len(DOMAINS)
    weights = np.array([(targets or TARGETS).get(d, 0.0) for d in DOMAINS])
    weights = weights / weights.sum()
    mix = Mix(models, np.zeros(k), most, weights, np.zeros(k))
    first = _sums(members, mix)
    tokens = first[0]
    if not tokens:
        return mix
    natural = first[2 : 2 + k] / tokens
    main = int(weights.argmax())
    scale = budget if budget is not None else max(LEAST, float(natural[main] / weights[main]))
    mix.targets = weights * scale
    # a rare domain's total counts as much as a frequent one's
    pull = PULL * np.maximum(natural, RARE)

    def at(slopes: np.ndarray, sums: np.ndarray | None = None) -> tuple[np.ndarray, float, np.ndarray, np.ndarray, np.ndarray]:
        """The slopes with the potential, its descent (the residual), the totals and the matrix there; one pass."""
        got = (_sums(members, replace(mix, slopes=slopes)) if sums is None else sums)[1:] / tokens
        mix.passes += 1
        total, square = got[1 + k : 1 + 2 * k], got[1 + 2 * k :].reshape(k, k)
        potential = got[0] + mix.targets @ slopes + (pull * slopes**2).sum() / 2
        return slopes, potential, total - mix.targets - pull * slopes, total, square

    now = at(mix.slopes, first)
    while True:
        mix.slopes, potential, rest, mix.totals, square = now
        mix.residual = float((np.abs(rest) / np.maximum(mix.targets, RARE)).max())
        if mix.residual <= STILL:
            return mix
        # the potential is convex with this matrix as its curvature, so short enough steps along ``way`` descend
        way, part = np.linalg.solve(square + np.diag(pull), rest), 1.0
        while True:
            if mix.passes >= PASSES:
                raise RuntimeError(f"rates not settled after {PASSES} passes: residual {mix.residual:.1e}, at most {STILL:.0e}; {mix.achieved()}")
            now = at(mix.slopes + part * way)
            if now[1] <= potential - 1e-4 * part * float(rest @ way) + 1e-14 * abs(potential):
                break
            part /= 2


def members_of(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, tokens: str | None = None, tokenizer: str | None = None, keep: bool = False) -> tuple[DataFrame, list]:
    """(doc_id, n_tokens, one column per domain) for every document, and the classifiers.

    ``tokens``: a column of ``docs`` with each document's tokens.  ``tokenizer``:
    the file whose ids are counted, in the same pass over the texts.  Without
    either, words are.  ``keep``: workers keep the tokenizer for their next task.
    """
    s = settings or Settings()
    with scratch(docs.sparkSession):
        known = written(sampled(docs, labels, s.bound), "labelled")  # about ``bound`` texts
        models = fit(known, ("quality", "toxic"), settings=s)
        shared = docs.sparkSession.sparkContext.broadcast(models)  # at most 2**BITS weights each
        count = F.col(tokens).cast("long") if tokens else F.lit(None).cast("long")
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), count.alias("n_tokens"))
        schema = "doc_id long, n_tokens long, " + ", ".join(f"{d} double" for d in DOMAINS)
        members = written(small_batches(rows).mapInArrow(tidy(_memberships(shared, tokens is not None, tokenizer, keep)), schema), "members", stays=True)
        shared.destroy()
    return members, models


def _rated(mix, first: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _matrix(batch, first)
            domain = [DOMAINS[i] for i in p.argmax(axis=1)] if len(p) else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(domain, pa.string()), pa.array(mix.value.rates(p))], names=[*batch.schema.names, "domain", "rate"])

    return run


def source_mix(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, tokens: str | None = None, tokenizer: str | None = None, **how) -> DataFrame:
    """doc_id, n_tokens (as ``members_of`` counts them), a posterior per domain, the likeliest domain and the rate, for every document.

    Null and empty texts have no tokens and the posterior of a text without
    features.  Documents with equal posteriors have equal rates, so repeated rows
    repeat.  Without labels all posteriors are alike; an empty table gives no
    rows.  Other columns are not read.
    """
    members, models = members_of(docs, labels, settings, tokens, tokenizer, keep=True)
    mix = docs.sparkSession.sparkContext.broadcast(fit_rates(members, models, **how))
    schema = "doc_id long, n_tokens long, " + ", ".join(f"{d} double" for d in DOMAINS) + ", domain string, rate double"
    return small_batches(members).mapInArrow(tidy(_rated(mix, 2)), schema)


def _drawn(mix, at: int, doc: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(mix.value.models)
        for batch in batches:
            p, _ = posteriors(score, batch.column(at))
            chance = batch.column(doc).to_numpy(zero_copy_only=False)
            keep = pa.array(chance < mix.value.rates(p))
            yield pa.RecordBatch.from_arrays([c for i, c in enumerate(batch.columns) if i != doc], names=[n for i, n in enumerate(batch.schema.names) if i != doc]).filter(keep)

    return run


def drawn(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, tokens: str | None = None, tokenizer: str | None = None, **how) -> DataFrame:
    """The documents that stay when each is kept with its rate (at most 1) as its chance, by a hash of its id.

    All columns stay, whatever their names.  The rates are told anew from each
    text, so nothing is joined.  Where nothing could be learned all stay.
    """
    with scratch(docs.sparkSession):
        members, models = members_of(docs, labels, settings, tokens, tokenizer)
        if not any(len(at) for at, _, _ in models):
            log.warning("no labels to learn from: mixing keeps all documents")
            return docs
        found = fit_rates(members, models, **how | {"most": 1.0})
    far = (np.abs(found.totals - found.targets) > MISS * found.targets).any()
    # the posteriors of a text sum to 1, so the totals sum to the share of tokens that stays
    log.log(logging.WARNING if far else logging.INFO, "mixing keeps %.3f of all tokens; domains (target, achieved): %s", found.totals.sum(), found.achieved())
    mix = docs.sparkSession.sparkContext.broadcast(found)
    chance = F.pmod(F.xxhash64(F.lit(23), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    rows = docs.select("*", chance.alias("chance")).toDF(*(f"c{i}" for i in range(len(docs.columns) + 1)))
    kept = small_batches(rows).mapInArrow(tidy(_drawn(mix, docs.columns.index("text"), len(docs.columns))), rows.drop(rows.columns[-1]).schema)
    return kept.toDF(*docs.columns)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens are those of the tokenizer that packs."""
    return source_mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), tokenizer=tokenizer_path())
