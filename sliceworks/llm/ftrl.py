"""Logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

The labelled sample is dealt to a fixed number of parts by a hash of the ids.  In
each epoch every part, a group of its own, runs the online updates from the common
state in one order, and what the parts changed is averaged, coordinate by
coordinate, over those parts that met it, in fixed point.  So the result depends on
the rows alone, not on files, partitions or cores.  Several labels are learned in the same passes.  The state has at most 2**BITS
coordinates a label, whatever the corpus holds.  It goes from epoch to epoch as a
table; the driver gets the weights that L1 leaves in the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, given_back, removed, small_batches, tidy, written
from .hashing import ALNUM, buffers, chunks, mix, words

BITS = 18
BIAS = 1 << BITS
#: Steps of the fixed point in which changes are averaged.
FINE = float(1 << 40)
#: Neighbouring coordinates whose changes travel in one row.
BLOCK = 1 << 12


@dataclass(frozen=True)
class Settings:
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 2.0
    l2: float = 1.0
    epochs: int = 8
    #: Weight of a row with label 1; those with 0 weigh 1.
    ones: float = 2.0
    parts: int = 8
    #: Labelled rows to learn from, about.
    bound: int = 12_000


_SECOND, _THIRD = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def features(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, pairs of neighbours and pairs with one word between; and the text each belongs to."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    parts, owners = [hashes], [doc]
    for gap, by in ((1, _SECOND), (2, _THIRD)):
        if len(hashes) > gap:
            same = doc[gap:] == doc[:-gap]
            parts.append(mix(hashes[:-gap] * by + hashes[gap:])[same])
            owners.append(doc[gap:][same])
    shift = np.uint64(64 - BITS)
    return (np.concatenate(parts) >> shift).astype(np.int64), np.concatenate(owners)


def one_pass(rows: list[tuple[float, np.ndarray]], z: np.ndarray, n: np.ndarray, s: Settings) -> None:
    """The online updates of (label, features) rows, in place; the last coordinate is the bias."""
    for y, i in rows:
        zi, ni = z.take(i), n.take(i)
        root = np.sqrt(ni)
        # 0 where |z| is at most l1, as ``weights`` has it
        w = (np.minimum(np.maximum(zi, -s.l1), s.l1) - zi) / ((s.beta + root) / s.alpha + s.l2)
        bias = -z[BIAS] / ((s.beta + n[BIAS] ** 0.5) / s.alpha)
        g = (1 / (1 + np.exp(-min(max(w.sum() + bias, -35), 35))) - y) * (s.ones if y else 1.0)
        ni = ni + g * g
        z[i] = zi + g - (np.sqrt(ni) - root) / s.alpha * w
        n[i] = ni
        z[BIAS] += g - ((n[BIAS] + g * g) ** 0.5 - n[BIAS] ** 0.5) / s.alpha * bias
        n[BIAS] += g * g


def _updates(states, settings: Settings):
    """What a part changes, in fixed point: a row per label (by its place) and block of coordinates.

    The ``value`` of ``states`` has each label's coordinates, z and n; None for one that is not asked.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(batch.num_rows):
                *ys, rows = (c[part] for c in batch.columns)
                own = [np.frombuffer(x.as_buffer(), np.int32) for x in rows.values]
                for k, state in enumerate(states.value):
                    if state is None:
                        continue
                    z, n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)
                    at, z[at], n[at] = state[0], *state[1:]
                    was_z, was_n = z.copy(), n.copy()
                    one_pass([(y, i) for y, i in zip(ys[k].as_py(), own) if y is not None], z, n, settings)
                    at = np.flatnonzero(n != was_n)
                    # whole numbers add up alike in any order
                    dz, dn = (np.rint((x[at] - was[at]) * FINE).astype(np.int64) for x, was in ((z, was_z), (n, was_n)))
                    cut = np.searchsorted(at, np.arange(0, BIAS + 1 + BLOCK, BLOCK))
                    met = [(b, x, y) for b, (x, y) in enumerate(zip(cut[:-1], cut[1:])) if y > x]
                    packed = [pa.array([c[x:y].tobytes() for _, x, y in met], pa.binary()) for c in ((at % BLOCK).astype(np.uint16), dz, dn)]
                    yield pa.RecordBatch.from_arrays([pa.array([k] * len(met), pa.int32()), pa.array([b for b, _, _ in met], pa.int32()), *packed], names=["k", "block", "i", "dz", "dn"])

    return run


def _numbers(i: bytes, *columns: bytes) -> tuple[np.ndarray, ...]:
    """Coordinates and what belongs to them, as the tables of a state hold them."""
    return np.frombuffer(i, np.int64), *map(np.frombuffer, columns)


def _epoch(labels: int, settings: Settings):
    """``_updates`` of rows of a part and the state of one label: k, i, z, n, then what the part holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                k, *state = (c[0].as_py() for c in row.columns[:4])
                states = [_numbers(*state) if j == k else None for j in range(labels)]
                part = pa.RecordBatch.from_arrays(row.columns[4:], names=row.schema.names[4:])
                yield from _updates(SimpleNamespace(value=states), settings)(iter([part]))

    return run


def _means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean change of each coordinate over the parts that met it; rows of a label and block come one after the other."""

    def out() -> pa.RecordBatch:
        at = np.flatnonzero(count)
        packed = [(at + now[1] * BLOCK).astype(np.int64), *(c[at] / count[at] / FINE for c in (dz, dn))]
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in packed)], names=["k", "i", "dz", "dn"])

    now = None
    for batch in batches:
        for k, block, i, *changes in zip(*(c.to_pylist() for c in batch.columns)):
            if (k, block) != now:
                if now:
                    yield out()
                now, (dz, dn, count) = (k, block), np.zeros((3, BLOCK), np.int64)
            at = np.frombuffer(i, np.uint16)
            count[at] += 1
            for total, own in zip((dz, dn), changes):
                total[at] += np.frombuffer(own, np.int64)
    if now:
        yield out()


def _moved(labels: int):
    """The next state, a row per label: that of the rows without a block, and the mean changes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = np.zeros((labels, 2, BIAS + 1))

        def add(k: int, *row: bytes) -> None:
            at, z, n = _numbers(*row)
            state[k, 0, at] += z
            state[k, 1, at] += n

        def changes() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                before = batch.column(1).is_null()
                for k, _, *row in zip(*(c.to_pylist() for c in batch.filter(before).columns)):
                    add(k, *row)
                yield batch.filter(pc.invert(before))

        for means in _means(changes()):
            for row in zip(*(c.to_pylist() for c in means.columns)):
                add(*row)
        for k, (z, n) in enumerate(state):
            at = np.flatnonzero(n)
            packed = [pa.array([c.tobytes()], pa.binary()) for c in (at.astype(np.int64), z[at], n[at])]
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *packed], names=["k", "i", "z", "n"])

    return run


def _left(settings: Settings):
    """Of a label's state the bias and the weights that L1 leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, *row in zip(*(c.to_pylist() for c in batch.columns)):
                at, z, n = _numbers(*row)
                bias = at == BIAS
                b = float((-z[bias] / ((settings.beta + np.sqrt(n[bias])) / settings.alpha)).sum())
                w = np.where(bias, 0.0, weights(z, n, settings))
                packed = [pa.array([c[w != 0].tobytes()], pa.binary()) for c in (at, w)]
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *packed, pa.array([b])], names=["k", "i", "w", "bias"])

    return run


def _whole(part: pa.Table) -> pa.Table:
    """A part as one row: its labels and features in the order of the updates."""
    rows = sorted(part.drop_columns("part").to_pylist(), key=lambda r: (r["turn"], r["features"]))
    kinds = {y: pa.list_(pa.float64()) for y in part.column_names[2:-1]} | {"features": pa.list_(pa.binary())}
    made = pa.table({c: pa.array([[r[c] for r in rows]], t) for c, t in kinds.items()})
    del rows
    given_back()
    return made


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's distinct features."""
    for batch in batches:
        data, off = buffers(batch.column(batch.num_columns - 1))
        found = []
        for lo, hi in chunks(off):
            hashes, first = words(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], ALNUM)
            for a, b in zip(first[:-1], first[1:]):
                found.append(np.unique(features(hashes[a:b], np.array([0, b - a]))[0]).astype(np.int32).tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.binary())], names=[*batch.schema.names[:-1], "features"])


def weights(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    """What L1 leaves of the coordinates, 0 elsewhere."""
    return np.where(np.abs(z) > s.l1, (np.sign(z) * s.l1 - z) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2), 0.0)


def fit(labelled: DataFrame, labels: tuple[str, ...], text: str = "text", doc_id: str = "doc_id", settings: Settings | None = None, what: str = "sample") -> list[tuple[np.ndarray, np.ndarray, float]]:
    """(buckets, weights, bias) of each label, learned from rows with a text and a label of 0 or 1; others are passed over.

    Without any such row all scores are one half.  ``labelled`` is bounded by the caller (``sampled``).
    """
    s = settings or Settings()
    spark = labelled.sparkSession
    ys = [F.when(F.col(label).isin(0, 1), F.col(label)).cast("double").alias(f"y{k}") for k, label in enumerate(labels)]
    names = [f"y{k}" for k in range(len(labels))]
    # the parts depend on ids alone, the order within them as well
    part = F.pmod(F.xxhash64(F.lit(5), F.col(doc_id)), F.lit(s.parts)).cast("int")
    rows = labelled.where(F.col(text).isNotNull()).select(part.alias("part"), F.xxhash64(F.lit(6), F.col(doc_id)).alias("turn"), *ys, F.col(text).alias("text"))
    rows = rows.where(F.coalesce(*names).isNotNull())
    # about ``bound`` texts, dealt once: a part of about bound / parts of them is a row, which every epoch reads again
    dealt = small_batches(rows.select("part", "turn", *names, "text"))
    found = dealt.mapInArrow(tidy(_prepared), "part int, turn long, " + ", ".join(f"{c} double" for c in names) + ", features binary")
    sample = written(found.groupBy("part").applyInArrow(_whole, ", ".join(f"{c} array<double>" for c in names) + ", features array<binary>"), what)
    # the state, at most 2**BITS + 1 coordinates a label, is a row per label; every part meets it without a shuffle or the driver
    none, paths = F.expr("X''"), []
    state = spark.range(0, len(labels), 1, 1).select(F.col("id").cast("int").alias("k"), none.alias("i"), none.alias("z"), none.alias("n"))
    for _ in range(s.epochs):
        met = state.coalesce(1).hint("shuffle_replicate_nl").crossJoin(sample)
        changed = met.mapInArrow(tidy(_epoch(len(labels), s)), "k int, block int, i binary, dz binary, dn binary")
        # one task adds up: 2**BITS + 1 coordinates of each label and part at most, whatever the corpus
        before = state.select("k", F.lit(None).cast("int").alias("block"), "i", F.col("z").alias("dz"), F.col("n").alias("dn"))
        rows = changed.repartition(1).unionByName(before).coalesce(1).sortWithinPartitions("k", "block")
        state = written(rows.mapInArrow(tidy(_moved(len(labels))), "k int, i binary, z binary, n binary"), "state", paths=paths)
        for path in paths[:-1]:
            removed(spark, path)
        del paths[:-1]
    found = {k: (np.frombuffer(i, np.int64), np.frombuffer(w), b) for k, i, w, b in state.mapInArrow(tidy(_left(s)), "k int, i binary, w binary, bias double").collect()}
    return [found[k] for k in range(len(labels))]


def scorer(models: list[tuple[np.ndarray, np.ndarray, float]]):
    """A function from a batch's string column to one column of probabilities per model and the number of words."""
    tables = []
    for at, w, bias in models:
        dense = np.zeros(1 << BITS, np.float32)
        dense[at] = w
        tables.append((dense, bias))

    def score(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
        data, off = buffers(column)
        out = [np.zeros(len(column)) for _ in tables]
        n_words = np.zeros(len(column), np.int64)
        for lo, hi in chunks(off):
            hashes, first = words(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], ALNUM)
            n_words[lo:hi] = np.diff(first)
            i, doc = features(hashes, first)
            for k, (dense, bias) in enumerate(tables):
                w = dense[i]
                hit = np.flatnonzero(w)
                # a feature counts once in a text
                pair = np.unique(doc[hit] * (1 << BITS) + i[hit])
                total = np.bincount(pair >> BITS, dense[pair & (BIAS - 1)].astype(np.float64), hi - lo)
                out[k][lo:hi] = 1 / (1 + np.exp(-np.clip(total + bias, -35, 35)))
        return out, n_words

    return score


def sampled(docs: DataFrame, labels: DataFrame, bound: int, doc_id: str = "doc_id") -> DataFrame:
    """Texts and labels of about ``bound`` labelled documents of ``docs``, by a hash of their ids.

    Labels of other documents do not count towards the bound.  Repeated labels
    of a document: the largest of each kind.  The ids are bounded by ``bound``,
    so they are broadcast and no text is shuffled.
    """
    once = labels.where(F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    here = docs.where(F.col(doc_id).isNotNull()).select(doc_id).distinct()
    present = written(once.join(here, doc_id, "left_semi"), "present")
    return docs.select(doc_id, "text").join(F.broadcast(bounded_sample(present, doc_id, bound)), doc_id)
