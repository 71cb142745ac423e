"""Results that must not depend on the machine, on another caller or on luck."""

import threading

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sliceworks.llm import common, ftrl, op7_jaccard
from sliceworks.llm.common import scratch, table, written
from sliceworks.llm.hashing import SPACED, buffers, words

from .helpers import docs


def test_fit_is_the_same_however_the_rows_are_dealt(spark, middle):
    """Files, partitions and order change nothing, and the eight averaged parts equal a plain replay."""
    d = table(spark, middle, "documents").join(table(spark, middle, "labels"), "doc_id").select("doc_id", "text", "toxic").cache()
    s = ftrl.Settings(epochs=2)
    name, was = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    fits = []
    try:
        for parts, dealt in ((1, d.repartition(1)), (8, d.repartition(7, "text")), (3, d.orderBy(F.desc("doc_id")).coalesce(2))):
            spark.conf.set(name, parts)
            fits.append(ftrl.fit(dealt, ("toxic",), settings=s)[0])
    finally:
        spark.conf.set(name, was)
    for at, w, bias in fits[1:]:
        assert (at == fits[0][0]).all() and (w == fits[0][1]).all() and bias == fits[0][2]

    rows = d.select("text", "toxic", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(8)).alias("part"), F.xxhash64(F.lit(6), "doc_id").alias("turn")).where("text IS NOT NULL").orderBy("turn").collect()
    made = [(r["part"], float(r["toxic"]), np.unique(ftrl.features(*words(*buffers(pa.array([r["text"]])), ftrl.ALNUM))[0])) for r in rows]
    z, n = np.zeros(ftrl.BIAS + 1), np.zeros(ftrl.BIAS + 1)
    for _ in range(2):
        dz, dn, met = np.zeros_like(z), np.zeros_like(n), np.zeros_like(n)
        for part in range(8):
            own_z, own_n = z.copy(), n.copy()
            ftrl.one_pass([(y, i) for p, y, i in made if p == part], own_z, own_n, s)
            dz, dn, met = dz + own_z - z, dn + own_n - n, met + (own_n != n)
        z, n = z + dz / np.maximum(met, 1), n + dn / np.maximum(met, 1)
    w = ftrl.weights(z, n, s)
    w[ftrl.BIAS] = 0
    assert set(np.flatnonzero(w)) == set(fits[0][0].tolist()) and np.abs(w[fits[0][0]] - fits[0][1]).max() < 1e-6


def test_scratch_of_two_threads(spark):
    """The end of one caller's scratch leaves another's tables alone."""
    first, second, seen = threading.Event(), threading.Event(), []

    def one():
        with scratch(spark):
            t = written(spark.range(5), "one")
            first.set()
            second.wait(60)
            seen.append(t.count())

    thread = threading.Thread(target=one)
    thread.start()
    first.wait(60)
    with scratch(spark):
        paths = []
        written(spark.range(7), "two", paths=paths)
    second.set()
    thread.join()
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths[0])
    assert seen == [5] and not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place) and not common._made.open


def _hashes(word: str, key: int) -> int:
    return int(words(*buffers(pa.array([word])), SPACED, key)[0][0])


def test_words_made_to_look_alike_do_not(spark):
    """Pairs that have one hash without a key have two under any drawn one; the join tells them apart."""
    pair = "4wsjlbcag3x6sv80", "b9styjep7tg*<3g9"
    assert _hashes(pair[0], 0) == _hashes(pair[1], 0)
    assert all(_hashes(pair[0], k) != _hashes(pair[1], k) for k in (1, 3, 1 << 60))
    rows = [(1, f"one two three {pair[0]} five six seven"), (2, f"one two three {pair[1]} five six seven"), (3, "eight nine ten eleven twelve"), (4, "eight nine ten eleven twelve")]
    got = {r["doc_id"]: r["component_id"] for r in op7_jaccard.jaccard_join(docs(spark, rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 3}


def test_sets_of_one_name_are_told_apart(spark):
    """Under key 0 two texts have one name; the second key shows it, and the call goes on with the next keys."""
    pair = "4wsjlbcag3x6sv80", "b9styjep7tg*<3g9"
    rows = [(i, f"one two three {w} five six seven") for i, w in enumerate(pair)]
    drawn = iter([0, 5, 7, 9])
    _, sets, classes, _, key = op7_jaccard.prepared(docs(spark, rows), "doc_id", "text", 75, 100, drawn)
    assert key == 7 and classes.count() == 2 and len({r["name"] for r in sets.collect()}) == 2


def test_blocks_of_equal_norms_are_pruned():
    """Random directions of one length: most are passed over before their products, none that reaches the threshold."""
    from sliceworks.llm.op8_topk import pruned

    rng = np.random.default_rng(8)
    c = np.rint(64 * rng.normal(size=(3000, 64)) / 8)
    norms = np.linalg.norm(c, axis=1)
    order = np.argsort(-norms)
    c, norms = c[order], norms[order]
    units, left = c / norms[:, None], []
    for i in range(0, 3000, 60):
        s = c @ c[i]
        s[i] = -np.inf
        theta = np.sort(s)[-20]
        at = pruned(c[i], norms[i], theta, c, norms, units)
        assert set(np.flatnonzero(s >= theta)) <= set(at.tolist())
        left.append(len(at) / 3000)
    assert np.mean(left) < 0.4
    for odd in (np.zeros(64), -c[0], c[0] * 1e6):
        assert len(pruned(odd, float(np.linalg.norm(odd)), -1.0, c, norms, units)) == 3000


def test_fit_passes_on_few_rows():
    """Changes travel in a row per label and block of coordinates; their means are over the parts that met a coordinate."""
    from types import SimpleNamespace

    none = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    rnd, made = np.random.default_rng(3), []
    for _ in range(2):
        texts = [np.unique(rnd.integers(0, ftrl.BIAS, 900)).astype(np.int32) for _ in range(20)]
        part = pa.RecordBatch.from_arrays([pa.array([[float(i % 2) for i in range(20)]]), pa.array([[t.tobytes() for t in texts]], pa.list_(pa.binary()))], names=["y0", "features"])
        made += list(ftrl._updates(SimpleNamespace(value=[none]), ftrl.Settings())(iter([part])))
    assert all(b.num_rows <= ftrl.BIAS // ftrl.BLOCK + 1 for b in made)
    want, met = np.zeros(ftrl.BIAS + 1), np.zeros(ftrl.BIAS + 1)
    for b in made:
        for row in b.to_pylist():
            at = row["block"] * ftrl.BLOCK + np.frombuffer(row["i"], np.uint16).astype(int)
            want[at] += np.frombuffer(row["dz"], np.int64) / ftrl.FINE
            met[at] += 1
    got = np.zeros(ftrl.BIAS + 1)
    for b in ftrl._means(iter([pa.Table.from_batches(made).sort_by([("k", "ascending"), ("block", "ascending")]).combine_chunks().to_batches()[0]])):
        for row in b.to_pylist():
            got[np.frombuffer(row["i"], np.int64)] = np.frombuffer(row["dz"])
    assert met.max() == 2 and np.allclose(got, want / np.maximum(met, 1), rtol=0, atol=1e-11)


def test_fit_leaves_its_state_to_the_tables(spark, small, monkeypatch):
    """Nothing is broadcast, and the driver gets the weights that L1 leaves, no matter how many coordinates there are."""
    from pyspark import SparkContext

    d = table(spark, small, "documents").join(table(spark, small, "labels"), "doc_id").select("doc_id", "text", "toxic", "quality")
    sent, got, collect = [], [], type(d).collect
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: sent.append(value))
    monkeypatch.setattr(type(d), "collect", lambda self: got.append(collect(self)) or got[-1])
    with scratch(spark):
        models = ftrl.fit(d, ("toxic", "quality"), settings=ftrl.Settings(epochs=2))
    held = sum(len(v) for rows in got for r in rows for v in r if isinstance(v, (bytes, bytearray)))
    assert not sent and any(len(at) for at, _, _ in models) and held == 16 * sum(len(at) for at, _, _ in models)


def test_counters_travel_in_few_bytes():
    """Sums of counters take a byte each where all are small, more where they must."""
    made = []
    for row, times in ((0, 1), (1, 2), (2, 300)):
        counts = np.zeros(op7_jaccard.IN_ROW, np.uint8)
        counts[[3, 9]] = 255, 7
        made += [(row, counts.tobytes())] * times
    batch = pa.RecordBatch.from_arrays([pa.array([r for r, _ in made], pa.int32()), pa.array([c for _, c in made], pa.binary())], names=["row", "counts"])
    got = [r for b in op7_jaccard._summed(iter([batch])) for r in b.to_pylist()]
    for r, times, width in zip(got, (1, 2, 300), (1, 2, 4)):
        sums = np.frombuffer(r["counts"], f"u{width}")
        assert len(sums) == op7_jaccard.IN_ROW and sums[3] == 255 * times and sums[9] == 7 * times and sums.sum() == 262 * times
