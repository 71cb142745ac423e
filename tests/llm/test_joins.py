"""Near duplicates, mixing and the pipeline against brute force."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from sliceworks.llm import components, ftrl, op2_mixing, op7_jaccard, op9_language, op10_pack
from sliceworks.llm.common import table

from .helpers import DOCS, docs


def shingles(text):
    w = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    """doc_id -> (set size, smallest id reachable)."""
    sets = [(d, shingles(t)) for d, t in rows]
    up = {d: d for d, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            both = len(a & b)
            if a and b and 100 * both >= 75 * (len(a) + len(b) - both):
                lo, hi = sorted((root(d), root(e)))
                up[hi] = lo
    return {d: (len(s), root(d)) for d, s in sets}


def assert_components(df, rows, **how):
    want = brute_components(rows)
    got = op7_jaccard.jaccard_join(df, **how).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_op7_equals_brute_force(spark, middle):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, middle, "documents").collect()]
    got = op7_jaccard.op7_ngram_jaccard(spark, middle).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows)


def families(seed, n_families=6, members=25, length=40):
    """Texts with a few replaced words each, so that similarities lie about the threshold."""
    rnd, rows = random.Random(seed), []
    passage = [f"common{i}" for i in range(12)]
    for f in range(n_families):
        base = [f"w{rnd.randint(0, 60)}" for _ in range(length)]
        for _ in range(members):
            w = list(base) + (passage if rnd.random() < 0.5 else [])
            for _ in range(rnd.randint(0, 3)):
                w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 5)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", " \t\n", "a", "A", "a b", "a b", "a b c d e", "a b c d e f", "é É", "É é"])]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("how", [{}, {"cell": 4, "part": 3}, {"counters": 16, "part": 5}])
def test_op7_about_the_threshold(spark, how):
    rows = families(len(how))
    assert_components(docs(spark, rows).repartition(5).withColumn("component_id", F.lit(1)), rows, **how)


def test_op7_edges(spark):
    assert op7_jaccard.jaccard_join(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, "a b c d e f"), (None, "a b c d e g"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "z y x w v u"), (1, "z y x w v u"), (5, "word " * 30000), (6, "word " * 20000)]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in op7_jaccard.jaccard_join(docs(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(None, 2, 1), (None, 2, None)] + [(1, 2, 1)] * 3 + [(2, 2, 1), (5, 1, 5), (6, 1, 5)], key=str)


@given(st.lists(st.sets(st.integers(0, 90), min_size=1, max_size=60), min_size=1, max_size=40), st.integers(0, 39))
@settings(max_examples=60, deadline=None)
def test_op7_tree_misses_nothing(sets, q):
    from sliceworks.llm.hashing import mix

    hashed = [np.sort(mix(np.array(sorted(s), np.uint64) + np.uint64(1))) for s in sets]
    tree = op7_jaccard.CountTree([op7_jaccard.point(s) for s in hashed], np.array([len(s) for s in hashed]))
    mine = hashed[q % len(sets)]
    near = set(tree.near(op7_jaccard.point(mine), len(mine)))
    assert {i for i, s in enumerate(hashed) if op7_jaccard.linked(mine, s)} <= near


def test_op7_sets_of_many_sizes(spark):
    """Points of different numbers of groups meet in one list."""
    rnd, rows = random.Random(77), []
    for n in (250, 256, 262, 300, 500, 520, 1000, 1030, 1300):
        for k in range(14):
            words = [f"w{i}" for i in range(n)]
            for _ in range(rnd.choice([1, 8, 12, 16])):
                words[rnd.randrange(n)] = f"x{rnd.randint(0, 9)}"
            rows.append((len(rows), " ".join(words)))
    assert_components(docs(spark, rows).repartition(4), rows)


@given(st.integers(2, 700), st.integers(0, 200), st.integers(0, 200), st.integers(0, 1 << 30))
@settings(max_examples=80, deadline=None)
def test_op7_linking_sets_share_lists(n, more, fewer, seed):
    rnd = np.random.default_rng(seed)
    order = rnd.integers(0, 9, 64).astype(np.uint16)
    drawn = np.unique(rnd.integers(0, 1 << 63, n + more, dtype=np.uint64))
    a, b = np.sort(rnd.permutation(drawn)[:n]), np.sort(rnd.permutation(drawn)[: max(2, len(drawn) - fewer)])
    if op7_jaccard.linked(a, b):
        both = len(np.intersect1d(op7_jaccard.first_ones(a, order), op7_jaccard.first_ones(b, order)))
        assert both >= max(op7_jaccard.shared_lists(-(-75 * len(s) // 100)) for s in (a, b))


def test_op7_lists_are_few(spark):
    """Two near copies share one list, however many shingles they share; a passage in common is none."""
    base = [f"w{i}" for i in range(300)]
    rows = [(1, " ".join(base)), (2, " ".join(["x", *base[1:]])), (3, " ".join([*base[:6], *(f"v{i}" for i in range(300))]))]
    _, _, classes, lists, _ = op7_jaccard.prepared(docs(spark, rows).repartition(3), "doc_id", "text", 75, 1 << 16)
    rep = {r["name"]: r["rep"] for r in classes.collect()}
    assert sorted(rep[r["name"]] for r in lists.collect()) == [1, 2]
    assert_components(docs(spark, rows), rows)


def test_op7_links_equal_brute_force(spark):
    rows = families(5, n_families=3, members=12)
    class_of = {}
    for d, t in sorted(rows):
        class_of.setdefault(shingles(t), d)
    sets = [(d, s) for s, d in class_of.items() if s]
    want = {(max(d, e), min(d, e)) for i, (d, a) in enumerate(sets) for e, b in sets[:i] if 100 * len(a & b) >= 75 * len(a | b)}
    links, members = op7_jaccard.jaccard_links(docs(spark, rows).repartition(4), cell=6)
    assert {(r["a"], r["b"]) for r in links.collect()} == want and want
    assert {r["doc_id"]: r["class_id"] for r in members.collect()} == {d: class_of[shingles(t)] if shingles(t) else d for d, t in rows}


def test_op7_links_come_from_trees(spark, monkeypatch):
    """Without what the trees give no two classes are joined."""
    monkeypatch.setattr(op7_jaccard.CountTree, "near", lambda self, p, size, percent=75: np.zeros(0, np.int64))
    rows = [(i, " ".join(["all", "of", "them", "share", "this", f"w{i % 3}"] + ["long text here"] * 9)) for i in range(6)]
    assert not list(op7_jaccard._joined(75, 0)(iter([])))[0].num_rows
    import pyarrow as pa

    from sliceworks.llm.hashing import buffers

    sets = list(op7_jaccard.shingle_sets(*buffers(pa.array([t for _, t in rows[:3]]))))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 1, 1]), pa.array(op7_jaccard.names_of(sets)), pa.array([t for _, t in rows[:3]])], names=["part", "name", "text"])
    assert sum(b.num_rows for b in op7_jaccard._joined(75, 0)(iter([batch]))) == 0
    monkeypatch.undo()
    assert sum(b.num_rows for b in op7_jaccard._joined(20, 0)(iter([batch]))) == 2


def test_op7_words_of_one_polynomial_hash(spark):
    """A word of the Thue-Morse sequence and its complement have one hash under every odd base."""
    rows = []
    for n in (16, 256, 1024, 4096):
        word = "a"
        while len(word) < n:
            word += word.translate(str.maketrans("ab", "ba"))
        other = word.translate(str.maketrans("ab", "ba"))
        rows += [(2 * n, f"one two three {word} five six"), (2 * n + 1, f"one two three {other} five six"), (2 * n + 2, word), (2 * n + 3, other)]
    assert_components(docs(spark, rows), rows)


def test_op7_repeated_id_with_another_text(spark):
    """Each text of a repeated id finds its own near copies."""
    first, second = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, first), (9, first), (9, second), (4, second + " end"), (7, first + " end"), (8, "something else that is no copy at all")]
    got = {(r["doc_id"], r["component_id"]) for r in op7_jaccard.jaccard_join(docs(spark, rows)).collect()}
    assert got == {(1, 1), (9, 1), (4, 1), (7, 1), (8, 8)}


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000 + 7 * i % 50, 1000 + 7 * (i + 1) % 50) for i in range(50)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 301)) and {v for k, v in got.items() if k >= 1000} == {1000}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- op2
def test_op2_meets_targets(spark):
    d = "/root/testdata/sf0.1"
    got = op2_mixing.op2_source_mix(spark, d).toPandas()
    n, p = got["n_tokens"].to_numpy(), got[list(op2_mixing.DOMAINS)].to_numpy()
    assert np.allclose(p.sum(axis=1), 1) and (got["rate"] >= 0).all() and len(got) == 10000
    total = (n * got["rate"].to_numpy()) @ p
    assert np.abs(total / total.sum() - [0.9, 0.07, 0.02, 0.01]).max() < 0.01


def test_op2_steps_reach_the_least_squares(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([1, 1, 1, 1], 200)
    n = rng.integers(1, 100, 200)
    rows = [(i, int(n[i]), *map(float, p[i])) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, " + ", ".join(f"{x} double" for x in op2_mixing.DOMAINS))
    mix = op2_mixing.fit_rates(df, [], {"good": 0.3, "poor": 0.3, "good_toxic": 0.2, "poor_toxic": 0.2}, budget=1.2)
    r = mix.rates(p)
    assert (r >= 0).all() and np.allclose(((n * r) @ p) / n.sum(), np.array([0.36, 0.36, 0.24, 0.24]), atol=0.01)


@pytest.mark.parametrize("most", [None, 1.0])
def test_op2_settles(spark, most):
    """Natural shares as the corpus has them; the totals are those of the least squares."""
    rng = np.random.default_rng(4)
    domain = rng.choice(4, 3000, p=[0.77, 0.11, 0.105, 0.015])
    p = rng.dirichlet([0.3] * 4, 3000) * 0.1 + 0.9 * np.eye(4)[domain]
    n = rng.integers(1, 400, 3000)
    rows = [(i, int(n[i]), *map(float, p[i])) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, " + ", ".join(f"{x} double" for x in op2_mixing.DOMAINS))
    mix = op2_mixing.fit_rates(df, [], most=most)
    r = mix.rates(p)
    total, natural = ((n * r) @ p) / n.sum(), (n @ p) / n.sum()
    assert np.allclose(mix.totals, total, rtol=1e-9) and mix.residual <= op2_mixing.STILL
    assert np.allclose([a for _, a in mix.achieved().values()], total)
    # no rate gains by a change: the slope of the least squares is 0 between the bounds, and points out of them elsewhere
    g = p @ ((total - mix.targets) / natural) + op2_mixing.PULL * (r - 1)
    inside = (r > 0) & (r < (most or np.inf))
    assert np.abs(g[inside]).max(initial=0) < 1e-5 and (g[r == 0] > -1e-5).all() and (g[r == most] < 1e-5).all()


def test_op2_equals_plain_projected_gradient(spark):
    """The totals and the rates of documents against projected gradient over explicit rates."""
    rng = np.random.default_rng(11)
    p, n = rng.dirichlet([0.4] * 4, 150), rng.integers(1, 50, 150)
    rows = [(i, int(n[i]), *map(float, p[i])) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, " + ", ".join(f"{x} double" for x in op2_mixing.DOMAINS))
    mix = op2_mixing.fit_rates(df, [], {"good": 0.5, "poor": 0.3, "good_toxic": 0.15, "poor_toxic": 0.05}, most=1.0)
    share, natural = n / n.sum(), (n @ p) / n.sum()
    r = np.ones(150)
    for _ in range(250_000):  # the weaker the pull, the slower the plain steps
        r = np.clip(r - 0.15 * (p @ (((share * r) @ p - mix.targets) / natural) + op2_mixing.PULL * (r - 1)), 0, 1)
    assert np.abs((share * r) @ p - mix.totals).max() < 1e-5 and np.abs(r - mix.rates(p)).max() < 1e-3


def test_op2_posteriors_are_plain_logistic(spark):
    import math

    import pyarrow as pa

    from sliceworks.llm.hashing import ALNUM, buffers, words

    texts = ["the quick brown fox", "", "Some words, some more words - and the rest", "x"]
    own = [sorted(set(ftrl.features(*words(*buffers(pa.array([t])), ALNUM))[0].tolist())) for t in texts]
    every = np.unique(np.concatenate([np.array(o, np.int64) for o in own]))
    rng = np.random.default_rng(3)
    models = [(every, rng.normal(size=len(every)), 0.3), (every, rng.normal(size=len(every)), -0.2)]
    got, n = op2_mixing.posteriors(ftrl.scorer(models), pa.array(texts))
    assert n.tolist() == [4, 0, 8, 1]
    for o, row in zip(own, got):
        good, toxic = (1 / (1 + math.exp(-(b + sum(w[np.searchsorted(at, i)] for i in o)))) for at, w, b in models)
        assert np.allclose(row, [good * (1 - toxic), (1 - good) * (1 - toxic), good * toxic, (1 - good) * toxic], atol=1e-6)


def test_op2_takes_token_counts(spark, middle):
    """With a column of tokens its totals meet the targets."""
    from sliceworks.llm import op1_tokens

    counted = op1_tokens.token_counts(table(spark, middle, "documents"))
    got = op2_mixing.source_mix(counted, table(spark, middle, "labels"), tokens="n_tokens").toPandas()
    n, p = got["n_tokens"].to_numpy(), got[list(op2_mixing.DOMAINS)].to_numpy()
    total = (n * got["rate"].to_numpy()) @ p
    assert np.abs(total / total.sum() - [0.9, 0.07, 0.02, 0.01]).max() < 0.01
    assert dict(zip(got["doc_id"], n)) == {r["doc_id"]: r["n_tokens"] for r in counted.select("doc_id", "n_tokens").collect()}


def test_op2_totals_meet_targets(spark, middle):
    """Each domain's own total, so that a rare one counts as well."""
    members, models = op2_mixing.members_of(table(spark, middle, "documents"), table(spark, middle, "labels"))
    mix = op2_mixing.fit_rates(members, models)
    assert np.allclose(mix.totals, mix.targets, rtol=0.02)


def test_op2_learns_from_the_documents_present(spark):
    """Labels of documents that earlier stages dropped do not use up the bound."""
    labels = spark.range(4000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    got = ftrl.sampled(docs(spark, [(i, f"text {i}") for i in range(40)] + [(None, "x")]), labels, 40)
    assert {r["doc_id"] for r in got.collect()} == set(range(40))


def test_op2_clean_documents_stay(spark, middle, caplog):
    docs_, labels = table(spark, middle, "documents"), table(spark, middle, "labels")
    with caplog.at_level("INFO"):
        kept = {r["doc_id"] for r in op2_mixing.drawn(docs_, labels).select("doc_id").collect()}
    assert "mixing keeps" in caplog.text and len(kept) > 0.85 * docs_.count()
    bad = labels.where("coalesce(quality, 0) <> 1 or coalesce(toxic, 1) <> 0").select("doc_id")
    clean = {r["doc_id"] for r in labels.join(bad, "doc_id", "left_anti").join(docs_, "doc_id", "left_semi").select("doc_id").collect()}
    assert clean and len(clean & kept) > 0.98 * len(clean)


def test_op2_edges(spark):
    rows = docs(spark, [(1, None), (2, ""), (2, ""), (3, "some words"), (None, "x"), (4, "word " * 30000)]).withColumn("rate", F.lit(1))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = op2_mixing.source_mix(rows, none).collect()
    assert len(got) == 6 and {r["n_tokens"] for r in got if r["doc_id"] in (1, 2)} == {0}
    assert op2_mixing.source_mix(spark.createDataFrame([], DOCS), none).count() == 0
    assert op2_mixing.drawn(rows, none).columns == rows.columns


# --- the pipeline
def test_pipeline_stages(spark, middle):
    docs_ = table(spark, middle, "documents")
    columns = docs_.columns
    found, seen = {}, docs_
    for name, stage in corpus_pipeline.STAGES:
        seen = corpus_pipeline.written(stage(spark, seen, middle), "test")
        found[name] = seen
        if name != "packing":
            assert seen.columns == columns
    rows = [(r["doc_id"], r["text"]) for r in found["language"].collect()]
    assert len(rows) == docs_.where("text rlike '\\\\p{L}'").count()
    last = {}
    for d, t in sorted(rows):
        last[t] = d
    exact = {r["doc_id"]: r["text"] for r in found["exact dedup"].collect()}
    assert exact == {d: t for t, d in last.items()}
    want = {root for _, root in brute_components(list(exact.items())).values()}
    assert {r["doc_id"] for r in found["near duplicates"].collect()} == want
    mixed = {r["doc_id"] for r in found["source mixing"].collect()}
    assert mixed <= want and len(mixed) > 0.4 * len(want)
    assert {r["doc_id"] for r in found["packing"].select("doc_id").collect()} == mixed
    # the draw, from the rates of the stage's input, and best fit over the lengths of what it leaves
    before, labels = found["near duplicates"], table(spark, middle, "labels")
    rates = {r["doc_id"]: r for r in op2_mixing.source_mix(before, labels, tokenizer=op10_pack.tokenizer_path(), most=1.0).collect()}
    chance = F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    assert mixed == {r["doc_id"] for r in before.select("doc_id", chance.alias("c")).collect() if r["c"] < rates[r["doc_id"]]["rate"]}
    ids = op10_pack.ids_of(op10_pack.tokenizer_path())
    assert all(rates[d]["n_tokens"] == len(ids.encode(exact[d])) for d in want)
    packed = found["packing"].collect()
    free, used = [], 0
    for n in sorted((r["length"] for r in packed), reverse=True):
        fits = [x for x in free if x >= n]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - n)
        else:
            used += 1
            free.append(op10_pack.CAPACITY - n)
    assert len({r["sequence_id"] for r in packed}) == used
    places = {}
    for r in packed:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        end = 0
        for at, n in sorted(own):
            assert at == end
            end += n
        assert end <= op10_pack.CAPACITY


def test_op2_rare_main_domain(spark):
    """Where hardly any document is of the main domain, the budget has a floor."""
    rows = [(i, 10, 1e-6, 0.4, 0.3, 0.3 - 1e-6) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, " + ", ".join(f"{d} double" for d in op2_mixing.DOMAINS))
    mix = op2_mixing.fit_rates(df, [], most=1.0)
    assert mix.targets.sum() == pytest.approx(op2_mixing.LEAST) and mix.totals.sum() > 0.02


def test_op9_learns_the_frequent_languages(spark, monkeypatch):
    monkeypatch.setattr(op9_language, "LANGUAGES", 2)
    rows = [(i, "the quick brown fox and the dog", "en") for i in range(9)] + [(20 + i, "der schnelle braune fuchs und", "de") for i in range(5)] + [(40, "le renard brun et le chien", "fr")]
    assert op9_language.learn(docs(spark, rows)).langs == ["de", "en"]


def test_pipeline_edges(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "12 34"), (4, "the same words here"), (5, "the same words here"), (5, "the same words here"), (None, "the same words here"), (None, "other words"), (6, "word " * 30000)]
    full = docs(spark, [(*r, "en") for r in rows])
    for name in ("sha", "keep_id", "KEEP_ID_", "lang_pred", "score", "languages", "n_tokens", "component_id", "name", "bucket", "a.b"):
        full = full.withColumn(name, F.lit(f"my {name}"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    none.write.parquet(str(tmp_path / "labels.parquet"))
    for table_ in (full, full.limit(0)):
        table_.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        got = corpus_pipeline.run(spark, str(tmp_path)).collect()
        assert (len(got) > 0) == (table_.count() > 0)
    stages = [corpus_pipeline.language, corpus_pipeline.exact, corpus_pipeline.near, corpus_pipeline.mixing]
    for stage, want in zip(stages, ([0, 0, 4, 5, 5, 6], [0, 2, 3, 5, 6], None, None)):
        found = stage(spark, full, str(tmp_path))
        assert found.columns == full.columns
        got = found.collect()
        assert want is None or sorted((r["doc_id"] or 0) for r in got) == want
        assert got and all(r[c] == f"my {c}" for r in got for c in full.columns[5:])


def test_pipeline_near_takes_an_id_as_one_document(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (3, text + " more"), (3, "another text that is no copy of any other"), (None, text), (4, "and one that stands alone in this table")]
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near(spark, docs(spark, rows), "").collect()]
    assert sorted(got, key=str) == sorted([rows[0], rows[3], rows[4]], key=str)
