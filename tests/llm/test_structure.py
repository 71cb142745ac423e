"""Operators 11 to 13 against SQL, brute force and odd tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sliceworks.llm import op11_repair, op12_trie, op13_quality

from .helpers import DOCS, by_sql, docs, same

CHATS = "conv_id long, turn long, role string, text string"


# --- op11
def test_op11_equals_sql(spark, middle):
    same(op11_repair.op11_structure_repair(spark, middle).toPandas(), by_sql(op11_repair.SQL, middle), ["conv_id"])


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired) by trying every edit of every row and up to three insertions at each place."""
    found, fault = [], faults(rows)
    options = [["D"] if f in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for f in fault]
    for edits in itertools.product(*options):
        base = sum({"D": 2, "K": 0, "R": 1}[e[0]] + (5 if f == "truncated" and e != "D" else 0) for e, f in zip(edits, fault))
        for gaps in itertools.product(["", "u", "a", "ua", "au"], repeat=len(rows) + 1):
            cost = base + 5 * sum(map(len, gaps))
            if found and cost > found[0][0]:
                continue
            audit, out = "", []
            for i in range(len(rows) + 1):
                for x in gaps[i]:
                    audit, out = audit + "I", [*out, ({"u": "user", "a": "assistant"}[x], "")]
                if i < len(rows):
                    audit += edits[i][0]
                    if edits[i] != "D":
                        out.append((rows[i][0] if edits[i] == "K" else {"Ru": "user", "Ra": "assistant"}[edits[i]], rows[i][1]))
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in out)):
                found.append((cost, audit, out))
                found.sort(key=lambda x: x[:2])
                found = found[:1]
    return found[0]


def test_op11_equals_all_edits(spark):
    rnd = random.Random(11)
    rows = []
    for c in range(120):
        for t in range(rnd.randint(1, 4)):
            rows.append((c, t, rnd.choice(["user", "user", "assistant", "assistant", "system", "tool", ""]), rnd.choice(["One.", "Two!", "cut", "cut.", " \n", "", "x?  ", "Three."])))
    steps = op11_repair.repair(spark.createDataFrame(rows, CHATS)).collect()
    for c in range(120):
        own = [(r, t) for i, _, r, t in rows if i == c]
        cost, audit, out = cheapest(own)
        got = sorted((s for s in steps if s["conv_id"] == c), key=lambda s: s["step"])
        assert (sum(s["cost"] for s in got), "".join(s["edit"] for s in got)) == (cost, audit), own
        assert [(s["new_role"], s["text"]) for s in got if s["new_role"] is not None] == out
        assert [s["fault"] for s in got if s["edit"] != "I"] == faults(own)


def test_op11_edges(spark):
    """Nulls, ties, repeats, clashing and extra columns, conversations of which nothing is left, an empty table."""
    schema = CHATS + ", fault string, again int, here boolean"
    long = "word " * 50_000 + "."
    rows = [(1, None, None, None), (1, 0, "user", "b."), (1, 0, "assistant", "a."), (2, 0, "user", long), (2, 0, "user", long), (None, None, None, "x."), (4, 0, "user", "q."), (4, 3, "assistant", "r.")]
    df = spark.createDataFrame([(*r, "mine", 5, True) for r in rows] + [(3, 0, "user", "x.", None, 1, False)], schema)
    steps = op11_repair.repair(df.select(*reversed(df.columns)), here="here").collect()
    by = {c: [(s["edit"], s["role"], s["new_role"], s["fault"]) for s in sorted((s for s in steps if s["conv_id"] == c), key=lambda s: s["step"] or 0)] for c in (1, 2, 3, 4, None)}
    assert by[1] == [("D", " ", None, "blank"), ("D", "assistant", None, None), ("D", "user", None, None)] or [e[0] for e in by[1]] == ["D", "R", "R"]
    assert by[3] == [(None, None, None, None)] and [e[0] for e in by[4]] == ["K", "K"]
    assert [e[0] for e in by[2]] == ["D", "D"] and by[2][1][3] == "duplicate" and [e[0] for e in by[None]] == ["D"]
    got = {r["conv_id"]: r for r in op11_repair.repair(df, here="here").mapInArrow(op11_repair._digests, op11_repair.DIGEST).collect()}
    assert got[4]["gaps"] == 2 and got[1]["gaps"] == 0 and got[None]["gaps"] == 0
    assert (got[3]["audit"], got[3]["repaired_sha256"], got[3]["cost"]) == ("", hashlib.sha256(b"").hexdigest(), 0)
    assert op11_repair.repair(spark.createDataFrame([], CHATS)).count() == 0


def test_op11_damage(spark):
    rows = [(c, t, "assistant", f"a.{c}!b?") for c in range(30) for t in (*range(4), None)]
    got = op11_repair.damaged(spark.createDataFrame(rows, CHATS)).collect()
    for c, t, _, text in rows:
        kind = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        own = [r for r in got if (r["conv_id"], r["turn"]) == (c, t)]
        assert len(own) == (2 if kind == 3 else 1) and own[0]["here"] == (kind != 0)
        if kind:
            assert own[0]["text"] == {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text) and own[0]["role"] == ("user" if kind == 4 else "assistant")


def test_op11_shuffles_once(spark, small):
    plan = op11_repair.repair(op11_repair.damaged(spark.read.parquet(f"{small}/conversations.parquet")), here="here")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_op11_grammar_of_ones_own():
    with pytest.raises(ValueError):
        op11_repair.Grammar(moves=((0, "u", 1), (0, "a", 1)), ends=(1,))
    with pytest.raises(ValueError):
        op11_repair.Grammar(insert=0)


# --- op12
def test_op12_equals_sql(spark, middle):
    same(op12_trie.op12_prefix_trie(spark, middle).toPandas(), by_sql(op12_trie.SQL, middle), ["depth", "conv_id"])


def plain_trie(rows):
    turns = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        turns.setdefault(c, []).append((role or "", text or ""))
    paths = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(turns.get(c - int(math.fmod(c, 100)), [])[:h] + turns[c][h:])
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    out = set()
    for p, of in members.items():
        below = [q for q in members if q[: len(p)] == p]
        leaves = [q for q in below if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in members)]
        kids = [q for q in members if len(q) == len(p) + 1 and q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        ends = ",".join(str(c) for c in sorted(of) if len(paths[c]) == len(p))
        out.add((min(of), len(p), min(members[p[:-1]]) if p else None, len(of), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize("most", [3, 50_000])
def test_op12_equals_plain_trie(spark, most):
    """Families that share, missing base conversations, negative ids, ties and nulls; families in parts of three nodes as well."""
    rnd = random.Random(12)
    rows = [(c, t, rnd.choice(["user", "assistant", None, ""]), rnd.choice(["hi", "ho", "é😀", None, ""])) for c in [*range(-3, 12), *range(200, 210), *range(301, 309), *range(1000, 1004)] for t in rnd.sample([None, 0, 1, 2, 2, 3, 4, 5], rnd.randint(1, 7))]
    got = op12_trie.trie(spark.createDataFrame(rows, CHATS), most=most).collect()
    assert len(got) == len({r["key"] for r in got})
    assert {tuple(r[c] for c in NODE) for r in got} == plain_trie(rows)


def test_op12_long_conversation_and_copies(spark):
    rows = [(c, t, "user", f"t{t}") for c in (0, 700, 701) for t in range(3000)] + [(c, 0, "user", "same") for c in range(1000, 3000)]
    got = {(r["conv_id"], r["depth"]): r for r in op12_trie.trie(spark.createDataFrame(rows, CHATS), most=500).collect()}
    deep = max(d for c, d in got)
    assert deep == 3000 and got[0, 0]["n_convs"] == 2003 and got[0, 10]["n_convs"] >= 1
    ends = [r for r in got.values() if r["n_convs"] > 1500 and r["depth"] == 1]
    of = [c for c in range(1000, 3000) if min(1, zlib.crc32(str(c).encode()) % 6) == 0 or zlib.crc32(str(c - c % 100).encode()) % 6 >= 0 and zlib.crc32(str(c).encode()) % 6 >= 1]
    assert len(ends) == 1 and ends[0]["ends_sha256"] == hashlib.sha256(",".join(map(str, of)).encode()).hexdigest()


def test_op12_edges_and_rebuilt_texts(spark):
    rows = [(1, 0, "user", "gone with its base", "x", 1), (None, 0, "user", "nobody's", "x", 1), (300, None, None, None, "x", 1), (300, 0, "user", "word " * 30_000, "x", 1)]
    df = spark.createDataFrame(rows, CHATS + ", key string, depth int")
    got = op12_trie.trie(df).collect()
    assert {tuple(r[c] for c in NODE) for r in got} == plain_trie([r[:4] for r in rows if r[0] is not None])
    texts = op12_trie.rebuilt(df).where("conv_id = 300").orderBy("depth").collect()
    assert [r["text"] for r in texts] == ["", "word " * 30_000] and texts[1]["parent"] == texts[0]["key"]
    assert op12_trie.trie(spark.createDataFrame([], CHATS)).count() == 0


# --- op13
def test_op13_equals_sql(spark, middle):
    same(op13_quality.op13_quality_rules(spark, middle).toPandas(), by_sql(op13_quality.SQL, middle), ["doc_id"])


def test_op13_counts_equal_plain_ones(spark):
    rnd = random.Random(13)
    bits = ["a", "bb", "é", "😀", "#*", "$", " ", "  ", "\n", "\t", "\x0b", "\r\n", " ", "a b c", "a b c ", "x|y", "", "\\"]
    texts = [None, "", " \n ", "word " * 40_000, "one two three " * 200] + ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    got = {r["doc_id"]: r for r in op13_quality.measured(docs(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        n = Counter(zip(w, w[1:], w[2:]))
        covered = {i + d for i, k in enumerate(zip(w, w[1:], w[2:])) if n[k] > 1 for d in (0, 1, 2)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert tuple(got[i][c] for c in op13_quality.COUNTS) == want, repr(t[:80])


def test_op13_binomial_tail(spark):
    cases = [(n, k, p) for n in (1, 5, 40, 333, 5000, 2_000_000) for p in (0.01, 0.02, 0.3) for k in {0, 1, int(n * p * 0.5), max(0, int(n * p) - 1)} if k <= n]
    df = spark.createDataFrame(cases, "n long, k long, p double")
    for p in (0.01, 0.02, 0.3):
        for r in df.where(F.col("p") == p).select("n", "k", op13_quality.binomial_tail(F.col("n"), F.col("k"), p).alias("got")).collect():
            n, k = r["n"], r["k"]
            if k >= n * p:
                assert r["got"] == 1
                continue
            log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
            assert r["got"] == pytest.approx(math.fsum(math.exp(log(i)) for i in range(k + 1)), rel=1e-8, abs=1e-290)


def test_op13_rejects_few_good_ones(spark):
    """Cutoffs hold on rows that were never labelled; a stratum of few labels rejects nothing, labels that say nothing reject nothing."""
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choice("abcdefghijklmnop") for _ in range(n))
    good = lambda: " ".join(word(rnd.choice([3, 4, 5, 6, 7])) for _ in range(60))
    poor = lambda: " ".join(word(5) + rnd.choice(["", "###"]) for _ in range(60))
    rows, labels = [], []
    for i in range(6000):
        is_good = i % 4 > 0
        rows.append((i, good() if is_good else poor(), "xx" if i % 50 else "yy"))
        if i < 4000:
            labels.append((i, int(is_good), 0))
    table = docs(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in op13_quality.quality(table, marks).collect()}
    new = [got[i] for i in range(4000, 6000)]
    lost = sum(not r["kept"] for r in new if r["doc_id"] % 4) / 1500
    assert lost <= 0.02 and sum(r["kept"] for r in new if r["doc_id"] % 4 == 0 and r["doc_id"] % 50) < 5
    assert all(r["kept"] for r in got.values() if r["doc_id"] % 50 == 0)
    noise = spark.createDataFrame([(i, rnd.randint(0, 1), 0) for i, _, _ in labels], "doc_id long, quality int, toxic int")
    assert sum(not r["kept"] for r in op13_quality.quality(table, noise).collect() if not r["base_failed"]) <= 0.02 * 6000


def test_op13_edges(spark):
    rows = [(1, None, None), (2, "", "en"), (3, "word " * 60_000, "en"), (4, "a " * 10, "en"), (4, "a " * 10, "en"), (None, " ".join(map(str, range(60))), None)]
    df = docs(spark, rows).withColumn("n_words", F.lit("mine")).withColumn("good", F.lit(1))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, None, 0), (None, 1, 0), (3, 7, 0), (4, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        got = op13_quality.quality(df, labels).collect()
        assert len(got) == 6 and [r["kept"] for r in got if r["doc_id"] is None] == [True] and sum(r["base_failed"] for r in got) == 5
    assert op13_quality.quality(spark.createDataFrame([], DOCS), odd).count() == 0


def test_op13_runs_no_python(spark, small):
    plan = op13_quality.op13_quality_rules(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
