"""Quality rules with risk-controlled thresholds.  DataFrame functions only.

Five ratios of a text (symbols, long words, short words, repeated lines, repeated
words) may reject it.  How far their cutoffs may go is learned from labelled rows,
stratum by stratum (language and length band):

1. Half of the labelled rows (by a hash of the id) gives a ladder of cutoffs.  On
   step j a rule's cutoff is the lowest that rejects at most ``LADDER[j]`` of the
   good rows; a step that does not catch ``GAIN`` times that share of the poor rows
   leaves the rule's cutoff where it was.
2. The other half, the holdout, tests the steps in order.  A step passes if the
   exact binomial chance of as few rejected good rows, were the true share
   ``ALPHA``, is at most ``DELTA`` / strata (Bonferroni over strata; within one the
   order of the steps is fixed before, so the first step that fails ends it and no
   further correction is due).
3. The last step that passed is the stratum's verdict; without one, nothing is
   rejected there beyond the base rules.

So with a chance of 1 - DELTA no stratum rejects more than ALPHA of its good
documents.  All counts are of all labelled rows, on a fixed grid of whole numbers,
and depend neither on partitions nor on order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

SPACE = " \t\n\x0b\x0c\r"
RULES = ("symbols", "long_words", "short_words", "repeated_lines", "repeated_words")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Risk:
    #: Share of good documents that a stratum may lose, and the chance that any stratum loses more.
    alpha: float = 0.02
    delta: float = 0.05
    #: Shares of good rows that a rule may reject, step by step.
    ladder: tuple[float, ...] = (0.0, 0.001, 0.002, 0.003, 0.004, 0.006, 0.008)
    #: A rule moves on only if it catches so many times the step's share (0.001 at least) of the poor rows.
    gain: float = 5.0
    #: Words from which a text is of the second, third band.
    bands: tuple[int, int] = (200, 1000)
    #: A stratum has at least 1 / ``most`` of the good rows, so there are at most ``most``; the others are one.
    most: int = 64


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of each whole text: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Null counts as empty.  A window of three words is first looked for by hash: if all hashes of a text differ, no window repeats; else
    the windows themselves are sorted and compared.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    bare = F.btrim(t, F.lit(SPACE))
    empty = F.array().cast("array<string>")
    rows = docs.select("*", F.when(bare == "", empty).otherwise(F.split(bare, r"[\x20\x09-\x0D]+")).alias("_w"),
                       F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "").alias("_lines"),
                       (F.length(t) - F.length(F.regexp_replace(t, "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"))
    n, inside = F.size("_w"), F.greatest(F.size("_w") - 2, F.lit(0))
    windows = lambda of: F.slice(F.transform("_w", lambda x, i: of(x, F.get("_w", i + 1), F.get("_w", i + 2), i)), F.lit(1), inside)
    hashes = windows(lambda a, b, c, _: F.xxhash64(a, b, c))
    lines = F.size("_lines")
    joined = windows(lambda a, b, c, i: F.struct(F.concat_ws(" ", a, b, c).alias("k"), i.alias("i")))
    rows = rows.select(*docs.columns, "n_symbols", F.length(F.array_join("_w", "")).cast("long").alias("word_chars"), n.cast("long").alias("n_words"), lines.cast("long").alias("n_lines"),
                       (lines - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"), F.when(inside > F.size(F.array_distinct(hashes)), F.sort_array(joined)).alias("_s"))
    kept = rows.columns[:-1]
    m = F.size("_s")
    beside = F.slice(F.arrays_zip(F.col("_s").alias("x"), F.slice("_s", F.lit(2), m).alias("after"), F.concat(F.array(F.get("_s", m)), F.col("_s")).alias("before")), F.lit(1), m)
    again = F.filter(beside, lambda z: F.coalesce(z["x"]["k"] == z["after"]["k"], F.lit(False)) | F.coalesce(z["x"]["k"] == z["before"]["k"], F.lit(False)))
    covered = F.array_distinct(F.flatten(F.transform(again, lambda z: F.array(z["x"]["i"], z["x"]["i"] + 1, z["x"]["i"] + 2))))
    return rows.select(*kept, F.when(F.col("_s").isNull(), F.lit(0)).otherwise(F.size(covered)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def notches() -> dict[str, Column]:
    """Each rule's ratio as a whole number, larger is worse; texts without a word or line have 0 (or the middle)."""
    per = lambda a, b, by: F.when(F.col(b) > 0, F.least(F.floor(F.col(a) * by / F.col(b)), F.lit(10_000))).otherwise(0).cast("long")
    length = per("word_chars", "n_words", 100)
    return dict(zip(RULES, (per("n_symbols", "n_words", 1000), length, 10_000 - length, per("n_dup_lines", "n_lines", 1000), per("n_repeat_words", "n_words", 1000))))


def log_factorial(x: Column) -> Column:
    """ln x! of a whole number: a table up to 31, then Stirling's series, exact to the last digits of a double."""
    small = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(32)])
    y = F.greatest(x.cast("double"), F.lit(32.0))
    series = y * F.log(y) - y + 0.5 * F.log(2 * math.pi * y) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return F.when(x < 32, F.get(small, x.cast("int"))).otherwise(series)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """The chance of at most ``k`` of ``n`` at a share of ``p``; 1 where k >= n p.

    Summed from the largest term down: below the mean the terms fall so fast that
    about sqrt(n p) of them count, the rest are under the last digit.
    """
    top = log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p)
    terms = F.least(k, F.ceil(12 * F.sqrt(n * p)) + 50).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))
    down = lambda s, j: F.struct((s["term"] * (k - j) / (n - k + j + 1) * ((1 - p) / p)).alias("term"), (s["total"] + s["term"]).alias("total"))
    total = F.aggregate(F.sequence(F.lit(0), F.greatest(terms, F.lit(0))), start, down)["total"]
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(top) * total))


def ladders(design: DataFrame, risk: Risk) -> DataFrame:
    """stratum and for each rule its cutoffs by step (a large number: none), of rows (stratum, good, the rules' notches)."""
    long = design.select("stratum", "good", F.explode(F.create_map(*[x for r in RULES for x in (F.lit(r), F.col(r))])).alias("rule", "notch"))
    per = long.groupBy("stratum", "rule", "notch").agg(F.sum(F.col("good").cast("long")).alias("g"), F.count("*").alias("n"))
    # at most the grid's 10,001 notches a stratum and rule
    falling = Window.partitionBy("stratum", "rule").orderBy(F.desc("notch"))
    whole = Window.partitionBy("stratum", "rule")
    tail = per.select("stratum", "rule", "notch", F.sum("g").over(falling).alias("g"), F.sum(F.col("n") - F.col("g")).over(falling).alias("b"),
                      F.sum("g").over(whole).alias("gs"), F.sum(F.col("n") - F.col("g")).over(whole).alias("bs"))
    worth = lambda q: (F.col("g") <= F.lit(q) * F.col("gs")) & (F.col("b") >= F.lit(risk.gain * max(q, 0.001)) * F.col("bs")) & (F.col("b") > 0)
    # the lowest notch within the share; it counts if it is worth its step, else the step before holds
    lowest = [F.min(F.when(F.col("g") <= F.lit(q) * F.col("gs"), F.struct("notch", worth(q).alias("ok")))).alias(f"q{j}") for j, q in enumerate(risk.ladder)]
    cut = tail.groupBy("stratum", "rule").agg(*lowest)
    steps = [F.coalesce(F.when(F.col(f"q{j}.ok"), F.col(f"q{j}.notch")), F.lit(1 << 40)) for j in range(len(risk.ladder))]
    running = F.array(*[F.least(*steps[: j + 1]) if j else steps[0] for j in range(len(steps))])
    return cut.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first(running))


def first_step(rule: str) -> Column:
    """The first step whose cutoff rejects the row (the number of steps, if none does), given its notch and ``cut_`` and the rule's name."""
    return F.size(F.filter(f"cut_{rule}", lambda c: F.col(rule) < c))


def certified(labelled: DataFrame, risk: Risk | None = None) -> DataFrame:
    """A row per stratum: its cutoffs by step, ``passed`` steps, and for each the holdout's ``rejected`` good rows and their ``chance``.

    ``labelled``: doc_id, good (boolean), stratum and the rules' notches; base
    failures left out by the caller.  At most ``most`` rows and the pooled one.
    """
    risk = risk or Risk()
    rows = labelled.withColumn("design", F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 1) < "8")
    cuts = ladders(rows.where("design"), risk).withColumnsRenamed({r: f"cut_{r}" for r in RULES})
    held = rows.where("NOT design AND good").join(F.broadcast(cuts), "stratum")
    level = F.least(*[first_step(r) for r in RULES])
    n = len(risk.ladder)
    per = held.groupBy("stratum").agg(F.count("*").alias("n_good"), F.array(*[F.count_if(level <= j) for j in range(n)]).alias("rejected"))
    per = per.crossJoin(F.broadcast(per.agg(F.count("*").alias("n_strata"))))  # one row
    chance = F.transform("rejected", lambda k: binomial_tail(F.col("n_good"), k, risk.alpha))
    per = per.withColumn("chance", chance)
    fails = F.array_position(F.transform("chance", lambda p: p <= risk.delta / F.col("n_strata")), False)
    passed = F.when(fails == 0, F.lit(n)).otherwise(fails - 1).cast("int")
    return cuts.join(F.broadcast(per.withColumn("passed", passed)), "stratum").select("stratum", "n_good", "rejected", "chance", "passed", *[f"cut_{r}" for r in RULES])


def quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", risk: Risk | None = None) -> DataFrame:
    """doc_id, the counts, base_failed, kept, stratum, and ``rejected_by``: the rules that reject the document.

    ``labels``: doc_id, quality (1 good, 0 poor, others and null count as none; of
    repeated ids the largest).  Null and empty texts have no words and fail the
    base; a null language is a stratum of its own; rows with a null or repeated id
    are judged each, and a repeated id's label counts for each of its rows.  Without
    labels only the base rejects.  An empty table gives no rows; other columns,
    whatever their names, are not read.
    """
    risk = risk or Risk()
    band = F.when(F.col("n_words") < risk.bands[0], "short").when(F.col("n_words") < risk.bands[1], "middle").otherwise("long")
    rows = measured(docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))).drop("text")
    own = F.concat(F.coalesce(F.concat(F.lit("+"), "lang"), F.lit("-")), F.lit("/"), band)
    # counts without texts: read for the labelled rows and for the verdicts
    seen = written(rows.select("doc_id", *COUNTS, "n_lines", own.alias("own"), *[c.alias(r) for r, c in notches().items()]), "quality")
    once = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(F.when(F.col("quality").isin(0, 1), F.col("quality"))).alias("quality"))
    labelled = seen.where(~base_failed()).join(once.where("quality IS NOT NULL"), "doc_id").select("doc_id", (F.col("quality") == 1).alias("good"), "own", *RULES)
    good = labelled.where("good").groupBy("own").agg(F.count("*").alias("n"))
    # a stratum has 1 / most of the good rows at least, so at most ``most`` names are left
    strata = written(good.crossJoin(F.broadcast(good.agg(F.sum("n").alias("all")))).where(F.col("n") * risk.most >= F.col("all")).select("own", F.col("own").alias("stratum")), "strata")
    named = lambda df: df.join(F.broadcast(strata), "own", "left").withColumn("stratum", F.coalesce("stratum", F.lit("rest")))
    found = written(certified(named(labelled), risk), "certified")
    judged = named(seen).join(F.broadcast(found), "stratum", "left")
    by = F.array_compact(F.array(*[F.when(first_step(r) < F.col("passed"), F.lit(r)) for r in RULES]))
    by = F.when(F.col("passed").isNull(), F.array().cast("array<string>")).otherwise(by)
    out = judged.select("doc_id", *COUNTS, base_failed().alias("base_failed"), by.alias("rejected_by"), "stratum")
    return out.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (F.size("rejected_by") == 0)).alias("kept"), "stratum", "rejected_by")


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules that reject are one string here."""
    out = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.withColumn("rejected_by", F.array_join("rejected_by", ","))


def _sql(risk: Risk) -> str:
    case = lambda a, b, by: f"CASE WHEN {b} > 0 THEN least({a} * {by} // {b}, 10000) ELSE 0 END"
    length = case("word_chars", "n_words", 100)
    rules = dict(zip(RULES, (case("n_symbols", "n_words", 1000), length, f"10000 - ({length})", case("n_dup_lines", "n_lines", 1000), case("n_repeat_words", "n_words", 1000))))
    steps = ", ".join(f"({j}, {q}, {risk.gain * max(q, 0.001)})" for j, q in enumerate(risk.ladder))
    longs = " UNION ALL ".join(f"SELECT doc_id, rid, stratum, good, design, '{r}' AS rule, {r} AS notch FROM labelled" for r in RULES)
    every = " UNION ALL ".join(f"SELECT rid, stratum, '{r}' AS rule, {i} AS place, {r} AS notch FROM named" for i, r in enumerate(RULES))
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM texts),
windows AS (SELECT rid, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS k FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + d) AS n FROM again, (VALUES (0), (1), (2)) AS s(d) GROUP BY rid),
counted AS (
  SELECT rid, doc_id, lang, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM words LEFT JOIN covered USING (rid)),
seen AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         coalesce('+' || lang, '-') || '/' || CASE WHEN n_words < {risk.bands[0]} THEN 'short' WHEN n_words < {risk.bands[1]} THEN 'middle' ELSE 'long' END AS own,
         {", ".join(f"{e} AS {r}" for r, e in rules.items())}
  FROM counted),
marks AS (SELECT doc_id, max(quality) FILTER (quality IN (0, 1)) AS quality FROM labels GROUP BY doc_id),
hits AS (SELECT seen.*, quality = 1 AS good FROM seen JOIN marks USING (doc_id) WHERE quality IS NOT NULL AND NOT base_failed),
strata AS (SELECT own FROM hits WHERE good GROUP BY own HAVING count(*) * {risk.most} >= (SELECT count(*) FROM hits WHERE good)),
named AS (SELECT *, CASE WHEN own IN (SELECT own FROM strata) THEN own ELSE 'rest' END AS stratum FROM seen),
labelled AS (SELECT named.*, good, md5(CAST(named.doc_id AS VARCHAR))[1] < '8' AS design FROM named JOIN hits USING (rid)),
long AS ({longs}),
tail AS (
  SELECT *, sum(g) OVER f AS tg, sum(b) OVER f AS tb, sum(g) OVER a AS gs, sum(b) OVER a AS bs
  FROM (SELECT stratum, rule, notch, count(*) FILTER (good) AS g, count(*) FILTER (NOT good) AS b FROM long WHERE design GROUP BY ALL)
  WINDOW f AS (PARTITION BY stratum, rule ORDER BY notch DESC), a AS (PARTITION BY stratum, rule)),
steps AS (SELECT * FROM (VALUES {steps}) AS s(j, q, least_bad)),
lowest AS (
  SELECT stratum, rule, j, min(notch) AS notch, arg_min(tb >= least_bad * bs AND tb > 0, notch) AS ok
  FROM tail, steps WHERE tg <= q * gs GROUP BY ALL),
cuts AS (
  SELECT s.stratum, s.rule, s.j, min(CASE WHEN ok THEN notch END) OVER (PARTITION BY s.stratum, s.rule ORDER BY s.j) AS cut
  FROM (SELECT * FROM (SELECT DISTINCT stratum, rule FROM tail), (SELECT j FROM steps)) AS s LEFT JOIN lowest USING (stratum, rule, j)),
held AS (
  SELECT l.stratum, c.j, l.rid, coalesce(bool_or(l.notch >= c.cut), false) AS lost
  FROM long AS l JOIN cuts AS c USING (stratum, rule) WHERE l.good AND NOT l.design GROUP BY ALL),
tested AS (SELECT stratum, j, count(*) AS n, count(*) FILTER (lost) AS k FROM held GROUP BY ALL),
chances AS (
  SELECT stratum, j, CASE WHEN k >= n * {risk.alpha} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
           exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk.alpha}) + (n - i) * ln(1 - {risk.alpha})))) END AS p
  FROM tested),
passes AS (
  SELECT stratum, j, bool_and(p <= {risk.delta} / (SELECT count(DISTINCT stratum) FROM tested)) OVER (PARTITION BY stratum ORDER BY j) AS ok FROM chances),
final AS (SELECT stratum, rule, arg_max(cut, j) AS cut FROM cuts JOIN (SELECT stratum, j FROM passes WHERE ok) USING (stratum, j) GROUP BY ALL),
thrown AS (SELECT rid, string_agg(rule, ',' ORDER BY place) AS rejected_by FROM ({every}) JOIN final USING (stratum, rule) WHERE notch >= cut GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rejected_by IS NULL AS kept, stratum, coalesce(rejected_by, '') AS rejected_by
FROM named LEFT JOIN thrown USING (rid)
"""


SQL = _sql(Risk())
