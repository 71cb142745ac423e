"""Repair of conversation structure by the cheapest edits.

A conversation's rows come in order; each has a fault or none.  Edits keep a row,
give it another role, delete it or insert an empty turn, so that the roles follow a
grammar.  The cost-to-go of every grammar state is found backwards, row by row; a
walk forwards then takes, of the edits that keep to it, the one whose letter comes
first.

Both passes are streams over sorted rows: the first sees a conversation from its
last row, the second from its first, and either holds one row and one cost for each
state, however long the conversation.  All sorts are within the partitions that one
shuffle by conversation makes, and may spill.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, table, tidy

SPACE = " \t\n\x0b\x0c\r"
NEVER = 1 << 60


@dataclass(frozen=True)
class Grammar:
    """States by number, 0 the first; roles by their first letter."""

    #: From state, by a role's first letter, to state: ``(s?(ua)+)?``.
    moves: tuple[tuple[int, str, int], ...] = ((0, "s", 1), (0, "u", 2), (1, "u", 2), (2, "a", 3), (3, "u", 2))
    ends: tuple[int, ...] = (0, 3)
    #: Roles that an edit may give.
    given: tuple[str, ...] = ("user", "assistant")
    #: Costs of the edits keep, rerole, delete and insert, and what a truncated row that stays adds.
    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def __post_init__(self):
        if self.insert <= 0:
            raise ValueError("an insertion must cost something")
        for q in range(self.states()):
            if sum((q, r[:1]) in self.table() for r in self.given) > 1:
                raise ValueError(f"from state {q} two given roles lead on, so letters would not tell the edits")

    def states(self) -> int:
        return 1 + max(max(a, b) for a, _, b in self.moves)

    def table(self) -> dict[tuple[int, str], int]:
        return {(a, letter): b for a, letter, b in self.moves}

    def made(self) -> list[tuple[str, int] | None]:
        """For each state the role that an edit can give there, and the state it leads to."""
        t = self.table()
        return [next(((r, t[q, r[:1]]) for r in self.given if (q, r[:1]) in t), None) for q in range(self.states())]


class Costs:
    """Costs-to-go of a grammar."""

    def __init__(self, g: Grammar):
        self.g, self.moves, self.made, self.n = g, g.table(), g.made(), g.states()
        self.last = self.inserted([0 if q in g.ends else NEVER for q in range(self.n)])

    def inserted(self, costs: list[int]) -> list[int]:
        """``costs`` where turns may also be inserted first, as many as help."""
        for _ in range(self.n):
            costs = [min(c, self.g.insert + costs[m[1]]) if m else c for c, m in zip(costs, self.made)]
        return costs

    def edits(self, q: int, letter: str, fault: str | None, after: list[int]) -> list[tuple[str, int, int, int]]:
        """(edit, cost of it, cost with what is to go, next state) for a row in state q, by letter."""
        g = self.g
        found = [("D", g.delete, g.delete + after[q], q)]
        if fault not in ("blank", "duplicate"):
            more = g.truncated if fault == "truncated" else 0
            if (to := self.moves.get((q, letter))) is not None:
                found.append(("K", g.keep + more, g.keep + more + after[to], to))
            if self.made[q]:
                found.append(("R", g.rerole + more, g.rerole + more + after[self.made[q][1]], self.made[q][1]))
        return found

    def before(self, letter: str, fault: str | None, after: list[int]) -> list[int]:
        return self.inserted([min(e[2] for e in self.edits(q, letter, fault, after)) for q in range(self.n)])


def _backward(g: Grammar):
    """Rows (conv_id, here, role, ..., fault last), a conversation's last row first, with the costs that are to go after each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, now, after = Costs(g), object(), None
        for batch in batches:
            conv, here, role, fault = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "here", "role", "fault"))
            out = []
            for c, is_here, r, f in zip(conv, here, role, fault):
                if c != now:
                    now, after = c, costs.last
                out.append(after)
                if is_here:
                    after = costs.before(r[:1], f, after)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], names=[*batch.schema.names, "after"])

    return run


STEP = "conv_id long, step long, edit string, cost long, turn long, role string, new_role string, text string, fault string"
_STEP = pa.schema([("conv_id", pa.int64()), ("step", pa.int64()), ("edit", pa.string()), ("cost", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("new_role", pa.string()), ("text", pa.string()), ("fault", pa.string())])


def _forward(g: Grammar):
    def steps(rows) -> Iterator[tuple]:
        costs = Costs(g)
        for conv, own in groupby(rows, itemgetter(0)):
            q, k, empty = 0, 0, True
            for _, here, turn, role, text, fault, after in own:
                if not here:
                    continue
                empty, letter = False, role[:1]
                to_go = costs.before(letter, fault, after)
                while True:
                    made = costs.made[q]
                    tight = [e for e in costs.edits(q, letter, fault, after) if e[2] == to_go[q]]
                    if made and g.insert + to_go[made[1]] == to_go[q]:
                        tight.append(("I", g.insert, to_go[q], made[1]))
                    edit, cost, _, to = min(tight)
                    if edit != "I":
                        break
                    yield conv, k, "I", cost, None, None, made[0], "", None
                    q, k = to, k + 1
                new = {"D": None, "K": role}.get(edit, made and made[0])
                yield conv, k, edit, cost, turn, role, new, text, fault
                q, k = to, k + 1
            while q not in g.ends:
                yield conv, k, "I", g.insert, None, None, costs.made[q][0], "", None
                q, k = costs.made[q][1], k + 1
            if empty and not k:
                yield conv, None, None, 0, None, None, None, None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for s in steps(chain.from_iterable(zip(*(b.column(i).to_pylist() for i in range(7))) for b in batches)):
            out.append(s)
            size += len(s[7] or "") + 100
            if size > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _STEP)], schema=_STEP)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _STEP)], schema=_STEP)

    return run


def fault_of(text: Column, again: Column) -> Column:
    """A row's first fault: blank, duplicate or truncated; null without one."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare == "", "blank").when(again, "duplicate").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")


def repair(rows: DataFrame, grammar: Grammar | None = None, here: str | None = None) -> DataFrame:
    """The edits, a row each: conv_id, step, edit (K, R, D, I), cost, turn, role, new_role (null if deleted), text, fault.

    ``rows``: conv_id, turn, role, text; other columns, whatever their names, are
    not read.  Rows go by turn, null first, equal turns by role, then text; null
    roles and texts count as one space, a null conv_id is a conversation of its
    own.  Rows whose column ``here`` is not true only tell that their conversation
    exists; one without other rows is a row without an edit.  An empty table gives
    none.  The rows of a conversation come together and in order.
    """
    g = grammar or Grammar()
    there = F.lit(True) if here is None else F.coalesce(F.col(here), F.lit(False))
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    one = rows.select(F.col("conv_id").cast("long").alias("conv_id"), there.alias("here"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    in_turn = F.col("turn").asc_nulls_first()
    # all of this holds the one partitioning: windows and sorts shuffle nothing more
    again = F.row_number().over(Window.partitionBy("conv_id", "here", "role", "text").orderBy(in_turn)) > 1
    marked = one.repartition("conv_id").withColumn("again", again)
    marked = marked.select("conv_id", "here", "turn", "role", "text", "again", fault_of(F.col("text"), F.col("again")).alias("fault"))
    last_first = marked.sortWithinPartitions("conv_id", F.col("turn").desc_nulls_last(), F.desc("role"), F.desc("text"), F.desc("again"))
    ddl = "conv_id long, here boolean, turn long, role string, text string, again boolean, fault string, after array<long>"
    costed = small_batches(last_first).mapInArrow(tidy(_backward(g)), ddl)
    first_first = costed.sortWithinPartitions("conv_id", in_turn, "role", "text", "again").select("conv_id", "here", "turn", "role", "text", "fault", "after")
    return small_batches(first_first).mapInArrow(tidy(_forward(g)), STEP)


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, here: a row in twenty each is dropped (not here), emptied, loses its stops, comes twice or says user.

    By crc32 of ``conv_id:turn``, nulls as one space.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    rows = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), (kind != 0).alias("here"), F.when(kind == 3, 2).otherwise(1).alias("n"))
    return rows.select("conv_id", "turn", "role", "text", "here", F.explode(F.array_repeat(F.lit(0), F.col("n"))).alias("copy")).drop("copy")


DIGEST = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
LEGAL = ("su", "ua", "au")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation of the edits in order; a conversation holds its audit's letters and a hash, no text."""
    out = []

    def made() -> pa.RecordBatch:
        names = [c.split()[0] for c in DIGEST.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    rows = chain.from_iterable(zip(*(b.column(i).to_pylist() for i in range(9))) for b in batches)
    for conv, own in groupby(rows, itemgetter(0)):
        faults, audit, digest = {"blank": 0, "duplicate": 0, "truncated": 0}, [], hashlib.sha256()
        turns, low, high, last, illegal, cost, begun = 0, None, None, None, 0, 0, False
        for _, _, edit, price, turn, role, new_role, text, fault in own:
            if edit is None:
                continue
            audit.append(edit)
            cost += price
            if fault:
                faults[fault] += 1
            if edit != "I":
                illegal += last is not None and last + role[:1] not in LEGAL
                last = role[:1]
                if turn is not None:
                    turns += turn != high  # turns rise
                    low, high = turn if low is None else low, turn
            if new_role is not None:
                digest.update((f"\n{new_role}:" if begun else f"{new_role}:").encode() + text.encode())
                begun = True
        out.append((conv, high - low + 1 - turns if turns else 0, *faults.values(), illegal, cost, "".join(audit), digest.hexdigest()))
        if len(out) >= 10_000:
            yield made()
            out.clear()
    if out:
        yield made()


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage, repair, and the digests of the edits."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(damaged(rows), here="here").mapInArrow(tidy(_digests), DIGEST)


def _sql() -> str:
    add = lambda e, cost, edit: f"lpad(CAST(CAST({e}[1:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {e}[10:] || '{edit}'"
    stays = lambda e, x: f"CASE WHEN stay AND x = '{x}' THEN {add(e, 'more', 'K')} END"
    given = lambda e: f"CASE WHEN stay THEN {add(e, '1 + more', 'R')} END"
    return rf"""
WITH RECURSIVE kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ord(x) AS BIGINT))),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 20 AS kind
  FROM conversations),
hurt AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(2) AS r(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again,
               rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM hurt)),
rows AS (
  SELECT *, role[1] AS x, fault IS NULL OR fault = 'truncated' AS stay, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more
  FROM (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM placed)),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before || x NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(x) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM rows) GROUP BY conv_id),
-- cost and edits of the best way to each state (start, system, user, assistant) after i rows
best AS (
  SELECT conv_id, 0::BIGINT AS i, '000000000' AS e0, NULL::VARCHAR AS es, '000000005I' AS eu, '000000010II' AS ea FROM counts
  UNION ALL
  SELECT conv_id, i, e0, es, u, least(ea, {add('u', 5, 'I')}) FROM (
    SELECT *, least(eu, {add('e0', 5, 'I')}, {add('es', 5, 'I')}, {add('ea', 5, 'I')}) AS u FROM (
      SELECT b.conv_id, r.i, {add('e0', 2, 'D')} AS e0, least({add('es', 2, 'D')}, {stays('e0', 's')}) AS es,
             least({add('eu', 2, 'D')}, {", ".join(f(e) for e in ("e0", "es", "ea") for f in (lambda e: stays(e, "u"), given))}) AS eu,
             least({add('ea', 2, 'D')}, {stays('eu', 'a')}, {given('eu')}) AS ea
      FROM best AS b JOIN rows AS r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1))),
found AS (SELECT c.*, least(e0, ea) AS way FROM counts AS c JOIN best AS b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = c.n),
letters AS (SELECT conv_id, way[10:] AS audit, unnest(range(1, length(way) - 8)) AS k FROM found),
walked AS (
  SELECT conv_id, k, audit[k] AS edit, count(*) FILTER (audit[k] <> 'I') OVER w AS i, count(*) FILTER (audit[k] <> 'D') OVER w AS j
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
turned AS (
  SELECT w.*, role, CASE WHEN edit = 'I' THEN '' ELSE text END AS text, max(CASE WHEN edit = 'K' AND j = 1 AND x = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY w.conv_id) AS s
  FROM walked AS w LEFT JOIN rows AS r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i WHERE edit <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (j - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k) AS whole
  FROM turned GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(CAST(way[1:9] AS BIGINT), 0) AS cost, coalesce(way[10:], '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o LEFT JOIN found AS f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
     LEFT JOIN repaired AS p ON p.conv_id IS NOT DISTINCT FROM o.conv_id
"""


SQL = _sql()
