"""Chat formatting: a declarative template and a state machine over roles.

DataFrame functions only.  A conversation becomes an array of segments, each
with a loss flag, and their concatenation.  The template's marks inside texts are
broken up by a backslash after their first character; backslashes are doubled
before, so the escape can be undone.  Escape and reading follow from the
template alone; one whose marks could be mistaken for each other is refused.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


@dataclass(frozen=True)
class Turn:
    """How a role's turn is marked, and whether its text counts for the loss."""

    opens: str
    closes: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    turns: dict[str, Turn] = field(default_factory=lambda: {
        "system": Turn("<<SYS>>", "<</SYS>>"),
        "user": Turn("[INST]", "[/INST]"),
        "assistant": Turn("<s>", "</s>", loss=True),
    })
    #: Any other role: its name stands between ``opens`` and ``names``.
    other: Turn = Turn("<<ROLE>>", "<</ROLE>>")
    names: str = "<|>"
    #: From state, by role, to state; what is missing is an error.
    moves: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "system"),
        ("start", "user", "user"),
        ("system", "user", "user"),
        ("user", "assistant", "assistant"),
        ("assistant", "user", "user"),
    )
    #: States in which a conversation may end.
    ends: tuple[str, ...] = ("user", "assistant")

    def __post_init__(self):
        marks = self.marks()
        opens = [kind.opens for kind in (*self.turns.values(), self.other)]
        if len(set(opens)) < len(opens):
            raise ValueError("two roles open alike")
        for m in marks:
            if len(m) < 2 or "\\" in m:
                raise ValueError(f"a mark has two characters or more and no backslash: {m!r}")
            for other in marks:
                for k in range(m == other, len(m)):
                    if m[k:].startswith(other) or other.startswith(m[k:]):
                        raise ValueError(f"marks overlap: {m!r}, {other!r}")

    def marks(self) -> list[str]:
        kinds = (*self.turns.values(), self.other)
        return list(dict.fromkeys([*(m for kind in kinds for m in (kind.opens, kind.closes)), self.names]))

    def control(self) -> str:
        """Pattern of the first character of every mark."""
        return "(" + "|".join(f"{re.escape(m[0])}(?={re.escape(m[1:])})" for m in self.marks()) + ")"

    def turn(self) -> str:
        """Pattern of a turn with its marks."""
        return "(?s)" + "|".join(f"{re.escape(kind.opens)}.*?{re.escape(kind.closes)}" for kind in (*self.turns.values(), self.other))


def escaped(text: Column, template: Template) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, template.control(), r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_chat(rows: DataFrame, template: Template | None = None, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, n_turns, valid, end_state, segments, formatted.

    ``segments``: array of (text, loss), in order.  ``valid``: the roles follow
    the template's moves and end in one of its end states; other conversations
    are formatted as well.  Null roles and texts count as empty, null turns come
    first, equal turns are ordered by role, then text; a null conv_id is a
    conversation of its own.  Repeated rows are repeated turns.  An empty table
    gives no rows; other columns are not read.
    """
    t = template or Template()
    who = F.coalesce(F.col(role), F.lit(""))
    opens = F.concat(F.lit(t.other.opens), escaped(who, t), F.lit(t.names))
    closes, loss = F.lit(t.other.closes), F.lit(t.other.loss)
    for name, kind in t.turns.items():
        is_it = who == F.lit(name)
        opens = F.when(is_it, F.lit(kind.opens)).otherwise(opens)
        closes = F.when(is_it, F.lit(kind.closes)).otherwise(closes)
        loss = F.when(is_it, F.lit(kind.loss)).otherwise(loss)
    content = F.coalesce(F.col(text), F.lit(""))
    one = F.struct(
        F.col(turn).alias("turn"), who.alias("role"), content.alias("plain"),
        opens.alias("opens"), escaped(content, t).alias("content"), closes.alias("closes"), loss.alias("loss"),
    )
    steps = F.create_map(*[F.lit(x) for a, b, c in t.moves for x in (f"{a}\n{b}", c)])
    off = F.lit(False)
    whole = rows.groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda x: F.array(
        F.struct(x["opens"].alias("text"), off.alias("loss")),
        F.struct(x["content"].alias("text"), x["loss"].alias("loss")),
        F.struct(x["closes"].alias("text"), off.alias("loss")),
    )))
    state = F.aggregate("turns", F.lit("start"), lambda s, x: F.coalesce(F.element_at(steps, F.concat(s, F.lit("\n"), x["role"])), F.lit("error")))
    out = whole.select("conv_id", F.size("turns").cast("long").alias("n_turns"), state.alias("end_state"), segments.alias("segments"))
    return out.select(
        "conv_id", "n_turns", F.col("end_state").isin(*t.ends).alias("valid"), "end_state", "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def read_back(formatted: Column, template: Template | None = None) -> Column:
    """Array of (role, text) that a formatted conversation holds."""
    t = template or Template()
    turns = F.regexp_extract_all(formatted, F.lit(t.turn()), F.lit(0))

    def parse(x: Column) -> Column:
        n, k = len(t.other.opens), len(t.other.closes)
        inner = F.substr(x, F.lit(n + 1), F.length(x) - (n + k))
        cut = F.instr(inner, t.names)
        role = unescaped(F.substr(inner, F.lit(1), cut - 1))
        text = F.substr(inner, cut + len(t.names))
        for name, kind in t.turns.items():
            is_it = F.startswith(x, F.lit(kind.opens))
            role = F.when(is_it, F.lit(name)).otherwise(role)
            text = F.when(is_it, F.substr(x, F.lit(len(kind.opens) + 1), F.length(x) - (len(kind.opens) + len(kind.closes)))).otherwise(text)
        return F.struct(role.alias("role"), unescaped(text).alias("text"))

    return F.transform(turns, parse)


#: The conversation that the query adds.
EXTRA = "SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the output: turns as read back from ``formatted``, loss from the flagged ``segments``."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    chats = format_chat(rows.unionByName(spark.sql(EXTRA)))
    turns = read_back(F.col("formatted"))
    said = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
    out = chats.select("conv_id", "formatted", "valid", turns.alias("back"), said.alias("said"))
    return out.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("back", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("said").cast("long").alias("loss_chars"),
        F.sha2("said", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
esc AS (
  SELECT *, length(t2) + length(regexp_extract_all(t2, '</?s>|<</?(?:SYS|ROLE)>>|<\|>|\[/?INST\]')) AS n_text,
         CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 20 + length(role) END AS n_marks
  FROM (SELECT *, replace(text, '\', '\\') AS t2 FROM rows)),
moves AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS prev FROM esc),
ok AS (
  SELECT *, CASE WHEN role = 'system' THEN prev IS NULL
                 WHEN role = 'user' THEN prev IS NULL OR prev IN ('system', 'assistant')
                 WHEN role = 'assistant' THEN prev = 'user' ELSE false END AS good FROM moves)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n_text + n_marks) AS BIGINT) AS formatted_chars,
       bool_and(good) AND arg_max(role, turn) IN ('user', 'assistant') AS valid
FROM ok GROUP BY conv_id
"""
