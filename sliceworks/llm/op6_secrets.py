"""Secret scans: keyword automaton, anchored patterns at its hits, checksums.

One pass of an Aho-Corasick automaton over the text finds where a keyword of a
pattern stands; a pattern is tried only there.  Runs of hexadecimal digits have
no keyword and are found by their own pattern.  Tokens that carry a checksum of
their own body count only if it agrees.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

# Kinds, in the order of ties; patterns; least lengths.
KINDS = ("assign", "access", "hex", "github", "npm")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ASSIGN_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
HEX = re.compile(r"[0-9a-f]{16,}")
GITHUB = re.compile(r"gh[opusr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
NPM = re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum62(body: str) -> str:
    """crc32 of the body as six digits to the base 62."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out


@lru_cache(1)
def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for word in ASSIGN_KEYS:
        a.add_word(word, ("assign", len(word)))
    a.add_word("akia", ("access", 4))
    for c in "opusr":
        a.add_word(f"gh{c}_", ("github", 4))
    a.add_word("npm_", ("npm", 4))
    a.make_automaton()
    return a


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets, by start, then kind; code points, end exclusive.

    Within a kind matches are leftmost and do not overlap; a match that is too
    short, or whose checksum fails, is dropped but still takes its place.
    """
    lower = text.lower()
    if len(lower) != len(text):  # one capital letter's small form is two characters
        lower = text.replace("İ", "i").lower()
    found, after = [], dict.fromkeys(KINDS, 0)
    hits = sorted((end + 1 - size, kind) for end, (kind, size) in automaton().iter(lower))
    for at, kind in hits:
        if at < after[kind]:
            continue
        m = {"assign": ASSIGN, "access": ACCESS, "github": GITHUB, "npm": NPM}[kind].match(text, at)
        if not m:
            continue
        after[kind] = m.end()
        if kind == "assign":
            good = len(m[2]) >= ASSIGN_LEAST
        elif kind == "access":
            good = len(m[0]) >= ACCESS_LEAST
        else:
            good = checksum62(m[1]) == m[2]
        if good:
            found.append((kind, at, m.end()))
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return found


def _joined(found) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def _scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        rows = []
        for text in texts:
            found = spans(text) if text else []
            base = [s for s in found if s[0] in KINDS[:3]]
            n = [sum(s[0] == k for s in base) for k in KINDS[:3]]
            rows.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(found), [{"kind": k, "start": a, "end": b} for k, a, b in found]))
        yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"])


def secret_scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: its id, the spans found (array of structs) and digests of them.

    Null and empty texts have no spans.  Repeated rows give repeated results, a
    null id stays null, other columns are not read.
    """
    kind = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, found array<struct<kind:string,start:int,end:int>>"
    scan = F.pandas_udf(_scan, kind)
    return small_batches(docs).select(F.col(doc_id).alias("doc_id"), scan(F.coalesce(F.col(text), F.lit(""))).alias("s")).select("doc_id", "s.*")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents")).drop("found")
