"""A trie over the prefixes of rebuilt conversations, families first.

A family is the conversations c with one base id c - c % 100.  Each member takes
the first turns of the base conversation in place of its own first ones.  So most
of what conversations share they share within their family:

1. Families meet by their base id, are rebuilt turn by turn and become small
   tries.  A node's key is a digest of 128 bits over its parent's key, role and
   text; only keys, counts and ids go on, never texts.
2. The families' nodes are merged by key: members, smallest member, children.
3. The merged nodes' smallest members go back to the families, which are walked
   from the deepest nodes up.  A conversation is the smallest member of the last
   nodes of its path alone; the characters down to the last node that it is not
   the smallest of are what it saves.  These sums and the leaves add up over
   families, so one more merge by key ends it, whatever the depth.

Families and conversations go through a task as a stream of sorted rows: it holds
at most ``NODES`` nodes of a family, the base's first turns, and for the walk one
state for each conversation of the family, never a conversation's turns or a
node's members.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table, tidy, written

#: Ids of a family.
FAMILY = 100
#: A conversation takes fewer turns than this from its base.
SHARED = 6
#: Nodes of a family that a task gathers before it passes them on.
NODES = 50_000
ROOT = b""

NODE = pa.schema([("base", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32()), ("chars", pa.int64()), ("above", pa.int64()), ("n", pa.int64()), ("first", pa.int64()), ("ends", pa.list_(pa.int64()))])
TURN = pa.schema([("conv_id", pa.int64()), ("depth", pa.int32()), ("role", pa.string()), ("text", pa.string()), ("key", pa.binary()), ("parent", pa.binary())])
NODE_DDL = "base long, key binary, parent binary, depth int, chars long, above long, n long, first long, ends array<long>"


def taken(conv_id: int) -> int:
    """How many turns the conversation takes from its base."""
    return zlib.crc32(str(conv_id).encode()) % SHARED


def child(parent: bytes, role: str, text: str) -> bytes:
    """The key of the node below ``parent`` that this turn leads to."""
    said = role.encode()
    return hashlib.blake2b(parent + struct.pack("<I", len(said)) + said + text.encode(), digest_size=16).digest()


def _rebuilt(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, Iterator[tuple[str, str]]]]:
    """(base, conv_id, its turns) of rows (base, conv_id, role, text) sorted by family, the base conversation first."""
    rows = chain.from_iterable(zip(*(b.column(i).to_pylist() for i in range(4))) for b in batches)
    for base, family in groupby(rows, itemgetter(0)):
        shared: list[tuple[str, str]] = []
        for conv, turns in groupby(family, itemgetter(1)):
            own = ((role, text) for _, _, role, text in turns)
            if conv == base:
                shared = list(islice(own, SHARED - 1))
                own = chain(shared, own)
            n = taken(conv)
            yield base, conv, chain(shared[:n], islice(own, n, None))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for _, conv, turns in _rebuilt(batches):
        key = ROOT
        for depth, (role, text) in enumerate(turns, 1):
            parent, key = key, child(key, role, text)
            rows.append((conv, depth, role, text, key, parent))
            size += len(text) + 100
            if size > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), TURN)], schema=TURN)
                rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), TURN)], schema=TURN)


def _tries(most: int):
    """Families as nodes; one with more than ``most`` comes in parts, whose equal nodes add up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: dict[bytes, list] = {}

        def out(base: int) -> pa.RecordBatch:
            rows = [(base, key, *node[:6], sorted(node[6])) for key, node in nodes.items()]
            nodes.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), NODE)], schema=NODE)

        now = None
        for base, conv, turns in _rebuilt(batches):
            if base != now and nodes:
                yield out(now)
            now, key, parent, above = base, ROOT, None, 0
            for depth, turn in enumerate(chain([None], turns)):
                if turn is not None:
                    parent, key = key, child(key, *turn)
                if len(nodes) >= most and key not in nodes:
                    yield out(base)
                node = nodes.setdefault(key, [parent, depth, len(turn[1]) if turn else 0, above, 0, conv, []])
                node[4] += 1
                node[5] = min(node[5], conv)
                above += node[2]
            node[6].append(conv)
        if nodes:
            yield out(now)

    return run


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per family node what its members below have saved, counted from the root, and its leaves; rows come by family, the deepest first.

    Rows: base, key, parent, until (characters down to the node), ends, conv_id
    (the smallest member of all) and leaf (whether it has no child).
    """
    rows = chain.from_iterable(zip(*(b.column(i).to_pylist() for i in range(7))) for b in batches)
    keys, saved, leaves = [], [], []

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(saved, pa.int64()), pa.array(leaves, pa.int64())], names=["key", "saved", "leaves"])
        keys.clear(), saved.clear(), leaves.clear()
        return made

    for _, family in groupby(rows, itemgetter(0)):
        # by key, what children passed up: the conversation that is the smallest of all it ran through, sums
        states: dict[bytes, list] = {}
        for key, parts in groupby(family, itemgetter(1)):
            open_ones, total, n_leaves = states.pop(key, ([], 0, 0))
            for _, _, parent, until, ends, first, leaf in parts:
                open_ones = open_ones + ends
                n_leaves += leaf and first in ends
            total += until * sum(c != first for c in open_ones)
            keys.append(key), saved.append(total), leaves.append(n_leaves)
            if parent is not None:
                up = states.setdefault(parent, [[], 0, 0])
                up[0] += [c for c in open_ones if c == first]
                up[1] += total
                up[2] += n_leaves
            if len(keys) >= 10_000:
                yield out()
    if keys:
        yield out()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's ids, of rows (key, id) sorted by both; the ids pass by one by one."""
    rows = chain.from_iterable(zip(*(b.column(i).to_pylist() for i in range(2))) for b in batches)
    keys, found = [], []
    for key, members in groupby(rows, itemgetter(0)):
        digest = hashlib.sha256()
        for i, (_, conv) in enumerate(members):
            digest.update(f",{conv}".encode() if i else str(conv).encode())
        keys.append(key), found.append(digest.hexdigest())
        if len(keys) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found)], names=["key", "ends_sha256"])
            keys, found = [], []
    if keys:
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found)], names=["key", "ends_sha256"])


def _families(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """base, conv_id, role, text by family, in order."""
    c = F.col(conv_id).cast("long")
    who, said = (F.coalesce(F.col(x), F.lit("")) for x in (role, text))
    all_of = rows.where(F.col(conv_id).isNotNull()).select((c - c % FAMILY).alias("base"), c.alias("conv_id"), who.alias("role"), said.alias("text"), F.col(turn).alias("turn"))
    own = F.col("conv_id") != F.col("base")
    sorted_rows = all_of.repartition("base").sortWithinPartitions("base", own, "conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return small_batches(sorted_rows.select("base", "conv_id", "role", "text"))


def rebuilt(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rebuilt turns: conv_id, depth (from 1), role, text, and the keys of the node and of its parent.

    As for ``trie``; a conversation that is left without turns has no row.
    """
    return _families(rows, conv_id, turn, role, text).mapInArrow(tidy(_texts), "conv_id long, depth int, role string, text string, key binary, parent binary")


def trie(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", most: int = NODES) -> DataFrame:
    """A row per node: key, parent, conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are ordered by turn, null first, equal turns by role, then text;
    null roles and texts are empty.  Rows with a null conv_id belong to no
    conversation and are left out.  Repeated rows are repeated turns.  A
    conversation that keeps no turn ends at the root.  An empty table has no
    root and gives no rows.  Other columns, whatever their names, are not read.
    """
    families = written(_families(rows, conv_id, turn, role, text).mapInArrow(tidy(_tries(most)), NODE_DDL), "families")
    met = families.groupBy("key", "parent", "depth", "chars", "above").agg(F.sum("n").alias("n_convs"), F.min("first").alias("conv_id"))
    children = met.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = written(met.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes")
    back = families.select("base", "key", "parent", "depth", (F.col("above") + F.col("chars")).alias("until"), "ends").join(nodes.select("key", "conv_id", (F.col("n_children") == 0).alias("leaf")), "key")
    walk = back.repartition("base").sortWithinPartitions("base", F.desc("depth"), "key").select("base", "key", "parent", "until", "ends", "conv_id", "leaf")
    sums = walk.mapInArrow(tidy(_settled), "key binary, saved long, leaves long").groupBy("key").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("n_leaves"))
    ends = families.where(F.size("ends") > 0).select("key", "ends").repartition("key").select("key", F.explode("ends").alias("id")).sortWithinPartitions("key", "id")
    digests = ends.mapInArrow(tidy(_digests), "key binary, ends_sha256 string")
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums, "key").join(digests, "key", "left").join(above, "parent", "left")
    return out.select(
        "key", "parent", "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("saved") - (F.col("n_convs") - 1) * F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations")).drop("key", "parent")


SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS rn
  FROM conversations WHERE conv_id IS NOT NULL),
-- crc32 of the decimal id, bit by bit
hashed AS (
  SELECT conv_id, n, conv_id - conv_id % {FAMILY} AS base, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % {SHARED} AS h
  FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id)),
convs AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS kept FROM hashed AS c LEFT JOIN hashed AS b ON b.conv_id = c.base),
turned AS (
  SELECT c.conv_id, t.rn + 1 AS d, role, text FROM convs AS c JOIN turns AS t ON t.conv_id = c.base AND t.rn < c.h
  UNION ALL SELECT c.conv_id, c.kept + t.rn - c.h + 1, role, text FROM convs AS c JOIN turns AS t ON t.conv_id = c.conv_id AND t.rn >= c.h),
members AS (
  SELECT conv_id, d, length(text) AS chars, string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY d) AS key FROM turned
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
nodes AS (SELECT key, d, chars, count(*) AS n, min(conv_id) AS conv_id FROM members GROUP BY ALL),
up AS (SELECT u.key, m.key AS parent FROM nodes AS u JOIN members AS m ON m.conv_id = u.conv_id AND m.d = u.d - 1),
children AS (SELECT parent AS key, count(*) AS n FROM up GROUP BY parent),
below AS (
  SELECT m.key, sum((u.n - 1) * u.chars) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
  FROM nodes AS u LEFT JOIN children AS c USING (key) JOIN members AS m ON m.conv_id = u.conv_id AND m.d <= u.d GROUP BY m.key),
ended AS (SELECT arg_max(key, d) AS key, conv_id FROM members GROUP BY conv_id),
ends AS (SELECT key, string_agg(conv_id, ',' ORDER BY conv_id) AS ids FROM ended GROUP BY key)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n AS n_convs, coalesce(c.n, 0) AS n_children, leaves AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes AS v JOIN below USING (key) LEFT JOIN children AS c USING (key) LEFT JOIN ends USING (key) LEFT JOIN up USING (key) LEFT JOIN nodes AS p ON p.key = up.parent
"""
