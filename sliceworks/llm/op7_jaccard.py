"""N-gram Jaccard join with trees over group counts.

A document is the set of its 5-word shingles.  Hashed into groups it is a point
of counts; the overlap of two documents is at most the sum of the smaller of
their counts, and of a document and a tree node at most that with the node's
largest counts.  All pairs that are ever compared come out of such trees.

The corpus does not fit one tree, so trees are built over lists.  Two sets that
link share k of their first shingles, whatever the order of shingles, if each
gives a quarter of its set and k; the order puts shingles of many documents
last, by counters over the whole corpus, so that lists stay short.  Any order
gives the same result.  Documents with equal sets are one class.  Of lists with
the same members one stays, and who is in fewer than k lists links with nothing
and leaves them, before lists become rows that are joined.

Components need no pair inside a component that is known already, so the trees
are asked three times.  First each class goes to one of its lists, drawn by a
hash, and trees over parts of these lists join most near copies; the smallest
members of what they join meet again until no list has several parts.  Then all
lists that still hold several components are asked for one pair of any two
components, and at last those of them that had more for all pairs.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, slots, small_batches, table, tidy, written
from .components import components, renamed
from .hashing import SPACED, buffers, chunks, mix, words

WORDS = 5
#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Counters that give the order, a power of two; and how many travel in one row.
COUNTERS = 1 << 22
IN_ROW = 1 << 12
#: Sets that link share one list, and one more for each of so many shingles.
EACH = 48
#: Shingles after which a task passes its counters on, each as 255 at most.
COUNT_FLUSH = 1 << 25
#: Entries that a task gathers before it passes them on.
FLUSH = 250_000
#: In the first trees a list is dealt out to parts of about this many documents; a tree takes so many bytes of sets.
PART = 512
PART_BYTES = 32 << 20
#: Later, a longer list is dealt out to cells of about this many documents on either side.
CELL = 2048
#: Members of one component in a list from which on its lists become one.
CROWD = 8
#: Involved documents up to which their ids are broadcast.
FEW = 400_000
#: Children of a tree's node.
FAN = 16

_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_SHORT = np.uint64(0xE7037ED1A0B428DB)


def shingle_sets(data: np.ndarray, off: np.ndarray, key: int = 0) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles, under the key."""
    for lo, hi in chunks(off):
        w, first = words(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], SPACED, key)
        n = len(w) - WORDS + 1
        h = mix(sum(w[k : k + n] * _MULT[k] for k in range(WORDS))) if n > 0 else w[:0]
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= WORDS:
                yield np.unique(h[a : b - WORDS + 1])
            elif b > a:
                yield mix((w[a:b] * _MULT[: b - a]).sum(keepdims=True) + _SHORT * np.array([b - a], np.uint64))
            else:
                yield w[:0]


def least_overlap(n: int, m: int, percent: int = PERCENT) -> int:
    """The smallest intersection with which sets of n and m elements link."""
    return -(-percent * (n + m) // (100 + percent))


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def groups_of(n: int) -> int:
    """Groups for a set of n: a power of two, between half of n and n, 128 at least."""
    return 1 << min(14, max(7, int(n).bit_length() - 1))


def point(s: np.ndarray) -> np.ndarray:
    """Counts per group; the groups are the leading bits, so neighbours can be added up."""
    g = groups_of(len(s))
    counts = np.bincount((s >> np.uint64(64 - g.bit_length() + 1)).astype(np.int64), minlength=g)
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint32)


def unpacked(p: bytes, n: int) -> np.ndarray:
    """A point from its bytes, one or four for each group."""
    return np.frombuffer(p, np.uint8 if len(p) == groups_of(n) else np.uint32)


def folded(p: np.ndarray, g: int) -> np.ndarray:
    return p.reshape(g, -1).sum(axis=1, dtype=np.int32) if len(p) > g else p.astype(np.int32, copy=False)


class CountTree:
    """An R-tree over points of counts, packed from the leaves up; a node has its children's largest counts and sizes."""

    def __init__(self, points: list[np.ndarray], sizes: np.ndarray, g: int | None = None):
        """``g``: groups, no more than any point has that is held or asked for."""
        g = g or min(len(p) for p in points)
        flat = np.stack([folded(p, g) for p in points])
        # neighbours in a leaf: sizes alike, then the counts of the first groups alike
        self.order = np.lexsort((flat[:, 0], flat[:, : max(1, g // 8)].sum(axis=1), sizes.astype(np.int64) // 16))
        self.points, self.sizes = flat[self.order], sizes[self.order]
        self.levels = [(self.points, self.sizes, self.sizes)]
        while len(self.levels[-1][0]) > FAN:
            top, small, large = self.levels[-1]
            at = np.arange(0, len(top), FAN)
            self.levels.append((np.maximum.reduceat(top, at), np.minimum.reduceat(small, at), np.maximum.reduceat(large, at)))
        self.g = g

    def near(self, p: np.ndarray, size: int, percent: int = PERCENT) -> np.ndarray:
        """Places (in the given order) whose overlap with the point may suffice, those with the largest bound first."""
        p = folded(p, self.g)
        at = np.arange(len(self.levels[-1][0]))
        for k in range(len(self.levels) - 1, -1, -1):
            top, small, large = self.levels[k]
            fits = (100 * small[at] <= (10000 * size) // percent + 100) & (100 * large[at] >= percent * size)
            at = at[fits]
            bound = np.minimum(top[at], p).sum(axis=1)
            stay = bound * (100 + percent) >= percent * (size + small[at])
            at, bound = at[stay], bound[stay]
            if k:
                at = (at[:, None] * FAN + np.arange(FAN)).ravel()
                at = at[at < len(self.levels[k - 1][0])]
        return self.order[at[np.argsort(-bound, kind="stable")]]


# --- the order of shingles
def _counted(counters: int, key: int):
    """A task's counters, in rows of neighbours; each shingle of a document adds one to the counter of its last bits."""
    schema = pa.schema([("row", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            rows = np.minimum(counts, 255).astype(np.uint8).reshape(-1, min(IN_ROW, counters))
            at = np.flatnonzero(rows.any(axis=1))
            return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([rows[i].tobytes() for i in at], pa.binary())], schema=schema)

        counts, held = np.zeros(counters, np.int32), 0
        for batch in batches:
            for s in shingle_sets(*buffers(batch.column(0)), key):
                np.add.at(counts, _counter(s, counters), np.int32(1))
                held += len(s)
            if held > COUNT_FLUSH:
                yield out()
                counts[:], held = 0, 0
        if held:
            yield out()

    return run


def _counter(s: np.ndarray, counters: int) -> np.ndarray:
    return (s & np.uint64(counters - 1)).astype(np.int64)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the rows of one number, which come one after the other, with as many bytes a counter as the row's largest takes."""

    def out() -> pa.RecordBatch:
        sums = total.astype(np.min_scalar_type(total.max()))
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([sums.tobytes()], pa.binary())], names=["row", "counts"])

    now, total = None, None
    for batch in batches:
        for row, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = np.frombuffer(counts.as_buffer(), np.uint8)
            if row != now:
                if total is not None:
                    yield out()
                now, total = row, np.zeros(len(own), np.int64)
            total += own
    if total is not None:
        yield out()


def shingle_order(docs: DataFrame, counters: int = COUNTERS, key: int = 0) -> np.ndarray:
    """The rank of each counter, low where few documents of the corpus have its shingles; it shapes lists, not results.

    The number of counters is fixed, so what a task holds, the driver gets and the
    workers are sent has one size whatever the corpus.
    """
    own = small_batches(docs.where(F.col("doc_id").isNotNull()).select("text")).mapInArrow(tidy(_counted(counters, key)), "row int, counts binary")
    by_row = own.repartition(slots(docs.sparkSession), "row").sortWithinPartitions("row")
    counts = np.zeros((-(-counters // IN_ROW), min(IN_ROW, counters)), np.int64)
    for row, sums in by_row.mapInArrow(_summed, "row int, counts binary").collect():  # most rows have a byte or two a counter
        counts[row] = np.frombuffer(sums, f"u{len(sums) // counts.shape[1]}")
    values = np.unique(counts)
    rank = np.searchsorted(values, counts.ravel())
    most = np.iinfo(np.uint16).max
    return (rank * most // max(len(values) - 1, most)).astype(np.uint16)


def shared_lists(n: int) -> int:
    """Lists that a set of n gives beyond those that it may share with no linking set; n or less."""
    return 1 + n // EACH


def first_ones(s: np.ndarray, order: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The shingles of which a linking set shares some: the first by rank, those of one rank by their hash.

    Of o common shingles the first k have a place up to n - o + k in either set,
    and o is ``percent`` of n at least.  So linking sets share as many of these as
    the smaller one's ``shared_lists``, which is no less than that of ``percent`` of n.
    """
    n = len(s) - (percent * len(s) + 99) // 100 + shared_lists(len(s))
    return s[np.argsort(order[_counter(s, len(order))], kind="stable")[:n]]


def names_of(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit name for each set; equal sets have equal names."""
    filled = [s for s in sets if len(s)]
    out = np.zeros(len(sets), np.uint64)
    if filled:
        flat, n = np.concatenate(filled), np.array([len(s) for s in filled])
        begin = np.append(0, np.cumsum(n)[:-1])
        two = mix(np.add.reduceat(mix(flat * _SHORT), begin) + n.astype(np.uint64))
        out[[i for i, s in enumerate(sets) if len(s)]] = mix(np.add.reduceat(flat, begin) ^ two)
    return out.view(np.int64)


# --- one pass over the texts
#: Rows of bucket -2: a document, the size, name and point of its set.  Others: lists.
ENTRIES = "bucket int, keys binary, sets binary, doc_id long, n long, name long, proof long, point binary"


def _entries(shared, n_buckets: int, percent: int, key: int, second: int):
    schema = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("sets", pa.binary()), ("doc_id", pa.int64()), ("n", pa.int64()), ("name", pa.int64()), ("proof", pa.int64()), ("point", pa.binary())])

    def packed(keys: list, names: list) -> Iterator[pa.RecordBatch]:
        """Keys and members, by the bucket of the key."""
        if not keys:
            return
        k, d = np.concatenate(keys), np.concatenate(names)
        order = np.argsort(k)
        k, d = k[order], d[order]
        bucket = ((k >> np.uint64(40)) * np.uint64(n_buckets) >> np.uint64(24)).astype(np.int64)
        cut = np.searchsorted(bucket, np.arange(n_buckets + 1))
        rows = [(b, k[x:y].tobytes(), d[x:y].tobytes()) for b, (x, y) in enumerate(zip(cut[:-1], cut[1:])) if y > x]
        b, ks, ds = zip(*rows)
        none = pa.nulls(len(b), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(ks, pa.binary()), pa.array(ds, pa.binary()), none, none, none, none, pa.nulls(len(b), pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        keys, names, held, met = [], [], 0, set()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = buffers(batch.column(1))
            sets = list(shingle_sets(*texts, key))
            own_names, proofs = names_of(sets), names_of(list(shingle_sets(*texts, second)))
            points = []
            for doc, s, name in zip(ids, sets, own_names.tolist()):
                points.append(point(s).tobytes() if len(s) > 1 else None)
                if len(s) > 1 and doc is not None and name not in met:
                    met.add(name)
                    own = first_ones(s, order, percent)
                    keys.append(own), names.append(np.full(len(own), name, np.int64))
                    held += len(own)
            void, n = pa.nulls(len(ids), pa.binary()), [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array([-2] * len(ids), pa.int32()), void, void, pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(own_names), pa.array(proofs), pa.array(points, pa.binary())], schema=schema)
            if held > FLUSH:
                yield from packed(keys, names)
                keys, names, held, met = [], [], 0, set()
        yield from packed(keys, names)

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket of keys the lists with several members, a row each; members are in order."""

    def several() -> pa.RecordBatch:
        k, d = np.concatenate(keys), np.concatenate(names)
        order = np.lexsort((d, k))
        k, d = k[order], d[order]
        new = np.append(True, (k[1:] != k[:-1]) | (d[1:] != d[:-1]))
        k, d = k[new], d[new]
        again = k[1:] == k[:-1]
        shared = np.append(again, False) | np.append(False, again)
        k, d = k[shared], d[shared]
        begin = np.flatnonzero(np.append(k[:1] == k[:1], k[1:] != k[:-1]))
        members = pa.ListArray.from_arrays(pa.array(np.append(begin, len(k)), pa.int32()), pa.array(d))
        return pa.RecordBatch.from_arrays([pa.array(k[begin].view(np.int64)), members], names=["key", "names"])

    keys, names, now = [], [], None
    for batch in batches:
        for bucket, k, d in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            if bucket != now and keys:
                yield several()
                keys, names = [], []
            now = bucket
            keys.append(np.frombuffer(k.as_buffer(), np.uint64)), names.append(np.frombuffer(d.as_buffer(), np.int64))
    if keys:
        yield several()


# --- the first trees
def _joined(percent: int, key: int):
    """Of each part (rows of one number, in order) the members that links within the part tie to a smaller one."""

    def part(names: list[int], sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
        if len(sets) < 2:
            return [], []
        points, sizes = [point(s) for s in sets], np.array([len(s) for s in sets])
        tree = CountTree(points, sizes)
        root = np.arange(len(sets))
        for i in range(1, len(sets)):
            near = tree.near(points[i], len(sets[i]), percent)
            near = near[near < i]
            while len(near := near[root[near] != root[i]]):
                j, near = near[0], near[1:]
                if linked(sets[i], sets[j], percent):
                    root[root == max(root[i], root[j])] = min(root[i], root[j])  # names are in order
        moved = np.flatnonzero(root != np.arange(len(sets)))
        return [names[i] for i in moved], [names[root[i]] for i in moved]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            node, parent = part(names, sets)
            return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(parent, pa.int64())], names=["node", "parent"])

        names, sets, now, held = [], [], None, 0
        for batch in batches:
            own = list(shingle_sets(*buffers(batch.column(2)), key))
            for at, name, is_of, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), names_of(own).tolist(), own):
                if at != now or held > PART_BYTES:
                    yield out()
                    names, sets, held = [], [], 0
                now = at
                # a row that repeats an id may have another text, a repeated row comes again
                if is_of == name and name not in names[-1:]:
                    names.append(name), sets.append(s)
                    held += s.nbytes
        yield out()

    return run


def chosen(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows (doc_id, text) with an id among ``ids`` (rep, ...); few ids are broadcast, many are joined."""
    few = ids.count() <= FEW
    return rows.withColumnRenamed("doc_id", "rep").join(F.broadcast(ids) if few else ids, "rep")


def first_joined(lists: DataFrame, classes: DataFrame, rows: DataFrame, percent: int, key: int, part: int = PART) -> DataFrame:
    """(node, parent): most classes of a component tied to the smallest name among them, by trees over one list of each.

    A class has one list and one part of it, so what its part's tree ties it to is a root.
    """
    spark, parts = rows.sparkSession, 4 * slots(rows.sparkSession)
    list_of = lists.groupBy("name").agg(F.min(F.struct(F.xxhash64(F.lit(31), "key").alias("h"), "key")).alias("least")).select("name", "least.key")
    todo, found, turn = list_of.join(classes, "name").select("name", "rep", "key", band().alias("band")), None, 0
    while True:
        many = todo.groupBy("key", "band").agg(F.count("*").alias("m")).where("m > 1")
        own = F.pmod(F.xxhash64(F.lit(41 + turn), "name"), F.ceil(F.col("m") / part))
        dealt = written(todo.join(many, ["key", "band"]).select("name", "rep", "key", "band", "m", F.xxhash64("key", "band", own).alias("part")), "dealt")
        texts = chosen(rows, dealt.select("rep", "name", "part")).select("part", "name", "text")
        by_part = small_batches(texts).repartition(parts, "part").sortWithinPartitions("part", "name")
        tied = written(by_part.mapInArrow(tidy(_joined(percent, key)), "node long, parent long"), "tied")
        found = tied if found is None else renamed(found, tied)
        # the smallest members of what is tied meet those of the list's other parts
        left = dealt.where(F.col("m") > part).join(tied.select(F.col("node").alias("name")), "name", "left_anti").select("name", "rep", "key", "band")
        if 2 * (n_left := left.count()) > dealt.where(F.col("m") > part).count() or not n_left:
            return written(found, "first") if turn else found
        todo, turn = left, turn + 1


# --- comparison
def _compare(percent: int, key: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [list(shingle_sets(*buffers(batch.column(i)), key)) for i in (2, 3)]
            # a row that repeats an id may have another text
            own = [names_of(sets) == batch.column(i).to_numpy() for i, sets in enumerate(sides)]
            ok = [bool(p and q) and linked(x, y, percent) for p, q, x, y in zip(*own, *sides)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame, percent: int, key: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets link, as a written table."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()
    texts = chosen(rows, written(classes.join(named, "name").select("rep", "name"), "ids"))
    ta, tb = (texts.select(F.col("name").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    both = pairs.join(tb, "b").join(ta, "a").select("a", "b", "text_a", "text_b")
    return written(small_batches(both).mapInArrow(tidy(_compare(percent, key)), "a long, b long").distinct(), "links")


def _trees(percent: int, forest: bool):
    """Pairs of a cell that the bounds let pass, of different components.

    With ``forest`` one pair for any two components that may meet, the best of
    its member, and the cell itself (a and b null) if it had others.
    """

    def pairs(across, name, comp, sizes, points, visitor, in_crowd) -> tuple[list[int], list[int], bool]:
        asks = np.flatnonzero(in_crowd == 0)
        held = np.flatnonzero(in_crowd == 1) if across else asks
        a, b, more = [], [], False
        if len(asks) and len(held):
            tree = CountTree([points[i] for i in held], sizes[held], min(map(len, points)))
            tied = comp.copy()
            for i in asks:
                near = held[tree.near(points[i], sizes[i], percent)]
                # two visitors have met in their own band
                near = near[(across | (name[near] < name[i])) & (comp[near] != comp[i]) & (visitor[near] + visitor[i] < 2)]
                n, taken = len(near), len(a)
                while forest and len(near := near[tied[near] != tied[i]]):
                    a.append(max(name[i], name[near[0]])), b.append(min(name[i], name[near[0]]))
                    tied[tied == tied[near[0]]] = tied[i]
                if not forest:
                    a.extend(np.maximum(name[near], name[i])), b.extend(np.minimum(name[near], name[i]))
                more |= len(a) - taken < n
        return a, b, more

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            name, comp, sizes, points, visitor, in_crowd = zip(*rows)
            a, b, more = pairs(now[3] >= 0, np.array(name), np.array(comp), np.array(sizes), [unpacked(p, n) for p, n in zip(points, sizes)], np.array(visitor), np.array(in_crowd))
            if more:
                a, b = [*a, None], [*b, None]
            cell = [pa.array([x] * len(a), t) for x, t in zip(now, kinds)]
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), *cell], names=["a", "b", *CELL_OF])

        rows, now = [], None
        for batch in batches:
            kinds = [c.type for c in batch.columns[: len(CELL_OF)]]
            for *cell, name, comp, n, p, visitor, in_crowd in zip(*(c.to_pylist() for c in batch.columns)):
                if cell != now and rows:
                    yield flush()
                    rows = []
                now = cell
                rows.append((name, comp, n, p, visitor, in_crowd))
        if rows:
            yield flush()

    return run


#: A list, one of its cells: a block of the crowd and one of the others, or (first number -1) two of the others.
CELL_OF = ("list", "crowded", "band", "block", "other")
CELL_TYPES = "list long, crowded boolean, band int, block int, other int"


def cells(lists: DataFrame, cell: int = CELL) -> DataFrame:
    """Lists dealt to cells, so that any two members of different components meet.

    The crowd, members of the one large component of a list, is dealt to blocks
    of about ``cell``, all others as well.  Every block of the crowd meets every
    block of the others, and every two blocks of the others meet; two of the
    crowd need not.
    """
    key = ["list", "crowded", "band"]
    sizes = lists.groupBy(*key).agg(F.ceil(F.sum("in_crowd") / cell).cast("int").alias("ki"), F.greatest(F.lit(1), F.ceil(F.sum(1 - F.col("in_crowd")) / cell)).cast("int").alias("kj"))
    rows = lists.join(sizes, key)
    inside = F.col("in_crowd") == 1
    own = F.pmod(F.xxhash64(F.lit(3), "name"), F.when(inside, F.greatest(F.lit(1), "ki")).otherwise(F.col("kj"))).cast("int")
    rows = rows.withColumn("own", own)

    def at(block, other):
        return F.struct(block.cast("int").alias("block"), other.cast("int").alias("other"))

    up_to_j = F.sequence(F.lit(0), F.col("kj") - 1)
    to_others = F.transform(up_to_j, lambda j: at(F.col("own"), j))
    to_crowd = F.transform(F.filter(F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("ki") - 1)), lambda i: i < F.col("ki")), lambda i: at(i, F.col("own")))
    among = F.transform(up_to_j, lambda o: at(F.lit(-1), F.least("own", o) * F.col("kj") + F.greatest("own", o)))
    return rows.withColumn("cell", F.explode(F.when(inside, to_others).otherwise(F.concat(to_crowd, among)))).select("*", "cell.*").drop("cell", "ki", "kj", "own")


def band() -> F.Column:
    """The size band of a set of n; a set links with sets of its own band and of the next ones on either side."""
    return F.floor(F.log("n") / float(np.log(100 / PERCENT + 0.007))).cast("int")


def open_lists(lists: DataFrame, classes: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Lists (list, crowded, band, name, comp, visitor, in_crowd) that still hold several components, as a written table.

    Lists are parted by size: a set meets those of its own band and of the next.
    Of lists with the same members one stays.  Where a component has many members
    in a list, its lists become one, so that each member is compared once.
    """
    placed = lists.withColumn("comp", F.col("name"))
    if comps is not None:
        placed = lists.join(comps.withColumnRenamed("node", "name"), "name", "left").select("key", "name", F.coalesce("parent", "name").alias("comp"))
    several = placed.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("key")
    sized = placed.join(several, "key", "left_semi").join(classes.select("name", "n"), "name").withColumn("band", band())
    visits = F.array(F.struct(F.col("band").alias("band"), F.lit(0).alias("visitor")), F.struct((F.col("band") + 1).alias("band"), F.lit(1).alias("visitor")))
    parted = sized.select("key", "name", "comp", F.explode(visits).alias("v")).select("key", "v.band", "name", "comp", "v.visitor")
    members_of = [F.bit_xor(F.xxhash64(F.lit(seed), "name", "visitor")).alias(f"h{seed}") for seed in (21, 22)]
    each = parted.groupBy("key", "band").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("m"), F.min("visitor").alias("v"), *members_of)
    mixed = each.where("x < y AND v = 0").groupBy("m", "band", "h21", "h22").agg(F.min("key").alias("key")).select("key", "band")
    if comps is None:
        alone = parted.join(mixed, ["key", "band"], "left_semi")
        return written(alone.select(F.col("key").alias("list"), F.lit(False).alias("crowded"), "band", "name", "comp", "visitor", F.lit(0).alias("in_crowd")), "open")
    per = parted.join(mixed, ["key", "band"], "left_semi").groupBy("key", "band", "comp").agg(F.count("*").alias("c"))
    top = per.groupBy("key", "band").agg(F.max(F.struct("c", (-F.col("comp")).alias("comp"))).alias("top"))
    crowd = F.when(F.col("top.c") >= CROWD, -F.col("top.comp"))
    named = top.select("key", "band", crowd.isNotNull().alias("crowded"), F.coalesce(crowd, "key").alias("list"))
    in_crowd = (F.col("crowded") & (F.col("comp") == F.col("list"))).cast("int").alias("in_crowd")
    return written(parted.join(named, ["key", "band"]).select("list", "crowded", "band", "name", "comp", "visitor", in_crowd).distinct(), "open")


def candidates(dealt: DataFrame, points: DataFrame, percent: int, forest: bool) -> DataFrame:
    """What the trees of the cells give, as a written table: pairs (a, b), and with ``forest`` cells that had more of them."""
    parts = 4 * slots(dealt.sparkSession)
    ready = dealt.join(points, "name").select(*CELL_OF, "name", "comp", "n", "point", "visitor", "in_crowd")
    by_cell = small_batches(ready).repartition(parts, *CELL_OF).sortWithinPartitions(*CELL_OF)
    return written(by_cell.mapInArrow(tidy(_trees(percent, forest)), f"a long, b long, {CELL_TYPES}"), "near")


def prepared(docs: DataFrame, doc_id: str, text: str, percent: int, counters: int, keys: Iterator[int] | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, int]:
    """Written tables of one pass over the texts, and the key of the hashes: the rows, sets (doc_id, n, name, point), classes (name, rep, n) and lists (key, name) with several classes.

    Words are hashed under a key drawn for the call, so no text can be made to
    look like another.  Each set also has a name under a second key; where sets of
    one name differ in it, two hashes were equal by chance, and all is done again
    under other keys.
    """
    spark = docs.sparkSession
    keys = keys or iter(lambda: secrets.randbits(63) | 1, None)
    key, second = next(keys), next(keys)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = spark.sparkContext.broadcast(shingle_order(rows, counters, key))  # two bytes a counter
    parts = slots(spark)
    made = written(small_batches(rows).mapInArrow(tidy(_entries(order, 8 * parts, percent, key, second)), ENTRIES), "entries")
    order.destroy()
    sets = made.where("bucket = -2").select("doc_id", "n", "name", "point")
    alike = made.where("bucket = -2 AND n > 0 AND doc_id IS NOT NULL").groupBy("name").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.min("proof").alias("p"), F.max("proof").alias("q"))
    classes = written(alike, "classes")
    if classes.where("p <> q").limit(1).count():
        return prepared(docs, doc_id, text, percent, counters, keys)
    classes = classes.select("name", "rep", "n")
    by_bucket = made.where("bucket >= 0").select("bucket", "keys", "sets").repartition(2 * parts, "bucket").sortWithinPartitions("bucket")
    return rows, sets, classes, lists_of(by_bucket.mapInArrow(tidy(_met), "key long, names array<long>"), classes, percent), key


def lists_of(met: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(key, name) of lists (key, names), as a written table: one of those with the same members, less those who are in too few to link.

    The key that stays has the smallest hash, so the list that a class draws is the same as among all.
    """
    once = met.groupBy("names").agg(F.min_by("key", F.xxhash64(F.lit(31), "key")).alias("key"), F.count("*").alias("alike"))
    each = written(once.select("key", "alike", F.explode("names").alias("name")), "alike")
    in_lists = each.groupBy("name").agg(F.sum("alike").alias("lists")).join(classes.select("name", "n"), "name")
    partner = F.ceil(F.col("n") * percent / 100)  # the smallest set that links
    enough = in_lists.where(F.col("lists") > F.floor(partner / EACH)).select("name")
    return written(each.select("key", "name").join(enough, "name", "left_semi"), "lists")


def points_of(names: DataFrame, sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(name, n, point) of the classes with these names, as a written table."""
    some = classes.join(names.select("name").distinct(), "name").select("name", F.col("rep").alias("doc_id"))
    few = some.count() <= FEW
    return written(sets.where("point IS NOT NULL").join(F.broadcast(some) if few else some, ["name", "doc_id"]).select("name", "n", "point"), "points")


def jaccard_links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, counters: int = COUNTERS, cell: int = CELL) -> tuple[DataFrame, DataFrame]:
    """The join itself: all links (a, b) between class representatives, a > b, and the membership (doc_id, n_shingles, class_id).

    A family of m near copies has up to m * m / 2 links, and all are compared and
    returned; ``jaccard_join`` gives components without that.  Texts, sets and
    rows count as there.
    """
    rows, sets, classes, lists, key = prepared(docs, doc_id, text, percent, counters)
    everything = open_lists(lists, classes, None)
    near = candidates(cells(everything, cell), points_of(everything, sets, classes), percent, forest=False)
    links = verified(near.select("a", "b").distinct(), classes, rows, percent, key)
    reps = classes.select("name", "rep")
    a, b = (reps.select(F.col("name").alias(x), F.col("rep").alias(f"rep_{x}")) for x in "ab")
    # a repeated id may stand for several classes
    named = links.join(a, "a").join(b, "b").select(F.greatest("rep_a", "rep_b").alias("a"), F.least("rep_a", "rep_b").alias("b")).where("a <> b").distinct()
    members = sets.join(reps.hint("merge"), "name", "left")
    return named, members.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("class_id"))


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, counters: int = COUNTERS, cell: int = CELL, part: int = PART) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id for every document.

    Components only: pairs of one component are compared no further than joins
    it; ``jaccard_links`` gives the links.

    ``component_id``: the smallest doc_id reachable by links; ``class_id``: the
    smallest doc_id with the same set.  Words are what blanks and tab to carriage
    return leave, A-Z in small form; with fewer than five words the whole
    sequence is one shingle; null, empty and blank texts have none and link with
    nothing.  An id is one document: rows that repeat it each return a row and
    are linked through each one's own set, and all of them are in one component
    (but for those without words).  A row with a null id joins only the class of
    its own set and links with nothing else.  An empty table gives no rows; other
    columns are not read.
    """
    with scratch(docs.sparkSession):
        return written(_components(docs, doc_id, text, percent, counters, cell, part), "components", stays=True)


def _components(docs: DataFrame, doc_id: str, text: str, percent: int, counters: int, cell: int, part: int) -> DataFrame:
    rows, sets, classes, lists, key = prepared(docs, doc_id, text, percent, counters)
    first = first_joined(lists, classes, rows, percent, key, part)

    def with_links(known: DataFrame, links: DataFrame) -> DataFrame:
        up = [known.select(F.col("node").alias(x), F.col("parent").alias(f"r{x}")) for x in "ab"]
        edges = links.join(up[0], "a", "left").join(up[1], "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
        return written(renamed(known, components(edges).withColumnRenamed("root", "parent")), "comps")

    still = open_lists(lists, classes, first)
    points = points_of(still, sets, classes)
    near = candidates(cells(still, cell), points, percent, forest=True)
    tried = near.where("a IS NOT NULL").select("a", "b").distinct()
    comps = with_links(first, verified(tried, classes, rows, percent, key))

    more = near.where("a IS NULL").select(*CELL_OF).distinct()
    if more.limit(1).count():
        now = comps.select(F.col("node").alias("name"), "parent")
        dealt = cells(still, cell).join(more, [*CELL_OF], "left_semi").join(now, "name", "left").withColumn("comp", F.coalesce("parent", "comp")).drop("parent")
        rest = candidates(dealt, points, percent, forest=False).select("a", "b").distinct()
        comps = with_links(comps, verified(rest.join(tried, ["a", "b"], "left_anti"), classes, rows, percent, key))

    # an id that is repeated with different texts ties its classes together
    several = sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("name").alias("b"), F.max("name").alias("x")).where("b < x").select("doc_id", "b")
    ties = sets.where("n > 0").join(several, "doc_id").select(F.col("name").alias("a"), "b").where("a <> b")
    if ties.limit(1).count():
        comps = with_links(comps, ties)
    in_comp = classes.join(comps.withColumnRenamed("node", "name"), "name", "left").select("name", "rep", F.coalesce("parent", "name").alias("root"))
    least = in_comp.groupBy("root").agg(F.min("rep").alias("component_id"))
    ids = in_comp.join(least, "root").select("name", "rep", "component_id")
    out = sets.join(ids.hint("merge"), "name", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("rep", "doc_id").alias("class_id"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).drop("class_id")
