"""N-gram Jaccard join with signature trees.

Texts are sets of word shingles. Texts with equal sets (by 128 bits of hash) form a
class, named by one of its rows, so that rows without an id or under a repeated one
are texts like any other. Classes that share a MinHash band form a candidate cluster, and inside a cluster
signature trees find the links: a node holds the OR of its members' token
bitmaps and their size range, and a dual traversal drops node pairs whose
largest possible overlap is too small. What is left is compared exactly.
Pairs already connected are skipped, so a group of copies yields a spanning
set of links, never all its pairs.

Band count follows from the threshold so that a pair at the threshold shares
no band with a chance below ``MISS``. Clusters beyond ``BLOCK`` classes are cut
into blocks by size class, and only blocks of equal or neighbouring size
classes meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vetrow.llm.common import boxed, components, map_batches, save, tasks_for

WORDS = 4
PERCENT = 85
ROWS = 4
MISS = 1e-8
BLOCK = 512
LEAF = 8
FAN = 8
SHINGLES_PER_TASK = 2_000_000
SHINGLES_PER_BLOCK = 500_000

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands that a pair at the threshold misses all of with a chance below ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles: ASCII letters lower-cased, words cut at
    ASCII white space; fewer words than a shingle has are one shingle, no words are none."""
    parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not parts:
        return np.zeros(0, np.uint64)
    if len(parts) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(parts), seed=words)], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    n = len(h) - words + 1
    out = h[:n].copy()
    for k in range(1, words):
        out = (out ^ (out >> np.uint64(29))) * _MIX[0] + h[k: k + n] * _MIX[1]
    out ^= out >> np.uint64(32)
    return np.unique(out)


class MinHash:
    """Band keys of shingle sets, for many sets at once."""

    def __init__(self, bands: int, rows: int = ROWS):
        rng = np.random.default_rng(9)
        self.bands, self.rows = bands, rows
        self.factor = rng.integers(1, 1 << 32, bands * rows, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
        self.offset = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint64).astype(np.uint32)

    def keys(self, sets: list[np.ndarray]) -> np.ndarray:
        """(sets x bands) int64 keys; the sets must not be empty."""
        flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
        work = np.empty_like(flat)
        out = np.zeros((len(sets), self.bands), np.uint64)
        for b in range(self.bands):
            key = np.full(len(sets), b + 1, np.uint64)
            for r in range(b * self.rows, (b + 1) * self.rows):
                np.multiply(flat, self.factor[r], out=work)
                np.add(work, self.offset[r], out=work)
                key = (key ^ (key >> np.uint64(31))) * _MIX[0] + np.minimum.reduceat(work, starts).astype(np.uint64) * _MIX[1]
            out[:, b] = key ^ (key >> np.uint64(32))
        return out.view(np.int64)


#: Texts that are cut into shingles before they are passed on.
TEXTS_AT_ONCE = 200


def set_hash(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set: at 10^11 sets two differing ones meet with a chance below 10^-16."""
    whole = xxhash.xxh3_128_intdigest(s.tobytes())
    return (whole >> 64) - (1 << 63), (whole & ((1 << 64) - 1)) - (1 << 63)


def signatures(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
               carry: Sequence[str] | None = None) -> DataFrame:
    """``doc`` (the carried columns; None: all), ``doc_id``, ``text`` (unless it is carried), ``n_shingles`` and, unless
    there is no shingle, ``high, low`` (the set's hash) and ``bands``."""
    count = bands_for(percent)
    kept = ["doc", "doc_id"] if carry is None or text_col in carry else ["doc", "doc_id", "text"]
    rows = docs.select(boxed(docs, carry), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = MinHash(count)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                sets = [shingles(t.as_py(), words) for t in part.column("text")]
                full = [i for i, s in enumerate(sets) if len(s)]
                hashes, bands = [(None, None)] * len(sets), [None] * len(sets)
                if full:
                    for i, keys in zip(full, hashing.keys([sets[i] for i in full])):
                        hashes[i], bands[i] = set_hash(sets[i]), keys
                found = [pa.array([len(s) for s in sets], pa.int64()), *(pa.array(h, pa.int64()) for h in zip(*hashes)), pa.array(bands, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *found], [*kept, "n_shingles", "high", "low", "bands"])

    longs = [T.StructField(n, T.LongType()) for n in ("n_shingles", "high", "low")]
    return map_batches(rows, run, T.StructType([*(rows.schema[c] for c in kept), *longs, T.StructField("bands", T.ArrayType(T.LongType()))]))


@dataclass
class Node:
    bits: np.ndarray   # OR of the members' bitmaps
    low: int           # smallest and largest set
    high: int
    fewest: int        # fewest bits of a member
    members: np.ndarray
    children: list


class SignatureTree:
    """Sets under nodes with OR-combined bitmaps and size ranges."""

    def __init__(self, index: np.ndarray, sizes: np.ndarray, bitmaps: np.ndarray, order: np.ndarray):
        counts = np.bitwise_count(bitmaps).sum(1, dtype=np.int64)
        ranked = index[np.lexsort((sizes[index], order[index]))]
        level = [self._node(ranked[i: i + LEAF], sizes, bitmaps, counts, []) for i in range(0, len(ranked), LEAF)]
        while len(level) > 1:
            level = [self._node(np.concatenate([n.members for n in level[i: i + FAN]]), sizes, bitmaps, counts, level[i: i + FAN])
                     for i in range(0, len(level), FAN)]
        self.root = level[0] if level else None

    @staticmethod
    def _node(members, sizes, bitmaps, counts, children) -> Node:
        return Node(np.bitwise_or.reduce(bitmaps[members]), int(sizes[members].min()), int(sizes[members].max()),
                    int(counts[members].min()), members, children)


def may_link(x: Node, y: Node, percent: int) -> bool:
    """Whether the largest possible overlap of two members reaches the threshold: a bit of one set that no
    set of the other node has is a shingle outside the intersection."""
    if 100 * x.high < percent * y.low or 100 * y.high < percent * x.low:
        return False
    common = int(np.bitwise_count(x.bits & y.bits).sum())
    overlap = min(x.high - max(0, x.fewest - common), y.high - max(0, y.fewest - common))
    return (100 + percent) * overlap >= percent * (x.low + y.low)


class Links:
    """Spanning links among sets, found by dual traversal."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        width = 1 << max(9, min(14, int(4 * self.sizes.max()).bit_length()))
        self.bitmaps = np.zeros((len(sets), width // 64), np.uint64)
        for row, s in zip(self.bitmaps, sets):
            bit = s & np.uint64(width - 1)
            np.bitwise_or.at(row, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        self.order = np.array([s[0] for s in sets], np.uint64)  # the least hash: likely the same for near copies
        self.parent = list(range(len(sets)))
        self.found: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def tree(self, index: np.ndarray) -> SignatureTree:
        return SignatureTree(index, self.sizes, self.bitmaps, self.order)

    def compare(self, x: Node, y: Node) -> None:
        """Exact check of the members of two leaves that their own bitmaps do not rule out."""
        for i in x.members:
            others = y.members[y.members > i] if x is y else y.members
            if not len(others):
                continue
            outside = np.bitwise_count(self.bitmaps[i] & ~self.bitmaps[others]).sum(1, dtype=np.int64)
            missing = np.bitwise_count(self.bitmaps[others] & ~self.bitmaps[i]).sum(1, dtype=np.int64)
            most = np.minimum(self.sizes[i] - outside, self.sizes[others] - missing)
            able = others[(100 + self.percent) * most >= self.percent * (self.sizes[i] + self.sizes[others])]
            for j in able:
                a, b = self.root(i), self.root(j)
                if a != b:
                    both = len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
                    if 100 * both >= self.percent * (self.sizes[i] + self.sizes[j] - both):
                        self.parent[max(a, b)] = min(a, b)
                        self.found.append((int(i), int(j)))

    def traverse(self, x: Node, y: Node) -> None:
        todo = [(x, y)]
        while todo:
            x, y = todo.pop()
            if x is not y and not may_link(x, y, self.percent):
                continue
            if len(x.members) * len(y.members) > 64 and len({self.root(i) for i in (*x.members, *y.members)}) == 1:
                continue
            if x is y:
                if not x.children:
                    self.compare(x, x)
                for i, c in enumerate(x.children):
                    todo.extend((c, d) for d in x.children[i:])
            elif x.children and (not y.children or len(x.members) >= len(y.members)):
                todo.extend((c, y) for c in x.children)
            elif y.children:
                todo.extend((x, c) for c in y.children)
            else:
                self.compare(x, y)


def spanning_links(sets: list[np.ndarray], sides: list[int], percent: int) -> list[tuple[int, int]]:
    """Links that connect what is linked: among all sets, or across the two sides if both occur."""
    links = Links(sets, percent)
    side = np.array(sides)
    one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if len(one) and len(two):
        links.traverse(links.tree(one).root, links.tree(two).root)
    elif len(one) > 1 or len(two) > 1:
        root = links.tree(one if len(one) else two).root
        links.traverse(root, root)
    return links.found


def _with_tasks(members: DataFrame, percent: int, block: int) -> DataFrame:
    """Adds ``tasks``: array of (task, side) in which a class of a cluster takes part."""
    base = math.log(100 / percent) * 1.001  # sets of a linked pair are in equal or neighbouring classes
    size_class = F.floor(F.log("n") / F.lit(base)).cast("int")
    staged = save(members.withColumn("c", size_class), "ngram-members")
    by_class = staged.groupBy("cluster", "c").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("volume"))
    plans = by_class.groupBy("cluster").agg(
        F.sum("k").alias("size"), F.sum("volume").alias("volume"),
        F.map_from_entries(F.collect_list(F.struct("c", F.greatest(
            F.ceil(F.col("k") / block), F.ceil(F.col("volume") / SHINGLES_PER_BLOCK)).cast("int")))).alias("blocks"))
    row = staged.join(plans, "cluster")
    own, up, down = (F.coalesce(F.try_element_at("blocks", F.col("c") + d), F.lit(0)) for d in (0, 1, -1))
    row = row.select("class_id", "cluster", "n", "c", "size", "volume", own.alias("own"), up.alias("up"), down.alias("down"),
                     F.pmod(F.xxhash64("class_id", F.lit(3)), own).cast("int").alias("i"))

    def task(c1, i1, c2, i2, side):
        return F.struct(F.xxhash64("cluster", c1, i1, c2, i2).alias("task"), side.cast("int").alias("side"))

    def each(count, make):
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), make)).otherwise(F.array().cast("array<struct<task:bigint,side:int>>"))

    c, i = F.col("c"), F.col("i")
    many = F.concat(
        each(F.col("own"), lambda j: task(c, F.least(i, j), c, F.greatest(i, j), i > j)),
        each(F.col("up"), lambda j: task(c, i, c + 1, j, F.lit(0))),
        each(F.col("down"), lambda j: task(c - 1, j, c, i, F.lit(1))))
    few = F.array(F.struct(F.xxhash64("cluster").alias("task"), F.lit(0).alias("side")))
    whole = (F.col("size") <= block) & (F.col("volume") <= SHINGLES_PER_BLOCK)
    return row.select("class_id", "n", F.when(whole, few).otherwise(many).alias("tasks"))


def _links(members: DataFrame, sig: DataFrame, words: int, percent: int, block: int) -> DataFrame:
    """(a, b) linked classes that connect every component; ``members``: class_id, cluster, n; ``sig``: row, text."""
    members = save(_with_tasks(members, percent, block), "ngram-tasks")
    volume = members.select(F.sum(F.col("n") * F.size("tasks"))).first()[0] or 0
    # one row a class, by a shuffle at every size: how many texts are candidates grows with the table
    texts = sig.select(F.col("row").alias("class_id"), "text").join(members.hint("merge"), "class_id").select("class_id", "tasks", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                found = pa.array([shingles(t.as_py(), words).tobytes() for t in part.column("text")], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("class_id"), part.column("tasks"), found], ["class_id", "tasks", "shingles"])

    own = map_batches(texts, sets, "class_id long, tasks array<struct<task:long,side:int>>, shingles binary")
    dealt = own.select("class_id", "shingles", F.explode("tasks").alias("t")).select("t.task", "t.side", "class_id", "shingles")
    parts = tasks_for(volume, SHINGLES_PER_TASK, 12)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by task; a task's sets are bounded by the blocks."""
        def links(rows: list) -> pa.RecordBatch | None:
            if len(rows) < 2:
                return None
            pairs = spanning_links([np.frombuffer(raw, np.uint64) for _, _, raw in rows], [s for _, s, _ in rows], percent)
            return pa.RecordBatch.from_arrays([pa.array([rows[i][0] for i, _ in pairs], pa.int64()),
                                               pa.array([rows[j][0] for _, j in pairs], pa.int64())], ["a", "b"])
        held, current = [], None
        for batch in batches:
            tasks, sides, ids = (batch.column(k).to_pylist() for k in range(3))
            for task, side, class_id, raw in zip(tasks, sides, ids, batch.column(3)):
                if task != current:
                    if (out := links(held)) is not None:
                        yield out
                    held, current = [], task
                held.append((class_id, side, raw.as_py()))
        if (out := links(held)) is not None:
            yield out

    return map_batches(dealt.repartition(parts, "task").sortWithinPartitions("task"), join, "a long, b long")


def linked_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
                block: int = BLOCK, carry: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): every row as ``signatures`` gives it, with ``row``, a number of its own; and for each set of
    shingles (``high, low``) its ``class_id, label, component_id`` as in ``jaccard_components``. Texts are cut into
    shingles once here and, where they are candidates, once more."""
    sig = save(signatures(docs, id_col=id_col, text_col=text_col, words=words, percent=percent, carry=carry).withColumn(
        "row", F.monotonically_increasing_id()), "ngram-signatures")
    texts = sig.select("row", (F.col("text") if "text" in sig.columns else F.col("doc").getField(text_col)).alias("text"))
    classes = save(sig.where("high is not null").groupBy("high", "low").agg(
        F.min("row").alias("class_id"), F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"),
        F.any_value("bands").alias("bands")), "ngram-classes")
    banded = classes.select("class_id", F.explode("bands").alias("band"))
    heads = banded.groupBy("band").agg(F.min("class_id").alias("head"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    meets = banded.join(heads, "band").where("class_id <> head").select(F.col("class_id").alias("a"), F.col("head").alias("b"))
    clusters = components(meets, "ngram-clusters")
    members = classes.select("class_id", "n").join(
        clusters.select(F.col("node").alias("class_id"), F.col("component").alias("cluster")), "class_id")
    labels = components(_links(members, texts, words, percent, block), "ngram-links")
    owned = classes.select("high", "low", "class_id", "doc_id").join(
        labels.select(F.col("node").alias("class_id"), F.col("component").alias("label")), "class_id", "left").select(
        "high", "low", "class_id", "doc_id", F.coalesce("label", "class_id").alias("label"))
    least = owned.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return sig, owned.join(least, "label").select("high", "low", "class_id", "label", "component_id")


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                       percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, class_id, label, component_id`` of every row: two texts link when 100 times their shared
    shingles reach ``percent`` times those of either; ``component_id`` is the smallest id reachable by links, ``label``
    the component's smallest class, which tells components apart where ids repeat or are missing.

    Null, empty and blank texts have no shingle and link with nothing; equal sets (and so repeated
    rows) share a class; a row without an id links like any other; texts are read whole at any length; other columns
    are ignored. ``class_id`` and ``label`` are row numbers of this run."""
    rows, classes = linked_rows(docs, id_col=id_col, text_col=text_col, words=words, percent=percent, block=block, carry=(id_col,))
    return rows.select("doc_id", "n_shingles", "high", "low").join(classes, ["high", "low"], "left").select(
        "doc_id", "n_shingles", "class_id", "label", F.coalesce("component_id", "doc_id").alias("component_id"))
