"""Embedding near-dedup by p-stable hashing.

Normalised vectors are projected on Gaussian directions, the projections are
quantised, and several of them make a bucket of one of several tables. Vectors
that share a bucket are compared by exact cosine, after sketches (the signs of
random projections) have said which of a bucket's vectors can have a partner there:
only those travel whole, once for each bucket where they may link. The number of projections
grows with the logarithm of the table so that buckets keep their size, and the
number of tables follows so that a pair at the threshold meets in none of them
with a chance below ``MISS``.

Buckets beyond ``BLOCK`` vectors are cut into blocks that meet pairwise. A pair
is counted in the first table where it meets; what leaves a task is a count
for each vector and a spanning set of links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetrow.llm.common import components, map_batches, save, save_counted, tasks_for
from vetrow.llm.vectors import as_bytes, component_type, matrix

THRESHOLD = 0.9
WIDTH = 2.0        # of the quantisation, in units of the normalised vectors
MISS = 1e-3
BUCKET = 1024      # vectors that unrelated vectors leave in a bucket, about
BLOCK = 2048
ROWS_PER_TASK = 20_000
SKETCH_BITS = 256
SKETCH_MISS = 1e-6  # chance that the sketches of a pair at the threshold differ too much


def meeting_chance(distance: float, width: float = WIDTH) -> float:
    """Chance that one quantised Gaussian projection is equal for two vectors at a distance."""
    r = width / distance
    normal = 0.5 * (1 + math.erf(-r / math.sqrt(2)))
    return 1 - 2 * normal - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_plan(vectors: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(projections of a table, tables): unrelated vectors are taken as orthogonal."""
    near, far = meeting_chance(math.sqrt(2 - 2 * threshold)), meeting_chance(math.sqrt(2))
    projections = max(2, math.ceil(math.log(max(vectors / BUCKET, 1)) / -math.log(far)))
    return projections, math.ceil(math.log(MISS) / math.log(1 - near ** projections))


def sketch_bound(threshold: float = THRESHOLD, bits: int = SKETCH_BITS, miss: float = SKETCH_MISS) -> int:
    """Most signs in which the sketches of a pair at the threshold differ, but for a chance of ``miss``."""
    p, tail = math.acos(max(-1.0, min(1.0, threshold))) / math.pi, 0.0
    for d in range(bits, 0, -1):
        tail += math.comb(bits, d) * p ** d * (1 - p) ** (bits - d)
        if tail > miss:
            return d
    return 0


class Hashing:
    def __init__(self, projections: int, tables: int):
        self.projections, self.tables = projections, tables
        self.directions: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.signs: dict[int, np.ndarray] = {}

    def sketches(self, unit: np.ndarray) -> np.ndarray:
        """(vectors x bytes) packed signs of projections that no table uses."""
        dim = unit.shape[1]
        if dim not in self.signs:
            self.signs[dim] = np.random.default_rng([dim, SKETCH_BITS]).standard_normal((dim, SKETCH_BITS))
        return np.packbits(unit @ self.signs[dim] >= 0, axis=1)

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """(vectors x tables) int32 bucket numbers; a bucket is the 32-bit hash of its quantised projections."""
        dim = unit.shape[1]
        if dim not in self.directions:
            rng = np.random.default_rng(dim)
            count = self.projections * self.tables
            self.directions[dim] = rng.standard_normal((dim, count)), rng.uniform(0, WIDTH, count)
        direction, shift = self.directions[dim]
        cell = np.floor((unit @ direction + shift) / WIDTH).astype(np.int64).astype(np.uint64).reshape(len(unit), self.tables, self.projections)
        key = np.full((len(unit), self.tables), dim, np.uint64) + np.arange(self.tables, dtype=np.uint64)
        for p in range(self.projections):
            key = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + cell[:, :, p] * np.uint64(0xC2B2AE3D27D4EB4F)
        return ((key ^ (key >> np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow of the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _keyed(classes: DataFrame, kind: np.dtype, projections: int, tables: int) -> DataFrame:
    """Adds ``keys``, the bucket of every table, and ``sketch``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = Hashing(projections, tables)
        for batch in batches:
            dims, raw = batch.column("dim").to_numpy(), batch.column("vec").to_pylist()
            keys, sketch = np.zeros((len(raw), tables), np.int32), np.zeros((len(raw), SKETCH_BITS // 8), np.uint8)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                unit = unit_rows(matrix([raw[i] for i in rows], kind))
                keys[rows], sketch[rows] = hashing.keys(unit), hashing.sketches(unit)
            lists = pa.ListArray.from_arrays(np.arange(0, len(raw) * tables + 1, tables, dtype=np.int32), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array([b.tobytes() for b in sketch], pa.binary())],
                                             [*batch.schema.names, "keys", "sketch"])

    return map_batches(classes, run, "class_id long, weight long, dim int, vec binary, keys array<int>, sketch binary")


def partnered(sketch: np.ndarray, one: np.ndarray, two: np.ndarray, bound: int) -> np.ndarray:
    """Whether each row has another within ``bound`` signs, among rows ``one`` x ``two`` (or within ``one`` if they are the same)."""
    words = sketch.view(np.uint64)
    out = np.zeros(len(sketch), bool)
    other = words[two].T.copy()
    for at in range(0, len(one), 128):
        part = one[at: at + 128]
        apart = np.zeros((len(part), len(two)), np.uint16)
        for w, column in enumerate(other):
            apart += np.bitwise_count(words[part, w][:, None] ^ column)
        near = apart <= bound
        if one is two:
            near[np.arange(len(part)), np.arange(at, at + len(part))] = False
        out[part] |= near.any(1)
        out[two] |= near.any(0)
    return out


def _by_task(batches: Iterator[pa.RecordBatch], compare) -> Iterator[pa.RecordBatch]:
    """``compare`` of each task's rows, which come sorted by task; None is left out."""
    held, current = [], None
    for batch in batches:
        task = batch.column("task").to_numpy()
        cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if task[a] != current:
                if held and (out := compare(pa.concat_tables(held))) is not None:
                    yield out
                held, current = [], task[a]
            held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
    if held and (out := compare(pa.concat_tables(held))) is not None:
        yield out


def _sides(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(one) or not len(two):
        one = two = one if len(one) else two
    return one, two


def _hopeful(dealt: DataFrame, bound: int) -> DataFrame:
    """The rows of ``dealt`` (``task, side, t, class_id, sketch``) whose sketch is near another's in the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compare(t: pa.Table) -> pa.RecordBatch | None:
            if t.num_rows < 2:
                return None
            sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(t.num_rows, -1)
            rows = np.flatnonzero(partnered(sketch, *_sides(t.column("side").to_numpy()), bound))
            names = ["task", "side", "t", "class_id"]
            return pa.RecordBatch.from_arrays([pa.array(t.column(c).to_numpy()[rows]) for c in names], names) if len(rows) else None

        yield from _by_task(batches, compare)

    return map_batches(dealt, run, "task long, side int, t int, class_id long")


def links_among(x: np.ndarray, keys: np.ndarray, weight: np.ndarray, one: np.ndarray, two: np.ndarray,
                table: int, threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(links of each row, spanning links) among rows ``one`` x ``two`` (or within ``one`` if they are the same),
    for pairs that met in no earlier table."""
    links = np.zeros(len(x), np.int64)
    same = one is two
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    spanning = []
    for at in range(0, len(one), 512):
        part = one[at: at + 512]
        near = x[part] @ x[two].T >= threshold
        if same:
            near &= two[None, :] > part[:, None]
        a, b = np.nonzero(near)
        if not len(a):
            continue
        a, b = part[a], two[b]
        if table:
            fresh = ~(keys[a, :table] == keys[b, :table]).any(1)
            a, b = a[fresh], b[fresh]
        np.add.at(links, a, weight[b])
        np.add.at(links, b, weight[a])
        first = np.concatenate([[True], a[1:] != a[:-1]]) if len(a) else np.zeros(0, bool)
        for lo, hi in zip(np.flatnonzero(first), [*np.flatnonzero(first)[1:], len(a)]):
            u = root(int(a[lo]))
            for v in b[lo:hi].tolist():
                if parent.get(v, v) != u:
                    w = root(v)
                    if w != u:
                        parent[w] = u
                        spanning.append((int(a[lo]), v))
    return links, spanning


def _compare(dealt: DataFrame, kind: np.dtype, threshold: float) -> DataFrame:
    """``class_id, links, other``: counts (other null) and spanning links (links 0). Rows come sorted by task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compare(t: pa.Table) -> pa.RecordBatch | None:
            if t.num_rows < 2:
                return None
            ids, weight, side = (t.column(c).to_numpy() for c in ("class_id", "weight", "side"))
            dims, table = t.column("dim").to_numpy(), t.column("t")[0].as_py()
            raw, lists = t.column("vec").to_pylist(), t.column("keys").combine_chunks()
            keys = lists.flatten().to_numpy().reshape(t.num_rows, -1)
            out_id, out_n, out_other = [], [], []
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x, own = unit_rows(matrix([raw[i] for i in rows], kind)), side[rows]
                one, two = _sides(own)
                links, spanning = links_among(x, keys[rows], weight[rows], one, two, table, threshold)
                linked = np.flatnonzero(links)
                out_id += [*ids[rows[linked]], *(ids[rows[a]] for a, _ in spanning)]
                out_n += [*links[linked], *[0] * len(spanning)]
                out_other += [*[None] * len(linked), *(ids[rows[b]] for _, b in spanning)]
            return pa.RecordBatch.from_arrays([pa.array(out_id, pa.int64()), pa.array(out_n, pa.int64()), pa.array(out_other, pa.int64())],
                                              ["class_id", "links", "other"])

        yield from _by_task(batches, compare)

    return map_batches(dealt, run, "class_id long, links long, other long")


def near_duplicates(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                    block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept, class_id`` of every row: vectors link when their cosine, in double
    precision, reaches the threshold; ``component_id`` is the smallest id reachable by links.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do
    vectors of different lengths or without an id. Equal vectors (repeated rows) are one class: each links with the
    others and they share all other links. Other columns are ignored."""
    kind = component_type(df, vector_col)
    rows = save(as_bytes(df, id_col, vector_col), "vectors")
    classes, count = save_counted(rows.where("class_id is not null").groupBy("class_id").agg(
        F.count(F.lit(1)).alias("weight"), F.any_value("dim").alias("dim"), F.any_value("vec").alias("vec")), "vector-classes")
    projections, tables = table_plan(count, threshold)
    keyed = save(_keyed(classes, kind, projections, tables), "vector-keys")
    slim = keyed.select("class_id", F.posexplode("keys").alias("t", "key"))
    hot = slim.groupBy("t", "key").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > block).select(
        "t", "key", F.ceil(F.col("k") / block).cast("int").alias("blocks"))
    cut = slim.join(hot, ["t", "key"]).groupBy("class_id").agg(
        F.map_from_entries(F.collect_list(F.struct("t", "blocks"))).alias("cut"))  # a class has one bucket of each table
    placed = keyed.select("class_id", "keys", "sketch").join(cut, "class_id", "left").select(
        "class_id", "sketch", "cut", F.posexplode("keys").alias("t", "key")).withColumn(
        "blocks", F.coalesce(F.try_element_at("cut", F.col("t")), F.lit(1))).withColumn(
        "i", F.pmod(F.xxhash64("class_id", "t"), F.col("blocks")).cast("int")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = placed.select(
        F.xxhash64("t", "key", F.least("i", "j"), F.greatest("i", "j")).alias("task"),
        (F.col("i") > F.col("j")).cast("int").alias("side"), "t", "class_id", "sketch")
    parts = tasks_for(count * tables, ROWS_PER_TASK, 12)
    hopeful, left = save_counted(_hopeful(dealt.repartition(parts, "task").sortWithinPartitions("task"), sketch_bound(threshold)), "vector-hopes")
    whole = hopeful.join(keyed.drop("sketch"), "class_id")
    found = save(_compare(whole.repartition(tasks_for(left, ROWS_PER_TASK, 12), "task").sortWithinPartitions("task"), kind, threshold), "vector-links")
    links = found.where("other is null").groupBy("class_id").agg(F.sum("links").alias("links"))
    labels = components(found.where("other is not null").select(F.col("class_id").alias("a"), F.col("other").alias("b")), "vector-links")
    named = rows.where("class_id is not null").groupBy("class_id").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("weight")).join(
        labels.select(F.col("node").alias("class_id"), F.col("component").alias("label")), "class_id", "left").join(
        links, "class_id", "left").select("class_id", "first", "weight", "links", F.coalesce("label", "class_id").alias("label"))
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    info = named.join(least, "label").select(
        "class_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    return rows.select("vec_id", "class_id").join(info, "class_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"), "class_id")
