"""Approximate nearest neighbours with randomly rotated one-bit codes.

Vectors are centred, normalised and rotated at random; a code keeps the sign of
each rotated component, packed in bits, with two scalars: the vector's distance
from the centre and the inner product of the code with the vector it stands for.
A query's rotated components are rounded to whole numbers of ``PLANES`` bits, one
packed plane for each bit, so that its inner product with a code is a sum of
popcounts of code AND plane. That and the scalars give an unbiased estimate with
an error bound, and only vectors whose lower bound on the distance does not exceed
the k-th smallest upper bound, nor the k-th exact distance among the most promising
rows, are reranked by exact distance.

Every row is indexed. Queries and rows meet block by block; a block returns its
k best for each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vetrow.llm.common import map_batches, save, save_counted, tasks_for
from vetrow.llm.vectors import as_bytes, component_type, matrix

NEAREST = 10
ERROR = 3.0  # standard deviations that the bound allows the estimate to be off
ROWS_PER_BLOCK = 16_384
QUERIES_PER_BLOCK = 4096
LEAST_BLOCKS = 64
PLANES = 8         # bits of a query's rounded component
FIRST = 4          # times k rows, of the smallest lower bounds, are reranked before the others
CELLS = 1 << 19    # estimates that are held at once
LARGEST = 2.0 ** 500  # components beyond have squares that overflow: bounds are then taken of scaled vectors


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same for the same dimension."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed sign bits, distance from the centre, inner product of code and vector) of rows."""
    moved = x - centre
    norm = np.linalg.norm(moved, axis=1)
    unit = (moved / np.where(norm > 0, norm, 1)[:, None]) @ turn.T
    bits = unit >= 0
    fit = np.abs(unit).sum(1) / np.sqrt(x.shape[1])
    return np.packbits(bits, axis=1), norm, np.where(norm > 0, fit, 1.0)


def packed_words(bits: np.ndarray) -> np.ndarray:
    """Packed bytes of each row as 64-bit words, words x rows."""
    wide = np.zeros((len(bits), -(-bits.shape[1] // 8) * 8), np.uint8)
    wide[:, : bits.shape[1]] = bits
    return np.ascontiguousarray(wide.view(np.uint64).T)


def sign_products(words: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(inner products of rounded queries with the signs, queries x rows; what rounding took from each query, as a length)."""
    low = unit.min(1)
    step = (unit.max(1) - low) / (2 ** PLANES - 1)
    step = np.where(step > 0, step, 1.0)
    level = np.rint((unit - low[:, None]) / step[:, None]).astype(np.int64)
    lost = np.linalg.norm(unit - (low[:, None] + level * step[:, None]), axis=1)
    ones = np.bitwise_count(words).sum(0, dtype=np.int64)
    total = np.zeros((len(unit), words.shape[1]), np.int64)
    for j in range(PLANES):
        plane = packed_words(np.packbits((level >> j & 1).astype(np.uint8), axis=1))
        for code, asked in zip(words, plane):
            total += np.bitwise_count(code[None, :] & asked[:, None]).astype(np.int64) << j
    held = low[:, None] * ones + step[:, None] * total
    return 2 * held - (low * unit.shape[1] + step * level.sum(1))[:, None], lost


def distance_bounds(codes: np.ndarray, norm: np.ndarray, fit: np.ndarray, queries: np.ndarray, centre: np.ndarray,
                    turn: np.ndarray, error: float = ERROR) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of squared distances, queries x rows, from the packed codes alone."""
    dim = len(centre)
    moved = queries - centre
    length = np.linalg.norm(moved, axis=1)
    unit = (moved / np.where(length > 0, length, 1)[:, None]) @ turn.T
    signed, lost = sign_products(packed_words(codes), unit)
    inner = signed / np.sqrt(dim) / fit
    off = (error * np.sqrt(np.maximum(1 - fit * fit, 0)) / np.sqrt(max(dim - 1, 1)) + lost[:, None]) / fit
    square = norm ** 2 + (length ** 2)[:, None]
    reach = 2 * norm * length[:, None]
    slack = 1e-12 * square  # of the arithmetic, where what is compared nearly cancels
    return square - reach * np.minimum(inner + off, 1) - slack, square - reach * np.maximum(inner - off, -1) + slack


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to one vector; where squares overflow, those of vectors scaled by a power of two."""
    with np.errstate(over="ignore", invalid="ignore"):
        gap = x - q
        out = np.sqrt(np.cumsum(gap * gap, axis=1)[:, -1]) if len(x) else np.zeros(0)
        far = np.flatnonzero(~np.isfinite(out))
        if len(far):
            small = x[far] * 2.0 ** -600 - q * 2.0 ** -600
            out[far] = np.sqrt(np.cumsum(small * small, axis=1)[:, -1]) * 2.0 ** 600
    return out


def nearest_in_block(ids: np.ndarray, x: np.ndarray, codes, norm, fit, query_ids: np.ndarray, queries: np.ndarray,
                     centre: np.ndarray, turn: np.ndarray, k: int, scale: float = 1.0) -> list[tuple[int, int, float]]:
    """(query, row, distance): the k nearest of each query among the rows that its bounds leave for reranking.
    ``centre`` and ``norm`` are of vectors times ``scale``."""
    out = []
    few = max(1, CELLS // max(len(ids), 1))
    for at in range(0, len(queries), few):
        lower, upper = distance_bounds(codes, norm, fit, queries[at: at + few] * scale, centre, turn)
        for i, (low, up) in enumerate(zip(lower, upper)):
            q, own = queries[at + i], ids == query_ids[at + i]
            low, up = np.where(own, np.inf, low), np.where(own, np.inf, up)
            able, exact = np.flatnonzero(~own), None
            if len(able) > FIRST * k:
                limit = np.partition(up, k - 1)[k - 1]
                first = np.argpartition(low, FIRST * k)[: FIRST * k]
                near = distances(x[first], q)
                with np.errstate(over="ignore"):
                    limit = np.minimum(limit, (np.partition(near, k - 1)[k - 1] * scale) ** 2)
                if np.isfinite(limit):
                    rest = low <= limit + 1e-9 * abs(limit)
                    rest[first] = False
                    rest = np.flatnonzero(rest)
                    able, exact = np.concatenate([first, rest]), np.concatenate([near, distances(x[rest], q)])
            exact = distances(x[able], q) if exact is None else exact
            best = np.lexsort((ids[able], exact))[:k]
            out.extend((int(query_ids[at + i]), int(ids[able[b]]), float(exact[b])) for b in best)
    return out


def _centre(rows: DataFrame, kind: np.dtype, dim: int) -> tuple[np.ndarray, float]:
    """(mean of all vectors times the scale, the scale): sums of each component by task, then over tasks. The scale is one
    but where a component's square would overflow. Sums are taken of components over 2^64, so that they do not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, top, n = np.zeros(dim), 0.0, 0
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0).to_pylist(), kind)
                total += (x * 2.0 ** -64).sum(0)
                top = max(top, float(np.abs(x).max()))
                n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim), pa.int32()), pa.array(total), pa.array([top] * dim, pa.float64()),
                                          pa.array([n] * dim, pa.int64())], ["i", "s", "top", "n"])

    sums = map_batches(rows.select("vec"), run, "i int, s double, top double, n long").groupBy("i").agg(
        F.try_divide(F.sum("s"), F.sum("n")).alias("m"), F.max("top").alias("top")).collect()
    scale = 2.0 ** -600 if max((r["top"] or 0.0 for r in sums), default=0.0) > LARGEST else 1.0
    out = np.zeros(dim)
    for r in sums:
        out[r["i"]] = (r["m"] or 0.0) * scale * 2.0 ** 64
    return out, scale


def _indexed(rows: DataFrame, kind: np.dtype, centre: np.ndarray, scale: float) -> DataFrame:
    """Adds ``code, norm, fit``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(len(centre))
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, norm, fit = encode(matrix(batch.column("vec").to_pylist(), kind) * scale, centre, turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vec"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm), pa.array(fit)],
                ["vec_id", "vec", "code", "norm", "fit"])

    return map_batches(rows.select("vec_id", "vec"), run, "vec_id long, vec binary, code binary, norm double, fit double")


def _search(dealt: DataFrame, kind: np.dtype, centre: np.ndarray, scale: float, k: int) -> DataFrame:
    """Queries (no code) against rows, task by task; rows come sorted by task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(len(centre))

        def search(held: list[pa.Table]) -> pa.RecordBatch | None:
            t = pa.concat_tables(held)
            ids, raw, codes = t.column("vec_id").to_numpy(), t.column("vec").to_pylist(), t.column("code").to_pylist()
            asked = np.array([c is None for c in codes])
            rows, queries = np.flatnonzero(~asked), np.flatnonzero(asked)
            if not len(rows) or not len(queries):
                return None
            x = matrix([raw[i] for i in rows], kind)
            code = np.frombuffer(b"".join(codes[i] for i in rows), np.uint8).reshape(len(rows), -1)
            norm, fit = t.column("norm").to_numpy()[rows], t.column("fit").to_numpy()[rows]
            found = nearest_in_block(ids[rows], x, code, norm, fit, ids[queries], matrix([raw[i] for i in queries], kind),
                                     centre, turn, k, scale)
            q, v, s = zip(*found) if found else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())], ["query_id", "vec_id", "score"])

        held, current = [], None
        for batch in batches:
            task = batch.column("task").to_numpy()
            cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if task[a] != current:
                    if held and (out := search(held)) is not None:
                        yield out
                    held, current = [], task[a]
                held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
        if held and (out := search(held)) is not None:
            yield out

    return map_batches(dealt, run, "query_id long, vec_id long, score double")


def nearest_neighbours(df: DataFrame, is_query, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found by Euclidean distance (``score``, exact, in double
    precision) of every row that ``is_query`` (a condition on ``vec_id``) picks, among all rows with another id.
    Ties go to the smaller id; fewer rows than ``k`` give all of them.

    Vectors that are null, empty, zero or hold null or non-finite components and rows without an id take no part. A
    vector's neighbours are among those of its length; each length that is asked for has an index of its own. Components
    whose squares overflow are searched by scaled vectors (a distance beyond all doubles is infinite). A repeated
    id is one row of the index for each of its rows and one query for each distinct vector; other columns are ignored."""
    kind = component_type(df, vector_col)
    rows = save(as_bytes(df, id_col, vector_col).where("class_id is not null").select("vec_id", "dim", "vec"), "ann-vectors")
    lengths = [r["dim"] for r in rows.where(is_query).select("dim").distinct().orderBy("dim").collect()] or [1]
    found = _found_among(rows.where(F.col("dim") == lengths[0]), is_query, kind, lengths[0], k)
    for dim in lengths[1:]:
        found = found.unionByName(_found_among(rows.where(F.col("dim") == dim), is_query, kind, dim, k))
    ranked = found.dropDuplicates().withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _found_among(rows: DataFrame, is_query, kind: np.dtype, dim: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): each block's nearest rows, of vectors of one length."""
    centre, scale = _centre(rows, kind, dim)
    index, count = save_counted(_indexed(rows, kind, centre, scale), "ann-index")
    queries, asked = save_counted(index.where(is_query).select("vec_id", "vec").distinct(), "ann-queries")
    blocks, query_blocks = tasks_for(count, ROWS_PER_BLOCK, LEAST_BLOCKS), tasks_for(asked, QUERIES_PER_BLOCK)

    def block(n, salt):
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n))

    held = index.select(block(blocks, 1).alias("d"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"), "vec_id", "vec", "code", "norm", "fit")
    wanted = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("d"), block(query_blocks, 2).alias("q"), "vec_id", "vec",
                            F.lit(None).cast("binary").alias("code"), F.lit(None).cast("double").alias("norm"), F.lit(None).cast("double").alias("fit"))
    dealt = held.unionByName(wanted).select((F.col("d") * query_blocks + F.col("q")).alias("task"), "vec_id", "vec", "code", "norm", "fit")
    return _search(dealt.repartition(tasks_for(blocks * query_blocks, 1), "task").sortWithinPartitions("task"), kind, centre, scale, k)
