import math
import random

import numpy as np
import pytest
from brute import counted, vector_links
from pyspark.sql import functions as F

from vetrow.llm import ann, embed_dedup
from vetrow.llm.common import components

EXTRA = ", weight string, class_id string, dim string, vec string, code string, task string, keys string, cut string"


def vectors(n=260, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.standard_normal(dim) * rng.choice([0.05, 0.3, 0.5])
        else:
            v = rng.standard_normal(dim) * 3
        rows.append((i, [float(x) for x in v.astype(np.float32)]))
    rows += [(500, None), (501, []), (502, [0.0] * dim), (503, [math.nan] * dim), (504, [math.inf] + [1.0] * (dim - 1)),
             (505, [None] + [1.0] * (dim - 1)), (506, rows[3][1]), (506, rows[3][1]), (507, [1.0, 2.0]), (508, [1.0, 2.0]),
             (509, [-0.0, *rows[5][1][1:]]), (510, [0.0, *rows[5][1][1:]]), (None, rows[7][1])]
    return rows


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, *["x"] * 8) for r in rows], f"vec_id long, embedding array<{kind}>{EXTRA}").repartition(3)


@pytest.mark.parametrize("kind,block", [("float", 2048), ("double", 16)])
def test_links_and_components_against_brute_force(spark, kind, block):
    rows = vectors()
    got = embed_dedup.near_duplicates(frame(spark, rows, kind), block=block).collect()
    want = []
    named = [(i, v if i is not None else None) for i, v in rows]
    for (i, _), (n, group) in zip(rows, vector_links([v for _, v in named], 0.9)):
        least = min((rows[g][0] for g in group if rows[g][0] is not None), default=None)
        want.append((i, n, least, least == i))
    assert counted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == counted(want)
    assert sum(n for _, n, _, _ in want) > 200


def test_tables_meet_pairs_at_the_threshold():
    for n in (10, 10_000, 10 ** 9):
        projections, tables = embed_dedup.table_plan(n)
        near = embed_dedup.meeting_chance(math.sqrt(0.2))
        assert (1 - near ** projections) ** tables <= embed_dedup.MISS


def test_sketches_keep_pairs_at_the_threshold():
    rng = np.random.default_rng(6)
    hashing, bound = embed_dedup.Hashing(2, 1), embed_dedup.sketch_bound()
    x = embed_dedup.unit_rows(rng.standard_normal((4000, 48)))
    away = rng.standard_normal(x.shape)
    away = embed_dedup.unit_rows(away - (away * x).sum(1, keepdims=True) * x)
    near = 0.9 * x + math.sqrt(1 - 0.81) * away
    apart = np.bitwise_count(hashing.sketches(x) ^ hashing.sketches(near)).sum(1)
    assert (apart <= bound).all() and bound < 80
    assert np.bitwise_count(hashing.sketches(x) ^ hashing.sketches(x[::-1])).sum(1).min() > bound


@pytest.mark.parametrize("split", [0, 90])
def test_partnered_rows_against_all_pairs(split):
    rng = np.random.default_rng(7)
    sketch = rng.integers(0, 256, (300, 32)).astype(np.uint8)
    sketch[200:260] = sketch[:60]
    sketch[200:260, 0] ^= 1
    one = np.arange(300)
    one, two = (one[:split], one[split:]) if split else (one, one)
    apart = np.bitwise_count(sketch[:, None] ^ sketch[None]).sum(2)
    want = {i for a in one for b in two for i in (a, b) if a != b and apart[a, b] <= 5}
    assert set(np.flatnonzero(embed_dedup.partnered(sketch, one, two, 5)).tolist()) == want


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500 + i, 500) for i in range(50)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: root(i) for i in parent}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def neighbours(rows, queries, k):
    ok = [(i, np.array(v, np.float64)) for i, v in rows
          if i is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in ok:
        if q in queries:
            near = sorted({(math.sqrt(np.cumsum((y - x) ** 2)[-1]), i) for i, y in ok if i != q})[:k]
            out[q] = [(i, d) for d, i in near]
    return out


@pytest.mark.parametrize("kind", ["float", "double"])
def test_nearest_against_brute_force(spark, kind):
    rows = vectors(seed=3)
    got = {}
    for r in ann.nearest_neighbours(frame(spark, rows, kind), F.col("vec_id") % 50 == 0, k=7).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = neighbours(rows, set(range(0, 1000, 50)), 7)
    assert set(got) == set(want)
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.97 * sum(len(w) for w in want.values())


def test_bounds_hold_for_most_pairs():
    rng = np.random.default_rng(2)
    x, q, centre = rng.standard_normal((400, 64)), rng.standard_normal((30, 64)), rng.standard_normal(64) * 0.1
    turn = ann.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    lower, upper = ann.distance_bounds(*ann.encode(x, centre, turn), q, centre, turn)
    exact = ((q[:, None, :] - x[None, :, :]) ** 2).sum(2)
    assert ((lower <= exact + 1e-9) & (exact <= upper + 1e-9)).mean() > 0.99


@pytest.mark.parametrize("dim", [1, 8, 16, 64, 100, 200])
def test_products_from_packed_bits(dim):
    rng = np.random.default_rng(dim)
    x, q = rng.standard_normal((70, dim)), rng.standard_normal((9, dim))
    q = q / np.linalg.norm(q, axis=1, keepdims=True)
    got, lost = ann.sign_products(ann.packed_words(np.packbits(x >= 0, axis=1)), q)
    want = q @ np.where(x >= 0, 1.0, -1.0).T
    assert (np.abs(got - want) <= np.sqrt(dim) * lost[:, None] + 1e-12).all()
    assert (lost <= 0.02).all()


def test_huge_components(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.standard_normal(4) * (1e160 if i % 2 else 1.0)]) for i in range(60)] + [
        (60, [1.5e308, 0.0, 0.0, 0.0]), (61, [-1.5e308, 0.0, 0.0, 0.0])]
    got = {}
    for r in ann.nearest_neighbours(frame(spark, rows, "double"), F.col("vec_id") < 4, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    for q in range(4):
        near = sorted((math.dist(v, rows[q][1]), i) for i, v in rows if i != q)[:5]
        assert [i for i, _ in got[q]] == [i for _, i in near]
        assert np.allclose([s for _, s in got[q]], [d for d, _ in near])


def test_every_length_is_searched(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.standard_normal(8 if i < 60 else 4)]) for i in range(100)] + [(200, [1.0])]
    got = {}
    for r in ann.nearest_neighbours(frame(spark, rows, "double"), F.col("vec_id") % 10 == 0, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    for q in range(0, 100, 10):
        near = sorted((math.dist(v, rows[q][1]), i) for i, v in rows if i != q and len(v) == len(rows[q][1]))[:5]
        assert got[q] == [i for _, i in near]
    assert 200 not in got  # alone of its length


def test_fewer_rows_than_asked_for(spark):
    rows = [(0, [1.0] * 4), (1, [2.0] * 4), (2, [1.0, 1.0, 1.0, 2.0])]
    got = ann.nearest_neighbours(frame(spark, rows), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 2, 1.0), (2, 1, 2.0)]


def test_empty_tables(spark):
    assert embed_dedup.near_duplicates(frame(spark, [])).collect() == []
    assert ann.nearest_neighbours(frame(spark, []), F.col("vec_id") == 0).collect() == []
