import random
import zlib

import pytest
from brute import CLASHING, edge_rows, frame, sharing

from vetrow.llm import sharding


def check(rows, out, shards):
    assert len(out) == len(rows)
    for r in out:
        assert 0 <= r["shard"] < shards
    by_key = {}
    for r in out:
        assert by_key.setdefault(r["key"], r["shard"]) == r["shard"]  # groups stay whole
    for s in {r["shard"] for r in out}:
        slots = sorted(r["slot"] for r in out if r["shard"] == s)
        assert slots == list(range(len(slots)))
    sizes = {}
    for r in out:
        sizes[r["key"]] = sizes.get(r["key"], 0) + r["size"]
    ordered = [sizes[k] for k in sorted(sizes)]
    held = [sum(r["size"] for r in out if r["shard"] == s) for s in range(shards)]
    order = [r["shard"] for r in sorted(out, key=lambda r: r["key"])]
    assert order == sorted(order)  # contiguous in the order of the hashes
    assert max(held) <= out[0]["capacity"]
    assert out[0]["capacity"] == sharing(ordered, shards)


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_edge_table_against_brute_force(spark, shards):
    rows = [r for r in edge_rows() if r[1] is None or len(r[1]) < 5000]
    out = sharding.shard_documents(frame(spark, rows, CLASHING), shards).collect()
    check(rows, out, shards)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in out)
    want = sorted((d is None, d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert got == want


def test_few_bits_need_refinement(spark):
    rng = random.Random(2)
    groups = spark.createDataFrame([(rng.getrandbits(64) - (1 << 63), rng.randint(1, 900)) for _ in range(700)], "key long, weight long")
    for shards in (2, 7, 16):
        cuts, capacity = sharding.minimax_cuts(groups, shards, range_bits=5)
        rows = sorted((r["key"], r["weight"]) for r in groups.collect())
        assert capacity == sharing([w for _, w in rows], shards)
        held = [0] * shards
        for k, w in rows:
            held[sum(k >= c for c in cuts)] += w
        assert max(held) <= capacity
        assert min(held) > 0


def test_group_larger_than_a_share(spark):
    rows = [(i, "copy" * 50) for i in range(60)] + [(100 + i, f"text {i} " * 3) for i in range(60)]
    out = sharding.shard_documents(frame(spark, rows), 8).collect()
    check(rows, out, 8)
    assert out[0]["capacity"] == 60 * 201
    assert len({r["shard"] for r in out}) == 8  # the rest still spreads


def test_empty_table(spark):
    assert sharding.shard_documents(frame(spark, []), 16).collect() == []
