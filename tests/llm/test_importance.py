import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import CLASHING, edge_rows, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from vetrow.llm import importance

TARGETS = ["alpha bravo charlie", "Golf golf GOLF é", None, "", "日本語 のテキスト"]


def runs(text, low, high):
    """Features by splitting, with the operator's separators as characters."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered) if w]
    return words, [" ".join(words[i:i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]


def brute(rows, targets, low=1, high=1, buckets=10_000, percent=10, least=20, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    texts = [runs(t, low, high) for _, t in rows]
    s, t = Counter(bucket(f) for _, fs in texts for f in fs), Counter(bucket(f) for x in targets for f in runs(x, low, high)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (s_all + buckets) / ((s[b] + 1.0) * (t_all + buckets))))
    out = []
    for (doc_id, _), (words, fs) in zip(rows, texts):
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    able = sorted((-r[3], r[0] is None, r[0] or 0) for r in out if r[4] >= least)
    return [r[:4] for r in out], able[:percent * len(able) // 100]


@pytest.mark.parametrize("low,high,percent", [(1, 1, 10), (1, 3, 50), (2, 2, 100), (1, 1, 0)])
def test_edge_table_against_brute_force(spark, low, high, percent):
    rows = edge_rows()
    target = spark.createDataFrame([(t,) for t in TARGETS], "text string")
    docs = frame(spark, rows, (*CLASHING, "weight", "rank"))
    out = importance.importance_resample(docs, target, low=low, high=high, percent=percent)
    assert out.columns == [*("score_in" if c == "score" else c + "_in" if c in ("weight", "rank") else c for c in docs.columns),
                           "n_features", "weight", "score", "rank"]
    got = out.collect()
    want, drawn = brute(rows, TARGETS, low, high, percent=percent)
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted([(r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got], key=order) == sorted(want, key=order)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(-r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in ranked] == drawn


@given(st.text(alphabet="aB9 \x00\t\n.é日Z-", max_size=40), st.integers(1, 3))
@settings(max_examples=300, deadline=None)
def test_spans_are_all_runs(text, n):
    _, features = runs(text, n, n)
    collapsed = importance.SEPARATORS.sub(b" ", text.encode().lower()).strip(b" ")
    assert [s.decode() for s in importance.feature_spans(collapsed, n)] == features


def test_long_text_is_counted_in_parts(monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(5000))
    whole = importance.bucket_counts(text, 1, 2, 97)
    monkeypatch.setattr(importance, "SPANS", 64)
    parts = importance.bucket_counts(text, 1, 2, 97)
    assert whole[:2] == parts[:2] and all(np.array_equal(a, b) for a, b in zip(whole[2:], parts[2:]))


def test_empty_tables(spark):
    empty, docs = spark.createDataFrame([], "doc_id long, text string"), frame(spark, edge_rows())
    assert importance.importance_resample(empty, docs.select("text")).collect() == []
    got = importance.importance_resample(docs, empty.select("text"), carry=("doc_id",)).collect()
    want, _ = brute(edge_rows(), [])
    assert sorted(r["weight"] for r in got) == sorted(w[2] for w in want)


def test_a_third_of_all_rows_under_one_id(spark):
    rows = [(7, " ".join(f"w{i % 5}" for i in range(30)))] * 400 + [(100 + i, f"x{i} " * 25) for i in range(800)]
    got = importance.importance_resample(frame(spark, rows), frame(spark, [(1, "w1 w2")]).select("text"), carry=("doc_id",)).collect()
    _, drawn = brute(rows, ["w1 w2"])
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [(-r["score"], r["doc_id"] is None, r["doc_id"]) for r in ranked] == drawn and len(drawn) == 120
