import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from brute import CLASHING, prose
from pyspark.sql import functions as F

from vetrow.llm import mixing


def filled(sizes, weights, budget, epochs):
    """Targets by exact water-filling, a source at a time: the one with the least cap for its weight is clamped first."""
    left, targets = Fraction(budget), {}
    free = {s for s in sizes if weights[s] > 0}
    targets.update({s: Fraction(0) for s in sizes if s not in free})
    while free:
        s = min(free, key=lambda s: Fraction(epochs * sizes[s]) / Fraction(weights[s]))
        if Fraction(weights[s]) * left / sum(Fraction(weights[x]) for x in free) <= epochs * sizes[s]:
            whole = sum(Fraction(weights[x]) for x in free)
            targets.update({x: Fraction(weights[x]) * left / whole for x in free})
            break
        targets[s] = Fraction(epochs * sizes[s])
        left -= targets[s]
        free.remove(s)
    return targets


def table(seed=3):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.choice([0, 1, 5, 60])), f"s{i % 4}") for i in range(160)]
    rows += [(200 + i, prose(rng, 9), None) for i in range(3)] + [(210, None, "s1"), (211, "", "only empty"), (212, None, "only empty")]
    rows += [(None, "a text without an id", "s2"), (None, "a text without an id", "s2"), (None, None, None)]
    rows += [(300, "the same row", "s3")] * 5 + [(301, "x" * 50_000 + " y" * 3000, "Ω"), (302, "tiny", "\U0001f600"), (303, "one two", "￮")]
    return rows


def docs_of(spark, rows, extra=()):
    return spark.createDataFrame([(*r, *["extra"] * len(extra)) for r in rows],
                                 "doc_id long, text string, source string" + "".join(f", {c} string" for c in extra)).repartition(3)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("epochs,budget,weights", [(3, None, (1, 2, 3)), (1, None, (5, 1)), (2, 100_000, (1,)), (3, 40, (1, 0, 2))])
def test_targets_and_taken_words(spark, epochs, budget, weights):
    rows = table()
    got = mixing.mix_sources(docs_of(spark, rows), weights=weights, max_epochs=epochs, budget=budget).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += words(t)
    named = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = filled(sizes, {s: weights[i % len(weights)] for i, s in enumerate(named)}, sum(sizes.values()) if budget is None else budget, epochs)
    taken = defaultdict(int)
    for r in got:
        taken[r["source"]] += r["taken"]
        assert r["size"] == words(r["text"]) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(float(want[r["source"]]), rel=1e-12)
        assert 0 <= r["part"] <= r["size"] and r["taken"] == r["repeats"] * r["size"] + r["part"] <= epochs * r["size"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= Fraction(1, 2) + Fraction(1, 10**6)
        cut = [r for r in got if r["source"] == s and 0 < r["part"] < r["size"]]
        assert len(cut) <= 1


def test_order_is_seeded_and_reruns_agree(spark):
    docs = docs_of(spark, table())
    digest = lambda d: sorted((str(r["doc_id"]), r["taken"], r["part"]) for r in d.collect())
    one, again = digest(mixing.mix_sources(docs)), digest(mixing.mix_sources(docs.repartition(5)))
    assert one == again and one != digest(mixing.mix_sources(docs, seed=7))
    rows = [(i, "w " * (i % 7 + 1), "a") for i in range(50)] + [(100, "w " * 100, "b")]
    got = {r["doc_id"]: r["part"] for r in mixing.mix_sources(docs_of(spark, rows), weights=(1, 3)).collect()}
    order = sorted(range(50), key=lambda i: hashlib.md5(f"2024:{i}".encode()).hexdigest()[:16])
    taken = [got[i] / (i % 7 + 1) for i in order]
    assert taken == sorted(taken, reverse=True)


def test_a_hot_source_goes_down_many_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "WINDOW_ROWS", 2)
    rows = [(5, "same text", "hot")] * 300 + [(i, "w " * (i % 5), "hot") for i in range(100)] + [(1000 + i, "v " * 40, "other") for i in range(20)]
    got = mixing.mix_sources(docs_of(spark, rows), weights=(3, 1)).collect()
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in taken)


def test_named_weights_clashing_columns_and_texts_of_the_mix(spark):
    docs = docs_of(spark, table(), (*CLASHING, "size", "taken", "part"))
    mixed = mixing.mix_sources(docs, weights={"s0": 1.5, None: 1})
    assert {"size_in", "taken_in", "part_in"} <= set(mixed.columns) and mixed.where("size_in = 'extra'").count() == len(table())
    assert mixed.where("source not in ('s0')").agg(F.sum("taken")).first()[0] == 0
    texts = mixing.expand(mixed).collect()
    assert sum(words(r["text"]) for r in texts) == mixed.agg(F.sum("taken")).first()[0]


def test_empty_table(spark):
    assert mixing.mix_sources(docs_of(spark, [])).collect() == []
    empty = mixing.mix_sources(docs_of(spark, [(1, None, None), (2, "", "a")])).collect()
    assert [(r["taken"], r["target"]) for r in empty] == [(0, 0.0)] * 2
