import random

import numpy as np
import pytest
from brute import CLASHING, WORDS, counted, edge_rows, frame, jaccard_components

from vetrow.llm import ngram_join


def results(df):
    return counted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def wanted(rows, words, percent):
    return counted((d, n, c) for (d, _), (n, c) in zip(rows, jaccard_components(rows, words, percent)))


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80)])
def test_edge_table_against_brute_force(spark, words, percent):
    rows = edge_rows()
    assert results(ngram_join.jaccard_components(frame(spark, rows, CLASHING), words=words, percent=percent)) == wanted(rows, words, percent)


def chained(n, seed=6):
    """Texts that drift: neighbours link, ends do not; sizes differ."""
    rng = random.Random(seed)
    rows = []
    for family in range(4):
        words = [f"{rng.choice(WORDS)}{rng.randint(0, 40)}" for _ in range(90)]
        for i in range(n):
            rows.append((1000 * family + i, " ".join(words)))
            at = rng.randrange(len(words))
            words[at: at + 2] = [f"new{family}x{i}"] + ["more"] * rng.randint(0, 2)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [512, 8])
def test_chains_whole_and_in_blocks(spark, block):
    rows = chained(40)
    assert results(ngram_join.jaccard_components(frame(spark, rows), block=block)) == wanted(rows, 4, 85)


def test_tree_never_drops_a_link():
    rng = random.Random(2)
    sets = []
    for _ in range(150):
        if sets and rng.random() < 0.6:
            s = set(rng.choice(sets))
            for _ in range(rng.randint(0, 6)):
                s.add(rng.getrandbits(60))
            sets.append(s)
        else:
            sets.append({rng.getrandbits(60) for _ in range(rng.randint(1, 80))})
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    parent = list(range(len(sets)))

    def root(p, i):
        while p[i] != i:
            i = p[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                parent[max(root(parent, i), root(parent, j))] = min(root(parent, i), root(parent, j))
    found = list(range(len(sets)))
    for i, j in ngram_join.spanning_links(arrays, [0] * len(arrays), 85):
        both = len(sets[i] & sets[j])
        assert 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both)
        found[max(root(found, i), root(found, j))] = min(root(found, i), root(found, j))
    assert [root(found, i) for i in range(len(sets))] == [root(parent, i) for i in range(len(sets))]


def bridged():
    """A and B link through X only: J(A, X) and J(X, B) reach 0.85, J(A, B) does not."""
    a = [f"w{i}" for i in range(100)]
    x = [*a[:96], "x1", "x2", *a[98:]]
    b = [*x[:3], "y1", "y2", *x[5:]]
    return " ".join(a), " ".join(x), " ".join(b)


@pytest.mark.parametrize("middle", [None, 3, 1])
def test_links_through_a_row_without_an_id_or_under_a_repeated_one(spark, middle):
    a, x, b = bridged()
    rows = [(1, a), (middle, x), (2, b), (None, "some other text that has nobody near it")]
    assert all(jaccard_components(list(enumerate(t)), 4, 85)[-1][1] == 0 for t in ((a, x), (x, b)))
    assert jaccard_components([(0, a), (1, b)], 4, 85)[-1][1] == 1
    got = ngram_join.jaccard_components(frame(spark, rows)).collect()
    assert [r["component_id"] for r in got if r["doc_id"] in (1, 2)] == [1] * (3 if middle == 1 else 2)
    assert sorted(r["component_id"] is None for r in got) == [False] * 3 + [True]  # the lone row without an id


def test_band_count_follows_the_threshold():
    for percent in (80, 85, 95):
        assert (1 - (percent / 100) ** ngram_join.ROWS) ** ngram_join.bands_for(percent) <= ngram_join.MISS


def test_empty_table(spark):
    assert ngram_join.jaccard_components(frame(spark, [])).collect() == []
