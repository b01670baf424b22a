"""Plain, single-process versions of the operators' contracts, and the tables that the tests share."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()


def prose(rng: random.Random, n: int) -> str:
    out = []
    while len(out) < n:
        k = rng.randint(3, 12)
        s = [rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing", "é"]) for _ in range(k)]
        out += [s[0].capitalize(), *s[1:-1], s[-1] + "."]
    return " ".join(out[:n])


def edge_rows(seed: int = 5) -> list[tuple]:
    """(doc_id, text): nulls, empty and blank texts, repeated rows, copies, near copies, a shared passage, long texts."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.choice([1, 3, 8, 40, 120]))) for i in range(40)]
    passage = prose(rng, 70)
    rows += [(100, None), (101, None), (102, ""), (103, ""), (104, "  \n\t "), (105, "one two"), (106, "one two"), (107, "!!! 123 \x00")]
    rows += [(110 + i, rows[30][1]) for i in range(6)] + [(120, prose(rng, 30) + " " + passage + " " + prose(rng, 20)),
                                                          (121, passage), (122, prose(rng, 5) + "\n" + passage)]
    long = prose(rng, 400)
    rows += [(130, long), (131, long.replace("alpha", "omega", 2)), (132, long + " tail"), (133, "z" * 120_000), (134, "ab " * 30_000)]
    rows += [(140, "same row here, twice in the table for sure"), (140, "same row here, twice in the table for sure")]
    rows += [(None, "a row without an id but with words in it"), (150, "日本語 のテキスト 😀 ﬁ ▁ x  y")]
    return rows


def frame(spark, rows, extra=()):
    """Documents with ``extra`` columns of names that operators use inside."""
    data = [(*r, *["extra"] * len(extra)) for r in rows]
    return spark.createDataFrame(data, "doc_id long, text string" + "".join(f", {c} string" for c in extra)).repartition(3)


CLASHING = ("score", "_score", "key", "shard", "slot", "bucket", "payload", "uid", "kind", "class_id", "n", "task", "cluster",
            "starts", "_starts", "digest", "members", "used", "_kept", "label")


def sharing(rows, shards):
    """Least possible largest shard over groups of equal texts in a given order."""
    def parts(sizes, capacity):
        n, room = 0, 0
        for s in sizes:
            if s > capacity:
                return None
            if s > room:
                n, room = n + 1, capacity
            room -= s
        return n

    def least(sizes):
        return next(c for c in range(max(sizes), sum(sizes) + 1) if parts(sizes, c) <= shards)

    return least(rows)


def jaccard_components(rows, words, percent):
    """{row index: (shingles, component id)}"""
    sets = []
    for _, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(set() if not w else {tuple(w)} if len(w) < words else {tuple(w[i:i + words]) for i in range(len(w) - words + 1)})
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(len(sets[i]), (least.get(root(i)) if sets[i] else rows[i][0])) for i in range(len(rows))]


def repeated_bytes(rows, least=50):
    """Sorted (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    first = {}
    for d, t in rows:
        b, d = (t or "").encode(), -1 if d is None else d
        for i in range(len(b) - least + 1):
            first[b[i:i + least]] = min(first.get(b[i:i + least], d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - least + 1):
            if first[b[i:i + least]] < (-1 if d is None else d):
                gone[i:i + least] = b"\1" * least
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def vector_links(vectors, threshold):
    """[(n_links, component index)] of float vectors; None links with nothing."""
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if k else None for v, k in zip(vectors, ok)]
    near = defaultdict(list)
    for i in range(len(unit)):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                near[i].append(j)
                near[j].append(i)
    seen, comp = {}, []
    for i in range(len(unit)):
        todo, group = [i], {i}
        while todo:
            for j in near[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        comp.append(group)
    return [(len(near[i]), comp[i]) for i in range(len(unit))]


def unit_removals(rows, min_words=6):
    """{(row, start)}: units that repeat an earlier one, by the rules of the unit dedup, written out plainly."""
    occurrences, own = [], {}
    for r, (d, text) in enumerate(rows):
        pieces, at = [], 0
        for m in re.finditer(r"\n+|(?<=[.!?])\s+", text or ""):
            pieces.append((at, (text[at:m.end()])))
            at = m.end()
        if text and at < len(text):
            pieces.append((at, text[at:]))
        pieces = [(a, p) for a, p in pieces if p]
        words = [p.lower().split() for _, p in pieces]
        for i, (a, _) in enumerate(pieces):
            marks = []
            if len(words[i]) >= min_words:
                marks = [("whole", *words[i])]
            elif words[i]:
                if i and len(words[i]) + len(words[i - 1]) >= min_words:
                    marks.append(("last", tuple(words[i - 1]), tuple(words[i])))
                if i + 1 < len(words) and len(words[i]) + len(words[i + 1]) >= min_words:
                    marks.append(("first", tuple(words[i]), tuple(words[i + 1])))
            own[r, a] = marks
            occurrences += [(m, (d is not None, d or 0, a)) for m in marks]
    first = {}
    for m, rank in occurrences:
        first[m] = min(first.get(m, rank), rank)
    return {(r, a) for (r, a), marks in own.items() if any((rows[r][0] is not None, rows[r][0] or 0, a) > first[m] for m in marks)}


def counted(rows):
    return Counter(rows)
