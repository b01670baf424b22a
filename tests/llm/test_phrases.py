import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import CLASHING

from vetrow.llm import phrases


def brute(rows, words=4, support=30, scale=2_000_000, held=80, top=2000):
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, words + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    out = {}
    candidates = {p: c for p, c in f.items() if len(p[1]) > 1 and c >= support}
    for (lang, p), a in candidates.items():
        if any(l2 == lang and len(q) > len(p) and 100 * c >= held * a and any(q[i:i + len(p)] == p for i in range(len(q)))
               for (l2, q), c in candidates.items()):
            continue
        score, _, l, r = min((scale * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def corpus(seed=1, n=300):
    rng = random.Random(seed)
    stock = "new york city of the big apple Über straße 日本 a b ab 3.5 x-y end".split()
    fixed = ["new york city", "the big apple of new york", "a b a b a b", "Über  straße\tx-y", "end"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else rng.choice(stock) for _ in range(rng.randint(1, 30))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "!\n", "\x0b", ";"]) for p in parts)
        rows.append((text, rng.choice(["en", "en", "en", "de", "und", None])))
    rows += [(None, "en"), ("", "fr"), (" \t\n.", "fr"), ("a b " * 400, "fr"), ("new york city. " * 20, None), ("\x00 \x00 " * 40, "zz")]
    return rows + rows[:40]


def frame(spark, rows, extra=()):
    return spark.createDataFrame([(i if i % 3 else None, t, g, *["extra"] * len(extra)) for i, (t, g) in enumerate(rows)],
                                 "doc_id long, text string, lang string" + "".join(f", {c} string" for c in extra)).repartition(4)


def result(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("words,support,held,top", [(4, 30, 80, 2000), (3, 5, 50, 2000), (2, 1, 80, 2000), (4, 30, 101, 7)])
def test_against_brute_force(spark, words, support, held, top):
    rows = corpus()
    got = phrases.mine_phrases(frame(spark, rows, (*CLASHING, "phrase", "rank", "tokens")), words=words, support=support, held_percent=held, top=top)
    assert result(got) == brute(rows, words, support, held=held, top=top)


def test_small_blocks(spark):
    rows = corpus(2, 120)
    assert result(phrases.mine_phrases(frame(spark, rows), support=9, block_tokens=50)) == brute(rows, support=9)


def test_full_bitmaps_only_let_more_through(spark):
    rows = corpus(3, 100)
    assert result(phrases.mine_phrases(frame(spark, rows), support=12, bitmap_bits=6)) == brute(rows, support=12)


def test_words_that_meet_in_one_id_get_another_seed(spark):
    real = phrases.word_id
    meeting = lambda word, seed: 5 if seed == 0 and word in (b"york", b"city") else real(word, seed)
    rows = corpus(4, 60)
    assert result(phrases.mine_phrases(frame(spark, rows), support=8, word_id=meeting)) == brute(rows, support=8)


def test_hashes_that_meet_are_counted_apart(monkeypatch):
    rng = np.random.default_rng(3)
    tokens, lang = rng.integers(0, 6, 500).astype(np.uint64), np.repeat(np.array([1, 2], np.int64), 250)
    tokens[249] = tokens[499] = 0
    monkeypatch.setattr(phrases, "_mix", lambda x: x & np.uint64(3))
    got = Counter()
    for k, at, counts in phrases.count_block(tokens, lang, 3, np.full(1, 2**64 - 1, np.uint64)):
        for p, c in zip(at, counts):
            got[int(lang[p]), tuple(tokens[p:p + k].tolist())] += int(c)
    want = Counter((int(lang[i]), tuple(tokens[i:i + k].tolist())) for k in (1, 2, 3) for i in range(501 - k) if tokens[i:i + k].all())
    assert got == want


def test_products_beyond_64_bits(spark):
    big = 40_000_000_000_000
    counted = spark.createDataFrame([(1, [1], big), (1, [2], big + 7), (1, [1, 2], big - 1)], "lang_id long, phrase array<long>, f long")
    row = phrases._scores(counted, 4, 2_000_000).first()
    assert (row["score"], row["l"], row["r"]) == (2_000_000 * (big - 1) // (2 * big + 7), big, big + 7)


def test_empty_table(spark):
    assert phrases.mine_phrases(frame(spark, [])).collect() == []
    assert phrases.mine_phrases(frame(spark, [(None, None), ("", "a")])).collect() == []
