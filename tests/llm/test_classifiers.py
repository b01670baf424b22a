import random

import numpy as np
import pytest
from brute import CLASHING, edge_rows, frame
from pyspark.sql import functions as F

from vetrow.llm import langid, toxicity

SOUNDS = {"aa": "ka ra ma ta", "bb": "sch ung lich ver", "cc": "que eau oi ment"}


def sounding(rng, lang, n):
    parts = SOUNDS[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_presence_counts_shared_grams():
    a, lettered = langid.presence(["Ab cd", "ab CD", "12 !", ""])
    assert (a[0] == a[1]).all() and list(lettered) == [True, True, False, False] and a[2].sum() == 0
    grams = {g for n in langid.LENGTHS for g in [" ab cd "[i: i + n] for i in range(8 - n)]}
    assert a[0].sum() == len(grams)


def test_folded_weights_equal_the_kernel_machine():
    """Scores by the folded matrix are those of landmarks, Nyström map and ridge regression step by step."""
    rng = random.Random(3)
    texts = [(sounding(rng, y, 30), y) for _ in range(12) for y in SOUNDS]
    model = langid.fit([t for t, _ in texts], [y for _, y in texts], landmarks=3)
    grams = lambda t: set(np.flatnonzero(langid.presence([t])[0][0]).tolist())
    kernel = lambda a, b: len(grams(a) & grams(b)) / np.sqrt(len(grams(a)) * len(grams(b)))
    marks = [t for y in SOUNDS for t in [x for x, z in texts if z == y][:3]]
    gram = np.array([[kernel(a, b) for b in marks] for a in marks])
    value, vector = np.linalg.eigh(gram)
    features = np.array([[kernel(t, m) for m in marks] for t, _ in texts]) @ (vector / np.sqrt(value))
    for j, y in enumerate(sorted(SOUNDS)):
        target = np.array([1.0 if z == y else -1.0 for _, z in texts])
        x = features - features.mean(0)
        w = np.linalg.solve(x.T @ x + 1e-2 * np.eye(x.shape[1]), x.T @ (target - target.mean()))
        want = x @ w + target.mean()
        held, _ = langid.presence([t for t, _ in texts])
        got = held @ model.weights[:, j] / np.sqrt(held.sum(1)) + model.bias[j]
        assert np.allclose(got, want, atol=1e-4)


def test_languages_held_out(spark):
    rng = random.Random(5)
    rows = [(i, sounding(rng, y, rng.choice([2, 20, 200])), y) for i in range(90) for y in SOUNDS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs.where(F.col("doc_id") % 3 != 0))
    right = langid.predict(docs, model).join(docs.distinct().select("doc_id", "text", "lang"), "doc_id").where("doc_id % 3 = 0")
    assert right.count() > 0
    scored, _ = model.score([t for i, t, _ in rows if i % 3 == 0])
    assert np.mean([a == b for a, b in zip(scored, [y for i, _, y in rows if i % 3 == 0])]) > 0.97


def test_language_edge_table(spark):
    rows = edge_rows()
    docs = frame(spark, rows, CLASHING).withColumn("lang", F.lit("xx"))
    model = langid.train(docs)
    out = {(r["doc_id"], r["lang_pred"], r["score"] > 0) for r in langid.predict(docs, model).collect()}
    for d, t in rows:
        lettered = bool(t) and any(c.isalpha() for c in t)
        assert (d, "xx" if lettered else "und", lettered) in out
    kept = langid.predict(docs, model, keep_columns=True)
    assert kept.columns == [c for c in docs.columns if c != "_score"] + ["_lang_pred", "_score"]
    assert kept.count() == len(rows)
    nothing = langid.train(docs.where("false"))
    assert {r["lang_pred"] for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(frame(spark, []), model).collect() == []


WORDS = "the garden house walks along with many people under bright water stones and idle rivers".split()


def clean(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def restorer():
    """A character model of plain words, counted without Spark."""
    rng = random.Random(1)
    counts = np.zeros(toxicity.SYMBOLS ** 3, np.int64)
    for word in (clean(rng, 4000) + " idiot stupid moron" * 30).split():
        s = np.concatenate([[0, 0], toxicity.symbols(word), [0]]).astype(int)
        np.add.at(counts, s[:-2] * 4096 + s[1:-1] * 64 + s[2:], 1)
    return toxicity.Restorer(counts)


@pytest.mark.parametrize("shown,meant", [
    ("1d1ot", "idiot"), ("$tup1d", "stupid"), ("m0r0n", "moron"), ("i.d.i.o.t", "idiot"), ("iiidiooot", "idiot"), ("st-upid!!!", "stupid"),
    ("stuupid", "stupid"), ("ıdiot", None), ("idi\u043et", "idiot"), ("\u0455tupid", "stupid"),
    ("garden", "garden"), ("garden.", "garden"), ("the&&&", "the"), ("***", ""), ("", ""), ("123456", None)])
def test_restored_words(restorer, shown, meant):
    got = restorer.restore(shown)
    assert meant is None or got == meant


def test_viterbi_finds_the_best_reading(restorer):
    """Against all readings of the lattice."""
    def readings(token):
        out, last = [(0.0, "")], ""
        for ch in token:
            after = []
            for score, word in out:
                if ch.isalpha():
                    after.append((score + toxicity.PLAIN, word + ch))
                    if ch == last:
                        after.append((score + toxicity.REPEATED, word))
                else:
                    after += [(score + toxicity.LOOKS, word + r) for r in toxicity.LOOKALIKES.get(ch, "")]
                    after.append((score + toxicity.INSERTED, word))
            out, last = after, ch
        return out

    def logp(word):
        s = [0, 0, *(toxicity._symbol(c) for c in word), 0]
        return sum(float(restorer.logp[a, b, c]) for a, b, c in zip(s, s[1:], s[2:]))

    for token in ("1d1ot", "s+onees", "w4l|k", "aaab0", "m!6ht"):
        best = max((score + logp(word), word) for score, word in readings(token))
        assert restorer.decode(token) == best[1]


def test_rows_of_single_signs(restorer):
    def words(text):
        return {w for u in toxicity.shown_units(text) if " " in u for w in restorer.spaced_words(u)}

    assert "idiot" in words("you i d i o t there")
    assert "stupid" in words("a s t u p i d")
    assert "moron" in words("such a m 0 r 0 n")
    assert toxicity.shown_units("a b") == ["a", "b"]
    assert words("x " * 5000) is not None


def test_blanks_in_the_lattice(restorer):
    """Against all ways to read each blank of a row of single letters."""
    def logp(word):
        s = [0, 0, *(toxicity._symbol(c) for c in word), 0]
        return sum(float(restorer.logp[a, b, c]) for a, b, c in zip(s, s[1:], s[2:]))

    for run in ("t h e i d i o t", "m o r o n", "u n d e r t h e"):
        letters, ways = run.split(), []
        for cut in range(1 << (len(letters) - 1)):
            text = letters[0]
            score = toxicity.PLAIN * len(letters)
            for i, c in enumerate(letters[1:]):
                score += toxicity.WORD_END if cut >> i & 1 else toxicity.PUT_BETWEEN
                text += " " + c if cut >> i & 1 else c
            ways.append((score + sum(logp(w) for w in text.split()), text))
        assert not any(a == b for a, b in zip(letters, letters[1:]))
        assert restorer.readings(run, 1) == [max(ways)[1]]
        assert restorer.readings(run, 3) == [t for _, t in sorted(ways, reverse=True)[:3]]


def test_scores_held_out(spark):
    rng = random.Random(9)
    bad = ["idiot", "stupid", "vequ", "lowei"]
    rows, labels = [], []
    for i in range(400):
        words = clean(rng, rng.randint(5, 60)).split()
        toxic = i % 5 == 0
        if toxic:
            word = rng.choice(bad)
            words.insert(rng.randrange(len(words)), word + "".join(rng.choice("aeioul") for _ in range(3)) if word in bad[2:] else word)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(1000, "what an 1d1ot you are"), (1001, "a s t u p i d thing"), (1002, None), (1003, ""), (1004, "stuuupid idea"), (1005, "the garden")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, table.where("doc_id % 4 <> 2"))
    out = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert len(out) == len(rows) and all(0 <= s <= 1 for s in out.values())
    held = [(out[i] >= toxicity.PREDICT_AT) == bool(y) for i, y in labels if i % 4 == 2]
    assert np.mean(held) > 0.97
    assert [i for i in (1000, 1001, 1004) if out[i] < toxicity.PREDICT_AT] == []
    assert all(out[i] < toxicity.PREDICT_AT for i in (1002, 1003, 1005))


def test_toxicity_edge_table(spark):
    rows = edge_rows()
    docs = frame(spark, rows, CLASHING)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (77777, 1), (4, 7)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert toxicity.score(docs, model).count() == len(rows)
    kept = toxicity.score(docs, model, keep_columns=True)
    assert kept.columns == [c for c in docs.columns if c != "_score"] + ["_score"] and kept.count() == len(rows)
    none = toxicity.train(frame(spark, []), labels)
    assert none.lexicon == {} and toxicity.score(frame(spark, []), none).collect() == []


def test_every_labelled_language_is_learned(spark, monkeypatch):
    words = {"aa": "alpha beta gamma", "bb": "uno dos tres cuatro", "cc": "ichi ni san shi"}
    rows = [(i, f"{words['aa']} {i} " * 3, "aa") for i in range(30)] + [(100 + i, f"{words['bb']} {i} " * 2000, "bb") for i in range(9)]
    rows += [(200, words["cc"], "cc"), (201, None, "dd"), (202, "123", "ee"), (203, "some text", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = langid.training_sample(docs, id_col="doc_id", text_col="text", lang_col="lang")
    by = {y: [t for t, g in sample if g == y] for y in {g for _, g in sample}}
    assert set(by) == {"aa", "bb", "cc"} and len(by["bb"]) == langid.LONG_TEXTS
    assert langid.train(docs).languages == ["aa", "bb", "cc"]
    many = spark.createDataFrame([(i, f"{chr(0x4e00 + i // 4)}{chr(0x4e00 + i // 4)} word{i // 4} {i}", f"l{i // 4:03d}") for i in range(1200)],
                                 "doc_id long, text string, lang string")
    model = langid.train(many)
    assert len(model.languages) == 300
    right = langid.predict(many, model).join(many.select("doc_id", "lang"), "doc_id").where("lang_pred = lang").count()
    assert right >= 1100
