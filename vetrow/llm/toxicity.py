"""Toxicity by noisy-channel deobfuscation.

A character model (trigrams of the whole corpus) and a channel (look-alike
signs, repeated letters, signs and blanks put between letters) restore each
disguised token: its readings form a lattice, and Viterbi decoding finds the
likeliest word. In the lattice of tokens of one sign each a blank is either put
there or a word's end, so that decoding also finds where the words lie. The
restored words are scored by a lexicon of words and word ends learned from
labelled texts. Each distinct token is restored once by a Python worker.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vetrow.llm.common import map_batches, text_blocks

#: Letters of the character model: a to z, then U+00DF to U+00FF; 0 is a word's end, 63 any other letter.
SYMBOLS = 64
OTHER = 63
#: Bounds of what the classifier is fitted on.
TOXIC_TEXTS = 1500
CLEAN_TEXTS = 4000
TRAINING_BYTES = 50_000
MAX_ENTRIES = 500
AFFIX = (4, 5, 6)
#: Entries in so many of the toxic texts, and so surely toxic, are taken whether or not others explain the same texts.
COMMON, SURE = 0.03, 0.98
PREDICT_AT = 0.3
TABLE_TOKENS = 150_000

# Signs that stand for letters, by the usual look-alikes.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "×": "x",
}
# Letters of other scripts that look like Latin ones, read so in words that hold Latin letters too.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "һ": "h", "ԁ": "d",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
}
# Log probabilities of the channel; the last two are of a blank inside a row of single signs.
PLAIN, LOOKS, REPEATED, INSERTED = math.log(0.9), math.log(0.4), math.log(0.2), math.log(0.3)
PUT_BETWEEN, WORD_END = math.log(0.8), math.log(0.2)
#: Readings of a row of single signs whose words are scored.
READINGS = 4

_EDGES = ".,;:?!\"'`´()[]{}<>/\\*&%#|~^=_-–—…«»“”‘’¿¡"
_PLAIN_WORD = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1")
_SPACED = re.compile(r"(?<!\S)(?:\S ){2,}\S(?!\S)")
_MIXED = re.compile(f"[a-z].*[{''.join(HOMOGLYPHS)}]|[{''.join(HOMOGLYPHS)}].*[a-z]")
_EDGE_RUN = re.compile(r"^([^\w\s])\1+|([^\w\s])\2+$")


def _symbol_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            o = ord(low[0])
            table[c] = o - 96 if 97 <= o <= 122 else 27 + o - 0xDF if 0xDF <= o <= 0xFF else OTHER
    return table


_SYMBOL: np.ndarray | None = None


def symbols(text: str) -> np.ndarray:
    global _SYMBOL
    if _SYMBOL is None:
        _SYMBOL = _symbol_table()
    return _SYMBOL[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def _symbol(ch: str) -> int:
    o = ord(ch)
    return o - 96 if 97 <= o <= 122 else 27 + o - 0xDF if 0xDF <= o <= 0xFF else OTHER


def trigram_counts(docs: DataFrame, *, text_col: str = "text") -> np.ndarray:
    """Counts of letter trigrams over every text: one number for each of SYMBOLS^3 trigrams, summed
    in tasks first; what reaches the driver is bounded by the alphabet."""
    cells = SYMBOLS ** 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for block in text_blocks([t for t in batch.column(0).to_pylist() if t], 1 << 12):
                s = np.concatenate([[0, 0], symbols("\n\n".join(block)), [0]]).astype(np.int32)
                total += np.bincount(s[:-2] * 4096 + s[1:-1] * 64 + s[2:], minlength=cells)
        grams = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(grams, pa.int64()), pa.array(total[grams], pa.int64())], ["gram", "n"])

    out = np.zeros(cells, np.int64)
    counted = map_batches(docs.select(text_col), run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    for r in counted.collect():
        out[r["gram"]] = r["n"]
    return out


class Restorer:
    """Reads tokens through the channel: the likeliest plain word behind each."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
        pair, single = c.sum(0), c.sum((0, 1))
        one = (single + 0.5) / (single.sum() + 0.5 * SYMBOLS)
        two = (pair + 20 * one[None, :]) / (pair.sum(1, keepdims=True) + 20)
        three = (c + 20 * two[None, :, :]) / (c.sum(2, keepdims=True) + 20)
        self.logp = np.log(three).astype(np.float32)

    def decode(self, token: str) -> str:
        """The likeliest word behind a token."""
        return self.readings(token, 1)[0]

    def readings(self, shown: str, most: int) -> list[str]:
        """Viterbi over the lattice of readings, the ``most`` likeliest; a state is the last two letters read, and holds
        as many ways to it. Blanks are put between letters or end a word. A way is a chain of letters, so that time and
        memory grow with the length alone."""
        logp = self.logp
        states = {(0, 0): [(0.0, None)]}
        last = ""
        for ch in shown:
            if ch == " ":
                options, skip = [], PUT_BETWEEN
            elif ch.isalpha():
                options = [(ch, PLAIN)]
                if ch in HOMOGLYPHS:
                    options.append((HOMOGLYPHS[ch], LOOKS))
                skip = REPEATED if ch == last else None
            else:
                options = [(r, LOOKS) for r in LOOKALIKES.get(ch, "")]
                skip = INSERTED
            if ch != " ":
                last = ch
            after: dict = defaultdict(list)
            for (a, b), ways in states.items():
                if skip is not None:
                    after[a, b] += [(score + skip, way) for score, way in ways]
                if ch == " " and b:
                    end = WORD_END + float(logp[a, b, 0])
                    after[0, 0] += [(score + end, (way, " ")) for score, way in ways]
                for letter, cost in options:
                    s = _symbol(letter)
                    to = cost + float(logp[a, b, s])
                    after[b, s] += [(score + to, (way, letter)) for score, way in ways]
            states = {}
            for state, ways in after.items():
                if len(ways) > 1:
                    ways.sort(key=_likelihood, reverse=True)
                states[state] = ways[:most]
        ended = [(score + float(logp[a, b, 0]), way) for (a, b), ways in states.items() for score, way in ways]
        ended.sort(key=_likelihood, reverse=True)
        out: dict[str, None] = {}
        for _, way in ended[: 2 * most]:
            letters = []
            while way is not None:
                way, letter = way
                letters.append(letter)
            out["".join(reversed(letters)).strip()] = None
        return list(out)[:most]

    def restore(self, token: str) -> str:
        """The plain lower-case word behind a lower-case token; empty if it holds no reading."""
        core = token.strip(_EDGES[:3] + '"')
        if _plain(core):
            return core
        while (shorter := _EDGE_RUN.sub("", core)) != core:
            core = shorter
        core = core.lstrip(_EDGES.replace("!", "").replace("|", "").replace("(", "")).rstrip(_EDGES)
        if not core or _plain(core):
            return core
        if not any(c.isalpha() or c in LOOKALIKES for c in core):
            return ""
        return self.decode(core)

    def spaced_words(self, run: str) -> set[str]:
        """Words of the likeliest readings of a row of single signs; those of one letter say nothing."""
        return {w for reading in self.readings(run, READINGS) for w in reading.split() if len(w) > 1}


def _likelihood(way) -> float:
    return way[0]


def _plain(core: str) -> bool:
    return bool(_PLAIN_WORD.fullmatch(core)) and not _RUN.search(core) and (core.isascii() or not _MIXED.search(core))


def shown_units(text: str) -> list[str]:
    """What is restored of a lower-case text: its tokens, and its rows of three or more tokens of one sign each."""
    return text.split() + _SPACED.findall(text)


def entries(word: str) -> list[str]:
    """What the lexicon may hold of a word: the word, its beginnings and its ends."""
    out = [word]
    for n in AFFIX:
        if len(word) > n:
            out.append(word[:n] + "*")
            out.append("*" + word[-n:])
    return out


@dataclass
class ToxicityModel:
    counts: np.ndarray          # trigram counts of the corpus
    lexicon: dict[str, float]   # entry to the share of toxic among texts that hold it
    base: float                 # share of toxic among texts that hold none


def fit_lexicon(texts: list[tuple[list[str], int, float]], most: int = MAX_ENTRIES) -> tuple[dict[str, float], float]:
    """(lexicon, base) from (words, toxic, weight) of the texts: entries are taken greedily, each time the one that
    explains most toxic texts not yet explained, against the clean texts that hold it; then those that are common and sure."""
    toxic = [i for i, t in enumerate(texts) if t[1] == 1]
    total = sum(w for _, _, w in texts)
    base = (sum(texts[i][2] for i in toxic) + 0.5) / (total + 1) if total else 0.0
    least = max(2, round(0.003 * len(toxic)))
    known: dict[str, tuple[str, ...]] = {}

    def held_by(words: list[str]) -> set[str]:
        for w in words:
            if w not in known:
                known[w] = tuple(entries(w))
        return {e for w in words for e in known[w]}

    support: Counter = Counter()
    for i in toxic:
        support.update(held_by(texts[i][0]))
    candidates = {e for e, n in support.items() if n >= least}
    holds: dict[str, list[int]] = defaultdict(list)
    for i in toxic:
        for e in held_by(texts[i][0]) & candidates:
            holds[e].append(i)
    support.clear()
    known.clear()
    clean: Counter = Counter()
    for words, label, weight in texts:
        if label != 1:
            for e in {e for w in words for e in entries(w)} & candidates:
                clean[e] += weight
    weight_of = {i: texts[i][2] for i in toxic}
    share = {e: (sum(weight_of[i] for i in d) + 0.2) / (sum(weight_of[i] for i in d) + clean[e] + 0.4) for e, d in holds.items()}
    usable = [e for e in holds if share[e] >= 0.6]
    lexicon: dict[str, float] = {}
    uncovered = set(toxic)
    gain = {e: len(holds[e]) for e in usable}
    while uncovered and gain and len(lexicon) < most:
        ranked = max(gain, key=lambda e: (gain[e] * share[e], len(e.strip("*")), e))
        fresh = sum(i in uncovered for i in holds[ranked])
        if fresh < gain[ranked]:  # lazily brought up to date
            gain[ranked] = fresh
            if fresh < least:
                del gain[ranked]
            continue
        lexicon[ranked] = share[ranked]
        uncovered.difference_update(holds[ranked])
        del gain[ranked]
    taken = {tuple(holds[e]) for e in lexicon}
    for e in sorted(usable, key=lambda e: (-len(holds[e]), -len(e.strip("*")), e)):  # common ones that others happen to cover here
        if len(lexicon) >= most or len(holds[e]) < max(least, COMMON * len(toxic)):
            break
        if share[e] >= SURE and tuple(holds[e]) not in taken:  # of entries in the same texts, the longest
            taken.add(tuple(holds[e]))
            lexicon[e] = share[e]
    missed = sum(weight_of[i] for i in uncovered)
    held = sum(w for _, label, w in texts if label != 1) + missed
    return lexicon, (missed + 0.2) / (held + 1) if texts else base


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          toxic_texts: int = TOXIC_TEXTS, clean_texts: int = CLEAN_TEXTS, max_bytes: int = TRAINING_BYTES) -> ToxicityModel:
    """The character model from every text of ``docs``; the lexicon from a bounded sample of ``labels``
    (id, label 0/1; others are ignored): about ``toxic_texts`` and ``clean_texts`` ids by hash, whole texts
    of at most ``max_bytes``."""
    counts = trigram_counts(docs, text_col=text_col)
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(id_col, F.col(label_col).alias("_toxic"))
    sizes = {r["_toxic"]: r["count"] for r in usable.groupBy("_toxic").count().collect()}
    share = {y: min(1.0, most / max(sizes.get(y, 0), 1)) for y, most in ((1, toxic_texts), (0, clean_texts))}
    place = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("toxic sample")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = usable.where(place < F.when(F.col("_toxic") == 1, share[1]).otherwise(share[0]))
    rows = docs.select(id_col, text_col).where(F.octet_length(text_col) <= max_bytes).join(
        F.broadcast(sample), id_col).collect()  # the sample is bounded by the two shares
    restorer, seen = Restorer(counts), {}
    texts = []
    for r in sorted(rows, key=lambda r: (r[id_col], r["_toxic"])):
        words = set()
        for token in set(shown_units(r[text_col].lower())):
            if token not in seen:
                seen[token] = restorer.spaced_words(token) if " " in token else {restorer.restore(token)}
            words |= seen[token]
        words.discard("")
        texts.append((sorted(words), r["_toxic"], 1 / share[r["_toxic"]]))
    lexicon, base = fit_lexicon(texts)
    return ToxicityModel(counts, lexicon, base)


class TokenTable(dict):
    """Token, or row of single signs, to its best lexicon entry (or None), restored once; ``batch`` takes what no longer fits."""

    def __init__(self, model: ToxicityModel):
        super().__init__()
        self.restorer, self.lexicon = Restorer(model.counts), model.lexicon
        self.batch: dict[str, str | None] = {}

    def __missing__(self, token: str):
        if token in self.batch:
            return self.batch[token]
        words = self.restorer.spaced_words(token) if " " in token else [self.restorer.restore(token)]
        held = [e for w in words for e in entries(w) if e in self.lexicon]
        best = max(held, key=lambda e: (self.lexicon[e], e)) if held else None
        if len(self) < TABLE_TOKENS:
            self[token] = best
        else:
            if len(self.batch) > TABLE_TOKENS // 8:
                self.batch.clear()
            self.batch[token] = best
        return best


def text_score(text: str, table: TokenTable, base: float) -> float:
    """Chance that at least one of the text's lexicon entries is meant: 1 - prod(1 - share), from the base on."""
    found = set(map(table.__getitem__, shown_units(text.lower())))
    clear = 1 - base
    for e in found:
        if e is not None:
            clear *= 1 - table.lexicon[e]
    return 1 - clear


def score(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text",
          keep_columns: bool = False) -> DataFrame:
    """``doc_id, score`` (0 to 1) of every whole text, or all columns and ``_score`` (replacing one of that name).

    A null or empty text has the base score; repeated rows score alike; with no labelled rows
    the lexicon is empty and every text has the base score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SYMBOLS^3 counts and MAX_ENTRIES entries
    rows = docs.drop("_score") if keep_columns else docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    place = rows.columns.index(text_col if keep_columns else "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TokenTable(shared.value)
        base = shared.value.base
        for batch in batches:
            scores = pa.array([text_score(t.as_py() or "", table, base) for t in batch.column(place)], pa.float64())
            if keep_columns:
                yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "_score"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), scores], ["doc_id", "score"])

    if keep_columns:
        return map_batches(rows, run, T.StructType([*rows.schema.fields, T.StructField("_score", T.DoubleType())]))
    return map_batches(rows, run, "doc_id long, score double")
