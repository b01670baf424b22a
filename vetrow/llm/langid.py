"""Language identification with string kernels.

The kernel of two texts counts the character n-grams (a blended spectrum of
lengths) present in both, normalised by the number present in each. Landmark
texts give Nyström features, and a ridge regression for each language against
the rest is fitted on them. As the presence kernel is linear in the n-grams,
landmarks, Nyström map and ridge weights fold into one matrix of n-gram slots
by languages, and texts are scored by products of presence matrices with it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vetrow.llm.common import map_batches, text_blocks

UNDETERMINED = "und"
LENGTHS = (1, 2, 3, 4)
SLOTS = 1 << 15
#: Bounds of what the classifier is fitted on: texts of each language and their length, landmarks of each language; of many
#: languages fewer each, so that all together stay near the second number. A language without a text of that length
#: gives its shortest ones. The model itself has SLOTS numbers for each language.
TRAINING_TEXTS, ALL_TEXTS = 250, 5000
TRAINING_BYTES, LONG_TEXTS = 20_000, 4
LANDMARKS, ALL_LANDMARKS = 40, 1200
BLOCK_TEXTS = 64
#: Trigrams that the training texts share are kept as a map of hashed slots, one bit each: those in so many texts of
#: a language, and at least in two, so that no text and little junk with a label makes itself known.
KNOWN_SLOTS = 1 << 22
KNOWN_TEXTS = 0.02


@lru_cache(maxsize=1)
def _folding() -> tuple[np.ndarray, np.ndarray]:
    """(lower-case code point or 32 for what is no letter, is a letter) by code point."""
    fold = np.full(0x110000, 32, np.uint32)
    letter = np.zeros(0x110000, bool)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            letter[c] = True
            low = ch.lower()
            fold[c] = ord(low) if len(low) == 1 else c
    return fold, letter


def presence(texts: list[str], lengths=LENGTHS, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """(texts x slots presence of n-grams, whether a text has a letter). Case and what is no letter are folded away."""
    fold, letter = _folding()
    out = np.zeros((len(texts), slots), np.uint8)
    lettered = np.zeros(len(texts), bool)
    flat = out.reshape(-1)
    for row, text in enumerate(texts):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        lettered[row] = letter[codes].any()
        if not lettered[row]:
            continue
        codes = fold[codes]
        blank = codes == 32
        codes = codes[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
        codes = np.concatenate([[32], codes, [32]]).astype(np.uint64)
        base = row * slots
        rolled = np.zeros(len(codes), np.uint64)
        for n in range(1, max(lengths) + 1):
            rolled = rolled[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:]
            if n in lengths:
                slot = ((rolled ^ np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - slots.bit_length() + 1)
                flat[base + slot.astype(np.int64)] = 1
    return out, lettered


def _trigrams(text: str) -> np.ndarray:
    """Slots of a text's trigrams; case and what is no letter are folded away."""
    fold, _ = _folding()
    codes = fold[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint64)
    codes = codes[np.concatenate([[True], ~((codes[1:] == 32) & (codes[:-1] == 32))])]
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    mixed = np.uint64(0x9E3779B97F4A7C15)
    rolled = ((codes[:-2] * mixed + codes[1:-1]) * mixed + codes[2:]) * np.uint64(0xD6E8FEB86659FD93)
    return (rolled >> np.uint64(64 - KNOWN_SLOTS.bit_length() + 1)).astype(np.int64)


def known_trigrams(texts: list[str], languages: list[str]) -> np.ndarray:
    """The map of the trigrams that different texts of a language share."""
    known = np.zeros(KNOWN_SLOTS, bool)
    for name in sorted(set(languages)):
        of_it = {t for t, y in zip(texts, languages) if y == name}
        held = np.zeros(KNOWN_SLOTS, np.uint32)
        for t in of_it:
            held[np.unique(_trigrams(t))] += 1
        known |= held >= max(2, math.ceil(KNOWN_TEXTS * len(of_it)))
    return np.packbits(known)


def known_share(text: str, known: np.ndarray) -> float:
    """The share of a text's trigrams that are in the map: low for letter junk and for languages not learned."""
    slots = _trigrams(text)
    return float(((known[slots >> 3] >> (7 - (slots & 7))) & 1).mean()) if len(slots) else 0.0


@dataclass
class KernelModel:
    languages: list[str]
    weights: np.ndarray  # slots x languages: landmarks, Nyström map and ridge weights folded together
    bias: np.ndarray

    def score(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(language, score 0 to 1) of every text."""
        names, scores = [], []
        for block in text_blocks(texts, BLOCK_TEXTS):
            held, lettered = presence(block)
            values = held.astype(np.float32) @ self.weights
            values = values / np.sqrt(np.maximum(held.sum(1, dtype=np.int64), 1))[:, None] + self.bias
            best = values.argmax(1) if len(self.languages) else np.zeros(len(block), int)
            for i, ok in enumerate(lettered):
                if ok and self.languages:
                    names.append(self.languages[best[i]])
                    scores.append(float(np.clip((values[i, best[i]] + 1) / 2, 0, 1)))
                else:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
        return names, np.array(scores)


def fit(texts: list[str], languages: list[str], landmarks: int = LANDMARKS, ridge: float = 1e-2) -> KernelModel:
    """Fit on labelled texts, in their order; the first ``landmarks`` of each language are the landmarks (fewer, one at
    least, where there would be more than ``ALL_LANDMARKS``)."""
    usable = [(t, y) for t, y in zip(texts, languages)]
    names = sorted({y for _, y in usable})
    landmarks = max(1, min(landmarks, ALL_LANDMARKS // max(len(names), 1)))
    if not names:
        return KernelModel([], np.zeros((SLOTS, 0), np.float32), np.zeros(0, np.float32))
    seen, chosen = dict.fromkeys(names, 0), []
    for i, (_, y) in enumerate(usable):
        if seen[y] < landmarks:
            seen[y] += 1
            chosen.append(i)
    marks, _ = presence([usable[i][0] for i in chosen])
    marks = marks.astype(np.float32)
    marks /= np.sqrt(np.maximum(marks.sum(1), 1))[:, None]
    gram = (marks @ marks.T).astype(np.float64)
    value, vector = np.linalg.eigh(gram)
    keep = value > 1e-8 * value.max()
    nystrom = vector[:, keep] / np.sqrt(value[keep])
    kernel = []
    for block in text_blocks([t for t, _ in usable], BLOCK_TEXTS):
        held, _ = presence(block)
        held = held.astype(np.float32)
        kernel.append((held @ marks.T) / np.sqrt(np.maximum(held.sum(1), 1))[:, None])
    features = np.concatenate(kernel).astype(np.float64) @ nystrom
    target = np.array([[1.0 if y == n else -1.0 for n in names] for _, y in usable])
    weight = np.array([1.0 / sum(y == n for _, y in usable) for _, n in usable])[:, None]  # languages count alike
    weight *= len(usable) / weight.sum()
    centre = (features * weight).sum(0) / weight.sum()
    bias = (target * weight).sum(0) / weight.sum()
    x, y = (features - centre) * np.sqrt(weight), (target - bias) * np.sqrt(weight)
    solved = np.linalg.solve(x.T @ x + ridge * np.eye(x.shape[1]), x.T @ y)
    folded = marks.T.astype(np.float64) @ (nystrom @ solved)
    return KernelModel(names, folded.astype(np.float32), (bias - centre @ solved).astype(np.float32))


def training_sample(labelled: DataFrame, *, id_col: str, text_col: str, lang_col: str,
                    texts: int = TRAINING_TEXTS, max_bytes: int = TRAINING_BYTES) -> list[tuple[str, str]]:
    """About ``texts`` whole texts of each language (fewer of many languages: ``ALL_TEXTS`` in all, two of each at least),
    chosen by the hash of their id among those of at most ``max_bytes``, or the ``LONG_TEXTS`` shortest of a language that
    has none: a bounded sample that keeps every label, in a fixed order. Ties go by hash, then by text."""
    usable = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    short = F.octet_length(text_col) <= max_bytes
    counts = usable.groupBy(lang_col).agg(F.count_if(short).alias("short")).collect()  # one row a language
    if not counts:
        return []
    texts = max(2, min(texts, ALL_TEXTS // len(counts)))
    place = F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("sample")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    usable = usable.select(place.alias("place"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), short.alias("short"))
    rows = []
    share = [x for r in counts if r["short"] for x in (F.lit(r[0]), F.lit(min(1.0, texts / r["short"])))]
    if share:
        rows += usable.where(F.col("short") & (F.col("place") < F.try_element_at(F.create_map(*share), F.col("lang")))).collect()
    lost = {r[0] for r in counts} - {r["lang"] for r in rows}  # no short text, or none that the hash chose
    if lost:
        nearest = Window.partitionBy("lang").orderBy(F.octet_length("text"), "place", "text")
        rows += usable.where(F.col("lang").isin(*lost)).withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= LONG_TEXTS).collect()
    rows.sort(key=lambda r: (r["place"], r["text"]))
    return [(r["text"], r["lang"]) for r in rows]


def train(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **bounds) -> KernelModel:
    sample = training_sample(labelled, id_col=id_col, text_col=text_col, lang_col=lang_col, **bounds)
    return fit([t for t, _ in sample], [y for _, y in sample])


def predict(docs: DataFrame, model: KernelModel, *, id_col: str = "doc_id", text_col: str = "text",
            keep_columns: bool = False, known: np.ndarray | None = None) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text, or all columns and ``_lang_pred, _score`` (replacing any of
    these names). With ``known``, a map of trigrams, the ``known_share`` of the text follows as ``_known`` (0 of a null
    one), from the same pass: a second one would hold another Python worker, and the texts once more, for each core.

    A null text, one without a letter, or any text when nothing was learned gets
    ``und`` with score 0; ties go to the language that sorts first; repeated
    rows are scored alike, whole texts are read at any length."""
    shared = docs.sparkSession.sparkContext.broadcast((model, known))  # slots x languages floats, and half a megabyte
    added = ["_lang_pred", "_score"] if keep_columns else ["lang_pred", "score"]
    added += ["_known"] if known is not None else []
    rows = docs.drop(*added) if keep_columns else docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    place = rows.columns.index(text_col if keep_columns else "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, trigrams = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            names, scores = scorer.score(texts)
            found = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            if trigrams is not None:
                found.append(pa.array([known_share(t, trigrams) for t in texts], pa.float64()))
            carried = batch.columns if keep_columns else [batch.column(0)]
            yield pa.RecordBatch.from_arrays([*carried, *found], [*batch.schema.names[: len(carried)], *added])

    carried = rows.schema.fields if keep_columns else rows.schema.fields[:1]
    kinds = [T.StringType(), T.DoubleType(), T.DoubleType()]
    return map_batches(rows, run, T.StructType([*carried, *(T.StructField(n, k) for n, k in zip(added, kinds))]))
