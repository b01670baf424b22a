"""Substring dedup by unit hashing.

Texts are cut into units (lines, paragraphs, or the sentences of lines), each
unit is normalised and hashed, digests are grouped over all texts, the
occurrence with the smallest (doc_id, start) stays and the others are removed,
with their offsets in the original text. A unit of few words says little by
itself: it is hashed in windows that grow over the units before or after it
until they have enough words, and goes where such a window is repeated.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vetrow.llm.common import map_batches, save

UNITS = {
    "paragraph": re.compile(r"\n[^\S\n]*\n\s*"),
    "line": re.compile(r"\n+"),
    "sentence": re.compile(r"\n+|(?<=[.!?])\s+"),
}
MIN_WORDS = 6
#: Scripts written without blanks between words, with their punctuation: Thai, Lao, Tibetan, Myanmar, Khmer, Tai, kana, Han, Yi, Javanese.
UNBLANKED = re.compile(
    "[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u1b00-\u1b7f\u2e80-\u2fdf\u3001-\u312f\u31a0-\u9fff"
    "\ua000-\ua4cf\ua980-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff]")


def cut_units(text: str, unit: str = "sentence") -> list[tuple[int, int]]:
    """(start, end) of the units of a text; a unit's end runs up to the next unit, so that units cover the text."""
    starts = [0, *(m.end() for m in UNITS[unit].finditer(text))]
    ends = [*starts[1:], len(text)]
    return [(a, b) for a, b in zip(starts, ends) if a < b]


def count_words(text: str) -> int:
    """Blank-separated words; in scripts without blanks every character counts."""
    if text.isascii():
        return len(text.split())
    return len(UNBLANKED.findall(text)) + len(UNBLANKED.sub(" ", text).split())


def unit_windows(text: str, unit: str = "sentence", min_words: int = MIN_WORDS,
                 window: int | None = None) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
    """Units and (digest, first unit, last unit) of what is compared: each unit of ``min_words``, and for each shorter
    one the least windows of that many words that start and that end with it, of at most ``window`` units.

    Without a bound blank units do not count, and a text of fewer words is one window: every passage of ``min_words``
    has each of its units in a window inside it, and each non-blank unit of a text is in one at least."""
    spans = cut_units(text, unit)
    normal = [" ".join(text[a:b].lower().split()) for a, b in spans]
    sizes = [count_words(n) for n in normal]
    found = {(i, i) for i, n in enumerate(sizes) if n >= min_words}
    row = [i for i, n in enumerate(sizes) if n or window]
    for p, i in enumerate(row):
        if not 0 < sizes[i] < min_words:
            continue
        for step in (1, -1):
            q, total = p, sizes[i]
            while total < min_words and 0 <= q + step < len(row) and (window is None or abs(q + step - p) < window):
                q += step
                total += sizes[row[q]]
            if total >= min_words:
                found.add((min(i, row[q]), max(i, row[q])))
    if window is None and row and not found:
        found.add((row[0], row[-1]))
    digest = xxhash.xxh3_64_intdigest
    return spans, [(digest("\n".join([n for n in normal[i:j + 1] if n])) - (1 << 63), i, j) for i, j in sorted(found)]


def _occurrences(docs: DataFrame, unit: str, min_words: int, window: int | None) -> DataFrame:
    """(digest, doc_id, start, end) of every window of units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, ids, starts, ends = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                spans, found = unit_windows(text.as_py() or "", unit, min_words, window)
                for d, i, j in found:
                    digests.append(d)
                    ids.append(doc_id)
                    starts.append(spans[i][0])
                    ends.append(spans[j][1])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (digests, ids, starts, ends)], ["digest", "doc_id", "start", "end"])

    return map_batches(docs, run, "digest long, doc_id long, start long, end long")


def repeated_units(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   unit: str = "sentence", min_words: int = MIN_WORDS, window: int | None = None) -> DataFrame:
    """(doc_id, spans): ``start, end`` in characters of the windows of units that repeat an earlier one."""
    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col)).where(F.col(text_col) != "")
    units = save(_occurrences(texts, unit, min_words, window), "units")
    rank = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "start")
    first = units.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    first = save(first, "units-first")  # joined as a table, so that a common unit's rows are split or never dealt by it
    later = units.join(first, "digest").where(rank > F.col("first"))
    return later.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))


def dedup_units(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                unit: str = "sentence", min_words: int = MIN_WORDS, window: int | None = None) -> DataFrame:
    """All columns of ``docs``, the text without repeated units, and ``_n_units``, ``_n_removed`` (units),
    ``_removed_chars`` and ``_removed_spans`` (``start-end`` in characters of the original, adjacent units joined).

    Occurrences rank by doc_id (a null one first), then by place; rows that repeat a doc_id are one
    document, with the same units removed where their texts are equal. A null text stays null,
    an empty one empty, both without units. Columns of these names are replaced.

    ``window`` bounds the units that are compared together where they are short: None compares all (see
    ``unit_windows``); two leave those that have fewer than ``min_words`` words with either neighbour."""
    removal = repeated_units(docs, id_col=id_col, text_col=text_col, unit=unit, min_words=min_words, window=window).select(
        F.col("doc_id").alias("_removal_id"), F.col("spans").alias("_spans"))
    added = ["_n_units", "_n_removed", "_removed_chars", "_removed_spans"]
    docs = docs.drop(*added, "_removal_id", "_spans")
    joined = docs.join(removal, F.col(id_col).cast("long").eqNullSafe(F.col("_removal_id")), "left").drop("_removal_id")
    schema = docs.schema
    place = [f.name for f in schema].index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, counts, removed, chars, spans = [], [], [], [], []
            for text, repeats in zip(batch.column(place), batch.column(batch.num_columns - 1)):
                text, repeats = text.as_py(), repeats.as_py()
                units = cut_units(text or "", unit)
                gone = set()
                if repeats:
                    first, last = {a: i for i, (a, _) in enumerate(units)}, {b: i for i, (_, b) in enumerate(units)}
                    for r in repeats:
                        if r["start"] in first and r["end"] in last:
                            inside = units[first[r["start"]]: last[r["end"]] + 1]
                            gone.update(a for a, b in inside if text[a:b].strip())
                runs: list[list[int]] = []
                stay = []
                n = 0
                for a, b in units:
                    if a in gone:
                        n += 1
                        if runs and runs[-1][1] == a:
                            runs[-1][1] = b
                        else:
                            runs.append([a, b])
                    else:
                        stay.append((a, b))
                kept.append("".join([text[a:b] for a, b in stay]) if runs else text)
                counts.append(len(units))
                removed.append(n)
                chars.append(sum(b - a for a, b in runs))
                spans.append(",".join(f"{a}-{b}" for a, b in runs))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns[place] = pa.array(kept, pa.string())
            columns += [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(chars, pa.int64()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], *added])

    out = T.StructType([*schema.fields, T.StructField(added[0], T.LongType()), T.StructField(added[1], T.LongType()),
                        T.StructField(added[2], T.LongType()), T.StructField(added[3], T.StringType())])
    return map_batches(joined, run, out)
