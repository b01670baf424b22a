"""Resampling documents towards a target by hashed n-gram importance.

Texts are cut into word n-grams by an overlapped regular expression over the
text with its separators collapsed to single spaces; the spans' CRC-32 picks the
bucket that is counted. A bucket's gain is the logarithm of its share in the
target over its share in the documents; a document's weight is its features' mean
gain, and the documents with the highest weight plus seeded Gumbel noise are drawn
(a draw without replacement in proportion to the exponential of the weight).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vetrow.llm.common import boxed, map_batches, numbered, save, unboxed

SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RESULTS = ("n_features", "weight", "score", "rank")
#: Spans that are counted at a time, however long a text is.
SPANS = 1 << 18


def ngram_pattern(n: int):
    """``n`` words with single spaces between, starting and ending at a word's bounds."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def feature_spans(collapsed: bytes, n: int) -> Iterator[bytes]:
    return (m.group() for m in ngram_pattern(n).finditer(collapsed, overlapped=True))


def bucket_counts(text: str | None, low: int, high: int, buckets: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """(features, words, buckets that occur, their counts) of a text."""
    collapsed = SEPARATORS.sub(b" ", (text or "").encode().lower()).strip(b" ")
    words = collapsed.count(b" ") + 1 if collapsed else 0
    parts = []
    for n in range(low, high + 1):
        spans = feature_spans(collapsed, n)
        while len(found := np.fromiter((crc32(s) % buckets for s in islice(spans, SPANS)), np.int64)):
            parts.append(np.unique(found, return_counts=True))
    if not parts:
        return 0, words, np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(parts) == 1:
        places, counts = parts[0]
    else:
        places, inverse = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
        counts = np.zeros(len(places), np.int64)
        np.add.at(counts, inverse, np.concatenate([c for _, c in parts]))
    return int(counts.sum()), words, places, counts


def _features(rows: DataFrame, low: int, high: int, buckets: int) -> DataFrame:
    """Rows (doc, id, text) as (doc, id, n_features, n_words, places, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bucket_counts(t.as_py(), low, high, buckets) for t in batch.column("text")]
            ends = np.cumsum([0, *(len(f[2]) for f in found)])
            flat = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (2, 3)]
            columns = [batch.column("doc"), batch.column("id"), pa.array([f[0] for f in found], pa.int64()),
                       pa.array([f[1] for f in found], pa.int64()),
                       *(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int64())) for v in flat)]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "id", "n_features", "n_words", "places", "counts"])

    longs = T.ArrayType(T.LongType())
    schema = T.StructType([rows.schema["doc"], rows.schema["id"], T.StructField("n_features", T.LongType()),
                           T.StructField("n_words", T.LongType()), T.StructField("places", longs), T.StructField("counts", longs)])
    return map_batches(rows, run, schema)


def _totals(features: DataFrame, buckets: int) -> np.ndarray:
    """The features in each bucket; one row a bucket reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            places, counts = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("places", "counts"))
            np.add.at(total, places, counts)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["place", "n"])

    parts = map_batches(features.select("places", "counts"), run, "place long, n long")
    totals = np.zeros(buckets, np.int64)
    for place, n in parts.groupBy("place").agg(F.sum("n")).collect():
        totals[place] = n
    return totals


def bucket_gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed share of each bucket in the target over that in the documents."""
    s_all, t_all, extra = float(documents.sum()), float(target.sum()), float(len(documents))
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + extra) / ((s + 1.0) * (t_all + extra))))
                     for s, t in zip(documents.tolist(), target.tolist())], np.int64)


def _weights(features: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc, id, n_features, n_words, weight)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = np.zeros(batch.num_rows, np.int64)
            lists, features = batch.column("places"), batch.column("n_features").to_numpy()
            places, counts = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("places", "counts"))
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            sums = np.concatenate([[0], np.cumsum(gains[places] * counts)])
            some = features > 0
            per_row = sums[ends] - sums[np.concatenate([[0], ends[:-1]])] if len(ends) else sums[:0]
            weights[some] = per_row[some] // features[some]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc", "id", "n_features", "n_words")), pa.array(weights, pa.int64())],
                ["doc", "id", "n_features", "n_words", "weight"])

    schema = T.StructType([*(features.schema[c] for c in ("doc", "id", "n_features", "n_words")), T.StructField("weight", T.LongType())])
    return map_batches(features, run, schema)


def gumbel_noise(seed: int, id_column: str = "id"):
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of the sha256 of seed and id (a null id: as an empty one)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _cutoff(scored: DataFrame, draws: int) -> int | None:
    """The highest score that at least ``draws`` documents reach. Scores are whole numbers within some 10^5 of each other
    (a logarithm of counts and of 32 bits, in thousandths), so that the histogram on the driver is that small."""
    if not draws:
        return None
    for score, n in scored.groupBy("score").count().orderBy(F.desc("score")).collect():
        draws -= n
        if draws <= 0:
            return score
    return None


def importance_resample(docs: DataFrame, target: DataFrame, *, low: int = 1, high: int = 1, buckets: int = 10_000,
                        percent: int = 10, least_words: int = 20, seed: int = 2024, id_col: str = "doc_id",
                        text_col: str = "text", target_text_col: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """The carried columns of ``docs`` (None: all) with ``n_features``, ``weight``, ``score`` and ``rank``: 1, 2, 3... for
    the drawn documents by score, ties to the smaller id (null ids last), null for the others.

    ``percent`` of the documents with ``least_words`` words are drawn, rounded down. Features are all runs of ``low`` to
    ``high`` words; A-Z are lower-cased, other letters are not changed. A null or empty text has no feature and the weight
    0. Rows that repeat an id have the same noise; those that tie in score and id are ranked in the order of the table's
    parts. An empty target gives every bucket the smoothed share; empty documents give an empty result. Carried columns
    that bear a result's name come back with ``_in`` appended. Texts are read once: the counts by bucket are written
    under the checkpoint folder."""
    rows = docs.select(boxed(docs, carry), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    aims = target.select(F.struct(F.lit(0).alias("none")).alias("doc"), F.lit(0).alias("id"), F.col(target_text_col).alias("text"))
    features = save(_features(rows, low, high, buckets), "importance-features")
    gains = bucket_gains(_totals(features, buckets), _totals(_features(aims, low, high, buckets), buckets))
    scored = _weights(features, gains).withColumn("score", F.col("weight") + gumbel_noise(seed))
    scored = save(scored.withColumn("row", F.monotonically_increasing_id()), "importance-scores")
    eligible = scored.where(F.col("n_words") >= least_words)
    draws = percent * eligible.count() // 100
    cutoff = _cutoff(eligible, draws)
    none = F.lit(None).cast("long").alias("rank")
    if cutoff is None:
        return unboxed(scored.withColumn("rank", none), RESULTS)
    reached = (F.col("n_words") >= least_words) & (F.col("score") >= cutoff)
    order = [F.desc("score"), F.col("id").asc_nulls_last(), F.asc("row")]
    drawn = numbered(scored.where(reached), order, "importance-drawn", "rank").withColumn(
        "rank", F.when(F.col("rank") <= draws, F.col("rank")))
    return unboxed(scored.where(~reached).withColumn("rank", none).unionByName(drawn), RESULTS)
