"""Phrase collocations by SON partitioning.

The corpus is cut into a fixed number of shards (each spread over as many tasks as
its size needs). Each shard is mined completely at a support lowered in proportion
to its words, level by level: a run of k words is counted only where both its runs
of k - 1 are frequent in the shard. A phrase that reaches the global support has to
reach the lowered one in some shard, so the union of what is frequent locally holds
every candidate; a last pass counts all of them globally and exactly.

Tasks exchange counts by 64-bit hash; what is frequent goes back to them as a
bitmap of fixed size, which may let a run through but never keep one out. Exact
counts are by the words themselves (their hashes are checked to be one to one).
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vetrow.llm.common import map_batches, save

#: A break between pieces, or a word.
TOKEN = re.compile(rb"[.,;:!?\x0A-\x0D]|[^\x20\x09.,;:!?\x0A-\x0D]+")
BREAKS = frozenset(b".,;:!?\n\x0b\x0c\r")
UNKNOWN_LANG = "und"
SHARDS = 3
#: Tokens that a task counts at a time (a longer piece by itself), and words whose ids it remembers.
BLOCK_TOKENS, WORDS_KNOWN = 1 << 19, 1 << 18
#: Characters of text that are cut before their tokens are passed on.
TEXT_CHARS = 1 << 21
#: The bitmap of what is frequent has 2^26 places: 8 MB, whatever the corpus.
BITMAP_BITS = 26
TOP = 2000

TOKENS_SCHEMA = "lang string, lang_id long, shard int, n_words long, tokens binary, word binary, id long"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def word_id(word: bytes, seed: int) -> int:
    """The word's hash, never 0 (0 stands for a break)."""
    return _signed(xxhash.xxh3_64_intdigest(word, seed)) or 1


class Words(dict):
    """Ids by word; ``new`` lists the words met since it was last cleared. A break is 0."""

    def __init__(self, seed: int, word_id=word_id):
        self.seed, self.word_id, self.new = seed, word_id, []

    def __missing__(self, word: bytes) -> int:
        i = 0 if len(word) == 1 and word[0] in BREAKS else self.word_id(word, self.seed)
        self[word] = i
        if i:
            self.new.append(word)
        return i


def tokens_of(text: bytes, words: Words) -> np.ndarray:
    """Word ids of a lower-cased text, with one 0 between pieces."""
    ids = np.fromiter(map(words.__getitem__, TOKEN.findall(text)), np.int64)
    return ids[(ids != 0) | np.concatenate([[False], ids[:-1] != 0])] if len(ids) else ids


def cut_tokens(tokens: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Tokens in parts of at least ``most``, cut between pieces only."""
    start = 0
    while len(tokens) - start > most:
        breaks = np.flatnonzero(tokens[start + most:] == 0)
        if not len(breaks):
            break
        end = start + most + int(breaks[0])
        yield tokens[start:end]
        start = end + 1
    yield tokens[start:]


def _tokenized(docs: DataFrame, text_col: str, lang_col: str, seed: int, word_id) -> DataFrame:
    """Rows of each text's tokens (lang, lang_id, shard, n_words, tokens) and rows of the words met (word, id)."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG)), F.col(text_col)).where(F.col(text_col) != "")
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]

    def batch_of(texts: list, words: Words) -> pa.RecordBatch:
        columns = [[*t, *([None] * len(words.new))] for t in zip(*texts)] or [[None] * len(words.new) for _ in range(5)]
        columns += [[None] * len(texts) + words.new, [None] * len(texts) + [words[w] for w in words.new]]
        words.new.clear()
        if len(words) > WORDS_KNOWN:
            words.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                          ["lang", "lang_id", "shard", "n_words", "tokens", "word", "id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, texts, size = Words(seed, word_id), [], 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang, text = lang.as_py(), text.as_py().encode().lower()  # of bytes: A-Z alone
                lang_id, shard = word_id(lang.encode(), seed), xxhash.xxh3_64_intdigest(text) % SHARDS
                for part in cut_tokens(tokens_of(text, words), BLOCK_TOKENS):
                    texts.append((lang, lang_id, shard, int(np.count_nonzero(part)), part.tobytes()))
                size += len(text)
                if size > TEXT_CHARS:
                    yield batch_of(texts, words)
                    texts, size = [], 0
        if texts:
            yield batch_of(texts, words)

    return map_batches(rows, run, TOKENS_SCHEMA)


def tokenize(docs: DataFrame, text_col: str, lang_col: str, word_id=word_id) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, words (id, word), languages (lang_id, lang)); ids are one to one, with another seed where two words meet."""
    for seed in itertools.count():
        tokens = save(_tokenized(docs, text_col, lang_col, seed, word_id), "phrase-tokens")
        words = tokens.where("word is not null").groupBy("id").agg(F.min("word").alias("word"), F.max("word").alias("other"))
        words = save(words, "phrase-words")
        texts = tokens.where("tokens is not null").select("lang", "lang_id", "shard", "n_words", "tokens")
        langs = save(texts.groupBy("lang_id").agg(F.min("lang").alias("lang"), F.max("lang").alias("other")), "phrase-langs")
        if not words.where("word <> other").limit(1).count() and not langs.where("lang <> other").limit(1).count():
            return texts.drop("lang"), words.select("id", F.decode("word", "UTF-8").alias("word")), langs.drop("other")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(tokens, language, shard) of every place, texts set apart by a 0, in blocks of whole texts."""
    held: list = []
    size = 0

    def block():
        lengths = [len(t) + 1 for t, _, _ in held]
        tokens = np.zeros(sum(lengths), np.int64)
        for (t, _, _), end in zip(held, np.cumsum(lengths)):
            tokens[end - len(t) - 1:end - 1] = t
        return tokens.view(np.uint64), np.repeat(np.array([g for _, g, _ in held], np.int64), lengths), np.repeat(np.array([s for _, _, s in held], np.int32), lengths)

    for batch in batches:
        for tokens, lang, shard in zip(batch.column("tokens"), batch.column("lang_id").to_pylist(), batch.column("shard").to_pylist()):
            tokens = np.frombuffer(tokens.as_buffer(), np.int64)
            if held and size + len(tokens) > most:
                yield block()
                held, size = [], 0
            held.append((tokens, lang, shard))
            size += len(tokens)
    if held:
        yield block()


def run_keys(tokens: np.ndarray, lang: np.ndarray, words: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For k = 1 to ``words``: (hash of language and the k words from each place on, whether they are in one piece)."""
    key = _mix(lang.view(np.uint64) ^ (tokens * np.uint64(0x9E3779B97F4A7C15)))
    inside = tokens != 0
    out = [(key, inside)]
    for k in range(1, words):
        n = len(tokens) - k
        if n <= 0:
            out.append((key[:0], inside[:0]))
            continue
        key = _mix(key[:n] * np.uint64(0x9E3779B97F4A7C15) + tokens[k:])
        inside = inside[:n] & (tokens[k:] != 0)
        out.append((key, inside))
    return out


def _places(keys: np.ndarray, shards: np.ndarray | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each key."""
    mixed = keys if shards is None else _mix(keys + shards.astype(np.uint64) + np.uint64(1))
    return (mixed >> np.uint64(64 - bits)).astype(np.int64), (mixed & np.uint64((1 << bits) - 1)).astype(np.int64)


def _has(bitmap: np.ndarray, keys: np.ndarray, shards: np.ndarray | None) -> np.ndarray:
    one, two = ((bitmap[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) for p in _places(keys, shards, len(bitmap).bit_length() + 5))
    return one & two == 1


def _bitmap(keys: DataFrame, by_shard: bool, size: int) -> np.ndarray:
    """The places of ``keys`` (key, shard), two of 2^``size`` each, as bits; no more than these reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (size - 6), np.uint64)
        for batch in batches:
            key = batch.column("key").to_numpy().view(np.uint64)
            for places in _places(key, batch.column("shard").to_numpy() if by_shard else None, size):
                np.bitwise_or.at(bits, places >> 6, np.uint64(1) << (places & 63).astype(np.uint64))
        some = np.flatnonzero(bits)
        for start in range(0, len(some), 1 << 16):
            part = some[start:start + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(bits[part].view(np.int64), pa.int64())], ["place", "bits"])

    merged = map_batches(keys, run, "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(1 << (size - 6), np.uint64)
    bitmap[merged.column("place").to_numpy()] = merged.column("bits").to_numpy().view(np.uint64)
    return bitmap


def _shard_counts(texts: DataFrame, k: int, frequent, block_tokens: int) -> DataFrame:
    """(key, lang_id, shard, n) of runs of ``k`` words whose runs of k - 1 are frequent in their shard, by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, lang, shard in _blocks(batches, block_tokens):
            keys = run_keys(tokens, lang, k)
            key, inside = keys[-1]
            if k > 1:
                shorter, whole = keys[-2]
                allowed = np.zeros(len(shorter), bool)
                at = np.flatnonzero(whole)
                allowed[at] = _has(frequent.value, shorter[at], shard[at])
                inside = inside & allowed[:len(key)] & allowed[1:len(key) + 1]
            at = np.flatnonzero(inside)
            _, first, counts = np.unique(_mix(key[at] + shard[at].astype(np.uint64)), return_index=True, return_counts=True)
            at = at[first]
            del keys, inside, first
            yield pa.RecordBatch.from_arrays([pa.array(key[at].view(np.int64)), pa.array(lang[at]), pa.array(shard[at]), pa.array(counts, pa.int64())],
                                             ["key", "lang_id", "shard", "n"])

    return map_batches(texts, run, "key long, lang_id long, shard int, n long")


def locally_frequent(texts: DataFrame, words: int, support: int, bitmap_bits: int = BITMAP_BITS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(key, shard) of every run of 1 to ``words`` words that its shard holds ``support`` times, lowered by the shard's
    share of its language's words."""
    context = texts.sparkSession.sparkContext
    sizes = texts.groupBy("lang_id", "shard").agg(F.sum("n_words").alias("n_shard"))
    whole = sizes.groupBy("lang_id").agg(F.sum("n_shard").alias("n_lang"))
    exact = "decimal(38,0)"
    lowered = F.ceil(F.lit(support).cast("decimal(10,0)") * F.col("n_shard").cast("decimal(19,0)") / F.col("n_lang").cast("decimal(19,0)"))
    sizes = save(sizes.join(whole, "lang_id").withColumn("least", lowered.cast(exact).cast("long")).select("lang_id", "shard", "least"), "phrase-supports")
    found, bitmap = [], None
    for k in range(1, words + 1):
        counts = _shard_counts(texts, k, bitmap, block_tokens).groupBy("key", "lang_id", "shard").agg(F.sum("n").alias("n"))
        frequent = save(counts.join(sizes, ["lang_id", "shard"]).where("n >= least").select("key", "shard"), f"phrase-local-{k}")
        found.append(frequent)
        if k < words:
            bitmap = context.broadcast(_bitmap(frequent, True, bitmap_bits))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def count_block(tokens: np.ndarray, lang: np.ndarray, words: int, wanted: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For k = 1 to ``words``: (k, a place where each wanted run of k words stands, its occurrences). Runs are told apart by
    their words: those of other words under the same hash as an earlier one are given one by one."""
    for k, (key, inside) in enumerate(run_keys(tokens, lang, words), 1):
        at = np.flatnonzero(inside)
        at = at[_has(wanted, key[at], None)]
        if not len(at):
            continue
        _, first, group, counts = np.unique(key[at], return_index=True, return_inverse=True, return_counts=True)
        model = at[first[group]]
        same = lang[at] == lang[model]
        for j in range(k):
            same &= tokens[at + j] == tokens[model + j]
        others = at[~same]
        counts = counts - np.bincount(group[~same], minlength=len(counts))
        yield k, np.concatenate([at[first], others]), np.concatenate([counts, np.ones(len(others), np.int64)])


def count_exactly(texts: DataFrame, candidates: DataFrame, words: int, support: int, bitmap_bits: int = BITMAP_BITS,
                  block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(lang_id, phrase (word ids), f) of all runs of 1 to ``words`` words that occur ``support`` times."""
    wanted = texts.sparkSession.sparkContext.broadcast(_bitmap(candidates, False, bitmap_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, lang, _ in _blocks(batches, block_tokens):
            for k, at, counts in count_block(tokens, lang, words, wanted.value):
                ids = [pa.array(tokens[at + j].view(np.int64) if j < k else np.zeros(len(at), np.int64)) for j in range(words)]
                yield pa.RecordBatch.from_arrays([pa.array(lang[at]), *ids, pa.array(counts, pa.int64())],
                                                 ["lang_id", *(f"w{j}" for j in range(words)), "n"])

    columns = [f"w{j}" for j in range(words)]
    counted = map_batches(texts, run, "lang_id long, " + ", ".join(f"{c} long" for c in columns) + ", n long")
    summed = counted.groupBy("lang_id", *columns).agg(F.sum("n").alias("f")).where(F.col("f") >= support)
    return summed.select("lang_id", F.array_remove(F.array(*columns), 0).alias("phrase"), "f")


def _exact(column) -> F.Column:
    return F.col(column).cast("decimal(19,0)")


def _scores(counted: DataFrame, words: int, scale: int) -> DataFrame:
    """(lang_id, phrase, a, l, r, score) of phrases of two words or more by their lowest-scoring cut."""
    parts = counted.select(F.col("lang_id"), F.col("phrase").alias("part"), F.col("f").alias("f_part"))
    phrases = counted.where(F.size("phrase") > 1).select("lang_id", "phrase", F.col("f").alias("a"))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)))
    sides = cuts.select("*", F.explode(F.array(
        F.struct(F.lit(True).alias("head"), F.expr("slice(phrase, 1, k)").alias("part")),
        F.struct(F.lit(False).alias("head"), F.expr("slice(phrase, k + 1, size(phrase) - k)").alias("part")))).alias("side")).select(
        "lang_id", "phrase", "a", "k", "side.head", "side.part")
    sized = sides.join(parts, ["lang_id", "part"]).groupBy("lang_id", "phrase", "a", "k").agg(
        F.max(F.when(F.col("head"), F.col("f_part"))).alias("l"), F.max(F.when(~F.col("head"), F.col("f_part"))).alias("r"))
    score = F.expr(f"cast({scale} as decimal(10,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return sized.groupBy("lang_id", "phrase", "a").agg(lowest).select("lang_id", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _largest_longer(counted: DataFrame, words: int) -> DataFrame:
    """(lang_id, phrase, f_longer): the highest count of a longer phrase that holds the phrase."""
    if words < 3:
        return counted.select("lang_id", "phrase", F.col("f").alias("f_longer")).limit(0)
    longer = counted.where(F.size("phrase") > 2)
    spans = F.flatten(F.array(*[
        F.expr(f"transform(sequence(1, greatest(size(phrase) - {w} + 1, 1)), i -> if(size(phrase) > {w}, slice(phrase, i, {w}), array()))")
        for w in range(2, words)]))
    held = longer.select("lang_id", "f", F.explode(F.array_distinct(spans)).alias("phrase")).where(F.size("phrase") > 0)
    return held.groupBy("lang_id", "phrase").agg(F.max("f").alias("f_longer"))


def mine_phrases(docs: DataFrame, *, words: int = 4, support: int = 30, scale: int = 2_000_000, held_percent: int = 80,
                 top: int | None = TOP, text_col: str = "text", lang_col: str = "lang", bitmap_bits: int = BITMAP_BITS,
                 block_tokens: int = BLOCK_TOKENS, word_id=word_id) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's phrases of 2 to ``words`` words with ``support``
    occurrences, best first (``top`` None: all, ranked all the same).

    A-Z are lower-cased; pieces end at ``.,;:!?`` and line ends, words at blanks and tabs; occurrences may overlap and stay
    in a piece. ``a``, ``l`` and ``r`` count the phrase and the two parts of its lowest-scoring cut, ties to the shorter
    first part, ``n`` all words of the language; ``score`` is ``scale * a / (l + r)``, rounded down. A phrase goes where a
    longer one that holds it has ``held_percent`` of its occurrences. Equal scores rank by ``a``, then by the phrase's
    bytes. A null language is ``und``, as is that name; null and empty texts have no words; repeated rows all count; ids
    and other columns are not read; an empty table gives an empty result. A very long text is counted piece by
    piece, as nothing crosses a piece's end.

    ``bitmap_bits`` and ``block_tokens`` bound memory, ``word_id`` hashes a word under a seed; none changes the result."""
    texts, names, langs = tokenize(docs, text_col, lang_col, word_id)
    limits = {"bitmap_bits": bitmap_bits, "block_tokens": block_tokens}
    counted = save(count_exactly(texts, locally_frequent(texts, words, support, **limits), words, support, **limits), "phrase-counts")
    scored, longer = _scores(counted, words, scale), _largest_longer(counted, words)
    kept = scored.join(longer, ["lang_id", "phrase"], "left").where(
        F.col("f_longer").isNull() | (F.lit(100).cast("decimal(5,0)") * _exact("f_longer") < F.lit(held_percent).cast("decimal(5,0)") * _exact("a")))
    order = [F.desc("score"), F.desc("a")]
    if top is not None:  # before words are looked up; ties at the bound stay
        kept = kept.withColumn("_near", F.rank().over(Window.partitionBy("lang_id").orderBy(*order))).where(F.col("_near") <= top).drop("_near")
    kept = save(kept.select("lang_id", "phrase", "a", "l", "r", "score"), "phrase-kept")
    spelled = kept.select("lang_id", "phrase", F.posexplode("phrase").alias("at", "id")).join(names, "id").groupBy("lang_id", "phrase").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]).alias("spelled"))
    totals = texts.groupBy("lang_id").agg(F.sum("n_words").alias("n")).join(langs, "lang_id")
    rows = kept.join(spelled, ["lang_id", "phrase"]).join(totals, "lang_id").withColumn("phrase", F.array_join("spelled", " "))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long"))
    return (ranked if top is None else ranked.where(F.col("rank") <= top)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
