"""The corpus pipeline: five stages over ``documents``, each by one operator of ``vetrow.llm``.

A stage takes (spark, docs, sf_dir) and returns what it keeps, in the columns of
documents; the last one returns the packed pieces. ``run`` writes each stage's
result under ``spark.checkpoint.dir`` and reads it back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrow.llm import langid, line_dedup, ngram_join, packing, toxicity
from vetrow.llm.common import boxed, crc_remainder, documents, save

NEAR_WORDS, NEAR_PERCENT = 5, 80
LEAST_KNOWN_SHARE = 0.7
#: The columns that stages read; others pass through.
WORKED_ON = ("doc_id", "text")


def _wrapped(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` beside one struct of all other columns, whose names then clash with none that an operator
    adds."""
    others = [c for c in docs.columns if c not in WORKED_ON]
    return docs.select(*WORKED_ON, boxed(docs, others) if others else F.struct(F.lit(0).alias("none")).alias("doc"))


def _unwrapped(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, in their order."""
    return df.select(*(F.col(c) if c in WORKED_ON and c in df.columns else F.col("doc").getField(c).alias(c) for c in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the operator's cut; null and empty texts stay. The scorer learns
    from the labels of the documents that are still there, leaving out the fold held out for tests."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_remainder("doc_id", 4) != 2)
    scored = toxicity.score(_wrapped(docs), toxicity.train(docs, labels), keep_columns=True)
    return _unwrapped(scored.where(F.col("_score") < toxicity.PREDICT_AT).drop("_score"), docs)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier knows: those without a letter, or unlike every language, go. The
    classifier's scores have a floor that junk does not fall below; a text is unlike every language where less than
    ``LEAST_KNOWN_SHARE`` of its trigrams are shared by training texts of one."""
    sample = langid.training_sample(docs.where(crc_remainder("doc_id", 3) != 1), id_col="doc_id", text_col="text", lang_col="lang")
    texts, languages = [t for t, _ in sample], [y for _, y in sample]
    shared = langid.predict(_wrapped(docs), langid.fit(texts, languages), keep_columns=True, known=langid.known_trigrams(texts, languages))
    known = (F.col("_lang_pred") != langid.UNDETERMINED) & (F.col("_known") >= LEAST_KNOWN_SHARE)
    return _unwrapped(shared.where(known).drop("_lang_pred", "_score", "_known"), docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by word-shingle similarity: the one with the smallest id (none comes last),
    ties by text hash, then by place in the table. Rows that share an id are different documents where their texts differ
    and are no near duplicates. Rows without a word (a null text, too) stay, one of those that repeat an id and a text;
    those without an id all stay. Other columns are kept as they are, whatever their names; an empty table stays empty."""
    rows, classes = ngram_join.linked_rows(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)
    text = F.col("doc").getField("text")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64(text).alias("text_hash"), "row")
    first = rows.select("high", "low", order.alias("place")).join(classes.select("high", "low", "label"), ["high", "low"]).groupBy(
        "label").agg(F.min("place").getField("row").alias("row"))
    kept = rows.join(first.select("row"), "row", "left_semi").select("doc")
    wordless = rows.where("high is null").select("doc", "doc_id", text.alias("text"))
    kept = kept.unionByName(wordless.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).select("doc")).unionByName(
        wordless.where("doc_id is null").select("doc"))
    return _unwrapped(kept, docs)


def drop_repeated_units(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the units that repeat an earlier one: of a smaller id (a null one comes first), or of an
    earlier place in it. A null text stays null, an empty one empty; rows that repeat an id are one document; other
    columns are kept as they are, but for ``n_chars``, which follows the text."""
    done = line_dedup.dedup_units(_wrapped(docs), window=None).drop("_n_units", "_n_removed", "_removed_chars", "_removed_spans")
    done = _unwrapped(done, docs)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in the sequences. Null and empty texts are one closing token each; repeated
    rows are packed each; columns other than the id and the text are not read; an empty table gives no piece."""
    pieces = packing.tokenize_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(save(pieces, "pieces"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_known_language),
    ("ngram_jaccard", keep_one_of_near_duplicates),
    ("substring_dedup", drop_repeated_units),
    ("packing", pack),
]

#: Classifiers and tokenizers are no SQL; tests hold language, ngram_jaccard and substring_dedup against plain versions,
#: toxicity and packing as stages by counts and columns only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
