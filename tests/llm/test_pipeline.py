import base64
import random
import string

import corpus_pipeline as pipeline
import pytest
from brute import edge_rows, jaccard_components
from pyspark.sql import functions as F

from vetrow.llm import langid, line_dedup
from vetrow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_and_result(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    assert 4 <= len(pipeline.STAGES) <= 5
    for name, stage in pipeline.STAGES[:-1]:
        before = docs
        docs = pipeline.save(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns and docs.dtypes == before.dtypes
        assert docs.count() <= kept
        kept = docs.count()
        if name == "ngram_jaccard":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            want = {d for (d, _), (_, c) in zip(rows, jaccard_components(rows, 5, 80)) if d == c}
            assert {r["doc_id"] for r in docs.collect()} == want
        if name == "substring_dedup":
            assert kept == before.count()
            assert docs.where(F.length("text") != F.col("n_chars")).count() == 0
    last = pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.select("doc_id").distinct().count() == kept
    assert pipeline.run(spark, SF).select("doc_id", "piece").distinct().count() == last.count()


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stay = docs
    for _, stage in pipeline.STAGES[:2]:
        stay = pipeline.save(stage(spark, stay, SF), "test-clean")
    clean = labels.where("toxic = 0").select("doc_id").distinct()
    assert stay.join(clean, "doc_id").count() >= 0.97 * docs.join(clean, "doc_id").count()


def test_stages_take_edge_tables(spark):
    for rows in (edge_rows(), []):
        docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long").repartition(2)
        for name, stage in pipeline.STAGES:
            docs = pipeline.save(stage(spark, docs, SF), f"test-edge-{name}")
            docs.count()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_language_stage_drops_letter_junk_and_keeps_clean_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = random.Random(3)
    letters = lambda n: " ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(n))
    junk = [letters(20) for _ in range(12)] + [base64.b64encode(rng.randbytes(300)).decode() for _ in range(6)] + ["Это текст на языке, которого нет"]
    planted = spark.createDataFrame([(10**9 + i, t, "en", "s", len(t)) for i, t in enumerate(junk)], docs.schema)
    kept = pipeline.keep_known_language(spark, docs.unionByName(planted), SF)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert not ids & set(range(10**9, 10**9 + len(junk)))
    lettered = {r["doc_id"] for r in docs.where(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()}
    assert len(ids & lettered) >= 0.99 * len(lettered)


def test_near_duplicate_stage_keeps_texts_under_one_id_and_drops_copies_without_id(spark):
    rows = [(1, "one text of a page with eight words"), (1, "quite another page that has its own words"), (2, "Quite another page that has its own words"),
            (None, "a page without an id that comes several times"), (None, "a page without an id that comes several times"),
            (None, "one text of a page with eight words"), (3, "same row twice with some words in it"), (3, "same row twice with some words in it"),
            (4, ""), (4, ""), (4, None), (None, " ")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = pipeline.keep_one_of_near_duplicates(spark, docs.repartition(3), SF)
    assert out.columns == docs.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[1] is None)
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=key) == sorted([rows[0], rows[1], rows[3], rows[6], rows[8], rows[10], rows[11]], key=key)


def test_near_duplicate_stage_links_through_a_row_without_an_id(spark):
    a = [f"w{i}" for i in range(100)]
    x = [*a[:97], "x1", *a[98:]]
    b = [*x[:3], "y1", *x[4:]]
    docs = spark.createDataFrame([(1, " ".join(a), "en"), (None, " ".join(x), "en"), (2, " ".join(b), "en")], "doc_id long, text string, lang string")
    assert [r["doc_id"] for r in pipeline.keep_one_of_near_duplicates(spark, docs, SF).collect()] == [1]


CLASHES = ("_score", "_lang_pred", "_known", "_text_hash", "_row_hash", "_class_id", "_removal_id", "_spans", "_n_units", "doc", "row", "none",
           "high", "label", "class_id", "n", "digest", "a.b", "_n_removed")


def test_stages_keep_columns_that_bear_names_of_their_own(spark):
    rows = edge_rows()
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or ""), *(f"{c} {i}" for c in CLASHES)) for i, (d, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)).repartition(2)
    for name, stage in pipeline.STAGES[:-1]:
        out = pipeline.save(stage(spark, docs, SF), f"test-clash-{name}")
        assert out.dtypes == docs.dtypes
        for r in out.collect():
            number = r["doc"].split()[1]
            assert all(r[c] == f"{c} {number}" for c in CLASHES) and r["doc_id"] == rows[int(number)][0]
        assert out.count() > 0


def without_repeats(rows):
    """{id: text} by the rules of growing windows, written out plainly for tables of unique ids and ASCII or Latin words."""
    windows, units = [], {}
    for d, text in sorted(rows):
        cut = units[d] = [text[a:b] for a, b in line_dedup.cut_units(text)]
        words = {i: tuple(u.lower().split()) for i, u in enumerate(cut) if u.strip()}
        row = list(words)
        total = lambda part: sum(len(words[i]) for i in part)
        parts = [row[p:q] for p in range(len(row)) for q in range(p + 1, min(p + 6, len(row)) + 1)]
        least = [w for w in parts if total(w) >= 6 and (len(w) == 1 or total(w[1:]) < 6 or total(w[:-1]) < 6)]
        windows += [(d, w, tuple(words[i] for i in w)) for w in (least or ([row] if row else []))]
    seen, gone = set(), set()
    for d, w, key in sorted(windows):
        if key in seen:
            gone.update((d, i) for i in w)
        seen.add(key)
    return {d: "".join(u for i, u in enumerate(cut) if (d, i) not in gone) for d, cut in units.items()}


def test_language_and_unit_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect() if r["text"]}
    sample = langid.training_sample(docs.where(pipeline.crc_remainder("doc_id", 3) != 1), id_col="doc_id", text_col="text", lang_col="lang")
    known = langid.known_trigrams([t for t, _ in sample], [y for _, y in sample])
    want = {d: t for d, t in rows.items() if any(map(str.isalpha, t)) and langid.known_share(t, known) >= pipeline.LEAST_KNOWN_SHARE}
    assert {r["doc_id"]: r["text"] for r in pipeline.keep_known_language(spark, docs, SF).collect()} == want
    got = {r["doc_id"]: r["text"] for r in pipeline.drop_repeated_units(spark, docs, SF).collect() if r["doc_id"] in rows}
    assert got == without_repeats(list(rows.items()))


def test_language_stage_passes_texts_to_python_once(spark):
    """A second pass in the same tasks takes another Python worker for each core, with its own copy of the batches."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = pipeline.keep_known_language(spark, docs, SF)
    assert kept.columns == docs.columns
    assert kept._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
