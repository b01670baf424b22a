"""The scale form of the duplicate check against a plain window formulation
(the whole key in one window, fine for a fixture) on the binding rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vetrow.operators.contract import REASONS_COL, apply_contract
from vetrow.operators.duplicates import flag_duplicates
from vetrow.operators.quarantine import split
from vetrow.plans.layers import evaluate_once
from vetrow.sources.binding import survey_rows
from vetrow.spec import BINDING, FINGERPRINT, NATURAL_KEY, ROW_ID


def window_form(contracted):
    valid = F.size(REASONS_COL) == 0
    by_key = Window.partitionBy(*NATURAL_KEY, valid.alias("_v"))
    ranked = Window.partitionBy(*NATURAL_KEY, valid.alias("_v")).orderBy(ROW_ID)
    fp = F.to_json(F.struct(*FINGERPRINT))
    marked = contracted.select(
        "*",
        F.count(F.lit(1)).over(by_key).alias("_n"),
        F.size(F.collect_set(fp).over(by_key)).alias("_variants"),
        F.row_number().over(ranked).alias("_pos"),
    )
    flag = (
        F.when(valid & (F.col("_n") > 1) & (F.col("_variants") > 1), F.lit("duplicate_key_conflict"))
        .when(valid & (F.col("_n") > 1) & (F.col("_pos") > 1), F.lit("exact_duplicate"))
    )
    return marked.select(ROW_ID, flag.alias("flag"))


def test_scale_form_equals_window_form(spark):
    contracted = apply_contract(survey_rows(spark, SF_SMALL), BINDING)
    scale = flag_duplicates(contracted, BINDING).select(
        ROW_ID,
        F.when(F.array_contains(REASONS_COL, "duplicate_key_conflict"), F.lit("duplicate_key_conflict"))
        .when(F.array_contains(REASONS_COL, "exact_duplicate"), F.lit("exact_duplicate"))
        .alias("flag"),
    )
    brute = window_form(contracted)
    assert scale.exceptAll(brute).count() == 0
    assert brute.exceptAll(scale).count() == 0
    assert scale.filter(F.col("flag").isNotNull()).count() == 517  # 509 conflicts + 8 copies at sf0.001


def test_row_ids_that_repeat_are_refused(spark):
    from vetrow.operators.duplicates import RowIdError

    contracted = apply_contract(survey_rows(spark, SF_SMALL), BINDING).withColumn(ROW_ID, F.lit("same"))
    with pytest.raises(RowIdError):
        flag_duplicates(contracted, BINDING)


def test_hot_key_keeps_exactly_one(spark):
    """One key holds most of the rows (the skew case): still one copy kept."""
    from samples import VALID, LINEAGE
    from vetrow.spec import LINEAGE_COLUMNS, RAW_COLUMNS

    def replicated(n, prefix, overrides):
        values = {**VALID, **LINEAGE, **overrides}
        cols = [F.lit(values[c]).cast("int" if c == "_source_year" else "timestamp" if c == "_ingested_at" else "string").alias(c)
                for c in (*RAW_COLUMNS, *LINEAGE_COLUMNS)]
        return spark.range(n).select(*cols, F.format_string(prefix + "%06d", "id").alias(ROW_ID))

    hot = replicated(5000, "h", {})
    conflicting = replicated(3000, "c", {"data_da_coleta": "13/03/2025"}).withColumn(
        "valor_de_venda", F.format_string("%d,00", (F.substring(ROW_ID, 2, 6).cast("int") % 7) + 1)
    )
    rows = hot.unionByName(conflicting)
    from datetime import date
    from vetrow.spec import SURVEY

    spec = SURVEY.with_dates(SURVEY.series_start, date(2026, 1, 1))
    out = flag_duplicates(apply_contract(rows, spec), spec)
    counts = {r["r"]: r["n"] for r in out.groupBy(F.array_join(REASONS_COL, ",").alias("r")).agg(F.count("*").alias("n")).collect()}
    assert counts == {"": 1, "exact_duplicate": 4999, "duplicate_key_conflict": 3000}
    kept = out.filter(F.size(REASONS_COL) == 0).first()
    assert kept[ROW_ID] == "h000000"


def test_rows_with_a_key_of_their_own_do_not_travel(spark):
    """Only rows that share a key, and a few more, are contested; the others stay where they are, whatever the join would do."""
    from vetrow.operators.duplicates import contested, key_bitmap

    rows = spark.range(40_000).select(F.col("id"), F.when(F.col("id") < 3_000, F.col("id") % 1_000).otherwise(F.col("id")).alias("k"))
    keys = rows.groupBy("k").count().where("count > 1").select("k")
    bits = 1 << 16
    shared, alone = contested(rows, key_bitmap(keys, ["k"], bits), ["k"], bits)
    met, other = ({r["id"] for r in df.collect()} for df in (shared, alone))
    assert met.isdisjoint(other) and met | other == set(range(40_000))
    assert set(range(3_000)) <= met and len(met) < 5_000
    assert "hashpartitioning(id" not in alone._jdf.queryExecution().executedPlan().toString()


def test_flags_are_the_same_when_nothing_is_broadcast_by_size(spark, monkeypatch):
    from vetrow.operators import duplicates

    monkeypatch.setattr(duplicates, "MAX_BITS", 1 << 15)
    contracted = apply_contract(survey_rows(spark, SF_SMALL), BINDING)
    brute = window_form(contracted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        judged = flag_duplicates(contracted, BINDING).select(
            ROW_ID, F.when(F.size(REASONS_COL) == 1, F.element_at(REASONS_COL, 1)).alias("reason"))
        flag = F.when(F.col("reason").isin("duplicate_key_conflict", "exact_duplicate"), F.col("reason"))
        scale = judged.select(ROW_ID, flag.alias("flag"))
        assert scale.exceptAll(brute).count() == 0
        assert brute.exceptAll(scale).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_both_sides_of_a_split_read_flagged_rows_without_a_shuffle(spark):
    """Neither the accepted nor the rejected side moves the contested rows to the verdicts again."""
    contracted = apply_contract(survey_rows(spark, SF_SMALL), BINDING)
    brute = window_form(contracted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        judged = evaluate_once(survey_rows(spark, SF_SMALL), BINDING, reused=True)
        for side in split(judged):
            assert "hashpartitioning" not in side._jdf.queryExecution().executedPlan().toString()
        flag = F.element_at(REASONS_COL, -1)
        scale = judged.select(ROW_ID, F.when((F.size(REASONS_COL) == 1) & flag.isin("duplicate_key_conflict", "exact_duplicate"), flag).alias("flag"))
        assert judged.count() == contracted.count()
        both = scale.where(scale["flag"].isNotNull()), brute.where(brute["flag"].isNotNull())
        assert both[0].exceptAll(both[1]).count() == 0 and both[1].exceptAll(both[0]).count() == 0 and both[0].count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_silver_between_writes_rows_that_were_judged_once(spark, monkeypatch):
    """The key check, the sample of dates and the write read kept rows; each moved the contested ones to the verdicts anew."""
    from vetrow.operators import tables
    from vetrow.plans import catalog

    upsert, plans = tables.upsert_table, []

    def seen(session, path, source, *args, **named):
        plans.append(source._jdf.queryExecution().optimizedPlan().toString())
        return upsert(session, path, source, *args, **named)

    monkeypatch.setattr(tables, "upsert_table", seen)
    assert catalog.q_silver_between(spark, SF_SMALL).count() > 0
    assert len(plans) == 1 and "Join" not in plans[0] and "Union" not in plans[0]


def marked_rows(spark, n):
    """Rows of several pieces and files: one key held by most, conflicts, single keys, copies with and without row ids."""
    from samples import LINEAGE, VALID
    from vetrow.spec import LINEAGE_COLUMNS, RAW_COLUMNS

    base = spark.range(n, numPartitions=3)
    values = {**VALID, **LINEAGE}
    kinds = {c: F.lit(values[c]).cast("int" if c == "_source_year" else "timestamp" if c == "_ingested_at" else "string")
             for c in (*RAW_COLUMNS, *LINEAGE_COLUMNS)}
    own = F.lpad(F.col("id").cast("string"), 14, "0")
    kinds["cnpj_da_revenda"] = F.when(F.col("id") % 5 < 2, F.lit("77777777777777")).when(
        F.col("id") % 5 == 2, F.lpad((F.col("id") / 15).cast("long").cast("string"), 14, "1")).otherwise(own)
    kinds["valor_de_venda"] = F.when((F.col("id") % 5 == 2) & (F.col("id") % 2 == 0), F.lit("4,80")).otherwise(kinds["valor_de_venda"])
    kinds["produto"] = F.when(F.col("id") % 11 == 0, F.lit("XPTO")).otherwise(kinds["produto"])
    row_id = F.when(F.col("id") == 7, F.lit(None)).when(F.col("id") % 5 < 3, F.format_string("r%07d", n - F.col("id"))).otherwise(own)
    return base.select(*(c.alias(name) for name, c in kinds.items()), row_id.alias(ROW_ID))


@pytest.mark.parametrize("pieces", [1 << 14, 0])
def test_flags_by_place_equal_those_by_key(spark, monkeypatch, pieces):
    from datetime import date
    from vetrow.operators import duplicates
    from vetrow.spec import SURVEY

    monkeypatch.setattr(duplicates, "MAX_PIECES", pieces)
    spec = SURVEY.with_dates(SURVEY.series_start, date(2026, 1, 1))
    rows = marked_rows(spark, 60_000)
    by_place = evaluate_once(rows, spec, reused=True)
    by_key = flag_duplicates(apply_contract(rows, spec), spec)
    assert by_place.columns == by_key.columns
    columns = [ROW_ID, "reseller_cnpj", "sale_price", F.array_join(REASONS_COL, ",").alias("reasons")]
    found, plain = by_place.select(*columns), by_key.select(*columns)
    assert found.count() == 60_000 and found.exceptAll(plain).count() == 0 and plain.exceptAll(found).count() == 0
    brute = window_form(apply_contract(rows, spec)).where(F.col(ROW_ID).isNotNull())
    flag = F.when(F.col("reasons").isin("duplicate_key_conflict", "exact_duplicate"), F.col("reasons")).alias("flag")
    judged = found.where(F.col(ROW_ID).isNotNull()).select(ROW_ID, flag)
    assert judged.exceptAll(brute).count() == 0 and brute.exceptAll(judged).count() == 0
    assert {r["flag"] for r in judged.select("flag").distinct().collect()} == {None, "duplicate_key_conflict", "exact_duplicate"}


def test_rows_of_a_numbered_table_are_not_moved_or_written_once_more(spark, monkeypatch):
    """All that the check writes are keys, verdicts and marks; contested rows were moved to the verdicts and written whole."""
    from vetrow.operators import duplicates
    from vetrow.spec import RAW_COLUMNS

    written = []
    for name in ("materialize", "materialize_counted"):
        real = getattr(duplicates, name)
        monkeypatch.setattr(duplicates, name, lambda df, what, *a, real=real: written.append((what, df)) or real(df, what, *a))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        judged = evaluate_once(survey_rows(spark, SF_SMALL), BINDING, reused=True)
        assert len(written) >= 4
        for what, df in written:
            assert not set(RAW_COLUMNS) & set(df.columns), what
            assert "valor_de_venda" not in df._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0], what
        assert judged.where(F.array_contains(REASONS_COL, "duplicate_key_conflict")).count() == 509
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_row_ids_that_repeat_are_refused_in_a_numbered_table(spark):
    from vetrow.operators.duplicates import RowIdError

    with pytest.raises(RowIdError):
        evaluate_once(survey_rows(spark, SF_SMALL).withColumn(ROW_ID, F.lit("same")), BINDING, reused=True)


def test_a_row_id_may_come_again_under_another_key(spark):
    from vetrow.operators.duplicates import check_row_ids

    key = list(NATURAL_KEY)
    rows = spark.createDataFrame([("a", "p", None, "1"), ("a", "p", None, "1"), ("a", "p", "d", "1"), ("b", "p", "d", "1")], [*key, ROW_ID])
    check_row_ids(rows, BINDING)


def test_rows_that_no_published_row_meets_are_not_moved(spark, monkeypatch):
    """The accepted side of a slice held against published rows lies where it was read; with too many marks rows are
    joined by place instead, to the same result."""
    import datetime

    from vetrow.operators import duplicates
    from vetrow.plans import layers

    first = split(evaluate_once(survey_rows(spark, SF_SMALL).where("_source_year <= 1997"), BINDING)).accepted
    published = layers.materialize(layers.prepare_silver(first, updated_at=datetime.datetime(2010, 1, 1)), "published")
    repriced = F.regexp_extract("bairro", r"(\d+)$", 1).cast("int") % 2 == 0
    later = survey_rows(spark, SF_SMALL).where("_source_year in (1997, 1998)").withColumns({
        "_source_series": F.lit("dsas"), ROW_ID: F.concat(F.lit("again-"), ROW_ID),
        "valor_de_venda": F.when(repriced, F.lit("9,9999")).otherwise(F.col("valor_de_venda"))})
    plans, found, real = [], [], layers.materialize_observed

    def written(df, name, *a, **b):
        if name == "accepted":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name, *a, **b)

    monkeypatch.setattr(layers, "materialize_observed", written)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for pieces in (duplicates.MAX_PIECES, -1):
            monkeypatch.setattr(duplicates, "MAX_PIECES", pieces)
            parts, metrics = layers.split_counted(later, BINDING, published=published, own_slice=F.col("_source_series") == "dsas")
            found.append((metrics, sorted(r[0] for r in parts.accepted.select(ROW_ID).collect()),
                          sorted((r[0], r[1], r[2] or "") for r in parts.rejected.select(ROW_ID, REASONS_COL, "_other_row").collect())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found[0] == found[1]
    assert "hashpartitioning" not in plans[0]
    kept = {r[0].removeprefix("again-") for r in parts.accepted.select(ROW_ID).collect()}
    assert kept and not kept & {r[0] for r in published.select(ROW_ID).collect()}
    marked = [r for r in found[0][2] if r[2]]
    assert {tuple(r[1]) for r in marked} == {("exact_duplicate",), ("duplicate_key_conflict",)}
    assert all(r[0] == "again-" + r[2] for r in marked if r[1] == ["exact_duplicate"])
