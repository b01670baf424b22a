"""End to end over the binding rows: the invariants are the product."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vetrow.operators import tables, versions
from vetrow.operators.contract import evaluate
from vetrow.operators.quality import DataQualityError
from vetrow.operators.quarantine import split
from vetrow.plans import layers
from vetrow.sources.binding import survey_rows
from vetrow.spec import BINDING, LINEAGE_COLUMNS, RAW_COLUMNS, ROW_ID

NOW = datetime(2010, 1, 2)


@pytest.fixture(scope="module")
def bronze_paths(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("layers"))
    raw = survey_rows(spark, SF_SMALL)
    raw.write.partitionBy(*layers.BRONZE_PARTITIONS).parquet(f"{base}/bronze")
    clean = split(evaluate(raw, BINDING)).accepted.select("_source_row").join(raw, "_source_row")
    clean.select(*RAW_COLUMNS, *LINEAGE_COLUMNS, ROW_ID).write.partitionBy(*layers.BRONZE_PARTITIONS).parquet(f"{base}/clean")
    return base


def test_breach_stops_before_silver_but_keeps_quarantine(spark, bronze_paths):
    base = bronze_paths
    with pytest.raises(DataQualityError, match="rejection_rate"):
        layers.run_silver(spark, f"{base}/bronze", f"{base}/silver_a", f"{base}/quarantine_a", spec=BINDING, now=NOW)
    assert tables.read_table(spark, f"{base}/quarantine_a").count() == 659
    assert not tables.fs.exists(spark, f"{base}/silver_a")


def test_clean_run_publishes_and_reruns_to_same_content(spark, bronze_paths):
    base = bronze_paths
    first = layers.run_silver(spark, f"{base}/clean", f"{base}/silver", f"{base}/quarantine", spec=BINDING, now=NOW)
    assert first.reconciliation.balances and first.reconciliation.rejected == 0
    assert first.metrics["accepted"] == 5351
    silver = tables.read_table(spark, f"{base}/silver")
    snapshot = silver.drop("_updated_at").collect()
    second = layers.run_silver(spark, f"{base}/clean", f"{base}/silver", f"{base}/quarantine", spec=BINDING,
                               now=datetime(2010, 1, 3))
    assert second.upsert == {"inserted": 0, "updated": 5351, "updated_with_changes": 0, "unchanged": 5351}
    assert first.upsert["inserted"] == -1  # first write creates the table
    again = tables.read_table(spark, f"{base}/silver").drop("_updated_at")
    before = spark.createDataFrame(snapshot, again.schema)
    assert tables.content_diff(again, before).count() == 0
    keys = again.groupBy("reseller_cnpj", "product", "collection_date").count().filter("count > 1").count()
    assert keys == 0


def test_gold_snapshots(spark, bronze_paths):
    base = bronze_paths
    if not tables.fs.exists(spark, f"{base}/silver"):
        layers.run_silver(spark, f"{base}/clean", f"{base}/silver", f"{base}/quarantine", spec=BINDING, now=NOW)
    paths = layers.run_gold(spark, f"{base}/silver", f"{base}/gold")
    assert set(paths) == set(layers.GOLD_TABLES)
    weekly = tables.latest_snapshot(spark, f"{base}/gold/price_by_state_product_week")
    assert weekly.count() == 3110
    assert weekly.filter("is_low_sample").count() == 3109
    margin = tables.latest_snapshot(spark, f"{base}/gold/margin_by_state_week")
    assert margin.count() == 1284 and margin.filter("is_reliable").count() == 1193
    assert tables.latest_snapshot(spark, f"{base}/gold/purchase_price_coverage").count() == 140


def test_bronze_run_from_files(spark, tmp_path):
    from vetrow.plans.raw_catalog import write_survey_files

    root = write_survey_files(spark, SF_SMALL)
    audited = layers.audit_raw(spark, root)
    counts = layers.run_bronze(spark, root, str(tmp_path / "bronze"), audited=audited, run_id="t")
    assert counts.agg(F.sum("rows")).first()[0] == 6010
    # reloading the same files replaces their rows instead of appending
    layers.run_bronze(spark, root, str(tmp_path / "bronze"), audited=audited, run_id="t2")
    assert tables.read_table(spark, str(tmp_path / "bronze")).count() == 6010


def test_empty_slice_stops_before_anything_is_written(spark, bronze_paths):
    base = bronze_paths
    q = f"{base}/quarantine_e"
    with pytest.raises(DataQualityError):
        layers.run_silver(spark, f"{base}/bronze", f"{base}/silver_e", q, spec=BINDING, now=NOW)
    before = tables.read_table(spark, q).count()
    with pytest.raises(layers.EmptySliceError):
        layers.run_silver(spark, f"{base}/bronze", f"{base}/silver_e", q, series="dsas", years=[1950], spec=BINDING, now=NOW)
    assert tables.read_table(spark, q).count() == before and not tables.fs.exists(spark, f"{base}/silver_e")


def test_rerun_after_gate_failure_cleans_the_slice(spark, bronze_paths):
    base = bronze_paths
    q, s = f"{base}/quarantine_r", f"{base}/silver_r"
    with pytest.raises(DataQualityError):
        layers.run_silver(spark, f"{base}/bronze", s, q, spec=BINDING, now=NOW)
    assert tables.read_table(spark, q).count() == 659 and not tables.fs.exists(spark, s)
    run = layers.run_silver(spark, f"{base}/clean", s, q, spec=BINDING, now=NOW)
    assert run.published and run.reconciliation.rejected == 0
    left = tables.read_table(spark, q)
    assert left is None or left.count() == 0  # the slice became clean: its quarantine is empty
    assert tables.read_table(spark, s).count() == 5351


def test_a_split_that_loses_rows_stops_the_run(spark, bronze_paths, monkeypatch):
    from vetrow.operators.quarantine import ReconciliationError, Split

    real = layers.split
    monkeypatch.setattr(layers, "split", lambda *a, **k: Split(real(*a, **k).accepted.where("product <> 'GNV'"), real(*a, **k).rejected))
    s, q = f"{bronze_paths}/silver_lost", f"{bronze_paths}/quarantine_lost"
    with pytest.raises(ReconciliationError, match="unaccounted"):
        layers.run_silver(spark, f"{bronze_paths}/bronze", s, q, spec=BINDING, now=NOW, rules=[])
    assert not tables.fs.exists(spark, s) and not tables.fs.exists(spark, q)


def test_metrics_are_counted_while_the_sides_are_written(spark, bronze_paths):
    from vetrow.operators import quality

    source = spark.read.parquet(f"{bronze_paths}/bronze")
    parts, metrics = layers.split_counted(source, BINDING, rejected_at=NOW)
    assert metrics == quality.layer_metrics(source, parts.accepted, parts.rejected).first().asDict()


def test_gold_refresh_builds_touched_years_only_and_equals_a_full_rebuild(spark, bronze_paths, tmp_path):
    silver, gold, whole = (str(tmp_path / n) for n in ("silver", "gold", "whole"))
    rows = layers.prepare_silver(split(evaluate(survey_rows(spark, SF_SMALL), BINDING)).accepted, updated_at=NOW)
    key = list(BINDING.natural_key)
    tables.upsert_table(spark, silver, rows.where("collection_date < '2000-01-01'"), key, layers.SILVER_PARTITIONS)
    first = layers.refresh_gold(spark, silver, gold)
    assert set(first) == set(layers.GOLD_TABLES) and first["purchase_price_coverage"] == [1995, 1996, 1997, 1998, 1999]
    before = {n: versions.current(spark, f"{gold}/{n}").folders for n in first}
    assert layers.refresh_gold(spark, silver, gold) == {n: [] for n in first}  # nothing new
    changed = rows.where("collection_date >= '1996-12-20' and collection_date < '1997-03-01' and collection_date >= '1997-01-01'")
    tables.upsert_table(spark, silver, changed.withColumn("sale_price", (F.col("sale_price") * 2).cast("decimal(9,4)")), key, layers.SILVER_PARTITIONS)
    built = layers.refresh_gold(spark, silver, gold)
    assert built == {"price_by_state_product_week": [1996, 1997], "purchase_price_coverage": [1997], "margin_by_state_week": [1996, 1997]}
    for name, years in built.items():
        after = versions.current(spark, f"{gold}/{name}").folders
        kept = {f for f in before[name] if int(f.split("/")[0].split("=")[1]) not in years}
        assert kept <= set(after) and not set(before[name]) - kept & set(after)
    layers.refresh_gold(spark, silver, whole)
    full = layers.build_gold(tables.read_table(spark, silver).drop("collection_year"))
    for name in built:
        mart = tables.read_table(spark, f"{gold}/{name}")
        assert tables.content_diff(mart, full[name].select(mart.columns)).count() == 0
        assert tables.content_diff(mart, tables.read_table(spark, f"{whole}/{name}")).count() == 0
    versions.vacuum(spark, silver, keep=1)  # the version it was built from is gone: built whole again
    tables.upsert_table(spark, silver, changed, key, layers.SILVER_PARTITIONS)
    versions.vacuum(spark, silver, keep=1)
    assert len(layers.refresh_gold(spark, silver, gold)["purchase_price_coverage"]) == 5
    mart = tables.read_table(spark, f"{gold}/price_by_state_product_week")
    full = layers.build_gold(tables.read_table(spark, silver).drop("collection_year"))["price_by_state_product_week"]
    assert tables.content_diff(mart, full.select(mart.columns)).count() == 0
