"""Named queries over the shared tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each one runs an operator of the library over the whole derived input; decimal
outputs are cast to double so schemas line up with the SQL oracle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrow.operators import marts, quality, tables, versions
from vetrow.operators.contract import REASONS_COL, apply_contract
from vetrow.operators.quarantine import Split, balance, reason_histogram, split
from vetrow.plans import layers
from vetrow.plans.layers import evaluate_once
from vetrow.session import materialize, scratch_path
from vetrow.sources.binding import survey_rows
from vetrow.spec import ACCEPTED_TYPED, BINDING, LINEAGE_COLUMNS, RAW_COLUMNS, ROW_ID

REJECTED_AT = datetime(2010, 1, 1)
_DECIMALS = ("sale_price", "purchase_price", "avg_price", "median_price", "min_price", "max_price",
             "avg_margin", "avg_margin_ratio")

def _doubles(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in _DECIMALS else F.col(c) for c in df.columns])


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey_rows(spark, sf_dir)


def evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate_once(raw(spark, sf_dir), BINDING)


def parts(spark: SparkSession, sf_dir: str) -> Split:
    return split(evaluated(spark, sf_dir), rejected_at=REJECTED_AT)


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts(spark, sf_dir).accepted


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accepted rows as bronze has them: the strings they were read from, which the evaluation kept beside the values,
    so that no row is looked up again by its id. They are read as they lie, with their flags by place."""
    judged = evaluate_once(raw(spark, sf_dir), BINDING, reused=True)
    good = split(judged, rejected_at=REJECTED_AT, originals=True).accepted
    return good.select(*RAW_COLUMNS, *LINEAGE_COLUMNS, ROW_ID)


# --- typing, contract, split -------------------------------------------------


def q_raw_survey(spark, sf_dir):
    return raw(spark, sf_dir)


def q_typed_survey(spark, sf_dir):
    typed = apply_contract(raw(spark, sf_dir), BINDING)
    return _doubles(typed.select(*ACCEPTED_TYPED, ROW_ID))


def q_contract_reasons(spark, sf_dir):
    checked = apply_contract(raw(spark, sf_dir), BINDING)
    return checked.select(
        ROW_ID,
        F.array_join(REASONS_COL, ",").alias("reasons"),
        F.size(REASONS_COL).alias("n_reasons"),
    )


def q_reason_histogram(spark, sf_dir):
    return reason_histogram(evaluated(spark, sf_dir))


def q_accepted_rows(spark, sf_dir):
    return _doubles(accepted(spark, sf_dir))


def q_rejected_rows(spark, sf_dir):
    rejected = parts(spark, sf_dir).rejected
    return rejected.select(*RAW_COLUMNS, *LINEAGE_COLUMNS, ROW_ID, F.array_join(REASONS_COL, ",").alias("reasons"))


def q_duplicate_flags(spark, sf_dir):
    """Valid rows that the duplicate check flags, with the flag."""
    flagged = evaluated(spark, sf_dir)
    flag = F.element_at(REASONS_COL, -1)
    return flagged.filter(
        (F.size(REASONS_COL) == 1) & flag.isin("duplicate_key_conflict", "exact_duplicate")
    ).select(ROW_ID, "reseller_cnpj", "product", "collection_date", flag.alias("flag"))


def q_reconciliation(spark, sf_dir):
    """The layers' counts from the run's own figures, with what is missing between them."""
    _, metrics = layers.split_counted(raw(spark, sf_dir), BINDING, rejected_at=REJECTED_AT)
    return balance(quality.metrics_frame(spark, metrics).drop("with_purchase_price"))


# --- quality rules -------------------------------------------------------------


def _report(spark, sf_dir, types: tuple[str, ...] | None) -> DataFrame:
    p, counted = layers.split_counted(raw(spark, sf_dir), BINDING, rejected_at=REJECTED_AT)
    metrics = quality.metrics_frame(spark, counted)
    rules = quality.load_rules()
    if types is not None:
        rules = [r for r in rules if r["type"] in types]
    return quality.run_rules({"accepted": p.accepted}, metrics, rules)


def _dq(*types: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _report(spark, sf_dir, types)


def q_dq_report(spark, sf_dir):
    return _report(spark, sf_dir, None)


def q_layer_metrics(spark, sf_dir):
    return quality.metrics_frame(spark, layers.split_counted(raw(spark, sf_dir), BINDING, rejected_at=REJECTED_AT)[1])


# --- gold ------------------------------------------------------------------------


def q_weekly_price(spark, sf_dir):
    return _doubles(marts.weekly_price(accepted(spark, sf_dir)))


def q_coverage(spark, sf_dir):
    return marts.coverage(accepted(spark, sf_dir))


def q_margin(spark, sf_dir):
    return _doubles(marts.margin(accepted(spark, sf_dir)))


def q_yearly_coverage(spark, sf_dir):
    return marts.yearly_coverage(marts.coverage(accepted(spark, sf_dir)))


def q_year_runs(spark, sf_dir):
    return marts.year_runs(marts.yearly_coverage(marts.coverage(accepted(spark, sf_dir))))


def q_first_zero_year(spark, sf_dir):
    return marts.first_zero_year(marts.yearly_coverage(marts.coverage(accepted(spark, sf_dir))))


def q_product_units(spark, sf_dir):
    return marts.product_units(accepted(spark, sf_dir))


# --- layer runs -------------------------------------------------------------------


def _clean_tables(spark, sf_dir) -> str:
    """The accepted rows as a bronze table of their own, run through silver and gold; the folder of the tables."""
    base = scratch_path(spark, f"tables/layers-{uuid.uuid4().hex}")
    tables.write_partitions(clean(spark, sf_dir), f"{base}/bronze", layers.BRONZE_PARTITIONS)
    layers.run_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/quarantine", spec=BINDING, now=REJECTED_AT)
    layers.run_gold(spark, f"{base}/silver", f"{base}/gold")
    return base


def q_silver_table(spark, sf_dir):
    """The silver table that a clean run publishes, with its stamps."""
    silver = tables.read_table(spark, f"{_clean_tables(spark, sf_dir)}/silver")
    return _doubles(silver.select(*ACCEPTED_TYPED, ROW_ID, "collection_year", "_updated_at"))


def q_gold_refresh(spark, sf_dir):
    """The weekly price mart after silver's year 1998 got new prices and only the years it touches were built anew."""
    base = scratch_path(spark, f"tables/refresh-{uuid.uuid4().hex}")
    rows = layers.prepare_silver(accepted(spark, sf_dir), updated_at=REJECTED_AT)
    tables.upsert_table(spark, f"{base}/silver", rows, BINDING.natural_key, layers.SILVER_PARTITIONS)
    layers.refresh_gold(spark, f"{base}/silver", f"{base}/gold")
    later = tables.read_table(spark, f"{base}/silver").where("collection_year = 1998").withColumn(
        "sale_price", (F.col("sale_price") + 1).cast(BINDING.price_type))
    tables.upsert_table(spark, f"{base}/silver", later, BINDING.natural_key, layers.SILVER_PARTITIONS)
    built = layers.refresh_gold(spark, f"{base}/silver", f"{base}/gold")["price_by_state_product_week"]
    mart = tables.read_table(spark, f"{base}/gold/price_by_state_product_week")
    return _doubles(mart.withColumn("built_anew", F.col("collection_year").isin(built)))


def q_stopped_run(spark, sf_dir):
    """What a run with breaches and then one without leave: whether the gate stopped it, and the rows of both tables."""
    base = _clean_tables(spark, sf_dir)
    tables.write_partitions(raw(spark, sf_dir), f"{base}/all", layers.BRONZE_PARTITIONS)
    runs = []
    for run, bronze in (("breach", f"{base}/all"), ("clean", f"{base}/bronze")):
        try:
            layers.run_silver(spark, bronze, f"{base}/{run}/silver", f"{base}/{run}/quarantine", spec=BINDING, now=REJECTED_AT)
            stopped = False
        except quality.DataQualityError:
            stopped = True
        sides = [tables.read_table(spark, f"{base}/{run}/{side}") for side in ("silver", "quarantine")]
        silver, quarantine = (0 if side is None else side.count() for side in sides)
        runs.append((run, stopped, silver, quarantine))
    return spark.createDataFrame(runs, "run string, stopped boolean, silver_rows long, quarantine_rows long")


def q_bronze_slice(spark, sf_dir):
    """Two years of one series, read from a bronze table on disk that holds two series of all years."""
    path = scratch_path(spark, f"tables/slice-{uuid.uuid4().hex}")
    rows = raw(spark, sf_dir)
    tables.write_partitions(rows.unionByName(rows.withColumn("_source_series", F.lit("glp"))), path, layers.BRONZE_PARTITIONS)
    return layers.read_slice(spark, path, "dsan", [1997, 1998]).select(*rows.columns)


def q_silver_between(spark, sf_dir):
    """Six weeks of a silver table, from the files whose dates meet them."""
    path = scratch_path(spark, f"tables/between-{uuid.uuid4().hex}")
    # kept once: the key check, the sample of dates and the write each read them, and only the write needs them by date
    rows = materialize(layers.prepare_silver(accepted(spark, sf_dir), updated_at=REJECTED_AT), "prepared")
    tables.assert_unique_key(rows, BINDING.natural_key)
    tables.upsert_table(spark, path, rows.repartitionByRange(48, "collection_date"), BINDING.natural_key, layers.SILVER_PARTITIONS,
                        assume_unique=True)
    versions.describe_files(spark, path, ["collection_date", "reseller_cnpj"])
    found = versions.read_between(spark, path, "collection_date", date(1996, 12, 10), date(1997, 1, 20))
    return _doubles(found.select(*ACCEPTED_TYPED, ROW_ID, "collection_year"))


def q_published_twins(spark, sf_dir):
    """What a later slice repeats or contradicts of an earlier one: clean rows up to 1997 are published, then those of 1997
    and 1998 come again as another series, every other one of them at another price, with published rows kept."""
    base = scratch_path(spark, f"tables/slices-{uuid.uuid4().hex}")
    rows = clean(spark, sf_dir)
    first = rows.where("_source_year <= 1997")
    repriced = F.regexp_extract("bairro", r"(\d+)$", 1).cast("int") % 2 == 0
    second = rows.where("_source_year in (1997, 1998)").withColumns({
        "_source_series": F.lit("dsas"), ROW_ID: F.concat(F.lit("again-"), ROW_ID),
        "valor_de_venda": F.when(repriced, F.lit("9,9999")).otherwise(F.col("valor_de_venda"))})
    tables.write_partitions(first.unionByName(second), f"{base}/bronze", layers.BRONZE_PARTITIONS)
    for series in ("dsan", "dsas"):
        layers.run_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/quarantine", series=series, spec=BINDING, rules=[],
                          now=REJECTED_AT, keep_published=True)
    rejected = tables.read_table(spark, f"{base}/quarantine").select(
        ROW_ID, F.array_join(REASONS_COL, ",").alias("reasons"), "_other_row", F.lit("quarantine").alias("side"))
    silver = tables.read_table(spark, f"{base}/silver").select(
        ROW_ID, F.lit("").alias("reasons"), F.lit(None).cast("string").alias("_other_row"), F.lit("silver").alias("side"))
    return rejected.unionByName(silver)


def q_gold_snapshot(spark, sf_dir):
    """The weekly price mart as the gold run publishes it, read back from its newest version."""
    gold = tables.latest_snapshot(spark, f"{_clean_tables(spark, sf_dir)}/gold/price_by_state_product_week")
    return _doubles(gold)


def q_gate_verdict(spark, sf_dir):
    """Whether each shipped rule lets the run pass, and whether the gate as a whole does."""
    report = _report(spark, sf_dir, None)
    breach = ~F.col("passed") & (F.col("severity") == quality.CRITICAL)
    return report.agg(F.count(F.lit(1)).alias("rules"), F.count_if(~F.col("passed")).alias("failed"),
                      F.count_if(breach).alias("breaches"), (F.count_if(breach) == 0).alias("published"))


def q_quarantine_rows(spark, sf_dir):
    """Rejected rows as the quarantine keeps them: the original strings, the reasons, and when."""
    rejected = parts(spark, sf_dir).rejected
    return rejected.select(ROW_ID, *RAW_COLUMNS, F.array_join(REASONS_COL, ",").alias("reasons"), "_rejected_at")


def q_originals_kept(spark, sf_dir):
    """Accepted rows next to the strings they were read from."""
    judged = evaluated(spark, sf_dir).where(F.size(REASONS_COL) == 0)
    return _doubles(judged.select(ROW_ID, "data_da_coleta", "collection_date", "valor_de_venda", "sale_price", "valor_de_compra", "purchase_price"))


SURVEY_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_survey": q_raw_survey,
    "typed_survey": q_typed_survey,
    "contract_reasons": q_contract_reasons,
    "reason_histogram": q_reason_histogram,
    "accepted_rows": q_accepted_rows,
    "rejected_rows": q_rejected_rows,
    "duplicate_flags": q_duplicate_flags,
    "reconciliation": q_reconciliation,
    "layer_metrics": q_layer_metrics,
    "dq_not_null": _dq("not_null"),
    "dq_domain": _dq("domain"),
    "dq_range": _dq("range"),
    "dq_unique_key": _dq("unique_key"),
    "dq_ratio": _dq("ratio"),
    "dq_reconciliation": _dq("reconciliation"),
    "dq_unit_per_product": _dq("custom"),
    "dq_report": q_dq_report,
    "weekly_price": q_weekly_price,
    "coverage": q_coverage,
    "margin": q_margin,
    "yearly_coverage": q_yearly_coverage,
    "year_runs": q_year_runs,
    "first_zero_year": q_first_zero_year,
    "product_units": q_product_units,
    "silver_table": q_silver_table,
    "published_twins": q_published_twins,
    "gold_refresh": q_gold_refresh,
    "stopped_run": q_stopped_run,
    "bronze_slice": q_bronze_slice,
    "silver_between": q_silver_between,
    "gold_snapshot": q_gold_snapshot,
    "gate_verdict": q_gate_verdict,
    "quarantine_rows": q_quarantine_rows,
    "originals_kept": q_originals_kept,
}
