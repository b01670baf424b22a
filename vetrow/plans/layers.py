"""The layer runs, in order: bronze (files -> raw table), silver (judge, split,
reconcile, rules, quarantine, gate, upsert), gold (marts).

Every run reads and writes tables by path; the caller owns the session. The
silver run types and checks the slice once into a table in the shared
checkpoint folder, and writes its accepted and rejected rows once, counting them
as it does; every later step (rules, quarantine, upsert) reads those tables, so
nothing is parsed twice and a lost executor costs a re-read, not a recomputation.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vetrow.operators import marts, quality, tables, versions
from vetrow.operators.contract import apply_contract
from vetrow.operators.duplicates import PLACE, flag_duplicates, part_published
from vetrow.operators.quarantine import Reconciliation, Split, check_balance, split
from vetrow.functions import fs
from vetrow.session import materialize, materialize_observed, scratch_path
from vetrow.sources import audit as au
from vetrow.sources import raw as rw
from vetrow.spec import FINGERPRINT, SURVEY, ContractSpec

BRONZE_PARTITIONS = ("_source_series", "_source_year")
QUARANTINE_PARTITIONS = ("_source_series", "_source_year")
SILVER_PARTITIONS = ("collection_year",)
GOLD_TABLES = ("price_by_state_product_week", "purchase_price_coverage", "margin_by_state_week")


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


# --- bronze --------------------------------------------------------------------------


def audit_raw(spark: SparkSession, raw_root: str) -> DataFrame:
    """Charset, header and verdict of every raw file."""
    return rw.audit_files(spark, raw_root)


def run_bronze(spark: SparkSession, raw_root: str, bronze_path: str, *, audited: DataFrame | None = None,
               raw_keys: DataFrame | Iterable[str] | None = None, run_id: str | None = None,
               ingested_at: datetime | None = None) -> DataFrame:
    """Load the raw files (all, or the given raw keys: a table with that column, or a few names) and replace
    their rows in bronze; other files' rows are untouched. Returns (``_source_file``, ``rows``) of every
    file asked for: refused ones with NULL rows.

    ``audited`` is the table ``audit_raw`` gives (made here if absent), one row for each file; a file that was asked
    for and is not in it is an error, as is a header that breaks the contract. Refused files stay out."""
    folder = scratch_path(spark, f"runs/bronze-{uuid.uuid4().hex}")
    try:
        files = rw.list_files(spark, raw_root)
        if raw_keys is not None:
            wanted = raw_keys if isinstance(raw_keys, DataFrame) else spark.createDataFrame([(k,) for k in raw_keys], "raw_key string")
            files = files.join(wanted.select("raw_key").distinct(), "raw_key", "left_semi")
        lines = None
        if audited is None:  # the text is read once, to be judged and then loaded
            lines = rw.stage_lines(spark, files, folder)
            audited = rw.audit_files(spark, raw_root, only=files, lines=lines, folder=folder)
        facts = audited.select("raw_key", "encoding", "header_line", "verdict").dropDuplicates(["raw_key"])
        known = materialize(rw.with_headers(materialize(files.join(facts, "raw_key", "left"), "audited", folder)), "files", folder)
        return _load_files(spark, known, lines, bronze_path, run_id or str(uuid.uuid4()), ingested_at or _now())
    finally:
        fs.remove(spark, folder)


def _load_files(spark: SparkSession, known: DataFrame, lines: DataFrame | None, bronze_path: str, run_id: str, ingested_at: datetime) -> DataFrame:
    lost = known.where("verdict is null").select("raw_key").orderBy("raw_key").limit(20).collect()
    if lost:
        raise rw.UnauditedFileError("no audit row for " + ", ".join(r["raw_key"] for r in lost))
    good = known.where(F.col("verdict") == au.OK)
    scope = {tuple(r) for r in good.select("series", "year").distinct().collect()}  # partitions, not files
    if not scope:
        raise FileNotFoundError("no raw file that can be loaded")
    keys = good.select(F.col("raw_key").alias("_source_file"))
    rows = rw.read_rows(spark, good, run_id=run_id, ingested_at=ingested_at, lines=lines)
    tables.replace_keys(spark, bronze_path, rows, keys, "_source_file", BRONZE_PARTITIONS, scope)
    written = rw.rows_per_file(tables.read_table(spark, bronze_path).join(keys, "_source_file", "left_semi"))
    asked = known.select(F.col("raw_key").alias("_source_file"), (F.col("verdict") == au.OK).alias("_good"))
    report = asked.join(written, "_source_file", "left").select(
        "_source_file", F.when(F.col("_good"), F.coalesce("rows", F.lit(0))).alias("rows"))
    return materialize(report, "bronze-report")


# --- silver --------------------------------------------------------------------------


class EmptySliceError(RuntimeError):
    """The slice to process holds no row; nothing was written."""


@dataclass
class SilverRun:
    reconciliation: Reconciliation
    report: list[str]
    metrics: dict[str, int]
    published: bool = False
    warnings: list[str] = field(default_factory=list)
    upsert: dict[str, int] = field(default_factory=dict)


def read_slice(spark: SparkSession, bronze_path: str, series: str | None = None,
               years: Iterable[int] | None = None) -> DataFrame:
    """The bronze rows of one window; filters on partition columns prune the scan."""
    bronze = tables.read_table(spark, bronze_path)
    if bronze is None:
        raise EmptySliceError(f"no bronze table at {bronze_path}")
    return bronze.filter(tables.slice_predicate(series, years))


def evaluate_once(source: DataFrame, spec: ContractSpec = SURVEY, folder: str | None = None, *, reused: bool = False,
                  scanned: Observation | None = None, placed_out: bool = False) -> DataFrame:
    """Typing and the 15 checks run once, into a parquet table in the shared
    checkpoint folder; the duplicate check and every consumer of the split
    then re-read only the columns they need from it, never the regex and date
    parsing again. ``reused``: the table numbers its rows, so that several readers find a row's flag by
    its place in it (see ``flag_duplicates``), which ``placed_out`` keeps.

    The source's rows are counted as they come (into ``scanned``, if given), which keeps what makes them out of the
    contract's generated code: fused, the two outgrow the 8,000 bytes of a method that the JVM compiles, and
    each row would be interpreted."""
    counted = source.observe(scanned or f"source-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))
    judged = apply_contract(counted, spec)
    if reused:
        judged = judged.withColumn(PLACE, F.monotonically_increasing_id())
    return flag_duplicates(materialize(judged, "contracted", folder), spec, folder=folder, placed_out=placed_out)


def prepare_silver(accepted: DataFrame, *, updated_at: datetime) -> DataFrame:
    """Accepted rows with their table partition and the time of the write."""
    return accepted.withColumns({"collection_year": F.year("collection_date"), "_updated_at": F.lit(updated_at).cast("timestamp")})


def run_silver(spark: SparkSession, bronze_path: str, silver_path: str, quarantine_path: str, *,
               series: str | None = None, years: Sequence[int] | None = None, spec: ContractSpec = SURVEY,
               rules: list[dict[str, Any]] | None = None, now: datetime | None = None, keep_published: bool = False) -> SilverRun:
    """slice -> evaluate -> split -> reconcile -> rules -> quarantine -> gate -> upsert.

    A key that another slice has published is overwritten by the later run, unless ``keep_published``: then the later
    row is quarantined, as a copy or a conflict, with the row id of the published one.

    The quarantine is written before the gate on purpose: when the gate stops
    the run, the rejected rows are the evidence. Nothing reaches silver then.
    The rolling four-week feed is excluded unless asked for by name."""
    stamp = now or _now()
    source = read_slice(spark, bronze_path, series, years)
    if series is None:
        source = source.filter(F.col("_source_series") != "qus")
    folder = scratch_path(spark, f"runs/silver-{uuid.uuid4().hex}")
    try:
        return _silver_steps(spark, source, silver_path, quarantine_path, series, years, spec, rules, stamp, folder, keep_published)
    finally:
        fs.remove(spark, folder)  # the run's intermediate tables


def _scope(series, years):
    """The slice's rows, of a table with lineage; the rolling feed is no part of a slice that does not name it."""
    scope = tables.slice_predicate(series, years)
    return scope if series is not None else scope & (F.col("_source_series") != "qus")


def split_counted(source: DataFrame, spec: ContractSpec, *, folder: str | None = None, rejected_at: datetime | None = None,
                  published: DataFrame | None = None, own_slice=None) -> tuple[Split, dict[str, int]]:
    """The accepted and the rejected rows of a slice as tables, and the layer metrics, counted while they were made: the
    source as the scan gave it, before any check; each side as it was written. Nothing is read again to be counted, and
    what a faulty split loses is missing from the sides only."""
    scanned = Observation(f"source-{uuid.uuid4().hex}")
    evaluated = evaluate_once(source, spec, folder, reused=True, scanned=scanned, placed_out=published is not None)
    twins = None
    if published is not None:
        evaluated, twins = part_published(evaluated, published, own_slice, spec, folder=folder)
    parts = split(evaluated, rejected_at=rejected_at)
    accepted, kept = materialize_observed(parts.accepted, "accepted", folder, priced=F.count("purchase_price"))
    refusals = parts.rejected
    if twins is not None:  # all of them rejected
        refusals = split(twins, rejected_at=rejected_at).rejected.unionByName(refusals, allowMissingColumns=True)
    rejected, refused = materialize_observed(refusals, "rejected", folder)
    metrics = {"source": int(scanned.get["rows"]), "accepted": kept["rows"], "rejected": refused["rows"], "with_purchase_price": kept["priced"]}
    return Split(accepted, rejected), metrics


def _silver_steps(spark, source, silver_path, quarantine_path, series, years, spec, rules, stamp, folder, keep_published) -> SilverRun:
    published = tables.read_table(spark, silver_path, merge_schema=False) if keep_published else None
    parts, metrics = split_counted(source, spec, folder=folder, rejected_at=stamp, published=published, own_slice=_scope(series, years))
    if not metrics["source"]:
        raise EmptySliceError(f"no bronze row for series {series or 'any'} and years {list(years) if years else 'any'}")
    recon = check_balance(metrics["source"], metrics["accepted"], metrics["rejected"])
    rule_list = quality.load_rules() if rules is None else list(rules)
    report_df = quality.run_rules({"accepted": parts.accepted}, quality.metrics_frame(spark, metrics), rule_list)

    _replace_quarantine(spark, quarantine_path, parts.rejected, _scope(series, years))

    report_df_rows = report_df.collect()  # one row per rule
    report = quality.gate_rows(report_df_rows)  # raises DataQualityError on a critical breach
    prepared = prepare_silver(parts.accepted, updated_at=stamp)
    business = [c for c in FINGERPRINT if c not in spec.natural_key]
    upsert = tables.upsert_table(spark, silver_path, prepared, spec.natural_key, SILVER_PARTITIONS,
                                 compare=business, assume_unique=_key_proven(report_df_rows, rule_list, spec))
    warnings = [line for line in report if line.startswith("[FAILED]")]
    return SilverRun(recon, report, metrics, published=True, warnings=warnings, upsert=upsert)


def _key_proven(rows, rule_list, spec: ContractSpec) -> bool:
    """True when a passed ``unique_key`` rule covered exactly the natural key."""
    key = set(spec.natural_key)
    return any(
        r["passed"] and rule_list[r["ordinal"]]["type"] == "unique_key"
        and set(rule_list[r["ordinal"]].get("columns", ())) == key
        for r in rows
    )


def _replace_quarantine(spark: SparkSession, path: str, rejected: DataFrame, scope) -> None:
    """Replace the processed slice's rejected rows; partitions of the slice
    left without any rejected row are removed (a slice that became clean),
    other slices are untouched."""
    tables.replace_where(spark, path, rejected, scope, QUARANTINE_PARTITIONS)


# --- gold ------------------------------------------------------------------------------


def build_gold(silver: DataFrame, *, exact_resellers: bool = True) -> dict[str, DataFrame]:
    """The three marts over the columns they need. ``exact_resellers=False``
    counts resellers with a mergeable sketch (``approx_count_distinct``)
    instead of an exact distinct, which saves the second exchange."""
    needed = silver.select(
        "state", "product", "unit", "collection_week", "collection_date", "sale_price", "purchase_price",
        "reseller_cnpj",
    )
    return {
        "price_by_state_product_week": marts.weekly_price(needed, exact_resellers=exact_resellers),
        "purchase_price_coverage": marts.coverage(needed),
        "margin_by_state_week": marts.margin(needed),
    }


def run_gold(spark: SparkSession, silver_path: str, gold_root: str, *, keep_versions: int | None = None,
             exact_resellers: bool = True) -> dict[str, str]:
    """Rebuild every mart as a new snapshot version; returns their paths.
    ``keep_versions`` prunes older versions once the new ones are complete."""
    silver = tables.read_table(spark, silver_path, merge_schema=False)
    marts_ = build_gold(silver, exact_resellers=exact_resellers)
    paths = {name: tables.publish_snapshot(df, f"{gold_root}/{name}") for name, df in marts_.items()}
    if keep_versions is not None:
        for name in paths:
            tables.prune_snapshots(spark, f"{gold_root}/{name}", keep_versions)
    return paths


# Years of silver that a mart's year is made of, counted from it: a week belongs to the year of its Monday.
REFRESHED = {
    "price_by_state_product_week": (marts.weekly_price, (0, 1)),
    "purchase_price_coverage": (marts.coverage, (0,)),
    "margin_by_state_week": (marts.margin, (0, 1)),
}
GOLD_PARTITIONS = ("collection_year",)


def _built_from(spark: SparkSession, root: str, built: versions.Version | None) -> int | None:
    """The silver version that a mart's newest version was built from, if that is known."""
    note = f"{root}/_sources/{built.number:06d}" if built else None
    return int(fs.read_text(spark, note)) if note and fs.exists(spark, note) else None


def refresh_gold(spark: SparkSession, silver_path: str, gold_root: str) -> dict[str, list[int]]:
    """Bring each mart up to the newest silver version: only the years that silver changed since the mart was built (by the
    folders of its versions, without reading them) are built anew, from the silver years that they are made of; the
    others are carried over. Returns the years built. A mart without a known origin is built whole.

    The marts are tables by year under ``gold_root``; a year's rows come from the same aggregate as in a full rebuild."""
    silver = versions.current(spark, silver_path)
    out = {}
    for name, (build, offsets) in REFRESHED.items():
        root = f"{gold_root}/{name}"
        built = versions.current(spark, root)
        origin = _built_from(spark, root, built)
        known = origin in versions.numbers(spark, silver_path)
        before = versions.current(spark, silver_path, origin) if known else versions.Version(0, ())
        changed = {int(p.rpartition("=")[2]) for p in versions.differing(before, silver)}
        years = sorted({y - o for y in changed for o in offsets})
        out[name] = years
        if not years:
            continue
        needed = sorted({y + o for y in years for o in offsets})
        rows = tables.read_table(spark, silver_path, merge_schema=False).where(F.col("collection_year").isin(needed)).drop("collection_year")
        mart = build(rows).where(F.col("collection_year").isin(years))
        replaced = {versions.partition_name(spark, GOLD_PARTITIONS, (y,)) for y in years}
        number = versions.publish(mart, root, built if known else None if built is None else versions.Version(built.number, ()), GOLD_PARTITIONS, replaced)
        fs.create_text(spark, f"{root}/_sources/{number:06d}", str(silver.number))
    return out
