"""Replace, upsert and compare tables stored as partitioned parquet.

Without a table format there is no MERGE or ``replaceWhere``; these are the
DataFrame forms, plus the writes that put them on disk:

* ``replace_slice`` - rows matching a predicate are swapped for new ones
  (bronze: one file's rows; quarantine: one processed slice).
* ``upsert_by_key`` - matched keys take the source row, unmatched source rows
  are inserted, target rows the source does not mention stay.
* ``content_diff`` - rows only on one side, the idempotence check.

On disk only the partitions a change touches are rewritten, into new folders, and
the change is published whole (``versions``): readers see the table before it or
after it, never part of it. ``read_table`` reads such a table; reading its folder
as plain parquet would also read what a change has replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from vetrow.functions import fs
from vetrow.operators import versions


class DuplicateSourceKeyError(RuntimeError):
    """An upsert source holds a key more than once; the result would depend on order."""


# --- predicates -----------------------------------------------------------------


def slice_predicate(series: str | None = None, years: Iterable[int] | None = None,
                    series_col: str = "_source_series", year_col: str = "_source_year") -> Column:
    """Series equal AND year in; no argument means the whole table."""
    cond = F.lit(True)
    if series:
        cond = cond & (F.col(series_col) == F.lit(series))
    years = list(years or [])
    if years:
        cond = cond & F.col(year_col).isin(*years)
    return cond


# --- DataFrame operators -----------------------------------------------------------


def replace_slice(current: DataFrame, new: DataFrame, predicate: Column) -> DataFrame:
    """Current rows outside the slice + the new rows. New columns are allowed
    (old rows get NULL there), so lineage can grow without a rewrite."""
    kept = current.filter(~F.coalesce(predicate, F.lit(False)))
    return kept.unionByName(new, allowMissingColumns=True)


def repeated_source_keys(source: DataFrame, key: Sequence[str]) -> DataFrame:
    return source.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 1)


def assert_unique_key(source: DataFrame, key: Sequence[str]) -> None:
    """Fail before writing if a key repeats (a MERGE would pick a row at random)."""
    clash = repeated_source_keys(source, key).limit(1).collect()
    if clash:
        shown = {k: clash[0][k] for k in key}
        raise DuplicateSourceKeyError(f"upsert source repeats key {shown}")


def upsert_by_key(target: DataFrame, source: DataFrame, key: Sequence[str], *, check_unique: bool = False) -> DataFrame:
    """target minus the keys the source brings (null-safe match) + source rows.

    The anti join is a shuffle join on the key (or a broadcast when Spark's
    size estimate of the source is under the threshold); AQE splits a skewed
    key's partition."""
    if check_unique:
        assert_unique_key(source, key)
    keys = source.select(*key)
    cond = None
    for k in key:
        term = target[k].eqNullSafe(keys[k])
        cond = term if cond is None else cond & term
    kept = target.join(keys, cond, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def upsert_report(target: DataFrame, source: DataFrame, key: Sequence[str],
                  columns: Sequence[str] | None = None) -> DataFrame:
    """What an upsert will do, in one row: keys inserted, keys updated, and of
    those how many carry different values (a later slice overriding an earlier
    one, possibly with a conflicting price) or the same ones. Keys are unique
    on both sides, so the join has no hot key."""
    cols = list(columns or [c for c in source.columns if c not in key and c in target.columns])
    new = source.select(*key, F.struct(*cols).alias("_new"))
    old = target.select(*[F.col(k).alias(f"_t_{k}") for k in key], F.struct(*cols).alias("_old"))
    cond = None
    for k in key:
        term = new[k].eqNullSafe(old[f"_t_{k}"])
        cond = term if cond is None else cond & term
    joined = new.join(old, cond, "left")
    hit = F.col("_old").isNotNull()
    same = F.col("_new").eqNullSafe(F.col("_old"))
    return joined.agg(
        F.count_if(~hit).alias("inserted"),
        F.count_if(hit).alias("updated"),
        F.count_if(hit & ~same).alias("updated_with_changes"),
        F.count_if(hit & same).alias("unchanged"),
    )


def content_diff(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (with multiplicity) present on one side only, tagged by side. Empty means that both hold the same
    content. One pass: both sides in one aggregate over all columns, where equal rows cancel out."""
    cols = list(columns or [c for c in left.columns if c in right.columns])
    tagged = left.select(*cols, F.lit(1).alias("_n")).unionAll(right.select(*cols, F.lit(-1).alias("_n")))
    surplus = tagged.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    side = F.when(F.col("_n") > 0, F.lit("left_only")).otherwise(F.lit("right_only"))
    copies = F.array_repeat(side, F.abs("_n").cast("int"))
    return surplus.select(*cols, F.explode(copies).alias("_side"))


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    """64 bits of a row; a NULL counts in its column."""
    parts = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(F.lit(seed), *parts)


def content_fingerprint(df: DataFrame, partition_by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One row for each partition: ``_rows`` and the sums ``_sum_1, _sum_2`` of two 64-bit hashes of its rows, which no order
    of the rows changes. Map tasks send one row for each partition; rows do not move."""
    cols = list(columns or df.columns)
    exact = [F.sum(_row_hash(cols, seed).cast("decimal(20,0)")).cast("decimal(38,0)").alias(f"_sum_{seed}") for seed in (1, 2)]
    return df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_rows"), *exact)


def changed_partitions(left: DataFrame, right: DataFrame, partition_by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """The partitions whose rows differ, copies counted, or that one side lacks. Differing rows go unseen where both sums
    of their hashes agree, a chance of about 2^-128 for a partition."""
    cols = list(columns or [c for c in left.columns if c in right.columns])
    one, two = (content_fingerprint(df.select(*dict.fromkeys([*partition_by, *cols])), partition_by, cols) for df in (left, right))
    facts = ("_rows", "_sum_1", "_sum_2")
    both = one.select(*partition_by, F.struct(*facts).alias("_left")).unionByName(
        two.select(*partition_by, F.struct(*facts).alias("_left")).withColumnRenamed("_left", "_right"), allowMissingColumns=True)
    return both.groupBy(*partition_by).agg(F.max("_left").alias("_left"), F.max("_right").alias("_right")).where(
        ~F.col("_left").eqNullSafe(F.col("_right"))).select(*partition_by)


def partitioned_diff(left: DataFrame, right: DataFrame, partition_by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """``content_diff`` of the partitions whose fingerprints differ; the others are proved equal without moving a row."""
    cols = list(columns or [c for c in left.columns if c in right.columns])
    changed = {tuple(r) for r in changed_partitions(left, right, partition_by, cols).collect()}  # partitions, not rows
    inside = _in_partitions(changed, partition_by)
    if inside is None:
        return content_diff(left.limit(0), right.limit(0), cols)
    return content_diff(left.where(inside), right.where(inside), cols)


def version_diff(spark: SparkSession, path: str, older: int, newer: int, partition_by: Sequence[str]) -> DataFrame:
    """Rows by which two versions of a published table differ (``left_only``: in the newer one). Partitions that both
    versions hold in the same folders are not read."""
    old, new = (versions.current(spark, path, n) for n in (older, newer))
    apart = [replace(v, folders=tuple(f for f in v.folders if f.rpartition("/")[0] in versions.differing(old, new))) for v in (new, old)]
    whole = read_table(spark, path, version=newer)
    left, right = (versions.read(spark, path, v, True) if v.folders else (whole if whole is not None else read_table(spark, path, version=older)).limit(0)
                   for v in apart)
    return partitioned_diff(left, right, partition_by)


# --- on disk -------------------------------------------------------------------------


def _partitions(df: DataFrame, partition_by: Sequence[str]) -> set[tuple]:
    """Distinct partition values (bounded by the number of partitions)."""
    return {tuple(r) for r in df.select(*partition_by).distinct().collect()}


def _in_partitions(values_set: set[tuple], partition_by: Sequence[str]) -> Column | None:
    """Predicate selecting the given partitions (prunes the scan to them)."""
    pred = None
    for values in values_set:
        term = None
        for c, v in zip(partition_by, values):
            t = F.col(c).isNull() if v is None else (F.col(c) == F.lit(v))
            term = t if term is None else term & t
        pred = term if pred is None else pred | term
    return pred


def _names(spark: SparkSession, partition_by: Sequence[str], values_set: Iterable[tuple]) -> set[str]:
    return {versions.partition_name(spark, partition_by, v) for v in values_set}


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Rewrite exactly the partitions present in ``df``."""
    versions.publish(df, path, versions.current(df.sparkSession, path, partition_by=partition_by), partition_by, None)


def read_table(spark: SparkSession, path: str, *, merge_schema: bool = True, version: int | None = None) -> DataFrame | None:
    """Read a table as its newest version (or the one asked for) has it, or a plain folder of parquet; None if there is
    none or it holds no file. ``merge_schema`` for tables whose partitions may carry added columns (bronze, quarantine:
    schema merged from the file footers in a distributed job). Silver has a fixed schema and skips that job."""
    found = versions.current(spark, path, version)
    if found is None:
        return None
    if found.number:
        return versions.read(spark, path, found, merge_schema) if found.folders else None
    try:
        return spark.read.option("mergeSchema", "true" if merge_schema else "false").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # folder left with no data file
            return None
        raise  # unreadable is not the same as absent: its rows would be written over


def replace_where(spark: SparkSession, path: str, new: DataFrame, predicate: Column,
                  partition_by: Sequence[str], *, scope: Iterable[tuple] | None = None) -> None:
    """Swap the rows matching ``predicate`` for ``new``. Partitions without such a row are not rewritten, those that hold
    nothing else are dropped, and ``new`` is evaluated once.

    ``scope`` names the partitions the predicate can match when the caller
    knows them (a file's series and year) and must cover every matching row;
    otherwise they are found with a scan, which partition pruning keeps cheap
    when the predicate is on partition columns."""
    base = versions.current(spark, path, partition_by=partition_by)
    current = read_table(spark, path)
    if current is None:
        versions.publish(new, path, base, partition_by, ())
        return
    hit = F.coalesce(predicate, F.lit(False))
    scoped = _partitions(current.filter(hit), partition_by) if scope is None else {tuple(v) for v in scope}
    stats = []
    if scoped:
        stats = (
            current.filter(_in_partitions(scoped, partition_by)).groupBy(*partition_by)
            .agg(F.count_if(hit).alias("_hits"), F.count_if(~hit).alias("_kept")).where("_hits > 0")
            .collect()  # one row per partition
        )
    mixed = {tuple(r[c] for c in partition_by) for r in stats if r["_kept"]}
    content = new
    if mixed:
        content = current.filter(_in_partitions(mixed, partition_by) & ~hit).unionByName(new, allowMissingColumns=True)
    gone = _names(spark, partition_by, [tuple(r[c] for c in partition_by) for r in stats])
    versions.publish(content, path, base, partition_by, gone)


def replace_keys(spark: SparkSession, path: str, new: DataFrame, keys: DataFrame, key: str,
                 partition_by: Sequence[str], scope: Iterable[tuple]) -> None:
    """Swap the rows whose ``key`` is in ``keys`` (a table of them, one row each) for ``new``. ``scope`` names the partitions
    that such rows can be in; others are not read. Partitions left with no row are dropped. ``new`` is evaluated once."""
    base = versions.current(spark, path, partition_by=partition_by)
    current = read_table(spark, path)
    scope = {tuple(v) for v in scope}
    if current is None or not scope:
        versions.publish(new, path, base, partition_by, ())
        return
    kept = current.where(_in_partitions(scope, partition_by)).join(keys.select(key).distinct(), key, "left_anti")
    content = kept.unionByName(new, allowMissingColumns=True)
    versions.publish(content, path, base, partition_by, _names(spark, partition_by, scope))


def merge_by_key(target: DataFrame, source: DataFrame, key: Sequence[str],
                 compare: Sequence[str] | None = None) -> tuple[DataFrame, list[Column], Column]:
    """Upsert without moving the source: the target (wide) is joined to the
    source's key and compared columns only (narrow), matched target rows are
    dropped, and the source rows are appended as they are read - one shuffle
    of the target, none of the full source rows.

    Returns the joined frame, the count expressions to ``observe`` on it
    (target rows replaced, replaced with different values) and the predicate
    of the target rows that survive, so the report costs no extra pass. Keys
    are unique on both sides, so the join has no hot key."""
    compare = list(compare or [c for c in source.columns if c not in key and c in target.columns])
    narrow = source.select(
        *[F.col(k).alias(f"_s_{k}") for k in key],
        F.struct(*compare).alias("_s_values"),
        F.lit(True).alias("_replaced"),
    )
    cond = None
    for k in key:
        term = target[k].eqNullSafe(narrow[f"_s_{k}"])
        cond = term if cond is None else cond & term
    joined = target.join(narrow, cond, "left")
    replaced = F.col("_replaced").isNotNull()
    same = F.col("_s_values").eqNullSafe(F.struct(*compare))
    counts = [
        F.count_if(replaced).alias("updated"),
        F.count_if(replaced & ~same).alias("updated_with_changes"),
    ]
    return joined, counts, ~replaced


def upsert_table(spark: SparkSession, path: str, source: DataFrame, key: Sequence[str],
                 partition_by: Sequence[str], *, compare: Sequence[str] | None = None,
                 assume_unique: bool = False) -> dict[str, int]:
    """First write creates the table; later writes rewrite only the partitions
    the source touches. The partition columns must be functions of the key
    (e.g. year of the collection date), so a key never moves partition.
    Returns what the write did (keys inserted, updated, updated with
    different values); ``inserted`` is -1 for the write that creates the table.
    ``assume_unique`` skips the source-key check when a data-quality rule has
    just proved it."""
    if not assume_unique:
        assert_unique_key(source, key)
    base = versions.current(spark, path, partition_by=partition_by)
    current = read_table(spark, path, merge_schema=False)
    if current is None:
        versions.publish(source, path, base, partition_by, ())
        return {"inserted": -1, "updated": 0, "updated_with_changes": 0, "unchanged": 0}
    touched = _partitions(source, partition_by)
    in_touched = _in_partitions(touched, partition_by)
    if in_touched is None:
        return {"inserted": 0, "updated": 0, "updated_with_changes": 0, "unchanged": 0}
    target = current.filter(in_touched)
    joined, counts, survives = merge_by_key(target, source, key, compare)
    replaced, arrived = Observation("upsert-replaced"), Observation("upsert-source")
    kept = joined.observe(replaced, *counts).filter(survives).select(*target.columns)
    incoming = source.observe(arrived, F.count(F.lit(1)).alias("rows")).select(*target.columns)
    versions.publish(kept.unionByName(incoming), path, base, partition_by, _names(spark, partition_by, touched))
    updated = int(replaced.get["updated"])
    changed = int(replaced.get["updated_with_changes"])
    return {"inserted": int(arrived.get["rows"]) - updated, "updated": updated,
            "updated_with_changes": changed, "unchanged": updated - changed}


def publish_snapshot(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write a complete new version ``root/v000N`` (full rebuild, new schema
    allowed) and return its path. Readers take the newest version holding
    ``_SUCCESS``, so they never see a half-written table."""
    spark = df.sparkSession
    versions = [int(d[1:]) for d in fs.list_dirs(spark, root) if d.startswith("v") and d[1:].isdigit()]
    target = f"{root}/v{(max(versions) + 1 if versions else 1):06d}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    return target


def latest_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    versions = sorted(
        (d for d in fs.list_dirs(spark, root) if d.startswith("v") and d[1:].isdigit()), reverse=True
    )
    for v in versions:
        if fs.exists(spark, f"{root}/{v}/_SUCCESS"):
            return spark.read.parquet(f"{root}/{v}")
    return None


def prune_snapshots(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all but the newest ``keep`` complete versions (at least one is
    always kept); unfinished newer versions are left alone. Returns what was removed."""
    keep = max(keep, 1)
    versions = sorted(d for d in fs.list_dirs(spark, root) if d.startswith("v") and d[1:].isdigit())
    complete = [v for v in versions if fs.exists(spark, f"{root}/{v}/_SUCCESS")]
    doomed = complete[:-keep]
    for v in doomed:
        fs.remove(spark, f"{root}/{v}")
    return doomed
