"""Table operators over ``orders``: an existing table (orders up to 1998) and a
new batch (orders from 1998 on, now final and repriced) that overlaps it by one
year, so the upsert has updates, inserts and untouched rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrow.operators import tables, versions
from vetrow.session import scratch_path
from vetrow.sources.binding import survey_rows

ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
KEY = ("o_orderkey",)
PART = ("order_year",)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(*ORDER_COLS)
    return o.withColumn("order_year", F.year("o_orderdate"))


def target(spark, sf_dir):
    return orders(spark, sf_dir).filter(F.col("order_year") < 1999)


def source(spark, sf_dir):
    batch = orders(spark, sf_dir).filter(F.col("order_year") >= 1998)
    return batch.withColumn("o_orderstatus", F.lit("F")).withColumn("o_totalprice", F.col("o_totalprice") + 1)


def revised_1997(spark, sf_dir):
    return (
        orders(spark, sf_dir)
        .filter(F.col("order_year") == 1997)
        .withColumn("o_orderstatus", F.lit("R"))
        .withColumn("o_revision", F.lit(2))
    )


def q_upsert(spark, sf_dir):
    return tables.upsert_by_key(target(spark, sf_dir), source(spark, sf_dir), KEY)


def q_upsert_changes(spark, sf_dir):
    merged = tables.upsert_by_key(target(spark, sf_dir), source(spark, sf_dir), KEY)
    return tables.content_diff(merged, target(spark, sf_dir))


def q_idempotence_diff(spark, sf_dir):
    once = tables.upsert_by_key(target(spark, sf_dir), source(spark, sf_dir), KEY)
    twice = tables.upsert_by_key(once, source(spark, sf_dir), KEY)
    return tables.content_diff(twice, once)


def q_content_diff(spark, sf_dir):
    """Both sides of a difference, copies counted: the batch against itself with one day's orders doubled and another's gone."""
    batch = source(spark, sf_dir)
    day = F.dayofmonth("o_orderdate")
    other = batch.where(day != 2).unionByName(batch.where(day == 1))
    return tables.content_diff(other, batch)


def q_upsert_report(spark, sf_dir):
    return tables.upsert_report(target(spark, sf_dir), source(spark, sf_dir), KEY)


def q_replace_slice(spark, sf_dir):
    return tables.replace_slice(orders(spark, sf_dir), revised_1997(spark, sf_dir), F.col("order_year") == 1997)


def q_slice_read(spark, sf_dir):
    return survey_rows(spark, sf_dir).filter(tables.slice_predicate("dsan", [1997, 1998]))


def q_upsert_table(spark, sf_dir):
    """Create a partitioned table from the target, upsert the batch into it
    (only the partitions it touches are rewritten), read it back."""
    path = scratch_path(spark, f"tables/upsert-{uuid.uuid4().hex}")
    tables.upsert_table(spark, path, target(spark, sf_dir), KEY, PART)
    tables.upsert_table(spark, path, source(spark, sf_dir), KEY, PART)
    return tables.read_table(spark, path).select(*ORDER_COLS, "order_year")


def q_replace_table(spark, sf_dir):
    """Write all orders partitioned by year, replace the 1997 slice on disk."""
    path = scratch_path(spark, f"tables/replace-{uuid.uuid4().hex}")
    tables.write_partitions(orders(spark, sf_dir), path, PART)
    tables.replace_where(spark, path, revised_1997(spark, sf_dir), F.col("order_year") == 1997, PART)
    return tables.read_table(spark, path).select(*ORDER_COLS, "o_revision", "order_year")


def q_unpublished_change(spark, sf_dir):
    """All orders by year, then a replacement of 1997 whose writer dies when its files are all there: readers still have
    the table as it was."""
    path = scratch_path(spark, f"tables/unpublished-{uuid.uuid4().hex}")
    tables.write_partitions(orders(spark, sf_dir), path, PART)
    versions.stage(revised_1997(spark, sf_dir), path, PART)
    return tables.read_table(spark, path).select(*ORDER_COLS, "order_year")


def q_table_versions(spark, sf_dir):
    """Rows and prices by year of each version of a table that is created, upserted into and has a year replaced."""
    path = scratch_path(spark, f"tables/versions-{uuid.uuid4().hex}")
    tables.upsert_table(spark, path, target(spark, sf_dir), KEY, PART)
    tables.upsert_table(spark, path, source(spark, sf_dir), KEY, PART)
    tables.replace_where(spark, path, revised_1997(spark, sf_dir).where("o_orderkey % 2 = 0"), F.col("order_year") == 1997, PART)
    parts = [tables.read_table(spark, path, version=n).groupBy("order_year").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("final")).withColumn("version", F.lit(n))
        for n in versions.numbers(spark, path)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _rerun(spark, sf_dir) -> str:
    """A table that is created, upserted into, and upserted into once more with the same batch, one day's prices changed."""
    path = scratch_path(spark, f"tables/rerun-{uuid.uuid4().hex}")
    tables.upsert_table(spark, path, target(spark, sf_dir), KEY, PART)
    batch = source(spark, sf_dir)
    tables.upsert_table(spark, path, batch, KEY, PART)
    changed = (F.col("order_year") == 2000) & (F.dayofmonth("o_orderdate") == 3)
    tables.upsert_table(spark, path, batch.withColumn("o_totalprice", F.when(changed, F.lit(1.5)).otherwise(F.col("o_totalprice"))), KEY, PART)
    return path


def q_version_diff(spark, sf_dir):
    """Rows by which a rerun's version differs from the one before."""
    return tables.version_diff(spark, _rerun(spark, sf_dir), 2, 3, PART).select(*ORDER_COLS, "order_year", "_side")


def q_partition_fingerprints(spark, sf_dir):
    """For each year whether the rerun changed it, by fingerprints, with its rows."""
    path = _rerun(spark, sf_dir)
    before, after = (tables.read_table(spark, path, version=n) for n in (2, 3))
    changed = tables.changed_partitions(before, after, PART).withColumn("changed", F.lit(True))
    rows = tables.content_fingerprint(after, PART).select(*PART, F.col("_rows").alias("orders"))
    return rows.join(changed, "order_year", "left").select("order_year", "orders", F.coalesce("changed", F.lit(False)).alias("changed"))


TABLE_QUERIES = {
    "upsert": q_upsert,
    "upsert_changes": q_upsert_changes,
    "upsert_report": q_upsert_report,
    "idempotence_diff": q_idempotence_diff,
    "content_diff": q_content_diff,
    "replace_slice": q_replace_slice,
    "slice_read": q_slice_read,
    "upsert_table": q_upsert_table,
    "replace_table": q_replace_table,
    "unpublished_change": q_unpublished_change,
    "table_versions": q_table_versions,
    "version_diff": q_version_diff,
    "partition_fingerprints": q_partition_fingerprints,
}

_O = "o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, " \
     "CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders)"
_T = "t AS (SELECT * FROM o WHERE order_year < 1999)"
_S = ("s AS (SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, "
      "o_orderpriority, order_year FROM o WHERE order_year >= 1998)")
_U = ("u AS (SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey IS NOT DISTINCT FROM t.o_orderkey) "
      "UNION ALL SELECT * FROM s)")
_U2 = ("u2 AS (SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey IS NOT DISTINCT FROM u.o_orderkey) "
       "UNION ALL SELECT * FROM s)")
_R = ("r AS (SELECT *, CAST(NULL AS INTEGER) AS o_revision FROM o WHERE NOT coalesce(order_year = 1997, false) "
      "UNION ALL SELECT o_orderkey, o_custkey, 'R' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, "
      "order_year, 2 AS o_revision FROM o WHERE order_year = 1997)")


def _with(*ctes, body):
    return "WITH " + ", ".join(ctes) + " " + body


def _slice_sql():
    from vetrow.plans.oracle import RAW_CTE, with_ctes

    return with_ctes(RAW_CTE, body="SELECT * FROM raw WHERE _source_series = 'dsan' AND _source_year IN (1997, 1998)")


_N = ("n AS (SELECT * REPLACE (CASE WHEN order_year = 2000 AND day(o_orderdate) = 3 THEN 1.5 ELSE o_totalprice END AS o_totalprice) FROM u)")

TABLE_ORACLES = {
    "upsert": _with(_O, _T, _S, _U, body="SELECT * FROM u"),
    "upsert_changes": _with(
        _O, _T, _S, _U,
        body="(SELECT *, 'left_only' AS _side FROM (SELECT * FROM u EXCEPT ALL SELECT * FROM t)) "
        "UNION ALL (SELECT *, 'right_only' AS _side FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM u))",
    ),
    "upsert_report": _with(
        _O, _T, _S,
        body="SELECT count(*) FILTER (WHERE t.o_orderkey IS NULL) AS inserted, "
        "count(*) FILTER (WHERE t.o_orderkey IS NOT NULL) AS updated, "
        "count(*) FILTER (WHERE t.o_orderkey IS NOT NULL AND (s.o_custkey, s.o_orderstatus, s.o_totalprice, "
        "s.o_orderdate, s.o_orderpriority, s.order_year) IS DISTINCT FROM (t.o_custkey, t.o_orderstatus, "
        "t.o_totalprice, t.o_orderdate, t.o_orderpriority, t.order_year)) AS updated_with_changes, "
        "count(*) FILTER (WHERE t.o_orderkey IS NOT NULL AND (s.o_custkey, s.o_orderstatus, s.o_totalprice, "
        "s.o_orderdate, s.o_orderpriority, s.order_year) IS NOT DISTINCT FROM (t.o_custkey, t.o_orderstatus, "
        "t.o_totalprice, t.o_orderdate, t.o_orderpriority, t.order_year)) AS unchanged "
        "FROM s LEFT JOIN t ON s.o_orderkey IS NOT DISTINCT FROM t.o_orderkey",
    ),
    "idempotence_diff": _with(
        _O, _T, _S, _U, _U2,
        body="(SELECT *, 'left_only' AS _side FROM (SELECT * FROM u2 EXCEPT ALL SELECT * FROM u)) "
        "UNION ALL (SELECT *, 'right_only' AS _side FROM (SELECT * FROM u EXCEPT ALL SELECT * FROM u2))",
    ),
    "content_diff": _with(_O, _S, body="SELECT *, 'left_only' AS _side FROM s WHERE day(o_orderdate) = 1 "
                          "UNION ALL SELECT *, 'right_only' AS _side FROM s WHERE day(o_orderdate) = 2"),
    "replace_slice": _with(_O, _R, body="SELECT * FROM r"),
    "slice_read": _slice_sql(),
    "upsert_table": _with(_O, _T, _S, _U, body="SELECT * FROM u"),
    "replace_table": _with(_O, _R, body="SELECT * FROM r"),
    "version_diff": _with(
        _O, _T, _S, _U, _N,
        body="(SELECT *, 'left_only' AS _side FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM u)) "
        "UNION ALL (SELECT *, 'right_only' AS _side FROM (SELECT * FROM u EXCEPT ALL SELECT * FROM n))",
    ),
    "partition_fingerprints": _with(
        _O, _T, _S, _U, _N,
        body="SELECT order_year, count(*) AS orders, order_year IN (SELECT order_year FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM u)) "
        "AS changed FROM n GROUP BY order_year",
    ),
    "unpublished_change": _with(_O, body="SELECT * FROM o"),
    "table_versions": _with(
        _O, _T, _S, _U,
        "v AS (SELECT 1 AS version, order_year, o_orderstatus FROM t UNION ALL SELECT 2, order_year, o_orderstatus FROM u "
        "UNION ALL SELECT 3, order_year, o_orderstatus FROM u WHERE order_year <> 1997 "
        "UNION ALL SELECT 3, order_year, 'R' FROM o WHERE order_year = 1997 AND o_orderkey % 2 = 0)",
        body="SELECT version, order_year, count(*) AS orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS final "
        "FROM v GROUP BY version, order_year",
    ),
}
