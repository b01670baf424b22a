"""Raw ingestion queries: survey rows derived from the tables are written as
published-style ``;``-CSV files into the shared scratch folder (three header /
charset variants), audited, and read back through the bronze path."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrow.functions import fs
from vetrow.operators import tables, versions
from vetrow.operators.quarantine import reason_histogram
from vetrow.plans import layers
from vetrow.session import materialize, scratch_path
from vetrow.sources import raw as rw
from vetrow.sources.binding import survey_rows
from vetrow.spec import BINDING, RAW_COLUMNS

# Header variants of the binding: the published one; the same with accents
# (written in Latin-1, as one published semester was); one extra column.
ACCENTED_HEADER = (
    "Região - Sigla", "Estado - Sigla", "Município", "Revenda", "CNPJ da Revenda", "Nome da Rua", "Número Rua",
    "Complemento", "Bairro", "Cep", "Produto", "Data da Coleta", "Valor de Venda", "Valor de Compra",
    "Unidade de Medida", "Bandeira",
)
EXTRA_COLUMN = "Observacao; livre"  # holds the separator, so the writer quotes the cell
INGESTED_AT = datetime(2010, 1, 1)
FOLDER = "todos os preços"  # a blank and an accent in every path
RESENT_FOLDER = "reenvio"
REFUSED_FOLDER = "páginas de erro"
BREACHED = (RAW_COLUMNS[4], RAW_COLUMNS[12])  # columns that the breaching files lack


def _write(rows: DataFrame, folder: str, header, charset: str, extra=(), columns=RAW_COLUMNS) -> None:
    """Published-style files, one folder a year. ``rows`` have a ``year``; rows without one go to an undated folder."""
    cols = [F.col(c).alias(h) for c, h in zip(columns, header)]
    cols += [F.lit(None).cast("string").alias(e) for e in extra]
    rows = rows.select(*cols, F.coalesce(F.col("year").cast("string"), F.lit("undated")).alias("year"))
    with versions.open_files(rows.sparkSession):
        (
            rows.write.mode("append")
            .partitionBy("year")
            .option("header", "true")
            .option("sep", rw.SEPARATOR)
            .option("encoding", charset)
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .csv(folder)
        )


def write_survey_files(spark: SparkSession, sf_dir: str, *, resent_year: int | None = None) -> str:
    """Write the derived rows, in three variants of header and charset; return the root. ``resent_year`` is written a
    second time, as another file of the same rows."""
    root = scratch_path(spark, f"raw-{uuid.uuid4().hex}")
    rows = survey_rows(spark, sf_dir).select(*RAW_COLUMNS, F.col("_source_year").alias("year"))
    accented, extra = F.col("year") == 1998, F.col("year") >= 1999
    folder = f"{root}/dsan/{FOLDER}"
    _write(rows.where(~F.coalesce(accented | extra, F.lit(False))), folder, rw.PUBLISHED_HEADER, "UTF-8")
    _write(rows.where(accented), folder, ACCENTED_HEADER, "ISO-8859-1")
    _write(rows.where(extra), folder, rw.PUBLISHED_HEADER, "UTF-8", (EXTRA_COLUMN,))
    if resent_year is not None:
        _write(rows.where(F.col("year") == resent_year), f"{root}/dsan/{RESENT_FOLDER}", rw.PUBLISHED_HEADER, "UTF-8")
    return root


LOADED = (*RAW_COLUMNS, "_source_series", "_source_year", "_source_encoding", "_header_signature")


def q_raw_scan(spark, sf_dir):
    root = write_survey_files(spark, sf_dir)
    lines = rw.stage_lines(spark, rw.list_files(spark, root))
    files = materialize(rw.with_headers(rw.audit_files(spark, root, lines=lines)), "raw-scan-files")
    return rw.read_rows(spark, files, run_id="raw-scan", ingested_at=INGESTED_AT, lines=lines).select(*LOADED)


def q_charset_scan(spark, sf_dir):
    return rw.audit_files(spark, write_survey_files(spark, sf_dir)).select("year", "encoding", "verdict").distinct()


def q_header_audit(spark, sf_dir):
    """Header verdict per year of files (each year's files share one header)."""
    files = rw.with_headers(rw.audit_files(spark, write_survey_files(spark, sf_dir)))
    return files.select("year", "encoding", "signature", "columns", "missing", "status").distinct()


def _bronze(spark) -> str:
    return scratch_path(spark, f"tables/bronze-{uuid.uuid4().hex}")


def q_bronze_load(spark, sf_dir):
    root, bronze = write_survey_files(spark, sf_dir), _bronze(spark)
    layers.run_bronze(spark, root, bronze, run_id="load", ingested_at=INGESTED_AT)
    return tables.read_table(spark, bronze).select(*LOADED)


def q_bronze_reload(spark, sf_dir):
    """All files, then those of one year again: every row is there once, that year's by the later run."""
    root, bronze = write_survey_files(spark, sf_dir), _bronze(spark)
    audited = materialize(layers.audit_raw(spark, root), "audited")
    layers.run_bronze(spark, root, bronze, audited=audited, run_id="load", ingested_at=INGESTED_AT)
    layers.run_bronze(spark, root, bronze, audited=audited, raw_keys=audited.where("year = 1996"), run_id="reload", ingested_at=INGESTED_AT)
    loaded = tables.read_table(spark, bronze)
    return loaded.groupBy("_source_year", "_ingestion_run_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("_source_row").alias("row_ids"))


def q_bronze_two_loads_duplicates(spark, sf_dir):
    """A year published a second time in a file of its own, loaded by a later run: its rows are copies, and one stays."""
    root, bronze = write_survey_files(spark, sf_dir, resent_year=1996), _bronze(spark)
    audited = materialize(layers.audit_raw(spark, root), "audited")
    resent = F.col("raw_key").startswith(f"dsan/{RESENT_FOLDER}/")
    for run, part in (("first", audited.where(~resent)), ("second", audited.where(resent))):
        layers.run_bronze(spark, root, bronze, audited=audited, raw_keys=part, run_id=run, ingested_at=INGESTED_AT)
    return reason_histogram(layers.evaluate_once(tables.read_table(spark, bronze), BINDING))


def write_error_pages(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Web pages under the names of survey files, by a made-up year: their first line holds the separator, and what tells
    a page stands on the second one."""
    page = F.concat(F.lit("status;"), "url", F.lit("\n  <HTML lang='pt'>\n"), "html")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(page.alias("value"), (2010 + F.col("page_id") % 3).alias("year"))
    pages.write.partitionBy("year").text(f"{root}/dsan/{REFUSED_FOLDER}")
    for year in fs.list_dirs(spark, f"{root}/dsan/{REFUSED_FOLDER}"):
        for name in fs.list_files(spark, f"{root}/dsan/{REFUSED_FOLDER}/{year}"):
            if name.endswith(".txt"):
                fs.move(spark, f"{root}/dsan/{REFUSED_FOLDER}/{year}/{name}", f"{root}/dsan/{REFUSED_FOLDER}/{year}/{name[:-4]}.csv")


def q_bronze_refused(spark, sf_dir):
    """Files and rows of a load by year, where error pages lie between the survey files: the pages stay out."""
    root, bronze = write_survey_files(spark, sf_dir), _bronze(spark)
    write_error_pages(spark, sf_dir, root)
    report = layers.run_bronze(spark, root, bronze, run_id="load", ingested_at=INGESTED_AT)
    year = F.regexp_extract("_source_file", r"year=(\w+)/", 1)
    return report.groupBy(year.alias("year"), F.col("rows").isNull().alias("refused")).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"))


def q_header_breach(spark, sf_dir):
    """What the contract says to each year's header where one year's files lack two columns, and whether a load with
    them is stopped with nothing written."""
    root, bronze = scratch_path(spark, f"raw-{uuid.uuid4().hex}"), _bronze(spark)
    rows = survey_rows(spark, sf_dir).select(*RAW_COLUMNS, F.col("_source_year").alias("year"))
    short = [(c, h) for c, h in zip(RAW_COLUMNS, rw.PUBLISHED_HEADER) if c not in BREACHED]
    whole = F.coalesce(F.col("year") != 1997, F.lit(True))
    _write(rows.where(whole), f"{root}/dsan/all", rw.PUBLISHED_HEADER, "UTF-8")
    _write(rows.where(~whole).drop(*BREACHED), f"{root}/dsan/short", [h for _, h in short], "UTF-8", columns=[c for c, _ in short])
    try:
        layers.run_bronze(spark, root, bronze, ingested_at=INGESTED_AT)
        stopped = False
    except rw.UnexpectedHeaderError:
        stopped = tables.read_table(spark, bronze) is None
    files = rw.with_headers(rw.audit_files(spark, root))
    return files.select("year", "columns", "missing", "status", F.lit(stopped).alias("load_stopped")).distinct()


def q_large_digests(spark, sf_dir):
    """Digests of page files, one a section, by one value where they are small and by their lines in order where not."""
    root = scratch_path(spark, f"raw-{uuid.uuid4().hex}")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        (F.col("page_id") % 7 * (F.col("page_id") % 5)).alias("section"), "page_id", F.coalesce("html", F.lit("")).alias("value"))
    pages.repartition("section").sortWithinPartitions("section", "page_id").drop("page_id").write.partitionBy("section").text(root)
    digests = rw.file_digests(spark, root, "*.txt", whole_below=1 << 15)
    return digests.select(F.regexp_extract("path", r"section=(\d+)/", 1).cast("long").alias("section"), "sha256")


RAW_QUERIES = {
    "raw_scan": q_raw_scan,
    "charset_scan": q_charset_scan,
    "header_audit": q_header_audit,
    "bronze_load": q_bronze_load,
    "bronze_reload": q_bronze_reload,
    "bronze_two_loads_duplicates": q_bronze_two_loads_duplicates,
    "bronze_refused": q_bronze_refused,
    "header_breach": q_header_breach,
    "large_digests": q_large_digests,
}


def _raw_oracles() -> dict[str, str]:
    from vetrow.plans.oracle import CONTRACT_CTE, RAW_CTE, with_ctes

    plain = rw.header_signature([rw.fold(h) for h in rw.PUBLISHED_HEADER])
    extra = rw.header_signature([rw.fold(h) for h in (*rw.PUBLISHED_HEADER, EXTRA_COLUMN)])
    cols = ", ".join(RAW_COLUMNS)
    loaded = with_ctes(
        RAW_CTE,
        body=f"SELECT {cols}, 'dsan' AS _source_series, _source_year, "
        f"CASE WHEN _source_year = 1998 THEN 'ISO-8859-1' ELSE 'UTF-8' END AS _source_encoding, "
        f"CASE WHEN _source_year >= 1999 THEN '{extra}' ELSE '{plain}' END AS _header_signature FROM raw",
    )
    # the resent year's rows once more, under row ids of their own
    once_more = RAW_CTE.rstrip()[: -len("FROM cp\n)")] + "FROM (SELECT * FROM cp UNION ALL SELECT * REPLACE (copy_no + 10 AS copy_no) FROM cp WHERE yr = 1996) cp\n)"
    return {
        "raw_scan": loaded,
        "bronze_load": loaded,
        "bronze_reload": with_ctes(
            RAW_CTE,
            body="SELECT _source_year, CASE WHEN _source_year = 1996 THEN 'reload' ELSE 'load' END AS _ingestion_run_id, "
            "count(*) AS rows, count(*) AS row_ids FROM raw GROUP BY 1, 2",
        ),
        "bronze_two_loads_duplicates": with_ctes(
            once_more, CONTRACT_CTE,
            body="SELECT reason, count(*) AS rows FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM rejected) GROUP BY reason",
        ),
        "bronze_refused": with_ctes(
            RAW_CTE,
            body="SELECT coalesce(CAST(_source_year AS VARCHAR), 'undated') AS year, false AS refused, count(*) AS rows FROM raw GROUP BY 1 "
            "UNION ALL SELECT DISTINCT CAST(2010 + page_id % 3 AS VARCHAR), true, 0 FROM pages",
        ),
        "large_digests": "SELECT page_id % 7 * (page_id % 5) AS section, sha256(string_agg(coalesce(html, '') || chr(10), '' ORDER BY page_id)) AS sha256 "
        "FROM pages GROUP BY 1",
        "header_breach": with_ctes(
            RAW_CTE,
            body="SELECT DISTINCT _source_year AS year, CAST(CASE WHEN _source_year = 1997 THEN 14 ELSE 16 END AS INTEGER) AS columns, "
            f"CASE WHEN _source_year = 1997 THEN '{','.join(BREACHED)}' ELSE '' END AS missing, "
            "CASE WHEN _source_year = 1997 THEN 'missing_columns' ELSE 'ok' END AS status, true AS load_stopped FROM raw",
        ),
        "header_audit": with_ctes(
            RAW_CTE,
            body="SELECT DISTINCT _source_year AS year, "
            "CASE WHEN _source_year = 1998 THEN 'ISO-8859-1' ELSE 'UTF-8' END AS encoding, "
            f"CASE WHEN _source_year >= 1999 THEN '{extra}' ELSE '{plain}' END AS signature, "
            "CAST(CASE WHEN _source_year >= 1999 THEN 17 ELSE 16 END AS INTEGER) AS columns, "
            "'' AS missing, 'ok' AS status FROM raw",
        ),
        "charset_scan": with_ctes(
            RAW_CTE,
            body="SELECT DISTINCT _source_year AS year, "
            "CASE WHEN _source_year = 1998 THEN 'ISO-8859-1' ELSE 'UTF-8' END AS encoding, 'ok' AS verdict FROM raw",
        ),
    }


RAW_ORACLES = _raw_oracles()
