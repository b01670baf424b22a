"""Bronze ingestion: published ``;``-CSV files loaded as strings, with lineage.

Files are read as lines of bytes, whatever their charset, by one splittable scan
on any Hadoop path; no file is ever one value, and no list of files is built on
the driver. ``stage_lines`` keeps the lines of that scan as a table, so that
auditing files and loading them in one run reads the text once.

1. ``audit_files`` - one row for every listed file: charset (strict UTF-8 or
   else Latin-1, judged over all its lines), its first line as header, and
   whether it is a survey file at all, by its first bytes in order across lines
   and blocks. A file of blanks is a row, too; one of no bytes is not listed by
   Spark and has nothing to load.
2. ``with_headers`` - the distinct header lines (a handful, however many files)
   are parsed and normalised, fingerprinted, and held against the contract.
3. ``read_rows`` - the lines of the files that may be loaded are joined to their
   file's row, decoded, parsed by Spark's CSV parser and put in contract order.

Paths are compared in one form (``plain_path``): Spark's metadata column encodes
blanks and accents, its listing does not.
"""

from __future__ import annotations

import csv
import hashlib
import re
import unicodedata
import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vetrow.functions import fs
from vetrow.session import materialize, scratch_path
from vetrow.sources import audit as au
from vetrow.spec import RAW_COLUMNS, ROW_ID

# The header as published (column order of the survey files).
PUBLISHED_HEADER = (
    "Regiao - Sigla",
    "Estado - Sigla",
    "Municipio",
    "Revenda",
    "CNPJ da Revenda",
    "Nome da Rua",
    "Numero Rua",
    "Complemento",
    "Bairro",
    "Cep",
    "Produto",
    "Data da Coleta",
    "Valor de Venda",
    "Valor de Compra",
    "Unidade de Medida",
    "Bandeira",
)
SEPARATOR = ";"
QUOTE = '"'
DEFAULT_CHARSET = "UTF-8"

MAX_HEADERS = 10_000  # distinct header lines of files that may be loaded; more than that is no survey any more
MAX_HEADER_BYTES = 1 << 16  # a first line longer than this is no header

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):/*"


class UnexpectedHeaderError(RuntimeError):
    """Columns are not the ones the contract names."""


class UnauditedFileError(RuntimeError):
    """A file to load has no audit row, so its charset and header are unknown."""


# --- headers ---------------------------------------------------------------------------


def fold(name: str) -> str:
    """A header cell as snake_case ASCII: letters lose their accents, and whatever is no letter or digit separates."""
    decomposed = unicodedata.normalize("NFKD", name)
    kept = "".join(c if c.isascii() else "" for c in decomposed)
    return "_".join(re.findall(r"[a-z0-9]+", kept.lower()))


def header_signature(columns: Sequence[str]) -> str:
    """First 12 hex digits of the sha256 of the names joined by ``|``: tells one shape of file from another."""
    digest = hashlib.sha256()
    digest.update("|".join(columns).encode())
    return digest.hexdigest()[:12]


def split_header(line: str) -> list[str]:
    """Cells of a header line; a quoted cell may hold the separator."""
    return next(csv.reader([line.lstrip("\ufeff")], delimiter=SEPARATOR, quotechar=QUOTE), [])


HEADER_SCHEMA = ("header_line string, names array<string>, signature string, columns int, missing string, status string")


def with_headers(files: DataFrame, contract: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """Adds ``names, signature, columns, missing, status`` to files with a ``header_line`` and, where there is a
    ``verdict``, a good one. Only distinct header lines reach the driver, at most ``MAX_HEADERS``."""
    good = files.where(F.col("verdict") == au.OK) if "verdict" in files.columns else files
    lines = [r[0] for r in good.where("header_line is not null").select("header_line").distinct().limit(MAX_HEADERS + 1).collect()]
    if len(lines) > MAX_HEADERS:
        raise UnexpectedHeaderError(f"more than {MAX_HEADERS} different header lines")
    rows = []
    for line in sorted(lines):
        names = [fold(c) for c in split_header(line)]
        missing = [c for c in contract if c not in names]
        rows.append((line, names, header_signature(names), len(names), ",".join(missing), "missing_columns" if missing else "ok"))
    return files.join(files.sparkSession.createDataFrame(rows, HEADER_SCHEMA), "header_line", "left")


def check_headers(files: DataFrame, shown: int = 20) -> int:
    """Raise for files whose header lacks a contracted column; else the widest header's column count."""
    bad = files.where("status = 'missing_columns'").select("raw_key", "missing", "names").orderBy("raw_key").limit(shown).collect()
    if bad:
        raise UnexpectedHeaderError("\n".join(
            f"{r['raw_key']} is missing contracted column(s): {r['missing']}. Found: {', '.join(r['names'])}" for r in bad))
    return files.agg(F.max("columns")).first()[0] or 0


# --- files -----------------------------------------------------------------------------


def plain_path(path: Column, *, encoded: bool) -> Column:
    """One form of a path: one slash after the scheme, nothing percent-encoded."""
    if encoded:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, _SCHEME, "$1:/")


def raw_key(path: Column, root: str) -> Column:
    """The path below the root, by the length of the root as the file system names it."""
    return F.substring(path, len(root) + 2, 1 << 30)


def plain_root(spark: SparkSession, root: str) -> str:
    return re.sub(_SCHEME, r"\1:/", fs.qualified(spark, root)).rstrip("/")


def key_parts(key: Column) -> tuple[Column, Column]:
    """(series, year) of a raw key ``series/sub/year/file``; the year folder may be missing or undated."""
    parts = F.split(key, "/")
    year = F.regexp_extract(F.when(F.size(parts) > 3, F.try_element_at(parts, F.lit(3))), r"(\d{4})$", 1)
    return F.element_at(parts, 1), F.when(year != "", year.cast("int"))


def list_files(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """(path, raw_key, size, series, year) of every file under ``root``. Content is not read."""
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        .load(root).select(plain_path(F.col("path"), encoded=False).alias("path"), F.col("length").alias("size"))
    )
    keyed = listing.withColumn("raw_key", raw_key(F.col("path"), plain_root(spark, root)))
    series, year = key_parts(F.col("raw_key"))
    return keyed.select("path", "raw_key", "size", series.alias("series"), year.alias("year"))


def raw_lines(spark: SparkSession, folders: str | list[str], glob: str = "*.csv") -> DataFrame:
    """(path, block, place, line) of all files under the folders: lines as bytes, in a string column that nothing
    has decoded; ``place`` rises by one along the lines of a block."""
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(folders)
    return text.select(
        plain_path(F.col("_metadata.file_path"), encoded=True).alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"))


def stage_lines(spark: SparkSession, files: DataFrame, folder: str | None = None, glob: str = "*.csv") -> DataFrame:
    """The lines of ``files`` as a table, from one scan of their text. The listing is written first: a scan of files is
    planned by the size of their content, so that the lines would be shuffled by path to meet a list of a few names."""
    listed = materialize(files.select("path").distinct(), "listing", folder)
    folders = folders_of(listed)
    if not folders:
        return spark.createDataFrame([], "path string, block long, place long, line string")
    return materialize(raw_lines(spark, folders, glob).join(listed, "path", "left_semi"), "lines", folder)


def folders_of(files: DataFrame) -> list[str]:
    """Folders that hold the files, without those inside another one: as many as there are partitions, not files."""
    found = sorted(r[0] for r in files.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct().collect())
    top: list[str] = []
    for folder in found:
        if not top or not f"{folder}/".startswith(f"{top[-1]}/"):
            top.append(folder)
    return top


def decoded(line: Column, encoding: Column) -> Column:
    """Bytes to text: Latin-1 as such, anything else as UTF-8 with a mark in place of what is not."""
    return F.when(encoding == au.LATIN1, F.decode(line.cast("binary"), au.LATIN1)).otherwise(F.make_valid_utf8(line))


def file_heads(lines: DataFrame, filled: Column, folder: str | None = None) -> DataFrame:
    """(path, utf8, first, head): whether all of a file's lines are UTF-8, its first line that is not blank (cut after
    ``MAX_HEADER_BYTES`` and one), and its first ``HEAD_BYTES`` from there on, line ends counting one byte.

    Lines are counted by block. A head begins in the block of the first line that is not blank and may reach into later
    blocks as long as those in between hold less than a head; of these blocks only so many lines are put in order."""
    head = au.HEAD_BYTES
    place = F.when(filled, F.col("place"))
    blocks = lines.groupBy("path", "block").agg(
        F.bool_and(F.is_valid_utf8("line")).alias("utf8"), F.min("place").alias("start"), F.min(place).alias("filled"),
        F.sum(F.octet_length("line") + 1).alias("bytes"), F.min_by(F.left(F.col("line"), F.lit(MAX_HEADER_BYTES + 1)), place).alias("first"))
    by_path = Window.partitionBy("path").orderBy("block")
    seen = blocks.withColumn("open", F.max(F.col("filled").isNotNull()).over(by_path.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    opening = F.col("filled").isNotNull() & ~F.coalesce(F.lag("open").over(by_path), F.lit(False))
    between = F.sum(F.when(F.col("open") & ~F.col("opening"), F.col("bytes")).otherwise(0)).over(
        by_path.rowsBetween(Window.unboundedPreceding, -1))
    marked = materialize(seen.withColumn("opening", opening).withColumn("between", F.coalesce(between, F.lit(0))), "blocks", folder)
    wanted = marked.where(F.col("open") & (F.col("between") < head)).select(
        F.col("path").alias("_path"), F.col("block").alias("_block"), F.when(F.col("opening"), F.col("filled")).otherwise(F.col("start")).alias("_from"))
    near = (F.col("path") == F.col("_path")) & (F.col("block") == F.col("_block")) & F.col("place").between(F.col("_from"), F.col("_from") + head)
    ordered = F.array_sort(F.collect_list(F.struct("block", "place", F.left(F.col("line"), F.lit(head)).alias("line"))))
    heads = lines.join(wanted, near).groupBy("path").agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("head"))
    facts = marked.groupBy("path").agg(F.bool_and("utf8").alias("utf8"), F.max(F.when(F.col("opening"), F.col("first"))).alias("first"))
    return facts.join(heads, "path", "left")


def audit_files(spark: SparkSession, root: str, *, only: DataFrame | None = None, glob: str = "*.csv",
                lines: DataFrame | None = None, folder: str | None = None) -> DataFrame:
    """One row for every file under ``root`` (or those whose ``path`` is in ``only``): ``path, raw_key, size, series,
    year, encoding, header_line, verdict``, as a table. The header is the first line that is not blank; a file without
    one, a web page, one without a separator in that line, or with a line too long for a header is refused by its
    verdict, never by an error. ``lines`` are the files' lines where they are staged already; else they are staged
    while this runs."""
    files = list_files(spark, root, glob)
    if only is not None:
        files = files.join(only.select(plain_path(F.col("path"), encoded=False).alias("path")).distinct(), "path", "left_semi")
    own = scratch_path(spark, f"runs/audit-{uuid.uuid4().hex}")
    try:
        lines = stage_lines(spark, files, own, glob) if lines is None else lines
        facts = file_heads(lines, au.stripped(F.col("line").cast("binary")) != "", own)
        return materialize(_judged(files.join(facts, "path", "left")), "audit", folder)
    finally:
        fs.remove(spark, own)


def _judged(files: DataFrame) -> DataFrame:
    """Charset, header and verdict from the facts of ``file_heads``."""
    first, long = F.coalesce("first", F.lit("")), F.coalesce(F.octet_length("first") > MAX_HEADER_BYTES, F.lit(False))
    verdict = au.sniff(F.coalesce("head", F.lit("")).cast("binary"), F.lit("csv"))
    encoding = F.when(F.coalesce("utf8", F.lit(True)), F.lit(au.UTF8)).otherwise(F.lit(au.LATIN1))
    return files.withColumn("encoding", encoding).select(
        "path", "raw_key", "size", "series", "year", "encoding",
        F.when(~long, F.nullif(F.ltrim(decoded(first, F.col("encoding")), F.lit("\ufeff")), F.lit(""))).alias("header_line"),
        F.when((verdict == au.OK) & long, F.lit(au.NO_HEADER)).otherwise(verdict).alias("verdict"))


WHOLE_BELOW = (1 << 31) - 1024  # bytes that fit in one value
MARK = b"\xef\xbb\xbf"


def file_digests(spark: SparkSession, root: str, glob: str = "*.csv", *, whole_below: int = WHOLE_BELOW) -> DataFrame:
    """(path, sha256) of every file, whatever its size. Files of ``whole_below`` bytes or more are not taken as one value:
    their lines go in order through one digest."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    path = plain_path(F.col("path"), encoded=False).alias("path")
    small = files.where(F.col("length") < whole_below).select(path, F.sha2("content", 256).alias("sha256"))
    large = materialize(files.where(F.col("length") >= whole_below).select(path, F.col("length").alias("size")), "large-files")
    folders = folders_of(large)
    return small.unionByName(streamed_digests(spark, large, folders, glob)) if folders else small


def streamed_digests(spark: SparkSession, files: DataFrame, folders: list[str], glob: str) -> DataFrame:
    """(path, sha256) of ``files`` (path, size), each read as its lines, in order, by one task that holds a batch of them at
    a time. A digest needs its bytes one after the other, so that a file is one task's work; many files are many tasks'.

    Spark's line reader leaves out line ends and a mark at the start of a file; the size tells what was there. A file
    whose size does not fit its lines (changed while it was read) has a NULL digest."""
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("lineSep", "\n").text(folders)
    lines = text.select(
        plain_path(F.col("_metadata.file_path"), encoded=True).alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), F.col("value").cast("binary").alias("line"))
    ordered = lines.join(files, "path").repartition("path").sortWithinPartitions("path", "block", "place").select("path", "size", "line")
    found = ordered.mapInArrow(_digest_lines, "path string, sha256 string")
    only_mark = F.when(F.col("size") == len(MARK), F.lit(hashlib.sha256(MARK).hexdigest()))  # a file without a line
    return files.join(found, "path", "left").select("path", F.coalesce("sha256", only_mark).alias("sha256"))


def _digest_lines(batches):
    import pyarrow as pa

    mark = MARK
    path, size, read, plain, marked = None, 0, 0, None, None

    def found():
        ends = size - read  # a last line end, a mark, both or nothing
        if ends not in (0, 1, len(mark), len(mark) + 1):
            return None
        digest = plain if ends < len(mark) else marked
        if ends % len(mark):
            digest.update(b"\n")
        return digest.hexdigest()

    def row():
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([found()], pa.string())], ["path", "sha256"])

    for batch in batches:
        for at, name in enumerate(batch.column("path")):
            name = name.as_py()
            if name != path:
                if path is not None:
                    yield row()
                path, size, read = name, batch.column("size")[at].as_py(), -1
                plain, marked = hashlib.sha256(), hashlib.sha256(mark)
            line = batch.column("line")[at].as_buffer()
            for digest in (plain, marked):
                if read >= 0:
                    digest.update(b"\n")
                digest.update(line)
            read += line.size + 1
    if path is not None:
        yield row()


# --- rows ------------------------------------------------------------------------------


def read_rows(spark: SparkSession, files: DataFrame, *, run_id: str, ingested_at: datetime,
              contract: Sequence[str] = RAW_COLUMNS, glob: str = "*.csv", lines: DataFrame | None = None) -> DataFrame:
    """Bronze rows of audited files with headers: strings only, nothing inferred, quoted separators honoured, one
    line one record, blank lines and the header line left out, columns found by their normalised name.

    The row id is the raw key, the block and the place in it: no two rows of a table share it, whatever
    run loaded them. ``lines`` are the files' lines where they are staged already."""
    width = check_headers(files)
    lines = (raw_lines(spark, folders_of(files), glob) if lines is None else lines).join(
        files.select("path", "raw_key", "series", "year", "encoding", "header_line", "names", "signature"), "path")
    text = F.ltrim(decoded(F.col("line"), F.col("encoding")), F.lit("\ufeff"))
    lines = lines.withColumn("text", text).where((F.trim("text") != "") & ~((F.col("block") == 0) & (F.col("text") == F.col("header_line"))))
    cells = F.from_csv("text", ", ".join(f"c{i} string" for i in range(max(width, 1))), {"sep": SEPARATOR, "quote": QUOTE})
    parsed = lines.withColumn("cells", cells).withColumn("cells", F.array(*(F.col(f"cells.c{i}") for i in range(max(width, 1)))))
    column = [F.try_element_at("cells", F.array_position("names", c).cast("int")).alias(c) for c in contract]
    return parsed.select(
        *column,
        F.col("raw_key").alias("_source_file"), F.col("series").alias("_source_series"), F.col("year").alias("_source_year"),
        F.col("encoding").alias("_source_encoding"), F.col("signature").alias("_header_signature"),
        F.lit(ingested_at).cast("timestamp").alias("_ingested_at"), F.lit(run_id).alias("_ingestion_run_id"),
        F.format_string("%s:%015d:%019d", "raw_key", "block", "place").alias(ROW_ID))


def stamp_lineage(frame: DataFrame, *, source_file: str, series: str, year: int | None, encoding: str,
                  run_id: str, ingested_at: datetime, contract: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """One already-loaded file's frame: the contract columns (extras dropped,
    but counted in the signature, taken before the projection) plus lineage."""
    stamps = {
        "_source_file": F.lit(source_file), "_source_series": F.lit(series), "_source_year": F.lit(year).cast("int"),
        "_source_encoding": F.lit(encoding), "_header_signature": F.lit(header_signature(list(frame.columns))),
        "_ingested_at": F.lit(ingested_at).cast("timestamp"), "_ingestion_run_id": F.lit(run_id),
        ROW_ID: F.format_string("%s:%019d", F.lit(source_file), F.monotonically_increasing_id()),
    }
    return frame.select(*contract, *(value.alias(name) for name, value in stamps.items()))


def rows_per_file(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("_source_file").agg(F.count(F.lit(1)).alias("rows"))
