"""Partitioned tables whose changes are published whole.

Every write puts its rows into folders of their own inside the partitions they
belong to (``year=1997/v-<id>``). What a table holds is a list of such folders,
``_versions/000042``, made to appear by one rename: readers take the newest list,
partitions that a change does not touch are carried over by name, and a writer that
dies before the rename leaves nothing that a reader sees. A list that is there
already is never replaced, so of two writers that started from the same version one
is refused.

A folder of partitioned parquet without lists is a table, too: its first change
carries its files over as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrow.functions import fs
from vetrow.session import CODEC

LISTS = "_versions"
PLAIN_FILES = "*.parquet"
OPEN_FILES = 20  # partitions that a task writes side by side; rows of further ones are sorted by partition
ROW_GROUP_BYTES = 32 << 20  # what an open file holds in memory at most


class ConcurrentChangeError(RuntimeError):
    """Another writer published a version since this one read the table."""


@dataclass(frozen=True)
class Version:
    """A list's number (0: none yet) and the folders it names, below the table's root."""

    number: int
    folders: tuple[str, ...]

    def outside(self, partitions: Iterable[str]) -> list[str]:
        """The folders of all partitions but these."""
        gone = set(partitions)
        return [f for f in self.folders if f.rpartition("/")[0] not in gone]


def partition_name(spark: SparkSession, partition_by: Sequence[str], values: Sequence) -> str:
    """The folder of a partition as Spark writes it (escaped; null and empty values under its default name)."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    shown = [None if v is None else str(v).lower() if isinstance(v, bool) else str(v) for v in values]
    return "/".join(utils.getPartitionPathString(c, v) for c, v in zip(partition_by, shown))


def numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n) for n in fs.list_files(spark, f"{root}/{LISTS}") if n.isdigit())


def _folders_of(spark: SparkSession, root: str, number: int) -> tuple[str, ...]:
    return tuple(json.loads(fs.read_text(spark, f"{root}/{LISTS}/{number:06d}")))


def _partition_dirs(spark: SparkSession, root: str, depth: int) -> list[str]:
    found = [""]
    for _ in range(depth):
        found = [f"{p}/{d}".lstrip("/") for p in found for d in fs.list_dirs(spark, f"{root}/{p}" if p else root) if "=" in d]
    return found


def current(spark: SparkSession, root: str, number: int | None = None, partition_by: Sequence[str] = ()) -> Version | None:
    """The newest version (or the one asked for); for a plain folder its partitions as they are (found if ``partition_by``
    is given); None if there is no table."""
    known = numbers(spark, root)
    if known:
        chosen = known[-1] if number is None else number
        return Version(chosen, _folders_of(spark, root, chosen))
    if not fs.exists(spark, root):
        return None
    dirs = _partition_dirs(spark, root, len(partition_by))
    held = [d for d in dirs if any(n.endswith(".parquet") for n in fs.list_files(spark, f"{root}/{d}"))]
    return Version(0, tuple(f"{d}/{PLAIN_FILES}".lstrip("/") for d in held))


def differing(old: Version, new: Version) -> set[str]:
    """Partitions that do not have the same folders in both versions."""
    held = [{}, {}]
    for folders, v in zip(held, (old, new)):
        for f in v.folders:
            folders.setdefault(f.rpartition("/")[0], set()).add(f)
    return {p for p in {*held[0], *held[1]} if held[0].get(p) != held[1].get(p)}


@contextmanager
def open_files(spark: SparkSession, count: int = OPEN_FILES):
    """Partitioned writes inside keep a file open for each partition; without, Spark sorts a task's rows by partition first,
    whole rows, which spill where a task has more of them than memory. The session's own setting wins."""
    conf = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(conf)
    if int(before) > 0:
        yield
        return
    spark.conf.set(conf, count)
    try:
        yield
    finally:
        spark.conf.set(conf, before)


def stage(df: DataFrame, root: str, partition_by: Sequence[str]) -> list[str]:
    """Write ``df`` into new folders inside its partitions, which no reader sees yet; their names below the root."""
    spark, name = df.sparkSession, f"v-{uuid.uuid4().hex}"
    draft = f"{root}/_drafts/{name}"
    writer = df.write.mode("errorifexists").option("compression", CODEC).option("parquet.block.size", ROW_GROUP_BYTES)
    with open_files(spark):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(draft)
    staged = []
    for partition in _partition_dirs(spark, draft, len(partition_by)):
        if not any(n.endswith(".parquet") for n in fs.list_files(spark, f"{draft}/{partition}")):
            continue
        folder = f"{partition}/{name}".lstrip("/")
        fs.move(spark, f"{draft}/{partition}".rstrip("/"), f"{root}/{folder}")
        staged.append(folder)
    fs.remove(spark, draft)
    return staged


def switch(spark: SparkSession, root: str, base: Version | None, folders: Sequence[str]) -> int:
    """Make ``folders`` the table, if it still is at version ``base``."""
    number = (base.number if base else 0) + 1
    if not fs.create_text(spark, f"{root}/{LISTS}/{number:06d}", json.dumps(sorted(folders))):
        raise ConcurrentChangeError(f"{root} is at version {number} already")
    return number


def publish(df: DataFrame, root: str, base: Version | None, partition_by: Sequence[str], replaced: Iterable[str] | None) -> int:
    """Write ``df`` and put it in place of the partitions named in ``replaced`` (None: of those that ``df`` has rows of);
    other partitions stay, and get what ``df`` has for them beside their rows."""
    staged = stage(df, root, partition_by)
    gone = {f.rpartition("/")[0] for f in staged} if replaced is None else set(replaced)
    return switch(df.sparkSession, root, base, (base.outside(gone) if base else []) + staged)


def read(spark: SparkSession, root: str, version: Version, merge_schema: bool) -> DataFrame:
    paths = [f"{root}/{f}" for f in version.folders]
    return spark.read.option("mergeSchema", str(merge_schema).lower()).option("basePath", root).parquet(*paths)


# --- figures of files ---------------------------------------------------------------

STATS = "_stats"


def describe_files(spark: SparkSession, root: str, columns: Sequence[str]) -> int:
    """Write, for every folder of the newest version that has none yet, a table of its files with the least and the greatest
    value of ``columns`` in each; returns how many folders were read. The tables lie beside the folders and stay valid, as
    folders are never changed."""
    found = current(spark, root)
    described = set(fs.list_dirs(spark, f"{root}/{STATS}"))
    fresh = [f for f in (found.folders if found else ()) if _stats_name(f) not in described]
    for name in sorted({_stats_name(f) for f in fresh}):  # a write's folders together
        own = [f"{root}/{f}" for f in fresh if _stats_name(f) == name]
        rows = spark.read.option("basePath", root).parquet(*own).select(F.col("_metadata.file_path").alias("file"), *columns)
        bounds = [x for c in columns for x in (F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"))]
        rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *bounds).coalesce(1).write.parquet(f"{root}/{STATS}/{name}")
    return len(fresh)


def _stats_name(folder: str) -> str:
    return folder.rpartition("/")[2].replace(PLAIN_FILES, "plain")


def read_between(spark: SparkSession, root: str, column: str, low, high) -> DataFrame:
    """The rows of the newest version with ``column`` from ``low`` to ``high``. Of described folders only the files whose
    bounds meet that range are listed and opened; the others are read whole."""
    found = current(spark, root)
    described = set(fs.list_dirs(spark, f"{root}/{STATS}"))
    known = [f for f in found.folders if _stats_name(f) in described]
    paths = [f"{root}/{f}" for f in found.folders if _stats_name(f) not in described]
    if known:
        figures = spark.read.parquet(*sorted({f"{root}/{STATS}/{_stats_name(f)}" for f in known}))
        meets = (F.col(f"high_{column}") >= F.lit(low)) & (F.col(f"low_{column}") <= F.lit(high))
        places = {f.removesuffix(PLAIN_FILES).rstrip("/") for f in known}  # a version's folders, not its files
        held = spark.createDataFrame([(len(p.split("/")) if p else 0, p) for p in places], "depth int, place string")
        decoded = F.url_decode(F.replace(F.col("file"), F.lit("+"), F.lit("%2B")))
        files = figures.where(meets).select(decoded.alias("file")).withColumns({
            "folder": F.regexp_replace("file", "/[^/]*$", ""), "depth": F.explode(F.array(*(F.lit(d) for d in sorted({len(p.split("/")) if p else 0 for p in places}))))})
        files = files.withColumn("place", F.expr("substring_index(folder, '/', -depth)")).join(held, ["depth", "place"])
        paths += [r["file"] for r in files.collect()]
    if not paths:
        return read(spark, root, found, False).limit(0)
    rows = spark.read.option("basePath", fs.qualified(spark, root)).parquet(*paths)
    return rows.where(F.col(column).between(F.lit(low), F.lit(high)))


def vacuum(spark: SparkSession, root: str, keep: int = 2, *, orphans: bool = False) -> list[str]:
    """Remove all lists but the newest ``keep`` (one at least) and the folders that only they name. ``orphans`` also
    removes folders that no list names, which a dead writer left; leave it off while a writer is at work."""
    known = numbers(spark, root)
    kept, dropped = known[-max(keep, 1):], known[:-max(keep, 1)]
    used = {f for n in kept for f in _folders_of(spark, root, n)}
    doomed = {f for n in dropped for f in _folders_of(spark, root, n)} - used
    if orphans and kept:
        depth = max((f.count("/") for f in used | doomed), default=0)
        dirs = _partition_dirs(spark, root, depth)
        doomed |= {f"{p}/{d}".lstrip("/") for p in dirs for d in fs.list_dirs(spark, f"{root}/{p}".rstrip("/")) if d.startswith("v-")} - used
        fs.remove(spark, f"{root}/_drafts")
    for n in dropped:
        fs.remove(spark, f"{root}/{LISTS}/{n:06d}")
    for folder in sorted(doomed):
        if folder.endswith(PLAIN_FILES):
            parent = f"{root}/{folder}"[: -len(PLAIN_FILES) - 1]
            for name in fs.list_files(spark, parent):
                fs.remove(spark, f"{parent}/{name}")
        else:
            fs.remove(spark, f"{root}/{folder}")
    return sorted(doomed)
