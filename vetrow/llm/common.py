"""What the operators share: tables cut at files, task counts, link components."""

from __future__ import annotations

import math
import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vetrow.session import materialize, materialize_counted


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once an application, for tasks that import it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="vetrow-package-")) / "vetrow.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted((root / "vetrow").rglob("*.py")):
            z.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


#: Rows and bytes that Spark hands a task's Python at a time, where the session does not say otherwise.
BATCH_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
                "spark.sql.execution.arrow.maxBytesPerBatch": (None, "8388608")}


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than Spark's default: a task holds a batch more than once, and texts are long."""
    for key, (default, value) in BATCH_LIMITS.items():
        if spark.conf.get(key, default) in (default, None):
            spark.conf.set(key, value)


def map_batches(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with this package importable in the tasks, in bounded batches."""
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    return df.mapInArrow(function, schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage at a table under ``spark.checkpoint.dir``."""
    return materialize(df, name, codec=None)


def save_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    return materialize_counted(df, name, codec=None)


def tasks_for(rows: int, rows_per_task: int, least: int = 1) -> int:
    """Partitions so that one holds about ``rows_per_task`` rows, however many rows there are."""
    return max(least, math.ceil(rows / rows_per_task))


def boxed(docs: DataFrame, carry: Sequence[str] | None = None):
    """The columns to carry (None: all) in one struct named ``doc``, where no name can clash with an operator's own."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in (docs.columns if carry is None else carry)]).alias("doc")


def unboxed(df: DataFrame, results: Sequence[str]) -> DataFrame:
    """The carried columns again, then ``results``. A carried column that bears a result's name comes back with ``_in`` appended."""
    fields = df.schema["doc"].dataType.names
    taken = {n.lower() for n in [*fields, *results]}
    columns = []
    for f in fields:
        name = f
        if f.lower() in {r.lower() for r in results}:
            name = f + "_in"
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
        columns.append(F.col("doc").getField(f).alias(name))
    return df.select(*columns, *results)


def numbered(df: DataFrame, order: Sequence, name: str, column: str, rows_per_task: int = 1_000_000) -> DataFrame:
    """``df`` with ``column``: 1, 2, 3... in the given order, without a window over all rows.

    Rows are dealt by ranges of the order, sorted where they are and written; a row's number is its place in its part plus
    the rows of the parts before. The order has to be a total one, as rows that are equal in it share a part."""
    rows = df.count()
    parts = tasks_for(rows, rows_per_task)
    place = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    placed = save(place, name).withColumns({"_part": F.shiftright("_place", 33), "_in_part": F.col("_place").bitwiseAND((1 << 33) - 1)})
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return placed.join(starts, "_part").withColumn(column, F.col("_start") + F.col("_in_part") + 1).drop(
        "_place", "_part", "_in_part", "_start")


def crc_remainder(column, modulus: int):
    """crc32 of the id's decimal text, modulo ``modulus``: the folds of labelled rows."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def text_blocks(texts: list[str], most: int, chars: int = 1 << 20) -> Iterator[list[str]]:
    """Texts in blocks of at most ``most`` and, but for a single long text, at most ``chars`` characters."""
    block, size = [], 0
    for t in texts:
        if block and (len(block) == most or size + len(t) > chars):
            yield block
            block, size = [], 0
        block.append(t)
        size += len(t)
    if block:
        yield block


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b).

    Each round hooks every node to its smallest smaller neighbour, flattens
    the resulting forest by pointer doubling and contracts the edges to the
    roots, so the edge table shrinks at least by half a round. Hubs are
    combined before the shuffle (``min``) and joined as a skew-splittable
    side. Nodes without an edge to another node are not returned.
    """
    edges, left = save_counted(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(),
        f"{name}-edges",
    )
    labels = None
    while left or labels is None:
        hook, hooked = save_counted(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), f"{name}-hook")
        moved = hooked
        while moved:
            step = hook.alias("x").join(hook.alias("y"), F.col("x.root") == F.col("y.node"), "left").select(
                "x.node", F.coalesce("y.root", "x.root").alias("root"), F.col("y.root").isNotNull().cast("int").alias("moved")
            )
            step = save(step, f"{name}-jump")
            moved = step.agg(F.max("moved")).first()[0]
            hook = step.select("node", "root")
        if labels is None:
            labels = hook
        else:
            labels = labels.alias("l").join(hook.alias("h"), F.col("l.root") == F.col("h.node"), "left").select(
                "l.node", F.coalesce("h.root", "l.root").alias("root")).unionByName(hook)
            labels = save(labels, f"{name}-labels")
        if not left:
            break
        first = edges.alias("e").join(hook.alias("h"), F.col("e.a") == F.col("h.node"), "left").select(
            F.coalesce("h.root", "e.a").alias("a"), F.col("e.b").alias("b"))
        second = first.alias("e").join(hook.alias("h"), F.col("e.b") == F.col("h.node")).select(
            F.col("e.a").alias("a"), F.col("h.root").alias("b"))
        edges, left = save_counted(
            second.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(),
            f"{name}-edges",
        )
    return labels.select("node", F.col("root").alias("component")).unionByName(
        labels.select(F.col("root").alias("node"), F.col("root").alias("component")).distinct())
