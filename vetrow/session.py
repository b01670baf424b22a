"""Session-level helpers. The caller owns the session; nothing here creates one
for library code."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
CODEC = "zstd"  # of tables that runs write: row ids and other long strings take less than half of what they do with snappy


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session (tests, a laptop) gets a fresh folder of its own
    when the setting is missing; on a cluster a machine-local folder would be
    lost with its executor, so we refuse instead.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder before running on a cluster")
    chosen = tempfile.mkdtemp(prefix="vetrow-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, chosen)
    spark.sparkContext.setCheckpointDir(chosen)
    return chosen


def materialize(df: DataFrame, name: str = "table", folder: str | None = None, codec: str | None = CODEC) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: the lineage is cut at a file (a lost executor re-reads it instead of
    recomputing upstream stages) and, unlike ``Dataset.checkpoint``, the
    upstream plan runs once, not twice."""
    return materialize_counted(df, name, folder, codec)[0]


def materialize_counted(df: DataFrame, name: str = "table", folder: str | None = None,
                        codec: str | None = CODEC) -> tuple[DataFrame, int]:
    """``materialize`` plus the number of rows written, observed during the
    write itself (no second pass to count). The table is read back with the
    schema it was written with, so no footer has to be read to infer it."""
    written, found = materialize_observed(df, name, folder, codec)
    return written, found["rows"]


def materialize_observed(df: DataFrame, name: str = "table", folder: str | None = None, codec: str | None = CODEC,
                         **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``materialize`` plus ``rows`` and other counts (aggregates by name) of what was written, from the write itself.
    ``codec`` None: the session's."""
    spark = df.sparkSession
    base = folder or scratch_path(spark, "materialized")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    observation = Observation(f"{name}-rows")
    writer = df.observe(observation, F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in counts.items())).write
    (writer.option("compression", codec) if codec else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path), {n: int(v) for n, v in observation.get.items()}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for files a job writes and
    reads back (e.g. CSV it derives from a table)."""
    return f"{checkpoint_dir(spark)}/{name}"


def local_session(cores: int = 8, app: str = "vetrow", shuffle_partitions: int | None = None):
    """Session for tests and the bench (local mode only)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.sources.partitionOverwriteMode", "static")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark
