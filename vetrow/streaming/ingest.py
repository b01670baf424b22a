"""Incremental bronze ingestion: raw files are picked up as they land.

Structured Streaming's file source tracks which files were already seen (in
its checkpoint under the shared checkpoint folder); each micro-batch audits
its own files only, and puts their audit rows and their bronze rows in place of
earlier ones of the same files. Both tables are keyed by file, so a micro-batch
that runs again after a failure, or under a new checkpoint, changes nothing.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vetrow.functions import fs
from vetrow.operators import tables
from vetrow.plans import layers
from vetrow.session import materialize, scratch_path
from vetrow.sources import audit as au
from vetrow.sources import raw as rw

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
AUDIT_PARTITIONS = ("series", "year")


def ingest_batch(spark: SparkSession, raw_root: str, bronze_path: str, audit_path: str):
    """The micro-batch function. Of a batch's files only the paths are used, so their content is not read here."""

    def handle(files: DataFrame, epoch_id: int) -> None:
        folder = scratch_path(spark, f"runs/ingest-{uuid.uuid4().hex}")
        try:
            found = materialize(rw.audit_files(spark, raw_root, only=files.select("path")), "batch", folder)
            now = F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp")
            audited = found.withColumn("_audited_at", now).withColumn("_epoch", F.lit(epoch_id))
            scope = {tuple(r) for r in found.select(*AUDIT_PARTITIONS).distinct().collect()}
            tables.replace_keys(spark, audit_path, audited, found, "raw_key", AUDIT_PARTITIONS, scope)
            good = found.where(F.col("verdict") == au.OK)
            if good.limit(1).collect():
                layers.run_bronze(spark, raw_root, bronze_path, audited=found, raw_keys=good, run_id=f"stream-{epoch_id}")
        finally:
            fs.remove(spark, folder)

    return handle


def start_raw_ingest(spark: SparkSession, raw_root: str, bronze_path: str, audit_path: str, *,
                     checkpoint: str | None = None, max_files_per_trigger: int = 64,
                     available_now: bool = True) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(raw_root)
    )
    writer = (
        files.writeStream.foreachBatch(ingest_batch(spark, raw_root, bronze_path, audit_path))
        .option("checkpointLocation", checkpoint or scratch_path(spark, "streams/raw-ingest"))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
