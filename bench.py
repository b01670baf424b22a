"""Bench: the survey flow and the file/table operators at one scale factor.

Runs on local[$BENCH_CPUS] against $BENCH_SF_DIR (default /root/testdata/sf0.1)
and prints one JSON line. Each step is forced with a ``noop`` write or a small
collect, so nothing is pulled to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))

    from pyspark.sql import SparkSession


    scratch = tempfile.mkdtemp(prefix="vetrow-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("vetrow-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # partitioned writes keep a few open files per task instead of sorting
        # each task's rows by partition value first
        .config("spark.sql.maxConcurrentOutputFileWriters", "16")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoint")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(f"{scratch}/checkpoint")

    from vetrow.operators import marts, quality, tables
    from vetrow.operators.quarantine import check_balance
    from vetrow.plans import layers
    from vetrow.plans.files_catalog import q_classify_names, q_payload_audit
    from vetrow.plans.raw_catalog import q_raw_scan
    from vetrow.plans.tables_catalog import q_upsert
    from vetrow.sources.binding import survey_rows
    from vetrow.spec import BINDING

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    state: dict = {}

    jobs: dict[str, int] = {}
    tracker = spark.sparkContext.statusTracker()

    def step(name, fn):
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        jobs[name] = len(tracker.getJobIdsForGroup(name))

    def bronze():
        out = f"{scratch}/{state['tag']}/bronze"
        survey_rows(spark, state["sf"]).write.partitionBy(*layers.BRONZE_PARTITIONS).parquet(out)
        state["raw"] = spark.read.parquet(out)

    def silver_evaluate():
        # as a run does it: both sides written once, counted while they are
        state["parts"], state["counts"] = layers.split_counted(state["raw"], BINDING, rejected_at=layers._now())

    def reconcile_rules():
        parts = state["parts"]
        counts = state["counts"]
        check_balance(counts["source"], counts["accepted"], counts["rejected"])
        quality.run_rules({"accepted": parts.accepted}, quality.metrics_frame(spark, counts)).collect()

    def quarantine_and_upsert():
        parts, base = state["parts"], f"{scratch}/{state['tag']}"
        tables.replace_where(spark, f"{base}/quarantine", parts.rejected, tables.slice_predicate(),
                             layers.QUARANTINE_PARTITIONS)
        prepared = layers.prepare_silver(parts.accepted, updated_at=layers._now())
        tables.upsert_table(spark, f"{base}/silver", prepared, BINDING.natural_key, layers.SILVER_PARTITIONS)
        # a rerun of the same slice: every touched partition is merged and rewritten
        tables.upsert_table(spark, f"{base}/silver", prepared, BINDING.natural_key, layers.SILVER_PARTITIONS,
                            assume_unique=True)

    def gold():
        base = f"{scratch}/{state['tag']}"
        layers.run_gold(spark, f"{base}/silver", f"{base}/gold")
        cov = marts.coverage(tables.read_table(spark, f"{base}/silver"))
        marts.year_runs(marts.yearly_coverage(cov)).collect()

    def flow(sf: str, tag: str) -> None:
        state.update(sf=sf, tag=tag)
        step("bronze_table", bronze)
        step("silver_evaluate_split", silver_evaluate)
        step("reconcile_and_rules", reconcile_rules)
        step("quarantine_and_upsert", quarantine_and_upsert)
        step("gold_marts", gold)
        step("upsert_orders", lambda: noop(q_upsert(spark, sf)))
        step("manifest_classify", lambda: noop(q_classify_names(spark, sf)))
        step("payload_audit", lambda: noop(q_payload_audit(spark, sf)))
        step("bronze_csv_roundtrip", lambda: noop(q_raw_scan(spark, sf)))

    # One untimed pass over the smallest tables first, so the timed pass
    # measures the plans rather than the JVM compiling them.
    warm_sf = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    warmup = 0.0
    if os.path.isdir(warm_sf) and os.path.abspath(warm_sf) != os.path.abspath(sf_dir):
        t0 = time.perf_counter()
        flow(warm_sf, "warmup")
        warmup = round(time.perf_counter() - t0, 3)
        timings.clear()
        for name in list(jobs):
            jobs[name] = 0
    flow(sf_dir, "timed")

    total = round(sum(timings.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "survey_flow_total", "value": total, "unit": "sec", "queries": timings,
                      "sf": sf, "cpus": cpus, "warmup_sec": warmup, "spark_jobs": jobs}))
    spark.stop()


if __name__ == "__main__":
    main()
