import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from vetrow.operators import tables, versions

SCHEMA = "k string, d date, price double, y int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_upsert_first_write_rerun_update_insert(spark, tmp_dir):
    path = f"{tmp_dir}/silver"
    a = frame(spark, [("a", dt.date(2024, 1, 1), 1.0, 2024), ("b", dt.date(2025, 1, 1), 2.0, 2025)])
    tables.upsert_table(spark, path, a, ["k", "d"], ["y"])
    tables.upsert_table(spark, path, a, ["k", "d"], ["y"])
    assert tables.content_diff(tables.read_table(spark, path), a).count() == 0
    b = frame(spark, [("b", dt.date(2025, 1, 1), 9.0, 2025), ("c", dt.date(2025, 2, 1), 3.0, 2025)])
    tables.upsert_table(spark, path, b, ["k", "d"], ["y"])
    got = {(r.k, r.price) for r in tables.read_table(spark, path).collect()}
    assert got == {("a", 1.0), ("b", 9.0), ("c", 3.0)}


def test_upsert_refuses_repeated_source_key(spark, tmp_dir):
    import pytest

    src = frame(spark, [("a", dt.date(2024, 1, 1), 1.0, 2024), ("a", dt.date(2024, 1, 1), 2.0, 2024)])
    with pytest.raises(tables.DuplicateSourceKeyError):
        tables.upsert_table(spark, f"{tmp_dir}/t", src, ["k", "d"], ["y"])


def test_upsert_null_safe_keys(spark):
    t = frame(spark, [(None, dt.date(2024, 1, 1), 1.0, 2024)])
    s = frame(spark, [(None, dt.date(2024, 1, 1), 5.0, 2024)])
    got = tables.upsert_by_key(t, s, ["k", "d"]).collect()
    assert [r.price for r in got] == [5.0]


def test_replace_where_scoped_and_idempotent(spark, tmp_dir):
    path = f"{tmp_dir}/q"
    base = frame(spark, [("a", None, 1.0, 2024), ("b", None, 1.0, 2025)])
    tables.write_partitions(base, path, ["y"])
    new = frame(spark, [("a2", None, 1.0, 2024)])
    for _ in range(2):  # same slice twice: no growth
        tables.replace_where(spark, path, new, F.col("y") == 2024, ["y"])
    got = sorted(r.k for r in tables.read_table(spark, path).collect())
    assert got == ["a2", "b"]


def test_replace_where_slice_becomes_clean(spark, tmp_dir):
    path = f"{tmp_dir}/q2"
    tables.write_partitions(frame(spark, [("a", None, 1.0, 2024), ("b", None, 1.0, 2025)]), path, ["y"])
    empty = frame(spark, []).limit(0)
    tables.replace_where(spark, path, empty, F.col("y") == 2024, ["y"])
    assert sorted(r.k for r in tables.read_table(spark, path).collect()) == ["b"]


def test_replace_slice_adds_columns(spark):
    cur = frame(spark, [("a", None, 1.0, 2024), ("b", None, 1.0, 2025)])
    new = frame(spark, [("c", None, 2.0, 2025)]).withColumn("extra", F.lit("x"))
    out = tables.replace_slice(cur, new, F.col("y") == 2025).collect()
    assert {(r.k, r.extra) for r in out} == {("a", None), ("c", "x")}


def test_slice_predicate(spark):
    df = spark.createDataFrame([("dsan", 2004), ("dsan", 2005), ("dsas", 2004)], "_source_series string, _source_year int")
    assert df.filter(tables.slice_predicate("dsan", [2004])).count() == 1
    assert df.filter(tables.slice_predicate()).count() == 3


def test_publish_snapshot_versions(spark, tmp_dir):
    root = f"{tmp_dir}/gold"
    tables.publish_snapshot(frame(spark, [("a", None, 1.0, 2024)]), root)
    v2 = tables.publish_snapshot(frame(spark, [("b", None, 1.0, 2024)]).withColumn("z", F.lit(1)), root)
    assert v2.endswith("v000002")
    latest = tables.latest_snapshot(spark, root)
    assert [r.k for r in latest.collect()] == ["b"] and "z" in latest.columns


def test_content_diff_sides(spark):
    a = frame(spark, [("a", None, 1.0, 1), ("a", None, 1.0, 1)])
    b = frame(spark, [("a", None, 1.0, 1), ("b", None, 1.0, 1)])
    got = sorted((r.k, r._side) for r in tables.content_diff(a, b).collect())
    assert got == [("a", "left_only"), ("b", "right_only")]


def test_replace_where_data_column_predicate_keeps_other_rows(spark, tmp_dir):
    # the predicate hits part of a partition: the rest of it must survive
    path = f"{tmp_dir}/q3"
    tables.write_partitions(frame(spark, [("a", None, 1.0, 2024), ("b", None, 1.0, 2024), ("c", None, 1.0, 2025)]), path, ["y"])
    tables.replace_where(spark, path, frame(spark, []).limit(0), F.col("k") == "a", ["y"])
    assert sorted(r.k for r in tables.read_table(spark, path).collect()) == ["b", "c"]
    tables.replace_where(spark, path, frame(spark, [("d", None, 1.0, 2026)]), F.col("k") == "b", ["y"], scope=[(2024,)])
    assert sorted(r.k for r in tables.read_table(spark, path).collect()) == ["c", "d"]


def test_prune_snapshots_keeps_newest(spark, tmp_dir):
    root = f"{tmp_dir}/g"
    for k in "abc":
        tables.publish_snapshot(frame(spark, [(k, None, 1.0, 2024)]), root)
    removed = tables.prune_snapshots(spark, root, keep=1)
    assert removed == ["v000001", "v000002"]
    assert [r.k for r in tables.latest_snapshot(spark, root).collect()] == ["c"]
    assert tables.prune_snapshots(spark, root, keep=0) == []  # the newest is never removed


def test_replace_where_on_new_table_with_no_rows(spark, tmp_dir):
    path = f"{tmp_dir}/fresh"
    tables.replace_where(spark, path, frame(spark, []).limit(0), F.col("y") == 2024, ["y"])
    assert tables.read_table(spark, path) is None
    tables.replace_where(spark, path, frame(spark, [("a", None, 1.0, 2024)]), F.col("y") == 2024, ["y"])
    assert [r.k for r in tables.read_table(spark, path).collect()] == ["a"]


def keys(df):
    return sorted(r.k for r in df.collect())


def test_a_writer_that_dies_before_the_switch_changes_nothing(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    tables.write_partitions(frame(spark, [("a", None, 1.0, 2024), ("b", None, 1.0, 2025)]), path, ["y"])

    def dies(*_):
        raise RuntimeError("lost")

    new = frame(spark, [("c", None, 2.0, 2024), ("b", None, 3.0, 2025)])
    changes = [
        lambda: tables.replace_where(spark, path, new, F.col("y") == 2024, ["y"]),
        lambda: tables.upsert_table(spark, path, new, ["k"], ["y"]),
        lambda: tables.replace_keys(spark, path, new, new, "k", ["y"], [(2024,), (2025,)]),
        lambda: tables.write_partitions(new, path, ["y"]),
    ]
    for change in changes:
        with monkeypatch.context() as patch:
            patch.setattr(versions, "switch", dies)
            with pytest.raises(RuntimeError, match="lost"):
                change()
        assert sorted(map(tuple, tables.read_table(spark, path).collect())) == [("a", None, 1.0, 2024), ("b", None, 1.0, 2025)]
    tables.upsert_table(spark, path, new, ["k"], ["y"])
    assert keys(tables.read_table(spark, path)) == ["a", "b", "c"]
    versions.vacuum(spark, path, 1, orphans=True)
    assert keys(tables.read_table(spark, path)) == ["a", "b", "c"]
    assert len([d for p in ("y=2024", "y=2025") for d in tables.fs.list_dirs(spark, f"{path}/{p}")]) == 2


def test_untouched_partitions_are_carried_by_name(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    tables.write_partitions(frame(spark, [("a", None, 1.0, 2024), ("b", None, 1.0, 2025), ("n", None, 1.0, None)]), path, ["y"])
    before = versions.current(spark, path)
    tables.replace_where(spark, path, frame(spark, [("d", None, 1.0, 2025)]), F.col("k") == "zz", ["y"])  # nothing to replace
    after = versions.current(spark, path)
    assert set(before.folders) < set(after.folders) and len(after.folders) == 4
    tables.replace_where(spark, path, frame(spark, []).limit(0), F.col("y").isNull(), ["y"])
    assert keys(tables.read_table(spark, path)) == ["a", "b", "d"]
    assert keys(tables.read_table(spark, path, version=1)) == ["a", "b", "n"]
    gone = versions.vacuum(spark, path, keep=1)
    assert len(gone) == 1 and keys(tables.read_table(spark, path)) == ["a", "b", "d"]


def test_a_plain_folder_is_taken_over(spark, tmp_dir):
    path = f"{tmp_dir}/plain"
    rows = frame(spark, [("a", None, 1.0, 2024), ("b", None, 1.0, 2025), ("x", None, 1.0, 2023)]).withColumn("s", F.lit("a/b ü=c"))
    rows.write.partitionBy("s", "y").parquet(path)
    tables.replace_where(spark, path, rows.where("k = 'a'").withColumn("k", F.lit("a2")), F.col("y") == 2024, ["s", "y"])
    tables.replace_where(spark, path, rows.limit(0), F.col("k") == "b", ["s", "y"], scope=[("a/b ü=c", 2025)])
    got = tables.read_table(spark, path)
    assert keys(got) == ["a2", "x"] and {r.s for r in got.collect()} == {"a/b ü=c"}
    versions.vacuum(spark, path, 1)
    assert keys(tables.read_table(spark, path)) == ["a2", "x"]


def test_of_two_writers_one_is_refused(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    tables.write_partitions(frame(spark, [("a", None, 1.0, 2024)]), path, ["y"])
    base = versions.current(spark, path)
    versions.publish(frame(spark, [("b", None, 1.0, 2025)]), path, base, ["y"], ())
    with pytest.raises(versions.ConcurrentChangeError):
        versions.publish(frame(spark, [("c", None, 1.0, 2025)]), path, base, ["y"], ())
    assert keys(tables.read_table(spark, path)) == ["a", "b"]


def test_new_rows_are_evaluated_once(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    tables.write_partitions(frame(spark, [("a", None, 1.0, 2024), ("b", None, 1.0, 2024)]), path, ["y"])
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    new = frame(spark, [("c", None, 1.0, 2024)]).mapInPandas(counted, SCHEMA)
    tables.replace_where(spark, path, new, F.col("k") == "a", ["y"])
    tables.replace_keys(spark, path, new, frame(spark, [("c", None, 1.0, 2024)]), "k", ["y"], [(2024,)])
    assert keys(tables.read_table(spark, path)) == ["b", "c"] and read.value == 2


def test_fingerprints_tell_contents_apart(spark):
    schema = "a string, b string, y int"
    make = lambda rows: spark.createDataFrame(rows, schema)
    base = [("x", None, 1), (None, "x", 2), ("p", "q", 3), ("p", "q", 3), ("", "", 4), (None, None, 5)]
    changed = lambda rows: sorted(r.y for r in tables.changed_partitions(make(base), make(rows), ["y"]).collect())
    assert changed(base[::-1]) == []
    assert changed([(None, "x", 1), *base[1:]]) == [1]            # a null in the other column
    assert changed([*base[:3], *base[4:]]) == [3]                 # a copy less
    assert changed([*base[:4], (None, "", 4), ("", None, 5)]) == [4, 5]
    assert changed([*base, ("new", None, 6)]) == [6]
    assert changed(base[1:]) == [1]
    got = tables.partitioned_diff(make(base), make(base[1:-1] + [("n", "n", 5)]), ["y"]).collect()
    assert sorted((r.y, r._side) for r in got) == [(1, "left_only"), (5, "left_only"), (5, "right_only")]


def test_version_diff_reads_changed_partitions_only(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    tables.write_partitions(frame(spark, [(k, None, 1.0, 2020 + i) for i, k in enumerate("abcdef")]), path, ["y"])
    tables.replace_where(spark, path, frame(spark, [("z", None, 1.0, 2021)]), F.col("y") == 2021, ["y"])
    diff = tables.version_diff(spark, path, 1, 2, ["y"])
    assert sorted((r.k, r._side) for r in diff.collect()) == [("b", "right_only"), ("z", "left_only")]
    assert all("/y=2021/" in f for f in diff.inputFiles())
    assert tables.version_diff(spark, path, 2, 2, ["y"]).count() == 0


def test_rows_of_a_later_slice_are_held_against_what_is_published(spark, tmp_dir):
    from samples import rows

    from vetrow.plans import layers

    later = {"_source_series": "glp"}
    bronze = rows(
        spark, {"_source_row": "a1"}, {"_source_row": "a2", "data_da_coleta": "10/03/2025"},
        {**later, "_source_row": "b1"}, {**later, "_source_row": "b2", "data_da_coleta": "10/03/2025", "valor_de_venda": "9,99"},
        {**later, "_source_row": "b3", "data_da_coleta": "11/03/2025"}, {**later, "_source_row": "b4", "valor_de_venda": "x"})
    tables.write_partitions(bronze, f"{tmp_dir}/b", layers.BRONZE_PARTITIONS)
    paths = (f"{tmp_dir}/b", f"{tmp_dir}/s", f"{tmp_dir}/q")
    for series in ("dsan", "glp", "glp", "dsan"):  # reruns do not hold a slice against itself
        layers.run_silver(spark, *paths, series=series, rules=[], now=dt.datetime(2025, 6, 2), keep_published=True)
    assert {r._source_row for r in tables.read_table(spark, paths[1]).collect()} == {"a1", "a2", "b3"}
    rejected = {r._source_row: (r._rejection_reasons, r._other_row) for r in tables.read_table(spark, paths[2]).collect()}
    assert rejected == {"b1": (["exact_duplicate"], "a1"), "b2": (["duplicate_key_conflict"], "a2"), "b4": (["sale_price_not_numeric"], None)}


def test_a_range_opens_the_files_that_meet_it_only(spark, tmp_dir):
    path = f"{tmp_dir}/t ü%20+"
    rows = frame(spark, [(f"k{i:03d}", dt.date(2024, 1, 1) + dt.timedelta(days=i), float(i), 2024 + (i >= 366)) for i in range(500)])
    tables.write_partitions(rows.repartitionByRange(10, "d"), path, ["y"])
    whole = tables.read_table(spark, path)
    span = (dt.date(2024, 3, 1), dt.date(2024, 3, 9))
    undescribed = versions.read_between(spark, path, "d", *span)
    versions.describe_files(spark, path, ["d", "k"])
    assert versions.describe_files(spark, path, ["d", "k"]) == 0  # folders are described once
    got = versions.read_between(spark, path, "d", *span)
    want = whole.where(F.col("d").between(*map(F.lit, span)))
    assert keys(got) == keys(want) == keys(undescribed) and got.count() == 9
    assert len(got.inputFiles()) <= 2 < len(whole.inputFiles())
    assert versions.read_between(spark, path, "k", "zzz", "zzzz").count() == 0
    tables.replace_where(spark, path, rows.where("k = 'k061'").withColumn("k", F.lit("new")), F.col("y") == 2024, ["y"])
    assert keys(versions.read_between(spark, path, "d", *span)) == ["new"]  # an undescribed folder is read whole


def test_a_range_of_a_plain_folder_that_was_taken_over(spark, tmp_dir):
    path = f"{tmp_dir}/plain"
    rows = frame(spark, [(f"k{i:02d}", dt.date(2024, 1, 1) + dt.timedelta(days=i), 1.0, 2023 + i % 2) for i in range(40)])
    rows.repartitionByRange(4, "d").write.partitionBy("y").parquet(path)
    tables.replace_where(spark, path, frame(spark, [("new", dt.date(2024, 1, 5), 1.0, 2024)]), F.col("k") == "k01", ["y"])
    for _ in range(2):  # before and after all folders are described
        got = versions.read_between(spark, path, "d", dt.date(2024, 1, 2), dt.date(2024, 1, 6))
        assert keys(got) == ["k02", "k03", "k04", "k05", "new"]
        versions.describe_files(spark, path, ["d"])


def test_partitioned_writes_keep_files_open_instead_of_sorting(spark, tmp_dir):
    conf = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(conf)
    with pytest.raises(ValueError):
        with versions.open_files(spark):
            assert int(spark.conf.get(conf)) == versions.OPEN_FILES
            raise ValueError
    assert spark.conf.get(conf) == before
    many = versions.OPEN_FILES + 5  # more partitions than files kept open
    rows = spark.range(0, 5_000, 1, 2).select("id", (F.col("id") % many).cast("int").alias("part"))
    tables.write_partitions(rows, f"{tmp_dir}/t", ["part"])
    back = tables.read_table(spark, f"{tmp_dir}/t")
    assert back.count() == 5_000 and back.groupBy("part").count().count() == many
    assert back.exceptAll(rows.select(*back.columns)).count() == 0
    held = versions.current(spark, f"{tmp_dir}/t").folders
    assert all(".zstd." in n for f in held for n in os.listdir(f"{tmp_dir}/t/{f}") if n.endswith(".parquet"))
