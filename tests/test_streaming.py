import os

from test_raw import HEADER, ROW1, ROW2, write
from vetrow.operators import tables
from vetrow.operators import tables
from vetrow.streaming.ingest import ingest_batch, start_raw_ingest


def test_stream_picks_up_new_files_once(spark, tmp_dir):
    root, bronze, audit, ckpt = (f"{tmp_dir}/{n}" for n in ("raw", "bronze", "audit", "ckpt"))
    write(f"{root}/dsan/all/2004/precos-01.csv", [HEADER, ROW1, ROW2])
    q = start_raw_ingest(spark, root, bronze, audit, checkpoint=ckpt)
    q.awaitTermination(300)
    assert tables.read_table(spark, bronze).count() == 2
    # a new file lands; the old one is not read again
    write(f"{root}/dsan/all/2005/precos-01.csv", [HEADER, ROW2])
    with open(f"{root}/dsan/all/2005/erro.csv", "w") as fh:
        fh.write("<html><body>erro</body></html>\n")
    q = start_raw_ingest(spark, root, bronze, audit, checkpoint=ckpt)
    q.awaitTermination(300)
    assert tables.read_table(spark, bronze).count() == 3
    audited = tables.read_table(spark, audit)
    assert audited.count() == 3
    assert audited.filter("verdict != 'ok'").count() == 1  # the error page was refused, not loaded


def test_replayed_batch_changes_nothing(spark, tmp_dir):
    """The same epoch twice, then again under another number: rows and audit rows stay as they were."""
    root, bronze, audit = (f"{tmp_dir}/{n}" for n in ("raw", "bronze", "audit"))
    write(f"{root}/dsan/all/2004/precos 01.csv", [HEADER, ROW1, ROW2])
    write(f"{root}/dsan/all/2005/precos-01.csv", [HEADER, ROW2])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    handle = ingest_batch(spark, root, bronze, audit)
    for epoch in (0, 0, 7):
        handle(files, epoch)
        assert tables.read_table(spark, bronze).count() == 3
        assert tables.read_table(spark, audit).count() == 2
    assert tables.read_table(spark, bronze).select("_source_row").distinct().count() == 3
