import datetime
import os

import pytest
from pyspark.sql import functions as F

from vetrow.operators import tables
from vetrow.plans import layers
from vetrow.sources import audit as au
from vetrow.sources import raw as rw
from vetrow.spec import RAW_COLUMNS

HEADER = ";".join(rw.PUBLISHED_HEADER)
ROW1 = 'NE;BA;SALVADOR;POSTO UM;" 40.511.529/0002-75";RUA A;1;": LOTE;";CENTRO;41270-000;GASOLINA;10/05/2004;1,88;1,7231;R$ / litro;MARCA'
ROW2 = "SE;RJ;NITEROI;POSTO DOIS; 29.244.142/0001-86;RUA B;2;;ICARAÍ;24230-151;ETANOL;10/05/2004;1,199;;R$ / litro;MARCA"


def write(path, text, encoding="utf-8", bom=False, crlf=True):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    nl = "\r\n" if crlf else "\n"
    data = ("\ufeff" if bom else "") + nl.join(text) + nl
    with open(path, "wb") as fh:
        fh.write(data.encode(encoding))


def load(spark, root, charset_of=None):
    files = rw.with_headers(rw.audit_files(spark, root))
    for key, charset in (charset_of or {}).items():
        files = files.withColumn("encoding", F.when(F.col("raw_key") == key, F.lit(charset)).otherwise(F.col("encoding")))
    return files, rw.read_rows(spark, files, run_id="r1", ingested_at=datetime.datetime(2025, 1, 1))


def test_fold_and_signature():
    assert rw.fold("\ufeffRegião - Sigla") == "regiao_sigla"
    assert rw.fold("CNPJ da Revenda") == "cnpj_da_revenda"
    assert rw.fold("  Valor de Venda ") == "valor_de_venda"
    assert [rw.fold(h) for h in rw.PUBLISHED_HEADER] == list(RAW_COLUMNS)
    assert len(rw.header_signature(["a", "b"])) == 12
    assert rw.header_signature(["a", "b"]) != rw.header_signature(["a", "b", "c"])


def test_header_cells_may_be_quoted():
    assert rw.split_header('a;"b; c";"d ""e"""') == ["a", "b; c", 'd "e"']
    assert rw.split_header("") == []


def test_scan_bom_crlf_quotes_blanks(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    write(f"{root}/dsan/all/2004/precos-01.csv", [HEADER, ROW1, ROW2], bom=True)
    _, df = load(spark, root)
    rows = {r.municipio: r for r in df.collect()}
    assert set(rows) == {"SALVADOR", "NITEROI"}
    assert rows["SALVADOR"].complemento == ": LOTE;"  # quoted delimiter kept
    assert rows["SALVADOR"].bandeira == "MARCA"  # no trailing CR
    assert rows["NITEROI"].valor_de_compra is None and rows["NITEROI"].complemento is None
    assert rows["NITEROI"].cnpj_da_revenda == " 29.244.142/0001-86"
    assert rows["NITEROI"].bairro == "ICARAÍ"
    assert all(t.simpleString() == "string" for t in [f.dataType for f in df.schema.fields if f.name in rw.RAW_COLUMNS])
    r = rows["SALVADOR"]
    assert (r._source_file, r._source_series, r._source_year, r._source_encoding) == ("dsan/all/2004/precos-01.csv", "dsan", 2004, "UTF-8")
    assert r._header_signature == rw.header_signature(list(rw.RAW_COLUMNS))


def test_latin1_both_ways(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    write(f"{root}/dsas/ca/2021/ca-2021-02.csv", [HEADER, ROW2], encoding="latin-1")
    files, right = load(spark, root)
    assert [r.encoding for r in files.collect()] == ["ISO-8859-1"]  # found by reading every line
    assert right.first().bairro == "ICARAÍ"
    _, wrong = load(spark, root, {"dsas/ca/2021/ca-2021-02.csv": "UTF-8"})
    assert wrong.first().bairro != "ICARAÍ"  # wrong charset mangles, never raises


def test_missing_column_raises(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    write(f"{root}/dsan/all/2004/bad.csv", [HEADER.replace(";Bandeira", ""), "x"])
    with pytest.raises(rw.UnexpectedHeaderError, match="bandeira"):
        load(spark, root)


def test_extra_column_changes_signature_only(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    write(f"{root}/dsan/all/2004/a.csv", [HEADER, ROW2])
    write(f"{root}/dsan/all/2005/b.csv", [HEADER + ";Extra", ROW2 + ";z"])
    _, df = load(spark, root)
    assert df.select("_header_signature").distinct().count() == 2
    assert "extra" not in df.columns


def test_same_filename_in_two_years_keeps_both(spark, tmp_dir):
    from vetrow.operators import tables

    root = f"{tmp_dir}/raw"
    write(f"{root}/dsan/all/2023/precos-glp-01.csv", [HEADER, ROW2])
    write(f"{root}/dsan/all/2024/precos-glp-01.csv", [HEADER, ROW1])
    _, df = load(spark, root)
    bronze = f"{tmp_dir}/bronze"
    tables.replace_where(spark, bronze, df, F.col("_source_file").isin(["dsan/all/2023/precos-glp-01.csv", "dsan/all/2024/precos-glp-01.csv"]),
                         ["_source_series", "_source_year"])
    # reload only the 2024 file: the 2023 rows must survive
    only = df.filter(F.col("_source_file") == "dsan/all/2024/precos-glp-01.csv")
    tables.replace_where(spark, bronze, only, F.col("_source_file") == "dsan/all/2024/precos-glp-01.csv", ["_source_series", "_source_year"])
    got = sorted(r._source_file for r in tables.read_table(spark, bronze).collect())
    assert got == ["dsan/all/2023/precos-glp-01.csv", "dsan/all/2024/precos-glp-01.csv"]


def test_stamp_lineage_projects_and_signs(spark):
    import datetime

    cols = list(rw.RAW_COLUMNS) + ["extra"]
    frame = spark.createDataFrame([tuple(["x"] * len(cols))], ", ".join(f"{c} string" for c in cols))
    out = rw.stamp_lineage(frame, source_file="dsan/all/2024/a.csv", series="dsan", year=2024, encoding="UTF-8",
                           run_id="r", ingested_at=datetime.datetime(2024, 5, 1))
    row = out.first()
    assert "extra" not in out.columns and len(out.columns) == 24
    assert row._source_row.startswith("dsan/all/2024/a.csv:")
    assert row._header_signature == rw.header_signature(cols)  # extras count in the signature
    assert row._ingested_at == datetime.datetime(2024, 5, 1) and row._source_year == 2024


def test_paths_with_blanks_accents_and_repeated_root_names(spark, tmp_dir):
    """Every file arrives, under a key that does not depend on what the root or its parents are called."""
    root = f"{tmp_dir}/lake/E/lake"
    write(f"{root}/dsan/all/2004/preços 01+a%20.csv", [HEADER, ROW1, ROW2])
    write(f"{root}/dsan/all/2004/precos-02.csv", [HEADER, ROW2])
    write(f"{root}/solto.csv", [HEADER, ROW2])  # directly under the root
    _, df = load(spark, root)
    got = sorted((r._source_file, r._source_series, r._source_year) for r in df.collect())
    assert got == [("dsan/all/2004/precos-02.csv", "dsan", 2004), ("dsan/all/2004/preços 01+a%20.csv", "dsan", 2004),
                   ("dsan/all/2004/preços 01+a%20.csv", "dsan", 2004), ("solto.csv", "solto.csv", None)]
    assert df.select("_source_row").distinct().count() == 4


def test_quoted_header_gets_a_verdict(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    quoted = ";".join(f'"{h}"' for h in rw.PUBLISHED_HEADER)
    write(f"{root}/dsan/all/2004/a.csv", [quoted + ';"Nota; livre"', ROW2 + ";x"])
    write(f"{root}/dsan/all/2005/b.csv", [quoted.replace(';"Bandeira"', ""), "x"])
    got = {r.raw_key: r for r in rw.with_headers(rw.audit_files(spark, root)).collect()}
    good, bad = got["dsan/all/2004/a.csv"], got["dsan/all/2005/b.csv"]
    assert (good.status, good.columns, good.signature) == ("ok", 17, rw.header_signature([*RAW_COLUMNS, "nota_livre"]))
    assert (bad.status, bad.missing) == ("missing_columns", "bandeira")
    rows = rw.read_rows(spark, spark.createDataFrame([good]), run_id="r", ingested_at=datetime.datetime(2025, 1, 1)).collect()
    assert [r.bandeira for r in rows] == ["MARCA"]


def test_refused_files_stay_out_and_are_reported(spark, tmp_dir):
    root, bronze = f"{tmp_dir}/raw", f"{tmp_dir}/bronze"
    write(f"{root}/dsan/all/2004/good.csv", ["", "  ", HEADER, ROW1, "", ROW2])  # blank lines are no records
    write(f"{root}/dsan/all/2004/page.csv", ["<html>", "erro;"])
    write(f"{root}/dsan/all/2005/empty.csv", ["", "  "])  # nothing but blanks
    got = {r._source_file: r.rows for r in layers.run_bronze(spark, root, bronze).collect()}
    assert got == {"dsan/all/2004/good.csv": 2, "dsan/all/2004/page.csv": None, "dsan/all/2005/empty.csv": None}
    assert tables.read_table(spark, bronze).count() == 2
    verdicts = {r.raw_key: r.verdict for r in layers.audit_raw(spark, root).collect()}
    assert verdicts == {"dsan/all/2004/good.csv": au.OK, "dsan/all/2004/page.csv": au.HTML_PAGE, "dsan/all/2005/empty.csv": au.NO_DELIMITER}


def test_file_without_audit_row_is_an_error(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    write(f"{root}/dsan/all/2004/a.csv", [HEADER, ROW1])
    audited = spark.createDataFrame(layers.audit_raw(spark, root).collect())
    write(f"{root}/dsan/all/2004/b.csv", [HEADER, ROW2])
    with pytest.raises(rw.UnauditedFileError, match="b.csv"):
        layers.run_bronze(spark, root, f"{tmp_dir}/bronze", audited=audited)
    assert layers.run_bronze(spark, root, f"{tmp_dir}/bronze", audited=audited, raw_keys=["dsan/all/2004/a.csv"]).first().rows == 1


def test_copies_loaded_by_two_runs_are_found(spark, tmp_dir):
    root, bronze = f"{tmp_dir}/raw", f"{tmp_dir}/bronze"
    write(f"{root}/dsan/all/2004/a.csv", [HEADER, ROW1])
    layers.run_bronze(spark, root, bronze)
    write(f"{root}/dsan/all/2004/b.csv", [HEADER, ROW1])
    layers.run_bronze(spark, root, bronze, raw_keys=["dsan/all/2004/b.csv"])
    out = layers.evaluate_once(tables.read_table(spark, bronze))
    assert sorted(r[0] for r in out.select(F.array_join("_rejection_reasons", ",")).collect()) == ["", "exact_duplicate"]


def test_listing_and_plan_do_not_grow_with_the_files(spark, tmp_dir):
    """One scan whatever the number of files, and no list of them in its plan."""
    root = f"{tmp_dir}/raw"
    for i in range(12):
        write(f"{root}/dsan/all/2004/p{i:02d}.csv", [HEADER, ROW1 if i % 2 else ROW2])
    _, df = load(spark, root)
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "p07.csv" not in plan and "Union" not in plan
    assert df.count() == 12


def test_digests(spark, tmp_dir):
    import hashlib

    root = f"{tmp_dir}/raw"
    write(f"{root}/dsan/all/2004/a b.csv", [HEADER, ROW1])
    with open(f"{root}/dsan/all/2004/a b.csv", "rb") as fh:
        want = hashlib.sha256(fh.read()).hexdigest()
    files = rw.list_files(spark, root).join(rw.file_digests(spark, root), "path").collect()
    assert [(r.raw_key, r.sha256) for r in files] == [("dsan/all/2004/a b.csv", want)]


def payloads(seed=11):
    """Files whose verdict hangs on bytes behind their first line: pages that begin late, blanks, marks, long lines."""
    import random

    rng = random.Random(seed)
    out = {}
    for i in range(45):
        lead = rng.choice(["", "\n\n \n", "﻿", "﻿ \n", " " * 300 + "\n"])
        body = [rng.choice(["a;b", "c", "", " ", "x;" * rng.randint(1, 130)]) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.6:
            body.insert(min(len(body), rng.randint(0, 25)), rng.choice(["<HTML>", "  <html lang=pt>", "z" * 40 + "<Html"]))
        out[f"f{i:02d}.csv"] = (lead + "\n".join(["h1;h2", *body] if rng.random() < 0.8 else body) + rng.choice(["", "\n"])).encode()
    out["page2.csv"] = b"status;404\n<html>"
    return {k: v for k, v in out.items() if v}


@pytest.mark.parametrize("block", ["128m", "64"])
def test_verdicts_by_lines_equal_those_by_whole_payloads(spark, tmp_dir, block):
    root = f"{tmp_dir}/raw"
    os.makedirs(f"{root}/dsan/all/2004")
    for name, payload in payloads().items():
        with open(f"{root}/dsan/all/2004/{name}", "wb") as f:
            f.write(payload)
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "0" if block == "64" else "4m")
    try:
        got = {r.raw_key: r.verdict for r in rw.audit_files(spark, root).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    whole = spark.createDataFrame([(f"dsan/all/2004/{k}", bytearray(v), "csv") for k, v in payloads().items()], "raw_key string, content binary, content_type string")
    want = {r.raw_key: r.verdict for r in au.audit(whole).collect()}
    assert got == want and len(set(want.values())) == 3


def test_pages_neither_stop_a_load_nor_count_as_headers(spark, tmp_dir, monkeypatch):
    root, bronze = f"{tmp_dir}/raw", f"{tmp_dir}/bronze"
    write(f"{root}/dsan/all/2004/good.csv", [HEADER, ROW1])
    for i in range(4):
        write(f"{root}/dsan/all/2004/page{i}.csv", [f"status;{i}", "<html>"])
    write(f"{root}/dsan/all/2004/long.csv", ["a;" + "b" * 3 * rw.MAX_HEADER_BYTES])
    monkeypatch.setattr(rw, "MAX_HEADERS", 2)
    got = {r._source_file: r.rows for r in layers.run_bronze(spark, root, bronze).collect()}
    assert got.pop("dsan/all/2004/good.csv") == 1 and set(got.values()) == {None} and len(got) == 5
    verdicts = {r.raw_key: r.verdict for r in rw.audit_files(spark, root).collect()}
    assert verdicts["dsan/all/2004/long.csv"] == au.NO_HEADER and verdicts["dsan/all/2004/page0.csv"] == au.HTML_PAGE


def test_a_load_scans_the_text_once(spark, tmp_dir, monkeypatch):
    root, bronze = f"{tmp_dir}/raw", f"{tmp_dir}/bronze"
    write(f"{root}/dsan/all/2004/good.csv", [HEADER, ROW1])
    layers.run_bronze(spark, root, bronze)
    scans = []
    real = rw.raw_lines
    monkeypatch.setattr(rw, "raw_lines", lambda *a, **k: scans.append(1) or real(*a, **k))
    layers.run_bronze(spark, root, bronze)
    assert len(scans) == 1 and tables.read_table(spark, bronze).count() == 1


def test_digests_of_files_beyond_one_value(spark, tmp_dir):
    import hashlib

    root = f"{tmp_dir}/raw"
    os.makedirs(root)
    contents = {**payloads(), "one.csv": b"\n", "crlf.csv": b"a;b\r\n\r\nc\r", "bytes.csv": bytes(range(256)) * 9, "mark.csv": b"\xef\xbb\xbf",
                "mark2.csv": b"\xef\xbb\xbf\n", "marks.csv": b"\xef\xbb\xbf\xef\xbb\xbfx"}
    for name, payload in contents.items():
        with open(f"{root}/{name}", "wb") as f:
            f.write(payload)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        got = {r.path.rpartition("/")[2]: r.sha256 for r in rw.file_digests(spark, root, whole_below=1).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {k: hashlib.sha256(v).hexdigest() for k, v in contents.items()}


def test_lines_are_not_shuffled_to_meet_the_listing(spark, tmp_path, monkeypatch):
    """The listing counts by its own size, not by that of the files' content."""
    folder = tmp_path / "dsan" / "all" / "2024"
    folder.mkdir(parents=True)
    for i in range(2):
        (folder / f"f{i}.csv").write_text("a;b\n" + "x;y\n" * 50_000)
    plans = {}
    plain = rw.materialize

    def noted(df, name="table", *args, **kwargs):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, name, *args, **kwargs)

    monkeypatch.setattr(rw, "materialize", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100000")
    try:
        lines = rw.stage_lines(spark, rw.list_files(spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert lines.count() == 100_002
    assert "BroadcastHashJoin" in plans["lines"] and "SortMergeJoin" not in plans["lines"]
