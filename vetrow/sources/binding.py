"""Raw survey rows derived from the shared tables (FIXTURES.md section 3).

``lineitem`` joined to ``supplier`` gives one raw, all-string survey row per line
item. A defect bucket ``b`` plants each kind of bad value in about 0.1 % of the
rows, and bucket 500 is emitted twice to make exact copies. The natural key
(reseller, product, date) repeats on its own, which gives the conflicts.

The join is a plain equi-join: Spark broadcasts ``supplier`` only while its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and falls back
to a sort-merge join beyond it, so the plan holds at any scale factor.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrow.spec import LINEAGE_COLUMNS, RAW_COLUMNS, ROW_ID

# Fixed values of the binding (FIXTURES.md section 3).
STATE_BY_NATION_MOD5 = ("SP", "RJ", "BA", "PR", "AM")
REGION_OF_STATE = {"SP": "SE", "RJ": "SE", "BA": "NE", "PR": "S", "AM": "N"}
INGESTED_AT = "2010-01-01 00:00:00"
RUN_ID = "binding"
ENCODING = "UTF-8"


def header_signature_of(names) -> str:
    return hashlib.sha256("|".join(names).encode()).hexdigest()[:12]


BINDING_SIGNATURE = header_signature_of(RAW_COLUMNS)


def _pick(index: Column, values) -> Column:
    """values[index] as a CASE chain (index is 0-based)."""
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def _defect(b: Column, normal: Column, defects: dict[int, object]) -> Column:
    expr = None
    for bucket, value in defects.items():
        lit = F.lit(None).cast("string") if value is None else F.lit(value)
        expr = F.when(b == bucket, lit) if expr is None else expr.when(b == bucket, lit)
    return expr.otherwise(normal)


def survey_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped raw rows: 16 strings, 7 lineage columns and the row id."""
    li = (spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_shipdate",
    ))
    su = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name", "s_nationkey")
    rows = li.join(su, li.l_suppkey == su.s_suppkey)

    b = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 1000
    u = F.lit(30000) + F.round(F.col("l_extendedprice") * 100).cast("bigint") % 50000
    rows = rows.select(
        "*",
        b.alias("_b"),
        u.alias("_u"),
        (F.col("l_partkey") % 16).alias("_pk"),
        (F.col("s_nationkey") % 5).alias("_nat"),
        F.year("l_shipdate").alias("_year"),
    )
    # Exact copies: bucket 500 comes out twice. explode keeps it a narrow step.
    rows = rows.withColumn(
        "_copy", F.explode(F.when(F.col("_b") == 500, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    )

    b, pk, nat = F.col("_b"), F.col("_pk"), F.col("_nat")
    u = F.col("_u")
    state = _pick(nat, STATE_BY_NATION_MOD5)
    region = _pick(nat, [REGION_OF_STATE[s] for s in STATE_BY_NATION_MOD5])
    product = (
        F.when(pk <= 8, F.lit("GASOLINA"))
        .when(pk <= 12, F.lit("ETANOL"))
        .when(pk <= 14, F.lit("GNV"))
        .otherwise(F.lit("GLP"))
    )
    unit = (
        F.when(pk == 15, F.lit("R$ / 13 kg"))
        .when(pk >= 13, F.lit("R$ / m³"))
        .otherwise(F.lit("R$ / litro"))
    )
    sale = F.concat(
        F.floor(u / 10000).cast("bigint").cast("string"),
        F.lit(","),
        F.lpad((u % 10000).cast("string"), 4, "0"),
    )
    purchase = F.when(
        (F.col("_year") >= 1999) | (F.col("l_linenumber") % 2 == 0), F.lit(None).cast("string")
    ).otherwise(F.concat(F.floor(u * 0.8 / 10000).cast("bigint").cast("string"), F.lit(",00")))
    brand = F.when(F.col("l_returnflag") == "R", F.lit("BRANCA")).otherwise(
        F.concat(F.lit("MARCA "), F.col("l_returnflag"))
    )
    cnpj = F.concat(F.lit(" "), F.lpad(F.col("l_suppkey").cast("string"), 14, "0"))

    raw = {
        "regiao_sigla": _defect(b, region, {16: "ZZ", 17: None}),
        "estado_sigla": _defect(b, state, {1: "XX", 20: "XX"}),
        "municipio": _defect(b, F.col("s_name"), {18: "  "}),
        "revenda": F.concat(F.lit("REVENDA "), F.col("l_suppkey").cast("string")),
        "cnpj_da_revenda": _defect(b, cnpj, {2: "123", 3: None}),
        "nome_da_rua": F.concat(F.lit("RUA "), F.col("l_partkey").cast("string")),
        "numero_rua": F.col("l_linenumber").cast("string"),
        "complemento": F.lit(None).cast("string"),
        "bairro": F.concat(F.lit("BAIRRO "), (F.col("l_orderkey") % 97).cast("string")),
        "cep": F.concat(F.lpad((F.col("l_partkey") % 100000).cast("string"), 5, "0"), F.lit("-000")),
        "produto": _defect(b, product, {4: None, 5: "XPTO"}),
        "data_da_coleta": _defect(
            b, F.date_format("l_shipdate", "dd/MM/yyyy"), {6: None, 7: "31/02/2000", 8: "01/01/1980"}
        ),
        "valor_de_venda": _defect(b, sale, {9: None, 10: "ABC", 11: "-1,00", 20: "-3,00"}),
        "valor_de_compra": _defect(b, purchase, {12: "nope", 13: "0,00"}),
        "unidade_de_medida": _defect(b, unit, {14: None, 15: "R$ / barril"}),
        "bandeira": _defect(b, brand, {19: None}),
    }
    lineage = {
        "_source_file": F.concat(F.lit("dsan/all/"), F.col("_year").cast("string"), F.lit("/precos.csv")),
        "_source_series": F.lit("dsan"),
        "_source_year": F.col("_year").cast("int"),
        "_source_encoding": F.lit(ENCODING),
        "_header_signature": F.lit(BINDING_SIGNATURE),
        "_ingested_at": F.lit(INGESTED_AT).cast("timestamp_ntz"),  # same wall time in any session zone
        "_ingestion_run_id": F.lit(RUN_ID),
    }
    # The line item's own fields are unique per row in every scale factor, and
    # the copy number separates the planted twins: an id that needs no sort.
    row_id = F.concat_ws(
        "-",
        F.col("l_orderkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
        F.date_format("l_shipdate", "yyyyMMdd"),
        F.col("l_returnflag"),
        F.col("_copy").cast("string"),
    )
    return rows.select(
        *[raw[c].alias(c) for c in RAW_COLUMNS],
        *[lineage[c].alias(c) for c in LINEAGE_COLUMNS],
        row_id.alias(ROW_ID),
    )


# --- published file names, one per order (FIXTURES.md section 3, "file-name
# classification"): the order picks one of the name shapes the publisher uses,
# its date gives year / month / semester, its key goes into the host name so
# every URL is distinct.
NAME_SHAPES = 12
GROUP_BY_KEY_MOD3 = ("gasolina-etanol", "diesel-gnv", "glp")


def published_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate")
    y = F.year("o_orderdate").cast("string")
    m = F.lpad(F.month("o_orderdate").cast("string"), 2, "0")
    s = F.when(F.month("o_orderdate") <= 6, F.lit("01")).otherwise(F.lit("02"))
    g = _pick(F.col("o_orderkey") % 3, GROUP_BY_KEY_MOD3)
    base = F.concat(F.lit("https://h"), F.col("o_orderkey").cast("string"), F.lit(".example.gov/arquivos/shpc/"))
    shape = F.col("o_orderkey") % NAME_SHAPES
    dsan = F.concat(base, F.lit("dsan/"), y, F.lit("/"))
    shapes = [
        F.concat(dsan, F.lit("precos-"), g, F.lit("-"), m, F.lit(".csv")),
        F.concat(dsan, m, F.lit("-dados-abertos-precos-"), g, F.lit(".csv")),
        F.concat(dsan, m, F.lit("-cados-abertos-preco-"), g, F.lit(".csv")),
        F.concat(dsan, m, F.lit("-dados-abertos-precos-"), y, F.lit("-"), m, F.lit("-"), g, F.lit(".csv")),
        F.concat(base, F.lit("dsas/ca/ca-"), y, F.lit("-"), s, F.lit(".csv")),
        F.concat(base, F.lit("dsas/ca/ca-"), y, F.lit("-"), s, F.lit(".zip")),
        F.concat(base, F.lit("dsas/glp/precos-semestrais-glp-"), y, F.lit("-"), s, F.lit(".csv")),
        F.concat(base, F.lit("dsas/glp/precos-semestrais-glp"), y, F.lit("-"), s, F.lit(".csv")),
        F.concat(base, F.lit("qus/ultimas-4-semanas-"), g, F.lit(".csv")),
        F.concat(base, F.lit("outros/relatorio-"), y, F.lit(".csv")),
        F.concat(dsan, F.lit("precos-"), g, F.lit(".csv")),
        F.concat(dsan, F.lit("precos-"), g, F.lit("-"), m, F.lit(".CSV")),
    ]
    url = None
    for i, expr in enumerate(shapes):
        url = F.when(shape == i, expr) if url is None else url.when(shape == i, expr)
    return o.select(F.year("o_orderdate").alias("order_year"), url.alias("url"))
