"""Small hand-made survey rows for operator tests."""

from __future__ import annotations

from vetrow.spec import LINEAGE_COLUMNS, RAW_COLUMNS, ROW_ID

# One valid row in the published shape (all strings).
VALID = {
    "regiao_sigla": "NE",
    "estado_sigla": "PE",
    "municipio": "RECIFE",
    "revenda": "POSTO EXEMPLO LTDA",
    "cnpj_da_revenda": " 12.345.678/0001-90",
    "nome_da_rua": "AV BOA VIAGEM",
    "numero_rua": "100",
    "complemento": "",
    "bairro": "BOA VIAGEM",
    "cep": "51020-000",
    "produto": "ETANOL",
    "data_da_coleta": "12/03/2025",
    "valor_de_venda": "4,79",
    "valor_de_compra": "",
    "unidade_de_medida": "R$ / litro",
    "bandeira": "BRANCA",
}

LINEAGE = {
    "_source_file": "dsan/all/2025/precos-etanol-03.csv",
    "_source_series": "dsan",
    "_source_year": 2025,
    "_source_encoding": "UTF-8",
    "_header_signature": "000000000000",
    "_ingested_at": None,
    "_ingestion_run_id": "test",
}

SCHEMA = ", ".join(
    [f"{c} string" for c in RAW_COLUMNS]
    + [
        "_source_file string", "_source_series string", "_source_year int", "_source_encoding string",
        "_header_signature string", "_ingested_at timestamp", "_ingestion_run_id string", f"{ROW_ID} string",
    ]
)


def rows(spark, *overrides):
    """One bronze row per override dict (applied on top of VALID), ids 1..n."""
    data = []
    for i, o in enumerate(overrides, start=1):
        r = {**VALID, **LINEAGE, ROW_ID: f"{i:04d}"}
        r.update(o)
        data.append(tuple(r[c] for c in (*RAW_COLUMNS, *LINEAGE_COLUMNS, ROW_ID)))
    return spark.createDataFrame(data, SCHEMA)
