"""Declarative description of a survey file: its columns, domains and contract.

Everything a run needs to judge a row lives in one ``ContractSpec`` value, so the
published survey and the shared test tables are two specs over the same code.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date

# ---------------------------------------------------------------------------
# Fixed values. These must equal the published survey's for results to match:
# column names of the raw files, lineage names, domains, formats and thresholds.
# ---------------------------------------------------------------------------

RAW_COLUMNS = (
    "regiao_sigla",
    "estado_sigla",
    "municipio",
    "revenda",
    "cnpj_da_revenda",
    "nome_da_rua",
    "numero_rua",
    "complemento",
    "bairro",
    "cep",
    "produto",
    "data_da_coleta",
    "valor_de_venda",
    "valor_de_compra",
    "unidade_de_medida",
    "bandeira",
)

LINEAGE_COLUMNS = (
    "_source_file",
    "_source_series",
    "_source_year",
    "_source_encoding",
    "_header_signature",
    "_ingested_at",
    "_ingestion_run_id",
)

PRODUCTS = (
    "DIESEL",
    "DIESEL S10",
    "DIESEL S50",
    "ETANOL",
    "GASOLINA",
    "GASOLINA ADITIVADA",
    "GLP",
    "GNV",
)

UNITS = ("R$ / litro", "R$ / m³", "R$ / 13 kg")

REGIONS = ("N", "NE", "CO", "SE", "S")

STATES = (
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA",
    "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
)

PRICE_TYPE = "decimal(9,4)"
DATE_FORMAT = "dd/MM/yyyy"
SERIES_START = date(2004, 1, 1)

NATURAL_KEY = ("reseller_cnpj", "product", "collection_date")

# Gold thresholds.
LOW_SAMPLE_BELOW = 10
RELIABLE_FROM = 0.5
PERCENTILE_ACCURACY = 1000

DUPLICATE_CONFLICT = "duplicate_key_conflict"
EXACT_DUPLICATE = "exact_duplicate"

# Column (string) that identifies a bronze row physically: ingestion stamps it
# once (raw key of the file + place in it) and it is stored with the row. It
# lets the duplicate check keep exactly one copy of byte-identical rows without
# ordering a whole key inside one task.
ROW_ID = "_source_row"


@dataclass(frozen=True)
class Field:
    """One typed column of a survey row: the raw column it reads, how it is read,
    and what the contract asks of it. ``stem`` begins its reasons."""

    name: str
    source: str
    read_as: str = "text"            # text, code (upper case), digits, date, price
    stem: str = ""
    required: bool = False           # blank: <stem>_missing
    length: int | None = None        # any other: <stem>_invalid
    domain: str | None = None        # attribute of the spec; outside of it, or NULL: unknown_<stem>
    identity: bool = True            # part of what makes two rows of a key the same observation


# The contract, column by column. Order is the report order of each kind's columns.
FIELDS = (
    Field("region", "regiao_sigla", stem="region", domain="regions"),
    Field("state", "estado_sigla", "code", stem="state", domain="states"),
    Field("municipality", "municipio", stem="municipality", required=True),
    Field("reseller_name", "revenda"),
    Field("reseller_cnpj", "cnpj_da_revenda", "digits", stem="cnpj", length=14),
    Field("product", "produto", stem="product", domain="products"),
    Field("collection_date", "data_da_coleta", "date", stem="collection_date", required=True),
    Field("sale_price", "valor_de_venda", "price", stem="sale_price", required=True),
    Field("purchase_price", "valor_de_compra", "price", stem="purchase_price"),
    Field("unit", "unidade_de_medida", stem="unit", domain="units"),
    Field("brand", "bandeira", stem="brand", required=True),
)
# The order in which the fields' reasons are reported.
REPORT_ORDER = ("collection_date", "reseller_cnpj", "product", "unit", "state", "region", "municipality", "brand",
                "sale_price", "purchase_price")
WEEK_COLUMN = "collection_week"

# Typed columns that decide whether two rows of one key are the same observation.
FINGERPRINT = tuple(f.name for f in FIELDS if f.identity)
# Accepted rows carry the typed columns, the week after its date (plus lineage).
ACCEPTED_TYPED = tuple(c for f in FIELDS for c in ((f.name, WEEK_COLUMN) if f.read_as == "date" else (f.name,)))


@dataclass(frozen=True)
class ContractSpec:
    """What a valid row looks like. ``as_of`` None means the run date."""

    products: tuple[str, ...] = PRODUCTS
    units: tuple[str, ...] = UNITS
    regions: tuple[str, ...] = REGIONS
    states: tuple[str, ...] = STATES
    date_format: str = DATE_FORMAT
    series_start: date = SERIES_START
    as_of: date | None = None
    price_type: str = PRICE_TYPE
    fields: tuple[Field, ...] = FIELDS
    report_order: tuple[str, ...] = REPORT_ORDER
    natural_key: tuple[str, ...] = NATURAL_KEY
    fingerprint: tuple[str, ...] = FINGERPRINT
    row_id: str = ROW_ID
    lineage: tuple[str, ...] = field(default=LINEAGE_COLUMNS)

    def with_dates(self, start: date, as_of: date | None) -> ContractSpec:
        return replace(self, series_start=start, as_of=as_of)


SURVEY = ContractSpec()

# The shared test tables (FIXTURES.md section 3): same domains, ship dates from
# 1995 on, judged as of 2010-01-01 so results do not depend on the run date.
BINDING = SURVEY.with_dates(date(1995, 1, 1), date(2010, 1, 1))
