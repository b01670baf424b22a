"""ANSI SQL (DuckDB dialect) equivalents of the registered queries.

They run on the shared tables only (``lineitem``, ``supplier``, ``orders``,
``pages``, ``documents`` ...), independently of the Spark code, and are what
the driver compares our DataFrames against.
"""

from __future__ import annotations

from vetrow.sources.binding import BINDING_SIGNATURE, INGESTED_AT, RUN_ID
from vetrow.spec import BINDING, FINGERPRINT, LOW_SAMPLE_BELOW, RELIABLE_FROM

_IN = lambda values: "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '')"


RAW_CTE = f"""
li AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_extendedprice,
         l.l_returnflag, l.l_shipdate, s.s_name, s.s_nationkey,
         (l.l_orderkey * 7 + l.l_linenumber) % 1000 AS b,
         30000 + CAST(round(l.l_extendedprice * 100) AS BIGINT) % 50000 AS u,
         l.l_partkey % 16 AS pk,
         s.s_nationkey % 5 AS nat,
         CAST(year(l.l_shipdate) AS INTEGER) AS yr
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
cp AS (
  SELECT *, 1 AS copy_no FROM li
  UNION ALL
  SELECT *, 2 AS copy_no FROM li WHERE b = 500
),
raw AS (
  SELECT
    CASE WHEN b = 16 THEN 'ZZ' WHEN b = 17 THEN NULL
         ELSE CASE nat WHEN 0 THEN 'SE' WHEN 1 THEN 'SE' WHEN 2 THEN 'NE' WHEN 3 THEN 'S' ELSE 'N' END END AS regiao_sigla,
    CASE WHEN b IN (1, 20) THEN 'XX'
         ELSE CASE nat WHEN 0 THEN 'SP' WHEN 1 THEN 'RJ' WHEN 2 THEN 'BA' WHEN 3 THEN 'PR' ELSE 'AM' END END AS estado_sigla,
    CASE WHEN b = 18 THEN '  ' ELSE s_name END AS municipio,
    'REVENDA ' || CAST(l_suppkey AS VARCHAR) AS revenda,
    CASE WHEN b = 2 THEN '123' WHEN b = 3 THEN NULL
         ELSE ' ' || lpad(CAST(l_suppkey AS VARCHAR), 14, '0') END AS cnpj_da_revenda,
    'RUA ' || CAST(l_partkey AS VARCHAR) AS nome_da_rua,
    CAST(l_linenumber AS VARCHAR) AS numero_rua,
    CAST(NULL AS VARCHAR) AS complemento,
    'BAIRRO ' || CAST(l_orderkey % 97 AS VARCHAR) AS bairro,
    lpad(CAST(l_partkey % 100000 AS VARCHAR), 5, '0') || '-000' AS cep,
    CASE WHEN b = 4 THEN NULL WHEN b = 5 THEN 'XPTO'
         WHEN pk <= 8 THEN 'GASOLINA' WHEN pk <= 12 THEN 'ETANOL' WHEN pk <= 14 THEN 'GNV' ELSE 'GLP' END AS produto,
    CASE WHEN b = 6 THEN NULL WHEN b = 7 THEN '31/02/2000' WHEN b = 8 THEN '01/01/1980'
         ELSE strftime(l_shipdate, '%d/%m/%Y') END AS data_da_coleta,
    CASE WHEN b = 9 THEN NULL WHEN b = 10 THEN 'ABC' WHEN b = 11 THEN '-1,00' WHEN b = 20 THEN '-3,00'
         ELSE CAST(CAST(floor(u / 10000) AS BIGINT) AS VARCHAR) || ',' || lpad(CAST(u % 10000 AS VARCHAR), 4, '0') END AS valor_de_venda,
    CASE WHEN b = 12 THEN 'nope' WHEN b = 13 THEN '0,00'
         WHEN yr >= 1999 OR l_linenumber % 2 = 0 THEN NULL
         ELSE CAST(CAST(floor(u * CAST(0.8 AS DOUBLE) / 10000) AS BIGINT) AS VARCHAR) || ',00' END AS valor_de_compra,
    CASE WHEN b = 14 THEN NULL WHEN b = 15 THEN 'R$ / barril'
         WHEN pk = 15 THEN 'R$ / 13 kg' WHEN pk >= 13 THEN 'R$ / m³' ELSE 'R$ / litro' END AS unidade_de_medida,
    CASE WHEN b = 19 THEN NULL WHEN l_returnflag = 'R' THEN 'BRANCA' ELSE 'MARCA ' || l_returnflag END AS bandeira,
    'dsan/all/' || CAST(yr AS VARCHAR) || '/precos.csv' AS _source_file,
    'dsan' AS _source_series,
    yr AS _source_year,
    'UTF-8' AS _source_encoding,
    '{BINDING_SIGNATURE}' AS _header_signature,
    TIMESTAMP '{INGESTED_AT}' AS _ingested_at,
    '{RUN_ID}' AS _ingestion_run_id,
    concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
              CAST(l_suppkey AS VARCHAR), CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR),
              strftime(l_shipdate, '%Y%m%d'), l_returnflag, CAST(copy_no AS VARCHAR)) AS _source_row
  FROM cp
)"""

_CHECKS = [
    ("collection_date_missing", f"NOT {_blank('data_da_coleta')}"),
    ("collection_date_not_parseable", f"{_blank('data_da_coleta')} OR collection_date IS NOT NULL"),
    (
        "collection_date_out_of_range",
        f"collection_date IS NULL OR collection_date BETWEEN DATE '{BINDING.series_start}' AND DATE '{BINDING.as_of}'",
    ),
    ("cnpj_invalid", "length(reseller_cnpj) = 14"),
    ("unknown_product", f"product IN {_IN(BINDING.products)}"),
    ("unknown_unit", f"unit IN {_IN(BINDING.units)}"),
    ("unknown_state", f"state IN {_IN(BINDING.states)}"),
    ("unknown_region", f"region IN {_IN(BINDING.regions)}"),
    ("municipality_missing", f"NOT {_blank('municipio')}"),
    ("brand_missing", f"NOT {_blank('bandeira')}"),
    ("sale_price_missing", f"NOT {_blank('valor_de_venda')}"),
    ("sale_price_not_numeric", f"{_blank('valor_de_venda')} OR sale_price IS NOT NULL"),
    ("sale_price_not_positive", "sale_price IS NULL OR sale_price > 0"),
    ("purchase_price_not_numeric", f"{_blank('valor_de_compra')} OR purchase_price IS NOT NULL"),
    ("purchase_price_not_positive", "purchase_price IS NULL OR purchase_price > 0"),
]

_REASON_TEXT = "concat_ws(',', " + ", ".join(
    f"CASE WHEN NOT coalesce(({cond}), false) THEN '{name}' END" for name, cond in _CHECKS
) + ")"

_FP = ", ".join(FINGERPRINT)

CONTRACT_CTE = f"""
typed AS (
  SELECT raw.*,
    trim(regiao_sigla) AS region,
    upper(trim(estado_sigla)) AS state,
    trim(municipio) AS municipality,
    trim(revenda) AS reseller_name,
    regexp_replace(cnpj_da_revenda, '[^0-9]', '', 'g') AS reseller_cnpj,
    trim(produto) AS product,
    CAST(try_strptime(trim(data_da_coleta), '%d/%m/%Y') AS DATE) AS collection_date,
    TRY_CAST(replace(trim(valor_de_venda), ',', '.') AS DECIMAL(9,4)) AS sale_price,
    TRY_CAST(replace(trim(valor_de_compra), ',', '.') AS DECIMAL(9,4)) AS purchase_price,
    trim(unidade_de_medida) AS unit,
    trim(bandeira) AS brand
  FROM raw
),
checked AS MATERIALIZED (
  SELECT typed.*, CAST(date_trunc('week', collection_date) AS DATE) AS collection_week,
         {_REASON_TEXT} AS contract_reasons
  FROM typed
),
repeated AS (
  SELECT reseller_cnpj, product, collection_date FROM checked WHERE contract_reasons = ''
  GROUP BY reseller_cnpj, product, collection_date HAVING count(*) > 1
),
keystats AS (
  SELECT reseller_cnpj AS k_cnpj, product AS k_product, collection_date AS k_date,
         count(*) AS k_rows,
         count(DISTINCT struct_pack({_FP})) AS k_variants,
         min(_source_row) AS k_keeper
  FROM checked JOIN repeated USING (reseller_cnpj, product, collection_date) WHERE contract_reasons = ''
  GROUP BY reseller_cnpj, product, collection_date
),
evaluated AS (
  SELECT c.*,
    CASE WHEN c.contract_reasons = '' AND k.k_rows > 1 AND k.k_variants > 1 THEN 'duplicate_key_conflict'
         WHEN c.contract_reasons = '' AND k.k_rows > 1 AND k.k_variants = 1 AND c._source_row <> k.k_keeper THEN 'exact_duplicate'
    END AS duplicate_flag
  FROM checked c LEFT JOIN keystats k
    ON c.reseller_cnpj = k.k_cnpj AND c.product = k.k_product AND c.collection_date = k.k_date
),
judged AS MATERIALIZED (
  SELECT *, concat_ws(',', nullif(contract_reasons, ''), duplicate_flag) AS reasons FROM evaluated
),
accepted AS (SELECT * FROM judged WHERE reasons = ''),
rejected AS (SELECT * FROM judged WHERE reasons <> '')"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def binding_sql(body: str) -> str:
    return with_ctes(RAW_CTE, CONTRACT_CTE, body=body)


def _avg_half_up(x: str, scale_in: int = 4, scale_mid: int = 8, scale_out: int = 4) -> str:
    """Spark's avg(decimal) then round(.., 4): the mean is first rounded HALF_UP
    to 8 decimals, then to 4. Done in integers to stay exact."""
    s = f"sum(CAST(round({x} * {10 ** scale_in}) AS HUGEINT))"
    n = f"count({x})"
    up = 10 ** (scale_mid - scale_in)
    mid = f"(sign({s}) * ((2 * abs({s}) * {up} + {n}) // (2 * {n})))"
    down = 10 ** (scale_mid - scale_out)
    return f"CAST(sign({mid}) * ((2 * abs({mid}) + {down}) // (2 * {down})) AS DOUBLE) / {10 ** scale_out}"


TYPED_COLS = (
    "region, state, municipality, reseller_name, reseller_cnpj, product, collection_date, collection_week, "
    "CAST(sale_price AS DOUBLE) AS sale_price, CAST(purchase_price AS DOUBLE) AS purchase_price, unit, brand"
)
LINEAGE_COLS = (
    "_source_file, _source_series, _source_year, _source_encoding, _header_signature, "
    "_ingested_at, _ingestion_run_id, _source_row"
)
RAW_COLS = (
    "regiao_sigla, estado_sigla, municipio, revenda, cnpj_da_revenda, nome_da_rua, numero_rua, complemento, "
    "bairro, cep, produto, data_da_coleta, valor_de_venda, valor_de_compra, unidade_de_medida, bandeira"
)

WEEKLY_PRICE_BODY = f"""
SELECT state, product, unit, collection_week,
  {_avg_half_up('sale_price')} AS avg_price,
  CAST(quantile_disc(sale_price, 0.5) AS DOUBLE) AS median_price,
  CAST(min(sale_price) AS DOUBLE) AS min_price,
  CAST(max(sale_price) AS DOUBLE) AS max_price,
  round(stddev_samp(sale_price), 4) AS stddev_price,
  count(*) AS observation_count,
  count(DISTINCT reseller_cnpj) AS reseller_count,
  count(*) < {LOW_SAMPLE_BELOW} AS is_low_sample,
  CAST(year(collection_week) AS INTEGER) AS collection_year
FROM accepted
GROUP BY state, product, unit, collection_week"""

COVERAGE_CTE = """
cov AS (
  SELECT CAST(year(collection_date) AS INTEGER) AS collection_year, product, state,
         count(*) AS total_rows, count(purchase_price) AS rows_with_purchase,
         round(count(purchase_price) / count(*), 6) AS coverage_ratio
  FROM accepted GROUP BY 1, 2, 3
),
yearly AS (
  SELECT collection_year, sum(rows_with_purchase) / sum(total_rows) AS ratio FROM cov GROUP BY collection_year
)"""

MARGIN_BODY = f"""
SELECT state, product, unit, collection_week,
  {_avg_half_up('(sale_price - purchase_price)')} AS avg_margin,
  round(avg((sale_price - purchase_price) / sale_price), 6) AS avg_margin_ratio,
  count(*) AS total_rows,
  count(purchase_price) AS rows_with_purchase,
  round(count(purchase_price) / count(*), 6) AS coverage_ratio,
  round(count(purchase_price) / count(*), 6) >= {RELIABLE_FROM} AS is_reliable,
  CAST(year(collection_week) AS INTEGER) AS collection_year
FROM accepted
WHERE state IS NOT NULL AND product IS NOT NULL AND unit IS NOT NULL AND collection_week IS NOT NULL
GROUP BY state, product, unit, collection_week
HAVING count(purchase_price) > 0"""


# --- quality rules ---------------------------------------------------------------

METRICS_BODY = """
SELECT (SELECT count(*) FROM raw) AS source,
       (SELECT count(*) FROM accepted) AS accepted,
       (SELECT count(*) FROM rejected) AS rejected,
       (SELECT count(purchase_price) FROM accepted) AS with_purchase_price"""


def _rule_sql(i: int, rule: dict) -> str:
    kind = rule["type"]
    head = f"{i} AS ordinal, '{rule['name']}' AS name, '{kind}' AS type, '{rule.get('severity', 'critical')}' AS severity"
    if kind in ("not_null", "domain", "range", "unique_key"):
        col = rule.get("column")
        if kind == "not_null":
            count_sql, word = f"SELECT count(*) FILTER (WHERE {col} IS NULL) AS n FROM accepted", "null"
        elif kind == "domain":
            count_sql, word = f"SELECT count(*) FILTER (WHERE NOT ({col} IN {_IN(rule['values'])})) AS n FROM accepted", "outside"
        elif kind == "range":
            conds = []
            if "min" in rule:
                conds.append(f"{col} >= {rule['min']}")
            if "max" in rule:
                conds.append(f"{col} <= {rule['max']}")
            inside = " AND ".join(conds) or "true"
            count_sql, word = f"SELECT count(*) FILTER (WHERE {col} IS NOT NULL AND NOT ({inside})) AS n FROM accepted", "outside"
        else:
            cols = ", ".join(rule["columns"])
            count_sql, word = (
                f"SELECT count(*) AS n FROM (SELECT 1 FROM accepted GROUP BY {cols} HAVING count(*) > 1)",
                "duplicated",
            )
        expected = f"[{rule.get('min', '-inf')}, {rule.get('max', 'inf')}]" if kind == "range" else f"0 {word}"
        return (
            f"SELECT {head}, n = 0 AS passed, CAST(n AS VARCHAR) || ' {word}' AS observed, "
            f"'{expected}' AS expected FROM ({count_sql})"
        )
    if kind == "custom":
        inner = (
            "SELECT count(*) AS n, string_agg(product, ', ' ORDER BY product) AS names FROM "
            "(SELECT product FROM (SELECT DISTINCT product, unit FROM accepted) GROUP BY product HAVING count(*) > 1)"
        )
        return (
            f"SELECT {head}, n = 0 AS passed, CASE WHEN n = 0 THEN 'none' ELSE names END AS observed, "
            f"'none' AS expected FROM ({inner})"
        )
    if kind == "ratio":
        num, den = rule["numerator"], rule["denominator"]
        value = f"(CASE WHEN coalesce({den}, 0) = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / {den} END)"
        conds = []
        if "max" in rule:
            conds.append(f"{value} <= {float(rule['max'])}")
        if "min" in rule:
            conds.append(f"{value} >= {float(rule['min'])}")
        passed = " AND ".join(conds) or "true"
        expected = f"[{rule.get('min', 0)}, {rule.get('max', 1)}]"
        return (
            f"SELECT {head}, {passed} AS passed, printf('%.6f', {value}) AS observed, '{expected}' AS expected "
            f"FROM metrics"
        )
    if kind == "reconciliation":
        return (
            f"SELECT {head}, source = accepted + rejected AS passed, "
            f"CAST(accepted + rejected AS VARCHAR) || ' accounted' AS observed, "
            f"CAST(source AS VARCHAR) || ' in source' AS expected FROM metrics"
        )
    raise ValueError(kind)


def dq_sql(types: tuple[str, ...] | None) -> str:
    from vetrow.operators.quality import load_rules

    rules = load_rules()
    if types is not None:
        rules = [r for r in rules if r["type"] in types]
    union = "\nUNION ALL\n".join(_rule_sql(i, r) for i, r in enumerate(rules))
    body = f"""
SELECT ordinal, name, type, severity, passed, observed, expected,
  '[' || CASE WHEN passed THEN 'ok' ELSE 'FAILED' END || '] ' || name || ': observed ' || observed
      || ', expected ' || expected AS message
FROM ({union})"""
    return with_ctes(RAW_CTE, CONTRACT_CTE, f"\nmetrics AS ({METRICS_BODY})", body=body)


SURVEY_ORACLES: dict[str, str] = {
    "raw_survey": with_ctes(RAW_CTE, body="SELECT * FROM raw"),
    "typed_survey": binding_sql(f"SELECT {TYPED_COLS}, _source_row FROM checked"),
    "contract_reasons": binding_sql(
        "SELECT _source_row, contract_reasons AS reasons, "
        "CAST(CASE WHEN contract_reasons = '' THEN 0 ELSE length(contract_reasons) - length(replace(contract_reasons, ',', '')) + 1 END AS INTEGER) AS n_reasons "
        "FROM checked"
    ),
    "reason_histogram": binding_sql(
        "SELECT reason, count(*) AS rows FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM rejected) GROUP BY reason"
    ),
    "accepted_rows": binding_sql(f"SELECT {TYPED_COLS}, {LINEAGE_COLS} FROM accepted"),
    "rejected_rows": binding_sql(f"SELECT {RAW_COLS}, {LINEAGE_COLS}, reasons FROM rejected"),
    "duplicate_flags": binding_sql(
        "SELECT _source_row, reseller_cnpj, product, collection_date, duplicate_flag AS flag "
        "FROM evaluated WHERE duplicate_flag IS NOT NULL"
    ),
    "reconciliation": with_ctes(
        RAW_CTE, CONTRACT_CTE, f"\nmetrics AS ({METRICS_BODY})",
        body="SELECT source, accepted, rejected, source - accepted - rejected AS missing, "
        "source = accepted + rejected AS balances FROM metrics",
    ),
    "layer_metrics": binding_sql(METRICS_BODY),
    "dq_not_null": dq_sql(("not_null",)),
    "dq_domain": dq_sql(("domain",)),
    "dq_range": dq_sql(("range",)),
    "dq_unique_key": dq_sql(("unique_key",)),
    "dq_ratio": dq_sql(("ratio",)),
    "dq_reconciliation": dq_sql(("reconciliation",)),
    "dq_unit_per_product": dq_sql(("custom",)),
    "dq_report": dq_sql(None),
    "weekly_price": binding_sql(WEEKLY_PRICE_BODY),
    "coverage": with_ctes(RAW_CTE, CONTRACT_CTE, COVERAGE_CTE, body="SELECT * FROM cov"),
    "margin": binding_sql(MARGIN_BODY),
    "yearly_coverage": with_ctes(RAW_CTE, CONTRACT_CTE, COVERAGE_CTE, body="SELECT * FROM yearly"),
    "year_runs": with_ctes(
        RAW_CTE, CONTRACT_CTE, COVERAGE_CTE,
        body="SELECT min(collection_year) AS first_year, max(collection_year) AS last_year, count(*) AS years "
        "FROM (SELECT collection_year, collection_year - row_number() OVER (ORDER BY collection_year) AS g FROM yearly) "
        "GROUP BY g",
    ),
    "first_zero_year": with_ctes(
        RAW_CTE, CONTRACT_CTE, COVERAGE_CTE,
        body="SELECT min(collection_year) AS first_zero_year FROM yearly WHERE ratio = 0",
    ),
    "product_units": binding_sql("SELECT DISTINCT product, unit FROM accepted"),
    "gold_refresh": binding_sql(
        WEEKLY_PRICE_BODY.replace("SELECT state,", "SELECT collection_year IN (1997, 1998) AS built_anew, * FROM (SELECT state,", 1).replace(
            "FROM accepted", "FROM (SELECT * REPLACE (CAST(CASE WHEN year(collection_date) = 1998 THEN sale_price + 1 ELSE sale_price END "
            "AS DECIMAL(9,4)) AS sale_price) FROM accepted)") + ")"),
    "stopped_run": binding_sql(
        "SELECT 'breach' AS run, true AS stopped, 0 AS silver_rows, (SELECT count(*) FROM rejected) AS quarantine_rows "
        "UNION ALL SELECT 'clean', false, (SELECT count(*) FROM accepted), 0"),
    "bronze_slice": binding_sql("SELECT * FROM raw WHERE _source_year IN (1997, 1998)"),
    "silver_between": binding_sql(
        f"SELECT {TYPED_COLS}, _source_row, CAST(year(collection_date) AS INTEGER) AS collection_year FROM accepted "
        "WHERE collection_date BETWEEN DATE '1996-12-10' AND DATE '1997-01-20'"),
    "published_twins": binding_sql(
        "SELECT 'again-' || _source_row AS _source_row, CASE WHEN CAST(substr(bairro, 8) AS INTEGER) % 2 = 0 "
        "THEN 'duplicate_key_conflict' ELSE 'exact_duplicate' END AS reasons, _source_row AS _other_row, 'quarantine' AS side "
        "FROM accepted WHERE _source_year = 1997 "
        "UNION ALL SELECT CASE WHEN _source_year = 1998 THEN 'again-' ELSE '' END || _source_row, '', NULL, 'silver' "
        "FROM accepted WHERE _source_year <= 1998"),
    "silver_table": binding_sql(
        f"SELECT {TYPED_COLS}, _source_row, CAST(year(collection_date) AS INTEGER) AS collection_year, "
        "TIMESTAMP '2010-01-01' AS _updated_at FROM accepted"),
    "gold_snapshot": binding_sql(WEEKLY_PRICE_BODY),
    "gate_verdict": f"SELECT count(*) AS rules, count(*) FILTER (WHERE NOT passed) AS failed, "
    f"count(*) FILTER (WHERE NOT passed AND severity = 'critical') AS breaches, "
    f"count(*) FILTER (WHERE NOT passed AND severity = 'critical') = 0 AS published FROM ({dq_sql(None)})",
    "quarantine_rows": binding_sql(f"SELECT _source_row, {RAW_COLS}, reasons, TIMESTAMP '2010-01-01' AS _rejected_at FROM rejected"),
    "originals_kept": binding_sql(
        "SELECT _source_row, data_da_coleta, collection_date, valor_de_venda, CAST(sale_price AS DOUBLE) AS sale_price, "
        "valor_de_compra, CAST(purchase_price AS DOUBLE) AS purchase_price FROM accepted"),
}
