from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from samples import rows
from vetrow.operators.contract import REASONS_COL, apply_contract, evaluate
from vetrow.spec import SURVEY

SPEC = SURVEY.with_dates(SURVEY.series_start, date(2026, 1, 1))


def reasons_of(spark, *overrides, spec=SPEC):
    out = evaluate(rows(spark, *overrides), spec).orderBy("_source_row").select(REASONS_COL).collect()
    return [r[0] for r in out]


def values_by_kind(value):
    """A raw text for a value, as surveys write its kind, with blanks around it."""
    if isinstance(value, date):
        return f" {value:%d/%m/%Y}"
    return f" {value:f} ".replace(".", ",") if isinstance(value, Decimal) else f" {value}  "


def test_every_field_is_read_as_its_kind(spark):
    """Each field of the spec, fed with values of its kind written out as text."""
    days = [date(2024, 12, 30) + timedelta(days=17 * i) for i in range(9)]
    prices = [Decimal(n * n + 7).scaleb(-(n % 5)) for n in range(1, 10)]
    given = {"date": days, "price": prices, "code": ["Aa", "bB", "zz"] * 3, "digits": [f"{n}.{n}/{n}-{n}" for n in range(9)], "text": [f"Ab {n}" for n in range(9)]}
    overrides = [{f.source: values_by_kind(given[f.read_as][i]) for f in SPEC.fields} for i in range(9)]
    got = apply_contract(rows(spark, *overrides), SPEC).orderBy("_source_row").collect()
    read = {"date": lambda v: v, "price": lambda v: v.quantize(Decimal("0.0001")), "code": str.upper, "digits": lambda v: "".join(c for c in v if c.isdigit()),
            "text": lambda v: v}
    for i, r in enumerate(got):
        assert {f.name: r[f.name] for f in SPEC.fields} == {f.name: read[f.read_as](given[f.read_as][i]) for f in SPEC.fields}
        assert r["collection_week"] == days[i] - timedelta(days=days[i].weekday())


@pytest.mark.parametrize("text", ["1.2.3", "1,2,3", "--1", "R$ 5", "5 5", "", " "])
def test_what_is_no_price_reads_as_null(spark, text):
    assert apply_contract(rows(spark, {"valor_de_venda": text}), SPEC).first()["sale_price"] is None


def breaches(f):
    """(raw text, reason) of each way in which a field can break the spec."""
    outside = "no such value"
    if f.required:
        yield from ((blank, f"{f.stem}_missing") for blank in (None, "", "   "))
    if f.length is not None:
        yield from ((text, f"{f.stem}_invalid") for text in ("7" * (f.length - 1), "7" * (f.length + 1), outside))
    if f.domain is not None:
        yield from ((text, f"unknown_{f.stem}") for text in (outside, None))
    if f.read_as == "price":
        yield outside, f"{f.stem}_not_numeric"
        yield from ((text, f"{f.stem}_not_positive") for text in ("0", "-0,0001"))
    if f.read_as == "date":
        yield from ((text, f"{f.stem}_not_parseable") for text in (outside, "32/01/2025", "2025-01-02"))
        yield from ((f"{day:%d/%m/%Y}", f"{f.stem}_out_of_range") for day in (SPEC.series_start - timedelta(days=1), SPEC.as_of + timedelta(days=1)))


def test_every_breach_of_every_field_names_its_reason(spark):
    cases = [(f.source, text, reason) for f in SPEC.fields for text, reason in breaches(f)]
    got = apply_contract(rows(spark, *({column: text} for column, text, _ in cases)), SPEC).orderBy("_source_row").select(REASONS_COL).collect()
    assert [r[0] for r in got] == [[reason] for _, _, reason in cases]
    assert len({reason for _, _, reason in cases}) == 15


def test_good_row_has_no_reason(spark):
    assert reasons_of(spark, {}) == [[]]


def test_all_breaches_of_a_row_are_named_in_report_order(spark):
    firsts = {f.name: (f.source, *next(breaches(f))) for f in SPEC.fields if any(breaches(f))}
    got = reasons_of(spark, {column: text for column, text, _ in firsts.values()})
    assert got == [[firsts[name][2] for name in SPEC.report_order if name in firsts]]


@pytest.mark.parametrize("column", ["produto", "unidade_de_medida", "estado_sigla", "regiao_sigla", "cnpj_da_revenda"])
def test_null_domain_value_is_rejected(spark, column):
    # A NULL is not "in the domain": the check must fail, not vanish.
    assert reasons_of(spark, {column: None})[0] != []


def test_evaluate_keeps_every_row_and_the_originals(spark):
    df = evaluate(rows(spark, {}, {"valor_de_venda": "x"}), SPEC)
    assert df.count() == 2
    assert "valor_de_venda" in df.columns and "sale_price" in df.columns


def test_exact_copies_keep_one(spark):
    got = reasons_of(spark, {}, {}, {})
    assert sorted(map(tuple, got)) == [(), ("exact_duplicate",), ("exact_duplicate",)]
    assert got[0] == []  # the smallest row id is the one kept


def test_conflicting_copies_all_rejected(spark):
    got = reasons_of(spark, {}, {"valor_de_venda": "4,80"})
    assert got == [["duplicate_key_conflict"], ["duplicate_key_conflict"]]


def test_address_only_difference_is_an_exact_copy(spark):
    got = reasons_of(spark, {}, {"nome_da_rua": "OUTRA RUA"})
    assert got == [[], ["exact_duplicate"]]


def test_rejected_twin_causes_nothing(spark):
    got = reasons_of(spark, {}, {"valor_de_venda": "-1,00"})
    assert got == [[], ["sale_price_not_positive"]]


def test_two_copies_and_a_rejected_row_keep_one(spark):
    # the rejected row (smallest id) must not push both valid copies past position 1
    got = reasons_of(spark, {"bandeira": ""}, {}, {})
    assert got == [["brand_missing"], [], ["exact_duplicate"]]


def test_null_purchase_prices_still_match(spark):
    got = reasons_of(spark, {"valor_de_compra": None}, {"valor_de_compra": None})
    assert got == [[], ["exact_duplicate"]]


def test_other_keys_untouched(spark):
    got = reasons_of(spark, {}, {"data_da_coleta": "13/03/2025"})
    assert got == [[], []]


def test_no_repeated_key_skips_verdict_join(spark):
    df = evaluate(rows(spark, {}, {"data_da_coleta": "13/03/2025"}), SPEC)
    assert df.filter(F.size(REASONS_COL) > 0).count() == 0
