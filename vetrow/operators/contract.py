"""The row contract, generated from the spec's field table.

Each ``Field`` says where a typed column comes from and what it must satisfy;
the columns and the named violations below follow from it. Every input row
comes out with its original strings, its typed values and the list of what is
wrong with it. All of it is one narrow, code-generated projection; only the
duplicate check (``duplicates``) shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrow.functions.columns import filled, parse_date, parse_price
from vetrow.spec import SURVEY, WEEK_COLUMN, ContractSpec, Field

REASONS_COL = "_rejection_reasons"


def typed(field: Field, spec: ContractSpec) -> Column:
    """The field's value, read from its raw column."""
    if field.read_as == "date":
        value = parse_date(field.source, spec.date_format)
    elif field.read_as == "price":
        value = parse_price(field.source, spec.price_type)
    elif field.read_as == "digits":
        value = F.regexp_replace(field.source, r"\D", "")
    elif field.read_as == "code":
        value = F.upper(F.trim(field.source))
    else:
        value = F.trim(field.source)
    return value.alias(field.name)


def violations(field: Field, spec: ContractSpec) -> list[tuple[str, Column]]:
    """(reason, condition of a row that has it) for what the table asks of a field. No condition is ever
    NULL: a NULL that a domain or a length is asked of violates it."""
    value, found = F.col(field.name), []

    def unless(reason: str, holds: Column) -> None:
        found.append((reason, ~F.coalesce(holds, F.lit(False))))

    if field.required:
        unless(f"{field.stem}_missing", filled(field.source))
    if field.read_as in ("date", "price"):
        what = "parseable" if field.read_as == "date" else "numeric"
        unless(f"{field.stem}_not_{what}", value.isNotNull() | ~filled(field.source))
    if field.read_as == "date":
        last = F.current_date() if spec.as_of is None else F.lit(spec.as_of)
        unless(f"{field.stem}_out_of_range", value.isNull() | value.between(F.lit(spec.series_start), last))
    if field.read_as == "price":
        unless(f"{field.stem}_not_positive", value.isNull() | (value > 0))
    if field.length is not None:
        unless(f"{field.stem}_invalid", F.length(value) == field.length)
    if field.domain is not None:
        unless(f"unknown_{field.stem}", value.isin(*getattr(spec, field.domain)))
    return found


def reasons(spec: ContractSpec = SURVEY) -> list[tuple[str, Column]]:
    """All violations of the spec, in report order."""
    by_name = {f.name: f for f in spec.fields}
    return [v for name in spec.report_order for v in violations(by_name[name], spec)]


def apply_contract(bronze: DataFrame, spec: ContractSpec = SURVEY) -> DataFrame:
    """Bronze rows with typed columns, the Monday of their ISO week and their reasons, duplicates aside.

    Empty slots leave the reason array by ``array_remove``, which stays in generated code; a lambda
    filter would take the parsing under it out of it."""
    day = next(f.name for f in spec.fields if f.read_as == "date")
    slots = [F.when(broken, F.lit(reason)).otherwise(F.lit("")) for reason, broken in reasons(spec)]
    with_types = bronze.select("*", *(typed(f, spec) for f in spec.fields))
    return with_types.withColumns({
        WEEK_COLUMN: F.date_trunc("week", day).cast("date"),
        REASONS_COL: F.array_remove(F.array(*slots), ""),
    })


def evaluate(bronze: DataFrame, spec: ContractSpec = SURVEY) -> DataFrame:
    """Contract reasons and duplicate flags; every input row comes out once."""
    from vetrow.operators.duplicates import flag_duplicates

    return flag_duplicates(apply_contract(bronze, spec), spec)


def is_valid() -> Column:
    return F.size(REASONS_COL) == 0
