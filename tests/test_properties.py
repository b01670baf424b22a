"""Generated inputs against plain-Python definitions of the same rules. Each
property evaluates all its examples in one DataFrame (one Spark job)."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vetrow.functions.columns import parse_date, parse_price
from vetrow.sources.raw import fold

PRICE = st.builds(
    lambda sign, whole, frac, pad_l, pad_r: f"{' ' * pad_l}{sign}{whole}{',' + frac if frac is not None else ''}{' ' * pad_r}",
    st.sampled_from(["", "-"]),
    st.text("0123456789", min_size=1, max_size=6),
    st.one_of(st.none(), st.text("0123456789", min_size=0, max_size=6)),
    st.integers(0, 2),
    st.integers(0, 2),
)


def expected_price(text):
    value = Decimal(text.strip().replace(",", ".")).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP)
    return None if abs(value) >= Decimal("100000") else value


@settings(max_examples=1, deadline=None)
@given(st.lists(PRICE, min_size=150, max_size=150))
def test_price_parsing_matches_decimal_rounding(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(parse_price("v", "decimal(9,4)")).collect()]
    for text, value in zip(texts, got):
        assert value == expected_price(text), text


DATES = st.tuples(st.integers(1, 31), st.integers(1, 12), st.integers(1900, 2100))


def expected_date(d, m, y):
    try:
        return dt.date(y, m, d)
    except ValueError:
        return None


@settings(max_examples=1, deadline=None)
@given(st.lists(DATES, min_size=200, max_size=200))
def test_date_parsing_is_strict(spark, triples):
    texts = [f"{d:02d}/{m:02d}/{y:04d}" for d, m, y in triples]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(parse_date("v", "dd/MM/yyyy")).collect()]
    assert got == [expected_date(*t) for t in triples]


@given(st.text(max_size=40))
def test_header_normalisation_is_idempotent_snake_case(name):
    once = fold(name)
    assert fold(once) == once
    assert all(ch.isascii() and (ch.isalnum() or ch == "_") and not ch.isupper() for ch in once)
    assert not once.startswith("_") and not once.endswith("_")
