"""Plan shape guards: the properties the scale design relies on."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from vetrow.operators.contract import apply_contract
from vetrow.sources.binding import survey_rows
from vetrow.spec import BINDING

QUERIES = entry.queries()


def plan_of(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_contract_projection_has_no_lambda(spark):
    # a lambda (e.g. array_compact's filter) would take the checks out of codegen
    plan = plan_of(apply_contract(survey_rows(spark, SF_SMALL), BINDING))
    assert "lambdafunction" not in plan


@pytest.mark.parametrize("name", ["duplicate_flags", "accepted_rows", "weekly_price", "dq_unique_key"])
def test_no_window_over_the_natural_key(spark, name):
    assert "Window" not in plan_of(QUERIES[name](spark, SF_SMALL))


def test_gold_reads_only_what_it_needs(spark):
    plan = plan_of(QUERIES["weekly_price"](spark, SF_SMALL))
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema:")]
    assert schemas and all("valor_de_venda" not in s and "municipio" not in s for s in schemas)


def test_the_contract_is_generated_in_methods_that_the_jvm_compiles(spark, monkeypatch):
    """HotSpot interprets methods over 8,000 bytes, which took most of the time of a first evaluation."""
    from vetrow.plans import layers

    written, real = [], layers.materialize
    monkeypatch.setattr(layers, "materialize", lambda df, *a, **b: written.append(df) or real(df, *a, **b))
    layers.evaluate_once(survey_rows(spark, SF_SMALL), BINDING, reused=True)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = written[0].select("*")._jdf.queryExecution().debug().codegenToSeq()
        sizes = [found.apply(i)._3().maxMethodCodeSize() for i in range(found.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(sizes) > 1 and max(sizes) < 8000, sizes
