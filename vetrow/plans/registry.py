"""All registered queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vetrow.plans.catalog import SURVEY_QUERIES
from vetrow.plans.files_catalog import AUDIT_ORACLES, AUDIT_QUERIES, MANIFEST_ORACLES, MANIFEST_QUERIES
from vetrow.plans.oracle import SURVEY_ORACLES
from vetrow.plans.raw_catalog import RAW_ORACLES, RAW_QUERIES
from vetrow.plans.tables_catalog import TABLE_ORACLES, TABLE_QUERIES


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    out.update(SURVEY_QUERIES)
    out.update(TABLE_QUERIES)
    out.update(MANIFEST_QUERIES)
    out.update(AUDIT_QUERIES)
    out.update(RAW_QUERIES)
    return out


def all_oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(SURVEY_ORACLES)
    out.update(TABLE_ORACLES)
    out.update(MANIFEST_ORACLES)
    out.update(AUDIT_ORACLES)
    out.update(RAW_ORACLES)
    return out
