"""All queries on the driver's tables, and the DuckDB SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import base, evidence, relational, texts  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.SQL)
