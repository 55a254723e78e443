"""Registration of queries: a function on (tables, spark) and the DuckDB SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from attestra.ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables(dict):
    """The Parquet tables of one folder, read on demand; columns are pruned by the plan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        ship(spark)
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        self[name] = df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return df


def query(sql: str | None = None):
    """Register a function of Tables under its name, with its SQL if there is one."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add
