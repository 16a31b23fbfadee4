"""Where queries and the SQL that they must agree with are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from taxoloom.sources.scratch import dealt_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The driver's tables by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def documents(self) -> DataFrame:
        return dealt_out(self.spark.read.parquet(f"{self.sf_dir}/documents.parquet"))


def query(sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under its name."""

    def wrap(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return wrap
