"""Registry of checked queries: a Spark callable and, where one exists, its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulo.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``."""

    def add(run: Query) -> Query:
        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        assert name not in QUERIES, name
        QUERIES[name] = configured
        if sql is not None:
            ORACLES[name] = sql.strip()
        return configured

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def comparable(value: Column) -> Column:
    """A computed double to six places. Going through a decimal first removes the noise that
    makes two engines round a tie differently."""
    return F.round(value.cast("decimal(28,9)"), 6).cast("double")


def sql_comparable(expression: str) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(28, 9)), 6) AS DOUBLE)"
