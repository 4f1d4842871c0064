"""Stored tables, record batches, views and the relational service catalog."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cumulo.functions.time import since
from cumulo.schemas import MetricSpec, Table, declared_schema

_SPEC_SCHEMA = declared_schema(
    {
        "metric_name": "string",
        "namespace": "string",
        "unit": "string",
        "stat": "string",
        "period": "int",
        "interval": "string",
        "scope": "string",
    }
)
# Specifications are configuration; a broadcast is only hinted for lists known to be this short.
BROADCAST_SPECS = 10_000


def spec_frame(spark: SparkSession, specs: Sequence[MetricSpec]) -> DataFrame:
    rows = [tuple(getattr(s, f) for f in _SPEC_SCHEMA.fieldNames()) for s in specs]
    frame = spark.createDataFrame(rows, _SPEC_SCHEMA)
    return F.broadcast(frame) if len(rows) <= BROADCAST_SPECS else frame


def spec_array(specs: Sequence[MetricSpec]) -> Column:
    """The specifications as an array-of-structs literal, to unnest next to each row."""
    names = _SPEC_SCHEMA.fieldNames()
    return F.array(
        *[F.struct(*[F.lit(getattr(s, n)).alias(n) for n in names]) for s in specs]
    ).cast(T.ArrayType(_SPEC_SCHEMA))


def records(
    spark: SparkSession, rows: Sequence[Mapping[str, object]], columns: Mapping[str, str]
) -> DataFrame:
    """A small batch of records held by the caller, under a declared schema.

    Bulk records arrive as text and go through :func:`parse_records` on the executors.
    """
    schema = declared_schema(columns)
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema)


def parse_records(df: DataFrame, text: str, columns: Mapping[str, str]) -> DataFrame:
    """JSON records in column ``text`` as rows under a declared schema."""
    parsed = F.from_json(F.col(text), declared_schema(columns))
    return df.select(parsed.alias("record")).select("record.*")


def read_if_exists(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The table, or no rows of the expected schema when it does not exist."""
    if spark.catalog.tableExists(name):
        return spark.table(name).select(*schema.fieldNames())
    return spark.createDataFrame([], schema)


def read_raw_metrics(
    spark: SparkSession,
    name: str,
    table: Table,
    *,
    client_id: str,
    accounts: Sequence[str] | None = None,
    service_name: str,
    as_of: dt.date,
    window_days: int,
) -> DataFrame:
    """Raw points of a tenant's accounts that the daily roll-up looks back on.

    Client and account are partition columns, so they prune directories. So does the month: a point
    is ingested after its date, hence in no earlier month.
    """
    df = read_if_exists(spark, name, table.schema).where(F.col("client_id") == client_id)
    if accounts is not None:
        df = df.where(F.col("account_id").isin(*accounts))
    first_month = (as_of - dt.timedelta(days=window_days)).strftime("%Y-%m")
    recent = (F.col("year_month") >= first_month) | F.col("year_month").isNull()
    return df.where(recent & looks_back(service_name, as_of, window_days))


def looks_back(service_name: str, as_of: dt.date, window_days: int) -> Column:
    recent = since(F.col("metric_date"), as_of, window_days)
    return (F.col("service_name") == service_name) & recent


def with_view(df: DataFrame, name: str, use: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """Expose ``df`` to SQL text as a temporary view while ``use`` runs."""
    df.createOrReplaceTempView(name)
    try:
        return use(df.sparkSession, name)
    finally:
        df.sparkSession.catalog.dropTempView(name)


def read_jdbc_query(
    spark: SparkSession, url: str, query: str, properties: Mapping[str, str]
) -> DataFrame:
    """Run ``query`` inside the database and read its result."""
    return spark.read.jdbc(url, f"({query}) AS pushed_query", properties=dict(properties))


def active_codes_query(table: str, provider: str = "aws") -> str:
    """The catalog look-up as text for :func:`read_jdbc_query`; both names are configuration."""
    literal = provider.replace("'", "''")
    return (
        f"select distinct service_code from {table} "
        f"where is_active = true and lower(trim(cloud_provider)) = '{literal}'"
    )
