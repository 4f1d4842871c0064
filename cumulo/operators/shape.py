"""Bringing rows into the shape of a stored table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLOUD = "aws"
# Beyond this many rows the listed side of a join is never broadcast.
BROADCAST_ROWS = 100_000


def stamp(
    df: DataFrame,
    client_id: str,
    run_time: dt.datetime,
    *,
    cloud_name: str = CLOUD,
) -> DataFrame:
    """Tenant, cloud and ingestion time; one run time for the whole batch.

    The account is data: it comes with each row from the scope the row was landed in.
    """
    run_time = run_time.astimezone(dt.timezone.utc)
    return df.withColumns(
        {
            "client_id": F.lit(client_id),
            "cloud_name": F.lit(cloud_name),
            "year_month": F.lit(run_time.strftime("%Y-%m")),
            "ingestion_timestamp": F.lit(run_time.isoformat()),
            "job_runtime_utc": F.lit(run_time),
        }
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order and type; missing ones are NULL, extra ones go."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The last row of each key in the given order; NULL key parts count as equal.

    Filtering on the row number lets Spark cut each key to one row per task before the
    shuffle, so a hot key costs no more than any other.
    """
    latest = Window.partitionBy(*keys).orderBy(
        *[(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order]
    )
    return df.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").drop("_rank")


def keep_one(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the same one on every run: the greatest by its remaining columns."""
    rest = [c for c in df.columns if c not in keys]
    return keep_last(df, keys, rest) if rest else df.dropDuplicates(list(keys))


def join_side(staged: DataFrame) -> DataFrame:
    """A stored or staged table as the listed side of a join: with few rows Spark may broadcast it, with
    more the join shuffles.

    Spark judges a scan by the size of its files, and where values repeat, that is a small part of what
    the rows take on the driver. Counting them reads no column.
    """
    return staged if staged.count() <= BROADCAST_ROWS else staged.hint("merge")


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows deduplication by key removes."""
    distinct = F.count_distinct(F.struct(*keys))
    return df.agg((F.count(F.lit(1)) - distinct).alias("duplicates"))


def for_clients(df: DataFrame, client_ids: Sequence[str]) -> DataFrame:
    """The same rows once per tenant, in one plan."""
    tenants = F.array(*[F.lit(c) for c in client_ids])
    return df.withColumn("client_id", F.explode(tenants))


def client_list(client_id: str, additional_client_id: str = "") -> list[str]:
    """The tenants to write for, each once."""
    return list(dict.fromkeys([client_id, additional_client_id or client_id]))


def limit_to_first(
    metrics: DataFrame, resources: DataFrame, id_column: str, limit: int
) -> DataFrame:
    """Metric rows of the first ``limit`` resources by id; no limit when it is not positive."""
    if limit <= 0:
        return metrics
    first = resources.select(id_column).distinct().orderBy(id_column).limit(limit)
    return metrics.join(first, id_column, "left_semi")


def preview(df: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    """The first rows, each with the total row count and the number of columns."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (
        df.orderBy(*order)
        .limit(rows)
        .withColumns({"total_rows": total, "total_columns": F.lit(len(df.columns))})
    )
