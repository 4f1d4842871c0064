"""The service catalog: which services run, in which scopes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumulo.functions.text import texts

PROVIDER = "aws"
DEFAULT_SERVICE = "EC2"
CATALOG_KEY = ("service_code", "cloud_provider")


def normalized(provider: Column) -> Column:
    return F.lower(F.trim(provider))


def with_catalog_defaults(rows: DataFrame, now: Column) -> DataFrame:
    """Defaults of the catalog table: active, created and updated now."""
    defaults = {"is_active": F.lit(True), "created_at": now, "updated_at": now}
    return rows.withColumns(
        {c: F.coalesce(c, d) if c in rows.columns else d for c, d in defaults.items()}
    )


def unique_key_violations(catalog: DataFrame, keys: Sequence[str] = CATALOG_KEY) -> DataFrame:
    """Keys that more than one row has; a key with a NULL part is never in violation."""
    complete = catalog
    for key in keys:
        complete = complete.where(F.col(key).isNotNull())
    return complete.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def admit(
    new: DataFrame, existing: DataFrame, order: Sequence[str], keys: Mapping[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split a batch before it is inserted: rows that keep the keys unique, and the rejected ones with a
    ``reason``: ``exists`` (a stored row has the key) or ``repeated`` (an earlier row of the batch has it).

    ``order`` says which of several rows comes first. A key with a NULL part violates nothing. Both results
    read the batch; it should be staged.
    """
    keys = keys or {k: F.col(k) for k in CATALOG_KEY}
    names = [f"_key_{k}" for k in keys]
    complete = F.lit(True)
    for name in names:
        complete = complete & F.col(name).isNotNull()
    keyed = new.withColumns(dict(zip(names, keys.values())))
    stored = existing.select(*[k.alias(n) for k, n in zip(keys.values(), names)]).distinct()
    first = F.row_number().over(Window.partitionBy(*names).orderBy(*order))
    # Rows without a complete key are no group: their share of the window is spread by row.
    whole = keyed.where(complete).withColumn("_place", first)
    judged = whole.join(stored.withColumn("_stored", F.lit(True)), names, "left")
    reason = F.when(F.col("_stored"), "exists").when(F.col("_place") > 1, "repeated")
    judged = judged.withColumn("reason", reason).select(*new.columns, "reason")
    free = keyed.where(~complete).select(*new.columns, F.lit(None).cast("string").alias("reason"))
    both = judged.unionByName(free)
    return both.where("reason IS NULL").drop("reason"), both.where("reason IS NOT NULL")


def active_codes(catalog: DataFrame, provider: str = PROVIDER) -> DataFrame:
    """Distinct codes of the provider's active services, in order."""
    return (
        catalog.where((normalized(F.col("cloud_provider")) == provider) & F.col("is_active"))
        .select("service_code")
        .distinct()
        .orderBy("service_code")
    )


def split_registered(codes: DataFrame, registry: Sequence[str]) -> DataFrame:
    """Each code in upper case with a flag whether a service is registered under it."""
    code = F.upper(F.trim("service_code"))
    return codes.where("service_code != ''").select(
        code.alias("service_code"), code.isin(*registry).alias("is_registered")
    )


def registered_codes(
    codes: DataFrame, registry: Sequence[str], default: str = DEFAULT_SERVICE
) -> DataFrame:
    """Registered codes, or the default service when there are none.

    The set collected is bounded by the registry: codes outside it are filtered first.
    """
    known = split_registered(codes, registry).where("is_registered")
    found = known.agg(F.collect_set("service_code").alias("codes"))
    services = F.when(F.size("codes") == 0, texts([default])).otherwise(F.col("codes"))
    return found.select(F.explode(services).alias("service_code"))


def ingest_scope(accounts: DataFrame, regions: Column, services: Column) -> DataFrame:
    """One row per account, region and service. Regions and services are lists held by each
    account row, so the product is unnested in place rather than joined."""
    return accounts.select("account_id", F.explode(regions).alias("region"), services.alias("s")).select(
        "account_id", "region", F.explode("s").alias("service")
    )
