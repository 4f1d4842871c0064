"""Daily roll-up of raw metric points.

Sub-daily series become the daily mean of their hourly percentiles; daily series pass
through. All (client, account) scopes of the input are rolled up in one plan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulo.functions.time import hour_of, month_of
from cumulo.operators.shape import CLOUD, keep_last
from cumulo.schemas import METRIC_SCHEMA, MetricSpec, daily_native, sub_daily

PERCENTILE = 0.9
_SCOPE = ("client_id", "account_id", "service_name")
_SERIES = (*_SCOPE, "resource_id", "metric_name", "metric_date")


def percentile_label(percentile: float) -> str:
    """``p90`` for 0.9; fractions of a percent are cut off, not rounded."""
    return f"p{int(percentile * 100)}"


def collects(specs: Sequence[MetricSpec]) -> Column:
    """The row's (metric, statistic) is one of the specs; the statistic in any case.

    The plain metric name list is implied by the pairs and can be pushed into the scan.
    """
    if not specs:
        return F.lit(False)
    pairs = [
        F.struct(F.lit(s.metric_name).alias("metric"), F.lit(s.stat.lower()).alias("stat"))
        for s in specs
    ]
    pair = F.struct(
        F.col("metric_name").alias("metric"), F.lower("aggregation_type").alias("stat")
    )
    names = list(dict.fromkeys(s.metric_name for s in specs))
    return F.col("metric_name").isin(*names) & pair.isin(*pairs)


def hourly_percentile(
    raw: DataFrame, specs: Sequence[MetricSpec], percentile: float = PERCENTILE
) -> DataFrame:
    """Percentile per series and hour. Digests are built before the shuffle and bounded in
    size, so an hour with very many points is no hot spot."""
    return (
        raw.where(collects(specs))
        .groupBy(*_SERIES, hour_of(F.col("date")).alias("hr"))
        .agg(
            F.percentile_approx("metric_value", percentile).alias("hourly_value"),
            F.min("resource_name").alias("resource_name"),
            F.min("region").alias("region"),
        )
    )


def rollup_sub_daily(
    raw: DataFrame, specs: Sequence[MetricSpec], percentile: float = PERCENTILE
) -> DataFrame:
    """Daily mean over the hours that have points."""
    return (
        hourly_percentile(raw, specs, percentile)
        .groupBy(*_SERIES)
        .agg(
            F.avg("hourly_value").alias("metric_value"),
            F.min("resource_name").alias("resource_name"),
            F.min("region").alias("region"),
        )
        .withColumn("aggregation_type", F.lit(percentile_label(percentile)))
    )


def pass_through_daily(raw: DataFrame, specs: Sequence[MetricSpec]) -> DataFrame:
    """Daily-native points as they are, labelled with the statistic of their spec."""
    label = F.lit("Average")
    for spec in reversed(specs):
        label = F.when(F.col("metric_name") == spec.metric_name, spec.stat).otherwise(label)
    return raw.where(collects(specs)).select(
        *_SERIES, "metric_value", "resource_name", "region", label.alias("aggregation_type")
    )


def daily_projection(daily: DataFrame, namespace: str, run_time: dt.datetime) -> DataFrame:
    """Daily rows in the order of the daily tables. Units are blank, the namespace is the
    service's even for volume metrics, and the month is that of the metric date."""
    run_time = run_time.astimezone(dt.timezone.utc)
    return daily.withColumns(
        {
            "namespace": F.lit(namespace),
            "date": F.col("metric_date"),
            "unit": F.lit(""),
            "metric_unit": F.lit(""),
            "cloud_name": F.lit(CLOUD),
            "year_month": month_of(F.col("metric_date")),
            "ingestion_timestamp": F.lit(run_time.strftime("%Y-%m-%d %H:%M:%S")),
            "job_runtime_utc": F.lit(run_time),
        }
    ).select(*METRIC_SCHEMA.fieldNames())


def daily_values(
    raw: DataFrame, specs: Sequence[MetricSpec], percentile: float = PERCENTILE
) -> DataFrame:
    """Both branches over raw points already restricted to their scopes and look-back.

    Each branch scans only its own metrics: the pushed name lists do not overlap.
    """
    branches = [
        rollup_sub_daily(raw, sub_daily(specs), percentile),
        pass_through_daily(raw, daily_native(specs)),
    ]
    return branches[0].unionByName(branches[1])


DAY = ("client_id", "account_id", "resource_id", "metric_date")
# Lists of changed days up to this length are broadcast; beyond it they are joined like any table.
BROADCAST_DAYS = 1_000_000


def changed_days(raw: DataFrame) -> DataFrame:
    """The days of resources that a batch of raw points touches. A point never moves to another day,
    since its time is part of its key: no other day's values can differ after the batch is merged."""
    return raw.select(*DAY).distinct()


def only_days(raw: DataFrame, days: DataFrame) -> DataFrame:
    """The stored raw points of the changed days. ``days`` must be cheap to read repeatedly.

    The span of the days is a plain predicate, which skips files and row groups; the days themselves
    are joined, and skip directories at run time if there are few enough to broadcast.
    """
    count, first, last = days.agg(F.count(F.lit(1)), F.min("metric_date"), F.max("metric_date")).first()
    wanted = days.select(*DAY).where(F.col("metric_date") <= last) if count else days.select(*DAY)
    wanted = F.broadcast(wanted) if count <= BROADCAST_DAYS else wanted.hint("merge")
    return raw.where(F.col("metric_date").between(first, last)).join(wanted, list(DAY), "left_semi")


def unique_daily(daily: DataFrame) -> DataFrame:
    """One row per key of the daily tables. Done before the projection: what is shuffled has no
    columns that only repeat constants."""
    return keep_last(
        daily, (*_SERIES, "aggregation_type"), ("metric_value", "resource_name", "region")
    )


def daily_rollup(
    raw: DataFrame,
    specs: Sequence[MetricSpec],
    *,
    namespace: str,
    run_time: dt.datetime,
    percentile: float = PERCENTILE,
) -> DataFrame:
    """The rows of the daily tables."""
    return daily_projection(daily_values(raw, specs, percentile), namespace, run_time)
