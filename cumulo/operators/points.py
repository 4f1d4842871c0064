"""Metric points: expected series, result blocks, bucketing, joins and volume sums."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.functions.text import first_nonblank, json_texts
from cumulo.functions.time import bucket_seconds, bucket_text, six_places, within_window
from cumulo.operators.inventory import require_id
from cumulo.operators.shape import keep_last
from cumulo.schemas import MetricSpec
from cumulo.sources.tables import BROADCAST_SPECS, spec_array, spec_frame

INSTANCE_KEYS = ("account_id", "region", "instance_id")
DEFAULT_PERIOD = 60
DEFAULT_INTERVAL = "PT1H"


def attached_volumes(inventory: DataFrame, ids: str = "ebs_volume_ids") -> DataFrame:
    """One row per (instance, attached volume) from the JSON list of volume ids."""
    return inventory.select(*INSTANCE_KEYS, F.explode(json_texts(F.col(ids))).alias("volume_id"))


def _series(resources: DataFrame, specs: Sequence[MetricSpec], per_volume: bool) -> DataFrame:
    spec = F.col("spec")
    group = F.concat_ws("|", spec["metric_name"], spec["namespace"], spec["stat"])
    period = F.when(spec["period"] != 0, spec["period"]).otherwise(DEFAULT_PERIOD)
    return resources.withColumn("spec", F.explode(spec_array(specs))).select(
        F.concat_ws(
            "/", *INSTANCE_KEYS, "volume_id", spec["metric_name"], spec["stat"], period
        ).alias("Id"),
        *INSTANCE_KEYS,
        "volume_id",
        spec["metric_name"].alias("metric_name"),
        spec["namespace"].alias("namespace"),
        spec["stat"].alias("stat"),
        period.alias("period_sec"),
        first_nonblank(spec["interval"], F.lit(DEFAULT_INTERVAL)).alias("interval"),
        (group if per_volume else F.lit(None).cast("string")).alias("merge_group"),
    )


def expected_series(
    instances: DataFrame,
    volumes: DataFrame,
    instance_specs: Sequence[MetricSpec],
    volume_specs: Sequence[MetricSpec],
) -> DataFrame:
    """Every series to ask for: instance × instance spec, attached volume × volume spec.

    The specifications unnest beside each row, so this is a map without any shuffle.
    """
    of_instances = instances.select(*INSTANCE_KEYS, F.lit("").alias("volume_id"))
    return _series(require_id(of_instances, "instance_id"), instance_specs, False).unionByName(
        _series(volumes.select(*INSTANCE_KEYS, "volume_id"), volume_specs, True)
    )


def valid_blocks(results: DataFrame) -> DataFrame:
    """Result blocks whose two arrays line up; the others are dropped whole."""
    return results.where(F.size("Timestamps") == F.size("Values"))


def join_series(results: DataFrame, series: DataFrame) -> DataFrame:
    """Result blocks with the metadata of their series; unknown ids drop out.

    Joined block by block, before points are unnested, to shuffle as little as possible. Series are many times
    the resources they unnest from, by whose size Spark would judge them: they are never broadcast.
    """
    scope = [c for c in ("account_id", "region") if c in results.columns]
    return results.drop(*scope).join(series.hint("merge"), "Id")


def zip_points(blocks: DataFrame) -> DataFrame:
    """One row per point of a block: its position, ``ts`` and the value to six places; NULL
    values drop."""
    keep = [c for c in blocks.columns if c not in ("Timestamps", "Values")]
    zipped = F.arrays_zip(F.col("Timestamps").alias("ts"), F.col("Values").alias("value"))
    points = blocks.select(*keep, F.posexplode(zipped).alias("position", "point"))
    return points.where("point.value is not null").select(
        *keep,
        "position",
        F.col("point.ts").alias("ts"),
        six_places(F.col("point.value")).alias("metric_value"),
    )


def latest_points(points: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """The point of each series and time that arrived last: fetch windows overlap, so a point may
    be landed several times, but counts once. Series are already together after the join."""
    return keep_last(points, ("Id", "ts"), (*arrival, "position"))


def align_points(points: DataFrame) -> DataFrame:
    """Replace the raw time of each point by the start of its series' bucket."""
    start = bucket_seconds(F.col("ts"), F.col("period_sec"), F.col("interval"))
    return points.withColumn("bucket", start).drop("ts")


def sum_volumes(points: DataFrame) -> DataFrame:
    """Volume series summed up to their instance, per metric and bucket."""
    return (
        points.where("merge_group != ''")
        .groupBy(*INSTANCE_KEYS, "metric_name", "namespace", "stat", "bucket")
        .agg(six_places(F.sum("metric_value")).alias("metric_value"))
    )


def instance_points(points: DataFrame) -> DataFrame:
    """Instance series as they are, followed by the summed volume series."""
    own = points.where(F.coalesce("merge_group", F.lit("")) == "")
    return own.drop("merge_group", "volume_id").unionByName(
        sum_volumes(points), allowMissingColumns=True
    )


def join_volume_points(volumes: DataFrame, points: DataFrame) -> DataFrame:
    """Points keyed by volume as points of the instance the volume is attached to.

    Points of a volume that share a bucket are summed first: what is shuffled for the join is
    one row per volume, metric and bucket, however many points a volume has.
    """
    by_volume = points.groupBy(
        "account_id", "region", "volume_id", "metric_name", "namespace", "stat", "bucket"
    ).agg(six_places(F.sum("metric_value")).alias("metric_value"))
    return volumes.join(by_volume, ["account_id", "region", "volume_id"])


def first_units(specs: Sequence[MetricSpec]) -> dict[str, str]:
    units: dict[str, str] = {}
    for spec in specs:
        units.setdefault(spec.metric_name, spec.unit)
    return units


def with_unit(df: DataFrame, specs: Sequence[MetricSpec]) -> DataFrame:
    """``unit`` and ``metric_unit`` by metric name; the first spec wins, '' without one."""
    units = df.sparkSession.createDataFrame(
        list(first_units(specs).items()), "metric_name string, unit string"
    )
    if len(specs) <= BROADCAST_SPECS:
        units = F.broadcast(units)
    unit = F.coalesce("unit", F.lit(""))
    return df.join(units, "metric_name", "left").withColumns({"unit": unit, "metric_unit": unit})


def enrich(
    points: DataFrame,
    resources: DataFrame,
    specs: Sequence[MetricSpec],
    *,
    service_name: str,
    namespace: str,
) -> DataFrame:
    """Points of instances with what the raw metric table says about their resource."""
    known = require_id(resources, "resource_id", "instance_id").select(
        *INSTANCE_KEYS,
        "resource_id",
        first_nonblank(F.col("resource_name"), F.col("instance_id")).alias("resource_name"),
    )
    date = bucket_text(F.col("bucket"))
    rows = points.join(known, list(INSTANCE_KEYS)).withColumns(
        {
            "service_name": F.lit(service_name),
            "namespace": F.coalesce("namespace", F.lit(namespace)),
            "aggregation_type": F.col("stat"),
            "date": date,
            "metric_date": F.substring(date, 1, 10),
        }
    )
    return with_unit(rows, specs)


def period_statistic(
    events: DataFrame, specs: Sequence[MetricSpec], keys: Sequence[str]
) -> DataFrame:
    """Each spec's statistic over its own period, from raw values.

    ``events`` has ``metric_name``, ``ts``, ``value`` and the ``keys`` of a resource. Sum and
    Average both pre-aggregate before the shuffle.
    """
    lookup = spec_frame(events.sparkSession, specs).select(
        "metric_name", "stat", "period", "interval"
    )
    start = bucket_seconds(F.col("ts"), F.col("period"), F.col("interval"))
    grouped = (
        events.join(lookup, "metric_name")
        .withColumn("bucket", start)
        .groupBy(*keys, "metric_name", "stat", "interval", "bucket")
    )
    value = F.when(F.lower("stat") == "sum", F.sum("value")).otherwise(F.avg("value"))
    return grouped.agg(six_places(value).alias("metric_value"))


def landed_within(points: DataFrame, as_of: dt.datetime, window_days: int) -> DataFrame:
    """Points of the fetch window ``[as_of - window_days, as_of)``."""
    return points.where(within_window(F.col("ts"), as_of, window_days))
