"""Result blocks, series, bucketing, volume sums and enrichment."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cumulo.operators import points as P
from cumulo.schemas import INSTANCE_SPECS, VOLUME_SPECS, MetricSpec
from cumulo.sources.landed import ARRIVAL, read_metric_results

UTC = dt.timezone.utc
SCOPE = ("a", "r")
SERIES = "Id string, account_id string, region string, instance_id string, volume_id string, metric_name string, namespace string, stat string, period_sec int, interval string, merge_group string"


def series_row(id_, instance="i-1", volume="", metric="CPU", period=300, interval="PT5M", group=None):
    return (id_, *SCOPE, instance, volume, metric, "NS", "Sum" if group else "Average", period, interval, group)


@pytest.fixture
def blocks(spark, tmp_path):
    def land(*docs):
        folder = tmp_path / "account_id=a" / "region=r"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "results.json").write_text("\n".join(json.dumps(d) for d in docs))
        return read_metric_results(spark, str(tmp_path))

    return land


def at(minute, second=0):
    return f"2024-01-01T00:{minute:02d}:{second:02d}Z"


def aligned(spark, results, *series):
    meta = spark.createDataFrame(list(series), SERIES)
    return P.align_points(P.zip_points(P.join_series(P.valid_blocks(results), meta)))


def test_blocks_to_points(spark, blocks, rows):
    results = blocks(
        {"Id": "s1", "Timestamps": [at(1), at(7, 30)], "Values": [1.23456789, None]},
        {"Id": "s1", "Timestamps": [at(2), at(3)], "Values": [1.0]},
        {"Id": "unknown", "Timestamps": [at(1)], "Values": [1.0]},
        {"Id": "s1", "Timestamps": [at(11, 59)], "Values": [2]},
        {"Id": "s1", "Timestamps": [], "Values": []},
        {"Id": "s1"},
    )
    got = aligned(spark, results, series_row("s1"))
    assert rows(got.select("metric_value", (F.col("bucket") % 86400).alias("b"))) == [(1.234568, 0), (2.0, 600)]
    assert set(ARRIVAL) <= set(got.columns)


def test_volumes_sum_per_instance_and_instances_keep_repeats(spark, blocks, rows):
    results = blocks(
        {"Id": "v1", "Timestamps": [at(1)], "Values": [1.5]},
        {"Id": "v2", "Timestamps": [at(2)], "Values": [2.25]},
        {"Id": "v3", "Timestamps": [at(2)], "Values": [7.0]},
        {"Id": "c", "Timestamps": [at(1), at(2)], "Values": [10.0, 20.0]},
    )
    daily = {"period": 86400, "interval": "P1D", "group": "IO|NS|Sum", "metric": "IO"}
    points = aligned(
        spark,
        results,
        series_row("v1", volume="v1", **daily),
        series_row("v2", volume="v2", **daily),
        series_row("v3", instance="i-2", volume="v3", **daily),
        series_row("c"),
    )
    got = P.instance_points(points).select("instance_id", "metric_name", "metric_value")
    assert rows(got) == [("i-1", "CPU", 10.0), ("i-1", "CPU", 20.0), ("i-1", "IO", 3.75), ("i-2", "IO", 7.0)]


def test_expected_series(spark, rows):
    inventory = spark.createDataFrame(
        [(*SCOPE, "i-1", '["v-1","v-2"]'), (*SCOPE, "i-2", "not json"), (*SCOPE, "", '[]')],
        "account_id string, region string, instance_id string, ebs_volume_ids string",
    )
    volumes = P.attached_volumes(inventory)
    assert rows(volumes.select("volume_id")) == [("v-1",), ("v-2",)]
    got = P.expected_series(inventory, volumes, INSTANCE_SPECS, VOLUME_SPECS)
    assert got.columns == ["Id", *P.INSTANCE_KEYS, "volume_id", "metric_name", "namespace", "stat", "period_sec", "interval", "merge_group"]
    counts = {r.volume_id: r["count"] for r in got.groupBy("volume_id").count().collect()}
    assert counts == {"": 12, "v-1": 4, "v-2": 4}
    assert got.select("Id").distinct().count() == 20
    assert got.where("merge_group = 'VolumeReadOps|AWS/EBS|Sum'").count() == 2
    odd = P.expected_series(inventory, volumes, [MetricSpec("M", "NS", "u", "Sum", 0, "")], [])
    assert {(r.period_sec, r.interval) for r in odd.collect()} == {(60, "PT1H")}


def test_join_volume_points(spark, rows):
    points = spark.createDataFrame(
        [(*SCOPE, "v-1", "IO", "NS", "Sum", 0, 1.5), (*SCOPE, "v-1", "IO", "NS", "Sum", 0, 1.0), (*SCOPE, "v-9", "IO", "NS", "Sum", 0, 5.0)],
        "account_id string, region string, volume_id string, metric_name string, namespace string, stat string, bucket long, metric_value double",
    )
    volumes = spark.createDataFrame([(*SCOPE, "i-1", "v-1")], "account_id string, region string, instance_id string, volume_id string")
    assert rows(P.join_volume_points(volumes, points).select("instance_id", "metric_value")) == [("i-1", 2.5)]


def test_enrich(spark, rows):
    points = spark.createDataFrame(
        [(*SCOPE, "i-1", "CPUUtilization", None, "Average", 300, 1.0), (*SCOPE, "i-1", "Other", "X", "Sum", 86400, 2.0), (*SCOPE, "i-9", "Other", "X", "Sum", 0, 2.0)],
        "account_id string, region string, instance_id string, metric_name string, namespace string, stat string, bucket long, metric_value double",
    )
    resources = spark.createDataFrame(
        [(*SCOPE, "i-1", "arn", ""), (*SCOPE, "i-9", "", "x")],
        "account_id string, region string, instance_id string, resource_id string, resource_name string",
    )
    got = P.enrich(points, resources, INSTANCE_SPECS, service_name="EC2", namespace="AWS/EC2")
    shown = got.select("resource_id", "resource_name", "metric_name", "namespace", "unit", "metric_unit", "date", "metric_date", "service_name")
    assert rows(shown) == [
        ("arn", "i-1", "CPUUtilization", "AWS/EC2", "Percent", "Percent", "1970-01-01T00:05:00Z", "1970-01-01", "EC2"),
        ("arn", "i-1", "Other", "X", "", "", "1970-01-02T00:00:00Z", "1970-01-02", "EC2"),
    ]


def test_first_unit_wins():
    specs = [MetricSpec("M", "N", "a"), MetricSpec("M", "N", "b")]
    assert P.first_units(specs) == {"M": "a"}


def test_period_statistic(spark, rows):
    specs = [MetricSpec("a", "N", "u", "Average", 300, "PT5M"), MetricSpec("b", "N", "u", "Sum", 86400, "P1D")]
    ts = [dt.datetime(2024, 1, 1, 0, m, tzinfo=UTC) for m in (0, 4, 5)]
    events = spark.createDataFrame(
        [("x", m, t, v) for m in ("a", "b", "c") for t, v in zip(ts, (1.0, 2.0, 4.0))],
        "resource_id string, metric_name string, ts timestamp, value double",
    )
    got = P.period_statistic(events, specs, ["resource_id"])
    start = 1704067200
    assert rows(got.select("metric_name", "bucket", "metric_value")) == [
        ("a", start, 1.5),
        ("a", start + 300, 4.0),
        ("b", start, 7.0),
    ]


def test_fetch_window_is_half_open(spark):
    as_of = dt.datetime(2024, 1, 8, tzinfo=UTC)
    days = spark.createDataFrame([(dt.datetime(2024, 1, d, tzinfo=UTC),) for d in (1, 2, 7, 8)], "ts timestamp")
    got = [r.ts.day for r in P.landed_within(days, as_of, 6).collect()]
    assert got == [2, 7]
