"""Daily roll-up."""

import datetime as dt

import pytest

from cumulo.operators import rollup as R
from cumulo.schemas import INSTANCE_SPECS, METRIC_SCHEMA, MetricSpec, daily_native, sub_daily
from cumulo.sources.tables import looks_back

RAW = (
    "client_id string, account_id string, service_name string, resource_id string, metric_name string, "
    "metric_date string, date string, aggregation_type string, metric_value double, resource_name string, region string"
)


def raw_row(metric, stat, hour, value, *, resource="r1", name="n", day="2024-01-05", account="a"):
    return ("c", account, "EC2", resource, metric, day, f"{day}T{hour:02d}:10:00Z", stat, value, name, "eu")


@pytest.fixture
def raw(spark):
    return lambda *rows: spark.createDataFrame(list(rows), RAW)


def test_mean_of_hourly_percentiles(raw, rows):
    points = [raw_row("CPUUtilization", "average", 1, float(v)) for v in range(1, 11)]
    points += [raw_row("CPUUtilization", "Average", 5, 3.0, name="m"), raw_row("CPUUtilization", "Sum", 5, 99.0)]
    got = R.rollup_sub_daily(raw(*points), sub_daily(INSTANCE_SPECS))
    assert rows(got.select("metric_value", "resource_name", "aggregation_type")) == [(6.0, "m", "p90")]


def test_daily_series_pass_through_with_repeats(raw, rows):
    points = [raw_row("NetworkIn", "SUM", 0, 5.0), raw_row("NetworkIn", "SUM", 0, 5.0), raw_row("CPUUtilization", "Average", 0, 1.0)]
    got = R.pass_through_daily(raw(*points), daily_native(INSTANCE_SPECS))
    assert rows(got.select("metric_name", "metric_value", "aggregation_type")) == [("NetworkIn", 5.0, "Sum")] * 2


def test_label_is_that_of_the_first_spec_of_the_name(raw, rows):
    specs = [MetricSpec("M", "N", "u", "Sum", 86400, "P1D"), MetricSpec("M", "N", "u", "Maximum", 86400, "P1D")]
    got = R.pass_through_daily(raw(raw_row("M", "maximum", 0, 5.0)), specs)
    assert rows(got.select("aggregation_type")) == [("Sum",)]


def test_daily_rollup_projection(raw, run_time):
    points = [
        raw_row("CPUUtilization", "Average", 1, 2.0),
        raw_row("CPUUtilization", "Average", 1, 2.0, account="b"),
        raw_row("NetworkIn", "Sum", 0, 5.0),
        raw_row("Ignored", "Sum", 0, 5.0),
    ]
    got = R.daily_rollup(raw(*points), INSTANCE_SPECS, namespace="AWS/EC2", run_time=run_time)
    assert got.schema.fieldNames() == METRIC_SCHEMA.fieldNames()
    found = {(r.account_id, r.metric_name): r for r in got.collect()}
    assert set(found) == {("a", "CPUUtilization"), ("b", "CPUUtilization"), ("a", "NetworkIn")}
    row = found["a", "NetworkIn"]
    assert (row.date, row.metric_date, row.year_month) == ("2024-01-05", "2024-01-05", "2024-01")
    assert (row.unit, row.metric_unit, row.namespace, row.cloud_name) == ("", "", "AWS/EC2", "aws")
    assert row.ingestion_timestamp == "2024-02-01 06:30:00"


def test_rollup_without_specs_is_empty(raw, run_time):
    got = R.daily_rollup(raw(raw_row("M", "Sum", 0, 1.0)), [], namespace="N", run_time=run_time)
    assert got.count() == 0


def test_hours_follow_utc_and_malformed_times_share_an_hour(raw, rows):
    first, second = list(raw_row("CPUUtilization", "Average", 0, 1.0)), list(raw_row("CPUUtilization", "Average", 0, 9.0))
    first[6] = second[6] = "soon"
    got = R.hourly_percentile(raw(tuple(first), tuple(second)), sub_daily(INSTANCE_SPECS))
    assert rows(got.select("hr", "hourly_value")) == [(None, 9.0)]


def test_percentile_labels():
    assert [R.percentile_label(p) for p in (0.9, 0.29, 0.95)] == ["p90", "p28", "p95"]


def test_lookback_is_inclusive(raw):
    days = [raw_row("M", "Sum", 0, 1.0, day=f"2024-01-{d:02d}") for d in (23, 24, 31)]
    kept = raw(*days).where(looks_back("EC2", dt.date(2024, 1, 31), 7))
    assert sorted(r.metric_date for r in kept.collect()) == ["2024-01-24", "2024-01-31"]
    assert raw(*days).where(looks_back("S3", dt.date(2024, 1, 31), 7)).count() == 0


def test_metric_names_reach_the_scan(spark, raw, tmp_path):
    raw(raw_row("NetworkIn", "Sum", 0, 5.0)).write.parquet(str(tmp_path / "raw"))
    df = R.pass_through_daily(spark.read.parquet(str(tmp_path / "raw")), daily_native(INSTANCE_SPECS))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "In(metric_name, [" in plan.split("PushedFilters: ")[1]
