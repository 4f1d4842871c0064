"""Physical plans: what must and must not be in them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cumulo.operators import points as P
from cumulo.operators import rollup as R
from cumulo.operators import upsert as U
from cumulo.schemas import INSTANCE_SPECS, RAW_METRICS, VOLUME_SPECS
from cumulo.sources.tables import read_raw_metrics

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored_metrics(spark, database):
    name = U.ensure_table(spark, database, RAW_METRICS)
    rows = spark.range(10).select(
        F.lit("c").alias("client_id"),
        F.concat(F.lit("a"), F.col("id") % 2).alias("account_id"),
        F.lit("2024-01").alias("year_month"),
        F.lit("EC2").alias("service_name"),
        F.concat(F.lit("r"), "id").alias("resource_id"),
        F.lit("CPUUtilization").alias("metric_name"),
        F.lit("Average").alias("aggregation_type"),
        F.lit("2024-01-30").alias("metric_date"),
        F.lit("2024-01-30T01:00:00Z").alias("date"),
        F.lit(1.0).alias("metric_value"),
    )
    U.append(rows, name, RAW_METRICS)
    return read_raw_metrics(
        spark,
        name,
        RAW_METRICS,
        client_id="c",
        accounts=["a1"],
        service_name="EC2",
        as_of=dt.date(2024, 1, 31),
        window_days=7,
    )


def test_tenant_and_account_prune_directories(stored_metrics):
    scan = plan(stored_metrics).split("PartitionFilters: [")[1].split("], PushedFilters")
    assert "client_id" in scan[0] and "account_id" in scan[0]
    assert stored_metrics.count() == 5


def test_merges_prune_directories_at_run_time(spark, database):
    """The touched partitions and the batch's directories reach the scans as runtime filters."""
    name = U.ensure_table(spark, database, RAW_METRICS)
    rows = spark.range(40).select(
        F.lit("c").alias("client_id"),
        F.concat(F.lit("a"), F.col("id") % 8).alias("account_id"),
        F.when(F.col("id") % 4 > 0, "2024-01").alias("year_month"),
        F.concat(F.lit("r"), "id").alias("resource_id"),
        F.lit("2024-01-30T01:00:00Z").alias("date"),
        F.lit("CPUUtilization").alias("metric_name"),
        F.lit("Average").alias("aggregation_type"),
    )
    U.append(rows, name, RAW_METRICS)
    target = spark.table(name)
    batch = U.as_stored(rows.where("account_id IN ('a0', 'a1')"), RAW_METRICS)
    touched = U.touched_partitions(batch, target, RAW_METRICS)
    found = touched.restrict(target)
    assert "dynamicpruning" in plan(found)
    assert len(found.collect()) == 10 and touched.count == 2
    scan = found._jdf.queryExecution().executedPlan()
    read = []

    def visit(node):
        if node.nodeName().startswith("Scan parquet") and "bronze_aws" in node.nodeName():
            read.append(node.metrics().apply("numPartitions").value())
        children = node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else None
        for child in [children] if children else [node.children().apply(i) for i in range(node.children().size())]:
            visit(child)
        if "QueryStage" in node.nodeName():
            visit(node.plan())

    visit(scan)
    assert read and max(read) == 2


@pytest.mark.parametrize("merged", [False, True])
def test_branches_skip_each_others_rows(spark, database, merged):
    """Files are in metric order, so a scan for some metrics reads about their share of the rows only."""
    name = U.ensure_table(spark, database, RAW_METRICS)
    specs = INSTANCE_SPECS + VOLUME_SPECS
    metric = F.element_at(F.array(*[F.lit(s.metric_name) for s in specs]), (F.col("id") % len(specs) + 1).cast("int"))
    rows = spark.range(200_000).select(
        F.lit("c").alias("client_id"),
        F.lit("a").alias("account_id"),
        F.lit("2024-01").alias("year_month"),
        F.concat(F.lit("r"), F.col("id") % 977).alias("resource_id"),
        metric.alias("metric_name"),
        F.lit("Average").alias("aggregation_type"),
        F.lit("2024-01-30").alias("metric_date"),
        F.col("id").cast("string").alias("date"),
        F.rand(3).alias("metric_value"),
        F.lit("EC2").alias("service_name"),
    )
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.page.row.count.limit", "2000")
    try:
        U.append(rows, name, RAW_METRICS)
        if merged:
            U.upsert(rows.where("id % 1000 = 0").withColumn("metric_value", F.lit(5.0)), name, RAW_METRICS)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.page.row.count.limit")
    for wanted in (specs[:2], specs[2:6]):
        found = spark.table(name).where(R.collects(wanted)).select("metric_name", "metric_value")
        found.collect()
        plan_ = found._jdf.queryExecution().executedPlan()
        while plan_.children().size():
            plan_ = plan_.children().apply(0)
        read = plan_.metrics().apply("numOutputRows").value()
        assert 20_000 * len(wanted) <= read < 20_000 * len(wanted) + 20_000


def test_rollup_scans_push_filters_and_prune_columns(spark, stored_metrics):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    text = plan(R.daily_values(stored_metrics, INSTANCE_SPECS + VOLUME_SPECS))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = text.split("FileScan")[1:]
    assert len(scans) == 2
    for scan in scans:
        pushed = scan.split("PushedFilters: ")[1]
        assert "GreaterThanOrEqual(metric_date,2024-01-24)" in pushed
        assert "metric_name" in pushed
        assert "ingestion_timestamp" not in scan.split("ReadSchema: ")[1].split("\n")[0]


def test_percentile_and_mean_reduce_before_each_shuffle(stored_metrics):
    text = plan(R.rollup_sub_daily(stored_metrics, INSTANCE_SPECS[:2]))
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_percentile_approx" in text and "partial_avg" in text


def test_expected_series_needs_no_shuffle(spark):
    instances = spark.range(5).select(
        F.lit("a").alias("account_id"), F.lit("r").alias("region"), F.col("id").cast("string").alias("instance_id")
    )
    volumes = instances.withColumn("volume_id", F.lit("v"))
    text = plan(P.expected_series(instances, volumes, INSTANCE_SPECS, VOLUME_SPECS))
    assert "Exchange" not in text


def test_volume_sums_reduce_before_the_shuffle(spark):
    points = spark.range(5).select(
        *[F.lit("x").alias(c) for c in (*P.INSTANCE_KEYS, "metric_name", "namespace", "stat", "merge_group")],
        (F.col("id") * 300).alias("bucket"),
        F.lit(1.0).alias("metric_value"),
    )
    text = plan(P.sum_volumes(points))
    assert text.count("Exchange") == 1 and "partial_sum" in text
