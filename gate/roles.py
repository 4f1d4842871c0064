"""The roles the test tables play.

``events`` are metric points: user -> resource, type -> metric, value -> value, id -> arrival.
``orders`` with ``customer`` and ``nation`` are instances, ``lineitem`` their volumes, ``part`` is
the service catalog.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulo.functions.time import bucket_text, iso_utc
from cumulo.operators import points as P
from cumulo.operators.shape import stamp
from cumulo.schemas import INSTANCE_DOC, MetricSpec
from gate.registry import table

CLIENT, OTHER_CLIENT = "tenant-a", "tenant-b"
ACCOUNT, REGION = "000000000001", "eu-west-1"
SERVICE, NAMESPACE = "EC2", "AWS/EC2"
RUN_TIME = dt.datetime(2024, 1, 31, 6, 30, tzinfo=dt.timezone.utc)
AS_OF = RUN_TIME.date()
WHOLE_MONTH = 30

EVENT_SPECS = (
    MetricSpec("view", "AWS/EC2", "Percent", "Average", 300, "PT5M"),
    MetricSpec("click", "AWS/EC2", "Percent", "Average", 300, "PT5M"),
    MetricSpec("purchase", "AWS/EBS", "Bytes", "Sum", 86400, "P1D", "volume"),
    MetricSpec("signup", "AWS/EBS", "Count", "Sum", 86400, "P1D", "volume"),
    MetricSpec("error", "AWS/EBS", "Count", "Sum", 86400, "P1D", "volume"),
)

SQL_SPECS = """
specs(metric_name, namespace, unit, stat, period, "interval", scope) AS (VALUES
  ('view', 'AWS/EC2', 'Percent', 'Average', 300, 'PT5M', 'instance'),
  ('click', 'AWS/EC2', 'Percent', 'Average', 300, 'PT5M', 'instance'),
  ('purchase', 'AWS/EBS', 'Bytes', 'Sum', 86400, 'P1D', 'volume'),
  ('signup', 'AWS/EBS', 'Count', 'Sum', 86400, 'P1D', 'volume'),
  ('error', 'AWS/EBS', 'Count', 'Sum', 86400, 'P1D', 'volume'))
"""


def instant(name: str) -> Column:
    """A zone-less time of the test tables as a UTC instant."""
    return F.col(name).cast("timestamp")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as metric points of a resource."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("res/"), "user_id").alias("resource_id"),
        "user_id",
        F.col("event_type").alias("metric_name"),
        instant("ts").alias("ts"),
        "value",
        "props",
    )


def raw_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a row of the raw metric table, next to its event id."""
    label = F.when(F.col("metric_name").isin("view", "click"), "Average").otherwise("Sum")
    date = iso_utc(F.col("ts"))
    rows = points(spark, sf_dir).select(
        "event_id",
        F.lit(ACCOUNT).alias("account_id"),
        label.alias("aggregation_type"),
        date.alias("date"),
        F.substring(date, 1, 10).alias("metric_date"),
        "metric_name",
        F.col("value").alias("metric_value"),
        F.lit(NAMESPACE).alias("namespace"),
        F.lit(REGION).alias("region"),
        "resource_id",
        F.concat(F.lit("user "), "user_id").alias("resource_name"),
        F.lit(SERVICE).alias("service_name"),
        F.lit("").alias("unit"),
        F.lit("").alias("metric_unit"),
    )
    return stamp(rows, CLIENT, RUN_TIME)


SQL_RAW = f"""
raw AS (
  SELECT event_id, '{ACCOUNT}' AS account_id,
         CASE WHEN event_type IN ('view', 'click') THEN 'Average' ELSE 'Sum' END AS aggregation_type,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS date, strftime(ts, '%Y-%m-%d') AS metric_date,
         event_type AS metric_name, value AS metric_value, '{NAMESPACE}' AS namespace,
         '{REGION}' AS region, 'res/' || user_id AS resource_id,
         'user ' || user_id AS resource_name, '{SERVICE}' AS service_name, '' AS unit,
         '' AS metric_unit, '{CLIENT}' AS client_id, 'aws' AS cloud_name, '2024-01' AS year_month,
         '2024-01-31T06:30:00+00:00' AS ingestion_timestamp,
         '2024-01-31T06:30:00Z' AS job_runtime_utc, ts
  FROM events)
"""


def period_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events reduced to the statistic of their metric per period, as raw metric rows."""
    reduced = P.period_statistic(points(spark, sf_dir), EVENT_SPECS, ["resource_id"])
    date = bucket_text(F.col("bucket"))
    rows = reduced.select(
        "resource_id",
        "metric_name",
        F.col("stat").alias("aggregation_type"),
        date.alias("date"),
        F.substring(date, 1, 10).alias("metric_date"),
        "metric_value",
        F.lit(ACCOUNT).alias("account_id"),
        F.lit(SERVICE).alias("service_name"),
        F.concat(F.lit("name of "), "resource_id").alias("resource_name"),
        F.lit(REGION).alias("region"),
    )
    return stamp(rows, CLIENT, RUN_TIME)


SQL_BUCKET = """
CASE WHEN s."interval" IN ('P1D', 'PT1D') OR s.period >= 86400 THEN date_trunc('day', e.ts)
     ELSE date_trunc('day', e.ts)
          + to_minutes(((hour(e.ts) * 60 + minute(e.ts)) // (s.period // 60)) * (s.period // 60))
END
"""

SQL_PERIOD = f"""
period AS (
  SELECT resource_id, metric_name, stat, bucket,
         CAST(round(CAST(CASE WHEN stat = 'Sum' THEN sum(value) ELSE avg(value) END AS DECIMAL(28, 9)), 6)
              AS DOUBLE) AS metric_value
  FROM (SELECT 'res/' || e.user_id AS resource_id, s.metric_name, s.stat, e.value,
               {SQL_BUCKET} AS bucket
        FROM events e JOIN specs s ON e.event_type = s.metric_name)
  GROUP BY resource_id, metric_name, stat, bucket)
"""


def daily_keyed(df: DataFrame) -> DataFrame:
    """The job time as text: the two engines differ in how they type an instant."""
    return df.withColumn("job_runtime_utc", iso_utc(F.col("job_runtime_utc")))


# ---------------------------------------------------------------------------------------------
# Instances
# ---------------------------------------------------------------------------------------------


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as an instance document, with every kind of missing field."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey").cast("string")
    key = F.col("o_orderkey").cast("string")
    volume = lambda suffix: F.struct(F.concat(F.lit("vol-"), key, F.lit(suffix)).alias("VolumeId"))
    tag = lambda k, v: F.struct(F.lit(k).alias("Key"), v.cast("string").alias("Value"))
    nothing = F.lit(None).cast("string")
    fields = {
        "InstanceId": F.when(status == "P", "").otherwise(F.concat(F.lit("i-"), key)),
        "InstanceType": priority,
        "Architecture": F.when(segment != "FURNITURE", F.lower(segment)),
        "Hypervisor": F.lit(""),
        "Platform": F.when(segment != "MACHINERY", F.concat(F.lit("on "), segment)),
        "PlatformDetails": F.when(status == "F", "").when(status == "O", "Linux"),
        "LaunchTime": F.when(priority != "5-LOW", instant("o_orderdate")),
        "PrivateIpAddress": F.when(priority != "1-URGENT", F.concat(F.lit("10.0.0."), nation)),
        "PublicIpAddress": F.when(status == "F", F.concat(F.lit("52.0.0."), nation)).otherwise(""),
        "VpcId": F.when(priority != "2-HIGH", F.concat(F.lit("vpc-"), nation)),
        "SubnetId": F.when(priority == "3-MEDIUM", "").otherwise(F.concat(F.lit("subnet-"), nation)),
        "State": F.when(priority != "4-NOT SPECIFIED", F.struct(status.alias("Name"))),
        "Monitoring": F.struct(F.when(F.col("c_acctbal") > 0, "enabled").alias("State")),
        "Placement": F.struct(F.concat(F.lit("az-"), nation).alias("AvailabilityZone")),
        "Tags": F.when(
            priority == "5-LOW",
            F.array(tag("env", status), tag("Name", F.col("c_name")), tag("Name", F.lit("second"))),
        )
        .when(priority == "2-HIGH", F.array(tag("Name", nothing)))
        .when(priority != "1-URGENT", F.array(tag("env", status))),
        "BlockDeviceMappings": F.when(
            status != "F",
            F.array(
                F.struct(volume("-a").alias("Ebs")),
                F.struct(F.lit(None).cast("struct<VolumeId:string>").alias("Ebs")),
                F.struct(F.struct(F.lit("").alias("VolumeId")).alias("Ebs")),
                F.struct(volume("-b").alias("Ebs")),
            ),
        ),
        "NetworkInterfaces": F.when(
            priority != "4-NOT SPECIFIED",
            F.array(
                F.struct(
                    F.when(status != "O", F.concat(F.lit("172.16.0."), nation)).alias("PrivateIpAddress"),
                    F.lit("first-subnet").alias("SubnetId"),
                    nothing.alias("VpcId"),
                    F.lit(None).cast("struct<PublicIp:string>").alias("Association"),
                ),
                F.struct(
                    F.lit("172.16.1.1").alias("PrivateIpAddress"),
                    F.lit("second-subnet").alias("SubnetId"),
                    F.lit("second-vpc").alias("VpcId"),
                    F.struct(
                        F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("54.0.0."), nation)).alias("PublicIp")
                    ).alias("Association"),
                ),
            ),
        ),
    }
    document = F.struct(
        *[fields[f.name].cast(f.dataType).alias(f.name) for f in INSTANCE_DOC]
    )
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey",
            "o_custkey",
            F.lpad(nation, 12, "0").alias("account_id"),
            F.concat(F.lit("region-"), "n_regionkey").alias("region"),
            document.alias("instance"),
        )
        .withColumn("raw_data", F.to_json("instance"))
    )


SQL_INSTANCES = """
inst AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate, c_name, c_acctbal, c_mktsegment,
         lpad(CAST(c_nationkey AS VARCHAR), 12, '0') AS account_id, 'region-' || n_regionkey AS region,
         CASE WHEN o_orderstatus <> 'P' THEN 'i-' || o_orderkey ELSE '' END AS instance_id,
         CAST(c_nationkey AS VARCHAR) AS nation
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""


# Orders of a customer share pages of bounded size: order keys are unique, so a page holds at
# most this many however many orders a customer has.
PAGE_SIZE = 64


def pages(spark: SparkSession, sf_dir: str, instance: str) -> DataFrame:
    """Inventory pages: a reservation with the instances of a customer, and an empty one."""
    chunk = F.floor(F.col("o_orderkey") / PAGE_SIZE)
    grouped = (
        instances(spark, sf_dir)
        .groupBy("account_id", "region", "o_custkey", chunk.alias("chunk"))
        .agg(F.collect_list(instance).alias("Instances"))
    )
    full = F.struct("Instances")
    empty = F.struct(F.slice("Instances", 1, 0).alias("Instances"))
    return grouped.select("account_id", "region", F.array(full, empty).alias("Reservations"))


# Points of a series share blocks of bounded size: event ids are unique and grow over time.
BLOCK_SIZE = 4096


def result_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric result blocks: ``error`` blocks miss a value, values below one are NULL."""
    chunk = F.floor(F.col("event_id") / BLOCK_SIZE)
    grouped = (
        points(spark, sf_dir)
        .groupBy("user_id", "metric_name", chunk.alias("chunk"))
        .agg(F.sort_array(F.collect_list(F.struct("event_id", "ts", "value"))).alias("points"))
    )
    values = F.transform("points", lambda p: F.when(p["value"] >= 1, p["value"]))
    return grouped.select(
        F.concat_ws("|", "user_id", "metric_name").alias("Id"),
        "chunk",
        F.transform("points", lambda p: p["ts"]).alias("Timestamps"),
        F.when(F.col("metric_name") == "error", F.slice(values, 1, F.size(values) - 1))
        .otherwise(values)
        .alias("Values"),
    )


def precise(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


SQL_PRECISE = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
