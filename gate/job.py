"""The whole ingestion job over landed documents made from ``customer`` and ``events``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cumulo.operators import points as P
from cumulo.plans.ingest import Landed, run_ingest, run_report as report_of
from cumulo.plans.params import IngestParams
from cumulo.schemas import DAILY_METRICS_COPY
from cumulo.session import scratch_dir
from cumulo.sources.tables import read_if_exists
from gate import roles as G
from gate.registry import comparable, query, sql_comparable, table
from gate.sinks import fresh_database

MIDNIGHT = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)


def _landed(spark, sf_dir):
    """Customers as instances with two volumes; each event type as a series of one of them."""
    nations = table(spark, sf_dir, "nation")
    homes = (
        table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            "c_name",
            F.lpad(F.col("n_regionkey").cast("string"), 12, "0").alias("account_id"),
            F.concat(F.lit("region-"), "n_regionkey").alias("region"),
        )
    )
    key = F.col("c_custkey").cast("string")
    volume = lambda suffix: F.struct(
        F.struct(F.concat(F.lit("vol-"), key, F.lit(suffix)).alias("VolumeId")).alias("Ebs")
    )
    instance = F.struct(
        F.concat(F.lit("i-"), key).alias("InstanceId"),
        F.array(F.struct(F.lit("Name").alias("Key"), F.col("c_name").alias("Value"))).alias("Tags"),
        F.array(volume("-a"), volume("-b")).alias("BlockDeviceMappings"),
    )
    reservation = F.struct(F.array(instance).alias("Instances"))
    pages = homes.select("account_id", "region", F.array(reservation).alias("Reservations"))

    kind = F.col("metric_name")
    series = (
        F.when(kind == "view", "/CPUUtilization/Average/300")
        .when(kind == "click", "/MemoryUtilization/Average/300")
        .when(kind == "purchase", F.concat(F.lit("vol-"), "user_id", F.lit("-a/VolumeReadOps/Sum/86400")))
        .when(kind == "signup", F.concat(F.lit("vol-"), "user_id", F.lit("-b/VolumeReadOps/Sum/86400")))
        .otherwise("/NetworkIn/Sum/86400")
    )
    # The monitoring service hands out one statistic per period: at most 288 points a day.
    reduced = P.period_statistic(G.points(spark, sf_dir), G.EVENT_SPECS, ["user_id"])
    day = F.col("bucket") - F.pmod("bucket", F.lit(86400))
    blocks = (
        reduced.groupBy("user_id", "metric_name", day.alias("day"))
        .agg(F.sort_array(F.collect_list(F.struct("bucket", "metric_value"))).alias("points"))
        .join(homes, F.col("user_id") == F.col("c_custkey"))
        .select(
            "account_id",
            "region",
            F.concat("account_id", F.lit("/"), "region", F.lit("/i-"), "user_id", F.lit("/"), series).alias("Id"),
            F.transform("points", lambda p: F.timestamp_seconds(p["bucket"])).alias("Timestamps"),
            F.transform("points", lambda p: p["metric_value"]).alias("Values"),
        )
    )
    landed = Landed(scratch_dir(spark, "landed-pages"), scratch_dir(spark, "landed-results"))
    scope = ("account_id", "region")
    for df, path in ((pages, landed.inventory), (blocks, landed.metrics)):
        df.hint("rebalance", *scope).write.partitionBy(*scope).json(path)
    return landed


_SQL_JOB = f"""
{G.SQL_SPECS}, {G.SQL_PERIOD},
hourly AS (
  SELECT resource_id, metric_name, date_trunc('day', bucket) AS day, hour(bucket) AS hr,
         quantile_disc(metric_value, 0.9) AS value
  FROM period WHERE metric_name IN ('view', 'click') GROUP BY ALL),
daily AS (
  SELECT resource_id, CASE metric_name WHEN 'view' THEN 'CPUUtilization' ELSE 'MemoryUtilization' END
         AS metric_name, day, 'p90' AS aggregation_type, avg(value) AS value
  FROM hourly GROUP BY resource_id, metric_name, day
  UNION ALL
  SELECT resource_id, 'VolumeReadOps', bucket, 'Sum', sum(metric_value) FROM period
  WHERE metric_name IN ('purchase', 'signup') GROUP BY resource_id, bucket
  UNION ALL
  SELECT resource_id, 'NetworkIn', bucket, 'Sum', metric_value FROM period WHERE metric_name = 'error')
"""


@query(
    "ingest_job",
    f"""
WITH {_SQL_JOB}
SELECT client_id, lpad(CAST(n_regionkey AS VARCHAR), 12, '0') AS account_id,
       'arn:aws:ec2:region-' || n_regionkey || ':' || lpad(CAST(n_regionkey AS VARCHAR), 12, '0')
         || ':instance/i-' || c_custkey AS resource_id,
       c_name AS resource_name, 'region-' || n_regionkey AS region, metric_name,
       strftime(day, '%Y-%m-%d') AS metric_date, strftime(day, '%Y-%m') AS year_month, aggregation_type,
       {sql_comparable('value')} AS metric_value
FROM daily JOIN customer ON resource_id = 'res/' || c_custkey JOIN nation ON c_nationkey = n_nationkey,
     (VALUES ('{G.CLIENT}'), ('{G.OTHER_CLIENT}')) AS c(client_id)
""",
)
def ingest_job(spark, sf_dir):
    """Landed documents to inventory, raw metrics and daily metrics for two tenants."""
    database = fresh_database(spark, "job")
    params = IngestParams(
        G.CLIENT, database, additional_client_id=G.OTHER_CLIENT, window_days=G.WHOLE_MONTH
    )
    run_ingest(spark, params, _landed(spark, sf_dir), MIDNIGHT)
    stored = read_if_exists(
        spark, f"{database}.{DAILY_METRICS_COPY.name}", DAILY_METRICS_COPY.schema
    )
    return stored.select(
        "client_id",
        "account_id",
        "resource_id",
        "resource_name",
        "region",
        "metric_name",
        "metric_date",
        "year_month",
        "aggregation_type",
        comparable(F.col("metric_value")).alias("metric_value"),
    )


@query(
    "run_report",
    f"""
WITH {_SQL_JOB},
raw AS (
  SELECT CASE metric_name WHEN 'view' THEN 'CPUUtilization' WHEN 'click' THEN 'MemoryUtilization'
              WHEN 'error' THEN 'NetworkIn' ELSE 'VolumeReadOps' END AS metric_name, resource_id, bucket
  FROM period JOIN customer ON resource_id = 'res/' || c_custkey GROUP BY ALL),
stored AS (
  SELECT 'bronze_aws_ec2_instances_v1' AS name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'bronze_aws_metrics_v1', count(*) FROM raw HAVING EXISTS (SELECT 1 FROM customer)
  UNION ALL
  SELECT name, count(*) FROM daily JOIN customer ON resource_id = 'res/' || c_custkey,
         (VALUES ('test_bronze_aws_metrics'), ('bronze_aws_daily_metrics')) AS t(name) GROUP BY name)
SELECT 'metric_rows' AS section, metric_name AS name, count(*)::BIGINT AS value FROM raw GROUP BY metric_name
UNION ALL SELECT 'rows_merged', name, (2 * n)::BIGINT FROM stored
UNION ALL SELECT 'failures', name, 0 FROM stored
UNION ALL SELECT 'duplicates', name, 0 FROM stored WHERE name = 'bronze_aws_metrics_v1'
""",
)
def run_report(spark, sf_dir):
    """What a run of the job for two tenants has told about itself."""
    database = fresh_database(spark, "report")
    params = IngestParams(
        G.CLIENT, database, additional_client_id=G.OTHER_CLIENT, window_days=G.WHOLE_MONTH
    )
    run_ingest(spark, params, _landed(spark, sf_dir), MIDNIGHT)
    told = report_of(spark, database, MIDNIGHT)
    sections = ("metric_rows", "rows_merged", "failures", "duplicates")
    return told.where(F.col("section").isin(*sections)).select("section", "name", "value")
