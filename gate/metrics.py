"""Metric points, roll-ups, filters and tenants over ``events`` (with ``orders``/``lineitem``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulo.functions.time import bucket_seconds, bucket_text, hour_of, iso_utc, month_of
from cumulo.operators import points as P
from cumulo.operators import reports
from cumulo.operators import rollup as R
from cumulo.operators import shape as S
from cumulo.operators.inventory import flatten_instances
from cumulo.schemas import DAILY_TABLES, METRIC_SCHEMA, MetricSpec, daily_native, sub_daily
from cumulo.sources import tables as T
from gate import roles as G
from gate.registry import comparable, query, sql_comparable, table

SUB_DAILY, DAILY = sub_daily(G.EVENT_SPECS), daily_native(G.EVENT_SPECS)

# ---------------------------------------------------------------------------------------------
# Roll-up
# ---------------------------------------------------------------------------------------------

_FLEET_RAW = G.SQL_RAW.replace("'res/' || user_id AS resource_id", "'fleet' AS resource_id")


@query(
    "hourly_percentile",
    f"""
WITH {_FLEET_RAW}
SELECT resource_id, metric_name, metric_date, CAST(hour(ts) AS INTEGER) AS hr,
       quantile_disc(metric_value, 0.9) AS hourly_value,
       min(resource_name) AS resource_name, min(region) AS region, 'p90' AS label
FROM raw WHERE metric_name IN ('view', 'click')
GROUP BY ALL
""",
)
def hourly_percentile(spark, sf_dir):
    raw = G.raw_points(spark, sf_dir).withColumn("resource_id", F.lit("fleet"))
    hourly = R.hourly_percentile(raw, SUB_DAILY)
    return hourly.select(
        "resource_id",
        "metric_name",
        "metric_date",
        "hr",
        "hourly_value",
        "resource_name",
        "region",
        F.lit(R.percentile_label(R.PERCENTILE)).alias("label"),
    )


_SQL_SUB_DAILY = """
hourly AS (
  SELECT resource_id, metric_name, metric_date, hour(ts) AS hr,
         quantile_disc(metric_value, 0.9) AS hourly_value,
         min(resource_name) AS resource_name, min(region) AS region
  FROM raw WHERE metric_name IN ('view', 'click') GROUP BY ALL),
sub_daily AS (
  SELECT resource_id, metric_name, metric_date, avg(hourly_value) AS metric_value,
         min(resource_name) AS resource_name, min(region) AS region, 'p90' AS aggregation_type
  FROM hourly GROUP BY ALL)
"""


@query(
    "daily_rollup_subdaily",
    f"""
WITH {G.SQL_RAW}, {_SQL_SUB_DAILY}
SELECT resource_id, metric_name, metric_date, {sql_comparable('metric_value')} AS metric_value,
       resource_name, region, aggregation_type
FROM sub_daily
""",
)
def daily_rollup_subdaily(spark, sf_dir):
    daily = R.rollup_sub_daily(G.raw_points(spark, sf_dir), SUB_DAILY)
    return daily.drop("client_id", "account_id", "service_name").withColumn(
        "metric_value", comparable(F.col("metric_value"))
    )


@query(
    "daily_passthrough",
    f"""
WITH {G.SQL_RAW}
SELECT resource_id, metric_name, metric_date, metric_value, resource_name, region,
       'Sum' AS aggregation_type
FROM raw WHERE metric_name IN ('purchase', 'signup', 'error')
""",
)
def daily_passthrough(spark, sf_dir):
    daily = R.pass_through_daily(G.raw_points(spark, sf_dir), DAILY)
    return daily.drop("client_id", "account_id", "service_name")


_SQL_DAILY_COLUMNS = f"""
'{G.CLIENT}' AS client_id, '{G.ACCOUNT}' AS account_id, '{G.SERVICE}' AS service_name,
'{G.NAMESPACE}' AS namespace, metric_date AS date, metric_date, resource_id, resource_name, region,
metric_name, aggregation_type, '' AS unit, '' AS metric_unit, 'aws' AS cloud_name,
substr(metric_date, 1, 7) AS year_month, '2024-01-31 06:30:00' AS ingestion_timestamp,
'2024-01-31T06:30:00Z' AS job_runtime_utc
"""


@query(
    "daily_projection",
    f"""
WITH {G.SQL_RAW}, daily AS (
  SELECT resource_id, metric_name, metric_date, metric_value, resource_name, region,
         'Sum' AS aggregation_type
  FROM raw WHERE metric_name IN ('purchase', 'signup', 'error'))
SELECT {_SQL_DAILY_COLUMNS}, metric_value FROM daily
""",
)
def daily_projection(spark, sf_dir):
    daily = R.pass_through_daily(G.raw_points(spark, sf_dir), DAILY)
    return G.daily_keyed(R.daily_projection(daily, G.NAMESPACE, G.RUN_TIME))


SQL_DAILY = f"""
{G.SQL_SPECS}, {G.SQL_PERIOD},
raw AS (
  SELECT resource_id, metric_name, stat AS aggregation_type, bucket AS ts,
         strftime(bucket, '%Y-%m-%d') AS metric_date, metric_value,
         'name of ' || resource_id AS resource_name, '{G.REGION}' AS region
  FROM period
  WHERE strftime(bucket, '%Y-%m-%d') >= '2024-01-01'),
{_SQL_SUB_DAILY},
daily AS (
  SELECT resource_id, metric_name, metric_date, metric_value, resource_name, region, aggregation_type
  FROM sub_daily
  UNION ALL
  SELECT resource_id, metric_name, metric_date, metric_value, resource_name, region, aggregation_type
  FROM raw WHERE metric_name IN ('purchase', 'signup', 'error'))
"""


def daily_values(spark, sf_dir):
    raw = G.period_points(spark, sf_dir)
    return R.daily_values(
        raw.where(T.looks_back(G.SERVICE, G.AS_OF, G.WHOLE_MONTH)), G.EVENT_SPECS
    )


def daily_rows(spark, sf_dir):
    """The flagship: raw events to daily metric rows of the whole month."""
    return R.daily_projection(daily_values(spark, sf_dir), G.NAMESPACE, G.RUN_TIME)


@query(
    "daily_rollup",
    f"""
WITH {SQL_DAILY}
SELECT {_SQL_DAILY_COLUMNS}, {sql_comparable('metric_value')} AS metric_value FROM daily
""",
)
def daily_rollup(spark, sf_dir):
    return G.daily_keyed(daily_rows(spark, sf_dir)).withColumn(
        "metric_value", comparable(F.col("metric_value"))
    )


@query(
    "period_statistic",
    f"""
WITH {G.SQL_SPECS}, {G.SQL_PERIOD}
SELECT resource_id, metric_name, stat, strftime(bucket, '%Y-%m-%dT%H:%M:%SZ') AS bucket, metric_value
FROM period
""",
)
def period_statistic(spark, sf_dir):
    reduced = P.period_statistic(G.points(spark, sf_dir), G.EVENT_SPECS, ["resource_id"])
    return reduced.select(
        "resource_id",
        "metric_name",
        "stat",
        bucket_text(F.col("bucket")).alias("bucket"),
        comparable(F.col("metric_value")).alias("metric_value"),
    )


# ---------------------------------------------------------------------------------------------
# Specifications and filters
# ---------------------------------------------------------------------------------------------


@query(
    "metric_specs",
    f"""
WITH {G.SQL_SPECS}
SELECT metric_name, namespace, unit, stat, period, "interval", scope, count(event_id) AS points
FROM specs LEFT JOIN events ON event_type = metric_name GROUP BY ALL
""",
)
def metric_specs(spark, sf_dir):
    specs = T.spec_frame(spark, G.EVENT_SPECS)
    used = G.points(spark, sf_dir).groupBy("metric_name").agg(F.count("event_id").alias("points"))
    return specs.join(used, "metric_name", "left").withColumn(
        "points", F.coalesce("points", F.lit(0).cast("long"))
    )


@query(
    "split_by_interval",
    """
SELECT event_id, event_type AS metric_name,
       CASE WHEN event_type IN ('view', 'click') THEN 'sub-daily' ELSE 'daily' END AS branch
FROM events
""",
)
def split_by_interval(spark, sf_dir):
    raw = G.raw_points(spark, sf_dir)
    branches = [
        raw.where(R.collects(specs)).select("event_id", "metric_name", F.lit(name).alias("branch"))
        for name, specs in (("sub-daily", SUB_DAILY), ("daily", DAILY))
    ]
    return branches[0].unionByName(branches[1])


@query(
    "spec_pair_filter",
    """
SELECT event_id, event_type AS metric_name, CASE event_type WHEN 'view' THEN 'AVERAGE' ELSE 'Sum' END
       AS aggregation_type
FROM events WHERE event_type IN ('view', 'purchase', 'signup', 'error')
""",
)
def spec_pair_filter(spark, sf_dir):
    # ``click`` rows carry a statistic that no specification of theirs asks for.
    label = F.when(F.col("metric_name") == "view", "AVERAGE").otherwise("Sum")
    raw = G.raw_points(spark, sf_dir).withColumn("aggregation_type", label)
    return raw.where(R.collects(G.EVENT_SPECS)).select("event_id", "metric_name", "aggregation_type")


@query(
    "lookback_filter",
    f"""
WITH {G.SQL_RAW}
SELECT event_id, metric_date FROM raw
WHERE client_id = '{G.CLIENT}' AND account_id = '{G.ACCOUNT}' AND service_name = '{G.SERVICE}'
  AND CAST(metric_date AS DATE) >= DATE '2024-01-31' - INTERVAL 7 DAY
""",
)
def lookback_filter(spark, sf_dir):
    tenant = (F.col("client_id") == G.CLIENT) & (F.col("account_id") == G.ACCOUNT)
    raw = G.raw_points(spark, sf_dir).where(tenant & T.looks_back(G.SERVICE, G.AS_OF, 7))
    return raw.select("event_id", "metric_date")


@query(
    "raw_window_filter",
    f"""
SELECT event_id, {G.SQL_PRECISE} AS ts FROM events
WHERE ts >= TIMESTAMP '2024-01-24 06:30:00' AND ts < TIMESTAMP '2024-01-31 06:30:00'
""",
)
def raw_window_filter(spark, sf_dir):
    recent = P.landed_within(G.points(spark, sf_dir), G.RUN_TIME, 7)
    return recent.select("event_id", G.precise(F.col("ts")).alias("ts"))


@query(
    "limit_resources",
    """
SELECT event_id, user_id FROM events
WHERE user_id IN (SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 25)
""",
)
def limit_resources(spark, sf_dir):
    resources = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    metrics = G.points(spark, sf_dir).select("event_id", "user_id")
    return S.limit_to_first(metrics, resources, "user_id", 25)


@query(
    "preview_rows",
    """
SELECT event_id, user_id, event_type, value, (SELECT count(*) FROM events) AS total_rows,
       4 AS total_columns
FROM events ORDER BY event_id LIMIT 20
""",
)
def preview_rows(spark, sf_dir):
    columns = ("event_id", "user_id", "event_type", "value")
    return S.preview(table(spark, sf_dir, "events").select(*columns), ["event_id"], 20)


# ---------------------------------------------------------------------------------------------
# Points
# ---------------------------------------------------------------------------------------------

BUCKET_CASES = (
    (300, "PT5M"),
    (3600, "PT1H"),
    (86400, ""),
    (300, " pt1d "),
    (420, ""),
    (90, ""),
    (30, ""),
    (0, ""),
    (7200, ""),
    (5400, ""),
)
_SQL_CASES = ", ".join(f"({p}, '{i}')" for p, i in BUCKET_CASES)


@query(
    "floor_timestamp",
    f"""
WITH cases(period, label) AS (VALUES {_SQL_CASES})
SELECT event_id, period, label, strftime(CASE
    WHEN upper(trim(label)) IN ('P1D', 'PT1D') OR period >= 86400 THEN date_trunc('day', ts)
    WHEN period <= 0 THEN date_trunc('hour', ts)
    WHEN period < 60 THEN date_trunc('minute', ts)
    WHEN period % 60 <> 0 THEN date_trunc('second', ts)
    ELSE date_trunc('day', ts)
         + to_minutes(((hour(ts) * 60 + minute(ts)) // (period // 60)) * (period // 60))
  END, '%Y-%m-%dT%H:%M:%SZ') AS bucket
FROM events, cases
""",
)
def floor_timestamp(spark, sf_dir):
    cases = F.array(
        *[F.struct(F.lit(p).alias("period"), F.lit(i).alias("label")) for p, i in BUCKET_CASES]
    )
    rows = G.points(spark, sf_dir).select("event_id", "ts", F.explode(cases).alias("case"))
    start = bucket_seconds(F.col("ts"), F.col("case.period"), F.col("case.label"))
    return rows.select("event_id", "case.period", "case.label", bucket_text(start).alias("bucket"))


_SQL_ZIPPED = """
zipped AS (
  SELECT user_id, event_type, event_id // 4096 AS chunk, ts, value,
         count(*) OVER (PARTITION BY user_id, event_type, event_id // 4096) AS n
  FROM events)
"""


@query(
    "zip_datapoints",
    f"""
WITH {_SQL_ZIPPED}
SELECT user_id || '|' || event_type AS Id, chunk, {G.SQL_PRECISE} AS ts, round(value, 6) AS metric_value
FROM zipped WHERE event_type <> 'error' AND value >= 1
""",
)
def zip_datapoints(spark, sf_dir):
    points = P.zip_points(P.valid_blocks(G.result_blocks(spark, sf_dir)))
    return points.select("Id", "chunk", G.precise(F.col("ts")).alias("ts"), "metric_value")


@query(
    "join_series_meta",
    f"""
WITH {_SQL_ZIPPED}, {G.SQL_SPECS}
SELECT DISTINCT user_id || '|' || event_type AS Id, chunk, n AS points, namespace, stat,
       period AS period_sec, "interval"
FROM zipped JOIN specs ON event_type = metric_name WHERE event_type <> 'signup'
""",
)
def join_series_meta(spark, sf_dir):
    # No series is known for sign-ups, so their blocks drop out.
    known = [s for s in G.EVENT_SPECS if s.metric_name != "signup"]
    series = (
        G.points(spark, sf_dir)
        .select("user_id")
        .distinct()
        .withColumn("spec", F.explode(T.spec_array(known)))
        .select(
            F.concat_ws("|", "user_id", "spec.metric_name").alias("Id"),
            "spec.namespace",
            "spec.stat",
            F.col("spec.period").alias("period_sec"),
            "spec.interval",
        )
    )
    joined = P.join_series(G.result_blocks(spark, sf_dir), series)
    return joined.select(
        "Id",
        "chunk",
        F.size("Timestamps").cast("long").alias("points"),
        "namespace",
        "stat",
        "period_sec",
        "interval",
    )


def _volume_points(spark, sf_dir):
    """Line items as points of a volume: quantity per month and return flag."""
    group = F.concat_ws("|", "metric_name", F.lit("AWS/EBS"), F.lit("Sum"))
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            F.lit(G.ACCOUNT).alias("account_id"),
            F.lit(G.REGION).alias("region"),
            F.concat(F.lit("i-"), "l_suppkey").alias("instance_id"),
            F.concat(F.lit("vol-"), "l_orderkey", F.lit("-"), "l_linenumber").alias("volume_id"),
            F.concat(F.lit("i-"), "l_orderkey").alias("order_instance"),
            F.concat(F.lit("Volume"), "l_returnflag").alias("metric_name"),
            F.lit("AWS/EBS").alias("namespace"),
            F.lit("Sum").alias("stat"),
            F.unix_seconds(F.date_trunc("month", G.instant("l_shipdate"))).alias("bucket"),
            F.col("l_quantity").alias("metric_value"),
        )
        .withColumn("merge_group", group)
    )


_SQL_MONTH = "strftime(date_trunc('month', l_shipdate), '%Y-%m-%dT%H:%M:%SZ')"
_SQL_VOLUMES = f"""
SELECT 'i-' || l_suppkey AS instance_id, 'Volume' || l_returnflag AS metric_name, 'AWS/EBS' AS namespace,
       'Sum' AS stat, {_SQL_MONTH} AS bucket, {sql_comparable('sum(l_quantity)')} AS metric_value
FROM lineitem GROUP BY ALL
"""


def _point_columns(df):
    return df.select(
        "instance_id",
        "metric_name",
        "namespace",
        "stat",
        bucket_text(F.col("bucket")).alias("bucket"),
        "metric_value",
    )


@query("sum_volumes", _SQL_VOLUMES)
def sum_volumes(spark, sf_dir):
    return _point_columns(P.sum_volumes(_volume_points(spark, sf_dir)))


@query(
    "instance_and_volume_series",
    f"""
{_SQL_VOLUMES}
UNION ALL
SELECT 'i-' || o_custkey, 'CPUUtilization', 'AWS/EC2', 'Average',
       strftime(o_orderdate, '%Y-%m-%dT00:00:00Z'), o_totalprice
FROM orders
""",
)
def instance_and_volume_series(spark, sf_dir):
    own = table(spark, sf_dir, "orders").select(
        F.lit(G.ACCOUNT).alias("account_id"),
        F.lit(G.REGION).alias("region"),
        F.concat(F.lit("i-"), "o_custkey").alias("instance_id"),
        F.lit("").alias("volume_id"),
        F.lit("CPUUtilization").alias("metric_name"),
        F.lit("AWS/EC2").alias("namespace"),
        F.lit("Average").alias("stat"),
        bucket_seconds(G.instant("o_orderdate"), F.lit(86400), F.lit("P1D")).alias("bucket"),
        F.col("o_totalprice").alias("metric_value"),
        F.lit(None).cast("string").alias("merge_group"),
    )
    volumes = _volume_points(spark, sf_dir).drop("order_instance")
    return _point_columns(P.instance_points(own.unionByName(volumes)))


@query(
    "join_resource_points",
    f"""
SELECT 'i-' || l_orderkey AS instance_id, 'vol-' || l_orderkey || '-' || l_linenumber AS volume_id,
       'Volume' || l_returnflag AS metric_name, {_SQL_MONTH} AS bucket,
       {sql_comparable('sum(l_quantity)')} AS metric_value
FROM lineitem GROUP BY ALL
""",
)
def join_resource_points(spark, sf_dir):
    points = _volume_points(spark, sf_dir)
    attached = points.select(
        "account_id", "region", F.col("order_instance").alias("instance_id"), "volume_id"
    ).distinct()
    joined = P.join_volume_points(attached, points)
    return joined.select(
        "instance_id",
        "volume_id",
        "metric_name",
        bucket_text(F.col("bucket")).alias("bucket"),
        "metric_value",
    )


_JOINED_SPECS = (
    MetricSpec("CPUUtilization", "AWS/EC2", "Percent", "Average", 86400, "P1D"),
    MetricSpec("VolumeReadOps", "AWS/EBS", "Count", "Sum", 86400, "P1D", "volume"),
)


@query(
    "resource_points",
    f"""
WITH {G.SQL_INSTANCES}, points AS (
  SELECT o_orderkey, 'VolumeReadOps' AS metric_name, 'AWS/EBS' AS namespace, 'Sum' AS stat, 'Count' AS unit,
         l_shipdate AS day, sum(l_quantity) AS value
  FROM inst JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O' GROUP BY ALL
  UNION ALL
  SELECT o_orderkey, 'CPUUtilization', 'AWS/EC2', 'Average', 'Percent', l_shipdate, l_extendedprice
  FROM inst JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' AND l_linenumber = 1)
SELECT 'arn:aws:ec2:' || region || ':' || account_id || ':instance/' || instance_id AS resource_id,
       CASE WHEN o_orderpriority = '5-LOW' THEN c_name ELSE instance_id END AS resource_name, account_id, region,
       metric_name, namespace, stat AS aggregation_type, unit, strftime(day, '%Y-%m-%dT00:00:00Z') AS date,
       strftime(day, '%Y-%m-%d') AS metric_date, {sql_comparable('value')} AS metric_value
FROM points JOIN inst USING (o_orderkey)
""",
)
def resource_points(spark, sf_dir):
    """The job's own way from instances and result blocks to points of resources: attached volumes, the
    series to ask for, blocks by series, volume sums, and what is known of the resource."""
    found = G.instances(spark, sf_dir)
    resources = flatten_instances(found.select("account_id", "region", "instance", "raw_data"))
    series = P.expected_series(resources, P.attached_volumes(resources), _JOINED_SPECS[:1], _JOINED_SPECS[1:])
    lines = table(spark, sf_dir, "lineitem").join(
        found.select("account_id", "region", "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    key = F.concat_ws("/", "account_id", "region", F.concat(F.lit("i-"), "l_orderkey"))
    # Every line is a point of one of two volumes, and each order's first line one of its instance, too.
    volume = F.concat(F.lit("vol-"), "l_orderkey", F.when(F.col("l_linenumber") % 2 == 0, "-a").otherwise("-b"))
    ids = F.array(
        F.struct(F.concat_ws("/", key, volume, F.lit("VolumeReadOps/Sum/86400")).alias("Id"), F.col("l_quantity").alias("value")),
        F.struct(
            F.when(F.col("l_linenumber") == 1, F.concat(key, F.lit("//CPUUtilization/Average/86400"))).alias("Id"),
            F.col("l_extendedprice").alias("value"),
        ),
    )
    points = lines.select(G.instant("l_shipdate").alias("ts"), F.explode(ids).alias("p")).where("p.Id IS NOT NULL")
    # An order has at most seven lines, hence a block at most seven points.
    blocks = points.groupBy("p.Id").agg(F.sort_array(F.collect_list(F.struct("ts", "p.value"))).alias("points"))
    blocks = blocks.select(
        "Id", F.transform("points", lambda p: p["ts"]).alias("Timestamps"), F.transform("points", lambda p: p["value"]).alias("Values")
    )
    aligned = P.align_points(P.zip_points(P.join_series(P.valid_blocks(blocks), series)))
    rows = P.enrich(P.instance_points(aligned), resources, _JOINED_SPECS, service_name=G.SERVICE, namespace=G.NAMESPACE)
    return rows.select(
        "resource_id", "resource_name", "account_id", "region", "metric_name", "namespace", "aggregation_type", "unit", "date",
        "metric_date", comparable(F.col("metric_value")).alias("metric_value"),
    )


@query(
    "expected_series",
    f"""
WITH {G.SQL_SPECS}, both_kinds AS (
  SELECT 'i-' || o_orderkey AS instance_id, '' AS volume_id, metric_name, stat, period,
         "interval", CAST(NULL AS VARCHAR) AS merge_group
  FROM orders, specs WHERE scope = 'instance'
  UNION ALL
  SELECT 'i-' || l_orderkey, 'vol-' || l_orderkey || '-' || l_linenumber, metric_name, stat, period,
         "interval", metric_name || '|' || namespace || '|' || stat
  FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem), specs WHERE scope = 'volume')
SELECT '{G.ACCOUNT}/{G.REGION}/' || instance_id || '/' || volume_id || '/' || metric_name || '/' || stat
       || '/' || period AS Id,
       instance_id, volume_id, metric_name, stat, period AS period_sec, "interval", merge_group
FROM both_kinds
""",
)
def expected_series(spark, sf_dir):
    scope = (F.lit(G.ACCOUNT).alias("account_id"), F.lit(G.REGION).alias("region"))
    instances = table(spark, sf_dir, "orders").select(
        *scope, F.concat(F.lit("i-"), "o_orderkey").alias("instance_id")
    )
    volumes = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber")
        .distinct()
        .select(
            *scope,
            F.concat(F.lit("i-"), "l_orderkey").alias("instance_id"),
            F.concat(F.lit("vol-"), "l_orderkey", F.lit("-"), "l_linenumber").alias("volume_id"),
        )
    )
    series = P.expected_series(instances, volumes, SUB_DAILY, DAILY)
    return series.drop("account_id", "region", "namespace")


# ---------------------------------------------------------------------------------------------
# Enrichment, counts and dates
# ---------------------------------------------------------------------------------------------


@query(
    "enrich_metrics",
    f"""
WITH {G.SQL_SPECS}
SELECT e.event_id, 'arn/' || c_custkey AS resource_id,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 'i-' || c_custkey ELSE c_name END AS resource_name,
       '{G.SERVICE}' AS service_name,
       CASE WHEN event_type = 'click' THEN '{G.NAMESPACE}' ELSE s.namespace END AS namespace,
       '{G.REGION}' AS region, s.unit, s.unit AS metric_unit, s.stat AS aggregation_type,
       strftime({G.SQL_BUCKET}, '%Y-%m-%dT%H:%M:%SZ') AS date,
       strftime(e.ts, '%Y-%m-%d') AS metric_date, round(e.value, 6) AS metric_value
FROM events e JOIN specs s ON e.event_type = s.metric_name JOIN customer ON c_custkey = e.user_id
WHERE c_mktsegment <> 'BUILDING'
""",
)
def enrich_metrics(spark, sf_dir):
    lookup = T.spec_frame(spark, G.EVENT_SPECS).select(
        "metric_name", "namespace", "stat", F.col("period").alias("period_sec"), "interval"
    )
    scope = {"account_id": F.lit(G.ACCOUNT), "region": F.lit(G.REGION)}
    points = (
        G.points(spark, sf_dir)
        .join(lookup, "metric_name")
        .withColumns(
            {
                **scope,
                "instance_id": F.concat(F.lit("i-"), "user_id"),
                "namespace": F.when(F.col("metric_name") != "click", F.col("namespace")),
                "metric_value": F.round("value", 6),
            }
        )
        .select(
            "event_id", "account_id", "region", "instance_id", "metric_name", "namespace", "stat",
            "period_sec", "interval", "ts", "metric_value",
        )
    )
    segment = F.col("c_mktsegment")
    resources = table(spark, sf_dir, "customer").select(
        *[v.alias(k) for k, v in scope.items()],
        F.concat(F.lit("i-"), "c_custkey").alias("instance_id"),
        F.when(segment == "BUILDING", "").otherwise(F.concat(F.lit("arn/"), "c_custkey")).alias("resource_id"),
        F.when(segment == "MACHINERY", "").otherwise(F.col("c_name")).alias("resource_name"),
    )
    rows = P.enrich(
        P.align_points(points), resources, G.EVENT_SPECS, service_name=G.SERVICE, namespace=G.NAMESPACE
    )
    return rows.select(
        "event_id", "resource_id", "resource_name", "service_name", "namespace", "region", "unit",
        "metric_unit", "aggregation_type", "date", "metric_date", "metric_value",
    )


@query(
    "lookup_unit",
    """
SELECT event_id, event_type AS metric_name,
       CASE event_type WHEN 'view' THEN 'Percent' WHEN 'click' THEN 'Count' ELSE '' END AS unit
FROM events
""",
)
def lookup_unit(spark, sf_dir):
    specs = [
        MetricSpec("view", "N", "Percent"),
        MetricSpec("view", "N", "Seconds"),
        MetricSpec("click", "N", "Count"),
    ]
    rows = G.points(spark, sf_dir).select("event_id", "metric_name")
    return P.with_unit(rows, specs).drop("metric_unit")


@query(
    "stamp_metadata",
    f"""
SELECT c_custkey, '{G.CLIENT}' AS client_id, 'aws' AS cloud_name, '2024-01' AS year_month,
       '2024-01-31T06:30:00+00:00' AS ingestion_timestamp, '2024-01-31T06:30:00Z' AS job_runtime_utc
FROM customer
""",
)
def stamp_metadata(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey")
    return G.daily_keyed(S.stamp(rows, G.CLIENT, G.RUN_TIME))


@query(
    "count_by_metric",
    "SELECT event_type AS metric_name, count(*) AS row_count FROM events GROUP BY ALL ORDER BY 1",
)
def count_by_metric(spark, sf_dir):
    return reports.count_by_metric(G.points(spark, sf_dir))


@query(
    "result_count",
    f"WITH {SQL_DAILY} SELECT count(*) AS row_count, count(*) = 0 AS is_empty FROM daily",
)
def result_count(spark, sf_dir):
    return reports.result_count(daily_rows(spark, sf_dir))


@query(
    "daily_merge_report",
    f"""
WITH {SQL_DAILY}
SELECT table_name, 2 * (SELECT count(*) FROM daily) AS rows_merged
FROM (VALUES ('test_bronze_aws_metrics'), ('bronze_aws_daily_metrics')) AS t(table_name)
""",
)
def daily_merge_report(spark, sf_dir):
    clients = S.client_list(G.CLIENT, G.OTHER_CLIENT)
    return reports.merge_report(
        daily_rows(spark, sf_dir), [t.name for t in DAILY_TABLES], len(clients)
    )


@query(
    "date_scalars",
    """
SELECT event_id,
       CASE WHEN event_type <> 'error' THEN CAST(hour(ts) AS INTEGER) END AS hr,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS day,
       CASE WHEN event_type <> 'error' THEN strftime(CAST(ts AS DATE) - INTERVAL 7 DAY, '%Y-%m-%d') END
         AS week_before,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m') END AS month
FROM events
""",
)
def date_scalars(spark, sf_dir):
    rows = G.points(spark, sf_dir)
    text = F.when(F.col("metric_name") == "error", "unknown").otherwise(iso_utc(F.col("ts")))
    day = F.substring(text, 1, 10).try_cast("date")
    return rows.select(
        "event_id",
        hour_of(text).alias("hr"),
        day.cast("string").alias("day"),
        F.date_sub(day, 7).cast("string").alias("week_before"),
        month_of(F.substring(text, 1, 10)).alias("month"),
    )


# ---------------------------------------------------------------------------------------------
# Deduplication and tenants
# ---------------------------------------------------------------------------------------------


def _keyed_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        "event_type",
        "event_id",
        "value",
    )


EVENT_KEY = ("user_id", "day", "event_type")
_SQL_KEYED = "SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_type, event_id, value FROM events"


@query(
    "dedup_keep_last",
    f"""
SELECT * FROM ({_SQL_KEYED})
QUALIFY row_number() OVER (PARTITION BY user_id, day, event_type ORDER BY event_id DESC) = 1
""",
)
def dedup_keep_last(spark, sf_dir):
    return S.keep_last(_keyed_events(spark, sf_dir), EVENT_KEY, ["event_id"])


@query(
    "dedup_any",
    f"""
SELECT user_id, day, event_type, max(value) AS value FROM ({_SQL_KEYED}) GROUP BY ALL
""",
)
def dedup_any(spark, sf_dir):
    return S.keep_one(_keyed_events(spark, sf_dir).drop("event_id"), EVENT_KEY)


@query(
    "duplicate_count",
    f"""
SELECT count(*) - count(DISTINCT (user_id, day, event_type)) AS duplicates FROM ({_SQL_KEYED})
""",
)
def duplicate_count(spark, sf_dir):
    return S.duplicate_count(_keyed_events(spark, sf_dir), EVENT_KEY)


@query(
    "tenant_fanout_raw",
    f"""
WITH {G.SQL_RAW}
SELECT event_id, account_id, metric_name, metric_value, client
       AS client_id FROM raw, (VALUES ('{G.CLIENT}'), ('{G.OTHER_CLIENT}')) AS c(client)
""",
)
def tenant_fanout_raw(spark, sf_dir):
    rows = S.for_clients(G.raw_points(spark, sf_dir), S.client_list(G.CLIENT, G.OTHER_CLIENT))
    return rows.select("event_id", "account_id", "metric_name", "metric_value", "client_id")


@query(
    "tenant_fanout_daily",
    f"""
WITH {SQL_DAILY}
SELECT resource_id, metric_name, metric_date, aggregation_type,
       {sql_comparable('metric_value')} AS metric_value, client AS client_id
FROM daily, (VALUES ('{G.CLIENT}'), ('{G.OTHER_CLIENT}')) AS c(client)
""",
)
def tenant_fanout_daily(spark, sf_dir):
    rows = S.for_clients(daily_rows(spark, sf_dir), S.client_list(G.CLIENT, G.OTHER_CLIENT))
    return rows.select(
        "resource_id",
        "metric_name",
        "metric_date",
        "aggregation_type",
        comparable(F.col("metric_value")).alias("metric_value"),
        "client_id",
    )


# ---------------------------------------------------------------------------------------------
# Views, records and optional tables
# ---------------------------------------------------------------------------------------------


@query(
    "temp_view_source",
    "SELECT event_type AS metric_name, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY ALL",
)
def temp_view_source(spark, sf_dir):
    return T.with_view(
        G.points(spark, sf_dir),
        "cumulo_merge_source",
        lambda session, name: session.sql(
            "select metric_name, count(*) as n, max(event_id) as last_id "
            f"from {name} group by metric_name"
        ),
    )


@query(
    "scan_if_exists",
    f"""
WITH {G.SQL_RAW}
SELECT resource_id, metric_name, date, metric_value, client_id FROM raw
""",
)
def scan_if_exists(spark, sf_dir):
    stored = S.conform(G.raw_points(spark, sf_dir), METRIC_SCHEMA)
    rows = T.with_view(
        stored, "cumulo_raw_points", lambda session, name: T.read_if_exists(session, name, METRIC_SCHEMA)
    )
    missing = T.read_if_exists(spark, "cumulo_no_such_table", METRIC_SCHEMA)
    return rows.unionByName(missing).select(
        "resource_id", "metric_name", "date", "metric_value", "client_id"
    )


@query(
    "records_with_schema",
    """
SELECT event_id, metric_name, metric_value, CAST(NULL AS VARCHAR) AS absent,
       CAST(user_id AS VARCHAR) AS odd
FROM (SELECT event_id, event_type AS metric_name, value AS metric_value, user_id FROM events)
""",
)
def records_with_schema(spark, sf_dir):
    record = F.to_json(
        F.struct("event_id", "metric_name", F.col("value").alias("metric_value"), F.col("user_id").alias("odd"), "props")
    )
    landed = G.points(spark, sf_dir).select(record.alias("record"))
    columns = {
        "event_id": "bigint",
        "metric_name": "string",
        "metric_value": "double",
        "absent": "string",
        "odd": "some unknown type",
    }
    return T.parse_records(landed, "record", columns)
