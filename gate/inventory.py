"""Inventory operators over ``orders`` with ``customer`` and ``nation`` as instances."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulo.functions.text import first_nonblank, json_texts
from cumulo.functions.time import iso_utc
from cumulo.operators import inventory as I
from cumulo.operators import points as P
from cumulo.operators import shape as S
from cumulo.schemas import INSTANCE_DOC, INVENTORY
from cumulo.session import scratch_dir
from cumulo.sources.landed import ARRIVAL, read_inventory_pages, read_metric_results
from gate import roles as G
from gate.registry import comparable, query, sql_comparable, table

# One SQL expression per inventory column, over the ``inst`` rows.
_SQL = {
    "resource_id": "'arn:aws:ec2:' || region || ':' || account_id || ':instance/' || instance_id",
    "availability_zone": "'az-' || nation",
    "instance_type": "o_orderpriority",
    "architecture": "CASE WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE lower(c_mktsegment) END",
    "instance_state": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderstatus END",
    "platform": """CASE WHEN o_orderstatus = 'O' THEN 'Linux'
                        WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE 'on ' || c_mktsegment END""",
    "hypervisor": "''",
    "monitoring_state": "CASE WHEN c_acctbal > 0 THEN 'enabled' ELSE '' END",
    "launch_time": """CASE WHEN o_orderpriority = '5-LOW' THEN ''
                           ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END""",
    "private_ip": """CASE WHEN o_orderpriority <> '1-URGENT' THEN '10.0.0.' || nation
                          WHEN o_orderstatus <> 'O' THEN '172.16.0.' || nation ELSE '' END""",
    "public_ip": """CASE WHEN o_orderstatus = 'F' THEN '52.0.0.' || nation
                         WHEN o_orderpriority <> '4-NOT SPECIFIED' AND c_acctbal > 5000
                         THEN '54.0.0.' || nation ELSE '' END""",
    "vpc_id": "CASE WHEN o_orderpriority <> '2-HIGH' THEN 'vpc-' || nation ELSE '' END",
    "subnet_id": """CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'first-subnet'
                         ELSE 'subnet-' || nation END""",
    "tags": """CASE o_orderpriority
        WHEN '1-URGENT' THEN '[]'
        WHEN '2-HIGH' THEN '[{"Key":"Name"}]'
        WHEN '5-LOW' THEN '[{"Key":"env","Value":"' || o_orderstatus || '"},{"Key":"Name","Value":"'
             || c_name || '"},{"Key":"Name","Value":"second"}]'
        ELSE '[{"Key":"env","Value":"' || o_orderstatus || '"}]' END""",
    "resource_name": "CASE WHEN o_orderpriority = '5-LOW' THEN c_name ELSE instance_id END",
    "ebs_volume_ids": """CASE WHEN o_orderstatus = 'F' THEN '[]'
        ELSE '["vol-' || o_orderkey || '-a","vol-' || o_orderkey || '-b"]' END""",
}
_FLAT = (
    "resource_id",
    "instance_id",
    "account_id",
    "region",
    "availability_zone",
    "instance_type",
    "architecture",
    "instance_state",
    "platform",
    "hypervisor",
    "monitoring_state",
    "launch_time",
    "private_ip",
    "public_ip",
    "vpc_id",
    "subnet_id",
    "tags",
    "resource_name",
    "ebs_volume_ids",
)


def _sql_select(*columns, key="o_orderkey", where="true"):
    chosen = ", ".join(f"{_SQL[c]} AS {c}" if c in _SQL else c for c in columns)
    lead = f"{key}, " if key else ""
    return f"WITH {G.SQL_INSTANCES} SELECT {lead}{chosen} FROM inst WHERE {where}"


_SQL_FLAT = _sql_select(*_FLAT, key="", where="instance_id <> ''")


@query(
    "unnest_two_levels",
    _sql_select("account_id", "region", "instance_id", "instance_type", key=""),
)
def unnest_two_levels(spark, sf_dir):
    rows = I.unnest_instances(G.pages(spark, sf_dir, "raw_data"))
    return rows.select(
        "account_id",
        "region",
        F.col("instance.InstanceId").alias("instance_id"),
        F.col("instance.InstanceType").alias("instance_type"),
    )


@query("scan_inventory_pages", _SQL_FLAT)
def scan_inventory_pages(spark, sf_dir):
    path = scratch_dir(spark, "pages")
    landed = G.pages(spark, sf_dir, "instance")
    landed.hint("rebalance", "account_id", "region").write.partitionBy("account_id", "region").json(path)
    pages = read_inventory_pages(spark, path)
    return I.flatten_instances(I.unnest_instances(pages)).select(*_FLAT)


@query(
    "malformed_documents",
    """
SELECT lpad(CAST(c_nationkey AS VARCHAR), 12, '0') AS account_id, c_custkey % 7 = 0 AS malformed,
       count(*) AS documents, count(*) FILTER (c_custkey % 7 <> 0) AS instances
FROM customer GROUP BY ALL
""",
)
def malformed_documents(spark, sf_dir):
    """Every seventh page is cut off: it is a marked row without instances, not a lost one."""
    path = scratch_dir(spark, "broken")
    key = F.col("c_custkey").cast("string")
    page = F.concat(F.lit('{"Reservations": [{"Instances": [{"InstanceId": "i-'), key, F.lit('"}]}]}'))
    cut = F.when(F.col("c_custkey") % 7 == 0, F.substring(page, 1, 40)).otherwise(page)
    account = F.lpad(F.col("c_nationkey").cast("string"), 12, "0").alias("account_id")
    landed = table(spark, sf_dir, "customer").select(account, F.lit("r").alias("region"), cut.alias("value"))
    landed.hint("rebalance", "account_id", "region").write.partitionBy("account_id", "region").text(path)
    pages = read_inventory_pages(spark, path)
    instances = F.when(~F.col("malformed"), F.size(F.col("Reservations")[0]["Instances"])).otherwise(0)
    return pages.groupBy("account_id", "malformed").agg(
        F.count(F.lit(1)).alias("documents"), F.sum(instances).cast("long").alias("instances")
    )


@query(
    "repeated_landing",
    f"""
WITH once AS (
  SELECT user_id, event_type, ts, round(value, 6) AS value FROM events WHERE event_type <> 'error' AND value >= 1
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type, ts ORDER BY event_id DESC) = 1)
SELECT CAST(user_id AS VARCHAR) AS instance_id, event_type AS metric_name, strftime(ts, '%Y-%m-%d') AS day,
       {sql_comparable('sum(value)')} AS metric_value
FROM once GROUP BY ALL
""",
)
def repeated_landing(spark, sf_dir):
    """Volume points that two overlapping runs landed are summed once."""
    path = scratch_dir(spark, "repeated")
    part = F.split("Id", "[|]")
    landed = G.result_blocks(spark, sf_dir).select(
        "Id",
        "Timestamps",
        "Values",
        F.explode(F.array(F.lit("1"), F.lit("2"))).alias("run"),
        F.lit(G.ACCOUNT).alias("account_id"),
        F.lit(G.REGION).alias("region"),
    )
    landed.hint("rebalance", "run").write.partitionBy("run", "account_id", "region").option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    ).json(path)
    points = P.zip_points(P.valid_blocks(read_metric_results(spark, path))).withColumns(
        {
            "instance_id": part[0],
            "metric_name": part[1],
            "namespace": F.lit("n"),
            "stat": F.lit("Sum"),
            "period_sec": F.lit(86400),
            "interval": F.lit("P1D"),
            "merge_group": F.lit("g"),
        }
    )
    summed = P.sum_volumes(P.align_points(P.latest_points(points, ARRIVAL)))
    return summed.select(
        "instance_id",
        "metric_name",
        F.date_format(F.timestamp_seconds("bucket"), "yyyy-MM-dd").alias("day"),
        comparable(F.col("metric_value")).alias("metric_value"),
    )


@query(
    "scan_metric_results",
    f"""
SELECT user_id || '|' || event_type AS Id, '{G.ACCOUNT}' AS account_id, '{G.REGION}' AS region,
       {G.SQL_PRECISE} AS ts, round(value, 6) AS metric_value
FROM events WHERE event_type <> 'error' AND value >= 1
""",
)
def scan_metric_results(spark, sf_dir):
    path = scratch_dir(spark, "results")
    landed = G.result_blocks(spark, sf_dir).select(
        "Id", "Timestamps", "Values", F.lit(G.ACCOUNT).alias("account_id"), F.lit(G.REGION).alias("region")
    )
    landed.hint("rebalance", "account_id", "region").write.partitionBy("account_id", "region").option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    ).json(path)
    points = P.zip_points(P.valid_blocks(read_metric_results(spark, path)))
    return points.select(
        "Id", "account_id", "region", G.precise(F.col("ts")).alias("ts"), "metric_value"
    )


@query("flatten_instance", _SQL_FLAT)
def flatten_instance(spark, sf_dir):
    return I.flatten_instances(G.instances(spark, sf_dir)).select(*_FLAT)


@query("require_id", _sql_select("instance_id", where="instance_id <> ''"))
def require_id(spark, sf_dir):
    ids = G.instances(spark, sf_dir).select(
        "o_orderkey", F.col("instance.InstanceId").alias("instance_id")
    )
    return I.require_id(ids, "instance_id")


@query("build_resource_arn", _sql_select("resource_id"))
def build_resource_arn(spark, sf_dir):
    arn = I.resource_arn(F.col("region"), F.col("account_id"), F.col("instance.InstanceId"))
    return G.instances(spark, sf_dir).select("o_orderkey", arn.alias("resource_id"))


@query("coalesce_blank", _sql_select("platform", "architecture", "monitoring_state"))
def coalesce_blank(spark, sf_dir):
    doc = F.col("instance")
    return G.instances(spark, sf_dir).select(
        "o_orderkey",
        first_nonblank(doc["PlatformDetails"], doc["Platform"]).alias("platform"),
        first_nonblank(doc["Architecture"]).alias("architecture"),
        first_nonblank(doc["Monitoring"]["State"]).alias("monitoring_state"),
    )


@query("fallback_first_match", _sql_select("public_ip"))
def fallback_first_match(spark, sf_dir):
    doc = F.col("instance")
    address = I.public_address(doc["PublicIpAddress"], doc["NetworkInterfaces"])
    return G.instances(spark, sf_dir).select("o_orderkey", address.alias("public_ip"))


@query("fallback_first_element", _sql_select("private_ip", "vpc_id", "subnet_id"))
def fallback_first_element(spark, sf_dir):
    doc = F.col("instance")
    fields = {"private_ip": "PrivateIpAddress", "vpc_id": "VpcId", "subnet_id": "SubnetId"}
    return G.instances(spark, sf_dir).select(
        "o_orderkey",
        *[
            I.from_first_interface(doc[field], doc["NetworkInterfaces"], field).alias(name)
            for name, field in fields.items()
        ],
    )


@query(
    "tag_lookup",
    f"""
WITH {G.SQL_INSTANCES}
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN c_name ELSE '' END AS name,
       CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN o_orderstatus ELSE '' END AS env
FROM inst
""",
)
def tag_lookup(spark, sf_dir):
    tags = F.coalesce(F.col("instance.Tags"), F.array().cast(INSTANCE_DOC["Tags"].dataType))
    return G.instances(spark, sf_dir).select(
        "o_orderkey", I.tag_value(tags, "Name").alias("name"), I.tag_value(tags, "env").alias("env")
    )


@query(
    "collect_nested_ids",
    f"""
WITH {G.SQL_INSTANCES}
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 2 END AS n,
       CASE WHEN o_orderstatus = 'F' THEN '' ELSE 'vol-' || o_orderkey || '-a,vol-' || o_orderkey || '-b'
       END AS ids
FROM inst
""",
)
def collect_nested_ids(spark, sf_dir):
    ids = I.volume_ids(F.col("instance.BlockDeviceMappings"))
    return G.instances(spark, sf_dir).select(
        "o_orderkey", F.size(ids).alias("n"), F.array_join(ids, ",").alias("ids")
    )


@query(
    "to_json_column",
    _sql_select("tags", "ebs_volume_ids", where="instance_id <> ''"),
)
def to_json_column(spark, sf_dir):
    flat = I.flatten_instances(G.instances(spark, sf_dir))
    return flat.select("o_orderkey", "tags", "ebs_volume_ids")


@query("format_utc_iso", _sql_select("launch_time"))
def format_utc_iso(spark, sf_dir):
    launch = iso_utc(F.col("instance.LaunchTime"))
    return G.instances(spark, sf_dir).select("o_orderkey", launch.alias("launch_time"))


@query(
    "parse_json_array",
    """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 2 ELSE 0 END AS n,
       CASE o_orderstatus WHEN 'O' THEN o_orderkey || ',' || o_orderpriority ELSE '' END AS ids
FROM orders
""",
)
def parse_json_array(spark, sf_dir):
    status = F.col("o_orderstatus")
    text = (
        F.when(status == "O", F.to_json(F.array(F.col("o_orderkey").cast("string"), "o_orderpriority")))
        .when(status == "F", "not json: [")
    )
    ids = json_texts(text)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.size(ids).alias("n"), F.array_join(ids, ",").alias("ids")
    )


@query(
    "conform_schema",
    "SELECT "
    + ", ".join(
        {
            "resource_id": "'cust/' || c_custkey AS resource_id",
            "instance_id": "CAST(c_custkey AS VARCHAR) AS instance_id",
            "region": "CAST(c_nationkey AS VARCHAR) AS region",
            "instance_type": "c_mktsegment AS instance_type",
        }.get(c, f"CAST(NULL AS VARCHAR) AS {c}")
        for c in INVENTORY.columns
    )
    + " FROM customer",
)
def conform_schema(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("cust/"), "c_custkey").alias("resource_id"),
        F.col("c_custkey").alias("instance_id"),
        F.col("c_nationkey").alias("region"),
        F.col("c_mktsegment").alias("instance_type"),
        F.col("c_acctbal").alias("not_declared"),
    )
    conformed = S.conform(rows, INVENTORY.schema)
    return conformed.withColumn("job_runtime_utc", F.col("job_runtime_utc").cast("string"))
