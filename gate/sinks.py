"""Sinks: each writes below the shared folder, reads back and returns what is stored."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cumulo.operators import export as X
from cumulo.operators import rollup as R
from cumulo.operators import shape as S
from cumulo.operators import upsert as U
from cumulo.operators.catalog import admit, normalized
from cumulo.schemas import DAILY_METRICS, DAILY_TABLES, INVENTORY, RAW_METRICS, declared_schema
from cumulo.session import scratch_dir, stage
from cumulo.sources import tables as T
from gate import roles as G
from gate.catalog import SQL_CATALOG, catalog
from gate.metrics import SQL_DAILY, daily_values
from gate.registry import comparable, query, sql_comparable, table


def fresh_database(spark, label):
    name = f"cumulo_{label}_{uuid.uuid4().hex[:12]}"
    U.create_database(spark, name, scratch_dir(spark, f"warehouse-{label}"))
    return name


# ---------------------------------------------------------------------------------------------
# Tables
# ---------------------------------------------------------------------------------------------

_RAW_COLUMNS = ", ".join(RAW_METRICS.columns)


@query("ensure_table", f"WITH {G.SQL_RAW} SELECT {_RAW_COLUMNS} FROM raw")
def ensure_table(spark, sf_dir):
    database = fresh_database(spark, "ensure")
    name = U.ensure_table(spark, database, RAW_METRICS)
    U.append(G.raw_points(spark, sf_dir), name, RAW_METRICS)
    # The second call finds the table and leaves its rows alone.
    stored = spark.table(U.ensure_table(spark, database, RAW_METRICS)).select(*RAW_METRICS.columns)
    return G.daily_keyed(stored)


@query(
    "scan_raw_metrics_pruned",
    f"""
WITH {G.SQL_RAW}
SELECT resource_id, metric_name, date, metric_value, client_id,
       lpad(CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) // 10 AS VARCHAR), 12, '0') AS account_id
FROM raw JOIN events USING (event_id)
WHERE CAST(metric_date AS DATE) >= DATE '2024-01-31' - INTERVAL 30 DAY
""",
)
def scan_raw_metrics_pruned(spark, sf_dir):
    """Two tenants share the table; the scan reads only the directories of one."""
    name = U.ensure_table(spark, fresh_database(spark, "scan"), RAW_METRICS)
    number = F.get_json_object("props", "$.k").cast("int")
    accounts = G.points(spark, sf_dir).select(
        "event_id", F.lpad(F.floor(number / 10).cast("string"), 12, "0").alias("account_id")
    )
    raw = G.raw_points(spark, sf_dir).drop("account_id").join(accounts, "event_id")
    U.append(S.for_clients(raw, [G.CLIENT, G.OTHER_CLIENT]), name, RAW_METRICS)
    scanned = T.read_raw_metrics(
        spark,
        name,
        RAW_METRICS,
        client_id=G.CLIENT,
        service_name=G.SERVICE,
        as_of=G.AS_OF,
        window_days=G.WHOLE_MONTH,
    )
    return scanned.select(
        "resource_id", "metric_name", "date", "metric_value", "client_id", "account_id"
    )


# ---------------------------------------------------------------------------------------------
# Upserts
# ---------------------------------------------------------------------------------------------


@query(
    "upsert_records",
    f"""
WITH latest AS (
  SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
SELECT 'cust/' || c_custkey AS resource_id, lpad(CAST(c_nationkey AS VARCHAR), 12, '0') AS account_id,
       CASE WHEN o_custkey IS NULL THEN '2023-12' ELSE '2024-01' END AS year_month,
       coalesce(o_orderstatus, 'registered') AS instance_state,
       coalesce(o_orderpriority, c_mktsegment) AS instance_type,
       CASE WHEN o_custkey IS NULL THEN c_name END AS availability_zone
FROM customer LEFT JOIN latest ON c_custkey = o_custkey
UNION ALL
SELECT 'supp/' || s_suppkey, lpad(CAST(s_nationkey AS VARCHAR), 12, '0'), '2024-01', 'supplier', s_name, NULL
FROM supplier
""",
)
def upsert_records(spark, sf_dir):
    """Stored customers receive their latest order and move to another month; suppliers are new."""
    name = U.ensure_table(spark, fresh_database(spark, "records"), INVENTORY)
    customers = table(spark, sf_dir, "customer")
    account = lambda key: F.lpad(F.col(key).cast("string"), 12, "0").alias("account_id")
    client = F.lit(G.CLIENT).alias("client_id")
    resource = lambda prefix, key: F.concat(F.lit(prefix), key).alias("resource_id")
    U.upsert(
        customers.select(
            resource("cust/", "c_custkey"),
            account("c_nationkey"),
            client,
            F.lit("2023-12").alias("year_month"),
            F.lit("registered").alias("instance_state"),
            F.col("c_mktsegment").alias("instance_type"),
            F.col("c_name").alias("availability_zone"),
        ),
        name,
        INVENTORY,
    )
    month = F.lit("2024-01").alias("year_month")
    ordered = (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            resource("cust/", "o_custkey"),
            account("c_nationkey"),
            client,
            month,
            F.col("o_orderstatus").alias("instance_state"),
            F.col("o_orderpriority").alias("instance_type"),
            F.col("o_orderkey").alias("arrival"),
        )
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        resource("supp/", "s_suppkey"),
        account("s_nationkey"),
        client,
        month,
        F.lit("supplier").alias("instance_state"),
        F.col("s_name").alias("instance_type"),
        F.lit(0).cast("long").alias("arrival"),
    )
    U.upsert(ordered.unionByName(suppliers), name, INVENTORY, order=["arrival"])
    return spark.table(name).select(
        "resource_id", "account_id", "year_month", "instance_state", "instance_type", "availability_zone"
    )


@query(
    "upsert_dataframe",
    """
WITH keyed AS (
  SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_type, value FROM events),
target AS (
  SELECT user_id, day, event_type, max(value) AS value, 'stored' AS region FROM keyed GROUP BY ALL),
source AS (
  SELECT user_id, day, 'view' AS event_type, CAST(count(*) AS DOUBLE) AS value, 'late' AS region
  FROM keyed GROUP BY user_id, day)
SELECT 'res/' || user_id AS resource_id, day AS metric_date, event_type AS metric_name, value AS metric_value,
       region
FROM (SELECT * FROM source
      UNION ALL
      SELECT * FROM target ANTI JOIN source USING (user_id, day, event_type))
""",
)
def upsert_dataframe(spark, sf_dir):
    """Daily rows by user, day and type; a late batch rewrites every view and adds missing ones."""
    name = U.ensure_table(spark, fresh_database(spark, "frame"), DAILY_METRICS)
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("res/"), "user_id").alias("resource_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("metric_date"),
        F.col("event_type").alias("metric_name"),
        F.col("value").alias("metric_value"),
        F.lit(G.CLIENT).alias("client_id"),
        F.lit(G.ACCOUNT).alias("account_id"),
        F.lit("Sum").alias("aggregation_type"),
        F.date_format("ts", "yyyy-MM").alias("year_month"),
    )
    stored = events.withColumn("region", F.lit("stored"))
    U.upsert(stored, name, DAILY_METRICS, order=["metric_value"])
    late = (
        events.withColumn("metric_name", F.lit("view"))
        .groupBy(*[c for c in events.columns if c != "metric_value"])
        .agg(F.count(F.lit(1)).cast("double").alias("metric_value"))
    )
    U.upsert(late.withColumn("region", F.lit("late")), name, DAILY_METRICS)
    return spark.table(name).select(
        "resource_id", "metric_date", "metric_name", "metric_value", "region"
    )


@query(
    "dual_table_write",
    f"""
WITH {SQL_DAILY}
SELECT table_name, resource_id, metric_name, metric_date, aggregation_type,
       {sql_comparable('metric_value')} AS metric_value
FROM daily, (VALUES ('test_bronze_aws_metrics'), ('bronze_aws_daily_metrics')) AS t(table_name)
""",
)
def dual_table_write(spark, sf_dir):
    """One result, computed once, merged into both daily tables."""
    database = fresh_database(spark, "dual")
    values = R.unique_daily(daily_values(spark, sf_dir))
    batch = stage(R.daily_projection(values, G.NAMESPACE, G.RUN_TIME), "daily")
    stored = []
    for daily in DAILY_TABLES:
        name = U.ensure_table(spark, database, daily)
        U.merge_batch(U.as_stored(batch, daily), name, daily)
        stored.append(spark.table(name).withColumn("table_name", F.lit(daily.name)))
    return stored[0].unionByName(stored[1]).select(
        "table_name",
        "resource_id",
        "metric_name",
        "metric_date",
        "aggregation_type",
        comparable(F.col("metric_value")).alias("metric_value"),
    )


@query(
    "incremental_rollup",
    f"""
WITH {SQL_DAILY}
SELECT resource_id, metric_name, metric_date, aggregation_type, {sql_comparable('metric_value')} AS metric_value
FROM daily
""",
)
def incremental_rollup(spark, sf_dir):
    """Raw points come in two overlapping batches; after each only the days it touches are rolled up."""
    database = fresh_database(spark, "incremental")
    raw_name, daily_name = (U.ensure_table(spark, database, t) for t in (RAW_METRICS, DAILY_METRICS))
    points = G.period_points(spark, sf_dir).where(T.looks_back(G.SERVICE, G.AS_OF, G.WHOLE_MONTH))
    points = stage(U.as_stored(points, RAW_METRICS), "points")
    for part in (F.col("metric_date") < "2024-01-16", F.col("metric_date") >= "2024-01-12"):
        batch = stage(points.where(part), "batch")
        U.merge_batch(batch, raw_name, RAW_METRICS)
        days = stage(R.changed_days(batch), "days")
        values = R.unique_daily(R.daily_values(R.only_days(spark.table(raw_name), days), G.EVENT_SPECS))
        daily = stage(U.as_stored(R.daily_projection(values, G.NAMESPACE, G.RUN_TIME), DAILY_METRICS), "daily")
        U.merge_batch(daily, daily_name, DAILY_METRICS)
    return spark.table(daily_name).select(
        "resource_id", "metric_name", "metric_date", "aggregation_type", comparable(F.col("metric_value")).alias("metric_value")
    )


@query(
    "rejected_rows",
    f"""
WITH {SQL_CATALOG}, stored AS (
  SELECT service_code, lower(trim(cloud_provider)) AS provider, min(id) AS id FROM catalog WHERE id % 2 = 0 GROUP BY ALL),
new AS (
  SELECT *, lower(trim(cloud_provider)) AS provider,
         row_number() OVER (PARTITION BY service_code, lower(trim(cloud_provider)) ORDER BY id) AS place
  FROM catalog WHERE id % 2 = 1),
judged AS (
  SELECT new.id, new.service_code, new.cloud_provider,
         CASE WHEN stored.id IS NOT NULL THEN 'exists' WHEN place > 1 THEN 'repeated' ELSE 'stored' END AS state
  FROM new LEFT JOIN stored USING (service_code, provider))
SELECT id, service_code, cloud_provider, state FROM judged
UNION ALL SELECT catalog.id, catalog.service_code, catalog.cloud_provider, 'stored' FROM catalog JOIN stored USING (id)
""",
)
def rejected_rows(spark, sf_dir):
    """Parts of even number are stored first, those of odd number come second: what keeps the catalog's
    key unique is inserted, the rest goes to a table of its own."""
    columns = ("id", "service_code", "cloud_provider")
    parts = catalog(spark, sf_dir).select(*columns)
    keys = {"service_code": F.col("service_code"), "cloud_provider": normalized(F.col("cloud_provider"))}
    stored = admit(stage(parts.where("id % 2 = 0"), "first"), parts.limit(0), ["id"], keys)[0]
    stored = stage(stored, "stored")
    accepted, rejected = admit(stage(parts.where("id % 2 = 1"), "second"), stored, ["id"], keys)
    catalog_rows = stage(stored.unionByName(accepted), "catalog")
    rejects = stage(rejected, "rejects")
    return catalog_rows.withColumn("state", F.lit("stored")).unionByName(rejects.withColumnRenamed("reason", "state"))


@query(
    "replace_by_key",
    f"""
WITH {SQL_CATALOG}, new AS (
  SELECT CAST(min(c_custkey) AS BIGINT) AS id, 'Brand#' || c_nationkey AS service_code,
         'aws' AS cloud_provider, 'replaced' AS category
  FROM customer GROUP BY c_nationkey)
SELECT id, service_code, cloud_provider, category FROM catalog
WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.service_code = catalog.service_code
                  AND lower(trim(catalog.cloud_provider)) = new.cloud_provider)
UNION ALL SELECT id, service_code, cloud_provider, category FROM new
""",
)
def replace_by_key(spark, sf_dir):
    columns = ("id", "service_code", "cloud_provider", "category")
    new = (
        table(spark, sf_dir, "customer")
        .groupBy("c_nationkey")
        .agg(F.min("c_custkey").alias("id"))
        .select(
            "id",
            F.concat(F.lit("Brand#"), "c_nationkey").alias("service_code"),
            F.lit("aws").alias("cloud_provider"),
            F.lit("replaced").alias("category"),
        )
    )
    keys = {"code": F.col("service_code"), "provider": normalized(F.col("cloud_provider"))}
    replaced = U.replace_by_key(catalog(spark, sf_dir).select(*columns), new, keys)
    return stage(replaced, "catalog")


# ---------------------------------------------------------------------------------------------
# Exports
# ---------------------------------------------------------------------------------------------

_EXPORT = declared_schema(
    {
        "service": "string",
        "region": "string",
        "c_custkey": "bigint",
        "c_name": "string",
        "c_mktsegment": "string",
        "c_acctbal": "double",
    }
)


def _sql_export(separator):
    return f"""
SELECT 'EC2' AS service,
       lpad(CAST(c_nationkey AS VARCHAR), 12, '0') || '{separator}region-' || n_regionkey AS region,
       c_custkey, c_name || ' "quoted", and more' AS c_name, c_mktsegment, c_acctbal
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


def _exportable(spark, sf_dir):
    nations = table(spark, sf_dir, "nation")
    rows = (
        table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.lpad(F.col("c_nationkey").cast("string"), 12, "0").alias("account_id"),
            F.concat(F.lit("region-"), "n_regionkey").alias("region"),
            "c_custkey",
            F.concat("c_name", F.lit(' "quoted", and more')).alias("c_name"),
            "c_mktsegment",
            "c_acctbal",
        )
    )
    return X.with_export_keys(rows, "EC2", several_accounts=True).drop("account_id")


@query("export_json", _sql_export("@"))
def export_json(spark, sf_dir):
    path = scratch_dir(spark, "export-json")
    X.export_json(_exportable(spark, sf_dir), path)
    return X.read_json_export(spark, path, _EXPORT)


@query("export_csv", _sql_export("_"))
def export_csv(spark, sf_dir):
    path = scratch_dir(spark, "export-csv")
    X.export_csv(_exportable(spark, sf_dir), path)
    return X.read_csv_export(spark, path, _EXPORT)


_DOCUMENT = declared_schema({"key": "bigint", "name": "string", "balance": "double", "note": "string"})


@query(
    "export_document",
    """
SELECT 'EC2' AS service, lpad(CAST(c_nationkey AS VARCHAR), 12, '0') || '@region-' || n_regionkey AS region,
       'customers' AS table_name, c_custkey AS key, c_name || ' "quoted", and more' AS name, c_acctbal AS balance,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS note
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT 'EC2', lpad(CAST(s_nationkey AS VARCHAR), 12, '0') || '@region-' || n_regionkey, 'suppliers', s_suppkey,
       s_name, s_acctbal, NULL
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""",
)
def export_document(spark, sf_dir):
    """Two tables of several accounts as one nested document."""
    nations = table(spark, sf_dir, "nation")

    def rows(name, key, nation, label, balance, note):
        own = table(spark, sf_dir, name).join(nations, F.col(nation) == F.col("n_nationkey")).select(
            F.lpad(F.col(nation).cast("string"), 12, "0").alias("account_id"),
            F.concat(F.lit("region-"), "n_regionkey").alias("region"),
            F.col(key).alias("key"),
            label.alias("name"),
            F.col(balance).alias("balance"),
            note.alias("note"),
        )
        return X.with_export_keys(own, "EC2", several_accounts=True).drop("account_id")

    segment = F.col("c_mktsegment")
    named = F.concat("c_name", F.lit(' "quoted", and more'))
    nothing = F.lit(None).cast("string")
    tables = {
        "customers": rows("customer", "c_custkey", "c_nationkey", named, "c_acctbal", F.when(segment != "BUILDING", segment)),
        "suppliers": rows("supplier", "s_suppkey", "s_nationkey", F.col("s_name"), "s_acctbal", nothing),
    }
    path = scratch_dir(spark, "export-document")
    X.export_documents(tables, path)
    return X.read_documents(spark, path, _DOCUMENT)
