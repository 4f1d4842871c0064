"""Service catalog, scopes, run reports and text expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cumulo.functions import text as X
from cumulo.functions.time import iso_utc
from cumulo.operators import catalog as C
from cumulo.operators import reports as R
from cumulo.sources import tables as T
from gate import roles as G
from gate.registry import query, table

# ---------------------------------------------------------------------------------------------
# Catalog
# ---------------------------------------------------------------------------------------------

SQL_CATALOG = """
catalog AS (
  SELECT p_partkey AS id, p_brand AS service_code,
         CASE p_type WHEN 'ECONOMY' THEN ' AWS ' WHEN 'SMALL' THEN 'aws' WHEN 'LARGE' THEN 'Aws'
              ELSE 'azure' END AS cloud_provider,
         p_type AS category, p_size > 25 AS is_active
  FROM part)
"""


def catalog(spark, sf_dir):
    """Parts as services: brand -> code, type -> provider in several spellings, size -> active."""
    kind = F.col("p_type")
    provider = (
        F.when(kind == "ECONOMY", " AWS ")
        .when(kind == "SMALL", "aws")
        .when(kind == "LARGE", "Aws")
        .otherwise("azure")
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_brand").alias("service_code"),
        provider.alias("cloud_provider"),
        kind.alias("category"),
        (F.col("p_size") > 25).alias("is_active"),
    )


@query(
    "active_codes",
    f"""
WITH {SQL_CATALOG}
SELECT DISTINCT service_code FROM catalog
WHERE lower(trim(cloud_provider)) = 'aws' AND is_active ORDER BY service_code
""",
)
def active_codes(spark, sf_dir):
    return C.active_codes(catalog(spark, sf_dir))


_REGISTRY = ("BRAND#7", "BRAND#16", "EC2")


@query(
    "registered_codes",
    f"""
WITH {SQL_CATALOG}, registered AS (
  SELECT DISTINCT upper(service_code) AS service_code FROM catalog
  WHERE lower(trim(cloud_provider)) = 'aws' AND is_active
    AND upper(service_code) IN {_REGISTRY}),
unregistered AS (
  SELECT DISTINCT upper(service_code) AS service_code FROM catalog
  WHERE lower(trim(cloud_provider)) = 'aws' AND is_active
    AND upper(service_code) NOT IN {_REGISTRY})
SELECT service_code, 'runs' AS decision FROM registered
UNION ALL SELECT 'EC2', 'runs' WHERE NOT EXISTS (SELECT 1 FROM registered)
UNION ALL SELECT service_code, 'skipped' FROM unregistered
""",
)
def registered_codes(spark, sf_dir):
    codes = C.active_codes(catalog(spark, sf_dir))
    runs = C.registered_codes(codes, _REGISTRY).withColumn("decision", F.lit("runs"))
    skipped = C.split_registered(codes, _REGISTRY).where("not is_registered")
    return runs.unionByName(skipped.select("service_code", F.lit("skipped").alias("decision")))


@query(
    "unique_key_violations",
    f"""
WITH {SQL_CATALOG}
SELECT service_code, cloud_provider, count(*) AS row_count FROM catalog
GROUP BY ALL HAVING count(*) > 1
""",
)
def unique_key_violations(spark, sf_dir):
    return C.unique_key_violations(catalog(spark, sf_dir))


@query(
    "catalog_defaults",
    """
SELECT p_partkey AS id, coalesce(CASE WHEN p_type = 'LARGE' THEN false END, true) AS is_active,
       '2024-01-31T06:30:00Z' AS created_at FROM part
""",
)
def catalog_defaults(spark, sf_dir):
    inactive = F.when(F.col("category") == "LARGE", False)
    rows = catalog(spark, sf_dir).withColumn("is_active", inactive)
    filled = C.with_catalog_defaults(rows, F.lit(G.RUN_TIME))
    return filled.select("id", "is_active", iso_utc(F.col("created_at")).alias("created_at"))


@query(
    "jdbc_query_text",
    f"""
WITH {SQL_CATALOG}
SELECT DISTINCT service_code FROM catalog WHERE lower(trim(cloud_provider)) = 'aws' AND is_active
""",
)
def jdbc_query_text(spark, sf_dir):
    """The text a JDBC read pushes into the database, run here over the same catalog rows."""
    return T.with_view(
        catalog(spark, sf_dir),
        "cumulo_service_configuration",
        lambda session, name: session.sql(T.active_codes_query(name)),
    )


# ---------------------------------------------------------------------------------------------
# Scopes and ids
# ---------------------------------------------------------------------------------------------

_REQUESTS = {
    "AUTOMOBILE": "*",
    "BUILDING": " all ",
    "FURNITURE": "us-west-2, eu-west-1 ,us-west-2,",
    "HOUSEHOLD": "us-east-1,ALL",
}
_SQL_REGIONS = ", ".join(f"'{r}'" for r in sorted(X.STANDARD_REGIONS))
_SQL_REQUESTED = f"""
CASE c_mktsegment
  WHEN 'FURNITURE' THEN ['us-west-2', 'eu-west-1', 'us-west-2']
  WHEN 'HOUSEHOLD' THEN ['us-east-1', 'ALL']
  ELSE [{_SQL_REGIONS}] END
"""


def _accounts(spark, sf_dir):
    """Customers as accounts, each with a region request."""
    request = F.lit("")
    for segment, text in _REQUESTS.items():
        request = F.when(F.col("c_mktsegment") == segment, text).otherwise(request)
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("account_id"),
        request.alias("request"),
        "c_name",
        "c_mktsegment",
    )


@query(
    "resolve_regions",
    f"SELECT c_custkey, array_to_string({_SQL_REQUESTED}, '|') AS regions FROM customer",
)
def resolve_regions(spark, sf_dir):
    regions = X.resolve_regions(F.col("request"), X.STANDARD_REGIONS)
    return _accounts(spark, sf_dir).select(
        "c_custkey", F.concat_ws("|", regions).alias("regions")
    )


@query(
    "ingest_scope",
    f"""
SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS account_id, unnest({_SQL_REQUESTED}) AS region, service
FROM customer, (VALUES ('EC2'), ('S3')) AS s(service)
""",
)
def ingest_scope(spark, sf_dir):
    regions = X.resolve_regions(F.col("request"), X.STANDARD_REGIONS)
    services = X.split_list(F.lit(" ec2,S3 "), upper=True)
    return C.ingest_scope(_accounts(spark, sf_dir), regions, services)


_SQL_ID_TEXTS = """
lpad(CAST(o_custkey AS VARCHAR), 12, '0') || ',' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || ' x' ||
lpad(CAST(o_custkey + 7 AS VARCHAR), 12, '0') || ';' || lpad(CAST(o_orderkey AS VARCHAR), 13, '0') || '/' ||
lpad(CAST(o_orderkey + o_custkey AS VARCHAR), 12, '0') || ' ' || lpad(CAST(o_custkey AS VARCHAR), 12, '0')
"""


@query(
    "extract_account_ids",
    f"""
WITH found AS (
  SELECT o_orderkey, list_filter(string_split_regex({_SQL_ID_TEXTS}, '[^\\p{{L}}\\p{{N}}_]+'),
                                 lambda x: regexp_full_match(x, '[0-9]{{12}}')) AS ids
  FROM orders),
numbered AS (SELECT o_orderkey, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM found),
firsts AS (SELECT o_orderkey, id, min(pos) AS pos FROM numbered GROUP BY ALL)
SELECT o_orderkey, string_agg(id, ',' ORDER BY pos) AS ids FROM firsts GROUP BY ALL
""",
)
def extract_account_ids(spark, sf_dir):
    padded = lambda value, width=12: F.lpad(value.cast("string"), width, "0")
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    first = F.concat(padded(customer), F.lit(","), padded(order), F.lit(" x"), padded(customer + 7))
    second = F.concat(padded(order, 13), F.lit("/"), padded(order + customer))
    ids = X.account_ids(first, F.lit(None).cast("string"), second, padded(customer))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(ids, ",").alias("ids"))


@query(
    "rewrite_arn_account",
    """
SELECT c_custkey, CASE c_mktsegment
    WHEN 'BUILDING' THEN 'arn:aws:iam::111122223333:user/' || c_name
    WHEN 'FURNITURE' THEN 'arn:aws:iam::111122223333:role/' || c_name
    ELSE 'arn:aws:iam::' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') || ':role/' || c_name END AS role_arn
FROM customer
""",
)
def rewrite_arn_account(spark, sf_dir):
    """Roles take over the account; users are no roles and furniture has no valid target."""
    segment = F.col("c_mktsegment")
    kind = F.when(segment == "BUILDING", "user/").otherwise("role/")
    role = F.concat(F.lit(" arn:aws:iam::111122223333:"), kind, "c_name", F.lit("\n"))
    target = F.when(segment == "FURNITURE", "123").otherwise(F.col("account_id"))
    return _accounts(spark, sf_dir).select(
        "c_custkey", X.role_for_account(role, target).alias("role_arn")
    )


# ---------------------------------------------------------------------------------------------
# Texts
# ---------------------------------------------------------------------------------------------


@query(
    "parse_comma_list",
    r"""
WITH parts AS (
  SELECT doc_id, unnest(string_split(text, ',')) AS part, generate_subscripts(string_split(text, ','), 1) AS pos
  FROM documents),
items AS (
  SELECT doc_id, pos, regexp_replace(regexp_replace(part, '^[\s\p{Z}]+', ''), '[\s\p{Z}]+$', '') AS item
  FROM parts)
SELECT d.doc_id, count(item) AS n, coalesce(string_agg(item, '|' ORDER BY pos), '') AS items
FROM documents d LEFT JOIN items i ON d.doc_id = i.doc_id AND item <> ''
GROUP BY d.doc_id
""",
)
def parse_comma_list(spark, sf_dir):
    items = X.split_list(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(items).cast("long").alias("n"), F.array_join(items, "|").alias("items")
    )


@query(
    "safe_name",
    r"""
SELECT doc_id, regexp_replace(text, '[^\p{L}\p{N}_\-.]', '_', 'g') AS name,
       regexp_replace(text, '[^A-Za-z0-9_]', '_', 'g') AS view_name
FROM documents
""",
)
def safe_name(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", X.safe_name(text).alias("name"), X.safe_view_name(text).alias("view_name")
    )


@query(
    "safe_id",
    r"""
SELECT page_id, coalesce(nullif(substr(regexp_replace(url, '[^a-zA-Z0-9_]', '', 'g'), 1, 40), ''), 'm') AS id
FROM pages
""",
)
def safe_id(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.safe_id(F.col("url")).alias("id"))


@query(
    "truncate_text",
    """
SELECT doc_id, CASE WHEN length(text) > 400 THEN substr(text, 1, 400) || '…' ELSE text END AS message
FROM documents
""",
)
def truncate_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", X.truncated(F.col("text")).alias("message")
    )


# ---------------------------------------------------------------------------------------------
# Run reports
# ---------------------------------------------------------------------------------------------

_SQL_LOG = """
log AS (
  SELECT event_id, lpad(CAST(user_id AS VARCHAR), 12, '0') AS account_id, 'region-' || event_type AS region,
         CASE event_type WHEN 'error' THEN 'AccessDenied' WHEN 'click' THEN 'AuthFailure'
              WHEN 'signup' THEN 'RequestExpired' WHEN 'purchase' THEN 'InvalidRequest' END AS code,
         value > 50 AS by_policy
  FROM events)
"""


def _call_log(spark, sf_dir):
    """Events as calls: views succeed, purchases fail hard, the rest is denied."""
    kind = F.col("metric_name")
    code = (
        F.when(kind == "error", "AccessDenied")
        .when(kind == "click", "AuthFailure")
        .when(kind == "signup", "RequestExpired")
        .when(kind == "purchase", "InvalidRequest")
    )
    message = F.when(F.col("value") > 50, "denied by a service_control_policy").otherwise("denied")
    return G.points(spark, sf_dir).select(
        "event_id",
        F.lpad(F.col("user_id").cast("string"), 12, "0").alias("account_id"),
        F.concat(F.lit("region-"), kind).alias("region"),
        code.alias("code"),
        message.alias("message"),
    )


@query(
    "classify_errors",
    f"""
WITH {_SQL_LOG}
SELECT event_id, code, CASE WHEN code = 'InvalidRequest' THEN 'hard' WHEN code IS NOT NULL THEN 'soft' END
       AS error_class, code IN ('AccessDenied', 'AuthFailure') AS only_warned
FROM log
""",
)
def classify_errors(spark, sf_dir):
    code = F.col("code")
    return _call_log(spark, sf_dir).select(
        "event_id",
        "code",
        R.error_class(code).alias("error_class"),
        R.fails_softly(code).alias("only_warned"),
    )


@query(
    "failed_scopes",
    """
SELECT c_custkey, 'nation-' || c_nationkey AS account_id FROM customer
WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0 OR s_acctbal > 9500)
""",
)
def failed_scopes(spark, sf_dir):
    """Suppliers as listing calls: debts are denials, riches hard errors; their nations drop out."""
    balance = F.col("s_acctbal")
    account = lambda key: F.concat(F.lit("nation-"), key).alias("account_id")
    region = F.lit(G.REGION).alias("region")
    code = F.when(balance < 0, "AccessDenied").when(balance > 9500, "InvalidRequest")
    errors = table(spark, sf_dir, "supplier").select(
        account("s_nationkey"), region, code.alias("code")
    )
    pages = table(spark, sf_dir, "customer").select("c_custkey", account("c_nationkey"), region)
    return R.without_failed_scopes(pages, errors).select("c_custkey", "account_id")


@query(
    "denial_summary",
    f"""
WITH {_SQL_LOG}
SELECT code, count(*) AS denials, (SELECT count(*) FROM log WHERE code <> 'InvalidRequest') AS total
FROM log WHERE code <> 'InvalidRequest' GROUP BY code
""",
)
def denial_summary(spark, sf_dir):
    return R.denial_summary(_call_log(spark, sf_dir))


@query(
    "denial_samples",
    f"""
WITH {_SQL_LOG}
SELECT account_id, region, code, CASE WHEN by_policy THEN 'SCP' ELSE 'IAM/deny' END AS reason
FROM log WHERE code <> 'InvalidRequest' ORDER BY event_id LIMIT 8
""",
)
def denial_samples(spark, sf_dir):
    return R.denial_samples(_call_log(spark, sf_dir), ["event_id"])


@query(
    "run_totals",
    """
WITH log AS (
  SELECT CASE event_type WHEN 'signup' THEN '_bookkeeping' ELSE event_type END AS table_name,
         CAST(json_extract_string(props, '$.k') AS BIGINT) - 50 AS rows_fetched,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS rows_merged,
         event_type = 'error' AS failed
  FROM events)
SELECT table_name, CAST(sum(greatest(rows_fetched, 0)) AS BIGINT) AS rows_fetched,
       CAST(sum(CASE WHEN table_name LIKE '\\_%' ESCAPE '\\' THEN 0 ELSE rows_merged END) AS BIGINT) AS rows_merged,
       CAST(sum(CAST(failed AS INTEGER)) AS BIGINT) AS failures
FROM log GROUP BY table_name
""",
)
def run_totals(spark, sf_dir):
    number = F.get_json_object("props", "$.k").cast("long")
    kind = F.col("metric_name")
    log = G.points(spark, sf_dir).select(
        F.when(kind == "signup", "_bookkeeping").otherwise(kind).alias("table_name"),
        (number - 50).alias("rows_fetched"),
        number.alias("rows_merged"),
        (kind == "error").alias("failed"),
    )
    return R.run_totals(log)
