"""Declared schemas: landed documents, stored tables and metric specifications."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

# The type names a table declaration may use; any other name means string.
TYPE_NAMES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def spark_type(name: str) -> T.DataType:
    return TYPE_NAMES.get(name, T.StringType())


def declared_schema(columns: Mapping[str, str]) -> T.StructType:
    """An all-nullable schema from an ordered ``{column: type name}`` mapping."""
    return T.StructType([T.StructField(c, spark_type(t), True) for c, t in columns.items()])


@dataclass(frozen=True)
class Table:
    """A stored table: its business key identifies a row, wherever that row is partitioned.

    ``dated_by`` is a key column whose month bounds the month partition from below: rows are stored in
    that month (``same_month``) or, by ingestion, in a later one. ``cluster`` orders the rows of a file, so
    that scans skip the parts whose values they do not ask for.
    """

    name: str
    keys: tuple[str, ...]
    partitions: tuple[str, ...]
    schema: T.StructType
    path_suffix: str = ""
    dated_by: str = ""
    same_month: bool = False
    cluster: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


@dataclass(frozen=True)
class MetricSpec:
    """One metric to collect: a statistic over a period, for an instance or a volume."""

    metric_name: str
    namespace: str
    unit: str
    stat: str = "Average"
    period: int = 3600
    interval: str = "PT1H"
    scope: str = "instance"


# ---------------------------------------------------------------------------------------------
# Stored tables (names, keys, partitions, columns in order)
# ---------------------------------------------------------------------------------------------
_PARTITIONS = ("client_id", "account_id", "year_month")

INVENTORY = Table(
    "bronze_aws_ec2_instances_v1",
    keys=("client_id", "account_id", "resource_id"),
    partitions=_PARTITIONS,
    schema=declared_schema(
        {
            "resource_id": "string",
            "instance_id": "string",
            "region": "string",
            "availability_zone": "string",
            "instance_type": "string",
            "architecture": "string",
            "instance_state": "string",
            "platform": "string",
            "hypervisor": "string",
            "monitoring_state": "string",
            "launch_time": "string",
            "private_ip": "string",
            "public_ip": "string",
            "vpc_id": "string",
            "subnet_id": "string",
            "tags": "string",
            "raw_data": "string",
            "client_id": "string",
            "account_id": "string",
            "cloud_name": "string",
            "year_month": "string",
            "ingestion_timestamp": "string",
            "job_runtime_utc": "timestamp",
        }
    ),
    path_suffix="aws/ec2_instances",
)

METRIC_SCHEMA = declared_schema(
    {
        "account_id": "string",
        "aggregation_type": "string",
        "client_id": "string",
        "cloud_name": "string",
        "date": "string",
        "ingestion_timestamp": "string",
        "job_runtime_utc": "timestamp",
        "metric_date": "string",
        "metric_name": "string",
        "metric_unit": "string",
        "metric_value": "double",
        "namespace": "string",
        "region": "string",
        "resource_id": "string",
        "resource_name": "string",
        "service_name": "string",
        "unit": "string",
        "year_month": "string",
    }
)

RAW_METRICS = Table(
    "bronze_aws_metrics_v1",
    keys=("client_id", "account_id", "resource_id", "date", "metric_name", "aggregation_type"),
    partitions=_PARTITIONS,
    schema=METRIC_SCHEMA,
    path_suffix="aws/ec2_metrics",
    dated_by="date",
    # The roll-up asks for some metrics and recent dates.
    cluster=("metric_name", "metric_date", "resource_id"),
)

_DAILY_KEYS = (
    "client_id",
    "account_id",
    "resource_id",
    "metric_date",
    "metric_name",
    "aggregation_type",
)
DAILY_METRICS = Table(
    "test_bronze_aws_metrics", _DAILY_KEYS, _PARTITIONS, METRIC_SCHEMA, "aws/metrics_daily", "metric_date", True
)
DAILY_METRICS_COPY = Table(
    "bronze_aws_daily_metrics", _DAILY_KEYS, _PARTITIONS, METRIC_SCHEMA, "aws/daily_metrics", "metric_date", True
)
DAILY_TABLES = (DAILY_METRICS, DAILY_METRICS_COPY)

# Bookkeeping of the jobs, of this library's own making.
LEDGER = Table(
    "landed_files",
    keys=("path", "size", "modified"),
    partitions=("service_name",),
    schema=declared_schema(
        {"path": "string", "size": "long", "modified": "timestamp", "job_runtime_utc": "timestamp", "service_name": "string"}
    ),
    path_suffix="jobs/landed_files",
)
RUN_REPORT = Table(
    "run_report",
    keys=("run", "service_name", "section", "name", "detail"),
    partitions=("run",),
    schema=declared_schema(
        {"service_name": "string", "section": "string", "name": "string", "detail": "string", "value": "long", "run": "string"}
    ),
    path_suffix="jobs/run_report",
)
CHANGED_DAYS = Table(
    "changed_days",
    keys=("client_id", "account_id", "resource_id", "metric_date", "batch"),
    partitions=("batch",),
    schema=declared_schema(
        {"client_id": "string", "account_id": "string", "resource_id": "string", "metric_date": "string", "batch": "string"}
    ),
    path_suffix="jobs/changed_days",
)

# ---------------------------------------------------------------------------------------------
# Metric specifications of the compute service
# ---------------------------------------------------------------------------------------------
INSTANCE_SPECS = (
    MetricSpec("CPUUtilization", "AWS/EC2", "Percent", "Average", 300, "PT5M"),
    MetricSpec("MemoryUtilization", "AWS/EC2", "Percent", "Average", 300, "PT5M"),
    MetricSpec("NetworkIn", "AWS/EC2", "Bytes", "Sum", 86400, "P1D"),
    MetricSpec("NetworkOut", "AWS/EC2", "Bytes", "Sum", 86400, "P1D"),
    MetricSpec("DiskReadBytes", "AWS/EC2", "Bytes", "Sum", 86400, "P1D"),
    MetricSpec("DiskWriteBytes", "AWS/EC2", "Bytes", "Sum", 86400, "P1D"),
)
VOLUME_SPECS = (
    MetricSpec("VolumeReadBytes", "AWS/EBS", "Bytes", "Sum", 86400, "P1D", "volume"),
    MetricSpec("VolumeWriteBytes", "AWS/EBS", "Bytes", "Sum", 86400, "P1D", "volume"),
    MetricSpec("VolumeReadOps", "AWS/EBS", "Count", "Sum", 86400, "P1D", "volume"),
    MetricSpec("VolumeWriteOps", "AWS/EBS", "Count", "Sum", 86400, "P1D", "volume"),
)
DAILY_INTERVALS = ("P1D", "PT1D")

# ---------------------------------------------------------------------------------------------
# Landed documents
# ---------------------------------------------------------------------------------------------


def _record(fields: Mapping[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# The fields read from landed documents, as the interfaces name them.
_TEXT = T.StringType()
INSTANCE_DOC = _record(
    {
        "InstanceId": _TEXT,
        "InstanceType": _TEXT,
        "Architecture": _TEXT,
        "Hypervisor": _TEXT,
        "Platform": _TEXT,
        "PlatformDetails": _TEXT,
        "LaunchTime": T.TimestampType(),
        "PrivateIpAddress": _TEXT,
        "PublicIpAddress": _TEXT,
        "VpcId": _TEXT,
        "SubnetId": _TEXT,
        "State": _record({"Name": _TEXT}),
        "Monitoring": _record({"State": _TEXT}),
        "Placement": _record({"AvailabilityZone": _TEXT}),
        "Tags": T.ArrayType(_record({"Key": _TEXT, "Value": _TEXT})),
        "BlockDeviceMappings": T.ArrayType(_record({"Ebs": _record({"VolumeId": _TEXT})})),
        "NetworkInterfaces": T.ArrayType(
            _record(
                {
                    "PrivateIpAddress": _TEXT,
                    "SubnetId": _TEXT,
                    "VpcId": _TEXT,
                    "Association": _record({"PublicIp": _TEXT}),
                }
            )
        ),
    }
)
RESULT_DOC = _record(
    {"Id": _TEXT, "Timestamps": T.ArrayType(T.TimestampType()), "Values": T.ArrayType(T.DoubleType())}
)


def sub_daily(specs: Iterable[MetricSpec]) -> list[MetricSpec]:
    return [s for s in specs if s.interval not in DAILY_INTERVALS]


def daily_native(specs: Iterable[MetricSpec]) -> list[MetricSpec]:
    return [s for s in specs if s.interval in DAILY_INTERVALS]
