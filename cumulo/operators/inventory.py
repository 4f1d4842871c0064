"""Inventory: from landed pages to one flat row per instance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulo.functions.text import blank_to_null, first_nonblank
from cumulo.functions.time import iso_utc
from cumulo.schemas import INSTANCE_DOC

SERVICE = "EC2"
INSTANCE = "instance"


def unnest_instances(pages: DataFrame, *carry: str) -> DataFrame:
    """One row per instance of each reservation: its text and its parsed document.

    Empty or missing arrays yield no row.
    """
    carry = carry or ("account_id", "region")
    reservations = pages.select(*carry, F.explode("Reservations").alias("reservation"))
    instances = reservations.select(
        *carry, F.explode("reservation.Instances").alias("raw_data")
    )
    return instances.withColumn(INSTANCE, F.from_json("raw_data", INSTANCE_DOC))


def listed_instances(pages: DataFrame, *carry: str) -> DataFrame:
    """Everything a later step needs to know of the pages, parsed once: a row per instance, with its text,
    and one row without text per page that did not parse (``malformed``)."""
    whole = F.when(~F.col("malformed"), F.col("Reservations"))
    reservations = pages.select(*carry, "malformed", F.explode_outer(whole).alias("reservation"))
    instances = reservations.select(*carry, "malformed", F.explode_outer("reservation.Instances").alias("raw_data"))
    return instances.where(F.col("malformed") | F.col("raw_data").isNotNull())


def parsed_instances(listed: DataFrame) -> DataFrame:
    """Instances with their parsed documents, of scopes whose pages all parsed: a malformed page leaves its
    account and region incomplete, like any failure while listing them."""
    broken = listed.where("malformed").select("account_id", "region").distinct()
    whole = listed.where(~F.col("malformed")).drop("malformed").join(broken, ["account_id", "region"], "left_anti")
    return whole.withColumn(INSTANCE, F.from_json("raw_data", INSTANCE_DOC))


def require_id(df: DataFrame, *ids: str) -> DataFrame:
    """Rows whose ids are all present and not blank."""
    for name in ids:
        df = df.where(F.col(name) != "")
    return df


def resource_arn(region: Column, account_id: Column, instance_id: Column) -> Column:
    return F.concat(
        F.lit("arn:aws:ec2:"), region, F.lit(":"), account_id, F.lit(":instance/"), instance_id
    )


def tag_value(tags: Column, key: str) -> Column:
    """Value of the first tag with this key, '' when there is none or it has no value."""
    first = F.try_element_at(F.filter(tags, lambda tag: tag["Key"] == key), F.lit(1))
    return F.coalesce(first["Value"], F.lit(""))


def public_address(own: Column, interfaces: Column) -> Column:
    """The instance's public address, else that of the first interface that has one."""
    associated = F.filter(
        F.transform(interfaces, lambda ni: ni["Association"]["PublicIp"]), lambda ip: ip != ""
    )
    return first_nonblank(own, F.try_element_at(associated, F.lit(1)))


def from_first_interface(own: Column, interfaces: Column, field: str) -> Column:
    """The instance's value, else that of the interface at position 0 and no other."""
    return first_nonblank(own, F.try_element_at(interfaces, F.lit(1))[field])


def volume_ids(mappings: Column) -> Column:
    """Ids of attached volumes, blanks skipped; no mappings give an empty list."""
    ids = F.filter(F.transform(mappings, lambda m: m["Ebs"]["VolumeId"]), lambda v: v != "")
    return F.coalesce(ids, F.array().cast("array<string>"))


def flatten_instances(instances: DataFrame) -> DataFrame:
    """Inventory columns from ``account_id``, ``region``, ``raw_data`` and the parsed document;
    any further column is carried along.

    ``resource_name``, ``ebs_volume_ids`` and ``service_name`` serve the metric joins and are
    dropped when the rows are conformed to the inventory table.
    """
    doc = F.col(INSTANCE)
    interfaces = doc["NetworkInterfaces"]
    tags = F.coalesce(doc["Tags"], F.array().cast(INSTANCE_DOC["Tags"].dataType))
    instance_id = doc["InstanceId"]
    used = ("account_id", "region", "raw_data", INSTANCE)
    flat = instances.select(
        resource_arn(F.col("region"), F.col("account_id"), instance_id).alias("resource_id"),
        instance_id.alias("instance_id"),
        "account_id",
        "region",
        first_nonblank(doc["Placement"]["AvailabilityZone"]).alias("availability_zone"),
        first_nonblank(doc["InstanceType"]).alias("instance_type"),
        first_nonblank(doc["Architecture"]).alias("architecture"),
        first_nonblank(doc["State"]["Name"]).alias("instance_state"),
        first_nonblank(doc["PlatformDetails"], doc["Platform"]).alias("platform"),
        first_nonblank(doc["Hypervisor"]).alias("hypervisor"),
        first_nonblank(doc["Monitoring"]["State"]).alias("monitoring_state"),
        iso_utc(doc["LaunchTime"]).alias("launch_time"),
        from_first_interface(doc["PrivateIpAddress"], interfaces, "PrivateIpAddress").alias(
            "private_ip"
        ),
        public_address(doc["PublicIpAddress"], interfaces).alias("public_ip"),
        from_first_interface(doc["VpcId"], interfaces, "VpcId").alias("vpc_id"),
        from_first_interface(doc["SubnetId"], interfaces, "SubnetId").alias("subnet_id"),
        F.to_json(tags).alias("tags"),
        "raw_data",
        F.coalesce(blank_to_null(tag_value(tags, "Name")), instance_id).alias("resource_name"),
        F.to_json(volume_ids(doc["BlockDeviceMappings"])).alias("ebs_volume_ids"),
        F.lit(SERVICE).alias("service_name"),
        *[c for c in instances.columns if c not in used],
    )
    return require_id(flat, "instance_id")
