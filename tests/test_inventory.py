"""Pages to inventory rows."""

import json

import pytest

from cumulo.operators.inventory import flatten_instances, unnest_instances
from cumulo.operators.shape import conform, stamp
from cumulo.schemas import INVENTORY
from cumulo.sources.landed import read_inventory_pages

ACCOUNT, REGION = "111122223333", "eu-west-1"


@pytest.fixture
def inventory(spark, tmp_path):
    """Land instances as one page per list and flatten what is read back."""

    def flatten(*pages):
        folder = tmp_path / f"account_id={ACCOUNT}" / f"region={REGION}"
        folder.mkdir(parents=True, exist_ok=True)
        lines = [json.dumps({"Reservations": r}) for r in pages]
        (folder / "pages.json").write_text("\n".join(lines))
        df = flatten_instances(unnest_instances(read_inventory_pages(spark, str(tmp_path))))
        return {r.instance_id: r for r in df.collect()}

    return flatten


def one(**fields):
    return [{"Instances": [{"InstanceId": "i-1", **fields}]}]


def test_one_page_one_instance(spark, inventory, run_time):
    row = inventory(
        [{"Instances": [{"InstanceId": "i-0abc", "State": {"Name": "running"}, "Tags": [{"Key": "Name", "Value": "web"}]}]}]
    )["i-0abc"]
    assert row.resource_id == f"arn:aws:ec2:{REGION}:{ACCOUNT}:instance/i-0abc"
    assert (row.account_id, row.region, row.instance_state, row.resource_name) == (ACCOUNT, REGION, "running", "web")
    assert json.loads(row.tags) == [{"Key": "Name", "Value": "web"}]
    flat = conform(stamp(spark.createDataFrame([row]), "c1", run_time), INVENTORY.schema)
    stamped = flat.first()
    assert flat.columns == INVENTORY.columns
    assert (stamped.client_id, stamped.cloud_name, stamped.year_month) == ("c1", "aws", "2024-02")
    assert stamped.ingestion_timestamp == "2024-02-01T06:30:00+00:00"


def test_empty_arrays_and_missing_ids_give_no_row(inventory):
    got = inventory(
        [{"Instances": []}, {"Instances": [{"InstanceId": ""}, {"State": {"Name": "x"}}, {"InstanceId": "i-2"}]}],
        [],
        [{}],
    )
    assert set(got) == {"i-2"}


def test_absent_fields_are_blank(inventory):
    row = inventory(one())["i-1"]
    for column in (
        "availability_zone instance_type architecture instance_state platform hypervisor "
        "monitoring_state launch_time private_ip public_ip vpc_id subnet_id"
    ).split():
        assert row[column] == "", column
    assert (row.tags, row.ebs_volume_ids, row.resource_name) == ("[]", "[]", "i-1")


@pytest.mark.parametrize(
    "tags, name",
    [
        ([{"Key": "Name", "Value": "web"}, {"Key": "Name", "Value": "w2"}], "web"),
        ([{"Key": "Name"}, {"Key": "Name", "Value": "w2"}], "i-1"),
        ([{"Key": "name", "Value": "web"}], "i-1"),
        ([{"Key": "Name", "Value": ""}], "i-1"),
    ],
)
def test_name_tag(inventory, tags, name):
    assert inventory(one(Tags=tags))["i-1"].resource_name == name


def test_address_fallbacks(inventory):
    bare = {"PrivateIpAddress": None}
    full = {
        "PrivateIpAddress": "10.0.0.2",
        "SubnetId": "sub-2",
        "VpcId": "vpc-2",
        "Association": {"PublicIp": "9.9.9.9"},
    }
    second = inventory(one(NetworkInterfaces=[bare, full]))["i-1"]
    assert (second.public_ip, second.private_ip, second.subnet_id, second.vpc_id) == ("9.9.9.9", "", "", "")
    first = inventory(one(NetworkInterfaces=[full, bare], SubnetId="own"))["i-1"]
    assert (first.public_ip, first.private_ip, first.subnet_id, first.vpc_id) == ("9.9.9.9", "10.0.0.2", "own", "vpc-2")


def test_platform_launch_time_and_volumes(inventory):
    row = inventory(
        one(
            Platform="windows",
            PlatformDetails="",
            LaunchTime="2024-01-01T13:47:59+02:00",
            BlockDeviceMappings=[{"Ebs": {"VolumeId": "v-1"}}, {}, {"Ebs": {"VolumeId": ""}}, {"Ebs": {"VolumeId": "v-2"}}],
        )
    )["i-1"]
    assert row.platform == "windows"
    assert row.launch_time == "2024-01-01T11:47:59Z"
    assert json.loads(row.ebs_volume_ids) == ["v-1", "v-2"]


def test_raw_document_keeps_undeclared_fields(inventory):
    row = inventory(one(EnaSupport=True, Nested={"a": [1, None]}))["i-1"]
    assert json.loads(row.raw_data) == {"InstanceId": "i-1", "EnaSupport": True, "Nested": {"a": [1, None]}}


def test_scope_prunes_directories(spark, tmp_path):
    for account in ("1", "2"):
        folder = tmp_path / f"account_id={account}" / "region=r"
        folder.mkdir(parents=True)
        (folder / "p.json").write_text(json.dumps({"Reservations": one()}))
    df = read_inventory_pages(spark, str(tmp_path), accounts=["2"])
    assert [r.account_id for r in df.collect()] == ["2"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "account_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
