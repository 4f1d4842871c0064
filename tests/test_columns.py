"""Scalar expressions: text, ids, regions, ARNs and bucket rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cumulo.functions import text as X
from cumulo.functions import time as M
from cumulo.plans.params import parse_params, regions_without_listing
from cumulo.schemas import declared_schema, spark_type

ROLE = "arn:aws:iam::111122223333:role/team/reader"


@pytest.fixture
def value(spark):
    """Evaluate one expression over one text."""

    def evaluate(expression, text=None):
        df = spark.createDataFrame([(text,)], "s string")
        return df.select(expression(F.col("s")).alias("r")).first().r

    return evaluate


@pytest.mark.parametrize("request_text", ["", "ALL", "*", "AUTO", " all ", None])
def test_blank_or_lone_wildcard_means_all_regions(value, request_text):
    got = value(lambda c: X.resolve_regions(c, X.STANDARD_REGIONS[::-1]), request_text)
    assert got == sorted(X.STANDARD_REGIONS)


@pytest.mark.parametrize(
    "request_text, expected",
    [
        ("us-east-1,ALL", ["us-east-1", "ALL"]),
        (" us-west-2 ,eu-west-1,, us-west-2", ["us-west-2", "eu-west-1", "us-west-2"]),
    ],
)
def test_named_regions_keep_order_and_repeats(value, request_text, expected):
    assert value(lambda c: X.resolve_regions(c, ["x"]), request_text) == expected


def test_region_override_is_sorted_and_default_is_the_standard_list():
    assert regions_without_listing("us-west-2,eu-west-1") == ["eu-west-1", "us-west-2"]
    assert regions_without_listing(" ") == list(X.STANDARD_REGIONS)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("111122223333, 444455556666;111122223333 12345", ["111122223333", "444455556666"]),
        ("x111122223333", []),
        ("é111122223333", []),
        ("1111222233334", []),
        ("444455556666/111122223333", ["444455556666", "111122223333"]),
        (None, []),
    ],
)
def test_account_ids(value, text, expected):
    assert value(X.account_ids, text) == expected


def test_account_ids_across_parameters(spark):
    df = spark.createDataFrame([("222222222222", None, "111111111111,222222222222")], "a string, b string, c string")
    got = df.select(X.account_ids(F.col("a"), F.col("b"), F.col("c")).alias("r")).first().r
    assert got == ["222222222222", "111111111111"]


@pytest.mark.parametrize(
    "role, account, expected",
    [
        (ROLE, "444455556666", "arn:aws:iam::444455556666:role/team/reader"),
        (f" {ROLE} ", " 444455556666 ", "arn:aws:iam::444455556666:role/team/reader"),
        (ROLE, "123", ROLE),
        (ROLE, "", ROLE),
        (ROLE, None, ROLE),
        ("arn:aws:iam::111122223333:user/x", "444455556666", "arn:aws:iam::111122223333:user/x"),
        (ROLE + ":a:b", "444455556666", "arn:aws:iam::444455556666:role/team/reader:a:b"),
        (None, "444455556666", ""),
    ],
)
def test_role_for_account(value, role, account, expected):
    assert value(lambda c: X.role_for_account(c, F.lit(account)), role) == expected


def test_lists_and_names(value):
    assert value(lambda c: X.split_list(c, upper=True), " ec2, ,s3\n ,") == ["EC2", "S3"]
    assert value(X.split_list, None) == []
    assert value(X.safe_name, "eu-west-1@a b/é.x") == "eu-west-1_a_b_é.x"
    assert value(X.safe_id, "a-b.c_1") == "abc_1"
    assert value(X.safe_id, "--") == "m"
    assert value(X.safe_id, "x" * 50) == "x" * 40
    assert value(X.safe_view_name, "acme-1.é") == "acme_1__"


def test_truncated(value):
    assert value(lambda c: X.truncated(c, 3), "abcd") == "abc…"
    assert value(lambda c: X.truncated(c, 4), "abcd") == "abcd"
    assert value(X.truncated, None) == ""


def test_first_nonblank_skips_null_and_blank(value):
    assert value(lambda c: X.first_nonblank(F.lit(None), c, F.lit("z")), "") == "z"
    assert value(lambda c: X.first_nonblank(c), None) == ""


@pytest.mark.parametrize(
    "text, expected",
    [('["a","b"]', ["a", "b"]), ("not json", []), ("", []), (None, []), ("[]", [])],
)
def test_json_texts(value, text, expected):
    assert value(X.json_texts, text) == expected


BUCKETS = [
    (300, "PT5M", "13:45:00"),
    (3600, "PT1H", "13:00:00"),
    (86400, None, "00:00:00"),
    (300, " pt1d ", "00:00:00"),
    (420, None, "13:46:00"),
    (90, None, "13:47:59"),
    (30, None, "13:47:00"),
    (0, None, "13:00:00"),
    (7200, "", "12:00:00"),
    (5400, "", "13:30:00"),
    (None, None, "13:00:00"),
]


def test_bucket_rules(spark):
    ts = dt.datetime(2024, 1, 1, 13, 47, 59, 500000, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame(
        [(i, ts, p, v) for i, (p, v, _) in enumerate(BUCKETS)],
        "i int, ts timestamp, period int, interval string",
    )
    start = M.bucket_seconds(F.col("ts"), F.col("period"), F.col("interval"))
    got = {r.i: r.b for r in df.select("i", M.bucket_text(start).alias("b")).collect()}
    assert got == {i: f"2024-01-01T{t}Z" for i, (_, _, t) in enumerate(BUCKETS)}


def test_bucket_before_1970(spark):
    ts = dt.datetime(1969, 12, 31, 23, 59, 59, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(ts,)], "ts timestamp")
    start = M.bucket_seconds(F.col("ts"), F.lit(300), F.lit("PT5M"))
    assert df.select(M.bucket_text(start).alias("b")).first().b == "1969-12-31T23:55:00Z"


def test_text_dates(value):
    assert value(M.hour_of, "2024-01-01T23:05:00Z") == 23
    assert value(M.hour_of, "2024-01-01T23:05:00+02:00") == 21
    assert value(M.hour_of, "soon") is None
    assert value(M.month_of, "2024-03-09") == "2024-03"
    assert value(M.month_of, "x") is None
    as_of = dt.date(2024, 1, 31)
    kept = {d: value(lambda c: M.since(c, as_of, 7), d) for d in ["2024-01-23", "2024-01-24", "2024-02-05", "junk"]}
    assert kept == {"2024-01-23": False, "2024-01-24": True, "2024-02-05": True, "junk": None}


def test_six_places(spark):
    df = spark.createDataFrame([(1.23456789,), (2.0,), (None,)], "v double")
    assert [r.r for r in df.select(M.six_places(F.col("v")).alias("r")).collect()] == [1.234568, 2.0, None]


def test_type_names():
    assert spark_type("long") == spark_type("bigint")
    assert spark_type("money").simpleString() == "string"
    schema = declared_schema({"a": "double", "b": "whatever"})
    assert schema.simpleString() == "struct<a:double,b:string>"


def test_parse_params():
    got = parse_params(
        {
            "CLIENT_ID": "c1",
            "ICEBERG_DATABASE": "lake",
            "ACTIVE_SERVICES": " ec2 ,S3",
            "AWS_REGIONS": "ALL",
            "ACCOUNT_IDS": "111122223333;444455556666",
            "CLOUD_ACCOUNT_ID": "444455556666",
            "WINDOW_DAYS": "3",
        }
    )
    assert got.services == ("EC2", "S3")
    assert got.regions == ()
    assert got.accounts == ("444455556666", "111122223333")
    assert got.window_days == 3
    assert parse_params({"CLIENT_ID": "c", "ICEBERG_DATABASE": "d", "ACTIVE_SERVICES": "all"}).services == ()
    lake = {"CLIENT_ID": "c", "ICEBERG_DATABASE": "d", "ICEBERG_CATALOG": "cat", "S3_BUCKET": "b"}
    got = parse_params(lake | {"AWS_ACCOUNT_ID": "111122223333"})
    assert (got.provider, got.database, got.warehouse) == ("iceberg", "cat.d", "s3://b/warehouse")
    assert got.accounts == ("111122223333",)
    named = parse_params(lake | {"AWS_ACCOUNT_ID": "111122223333", "ACCOUNT_IDS": "444455556666"})
    assert named.accounts == ("444455556666",)
