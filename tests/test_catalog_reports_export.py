"""Service catalog, run reports, exports and small sources."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cumulo.functions.text import resolve_regions, split_list
from cumulo.operators import catalog as C
from cumulo.operators import export as E
from cumulo.operators import reports as R
from cumulo.operators import shape as S
from cumulo.plans.services import active_services, registered_names, service_named
from cumulo.schemas import METRIC_SCHEMA, RAW_METRICS, declared_schema
from cumulo.sources import tables as T

CATALOG = "service_code string, cloud_provider string, is_active boolean"


@pytest.fixture
def catalog(spark):
    return spark.createDataFrame(
        [("EC2", " AWS ", True), ("S3", "aws", False), ("EC2", "aws", True), ("VM", "azure", True), ("rds", "Aws", True)],
        CATALOG,
    )


def test_active_codes(catalog):
    assert [r[0] for r in C.active_codes(catalog).collect()] == ["EC2", "rds"]


def test_registered_codes(spark, catalog, rows):
    codes = C.active_codes(catalog)
    assert rows(C.registered_codes(codes, ["EC2", "RDS"])) == [("EC2",), ("RDS",)]
    assert rows(C.registered_codes(codes, ["LAMBDA"])) == [("EC2",)]
    assert rows(C.registered_codes(codes.limit(0), ["RDS"])) == [("EC2",)]
    assert rows(C.split_registered(codes, ["EC2"])) == [("EC2", True), ("RDS", False)]


def test_active_services(catalog):
    assert active_services(["ec2", "nope"], None) == ["EC2", "NOPE"]
    assert active_services([], None) == ["EC2"]
    assert active_services([], catalog) == ["EC2"]
    assert registered_names() == ["EC2"]
    assert service_named("ec2").namespace == "AWS/EC2"
    assert service_named("nope") is None


def test_unique_key_violations(spark, rows):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", None), ("b", None)], "service_code string, cloud_provider string")
    assert rows(C.unique_key_violations(df)) == [("a", "x", 2)]


def test_catalog_defaults(spark):
    now = F.lit(dt.datetime(2024, 1, 1))
    row = C.with_catalog_defaults(spark.createDataFrame([("a", None), ("b", False)], "c string, is_active boolean"), now).collect()
    assert [r.is_active for r in row] == [True, False]
    assert row[0].created_at == row[0].updated_at is not None


def test_ingest_scope(spark, rows):
    accounts = spark.createDataFrame([("a", "r1,r2"), ("b", "ALL")], "account_id string, wanted string")
    got = C.ingest_scope(accounts, resolve_regions(F.col("wanted"), ["z"]), split_list(F.lit("EC2,S3")))
    assert rows(got) == sorted(
        [("a", r, s) for r in ("r1", "r2") for s in ("EC2", "S3")] + [("b", "z", s) for s in ("EC2", "S3")], key=repr
    )


@pytest.fixture
def error_log(spark):
    codes = ["AuthFailure", "InvalidRequest", "RequestExpired", "", None, "AuthFailure"]
    return spark.createDataFrame(
        [("a", "r", c, "denied by service_control_policy" if i == 0 else None, i) for i, c in enumerate(codes)],
        "account_id string, region string, code string, message string, n int",
    )


def test_error_classes(error_log):
    got = [tuple(r) for r in error_log.orderBy("n").select(R.error_class(F.col("code")), R.fails_softly(F.col("code"))).collect()]
    assert got == [("soft", True), ("hard", False), ("soft", False), (None, False), (None, None), ("soft", True)]


def test_denials(error_log, rows):
    assert rows(R.denial_summary(error_log)) == [("AuthFailure", 2, 3), ("RequestExpired", 1, 3)]
    got = [tuple(r) for r in R.denial_samples(error_log, ["n"], 2).collect()]
    assert got == [("a", "r", "AuthFailure", "SCP"), ("a", "r", "RequestExpired", "IAM/deny")]


def test_run_totals(spark, rows):
    log = spark.createDataFrame([("t", 3, 2, False), ("t", -1, 4, True), ("_x", 1, 9, False)], "table_name string, rows_fetched long, rows_merged long, failed boolean")
    assert rows(R.run_totals(log)) == [("_x", 1, 0, 0), ("t", 3, 6, 1)]


def test_counts(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("",), (None,)], "metric_name string")
    assert [tuple(r) for r in R.count_by_metric(df).collect()] == [("a", 1), ("b", 2)]
    assert rows(R.result_count(df)) == [(5, False)]
    assert rows(R.result_count(df.limit(0))) == [(0, True)]
    assert rows(R.merge_report(df, ["x", "y"], 2)) == [("x", 10), ("y", 10)]


def test_preview_and_limit(spark, rows):
    df = spark.createDataFrame([(i, str(i)) for i in range(5)], "id int, v string")
    assert [tuple(r) for r in S.preview(df, ["id"], 2).collect()] == [(0, "0", 5, 2), (1, "1", 5, 2)]
    assert rows(S.limit_to_first(df, df, "id", 2).select("id")) == [(0,), (1,)]
    assert S.limit_to_first(df, df, "id", 0) is df


EXPORT = declared_schema({"service": "string", "region": "string", "v": "string", "n": "double"})


@pytest.mark.parametrize("form", ["json", "csv"])
def test_exports_read_back(spark, tmp_path, rows, form):
    df = spark.createDataFrame(
        [("a", "eu", 'x,"y"\nz\\', 1.5), ("a", "eu/w", "", 2.0), ("b", "eu", None, None)], "account_id string, region string, v string, n double"
    )
    keyed = E.with_export_keys(df, "EC2", several_accounts=True).drop("account_id")
    path = str(tmp_path / "out")
    (E.export_json if form == "json" else E.export_csv)(keyed, path)
    read = E.read_json_export if form == "json" else E.read_csv_export
    at, slash, blank = ("@", "/", "") if form == "json" else ("_", "_", None)
    assert rows(read(spark, path, EXPORT)) == [
        ("EC2", f"a{at}eu", 'x,"y"\nz\\', 1.5),
        ("EC2", f"a{at}eu{slash}w", blank, 2.0),
        ("EC2", f"b{at}eu", None, None),
    ]


def test_one_account_exports_the_bare_region(spark):
    df = spark.createDataFrame([("a", "eu")], "account_id string, region string")
    assert E.with_export_keys(df, "EC2", several_accounts=False).first().region == "eu"


def test_records(spark, rows):
    columns = {"a": "string", "n": "long", "x": "odd type"}
    got = T.records(spark, [{"a": "1", "n": 2, "more": 3}, {"x": "t"}], columns)
    assert rows(got) == [("1", 2, None), (None, None, "t")]
    text = spark.createDataFrame([('{"a":"1","n":2,"more":3}',), ('{"x":"t"}',)], "t string")
    assert rows(T.parse_records(text, "t", columns)) == [("1", 2, None), (None, None, "t")]


def test_missing_table_reads_as_empty(spark):
    got = T.read_if_exists(spark, "no_such_table_here", METRIC_SCHEMA)
    assert got.columns == RAW_METRICS.columns and got.count() == 0


def test_view_lives_only_while_used(spark):
    df = T.with_view(spark.range(3), "v_source", lambda s, n: s.sql(f"select max(id) as m from {n}"))
    assert df.first().m == 2
    assert not spark.catalog.tableExists("v_source")


def test_jdbc_query_is_pushed_as_a_derived_table():
    class Reader:
        def jdbc(self, url, table, properties):
            return url, table, properties

    class Session:
        read = Reader()

    query = T.active_codes_query("service_configuration")
    url, table, properties = T.read_jdbc_query(Session(), "jdbc:x", query, {"driver": "d"})
    assert (url, properties) == ("jdbc:x", {"driver": "d"})
    assert table.startswith("(select distinct service_code from service_configuration")


def test_jdbc_query_text_agrees_with_the_dataframe(spark, catalog, rows):
    text = T.with_view(catalog, "service_configuration", lambda s, n: s.sql(T.active_codes_query(n)))
    assert rows(text) == rows(C.active_codes(catalog))


def test_spec_frame(spark):
    from cumulo.schemas import INSTANCE_SPECS, VOLUME_SPECS, daily_native, sub_daily

    specs = INSTANCE_SPECS + VOLUME_SPECS
    frame = T.spec_frame(spark, specs)
    assert frame.count() == 10
    assert [s.metric_name for s in sub_daily(specs)] == ["CPUUtilization", "MemoryUtilization"]
    assert len(daily_native(specs)) == 8


def test_two_tables_share_a_tree(spark, tmp_path, rows):
    """Each table replaces its own directories only."""
    from cumulo.operators import export as X

    df = spark.createDataFrame([("1", "r", 1), ("2", "r", 2)], "account_id string, region string, n int")
    named = lambda table, d: X.with_export_keys(d, "EC2", True, table).drop("account_id")
    for form in ("json", "csv"):
        path = str(tmp_path / form)
        write, read = getattr(X, f"export_{form}"), getattr(X, f"read_{form}_export")
        write(named("a b", df), path)
        write(named("c", df.withColumn("n", F.col("n") * 10)), path)
        write(named("a b", df.where("n = 2").withColumn("n", F.lit(7))), path)
        schema = declared_schema({"service": "string", "region": "string", "table_name": "string", "n": "int"})
        region = (lambda a: f"{a}@r") if form == "json" else (lambda a: f"{a}_r")
        got = {(r.region, r.table_name, r.n) for r in read(spark, path, schema).collect()}
        assert got == {(region("1"), "a_b", 1), (region("2"), "a_b", 7), (region("1"), "c", 10), (region("2"), "c", 20)}


def test_documents_nest_and_are_bounded(spark, tmp_path):
    import json

    from cumulo.operators import export as X

    one = spark.createDataFrame([("EC2", 'a"b@r', 1, None), ("EC2", "r2", 2, "é\n"), ("S3", "r", 3, "x")], "service string, region string, n int, t string")
    two = spark.createDataFrame([("EC2", "r2", 9.5)], "service string, region string, v double")
    got = {r.service: json.loads(r.document) for r in X.nested_documents({"one": one, "two": two}).collect()}
    assert got == {
        "EC2": {'a"b@r': {"one": [{"n": 1, "t": None}]}, "r2": {"one": [{"n": 2, "t": "é\n"}], "two": [{"v": 9.5}]}},
        "S3": {"r": {"one": [{"n": 3, "t": "x"}]}},
    }
    with pytest.raises(ValueError, match="EC2"):
        X.nested_documents({"one": one}, most_bytes=20)


def test_admit_keeps_the_target_unique(spark):
    """Random batches: the target stays unique, and nothing is lost."""
    import random

    from cumulo.operators import catalog as C

    draw = random.Random(5)
    schema = "id int, service_code string, cloud_provider string"
    target, lost, sent = spark.createDataFrame([], schema), 0, 0
    for _ in range(3):
        rows = [(draw.randrange(1000), draw.choice(["a", "b", "c", None]), draw.choice(["aws", "AWS ", "x"])) for _ in range(20)]
        keys = {"code": F.col("service_code"), "provider": C.normalized(F.col("cloud_provider"))}
        accepted, rejected = C.admit(spark.createDataFrame(rows, schema), target, ["id", "cloud_provider"], keys)
        assert {r.reason for r in rejected.collect()} <= {"exists", "repeated"}
        target = spark.createDataFrame(target.union(accepted).collect(), schema)
        lost, sent = lost + rejected.count(), sent + len(rows)
        normal = target.withColumn("cloud_provider", C.normalized(F.col("cloud_provider")))
        assert C.unique_key_violations(normal).count() == 0
        assert target.count() + lost == sent
