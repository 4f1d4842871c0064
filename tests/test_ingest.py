"""The whole job over landed documents."""

import datetime as dt
import json
import re

import pytest

from cumulo.operators.reports import run_totals
from cumulo.operators.shape import keep_last
from cumulo.plans.ingest import Landed, run_ingest
from cumulo.plans.params import IngestParams
from cumulo.schemas import RAW_METRICS
from cumulo.sources.landed import ARRIVAL, read_metric_results
from cumulo.sources.tables import read_raw_metrics

ACCOUNTS = ("111122223333", "444455556666")


def land(folder, name, docs):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(d) for d in docs))


@pytest.fixture
def landed(tmp_path):
    for account in ACCOUNTS:
        scope = f"account_id={account}/region=eu-west-1"
        instance = {
            "InstanceId": "i-1",
            "Tags": [{"Key": "Name", "Value": "web"}],
            "BlockDeviceMappings": [{"Ebs": {"VolumeId": "v-1"}}, {"Ebs": {"VolumeId": "v-2"}}],
        }
        land(tmp_path / "inventory" / scope, "p.json", [{"Reservations": [{"Instances": [instance]}]}])
        key = f"{account}/eu-west-1/i-1"
        hours = [f"2024-01-31T{h:02d}:{m:02d}:10Z" for h in (1, 2) for m in (0, 2, 6)]
        land(
            tmp_path / "metrics" / scope,
            "m.json",
            [
                {"Id": f"{key}//CPUUtilization/Average/300", "Timestamps": hours, "Values": [1, 2, 3, 10, 20, 5]},
                {"Id": f"{key}/v-1/VolumeReadOps/Sum/86400", "Timestamps": ["2024-01-30T00:00:00Z"], "Values": [1.5]},
                {"Id": f"{key}/v-2/VolumeReadOps/Sum/86400", "Timestamps": ["2024-01-30T00:00:00Z"], "Values": [2.25]},
                {"Id": "other", "Timestamps": ["2024-01-30T00:00:00Z"], "Values": [9.0]},
                {"Id": f"{key}//NetworkIn/Sum/86400", "Timestamps": ["2023-01-30T00:00:00Z"], "Values": [9.0]},
            ],
        )
    return Landed(str(tmp_path / "inventory"), str(tmp_path / "metrics"))


def test_job_is_idempotent_and_serves_both_tenants(spark, database, landed, run_time):
    params = IngestParams("c1", database, additional_client_id="c2")
    for time in (run_time - dt.timedelta(days=1), run_time):
        log = run_ingest(spark, params, landed, time)
    totals = {r.table_name: (r.rows_fetched, r.rows_merged) for r in run_totals(log).collect()}
    assert totals == {
        "bronze_aws_ec2_instances_v1": (2, 4),
        "bronze_aws_metrics_v1": (14, 20),
        "test_bronze_aws_metrics": (0, 8),
        "bronze_aws_daily_metrics": (0, 8),
    }
    inventory = spark.table(f"{database}.bronze_aws_ec2_instances_v1")
    assert {(r.client_id, r.account_id, r.year_month) for r in inventory.collect()} == {
        (c, a, "2024-02") for c in ("c1", "c2") for a in ACCOUNTS
    }
    raw = spark.table(f"{database}.bronze_aws_metrics_v1").where(f"client_id = 'c2' and account_id = '{ACCOUNTS[0]}'")
    assert {(r.metric_name, r.date): r.metric_value for r in raw.collect()} == {
        # The later point of a bucket wins.
        ("CPUUtilization", "2024-01-31T01:00:00Z"): 2.0,
        ("CPUUtilization", "2024-01-31T01:05:00Z"): 3.0,
        ("CPUUtilization", "2024-01-31T02:00:00Z"): 20.0,
        ("CPUUtilization", "2024-01-31T02:05:00Z"): 5.0,
        ("VolumeReadOps", "2024-01-30T00:00:00Z"): 3.75,
    }
    for table in ("test_bronze_aws_metrics", "bronze_aws_daily_metrics"):
        daily = spark.table(f"{database}.{table}")
        got = {(r.client_id, r.account_id, r.metric_name, r.aggregation_type, r.metric_date, r.metric_value) for r in daily.collect()}
        assert got == {
            row
            for c in ("c1", "c2")
            for a in ACCOUNTS
            for row in (
                (c, a, "CPUUtilization", "p90", "2024-01-31", 11.5),
                (c, a, "VolumeReadOps", "Sum", "2024-01-30", 3.75),
            )
        }


def test_scope_and_unknown_services(spark, database, landed, run_time):
    params = IngestParams("c1", database, services=("EC2", "NOPE"), accounts=(ACCOUNTS[1],))
    log = {r.table_name: r.rows_fetched for r in run_ingest(spark, params, landed, run_time).collect()}
    assert log["bronze_aws_ec2_instances_v1"] == 1
    none = IngestParams("c1", database, accounts=("000000000000",))
    assert [r.rows_fetched for r in run_ingest(spark, none, landed, run_time).collect()] == [0]


def test_scopes_with_errors_have_no_inventory(spark, database, landed, run_time, tmp_path):
    errors = [
        {"service_name": "EC2", "account_id": ACCOUNTS[0], "region": "eu-west-1", "code": "AuthFailure"},
        {"service_name": "EC2", "account_id": ACCOUNTS[0], "region": "us-east-1", "code": "InvalidRequest"},
        {"service_name": "S3", "account_id": ACCOUNTS[1], "region": "eu-west-1", "code": "InvalidRequest"},
    ]
    land(tmp_path / "errors", "e.json", errors)
    logged = Landed(landed.inventory, landed.metrics, str(tmp_path / "errors"))
    totals = run_totals(run_ingest(spark, IngestParams("c1", database), logged, run_time))
    row = totals.where("table_name = 'bronze_aws_ec2_instances_v1'").first()
    assert (row.rows_fetched, row.rows_merged, row.failures) == (1, 1, 1)
    stored = spark.table(f"{database}.bronze_aws_ec2_instances_v1")
    assert [r.account_id for r in stored.collect()] == [ACCOUNTS[1]]


def test_instances_without_points(spark, database, landed, run_time, tmp_path):
    """Raw metrics receive nothing, yet the roll-up still runs over what is stored."""
    run_ingest(spark, IngestParams("c1", database), landed, run_time)
    scope = f"account_id={ACCOUNTS[0]}/region=eu-west-1"
    land(tmp_path / "silent" / scope, "m.json", [{"Id": "other", "Timestamps": [], "Values": []}])
    silent = Landed(landed.inventory, str(tmp_path / "silent"))
    log = run_totals(run_ingest(spark, IngestParams("c1", database), silent, run_time))
    totals = {r.table_name: (r.rows_fetched, r.rows_merged) for r in log.collect()}
    assert totals == {
        "bronze_aws_ec2_instances_v1": (2, 2),
        "bronze_aws_metrics_v1": (0, 0),
        "test_bronze_aws_metrics": (0, 4),
        "bronze_aws_daily_metrics": (0, 4),
    }


def test_points_landed_again_count_once(spark, database, landed, run_time, tmp_path):
    """Three runs fetch the same window; volumes are summed over what arrived last."""
    scope = f"account_id={ACCOUNTS[0]}/region=eu-west-1"
    again = [
        {"Id": f"{ACCOUNTS[0]}/eu-west-1/i-1/{v}/VolumeReadOps/Sum/86400", "Timestamps": ["2024-01-30T00:00:00Z"], "Values": [x]}
        for v, x in (("v-1", 1.5), ("v-2", 2.25))
    ]
    for name in ("m2.json", "m3.json"):
        land(tmp_path / "metrics" / scope, name, again)
    run_ingest(spark, IngestParams("c1", database), landed, run_time)
    stored = spark.table(f"{database}.bronze_aws_metrics_v1").where("metric_name = 'VolumeReadOps'")
    assert {r.metric_value for r in stored.collect()} == {3.75}


def test_a_run_reads_its_own_landing(spark, database, landed, run_time, tmp_path):
    scope = f"account_id={ACCOUNTS[0]}/region=eu-west-1"
    for run, ids in (("r1", ("i-1", "i-2")), ("r2", ("i-1",))):
        pages = [{"Reservations": [{"Instances": [{"InstanceId": i} for i in ids]}]}]
        land(tmp_path / "runs" / f"run={run}" / scope, "p.json", pages)
        land(tmp_path / "results" / f"run={run}" / scope, "m.json", [{"Id": "other", "Timestamps": [], "Values": []}])
        folders = Landed(str(tmp_path / "runs"), str(tmp_path / "results"), run=run)
        month = run_time if run == "r1" else run_time + dt.timedelta(days=40)
        run_ingest(spark, IngestParams("c1", database), folders, month)
    stored = spark.table(f"{database}.bronze_aws_ec2_instances_v1").collect()
    assert {(r.instance_id, r.year_month) for r in stored} == {("i-1", "2024-03"), ("i-2", "2024-02")}


def test_broken_pages_fail_their_scope(spark, database, landed, run_time, tmp_path):
    scope = f"account_id={ACCOUNTS[0]}/region=eu-west-1"
    (tmp_path / "inventory" / scope / "q.json").write_text('{"Reservations": [{"Instances": [{"InstanceId": "i-9"')
    (tmp_path / "metrics" / scope / "q.json").write_text('{"Id": "x", "Timestamps": [')
    log = {r.table_name: r for r in run_ingest(spark, IngestParams("c1", database), landed, run_time).collect()}
    assert (log["bronze_aws_ec2_instances_v1"].rows_fetched, log["bronze_aws_ec2_instances_v1"].failed) == (1, 1)
    assert log["bronze_aws_metrics_v1"].failed == 1
    stored = spark.table(f"{database}.bronze_aws_ec2_instances_v1")
    assert [r.account_id for r in stored.collect()] == [ACCOUNTS[1]]


def test_errors_of_other_accounts_do_not_count(spark, database, landed, run_time, tmp_path):
    errors = [{"service_name": "EC2", "account_id": ACCOUNTS[0], "region": "eu-west-1", "code": "InvalidRequest"}]
    land(tmp_path / "errors", "e.json", errors)
    logged = Landed(landed.inventory, landed.metrics, str(tmp_path / "errors"))
    log = run_ingest(spark, IngestParams("c1", database, accounts=(ACCOUNTS[1],)), logged, run_time).first()
    assert (log.rows_fetched, log.failed) == (1, 0)


def test_a_tenant_named_twice_is_served_once(spark, database, landed, run_time):
    run_ingest(spark, IngestParams("c1", database, additional_client_id="c1"), landed, run_time)
    for table, keys in (("bronze_aws_ec2_instances_v1", 2), ("bronze_aws_daily_metrics", 4)):
        assert spark.table(f"{database}.{table}").count() == keys


def test_arrival_order_does_not_follow_splits(spark, tmp_path):
    """Files of one time: the same winners however they are split."""
    import os

    for name, value in (("a.json", 1.0), ("b.json", 2.0)):
        land(tmp_path / "account_id=1/region=r", name, [{"Id": str(i), "Values": [value]} for i in range(3000)])
        os.utime(tmp_path / "account_id=1/region=r" / name, (1_700_000_000, 1_700_000_000))
    winners = []
    for size in ("128m", "10k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        last = keep_last(read_metric_results(spark, str(tmp_path)), ["Id"], ARRIVAL)
        winners.append({(r.Id, r.Values[0]) for r in last.collect()})
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert winners[0] == winners[1] == {(str(i), 2.0) for i in range(3000)}


def test_runs_and_months_prune_directories(spark, database, landed, tmp_path):
    from cumulo.operators.upsert import ensure_table

    land(tmp_path / "runs/run=r1/account_id=1/region=r", "m.json", [{"Id": "a"}])
    plan = read_metric_results(spark, str(tmp_path / "runs"), run="r1")._jdf.queryExecution().executedPlan().toString()
    assert "run" in plan.split("PartitionFilters: [")[1].split("]")[0]
    name = ensure_table(spark, database, RAW_METRICS)
    stored = read_raw_metrics(
        spark, name, RAW_METRICS, client_id="c", service_name="EC2", as_of=dt.date(2024, 2, 3), window_days=7
    )
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "2024-01" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_run_that_landed_nothing_is_an_error(spark, database, landed, run_time):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException, match="run=r1"):
        run_ingest(spark, IngestParams("c1", database), Landed(landed.inventory, landed.metrics, run="r1"), run_time)


def test_run_names_are_found_as_spark_writes_them(spark, tmp_path):
    name = "2024-01-31T00:00:00 #1=a%b/c[d]{e}"
    rows = spark.createDataFrame([("a", name, "1", "r")], "Id string, run string, account_id string, region string")
    rows.write.partitionBy("run", "account_id", "region").json(str(tmp_path / "runs"))
    assert [r.Id for r in read_metric_results(spark, str(tmp_path / "runs"), run=name).collect()] == ["a"]


def test_pages_are_parsed_once(spark, database, landed, run_time, monkeypatch):
    """One scan of JSON pages feeds the malformed count, the failed scopes and the inventory."""
    from cumulo.plans import ingest

    scans = []
    real = ingest.stage

    def seen(df, label, *partitions):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        scans.append((label, plan.count("Reservations#") > 0 and "json" in plan))
        return real(df, label, *partitions)

    monkeypatch.setattr(ingest, "stage", seen)
    run_ingest(spark, IngestParams("c1", database), landed, run_time)
    assert [label for label, reads in scans if reads] == ["listed"]


def stored_daily(spark, database):
    daily = spark.table(f"{database}.bronze_aws_daily_metrics").drop("ingestion_timestamp", "job_runtime_utc")
    return sorted((tuple(r) for r in daily.collect()), key=repr)


def test_a_ledger_reads_each_file_once(spark, database, landed, run_time, tmp_path):
    """The second job parses nothing old; results that land later meet instances of an earlier job."""
    from cumulo.sources.landed import read_inventory_pages

    params = IngestParams("c1", database)
    once = Landed(landed.inventory, landed.metrics, once=True)
    first = run_totals(run_ingest(spark, params, once, run_time)).collect()
    before = stored_daily(spark, database)
    scope = f"account_id={ACCOUNTS[0]}/region=eu-west-1"
    key = f"{ACCOUNTS[0]}/eu-west-1/i-1"
    later = [{"Id": f"{key}//NetworkIn/Sum/86400", "Timestamps": ["2024-01-29T00:00:00Z"], "Values": [7.0]}]
    land(tmp_path / "metrics" / scope, "late.json", later)
    second = run_totals(run_ingest(spark, params, once, run_time + dt.timedelta(hours=1))).collect()
    fetched = lambda log: {r.table_name: r.rows_fetched for r in log}
    assert fetched(first)["bronze_aws_metrics_v1"] == 14 and fetched(second)["bronze_aws_metrics_v1"] == 1
    assert fetched(second)["bronze_aws_ec2_instances_v1"] == 0
    after = stored_daily(spark, database)
    assert len(after) == len(before) + 1 and set(before) < set(after)
    # Another scope's files stay unread, a file that changed is read again.
    from cumulo.sources.ledger import Ledger

    land(tmp_path / "metrics" / scope, "late.json", later * 2)
    assert [p.rsplit("/", 1)[1] for p in Ledger(spark, database).take(landed.metrics, (ACCOUNTS[0],), None)] == ["late.json"]
    assert Ledger(spark, database).take(landed.metrics, (ACCOUNTS[1],), None) == []
    assert read_inventory_pages(spark, landed.inventory, files=[]).count() == 0


def test_changed_days_give_the_full_rollup(spark, tmp_path, run_time):
    """Random batches, among them late and repeated points: the same daily rows, from fewer stored rows."""
    import random

    from cumulo.operators.upsert import create_database
    from cumulo.plans import ingest

    draw = random.Random(3)
    account = ACCOUNTS[0]
    scope = f"account_id={account}/region=eu-west-1"
    pages = [{"Reservations": [{"Instances": [{"InstanceId": f"i-{i}"} for i in range(4)]}]}]
    stored = {}
    for kind, changes in (("full", False), ("changes", True)):
        create_database(spark, f"db_{kind}", str(tmp_path / f"warehouse-{kind}"))
    batches = []
    for batch in range(3):
        docs = []
        for _ in range(12):
            i, day = draw.randrange(4), draw.choice(["2024-01-28", "2024-01-29", "2024-01-30"][: 1 + batch])
            hours = [f"{day}T{draw.randrange(24):02d}:{draw.choice((0, 5, 10)):02d}:00Z" for _ in range(3)]
            docs.append({"Id": f"{account}/eu-west-1/i-{i}//CPUUtilization/Average/300", "Timestamps": hours, "Values": [draw.randrange(9) for _ in hours]})
            docs.append({"Id": f"{account}/eu-west-1/i-{i}//NetworkIn/Sum/86400", "Timestamps": [f"{day}T00:00:00Z"], "Values": [draw.randrange(99)]})
        run = f"b{batch}"
        land(tmp_path / "pages" / f"run={run}" / scope, "p.json", pages)
        land(tmp_path / "results" / f"run={run}" / scope, "m.json", docs)
        batches.append(run)
    for n, run in enumerate(batches):
        for kind, changes in (("full", False), ("changes", True)):
            params = IngestParams("c1", f"db_{kind}", additional_client_id="c2", changes_only=changes)
            folders = Landed(str(tmp_path / "pages"), str(tmp_path / "results"), run=run)
            run_ingest(spark, params, folders, run_time + dt.timedelta(hours=n))
            stored[kind] = stored_daily(spark, f"db_{kind}")
        assert stored["full"] == stored["changes"] and stored["full"]
    assert spark.table("db_changes.changed_days").count() == 0
    # A job that stops before its roll-up leaves its days to the next one.
    params = IngestParams("c1", "db_changes", changes_only=True)
    raw = spark.table("db_changes.bronze_aws_metrics_v1").where("client_id = 'c1'")
    ingest._note_changes(raw.where("metric_date = '2024-01-28'"), params, run_time)
    days = ingest._pending(spark, params, None)
    from cumulo.operators.rollup import only_days

    some = only_days(raw, days)
    assert {r.metric_date for r in some.collect()} == {"2024-01-28"} and some.count() < raw.count()
    for kind in stored:
        spark.sql(f"DROP DATABASE db_{kind} CASCADE")


@pytest.fixture
def broadcast_by(monkeypatch):
    """Keys of the broadcast joins in all that is staged or written, where tables count as too long for one."""
    from cumulo.operators import rollup, shape, upsert
    from cumulo.plans import ingest
    from cumulo.sources import ledger

    monkeypatch.setattr(shape, "BROADCAST_ROWS", 0, raising=False)
    monkeypatch.setattr(rollup, "BROADCAST_DAYS", 0)
    found = set()

    def spied(real):
        def call(df, *args):
            plan = df._jdf.queryExecution().executedPlan().toString()
            for keys in re.findall(r"BroadcastHashJoin .*?, \[(.*?)\], ", plan):
                found.add(tuple(re.sub(r"#\d+L?", "", k) for k in keys.split(", ")))
            return real(df, *args)

        return call

    for module, name in ((ingest, "stage"), (upsert, "stage"), (ledger, "stage"), (upsert, "_balanced")):
        monkeypatch.setattr(module, name, spied(getattr(module, name)))
    return found


def test_a_job_broadcasts_no_rows_of_its_tables(spark, database, landed, run_time, broadcast_by):
    """Only specifications, scopes that failed and partitions, though all files of the job are small."""
    once = Landed(landed.inventory, landed.metrics, once=True)
    run_ingest(spark, IngestParams("c1", database, additional_client_id="c2", changes_only=True), once, run_time)
    assert broadcast_by == {("metric_name",), ("account_id", "region"), ("_listed",)}
    assert len(stored_daily(spark, database)) == 8


def test_a_repeated_report_is_merged_without_broadcasting_its_lines(spark, database, rows, run_time, broadcast_by):
    from pyspark.sql import functions as F

    from cumulo.operators.reports import report_lines
    from cumulo.plans import ingest
    from cumulo.plans.services import service_named

    for factor in (1, 2):
        lines = report_lines(spark.range(3), "metric_rows", F.concat(F.lit("m"), "id"), F.col("id") * factor)
        ingest._store_report(spark, [lines], service_named("EC2"), IngestParams("c1", database), run_time)
    told = ingest.run_report(spark, database, run_time)
    assert rows(told.select("section", "name", "value")) == [("metric_rows", f"m{i}", 2 * i) for i in range(3)]
    assert broadcast_by == {("_listed",)}
