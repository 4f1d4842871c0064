"""The scheduled job: landed documents into inventory, raw metrics and daily metrics.

All accounts, regions and tenants of a service go through one plan per table. Every result that
several writes consume is staged once in the shared folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cumulo.operators import points as P
from cumulo.operators.reports import (
    count_by_metric,
    denial_samples,
    denial_summary,
    fails_softly,
    hard_failures,
    merge_report,
    report_lines,
    run_totals,
    without_failed_scopes,
)
from cumulo.operators.rollup import DAY, changed_days, daily_projection, daily_values, only_days, unique_daily
from cumulo.operators.shape import client_list, for_clients, join_side, keep_last, stamp
from cumulo.operators.upsert import append, as_stored, ensure_table, merge_batch, remove_keys
from cumulo.plans.params import IngestParams
from cumulo.plans.services import Service, active_services, service_named
from cumulo.schemas import CHANGED_DAYS, DAILY_TABLES, RUN_REPORT, Table
from cumulo.session import configure, stage
from cumulo.sources.landed import ARRIVAL, read_error_log, read_inventory_pages, read_metric_results
from cumulo.sources.ledger import Ledger
from cumulo.sources.tables import read_raw_metrics

_RUN_LOG = "table_name string, rows_fetched long, rows_merged long, failed long"


@dataclass(frozen=True)
class Landed:
    """Folders of landed documents, partitioned by account and region, and of landing errors.

    Folders that are also partitioned by ``run`` are read for the named run only: an instance that
    is gone keeps its last state, and old landings are not parsed again. A run that landed nothing is an
    error. Without a run all landed documents are read, and each point counts as it last arrived; with
    ``once`` only the files that no job has consumed yet, as a ledger in the database tells.
    """

    inventory: str
    metrics: str
    errors: str | None = None
    run: str | None = None
    once: bool = False


def run_ingest(
    spark: SparkSession,
    params: IngestParams,
    landed: Landed,
    run_time: dt.datetime,
    catalog: DataFrame | None = None,
) -> DataFrame:
    """Run every requested or active service that is registered; returns the run log by table.

    What else a run has to tell is stored by service in the table ``run_report``; see :func:`run_report`.
    """
    configure(spark)
    log: list[tuple] = []
    for name in active_services(params.services, catalog):
        service = service_named(name)
        if service is not None:
            notes: list[DataFrame] = []
            own = _ingest_service(spark, service, params, landed, run_time, notes)
            totals = run_totals(spark.createDataFrame(own, _RUN_LOG))
            for measure in ("rows_fetched", "rows_merged", "failures"):
                notes.append(report_lines(totals, measure, F.col("table_name"), F.col(measure)))
            _store_report(spark, notes, service, params, run_time)
            log += own
    return spark.createDataFrame(log, _RUN_LOG)


def run_name(run_time: dt.datetime) -> str:
    return run_time.astimezone(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")


def run_report(spark: SparkSession, database: str, run_time: dt.datetime) -> DataFrame:
    """What the run of that time has told, by service and section: ``rows_fetched``, ``rows_merged`` and
    ``failures`` by table, ``metric_rows`` by metric, ``duplicates`` removed, ``denials`` by code (detail: how
    they are taken), ``denial_samples`` by scope (detail: the reason)."""
    return spark.table(f"{database}.{RUN_REPORT.name}").where(F.col("run") == run_name(run_time)).select(
        "service_name", "section", "name", "detail", "value"
    )


def _store_report(
    spark: SparkSession, notes: Sequence[DataFrame], service: Service, params: IngestParams, run_time: dt.datetime
) -> None:
    name = ensure_table(spark, params.database, RUN_REPORT, provider=params.provider, warehouse=params.warehouse or None)
    lines = reduce(DataFrame.unionByName, notes)
    lines = lines.withColumns({"service_name": F.lit(service.name), "run": F.lit(run_name(run_time))})
    # A run that is repeated replaces its report.
    batch = stage(as_stored(lines.coalesce(1), RUN_REPORT), "report")
    merge_batch(batch, name, RUN_REPORT)


def _ingest_service(
    spark: SparkSession,
    service: Service,
    params: IngestParams,
    landed: Landed,
    run_time: dt.datetime,
    notes: list[DataFrame],
) -> list[tuple]:
    accounts, regions = params.accounts or None, params.regions or None
    scope = (accounts, regions, landed.run)
    ledger = Ledger(spark, params.database, params.provider, params.warehouse or None) if landed.once else None
    taken = lambda folder: ledger.take(folder, accounts, regions) if ledger else None
    pages = read_inventory_pages(spark, landed.inventory, *scope, taken(landed.inventory))
    failures = 0
    if landed.errors:
        errors = read_error_log(spark, landed.errors, *scope).where(F.col("service_name") == service.name)
        pages = without_failed_scopes(pages, errors)
        failures = hard_failures(errors).count()
        taken_as = F.when(fails_softly(F.col("code")), "warning").otherwise("no inventory")
        notes.append(report_lines(denial_summary(errors), "denials", F.col("code"), F.col("denials"), taken_as))
        samples = denial_samples(errors, ("account_id", "region", "code", "message"))
        scope_name = F.concat_ws("@", "account_id", "region", "code")
        samples = samples.groupBy(scope_name.alias("name"), "reason").agg(F.count(F.lit(1)).alias("n"))
        notes.append(report_lines(samples, "denial_samples", F.col("name"), F.col("n"), F.col("reason")))
    # Parsed once: what is staged also tells of the pages that did not parse.
    listed = stage(service.listed(pages), "listed")
    failures += listed.where("malformed").count()
    found, fetched = _counted(service.resources(listed))
    resources = stage(keep_last(found, P.INSTANCE_KEYS, ARRIVAL), "resources")
    inventory = stamp(resources, params.client_id, run_time)
    log = [_merge(inventory, service.inventory, params, fetched, failures)]
    if service.metrics is None:
        return log
    if ledger:
        # Results may land long after the pages of their instances.
        resources = stage(_with_stored(resources, service, params, accounts, regions), "known")
    # Without instances there is nothing to measure; without points the roll-up still runs.
    if resources.isEmpty() if ledger else log[0][1] == 0:
        return log

    # Parsed once, with the malformed documents counted on the way.
    seen = Observation()
    results = read_metric_results(spark, landed.metrics, *scope, taken(landed.metrics))
    results = results.observe(seen, F.count(F.when(F.col("malformed"), 1)).alias("malformed"))
    blocks = stage(P.valid_blocks(results), "blocks")
    series = P.expected_series(
        resources, P.attached_volumes(resources), service.instance_specs, service.volume_specs
    )
    zipped = P.zip_points(P.join_series(blocks, series))
    recent = P.landed_within(zipped, run_time, params.window_days)
    # Instance and volume series part ways from here: parse the documents only once.
    points = stage(P.align_points(P.latest_points(recent, ARRIVAL)), "points")
    merged, fetched = _counted(P.instance_points(points))
    # Repeated buckets go while the rows are still narrow; the last point to arrive stays.
    unique = keep_last(
        merged, (*P.INSTANCE_KEYS, "metric_name", "stat", "bucket"), (*ARRIVAL, "position")
    )
    unique, kept = _counted(unique)
    raw = P.enrich(
        unique, join_side(resources), service.specs, service_name=service.name, namespace=service.namespace
    )
    raw = stage(as_stored(stamp(raw, params.client_id, run_time), service.metrics), "raw")
    removed = spark.range(1).select(F.lit(fetched() - kept()).alias("n"))
    notes.append(report_lines(removed, "duplicates", F.lit(service.metrics.name), F.col("n")))
    notes.append(report_lines(count_by_metric(raw), "metric_rows", F.col("metric_name"), F.col("row_count")))
    if params.changes_only:
        _note_changes(raw, params, run_time)
    log.append(_merge(raw, service.metrics, params, fetched, seen.get["malformed"]))

    stored = read_raw_metrics(
        spark,
        f"{params.database}.{service.metrics.name}",
        service.metrics,
        client_id=params.client_id,
        accounts=accounts,
        service_name=service.name,
        as_of=run_time.astimezone(dt.timezone.utc).date(),
        window_days=params.window_days,
    )
    if params.changes_only:
        days = stage(_pending(spark, params, accounts), "changed-days")
        stored = only_days(stored, days)
    values = unique_daily(daily_values(stored, service.specs, service.percentile))
    daily = stage(daily_projection(values, service.namespace, run_time), "daily")
    log += [_merge(daily, table, params) for table in DAILY_TABLES]
    clients = len(client_list(params.client_id, params.additional_client_id))
    told = merge_report(daily, [t.name for t in DAILY_TABLES], clients)
    notes.append(report_lines(told, "daily_rows", F.col("table_name"), F.col("rows_merged")))
    if params.changes_only:
        _forget_changes(days, params)
    if ledger:
        ledger.note(service.name, run_time)
    return log


def _with_stored(
    resources: DataFrame, service: Service, params: IngestParams, accounts: Sequence[str] | None, regions: Sequence[str] | None
) -> DataFrame:
    """The resources of this landing and those stored by earlier ones, made anew from their documents."""
    stored = resources.sparkSession.table(f"{params.database}.{service.inventory.name}")
    stored = stored.where(F.col("client_id") == params.client_id)
    for column, wanted in (("account_id", accounts), ("region", regions)):
        if wanted is not None:
            stored = stored.where(F.col(column).isin(*wanted))
    listed = stored.select("account_id", "region", "raw_data", F.lit(False).alias("malformed"))
    again = service.resources(listed).join(join_side(resources), list(P.INSTANCE_KEYS), "left_anti")
    return resources.unionByName(again, allowMissingColumns=True)


# Days whose raw points changed are stored before the points are merged and forgotten after their daily rows
# are: a job that stops in between leaves them to the next one.


def _note_changes(raw: DataFrame, params: IngestParams, run_time: dt.datetime) -> None:
    name = ensure_table(raw.sparkSession, params.database, CHANGED_DAYS, provider=params.provider, warehouse=params.warehouse or None)
    append(changed_days(raw).withColumn("batch", F.lit(run_name(run_time))), name, CHANGED_DAYS)


def _pending(spark: SparkSession, params: IngestParams, accounts: Sequence[str] | None) -> DataFrame:
    days = spark.table(f"{params.database}.{CHANGED_DAYS.name}").where(F.col("client_id") == params.client_id)
    if accounts is not None:
        days = days.where(F.col("account_id").isin(*accounts))
    return days.groupBy(*DAY).agg(F.collect_set("batch").alias("batches"))


def _forget_changes(days: DataFrame, params: IngestParams) -> None:
    """Leave only what other tenants and accounts still have to roll up."""
    name = f"{params.database}.{CHANGED_DAYS.name}"
    done = days.select(*DAY, F.explode("batches").alias("batch"))
    remove_keys(done, name, CHANGED_DAYS)


def _counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """Count the rows on their way through the next write instead of in a job of their own."""
    seen = Observation()

    def rows() -> int:
        try:
            return seen.get["rows"]
        except Py4JJavaError:
            # Adaptive execution found the result empty and dropped the plan with its counter.
            return df.count()

    return df.observe(seen, F.count(F.lit(1)).alias("rows")), rows


def _merge(
    batch: DataFrame,
    table: Table,
    params: IngestParams,
    fetched: Callable[[], int] | None = None,
    failures: int = 0,
) -> tuple:
    """Merge a staged batch, unique by key, once per tenant; returns its line of the run log."""
    clients = client_list(params.client_id, params.additional_client_id)
    name = ensure_table(
        batch.sparkSession,
        params.database,
        table,
        provider=params.provider,
        warehouse=params.warehouse or None,
    )
    merge_batch(for_clients(as_stored(batch, table), clients), name, table)
    rows_fetched = fetched() if fetched else 0
    return (table.name, rows_fetched, batch.count() * len(clients), failures)
