"""Summaries of a run: counts, denials and totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Error codes that leave a scope without inventory instead of failing it.
SOFT_DENIAL_CODES = (
    "AuthFailure",
    "UnauthorizedOperation",
    "AccessDenied",
    "OptInRequired",
    "RequestExpired",
    "OptinRequired",
)
# The reason hint of a denial, and how many samples are shown.
POLICY_MARK = "service_control_policy"
POLICY_HINT = "SCP"
OTHER_HINT = "IAM/deny"
SAMPLES = 8


def error_class(code: Column) -> Column:
    """``soft`` for expected access errors, ``hard`` for the rest, NULL without an error."""
    return F.when(code.isin(*SOFT_DENIAL_CODES), "soft").when(code != "", "hard")


def without_failed_scopes(pages: DataFrame, errors: DataFrame) -> DataFrame:
    """Pages of scopes that were listed completely: an error of either class leaves its account
    and region without inventory, also where some pages had arrived before it."""
    failed = errors.where(error_class(F.col("code")).isNotNull()).select("account_id", "region")
    return pages.join(failed, ["account_id", "region"], "left_anti")


def hard_failures(errors: DataFrame) -> DataFrame:
    return errors.where(error_class(F.col("code")) == "hard")


def fails_softly(code: Column) -> Column:
    """Whether a failing fetch is only warned about; expired requests are not."""
    return code.isin(*[c for c in SOFT_DENIAL_CODES if c != "RequestExpired"])


def denial_hint(message: Column) -> Column:
    policy = F.contains(F.coalesce(message, F.lit("")), F.lit(POLICY_MARK))
    return F.when(policy, POLICY_HINT).otherwise(OTHER_HINT)


def _denials(log: DataFrame) -> DataFrame:
    return log.where(error_class(F.col("code")) == "soft")


def denial_summary(log: DataFrame) -> DataFrame:
    """Soft denials per code, with the total over all codes."""
    by_code = _denials(log).groupBy("code").agg(F.count(F.lit(1)).alias("denials"))
    # At most one row per soft code is left here.
    return by_code.withColumn("total", F.sum("denials").over(Window.partitionBy()))


def denial_samples(log: DataFrame, order: Sequence[str], limit: int = SAMPLES) -> DataFrame:
    """The first few soft denials with their reason."""
    return (
        _denials(log)
        .orderBy(*order)
        .limit(limit)
        .select("account_id", "region", "code", denial_hint(F.col("message")).alias("reason"))
    )


def count_by_metric(metrics: DataFrame) -> DataFrame:
    """Rows per metric name, by name; rows without a name do not count."""
    return (
        metrics.where("metric_name != ''")
        .groupBy("metric_name")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("metric_name")
    )


def run_totals(run_log: DataFrame) -> DataFrame:
    """Rows fetched and merged per table. Only positive fetches count, and names starting with
    an underscore are bookkeeping, not tables."""
    fetched = F.sum(F.when(F.col("rows_fetched") > 0, F.col("rows_fetched")).otherwise(0))
    return (
        run_log.groupBy("table_name")
        .agg(
            fetched.alias("rows_fetched"),
            F.sum(
                F.when(F.startswith("table_name", F.lit("_")), 0).otherwise(
                    F.coalesce("rows_merged", F.lit(0))
                )
            ).alias("rows_merged"),
            F.sum(F.col("failed").cast("long")).alias("failures"),
        )
    )


def result_count(df: DataFrame) -> DataFrame:
    """Number of rows and whether there is anything to write."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("row_count"), (n == 0).alias("is_empty"))


def merge_report(batch: DataFrame, table_names: Sequence[str], clients: int) -> DataFrame:
    """Rows merged into each table: those of the batch, once per client."""
    tables = F.explode(F.array(*[F.lit(t) for t in table_names]))
    counted = batch.agg((F.count(F.lit(1)) * clients).alias("rows_merged"))
    return counted.select(tables.alias("table_name"), "rows_merged")


def report_lines(df: DataFrame, section: str, name: Column, value: Column, detail: Column | None = None) -> DataFrame:
    """Summary rows in the shape of the run report."""
    detail = F.lit("") if detail is None else detail
    columns = {"section": F.lit(section), "name": name, "detail": detail, "value": value.cast("long")}
    return df.select(*[c.alias(n) for n, c in columns.items()])
