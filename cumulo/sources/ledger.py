"""Which landed files earlier jobs have consumed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulo.operators.shape import join_side
from cumulo.operators.upsert import append, ensure_table
from cumulo.schemas import LEDGER
from cumulo.session import stage
from cumulo.sources.tables import read_if_exists


def landed_files(
    spark: SparkSession, folder: str, accounts: Sequence[str] | None = None, regions: Sequence[str] | None = None
) -> DataFrame:
    """``path``, ``size`` and ``modified`` of the files below a folder, of these accounts and regions. No file
    is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    files = files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    for column, wanted in (("account_id", accounts), ("region", regions)):
        if wanted is not None:
            files = files.where(_directory(column).isin(*wanted))
    return files


def _directory(column: str) -> Column:
    return F.regexp_extract("path", f"/{column}=([^/]*)/", 1)


def unread(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that no entry of the ledger names with the same size and time: a file that changed is new."""
    return files.join(ledger, ["path", "size", "modified"], "left_anti")


class Ledger:
    """The stored ledger of one database and what the present job adds to it.

    A job notes its files once all their rows are merged. If it stops before, the next one reads them
    again, and merging them twice changes nothing.
    """

    def __init__(self, spark: SparkSession, database: str, provider: str = "parquet", warehouse: str | None = None):
        self.spark, self.name = spark, f"{database}.{LEDGER.name}"
        self.provider, self.warehouse = provider, warehouse
        self.taken: list[DataFrame] = []

    def take(self, folder: str, accounts: Sequence[str] | None, regions: Sequence[str] | None) -> list[str]:
        """Paths of the folder's unread files, to be noted later. The list is as long as the listing of those
        files that Spark itself keeps to read them."""
        stored = read_if_exists(self.spark, self.name, LEDGER.schema)
        found = stage(unread(landed_files(self.spark, folder, accounts, regions), join_side(stored)), "unread")
        self.taken.append(found)
        return [row["path"] for row in found.select("path").toLocalIterator()]

    def note(self, service: str, run_time: dt.datetime) -> None:
        database = self.name.rsplit(".", 1)[0]
        ensure_table(self.spark, database, LEDGER, provider=self.provider, warehouse=self.warehouse)
        for files in self.taken:
            entries = files.withColumns({"service_name": F.lit(service), "job_runtime_utc": F.lit(run_time)})
            append(entries, self.name, LEDGER)
        self.taken = []
