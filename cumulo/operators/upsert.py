"""Upsert by business key into a partitioned catalog table.

Tables of a row-level format take a native merge. On plain Parquet only the partitions that hold
a matched row are rewritten (copy-on-write), and each of them is written once:

1. the batch is made unique by key and staged;
2. one scan of the target's key and partition columns, pruned at run time to the batch's (client,
   account) directories and bounded by the months its dates allow, finds the touched partitions,
   those with a matched row; they are a table of their own;
3. the touched partitions without their matched rows, plus their batch rows, are written to a new
   folder that no partition names yet;
4. batch rows of all other partitions are appended;
5. each touched partition is pointed to its new folder, or dropped if no rows are left in it;
6. the old folders are deleted.

A merge that stops between any two steps leaves every partition whole, either as it was or as it will be.
Repeating the merge of the same batch completes it: whatever it had already inserted now matches
and is replaced. What is restricted to partitions is joined with the table of touched ones, never with
a list in the query's text; the catalog is told of one partition at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cumulo.operators.shape import conform, join_side, keep_last, keep_one
from cumulo.schemas import Table
from cumulo.session import stage

ROW_LEVEL_PROVIDERS = ("iceberg", "delta")
# Rows with a NULL key part never match; they are spread over this many join buckets.
_NULL_KEY_SPREAD = 1024
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
# Lists of partitions up to this length are broadcast; beyond it they are joined like any table.
BROADCAST_PARTITIONS = 1_000_000
# Fixed value: the directory name that stands for NULL.
_NULL_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def create_database(spark: SparkSession, database: str, location: str) -> None:
    """Managed tables of the database live under ``location``."""
    path = location.replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)} LOCATION '{path}'")


def ensure_table(
    spark: SparkSession,
    database: str,
    table: Table,
    *,
    provider: str = "parquet",
    warehouse: str | None = None,
) -> str:
    """Create the table from its declaration unless it exists; returns its full name.

    With a row-level format the table is put at ``warehouse``/path suffix. Parquet tables stay
    managed by the catalog, so that dropping an emptied partition also drops its files.
    """
    name = f"{database}.{table.name}"
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in table.schema)
    ddl = f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING {provider}"
    if table.partitions:
        ddl += f" PARTITIONED BY ({', '.join(map(_quoted, table.partitions))})"
    if warehouse and provider in ROW_LEVEL_PROVIDERS:
        location = f"{warehouse.rstrip('/')}/{table.path_suffix}".replace("'", "\\'")
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)
    return name


def table_provider(spark: SparkSession, name: str) -> str:
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").where("col_name = 'Provider'")
    row = detail.select("data_type").first()
    return row[0].lower() if row else ""


def as_stored(df: DataFrame, table: Table) -> DataFrame:
    """The declared columns; blank partition values are NULL, as they read back from storage."""
    df = conform(df, table.schema)
    text = [f.name for f in table.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns(
        {c: F.nullif(F.col(c), F.lit("")) for c in table.partitions if c in text}
    )


def append(df: DataFrame, name: str, table: Table) -> None:
    """Insert rows as they are, with files sized per partition."""
    _insert(_balanced(as_stored(df, table), table), name)


def upsert(
    df: DataFrame,
    name: str,
    table: Table,
    *,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Upsert ``df`` and return the deduplicated batch that was written.

    ``order`` says which of several rows with the same key arrived last; without it the choice
    only has to be the same on every run. All non-key columns are replaced, also by NULLs.
    """
    batch = stage(unique_batch(df, table, order), f"batch-{table.name}")
    merge_batch(batch, name, table)
    return batch


def unique_batch(df: DataFrame, table: Table, order: Sequence[str] | None) -> DataFrame:
    if not order:
        return keep_one(as_stored(df, table), table.keys)
    absent = {k: F.lit(None).cast("string") for k in table.keys if k not in df.columns}
    return as_stored(keep_last(df.withColumns(absent), table.keys, order), table)


def merge_batch(batch: DataFrame, name: str, table: Table) -> None:
    """Merge a batch into the table. It must be unique by key and cheap to read repeatedly, that
    is, staged. An empty batch changes nothing."""
    if batch.isEmpty():
        return
    if table_provider(batch.sparkSession, name) in ROW_LEVEL_PROVIDERS:
        _merge_rows(batch, name, table)
    else:
        _rewrite_partitions(batch, name, table)


def replace_rows(
    target: DataFrame, new: DataFrame, batch: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Target rows whose key is not in the batch, followed by the new rows."""
    return _matches(target, batch, keys, "left_anti").unionByName(new)


def replace_by_key(
    existing: DataFrame, new: DataFrame, keys: dict[str, Column]
) -> DataFrame:
    """Delete the rows whose key expressions equal those of a new row, then insert the new rows."""
    match = [f"_match_{k}" for k in keys]
    expressions = dict(zip(match, keys.values()))
    replaced = new.withColumns(expressions).select(*match)
    kept = existing.withColumns(expressions).join(replaced, match, "left_anti")
    return kept.select(*existing.columns).unionByName(new)


def _balanced(df: DataFrame, table: Table) -> DataFrame:
    """Rows of a partition together, with large partitions split and small ones combined, and in the table's
    order within each file."""
    if table.partitions:
        df = df.hint("rebalance", *table.partitions)
    return df.sortWithinPartitions(*table.partitions, *table.cluster) if table.cluster else df


def _insert(df: DataFrame, name: str, overwrite: bool = False) -> None:
    """Insert by the stored column order, which puts the partition columns last; overwriting
    replaces only the partitions that receive rows."""
    spark = df.sparkSession
    stored = df.select(*spark.table(name).columns)
    # Inserting into a catalog table takes the mode from the session, not from writer options.
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        stored.write.insertInto(name, overwrite=overwrite)
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


def _merge_rows(batch: DataFrame, name: str, table: Table) -> None:
    target = name.split(".")[-1]
    match = " AND ".join(f"{_quoted(target)}.{_quoted(k)} = source.{_quoted(k)}" for k in table.keys)
    (
        batch.alias("source")
        .mergeInto(name, F.expr(match))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def _null_spread(columns: Sequence[str], keys: Sequence[str]) -> Column:
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    spread = 1 + F.pmod(F.xxhash64(*columns), F.lit(_NULL_KEY_SPREAD))
    return F.when(has_null, spread).otherwise(F.lit(0).cast("long"))


def _matches(target: DataFrame, batch: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    spread = target.withColumn("_spread", _null_spread(target.columns, keys))
    wanted = batch.select(*keys, F.lit(0).cast("long").alias("_spread"))
    return spread.join(join_side(wanted), [*keys, "_spread"], how).select(*target.columns)


def _literal(value: object) -> str:
    return "null" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


class Partitions:
    """Distinct partitions (or their leading directories) with the number of rows found in each, staged."""

    def __init__(self, rows: DataFrame, columns: Sequence[str], label: str):
        self.columns = list(columns)
        found = rows.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("found"))
        self.frame = stage(found, label)
        self.count = self.frame.count()

    def restrict(self, df: DataFrame, how: str = "left_semi") -> DataFrame:
        """Rows in these partitions, or with ``left_anti`` in no one of them.

        NULL values compare equal inside the struct. Broadcasting it lets a scan of the partitioned
        table skip directories at run time.
        """
        # The comparison tells the optimizer that the list is worth pruning by.
        listed = self.frame.where("found > 0").select(F.struct(*self.columns).alias("_listed"))
        if self.count <= BROADCAST_PARTITIONS:
            listed = F.broadcast(listed)
        return df.join(listed, F.struct(*self.columns) == F.col("_listed"), how)

    def __iter__(self) -> Iterator[Row]:
        return self.frame.select(*self.columns).toLocalIterator()


def _possible_months(batch: DataFrame, table: Table) -> Column:
    """The months in which rows with the batch's keys can be stored, as a plain partition bound."""
    if not table.dated_by:
        return F.lit(True)
    month = F.substring(table.dated_by, 1, 7)
    first, last = batch.agg(F.min(month), F.max(month)).first()
    if first is None:
        return F.lit(True)
    bound = F.col("year_month") >= first
    if table.same_month:
        bound = bound & (F.col("year_month") <= last)
    return bound | F.col("year_month").isNull()


def touched_partitions(batch: DataFrame, target: DataFrame, table: Table) -> Partitions:
    """Partitions of the target that hold a row with a key of the batch."""
    # Partition columns that belong to the key confine the matches to the batch's directories.
    fixed = [c for c in table.partitions if c in table.keys]
    nearby = target.where(_possible_months(batch, table))
    if fixed:
        nearby = Partitions(batch, fixed, f"directories-{table.name}").restrict(nearby)
    columns = list(dict.fromkeys([*table.keys, *table.partitions]))
    matched = _matches(nearby.select(*columns), batch, table.keys, "left_semi")
    return Partitions(matched, table.partitions, f"touched-{table.name}")


def remove_keys(keys: DataFrame, name: str, table: Table) -> None:
    """Delete the stored rows with these keys. ``keys`` must be staged; on Parquet the partitions they lie in
    are written once without them, and those left without rows are dropped."""
    spark = keys.sparkSession
    if table_provider(spark, name) in ROW_LEVEL_PROVIDERS:
        target = name.split(".")[-1]
        match = " AND ".join(f"{_quoted(target)}.{_quoted(k)} = source.{_quoted(k)}" for k in table.keys)
        keys.select(*table.keys).alias("source").mergeInto(name, F.expr(match)).whenMatched().delete().merge()
        return
    spark.catalog.refreshTable(name)
    target = spark.table(name)
    keys = as_stored(keys, table)
    touched = touched_partitions(keys, target, table)
    if touched.count:
        kept = _matches(touched.restrict(target), keys, table.keys, "left_anti")
        folder = _write_apart(kept, name, table)
        _delete(spark, _point_partitions(spark, name, table, touched, folder))


def _rewrite_partitions(batch: DataFrame, name: str, table: Table) -> None:
    spark = batch.sparkSession
    spark.catalog.refreshTable(name)
    target = spark.table(name)
    if not table.partitions:
        folder = _write_apart(replace_rows(target, batch, batch, table.keys), name, table)
        _point_table(spark, name, folder)
        return
    touched = touched_partitions(batch, target, table)
    if not touched.count:
        _insert(_balanced(batch, table), name)
        return
    merged = replace_rows(touched.restrict(target), touched.restrict(batch), batch, table.keys)
    folder = _write_apart(merged, name, table)
    _insert(_balanced(touched.restrict(batch, "left_anti"), table), name)
    old = _point_partitions(spark, name, table, touched, folder)
    _delete(spark, old)


# ---- folders and catalog entries -------------------------------------------------------------


def _located(spark: SparkSession, name: str, spec: str = "") -> str:
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)} {spec}")
    return detail.where("col_name = 'Location'").select("data_type").first()[0]


def _write_apart(rows: DataFrame, name: str, table: Table) -> str:
    """Write rows to a new folder: hidden inside the table's, or beside it if the table itself will move."""
    root = _located(rows.sparkSession, name).rstrip("/")
    if table.partitions:
        folder = f"{root}/_rewritten-{uuid.uuid4().hex}"
    else:
        folder = f"{root.rsplit('/', 1)[0]}/{table.name}-{uuid.uuid4().hex}"
    _balanced(rows, table).write.partitionBy(*table.partitions).parquet(folder)
    return folder


def _point_table(spark: SparkSession, name: str, folder: str) -> None:
    old = _located(spark, name)
    spark.sql(f"ALTER TABLE {_quoted(name)} SET LOCATION {_literal(folder)}")
    spark.catalog.refreshTable(name)
    _delete(spark, [old])


def _point_partitions(
    spark: SparkSession, name: str, table: Table, partitions: Partitions, folder: str
) -> list[str]:
    """Point each partition to its part of the folder, or drop it if it has none; gives the old folders."""
    written = _partition_folders(spark, folder, table.partitions)
    old = []
    for partition in partitions:
        spec = _partition_spec(partition, table.partitions)
        part = written.get(tuple(None if v is None else str(v) for v in partition))
        if part is None:
            spark.sql(f"ALTER TABLE {_quoted(name)} DROP IF EXISTS {spec}")
        else:
            old.append(_located(spark, name, spec))
            spark.sql(f"ALTER TABLE {_quoted(name)} {spec} SET LOCATION {_literal(part)}")
    spark.catalog.refreshTable(name)
    return old


def _partition_spec(partition: Row, columns: Sequence[str]) -> str:
    values = ", ".join(f"{_quoted(c)} = {_literal(partition[c])}" for c in columns)
    return f"PARTITION ({values})"


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _partition_folders(spark: SparkSession, folder: str, columns: Sequence[str]) -> dict[tuple, str]:
    """Folder by partition values, as text, of the partitions written below ``folder``."""
    system, at = _file_system(spark, "/".join([folder, *(f"{c}=*" for c in columns)]))
    found = {}
    for status in system.globStatus(at) or []:
        path = status.getPath().toString()
        values = [unquote(part.split("=", 1)[1]) for part in path.split("/")[-len(columns) :]]
        found[tuple(None if v == _NULL_DIRECTORY else v for v in values)] = path
    return found


def _delete(spark: SparkSession, folders: Sequence[str]) -> None:
    for folder in folders:
        system, at = _file_system(spark, folder)
        system.delete(at, True)
