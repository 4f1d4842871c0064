"""Exports of fetched rows: line-delimited JSON and CSV, one directory per service, region and table, and
one nested JSON document per service."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cumulo.functions.text import safe_name

EXPORT_KEYS = ("service", "region")
# The third level, for rows of several tables in one tree.
TABLE_KEY = "table_name"
# A nested document is one value: bytes of its rows up to which one is written.
DOCUMENT_BYTES = 1 << 29
# A quote inside a field is doubled. NULL and '' both end up as an empty field, read as NULL.
_CSV = {"header": "true", "quote": '"', "escape": '"', "nullValue": ""}


def with_export_keys(df: DataFrame, service: str, several_accounts: bool, table: str | None = None) -> DataFrame:
    """``service`` and the region key: ``account@region`` when several accounts run; with a table, its name."""
    key = F.concat_ws("@", "account_id", "region") if several_accounts else F.col("region")
    named = {} if table is None else {TABLE_KEY: F.lit(table)}
    return df.withColumns({"service": F.lit(service), "region": key} | named)


def _levels(columns) -> tuple[str, ...]:
    return EXPORT_KEYS + ((TABLE_KEY,) if TABLE_KEY in columns else ())


def _export(df: DataFrame, path: str, form: str, options: dict[str, str]) -> None:
    """Rows that name their table go to a tree that other tables share: only the directories that receive
    rows are replaced. Others need a path of their own."""
    levels = _levels(df.columns)
    writer = df.hint("rebalance", *levels).write.partitionBy(*levels).options(**options).format(form)
    if TABLE_KEY in levels:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def export_json(df: DataFrame, path: str) -> None:
    """The region key is kept as it is, service and table become safe names."""
    safe = [k for k in _levels(df.columns) if k != "region"]
    _export(df.withColumns({k: safe_name(F.col(k)) for k in safe}), path, "json", {})


def export_csv(df: DataFrame, path: str) -> None:
    """All keys become safe names, as parts of a file name."""
    _export(df.withColumns({k: safe_name(F.col(k)) for k in _levels(df.columns)}), path, "csv", _CSV)


def _json_text(text: Column) -> Column:
    """A JSON string of the text."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def nested_documents(tables: Mapping[str, DataFrame], most_bytes: int = DOCUMENT_BYTES) -> DataFrame:
    """``service`` and ``document``: the rows of all tables as ``{region: {table: [row, …]}}``.

    Rows have ``service`` and ``region`` (see :func:`with_export_keys`); the other columns are the row, in
    order, NULLs included. Rows are ordered by their text. A service is one value, so one whose
    rows exceed ``most_bytes`` is an error: the line-delimited exports have no such bound.
    """
    rows = None
    for name, df in tables.items():
        own = F.to_json(F.struct(*[c for c in df.columns if c not in (*EXPORT_KEYS, TABLE_KEY)]), {"ignoreNullFields": "false"})
        part = df.select(*EXPORT_KEYS, F.lit(name).alias(TABLE_KEY), own.alias("row"))
        rows = part if rows is None else rows.unionByName(part)
    sizes = rows.groupBy("service").agg(F.sum(F.octet_length("row") + 1).alias("bytes"))
    large = sizes.where(F.col("bytes") > most_bytes).limit(1).collect()
    if large:
        raise ValueError(f"{large[0]['service']}: {large[0]['bytes']} bytes of rows do not fit in one document")

    def level(df: DataFrame, keys: tuple[str, ...], key: str, body: str) -> DataFrame:
        """Objects by ``keys`` with a member per ``key``."""
        members = F.array_sort(F.collect_list(F.struct(key, body)))
        texts = F.transform(members, lambda m: F.concat(_json_text(m[key]), F.lit(":"), m[body]))
        return df.groupBy(*keys).agg(F.concat(F.lit("{"), F.array_join(texts, ","), F.lit("}")).alias("document"))

    listed = F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list("row")), ","), F.lit("]"))
    by_table = rows.groupBy(*EXPORT_KEYS, TABLE_KEY).agg(listed.alias("document"))
    by_region = level(by_table, EXPORT_KEYS, TABLE_KEY, "document")
    return level(by_region, EXPORT_KEYS[:1], "region", "document")


def export_documents(tables: Mapping[str, DataFrame], path: str, most_bytes: int = DOCUMENT_BYTES) -> None:
    """One JSON file per service, in a directory of its name."""
    documents = nested_documents(tables, most_bytes).withColumn("service", safe_name(F.col("service")))
    documents.hint("rebalance", "service").write.partitionBy("service").text(path)


def read_documents(spark: SparkSession, path: str, row: T.StructType) -> DataFrame:
    """Rows of exported documents: ``service``, ``region``, ``table_name`` and the columns of ``row``."""
    shape = T.MapType(T.StringType(), T.MapType(T.StringType(), T.ArrayType(row)))
    # Service names are safe, so the directory has them as they are; without any there is nothing to infer.
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    service = F.regexp_extract("_metadata.file_path", "/service=([^/]*)/", 1).alias("service")
    regions = files.select(service, F.from_json("value", shape).alias("document"))
    regions = regions.select("service", F.explode("document").alias("region", "tables"))
    rows = regions.select(*EXPORT_KEYS, F.explode("tables").alias(TABLE_KEY, "rows"))
    return rows.select(*EXPORT_KEYS, TABLE_KEY, F.explode("rows").alias("row")).select(*EXPORT_KEYS, TABLE_KEY, "row.*")


def read_json_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path).select(*schema.fieldNames())


def read_csv_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    files = _data_first(schema)
    return spark.read.schema(files).options(multiLine="true", **_CSV).csv(path).select(
        *schema.fieldNames()
    )


def _data_first(schema: T.StructType) -> T.StructType:
    """CSV columns are positional: the file's columns, then the directory's."""
    levels = _levels(schema.fieldNames())
    data = [f for f in schema if f.name not in levels]
    return T.StructType(data + [schema[k] for k in levels])
