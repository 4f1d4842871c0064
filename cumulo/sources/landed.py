"""Landed JSON: inventory pages and metric result blocks, one document per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cumulo.schemas import RESULT_DOC

# Instances arrive as text: the stored raw document then keeps fields no schema names.
_PAGE = T.StructType(
    [
        T.StructField(
            "Reservations",
            T.ArrayType(T.StructType([T.StructField("Instances", T.ArrayType(T.StringType()))])),
        ),
        T.StructField("account_id", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)
_RESULT = T.StructType(
    RESULT_DOC.fields
    + [T.StructField("account_id", T.StringType()), T.StructField("region", T.StringType())]
)


_ERROR = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("service_name", "account_id", "region", "code", "message")
    ]
)
# Order of arrival: when the file was landed, then its place among files of one time. Blocks and lines
# of a file follow each other however it is split.
ARRIVAL = ("landed_at", "landed_file", "landed_block", "landed_line")
_CORRUPT = "_corrupt_record"


def _scoped(
    df: DataFrame,
    accounts: Sequence[str] | None,
    regions: Sequence[str] | None,
    run: str | None,
) -> DataFrame:
    if accounts is not None:
        df = df.where(F.col("account_id").isin(*accounts) if accounts else F.lit(False))
    if regions is not None:
        df = df.where(F.col("region").isin(*regions) if regions else F.lit(False))
    return df if run is None else df.where(F.col("run") == run)


# Besides control characters, those that a partition's directory name has as %XX.
_ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def run_folder(path: str, run: str) -> str:
    name = "".join(f"%{ord(c):02X}" if c < " " or c in _ESCAPED else c for c in run)
    return f"{path.rstrip('/')}/run={name}"


def _read(
    spark: SparkSession,
    schema: T.StructType,
    path: str,
    accounts: Sequence[str] | None,
    regions: Sequence[str] | None,
    run: str | None,
    files: Sequence[str] | None = None,
) -> DataFrame:
    """A run that matches no directory is an error; ``files`` names the only files to read."""
    text = T.StringType()
    extra = [T.StructField(_CORRUPT, text)] + ([] if run is None else [T.StructField("run", text)])
    reader = spark.read.schema(T.StructType(schema.fields + extra)).option("basePath", path)
    if files is not None and not files:
        # Nothing to read still has the columns of what could be read.
        return _read(spark, schema, path, (), (), run)
    df = reader.json(list(files) if files is not None else path if run is None else run_folder(path, run))
    return _scoped(df, accounts, regions, run).select(
        *[f.name for f in schema],
        F.col(_CORRUPT).isNotNull().alias("malformed"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("_metadata.file_path").alias("landed_file"),
        F.col("_metadata.file_block_start").alias("landed_block"),
        F.monotonically_increasing_id().alias("landed_line"),
    )


def read_inventory_pages(
    spark: SparkSession,
    path: str,
    accounts: Sequence[str] | None = None,
    regions: Sequence[str] | None = None,
    run: str | None = None,
    files: Sequence[str] | None = None,
) -> DataFrame:
    """Pages under ``path/[run=…/]account_id=…/region=…``; run and scope prune directories.

    A document that does not parse is a row with ``malformed`` set and without content.
    """
    return _read(spark, _PAGE, path, accounts, regions, run, files)


def read_metric_results(
    spark: SparkSession,
    path: str,
    accounts: Sequence[str] | None = None,
    regions: Sequence[str] | None = None,
    run: str | None = None,
    files: Sequence[str] | None = None,
) -> DataFrame:
    """Result blocks under ``path/[run=…/]account_id=…/region=…``: ``Id``, ``Timestamps``, ``Values``.

    Further pages of a result are simply further rows; malformed ones are marked as in pages.
    """
    return _read(spark, _RESULT, path, accounts, regions, run, files)


def read_error_log(
    spark: SparkSession,
    path: str,
    accounts: Sequence[str] | None = None,
    regions: Sequence[str] | None = None,
    run: str | None = None,
) -> DataFrame:
    """Errors met while landing: service, account, region, code and message, of one run if named."""
    schema = _ERROR if run is None else T.StructType([*_ERROR.fields, T.StructField("run", T.StringType())])
    return _scoped(spark.read.schema(schema).json(path), accounts, regions, run).select(*_ERROR.fieldNames())
