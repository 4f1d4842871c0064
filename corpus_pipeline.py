"""The corpus pipeline: reject, de-duplicate, decontaminate, pseudonymise, pack.

Each stage takes what its predecessor kept, written as Parquet and read again, so a stage starts from
files that survive the loss of executors. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cumulo.llm import decontamination, packing, pii, quality, simhash
from cumulo.llm.common import prepare, stage
from cumulo.llm.queries import KEY

# The setting that holds the secret of the pseudonyms. Without it the key of the checks is used, which is public.
KEY_SETTING = "spark.cumulo.pseudonymKey"

# The stages fit models and run hashes that SQL does not have; tests hold them against plain versions.
ORACLE_SQL = None


def reject(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model keeps."""
    labels = prepare(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return quality.score(docs, labels).where("kept").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: texts whose fingerprints link, directly or through others. The
    row with the smallest id stays, rows without an id come last.

    Rows are numbered in a written copy, so rows that repeat an id or have none are judged each."""
    prepare(spark)
    row = next(n for n in ("row", *(f"row_{i}" for i in range(len(docs.columns) + 1))) if n not in docs.columns)
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = simhash.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"))
    groups = found.select(F.col("doc_id").alias(row), F.col("component_id").alias("group")).join(rows.select(row, "doc_id"), row)
    first = groups.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row)).alias("kept"))
    copies = groups.join(first, "group").where(F.col(row) != F.col(f"kept.{row}")).select(row)
    return rows.join(copies, row, "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontamination.without_leaks(docs, prepare(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonymize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data. Texts keep their length."""
    key = prepare(spark).conf.get(KEY_SETTING, None)
    return pii.pseudonymize(docs, key.encode() if key else KEY).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    prepare(spark)
    pieces = packing.tokenize(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("quality", reject),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("personal_data", pseudonymize),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
