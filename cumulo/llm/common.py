"""Shared pieces: reading whole texts in tasks, numbering rows, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cumulo.session import configure, stage

__all__ = ["arrow_batches", "connected", "numbered", "prepare", "stage", "texts_of", "words_of"]

# Rows and bytes that a task hands to Python at a time; whole texts can be long.
BATCH_ROWS = 1000
BATCH_BYTES = 64 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """The session with the settings the operators rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return configure(spark)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The column's texts as UTF-8 bytes; null stays None."""
    return batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()


def words_of(text: bytes | None) -> list[bytes]:
    """Maximal runs outside the six ASCII blanks. ``bytes.split`` cuts at exactly those."""
    return text.split() if text else []


def arrow_batches(schema: pa.Schema, rows: Callable[[pa.RecordBatch], Iterator[tuple]], size: int = 4096):
    """A ``mapInArrow`` function from one that yields row tuples; output goes in bounded batches."""

    def run(batches):
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*held)) if held else [()] * len(schema)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
            )

        for incoming in batches:
            for row in rows(incoming):
                held.append(row)
                if len(held) >= size:
                    yield batch()
                    held.clear()
        if held:
            yield batch()

    return run


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Each name, with a number behind it if the frame has a column of that name."""
    taken = set(df.columns)
    return [next(n for n in (name, *(f"{name}{i}" for i in range(len(taken) + 1))) if n not in taken) for name in names]


def numbered(df: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Number the rows of each key from 0 without gaps; also gives each key's count as ``n``.

    The rows are written once, so that their task and place are fixed; each task's rows of a key
    are numbered apart and shifted by the count in earlier tasks. A key that holds most rows is
    therefore never in one task. Keys must not be null; a column called ``name`` is replaced.
    """
    task, at, count, start, rank = free_names(df, "_task", "_place", "_n", "_start", "_rank")
    rows = stage(
        df.withColumn(task, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id()), f"numbered-{name}"
    )
    counts = rows.groupBy(*keys, task).agg(F.count("*").alias(count))
    earlier = Window.partitionBy(*keys).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, task, F.coalesce(F.sum(count).over(earlier), F.lit(0)).alias(start))
    inside = Window.partitionBy(*keys, task).orderBy(at)
    out = (
        rows.withColumn(rank, F.row_number().over(inside) - 1)
        .join(starts, [*keys, task])
        .withColumn(name, (F.col(start) + F.col(rank)).cast("long"))
        .drop(task, at, rank, start)
    )
    return out, rows.groupBy(*keys).agg(F.count("*").alias("n"))


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of ``a``-``b`` links.

    Alternates two steps until the links are stars: every node hands its larger neighbours to its
    smallest neighbour, then its smaller ones. Each round is a grouped minimum and a join on the
    node, so a node with very many links is reduced before the shuffle and split by the skew join.
    Rounds are written to the shared folder, which keeps the lineage short.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links, last = stage(links, "links"), None
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        links = stage(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "links")
        state = tuple(links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == last:
            break
        last = state
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
