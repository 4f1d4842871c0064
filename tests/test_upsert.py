"""Deduplication, tables and upserts."""

import random

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from cumulo.operators import shape as S
from cumulo.operators import upsert as U
from cumulo.schemas import INVENTORY, Table, declared_schema

TABLE = Table(
    "t",
    keys=("client_id", "k"),
    partitions=("client_id", "month"),
    schema=declared_schema({"k": "string", "client_id": "string", "month": "string", "v": "string", "w": "string"}),
)
ROW = "k string, client_id string, month string, v string, w string"


@pytest.fixture
def batch(spark):
    return lambda *rows: spark.createDataFrame(list(rows), ROW)


@pytest.fixture
def table(spark, database):
    return U.ensure_table(spark, database, TABLE)


def stored(spark, name):
    return sorted((tuple(r) for r in spark.table(name).select(*TABLE.columns).collect()), key=repr)


def test_keep_last(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), (None, 1, "p"), (None, 2, "q"), ("b", None, "n"), ("b", 0, "m")], "k string, o int, v string")
    assert rows(S.keep_last(df, ["k"], ["o"]).select("k", "v")) == [("a", "y"), ("b", "m"), (None, "q")]


def test_keep_last_limits_each_key_before_the_shuffle(spark):
    df = spark.range(0, 1000, numPartitions=4).select((F.col("id") % 3).alias("k"), "id").toDF("k", "o")
    plan = S.keep_last(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_keep_one_is_the_same_on_every_run(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("a", None, "z")], "k string, n int, v string")
    assert rows(S.keep_one(df, ["k"])) == rows(S.keep_one(df.orderBy(F.desc("v")), ["k"])) == [("a", 2, None)]


def test_duplicate_count(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "k string")
    assert S.duplicate_count(df, ["k"]).first().duplicates == 2


def test_conform(spark, rows):
    df = spark.createDataFrame([("1", "extra")], "w string, x string")
    got = S.conform(df, TABLE.schema)
    assert got.columns == TABLE.columns
    assert rows(got) == [(None, None, None, None, "1")]


def test_ensure_table_twice(spark, database):
    name = U.ensure_table(spark, database, INVENTORY)
    assert U.ensure_table(spark, database, INVENTORY) == name
    assert set(spark.table(name).columns) == set(INVENTORY.columns)
    assert spark.table(name).schema["job_runtime_utc"].dataType.simpleString() == "timestamp"


def test_update_insert_and_full_row_replace(spark, table, batch):
    U.upsert(batch(("1", "c", "m1", "a", "x"), ("2", "c", "m1", "b", "y")), table, TABLE)
    U.upsert(batch(("1", "c", "m1", "z", "w")).drop("w"), table, TABLE)
    U.upsert(batch(("3", "c", "m1", "n", "n"), ("1", "d", "m1", "other", "x")), table, TABLE)
    assert stored(spark, table) == [
        ("1", "c", "m1", "z", None),
        ("1", "d", "m1", "other", "x"),
        ("2", "c", "m1", "b", "y"),
        ("3", "c", "m1", "n", "n"),
    ]


def test_a_row_moves_partition_and_the_emptied_one_goes(spark, table, batch):
    U.upsert(batch(("9", "c", "2023-12", "old", ""), ("8", "c", "2023-11", "stay", "")), table, TABLE)
    U.upsert(batch(("9", "c", "2024-02", "new", "")), table, TABLE)
    assert stored(spark, table) == [("8", "c", "2023-11", "stay", ""), ("9", "c", "2024-02", "new", "")]
    listed = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    assert listed == {"client_id=c/month=2023-11", "client_id=c/month=2024-02"}


def test_many_keys_are_not_broadcast(spark):
    """However small the files they are read from; Spark may still broadcast a short batch."""
    keys = [F.lit("c").alias("client_id"), F.lit("x" * 200).alias("v"), F.lit("m").alias("month"), F.lit("w").alias("w")]
    target = U.stage(spark.range(150_000).select(F.col("id").cast("string").alias("k"), *keys), "target")
    for batch, join in ((target, "SortMergeJoin"), (U.stage(target.limit(1000), "few"), "BroadcastHashJoin")):
        for how in ("left_semi", "left_anti"):
            matched = U._matches(target, batch, TABLE.keys, how)
            assert join in matched._jdf.queryExecution().executedPlan().toString()
            assert matched.count() == (batch.count() if how == "left_semi" else 150_000 - batch.count())


def test_null_keys_insert_again(spark, table, batch):
    for value in ("a", "b"):
        U.upsert(batch((None, "c", "m", value, ""), (None, "c", "m", value, "")), table, TABLE)
    assert stored(spark, table) == [(None, "c", "m", "a", ""), (None, "c", "m", "b", "")]


def test_null_and_blank_partition_values_keep_their_rows(spark, table, batch):
    U.upsert(batch(("1", None, "m", "a", ""), ("2", "", None, "b", "")), table, TABLE)
    U.upsert(batch(("3", None, "m", "c", ""), ("4", "c'x", "a/b=c", "d", "")), table, TABLE)
    U.upsert(batch(("4", "c'x", "m2", "e", "")), table, TABLE)
    assert stored(spark, table) == [
        ("1", None, "m", "a", ""),
        ("2", None, None, "b", ""),
        ("3", None, "m", "c", ""),
        ("4", "c'x", "m2", "e", ""),
    ]


def test_last_in_order_wins(spark, table, batch):
    df = batch(("1", "c", "m", "late", ""), ("1", "c", "m", "early", "")).withColumn("o", F.when(F.col("v") == "late", 2).otherwise(1))
    assert U.upsert(df, table, TABLE, order=["o"]).count() == 1
    assert stored(spark, table) == [("1", "c", "m", "late", "")]


def test_a_missing_key_column_is_null(spark, table, batch):
    df = batch(("1", "c", "m", "late", "2"), ("2", "c", "m", "early", "1")).drop("k")
    U.upsert(df, table, TABLE, order=["w"])
    assert stored(spark, table) == [(None, "c", "m", "late", "2")]


def test_an_interrupted_merge_is_completed_by_repeating_it(spark, table, batch):
    """Appended rows of a half-done merge match on the next try and are replaced."""
    U.upsert(batch(("1", "c", "m1", "old", "")), table, TABLE)
    again = batch(("1", "c", "m2", "new", ""), ("2", "c", "m2", "new", ""))
    U.append(again, table, TABLE)
    U.upsert(again, table, TABLE)
    assert stored(spark, table) == [("1", "c", "m2", "new", ""), ("2", "c", "m2", "new", "")]


class Killed(Exception):
    pass


@pytest.mark.parametrize("step", ["_write_apart", "_insert", "_point_partitions", "_located", "_delete"])
def test_a_merge_killed_between_steps_leaves_partitions_whole(spark, table, batch, monkeypatch, step):
    """Whichever step does not begin, a partition holds its old rows or its new ones, and repeating completes it."""
    old = [(k, "c", m, "old", "") for k, m in (("1", "m1"), ("2", "m1"), ("3", "m2"), ("4", "m3"), ("5", "m4"))]
    new = [("1", "c", "m1", "new", ""), ("3", "c", "m2", "new", ""), ("4", "c", "m1", "new", ""), ("6", "c", "m5", "new", "")]
    U.upsert(batch(*old), table, TABLE)
    calls, real = [], getattr(U, step)

    def stop(*args, **kwargs):
        calls.append(args)
        # The first look-up finds the table's folder; later ones come between two partitions.
        if step == "_located" and len(calls) < 3:
            return real(*args, **kwargs)
        raise Killed

    monkeypatch.setattr(U, step, stop)
    with pytest.raises(Killed):
        U.upsert(batch(*new), table, TABLE)
    monkeypatch.undo()
    before = {m: sorted(r for r in old if r[2] == m) for m in ("m1", "m2", "m3", "m4", "m5")}
    after = {m: sorted(r for r in new if r[2] == m) for m in before}
    after["m1"] = sorted([*after["m1"], old[1]])
    after["m4"] = before["m4"]
    for month in before:
        assert [r for r in stored(spark, table) if r[2] == month] in (before[month], after[month])
    U.upsert(batch(*new), table, TABLE)
    assert stored(spark, table) == sorted(r for rows in after.values() for r in rows)


def test_rewritten_partitions_are_written_once(spark, table, batch, monkeypatch):
    """No second copy of the merged rows, and no file of the old state is left."""
    from pathlib import Path

    U.upsert(batch(*[(str(i), "c", f"m{i % 3}", "old", "") for i in range(9)]), table, TABLE)
    staged = []
    real = U.stage
    monkeypatch.setattr(U, "stage", lambda df, label, *p: staged.append(label) or real(df, label, *p))
    for value in ("new", "newer"):
        U.upsert(batch(*[(str(i), "c", f"m{i % 3}", value, "") for i in range(0, 9, 2)]), table, TABLE)
        assert [r[3] for r in stored(spark, table)] == [value if i % 2 == 0 else "old" for i in range(9)]
    assert not [label for label in staged if label.startswith("merged")]
    root = Path(U._located(spark, table).removeprefix("file:"))
    files = {p for p in root.rglob("*.parquet")}
    named = {Path(f.removeprefix("file://").removeprefix("file:")) for f in spark.table(table).inputFiles()}
    assert {p.name for p in files} == {p.name for p in named}


def test_many_partitions_need_no_list(spark, table, monkeypatch):
    """20,000 partitions: nothing is collected and no text grows with them."""
    from pyspark.sql.classic.dataframe import DataFrame

    rows = spark.range(20_000).select(
        F.col("id").cast("string").alias("k"), F.lit("c").alias("client_id"), F.concat(F.lit("m"), "id").alias("month"), F.lit("v").alias("v"), F.lit("w").alias("w")
    )

    def refuse(*_):
        raise AssertionError("collected")

    monkeypatch.setattr(DataFrame, "collect", refuse)
    touched = U.touched_partitions(rows, rows, TABLE)
    assert touched.count == 20_000
    left = touched.restrict(rows)
    assert len(left._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    assert left.count() == 20_000 and touched.restrict(rows, "left_anti").count() == 0


def test_empty_batch(spark, table, batch):
    U.upsert(batch(("1", "c", "m", "a", "")), table, TABLE)
    assert U.upsert(batch().limit(0), table, TABLE).count() == 0
    assert stored(spark, table) == [("1", "c", "m", "a", "")]


def test_untouched_partitions_are_not_rewritten(spark, table, batch):
    U.upsert(batch(("1", "c", "m1", "a", ""), ("2", "c", "m2", "b", "")), table, TABLE)
    before = {f for f in spark.table(table).inputFiles() if "month=m1" in f}
    U.upsert(batch(("2", "c", "m2", "z", "")), table, TABLE)
    assert before and before <= set(spark.table(table).inputFiles())


def test_unpartitioned_table(spark, database, batch):
    plain = Table("plain", keys=("k",), partitions=(), schema=TABLE.schema)
    name = U.ensure_table(spark, database, plain)
    U.upsert(batch(("1", "c", "m", "a", "")), name, plain)
    U.upsert(batch(("1", "c", "m", "b", ""), ("2", "c", "m", "b", "")), name, plain)
    assert [r[3] for r in stored(spark, name)] == ["b", "b"]


def test_many_rows_against_a_model(spark, table):
    """Random upserts behave as a dictionary keyed by (client, k)."""
    rng = random.Random(7)
    model = {}
    for run in range(3):
        changes = {}
        for _ in range(60):
            key = (rng.choice("cd"), str(rng.randrange(40)))
            changes[key] = (f"m{rng.randrange(4)}", f"{run}-{rng.random():.6f}")
        model.update(changes)
        rows = [(k, c, m, v, "") for (c, k), (m, v) in changes.items()]
        U.upsert(spark.createDataFrame(rows, ROW), table, TABLE)
        assert stored(spark, table) == sorted(((k, c, m, v, "") for (c, k), (m, v) in model.items()), key=repr)


def test_replace_by_key(spark, rows):
    existing = spark.createDataFrame([("EC2", " AWS ", 1), ("EC2", "azure", 2), (None, "aws", 3)], "code string, provider string, n int")
    new = spark.createDataFrame([("EC2", "aws", 9)], existing.schema)
    got = U.replace_by_key(existing, new, {"code": F.col("code"), "provider": F.lower(F.trim("provider"))})
    assert rows(got) == [("EC2", "aws", 9), ("EC2", "azure", 2), (None, "aws", 3)]


def test_tenants(spark, rows):
    df = spark.createDataFrame([("x", "old")], "v string, client_id string")
    assert rows(S.for_clients(df, S.client_list("a", "b")).select("client_id")) == [("a",), ("b",)]
    assert S.client_list("a") == ["a"]


def test_native_merge_resolves_and_is_refused_by_parquet(spark, table, batch):
    """All names of the merge resolve; only the format's lack of row-level writes stops it."""
    with pytest.raises(UnsupportedOperationException, match="does not support MERGE INTO TABLE"):
        U._merge_rows(batch(("1", "c", "m", "a", "")), table, TABLE)
