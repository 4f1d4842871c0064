"""Every registered query against its SQL counterpart, on the smallest tables and on empty ones."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from gate.registry import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")

SMALL = Path(contract.SMOKE_DIR)
pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="no test tables")
# Products of rows and Python workers have no place in any plan.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas")


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("empty")
    for source in SMALL.glob("*.parquet"):
        spark.read.parquet(str(source)).limit(0).write.parquet(str(root / source.name))
    return root


def connection(folder):
    con = duckdb.connect()
    for source in folder.glob("*.parquet"):
        files = f"{source}/*.parquet" if source.is_dir() else source
        con.execute(f"CREATE VIEW {source.stem} AS SELECT * FROM read_parquet('{files}')")
    return con


def canonical(rows):
    return sorted((tuple(f"{v:.9g}" if isinstance(v, float) else v for v in r) for r in rows), key=repr)


def spark_rows(spark, name, folder):
    df = QUERIES[name](spark, str(folder))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]
    columns = sorted(df.columns)
    return columns, canonical(df.select(*[f"`{c}`" for c in columns]).collect())


def sql_rows(name, folder):
    relation = connection(folder).sql(ORACLES[name])
    columns = sorted(relation.columns)
    order = [relation.columns.index(c) for c in columns]
    return columns, canonical([tuple(r[i] for i in order) for r in relation.fetchall()])


@pytest.mark.parametrize("name", list(QUERIES))
def test_small_tables(spark, name):
    got = spark_rows(spark, name, SMALL)
    assert got == sql_rows(name, SMALL)
    assert got[1]


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables(spark, name, empty_dir):
    assert spark_rows(spark, name, empty_dir) == sql_rows(name, empty_dir)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
