import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cumulo.session import configure

    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    )
    session = configure(builder.getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def run_time():
    return dt.datetime(2024, 2, 1, 6, 30, tzinfo=dt.timezone.utc)


@pytest.fixture
def database(spark, tmp_path):
    from cumulo.operators.upsert import create_database

    name = "db_" + tmp_path.name.replace("-", "_")
    create_database(spark, name, str(tmp_path / "warehouse"))
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
