"""Random inputs against plain Python."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from cumulo.functions.text import account_ids, resolve_regions
from cumulo.functions.time import bucket_seconds
from cumulo.operators.rollup import rollup_sub_daily
from cumulo.operators.shape import keep_last
from cumulo.schemas import MetricSpec

UTC = dt.timezone.utc


def slow_bucket(ts, period, interval):
    midnight = ts.replace(hour=0, minute=0, second=0, microsecond=0)
    if (interval or "").strip().upper() in {"P1D", "PT1D"} or (period or 0) >= 86400:
        return midnight
    if not period or period < 0:
        period = 3600
    if period < 60:
        return ts.replace(second=0, microsecond=0)
    if period % 60:
        return ts.replace(microsecond=0)
    minutes = (ts - midnight) // dt.timedelta(minutes=1)
    return midnight + dt.timedelta(minutes=minutes - minutes % (period // 60))


def test_buckets(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        ts = dt.datetime(1969, 1, 1, tzinfo=UTC) + dt.timedelta(microseconds=rng.randrange(2 * 10**15))
        period = rng.choice([None, -5, 0, 1, 59, 60, 61, 300, 420, 660, 3600, 5400, 7200, 86399, 86400, 10**6, rng.randrange(90000)])
        rows.append((i, ts, period, rng.choice([None, "", "PT5M", "p1d ", "PT1D", "P1W"])))
    df = spark.createDataFrame(rows, "i int, ts timestamp, p int, v string")
    start = bucket_seconds(F.col("ts"), F.col("p"), F.col("v"))
    got = {r.i: r.s for r in df.select("i", start.alias("s")).collect()}
    assert got == {i: int(slow_bucket(ts, p, v).timestamp()) for i, ts, p, v in rows}


def test_keep_last_of_random_rows(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(4), i, str(i)) for i in rng.sample(range(1000), 400)]
    last = {}
    for k, g, i, v in sorted(rows, key=lambda r: r[2]):
        last[k, g] = v
    df = spark.createDataFrame(rows, "k string, g int, i int, v string").repartition(7)
    got = {(r.k, r.g): r.v for r in keep_last(df, ["k", "g"], ["i"]).collect()}
    assert got == last


def test_rollup_of_random_points(spark):
    """Percentile per hour is the value of rank ceil(0.9 n); then the mean over hours."""
    rng = random.Random(11)
    rows, hours = [], {}
    for _ in range(2000):
        resource, day, hour = rng.choice("xyz"), rng.randrange(1, 4), rng.randrange(24)
        value = round(rng.random() * 100, 2)
        date = f"2024-01-{day:02d}"
        rows.append(("c", "a", "S", resource, "M", date, f"{date}T{hour:02d}:{rng.randrange(60):02d}:00Z", "average", value, "n", "r"))
        hours.setdefault((resource, date), {}).setdefault(hour, []).append(value)
    expected = {}
    for key, by_hour in hours.items():
        ranked = [sorted(v)[-(-9 * len(v) // 10) - 1] for v in by_hour.values()]
        expected[key] = round(sum(ranked) / len(ranked), 9)
    df = spark.createDataFrame(
        rows,
        "client_id string, account_id string, service_name string, resource_id string, metric_name string, metric_date string, "
        "date string, aggregation_type string, metric_value double, resource_name string, region string",
    ).repartition(5)
    daily = rollup_sub_daily(df, [MetricSpec("M", "N", "u", "Average", 300, "PT5M")])
    got = {(r.resource_id, r.metric_date): round(r.metric_value, 9) for r in daily.collect()}
    assert got == expected


def test_ids_and_regions_of_random_texts(spark):
    rng = random.Random(13)
    pieces = ["111122223333", "444455556666", "12345", ",", ";", " ", "x", "_", "é", "-", "1111222233334", "ALL", "\n"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(8))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select(
        "i", account_ids(F.col("t")).alias("ids"), resolve_regions(F.col("t"), ["r2", "r1"]).alias("regions")
    ).collect()
    for row in rows:
        text = texts[row.i]
        assert row.ids == list(dict.fromkeys(re.findall(r"\b\d{12}\b", text)))
        items = [p.strip() for p in text.split(",") if p.strip()]
        wanted = items if items and items not in (["ALL"],) else ["r1", "r2"]
        assert row.regions == wanted
