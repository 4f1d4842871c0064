"""The pipeline stage by stage, and the registered queries."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from cumulo.llm import decontamination, pii, simhash
from cumulo.llm.queries import KEY, ORACLES, QUERIES

SMALL = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="no test tables")


def test_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]
    docs = whole = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = []
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, str(SMALL)).cache()
        assert docs.columns == whole.columns
        seen.append({r.doc_id: r.text for r in docs.collect()})
    first, second, third, fourth = seen
    kept = spark.createDataFrame(list(first.items()), "doc_id long, text string")
    low = {r.doc_id for r in simhash.near_duplicates(kept).collect() if r.doc_id == r.component_id}
    assert second.keys() == low
    finder = decontamination.Finder(next(decontamination._blocks(spark.read.parquet(f"{SMALL}/benchmark.parquet")))[0], decontamination.RATE)
    assert third.keys() == {d for d, t in second.items() if not list(finder.find(t))}
    assert fourth == {d: t and pii.replace(t, KEY)[0] for d, t in third.items()}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(SMALL)).collect()
    assert {r.doc_id for r in pieces} == fourth.keys()
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    clean = [d for d, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert sum(d in first for d in clean) >= 0.97 * len(clean)


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_passages_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    name = next(n for n in ORACLES if n.startswith("op5_"))
    relation = con.sql(ORACLES[name])
    got = QUERIES[name](spark, str(SMALL)).select(*relation.columns).collect()
    assert sorted(tuple(r) for r in got) == sorted(relation.fetchall())


def test_copies_are_judged_by_row(spark):
    """Rows that repeat an id or have none, null texts, and columns named like the numbering."""
    text = "one two three four five six"
    rows = [(3, text, 1), (None, text, 2), (3, text, 3), (2, text, 4), (None, None, 5), (None, "", 6), (9, "other words altogether here", 7), (3, "unlike the rest of them", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    got = corpus_pipeline.deduplicate(spark, docs, "")
    assert got.columns == docs.columns
    kept = {r["row"] for r in got.collect()}
    assert kept - {5, 6} == {4, 7, 8} and len(kept & {5, 6}) == 1
    assert corpus_pipeline.deduplicate(spark, docs.limit(0), "").count() == 0


def write_tables(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")


def test_whole_run_on_odd_tables(spark, tmp_path):
    """Null ids, null and repeated rows and further columns go through all stages; an empty table gives no rows."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 60")
    odd = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).union(docs.limit(2))
    odd = odd.union(docs.limit(1).withColumn("text", F.lit(None).cast("string"))).withColumn("sequence_id", F.lit(1)).withColumn("kept", F.lit("x"))
    whole = docs.withColumn("sequence_id", F.lit(2)).withColumn("kept", F.lit("y")).union(odd)
    write_tables(spark, tmp_path / "odd", whole)
    pieces = corpus_pipeline.run(spark, str(tmp_path / "odd"))
    assert len(set(pieces.columns)) == len(pieces.columns)
    found = pieces.collect()
    ids = {r["doc_id"] for r in found}
    assert len(ids) > 10 and ids <= {r["doc_id"] for r in whole.collect()}
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in found)
    ends = {}
    for sequence, offset, length in places:
        assert ends.get(sequence, 0) == offset
        ends[sequence] = offset + length
    write_tables(spark, tmp_path / "empty", whole.limit(0))
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0


def test_pseudonym_key_is_a_setting(spark):
    docs = spark.createDataFrame([(1, "call +49 30 12345678 or write to jane.doe@example.org")], "doc_id long, text string")
    before = corpus_pipeline.pseudonymize(spark, docs, "").first()["text"]
    spark.conf.set(corpus_pipeline.KEY_SETTING, "another key")
    try:
        after = corpus_pipeline.pseudonymize(spark, docs, "").first()["text"]
    finally:
        spark.conf.unset(corpus_pipeline.KEY_SETTING)
    assert len({docs.first()["text"], before, after}) == 3
