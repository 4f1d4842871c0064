"""Reply trees and chat formatting against plain walks and exact round trips."""

import hashlib
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cumulo.llm import chats
from cumulo.llm.queries import ORACLES, QUERIES

SMALL = Path("/root/testdata/sf0.001")
TREE = "tree_id long, node_id long, parent_id long, role string, text string, score double"
CONTROLS = ["<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[END]"]


def odd_texts(n, seed=2):
    draw = random.Random(seed)
    bits = [*CONTROLS, "<", "[", "\\", "\\\\", "/s>", "s>", "INST]", "a", "é", "日", "\n", " ", "<<", "[[", "]", "\x00", "$1"]
    return ["".join(draw.choice(bits) for _ in range(draw.randrange(12))) for _ in range(n)]


def test_escape_round_trip(spark):
    texts = odd_texts(3000)
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chats.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", chats.unescape(F.col("e")).alias("u")).collect():
        assert r["u"] == r["t"]
        assert not any(c in r["e"] for c in CONTROLS)
        if not re.search(r"[<\[]\\*(/?s>|/?(SYS|INST|ROLE)\]|END\])", r["t"]):
            assert r["e"] == r["t"]


def plain_paths(rows, most):
    """Branches per tree by walking up from every leaf: (score, leaf, nodes from the root)."""
    trees = {}
    for tree, node, parent, role, text, score in rows:
        if node is None:
            continue
        key = (parent is not None, parent or 0, role or "", text or "", score if score and score == score else 0.0)
        own = trees.setdefault(tree, {})
        own[node] = min(own.get(node, key), key)
    out = {}
    for tree, own in trees.items():
        parents = {k[1] for k in own.values() if k[0]}
        found = []
        for leaf in own.keys() - parents:
            path, at = [], leaf
            while at is not None and at in own and at not in path:
                path.append(at)
                at = own[at][1] if own[at][0] else None
            if at in path:
                continue
            found.append((-sum(own[n][4] for n in path) / len(path), leaf, path[::-1]))
        for i, (score, leaf, path) in enumerate(sorted(found)[:most]):
            out[tree, i + 1] = (leaf, [(own[n][2], own[n][3]) for n in path])
    return out


def check(df, rows, most):
    want = plain_paths(rows, most)
    found = df.withColumn("turns", chats.read_turns(F.col("formatted"))).withColumn(
        "masked", chats.read_masked(F.col("formatted"), F.col("loss"))
    )
    got = found.collect()
    assert len(got) == len(want)
    for r in got:
        leaf, turns = want[r["tree_id"], r["branch"]]
        assert r["leaf_id"] == leaf and r["n_turns"] == len(turns)
        assert [(t["role"], t["text"]) for t in r["turns"]] == turns
        assert r["masked"] == "".join(t for role, t in turns if role == "assistant")
        spans = [r["formatted"][s["start"] : s["stop"]] for s in r["loss"]]
        assert len(spans) == sum(role == "assistant" for role, _ in turns)


@pytest.mark.parametrize("most", [1, 3])
def test_trees_against_walks(spark, most):
    draw = random.Random(most)
    texts, roles = odd_texts(500, 5), ["user", "assistant", "system", "tool", "[INST]", "User", "", None]
    rows = []
    for tree in (0, 1, 2, None):
        for node in range(60):
            parent = draw.choice([None, node - 1, draw.randrange(node)]) if node else None
            # Scores are sums of powers of two, so that no order of adding changes them.
            rows.append((tree, node, parent, draw.choice(roles), draw.choice(texts), draw.choice([None, float("nan"), 0.5, 1.0, -2.0])))
    rows += [(5, 1, 2, "user", "a", 1.0), (5, 2, 1, "user", "b", 1.0), (5, 3, 2, "user", "below a circle", 9.0)]
    rows += [(6, 1, 77, "user", "orphan", 1.0), (6, None, 1, "user", "no id", 1.0), (6, 2, 1, "assistant", None, None)]
    rows += [(6, 2, 1, "assistant", None, None), (6, 2, 1, "assistant", "twice", None), (7, 4, 4, "user", "own parent", 0.0)]
    df = spark.createDataFrame(rows, TREE).withColumns({"place": F.lit(1), "tree": F.lit("x"), "formatted": F.lit(2)})
    check(chats.conversations(df.repartition(5), most), rows, most)


def test_long_chain_takes_few_rounds(spark):
    rows = [(1, i, i - 1 if i else None, ("user", "assistant")[i % 2], f"t{i}", 1.0) for i in range(1000)]
    df = spark.createDataFrame(rows, TREE)
    nodes = df.select(F.struct("tree_id").alias("tree"), F.col("node_id").alias("node"), F.col("parent_id").alias("parent"), "score")
    jumps, reach = chats.pointers(nodes)
    assert len(jumps) == 10 and reach.agg(F.max("length")).first()[0] == 1000
    check(chats.conversations(df), rows, 1)


def test_empty_table(spark):
    df = spark.createDataFrame([], TREE)
    assert chats.conversations(df).count() == 0
    assert chats.conversations(chats.chains(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_chains(spark):
    rows = [(1, 5, "user", "b"), (1, 5, "user", "a"), (1, None, "system", "s"), (1, 9, None, None), (None, 1, "user", "x"), (1, 5, "user", "a")]
    found = chats.chains(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("tree_id", "node_id").collect()
    assert [(r["tree_id"], r["node_id"], r["parent_id"], r["text"]) for r in found] == [
        (None, 1, None, "x"), (1, 1, None, "s"), (1, 2, 1, "a"), (1, 3, 2, "a"), (1, 4, 3, "b"), (1, 5, 4, None)
    ]


@pytest.mark.skipif(not SMALL.exists(), reason="no test tables")
def test_registered(spark):
    df = QUERIES["op11_reply_tree_chats"](spark, str(SMALL))
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|MapPartitions|ExistingRDD", plan)
    got = {r["conv_id"]: r for r in df.collect()}
    rows = {}
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect():
        rows.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    said = "</s>[INST] ok [/INST]"
    rows[-1] = [(0, "user", said), (1, "assistant", said)]
    assert got.keys() == rows.keys()
    for conv, turns in rows.items():
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        learned = "".join(text for _, role, text in turns if role == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    relation = con.sql(ORACLES["op11_reply_tree_chats"])
    assert sorted(tuple(r) for r in df.select(*relation.columns).collect()) == sorted(relation.fetchall())
