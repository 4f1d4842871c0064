"""The registered queries on odd and on empty tables, and the columns they derive."""

import math
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from cumulo.llm.queries import QUERIES

P = pytest.importorskip("public_tokenizers")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, n int, word string, chunk int"
LONG = "one very long text of many words " * 20_000
TEXTS = [(None, "no id"), (None, None), (1, "a b c"), (1, "a b c"), (2, None), (3, ""), (4, " \t\n"), (5, LONG), (6, "ä<|endoftext|> Ü 日本"), (7, "a b c")]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    documents = [(i, t, None, "x", None, 1, "w", 2) for i, t in TEXTS]
    vectors = [(None, [1.0, 2.0], 0, 1), (1, [1.0, 2.0], 0, 1), (1, [1.0, 2.0], 0, 1), (2, None, 0, 1), (3, [2.0, 1.0], 0, 1), (4, [None, 1.0], 0, 1)]
    tables = {
        "documents": (documents, DOCUMENTS),
        "embeddings": (vectors, "vec_id long, embedding array<float>, label int, component int"),
        "labels": ([(1, 1, 0), (1, 1, 0), (5, 0, 1), (None, 0, 0), (99, 1, 0)], "doc_id long, quality int, toxic int"),
        "benchmark": ([(1, "one very long text of"), (1, "one very long text of"), (2, None), (None, "a b c"), (3, "")], "item_id long, text string"),
        "conversations": ([(1, 0, "user", None, 1), (1, 0, "user", None, 1), (None, None, None, None, 1), (2, 5, "tool", "<s>", 1)], "conv_id long, turn long, role string, text string, place int"),
    }
    root = tmp_path_factory.mktemp("tables")
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        df.write.parquet(f"{root}/odd/{name}.parquet")
        df.limit(0).write.parquet(f"{root}/empty/{name}.parquet")
    return root


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_and_empty_tables(spark, folders, name):
    found = QUERIES[name](spark, f"{folders}/odd")
    rows = found.collect()
    assert rows and len(set(found.columns)) == len(found.columns)
    if "doc_id" in found.columns and name.split("_")[0] in ("op1", "op3", "op4", "op5", "op7", "op9", "op10"):
        assert sorted(r["doc_id"] or -1 for r in rows) == sorted(i or -1 for i, _ in TEXTS)
    empty = QUERIES[name](spark, f"{folders}/empty")
    assert empty.columns == found.columns
    assert empty.count() == (1 if name.startswith("op11_") else 0)


def test_derived_columns(spark, folders):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = dict(TEXTS[2:])
    for r in QUERIES["op4_hash_tree_sharding"](spark, f"{folders}/odd").where("doc_id IS NOT NULL").collect():
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
    pieces = {}
    for r in QUERIES["op2_best_fit_packing"](spark, f"{folders}/odd").where("doc_id > 1").collect():
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for doc_id, found in pieces.items():
        ids = own.encode(texts[doc_id] or "", add_special_tokens=False).ids + [2]
        for piece, start, length, crc in sorted(found):
            part = ids[start : start + length]
            assert len(part) == length and crc == zlib.crc32(struct.pack(f"<{length}I", *part))
        assert sum(f[2] for f in found) == len(ids)
    prints = QUERIES["op10_pigeonring_simhash"](spark, f"{folders}/odd").select("doc_id", "fingerprint").collect()
    import xxhash

    one = f"{xxhash.xxh64_intdigest('a b c', 42):016x}"
    assert {r["fingerprint"] for r in prints if r["doc_id"] in (1, 7)} == {one}
    assert {r["fingerprint"] for r in prints if r["doc_id"] in (2, 3, 4)} == {"0" * 16}


def test_scores_of_words_that_training_lacks(spark, tmp_path):
    """A held-out text that a unigram model gives a word's price is not charged for every byte of it."""
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    odd = ["key 9f86d081884c7d659a2feaa0c55ad015" * 30, "x" * 5000, "the `new` word", "\0 \U0001f600", "", None, "the old word"]
    rows = [(i, "the old word and the other") for i in range(200) if i not in held] + list(zip(held, odd))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in QUERIES["op7_context_tree_scores"](spark, str(tmp_path)).collect()}
    assert sorted(found) == sorted(i for i, _ in rows)
    for r in found.values():
        assert math.isfinite(r["score"]) and math.isfinite(r["tree_score"])
        assert r["score"] >= max(r["base_score"], r["tree_score"]) - math.log10(2) - 1e-9
        if r["tree_score"] > -300 and r["base_score"] > -300:
            assert 10 ** r["score"] == pytest.approx((10 ** r["base_score"] + 10 ** r["tree_score"]) / 2)
    assert found[held[1]]["tree_score"] < -100 > found[held[0]]["tree_score"]
