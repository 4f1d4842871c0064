"""Phrases against a plain count, and the trie and its runs on their own."""

import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from cumulo.llm import phrases
from cumulo.llm.queries import ORACLES, QUERIES

SMALL = Path("/root/testdata/sf0.001")


def plain(rows, least=10, top=2000, share=50):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            counts.update((lang, *words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    found = {}
    for key, a in counts.items():
        lang, *words = key
        if len(words) < 2 or a < least:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        value, _, l, r = min(cuts)
        found[key] = (value, a, " ".join(words), l, r)
    for key, (_, a, *_) in list(found.items()):
        if len(key) == 4:
            for inner in (key[:3], (key[0], *key[2:])):
                if inner in found and 100 * a >= share * counts[inner]:
                    found[inner] = None
    out = []
    for lang in total:
        own = [v for k, v in found.items() if v and k[0] == lang]
        own.sort(key=lambda v: (-v[0], -v[1], v[2].encode()))
        out += [(lang, i + 1, p, a, l, r, total[lang], s) for i, (s, a, p, l, r) in enumerate(own[:top])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def said():
    draw = random.Random(4)
    words = ["the", "of", "Land", "l'eau", "été", "ü", "#1", "a\x00b", "x y", "日本"]
    ends = [" ", "  ", "\t", ". ", ", ", "!", "\n", "\r\n", " ; ", "? "]
    rows = []
    for i in range(300):
        text = "".join(draw.choice(words[: 3 + i % 8]) + draw.choice(ends[: 2 + i % 9]) for _ in range(draw.randrange(60)))
        rows.append((draw.choice(["en", "en", "en", None, "", "und"]), text))
    rows += [("en", None), (None, None), ("fr", ""), ("de", " \t.,"), ("en", "the of land " * 3000), ("en", "word" * 100_000)]
    return rows + [("en", "one more copy of this line")] * 12


@pytest.mark.parametrize("small", [False, True])
def test_against_plain(spark, said, monkeypatch, small):
    if small:
        # Everything bursts, spills, is renumbered and dealt over many partitions with frequent words.
        for name, value in {"SHARE": 900, "BURST": 16, "HELD": 40, "HELD_WORDS": 5, "NUMBERED": 12, "CHUNK": 64}.items():
            monkeypatch.setattr(phrases, name, value)
    df = spark.createDataFrame(said, "lang string, text string").repartition(5)
    assert rows_of(phrases.collocations(df)) == plain(said)
    assert rows_of(phrases.collocations(df, least=2, top=7, share=90)) == plain(said, 2, 7, 90)


def test_trie_counts_and_whole_subtrees(monkeypatch):
    monkeypatch.setattr(phrases, "BURST", 64)
    draw = np.random.default_rng(1)
    trie, want = phrases.HatTrie(), Counter()
    for _ in range(30):
        ids = [np.minimum(draw.zipf(1.3, 200), 900) for _ in range(3)]
        codes, counts = np.unique(ids[0] << 42 | ids[1] << 21 | ids[2], return_counts=True)
        trie.add(codes, counts)
        want.update(dict(zip(codes.tolist(), counts.tolist())))
    assert len(trie) == len(want) and trie.nodes and any(node.nodes for node in trie.nodes.values())
    seen = Counter()
    while len(trie):
        codes, counts = trie.take(len(trie) // 2)
        assert len(codes)
        own = set((codes >> 42).tolist())
        # What was taken of a word with a node of its own is all of it.
        assert not own & set(trie.nodes)
        seen.update(dict(zip(codes.tolist(), counts.tolist())))
    assert seen == want


def test_frequent_prefixes_are_split():
    counting = phrases._Counting("en")
    text = b" ".join(b"the w%d x%d" % (i, i) for i in range(2000))
    for _ in counting.read(text):
        pass
    counting.finish()
    codes, counts = counting.trie.take()
    plain_runs = counting.runs(codes, counts, set(), 64)
    hot = counting.runs(codes, counts, {("en", b"the")}, 64)
    largest = [max(b.column(2).to_pylist()) for b in (plain_runs, hot)]
    assert largest[0] >= 2000 > 4 * largest[1]
    assert sum(plain_runs.column(2).to_pylist()) == sum(hot.column(2).to_pylist()) == len(codes)


def test_parts_keep_words():
    text = b"aa bb. cc\tdd " + b"e" * 50 + b" ff"
    for size in (1, 3, 7, 20, 1000):
        joined = b" ".join(phrases.parts_of(text, size))
        assert joined.split() == text.translate(phrases._TABLE).split()


def test_scores_are_exact(spark):
    pairs = [(999_999_999_999_999, 999_999_999_999_999, 999_999_999_999_999), (3, 7, 11), (10**9 + 7, 10**9 + 8, 10**9 + 9)]
    df = spark.createDataFrame(pairs, "a long, l long, r long")
    got = [r[0] for r in df.select(phrases.score(*[df[c] for c in "alr"])).collect()]
    assert got == [1_000_000 * a * a // (l * r) for a, l, r in pairs]


def test_odd_tables(spark):
    schema = "lang string, text string, rank int, phrase string, n int, word string, part string"
    found = phrases.collocations(spark.createDataFrame([], schema))
    assert found.count() == 0
    rows = [("en", "a b. a b c", 1, "p", 2, "w", "z"), (None, None, None, None, None, None, None)]
    found = phrases.collocations(spark.createDataFrame(rows * 10, schema))
    assert rows_of(found) == plain([r[:2] for r in rows * 10])


@pytest.mark.skipif(not SMALL.exists(), reason="no test tables")
def test_registered_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    relation = con.sql(ORACLES["op12_hat_trie_phrases"])
    got = QUERIES["op12_hat_trie_phrases"](spark, str(SMALL)).select(*relation.columns)
    assert rows_of(got) == sorted(relation.fetchall())
