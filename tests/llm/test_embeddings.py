"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from cumulo.llm import embeddings


def all_pairs(rows, least=0.9):
    units = {}
    for vec_id, values in rows:
        x = np.array([np.nan if v is None else v for v in values or [0.0]], dtype=float)
        if np.isfinite(x).all() and x.any() and vec_id is not None:
            units[vec_id] = x / np.linalg.norm(x)
    ids = sorted(units)
    linked = {a: [b for b in ids if b != a and len(units[a]) == len(units[b]) and units[a] @ units[b] >= least] for a in ids}
    low = {i: i for i, _ in rows if i is not None}
    changed = True
    while changed:
        changed = False
        for a in ids:
            best = min([low[b] for b in linked[a]] + [low[a]])
            if best < low[a]:
                low[a], changed = best, True
    return {i: (len(linked.get(i, [])), low[i]) for i in low}


@pytest.fixture(scope="module")
def vectors():
    draw = np.random.default_rng(1)
    rows, n = [], 0
    for group in range(60):
        center = draw.standard_normal(32)
        for _ in range(1 + group % 9):
            rows.append((n, [float(x) for x in np.float32(center + draw.standard_normal(32) * 0.25)]))
            n += 1
    rows += [(n + i, rows[5][1]) for i in range(4)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 32), (1003, [float("nan")] * 32), (1004, [None] * 32), (1005, rows[0][1][:16])]
    return rows


def check(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(frame).collect()}
    expected = all_pairs(rows)
    found, true = (sum(n for n, _ in x.values()) for x in (got, expected))
    assert got.keys() == expected.keys() and all(got[i][0] <= expected[i][0] for i in got)
    return found / true, got, expected


def test_recall_and_components(spark, vectors):
    recall, got, expected = check(spark, vectors)
    assert recall >= 0.98
    assert sum(got[i] == expected[i] for i in got) >= 0.97 * len(got)
    assert all(got[i] == (0, i) for i in (1000, 1001, 1002, 1003, 1004))


def test_split_filters_lose_nothing(spark, vectors, monkeypatch):
    whole = check(spark, vectors)[1]
    monkeypatch.setattr(embeddings, "TILE", 4)
    assert check(spark, vectors)[1] == whole


def test_empty_and_null_ids(spark):
    frame = spark.createDataFrame([(None, [1.0, 2.0]), (4, [1.0, 2.0]), (4, [1.0, 2.0])], "vec_id long, embedding array<float>")
    rows = sorted(embeddings.near_duplicates(frame).collect(), key=lambda r: r.vec_id or 0)
    assert [tuple(r) for r in rows] == [(None, 0, None, False), (4, 1, 4, True), (4, 1, 4, True)]
    assert embeddings.near_duplicates(frame.limit(0)).collect() == []


@pytest.mark.parametrize("vectors", [10_000, 10_000_000, 100_000_000])
def test_pairs_at_the_threshold_share_filters_at_any_size(vectors):
    """Codes built for so many vectors, fresh pairs at exactly 0.9: at least 0.98 of them meet."""
    filters = embeddings.Filters(64, vectors)
    draw = np.random.default_rng(99)
    first = embeddings._unit_rows(draw.standard_normal((400, 64)))
    aside = draw.standard_normal((400, 64))
    aside -= (aside * first).sum(axis=1, keepdims=True) * first
    second = 0.9 * first + np.sqrt(0.19) * embeddings._unit_rows(aside)
    met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(filters.decode(first), filters.decode(second))]
    assert np.mean(met) >= 0.98
    lists = filters.decode(first[:50])
    assert all((np.diff(found) > 0).all() for found in lists)


def test_hashes_of_classes_are_independent(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([([1.0, 2.0],)], "embedding array<float>")
    chained, apart = frame.select(F.xxhash64("embedding", F.lit(1)), F.xxhash64(F.lit(1), "embedding")).first()
    assert chained != apart


def test_cosines_at_the_threshold_do_not_depend_on_blocks():
    units = np.array([[1.0, 0.0], [0.9, np.sqrt(1 - 0.81)]])
    lists = [np.array([0]), np.array([0])]
    rows = [list(embeddings._compare(np.array([1, 2]), np.array([1, 1]), units, lists, 0, None, least)) for least in (0.9, 0.9 + 1e-15)]
    assert len(rows[0]) == 2 and rows[1] == []
