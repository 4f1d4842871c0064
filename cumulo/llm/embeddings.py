"""Near-duplicate vectors by spherical-cap filters.

Filters are directions c = (c1, c2) with c1 and c2 from two random codebooks over the halves of the
rotated space. A vector belongs to every filter whose direction is within a cap around it; since the
inner product is the sum of two, the exceeding filters are listed from the two sorted score lists
without trying all products. Close vectors share filters, distant ones rarely do; vectors that share a
filter are compared exactly, in double precision.

The codebooks grow with the root of the number of vectors, so that a filter holds about ``TARGET``
unrelated vectors at any size; the cap is set so that a direction has ``LISTED`` filters on average. The
larger the codebooks, the more often a pair at the threshold shares none of them, so independent codes are
added until, by the rate at which one code misses trial pairs of exactly the threshold's cosine, all of them
miss such a pair at most once in ``1 / MISS`` times. Equal vectors are one class. A filter with more than ``TILE`` classes is split into blocks, whose pairs
are compared in separate tasks, so no pair is left out and no task grows. A pair counts in its
smallest common filter only; what leaves a task is a count and one link per class, never pairs.

Null, empty, zero and non-finite vectors link with nothing, as do vectors of different lengths. Rows
without an id keep a row with no links and no component. Repeated rows are vectors of their own. An
empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.llm.common import connected, stage

LISTED = 12
TARGET = 32
TILE = 1024
# Rows that one task compares group by group.
GROUP_ROWS = 20_000
SEED = 7
# Bound for the share of pairs at the threshold that share no filter, and the pairs it is measured on.
MISS = 0.01
TRIALS = 400
# Cosines this near to the threshold are summed once more, exactly.
NEAR = 1e-12


class Filters:
    """Independent product codes for vectors of one length, as many as the threshold asks for."""

    def __init__(self, length: int, vectors: int, least: float = 0.9):
        self.codes = [Code(length, vectors, 0)]
        draw = np.random.default_rng([SEED, length, 2])
        first = _unit_rows(draw.standard_normal((TRIALS, length)))
        aside = draw.standard_normal((TRIALS, length))
        aside -= (aside * first).sum(axis=1, keepdims=True) * first
        if length > 1:
            second = least * first + np.sqrt(1 - least * least) * _unit_rows(aside)
            lists = zip(self.codes[0].decode(first), self.codes[0].decode(second))
            missed = sum(len(np.intersect1d(a, b)) == 0 for a, b in lists)
            rate = (missed + 1) / (TRIALS + 2)
            self.codes += [Code(length, vectors, i) for i in range(1, int(np.ceil(np.log(MISS) / np.log(rate))))]

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """Numbers of the filters of each vector, in order, over all codes."""
        step = self.codes[0].size ** 2
        found = [code.decode(unit) for code in self.codes]
        return [np.concatenate([part + i * step for i, part in enumerate(own)]) for own in zip(*found)]


def _unit_rows(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


class Code:
    """One product code for vectors of one length."""

    def __init__(self, length: int, vectors: int, number: int):
        self.width = max(8, length + length % 2)
        draw = np.random.default_rng([SEED, self.width, *([number] if number else [])])
        self.turn = np.linalg.qr(draw.standard_normal((self.width, self.width)))[0]
        self.size = max(16, int(np.ceil(np.sqrt(vectors * LISTED / TARGET))))
        books = draw.standard_normal((2, self.size, self.width // 2))
        self.books = books / np.linalg.norm(books, axis=2, keepdims=True) / np.sqrt(2)
        trial = draw.standard_normal((256, self.width))
        first, second = self._scores(trial / np.linalg.norm(trial, axis=1, keepdims=True))
        low, high = 0.0, 1.0
        for _ in range(30):
            self.cap = (low + high) / 2
            listed = sum(len(self._list(a, b, self.cap)) for a, b in zip(first, second)) / len(trial)
            low, high = (self.cap, high) if listed > LISTED else (low, self.cap)
            if abs(listed - LISTED) < 0.01 * LISTED:
                break

    def _scores(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turned = np.pad(unit, ((0, 0), (0, self.width - unit.shape[1]))) @ self.turn
        half = self.width // 2
        return turned[:, :half] @ self.books[0].T, turned[:, half:] @ self.books[1].T

    def _list(self, first: np.ndarray, second: np.ndarray, cap: float) -> np.ndarray:
        """Numbers of the filters whose two scores add up to the cap or more, in order."""
        order = np.argsort(-second, kind="stable")
        ranked = -second[order]
        live = np.flatnonzero(first - ranked[0] >= cap)
        counts = np.searchsorted(ranked, first[live] - cap, side="right")
        heads = np.repeat(live, counts)
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.sort(heads * self.size + order[inside])

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """The filters of each vector. One with few within the cap gets a wider cap, since its
        close neighbours lie in the same thin region of the code."""
        out = []
        for first, second in zip(*self._scores(unit)):
            cap = self.cap
            found = self._list(first, second, cap)
            while len(found) < LISTED // 2:
                cap *= 0.97
                found = self._list(first, second, cap)
            out.append(found)
        return out


def _units(vectors: list) -> np.ndarray:
    rows = np.array(vectors, dtype=np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _compare(nodes, copies, units, lists, own: int, blocks: np.ndarray | None, least: float):
    """Per class with links: node, weighted number of links first met in this filter, smallest node
    of its group."""
    cosine = units @ units.T
    close = cosine >= least
    # Blocked products of other shapes may differ in the last bits; these pairs get one sum for all.
    for i, j in np.argwhere(np.triu(np.abs(cosine - least) < NEAR, 1)):
        close[i, j] = close[j, i] = math.fsum((units[i] * units[j]).tolist()) >= least
    np.fill_diagonal(close, False)
    if blocks is not None:
        close &= blocks[:, None] != blocks[None, :]
    some = np.flatnonzero(close.any(axis=1))
    if not len(some):
        return
    close, nodes, copies = close[np.ix_(some, some)], nodes[some], copies[some]
    earlier = [l[l < own] for l in (lists[i] for i in some)]
    flat = np.concatenate(earlier)
    first = close
    if len(flat):
        known = np.sort(flat)
        known = known[np.append(True, known[1:] != known[:-1])]
        member = np.zeros((len(some), len(known)), dtype=np.float32)
        member[np.repeat(np.arange(len(some)), [len(e) for e in earlier]), np.searchsorted(known, flat)] = 1
        first = close & (member @ member.T == 0)
    links = first @ copies
    low = nodes.copy()
    while True:
        new = np.minimum(low, np.where(close, low[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new == low).all():
            break
        low = new
    yield from zip(nodes.tolist(), links.tolist(), low.tolist())


def near_duplicates(vectors: DataFrame, least: float = 0.9) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vec_id``, ``embedding``."""
    value = F.col("embedding")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.col("vec_id").isNotNull() & value.isNotNull() & finite & F.exists(value, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("embedding"))
    rows = rows.withColumn("valid", F.coalesce(valid, F.lit(False)))
    # The second hash starts from another seed, so both must collide for two vectors to be one class.
    key = [F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(1), "embedding").alias("k2")]

    classes = rows.where("valid").groupBy(*key).agg(
        F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.any_value("embedding").alias("embedding")
    )
    classes = stage(classes, "vectors")
    sizes = {r["d"]: r["n"] for r in classes.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).collect()}

    def decode(batches):
        codes: dict[int, Filters] = {}
        for batch in batches:
            values = batch.column(batch.schema.get_field_index("embedding")).to_pylist()
            lists: list = [None] * len(values)
            for d in {len(v) for v in values}:
                at = [i for i, v in enumerate(values) if len(v) == d]
                if d not in codes:
                    codes[d] = Filters(d, sizes[d], least)
                for low in range(0, len(at), 1024):
                    part = at[low : low + 1024]
                    for i, found in zip(part, codes[d].decode(_units([values[i] for i in part]))):
                        lists[i] = found
            own = [batch.column(batch.schema.get_field_index(c)) for c in ("node", "copies", "embedding")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(lists, pa.list_(pa.int64()))], names=["node", "copies", "embedding", "filters"]
            )

    kind = dict(classes.dtypes)["embedding"]
    listed = classes.select("node", "copies", "embedding").mapInArrow(
        decode, f"node long, copies long, embedding {kind}, filters array<long>"
    )
    listed = stage(listed.withColumn("d", F.size("embedding")), "filters")

    members = listed.select("d", F.explode("filters").alias("filter"))
    counts = members.groupBy("d", "filter").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / TILE).cast("int")
    total = max(1, sum(sizes.values()) * LISTED)
    met = listed.withColumn("filter", F.explode("filters")).join(counts, ["d", "filter"])
    met = met.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = met.withColumn("other", other).select(
        "node",
        "copies",
        "embedding",
        "filters",
        "filter",
        "block",
        F.least("block", "other").alias("a"),
        F.greatest("block", "other").alias("b"),
        # Small filters share a group; each tile of a split one is a group.
        F.when(F.col("blocks") > 1, F.xxhash64("filter")).otherwise(
            F.pmod(F.xxhash64("filter"), F.lit(max(1, total // GROUP_ROWS)))
        ).alias("group"),
        "d",
        (F.col("blocks") > 1).alias("split"),
    )

    out = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("low", pa.int64())])

    def compare(table: pa.Table) -> pa.Table:
        filters = table.column("filter").to_numpy()
        order = np.argsort(filters, kind="stable")
        cuts = np.flatnonzero(np.append(True, filters[order][1:] != filters[order][:-1]))
        nodes, copies, block = (table.column(c).to_numpy() for c in ("node", "copies", "block"))
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        values, lists = table.column("embedding").combine_chunks(), table.column("filters").combine_chunks()
        found = []
        for low, high in zip(cuts, np.append(cuts[1:], len(order))):
            at = order[low:high]
            if len(at) < 2:
                continue
            units = _units(values.take(pa.array(at)).to_pylist())
            own = [np.array(l, dtype=np.int64) for l in lists.take(pa.array(at)).to_pylist()]
            parted = block[at] if a != b else None
            found += _compare(nodes[at], copies[at], units, own, int(filters[at[0]]), parted, least)
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], [], []))], schema=out)

    compared = tiles.groupBy("d", "split", "group", "a", "b").applyInArrow(compare, "node long, links long, low long")
    compared = stage(compared, "compared")
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected(compared.select(F.col("node").alias("a"), F.col("low").alias("b")))
    named = classes.select("k1", "k2", "node", "copies").join(links, "node", "left").join(groups.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
    named = named.select(
        "k1",
        "k2",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    # Only valid rows carry a key, so the others join nothing.
    keyed = rows.select("vec_id", *[F.when(F.col("valid"), k).alias(n) for k, n in zip(key, ("k1", "k2"))])
    component = F.coalesce("component_id", "vec_id")
    return keyed.join(named, ["k1", "k2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
