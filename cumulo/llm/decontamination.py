"""Benchmark decontamination: test items found in documents within an edit budget.

A document leaks an item if some stretch of it is within ``budget`` edits of the item, both
lower-cased with each run of blanks as one space. With budget + 1 pieces of the item, at least one
piece survives any such edits unchanged, so every leak holds an exact piece hit; the stretch around
each hit is then checked by Myers' bit-parallel distance.

The items are a stated query set held against all documents. Spark deals them into blocks of bounded
size, and the driver holds one block at a time: each is fetched, sent, and its pass over the documents
written before the next one, so any number of items works within the same memory. A single block, as for
items of up to ``BLOCK_CHARS`` characters, is not written.

Null or blank texts leak nothing, null or blank items are leaked by nothing, repeated document rows each
count, repeated item rows count once. Very long texts are searched whole. An empty table, of documents or
of items, gives no leaks. Columns named like the results are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.llm.common import arrow_batches, stage

# Characters of items, and items, that one pass holds in a task on average. Items are dealt by hash, so that a
# block exceeds this only by chance, and by the length of one item.
BLOCK_CHARS = 4_000_000
BLOCK_ITEMS = 50_000
# Edits allowed per character of an item.
RATE = 0.05
_BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def normal(text: str | None) -> str:
    return _BLANKS.sub(" ", text.lower()).strip(" ") if text else ""


def budget(length: int, rate: float) -> int:
    """Edits allowed for an item of so many characters; its pieces have at least one character."""
    return min(int(length * rate), max(0, length - 1))


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """``edits`` + 1 pieces of nearly equal length, with their offsets."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(item: str, text: str, edits: int, masks: dict[str, int] | None = None) -> tuple[int, int] | None:
    """The least distance of the item to any stretch of the text, and where the first such stretch
    ends; None above ``edits``. The item's states are the bits of one integer per character read."""
    m = len(item)
    if masks is None:
        masks = bits(item)
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best, end = full, 0, m, m, 0
    for at, char in enumerate(text, 1):
        eq = masks.get(char, 0)
        across = eq | minus
        diagonal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        # A free start: nothing is carried into the first row.
        up = up << 1 & full
        down = down << 1 & full
        plus = down | ~(across | up) & full
        minus = up & across
        if score < best:
            best, end = score, at
    return (best, end) if best <= edits else None


def bits(item: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, char in enumerate(item):
        masks[char] |= 1 << i
    return dict(masks)


def _stretches(hits: list[int], before: int, after: int, length: int) -> list[tuple[int, int]]:
    """Overlapping stretches around the estimated starts, merged."""
    out: list[list[int]] = []
    for start in sorted(set(hits)):
        a, b = max(0, start - before), min(length, start + after)
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


class Finder:
    """All leaks of a block of items in one text."""

    def __init__(self, block: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = block
        self.limits = [budget(len(text), rate) for _, text in block]
        self.masks = [bits(text) for _, text in block]
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, (_, text) in enumerate(block):
            for offset, piece in pieces(text, self.limits[i]):
                where[piece].append((i, offset))
        self.machine = ahocorasick.Automaton()
        for piece, places in where.items():
            self.machine.add_word(piece, (len(piece), places))
        if where:
            self.machine.make_automaton()

    def find(self, text: str | None):
        """``item_id``, distance and end of the closest stretch, per leaked item."""
        text = normal(text)
        if not text or not self.items:
            return
        starts: dict[int, list[int]] = defaultdict(list)
        for last, (size, places) in self.machine.iter(text):
            for i, offset in places:
                starts[i].append(last + 1 - size - offset)
        for i, hits in starts.items():
            item_id, item = self.items[i]
            edits, best = self.limits[i], None
            for a, b in _stretches(hits, edits, len(item) + edits, len(text)):
                got = myers(item, text[a:b], edits, self.masks[i])
                if got and (best is None or got[0] < best[0]):
                    best = (got[0], a + got[1])
            if best:
                yield item_id, *best


def _blocks(items: DataFrame):
    """Blocks of distinct items (id, normalised text), one after the other, and whether it is the only one."""
    rows = items.select("item_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.length("text")).alias("chars"), F.count(F.lit(1)).alias("n")).first()
    blocks = max(1, -(-(size["chars"] or 0) // BLOCK_CHARS), -(-size["n"] // BLOCK_ITEMS))
    if blocks > 1:
        rows = stage(rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items", "block")
    for block in range(blocks):
        own = rows if blocks == 1 else rows.where(F.col("block") == block)
        known = sorted((r["item_id"], normal(r["text"])) for r in own.select("item_id", "text").toLocalIterator() if r["item_id"] is not None)
        yield [x for x in known if x[1]], blocks == 1


def leaks(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """``doc_id``, ``item_id``, ``distance`` and ``stop`` (where the closest stretch of the
    normalised text ends), one row per document row and item leaked."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("stop", pa.int64())])
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def search(block) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast((block, rate))

        def run(batches):
            finder = Finder(*shared.value)

            def rows(batch):
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for found in finder.find(text):
                        yield doc_id, *found

            yield from arrow_batches(schema, rows)(batches)

        return narrow.mapInArrow(run, "doc_id long, item_id long, distance int, stop long")

    found = None
    for block, only in _blocks(items):
        own = search(block) if only else stage(search(block), "leaks")
        found = own if found is None else found.union(own)
    return found


def without_leaks(docs: DataFrame, items: DataFrame, rate: float = RATE, column: str = "text") -> DataFrame:
    """The rows that leak no item, with all their columns, in one pass per block and without a shuffle."""
    out = docs
    for block, only in _blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast((block, rate))

        def run(batches, shared=shared):
            finder = Finder(*shared.value)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
                clean = pa.array([next(finder.find(t), None) is None for t in texts], pa.bool_())
                yield batch.filter(clean)

        out = out.mapInArrow(run, docs.schema)
        if not only:
            out = stage(out, "without-leaks")
    return out
