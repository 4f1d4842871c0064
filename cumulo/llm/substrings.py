"""Removal of repeated word windows, found by difference-cover anchors.

Positions p with p mod 7 in {0, 1, 3} form a difference cover: for any two positions i and j some shift
below 7 brings both into the cover. So if the 13-word windows at i and j are equal, both hold an equal
7-word anchor at the same shift, and hashing only the anchors at covered positions (three in seven)
finds every repeated window. Windows around an anchor that occurs in several documents are then
extended to all 13 words and compared.

Both comparisons go through buckets of the hash. A task first settles what it can among its own
documents and sends on one entry per hash (and first document), so a passage that very many
documents share costs one entry per task, and buckets stay even; what it has settled is spread over
them by document. Their number grows with the text.

A null text has no words. A row without an id is never a source and keeps its words. Rows with one id
and different texts are told apart; a window that only recurs under the same id stays. An empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.llm.common import arrow_batches, texts_of

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
# Entries that a task holds before it settles and sends them, and entries meant for one bucket.
PAGE = 400_000
BUCKET = 2_500_000
# Bytes of text per word, for the number of buckets.
WORD_BYTES = 6
MIN_BUCKETS = 16

_ENTRIES = (
    "bucket int, kind int, ids array<long>, checks array<long>, runs array<int>, first binary, second binary, places binary"
)
_ENTRIES_ARROW = pa.schema(
    [
        ("bucket", pa.int32()),
        ("kind", pa.int32()),
        ("ids", pa.list_(pa.int64())),
        ("checks", pa.list_(pa.int64())),
        ("runs", pa.list_(pa.int32())),
        ("first", pa.binary()),
        ("second", pa.binary()),
        ("places", pa.binary()),
    ]
)
_FOUND = "doc_id long, check long, found binary"
_FOUND_ARROW = pa.schema([("doc_id", pa.int64()), ("check", pa.int64()), ("found", pa.binary())])

# Entries to compare with other tasks' entries; an anchor known to be common, to compare with them too;
# entries settled here, to be passed on.
OPEN, COMMON, SETTLED = 0, 1, 2


def _spans(words: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by blanks, and where each begins and ends."""
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    return b" ".join(words), np.concatenate([[0], ends[:-1] + 1]).astype(np.int64), ends


def anchors(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Covered positions and the hashes of their anchors."""
    import xxhash

    at = np.arange(len(words) - ANCHOR + 1)
    at = at[np.isin(at % PERIOD, COVER)]
    line, starts, ends = _spans(words)
    digest, low, high = xxhash.xxh64_intdigest, starts[at].tolist(), ends[at + ANCHOR - 1].tolist()
    return at, np.fromiter((digest(line[a:b]) for a, b in zip(low, high)), dtype=np.uint64, count=len(at))


def windows(words: list[bytes], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the windows at the given positions, 64 and 32 bits."""
    import xxhash

    line, starts, ends = _spans(words)
    digest, low, high = xxhash.xxh3_128_intdigest, starts[at].tolist(), ends[at + WINDOW - 1].tolist()
    both = [digest(line[a:b]) for a, b in zip(low, high)]
    first = np.fromiter((x & 0xFFFFFFFFFFFFFFFF for x in both), dtype=np.uint64, count=len(both))
    return first, np.fromiter((x >> 96 for x in both), dtype=np.uint32, count=len(both))


def candidates(n_words: int, at: np.ndarray) -> np.ndarray:
    """Windows that hold an anchor from ``at`` at a shift below the period."""
    if not len(at):
        return at
    near = (at[:, None] - np.arange(PERIOD)[None, :]).ravel()
    return np.unique(near[(near >= 0) & (near <= n_words - WINDOW)])


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together (keeping their order), and where groups begin in it."""
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    if len(order):
        new[0] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    return order, new


class _Page:
    """Entries of a task's documents: hashes, each with the document and place it comes from."""

    def __init__(self):
        self.ids, self.checks, self.parts, self.held = [], [], [], 0

    def add(self, doc_id: int, check: int, first: np.ndarray, second: np.ndarray, places: np.ndarray) -> None:
        self.parts.append((np.full(len(first), len(self.ids)), first, second, places.astype(np.uint32)))
        self.ids.append(doc_id)
        self.checks.append(check)
        self.held += len(first)

    def columns(self) -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(x) for x in zip(*self.parts))

    def rows(self, kind: int, bucket: np.ndarray, doc: np.ndarray, *values: np.ndarray):
        """A row per bucket; entries go in the order of their documents, whose ids stand once per run."""
        order = np.lexsort((doc, bucket))
        bucket, doc, values = bucket[order], doc[order], [v[order] for v in values]
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
        for a, z in zip(cuts, [*cuts[1:], len(bucket)]):
            heads = a + np.flatnonzero(np.append(True, doc[a + 1 : z] != doc[a : z - 1]))
            runs = np.diff(np.append(heads, z))
            ids, checks = [self.ids[d] for d in doc[heads]], [self.checks[d] for d in doc[heads]]
            blobs = [v[a:z].tobytes() for v in values] + [b""] * (3 - len(values))
            yield (int(bucket[a]), kind, ids, checks, runs.tolist(), *blobs)


def _bucket(first: np.ndarray, buckets: int) -> np.ndarray:
    return (first >> np.uint64(33)).astype(np.int64) % buckets


def _settled(page: _Page, doc: np.ndarray, buckets: int, turn: int) -> np.ndarray:
    """Any bucket does for settled entries: one by their document and by the page, so that neither the
    pages of many tasks nor the repeats of one row meet."""
    mixed = np.array(page.ids, dtype=np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= np.array(page.checks, dtype=np.uint64) + (np.uint64(turn) << np.uint64(32))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return _bucket(mixed ^ (mixed >> np.uint64(32)), buckets)[doc]


def _anchor_rows(page: _Page, buckets: int, turn: int):
    doc, first, _, _ = page.columns()
    order, new = _groups(first)
    group, by_group = np.cumsum(new) - 1, doc[order]
    several = np.zeros(group[-1] + 1, dtype=bool)
    several[group[by_group != by_group[new][group]]] = True
    common, head = np.zeros(len(doc), dtype=bool), np.zeros(len(doc), dtype=bool)
    common[order], head[order] = several[group], new
    once, met = head & ~common, head & common
    yield from page.rows(OPEN, _bucket(first[once], buckets), doc[once], first[once])
    yield from page.rows(COMMON, _bucket(first[met], buckets), doc[met], first[met])
    yield from page.rows(SETTLED, _settled(page, doc[common], buckets, turn), doc[common], first[common])


def _window_rows(page: _Page, buckets: int, turn: int):
    doc, first, second, places = page.columns()
    ids = np.array(page.ids)[doc]
    order, new = _groups(first, second)
    group = np.cumsum(new) - 1
    lowest = np.minimum.reduceat(ids[order], np.flatnonzero(new))
    later = np.zeros(len(doc), dtype=bool)
    later[order] = ids[order] > lowest[group]
    least = ~later
    yield from page.rows(OPEN, _bucket(first[least], buckets), doc[least], first[least], second[least], places[least])
    yield from page.rows(SETTLED, _settled(page, doc[later], buckets, turn), doc[later], first[later], second[later], places[later])


def _read(table: pa.Table) -> tuple[np.ndarray, ...]:
    """kind, id, check, first, second and place of every entry of a bucket."""
    parts = []
    for row in table.select(["kind", "ids", "checks", "runs", "first", "second", "places"]).to_pylist():
        first = np.frombuffer(row["first"], dtype=np.uint64)
        runs = row["runs"]
        parts.append(
            (
                np.full(len(first), row["kind"], dtype=np.int8),
                np.repeat(np.array(row["ids"], dtype=np.int64), runs),
                np.repeat(np.array(row["checks"], dtype=np.uint32), runs),
                first,
                np.frombuffer(row["second"], dtype=np.uint32),
                np.frombuffer(row["places"], dtype=np.uint32),
            )
        )
    return tuple(np.concatenate(x) for x in zip(*parts))


def _by_document(ids: np.ndarray, checks: np.ndarray, values: np.ndarray) -> pa.Table:
    order, new = _groups(ids, checks)
    cuts = np.flatnonzero(new)
    values = values[order]
    blobs = [values[a:z].tobytes() for a, z in zip(cuts, np.append(cuts[1:], len(order)))]
    return pa.table([ids[order][new], checks[order][new].astype(np.int64), pa.array(blobs, pa.binary())], schema=_FOUND_ARROW)


def _common_anchors(table: pa.Table) -> pa.Table:
    kind, ids, checks, first, _, _ = _read(table)
    compared = kind != SETTLED
    order, new = _groups(first[compared])
    size = np.diff(np.append(np.flatnonzero(new), len(order)))
    group = np.cumsum(new) - 1
    several = size > 1
    several[group[kind[compared][order] == COMMON]] = True
    wanted = kind == SETTLED
    at = np.flatnonzero(compared)[order]
    wanted[at] = several[group] & (kind[at] == OPEN)
    return _by_document(ids[wanted], checks[wanted], first[wanted])


def _covered_windows(table: pa.Table) -> pa.Table:
    kind, ids, checks, first, second, places = _read(table)
    wanted = kind == SETTLED
    at = np.flatnonzero(~wanted)
    order, new = _groups(first[at], second[at])
    if len(at):
        lowest = np.minimum.reduceat(ids[at][order], np.flatnonzero(new))
        wanted[at[order]] = ids[at][order] > lowest[np.cumsum(new) - 1]
    return _by_document(ids[wanted], checks[wanted], places[wanted])


def _paged(entries, settle, buckets: int):
    """A ``mapInArrow`` function: entries of each document, settled and sent page by page."""

    def run(batches):
        task = TaskContext.get()
        page, turn = _Page(), (task.partitionId() if task else 0) << 16
        for batch in batches:
            for row in entries(batch):
                if len(row[2]):
                    page.add(*row)
                if page.held >= PAGE:
                    yield _arrow(settle(page, buckets, turn))
                    page, turn = _Page(), turn + 1
        if page.held:
            yield _arrow(settle(page, buckets, turn))

    return run


def _arrow(rows) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ENTRIES_ARROW)], schema=_ENTRIES_ARROW)


def _anchor_entries(batch):
    none = np.zeros(0, dtype=np.uint32)
    for doc_id, check, text in _columns(batch):
        words = text.split() if text and doc_id is not None else []
        if len(words) >= WINDOW:
            _, first = anchors(words)
            yield doc_id, check, first, none, none


def _window_entries(batch):
    found = batch.column(batch.schema.get_field_index("found")).to_pylist()
    for (doc_id, check, text), lists in zip(_columns(batch), found):
        if not lists or doc_id is None:
            continue
        words = text.split()
        at, first = anchors(words)
        common = np.frombuffer(b"".join(lists), dtype=np.uint64)
        places = candidates(len(words), at[np.isin(first, common)])
        yield doc_id, check, *windows(words, places), places


def _columns(batch):
    own = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "check")]
    return zip(*own, texts_of(batch))


def kept_words(words: list[bytes], starts: np.ndarray) -> list[bytes]:
    """The words outside the windows that begin at ``starts``."""
    edge = np.zeros(len(words) + WINDOW + 1, dtype=np.int64)
    starts = np.unique(starts).astype(np.int64)
    edge[starts] += 1
    edge[starts + WINDOW] -= 1
    covered = np.cumsum(edge)[: len(words)] > 0
    return [w for w, gone in zip(words, covered.tolist()) if not gone]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept``, the words that stay joined by blanks (UTF-8).

    A word goes if a 13-word window over it also begins in a document with a smaller id.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("check"),
        F.col("text").cast("string").alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(MIN_BUCKETS, int(size / WORD_BYTES * len(COVER) / PERIOD / BUCKET))

    def by_document(entries: DataFrame, settle) -> DataFrame:
        found = entries.groupBy("bucket").applyInArrow(settle, _FOUND)
        return found.groupBy("doc_id", "check").agg(F.collect_list("found").alias("found"))

    common = by_document(rows.mapInArrow(_paged(_anchor_entries, _anchor_rows, buckets), _ENTRIES), _common_anchors)
    near = rows.join(common, ["doc_id", "check"], "left")
    covered = by_document(near.mapInArrow(_paged(_window_entries, _window_rows, buckets), _ENTRIES), _covered_windows)

    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])

    def cut(batch):
        found = batch.column(batch.schema.get_field_index("found")).to_pylist()
        for (doc_id, _, text), lists in zip(_columns(batch), found):
            words = text.split() if text else []
            kept = kept_words(words, np.frombuffer(b"".join(lists), dtype=np.uint32)) if lists else words
            yield doc_id, len(words), len(words) - len(kept), b" ".join(kept)

    out = rows.join(covered, ["doc_id", "check"], "left").mapInArrow(
        arrow_batches(schema, cut, 512), "doc_id long, n_words long, n_removed long, kept binary"
    )
    return out.withColumn("kept", F.col("kept").cast("string"))
