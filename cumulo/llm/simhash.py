"""SimHash near-duplicates found by pigeonring filtering.

A fingerprint of 64 bits is cut into a ring of segments. If two fingerprints differ in at most
``max_bits`` bits, some segment starts a chain in which the first l segments together differ in at
most l * max_bits / segments bits, for every l. With more segments than bits the first of them is
equal, so candidates share (segment number, segment value); the rest of the chain prunes them before
the full Hamming check.

Equal fingerprints are one class; only classes are compared. A bucket with up to ``BUCKET`` classes
is compared in one task and gives the links of a spanning star per group. A larger one is resolved
exactly without pairs: two fingerprints differ in at most two bits if and only if some word is at most
one bit away from both, so each class lists those words and classes with a common one are linked; at
most 65 classes can meet at one word.

Null or blank texts have fingerprint zero and link like any other. Rows without an id get a fingerprint
and no component. Repeated rows share theirs. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.llm.common import arrow_batches, connected, stage, texts_of

BITS = 64
SEED = 42
# Classes of one bucket that a single task compares with each other.
BUCKET = 1024
# Shingles whose bits are counted at a time.
SHINGLES = 1 << 16


def fingerprint(text: bytes | None, width: int = 3, seed: int = SEED) -> int:
    """Bit b is set if it is set in over half the hashes of the shingles, repeats included."""
    import xxhash

    words = text.lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    starts, ends = starts[:n].tolist(), ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, dtype=np.int64)
    for low in range(0, n, SHINGLES):
        part = [digest(line[a:b], seed) for a, b in zip(starts[low : low + SHINGLES], ends[low : low + SHINGLES])]
        rows = np.array(part, dtype=np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit number."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def rows(batch):
        for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
            value = fingerprint(text, width)
            yield doc_id, value - (1 << 64) if value >> 63 else value

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(arrow_batches(schema, rows), "doc_id long, fp long")


def ring(segments: int) -> list[tuple[int, int]]:
    """Shift and mask of each segment."""
    cuts = [BITS * i // segments for i in range(segments + 1)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(cuts, cuts[1:])]


def _close(fps: np.ndarray, start: int, segments: int, max_bits: int) -> np.ndarray:
    """Which pairs pass the chain from segment ``start`` and then the Hamming check."""
    differ = fps[:, None] ^ fps[None, :]
    passed, total = np.ones(differ.shape, dtype=bool), np.zeros(differ.shape, dtype=np.uint8)
    parts = ring(segments)
    for length in range(1, segments + 1):
        shift, mask = parts[(start + length - 1) % segments]
        total += np.bitwise_count((differ >> np.uint64(shift)) & np.uint64(mask))
        passed &= total <= length * max_bits // segments
    return passed


def stars(linked: np.ndarray, nodes: np.ndarray):
    """Links of each node to the smallest node of its group; ``linked`` is a symmetric matrix."""
    low = nodes.copy()
    while True:
        new = np.where(linked, low[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(new, low)
        if (new == low).all():
            break
        low = new
    return [(int(n), int(m)) for n, m in zip(nodes, low) if n != m]


def links(classes: DataFrame, max_bits: int = 2, segments: int = 3) -> DataFrame:
    """Links ``a``-``b`` that join all classes (``fp``, ``node``) within ``max_bits`` bits, whether
    directly or through others."""
    if max_bits != 2 or segments < 3:
        raise ValueError("two bits and at least three segments: a chain starts at an equal segment")
    parts = ring(segments)
    values = [
        F.struct(F.lit(i).alias("segment"), F.shiftrightunsigned("fp", s).bitwiseAND(F.lit(m)).alias("value"))
        for i, (s, m) in enumerate(parts)
    ]
    rows = classes.select("fp", "node", F.explode(F.array(*values)).alias("s")).select("fp", "node", "s.segment", "s.value")
    sizes = rows.groupBy("segment", "value").agg(F.count("*").alias("n")).where("n > 1")
    rows = stage(rows.join(sizes, ["segment", "value"]), "segments")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batch):
        segment, members = batch.column(0).to_pylist(), batch.column(1)
        offsets = members.offsets.to_numpy()
        flat = members.values
        fps = flat.field(0).to_numpy(zero_copy_only=False).view(np.uint64)
        nodes = flat.field(1).to_numpy(zero_copy_only=False)
        for i, low, high in zip(segment, offsets, offsets[1:]):
            close = _close(fps[low:high], i, segments, max_bits)
            if close.sum() > high - low:
                yield from stars(close, nodes[low:high])

    small = rows.where(F.col("n") <= BUCKET).groupBy("segment", "value").agg(F.collect_list(F.struct("fp", "node")).alias("members"))
    found = small.select("segment", "members").mapInArrow(arrow_batches(schema, compare), "a long, b long")

    large = rows.where(F.col("n") > BUCKET).select("fp", "node").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(BITS)])
    near = large.select("node", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("word"))
    met = near.groupBy("word").agg(F.collect_list("node").alias("nodes")).where(F.size("nodes") > 1)
    wide = met.select(F.explode("nodes").alias("a"), F.array_min("nodes").alias("b")).where("a <> b")
    return found.union(wide).distinct()


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 2, segments: int = 3) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the smallest id reachable over links."""
    rows = stage(fingerprints(docs, width), "fingerprints")
    classes = rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node"))
    groups = connected(links(classes, max_bits, segments))
    named = classes.join(groups, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    out = rows.join(named, "fp", "left")
    return out.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
