"""Context-tree weighting over byte contexts, and the word unigram base it is held against.

A text is its bytes, A-Z lower-cased, and an end byte that UTF-8 never has; before it stand end bytes.
Each byte is eight binary decisions. For every decision there is a tree over the bytes before it, up to
``DEPTH``; a node's Krichevsky-Trofimov estimate and its children are weighted by one half each, all
counts taken from the whole training corpus. Frozen, the tree predicts a bit by mixing the estimates of
all depths along its context by their posterior weights, which gives a code length per byte. Every context
of the corpus is a node; there is no bound on their number.

1. Tasks read texts in chunks. A chunk keeps its texts and sends its distinct codes (a context of
   ``DEPTH`` bytes and the byte after it) with their training counts to buckets by the last three bytes
   of the context, and its distinct words to buckets of words.
2. A bucket adds up its codes, which are all of the contexts that end in its bytes. It weights its trees
   from the deepest contexts up to three bytes; what is left for each pair of bytes, at most 65,536 of
   them, is added up over the buckets, and one task weights the top of the tree.
3. Knowing the top's mixtures, the buckets answer each chunk with the log probabilities of its codes, and
   word buckets with the counts of its words. The chunk adds them up by document.

Codes are sorted by context, so they travel as differences, at about a byte and a half each. A bucket
holds each code once however many chunks send it.

Null texts are empty: one end byte, one end token. A row without an id trains. Repeated rows count and are
scored each. A text longer than a chunk is a chunk of its own, coded in slices. An empty table gives no
rows; without training rows every byte has the same probability. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulo.llm.common import stage, texts_of

DEPTH = 6
END = 0xFF
# Contexts of so many bytes are never parted between buckets; those shorter are the top.
TOP = 2
# Bytes of texts in a chunk, and of those coded at a time; texts that share a slice have one byte for a number.
CHUNK = 32_000_000
SLICE = 1_000_000
SHARED = 255
# Bytes of the corpus per bucket, and codes that a bucket adds up at a time.
BUCKET = 32_000_000
MIN_BUCKETS = 8
FOLD = 3_000_000
_TEXTS, _CODES, _WORDS = 0, 1, 2
LN2 = math.log(2)


# ---- codes ---------------------------------------------------------------------------------------


def codes(line: bytes, depth: int) -> np.ndarray:
    """For every byte of the line but the first ``depth``: the bytes before it, the nearest in the highest
    place, and the byte itself in the lowest."""
    n = len(line) - depth
    window = np.ndarray((n,), "<u8", line + bytes(8), 0, (1,))
    return ((window & np.uint64((1 << 8 * depth) - 1)) << np.uint64(8)) | ((window >> np.uint64(8 * depth)) & np.uint64(255))


def slices(texts: list[bytes], depth: int):
    """(first text, codes, number of codes of each text) of the texts and their end bytes, in order.

    Texts share a slice up to ``SLICE`` bytes; a longer one is cut into several slices of its own."""
    pad = bytes([END]) * depth
    first, held, size = 0, [], 0

    def shared():
        line = pad + pad.join(held) + pad[:1]
        found, sizes = codes(line, depth), np.array([len(t) + 1 for t in held])
        if depth > 1 and len(held) > 1:
            ends = np.cumsum(sizes[:-1] + depth - 1) - (depth - 1)
            keep = np.ones(len(found), dtype=bool)
            keep[(ends[:, None] + np.arange(depth - 1)).ravel()] = False
            found = found[keep]
        return first, found, sizes

    for i, text in enumerate(texts):
        if held and (size + len(text) > SLICE or len(held) == SHARED):
            yield shared()
            held, size = [], 0
        if not held:
            first = i
        if len(text) > SLICE:
            line = pad + text + pad[:1]
            for low in range(0, len(text) + 1, SLICE):
                part = codes(line[low : low + depth + SLICE], depth)
                yield i, part, np.array([len(part)])
            continue
        held.append(text)
        size += len(text)
    if held:
        yield shared()


def _heads(ranked: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, np.int64)


def add_up(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, sorted, and the sums of their counts. The list is emptied, so that its parts and their
    sum are not held together."""
    values, counts = (np.concatenate(x) for x in zip(*parts))
    parts.clear()
    order = np.argsort(values, kind="stable")
    values = values[order]
    counts = counts[order]
    del order
    first = _heads(values)
    return values[first], np.add.reduceat(counts, first) if len(first) else counts


def tally(texts: list[bytes], train: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of the texts and how often each occurs in training texts (0: in others only)."""
    parts, size = [], 0
    for first, found, sizes in slices(texts, depth):
        marks = np.repeat(train[first : first + len(sizes)].astype(np.uint64), sizes)
        ranked = np.sort(found << np.uint64(1) | marks)
        head = _heads(ranked >> np.uint64(1))
        counts = np.add.reduceat((ranked & np.uint64(1)).astype(np.int64), head)
        parts.append((ranked[head] >> np.uint64(1), counts))
        size += len(head)
        if size > FOLD:
            parts, size = [add_up(parts)], 0
    return add_up(parts) if len(parts) > 1 else parts[0]


def packed(values: np.ndarray) -> bytes:
    """Whole numbers or floats, compressed by place."""
    wide = np.ascontiguousarray(values)
    planes = wide.view(np.uint8).reshape(len(wide), wide.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, kind: str, n: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, decompressed_size=n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).ravel()


def packed_codes(values: np.ndarray) -> bytes:
    return packed(np.diff(values, prepend=np.uint64(0)))


def unpacked_codes(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpacked(data, "<u8", n), dtype=np.uint64)


# ---- trees ---------------------------------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)


def _small_kt() -> np.ndarray:
    half = np.array([math.lgamma(i + 0.5) for i in range(64)]) - math.lgamma(0.5)
    whole = np.array([math.lgamma(i + 1.0) for i in range(127)])
    at = np.arange(64)
    return half[:, None] + half[None, :] - whole[at[:, None] + at[None, :]]


_SMALL = _small_kt()


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a run with so many zeros and ones."""
    out = np.empty(zeros.shape)
    small = (zeros < 64) & (ones < 64)
    out[small] = _SMALL[zeros[small], ones[small]]
    z, o = zeros[~small], ones[~small]
    if len(z):
        # The series is exact to double precision from 64 on; below it each count has its own value.
        halves = [
            np.where(x < 64, _HALF[np.minimum(x, 63)], _log_gamma(np.maximum(x, 64) + 0.5) - math.lgamma(0.5)) for x in (z, o)
        ]
        out[~small] = halves[0] + halves[1] - _log_gamma(z + o + 1.0)
    return out


_HALF = np.array([math.lgamma(i + 0.5) for i in range(64)]) - math.lgamma(0.5)


def own_share(own: np.ndarray, under: np.ndarray) -> np.ndarray:
    """Share of the first in the sum of two probabilities given by their logs. It is never above one, as the
    difference of long logs can be."""
    return 1 / (1 + np.exp(np.minimum(under - own, 700.0)))


class Forest:
    """The trees of all contexts that end in the same bytes, from ``TOP`` + 1 bytes down to ``depth``, over
    sorted distinct codes and their counts."""

    def __init__(self, values: np.ndarray, counts: np.ndarray, depth: int):
        self.depth = depth
        # Per depth: codes of its contexts, their counts, and the place of each deeper code among them.
        self.tables = {depth: (values, counts, None)}
        for d in range(depth - 1, TOP, -1):
            keys, n, _ = self.tables[d + 1]
            shorter = (keys >> np.uint64(16) << np.uint64(8)) | (keys & np.uint64(255))
            order = np.argsort(shorter, kind="stable")
            ranked = shorter[order]
            head = _heads(ranked)
            place = np.empty(len(keys), np.int64)
            place[order] = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(ranked))))
            self.tables[d] = (ranked[head], np.add.reduceat(n[order], head), place)
        keys = self.tables[TOP + 1][0] >> np.uint64(16)
        self.pairs, self.pair_of = np.unique(keys, return_inverse=True)

    def _level(self, bit: int):
        """Per depth, the nodes that decide this bit: first codes, node of each code, KT log and estimate."""
        out = {}
        for d, (keys, n, _) in self.tables.items():
            prefix = keys >> np.uint64(8 - bit)
            first = _heads(prefix)
            node = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
            total = np.add.reduceat(n, first)
            ones = np.add.reduceat(np.where(keys >> np.uint64(7 - bit) & np.uint64(1), n, 0), first)
            out[d] = (first, node, log_kt(total - ones, ones), (ones + 0.5) / (total + 1.0))
        return out

    def _weighted(self, level):
        """Per depth, the nodes' weighted logs, the weight of stopping there and each node's parent."""
        log_w, stop, parent = {}, {}, {}
        for d in range(self.depth, TOP, -1):
            _, _, log_e, _ = level[d]
            if d == self.depth:
                log_w[d] = log_e
                continue
            parent[d + 1] = level[d][1][self.tables[d][2][level[d + 1][0]]]
            under = np.bincount(parent[d + 1], log_w[d + 1], len(log_e))
            log_w[d] = np.logaddexp(log_e, under) - LN2
            stop[d] = own_share(log_e, under)
        return log_w, stop, parent

    def _columns(self, level, bit: int) -> tuple[np.ndarray, np.ndarray]:
        """Pair and decision (0 to 254) of the nodes of the shortest contexts."""
        first = level[TOP + 1][0]
        prefix = (self.tables[TOP + 1][0][first] & np.uint64(255)).astype(np.int64) >> (8 - bit)
        return self.pair_of[first], (1 << bit) - 1 + prefix

    def left_for_top(self) -> tuple[np.ndarray, np.ndarray]:
        """Per pair of bytes: the sum of its contexts' weighted logs per decision, and byte counts."""
        under = np.zeros((len(self.pairs), 255))
        for bit in range(8):
            level = self._level(bit)
            log_w, _, _ = self._weighted(level)
            np.add.at(under, self._columns(level, bit), log_w[TOP + 1])
        keys, n, _ = self.tables[TOP + 1]
        counts = np.zeros((len(self.pairs), 256), np.int64)
        np.add.at(counts, (self.pair_of, (keys & np.uint64(255)).astype(np.int64)), n)
        return under, counts

    def logs(self, mass: np.ndarray, share: np.ndarray) -> np.ndarray:
        """log10 probability of each code's byte, given per pair and decision the probability of a one that
        the top has settled, and the share it leaves."""
        keys = self.tables[self.depth][0]
        out = np.zeros(len(keys))
        for bit in range(8):
            level = self._level(bit)
            stop, parent = self._weighted(level)[1:]
            at = self._columns(level, bit)
            settled, left = mass[at], share[at]
            for d in range(TOP + 1, self.depth + 1):
                if d > TOP + 1:
                    settled, left = settled[parent[d]], left[parent[d]]
                estimate = level[d][3]
                if d == self.depth:
                    settled = settled + left * estimate
                else:
                    settled, left = settled + left * stop[d] * estimate, left * (1 - stop[d])
            one = settled[level[self.depth][1]]
            out += np.log10(np.where(keys >> np.uint64(7 - bit) & np.uint64(1), one, 1 - one))
        return out


def decisions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of zeros and ones at each of the 255 decisions, from those of the 256 bytes (last axis)."""
    tree = np.zeros((len(counts), 512), np.int64)
    tree[:, 256:] = counts
    for p in range(255, 0, -1):
        tree[:, p] = tree[:, 2 * p] + tree[:, 2 * p + 1]
    return tree[:, 2::2], tree[:, 3::2]


def top_mixture(pairs: np.ndarray, under: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per pair and decision: the probability of a one settled by contexts of up to two bytes, and the
    share left to longer ones."""
    levels = []
    names = pairs
    for d in range(TOP, -1, -1):
        zeros, ones = decisions(counts)
        log_e = log_kt(zeros, ones)
        log_w = np.logaddexp(log_e, under) - LN2
        levels.append((own_share(log_e, under), (ones + 0.5) / (zeros + ones + 1.0), names))
        if d:
            names, place = np.unique(names >> np.uint64(8), return_inverse=True)
            under, counts = (
                np.array([np.bincount(place, column, len(names)) for column in table.T]).T for table in (log_w, counts)
            )
            counts = counts.astype(np.int64)
            levels[-1] = (*levels[-1], place)
    mass, share = np.zeros((1, 255)), np.ones((1, 255))
    for i, (stop, estimate, _, *place) in enumerate(reversed(levels)):
        if place:
            mass, share = mass[place[0]], share[place[0]]
        mass, share = mass + share * stop * estimate, share * (1 - stop)
    return mass, share


# ---- chunks and buckets --------------------------------------------------------------------------

_PIECE = pa.schema(
    [("kind", pa.int32()), ("chunk", pa.int64()), ("bucket", pa.int64()), ("size", pa.int64()), ("a", pa.binary()), ("b", pa.binary())]
)
_PIECE_TYPES = "kind int, chunk long, bucket long, size long, a binary, b binary"


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _pieces(rows) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(_PIECE)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECE)], schema=_PIECE)


def _spread(values: np.ndarray, depth: int, buckets: int) -> np.ndarray:
    shortest = values >> np.uint64(8 * (depth - TOP))
    mixed = shortest * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)


def chunk_pieces(chunk: int, ids: list, outs: list[bool], texts: list[bytes], depth: int, buckets: int):
    """A chunk's own row, and what it sends: codes and words by bucket."""
    import xxhash

    known = np.array([i is not None for i in ids])
    told = np.concatenate([np.array([i or 0 for i in ids], "<i8"), known.astype("<i8"), np.array(outs, "<i8")])
    body = bytes([END]).join(texts)
    blob = len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)
    yield _TEXTS, chunk, 0, len(ids), blob, packed(told)
    del body, blob
    train = ~np.array(outs, dtype=bool)
    values, counts = tally(texts, train, depth)
    bucket = _spread(values, depth, buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b, low, high in zip(range(buckets), cuts, cuts[1:]):
        if high > low:
            own = order[low:high]
            yield _CODES, chunk, b, int(high - low), packed_codes(values[own]), packed(counts[own])
    del values, counts, bucket, order
    words = [Counter(), Counter()]
    for text, out in zip(texts, outs):
        words[out].update(text.split())
        words[out][b""] += 1
    dealt: dict[int, list[bytes]] = {}
    for word in words[0].keys() | words[1].keys():
        dealt.setdefault(xxhash.xxh64_intdigest(word) % buckets, []).append(word)
    for b, own in dealt.items():
        counts = np.array([words[0][w] for w in own], "<i8")
        yield _WORDS, chunk, b, len(own), _told(own), packed(counts)


def _told(words: list[bytes]) -> bytes:
    body = b"\n".join(words)
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def _body(blob: bytes) -> bytes:
    size = int.from_bytes(blob[:8], "little")
    return pa.decompress(blob[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def bucket_codes(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes of a bucket and their counts, a bounded number of pieces at a time."""
    held, size = [], 0
    for n, a, b in zip(*(table.column(c) for c in ("size", "a", "b"))):
        n = n.as_py()
        held.append((unpacked_codes(a.as_py(), n), unpacked(b.as_py(), "<i8", n)))
        size += n
        if size > FOLD:
            held, size = [add_up(held)], 0
    return add_up(held)


def word_answers(table: pa.Table) -> pa.Table:
    """Each chunk's words with their training counts over all chunks; chunk -1 has in ``a`` the numbers of
    all training tokens and of distinct ones."""
    total: Counter = Counter()
    told = [
        (chunk, n, a, _body(a).split(b"\n"), unpacked(b, "<i8", n))
        for chunk, n, a, b in zip(*(table.column(c).to_pylist() for c in ("chunk", "size", "a", "b")))
    ]
    for _, _, _, words, counts in told:
        for word, n in zip(words, counts.tolist()):
            total[word] += n
    rows = [(_WORDS, chunk, 0, n, a, packed(np.array([total[w] for w in words], "<i8"))) for chunk, n, a, words, _ in told]
    sums = np.array([sum(total.values()), sum(n > 0 for n in total.values())], "<i8")
    rows.append((_WORDS, -1, 0, 2, sums.tobytes(), b""))
    return pa.Table.from_batches([_pieces(rows)])


def score_chunk(texts: list[bytes], values: np.ndarray, logs: np.ndarray, depth: int) -> np.ndarray:
    """Sum of the log probabilities of each text's bytes."""
    out = np.zeros(len(texts))
    for first, found, sizes in slices(texts, depth):
        own = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
        ranked = np.sort(found << np.uint64(8) | own)
        code, own = ranked >> np.uint64(8), (ranked & np.uint64(255)).astype(np.int64)
        head = _heads(code)
        at = np.searchsorted(values, code[head])
        each = np.repeat(logs[at], np.diff(np.append(head, len(code))))
        out[first : first + len(sizes)] += np.bincount(own, each, len(sizes))
    return out


def score(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` (log10 probability of the text and its end) and ``bits_per_byte``. Depths 3 to 6."""
    if not TOP < depth <= 6:
        raise ValueError("a context has three to six bytes")
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(MIN_BUCKETS, size // BUCKET)

    def read(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids, outs, texts, held = [], [], [], 0
        for batch in batches:
            for doc_id, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch)):
                text = text.lower().replace(b"\xff", b"\xfe")
                if texts and held + len(text) > CHUNK:
                    yield _pieces(list(chunk_pieces(number, ids, outs, texts, depth, buckets)))
                    number += 1
                    ids, outs, texts, held = [], [], [], 0
                ids.append(doc_id)
                outs.append(out)
                texts.append(text)
                held += len(text)
        if texts:
            yield _pieces(list(chunk_pieces(number, ids, outs, texts, depth, buckets)))

    pieces = stage(rows.mapInArrow(read, _PIECE_TYPES), "chunks", "kind").select(*_PIECE.names)
    kind = lambda k: pieces.where(F.col("kind") == k)

    def leave(table: pa.Table) -> pa.Table:
        forest = Forest(*bucket_codes(table), depth)
        under, counts = forest.left_for_top()
        found = [[p.tobytes() for p in table] for table in (under, counts)]
        return pa.table([pa.array(forest.pairs.astype(np.int64)), pa.array(found[0], pa.binary()), pa.array(found[1], pa.binary())], names=["pair", "under", "counts"])

    def join(table: pa.Table) -> pa.Table:
        under = sum(np.frombuffer(u) for u in sorted(table.column("under").to_pylist()))
        counts = sum(np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist())
        return pa.table([table.column("pair").slice(0, 1), pa.array([under.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary())], names=["pair", "under", "counts"])

    def weigh(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("pair").to_numpy())
        pairs = table.column("pair").to_numpy()[order].astype(np.uint64)
        under, counts = (
            np.array([np.frombuffer(x, t) for x in table.column(c).take(pa.array(order)).to_pylist()])
            for c, t in (("under", np.float64), ("counts", np.int64))
        )
        # As doubles: a bit that was one 20 million times would be certain as a 32-bit float.
        found = [[p.tobytes() for p in x] for x in top_mixture(pairs, under, counts)]
        return pa.table([pa.array(pairs.astype(np.int64)), pa.array(found[0], pa.binary()), pa.array(found[1], pa.binary())], names=["pair", "mass", "share"])

    pair = "pair long, under binary, counts binary"
    left = kind(_CODES).groupBy("bucket").applyInArrow(leave, pair).groupBy("pair").applyInArrow(join, pair)
    top = left.groupBy(F.lit(0).alias("all")).applyInArrow(weigh, "pair long, mass binary, share binary").toArrow()
    shared = spark.sparkContext.broadcast(
        tuple(
            np.frombuffer(b"".join(top.column(c).to_pylist())).reshape(-1, 255) if c != "pair" else top.column(c).to_numpy()
            for c in ("pair", "mass", "share")
        )
        if top.num_rows
        else None
    )

    def answer(table: pa.Table) -> pa.Table:
        values, counts = bucket_codes(table)
        forest = Forest(values, counts, depth)
        names, mass, share = shared.value
        at = np.searchsorted(names, forest.pairs.astype(np.int64))
        logs = forest.logs(mass[at], share[at]).astype("<f4")
        del forest
        out = []
        for chunk, n, a in zip(*(table.column(c) for c in ("chunk", "size", "a"))):
            n, a = n.as_py(), a.as_py()
            own = logs[np.searchsorted(values, unpacked_codes(a, n))]
            out.append((_CODES, chunk.as_py(), 0, n, a, packed(own)))
        return pa.Table.from_batches([_pieces(out)])

    words = stage(kind(_WORDS).groupBy("bucket").applyInArrow(word_answers, _PIECE_TYPES), "chunk-words")
    sums = words.where("chunk = -1").mapInArrow(_sums, "tokens long, distinct long")
    found = sums.agg(F.sum("tokens").alias("tokens"), F.sum("distinct").alias("distinct")).first()
    tokens, distinct = found["tokens"] or 0, found["distinct"] or 0

    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
            ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64()),
        ]
    )

    def finish(own: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        values, logs, known = [], [], {}
        for k, n, a, b in zip(*(answers.column(c) for c in ("kind", "size", "a", "b"))):
            n, a, b = n.as_py(), a.as_py(), b.as_py()
            if k.as_py() == _CODES:
                values.append(unpacked_codes(a, n))
                logs.append(unpacked(b, "<f4", n))
            else:
                known.update(zip(_body(a).split(b"\n"), unpacked(b, "<i8", n).tolist()))
        if values:
            values, logs = np.concatenate(values), np.concatenate(logs)
            order = np.argsort(values, kind="stable")
            values, logs = values[order], logs[order].astype(np.float64)
        log_of = {w: math.log10(n + 1) for w, n in known.items()}
        rate = math.log10(tokens + distinct + 1)
        for n, a, b in zip(*(own.column(c).to_pylist() for c in ("size", "a", "b"))):
            ids, valid, outs = unpacked(b, "<i8", 3 * n).reshape(3, n).tolist()
            texts = _body(a).split(bytes([END]))
            for i, text, total in zip(range(n), texts, score_chunk(texts, values, logs, depth).tolist()):
                said = text.split()
                said.append(b"")
                base = math.fsum(map(log_of.__getitem__, said)) - len(said) * rate
                rows.append(
                    (
                        ids[i] if valid[i] else None, bool(outs[i]), len(said), sum(n > 0 for n in map(known.__getitem__, said)), tokens,
                        base, total, -total * math.log2(10) / (len(text) + 1),
                    )
                )
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)

    answers = kind(_CODES).groupBy("bucket").applyInArrow(answer, _PIECE_TYPES).unionByName(words.where("chunk >= 0"))
    return (
        kind(_TEXTS)
        .groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(
            finish,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
            "score double, bits_per_byte double",
        )
    )


def weighted_with_base(scored: DataFrame) -> DataFrame:
    """``score`` becomes the log10 of the mean of the tree's and the base's probability, as a node weights its
    own estimate and its children; ``tree_score`` keeps the tree's own.

    The base takes all words that training lacks for one, while the tree spells them out, which costs it more
    the longer they are. A text's probability is at most that of its tokens so taken, so the mean never
    promises more than the two models together give those tokens; it is at least half of either one's."""
    low, high = F.least("base_score", "score"), F.greatest("base_score", "score")
    mean = high + F.log10((F.pow(F.lit(10.0), low - high) + 1) / 2)
    return scored.withColumns({"score": mean, "tree_score": F.col("score")})


def _sums(batches):
    for batch in batches:
        each = np.array([np.frombuffer(a, "<i8") for a in batch.column(batch.schema.get_field_index("a")).to_pylist()])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in each.reshape(-1, 2).T], names=["tokens", "distinct"])
