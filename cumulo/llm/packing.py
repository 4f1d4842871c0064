"""Packing token pieces into sequences: Martello-Toth dominance reduction, then best fit.

Lengths are whole numbers up to the capacity, so an instance is a table of how many pieces have
each length: its size is bounded by the capacity, whatever the corpus. Only that table reaches the
driver. The plan it gives is a list of patterns (lengths and how often a sequence takes each) with
the number of sequences filled so; pieces find their place by their number among equal lengths.

Null text counts as empty; an empty document is one piece of its end token. Repeated rows are packed
once each. An empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import struct
from bisect import bisect_left, bisect_right, insort
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cumulo.llm.common import arrow_batches, free_names, numbered

CAPACITY = 1024
# Units whose ids a worker keeps at hand, characters of all of them together, and of one; beyond either total
# the store starts anew, and a longer unit is not kept.
KEPT_UNITS = 400_000
KEPT_CHARS = 8_000_000
LONGEST_KEPT = 64

Pattern = dict[int, int]
Plan = list[tuple[Pattern, int]]


# ---- planning on the table of lengths --------------------------------------------------------


class _Sizes:
    """Remaining counts by length, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.count = {s: n for s, n in counts.items() if n > 0}
        self.order = sorted(self.count)

    def take(self, pattern: Pattern, times: int) -> None:
        for size, k in pattern.items():
            self.count[size] -= k * times
            if not self.count[size]:
                del self.count[size]
                self.order.pop(bisect_left(self.order, size))

    def without(self, size: int) -> int:
        """How many of ``size`` are left besides one."""
        return self.count.get(size, 0) - 1

    def smallest_others(self, size: int, n: int) -> list[int]:
        """The ``n`` smallest pieces besides one of ``size``."""
        out: list[int] = []
        for s in self.order:
            out += [s] * min(n, self.count[s] - (s == size))
            if len(out) >= n:
                break
        return out[:n]

    def largest_other(self, size: int, room: int) -> int | None:
        for at in range(bisect_right(self.order, room) - 1, -1, -1):
            s = self.order[at]
            if self.count[s] - (s == size) > 0:
                return s
        return None

    def best_pair(self, size: int, room: int) -> tuple[int, int] | None:
        """The pair (larger, smaller) besides one of ``size`` with the largest sum within ``room``;
        of equal sums the one with the largest first part."""
        have = [s for s in self.order if self.count[s] - (s == size) > 0 and s <= room]
        best, low = None, 0
        for larger in reversed(have):
            while low < len(have) and have[low] + larger <= room:
                low += 1
            at = low - 1
            while at >= 0 and (have[at] > larger or have[at] == larger and self.count[larger] - (larger == size) < 2):
                at -= 1
            if at >= 0 and (best is None or larger + have[at] > sum(best)):
                best = (larger, have[at])
        return best


def _dominating(left: _Sizes, size: int, capacity: int) -> Pattern | None:
    """A set with one piece of ``size`` that dominates every other feasible set holding it."""
    room = capacity - size
    small = left.smallest_others(size, 3)
    if not small or small[0] > room:
        return {size: 1}
    one = left.largest_other(size, room)
    if one == room or len(small) < 2 or small[0] + small[1] > room:
        return dict(Counter([size, one]))
    if len(small) == 3 and sum(small) <= room:
        return None
    larger, smaller = left.best_pair(size, room)
    if one >= larger + smaller:
        return dict(Counter([size, one]))
    if one == larger:
        # Dominating if no two pieces that both exceed the smaller one fit together.
        above = [s for s in left.order[bisect_right(left.order, smaller) :] if left.count[s] - (s == size) > 0][:2]
        if above and left.count[above[0]] - (above[0] == size) > 1:
            above = [above[0]] * 2
        if len(above) < 2 or sum(above) > room:
            return dict(Counter([size, larger, smaller]))
    return None


def reduce_by_dominance(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[Plan, dict[int, int]]:
    """Fix dominating sets for good; returns them and the counts that stay open.

    A set found once is fixed as often as its pieces last: removing it takes away only pieces, and
    with fewer pieces it still dominates. Passes repeat while one of them shrinks the instance.
    """
    left, fixed, shrunk = _Sizes(counts), [], True
    while shrunk:
        shrunk = False
        for size in sorted(left.count, reverse=True):
            while size in left.count:
                pattern = _dominating(left, size, capacity)
                if pattern is None:
                    break
                times = min(left.count[s] // k for s, k in pattern.items())
                left.take(pattern, times)
                fixed.append((pattern, times))
                shrunk = True
    return fixed, left.count


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best fit of the lengths in falling order, whole groups of equal sequences at a time."""
    open_bins: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)
    gaps: list[int] = []

    def put(gap: int, pattern: Pattern, times: int) -> None:
        if gap not in open_bins or not open_bins[gap]:
            insort(gaps, gap)
        open_bins[gap].append((pattern, times))

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect_left(gaps, size)
            if at == len(gaps):
                pattern, times, gap = {}, max(1, n // (capacity // size)), capacity
            else:
                gap = gaps[at]
                pattern, times = open_bins[gap].pop()
                if not open_bins[gap]:
                    gaps.pop(at)
            fit = min(gap // size, n)
            filled = min(times, n // fit)
            if filled < times and pattern:
                put(gap, pattern, times - filled)
            put(gap - fit * size, pattern | {size: pattern.get(size, 0) + fit}, filled)
            n -= filled * fit
    return [group for gap in open_bins for group in open_bins[gap]]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    fixed, rest = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def slots(packing: Plan) -> list[tuple[int, int, int, int, int, int]]:
    """Per length and pattern: length, first piece number, number of pieces, pieces per sequence,
    first sequence, offset of the first piece in the sequence."""
    out, used, sequence = [], Counter(), 0
    for pattern, times in packing:
        offset = 0
        for size in sorted(pattern, reverse=True):
            k = pattern[size]
            out.append((size, used[size], k * times, k, sequence, offset))
            used[size] += k * times
            offset += k * size
        sequence += times
    return out


# ---- tokens ------------------------------------------------------------------------------------

# A token always starts at a blank between two characters that are not blank; without double blanks, at
# every blank.
_BLANKS = re.compile(r"\s\s|\0")
_UNIT = re.compile(r"(?<=\S)(?= \S)")


def added_tokens(tokenizer_json: str) -> dict[str, int]:
    """Tokens that stand for themselves wherever a text has them, whatever surrounds them."""
    return {t["content"]: t["id"] for t in json.loads(tokenizer_json).get("added_tokens", [])}


def byte_ranks(tokenizer_json: str) -> dict[bytes, int]:
    """Byte strings of a byte-level BPE file's vocabulary, without its added tokens."""
    content = json.loads(tokenizer_json)
    added = added_tokens(tokenizer_json)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
    return {bytes(letters[c] for c in t): i for t, i in content["model"]["vocab"].items() if t not in added}


class Units(dict):
    """Ids of texts, put together from those of the units between places where a token must start: at a
    blank, and at and after a line end. The words of a corpus repeat, so the ids of short units are kept."""

    def __init__(self, words: str, ranks: dict[bytes, int], added: dict[str, int] | None = None):
        import tiktoken

        super().__init__()
        self.coder = tiktoken.Encoding("ranks", pat_str=words, mergeable_ranks=ranks, special_tokens={})
        self.added = {t: struct.pack("<I", i) for t, i in (added or {}).items()}
        # Longer tokens first, as the longest one that fits is taken.
        names = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.chars = 0

    def __missing__(self, unit: str) -> bytes:
        found = self.coder.encode_ordinary(unit)
        ids = struct.pack(f"<{len(found)}I", *found)
        if len(unit) <= LONGEST_KEPT:
            self[unit] = ids
            self.chars += len(unit)
        return ids

    def encode(self, text: str) -> bytes:
        if self.marks and self.marks.search(text):
            parts = self.marks.split(text)
            return b"".join(self.added[p] if i % 2 else self._plain(p) for i, p in enumerate(parts) if p)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if len(self) > KEPT_UNITS or self.chars > KEPT_CHARS:
            self.clear()
            self.chars = 0
        if _BLANKS.search(text):
            units = _UNIT.split(text)
        else:
            units = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        return b"".join(map(self.__getitem__, units))


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every document: ``doc_id``, ``piece``, ``start``,
    ``length`` and ``ids`` (little-endian unsigned 32-bit). Only longer documents are cut; their
    first piece is the short one.

    The vocabulary file is broadcast. Ids of units between single blanks are kept in each task,
    since the words of a corpus repeat; such a blank always begins a token, so units can be encoded
    apart.
    """
    import public_tokenizers

    with open(tokenizer_path, encoding="utf-8") as file:
        content = file.read()
    ranks, added = byte_ranks(content), added_tokens(content)
    # A worker keeps a broadcast value for all its tasks, and in it the coder and the ids met so far.
    shared = docs.sparkSession.sparkContext.broadcast((public_tokenizers.PATTERN, ranks, added, []))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
    )
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        words, table, marks, made = shared.value
        if not made:
            made.append(Units(words, table, marks))
        units = made[0]

        def rows(batch):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = units.encode(text or "") + end
                n = len(ids) // 4
                first = n % capacity or capacity if n > capacity else n
                start, piece = 0, 0
                while start < n:
                    stop = start + (first if not piece else capacity)
                    yield doc_id, piece, start, stop - start, ids[4 * start : 4 * stop]
                    start, piece = stop, piece + 1

        yield from arrow_batches(schema, rows, 512)(batches)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


# ---- placing -----------------------------------------------------------------------------------


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` from 1 to ``capacity``; columns of
    these names are replaced.

    The places of one length are an array sorted by first piece number. There are as many arrays
    as lengths, and as many places as the plan has patterns: both bounded by the capacity, so
    the table of them is broadcast.
    """
    spark = pieces.sparkSession
    # Columns that are named like the result's give way to it.
    pieces = pieces.drop("sequence_id", "offset")
    number, spotted = free_names(pieces, "number", "_spot")
    ranked, lengths = numbered(pieces, ["length"], number)
    counts = {r["length"]: r["n"] for r in lengths.collect()}
    if any(not 1 <= size <= capacity for size in counts):
        raise ValueError("lengths must be from 1 to the capacity")
    by_size: dict[int, list[tuple]] = defaultdict(list)
    for size, first, n, per, sequence, offset in slots(plan(counts, capacity)):
        by_size[size].append((first, n, per, sequence, offset))
    table = spark.sparkContext.broadcast({s: np.array(sorted(v), dtype=np.int64) for s, v in by_size.items()})

    @F.pandas_udf(T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
    def spot(length, number):
        import pandas as pd

        size, rank = length.to_numpy(), number.to_numpy()
        sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        for s in np.unique(size).tolist():
            at = np.flatnonzero(size == s)
            first, _, per, base, start = table.value[s].T
            group = np.searchsorted(first, rank[at], side="right") - 1
            inside = rank[at] - first[group]
            sequence[at] = base[group] + inside // per[group]
            offset[at] = start[group] + inside % per[group] * s
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = ranked.withColumn(spotted, spot("length", number))
    return placed.select(*pieces.columns, f"{spotted}.sequence_id", f"{spotted}.offset")


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The filled sequences: ``sequence_id`` and the ``ids`` of its pieces in order. A sequence has
    at most as many pieces as tokens."""
    at = placed.select("doc_id", "piece", "start", "sequence_id", "offset")
    joined = pieces.select("doc_id", "piece", "start", "ids").join(at, ["doc_id", "piece", "start"])
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return joined.groupBy("sequence_id").agg(F.unhex(F.array_join(F.transform(parts, lambda p: p["ids"]), "")).alias("ids"))
