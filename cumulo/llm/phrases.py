"""Phrase collocations counted in HAT-tries.

Every task counts the windows of three words that start in its texts in one trie per language. Words have
ids of the task; the trie is shallow: near its root a node per first and per second word, below it hash
containers of the remaining windows. A container that grows too large bursts: words under which it
holds much get a container of their own, the rest stays mixed. When a task holds too many windows, it
spills its largest subtrees whole, as runs sorted by their words.

A run is dealt over partitions by the prefix of its windows: the first word and, as long as all words
so far are frequent ones, the next word too. No prefix can therefore hold more than about one part of the
windows, and the runs of one prefix meet in one group, where they are merged. A bigram's count is the sum
over its windows; bigrams of two frequent words lie in several groups and are added up afterwards.

The frequent words are those that occur more often than a partition's share of all words, so there are at
most as many as partitions. Only they are sent to the tasks. Word counts, scores, dropping and ranks
are joins and groups; scores are exact decimals.

Null texts are empty, a null language is ``und``. Repeated rows count each. Long texts are counted in
parts that overlap by two words. Ties are broken by the phrase. An empty table gives no rows; columns
besides the language and the text are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumulo.llm.common import stage, texts_of

BITS = 21
MASK = (1 << BITS) - 1
# Windows of one partition, on average.
SHARE = 1_000_000
# Entries of a container before it bursts, the part of them that earns a word a container of its own,
# and the depth to which containers burst.
BURST, OWN, DEEPEST = 1 << 16, 16, 2
# Distinct windows that a task holds, words that it counts or numbers, and bytes that it reads at a time.
HELD = 1_000_000
HELD_WORDS = 300_000
NUMBERED = 1 << 19
CHUNK = 1 << 20

# A-Z lower-cased; tab as blank; the ends of pieces as line ends.
_TABLE = bytearray(range(256))
_TABLE[65:91] = range(97, 123)
_TABLE[9] = 32
for _sign in b".,;:!?\n\v\f\r":
    _TABLE[_sign] = 10
_TABLE = bytes(_TABLE)
# Stands for the end of a piece among the words; UTF-8 never has this byte.
_END = b"\xff"


def parts_of(text: bytes, size: int = CHUNK):
    """The normalised text in parts of about ``size`` bytes that end between words."""
    text = text.translate(_TABLE)
    start = 0
    while len(text) - start > size:
        stop = max(text.rfind(b" ", start, start + size), text.rfind(b"\n", start, start + size))
        if stop < 0:
            ends = [p for p in (text.find(b" ", start), text.find(b"\n", start)) if p >= 0]
            stop = min(ends, default=len(text))
        yield text[start : stop + 1]
        start = stop + 1
    yield text[start:]


class HatTrie:
    """Counts of windows of three word ids, packed into whole numbers, under a shallow trie."""

    def __init__(self, depth: int = 0):
        self.depth = depth
        self.limit = BURST
        self.mixed: dict[int, int] = {}
        self.nodes: dict[int, HatTrie] = {}

    def __len__(self) -> int:
        return len(self.mixed) + sum(map(len, self.nodes.values()))

    def _words(self, codes: np.ndarray) -> np.ndarray:
        """The word that children are told apart by."""
        return (codes >> BITS * (2 - self.depth)) & MASK

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        """Count distinct windows, in order."""
        if self.nodes:
            words = self._words(codes)
            own = np.isin(words, np.fromiter(self.nodes, np.int64, len(self.nodes)))
            at = np.flatnonzero(own)
            if len(at):
                cuts = np.flatnonzero(np.diff(words[at], prepend=-1))
                for low, high in zip(cuts, np.append(cuts[1:], len(at))):
                    span = at[low:high]
                    self.nodes[int(words[span[0]])].add(codes[span], counts[span])
                codes, counts = codes[~own], counts[~own]
        mixed, get = self.mixed, self.mixed.get
        for code, n in zip(codes.tolist(), counts.tolist()):
            mixed[code] = get(code, 0) + n
        if len(mixed) > self.limit and self.depth < DEEPEST:
            self._burst()

    def _burst(self) -> None:
        codes = np.sort(np.fromiter(self.mixed, np.int64, len(self.mixed)))
        words = self._words(codes)
        cuts = np.flatnonzero(np.diff(words, prepend=-1))
        for low, high in zip(cuts, np.append(cuts[1:], len(codes))):
            if high - low > self.limit // OWN:
                node = self.nodes[int(words[low])] = HatTrie(self.depth + 1)
                node.mixed = {code: self.mixed.pop(code) for code in codes[low:high].tolist()}
        # Only many rare words are left: they stay together.
        if len(self.mixed) > self.limit // 2:
            self.limit *= 2

    def _items(self):
        yield self.mixed
        for node in self.nodes.values():
            yield from node._items()

    def take(self, enough: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Remove whole subtrees, the largest first, until ``enough`` windows are out (None: all)."""
        trees = sorted(((len(node), word) for word, node in self.nodes.items()), reverse=True)
        tables, out = [self.mixed], len(self.mixed)
        self.mixed, self.limit = {}, BURST
        for size, word in trees:
            if enough is not None and out >= enough:
                break
            tables += self.nodes.pop(word)._items()
            out += size
        codes = np.concatenate([np.fromiter(t.keys(), np.int64, len(t)) for t in tables])
        counts = np.concatenate([np.fromiter(t.values(), np.int64, len(t)) for t in tables])
        return codes, counts


class _Ids(dict):
    """Words numbered as they come; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({_END: 0})

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


_RUN = pa.schema(
    [("part", pa.int64()), ("lang", pa.string()), ("size", pa.int64())] + [(c, pa.binary()) for c in ("words", "first", "second", "third", "n")]
)
_RUN_TYPES = "part long, lang string, size long, words binary, first binary, second binary, third binary, n binary"


def _narrow(values: np.ndarray) -> bytes:
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _widened(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}").astype(np.int64)


class _Counting:
    """The trie of one language in one task, the ids of its words and the words not yet counted."""

    def __init__(self, lang: str):
        self.lang, self.ids, self.trie = lang, _Ids(), HatTrie()
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def read(self, text: bytes) -> None:
        for part in parts_of(text):
            words = part.replace(b"\n", b" \xff ").split()
            self.waiting.append(np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words)))
            self.size += len(words)
            yield
        self.waiting.append(np.zeros(2, np.int64))

    def count(self) -> None:
        """Put the waiting windows into the trie. The last two words wait on: more may follow."""
        ids = np.concatenate([*self.waiting, np.zeros(0, np.int64)])
        self.waiting, self.size = [ids[-2:]], 0
        first, second = ids[:-2], ids[1:-1]
        codes = (first << 2 * BITS | second << BITS | ids[2:])[(first > 0) & (second > 0)]
        codes, counts = np.unique(codes, return_counts=True)
        self.trie.add(codes, counts)

    def finish(self) -> None:
        self.waiting.append(np.zeros(2, np.int64))
        self.count()

    def renumber(self) -> None:
        """Start the ids anew, once nothing is held under the old ones; waiting words move over."""
        names = list(self.ids)
        self.ids = _Ids()
        self.waiting = [np.array([self.ids[names[i]] for i in w.tolist()], np.int64) for w in self.waiting]

    def runs(self, codes: np.ndarray, counts: np.ndarray, hot: set[tuple[str, bytes]], parts: int) -> pa.RecordBatch:
        """Sorted runs of these windows, one for each partition of prefixes."""
        import xxhash

        names = list(self.ids)
        ids = [(codes >> shift) & MASK for shift in (2 * BITS, BITS, 0)]
        used = np.unique(np.concatenate([*ids, np.zeros(1, np.int64)]))
        words = [names[i] for i in used.tolist()]
        words[0] = b""
        by_name = sorted(range(len(words)), key=words.__getitem__)
        words = [words[i] for i in by_name]
        rank = np.zeros(len(names), np.int64)
        rank[used[by_name]] = np.arange(len(words))
        ids = [rank[i] for i in ids]
        seed = self.lang.encode()
        hashes = np.array([xxhash.xxh64_intdigest(seed + b"\n" + w) for w in words], np.uint64)
        frequent = np.array([(self.lang, w) in hot for w in words])
        spread, deeper = hashes[ids[0]], frequent[ids[0]]
        for i in ids[1:]:
            further = (spread ^ hashes[i]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
            spread = np.where(deeper, further ^ (further >> np.uint64(29)), spread)
            deeper = deeper & frequent[i]
        part = (spread % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((ids[0] << 2 * BITS | ids[1] << BITS | ids[2], part))
        part, counts, ids = part[order], counts[order], [i[order] for i in ids]
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        rows = []
        for low, high in zip(cuts, np.append(cuts[1:], len(part))):
            own = np.unique(np.concatenate([i[low:high] for i in ids]))
            told = b"\n".join(words[i] for i in own.tolist())
            columns = [_narrow(np.searchsorted(own, i[low:high])) for i in ids]
            rows.append((int(part[low]), self.lang, int(high - low), told, *columns, _narrow(counts[low:high])))
        columns = zip(*rows) if rows else [()] * len(_RUN)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RUN)], schema=_RUN)


def _merge(blobs: list[dict]):
    """Words, sorted, and the runs' windows with their counts: three ids and n, sorted."""
    told = [b["words"].split(b"\n") for b in blobs]
    words = sorted(set().union(*told) | {b""})
    place = {w: i for i, w in enumerate(words)}
    columns: list[list[np.ndarray]] = [[], [], [], []]
    for blob, own in zip(blobs, told):
        at = np.array([place[w] for w in own], np.int64)
        size = blob["size"]
        for c, name in enumerate(("first", "second", "third")):
            columns[c].append(at[_widened(blob[name], size)])
        columns[3].append(_widened(blob["n"], size))
    first, second, third, n = (np.concatenate(c) for c in columns)
    order = np.lexsort((third, second, first))
    first, second, third, n = first[order], second[order], third[order], n[order]
    pair = (np.diff(first, prepend=-1) != 0) | (np.diff(second, prepend=-1) != 0)
    start = np.flatnonzero(pair | (np.diff(third, prepend=-1) != 0))
    return words, first[start], second[start], third[start], np.add.reduceat(n, start), pair[start]


def word_counts(rows: DataFrame) -> DataFrame:
    """``lang``, ``word`` (binary) and ``n`` of all words of ``lang``, ``text``."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])

    def sent(held):
        out = [(lang, word, n) for lang, words in held.items() for word, n in words.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    def count(batches):
        held: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                own = held.setdefault(lang, Counter())
                for part in parts_of(text):
                    own.update(part.split())
                    if sum(map(len, held.values())) > HELD_WORDS:
                        yield sent(held)
                        held = {}
                        own = held.setdefault(lang, Counter())
        if any(held.values()):
            yield sent(held)

    counted = rows.mapInArrow(count, "lang string, word binary, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def gram_counts(rows: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """``lang``, ``first``, ``second``, ``third`` (empty for pairs) and ``f`` of all pairs and triples of
    consecutive words of a piece that occur ``least`` times or more."""
    spark = rows.sparkSession
    total = words.agg(F.sum("n")).first()[0] or 0
    parts = max(1, total // SHARE)
    frequent = words.where(F.col("n") * parts > total).select("lang", "word").toArrow()
    shared = spark.sparkContext.broadcast(
        set(zip(frequent.column("lang").to_pylist(), frequent.column("word").to_pylist()))
    )

    def count(batches):
        hot, held = shared.value, {}

        def spill(enough: int | None):
            """Take that share of what is held out of each language's trie."""
            for own in held.values():
                wanted = None if enough is None else len(own.trie) // enough
                codes, counts = own.trie.take(wanted)
                if len(codes):
                    yield own.runs(codes, counts, hot, parts)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
                own = held.get(lang) or held.setdefault(lang, _Counting(lang))
                for _ in own.read(text):
                    if own.size > CHUNK // 2:
                        own.count()
                        if sum(len(o.trie) for o in held.values()) > HELD:
                            yield from spill(2)
                    if sum(len(o.ids) for o in held.values()) > NUMBERED:
                        for each in held.values():
                            each.count()
                        yield from spill(None)
                        for each in held.values():
                            each.renumber()
            for own in held.values():
                own.count()
            if sum(len(o.trie) for o in held.values()) > HELD:
                yield from spill(2)
        for own in held.values():
            own.finish()
        yield from spill(None)

    schema = pa.schema(
        [("lang", pa.string()), ("first", pa.binary()), ("second", pa.binary()), ("third", pa.binary()), ("f", pa.int64())]
    )

    def merge(table: pa.Table) -> pa.Table:
        hot, out = shared.value, []
        by_lang: dict[str, list[dict]] = {}
        for blob in table.to_pylist():
            by_lang.setdefault(blob["lang"], []).append(blob)
        for lang, blobs in by_lang.items():
            words, first, second, third, n, pair = _merge(blobs)
            frequent = np.array([(lang, w) in hot for w in words])
            names = pa.array(words, pa.binary())

            def told(first, second, third, f):
                columns = [names.take(pa.array(c)) for c in (first, second, third)]
                out.append(pa.table([pa.array([lang] * len(f), pa.string()), *columns, pa.array(f)], schema=schema))

            keep = (third > 0) & (n >= least)
            told(first[keep], second[keep], third[keep], n[keep])
            start = np.flatnonzero(pair)
            f, first, second = np.add.reduceat(n, start), first[start], second[start]
            keep = (f >= least) | (frequent[first] & frequent[second])
            told(first[keep], second[keep], np.zeros(keep.sum(), np.int64), f[keep])
        return pa.concat_tables(out)

    runs = rows.mapInArrow(count, _RUN_TYPES)
    merged = runs.groupBy("part").applyInArrow(merge, "lang string, first binary, second binary, third binary, f long")
    counted = merged.groupBy("lang", "first", "second", "third").agg(F.sum("f").alias("f"))
    return counted.where(F.col("f") >= least)


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), exact for counts below 10 to the power of 15."""
    big = [c.cast("decimal(15,0)") for c in (a, left, right)]
    top = (big[0] * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(22,0)") * big[0]
    return F.call_function("div", top.cast("decimal(38,0)"), big[1] * big[2])


def collocations(
    docs: DataFrame, least: int = 10, top: int = 2000, share: int = 50, unknown: str = "und"
) -> DataFrame:
    """The best phrases of two and three words of each language: ``lang``, ``rank``, ``phrase``, ``a``
    (its count), ``l`` and ``r`` (counts of the parts at the cut), ``n`` (words of the language), ``score``.

    Phrases occur ``least`` times or more. One inside a longer phrase that occurs ``share`` percent as often
    or more is left out. The cut of a phrase is the lowest-scoring, the first of equal ones."""
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(unknown)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    words = stage(word_counts(rows), "phrase-words")
    grams = stage(gram_counts(rows, words, least), "phrase-grams")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    single = words.where(F.col("n") >= least).select("lang", "word", F.col("n").alias("f"))
    pairs = grams.where(F.octet_length("third") == 0).select("lang", "first", "second", F.col("f").alias("a"))
    triples = grams.where(F.octet_length("third") > 0).select("lang", "first", "second", "third", F.col("f").alias("a"))

    def with_word(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.join(single.select("lang", F.col("word").alias(column), F.col("f").alias(name)), ["lang", column])

    def with_pair(df: DataFrame, first: str, second: str, name: str) -> DataFrame:
        own = pairs.select("lang", F.col("first").alias(first), F.col("second").alias(second), F.col("a").alias(name))
        return df.join(own, ["lang", first, second])

    inside = triples.select("lang", "first", "second", "a").union(triples.select("lang", "second", "third", "a"))
    inside = inside.groupBy("lang", "first", "second").agg(F.max("a").alias("longer"))
    two = with_word(with_word(pairs, "first", "l"), "second", "r").join(inside, ["lang", "first", "second"], "left")
    two = two.where(100 * F.coalesce("longer", F.lit(0)) < share * F.col("a"))
    two = two.select(
        "lang", F.concat_ws(" ", F.col("first").cast("string"), F.col("second").cast("string")).alias("phrase"), "a", "l", "r"
    ).withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))

    three = with_word(with_pair(triples, "second", "third", "r1"), "first", "l1")
    three = with_word(with_pair(three, "first", "second", "l2"), "third", "r2")
    cuts = [
        F.struct(score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
        for k in (1, 2)
    ]
    phrase = F.concat_ws(" ", *[F.col(c).cast("string") for c in ("first", "second", "third")])
    three = three.select("lang", phrase.alias("phrase"), "a", F.least(*cuts).alias("cut"))
    three = three.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
