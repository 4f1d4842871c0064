"""Weak-label quality model: heuristic labellers, expectation-maximisation, hashed linear scorer.

Overlapping labellers vote that a text is bad, good, or abstain, for two kinds of bad texts: junk and
abuse. What they say is counted over all documents; there are at most 3 to the power of the labellers
vote patterns, and only their counts reach the driver. For each kind, expectation-maximisation
estimates from them how each labeller votes on good and on bad texts, and so each pattern's posterior.
Given labels, where there are any, are one more labeller, whose abstention says nothing.

Posterior labels (bad in either way) of at most ``SAMPLE`` documents, labelled ones if there are any,
train the scorer, a logistic model on hashed words, word beginnings, trailing signs, the share of
repeated words and the votes. At most ``FEATURES`` weights are kept and broadcast. Every document is then scored by
its whole text.

The sample is those documents whose ids have the smallest hashes, so it does not depend on the order of
tasks. Of rows that repeat an id it takes the least text.

Null and blank texts are voted on like any other and score by the prior alone, very long ones are read
whole. Rows without an id are scored but not sampled; repeated rows are scored each. Several labels of one
document count as bad if one of them is. Without any labels the heuristics alone decide; an empty table gives
no rows. Columns named like the results are replaced.
"""

from __future__ import annotations

import operator
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.llm.common import texts_of

SAMPLE = 8_192
FEATURES = 65_536
# Stands for the bias among the features' hashes, which are not negative.
BIAS = -1
# Sampled documents that must show a feature.
SEEN = 3
# Words whose weights a task keeps at hand, beyond which the store starts anew, and bytes of a word that is kept.
KEPT_WORDS = 200_000
LONGEST_KEPT = 64
THRESHOLD = 0.5
# Belief about a given label on bad and on good texts (bad, none, good), as weighty as all given labels.
GIVEN = ((0.999, 0.0, 0.001), (0.001, 0.0, 0.999))
# Places of the labellers of each kind in a pattern; the last of each is the given label.
JUNK, ABUSE = (0, 1, 2, 3, 4, 5, 7), (6, 8)

# Fixed list: plain insults that the lexicon labeller knows.
INSULTS = frozenset(
    b"idiot stupid moron loser pathetic worthless disgusting trash scum clown imbecile".split()
)
_SIGN = re.compile(rb"[*#$%&]{2,}(?=\s|$)")
_TAIL = re.compile(rb"[^\w\x80-\xff]+$")
_PLAIN = re.compile(rb"(?<!\S)[A-Za-z\x80-\xff]+[.,;:?!]?(?!\S)")


def votes(text: bytes | None, words: list[bytes]) -> str:
    """One character per labeller: b bad, g good, - abstains."""
    n = max(1, len(words))
    text = text or b""
    signs = len(_SIGN.findall(text)) / n
    shouts = text.count(b"!!") / n
    bars = text.count(b" | ") / n
    repeats = sum(map(operator.eq, words, words[1:])) / n
    variety = len(set(words)) / n
    plain = len(_PLAIN.findall(text)) / n
    insults = not INSULTS.isdisjoint(w.strip(b".,;:?!") for w in set(text.lower().split()))
    said = (
        "b" if signs > 0.1 else "-",
        "b" if shouts > 0.1 else "-",
        "b" if bars > 0.1 else "-",
        "b" if repeats > 0.15 else "g" if repeats < 0.05 else "-",
        "b" if variety < 0.15 and n > 50 else "g" if variety > 0.35 else "-",
        "g" if plain > 0.9 else "b" if plain < 0.6 else "-",
        "b" if insults else "-",
    )
    return "".join(said)


def word_features(word: bytes) -> list[int]:
    """Hashes of the word, its beginning and its trailing signs."""
    import xxhash

    word = word.lower()
    tail = _TAIL.search(word)
    stem = word[: tail.start()] if tail else word
    out = [b"w" + stem, b"b" + stem[:5]]
    if len(word) - len(stem) > 1 or not stem:
        out.append(b"t" + word[len(stem) :])
    return [xxhash.xxh64_intdigest(f) >> 1 for f in out]


def text_features(words: list[bytes], said: str) -> list[int]:
    """Hashes of the share of repeated words and of what the labellers said."""
    import xxhash

    share = sum(map(operator.eq, words, words[1:])) / max(1, len(words))
    told = [b"v%d" % i + c.encode() for i, c in enumerate(said) if c != "-"]
    return [xxhash.xxh64_intdigest(f) >> 1 for f in [b"r%d" % min(9, int(share * 20)), *told]]


def estimate(patterns: Counter, rounds: int = 60) -> dict[str, float]:
    """Posterior of bad per pattern of one kind; the last character is the given label."""
    names = sorted(patterns)
    if not names:
        return {}
    n = np.array([patterns[p] for p in names], dtype=float)
    said = np.array([["b-g".index(c) for c in p] for p in names])
    heard = np.ones(said.shape, dtype=bool)
    heard[:, -1] = said[:, -1] != 1
    weight = np.where(heard, 1 - said, 0)
    weight[:, -1] *= 4
    bad = 1 / (1 + np.exp(-1.5 * weight.sum(axis=1) + 0.5))
    for _ in range(rounds):
        log_odds = np.zeros(len(names))
        prior = (n @ bad + 1) / (n.sum() + 2)
        log_odds += np.log(prior / (1 - prior))
        for l in range(said.shape[1]):
            use = heard[:, l]
            on = [np.bincount(said[use, l], n[use] * w[use], 3) + 1.0 for w in (bad, 1 - bad)]
            if l == said.shape[1] - 1:
                on = [x + n[use].sum() * np.array(belief) for x, belief in zip(on, GIVEN)]
            rates = [x / x.sum() for x in on]
            log_odds[use] += np.log(rates[0][said[use, l]] / rates[1][said[use, l]])
        bad = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return dict(zip(names, bad.tolist()))


def posteriors(counts: dict[str, int]) -> dict[str, float]:
    """Probability of bad in either way per whole pattern."""
    good = dict.fromkeys(counts, 1.0)
    for places in (JUNK, ABUSE):
        own: Counter = Counter()
        for pattern, n in counts.items():
            own["".join(pattern[i] for i in places)] += n
        bad = estimate(own)
        for pattern in counts:
            good[pattern] *= 1 - bad["".join(pattern[i] for i in places)]
    return {pattern: 1 - g for pattern, g in good.items()}


def fit(features: list[np.ndarray], bad: np.ndarray, rounds: int = 200) -> tuple[dict[int, float], float]:
    """Weights and bias of the logistic model. A feature's value is its log ratio between the classes,
    so features that tell nothing weigh nothing."""
    flat = np.concatenate(features)
    rows = np.repeat(np.arange(len(features), dtype=np.int32), [len(f) for f in features])
    known, place = _unique(flat)
    in_bad, in_all = np.bincount(place, bad[rows], len(known)), np.bincount(place, minlength=len(known))
    ratio = np.log((in_bad + 0.1) / (bad.sum() + 0.2)) - np.log((in_all - in_bad + 0.1) / ((1 - bad).sum() + 0.2))
    strength = np.abs(ratio) * np.sqrt(in_all)
    strength[in_all < SEEN] = 0
    kept = np.sort(np.argsort(-strength, kind="stable")[:FEATURES])
    kept = kept[strength[kept] > 0]
    at = np.full(len(known), -1)
    at[kept] = np.arange(len(kept))
    use = at[place] >= 0
    rows, place, ratio = rows[use], at[place[use]], ratio[kept]
    weights, bias = np.full(len(kept), 0.5), float(np.log((bad.sum() + 1) / ((1 - bad).sum() + 1)))
    speed, pace = np.zeros(len(kept)), 0.0
    for _ in range(rounds):
        z = np.bincount(rows, (weights * ratio)[place], len(bad)) + bias
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - bad
        slope = np.bincount(place, error[rows], len(kept)) * ratio / len(bad) + 1e-5 * weights
        speed += slope**2
        pace += error.mean() ** 2
        weights -= 0.2 * slope / (np.sqrt(speed) + 1e-8)
        bias -= 0.2 * error.mean() / (np.sqrt(pace) + 1e-8)
    return dict(zip(known[kept].tolist(), (weights * ratio).tolist())), float(bias)


def _unique(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    place = np.empty(len(values), dtype=np.int32)
    place[order] = np.cumsum(new) - 1
    return ranked[new], place


def train(docs: DataFrame, labels: DataFrame) -> tuple[dict[int, float], float]:
    """The scorer's weights and bias for these documents."""
    given = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic")
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def vote(batches):
        for batch in batches:
            said = [votes(t, t.split() if t else []) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string())], names=["doc_id", "said"])

    def said(column: str, bad: int):
        return F.when(F.col(column) == bad, "b").when(F.col(column) == 1 - bad, "g").otherwise("-")

    pattern = F.concat("said", said("quality", 0), said("toxic", 1)).alias("pattern")
    voted = rows.mapInArrow(vote, "doc_id long, said string").join(given, "doc_id", "left")
    counts = {r["pattern"]: r["count"] for r in voted.groupBy(pattern).count().collect()}
    posterior = posteriors(counts)

    # The documents with the smallest hashes, labelled ones if there are any: the same on every run.
    pool = given if given.limit(1).count() else rows.select("doc_id", F.lit(None).cast("int").alias("quality"), F.lit(None).cast("int").alias("toxic"))
    pool = pool.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    chosen = pool.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # One row per document, however often its id repeats: at most SAMPLE rows go on.
    sample = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality", "toxic").agg(F.min("text").alias("text"))

    def look(batches):
        for batch in batches:
            said, seen = [], []
            for text in texts_of(batch):
                words = text.split() if text else []
                found = {h for w in set(words) for h in word_features(w)}
                said.append(votes(text, words))
                seen.append([*found, *text_features(words, said[-1])])
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["quality", "toxic"]).columns, pa.array(said, pa.string()), pa.array(seen, pa.list_(pa.int64()))],
                names=["quality", "toxic", "said", "seen"],
            )

    looked = sample.select("text", F.col("quality").cast("int"), F.col("toxic").cast("int"))
    looked = looked.mapInArrow(look, "quality int, toxic int, said string, seen array<long>")
    learned = pa.schema([("feature", pa.int64()), ("weight", pa.float64())])

    def learn(table: pa.Table) -> pa.Table:
        seen = table.column("seen").combine_chunks()
        flat, cuts = seen.values.to_numpy(), seen.offsets.to_numpy()
        bad = np.array([posterior[p] for p in table.column("pattern").to_pylist()])
        weights, bias = fit([flat[a:z] for a, z in zip(cuts, cuts[1:])], bad)
        return pa.table([[BIAS, *weights], [bias, *weights.values()]], schema=learned)

    # The sample is bounded, so one task fits the scorer; the driver only hands on its weights.
    found = looked.select("seen", pattern).groupBy(F.lit(0).alias("all")).applyInArrow(learn, "feature long, weight double")
    table = found.toArrow()
    weights = dict(zip(table.column("feature").to_pylist(), table.column("weight").to_pylist()))
    return weights, weights.pop(BIAS, -3.0)


def score(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """Add ``bad``, the scorer's probability, and ``kept``; the other columns stay."""
    weights, bias = train(docs.select("doc_id", F.col(text).alias("text")), labels)
    shared = docs.sparkSession.sparkContext.broadcast((weights, bias))
    columns = [c for c in docs.columns if c not in ("bad", "kept")]
    schema = docs.select(*columns, F.lit(0.0).alias("bad"), F.lit(True).alias("kept")).schema

    def run(batches):
        known, base = shared.value
        store: dict[bytes, tuple[tuple[int, float], ...]] = {}
        for batch in batches:
            bad = []
            for value in texts_of(batch, text):
                words = value.split() if value else []
                found: dict[int, float] = {}
                if len(store) > KEPT_WORDS:
                    store.clear()
                for word in set(words):
                    own = store.get(word)
                    if own is None:
                        own = tuple((h, known[h]) for h in word_features(word) if h in known)
                        if len(word) <= LONGEST_KEPT:
                            store[word] = own
                    if own:
                        found.update(own)
                own = text_features(words, votes(value, words))
                z = base + sum(found.values()) + sum(known.get(f, 0.0) for f in own)
                bad.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
            out = batch.select(columns)
            flags = pa.array([b < THRESHOLD for b in bad], pa.bool_())
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(bad, pa.float64()), flags], names=[*columns, "bad", "kept"])

    return docs.mapInArrow(run, schema)
