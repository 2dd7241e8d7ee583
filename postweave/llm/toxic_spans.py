"""Toxic spans: a linear-chain conditional random field tags words, and its marginals make document scores and offsets.

Each word is clean or toxic. A toxic word weighs the sum of its features (the word, its beginnings and its ending, all
hashed) and of entering or staying in a span; clean words weigh nothing. So the all-clean tagging has weight 1, and
with Z, the weight of all taggings, 1 - 1 / Z is the chance that a document has a toxic word.

Labels are of documents: words of clean ones are labelled clean, and of a toxic one that at least one word is toxic. Both
likelihoods and their gradients come from one forward and one backward pass. They are fitted on a bounded sample of
labelled rows: tasks sum gradients, sums meet by ranges of features, and the driver takes quasi-Newton steps. The fit starts
from how much more often toxic texts have a feature; features of few texts have no weight, so texts are not learnt by heart.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postweave.llm.batches import LOWER, mix, slabs, text_bytes, word_spans
from postweave.plans.storage import stored

# Weights of hashed features; entering and staying follow them.
SLOTS = 1 << 18
PREFIXES, SUFFIX = (3, 4, 5, 6, 7, 8), 3
FEATURES = len(PREFIXES) + 3
# Labelled rows of each kind that a fit takes at most, chosen by hashes of their ids.
SAMPLE = 4000
# A feature needs so many texts; the evidence of its texts is spread over the features of a word and starts this much stronger.
LEAST_TEXTS, EVIDENCE = 10, 3.0
# Weight of the squares of weights and of (stay - enter); steps, pairs that they remember, and the least relative gain of a step.
RIDGE, TIE, STEPS, MEMORY, GAIN = 1.0, 5.0, 40, 8, 1e-3
START = (-7.0, -7.0)
GREATEST = 25.0
LANE = 128
# Bytes of text whose words are in memory at once, with all their features.
SLAB = 1 << 19
PARTS, SLICES = 16, 8
FOLDS, HELD_OUT = 4, 2
THRESHOLD, SPAN = 0.3, 0.5

LETTERS = np.zeros(256, bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True


def _span_hashes(data: np.ndarray, spans: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """A polynomial hash of each span of bytes of each kind; the kinds do not share hashes."""
    base = np.full(len(data) + 1, 0x9E3779B97F4A7C15, np.uint64)
    inverse = np.full(len(data) + 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64)
    base[0] = inverse[0] = 1
    base, inverse = np.cumprod(base, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * base[:-1], out=sums[1:])
    return [mix((sums[b] - sums[a]) * inverse[a] + np.uint64((k + 1) * 0xD6E8FEB86659FD93 % 2**64)) for k, (a, b) in enumerate(spans)]


class Words:
    """The words of a text column: where each text's begin, their bytes and the slots of their features."""

    def __init__(self, column: pa.Array):
        data, bounds = text_bytes(column)
        self.starts, self.ends = word_spans(data, bounds, ~LETTERS)
        self.at = np.searchsorted(self.starts, bounds)
        low, a, b = LOWER[data], self.starts, self.ends
        capitals = np.concatenate([[0], np.cumsum(UPPER[data])])
        shape = np.minimum(capitals[b] - capitals[a], 2) * 3 + np.minimum(b - a, 3) - 1
        spans = [(a, b), *((a, np.minimum(a + k, b)) for k in PREFIXES), (np.maximum(b - SUFFIX, a), b)]
        slots = [h & np.uint64(SLOTS - 1) for h in _span_hashes(low, spans)] if len(a) else [a.astype(np.uint64)] * len(spans)
        slots.append(mix(shape.astype(np.uint64) + np.uint64(77)) & np.uint64(SLOTS - 1))
        self.slots = np.stack(slots, axis=1).astype(np.int32)
        self.data, self.bounds = data, bounds


def ratios(enter: np.ndarray, stay: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the weight of toxic over clean, of what precedes it and itself, and of what follows it.

    r' = (enter + r stay) / (1 + r) and q = (1 + stay q') / (1 + enter q'). Where a document begins, ``stay`` equals
    ``enter``, so nothing of its predecessor is left. The words are cut into lanes which advance together: first the
    product of the 2 x 2 matrices of each, then the values where lanes meet, then those within.
    """
    count = len(enter)
    lanes = -(-count // LANE)
    a, b = np.zeros((2, lanes * LANE))
    a[:count], b[:count] = enter, stay
    a, b = (np.ascontiguousarray(x.reshape(lanes, LANE).T) for x in (a, b))
    p, q, s, t = np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes)
    for k in range(LANE):
        p, q, s, t = b[k] * p + a[k] * s, b[k] * q + a[k] * t, p + s, q + t
        scale = 1 / (p + q + s + t)
        p, q, s, t = p * scale, q * scale, s * scale, t * scale
    before, after = np.zeros(lanes), np.ones(lanes)
    matrices = list(zip(p.tolist(), q.tolist(), s.tolist(), t.tolist()))
    r = 0.0
    for k, (p, q, s, t) in enumerate(matrices[:-1]):
        before[k + 1] = r = (p * r + q) / (s * r + t)
    r = 1.0
    for k in range(lanes - 1, 0, -1):
        p, q, s, t = matrices[k]
        after[k - 1] = r = (p * r + s) / (q * r + t)
    forward, backward = np.empty_like(a), np.empty_like(a)
    for k in range(LANE):
        before = forward[k] = (a[k] + before * b[k]) / (1 + before)
    for k in range(LANE - 1, -1, -1):
        backward[k] = after
        after = (1 + b[k] * after) / (1 + a[k] * after)
    return forward.T.ravel()[:count], backward.T.ravel()[:count]


def _per_text(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return sums[at[1:]] - sums[at[:-1]]


class Field:
    """The weights."""

    def __init__(self, weights: np.ndarray | None = None):
        self.weights = np.concatenate([np.zeros(SLOTS), START]) if weights is None else weights

    def passes(self, slots: np.ndarray, at: np.ndarray):
        """enter, stay, forward and backward ratios of all words, and log Z of each text."""
        word = self.weights[:-2][slots].sum(axis=1) if len(slots) else np.zeros(0)
        enter, stay = (np.exp(np.clip(word + w, -GREATEST, GREATEST)) for w in self.weights[-2:])
        first = at[:-1][at[1:] > at[:-1]]
        stay[first] = enter[first]
        forward, backward = ratios(enter, stay) if len(word) else (word, word)
        return enter, stay, forward, backward, _per_text(np.log1p(forward), at)

    def marginals(self, slots: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chance of each word, and of at least one word of each text, to be toxic."""
        _, _, forward, backward, z = self.passes(slots, at)
        both = forward * backward
        return both / (1 + both), -np.expm1(-z)

    def loss(self, slots: np.ndarray, at: np.ndarray, toxic: np.ndarray, share: np.ndarray) -> tuple[float, np.ndarray]:
        """The negative log-likelihood of labelled texts, each ``share`` times, and its gradient."""
        enter, stay, forward, backward, z = self.passes(slots, at)
        z = np.maximum(z, 1e-12)
        value = float((share * np.where(toxic, -np.log(-np.expm1(-z)), z)).sum())
        pull = np.repeat(share * np.where(toxic, -1 / np.expm1(np.minimum(z, 700)), 1.0), np.diff(at))
        both = forward * backward
        chance = pull * both / (1 + both)
        gradient = np.zeros(SLOTS + 2)
        if len(slots):
            gradient[:-2] = np.bincount(slots.ravel(), np.repeat(chance, slots.shape[1]), SLOTS)
        before = np.concatenate([[0.0], forward[:-1]])[: len(forward)]
        before[at[:-1][at[1:] > at[:-1]]] = 0
        total = 1 + enter * backward + before + before * stay * backward
        gradient[-2] = (pull * enter * backward / total).sum()
        gradient[-1] = (pull * before * stay * backward / total).sum()
        return value, gradient


def minimised(start: np.ndarray, loss, steps: int = STEPS, memory: int = MEMORY, gain: float = GAIN) -> np.ndarray:
    """Limited-memory BFGS steps, each halved until the loss falls."""
    x = start.copy()
    value, gradient = loss(x)
    pairs: deque = deque(maxlen=memory)
    for _ in range(steps):
        direction, kept = gradient.copy(), []
        for s, y in reversed(pairs):
            kept.append((s @ direction) / (s @ y))
            direction -= kept[-1] * y
        if pairs:
            s, y = pairs[-1]
            direction *= (s @ y) / (y @ y)
        else:
            direction /= max(1.0, np.abs(gradient).max())
        for (s, y), k in zip(pairs, reversed(kept)):
            direction += s * (k - (y @ direction) / (s @ y))
        slope, length = gradient @ direction, 1.0
        if slope <= 0:
            break
        while True:
            to = x - length * direction
            new, its = loss(to)
            if new <= value - 1e-4 * length * slope or length < 1e-6:
                break
            length /= 2
        if new >= value:
            break
        s, y = to - x, its - gradient
        if s @ y > 1e-12:
            pairs.append((s, y))
        done = value - new < gain * max(1.0, abs(new))
        x, value, gradient = to, new, its
        if done:
            break
    return x


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def sampled(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """(text, toxic, share): of each label ``limit`` rows by the order of their ids' hashes, with the texts of these ids.

    If ids occur often in ``docs``, about twice ``limit`` of their texts are drawn. ``share`` is the number of labelled rows
    that a text stands for.
    """
    total = {r.toxic: r["count"] for r in labels.groupBy("toxic").count().collect()}
    of_label = lambda values: F.when(F.col("toxic"), F.lit(values.get(True, 0.0))).otherwise(F.lit(values.get(False, 0.0)))
    first = [labels.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit) for k in (False, True)]
    chosen = stored(first[0].union(first[1]), "labels")
    rows = docs.join(F.broadcast(chosen), "doc_id")
    found = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    kept = {k: min(1.0, 2 * limit / n) for k, n in found.items()}
    share = {k: total[k] / (found[k] * kept[k]) for k in found}
    rows = rows.where(F.rand(0) < of_label(kept)).withColumn("share", of_label(share))
    return rows.select("text", "toxic", "share")


def _stored_words(rows: DataFrame) -> DataFrame:
    """(slots, sizes, toxic, share), a row for each slab of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, limit=SLAB):
            words = Words(batch.column("text"))
            blob = lambda x, kind: pa.array([np.ascontiguousarray(x, kind).tobytes()], pa.binary())
            flags = batch.column("toxic").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [blob(words.slots, np.int32), blob(np.diff(words.at), np.int64), blob(flags, np.int8), blob(batch.column("share").to_numpy(), np.float64)],
                names=["slots", "sizes", "toxic", "share"],
            )

    return rows.mapInArrow(run, "slots binary, sizes binary, toxic binary, share binary")


def _summed(words: DataFrame, size: int, vector) -> np.ndarray:
    """The sum over all rows of ``_stored_words`` of ``vector(slots, at, toxic, share)``, of ``size`` numbers; it meets by slices."""
    cut = -(-size // SLICES)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cut * SLICES)
        for batch in batches:
            for slots, sizes, toxic, share in zip(*(batch.column(k).to_pylist() for k in range(4))):
                at = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int64))])
                total[:size] += vector(np.frombuffer(slots, np.int32).reshape(-1, FEATURES), at, np.frombuffer(toxic, np.int8) == 1, np.frombuffer(share))
        sums = [total[k * cut : (k + 1) * cut].tobytes() for k in range(SLICES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(sums, pa.binary())], names=["slice", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b.as_py()) for b in group.column("sums"))
        return pa.table({"slice": group.column("slice")[:1], "sums": [total.tobytes()]})

    rows = words.mapInArrow(part, "slice int, sums binary").groupBy("slice").applyInArrow(add, "slice int, sums binary").collect()
    out = np.concatenate([np.zeros(0), *(np.frombuffer(r.sums) for r in sorted(rows, key=lambda r: r.slice))])
    return out[:size] if len(out) else np.zeros(size)


def _texts_of_slots(slots: np.ndarray, at: np.ndarray, toxic: np.ndarray, share: np.ndarray) -> np.ndarray:
    """For each slot the number of texts, the shares of toxic texts and those of clean ones; at the end these of all texts."""
    text = np.repeat(np.arange(len(toxic)), np.diff(at) * slots.shape[1])
    pairs = np.unique(text * SLOTS + slots.ravel())
    text, slot = pairs // SLOTS, pairs % SLOTS
    weights = (np.ones(len(toxic)), share * toxic, share * ~toxic)
    return np.concatenate([np.bincount(slot, w[text], SLOTS) for w in weights] + [[w.sum() for w in weights]])


def evidence(sums: np.ndarray, least: int = LEAST_TEXTS) -> tuple[np.ndarray, np.ndarray]:
    """From ``_texts_of_slots``: which slots have enough texts, and how much likelier they are in toxic ones (log, 0 at least)."""
    texts, toxic, clean = sums[:-3].reshape(3, SLOTS)
    used = texts >= least
    more = np.log((toxic + 0.5) / (clean + 2.5)) - np.log(max(sums[-2], 1e-9) / max(sums[-1], 1e-9))
    return used, np.where(used, np.maximum(more, 0), 0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, ridge: float = RIDGE, steps: int = STEPS, least_texts: int = LEAST_TEXTS) -> Field:
    """Fit on (doc_id, text) and (doc_id, toxic) rows; rows whose fold is HELD_OUT or null take no part.

    Without labels of both kinds the weights stay as they start, and no text is toxic.
    """
    learned = labels.where(F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    kinds = stored(sampled(docs, learned, sample).repartition(PARTS), "labelled")
    seen = kinds.agg(F.count_distinct("toxic")).first()[0]
    if seen < 2:
        return Field()
    words = stored(_stored_words(kinds), "label-words")
    used, more = evidence(_summed(words, 3 * SLOTS + 3, _texts_of_slots), least_texts)
    start = Field().weights
    start[:-2] = EVIDENCE * more / FEATURES
    used = np.append(used, [True, True])

    def loss(weights: np.ndarray) -> tuple[float, np.ndarray]:
        held = docs.sparkSession.sparkContext.broadcast(weights)
        sums = _summed(words, SLOTS + 3, lambda *texts: np.append(*Field(held.value).loss(*texts)[::-1]))
        held.unpersist()
        apart = TIE * (weights[-1] - weights[-2])
        prior = np.append(weights[:-2], [-apart, apart])
        value = sums[-1] + ridge / 2 * float(weights[:-2] @ weights[:-2] + apart * (weights[-1] - weights[-2]))
        return value, np.where(used, sums[:-1] + ridge * prior, 0)

    return Field(minimised(start, loss, steps))


SPANS = "array<struct<start:long,end:long,chance:double>>"


def toxic_spans(docs: DataFrame, field: Field, span: float = SPAN) -> DataFrame:
    """(doc_id, score, spans) of (doc_id, text): code points of runs of words that are likelier toxic than ``span``."""
    held = docs.sparkSession.sparkContext.broadcast(field.weights)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Field(held.value)
        for batch in slabs(batches, limit=SLAB):
            words = Words(batch.column("text"))
            chance, score = model.marginals(words.slots, words.at)
            row = np.repeat(np.arange(batch.num_rows), np.diff(words.at))
            hit = np.flatnonzero(chance >= span)
            new = np.ones(len(hit), bool)
            new[1:] = (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(hit)) - 1 if len(hit) else first
            points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
            zero = points[words.bounds[row[hit[first]]]]
            best = np.maximum.reduceat(chance[hit], first) if len(hit) else np.zeros(0)
            found = pa.StructArray.from_arrays(
                [pa.array(points[words.starts[hit[first]]] - zero), pa.array(points[words.ends[hit[last]]] - zero), pa.array(best)], ["start", "end", "chance"]
            )
            offsets = np.searchsorted(row[hit[first]], np.arange(batch.num_rows + 1)).astype(np.int32)
            spans = pa.ListArray.from_arrays(pa.array(offsets), found)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), spans], names=["doc_id", "score", "spans"])

    return docs.mapInArrow(run, f"doc_id {kind}, score double, spans {SPANS}")


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted, spans (code points from and to, and the greatest chance within).

    Only whole texts make a score; texts without words and null texts have 0. Null ids are scored, never trained on.
    Labels of one id that occur twice, or for several rows, count each time; null labels not at all.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marks = labels.select(F.col(doc_id).alias("doc_id"), (F.col(label) > 0).alias("toxic"))
    found = toxic_spans(plain, fit(plain, marks, sample))
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
