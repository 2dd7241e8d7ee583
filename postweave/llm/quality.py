"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

1. One pass over the texts makes some twenty statistics of each document, stored as a narrow table.
2. Standardised statistics x become z = sqrt(2 / D) cos(W x + b), whose inner products approximate a Gaussian kernel.
   Tasks sum the normal equations Z'Z and Z'y of the labelled rows; sums are added in two steps, so
   the driver gets at most SUMS matrices of D x D, whatever the number of tasks.
3. Ridge scores of labelled rows that had no part in the fit are counted by value bins, and a monotone step
   function fitted to them by pooling adjacent violators makes probabilities of scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postweave.llm.batches import LOWER, SPACES, hash_spans, slabs, text_bytes, window_hashes, word_spans
from postweave.plans.storage import stored

FEATURES = 256
# Width of the kernel in deviations of the statistics, and weight of the ridge for each row.
WIDTH, RIDGE = 4.0, 1e-4
CLIP = 5.0
SUMS = 16
# Bins of a ridge score, from LOW to HIGH.
BINS, LOW, HIGH = 2000, -0.5, 1.5
# Share of the ridge score in the result: orders documents whose calibrated values are equal.
TIE = 1e-3
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4
THRESHOLD = 0.3

STATISTICS = (
    "log_words word_bytes punctuation symbols exclamations bars upper digits wide capitalised short_words sentence_ends"
    " log_line_words ended_lines repeated_lines distinct_words adjacent_words commonest_word distinct_pairs distinct_fours"
).split()


def _table(chars) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[c if isinstance(c, int) else ord(c) for c in chars]] = True
    return out


CLASSES = {
    "punctuation": _table(c for c in range(0x21, 0x7F) if not chr(c).isalnum()),
    "symbols": _table("#*$%&<>^~\\"),
    "exclamations": _table("!"),
    "bars": _table("|"),
    "upper": _table(range(65, 91)),
    "digits": _table(range(48, 58)),
    "wide": _table(range(128, 256)),
}
ENDS = _table(".!?:;\"')")


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(np.float64)


def _distinct(ordered: np.ndarray) -> int:
    return int((ordered[1:] != ordered[:-1]).sum()) + 1 if len(ordered) else 0


def statistics(column: pa.Array) -> np.ndarray:
    """STATISTICS of each text; those of a text without words are all 0."""
    data, bounds = text_bytes(column)
    starts, ends = word_spans(data, bounds)
    words = hash_spans(LOWER[data], starts, ends) if len(starts) else np.zeros(0, np.uint64)
    at = np.searchsorted(starts, bounds)
    count = np.diff(at).astype(np.float64)
    some = np.maximum(count, 1)
    letters = np.maximum(_per_row(~SPACES[data], bounds), 1)
    out = {name: _per_row(flags[data], bounds) / letters for name, flags in CLASSES.items()}
    out["log_words"] = np.log1p(count)
    out["word_bytes"] = letters / some
    out["capitalised"] = _per_row(CLASSES["upper"][data[starts]], at) / some
    out["short_words"] = _per_row(ends - starts <= 3, at) / some
    last = data[ends - 1]
    out["sentence_ends"] = _per_row(ENDS[last], at) / some
    lines_at, line_ends = word_spans(data, bounds, _table([10]))
    line_rows = np.searchsorted(lines_at, bounds)
    lines = np.maximum(np.diff(line_rows), 1)
    line_hash = hash_spans(data, lines_at, line_ends) if len(lines_at) else words[:0]
    out["log_line_words"] = np.log1p(count / lines)
    out["ended_lines"] = _per_row(ENDS[data[line_ends - 1]], line_rows) / lines
    pairs, fours = window_hashes(words, 2), window_hashes(words, 4)
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    out["adjacent_words"] = _per_row(same, at) / some
    rest = {name: np.zeros(len(count)) for name in ("repeated_lines", "distinct_words", "commonest_word", "distinct_pairs", "distinct_fours")}
    for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        if a == b:
            continue
        own = np.sort(words[a:b])
        changes = np.flatnonzero(own[1:] != own[:-1])
        rest["distinct_words"][k] = (len(changes) + 1) / (b - a)
        rest["commonest_word"][k] = np.diff(np.concatenate([[-1], changes, [b - a - 1]])).max() / (b - a)
        for name, windows, width in (("distinct_pairs", pairs, 2), ("distinct_fours", fours, 4)):
            rest[name][k] = _distinct(np.sort(windows[a : b - width + 1])) / (b - a - width + 1) if b - a >= width else 1.0
        own_lines = line_hash[line_rows[k] : line_rows[k + 1]]
        rest["repeated_lines"][k] = 1 - _distinct(np.sort(own_lines)) / max(1, len(own_lines))
    out |= rest
    found = np.stack([out[name] for name in STATISTICS], axis=1)
    found[count == 0] = 0
    return found


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics) of (doc_id, text)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            found = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c) for c in found.T)], names=["doc_id", *STATISTICS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(measure, f"doc_id {kind}, " + ", ".join(f"{s} double" for s in STATISTICS))


class Model:
    """Fourier features, ridge weights and calibration. Without labels every score is one half."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, seed: int = 0, features: int = FEATURES):
        rng = np.random.default_rng(seed)
        self.mean, self.deviation = mean, np.where(deviation > 1e-9, deviation, 1)
        self.directions = rng.standard_normal((len(mean), features)) / WIDTH
        self.phases = rng.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.values, self.chances = np.array([0.5]), np.array([0.5])

    def features(self, found: np.ndarray) -> np.ndarray:
        x = np.clip((found - self.mean) / self.deviation, -CLIP, CLIP)
        z = np.sqrt(2 / len(self.phases)) * np.cos(x @ self.directions + self.phases)
        return np.hstack([z, np.ones((len(z), 1))])

    def ridge(self, found: np.ndarray) -> np.ndarray:
        return np.clip(self.features(found) @ self.weights, LOW, HIGH)

    def score(self, found: np.ndarray) -> np.ndarray:
        raw = self.ridge(found)
        return (1 - TIE) * np.interp(raw, self.values, self.chances) + TIE * (raw - LOW) / (HIGH - LOW)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def normal_equations(labelled: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, int]:
    """Z'Z, Z'y and the number of rows of (statistics, label)."""
    size = len(model.weights)

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            z = np.hstack([model.features(batch[list(STATISTICS)].to_numpy()), batch[["label"]].to_numpy(np.float64)])
            total += z.T @ z
        yield pd.DataFrame({"bucket": [TaskContext.get().partitionId() % SUMS], "total": [total.tobytes()]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(t) for t in group["total"])
        return pd.DataFrame({"total": [total.tobytes()]})

    parts = labelled.mapInPandas(part, "bucket int, total binary")
    sums = parts.groupBy("bucket").applyInPandas(add, "total binary").collect()
    total = sum((np.frombuffer(r.total) for r in sums), np.zeros((size + 1) ** 2)).reshape(size + 1, size + 1)
    return total[:size, :size], total[:size, size], int(round(total[size - 1, size - 1]))


def pool_adjacent_violators(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values`` in weighted squares."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            weight = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / weight, weight, a[2] + b[2]])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def _scored(rows: DataFrame, score, keep: str) -> DataFrame:
    """``keep`` columns of ``rows`` and the function ``score`` of their statistics."""
    names = keep.split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.stack([batch.column(s).to_numpy(zero_copy_only=False) for s in STATISTICS], axis=1)
            values = pa.array(score(found), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), values], names=[*names, "score"])

    kept = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    return rows.mapInArrow(run, f"{kept}, score double")


def fit(found: DataFrame, labels: DataFrame, seed: int = 0) -> Model:
    """Fit on (doc_id, statistics) and (doc_id, label) rows; rows whose fold is HELD_OUT or null take no part."""
    moments = found.agg(*(f(s).alias(f"{n}_{s}") for s in STATISTICS for n, f in (("mean", F.avg), ("sd", F.stddev_pop)))).first()
    column = lambda n: np.array([moments[f"{n}_{s}"] or 0.0 for s in STATISTICS])
    model = Model(column("mean"), column("sd"), seed)
    used = labels.where(F.col("label").isNotNull()).withColumn("fold", fold(F.col("doc_id"))).where(F.col("fold") != HELD_OUT)
    labelled = stored(found.join(used, "doc_id"), "labelled")

    gram, target, rows = normal_equations(labelled.where(F.col("fold") != CALIBRATION), model)
    if not rows:
        return model
    penalty = np.full(len(gram), RIDGE * rows)
    penalty[-1] = 1e-9
    model.weights = np.linalg.solve(gram + np.diag(penalty), target)

    raw = _scored(labelled.where(F.col("fold") == CALIBRATION), model.ridge, "label")
    bin_ = F.floor((F.col("score") - LOW) / (HIGH - LOW) * BINS)
    bins = raw.groupBy(bin_.alias("bin")).agg(F.avg("label").alias("share"), F.count("*").alias("rows")).collect()
    bins = sorted(bins, key=lambda r: r.bin)
    if bins:
        model.values = LOW + (np.array([r.bin for r in bins]) + 0.5) * (HIGH - LOW) / BINS
        model.chances = pool_adjacent_violators(np.array([r.share for r in bins]), np.array([r.rows for r in bins], np.float64))
    return model


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    threshold: float = THRESHOLD,
    seed: int = 0,
) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted.

    Only whole texts make a score. Null texts count as empty. Null ids are scored, never trained on. Labels of
    one id that occur twice, or for several rows, count each time; null labels not at all.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = stored(document_statistics(plain), "statistics")
    model = fit(found, labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("label")), seed)
    scored = _scored(found, model.score, "doc_id")
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
