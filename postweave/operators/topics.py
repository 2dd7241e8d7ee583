"""Topics by non-negative matrix factorisation of TF-IDF vectors, X ~ W H.

X (posts by vocabulary) and W (posts by topics) stay distributed; H (topics by vocabulary) is a
driver array whose size is fixed by the parameters (5 x 1500 by default). Alternating non-negative
least squares (Kim and Park 2008) from an NNDSVD start (Boutsidis and Gallopoulos 2008):

* given H, each post's row of W is its own small least-squares problem, solved inside the tasks for
  a whole Arrow batch at once and not kept;
* given the sums W'W and W'X, which Spark adds up over the posts, H is solved on the driver.

So every iteration is one pass over the vectors that shuffles only the partial sums. Before the first one, the vectors are
packed into blocks of some thousand posts, so that a pass hands whole arrays to the tasks and converts no single vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postweave import settings
from postweave.operators.tfidf import TfidfSpace, fit_tfidf
from postweave.plans.storage import stored

# Groups in which the partial sums of tasks are added.
SUMS = 16

# Entries of a packed block, and of what is multiplied at once; one post at least.
BLOCK_ENTRIES, SLICE_ENTRIES = 1 << 19, 1 << 16

# Sweeps of coordinate descent; the few coupled columns settle long before.
ROUNDS = 200


def nonnegative_solve(gram: np.ndarray, target: np.ndarray, rounds: int = ROUNDS, tol: float = 1e-10) -> np.ndarray:
    """Rows w >= 0 that minimise w G w' / 2 - w t' for each row t of ``target``.

    Coordinate descent over the few columns, all rows at once.
    """
    k = gram.shape[0]
    wanted = np.ascontiguousarray(target.T)
    result = np.zeros_like(wanted)
    diagonal = np.diag(gram)
    scale = float(np.abs(target).max(initial=0.0))
    for _ in range(rounds):
        change = 0.0
        for j in range(k):
            if diagonal[j] <= 0.0:
                continue
            moved = np.maximum(result[j] + (wanted[j] - gram[j] @ result) / diagonal[j], 0.0)
            if moved.size:
                change = max(change, float(np.abs(moved - result[j]).max()) * float(diagonal[j]))
            result[j] = moved
        if change <= tol * max(scale, 1e-300):
            break
    return np.ascontiguousarray(result.T)


# Directions beyond those asked for and passes of the range finder; scale on which residuals are told.
EXTRA_DIRECTIONS, RANGE_ROUNDS = 10, 8
RESIDUAL_SCALE = 10.0 ** np.arange(-15, 4)


class _Block:
    """Sparse rows: the number of entries of each, and the term and weight of each entry."""

    def __init__(self, lengths: np.ndarray, terms: np.ndarray, weights: np.ndarray):
        self.rows = len(lengths)
        self.lengths = lengths
        self.terms = terms.astype(np.intp)
        self.weights = weights

    @classmethod
    def of_vectors(cls, features: pa.Array) -> _Block:
        """The rows of an Arrow array of vectors."""
        return cls(*_entries(features))

    @classmethod
    def of_packed(cls, blocks: pa.RecordBatch, i: int) -> _Block:
        """The i-th of packed blocks, read where it lies."""
        return cls(*(np.frombuffer(blocks.column(name)[i].as_buffer(), kind) for name, kind in PACKED.items()))

    def _slices(self) -> Iterator[tuple[slice, slice]]:
        """Rows and their entries, few enough at once that the products of a slice stay in the processor's cache."""
        yield from _cuts(self.lengths, SLICE_ENTRIES)

    def times(self, right: np.ndarray) -> np.ndarray:
        """X @ right, for ``right`` of shape (vocabulary, k)."""
        columns = np.ascontiguousarray(right.T)
        found = np.zeros((len(columns), self.rows))
        for rows, entries in self._slices():
            lengths, terms, weights = self.lengths[rows], self.terms[entries], self.weights[entries]
            filled = np.flatnonzero(lengths)
            if len(filled):
                starts = (np.cumsum(lengths) - lengths)[filled]
                for column, into in zip(columns, found, strict=True):
                    into[rows.start + filled] = np.add.reduceat(weights * column[terms], starts)
        return found.T

    def pulled(self, left: np.ndarray, size: int) -> np.ndarray:
        """left' @ X, for ``left`` of shape (rows, k)."""
        columns = np.ascontiguousarray(left.T)
        found = np.zeros((len(columns), size))
        for rows, entries in self._slices():
            lengths, terms, weights = self.lengths[rows], self.terms[entries], self.weights[entries]
            for column, into in zip(columns, found, strict=True):
                into += np.bincount(terms, weights * np.repeat(column[rows], lengths), size)
        return found


def _cuts(lengths: np.ndarray, most: int) -> Iterator[tuple[slice, slice]]:
    """Rows in order and their entries, cut where the entries would be more than ``most``, but with one row at least."""
    ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    row = 0
    while row < len(lengths):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + most, "right")) - 1)
        yield slice(row, stop), slice(int(ends[row]), int(ends[stop]))
        row = stop


# The columns of a packed block and how their numbers are written.
PACKED = {"lengths": np.int32, "terms": np.int32, "weights": np.float64}


def _entries(features: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    indices, values = features.field("indices"), features.field("values")
    return np.diff(np.asarray(indices.offsets)), np.asarray(indices.flatten()), np.asarray(values.flatten())


def packed(vectors: DataFrame) -> DataFrame:
    """Vectors as blocks of rows, for tables that are read by many passes; packed frames stay as they are.

    A block is one row of three binary columns with at most BLOCK_ENTRIES entries, or a single vector.
    """
    if vectors.columns == list(PACKED):
        return vectors

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, terms, weights = _entries(batch.column("features"))
            for rows, entries in _cuts(lengths, BLOCK_ENTRIES):
                parts = zip(PACKED.items(), (lengths[rows], terms[entries], weights[entries]), strict=True)
                yield pa.RecordBatch.from_pydict({name: pa.array([part.astype(kind).tobytes()], pa.binary()) for (name, kind), part in parts})

    return vectors.select("features").mapInArrow(pack, ", ".join(f"{name} binary" for name in PACKED))


def _summed(vectors: DataFrame, one_batch, size: int) -> np.ndarray:
    """Sum of ``one_batch(block)`` (a flat array of ``size`` numbers) over all blocks of packed or other vectors.

    Each task adds up its own blocks to one row. The rows are added in SUMS groups, and the driver
    adds the groups, so it holds at most SUMS arrays however many splits there are.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(size)
        for batch in batches:
            for i in range(batch.num_rows):
                total += one_batch(_Block.of_packed(batch, i))
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId() % SUMS], pa.int32()), "total": [total.tobytes()]})

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(t) for t in rows.column("total").to_pylist())
        return pa.table({"total": pa.array([total.tobytes()], pa.binary())})

    parts = packed(vectors).mapInArrow(partial, "part int, total binary")
    sums = parts.groupBy("part").applyInArrow(add, "total binary").collect()
    return sum((np.frombuffer(r.total) for r in sums), np.zeros(size))


@dataclass(frozen=True)
class TopicModel:
    """Fitted topics: vocabulary, H, and the objective after each pass."""

    space: TfidfSpace
    weights: np.ndarray
    objective: tuple[float, ...]

    @property
    def topics(self) -> int:
        return self.weights.shape[0]

    def labels(self) -> list[str]:
        return [", ".join(term for term, _ in self._top(t, settings.TOPIC_LABEL_TERMS)) for t in range(self.topics)]

    def _top(self, topic: int, n: int) -> list[tuple[str, float]]:
        pairs = zip(self.space.vocabulary, self.weights[topic].tolist(), strict=True)
        # Nearly equal weights are ties of symmetric terms up to rounding.
        return sorted(pairs, key=lambda p: (-round(p[1], 9), p[0]))[:n]

    def term_rows(self, n: int = settings.TOPIC_TERMS) -> list[tuple]:
        labels = self.labels()
        return [
            (topic, labels[topic], term, weight, rank)
            for topic in range(self.topics)
            for rank, (term, weight) in enumerate(self._top(topic, n), start=1)
        ]


def topic_vectors(posts: DataFrame, space: TfidfSpace) -> DataFrame:
    """Stored (post_id[, month], features), the only table that the iterations read."""
    keep = [c for c in ("post_id", "month") if c in posts.columns]
    return stored(space.vectors(posts, *keep), "topic-vectors")


def leading_directions(vectors: DataFrame, size: int, k: int, extra: int = EXTRA_DIRECTIONS, rounds: int = RANGE_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` singular values and right singular vectors of X, by a randomised range finder.

    Seeded random directions, some more than asked for, are multiplied by X'X in a few passes and made orthogonal in
    between; X'X itself is never formed. A pass sums vocabulary x (k + extra) numbers.
    """
    width = min(size, k + extra)
    directions = np.random.default_rng(settings.SEED).standard_normal((size, width))
    for _ in range(rounds):
        directions = np.linalg.qr(directions)[0]

        def multiplied(block: _Block, directions: np.ndarray = directions) -> np.ndarray:
            return block.pulled(block.times(directions), size).ravel()

        image = _summed(vectors, multiplied, width * size).reshape(width, size).T
        before, directions = directions, image
    small = before.T @ image
    values, turns = np.linalg.eigh((small + small.T) / 2)
    top = np.argsort(values)[::-1][:k]
    right = before @ turns[:, top]
    # One sign for each vector, so that equal inputs give equal starts.
    right *= np.where(right[np.abs(right).argmax(axis=0), np.arange(len(top))] < 0, -1.0, 1.0)
    return np.sqrt(np.maximum(values[top], 0.0)), right


def squared_length(vectors: DataFrame) -> float:
    """The sum of the squares of all weights."""
    return float(_summed(vectors, lambda block: np.array([(block.weights**2).sum()]), 1)[0])


def start_weights(vectors: DataFrame, size: int, k: int, documents: int) -> np.ndarray:
    """NNDSVD start for H, zeros filled with the mean of X.

    The left singular vectors are never formed: one pass sums the squares of their positive and negative parts.
    """
    singular, right = leading_directions(vectors, size, k)

    def sides(block: _Block) -> np.ndarray:
        left = block.times(right)
        plus, minus = np.maximum(left, 0.0), np.maximum(-left, 0.0)
        return np.concatenate([(plus**2).sum(0), (minus**2).sum(0), [block.weights.sum()]])

    sums = _summed(vectors, sides, 2 * k + 1)
    safe = np.where(singular > 0, singular, 1.0)
    plus, minus = np.sqrt(sums[:k]) / safe, np.sqrt(sums[k : 2 * k]) / safe
    h = np.zeros((k, size))
    for j in range(k):
        up, down = np.maximum(right[:, j], 0.0), np.maximum(-right[:, j], 0.0)
        if j == 0:
            # The leading pair has one sign.
            up, down, left_up, left_down = np.abs(right[:, 0]), down * 0, np.hypot(plus[0], minus[0]), 0.0
        else:
            left_up, left_down = plus[j], minus[j]
        norms = np.linalg.norm(up) * left_up, np.linalg.norm(down) * left_down
        side, strength = (up, norms[0]) if norms[0] >= norms[1] else (down, norms[1])
        length = np.linalg.norm(side)
        if length > 0:
            h[j] = np.sqrt(singular[j] * strength) * side / length
    return np.where(h <= 1e-12, sums[-1] / (documents * size), h)


def fit_topics(
    vectors: DataFrame,
    space: TfidfSpace,
    k: int = settings.TOPICS,
    max_iter: int = settings.TOPIC_ITERATIONS,
    tol: float = settings.TOPIC_TOLERANCE,
) -> TopicModel:
    """Factorise the stored vectors until the projected gradient is at most ``tol`` of the first one."""
    size = len(space.vocabulary)
    k = max(1, min(k, space.documents, size))
    vectors = stored(packed(vectors), "topic-blocks")
    h = start_weights(vectors, size, k, space.documents)
    squares = squared_length(vectors)
    objective: list[float] = []
    first = None
    for _ in range(max_iter):
        hh = h @ h.T

        def sums(block: _Block, h: np.ndarray = h, hh: np.ndarray = hh) -> np.ndarray:
            w = nonnegative_solve(hh, block.times(h.T))
            return np.concatenate([(w.T @ w).ravel(), block.pulled(w, size).ravel()])

        flat = _summed(vectors, sums, k * k + k * size)
        ww, wx = flat[: k * k].reshape(k, k), flat[k * k :].reshape(k, size)
        objective.append(0.5 * (squares - 2 * float((wx * h).sum()) + float((ww * hh).sum())))
        gradient = ww @ h - wx
        steepness = float(np.linalg.norm(np.where(h > 0, gradient, np.minimum(gradient, 0.0))))
        first = steepness if first is None else first
        if steepness <= tol * first:
            break
        h = nonnegative_solve(ww, wx.T).T
    return TopicModel(space, h, tuple(objective))


@dataclass(frozen=True)
class TopicCertificate:
    """How far a model is from the conditions that a minimum fulfils.

    ``gradient`` is the norm of the projected gradient of H by that of the start. ``row_residual`` is the greatest violation
    of the conditions of a post's weights w >= 0: no positive weight has a slope, no zero one a falling slope.
    """

    posts: int
    gradient: float
    row_residual: float


def topic_certificate(vectors: DataFrame, model: TopicModel) -> TopicCertificate:
    """Check a fitted model by one pass over the stored vectors for its weights and one for those of the start."""
    size, k = len(model.space.vocabulary), model.topics
    vectors = stored(packed(vectors), "topic-blocks")

    def sums(block: _Block, h: np.ndarray) -> np.ndarray:
        target, hh = block.times(h.T), h @ h.T
        w = nonnegative_solve(hh, target)
        slope = w @ hh - target
        worst = np.abs(np.where(w > 0, slope, np.minimum(slope, 0.0))).max(initial=0.0)
        # The greatest of all batches comes out of sums of flags on a scale of powers of ten.
        reached = worst > RESIDUAL_SCALE
        return np.concatenate([(w.T @ w).ravel(), block.pulled(w, size).ravel(), reached.astype(np.float64), [block.rows]])

    def checked(h: np.ndarray) -> tuple[float, np.ndarray, int]:
        flat = _summed(vectors, lambda block: sums(block, h), k * k + k * size + len(RESIDUAL_SCALE) + 1)
        ww, wx = flat[: k * k].reshape(k, k), flat[k * k : k * k + k * size].reshape(k, size)
        gradient = ww @ h - wx
        steepness = float(np.linalg.norm(np.where(h > 0, gradient, np.minimum(gradient, 0.0))))
        return steepness, flat[k * k + k * size : -1], int(flat[-1])

    start, _, _ = checked(start_weights(vectors, size, k, model.space.documents))
    steepness, reached, posts = checked(model.weights)
    residual = float(RESIDUAL_SCALE[reached > 0].max(initial=0.0)) * 10
    return TopicCertificate(posts, steepness / start if start else 0.0, residual)


def assign_topics(vectors: DataFrame, model: TopicModel) -> DataFrame:
    """post_topics: the strongest topic of each post (lowest id on a tie), its label and weight."""
    h, hh, labels = model.weights, model.weights @ model.weights.T, model.labels()
    keep = [c for c in ("post_id", "month") if c in vectors.columns]

    def strongest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = nonnegative_solve(hh, _Block.of_vectors(batch.column("features")).times(h.T))
            topic = w.argmax(axis=1)
            columns = [batch.column(c) for c in keep]
            columns += [pa.array(topic, pa.int32()), pa.array(w[np.arange(len(w)), topic])]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "topic_id", "topic_weight"])

    fields = ", ".join(f"{c} {vectors.schema[c].dataType.simpleString()}" for c in keep)
    found = vectors.mapInArrow(strongest, f"{fields}, topic_id int, topic_weight double")
    label = F.get(F.array(*map(F.lit, labels)), F.col("topic_id"))
    extra = [c for c in keep if c != "post_id"]
    return found.select(F.col("post_id").cast("string"), "topic_id", label.alias("topic_label"), "topic_weight", *extra)


def topic_summary(post_topics: DataFrame) -> DataFrame:
    """Posts and mean weight per topic."""
    return _roll_up(post_topics).orderBy(F.desc("posts_count"), "topic_id")


def topics_by_month(post_topics: DataFrame, posts: DataFrame | None = None) -> DataFrame:
    """Posts and mean weight per month and topic.

    The month comes with ``post_topics`` where the vectors carried it; else from ``posts`` by a left
    join on post_id.
    """
    if posts is not None:
        months = posts.select(F.col("post_id").cast("string").alias("post_id"), "month")
        post_topics = post_topics.drop("month").join(months, "post_id", "left")
    dated = post_topics.where(F.col("month").isNotNull())
    return _roll_up(dated, "month").orderBy("month", F.desc("posts_count"), "topic_id")


def _roll_up(post_topics: DataFrame, *keys: str) -> DataFrame:
    return post_topics.groupBy(*keys, "topic_id", "topic_label").agg(
        F.count("post_id").alias("posts_count"), F.avg("topic_weight").alias("avg_topic_weight")
    )


TOPIC_TABLES = {
    "topic_terms": "topic_id int, topic_label string, term string, weight double, term_rank int",
    "post_topics": "post_id string, topic_id int, topic_label string, topic_weight double",
    "topic_summary": "topic_id int, topic_label string, posts_count bigint, avg_topic_weight double",
    "topics_by_month": "month string, topic_id int, topic_label string, posts_count bigint, avg_topic_weight double",
}


def topic_tables(
    posts: DataFrame,
    topics: int = settings.TOPICS,
    n_terms: int = settings.TOPIC_TERMS,
    max_features: int = settings.TOPIC_VOCABULARY,
    max_iter: int = settings.TOPIC_ITERATIONS,
    tol: float = settings.TOPIC_TOLERANCE,
    space: TfidfSpace | None = None,
) -> tuple[dict[str, DataFrame], TopicModel | None]:
    """The four topic tables and the fitted model; empty tables for fewer than two posts or words.

    Without a fitted ``space`` the posts are read three times before the vectors are stored; pass a
    stored frame.
    """
    spark = posts.sparkSession
    space = fit_tfidf(posts, max_features) if space is None else space
    if space.documents < 2 or len(space.vocabulary) < 2:
        return {name: spark.createDataFrame([], schema) for name, schema in TOPIC_TABLES.items()}, None
    vectors = topic_vectors(posts, space)
    model = fit_topics(vectors, space, topics, max_iter, tol)
    assigned = stored(assign_topics(vectors, model), "assigned-topics")
    by_month = (
        topics_by_month(assigned)
        if "month" in assigned.columns
        else spark.createDataFrame([], TOPIC_TABLES["topics_by_month"])
    )
    tables = {
        "topic_terms": spark.createDataFrame(model.term_rows(n_terms), TOPIC_TABLES["topic_terms"]),
        "post_topics": assigned.drop("month"),
        "topic_summary": topic_summary(assigned),
        "topics_by_month": by_month,
    }
    return tables, model
