"""User activity: top users, distributions, features, clusters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postweave import settings
from postweave.functions.values import activity_group, activity_label
from postweave.plans.storage import stored

FEATURES = (
    "posts_count",
    "avg_likes",
    "avg_comments",
    "total_comments",
    "total_engagement",
    "avg_engagement",
    "unique_sources",
    "unique_categories",
    "active_months",
)

def _known_users(posts: DataFrame) -> DataFrame:
    return posts.where(F.col("user_id").isNotNull())


def top_users(posts: DataFrame, n: int = settings.TOP_USERS) -> DataFrame:
    """The users with most posts."""
    stats = _known_users(posts).groupBy("user_id").agg(
        F.count("post_id").alias("posts_count"),
        F.avg("likes_count").alias("avg_likes"),
        F.sum("comments_count").alias("total_comments"),
        F.sum("engagement_score").alias("total_engagement"),
        F.avg("engagement_score").alias("avg_engagement"),
    )
    return stats.orderBy(F.desc("posts_count"), "user_id").limit(n)


def top_users_engagement(posts: DataFrame, n: int = settings.TOP_USERS) -> DataFrame:
    """The users with most engagement."""
    stats = _known_users(posts).groupBy("user_id").agg(
        F.count("post_id").alias("posts_count"),
        F.sum("engagement_score").alias("total_engagement"),
        F.avg("engagement_score").alias("avg_engagement"),
    )
    return stats.orderBy(F.desc("total_engagement"), "user_id").limit(n)


def user_distribution(posts: DataFrame) -> DataFrame:
    """Users per activity group."""
    per_user = _known_users(posts).groupBy("user_id").agg(F.count(F.lit(1)).alias("posts"))
    groups = per_user.groupBy(activity_group(F.col("posts")).alias("activity_group"))
    return groups.agg(F.count(F.lit(1)).alias("users_count")).orderBy("activity_group")


def user_activity_by_month(posts: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct users, posts and mean engagement per month.

    The exact count shuffles one row per (month, user); ``approximate`` a fixed sketch per month.
    """
    users = F.approx_count_distinct("user_id") if approximate else F.count_distinct("user_id")
    return (
        posts.where(F.col("month").isNotNull())
        .groupBy("month")
        .agg(
            users.alias("unique_users"),
            F.count("post_id").alias("total_posts"),
            F.avg("engagement_score").alias("avg_engagement"),
        )
        .orderBy("month")
    )


def user_features(posts: DataFrame) -> DataFrame:
    """Nine features per user. Distinct counts of absent columns are 0, nulls are 0.

    Posts are first summed per (user, source, category, month), on the map side before the shuffle,
    so a user with very many posts comes down to as many rows as there are combinations. Only these
    are expanded for the distinct counts.
    """
    kinds = [c for c in ("source", "category", "month") if c in posts.columns]
    sums = {"likes": "likes_count", "comments": "comments_count", "engagement": "engagement_score"}
    partial = _known_users(posts).groupBy("user_id", *kinds).agg(
        F.count("post_id").alias("posts"),
        *(F.sum(c).alias(f"{n}_sum") for n, c in sums.items()),
        *(F.count(c).alias(f"{n}_rows") for n, c in sums.items()),
    )
    mean = lambda n: F.try_divide(F.sum(f"{n}_sum"), F.sum(f"{n}_rows"))

    def distinct(column: str):
        return F.count_distinct(column) if column in kinds else F.lit(0).cast("long")

    stats = partial.groupBy("user_id").agg(
        F.sum("posts").alias("posts_count"),
        mean("likes").alias("avg_likes"),
        mean("comments").alias("avg_comments"),
        F.sum("comments_sum").alias("total_comments"),
        F.sum("engagement_sum").alias("total_engagement"),
        mean("engagement").alias("avg_engagement"),
        distinct("source").alias("unique_sources"),
        distinct("category").alias("unique_categories"),
        distinct("month").alias("active_months"),
    )
    return stats.na.fill(0, subset=list(FEATURES))


def with_activity_label(features: DataFrame) -> DataFrame:
    return features.withColumn("segment_label", activity_label(F.col("posts_count"), F.col("avg_engagement")))


def scaled_features(features: DataFrame, keep: str = "user_id") -> DataFrame:
    """``keep`` and the features less their mean, in standard deviations; constant ones are 0."""
    doubles = features.select(keep, *(F.col(c).cast("double").alias(c) for c in FEATURES))
    moments = doubles.agg(*(f(c).alias(f"{n}_{c}") for c in FEATURES for n, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    scaled = [
        ((F.col(c) - F.lit(moments[f"m_{c}"])) / F.lit(moments[f"s_{c}"]) if moments[f"s_{c}"] else F.lit(0.0)).alias(c)
        for c in FEATURES
    ]
    return doubles.select(keep, *scaled)


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in FEATURES], axis=1)


def _distances(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.stack([((rows - center) ** 2).sum(axis=1) for center in centers], axis=1)


def _start_centers(scaled: DataFrame, k: int, starts: int, seed: int) -> np.ndarray:
    """k-means++ for all starts at once, one pass for each of the ``k`` centers.

    A user's chance to be the next center is in proportion to the squared distance to the nearest
    one so far: the user with the least -log(u) / distance is taken, u from a hash of the user.
    """
    centers = np.zeros((starts, 0, len(FEATURES)))
    for number in range(k):

        def draw(batches: Iterator[pa.RecordBatch], number: int = number, centers: np.ndarray = centers) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, hashes = _rows(batch), batch.column("hash").to_numpy().view(np.uint64)
                for start in range(starts if len(rows) else 0):
                    salt = np.uint64(((seed + start) * 1000 + number) * 0x9E3779B97F4A7C15 % (1 << 64))
                    mixed = (hashes ^ salt) * np.uint64(0xD6E8FEB86659FD93)
                    chance = ((mixed ^ (mixed >> np.uint64(32))) >> np.uint64(11)).astype(np.float64) + 0.5
                    weight = _distances(rows, centers[start]).min(axis=1) if number else np.ones(len(rows))
                    key = np.where(weight > 0, -np.log(chance / 2**53) / np.maximum(weight, 1e-300), np.inf)
                    best = np.lexsort((hashes, key))[0]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "start": pa.array([start], pa.int32()),
                            "key": [float(key[best])],
                            "hash": [int(hashes[best].view(np.int64))],
                            "row": [rows[best].tolist()],
                        }
                    )

        drawn = scaled.mapInArrow(draw, "start int, key double, hash long, row array<double>")
        best = drawn.groupBy("start").agg(F.min_by("row", F.struct("key", "hash")).alias("row")).orderBy("start").collect()
        centers = np.concatenate([centers, np.array([r.row for r in best]).reshape(starts, 1, -1)], axis=1)
    return centers


def _move_centers(scaled: DataFrame, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means of the users nearest to each center, and the cost of each start, in one pass."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, k, size = centers.shape
        sums = np.zeros((starts, k, size + 2))
        for batch in batches:
            rows = _rows(batch)
            for start in range(starts if len(rows) else 0):
                distance = _distances(rows, centers[start])
                nearest = distance.argmin(axis=1)
                parts = [*rows.T, np.ones(len(rows)), distance[np.arange(len(rows)), nearest]]
                sums[start] += np.stack([np.bincount(nearest, part, k) for part in parts], axis=1)
        start, cluster = np.indices((starts, k)).reshape(2, -1)
        columns = [pa.array(start, pa.int32()), pa.array(cluster, pa.int32()), *map(pa.array, sums.reshape(-1, size + 2).T)]
        yield pa.RecordBatch.from_arrays(columns, ["start", "cluster", *FEATURES, "users", "cost"])

    sums = ", ".join(f"{c} double" for c in (*FEATURES, "users", "cost"))
    parts = scaled.mapInArrow(add_up, f"start int, cluster int, {sums}")
    # At most starts * k rows from each task, and as many keys.
    found = parts.groupBy("start", "cluster").agg(*(F.sum(c).alias(c) for c in (*FEATURES, "users", "cost"))).collect()
    moved, costs = centers.copy(), np.zeros(len(centers))
    for row in found:
        costs[row.start] += row.cost
        if row.users:
            moved[row.start, row.cluster] = [row[c] / row.users for c in FEATURES]
    return moved, costs


def fit_centers(scaled: DataFrame, k: int, starts: int, seed: int, max_iter: int, tol: float = 1e-4) -> np.ndarray:
    """The centers of the best of several starts; each pass moves the centers of all starts that still move."""
    centers = _start_centers(scaled, k, starts, seed)
    costs, moving = np.full(starts, np.inf), np.arange(starts)
    for _ in range(max_iter):
        moved, cost = _move_centers(scaled, centers[moving])
        shift = ((moved - centers[moving]) ** 2).sum(axis=(1, 2))
        centers[moving], costs[moving] = moved, cost
        moving = moving[shift > tol]
        if not len(moving):
            break
    best = centers[np.lexsort((np.arange(starts), np.round(costs, 9)))[0]]
    # Until no user changes center, so that each center is the mean of its users.
    for _ in range(max_iter):
        moved = _move_centers(scaled, best[None])[0][0]
        if np.allclose(moved, best, rtol=0, atol=1e-12):
            break
        best = moved
    return best


def segment_certificate(features: DataFrame, segments: DataFrame, slack: float = 1e-6) -> DataFrame:
    """One row that tells whether segments are a fixed point of k-means: users, segments, not_nearest, out_of_order.

    ``not_nearest`` counts users whose squared distance to the mean of another segment is less, by more than ``slack``, than to
    that of their own, in standard deviations. ``out_of_order`` counts segments with a smaller mean total_engagement
    than the one before. The means are read from the segments alone, whoever made them.
    """
    placed = scaled_features(features).join(segments.select("user_id", "segment_id"), "user_id")
    means = placed.groupBy("segment_id").agg(*(F.avg(c).alias(c) for c in FEATURES)).orderBy("segment_id").collect()
    apart = [sum((F.pow(F.col(c) - m[c], 2) for c in FEATURES[1:]), F.pow(F.col(FEATURES[0]) - m[FEATURES[0]], 2)) for m in means]
    own = F.get(F.array(*apart), F.array_position(F.array(*(F.lit(m.segment_id) for m in means)), F.col("segment_id")).cast("int") - 1)
    falls = sum(b.total_engagement < a.total_engagement - slack for a, b in zip(means, means[1:]))
    return placed.agg(
        F.count("*").alias("users"),
        F.lit(len(means)).cast("long").alias("segments"),
        F.count(F.when(own - F.array_min(F.array(*apart)) > slack, 1)).alias("not_nearest"),
        F.lit(falls).cast("long").alias("out_of_order"),
    )


def assign_segments(scaled: DataFrame, centers: np.ndarray, keep: str = "user_id") -> DataFrame:
    """(``keep``, segment_id): the number of the nearest center, the first of equally near ones."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = _distances(_rows(batch), centers).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(keep), pa.array(number, pa.int32())], [keep, "segment_id"])

    return scaled.mapInArrow(nearest, f"{keep} {scaled.schema[keep].dataType.simpleString()}, segment_id int")


def segment_users(
    features: DataFrame,
    k: int = settings.SEGMENTS,
    starts: int = settings.SEGMENT_STARTS,
    seed: int = settings.SEED,
    max_iter: int = settings.SEGMENT_ITERATIONS,
) -> DataFrame:
    """Users with their rule-based label and k-means cluster, best of several seeded starts.

    The features are read by every pass, so pass a stored or persisted frame. Nothing depends on how it is
    partitioned. Clusters are numbered by their mean total_engagement (then by the other features).
    """
    labelled = with_activity_label(features)
    known = features.count()
    if known < 2:
        return labelled.withColumn("segment_id", F.lit(0))
    scaled = scaled_features(features).withColumn("hash", F.xxhash64("user_id"))
    scaled = stored(scaled, "scaled-features")
    centers = fit_centers(scaled, max(1, min(k, known)), starts, seed, max_iter)
    by = FEATURES.index("total_engagement")
    centers = centers[sorted(range(len(centers)), key=lambda i: (centers[i][by], *centers[i]))]
    return labelled.join(assign_segments(scaled, centers), "user_id").select(
        "user_id", *FEATURES, "segment_label", "segment_id"
    )


def user_segment_distribution(segments: DataFrame) -> DataFrame:
    """Users, mean posts and mean of the users' mean engagement per label."""
    return (
        segments.groupBy("segment_label")
        .agg(
            F.count("user_id").alias("users_count"),
            F.avg("posts_count").alias("avg_posts_count"),
            F.avg("avg_engagement").alias("avg_engagement"),
        )
        .orderBy(F.desc("users_count"), "segment_label")
    )
