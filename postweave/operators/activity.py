"""Post counts by period, by field and by engagement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postweave import settings
from postweave.functions.values import engagement_bin


def _posts_by(posts: DataFrame, period: str) -> DataFrame:
    dated = posts.where(F.col(period).isNotNull())
    return dated.groupBy(period).agg(F.count(F.lit(1)).alias("post_count")).orderBy(period)


def posts_by_date(posts: DataFrame) -> DataFrame:
    return _posts_by(posts, "date")


def posts_by_month(posts: DataFrame) -> DataFrame:
    return _posts_by(posts, "month")


def top_field_values(posts: DataFrame, field: str, n: int = settings.TOP_FIELD_VALUES) -> DataFrame:
    """The most frequent values of a field, null as ``unknown``; no rows if the field is absent."""
    if field not in posts.columns:
        return posts.sparkSession.createDataFrame([], f"`{field}` string, count bigint")
    value = F.coalesce(F.col(field).cast("string"), F.lit("unknown")).alias(field)
    counts = posts.select(value).groupBy(field).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), field).limit(n)


def engagement_distribution(posts: DataFrame) -> DataFrame:
    """Posts per engagement bin, all bins in order, empty ones with 0; no rows for no posts at all."""
    group = engagement_bin(F.col("engagement_score"))
    binned = posts.select(group.alias("g"))
    per_bin = [F.count_if(F.col("g") == label).alias(f"n{i}") for i, label in enumerate(settings.ENGAGEMENT_LABELS)]
    counted = binned.agg(F.count(F.lit(1)).alias("posts"), *per_bin).where("posts > 0")
    rows = [
        F.struct(F.lit(label).alias("engagement_group"), F.col(f"n{i}").alias("posts_count"))
        for i, label in enumerate(settings.ENGAGEMENT_LABELS)
    ]
    return counted.select(F.inline(F.array(*rows)))
