"""Value expressions: missing markers, numbers, engagement and activity labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postweave import settings
from postweave.functions.text import strip

# How a number may be written. Spark's cast also takes Java suffixes such as ``1d``.
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"


def is_present(c: Column) -> Column:
    """A required value is there: not null and not one of the written forms of nothing."""
    text = F.lower(strip(c.cast("string")))
    return c.isNotNull() & ~text.isin(*settings.MISSING_MARKERS)


def parse_number(c: Column) -> Column:
    """Text as double; null where it is not a plain number."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def to_count(c: Column, data_type: T.DataType) -> Column:
    """A counter as double; anything that is not a number becomes 0."""
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        number = c.cast("double")
    else:
        number = parse_number(c.cast("string"))
    return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0))


def engagement_bin(c: Column) -> Column:
    """Label of the right-closed bin that holds the score; null outside all bins."""
    edges, labels = settings.ENGAGEMENT_EDGES, settings.ENGAGEMENT_LABELS
    bins = F.when(c < edges[0], F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels, strict=True):
        bins = bins.when(c <= upper, F.lit(label))
    return bins


def activity_group(posts: Column) -> Column:
    """How often a user posts. The last group starts at 11."""
    return (
        F.when(posts == 1, "1 post")
        .when(posts.between(2, 5), "2-5 posts")
        .when(posts.between(6, 10), "6-10 posts")
        .otherwise("10+ posts")
    )


def activity_label(posts: Column, avg_engagement: Column) -> Column:
    """Segment name of a user by posts and mean engagement."""
    return (
        F.when((posts <= 1) & (avg_engagement <= 5), "low_activity")
        .when((posts >= 5) | (avg_engagement >= 20), "high_activity")
        .otherwise("medium_activity")
    )


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType
