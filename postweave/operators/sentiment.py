"""Lexicon sentiment of posts and its roll-ups."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postweave import settings
from postweave.functions.text import word_list, words


def count_words(tokens: str, lexicon: Iterable[str]) -> Column:
    """How many tokens of an array column, repeats included, are in the lexicon."""
    listed = word_list(lexicon)
    some = f"coalesce(`{tokens}`, array())"
    return F.expr(f"size(filter({some}, t -> t IN ({listed})))") if listed else F.lit(0)


def with_sentiment(
    posts: DataFrame,
    positive: Iterable[str] = settings.POSITIVE_WORDS,
    negative: Iterable[str] = settings.NEGATIVE_WORDS,
    positive_above: float = settings.POSITIVE_ABOVE,
    negative_below: float = settings.NEGATIVE_BELOW,
) -> DataFrame:
    """Add word counts, score (positive share minus negative share of the hits) and label."""
    tokens = "tokens" if "tokens" in posts.columns else "_words"
    counted = posts if tokens == "tokens" else posts.withColumn(tokens, words(posts))
    pos, neg = F.col("positive_word_count"), F.col("negative_word_count")
    score = F.col("sentiment_score")
    label = (
        F.when(score > positive_above, "positive").when(score < negative_below, "negative").otherwise("neutral")
    )
    counted = counted.withColumns(
        {"positive_word_count": count_words(tokens, positive), "negative_word_count": count_words(tokens, negative)}
    ).drop("_words")
    scored = counted.withColumn("sentiment_score", (pos - neg) / F.greatest(pos + neg, F.lit(1)))
    return scored.withColumn("sentiment_label", label)


def _roll_up(posts: DataFrame, *keys: str) -> DataFrame:
    known = posts.where(F.col(keys[0]).isNotNull())
    return known.groupBy(*keys).agg(
        F.count("post_id").alias("posts_count"), F.avg("sentiment_score").alias("avg_sentiment_score")
    )


def sentiment_distribution(posts: DataFrame) -> DataFrame:
    return _roll_up(posts, "sentiment_label").orderBy(F.desc("posts_count"), "sentiment_label")


def sentiment_by_month(posts: DataFrame) -> DataFrame:
    return _roll_up(posts, "month", "sentiment_label").orderBy("month", "sentiment_label")


def sentiment_by_source(posts: DataFrame) -> DataFrame:
    return _roll_up(posts, "source", "sentiment_label").orderBy("source", F.desc("posts_count"), "sentiment_label")
