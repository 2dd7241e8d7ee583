"""Word and n-gram counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postweave import settings
from postweave.functions.text import words


def exploded_terms(posts: DataFrame, *keep: str) -> DataFrame:
    """One row per word: the kept columns and ``term``."""
    return posts.select(*keep, F.explode(words(posts)).alias("term"))


def term_counts(posts: DataFrame) -> DataFrame:
    """(term, count) over all posts. Map-side partial counts keep frequent words cheap to shuffle."""
    return exploded_terms(posts).groupBy("term").agg(F.count(F.lit(1)).alias("count"))


def top_terms(posts: DataFrame, n: int) -> DataFrame:
    """The n most frequent words; at most n rows, equal counts in word order."""
    return term_counts(posts).orderBy(F.desc("count"), "term").limit(n)


def top_words(posts: DataFrame, n: int = settings.TOP_WORDS) -> DataFrame:
    return top_terms(posts, n).withColumnRenamed("term", "word")


def ngram_column(n: int) -> str:
    return {2: "bigram", 3: "trigram"}.get(n, "ngram")


def top_ngrams(posts: DataFrame, n: int, top_n: int = settings.TOP_NGRAMS) -> DataFrame:
    """The most frequent runs of n neighbouring words within a post.

    A run is built from the token array by position after the explode, which keeps the whole map
    side in generated code and never builds an array of arrays per post.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    name = ngram_column(n)
    tokens = posts.select(words(posts).alias("w")).where(F.size("w") >= n)
    starts = tokens.select("w", F.posexplode("w").alias("i", "first")).where(F.col("i") <= F.size("w") - n)
    rest = [F.get("w", F.col("i") + k) for k in range(1, n)]
    ngrams = starts.select(F.concat_ws(" ", "first", *rest).alias(name))
    return ngrams.groupBy(name).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), name).limit(top_n)


def top_bigrams(posts: DataFrame, top_n: int = settings.TOP_NGRAMS) -> DataFrame:
    return top_ngrams(posts, 2, top_n)


def top_trigrams(posts: DataFrame, top_n: int = settings.TOP_NGRAMS) -> DataFrame:
    return top_ngrams(posts, 3, top_n)
