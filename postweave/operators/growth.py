"""Words by month and growth between the last two complete months."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postweave import settings
from postweave.functions.text import words
from postweave.operators.terms import top_terms

# Marks one row per post next to its words; a word is never empty.
POST = ""


def trend_vocabulary(posts: DataFrame, n_terms: int = settings.TREND_TERMS) -> DataFrame:
    """The most frequent words over all posts, months or not."""
    return top_terms(posts, n_terms)


def month_profile(posts: DataFrame, n_terms: int = settings.TREND_TERMS, vocabulary: DataFrame | None = None) -> DataFrame:
    """One row per month: posts, latest time and the counts of the vocabulary words.

    Each post adds one marker row to its words, so word counts, post totals and the latest time come
    out of one aggregation. The vocabulary has at most ``n_terms`` + 1 rows and is broadcast. The
    result is as long as the calendar, with at most ``n_terms`` entries a row. The row of posts
    without a month stays, for their times.
    """
    vocabulary = trend_vocabulary(posts, n_terms) if vocabulary is None else vocabulary
    spark = posts.sparkSession
    wanted = vocabulary.select("term").union(spark.range(1).select(F.lit(POST).alias("term")))
    time = F.col("datetime").cast("timestamp_ntz") if "datetime" in posts.columns else F.lit(None).cast("timestamp_ntz")
    marked = posts.select(
        F.col("month"),
        time.alias("datetime"),
        F.explode(F.concat(F.array(F.lit(POST)), words(posts))).alias("term"),
    )
    counted = (
        marked.join(F.broadcast(wanted), "term")
        .groupBy("month", "term")
        .agg(F.count(F.lit(1)).alias("count"), F.max("datetime").alias("last_time"))
    )
    is_post = F.col("term") == POST
    return counted.groupBy("month").agg(
        F.coalesce(F.sum(F.when(is_post, F.col("count"))), F.lit(0)).alias("total_posts"),
        F.max(F.when(is_post, F.col("last_time"))).alias("last_time"),
        F.collect_list(F.when(~is_post, F.struct("term", "count"))).alias("terms"),
    )


def _by_term(profile: DataFrame) -> DataFrame:
    return profile.where(F.col("month").isNotNull()).select("*", F.inline("terms")).drop("terms")


def _monthly_rows(profile: DataFrame) -> DataFrame:
    return _by_term(profile).select(
        F.col("month").cast("string").alias("month"),
        "term",
        "count",
        F.col("total_posts").alias("total_posts_in_month"),
        (F.col("count") / F.col("total_posts")).alias("relative_frequency"),
    )


def terms_by_month(posts: DataFrame, n_terms: int = settings.TREND_TERMS, vocabulary: DataFrame | None = None) -> DataFrame:
    """Counts of the most frequent words per month, with the share of the month's posts."""
    rows = _monthly_rows(month_profile(posts, n_terms, vocabulary))
    return rows.orderBy("month", F.desc("relative_frequency"), F.desc("count"), "term")


def _last_two_months(profile: DataFrame) -> DataFrame:
    """The profile rows of the two months to compare, each with both names; none if there are not two.

    The windows run over the profile, which has one row per calendar month.
    """
    everything = Window.partitionBy()
    last = F.max("last_time").over(everything)
    last_month = F.date_format(last, "yyyy-MM")
    month = F.col("month").cast("string")
    last_complete = F.last_day(last) == F.to_date(last)
    complete = last.isNull() | (month < last_month) | (last_complete & (month == last_month))
    candidates = (
        profile.withColumn("complete", complete)
        .where(F.col("month").isNotNull() & F.col("complete") & (F.size("terms") > 0))
        .withColumn("recency", F.row_number().over(Window.orderBy(F.desc("month"))))
        .where("recency <= 2")
    )
    return (
        candidates.withColumns(
            {
                "previous_month": F.min("month").over(everything),
                "latest_month": F.max("month").over(everything),
                "months": F.count(F.lit(1)).over(everything),
            }
        )
        .where("months = 2")
        .drop("complete", "recency", "months")
    )


def last_two_months(posts: DataFrame, n_terms: int = settings.TREND_TERMS, vocabulary: DataFrame | None = None) -> DataFrame:
    """One row (previous_month, latest_month), or none.

    A month counts if it holds a vocabulary word; the last one only if the data reach its last day.
    They need not be neighbours in the calendar.
    """
    pair = _last_two_months(month_profile(posts, n_terms, vocabulary))
    return pair.where(F.col("month") == F.col("latest_month")).select("previous_month", "latest_month")


def growing_terms(
    posts: DataFrame,
    n_terms: int = settings.TREND_TERMS,
    top_n: int = settings.GROWING_TERMS,
    vocabulary: DataFrame | None = None,
) -> DataFrame:
    """Words whose share of posts rose between the last two complete months."""
    pair = _last_two_months(month_profile(posts, n_terms, vocabulary))
    latest = F.col("month") == F.col("latest_month")
    totals = Window.partitionBy()
    rows = pair.withColumns(
        {
            "previous_total_posts": F.max(F.when(~latest, F.col("total_posts"))).over(totals),
            "latest_total_posts": F.max(F.when(latest, F.col("total_posts"))).over(totals),
        }
    )
    share = F.col("count") / F.col("total_posts")
    months = ["previous_month", "latest_month", "previous_total_posts", "latest_total_posts"]

    def side(value, is_latest: bool, zero):
        return F.coalesce(F.sum(F.when(latest if is_latest else ~latest, value)), F.lit(zero))

    pivoted = _by_term(rows).groupBy("term", *months).agg(
        side(F.col("count"), False, 0).alias("previous_count"),
        side(F.col("count"), True, 0).alias("latest_count"),
        side(share, False, 0.0).alias("previous_relative_frequency"),
        side(share, True, 0.0).alias("latest_relative_frequency"),
    )
    before, after = F.col("previous_relative_frequency"), F.col("latest_relative_frequency")
    growth = pivoted.withColumns(
        {
            "absolute_growth": F.col("latest_count") - F.col("previous_count"),
            "relative_growth": after - before,
        }
    ).where("relative_growth > 0")
    rate = F.col("relative_growth") / F.when(before > 0, before).otherwise(F.lit(1.0))
    return (
        growth.withColumn("growth_rate", rate)
        .withColumn("growth_percent", F.col("growth_rate") * 100)
        .withColumn("trend_score", F.col("relative_growth") * F.col("latest_count"))
        .select(
            "term",
            "previous_month",
            "latest_month",
            "previous_count",
            "latest_count",
            "absolute_growth",
            "previous_total_posts",
            "latest_total_posts",
            "previous_relative_frequency",
            "latest_relative_frequency",
            "relative_growth",
            "growth_rate",
            "growth_percent",
            "trend_score",
        )
        .orderBy(F.desc("relative_growth"), F.desc("latest_count"), F.desc("absolute_growth"), "term")
        .limit(top_n)
    )
