"""Result store: one Parquet table per result, partitioned by run.

A run's partitions are overwritten as a whole, and its row in ``analysis_runs`` is written last. A
failed save can therefore be repeated: it gets the same run_id and replaces what it had written.
One writer at a time gives out run ids.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from multiprocessing.pool import ThreadPool

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postweave.sources.columns import align_schema

RUNS = "analysis_runs"
POSTS = "processed_posts"
QUALITY = "preprocessing_quality_reports"

_TERM_GROWTH = """
    term string, previous_month string, latest_month string, previous_count bigint, latest_count bigint,
    absolute_growth bigint, previous_total_posts bigint, latest_total_posts bigint,
    previous_relative_frequency double, latest_relative_frequency double, relative_growth double,
    growth_rate double, growth_percent double, trend_score double
"""
_USER_FEATURES = """
    user_id string, posts_count bigint, avg_likes double, avg_comments double, total_comments double,
    total_engagement double, avg_engagement double, unique_sources bigint, unique_categories bigint,
    active_months bigint
"""

# Stored tables and their columns after run_id.
STORED_COLUMNS = {
    RUNS: """
        created_at timestamp_ntz, started_at timestamp_ntz, finished_at timestamp_ntz, source_name string,
        nrows_limit bigint, status string, error_message string, total_rows bigint, total_users bigint,
        top_word string, top_source string, top_topic string, dominant_sentiment string
    """,
    QUALITY: "metric_name string, metric_value string",
    POSTS: """
        post_id string, title string, text string, created_utc double, datetime timestamp_ntz, user_id string,
        likes_count double, comments_count double, upvote_ratio double, category string, permalink string,
        url string, source string, company string, reposts_count double, full_text string, clean_text string,
        date date, month string, engagement_score double, text_length int, positive_word_count int,
        negative_word_count int, sentiment_score double, sentiment_label string
    """,
    "trend_top_words": "word string, count bigint",
    "trend_top_bigrams": "bigram string, count bigint",
    "trend_top_trigrams": "trigram string, count bigint",
    "trend_tfidf_terms": "term string, score double",
    "trend_posts_by_date": "date date, post_count bigint",
    "trend_posts_by_month": "month string, post_count bigint",
    "trend_top_sources": "source string, count bigint",
    "trend_top_companies": "company string, count bigint",
    "trend_top_categories": "category string, count bigint",
    "trend_terms_by_month": """
        month string, term string, count bigint, total_posts_in_month bigint, relative_frequency double
    """,
    "trend_growing_terms": _TERM_GROWTH,
    "sentiment_distribution": "sentiment_label string, posts_count bigint, avg_sentiment_score double",
    "sentiment_by_month": "month string, sentiment_label string, posts_count bigint, avg_sentiment_score double",
    "sentiment_by_source": "source string, sentiment_label string, posts_count bigint, avg_sentiment_score double",
    "topic_terms": "topic_id int, topic_label string, term string, weight double, term_rank int",
    "post_topics": "post_id string, topic_id int, topic_label string, topic_weight double",
    "topic_summary": "topic_id int, topic_label string, posts_count bigint, avg_topic_weight double",
    "topics_by_month": """
        month string, topic_id int, topic_label string, posts_count bigint, avg_topic_weight double
    """,
    "user_top_users": """
        user_id string, posts_count bigint, avg_likes double, total_comments double, total_engagement double,
        avg_engagement double
    """,
    "user_top_users_engagement": "user_id string, posts_count bigint, total_engagement double, avg_engagement double",
    "user_distribution": "activity_group string, users_count bigint",
    "user_activity_by_month": "month string, unique_users bigint, total_posts bigint, avg_engagement double",
    "user_engagement_distribution": "engagement_group string, posts_count bigint",
    "user_features": _USER_FEATURES,
    "user_segments": f"{_USER_FEATURES}, segment_label string, segment_id int",
    "user_segment_distribution": """
        segment_label string, users_count bigint, avg_posts_count double, avg_engagement double
    """,
}

# Stored names that differ from the result names.
STORED_NAMES = {
    "top_words": "trend_top_words",
    "top_bigrams": "trend_top_bigrams",
    "top_trigrams": "trend_top_trigrams",
    "tfidf_terms": "trend_tfidf_terms",
    "posts_by_date": "trend_posts_by_date",
    "posts_by_month": "trend_posts_by_month",
    "top_sources": "trend_top_sources",
    "top_companies": "trend_top_companies",
    "top_categories": "trend_top_categories",
    "terms_by_month": "trend_terms_by_month",
    "growing_terms": "trend_growing_terms",
    "top_users": "user_top_users",
    "top_users_engagement": "user_top_users_engagement",
    "engagement_distribution": "user_engagement_distribution",
}


def stored_schema(table: str) -> T.StructType:
    """run_id and the table's columns."""
    if table not in STORED_COLUMNS:
        raise ValueError(f"unknown table: {table}")
    return T.StructType.fromDDL(f"run_id int, {STORED_COLUMNS[table]}")


def attach_run_id(df: DataFrame, run_id: int) -> DataFrame:
    """The frame with run_id as its first column, or overwritten where it already has one."""
    number = F.lit(run_id).cast("int").alias("run_id")
    if "run_id" in df.columns:
        return df.select([number if c == "run_id" else F.col(c) for c in df.columns])
    return df.select(number, "*")


class RunStore:
    """Saved runs under one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def exists(self, table: str) -> bool:
        try:
            self.spark.read.schema(stored_schema(table)).parquet(self._path(table))
        except AnalysisException:
            return False
        return True

    def table_names(self) -> list[str]:
        """Stored tables, sorted."""
        return sorted(t for t in STORED_COLUMNS if self.exists(t))

    def has_run_id(self, table: str) -> bool:
        return "run_id" in stored_schema(table).names

    def read(self, table: str, limit: int | None = None, run_id: int | None = None) -> DataFrame:
        """A table, or one run of it: the filter on run_id prunes the scan to that partition."""
        schema = stored_schema(table)
        df = self.spark.read.schema(schema).parquet(self._path(table)).select(schema.names)
        if run_id is not None and self.has_run_id(table):
            df = df.where(F.col("run_id") == run_id)
        return df if limit is None else df.limit(limit)

    def count(self, table: str, run_id: int | None = None) -> int:
        return self.read(table, run_id=run_id).count()

    def preview(self, table: str, limit: int = 20, run_id: int | None = None, order_by: Sequence[str] = ()) -> DataFrame:
        """Some rows of a table; with ``order_by`` the first ones."""
        rows = self.read(table, run_id=run_id)
        return (rows.orderBy(*order_by) if order_by else rows).limit(limit)

    def latest_run_id(self) -> int | None:
        if not self.exists(RUNS):
            return None
        return self.read(RUNS).agg(F.max("run_id").alias("latest")).first().latest

    def recent_runs(self, limit: int = 10) -> DataFrame:
        return self.read(RUNS).orderBy(F.desc("run_id")).limit(limit)

    def write(self, df: DataFrame, table: str, replace: bool = False) -> None:
        """Add rows, aligned to the stored schema. Whole run partitions are overwritten, other runs
        stay; ``replace`` drops all runs of the table first."""
        out = align_schema(df, stored_schema(table))
        mode = "static" if replace else "dynamic"
        out.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("run_id").parquet(self._path(table))

    def save_quality(self, report: DataFrame, run_id: int) -> None:
        text = report.withColumn("metric_value", F.col("metric_value").cast("string"))
        self.write(attach_run_id(text, run_id), QUALITY)

    def save_tables(self, tables: Mapping[str, DataFrame], run_id: int, parallelism: int = 4) -> None:
        """Write result tables under their stored names, several at a time."""

        def save(name: str) -> None:
            self.write(attach_run_id(tables[name], run_id), STORED_NAMES.get(name, name))

        with ThreadPool(parallelism) as pool:
            pool.map(save, list(tables), chunksize=1)

    def record_run(
        self,
        run_id: int,
        summary: Mapping[str, object],
        source_name: str | None = None,
        nrows_limit: int | None = None,
        started: datetime | None = None,
        status: str = "finished",
        error_message: str | None = None,
    ) -> None:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        row = {
            "run_id": run_id,
            "created_at": now,
            "started_at": started or now,
            "finished_at": now,
            "source_name": source_name,
            "nrows_limit": nrows_limit,
            "status": status,
            "error_message": error_message,
            **{k: summary[k] for k in ("total_rows", "total_users")},
            **{k: str(summary.get(k) or "n/a") for k in ("top_word", "top_source", "top_topic", "dominant_sentiment")},
        }
        schema = stored_schema(RUNS)
        self.write(self.spark.createDataFrame([tuple(row[c] for c in schema.names)], schema), RUNS)

    def save_run(self, result, source_name: str | None = None, nrows_limit: int | None = None) -> int:
        """Save posts, quality report and all tables of an analysis; returns the new run_id."""
        started = datetime.now(timezone.utc).replace(tzinfo=None)
        run_id = (self.latest_run_id() or 0) + 1
        self.write(attach_run_id(result.posts, run_id), POSTS)
        self.save_quality(result.quality_report, run_id)
        self.save_tables(result.tables, run_id)
        self.record_run(run_id, result.summary, source_name, nrows_limit, started)
        return run_id
