"""Run summary, report texts and chart series."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postweave.functions.text import sanitize_label
from postweave.plans.quality import METRICS

# Titles and line labels of the text reports.
SUMMARY_TITLE = "Краткая сводка по результатам анализа"
SUMMARY_LINES = (
    ("Количество записей", "total_rows"),
    ("Количество уникальных пользователей", "total_users"),
    ("Наиболее частотное слово", "top_word"),
    ("Наиболее частый источник/категория", "top_source"),
)
QUALITY_TITLE = "Журнал качества предобработки данных"


@dataclass(frozen=True)
class Chart:
    kind: str
    label: str
    value: str
    title: str
    interactive: bool = True


# Which columns of which result table make a chart.
CHARTS = {
    "top_words": Chart("bar", "word", "count", "Top words"),
    "top_bigrams": Chart("bar", "bigram", "count", "Top bigrams", interactive=False),
    "top_trigrams": Chart("bar", "trigram", "count", "Top trigrams", interactive=False),
    "posts_by_date": Chart("line", "date", "post_count", "Posts by date"),
    "posts_by_month": Chart("line", "month", "post_count", "Posts by month"),
    "top_sources": Chart("bar", "source", "count", "Top sources"),
    "top_categories": Chart("bar", "category", "count", "Top categories"),
    "growing_terms": Chart("bar", "term", "absolute_growth", "Growing terms"),
    "sentiment_distribution": Chart("bar", "sentiment_label", "posts_count", "Sentiment distribution"),
    "topic_summary": Chart("bar", "topic_label", "posts_count", "Topic summary"),
    "top_users": Chart("bar", "user_id", "posts_count", "Top active users"),
    "user_distribution": Chart("bar", "activity_group", "users_count", "User activity distribution"),
    "engagement_distribution": Chart("bar", "engagement_group", "posts_count", "Engagement distribution"),
    "user_segment_distribution": Chart("bar", "segment_label", "users_count", "User segment distribution"),
    "user_activity_by_month": Chart("line", "month", "total_posts", "User activity by month"),
}


def chart_series(table: DataFrame, label: str, value: str, sanitize: bool = True) -> DataFrame | None:
    """(label, value) of a result table; None if it lacks one of the columns."""
    if label not in table.columns or value not in table.columns:
        return None
    text = sanitize_label(F.col(label)) if sanitize else F.col(label).cast("string")
    return table.select(text.alias("label"), F.col(value).alias("value"))


def all_chart_series(tables: Mapping[str, DataFrame], interactive: bool = False) -> dict[str, DataFrame]:
    """Series of every chart whose table is there. Interactive charts keep their labels as they are."""
    chosen = {name: chart for name, chart in CHARTS.items() if name in tables and (chart.interactive or not interactive)}
    series = {n: chart_series(tables[n], c.label, c.value, sanitize=not interactive) for n, c in chosen.items()}
    return {name: frame for name, frame in series.items() if frame is not None}


def _first(table: DataFrame, column: str, order, name: str) -> DataFrame:
    """One row with the leading value of an ordered table, or n/a."""
    best = table.orderBy(*order).limit(1)
    return best.agg(F.coalesce(F.max(F.col(column).cast("string")), F.lit("n/a")).alias(name))


def run_summary(posts: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row: posts, distinct users and the leading word, source, topic and sentiment."""
    leaders = {
        "top_word": ("top_words", "word", [F.desc("count"), "word"]),
        "top_source": ("top_sources", "source", [F.desc("count"), "source"]),
        "top_topic": ("topic_summary", "topic_label", [F.desc("posts_count"), "topic_id"]),
        "dominant_sentiment": ("sentiment_distribution", "sentiment_label", [F.desc("posts_count"), "sentiment_label"]),
    }
    summary = posts.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct("user_id").alias("total_users"))
    columns = [F.col("total_rows"), F.col("total_users")]
    for name, (table, column, order) in leaders.items():
        found = F.lit("n/a") if table not in tables else _first(tables[table], column, order, name).scalar()
        columns.append(found.alias(name))
    return summary.select(columns)


def summary_lines(summary: DataFrame) -> DataFrame:
    """The summary as text lines."""
    lines = [F.lit(SUMMARY_TITLE)]
    lines += [F.concat(F.lit(f"{label}: "), F.col(c).cast("string")) for label, c in SUMMARY_LINES]
    return summary.select(F.explode(F.array(*lines)).alias("line"))


def quality_lines(report: DataFrame) -> DataFrame:
    """The quality report as text lines; none for an empty report."""
    entry = F.concat_ws(": ", F.col("metric_name"), F.col("metric_value").cast("string"))
    place = F.array_position(F.array(*map(F.lit, METRICS)), F.col("metric_name"))
    placed = F.array_sort(F.collect_list(F.struct(place.alias("place"), entry.alias("entry"))))
    entries = report.agg(placed.alias("entries")).where(F.size("entries") > 0)
    entries = entries.select(F.col("entries.entry").alias("entries"))
    return entries.select(F.explode(F.concat(F.array(F.lit(QUALITY_TITLE)), F.col("entries"))).alias("line"))
