"""The whole analysis: from raw posts to 26 result tables and a summary."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postweave import settings
from postweave.functions.dates import DATETIME_FORMATS, EPOCH_UNITS, day_first
from postweave.operators import activity, growth, sentiment, terms, tfidf, topics, users
from postweave.operators.cleaning import (
    READINGS,
    coerce_numeric,
    dedupe_posts,
    fill_text,
    filter_required,
    full_text,
    some_text,
    trim_keys,
    with_engagement,
    with_input_order,
    with_periods,
    with_text_length,
    with_tokens,
)
from postweave.plans.quality import report_frame, stage_counts, stage_flags
from postweave.plans.reports import run_summary
from postweave.plans.storage import delete, stored, work_folder
from postweave.sources.columns import ColumnMatch, check_fields, fill_optional, map_columns
from postweave.sources.files import load_dataset


@dataclass(frozen=True)
class Options:
    """Parameters of an analysis; the defaults are those of the single operators.

    ``order_by`` names the columns that tell which copy of a post comes first; a scan of files needs none. ``reading``
    says how dates are written (see ``parse_datetime_column``), ``auto`` finds it.
    """

    order_by: Sequence[str] | None = None
    formats: Sequence[str] = DATETIME_FORMATS
    reading: str = "auto"
    dayfirst: bool = False
    drop_empty: bool = True
    stop_words: Iterable[str] | None = None
    extra_stop_words: Iterable[str] = ()
    min_token_length: int = settings.MIN_TOKEN_LENGTH
    positive_words: Iterable[str] = settings.POSITIVE_WORDS
    negative_words: Iterable[str] = settings.NEGATIVE_WORDS
    positive_above: float = settings.POSITIVE_ABOVE
    negative_below: float = settings.NEGATIVE_BELOW
    top_words: int = settings.TOP_WORDS
    top_ngrams: int = settings.TOP_NGRAMS
    top_users: int = settings.TOP_USERS
    top_values: int = settings.TOP_FIELD_VALUES
    trend_terms: int = settings.TREND_TERMS
    growing_terms: int = settings.GROWING_TERMS
    tfidf_vocabulary: int = settings.TFIDF_VOCABULARY
    topics: int = settings.TOPICS
    topic_terms: int = settings.TOPIC_TERMS
    topic_vocabulary: int = settings.TOPIC_VOCABULARY
    topic_iterations: int = settings.TOPIC_ITERATIONS
    segments: int = settings.SEGMENTS
    segment_starts: int = settings.SEGMENT_STARTS
    snapshots: str | None = None


@dataclass(frozen=True)
class AnalysisResult:
    """Tables are lazy scans over stored posts, except the fitted topic and cluster models.

    The stored posts, vectors and features lie in ``work`` until ``close``; what was saved elsewhere stays.
    """

    posts: DataFrame
    tables: dict[str, DataFrame]
    summary: dict[str, object]
    quality: dict[str, int]
    quality_report: DataFrame
    match: ColumnMatch | None = field(default=None)
    work: str | None = field(default=None)

    def close(self) -> None:
        """Delete the intermediate tables; the lazy tables can't be read afterwards."""
        if self.work:
            delete(self.posts.sparkSession, self.work)

    def __enter__(self) -> AnalysisResult:
        return self

    def __exit__(self, *_) -> None:
        self.close()


# Columns of the stage table that later stages test, and those that are derived again when read.
STAGE_COLUMNS = ("_has_text", "_has_words", *READINGS)
DERIVED_TEXTS = ("full_text", "clean_text")


def stage_posts(raw: DataFrame, options: Options) -> DataFrame:
    """Required, unique posts with tokens, sentiment and the tests of all later stages; stored once.

    This is the one heavy pass: it reads the input, shuffles it for the dedupe, tokenises and
    scores. Texts that follow from the others are not stored.
    """
    ordered = with_input_order(raw, options.order_by)
    posts = fill_text(dedupe_posts(trim_keys(filter_required(ordered))))
    has_text_ = some_text(posts) if options.drop_empty else F.lit(True)
    posts = with_tokens(
        posts.withColumn("_has_text", has_text_),
        stop_words=options.stop_words,
        extra_stop_words=options.extra_stop_words,
        min_length=options.min_token_length,
    )
    formats = day_first(options.formats) if options.dayfirst else options.formats
    # A unit that ``auto`` does not try takes the place of the seconds.
    units = (options.reading, "milli") if options.reading in EPOCH_UNITS and options.reading != "milli" else ("second", "milli")
    flagged = stage_flags(coerce_numeric(posts), formats, options.drop_empty, units)
    scored = sentiment.with_sentiment(
        flagged, options.positive_words, options.negative_words, options.positive_above, options.negative_below
    )
    return stored(scored.drop(*DERIVED_TEXTS), "staged", options.snapshots)


def clean_posts(raw: DataFrame, options: Options) -> tuple[DataFrame, dict]:
    """Validated and preprocessed posts as a lazy filter on the stage table, and all stage counts.

    The counts and the reading of the dates come from narrow scans of the stage table, so nothing is
    tokenised or shuffled twice and a repeated task cannot count a row twice.
    """
    staged = stage_posts(raw, options)
    counts = stage_counts(raw, staged, "second" if options.reading in EPOCH_UNITS and options.reading != "milli" else options.reading)
    dated = staged.where("_has_words").withColumn("datetime", F.col(counts["reading"]))
    posts = dated.where(F.col("datetime").isNotNull()).drop(*STAGE_COLUMNS)
    posts = with_text_length(with_engagement(with_periods(posts)))
    posts = posts.withColumns({"full_text": full_text(posts), "clean_text": F.array_join("tokens", " ")})
    if options.snapshots:
        stored(staged.where("_has_text").drop("tokens", *STAGE_COLUMNS), "validated", options.snapshots)
        posts = stored(posts, "cleaned", options.snapshots)
    return posts, counts


def analyze_posts(raw: DataFrame, options: Options | None = None, match: ColumnMatch | None = None) -> AnalysisResult:
    """Analyse posts that already have the canonical columns. The result owns its intermediate tables."""
    with work_folder(raw.sparkSession, "analysis") as work:
        return _analyze(raw, options or Options(), match, work)


def _analyze(raw: DataFrame, options: Options, match: ColumnMatch | None, work: str) -> AnalysisResult:
    spark = raw.sparkSession
    posts, counts = clean_posts(fill_optional(raw), options)

    # One word count serves every vocabulary: all of them are its first rows.
    most = max(options.topic_vocabulary, options.tfidf_vocabulary, options.trend_terms, options.top_words)
    ranked = [(row.term, row["count"]) for row in terms.top_terms(posts, most).collect()]
    vocabulary = [term for term, _ in ranked]
    counted = spark.createDataFrame(ranked, "word string, count bigint")
    trend = spark.createDataFrame([(t,) for t in vocabulary[: options.trend_terms]], "term string")

    space = tfidf.fit_tfidf(posts, most, vocabulary)
    topic_frames, _ = topics.topic_tables(
        posts,
        options.topics,
        options.topic_terms,
        max_iter=options.topic_iterations,
        space=space.leading(options.topic_vocabulary),
    )
    features = stored(users.user_features(posts), "user-features")
    segments = users.segment_users(features, options.segments, options.segment_starts)

    tables = {
        "top_words": counted.orderBy(F.desc("count"), "word").limit(options.top_words),
        "top_bigrams": terms.top_bigrams(posts, options.top_ngrams),
        "top_trigrams": terms.top_trigrams(posts, options.top_ngrams),
        "tfidf_terms": tfidf.top_tfidf_terms(posts, options.top_words, space=space.leading(options.tfidf_vocabulary)),
        "posts_by_date": activity.posts_by_date(posts),
        "posts_by_month": activity.posts_by_month(posts),
        "top_sources": activity.top_field_values(posts, "source", options.top_values),
        "top_companies": activity.top_field_values(posts, "company", options.top_values),
        "top_categories": activity.top_field_values(posts, "category", options.top_values),
        "terms_by_month": growth.terms_by_month(posts, vocabulary=trend),
        "growing_terms": growth.growing_terms(posts, top_n=options.growing_terms, vocabulary=trend),
        "sentiment_distribution": sentiment.sentiment_distribution(posts),
        "sentiment_by_month": sentiment.sentiment_by_month(posts),
        "sentiment_by_source": sentiment.sentiment_by_source(posts),
        **topic_frames,
        "top_users": users.top_users(posts, options.top_users),
        "top_users_engagement": users.top_users_engagement(posts, options.top_users),
        "user_distribution": users.user_distribution(posts),
        "user_activity_by_month": users.user_activity_by_month(posts),
        "engagement_distribution": activity.engagement_distribution(posts),
        "user_features": features,
        "user_segments": segments,
        "user_segment_distribution": users.user_segment_distribution(segments),
    }
    summary = run_summary(posts, tables).first().asDict()
    counts = {k: v for k, v in counts.items() if k != "reading"}
    return AnalysisResult(posts.drop("tokens"), tables, summary, counts, report_frame(spark, counts), match, work)


def analyze(
    spark: SparkSession,
    path: str,
    n_rows: int | None = None,
    mapping: Mapping[str, str] | None = None,
    options: Options | None = None,
    **read_options,
) -> AnalysisResult:
    """Read a file of posts, map its columns, check them and analyse."""
    options = options or Options()
    keep_order = not options.order_by
    mapped, match = load_dataset(spark, path, n_rows, mapping, options.snapshots, keep_order, **read_options)
    check_fields(mapped, match)
    return analyze_posts(mapped, options, match)


def analyze_frame(
    raw: DataFrame, mapping: Mapping[str, str] | None = None, options: Options | None = None
) -> AnalysisResult:
    """The same for a frame with raw column names."""
    mapped, match = map_columns(raw, mapping)
    check_fields(mapped, match)
    return analyze_posts(fill_optional(mapped), options, match)
