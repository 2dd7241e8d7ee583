"""Registered queries: every operator over whole tables, as (session, table folder) -> DataFrame.

Two views make posts out of the tables: ``document_posts`` (texts) and ``event_posts`` (ten times as
many rows, no texts); ``untidy_posts`` holds what cleaning is for: missing and padded keys, copies,
null texts, numbers and dates as text in several spellings.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postweave import settings
from postweave.functions.text import sanitize_label
from postweave.functions.dates import EPOCH_UNITS
from postweave.functions.values import engagement_bin, is_present
from postweave.operators.cleaning import ORDER
from postweave.operators import activity, cleaning, growth, sentiment, terms, tfidf, topics, users
from postweave.plans.analysis import Options, analyze_posts
from postweave.plans.quality import quality_counts, quality_report
from postweave.plans.reports import chart_series, run_summary
from postweave.plans.storage import file_bytes, new_path, stored
from postweave.sources.columns import align_schema, fill_optional, map_columns
from postweave.sources.files import limit_rows, load_dataset, scan_csv, scan_json
from postweave.sources.store import RunStore, attach_run_id, stored_schema

# Frequent words of the test texts, as the default lexicons hardly occur in them.
TEST_POSITIVE = ("best", "des", "eau", "que")
TEST_NEGATIVE = ("und", "les", "tion", "der")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Bytes of input files whose rows one task gets where texts are worked on.
DEALT_BYTES = 8 << 20


def dealt(df: DataFrame, key: str, folder: str, *names: str) -> DataFrame:
    """Rows dealt by a key to as many tasks as the named tables have DEALT_BYTES.

    Adaptive execution alone would deal them to as many tasks as there are cores, up to 64 MB each, and the memory of a task that counts
    the phrases of its rows would grow with that. It still does so where the input is too small for more tasks than cores.
    """
    spark = df.sparkSession
    tasks = -(-file_bytes(spark, *(f"{folder}/{name}.parquet" for name in names)) // DEALT_BYTES)
    return df.repartition(tasks, key) if tasks > spark.sparkContext.defaultParallelism else df.repartition(key)


def document_posts(spark: SparkSession, folder: str) -> DataFrame:
    d, e, o = (table(spark, folder, t) for t in ("documents", "events", "orders"))
    # Dealt as the joins need it, so that the text work that follows has many tasks.
    d = dealt(d, "doc_id", folder, "documents")
    joined = d.join(e, d.doc_id == e.event_id).join(o, d.doc_id == o.o_orderkey)
    return joined.select(
        d.doc_id.cast("string").alias("post_id"),
        e.user_id.cast("string").alias("user_id"),
        o.o_orderdate.cast("timestamp_ntz").alias("datetime"),
        F.lit("").alias("title"),
        d.text,
        e.value.alias("likes_count"),
        F.get_json_object(e.props, "$.k").cast("double").alias("comments_count"),
        F.lit(0.0).alias("reposts_count"),
        d.source,
        d.lang.alias("company"),
        F.lit("").alias("url"),
        e.event_type.alias("category"),
    )


def event_posts(spark: SparkSession, folder: str) -> DataFrame:
    e, o = table(spark, folder, "events"), table(spark, folder, "orders")
    posts = e.join(o, e.event_id == o.o_orderkey).select(
        e.event_id.cast("string").alias("post_id"),
        e.user_id.cast("string").alias("user_id"),
        o.o_orderdate.cast("timestamp_ntz").alias("datetime"),
        e.value.alias("likes_count"),
        F.get_json_object(e.props, "$.k").cast("double").alias("comments_count"),
        F.lit(0.0).alias("reposts_count"),
        e.event_type.alias("source"),
        o.o_orderpriority.alias("category"),
    )
    return cleaning.with_engagement(cleaning.with_periods(posts))


def untidy_posts(spark: SparkSession, folder: str) -> DataFrame:
    e, d, o = (table(spark, folder, t) for t in ("events", "documents", "orders"))
    e = e.repartition("event_id")
    joined = e.join(d, e.event_id == d.doc_id, "left").join(o, e.event_id == o.o_orderkey, "left")
    kind = e.event_type
    key = F.coalesce(d.doc_id.cast("string"), F.concat(F.lit("u"), e.user_id))
    slashes = F.concat(F.lit('"'), F.date_format(o.o_orderdate, "MM/dd/yyyy HH:mm"), F.lit('"'))
    return joined.select(
        F.when(kind == "error", " NaN ").otherwise(F.concat(F.lit(" "), key, F.lit("\t"))).alias("post_id"),
        F.when(kind != "signup", e.user_id.cast("string")).alias("user_id"),
        F.when(o.o_orderstatus == "F", F.date_format(o.o_orderdate, "yyyy-MM-dd"))
        .when(o.o_orderstatus == "O", slashes)
        .otherwise("not a date")
        .alias("datetime"),
        F.when(kind != "view", kind).alias("title"),
        d.text,
        F.concat(e.value.cast("string"), F.when(kind == "click", "d").otherwise("")).alias("likes_count"),
        F.get_json_object(e.props, "$.k").alias("comments_count"),
        kind.alias("reposts_count"),
        d.source,
        d.lang.alias("company"),
        F.lit("").alias("url"),
        kind.alias("category"),
        e.event_id,
    )


def token_posts(spark: SparkSession, folder: str) -> DataFrame:
    """document_posts preprocessed: tokens, periods, engagement."""
    return cleaning.preprocess_posts(document_posts(spark, folder))


def scored_posts(spark: SparkSession, folder: str) -> DataFrame:
    return sentiment.with_sentiment(token_posts(spark, folder), TEST_POSITIVE, TEST_NEGATIVE)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded and times as text, so that two engines' results can be compared."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, digits)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
        columns.append(c.alias(f.name))
    return df.select(columns)


Query = Callable[[SparkSession, str], DataFrame]


def _csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "documents") + ".csv"
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.csv(path, header=True, sep=";", quote='"', escape='"')
    return scan_csv(spark, path)


def _multi_line_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as CSV whose texts hold line breaks, quotes and separators, read back in splits."""
    path = new_path(spark, "documents") + ".csv"
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.csv(path, header=True, sep=",", quote='"', escape='"')
    return scan_csv(spark, path, ",", "utf-8", multi_line=True, in_splits=True).drop(ORDER)


def _json_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "conversations") + ".json"
    table(spark, folder, "conversations").write.json(path)
    return scan_json(spark, path).select("conv_id", "turn", "role", "text")


def _load_documents(spark: SparkSession, folder: str) -> DataFrame:
    mapping = {"doc_id": "post_id", "lang": "company", "n_chars": "likes_count"}
    return load_dataset(spark, f"{folder}/documents.parquet", mapping=mapping)[0]


def _stored_table(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs saved, the second read back."""
    store = RunStore(spark, new_path(spark, "run-store"))
    months = activity.posts_by_month(event_posts(spark, folder))
    for run_id in (1, 2):
        store.write(attach_run_id(months, run_id), "trend_posts_by_month")
    return store.read("trend_posts_by_month", run_id=2)


def _epoch_text(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    return e.select("event_id", millis.alias("datetime"))


# The fitted topics of a table folder and the stored posts they were fitted to, for the queries that show them; by application.
_fitted: dict[tuple[str, str], tuple] = {}


def _topic_frames(spark: SparkSession, folder: str):
    """The topic tables of one fit, written once for all queries of a session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _fitted:
        posts = stored(token_posts(spark, folder).select("post_id", "month", "tokens"), "posts")
        tables, model = topics.topic_tables(posts)
        _fitted[key] = {name: stored(frame, name) for name, frame in tables.items()}, model, posts
    return _fitted[key]


def _topic_query(name: str) -> Query:
    return lambda spark, folder: _topic_frames(spark, folder)[0][name]


def _topic_objective(spark: SparkSession, folder: str) -> DataFrame:
    model = _topic_frames(spark, folder)[1]
    return spark.createDataFrame(list(enumerate(model.objective, 1)), "pass int, objective double")


def _topic_certificate(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the fitted topics fulfil the conditions of a minimum: bounds that the fit aims at are passed or not."""
    _, model, posts = _topic_frames(spark, folder)
    found = topics.topic_certificate(topics.topic_vectors(posts, model.space), model)
    row = (found.posts, model.topics, int(found.gradient > settings.TOPIC_TOLERANCE * 1.01), int(found.row_residual > 1e-6))
    return spark.createDataFrame([row], "posts long, topics int, steep int, rows_off int")


def _segment_certificate(spark: SparkSession, folder: str) -> DataFrame:
    features = stored(_features(spark, folder), "features")
    return users.segment_certificate(features, stored(users.segment_users(features), "segments"))


# Spellings in which ``parse_datetime_formats`` writes dates: weekday, half-day and offset names come on top of formats.
SPELLINGS = (
    "M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy h:mm a", "MM/dd/yyyy hh:mm:ss a", "MM.dd.yyyy", "yyyy.MM.dd", "yyyy/M/d",
    "d-MMM-yyyy", "MM-dd-yyyy", "MMM d, yyyy h:mm a", "EEE MMM dd HH:mm:ss '+0000' yyyy", "EEE, dd MMM yyyy HH:mm:ss 'GMT'",
    "yyyyMMdd'T'HHmmss",
)


def _with_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with a time of day and an offset in one of four spellings, which does not move the time."""
    o = table(spark, folder, "orders")
    time = F.timestamp_seconds(F.unix_seconds(o.o_orderdate.cast("timestamp")) + o.o_orderkey * 7919 % 86_400)
    kind = o.o_orderkey % 4
    text = (
        F.when(kind == 0, F.concat(F.date_format(time, "dd MMM yyyy HH:mm:ss"), F.lit(" +0300")))
        .when(kind == 1, F.concat(F.date_format(time, "EEEE, d MMM yyyy H:mm:ss"), F.lit(" GMT-05:30")))
        .when(kind == 2, F.concat(F.date_format(time, "EEE MMM dd HH:mm:ss "), F.lit("-0800 "), F.date_format(time, "yyyy")))
        .otherwise(F.concat(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
    )
    return o.select("o_orderkey", text.alias("datetime"))


def _epoch_units(spark: SparkSession, folder: str) -> DataFrame:
    """Events' times as texts of numbers, read back by unit; units above seconds keep whole ones only."""
    e = table(spark, folder, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"))
    read = []
    for unit, each in EPOCH_UNITS.items():
        number = F.col("micros") * int(1 / each) if each < 1 else F.expr(f"micros div {int(each)}")
        texts = e.select("event_id", F.lit(unit).alias("unit"), number.cast("string").alias("datetime"))
        read.append(cleaning.parse_datetime_column(texts, unit))
    return reduce(DataFrame.unionAll, read)


def _spelled_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with a time of day, written in one of SPELLINGS by key; half of them in lower case."""
    o = table(spark, folder, "orders")
    time = F.timestamp_seconds(F.unix_seconds(o.o_orderdate.cast("timestamp")) + o.o_orderkey * 7919 % 86_400)
    kind = o.o_orderkey % len(SPELLINGS)
    text = reduce(lambda c, k: c.when(kind == k, F.date_format(time, SPELLINGS[k])), range(len(SPELLINGS)), F.when(F.lit(False), ""))
    return o.select("o_orderkey", text.alias("datetime"))


def _spelled_vectors(spark: SparkSession, folder: str):
    posts = stored(token_posts(spark, folder).select("post_id", "tokens"), "posts")
    space = tfidf.fit_tfidf(posts, settings.TOPIC_VOCABULARY)
    return space, stored(space.vectors(posts, "post_id"), "vectors")


def _tfidf_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """(post_id, term, weight) of the vectors that topics are fitted to."""
    space, vectors = _spelled_vectors(spark, folder)
    names = F.array(*map(F.lit, space.vocabulary))
    entries = vectors.select("post_id", F.posexplode(vector_to_array("features")).alias("i", "weight")).where("weight > 0")
    return rounded(entries.select("post_id", F.get(names, "i").alias("term"), "weight"))


def _post_topics_of_given(spark: SparkSession, folder: str) -> DataFrame:
    """Posts under two fixed topics: the even and the odd words by rank, less and less weighty."""
    space, vectors = _spelled_vectors(spark, folder)
    rank = np.arange(len(space.vocabulary))
    weights = np.stack([np.where(rank % 3 != 1, 1 / (rank + 1), 0), np.where(rank % 3 != 0, 1 / (rank + 1), 0)])
    model = topics.TopicModel(space, weights, ())
    return rounded(topics.assign_topics(vectors, model).select("post_id", "topic_id", "topic_weight"))


def _segments_of_given(spark: SparkSession, folder: str) -> DataFrame:
    """Users by the nearest of three fixed centers: all features at -1, 0 and 1 deviations."""
    centers = np.repeat([[-1.0], [0.0], [1.0]], len(users.FEATURES), axis=1)
    return users.assign_segments(users.scaled_features(stored(_features(spark, folder), "features")), centers)


def _two_runs(spark: SparkSession, folder: str) -> RunStore:
    """Two saved runs: months of all events, then of those before 1997; with a quality report each."""
    store = RunStore(spark, new_path(spark, "run-store"))
    posts = event_posts(spark, folder)
    for run_id, some in ((1, posts), (2, posts.where("month < '1997'"))):
        months = stored(activity.posts_by_month(some), "months")
        store.save_tables({"posts_by_month": months}, run_id)
        total = months.agg(F.sum("post_count").alias("n"))
        store.save_quality(total.select(F.lit("loaded_rows").alias("metric_name"), F.col("n").alias("metric_value")), run_id)
        store.record_run(run_id, {"total_rows": total.first().n, "total_users": 0, "top_word": f"run {run_id}"}, "events")
    return store


RUN_COLUMNS = "run_id", "source_name", "status", "total_rows", "top_word", "top_topic"


def _given_topics(spark: SparkSession, folder: str) -> DataFrame:
    """A post_topics table made from columns: the language as topic, the length as weight."""
    d = table(spark, folder, "documents")
    topic = F.instr(F.lit("en de fr es"), F.col("lang")).cast("int")
    return d.select(
        F.col("doc_id").cast("string").alias("post_id"),
        topic.alias("topic_id"),
        F.col("lang").alias("topic_label"),
        (F.col("n_chars") / 1000.0).alias("topic_weight"),
    )


def _tfidf(spark: SparkSession, folder: str) -> DataFrame:
    return tfidf.top_tfidf_terms(stored(token_posts(spark, folder).select("tokens"), "posts"))


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return users.user_features(event_posts(spark, folder))


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    return users.segment_users(stored(_features(spark, folder), "features"))


def _summary(spark: SparkSession, folder: str) -> DataFrame:
    posts = stored(scored_posts(spark, folder).drop("text", "full_text", "clean_text"), "posts")
    tables = {
        "top_words": terms.top_words(posts),
        "top_sources": activity.top_field_values(posts, "source"),
        "sentiment_distribution": sentiment.sentiment_distribution(posts),
    }
    return run_summary(posts, tables).drop("top_topic")


# Summary and written tables of the whole analysis of a table folder, for the three queries that show them; by application.
_analysed: dict[tuple[str, str], tuple[dict, dict[str, DataFrame]]] = {}


def _whole_analysis(spark: SparkSession, folder: str) -> tuple[dict, dict[str, DataFrame]]:
    """The whole analysis with all tables written, once for all queries of a session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _analysed:
        options = Options(order_by=["event_id"], positive_words=TEST_POSITIVE, negative_words=TEST_NEGATIVE)
        with analyze_posts(untidy_posts(spark, folder), options) as result:
            _analysed[key] = result.summary, {name: stored(frame, name) for name, frame in result.tables.items()}
    return _analysed[key]


def _analysis(spark: SparkSession, folder: str) -> DataFrame:
    """The run row of the analysis."""
    summary, _ = _whole_analysis(spark, folder)
    return spark.createDataFrame([tuple(summary.values())], list(summary))


def _analysis_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The cells of the run row that do not come from a fitted model."""
    return _analysis(spark, folder).drop("top_topic")


def _analysis_table_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(table, rows) of the tables of the analysis, but the two whose length depends on which topics the
    fitted model gives to posts."""
    _, tables = _whole_analysis(spark, folder)
    counts = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, frame in tables.items()
        if name not in ("topic_summary", "topics_by_month")
    ]
    return reduce(DataFrame.union, counts)


def _docs(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rounded(operator(document_posts(spark, folder)))


def _words(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rounded(operator(token_posts(spark, folder)))


def _trend(operator: Callable[[DataFrame], DataFrame]) -> Query:
    """On stored tokens, which these operators read twice: for the vocabulary and for the months."""
    return lambda s, f: rounded(operator(stored(token_posts(s, f).select("month", "datetime", "tokens"), "posts")))


def _scored(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rounded(operator(scored_posts(spark, folder)))


def _events(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rounded(operator(event_posts(spark, folder)))


def _untidy(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rounded(operator(untidy_posts(spark, folder)))


def _dated(df: DataFrame) -> DataFrame:
    return cleaning.with_engagement(cleaning.with_periods(df))


def _fields(spark: SparkSession, folder: str) -> DataFrame:
    """Events under their raw names, mapped to post fields."""
    raw = table(spark, folder, "events").withColumnRenamed("event_id", "Message ID").withColumnRenamed("ts", "Date-Posted")
    mapped, _ = map_columns(raw, {"user_id": "user_id", "value": "likes_count", "event_type": "text"})
    return rounded(mapped)


QUERIES: dict[str, Query] = {
    # readers and stored tables
    "scan_csv": _csv_round_trip,
    "scan_csv_multi_line": _multi_line_round_trip,
    "scan_json": _json_round_trip,
    "limit_rows": lambda s, f: limit_rows(
        table(s, f, "documents").select("doc_id", "lang", "source", "n_chars").orderBy("doc_id"), 5000
    ),
    "load_dataset": lambda s, f: rounded(_load_documents(s, f)),
    "read_result_table": _stored_table,
    "attach_run_id": lambda s, f: rounded(attach_run_id(table(s, f, "events"), 7)),
    "recent_runs": lambda s, f: _two_runs(s, f).recent_runs(1).select(*RUN_COLUMNS),
    "latest_run": lambda s, f: s.createDataFrame([(_two_runs(s, f).latest_run_id(),)], "run_id int"),
    "table_count": lambda s, f: s.createDataFrame([(_two_runs(s, f).count("trend_posts_by_month", 2),)], "rows long"),
    "table_preview": lambda s, f: _two_runs(s, f).preview("trend_posts_by_month", 5, 2, ["month"]),
    "saved_quality": lambda s, f: _two_runs(s, f).read("preprocessing_quality_reports"),
    # column names
    "map_columns": _fields,
    "fill_optional": lambda s, f: rounded(fill_optional(table(s, f, "documents").select("doc_id", "text", "source"))),
    "align_schema": _docs(
        lambda d: align_schema(_dated(d).withColumn("run_id", F.lit(1)).drop("url"), stored_schema("processed_posts"))
    ),
    "chart_series": _docs(lambda d: chart_series(activity.top_field_values(d, "source"), "source", "count")),
    # cleaning
    "valid_required": _untidy(lambda d: d.select("event_id", *(is_present(F.col(c)).alias(c) for c in ("post_id", "user_id", "datetime")))),
    "filter_required": _untidy(lambda d: cleaning.filter_required(d).select("event_id", "post_id", "user_id")),
    "dedupe_scanned": lambda s, f: cleaning.dedupe_posts(
        table(s, f, "documents").select(F.coalesce("source", F.lit("none")).alias("post_id"), "doc_id", "lang")
    ),
    "dedupe_posts": _untidy(
        lambda d: cleaning.dedupe_posts(cleaning.trim_keys(cleaning.filter_required(d)), ["event_id"]).select("post_id", "event_id", "title")
    ),
    "fill_text": _untidy(lambda d: cleaning.fill_text(d).select("event_id", "user_id", "title", "text")),
    "coerce_numeric": _untidy(
        lambda d: cleaning.coerce_numeric(d).select("event_id", "likes_count", "comments_count", "reposts_count")
    ),
    "filter_empty_text": _untidy(lambda d: cleaning.filter_empty_text(cleaning.fill_text(d)).select("event_id", "title")),
    "filter_empty_clean": _docs(
        lambda d: cleaning.filter_empty_clean(cleaning.with_tokens(d)).select("post_id", "source")
    ),
    "parse_datetime": _untidy(lambda d: cleaning.parse_datetime_column(d).select("event_id", "datetime")),
    "parse_datetime_formats": lambda s, f: rounded(cleaning.parse_datetime_column(_spelled_dates(s, f), "format")),
    "parse_datetime_epoch": lambda s, f: rounded(cleaning.parse_datetime_column(_epoch_text(s, f))),
    "parse_datetime_offsets": lambda s, f: rounded(cleaning.parse_datetime_column(_with_offsets(s, f), "format")),
    "parse_datetime_units": lambda s, f: rounded(_epoch_units(s, f)),
    "filter_datetime": _untidy(
        lambda d: cleaning.filter_datetime(cleaning.parse_datetime_column(d, "format")).select("event_id", "datetime")
    ),
    "validate_posts": _untidy(lambda d: cleaning.validate_posts(d, ["event_id"]).drop("url", "company")),
    "preprocess_posts": _untidy(
        lambda d: cleaning.preprocess_posts(cleaning.validate_posts(d, ["event_id"])).select(
            "post_id", "user_id", "datetime", "full_text", "clean_text", "date", "month", "likes_count",
            "engagement_score", "text_length",
        )
    ),
    "quality_report": _untidy(lambda d: quality_report(quality_counts(d, ["event_id"]))),
    # scalar expressions
    "clean_text": _docs(lambda d: cleaning.with_clean_text(d).select("post_id", "cleaned")),
    "tokens": _docs(
        lambda d: cleaning.with_tokens(d).select("post_id", F.posexplode("tokens").alias("position", "token"))
    ),
    "normalize_text": _docs(lambda d: cleaning.with_tokens(d).select("post_id", "clean_text")),
    "post_periods": _docs(lambda d: cleaning.with_periods(d).select("post_id", "date", "month")),
    "engagement_score": _docs(lambda d: cleaning.with_engagement(d).select("post_id", "engagement_score")),
    "text_length": _docs(lambda d: cleaning.with_text_length(cleaning.with_tokens(d)).select("post_id", "text_length")),
    "sanitize_label": lambda s, f: table(s, f, "events").select("event_id", sanitize_label(F.col("props")).alias("label")),
    "sentiment_columns": _scored(
        lambda d: d.select("post_id", "positive_word_count", "negative_word_count", "sentiment_score", "sentiment_label")
    ),
    "activity_label": lambda s, f: users.with_activity_label(_features(s, f)).select("user_id", "segment_label"),
    "engagement_bin": _events(lambda d: d.select("post_id", engagement_bin(F.col("engagement_score")).alias("engagement_group"))),
    # words
    "top_words": _words(terms.top_words),
    "top_ngrams": _words(lambda d: terms.top_ngrams(d, 4)),
    "top_bigrams": _words(terms.top_bigrams),
    "top_trigrams": _words(terms.top_trigrams),
    "tfidf_terms": lambda s, f: rounded(_tfidf(s, f)),
    "trend_vocabulary": _words(growth.trend_vocabulary),
    "terms_by_month": _trend(growth.terms_by_month),
    "last_two_months": _trend(growth.last_two_months),
    "growing_terms": _trend(growth.growing_terms),
    # periods and fields
    "posts_by_date": _events(activity.posts_by_date),
    "posts_by_month": _events(activity.posts_by_month),
    "top_sources": _docs(lambda d: activity.top_field_values(d, "source")),
    "top_companies": _docs(lambda d: activity.top_field_values(d, "company")),
    "top_categories": _docs(lambda d: activity.top_field_values(d, "category")),
    "engagement_distribution": _events(activity.engagement_distribution),
    # sentiment
    "sentiment_distribution": _scored(sentiment.sentiment_distribution),
    "sentiment_by_month": _scored(sentiment.sentiment_by_month),
    "sentiment_by_source": _scored(sentiment.sentiment_by_source),
    # users
    "top_users": _events(users.top_users),
    "top_users_engagement": _events(users.top_users_engagement),
    "user_distribution": _docs(users.user_distribution),
    "user_activity_by_month": _events(users.user_activity_by_month),
    "user_features": lambda s, f: rounded(_features(s, f)),
    "user_segments": _segments,
    "user_segment_labels": lambda s, f: rounded(users.with_activity_label(_features(s, f)).select("user_id", *users.FEATURES, "segment_label")),
    "segment_assignment_of_given": _segments_of_given,
    "user_segment_distribution": lambda s, f: rounded(
        users.user_segment_distribution(users.with_activity_label(_features(s, f)))
    ),
    # topics
    "topic_model": _topic_objective,
    "topic_certificate": _topic_certificate,
    "segment_certificate": _segment_certificate,
    "topic_terms": _topic_query("topic_terms"),
    "post_topics": _topic_query("post_topics"),
    "topic_summary": _topic_query("topic_summary"),
    "topics_by_month": _topic_query("topics_by_month"),
    "tfidf_vectors": _tfidf_vectors,
    "post_topics_of_given": _post_topics_of_given,
    "topic_summary_of_given": lambda s, f: rounded(topics.topic_summary(_given_topics(s, f))),
    "topics_by_month_of_given": lambda s, f: rounded(
        topics.topics_by_month(_given_topics(s, f), _dated(document_posts(s, f)))
    ),
    # runs
    "run_summary": _summary,
    "analysis": _analysis,
    "analysis_summary": _analysis_summary,
    "analysis_table_rows": _analysis_table_rows,
}
