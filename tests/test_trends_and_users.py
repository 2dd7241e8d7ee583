"""Words, growth, sentiment, users, topics, reports and the run store on small inputs."""

import math
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from postweave.operators import activity, growth, sentiment, terms, tfidf, topics, users
from postweave.plans import catalog, reports
from postweave.plans.analysis import Options, analyze_frame, analyze_posts
from postweave.plans.storage import stored
from postweave.sources import sinks
from postweave.sources.store import STORED_COLUMNS, RunStore, attach_run_id, stored_schema


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "clean_text string")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_top_words(spark):
    assert rows(terms.top_words(texts(spark, "apple stock growth", "apple market growth", None, " "), 3)) == [
        ("apple", 2), ("growth", 2), ("market", 1),
    ]


def test_ngrams_stay_within_a_post(spark):
    df = texts(spark, "apple stock growth", "apple stock market", "one", "", None)
    assert rows(terms.top_bigrams(df, 3)) == [("apple stock", 2), ("stock growth", 1), ("stock market", 1)]
    assert rows(terms.top_trigrams(df)) == [("apple stock growth", 1), ("apple stock market", 1)]
    assert terms.top_ngrams(df, 4).columns == ["ngram", "count"] and rows(terms.top_ngrams(df, 4)) == []
    assert rows(terms.top_ngrams(df, 1, 1)) == [("apple", 2)]


def test_ngrams_of_one_hot_post(spark):
    """One very long post: counted by brute force."""
    words = [f"w{i % 7}" for i in range(20000)]
    expected = Counter(zip(words, words[1:], words[2:]))
    found = dict(rows(terms.top_trigrams(texts(spark, " ".join(words)), 100)))
    assert found == {" ".join(k): v for k, v in expected.items()}


def test_tfidf(spark):
    df = texts(spark, "apple stock growth", "apple market growth")
    found = {t: round(s, 6) for t, s in rows(tfidf.top_tfidf_terms(df, 4))}
    assert found == {"apple": 0.501549, "growth": 0.501549, "market": 0.352455, "stock": 0.352455}
    assert rows(tfidf.top_tfidf_terms(texts(spark, "", None))) == []


def test_tfidf_mean_counts_posts_without_vocabulary_words(spark):
    df = texts(spark, "aa aa aa", "aa bb", "cc dd")
    found = rows(tfidf.top_tfidf_terms(df, 5, max_features=1))
    assert found == [("aa", pytest.approx(2 / 3))]


MONTHLY = [("2024-01", "apple banana"), ("2024-01", "banana"), ("2024-02", "apple apple"), ("2024-02", "apple"), ("2024-02", "cherry")]


def test_growth_without_times(spark):
    df = spark.createDataFrame(MONTHLY, "month string, clean_text string")
    found = growth.growing_terms(df, 3, 3).collect()
    apple, cherry = found
    assert (apple.term, apple.previous_count, apple.latest_count, apple.absolute_growth) == ("apple", 1, 3, 2)
    assert (apple.previous_total_posts, apple.latest_total_posts) == (2, 3)
    assert (apple.relative_growth, apple.growth_rate, apple.growth_percent, apple.trend_score) == (0.5, 1.0, 100.0, 1.5)
    assert cherry.term == "cherry" and cherry.growth_percent == pytest.approx(100 / 3)
    monthly = rows(growth.terms_by_month(df, 3))
    assert monthly[0] == ("2024-01", "banana", 2, 2, 1.0) and len(monthly) == 4


@pytest.mark.parametrize("last, pair", [("2024-02-29", ("2024-01", "2024-02")), ("2024-02-28", None)])
def test_last_month_must_be_complete(spark, last, pair):
    df = spark.createDataFrame(MONTHLY, "month string, clean_text string")
    df = df.withColumn("datetime", F.lit(last).cast("timestamp_ntz"))
    assert rows(growth.last_two_months(df, 3)) == ([pair] if pair else [])
    assert (growth.growing_terms(df, 3).count() > 0) == bool(pair)


def test_compared_months_need_not_be_neighbours(spark):
    days = ["2024-01-10", "2024-03-10", "2024-04-10"]
    df = spark.createDataFrame([(d[:7], "word", d) for d in days], "month string, clean_text string, d string")
    df = df.withColumn("datetime", F.col("d").cast("timestamp_ntz"))
    assert rows(growth.last_two_months(df)) == [("2024-01", "2024-03")]


def test_totals_count_posts_without_words_and_skip_missing_months(spark):
    data = [("2024-01", "apple"), ("2024-01", ""), (None, "apple"), ("2024-02", "pear")]
    df = spark.createDataFrame(data, "month string, clean_text string")
    assert rows(growth.terms_by_month(df)) == [("2024-01", "apple", 1, 2, 0.5), ("2024-02", "pear", 1, 1, 1.0)]


def test_sentiment(spark):
    data = [("1", "good useful product"), ("2", "bad terrible problem"), ("3", "ordinary text"), ("4", "good good bad")]
    df = sentiment.with_sentiment(spark.createDataFrame(data, "post_id string, clean_text string"))
    found = rows(df.select("positive_word_count", "negative_word_count", "sentiment_score", "sentiment_label").orderBy("post_id"))
    assert found == [(2, 0, 1.0, "positive"), (0, 3, -1.0, "negative"), (0, 0, 0.0, "neutral"), (2, 1, pytest.approx(1 / 3), "positive")]
    assert df.columns[:2] == ["post_id", "clean_text"] and "_words" not in df.columns
    assert rows(sentiment.sentiment_distribution(df))[0] == ("positive", 2, pytest.approx(2 / 3))
    with pytest.raises(ValueError):
        sentiment.with_sentiment(spark.createDataFrame([("1",)], "post_id string"))


def test_top_users(spark):
    data = [(1, "u1", 10, 2, 0, 12), (2, "u1", 5, 1, 0, 6), (3, "u2", 3, 1, 0, 4), (4, None, 1, 1, 1, 3)]
    df = spark.createDataFrame(
        data, "post_id int, user_id string, likes_count int, comments_count int, reposts_count int, engagement_score int"
    )
    assert rows(users.top_users(df)) == [("u1", 2, 7.5, 3, 18, 9.0), ("u2", 1, 3.0, 1, 4, 4.0)]
    assert rows(users.top_users_engagement(df, 1)) == [("u1", 2, 18, 9.0)]
    found = users.user_features(df).where("user_id = 'u1'").first()
    assert (found.unique_sources, found.unique_categories, found.active_months) == (0, 0, 0)


SEGMENTED = [
    ("1", "u1", 10, 1, 0, 11, "a", "x", "2024-01"), ("2", "u1", 12, 2, 0, 14, "a", "x", "2024-01"),
    ("3", "u1", 8, 1, 0, 9, "b", "y", "2024-02"), ("4", "u2", 1, 0, 0, 1, "a", "x", "2024-01"),
    ("5", "u3", 50, 10, 1, 61, "b", "z", "2024-02"), ("6", "u3", 60, 12, 1, 73, "b", "z", "2024-02"),
]
SEGMENT_SCHEMA = (
    "post_id string, user_id string, likes_count int, comments_count int, reposts_count int, engagement_score int, "
    "source string, category string, month string"
)


def test_segments(spark):
    features = users.user_features(spark.createDataFrame(SEGMENTED, SEGMENT_SCHEMA))
    found = {r.user_id: r for r in users.segment_users(features).collect()}
    u1 = found["u1"]
    assert (u1.posts_count, u1.avg_likes, u1.total_comments, u1.total_engagement) == (3, 10.0, 4, 34)
    assert u1.avg_comments == pytest.approx(4 / 3) and u1.avg_engagement == pytest.approx(34 / 3)
    assert (u1.unique_sources, u1.unique_categories, u1.active_months) == (2, 2, 2)
    assert {k: v.segment_label for k, v in found.items()} == {"u1": "medium_activity", "u2": "low_activity", "u3": "high_activity"}
    # Numbered by mean total engagement.
    assert {k: v.segment_id for k, v in found.items()} == {"u2": 0, "u1": 1, "u3": 2}
    distribution = rows(users.user_segment_distribution(users.segment_users(features)))
    assert [r[:2] for r in distribution] == [("high_activity", 1), ("low_activity", 1), ("medium_activity", 1)]


def test_features_of_one_hot_user(spark):
    """A user with a third of all posts, against sums by hand."""
    n = 9000
    df = spark.range(n).select(
        F.col("id").cast("string").alias("post_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 50)).alias("user_id"),
        (F.col("id") % 5).cast("double").alias("likes_count"), F.lit(1.0).alias("comments_count"),
        (F.col("id") % 5 + 1).cast("double").alias("engagement_score"),
        (F.col("id") % 7).cast("string").alias("source"), (F.col("id") % 11).cast("string").alias("category"),
        F.concat(F.lit("2024-0"), F.col("id") % 9 + 1).alias("month"),
    )
    hot = users.user_features(df.repartition(8)).where("user_id = 'hot'").first()
    ids = range(0, n, 3)
    assert hot.posts_count == len(ids) and hot.total_engagement == sum(i % 5 + 1 for i in ids)
    assert (hot.unique_sources, hot.unique_categories, hot.active_months) == (7, 11, len({i % 9 for i in ids}))
    months = {r.month: r for r in users.user_activity_by_month(df).collect()}
    close = {r.month: r for r in users.user_activity_by_month(df, approximate=True).collect()}
    for m in range(9):
        inside = [i for i in range(n) if i % 9 == m]
        expected = len({"hot" if i % 3 == 0 else i % 50 for i in inside})
        row = months[f"2024-0{m + 1}"]
        assert (row.unique_users, row.total_posts) == (expected, len(inside))
        assert close[row.month].unique_users == pytest.approx(expected, rel=0.15)


def test_single_user_and_no_user(spark):
    df = spark.createDataFrame(SEGMENTED, SEGMENT_SCHEMA)
    assert [r.segment_id for r in users.segment_users(users.user_features(df.where("user_id = 'u2'"))).collect()] == [0]
    assert rows(users.segment_users(users.user_features(df.where("false")))) == []


def test_more_starts_do_not_cost_more(spark):
    """Best of several starts is at most as far from its centers as one start."""
    df = spark.range(400).select(
        F.col("id").cast("string").alias("user_id"), *((F.hash("id", F.lit(c)) % 50 + 50).cast("double").alias(c) for c in users.FEATURES)
    )

    def cost(starts):
        clustered = users.segment_users(df, starts=starts).collect()
        x = np.array([[r[c] for c in users.FEATURES] for r in clustered], dtype=float)
        x = (x - x.mean(0)) / x.std(0)
        ids = np.array([r.segment_id for r in clustered])
        assert set(ids) == {0, 1, 2} and len(ids) == 400
        return sum(((x[ids == i] - x[ids == i].mean(0)) ** 2).sum() for i in range(3))

    assert cost(6) <= cost(1) + 1e-6


def test_empty_inputs(spark):
    empty = spark.createDataFrame(
        [], f"{SEGMENT_SCHEMA}, clean_text string, company string, date date, sentiment_label string, sentiment_score double, datetime timestamp_ntz"
    )
    for frame in (
        terms.top_words(empty), terms.top_bigrams(empty), terms.top_trigrams(empty), tfidf.top_tfidf_terms(empty),
        activity.posts_by_date(empty), activity.posts_by_month(empty), activity.top_field_values(empty, "source"),
        activity.top_field_values(empty, "absent"), growth.terms_by_month(empty), growth.growing_terms(empty),
        sentiment.sentiment_distribution(empty), sentiment.sentiment_by_month(empty), sentiment.sentiment_by_source(empty),
        users.top_users(empty), users.top_users_engagement(empty), users.user_distribution(empty),
        users.user_activity_by_month(empty), activity.engagement_distribution(empty), users.user_features(empty),
        *topics.topic_tables(empty)[0].values(),
    ):
        assert frame.columns and frame.count() == 0


def test_null_values_of_a_field(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",), (None,), (None,)], "source string")
    assert rows(activity.top_field_values(df, "source")) == [("unknown", 3), ("a", 2)]


THEMES = [
    ("1", "2024-01", "cat animal pet kitten"), ("2", "2024-01", "dog animal pet puppy"),
    ("3", "2024-02", "python code data model"), ("4", "2024-02", "python data analysis code"),
]


def test_topics_of_two_themes(spark):
    df = spark.createDataFrame(THEMES, "post_id string, month string, clean_text string")
    tables, model = topics.topic_tables(df, 2, 3)
    topic_of = dict(rows(tables["post_topics"].select("post_id", "topic_id")))
    assert topic_of["1"] == topic_of["2"] != topic_of["3"] == topic_of["4"]
    assert {r.topic_label for r in tables["topic_terms"].collect()} == {"code, data, python", "animal, pet, cat"}
    assert [tables[n].count() for n in ("topic_terms", "post_topics", "topic_summary", "topics_by_month")] == [6, 4, 2, 2]
    assert model.objective[0] == pytest.approx(0.676306, abs=1e-5) and model.objective[-1] == pytest.approx(0.482872, abs=1e-5)
    assert rows(topics.topics_by_month(tables["post_topics"], df)) == rows(tables["topics_by_month"])


@pytest.mark.parametrize("data", [THEMES[:1], [("1", "2024-01", "word"), ("2", "2024-01", "word word")]])
def test_too_little_for_topics(spark, data):
    tables, model = topics.topic_tables(spark.createDataFrame(data, "post_id string, month string, clean_text string"))
    assert model is None and all(t.count() == 0 and t.columns for t in tables.values())


def test_topic_objective_falls_and_matches_dense_algebra(spark):
    rng = np.random.default_rng(3)
    data = [(str(i), "2024-01", " ".join(f"w{j}" for j in rng.zipf(1.4, 30) % 40)) for i in range(60)]
    df = spark.createDataFrame(data, "post_id string, month string, clean_text string")
    space = tfidf.fit_tfidf(df)
    vectors = topics.topic_vectors(df, space)
    model = topics.fit_topics(vectors, space, 4, max_iter=25)
    losses = np.array(model.objective)
    assert len(losses) > 2 and (np.diff(losses) <= 1e-9).all()
    x = np.array([r.features.toArray() for r in vectors.collect()])
    w = topics.nonnegative_solve(model.weights @ model.weights.T, x @ model.weights.T)
    assert (w >= 0).all() and (model.weights >= 0).all()
    dense = 0.5 * ((x - w @ model.weights) ** 2).sum()
    assert dense <= losses[-1] + 1e-9 and dense >= 0.5 * (np.linalg.svd(x, compute_uv=False)[4:] ** 2).sum() - 1e-9
    assigned = {r.post_id: (r.topic_id, r.topic_weight) for r in topics.assign_topics(vectors, model).collect()}
    by_id = {r.post_id: v for r, v in zip(vectors.collect(), w)}
    assert len(assigned) == 60
    assert all(math.isclose(assigned[i][1], v.max(), abs_tol=1e-9) and assigned[i][0] == v.argmax() for i, v in by_id.items())


def test_chart_series(spark):
    df = spark.createDataFrame([("a*b", 1), ("\U0001f600", 2)], "source string, count int")
    assert rows(reports.chart_series(df, "source", "count")) == [("ab", 1), ("unknown", 2)]
    assert reports.chart_series(df, "source", "absent") is None
    assert len(reports.CHARTS) == 15 and sum(c.interactive for c in reports.CHARTS.values()) == 13
    assert set(reports.all_chart_series({"top_sources": df}, interactive=True)) == {"top_sources"}


@pytest.fixture(scope="module")
def result(spark):
    data = [(str(i), f"u{i % 3}", f"2024-0{1 + i % 3}-1{i % 9}", f"title{i % 4}", "market growth story again", i) for i in range(24)]
    raw = spark.createDataFrame(data, ["ID", "author", "created_at", "headline", "body", "likes"])
    return analyze_frame(raw, options=Options(order_by=["post_id"]))


def test_analysis_of_a_frame(spark, result):
    assert result.summary == {
        "total_rows": 24, "total_users": 3, "top_word": "growth", "top_source": "unknown",
        "top_topic": result.summary["top_topic"], "dominant_sentiment": "neutral",
    }
    assert len(result.tables) == 26 and result.posts.count() == 24
    single = {"top_words": terms.top_words, "growing_terms": growth.growing_terms, "terms_by_month": growth.terms_by_month,
              "tfidf_terms": tfidf.top_tfidf_terms}
    for name, operator in single.items():
        alone = operator(result.posts)
        assert sorted(map(str, rows(alone))) == sorted(map(str, rows(result.tables[name]))), name


def test_analysis_of_no_posts(spark):
    raw = spark.createDataFrame([], "post_id string, user_id string, datetime string, text string")
    empty = analyze_posts(raw, Options(order_by=["post_id"]))
    assert empty.summary["total_rows"] == 0 and empty.summary["top_word"] == "n/a" and empty.summary["top_topic"] == "n/a"
    assert all(t.count() == 0 and t.columns for t in empty.tables.values())


def test_analysis_does_not_depend_on_partitions(spark):
    folder = "/root/testdata/sf0.001"
    found = []
    for parts in (1, 4, 7):
        raw = catalog.untidy_posts(spark, folder).repartition(parts)
        with analyze_posts(raw, Options(order_by=["event_id"], topic_iterations=3)) as result:
            tables = {n: sorted(map(str, rows(catalog.rounded(result.tables[n])))) for n in ("top_words", "user_segments", "posts_by_date")}
            found.append((result.summary["total_rows"], result.quality, tables))
    assert found[0] == found[1] == found[2] and found[0][0] > 0


def test_closed_analysis_leaves_no_files(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(Path(shared).iterdir())
    raw = spark.createDataFrame([("1", "u", "2024-01-01", "some plain words"), ("2", "v", "2024-02-02", "other plain words")], "post_id string, user_id string, datetime string, text string")
    result = analyze_posts(raw, Options(order_by=["post_id"]))
    assert result.posts.count() == 2 and set(Path(shared).iterdir()) > before
    result.close()
    assert set(Path(shared).iterdir()) == before


def test_empty_posts_stay_if_asked(spark):
    raw = spark.createDataFrame([("1", "u", "01.02.2024", ""), ("2", "v", "13.02.2024", "other plain words")], "post_id string, user_id string, datetime string, text string")
    with analyze_posts(raw, Options(order_by=["post_id"], drop_empty=False, dayfirst=True)) as result:
        assert {r.post_id: str(r.date) for r in result.posts.collect()} == {"1": "2024-02-01", "2": "2024-02-13"}


def test_wide_tables_are_written_by_several_tasks(spark, tmp_path):
    posts = spark.range(100_000).selectExpr("cast(id as string) as post_id", "concat('source number ', id) as source", "'neutral' as sentiment_label", "0.0 as sentiment_score")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.save_tables({"sentiment_by_source": sentiment.sentiment_by_source(posts)}, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "sentiment_by_source").glob("part-*"))) > 1
    assert spark.read.csv(f"{tmp_path}/sentiment_by_source", header=True).count() == 100_000


def test_segments_do_not_depend_on_partitions(spark):
    features = users.user_features(catalog.event_posts(spark, "/root/testdata/sf0.001"))
    found = {n: sorted(rows(users.segment_users(features.repartition(n)).select("user_id", "segment_id"))) for n in (1, 5)}
    assert found[1] == found[5] and len({s for _, s in found[1]}) == 3


def test_topic_labels_are_those_of_a_finished_fit(spark):
    posts = stored(catalog.token_posts(spark, "/root/testdata/sf0.001").select("post_id", "tokens"), "posts")
    space = tfidf.fit_tfidf(posts, 300)
    vectors = topics.topic_vectors(posts, space)
    assert topics.fit_topics(vectors, space).labels() == topics.fit_topics(vectors, space, tol=1e-7).labels()


def test_run_store(spark, result, tmp_path):
    store = RunStore(spark, str(tmp_path / "store"))
    assert store.latest_run_id() is None and store.table_names() == []
    assert store.save_run(result, "posts.csv", 5000) == 1
    assert store.save_run(result) == 2
    assert store.latest_run_id() == 2
    assert [r.run_id for r in store.recent_runs(1).collect()] == [2]
    first = store.read("analysis_runs", run_id=1).first()
    assert (first.source_name, first.nrows_limit, first.status, first.total_rows) == ("posts.csv", 5000, "finished", 24)
    assert first.top_word == "growth" and first.error_message is None
    assert set(store.table_names()) == set(STORED_COLUMNS) and len(STORED_COLUMNS) == 29
    for table in STORED_COLUMNS:
        frame = store.read(table)
        assert frame.columns == stored_schema(table).names and store.has_run_id(table)
    assert store.count("processed_posts") == 48 and store.count("processed_posts", 1) == 24
    assert store.preview("processed_posts", 5, 2).count() == 5
    by_run = store.read("trend_top_words", run_id=2)
    assert rows(by_run.drop("run_id").orderBy(F.desc("count"), "word")) == rows(result.tables["top_words"])
    assert "PartitionFilters: [isnotnull(run_id" in by_run._jdf.queryExecution().executedPlan().toString()
    quality = dict(rows(store.read("preprocessing_quality_reports", run_id=1).drop("run_id")))
    assert quality["loaded_rows"] == "24"
    # A repeated save of one run replaces it; replace drops the others.
    store.write(attach_run_id(result.tables["top_words"], 2), "trend_top_words")
    assert store.count("trend_top_words", 2) == result.tables["top_words"].count() and store.count("trend_top_words", 1) > 0
    store.write(attach_run_id(result.tables["top_words"], 3), "trend_top_words", replace=True)
    assert store.count("trend_top_words") == store.count("trend_top_words", 3)
    with pytest.raises(ValueError, match="unknown table"):
        store.read("other")


def test_attach_run_id(spark):
    df = spark.createDataFrame([(1, 9)], "a int, run_id int")
    assert attach_run_id(df, 4).columns == ["a", "run_id"] and attach_run_id(df, 4).first().run_id == 4
    assert attach_run_id(df.drop("run_id"), 4).columns == ["run_id", "a"]


def test_sinks(spark, result, tmp_path):
    folder = str(tmp_path)
    sinks.save_tables({k: result.tables[k] for k in ("top_words", "user_features")}, folder)
    back = spark.read.csv(f"{folder}/top_words", header=True)
    assert rows(back) == [(w, str(c)) for w, c in rows(result.tables["top_words"])]
    summary = spark.createDataFrame([(4, 3, "good", "test")], "total_rows int, total_users int, top_word string, top_source string")
    sinks.save_summary(summary, folder)
    lines = [r.value for r in spark.read.text(f"{folder}/summary_report").collect()]
    assert lines[0] == reports.SUMMARY_TITLE and lines[1] == "Количество записей: 4" and len(lines) == 5
    sinks.save_quality_report(result.quality_report, folder)
    lines = [r.value for r in spark.read.text(f"{folder}/preprocessing_quality_report_txt").collect()]
    assert lines[:2] == [reports.QUALITY_TITLE, "loaded_rows: 24"] and len(lines) == 10
    sinks.save_quality_report(result.quality_report.where("false"), f"{folder}/none")
    assert not (tmp_path / "none").exists()


def test_stored_reads_what_was_written(spark):
    df = stored(spark.range(5).withColumn("x", F.array(F.col("id"))), "numbers")
    assert df.count() == 5 and "Range" not in df._jdf.queryExecution().executedPlan().toString()


def test_certificate_of_segments(spark):
    df = spark.range(300).select(
        F.col("id").cast("string").alias("user_id"), *((F.hash("id", F.lit(c)) % 40 + 40).cast("double").alias(c) for c in users.FEATURES)
    )
    segments = users.segment_users(df)
    assert tuple(users.segment_certificate(df, segments).first()) == (300, 3, 0, 0)
    moved = segments.withColumn("segment_id", F.when(F.col("user_id") == "7", (F.col("segment_id") + 1) % 3).otherwise(F.col("segment_id")))
    found = users.segment_certificate(df, moved).first()
    assert found.not_nearest >= 1
    turned = segments.withColumn("segment_id", 2 - F.col("segment_id"))
    assert users.segment_certificate(df, turned).first().out_of_order >= 1


def some_vectors(spark, rows=60, size=40):
    rng = np.random.default_rng(11)
    texts = [[f"w{k:02}" for k in rng.integers(size // 4 * (r % 4), size // 4 * (r % 4) + size // 2, 12) % size] for r in range(rows)]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "post_id string, tokens array<string>")
    space = tfidf.fit_tfidf(df, 1000)
    vectors = topics.topic_vectors(df, space)
    x = np.zeros((rows, len(space.vocabulary)))
    for r in vectors.collect():
        x[int(r.post_id)] = r.features.toArray()
    return vectors, space, x


def test_leading_directions_are_those_of_dense_algebra(spark):
    vectors, space, x = some_vectors(spark)
    values, right = topics.leading_directions(vectors, x.shape[1], 4)
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(values, s[:4], rtol=1e-3)
    assert np.allclose(np.abs((right * vt[:4].T).sum(axis=0)), 1, atol=2e-2)
    assert topics.squared_length(vectors) == pytest.approx((x**2).sum())


def test_certificate_of_topics(spark):
    vectors, space, x = some_vectors(spark)
    model = topics.fit_topics(vectors, space, 4)
    found = topics.topic_certificate(vectors, model)
    assert found.posts == 60 and found.gradient <= 1.01e-4 and found.row_residual < 1e-6
    other = topics.TopicModel(space, model.weights + 0.05, ())
    assert topics.topic_certificate(vectors, other).gradient > 0.01


def test_a_vocabulary_of_tens_of_thousands(spark):
    """No matrix of vocabulary by vocabulary: 40,000 words would take 12.8 GB."""
    df = spark.range(0, 3000, 1, 2).select(F.col("id").cast("string").alias("post_id"), F.expr("transform(sequence(0, 39), k -> concat('w', cast((id * 13 + k * 997 * (id % 7 + 1)) % 40000 AS string)))").alias("tokens"))
    space = tfidf.fit_tfidf(df, 40_000)
    assert len(space.vocabulary) > 20_000
    vectors = topics.topic_vectors(df, space)
    model = topics.fit_topics(vectors, space, 3, max_iter=2)
    assert model.weights.shape == (3, len(space.vocabulary))


def test_vectors_are_packed_into_few_rows_without_loss(spark, monkeypatch):
    vectors, space, x = some_vectors(spark)
    monkeypatch.setattr(topics, "BLOCK_ENTRIES", 50)
    vectors = stored(vectors.coalesce(1), "one-task")
    order = [r.features.toArray() for r in vectors.collect()]
    blocks = topics.packed(vectors)
    assert topics.packed(blocks) is blocks and blocks.columns == ["lengths", "terms", "weights"]
    found, most = [], 0
    for r in blocks.collect():
        lengths, terms_, weights = np.frombuffer(r.lengths, np.int32), np.frombuffer(r.terms, np.int32), np.frombuffer(r.weights)
        most = max(most, len(terms_))
        ends = np.cumsum(lengths)
        for start, stop in zip(ends - lengths, ends):
            row = np.zeros(x.shape[1])
            row[terms_[start:stop]] = weights[start:stop]
            found.append(row)
    assert np.array_equal(found, order) and 12 < most <= 50
    assert topics.squared_length(blocks) == pytest.approx((x**2).sum())


def test_products_of_a_block_by_slices(monkeypatch):
    monkeypatch.setattr(topics, "SLICE_ENTRIES", 20)
    rng = np.random.default_rng(5)
    x = rng.random((40, 30)) * (rng.random((40, 30)) < 0.3)
    x[[0, 7, 8, 39]] = 0
    x[20] = 1.0  # alone longer than a slice
    row, term = np.nonzero(x)
    block = topics._Block((x > 0).sum(axis=1).astype(np.int32), term.astype(np.int32), x[row, term])
    right, left = rng.random((30, 3)), rng.random((40, 3))
    assert np.allclose(block.times(right), x @ right) and np.allclose(block.pulled(left, 30), left.T @ x)


def test_posts_are_dealt_to_more_tasks_the_larger_the_files(spark, tmp_path, monkeypatch):
    """A task that counts phrases gets a bounded part of the texts, however few cores there are."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    size = sum(f.stat().st_size for f in (tmp_path / "documents.parquet").rglob("*") if f.is_file())
    monkeypatch.setattr(catalog, "DEALT_BYTES", size // 30)
    dealt = catalog.dealt(spark.read.parquet(f"{tmp_path}/documents.parquet"), "doc_id", str(tmp_path), "documents")
    assert 30 <= dealt.rdd.getNumPartitions() <= 31
    assert sorted(r.doc_id for r in dealt.collect()) == list(range(400))
    monkeypatch.setattr(catalog, "DEALT_BYTES", size)
    assert catalog.dealt(spark.read.parquet(f"{tmp_path}/documents.parquet"), "doc_id", str(tmp_path), "documents").rdd.getNumPartitions() <= 8
