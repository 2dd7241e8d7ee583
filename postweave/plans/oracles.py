"""The registered queries once more, as SQL for DuckDB over the same tables.

Written from the definitions, not from the Spark plans: top lists go through window-free sorts, TF-IDF
through explicit sums, the whole analysis through counts of what each table must hold.
"""

from __future__ import annotations

from postweave import settings
from postweave.plans.catalog import TEST_NEGATIVE, TEST_POSITIVE

_SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _listed(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


_STOP = _listed(sorted(settings.STOP_WORDS))

_POSTS = """posts AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS post_id, CAST(e.user_id AS VARCHAR) AS user_id, o.o_orderdate AS datetime,
    '' AS title, d.text, e.value AS likes_count, CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS comments_count,
    CAST(0 AS DOUBLE) AS reposts_count, d.source, d.lang AS company, '' AS url, e.event_type AS category,
    e.value + CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS engagement_score,
    strftime(o.o_orderdate, '%Y-%m-%d') AS date, strftime(o.o_orderdate, '%Y-%m') AS month
  FROM documents d JOIN events e ON e.event_id = d.doc_id JOIN orders o ON o.o_orderkey = d.doc_id)"""

_EVENTS = """posts AS (
  SELECT CAST(e.event_id AS VARCHAR) AS post_id, CAST(e.user_id AS VARCHAR) AS user_id, e.value AS likes_count,
    CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS comments_count,
    e.value + CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS engagement_score,
    e.event_type AS source, o.o_orderpriority AS category,
    strftime(o.o_orderdate, '%Y-%m-%d') AS date, strftime(o.o_orderdate, '%Y-%m') AS month
  FROM events e JOIN orders o ON o.o_orderkey = e.event_id)"""

_UNTIDY = r"""untidy AS (
  SELECT CASE WHEN e.event_type = 'error' THEN ' NaN '
      ELSE ' ' || coalesce(CAST(d.doc_id AS VARCHAR), 'u' || CAST(e.user_id AS VARCHAR)) || chr(9) END AS post_id,
    CASE WHEN e.event_type <> 'signup' THEN CAST(e.user_id AS VARCHAR) END AS user_id,
    CASE o.o_orderstatus WHEN 'F' THEN strftime(o.o_orderdate, '%Y-%m-%d')
      WHEN 'O' THEN '"' || strftime(o.o_orderdate, '%m/%d/%Y %H:%M') || '"' ELSE 'not a date' END AS datetime,
    CASE WHEN e.event_type <> 'view' THEN e.event_type END AS title, d.text,
    CAST(e.value AS VARCHAR) || CASE WHEN e.event_type = 'click' THEN 'd' ELSE '' END AS likes_count,
    json_extract_string(e.props, '$.k') AS comments_count, e.event_type AS reposts_count,
    d.source, d.lang AS company, '' AS url, e.event_type AS category, e.event_id
  FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id LEFT JOIN orders o ON o.o_orderkey = e.event_id)"""

_PRESENT = "coalesce(lower(trim({c}, ' ' || chr(9))) NOT IN ('', 'nan', 'none', 'null', 'nat', 'unknown'), FALSE)"
_REQUIRED = " AND ".join(_PRESENT.format(c=c) for c in ("post_id", "user_id", "datetime"))
_NUMBER = r"CASE WHEN regexp_full_match({c}, '\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*') THEN CAST({c} AS DOUBLE) ELSE 0.0 END"
_TIME = "coalesce(try_strptime(trim(datetime, '\"'), '%Y-%m-%d'), try_strptime(trim(datetime, '\"'), '%m/%d/%Y %H:%M'))"

_VALID = f"""{_UNTIDY}, required AS (
  SELECT trim(post_id, ' ' || chr(9)) AS post_id, trim(user_id) AS user_id, datetime, coalesce(title, '') AS title,
    coalesce(text, '') AS text, {_NUMBER.format(c="likes_count")} AS likes_count,
    {_NUMBER.format(c="comments_count")} AS comments_count, {_NUMBER.format(c="reposts_count")} AS reposts_count,
    source, company, category, event_id
  FROM untidy WHERE {_REQUIRED}),
firsts AS (
  SELECT r.* FROM required r JOIN (SELECT post_id, min(event_id) AS event_id FROM required GROUP BY post_id) f
    ON f.post_id = r.post_id AND f.event_id = r.event_id),
valid AS (SELECT * FROM firsts WHERE trim(title || ' ' || text) <> '')"""


def _cleaned(c: str) -> str:
    """Lower-cased letters and digits; addresses and escaped ampersands are left out, single blanks between words."""
    plain = f"replace(regexp_replace(lower({c}), '(http|www)[^{_SPACE}]+', ' ', 'g'), '&amp;', ' ')"
    return f"array_to_string(regexp_extract_all({plain}, '[0-9a-zа-яё]+'), ' ')"


def _tokens(c: str) -> str:
    return (
        f"list_filter(string_split({_cleaned(c)}, ' '), lambda t: length(t) >= 3 AND t NOT IN ({_STOP}) "
        "AND NOT regexp_full_match(t, '[0-9]+'))"
    )


_WORDS = f"""{_POSTS}, cleaned AS (SELECT *, {_tokens("text")} AS tokens FROM posts),
docs AS (SELECT * FROM cleaned WHERE len(tokens) > 0),
terms AS (SELECT post_id, month, unnest(tokens) AS term FROM docs)"""

_COUNT_OF = "len(list_filter(tokens, lambda t: t IN ({w})))"
_SCORED = f"""{_WORDS}, hits AS (
  SELECT *, CAST({_COUNT_OF.format(w=_listed(TEST_POSITIVE))} AS INTEGER) AS pos,
    CAST({_COUNT_OF.format(w=_listed(TEST_NEGATIVE))} AS INTEGER) AS neg FROM docs),
scores AS (SELECT *, (pos - neg) / CAST(greatest(pos + neg, 1) AS DOUBLE) AS score FROM hits),
scored AS (SELECT *, CASE WHEN score > 0.05 THEN 'positive' WHEN score < -0.05 THEN 'negative' ELSE 'neutral' END AS label
  FROM scores)"""

_TREND = f"""{_WORDS}, vocabulary AS (
  SELECT term, count(*) AS n FROM terms GROUP BY term ORDER BY n DESC, term LIMIT 30),
months AS (SELECT month, count(*) AS total FROM docs GROUP BY month),
monthly AS (
  SELECT t.month, t.term, count(*) AS n, max(m.total) AS total
  FROM terms t JOIN vocabulary v ON v.term = t.term JOIN months m ON m.month = t.month GROUP BY t.month, t.term),
last_time AS (SELECT max(datetime) AS t FROM docs),
complete AS (
  SELECT DISTINCT month FROM monthly, last_time
  WHERE month < strftime(t, '%Y-%m') OR (month = strftime(t, '%Y-%m') AND last_day(t) = CAST(t AS DATE))),
last_two AS (SELECT month FROM complete ORDER BY month DESC LIMIT 2),
pair AS (SELECT min(month) AS previous_month, max(month) AS latest_month FROM last_two HAVING count(*) = 2)"""

_FEATURES = f"""{_EVENTS}, features AS (
  SELECT user_id, count(*) AS posts_count, avg(likes_count) AS avg_likes, avg(comments_count) AS avg_comments,
    sum(comments_count) AS total_comments, sum(engagement_score) AS total_engagement,
    avg(engagement_score) AS avg_engagement, count(DISTINCT source) AS unique_sources,
    count(DISTINCT category) AS unique_categories, count(DISTINCT month) AS active_months
  FROM posts GROUP BY user_id),
labelled AS (
  SELECT *, CASE WHEN posts_count <= 1 AND avg_engagement <= 5 THEN 'low_activity'
    WHEN posts_count >= 5 OR avg_engagement >= 20 THEN 'high_activity' ELSE 'medium_activity' END AS segment_label
  FROM features)"""

_BIN = """CASE WHEN engagement_score < -1 THEN NULL WHEN engagement_score <= 0 THEN '0' WHEN engagement_score <= 5 THEN '1-5'
  WHEN engagement_score <= 20 THEN '6-20' WHEN engagement_score <= 100 THEN '21-100'
  WHEN engagement_score <= 1000000 THEN '100+' END"""

_GIVEN = """given AS (
  SELECT CAST(doc_id AS VARCHAR) AS post_id, CAST(strpos('en de fr es', lang) AS INTEGER) AS topic_id, lang AS topic_label,
    n_chars / CAST(1000 AS DOUBLE) AS topic_weight FROM documents)"""


def _ngrams(n: int, name: str) -> str:
    later = " || ' ' || ".join(f"tokens[i + {k}]" for k in range(n))
    return f"""WITH {_WORDS}, starts AS (SELECT tokens, unnest(range(1, len(tokens) - {n - 2})) AS i FROM docs WHERE len(tokens) >= {n})
      SELECT {later} AS {name}, count(*) AS count FROM starts GROUP BY 1 ORDER BY count DESC, 1 LIMIT 20"""


def _top_field(field: str) -> str:
    return f"""WITH {_POSTS} SELECT coalesce({field}, 'unknown') AS {field}, count(*) AS count FROM posts
      GROUP BY 1 ORDER BY count DESC, 1 LIMIT 15"""


def _sentiment(keys: str) -> str:
    chosen = f"{keys}, " if keys else ""
    return f"""WITH {_SCORED} SELECT {chosen}label AS sentiment_label, count(*) AS posts_count,
      round(avg(score), 6) AS avg_sentiment_score FROM scored GROUP BY {chosen}label"""


_ROUNDED_FEATURES = """user_id, posts_count, round(avg_likes, 6) AS avg_likes, round(avg_comments, 6) AS avg_comments,
  round(total_comments, 6) AS total_comments, round(total_engagement, 6) AS total_engagement,
  round(avg_engagement, 6) AS avg_engagement, unique_sources, unique_categories, active_months"""

_METRIC_SELECTS = (
    ("loaded_rows", "(SELECT count(*) FROM untidy)"),
    ("missing_required_removed", "(SELECT count(*) FROM untidy) - (SELECT count(*) FROM required)"),
    ("duplicates_removed", "(SELECT count(*) FROM required) - (SELECT count(*) FROM firsts)"),
    ("empty_text_removed_at_validation", "(SELECT count(*) FROM firsts) - (SELECT count(*) FROM valid)"),
    ("rows_after_validation", "(SELECT count(*) FROM valid)"),
    ("rows_before_preprocessing", "(SELECT count(*) FROM valid)"),
    ("empty_text_removed_at_preprocessing", "(SELECT count(*) FROM valid) - (SELECT count(*) FROM worded)"),
    ("invalid_datetime_removed", "(SELECT count(*) FROM worded) - (SELECT count(time) FROM worded)"),
    ("final_clean_rows", "(SELECT count(time) FROM worded)"),
)
_WORDED = f"""{_VALID}, worded AS (
  SELECT *, {_TIME} AS time FROM (
    SELECT *, trim(title || ' ' || text) AS full_text, {_tokens("title || ' ' || text")} AS tokens FROM valid)
  WHERE len(tokens) > 0)"""

_FORMATS = ("%-m/%-d/%Y", "%-m/%-d/%Y %-H:%M", "%-m/%-d/%Y %-I:%M %p", "%m/%d/%Y %I:%M:%S %p", "%m.%d.%Y", "%Y.%m.%d", "%Y/%-m/%-d",
            "%-d-%b-%Y", "%m-%d-%Y", "%b %-d, %Y %-I:%M %p", "%a %b %d %H:%M:%S %Y", "%a, %d %b %Y %H:%M:%S", "%Y%m%d %H%M%S")


def _kept_part(time: str) -> str:
    """What a spelling keeps of a time: the day, the minute, or all of it."""
    days, minutes = (0, 4, 5, 6, 7, 8), (1, 2, 9)
    kind = f"o_orderkey % {len(_FORMATS)}"
    return f"CASE WHEN {kind} IN {days} THEN date_trunc('day', {time}) WHEN {kind} IN {minutes} THEN date_trunc('minute', {time}) ELSE {time} END"


_VECTORS = f"""{_WORDS}, vocabulary AS (
    SELECT term, count(DISTINCT post_id) AS df, row_number() OVER (ORDER BY count(*) DESC, term) - 1 AS rank FROM terms
    GROUP BY term ORDER BY rank LIMIT 1500),
  size AS (SELECT count(*) AS n FROM docs),
  raw AS (
    SELECT t.post_id, t.term, max(v.rank) AS rank, count(*) * (ln((1 + max(s.n)) / CAST(1 + max(v.df) AS DOUBLE)) + 1) AS w
    FROM terms t JOIN vocabulary v ON v.term = t.term CROSS JOIN size s GROUP BY t.post_id, t.term),
  vectors AS (SELECT post_id, term, rank, w / sqrt(sum(w * w) OVER (PARTITION BY post_id)) AS w FROM raw)"""

_SEGMENTED = ("posts_count", "avg_likes", "avg_comments", "total_comments", "total_engagement", "avg_engagement", "unique_sources",
              "unique_categories", "active_months")

# Posts of the analysis: the cleaned posts with time, words and sentiment.
_ANALYSED = f"""{_WORDED}, posts AS (
    SELECT *, strftime(time, '%Y-%m-%d') AS date, strftime(time, '%Y-%m') AS month, likes_count + comments_count + reposts_count AS engagement_score,
      CAST({_COUNT_OF.format(w=_listed(TEST_POSITIVE))} AS INTEGER) AS pos, CAST({_COUNT_OF.format(w=_listed(TEST_NEGATIVE))} AS INTEGER) AS neg
    FROM worded WHERE time IS NOT NULL),
  labelled AS (SELECT *, (pos - neg) / CAST(greatest(pos + neg, 1) AS DOUBLE) AS score FROM posts),
  scored AS (SELECT *, CASE WHEN score > 0.05 THEN 'positive' WHEN score < -0.05 THEN 'negative' ELSE 'neutral' END AS label FROM labelled),
  terms AS (SELECT post_id, month, unnest(tokens) AS term FROM posts),
  ranked AS (SELECT term, count(*) AS n FROM terms GROUP BY term ORDER BY n DESC, term),
  trend AS (SELECT term FROM ranked LIMIT 30),
  monthly AS (SELECT t.month, t.term, count(*) AS n FROM terms t JOIN trend v ON v.term = t.term GROUP BY t.month, t.term),
  months AS (SELECT month, count(*) AS total FROM posts GROUP BY month),
  complete AS (
    SELECT DISTINCT month FROM monthly, (SELECT max(time) AS t FROM posts)
    WHERE month < strftime(t, '%Y-%m') OR (month = strftime(t, '%Y-%m') AND last_day(t) = CAST(t AS DATE))),
  pair AS (SELECT min(month) AS a, max(month) AS b FROM (SELECT month FROM complete ORDER BY month DESC LIMIT 2) HAVING count(*) = 2),
  growing AS (
    SELECT v.term FROM trend v CROSS JOIN pair p
    WHERE coalesce((SELECT max(n) FROM monthly m WHERE m.term = v.term AND m.month = p.b), 0) / CAST((SELECT max(total) FROM months WHERE month = p.b) AS DOUBLE)
        > coalesce((SELECT max(n) FROM monthly m WHERE m.term = v.term AND m.month = p.a), 0) / CAST((SELECT max(total) FROM months WHERE month = p.a) AS DOUBLE))"""


def _grams(n: int) -> str:
    joined = " || ' ' || ".join(f"tokens[i + {k}]" for k in range(n))
    return f"(SELECT count(DISTINCT {joined}) FROM (SELECT tokens, unnest(range(1, len(tokens) - {n - 2})) AS i FROM posts WHERE len(tokens) >= {n}))"


_TABLE_ROWS = {
    "top_words": "(SELECT least(20, count(*)) FROM ranked)",
    "top_bigrams": f"least(20, {_grams(2)})",
    "top_trigrams": f"least(20, {_grams(3)})",
    "tfidf_terms": "(SELECT least(20, count(*)) FROM ranked)",
    "posts_by_date": "(SELECT count(DISTINCT date) FROM posts)",
    "posts_by_month": "(SELECT count(DISTINCT month) FROM posts)",
    "top_sources": "(SELECT least(15, count(DISTINCT coalesce(source, 'unknown'))) FROM posts)",
    "top_companies": "(SELECT least(15, count(DISTINCT coalesce(company, 'unknown'))) FROM posts)",
    "top_categories": "(SELECT least(15, count(DISTINCT coalesce(category, 'unknown'))) FROM posts)",
    "terms_by_month": "(SELECT count(*) FROM monthly)",
    "growing_terms": "(SELECT least(20, count(*)) FROM growing)",
    "sentiment_distribution": "(SELECT count(DISTINCT label) FROM scored)",
    "sentiment_by_month": "(SELECT count(*) FROM (SELECT DISTINCT month, label FROM scored))",
    "sentiment_by_source": "(SELECT count(*) FROM (SELECT DISTINCT source, label FROM scored WHERE source IS NOT NULL))",
    "topic_terms": "40",
    "post_topics": "(SELECT count(*) FROM posts)",
    "top_users": "(SELECT least(20, count(DISTINCT user_id)) FROM posts)",
    "top_users_engagement": "(SELECT least(20, count(DISTINCT user_id)) FROM posts)",
    "user_distribution": """(SELECT count(DISTINCT CASE WHEN n = 1 THEN 1 WHEN n <= 5 THEN 2 WHEN n <= 10 THEN 3 ELSE 4 END)
      FROM (SELECT count(*) AS n FROM posts GROUP BY user_id))""",
    "user_activity_by_month": "(SELECT count(DISTINCT month) FROM posts)",
    "engagement_distribution": "5",
    "user_features": "(SELECT count(DISTINCT user_id) FROM posts)",
    "user_segments": "(SELECT count(DISTINCT user_id) FROM posts)",
    "user_segment_distribution": """(SELECT count(DISTINCT CASE WHEN n <= 1 AND e <= 5 THEN 1 WHEN n >= 5 OR e >= 20 THEN 3 ELSE 2 END)
      FROM (SELECT count(*) AS n, avg(engagement_score) AS e FROM posts GROUP BY user_id))""",
}

ORACLES: dict[str, str] = {
    "scan_csv": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents",
    "scan_csv_multi_line": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents",
    "scan_json": "SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, text FROM conversations",
    "limit_rows": "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 5000",
    "load_dataset": """SELECT doc_id AS post_id, lang AS company, n_chars AS likes_count, text, source, '' AS title,
      CAST(0 AS INTEGER) AS comments_count, CAST(0 AS INTEGER) AS reposts_count, '' AS url, 'unknown' AS category FROM documents""",
    "read_result_table": f"""WITH {_EVENTS} SELECT CAST(2 AS INTEGER) AS run_id, month, count(*) AS post_count FROM posts GROUP BY month""",
    "attach_run_id": """SELECT CAST(7 AS INTEGER) AS run_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts, user_id,
      event_type, round(value, 6) AS value, props FROM events""",
    "map_columns": """SELECT event_id AS post_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS datetime,
      event_type AS text, round(value, 6) AS likes_count, props FROM events""",
    "fill_optional": """SELECT doc_id, text, source, '' AS title, CAST(0 AS INTEGER) AS likes_count, CAST(0 AS INTEGER) AS comments_count,
      CAST(0 AS INTEGER) AS reposts_count, 'unknown' AS company, '' AS url, 'unknown' AS category FROM documents""",
    "align_schema": f"""WITH {_POSTS} SELECT CAST(1 AS INTEGER) AS run_id, post_id, title, text, CAST(NULL AS DOUBLE) AS created_utc,
      strftime(datetime, '%Y-%m-%d %H:%M:%S.%g') AS datetime, user_id, round(likes_count, 6) AS likes_count,
      round(comments_count, 6) AS comments_count, CAST(NULL AS DOUBLE) AS upvote_ratio, category, CAST(NULL AS VARCHAR) AS permalink,
      CAST(NULL AS VARCHAR) AS url, source, company, reposts_count, CAST(NULL AS VARCHAR) AS full_text,
      CAST(NULL AS VARCHAR) AS clean_text, date, month, round(engagement_score, 6) AS engagement_score,
      CAST(NULL AS INTEGER) AS text_length, CAST(NULL AS INTEGER) AS positive_word_count,
      CAST(NULL AS INTEGER) AS negative_word_count, CAST(NULL AS DOUBLE) AS sentiment_score,
      CAST(NULL AS VARCHAR) AS sentiment_label FROM posts""",
    "chart_series": f"""WITH {_POSTS} SELECT regexp_replace(source, '[^A-Za-z0-9_ .,:/()-]', '', 'g') AS label, count(*) AS value
      FROM posts GROUP BY source ORDER BY value DESC, source LIMIT 15""",
    "valid_required": f"""WITH {_UNTIDY} SELECT event_id, {", ".join(f"{_PRESENT.format(c=c)} AS {c}" for c in ("post_id", "user_id", "datetime"))}
      FROM untidy""",
    "filter_required": f"WITH {_UNTIDY} SELECT event_id, post_id, user_id FROM untidy WHERE {_REQUIRED}",
    "dedupe_scanned": """SELECT coalesce(source, 'none') AS post_id, doc_id, lang FROM documents
      QUALIFY row_number() OVER (PARTITION BY coalesce(source, 'none') ORDER BY doc_id) = 1""",
    "dedupe_posts": f"""WITH {_UNTIDY} SELECT trim(post_id, ' ' || chr(9)) AS post_id, min(event_id) AS event_id, nullif(arg_min(coalesce(title, '-'), event_id), '-') AS title
      FROM untidy WHERE {_REQUIRED} GROUP BY 1""",
    "fill_text": f"""WITH {_UNTIDY} SELECT event_id, coalesce(user_id, 'unknown') AS user_id, coalesce(title, '') AS title,
      coalesce(text, '') AS text FROM untidy""",
    "coerce_numeric": f"""WITH {_UNTIDY} SELECT event_id, {", ".join(f"{_NUMBER.format(c=c)} AS {c}" for c in settings.NUMERIC_FIELDS)} FROM untidy""",
    "filter_empty_text": f"""WITH {_UNTIDY} SELECT event_id, coalesce(title, '') AS title FROM untidy
      WHERE trim(coalesce(title, '') || coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) <> ''""",
    "filter_empty_clean": f"WITH {_WORDS} SELECT post_id, source FROM docs",
    "parse_datetime": f"WITH {_UNTIDY} SELECT event_id, strftime({_TIME}, '%Y-%m-%d %H:%M:%S.%g') AS datetime FROM untidy",
    "parse_datetime_epoch": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS datetime FROM events",
    "filter_datetime": f"""WITH {_UNTIDY} SELECT event_id, strftime({_TIME}, '%Y-%m-%d %H:%M:%S.%g') AS datetime FROM untidy
      WHERE {_TIME} IS NOT NULL""",
    "validate_posts": f"""WITH {_VALID} SELECT post_id, user_id, datetime, title, text, round(likes_count, 6) AS likes_count,
      comments_count, reposts_count, source, category, event_id FROM valid""",
    "preprocess_posts": f"""WITH {_WORDED} SELECT post_id, user_id, strftime(time, '%Y-%m-%d %H:%M:%S.%g') AS datetime, full_text,
      array_to_string(tokens, ' ') AS clean_text, strftime(time, '%Y-%m-%d') AS date, strftime(time, '%Y-%m') AS month,
      round(likes_count, 6) AS likes_count, round(likes_count + comments_count + reposts_count, 6) AS engagement_score,
      CAST(len(tokens) AS INTEGER) AS text_length FROM worded WHERE time IS NOT NULL""",
    "quality_report": f"WITH {_WORDED} "
    + " UNION ALL ".join(f"SELECT '{m}' AS metric_name, {v} AS metric_value" for m, v in _METRIC_SELECTS),
    "clean_text": f"WITH {_POSTS} SELECT post_id, {_cleaned('text')} AS cleaned FROM posts",
    "tokens": f"""WITH {_WORDS} SELECT post_id, CAST(unnest(range(0, len(tokens))) AS INTEGER) AS position, unnest(tokens) AS token
      FROM cleaned""",
    "normalize_text": f"WITH {_WORDS} SELECT post_id, array_to_string(tokens, ' ') AS clean_text FROM cleaned",
    "post_periods": f"WITH {_POSTS} SELECT post_id, date, month FROM posts",
    "engagement_score": f"WITH {_POSTS} SELECT post_id, round(engagement_score, 6) AS engagement_score FROM posts",
    "text_length": f"WITH {_WORDS} SELECT post_id, CAST(len(tokens) AS INTEGER) AS text_length FROM cleaned",
    "sanitize_label": """SELECT event_id, trim(regexp_replace(regexp_replace(props, '[^A-Za-z0-9_ .,:/()-]', '', 'g'), ' +', ' ', 'g')) AS label
      FROM events""",
    "sentiment_columns": f"""WITH {_SCORED} SELECT post_id, pos AS positive_word_count, neg AS negative_word_count,
      round(score, 6) AS sentiment_score, label AS sentiment_label FROM scored""",
    "activity_label": f"WITH {_FEATURES} SELECT user_id, segment_label FROM labelled",
    "engagement_bin": f"WITH {_EVENTS} SELECT post_id, {_BIN} AS engagement_group FROM posts",
    "top_words": f"""WITH {_WORDS} SELECT term AS word, count(*) AS count FROM terms GROUP BY term
      ORDER BY count DESC, term LIMIT 20""",
    "top_ngrams": _ngrams(4, "ngram"),
    "top_bigrams": _ngrams(2, "bigram"),
    "top_trigrams": _ngrams(3, "trigram"),
    "tfidf_terms": f"""WITH {_WORDS}, vocabulary AS (
        SELECT term, count(*) AS n, count(DISTINCT post_id) AS df FROM terms GROUP BY term ORDER BY n DESC, term LIMIT 1000),
      size AS (SELECT count(*) AS n FROM docs),
      weights AS (
        SELECT t.post_id, t.term, count(*) * (ln((1 + max(s.n)) / CAST(1 + max(v.df) AS DOUBLE)) + 1) AS w
        FROM terms t JOIN vocabulary v ON v.term = t.term CROSS JOIN size s GROUP BY t.post_id, t.term),
      norms AS (SELECT post_id, sqrt(sum(w * w)) AS norm FROM weights GROUP BY post_id)
      SELECT term, round(sum(w / norm) / (SELECT n FROM size), 6) AS score
      FROM weights JOIN norms USING (post_id) GROUP BY term ORDER BY sum(w / norm) DESC, term LIMIT 20""",
    "trend_vocabulary": f"WITH {_TREND} SELECT term, n AS count FROM vocabulary",
    "terms_by_month": f"""WITH {_TREND} SELECT month, term, n AS count, total AS total_posts_in_month,
      round(n / CAST(total AS DOUBLE), 6) AS relative_frequency FROM monthly""",
    "last_two_months": f"WITH {_TREND} SELECT previous_month, latest_month FROM pair",
    "growing_terms": f"""WITH {_TREND}, sides AS (
        SELECT v.term, p.previous_month, p.latest_month, coalesce(a.n, 0) AS pc, coalesce(b.n, 0) AS lc,
          (SELECT total FROM months WHERE month = p.previous_month) AS pt,
          (SELECT total FROM months WHERE month = p.latest_month) AS lt
        FROM vocabulary v CROSS JOIN pair p
        LEFT JOIN monthly a ON a.term = v.term AND a.month = p.previous_month
        LEFT JOIN monthly b ON b.term = v.term AND b.month = p.latest_month),
      shares AS (SELECT *, pc / CAST(pt AS DOUBLE) AS pf, lc / CAST(lt AS DOUBLE) AS lf FROM sides)
      SELECT term, previous_month, latest_month, pc AS previous_count, lc AS latest_count, lc - pc AS absolute_growth,
        pt AS previous_total_posts, lt AS latest_total_posts, round(pf, 6) AS previous_relative_frequency,
        round(lf, 6) AS latest_relative_frequency, round(lf - pf, 6) AS relative_growth,
        round((lf - pf) / CASE WHEN pf > 0 THEN pf ELSE 1 END, 6) AS growth_rate,
        round((lf - pf) / CASE WHEN pf > 0 THEN pf ELSE 1 END * 100, 6) AS growth_percent,
        round((lf - pf) * lc, 6) AS trend_score
      FROM shares WHERE lf > pf ORDER BY lf - pf DESC, lc DESC, lc - pc DESC, term LIMIT 20""",
    "posts_by_date": f"WITH {_EVENTS} SELECT date, count(*) AS post_count FROM posts GROUP BY date",
    "posts_by_month": f"WITH {_EVENTS} SELECT month, count(*) AS post_count FROM posts GROUP BY month",
    "top_sources": _top_field("source"),
    "top_companies": _top_field("company"),
    "top_categories": _top_field("category"),
    "engagement_distribution": f"""WITH {_EVENTS}, bins AS (SELECT unnest(['0', '1-5', '6-20', '21-100', '100+']) AS engagement_group),
      binned AS (SELECT {_BIN} AS g FROM posts)
      SELECT engagement_group, (SELECT count(*) FROM binned WHERE g = engagement_group) AS posts_count FROM bins""",
    "sentiment_distribution": _sentiment(""),
    "sentiment_by_month": _sentiment("month"),
    "sentiment_by_source": _sentiment("source"),
    "top_users": f"""WITH {_FEATURES} SELECT user_id, posts_count, round(avg_likes, 6) AS avg_likes,
      round(total_comments, 6) AS total_comments, round(total_engagement, 6) AS total_engagement,
      round(avg_engagement, 6) AS avg_engagement FROM features ORDER BY posts_count DESC, user_id LIMIT 20""",
    "top_users_engagement": f"""WITH {_FEATURES} SELECT user_id, posts_count, round(f.total_engagement, 6) AS total_engagement,
      round(avg_engagement, 6) AS avg_engagement FROM features f ORDER BY f.total_engagement DESC, user_id LIMIT 20""",
    "user_distribution": f"""WITH {_POSTS}, counts AS (SELECT user_id, count(*) AS n FROM posts GROUP BY user_id)
      SELECT CASE WHEN n = 1 THEN '1 post' WHEN n <= 5 THEN '2-5 posts' WHEN n <= 10 THEN '6-10 posts' ELSE '10+ posts' END
        AS activity_group, count(*) AS users_count FROM counts GROUP BY 1""",
    "user_activity_by_month": f"""WITH {_EVENTS} SELECT month, count(DISTINCT user_id) AS unique_users, count(*) AS total_posts,
      round(avg(engagement_score), 6) AS avg_engagement FROM posts GROUP BY month""",
    "user_features": f"WITH {_FEATURES} SELECT {_ROUNDED_FEATURES} FROM features",
    "user_segment_distribution": f"""WITH {_FEATURES} SELECT segment_label, count(*) AS users_count,
      round(avg(posts_count), 6) AS avg_posts_count, round(avg(l.avg_engagement), 6) AS avg_engagement
      FROM labelled l GROUP BY segment_label""",
    "topic_summary_of_given": f"""WITH {_GIVEN} SELECT topic_id, topic_label, count(*) AS posts_count,
      round(avg(topic_weight), 6) AS avg_topic_weight FROM given GROUP BY topic_id, topic_label""",
    "topics_by_month_of_given": f"""WITH {_GIVEN}, {_POSTS} SELECT p.month, topic_id, topic_label, count(*) AS posts_count,
      round(avg(topic_weight), 6) AS avg_topic_weight
      FROM given g LEFT JOIN posts p ON p.post_id = g.post_id WHERE p.month IS NOT NULL GROUP BY p.month, topic_id, topic_label""",
    "run_summary": f"""WITH {_SCORED} SELECT (SELECT count(*) FROM docs) AS total_rows,
      (SELECT count(DISTINCT user_id) FROM docs) AS total_users,
      (SELECT term FROM terms GROUP BY term ORDER BY count(*) DESC, term LIMIT 1) AS top_word,
      (SELECT source FROM docs GROUP BY source ORDER BY count(*) DESC, source LIMIT 1) AS top_source,
      (SELECT label FROM scored GROUP BY label ORDER BY count(*) DESC, label LIMIT 1) AS dominant_sentiment""",
    "parse_datetime_formats": f"""SELECT o_orderkey, strftime({_kept_part("t")}, '%Y-%m-%d %H:%M:%S.%g') AS datetime FROM (
      SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey * 7919 % 86400) AS t FROM orders)""",
    "parse_datetime_offsets": """SELECT o_orderkey, strftime(CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey * 7919 % 86400), '%Y-%m-%d %H:%M:%S.%g')
      AS datetime FROM orders""",
    "parse_datetime_units": """SELECT event_id, unit, strftime(make_timestamp(epoch_us(ts) // each * each), '%Y-%m-%d %H:%M:%S.%g') AS datetime
      FROM events, (VALUES ('day', 86400000000), ('hour', 3600000000), ('minute', 60000000), ('second', 1000000), ('milli', 1000),
        ('micro', 1), ('nano', 1)) units(unit, each)""",
    "tfidf_vectors": f"WITH {_VECTORS} SELECT post_id, term, round(w, 6) AS weight FROM vectors WHERE w > 0",
    "post_topics_of_given": f"""WITH {_VECTORS}, h AS (
        SELECT rank, CASE WHEN rank % 3 <> 1 THEN 1 / CAST(rank + 1 AS DOUBLE) ELSE 0 END AS h0,
          CASE WHEN rank % 3 <> 0 THEN 1 / CAST(rank + 1 AS DOUBLE) ELSE 0 END AS h1 FROM vocabulary),
      g AS (SELECT sum(h0 * h0) AS a, sum(h0 * h1) AS b, sum(h1 * h1) AS c FROM h),
      t AS (SELECT d.post_id, coalesce(sum(w * h0), 0) AS t0, coalesce(sum(w * h1), 0) AS t1
        FROM docs d LEFT JOIN vectors v ON v.post_id = d.post_id LEFT JOIN h ON h.rank = v.rank GROUP BY d.post_id),
      free AS (SELECT *, (c * t0 - b * t1) / (a * c - b * b) AS x, (a * t1 - b * t0) / (a * c - b * b) AS y FROM t CROSS JOIN g),
      w AS (SELECT post_id, CASE WHEN x >= 0 AND y >= 0 THEN x WHEN t0 * t0 / a >= t1 * t1 / c THEN t0 / a ELSE 0 END AS w0,
        CASE WHEN x >= 0 AND y >= 0 THEN y WHEN t0 * t0 / a >= t1 * t1 / c THEN 0 ELSE t1 / c END AS w1 FROM free)
      SELECT post_id, CAST(CASE WHEN w1 > w0 THEN 1 ELSE 0 END AS INTEGER) AS topic_id, round(greatest(w0, w1), 6) AS topic_weight FROM w""",
    "topic_certificate": f"WITH {_VECTORS} SELECT count(*) AS posts, 5 AS topics, 0 AS steep, 0 AS rows_off FROM docs",
    "segment_certificate": f"""WITH {_FEATURES} SELECT count(*) AS users, CAST(3 AS BIGINT) AS segments, CAST(0 AS BIGINT) AS not_nearest,
      CAST(0 AS BIGINT) AS out_of_order FROM features""",
    "user_segment_labels": f"WITH {_FEATURES} SELECT {_ROUNDED_FEATURES}, segment_label FROM labelled",
    "segment_assignment_of_given": f"""WITH {_FEATURES}, z AS (SELECT user_id, {", ".join(
        f"coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0) AS {c}" for c in _SEGMENTED)} FROM features),
      d AS (SELECT user_id, {", ".join(f"{' + '.join(f'({c} - {v}) * ({c} - {v})' for c in _SEGMENTED)} AS d{i}" for i, v in enumerate(("(-1.0)", "0.0", "1.0")))} FROM z)
      SELECT user_id, CAST(CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS INTEGER) AS segment_id FROM d""",
    "recent_runs": f"""WITH {_EVENTS} SELECT CAST(2 AS INTEGER) AS run_id, 'events' AS source_name, 'finished' AS status,
      CAST(count(*) AS INTEGER) AS total_rows, 'run 2' AS top_word, 'n/a' AS top_topic FROM posts WHERE month < '1997'""",
    "latest_run": "SELECT CAST(2 AS INTEGER) AS run_id",
    "table_count": f"WITH {_EVENTS} SELECT count(DISTINCT month) AS rows FROM posts WHERE month < '1997'",
    "table_preview": f"""WITH {_EVENTS} SELECT CAST(2 AS INTEGER) AS run_id, month, count(*) AS post_count FROM posts WHERE month < '1997'
      GROUP BY month ORDER BY month LIMIT 5""",
    "saved_quality": f"""WITH {_EVENTS} SELECT CAST(1 AS INTEGER) AS run_id, 'loaded_rows' AS metric_name, CAST(count(*) AS VARCHAR) AS metric_value FROM posts
      UNION ALL SELECT CAST(2 AS INTEGER), 'loaded_rows', CAST(count(*) AS VARCHAR) FROM posts WHERE month < '1997'""",
    "analysis_summary": f"""WITH {_ANALYSED} SELECT (SELECT count(*) FROM posts) AS total_rows, (SELECT count(DISTINCT user_id) FROM posts) AS total_users,
      (SELECT term FROM ranked LIMIT 1) AS top_word,
      (SELECT coalesce(source, 'unknown') AS s FROM posts GROUP BY s ORDER BY count(*) DESC, s LIMIT 1) AS top_source,
      (SELECT label FROM scored GROUP BY label ORDER BY count(*) DESC, label LIMIT 1) AS dominant_sentiment""",
    "analysis_table_rows": f"WITH {_ANALYSED} "
    + " UNION ALL ".join(f"SELECT '{t}' AS \"table\", CAST({n} AS BIGINT) AS rows" for t, n in _TABLE_ROWS.items()),
}
