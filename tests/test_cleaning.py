"""Text, numbers, dates, dedupe and the counts of the stages."""

import datetime as dt
import re
import random

import pytest
from pyspark.sql import functions as F

from postweave import settings
from postweave.functions import text as X
from postweave.functions import dates
from postweave.functions import values as V
from postweave.operators import cleaning
from postweave.plans.analysis import Options, clean_posts
from postweave.plans.quality import METRICS, quality_counts, quality_report
from postweave.sources.columns import fill_optional


def apply(spark, values, expression, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r.out for r in df.select("i", expression.alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "raw, cleaned, normal",
    [
        ("Check this http://example.com now!", "check this now", "check"),
        ("This is a simple market analysis text", "this is a simple market analysis text", "simple market analysis text"),
        ("a&amp;b C++ foo_bar 123 abc123 Ёлка ПРИВЕТ", "a b c foo bar 123 abc123 ёлка привет", "foo bar abc123 ёлка привет"),
        ("http", "http", "http"),
        ("", "", ""),
        ("see www.x.y/z?a=b next\u001cword", "see next word", "word"),
        ("xhttp://abc end", "x end", "end"),
        ("!&amp;!&x 12 2024", "x 12 2024", ""),
        ("\U0001f600 don't", "don t", "don"),
    ],
)
def test_text(spark, raw, cleaned, normal):
    df = spark.createDataFrame([(raw,)], "v string").select(X.clean_text("v").alias("c"), X.normalize_text("v").alias("n"))
    assert tuple(df.first()) == (cleaned, normal)


def test_text_agrees_with_python_on_hostile_strings(spark):
    """The same steps with Python's re, which the definitions follow."""
    import re

    pieces = ["http", "www", "HTTP://x", "&", "&amp;", "amp;", "\t", "\n", " ", " ", "\u001c", "\x85", "a", "Ё", "é", "İ",
              "the", "12", "x1", "_", "-", "+", "|", "\\", "/", ".", "\U0001f600", "ß", "K", "market", " "]
    rng = random.Random(7)
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(400)]

    def expected(t):
        t = re.sub(r"http\S+|www\S+", " ", t.lower())
        t = re.sub(r"[^0-9a-zа-яё\s]", " ", t.replace("&amp;", " "))
        return re.sub(r"\s+", " ", t).strip()

    stop = settings.default_stop_words()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    rows = df.select(X.clean_text("v").alias("c"), X.normalize_text("v").alias("n"), "i").orderBy("i").collect()
    assert [r.c for r in rows] == [expected(t) for t in texts]
    kept = lambda c: " ".join(w for w in c.split() if len(w) >= 3 and w not in stop and not w.isdigit())
    assert [r.n for r in rows] == [kept(expected(t)) for t in texts]


def test_stop_words():
    words = settings.default_stop_words()
    assert len(words) == len(settings.STOP_WORDS) == 318 and sum(len(w) >= 3 for w in words) == 286
    assert all(w.isalpha() and w == w.lower() for w in words)


def test_extra_stop_words_and_length(spark):
    df = spark.createDataFrame([("Alpha beta it's ab",)], "v string")
    assert df.select(X.tokenize("v", extra_stop_words=["ALPHA"])).first()[0] == ["beta"]
    assert df.select(X.tokenize("v", stop_words=[], min_length=1)).first()[0] == ["alpha", "beta", "it", "s", "ab"]


def test_strip_knows_all_white_space(spark):
    assert apply(spark, ["  a b\u001c\n", " "], X.strip(F.col("v"))) == ["a b", ""]


def test_sanitize_label(spark):
    found = apply(spark, ["Привет \U0001f600 a*b (x)/y", "\U0001f600", None, " a   b "], X.sanitize_label(F.col("v")))
    assert found == ["Привет ab (x)/y", "unknown", "None", "a b"]


def test_numbers(spark):
    values = ["1d", "1.5f", " 12 ", "1e3", "nan", "inf", "", "0x10", "-2.5", ".5", "1_0", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    found = [r[0] for r in df.select(V.to_count(F.col("v"), df.schema["v"].dataType)).collect()]
    assert found == [0, 0, 12, 1000, 0, float("inf"), 0, 0, -2.5, 0.5, 0, 0]
    typed = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "v double")
    assert [r[0] for r in typed.select(V.to_count(F.col("v"), typed.schema["v"].dataType)).collect()] == [1.5, 0, 0]


def test_is_present(spark):
    values = ["x", " NaN ", "None", "null", "NaT", "unknown", "", " ", None, "0"]
    assert apply(spark, values, V.is_present(F.col("v"))) == [True] + [False] * 8 + [True]


def test_engagement_bin(spark):
    values = [-2.0, -1.0, -0.5, 0.0, 0.5, 5.0, 5.5, 100.0, 1e6, 1e6 + 1, None, float("nan")]
    found = apply(spark, values, V.engagement_bin(F.col("v")), "double")
    assert found == [None, "0", "0", "0", "1-5", "1-5", "6-20", "21-100", "100+", None, None, None]


def test_activity_group_and_label(spark):
    assert apply(spark, [1, 2, 5, 6, 10, 11], V.activity_group(F.col("v")), "int") == [
        "1 post", "2-5 posts", "2-5 posts", "6-10 posts", "6-10 posts", "10+ posts",
    ]
    pairs = spark.createDataFrame([(1, 5.0), (1, 6.0), (5, 0.0), (1, 20.0), (2, 0.0)], "p int, e double")
    found = [r[0] for r in pairs.select(V.activity_label(F.col("p"), F.col("e"))).collect()]
    assert found == ["low_activity", "medium_activity", "high_activity", "high_activity", "medium_activity"]


def parsed(spark, values, reading="auto", **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, datetime string")
    return [r.datetime for r in cleaning.parse_datetime_column(df, reading, **options).orderBy("i").collect()]


def test_dates_in_any_declared_format(spark):
    values = ["2024-01-05", '"2024-01-05 10:20:30"', "2024-01-05T10:20:30Z", "01/02/2024", "01/02/2024 03:04", "20240105",
              "5 Jan 2024", "January 5, 2024", "2024/01/05 10:00", "'2024-02-30'", "x", "13/45/2024", None, "1500-01-01", "12:30:00"]
    day = dt.datetime(2024, 1, 5)
    time = dt.datetime(2024, 1, 5, 10, 20, 30)
    assert parsed(spark, values) == [
        day, time, time, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4), day, day, day,
        dt.datetime(2024, 1, 5, 10), None, None, None, None, None, None,
    ]


def test_formats_of_the_same_shape_are_tried_in_order(spark):
    formats = ["MM/dd/yyyy", "dd/MM/yyyy"]
    assert parsed(spark, ["02/03/2024", "25/03/2024"], formats=formats) == [dt.datetime(2024, 2, 3), dt.datetime(2024, 3, 25)]


def test_epoch_only_if_nothing_else_parses(spark):
    moment = dt.datetime(2023, 11, 14, 22, 13, 20)
    assert parsed(spark, ["1700000000", "x"]) == [moment, None]
    assert parsed(spark, ["1700000000000", "x"]) == [moment, None]
    assert parsed(spark, ["1700000000", "2024-01-01"]) == [None, dt.datetime(2024, 1, 1)]
    assert parsed(spark, ["x", None]) == [None, None]
    assert parsed(spark, ["1700000000"], "second") == [moment]
    with pytest.raises(ValueError):
        parsed(spark, ["x"], "other")


RAW = [
    ("1", "u1", "2024-01-01", "a", "text"),
    (None, "u2", "2024-01-02", "b", "text"),
    ("nan", "u3", "2024-01-03", "c", "text"),
    ("4", "", "2024-01-04", "d", "text"),
]


def test_required_values(spark):
    raw = fill_optional(spark.createDataFrame(RAW, "post_id string, user_id string, datetime string, title string, text string"))
    rows = cleaning.validate_posts(raw, ["post_id"]).collect()
    assert [r.post_id for r in rows] == ["1"]
    counts = quality_counts(raw, ["post_id"]).first()
    assert counts.missing_required_removed == 3 and counts.duplicates_removed == 0 and counts.rows_after_validation == 1


def untidy(spark):
    rows = [
        (0, "7", "u1", "2024-01-01", "first", "market text", "1"),
        (1, " 7 ", "u1", "2024-01-01", "second", "market text", "1"),
        (2, "8", "u2", "2024-01-02", None, " ", "x"),
        (3, "9", "u2", "2024-01-02", "the", "of and", "2"),
        (4, "10", "u3", "no date", "fine", "words", "2"),
        (5, "11", "unknown", "2024-01-02", "fine", "words", "2"),
        (6, "12", "u4", "2024-02-29", "fine", "words", "1e2"),
    ]
    df = spark.createDataFrame(rows, "n int, post_id string, user_id string, datetime string, title string, text string, likes_count string")
    return fill_optional(df)


EXPECTED = dict(zip(METRICS, [7, 1, 1, 1, 4, 4, 1, 1, 2], strict=True))


def test_dedupe_keeps_the_first(spark):
    df = untidy(spark).repartition(5)
    kept = cleaning.dedupe_posts(cleaning.trim_keys(cleaning.filter_required(df)), ["n"])
    assert {r.post_id: r.n for r in kept.collect()} == {"7": 0, "8": 2, "9": 3, "10": 4, "12": 6}
    assert "_input_order" not in kept.columns


def test_dedupe_cuts_copies_before_the_shuffle(spark):
    plan = cleaning.dedupe_posts(untidy(spark), ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_counts_of_the_stages_agree(spark):
    raw = untidy(spark)
    counts = quality_counts(raw, ["n"])
    assert {m: counts.first()[m] for m in METRICS} == EXPECTED
    assert [tuple(r) for r in quality_report(counts).collect()] == list(EXPECTED.items())
    posts, found = clean_posts(raw, Options(order_by=["n"]))
    assert {m: found[m] for m in METRICS} == EXPECTED
    lazy = cleaning.preprocess_posts(cleaning.validate_posts(raw, ["n"]))
    columns = ["post_id", "title", "month", "likes_count", "engagement_score", "clean_text", "text_length"]
    assert sorted(map(tuple, posts.select(columns).collect())) == sorted(map(tuple, lazy.select(columns).collect()))
    assert {r.post_id: r.likes_count for r in lazy.collect()} == {"7": 1.0, "12": 100.0}


def test_counts_of_nothing(spark):
    counts = quality_counts(untidy(spark).where("n < 0"), ["n"]).first()
    assert [counts[m] for m in METRICS] == [0] * 9


def test_one_hot_post_id(spark):
    """A third of all rows under one key: still one row per key, and the right one."""
    df = spark.range(30000).select(
        F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("post_id")
    )
    kept = cleaning.dedupe_posts(df.repartition(8), ["n"])
    assert kept.count() == 20001 and kept.where("post_id = 'hot'").first().n == 0


def test_empty_filter_tokenises_once(spark):
    df = cleaning.preprocess_posts(untidy(spark), "format").select("tokens")
    assert df._jdf.queryExecution().executedPlan().toString().count("regexp_extract_all") == 1


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1/5/2024", "2024-01-05 00:00:00"),
        ("1/5/2024 13:45", "2024-01-05 13:45:00"),
        ("1/5/2024 1:45 PM", "2024-01-05 13:45:00"),
        ("1/5/2024 1:45 pm", "2024-01-05 13:45:00"),
        ("01/05/2024 01:45:00 PM", "2024-01-05 13:45:00"),
        ("05.01.2024", "2024-05-01 00:00:00"),
        ("2024.01.05", "2024-01-05 00:00:00"),
        ("2024/1/5", "2024-01-05 00:00:00"),
        ("5-Jan-2024", "2024-01-05 00:00:00"),
        ("01-05-2024", "2024-01-05 00:00:00"),
        ("Jan 5, 2024 1:45 PM", "2024-01-05 13:45:00"),
        ("Wed Oct 10 20:19:24 +0000 2018", "2018-10-10 20:19:24"),
        ("Wed, 10 Oct 2018 20:19:24 GMT", "2018-10-10 20:19:24"),
        ("20240105T134500", "2024-01-05 13:45:00"),
        ("13/45/2024", None),
        ("Wednesday", None),
    ],
)
def test_spellings_of_dates(spark, text, expected):
    df = spark.createDataFrame([(text,)], "datetime string")
    found = cleaning.parse_datetime_column(df, "format").first().datetime
    assert (str(found) if found else None) == expected


def test_day_first(spark):
    df = spark.createDataFrame([("05.01.2024",), ("5/1/2024 13:45",), ("13-01-2024",), ("2024/1/5",), ("Jan 5, 2024",)], "datetime string")
    found = [str(r.datetime) for r in cleaning.parse_datetime_column(df, "format", dayfirst=True).collect()]
    assert found == ["2024-01-05 00:00:00", "2024-01-05 13:45:00", "2024-01-13 00:00:00", "2024-01-05 00:00:00", "2024-01-05 00:00:00"]


def written(moment, date_format):
    """What a date format makes of a time, by its letters."""
    month = moment.strftime("%B")
    fields = {
        "yyyy": f"{moment.year:04}", "M": str(moment.month), "MM": f"{moment.month:02}", "MMM": month[:3], "MMMM": month,
        "d": str(moment.day), "dd": f"{moment.day:02}", "H": str(moment.hour), "HH": f"{moment.hour:02}", "mm": f"{moment.minute:02}",
        "ss": f"{moment.second:02}", "h": str((moment.hour + 11) % 12 + 1), "a": "pm" if moment.hour > 11 else "AM",
    }
    return re.sub(r"([A-Za-z])\1*", lambda run: fields[run.group()], date_format)


def test_every_declared_format_reads_what_it_writes(spark):
    rng = random.Random(1)
    cases = []
    for date_format in dates.DATETIME_FORMATS:
        for _ in range(25):
            moment = dt.datetime(rng.randint(1700, 2200), rng.randint(1, 12), rng.randint(1, 28), rng.randint(0, 23), rng.randint(0, 59), rng.randint(0, 59))
            kept = {"hour": moment.hour, "minute": moment.minute, "second": moment.second}
            kept["second"] *= "s" in date_format
            kept = {k: v * ("m" in date_format) for k, v in kept.items()}
            cases.append((written(moment, date_format), moment.replace(**kept)))
    assert parsed(spark, [text for text, _ in cases], "format") == [moment for _, moment in cases]


@pytest.mark.parametrize("text", ["5/1/2024 3:4", "31/31/2024", "2024.02.30", "5 Jax 2024", "5 Januar 2024", "Jan 32, 2024", "1/5/2024 13:45 PM",
                                  "1/5/2024 0:45 am", "1/5/2024 10:60", "1/5/2024 10:10:60", "1/5/24", "20241305", "1700000000", "am", "1/5/2024 pm", "٣/٥/2024", "\x01\x02"])
def test_texts_that_are_no_dates(spark, text):
    assert parsed(spark, [text], "format") == [None]


def test_custom_formats(spark):
    moment = dt.datetime(2024, 5, 7, 3, 4, 5)
    assert parsed(spark, ["07.05.24 03h"], formats=["dd.MM.yy HH'h'".replace("'", "").replace("h", "~")]) == [None]
    assert parsed(spark, ["07052024-030405"], formats=["ddMMyyyy-HHmmss"]) == [moment]
    assert parsed(spark, ["07.05.24 3:04"], formats=["dd.MM.yy H:mm"]) == [moment.replace(second=0)]
    assert parsed(spark, ["2024|5|7 03:04:05.250"], formats=["yyyy|M|d HH:mm:ss.SSS"]) == [moment.replace(microsecond=250000)]
    assert parsed(spark, ["Tue|7|May|2024"], formats=["E|d|MMM|yyyy"]) == [dt.datetime(2024, 5, 7)]
    with pytest.raises(ValueError):
        parsed(spark, ["x"], formats=["yyyy-MM-dd XXX"])


def test_offsets_leave_the_time_as_written(spark):
    texts = ["12 Oct 2018 20:19:24 +0300", "Fri, 12 Oct 2018 20:19:24 GMT+03:00", "2018-10-12T20:19:24-05:00", "Fri Oct 12 20:19:24 -0800 2018"]
    assert parsed(spark, texts, "format") == [dt.datetime(2018, 10, 12, 20, 19, 24)] * 4


@pytest.mark.parametrize("unit, number", [("day", 19675), ("hour", 472222), ("minute", 28333333), ("micro", 1700000000123456), ("nano", 1700000000123456000)])
def test_epoch_units(spark, unit, number):
    expected = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=number * 10**6 * dates.EPOCH_UNITS[unit] / 10**6)
    found = parsed(spark, [str(number), "x"], unit)
    assert abs(found[0] - expected) <= dt.timedelta(microseconds=1) and found[1] is None


def test_no_date_is_parsed_by_trial(spark):
    """No format parser in the plan; each step is made once."""
    df = spark.createDataFrame([("1",)], "datetime string")
    plan = cleaning.filter_datetime(cleaning.parse_datetime_column(df, "format"))._jdf.queryExecution().executedPlan().toString().lower()
    assert "gettimestamp" not in plan and "to_timestamp" not in plan
    assert plan.count("split(") == 2


@pytest.fixture(scope="module")
def scanned(spark, tmp_path_factory):
    """Sixteen files; a third of all rows under one key, half of the others twice."""
    folder = str(tmp_path_factory.mktemp("posts") / "p")
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string"))
    df = spark.range(12000).select(F.col("id").alias("n"), hot.alias("post_id"), F.repeat(F.lit("text "), 50).alias("text"))
    df.repartitionByRange(16, "n").write.parquet(folder)
    return folder


def firsts(spark, folder):
    rows = spark.read.parquet(folder).select("n", "post_id", "_metadata.file_path", "_metadata.row_index").collect()
    best = {}
    for r in sorted(rows, key=lambda r: (r.file_path, r.row_index)):
        best.setdefault(r.post_id, r.n)
    return best


def test_copies_of_a_scan_go_without_a_shuffle_of_texts(spark, scanned, monkeypatch):
    kept = cleaning.dedupe_posts(spark.read.parquet(scanned))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Window" not in plan and "BroadcastHashJoin" in plan
    assert kept.columns == ["n", "post_id", "text"]
    expected = firsts(spark, scanned)
    assert {r.post_id: r.n for r in kept.collect()} == expected and kept.count() == len(expected)
    # Too many keys with copies: the way by windows gives the same rows.
    monkeypatch.setattr(cleaning, "LATE_KEYS", 10)
    other = cleaning.dedupe_posts(spark.read.parquet(scanned))
    assert "Window" in other._jdf.queryExecution().executedPlan().toString()
    assert {r.post_id: r.n for r in other.collect()} == expected


def test_scans_without_copies_and_null_keys(spark, scanned):
    unique = spark.read.parquet(scanned).withColumn("post_id", F.col("n").cast("string"))
    kept = cleaning.dedupe_posts(unique)
    assert kept.count() == 12000 and "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    nulls = spark.read.parquet(scanned).withColumn("post_id", F.when(F.col("n") % 2 == 0, F.col("n").cast("string")))
    assert cleaning.dedupe_posts(nulls).count() == 6001
