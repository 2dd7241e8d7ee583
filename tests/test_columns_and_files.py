"""Column mapping and readers."""

import json

import pytest

from postweave import settings
from postweave.operators.cleaning import dedupe_posts
from postweave.plans.analysis import Options, analyze
from postweave.sources import columns as C
from postweave.sources.files import inspect_csv, load_dataset, read_posts, scan_csv, scan_json

HEADER = ["id", "author", "created_datetime", "title", "text", "score", "num_comments", "subreddit"]
ROWS = [
    ["1", "u1", "2024-01-01", "Good launch", "success improve", "10", "2", "test"],
    ["2", "u1", "2024-01-02", "Bad issue", "problem failed", "1", "3", "test"],
    ["3", "u2", "2024-02-01", "Useful guide", "good useful", "5", "1", "demo"],
    ["4", "u3", "2024-02-02", "Ordinary note", "plain text", "0", "0", "demo"],
]


def write(path, separator=",", encoding="utf-8", rows=ROWS):
    lines = [separator.join(row) for row in [HEADER, *rows]]
    path.write_bytes(("\n".join(lines) + "\n").encode(encoding))
    return str(path)


@pytest.mark.parametrize(
    "raw, name",
    [("﻿id", "id"), (" Date Posted ", "date_posted"), ("num-comments", "num_comments"), ("A  b!!", "a_b"), ("Текст", "текст")],
)
def test_normalize_column_name(raw, name):
    assert C.normalize_column_name(raw) == name


def test_first_raw_name_wins_and_aliases_fill(spark):
    df = spark.createDataFrame([(1, "a", "t", "x", "u", "p")], ["id", "Author", "created_utc", "selftext", "permalink", "link"])
    mapped, match = C.map_columns(df)
    assert match.matched == {
        "post_id": "id", "user_id": "author", "datetime": "created_utc", "url": "permalink", "text": "selftext",
    }
    assert match.text_fields == ("text",)
    assert set(mapped.columns) == {"post_id", "user_id", "datetime", "url", "text", "link"}


def test_custom_mapping_replaces_the_default_one(spark):
    df = spark.createDataFrame([(1, 2, "w", "a", "t")], ["id", "score", "who", "author", "body"])
    mapped, match = C.map_columns(df, {"who": "user_id"})
    assert match.matched["user_id"] == "who" and match.matched["post_id"] == "id"
    assert match.matched["likes_count"] == "score" and "author" in mapped.columns


def test_name_in_the_way_gets_a_suffix(spark):
    df = spark.createDataFrame([("raw", "mapped")], ["text", "body"])
    mapped, _ = C.map_columns(df, {"body": "text"})
    assert mapped.first().asDict() == {"text": "mapped", "text_raw": "raw"}


def test_normalised_duplicates_stay_apart(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "A_B"])
    assert C.normalize_columns(df).columns == ["a_b", "a_b_2"]


def test_check_fields(spark):
    good = spark.createDataFrame([(1, "u1", "2024-01-01", "hello", "world")], ["id", "author", "created_datetime", "title", "text"])
    mapped, match = C.map_columns(good)
    C.check_fields(mapped, match)
    textless, match = C.map_columns(good.drop("title", "text"))
    with pytest.raises(ValueError, match="no text field"):
        C.check_fields(C.fill_optional(textless), match)
    undated, match = C.map_columns(good.drop("created_datetime"))
    with pytest.raises(ValueError, match="datetime"):
        C.check_fields(undated, match)


def test_fill_optional_keeps_nulls_of_present_columns(spark):
    df = spark.createDataFrame([("1", None)], "post_id string, source string")
    row = C.fill_optional(df).first()
    assert row.source is None and row.company == "unknown" and row.likes_count == 0 and row.url == ""


def test_suggest_mapping():
    found = C.suggest_mapping(["ID", "Posted At", "body", "flair", "num_comments"])
    assert found["post_id"] == "ID" and found["datetime"] == "Posted At" and found["text"] == "body"
    assert found["category"] == "flair" and found["user_id"] is None and set(found) == set(settings.FIELD_ALIASES)


@pytest.mark.parametrize("separator", [",", ";", "\t"])
def test_separators_give_the_same_rows(spark, tmp_path, separator):
    df = scan_csv(spark, write(tmp_path / "posts.csv", separator))
    assert df.columns == HEADER and [list(r) for r in df.collect()] == ROWS
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}


@pytest.mark.parametrize("encoding, found", [("utf-8", "utf-8"), ("utf-8-sig", "utf-8"), ("cp1251", "cp1251")])
def test_encodings(spark, tmp_path, encoding, found):
    rows = [[*ROWS[0][:4], "Ёлка привет", *ROWS[0][5:]]]
    path = write(tmp_path / "posts.csv", encoding=encoding, rows=rows)
    assert inspect_csv(spark, path).encoding == found
    mapped, _ = load_dataset(spark, path)
    assert mapped.select("post_id", "text").first() == ("1", "Ёлка привет")


def test_encoding_is_decided_by_the_whole_file(spark, tmp_path):
    rows = [[str(i), "u", "2024-01-01", "t", "plain", "0", "0", "s"] for i in range(500)]
    rows.append(["500", "u", "2024-01-01", "t", "хвост", "0", "0", "s"])
    df = scan_csv(spark, write(tmp_path / "posts.csv", encoding="cp1251", rows=rows))
    assert df.where("id = '500'").first().text == "хвост"


def test_latin_1_is_the_last_resort(spark, tmp_path):
    path = tmp_path / "posts.csv"
    path.write_bytes(b"id,text\n1,caf\xe9 \x98\n")
    assert inspect_csv(spark, str(path)).encoding == "latin-1"
    assert scan_csv(spark, str(path)).first().text == "café \x98"


def test_quoted_line_breaks_and_quotes(spark, tmp_path):
    path = tmp_path / "posts.csv"
    path.write_text('id,text\n1,"two\nlines, one ""quote"""\n2,plain\n', encoding="utf-8")
    assert inspect_csv(spark, str(path)).multi_line
    assert [r.text for r in scan_csv(spark, str(path)).collect()] == ['two\nlines, one "quote"', "plain"]


def test_lines_with_even_quotes_stay_splittable(spark, tmp_path):
    path = tmp_path / "posts.csv"
    path.write_text('id,text\n1,"a, ""b"""\n', encoding="utf-8")
    layout = inspect_csv(spark, str(path))
    assert not layout.multi_line and scan_csv(spark, str(path)).first().text == 'a, "b"'


@pytest.mark.parametrize("text, found", [('"a;b";c\n"x;y;z";w\n', ";"), ("a b\nc d\n", ","), ("", ",")])
def test_separator_ignores_marks_inside_quotes(spark, tmp_path, text, found):
    path = tmp_path / "posts.csv"
    path.write_text(text)
    assert inspect_csv(spark, str(path)).separator == found


@pytest.mark.parametrize("ragged", [1, 2, 30])
def test_ragged_rows_do_no_harm(spark, tmp_path, ragged):
    lines = ["id\ttext\tauthor"] + [f"{i}\tone, two\tu" for i in range(60)]
    lines[ragged] = "x\tshort"
    path = tmp_path / "posts.csv"
    path.write_text("\n".join(lines))
    assert inspect_csv(spark, str(path)).separator == "\t"


def test_files_with_different_separators_are_refused(spark, tmp_path):
    folder = tmp_path / "posts.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("a;b\n1;2\n")
    (folder / "b.csv").write_text("a\tb\n1\t2\n")
    with pytest.raises(ValueError, match="separators"):
        inspect_csv(spark, str(folder))


def test_session_setting_is_required_and_left_alone(spark, tmp_path):
    path = write(tmp_path / "posts.csv", encoding="cp1251", rows=[["1", "u", "2024-01-01", "t", "Ёлка", "0", "0", "s"]])
    spark.conf.set("spark.sql.legacy.javaCharsets", "false")
    try:
        with pytest.raises(ValueError, match="javaCharsets"):
            scan_csv(spark, path)
    finally:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")


def test_first_copy_by_place_in_files(spark, tmp_path):
    """Which copy stays follows the files, however the splits are read."""
    folder = tmp_path / "posts.csv"
    folder.mkdir()
    for k, size in ((0, 3), (1, 400), (2, 50)):
        lines = [f"{i},u,2024-01-0{k + 1},t,file {k} row {n}" for n, i in enumerate([7, *range(100 * k, 100 * k + size)])]
        (folder / f"part-{k}.csv").write_text("\n".join(["id,author,created_datetime,title,text", *lines]))
    kept = set()
    for split in ("128m", "2k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            mapped, _ = load_dataset(spark, str(folder), keep_order=True, separator=",", encoding="utf-8", multi_line=False)
            kept.add(tuple(sorted((r.post_id, r.text) for r in dedupe_posts(mapped).collect())))
            first, _ = load_dataset(spark, str(folder), 5, separator=",", encoding="utf-8", multi_line=False)
            assert sorted(r.text for r in first.collect()) == ["file 0 row 0", "file 0 row 1", "file 0 row 2", "file 0 row 3", "file 1 row 0"]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(kept) == 1 and dict(kept.pop())["7"] == "file 0 row 0"


def test_other_frames_need_an_order(spark):
    with pytest.raises(ValueError, match="order_by"):
        dedupe_posts(spark.createDataFrame([("1",)], "post_id string"))


def test_json_forms(spark, tmp_path):
    records = [dict(zip(HEADER, row)) for row in ROWS]
    array, lines, columns = tmp_path / "a.json", tmp_path / "l.json", tmp_path / "c.json"
    array.write_text(json.dumps(records, indent=1))
    lines.write_text("\n".join(json.dumps(r) for r in records))
    columns.write_text(json.dumps({"id": {"0": 1}, "text": {"0": "x"}}))
    for path in (array, lines):
        assert sorted(tuple(r) for r in scan_json(spark, str(path)).select(HEADER).collect()) == [tuple(r) for r in ROWS]
    with pytest.raises(ValueError, match="records"):
        scan_json(spark, str(columns))


def test_json_numbers_become_text(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('[{"id": 7, "score": 1.5}]')
    assert scan_json(spark, str(path)).first() == ("7", "1.5")


def test_format_dispatch(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p.parquet"))
    assert read_posts(spark, str(tmp_path / "p.parquet"), n_rows=2).count() == 2
    assert read_posts(spark, write(tmp_path / "POSTS.CSV")).count() == 4
    with pytest.raises(ValueError, match="unsupported"):
        read_posts(spark, str(tmp_path / "p.doc"))


def test_snapshots(spark, tmp_path):
    folder = str(tmp_path / "snapshots")
    mapped, _ = load_dataset(spark, write(tmp_path / "posts.csv"), snapshots=folder)
    assert mapped.count() == 4
    names = sorted(p.name.split("-")[0] for p in (tmp_path / "snapshots").iterdir())
    assert names == ["mapped", "raw"]


def test_analysis_snapshots_and_row_limit(spark, tmp_path):
    folder = tmp_path / "snapshots"
    result = analyze(spark, write(tmp_path / "posts.csv"), n_rows=3, options=Options(snapshots=str(folder)))
    assert result.quality["loaded_rows"] == 3 and result.summary["total_rows"] == 3
    kinds = {p.name.split("-")[0]: spark.read.parquet(str(p)) for p in folder.iterdir()}
    assert set(kinds) == {"raw", "mapped", "staged", "validated", "cleaned"}
    assert {name: frame.count() for name, frame in kinds.items()} == dict.fromkeys(kinds, 3)
    assert kinds["raw"].columns == HEADER and "clean_text" in kinds["cleaned"].columns
    assert "_has_text" not in kinds["validated"].columns


def test_align_schema(spark):
    df = spark.createDataFrame([(1, "x", 2)], "b int, extra string, a int")
    schema = spark.createDataFrame([], "a bigint, b int, c string").schema
    assert C.align_schema(df, schema).first() == (2, 1, None)


def test_whole_analysis_of_a_csv(spark, tmp_path):
    result = analyze(spark, write(tmp_path / "posts.csv"))
    assert result.match.matched["source"] == "subreddit"
    assert result.summary["total_rows"] == 4 and result.summary["total_users"] == 3
    assert result.summary["dominant_sentiment"] == "positive" and result.summary["top_word"] == "good"
    assert len(result.tables) == 26
    assert result.quality["loaded_rows"] == 4 and result.quality["final_clean_rows"] == 4
    assert sum(v for k, v in result.quality.items() if k.endswith("removed") or "_removed_" in k) == 0
    posts = {r.post_id: r for r in result.posts.collect()}
    assert [posts[i].engagement_score for i in "1234"] == [12, 4, 6, 0]
    assert [posts[i].text_length for i in "1234"] == [4, 4, 4, 4]
    assert [(posts[i].positive_word_count, posts[i].negative_word_count) for i in "1234"] == [(3, 0), (0, 4), (3, 0), (0, 0)]
    assert [posts[i].sentiment_score for i in "1234"] == [1, -1, 1, 0]
    tables = {name: [tuple(r) for r in table.collect()] for name, table in result.tables.items()}
    assert tables["engagement_distribution"] == [("0", 1), ("1-5", 1), ("6-20", 2), ("21-100", 0), ("100+", 0)]
    assert tables["top_words"][:2] == [("good", 2), ("useful", 2)]
    assert tables["growing_terms"] == []
    assert tables["user_distribution"] == [("1 post", 2), ("2-5 posts", 1)]
    assert tables["posts_by_month"] == [("2024-01", 2), ("2024-02", 2)]
    assert [r[1] for r in tables["user_activity_by_month"]] == [1, 2]
    assert tables["sentiment_distribution"][0][:2] == ("positive", 2)
    labels = dict(result.tables["user_segments"].select("user_id", "segment_label").collect())
    assert labels == {"u1": "medium_activity", "u2": "medium_activity", "u3": "low_activity"}
    assert sorted(r.posts_count for r in result.tables["topic_summary"].collect()) and len(tables["post_topics"]) == 4
