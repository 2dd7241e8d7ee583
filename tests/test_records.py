"""Multi-line CSV in splits: the rows of Spark's own reader, by more than one task."""

import random

import pytest
from pyspark.sql import functions as F

from postweave.operators.cleaning import ORDER, dedupe_posts
from postweave.sources.files import load_dataset, scan_csv


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def quoted(value):
    return '"' + value.replace('"', '""') + '"'


def write(path, rows, end="\n", encoding="utf-8"):
    lines = ["post_id,user_id,text"] + [f"{i},{quoted(u)},{quoted(t)}" for i, u, t in rows]
    path.write_bytes((end.join(lines) + end).encode(encoding))


def some_rows(seed, n, longest=60):
    rng = random.Random(seed)
    pieces = ["word", "é", '"', ",", "\n", "\n\n", " ", "'", ";", "x" * 30, '""', "\\"]
    return [(k, f"u{k}", "t" + "".join(rng.choice(pieces) for _ in range(rng.randint(0, longest)))) for k in range(n)]


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_rows_of_the_whole_file_reader(spark, tmp_path, small_splits, seed, end):
    folder = tmp_path / "posts.csv"
    folder.mkdir()
    for part in range(3):
        write(folder / f"{part}.csv", some_rows(seed * 10 + part, 60, 200 if part == 2 else 40), end)
    found = scan_csv(spark, str(folder), ",", "utf-8", True, in_splits=True)
    whole = scan_csv(spark, str(folder), ",", "utf-8", True)
    assert found.select("post_id", "user_id", "text").schema == whole.schema
    assert sorted(map(tuple, found.drop(ORDER).collect())) == sorted(map(tuple, whole.collect()))
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 3
    # Places ascend as the records do in each file.
    ordered = [int(r.post_id) for r in found.orderBy(ORDER).collect()]
    assert ordered == list(range(60)) * 3


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    rows = [(0, "a", "short"), (1, "b", "\n".join(f"line {k}" for k in range(2000))), (2, "c", "end"), (3, "d", "\n" * 900 + "x")]
    write(tmp_path / "posts.csv", rows)
    found = scan_csv(spark, str(tmp_path / "posts.csv"), ",", "utf-8", True, in_splits=True).orderBy(ORDER).collect()
    assert [(int(r.post_id), r.user_id, r.text) for r in found] == rows


@pytest.mark.parametrize("encoding, text", [("windows-1251", "привет\nмир"), ("iso-8859-1", "é\nü")])
def test_encodings(spark, tmp_path, small_splits, encoding, text):
    rows = [(k, "u", text + str(k)) for k in range(100)]
    write(tmp_path / "posts.csv", rows, encoding=encoding)
    found = scan_csv(spark, str(tmp_path / "posts.csv"), ",", encoding, True, in_splits=True).orderBy(ORDER).collect()
    assert [r.text for r in found] == [t for _, _, t in rows]


def test_odd_files(spark, tmp_path, small_splits):
    read = lambda name: [tuple(r)[:3] for r in scan_csv(spark, str(tmp_path / name), ",", "utf-8", True, in_splits=True).orderBy(ORDER).collect()]
    (tmp_path / "header.csv").write_text("post_id,user_id,text\n")
    assert read("header.csv") == []
    (tmp_path / "no_end.csv").write_text('post_id,user_id,text\n1,u,"a\nb"')
    assert read("no_end.csv") == [("1", "u", "a\nb")]
    (tmp_path / "blank.csv").write_text('post_id,user_id,text\n\n1,u,\n   \n2,,"x\n\ny"\n')
    assert read("blank.csv") == [("1", "u", None), ("2", None, "x\n\ny")]
    (tmp_path / "header2.csv").write_text('post_id,"user\nid",text\n1,u,a\n')
    assert read("header2.csv") == [("1", "u", "a")]


def test_first_of_copies_and_row_limit(spark, tmp_path, small_splits):
    rows = [(k % 7, f"u{k}", f"a\nb {k}") for k in range(300)]
    write(tmp_path / "posts.csv", rows)
    mapped, _ = load_dataset(spark, str(tmp_path / "posts.csv"), keep_order=True)
    kept = dedupe_posts(mapped).collect()
    assert sorted((int(r.post_id), r.user_id) for r in kept) == [(k, f"u{k}") for k in range(7)]
    first, _ = load_dataset(spark, str(tmp_path / "posts.csv"), 5)
    assert sorted(r.user_id for r in first.collect()) == [f"u{k}" for k in range(5)]
    assert ORDER not in first.columns
