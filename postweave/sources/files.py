"""Readers: delimited text, JSON and Parquet files of posts with arbitrary column names."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postweave import settings
from postweave.operators.cleaning import ORDER, with_input_order
from postweave.plans.storage import stored
from postweave.sources.columns import ColumnMatch, fill_optional, map_columns
from postweave.sources.records import scan_multi_line


@dataclass(frozen=True)
class CsvLayout:
    """How a delimited text file is to be read."""

    separator: str
    encoding: str
    multi_line: bool


def _bytes_as_text() -> Column:
    """One character per byte: enough to see quotes, brackets and separators."""
    return F.decode(F.col("value").cast("binary"), "iso-8859-1")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all files with their file and their place in it."""
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    place = F.struct("_metadata.file_block_start", within.alias("row"))
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), place.alias("place"))


def _fields(line: Column, separator: str) -> Column:
    """Number of fields of a line; separators inside quotes do not count."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(separator), F.lit(""))) + 1


def inspect_csv(spark: SparkSession, path: str) -> CsvLayout:
    """Find separator, encoding and quoted line breaks in one distributed pass over the raw lines.

    Lines are counted by file and number of fields for each separator. The separator of a file is the
    one by which most lines have as many fields (over 1) as its first line, so ragged rows do
    no harm wherever they are; by equal numbers the one with more fields. All files must agree. The same counts tell whether
    all lines are valid UTF-8, whether one holds the single byte that cp1251 does not define, and whether one has an
    odd number of quotes (a record may then go on in the next line, and the file cannot be split at
    line ends). Name the options where they are known.
    """
    lines = _lines(spark, path)
    # Quotes are single bytes in all these encodings.
    as_text = _bytes_as_text()
    quotes = F.length(as_text) - F.length(F.replace(as_text, F.lit('"'), F.lit("")))
    blank = F.trim(as_text) == ""
    widths = [F.when(~blank, _fields(as_text, c)).alias(f"w{i}") for i, c in enumerate(settings.CSV_SEPARATORS)]
    kinds = lines.select(
        "file",
        "place",
        *widths,
        F.is_valid_utf8("value").alias("utf8"),
        as_text.contains("\x98").alias("not_cp1251"),
        (quotes % 2 == 1).alias("open_quote"),
    )
    names = [f"w{i}" for i in range(len(widths))]
    counted = kinds.groupBy("file", *names).agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("place").alias("first"),
        F.bool_and("utf8").alias("utf8"),
        F.bool_or("not_cp1251").alias("not_cp1251"),
        F.bool_or("open_quote").alias("open_quote"),
    )
    headers = counted.where(F.col(names[0]).isNotNull()).groupBy("file").agg(*(F.min_by(n, "first").alias(f"head_{n}") for n in names))
    judged = counted.join(headers, "file", "left")
    per_file = judged.groupBy("file").agg(
        *(F.sum(F.when((F.col(n) == F.col(f"head_{n}")) & (F.col(n) > 1), F.col("lines"))).alias(n) for n in names),
        *(F.max(f"head_{n}").alias(f"head_{n}") for n in names),
        F.bool_and("utf8").alias("utf8"),
        F.bool_or("not_cp1251").alias("not_cp1251"),
        F.bool_or("open_quote").alias("open_quote"),
    )
    rank = [F.struct(F.coalesce(n, F.lit(0)), F.coalesce(f"head_{n}", F.lit(0)), F.lit(-i).alias("order")) for i, n in enumerate(names)]
    best = (-F.greatest(*rank)["order"]).alias("best")
    found = per_file.agg(
        F.collect_set(best).alias("best"),
        F.bool_and("utf8").alias("utf8"),
        F.bool_or("not_cp1251").alias("not_cp1251"),
        F.bool_or("open_quote").alias("open_quote"),
    ).first()
    if len(found.best) > 1:
        marks = ", ".join(repr(settings.CSV_SEPARATORS[i]) for i in sorted(found.best))
        raise ValueError(f"files with different separators ({marks}): read them one by one, or name the separator")
    first, second, last = settings.CSV_ENCODINGS
    encoding = first if found.utf8 in (True, None) else (last if found.not_cp1251 else second)
    separator = settings.CSV_SEPARATORS[found.best[0] if found.best else 0]
    return CsvLayout(separator, encoding, bool(found.open_quote))


def _java_name(encoding: str) -> str:
    return {"latin-1": "iso-8859-1", "cp1251": "windows-1251", "utf-8-sig": "utf-8"}.get(encoding, encoding)


def scan_csv(
    spark: SparkSession,
    path: str,
    separator: str | None = None,
    encoding: str | None = None,
    multi_line: bool | None = None,
    in_splits: bool = False,
) -> DataFrame:
    """Delimited text with a header; every column as text. Options left out are found by inspection.

    Files whose quoted fields hold line breaks are read whole by one task each, or, ``in_splits``, by as many as others; the frame
    then has the place of each record, too (see ``scan_multi_line``).
    """
    if separator is None or encoding is None or multi_line is None:
        layout = inspect_csv(spark, path)
        separator = layout.separator if separator is None else separator
        encoding = layout.encoding if encoding is None else encoding
        multi_line = layout.multi_line if multi_line is None else multi_line
    java = _java_name(encoding)
    if java.startswith("windows") and spark.conf.get("spark.sql.legacy.javaCharsets") != "true":
        raise ValueError(f"set spark.sql.legacy.javaCharsets to true on the session to read {encoding}")
    if multi_line and in_splits:
        return scan_multi_line(spark, path, separator, java)
    return spark.read.csv(
        path, header=True, sep=separator, encoding=java, quote='"', escape='"', multiLine=multi_line
    )


def scan_json(spark: SparkSession, path: str, lines: bool | None = None, schema: str | T.StructType | None = None) -> DataFrame:
    """JSON records, plain values as text: one array of records per file, or one record per line.

    JSON Lines files are split among tasks; an array is read by one task per file. Without ``schema`` the
    fields are found by another pass over the data, as is the form without ``lines``.
    """
    lines = _is_json_lines(spark, path) if lines is None else lines
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path, multiLine=not lines, primitivesAsString=True)


def _is_json_lines(spark: SparkSession, path: str) -> bool:
    """Whether every line is a record; a column-wise document (field -> row -> value) is refused."""
    text = F.regexp_replace(F.trim(F.regexp_replace(_bytes_as_text(), "^\xef\xbb\xbf", "")), "\\s+$", "")
    found = (
        _lines(spark, path)
        .select(text.alias("text"), "file", "place")
        .where("text <> ''")
        .agg(
            F.bool_and(F.col("text").startswith("{") & F.col("text").endswith("}")).alias("lines"),
            F.min_by("text", F.struct("file", "place")).alias("first"),
            F.count(F.lit(1)).alias("count"),
        )
        .first()
    )
    if found.first is None:
        return True
    if found.lines and found["count"] == 1:
        try:
            record = json.loads(found.first)
        except ValueError:
            record = {}
        values = list(record.values())
        if values and all(isinstance(v, dict) and v and all(k.isdigit() for k in v) for v in values):
            raise ValueError("JSON must hold records: an array of objects, or one object per line")
    if not found.lines and not found.first.startswith("["):
        raise ValueError("JSON must hold records: an array of objects, or one object per line")
    return found.lines


def read_posts(
    spark: SparkSession, path: str, n_rows: int | None = None, file_format: str | None = None, **options
) -> DataFrame:
    """Read a file by its suffix: .csv, .json or .parquet. ``n_rows`` takes the first rows only.

    Which rows are the first is decided by their place in the files.
    """
    kind = (file_format or path.rstrip("/").rpartition(".")[2]).lower()
    if kind == "csv":
        df = scan_csv(spark, path, **options)
    elif kind in ("json", "jsonl"):
        df = scan_json(spark, path, **options)
    elif kind == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported file format: {kind}")
    if n_rows is None:
        return df
    return limit_rows(with_input_order(df).orderBy(ORDER), n_rows).drop(ORDER)


def limit_rows(df: DataFrame, n_rows: int | None = None) -> DataFrame:
    return df if n_rows is None else df.limit(n_rows)


def load_dataset(
    spark: SparkSession,
    path: str,
    n_rows: int | None = None,
    mapping: Mapping[str, str] | None = None,
    snapshots: str | None = None,
    keep_order: bool = False,
    **options,
) -> tuple[DataFrame, ColumnMatch]:
    """Read, map to the canonical fields and fill absent optional ones.

    With ``snapshots`` the raw and the mapped table are also written there. A row limit is stored
    too, as finding the first rows reads all files. ``keep_order`` adds the place of each row in the files, for the dedupe.
    """
    if (options.get("file_format") or path.rstrip("/").rpartition(".")[2]).lower() == "csv":
        options.setdefault("in_splits", True)
    raw = read_posts(spark, path, None, **options)
    if keep_order or n_rows is not None:
        raw = with_input_order(raw)
    if n_rows is not None:
        raw = stored(limit_rows(raw.orderBy(ORDER), n_rows), "first-rows")
    raw = raw if keep_order else raw.drop(ORDER)
    mapped, match = map_columns(raw, mapping)
    mapped = fill_optional(mapped)
    if snapshots:
        stored(raw.drop(ORDER), "raw", snapshots)
        stored(mapped.drop(ORDER), "mapped", snapshots)
    return mapped, ColumnMatch(tuple(c for c in match.original if c != ORDER), match.matched, match.text_fields)
