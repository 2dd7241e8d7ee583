"""Row cleaning: required values, duplicates, empty texts, dates, derived post columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postweave import settings
from postweave.functions.dates import (
    DATETIME_FORMATS,
    EPOCH_UNITS,
    day_first,
    epoch_time,
    in_clock_range,
    unquote,
    with_parsed_datetime,
)
from postweave.functions.text import clean_text, has_text, strip, tokenize
from postweave.functions.values import column_type, is_present, parse_number, to_count
from postweave.plans.storage import stored

# Column that holds the input order between the scan and the dedupe.
ORDER = "scan_position"
# Keys with copies, and characters of them and their files, that may be sent to all tasks.
LATE_KEYS, LATE_CHARS = 500_000, 128 << 20


def required_present() -> Column:
    """True where the three required fields all hold a value."""
    present = [is_present(F.col(f)) for f in settings.REQUIRED_FIELDS]
    return present[0] & present[1] & present[2]


def filter_required(df: DataFrame) -> DataFrame:
    return df.where(required_present())


def trim_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({k: strip(F.col(k).cast("string")) for k in ("post_id", "user_id")})


def with_input_order(df: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Add the input order: the given columns, or the position in the files. Nulls come last.

    Without columns the frame must be a scan of files, projected or filtered only: rows are ordered by file
    path and row in the file where the format tells it, else by place of the split in the file and place in the split,
    so it does not matter which task reads a split. For other frames there is no order to guess, and an error is raised.
    """
    if ORDER in df.columns:
        return df
    if order_by:
        return df.withColumn(ORDER, F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by))
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    for place in ([F.col("_metadata.row_index").alias("row_in_file")], [F.col("_metadata.file_block_start"), within.alias("row")]):
        try:
            return df.withColumn(ORDER, F.struct("_metadata.file_path", *place))
        except AnalysisException:
            continue
    raise ValueError("which copy of a post comes first? Name the columns that order the rows (order_by)")


def _splits(df: DataFrame) -> int:
    """Number of tasks that scan a frame without shuffles."""
    return df._jdf.queryExecution().toRdd().getNumPartitions()


def _same_in_every_scan(df: DataFrame) -> bool:
    """Whether the input order is one of rows in files, which no choice of splits changes."""
    kind = df.schema[ORDER].dataType
    return isinstance(kind, T.StructType) and kind.names == ["file_path", "row_in_file"]


def _without_late_copies(df: DataFrame) -> DataFrame | None:
    """The first row of each post_id, without a shuffle of whole rows; None if there are too many keys with copies.

    Only keys and places are grouped. The keys that occur more than once are stored with the place of their first row and, up
    to a checked number and size, sent to all tasks: a row goes if its key is among them at another place.
    """
    placed = df.select("post_id", ORDER).groupBy("post_id").agg(F.min(ORDER).alias("_first"), F.count(F.lit(1)).alias("_copies"))
    repeated = stored(placed.where("_copies > 1").select(F.col("post_id").alias("_key"), "_first"), "repeated-keys")
    size = repeated.agg(F.count(F.lit(1)).alias("keys"), F.sum(F.coalesce(F.length("_key"), F.lit(0)) + F.length("_first.file_path")).alias("chars")).first()
    if size["keys"] > LATE_KEYS or (size["chars"] or 0) > LATE_CHARS:
        return None
    if not size["keys"]:
        return df.drop(ORDER)
    joined = df.join(F.broadcast(repeated), F.col("post_id").eqNullSafe(F.col("_key")), "left")
    return joined.where(F.col("_first").isNull() | (F.col(ORDER) == F.col("_first"))).drop("_key", "_first", ORDER)


def dedupe_posts(df: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row of each post_id in input order.

    Scans of files that tell each row's place, in at least as many splits as there are cores, are grouped by narrow rows first and
    read again (see ``_without_late_copies``). Else the filter on the row number sits right on the window, so Spark cuts
    each map task's output to one row per post_id before the shuffle. Either way a post_id with very
    many copies reaches the reducer with at most one row per map task.
    """
    ordered = df if ORDER in df.columns else with_input_order(df, order_by)
    if _same_in_every_scan(ordered) and len(ordered.inputFiles()) and _splits(ordered) >= ordered.sparkSession.sparkContext.defaultParallelism:
        kept = _without_late_copies(ordered)
        if kept is not None:
            return kept
    first = Window.partitionBy("post_id").orderBy(F.asc_nulls_last(ORDER))
    return ordered.withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy", ORDER)


def fill_text(df: DataFrame) -> DataFrame:
    """Null texts become empty, a null user becomes ``unknown``."""
    fills = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in settings.TEXT_FIELDS if c in df.columns}
    fills["user_id"] = F.coalesce(F.col("user_id").cast("string"), F.lit("unknown"))
    return df.withColumns(fills)


def coerce_numeric(df: DataFrame) -> DataFrame:
    """Counters as doubles; what is not a number becomes 0."""
    present = [c for c in settings.NUMERIC_FIELDS if c in df.columns]
    return df.withColumns({c: to_count(F.col(c), column_type(df, c)) for c in present})


def _joined_text(df: DataFrame) -> Column:
    return F.concat_ws(" ", *(F.col(c) for c in settings.TEXT_FIELDS if c in df.columns))


def full_text(df: DataFrame) -> Column:
    """Title and text, trimmed; both must be filled."""
    return strip(_joined_text(df))


def some_text(df: DataFrame) -> Column:
    """True where full_text would not be empty."""
    return has_text(_joined_text(df))


def filter_empty_text(df: DataFrame) -> DataFrame:
    return df.where(some_text(df))


def validate_posts(df: DataFrame, order_by: Sequence[str] | None = None, drop_empty: bool = True) -> DataFrame:
    """Required filter, key trim, dedupe, fills, number coercion, empty-text filter, in this order."""
    df = with_input_order(df, order_by)
    df = dedupe_posts(trim_keys(filter_required(df)))
    df = coerce_numeric(fill_text(df))
    return filter_empty_text(df) if drop_empty else df


def with_tokens(df: DataFrame, **options) -> DataFrame:
    """Add full_text, tokens and clean_text (the tokens joined by blanks).

    The tokens come out of an explode of a one-element array. That keeps Spark from copying their
    expression into every later filter on them (also those it infers for an explode), which would
    tokenise each text once per copy.
    """
    df = df.withColumn("full_text", full_text(df))
    df = df.withColumn("tokens", F.explode(F.array(tokenize("full_text", **options))))
    return df.withColumn("clean_text", F.array_join("tokens", " "))


def with_clean_text(df: DataFrame, column: str = "text") -> DataFrame:
    """Add the cleaned but complete words of one column, stop words included."""
    return df.withColumn("cleaned", clean_text(column))


def filter_empty_clean(df: DataFrame) -> DataFrame:
    return df.where(F.size("tokens") > 0)


def is_time(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType))


READINGS = ("_by_format", "_by_second", "_by_milli")


def with_time_readings(
    df: DataFrame, formats: Sequence[str] = DATETIME_FORMATS, units: tuple[str, str] = ("second", "milli")
) -> DataFrame:
    """Add the three readings of a textual datetime: by format, and as numbers of two units, seconds and milliseconds."""
    df = df.withColumn("_text", unquote(F.col("datetime").cast("string")))
    df = with_parsed_datetime(df, "_text", "_parsed", formats).withColumn("_number", parse_number(F.col("_text")))
    readings = {
        "_by_format": in_clock_range(F.col("_parsed")),
        "_by_second": epoch_time(F.col("_number"), units[0]),
        "_by_milli": epoch_time(F.col("_number"), units[1]),
    }
    return df.withColumns(readings).drop("_text", "_parsed", "_number")


def reading_counts() -> list[Column]:
    """How many rows each reading of ``with_time_readings`` could parse."""
    return [F.count(c).alias(c) for c in READINGS]


def choose_reading(by_format: Column, by_second: Column, by_milli: Column) -> Column:
    """Which reading holds for the whole column, out of the three counts.

    The epoch readings count only if no value fits a format; milliseconds only if they parse more.
    """
    epoch = F.when(by_milli > by_second, "_by_milli").otherwise("_by_second")
    return F.when((by_format > 0) | (by_second + by_milli == 0), "_by_format").otherwise(epoch)


def parse_datetime_column(
    df: DataFrame, reading: str = "auto", formats: Sequence[str] = DATETIME_FORMATS, dayfirst: bool = False
) -> DataFrame:
    """Replace ``datetime`` by its parsed value, null where it does not parse.

    ``reading`` is ``format``, a unit of EPOCH_UNITS or ``auto``. ``auto`` decides by the whole
    column between formats, seconds and milliseconds: an aggregate over it, used as a scalar subquery. That reads
    the input twice, so name the reading where it is known; a column that already holds times is only cast.
    """
    if is_time(column_type(df, "datetime")):
        return df.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))
    if reading in EPOCH_UNITS:
        return df.withColumn("datetime", epoch_time(parse_number(unquote(F.col("datetime").cast("string"))), reading))
    if reading not in ("auto", "format"):
        raise ValueError(f"unknown reading of datetime: {reading}")
    read = with_time_readings(df, day_first(formats) if dayfirst else formats)
    if reading == "auto":
        counts = read.agg(*reading_counts())
        chosen = counts.select(choose_reading(*(F.col(c) for c in READINGS))).scalar()
        position = F.array_position(F.array(*map(F.lit, READINGS)), chosen) - 1
        value = F.get(F.array(*READINGS), position.cast("int"))
    else:
        value = F.col(f"_by_{reading}")
    return read.withColumn("datetime", value).drop(*READINGS)


def filter_datetime(df: DataFrame) -> DataFrame:
    return df.where(F.col("datetime").isNotNull())


def with_periods(df: DataFrame) -> DataFrame:
    return df.withColumns({"date": F.to_date("datetime"), "month": F.date_format("datetime", "yyyy-MM")})


def with_engagement(df: DataFrame) -> DataFrame:
    return df.withColumn("engagement_score", sum((F.col(c) for c in settings.NUMERIC_FIELDS[1:]), F.col("likes_count")))


def with_text_length(df: DataFrame) -> DataFrame:
    return df.withColumn("text_length", F.size("tokens"))


def preprocess_posts(
    df: DataFrame,
    reading: str = "auto",
    formats: Sequence[str] = DATETIME_FORMATS,
    drop_empty: bool = True,
    **token_options,
) -> DataFrame:
    """Fills, tokens, empty filter, dates, periods, counters, engagement and text length."""
    df = with_tokens(fill_text(df), **token_options)
    df = filter_empty_clean(df) if drop_empty else df
    df = filter_datetime(parse_datetime_column(df, reading, formats))
    return with_text_length(with_engagement(coerce_numeric(with_periods(df))))
