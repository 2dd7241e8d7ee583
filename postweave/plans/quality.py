"""How many rows each cleaning stage removed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postweave.functions.dates import DATETIME_FORMATS
from postweave.functions.values import column_type
from postweave.operators.cleaning import (
    ORDER,
    READINGS,
    choose_reading,
    fill_text,
    is_time,
    reading_counts,
    required_present,
    some_text,
    trim_keys,
    with_input_order,
    with_time_readings,
    with_tokens,
)

# The metrics of the report, in order.
METRICS = (
    "loaded_rows",
    "missing_required_removed",
    "duplicates_removed",
    "empty_text_removed_at_validation",
    "rows_after_validation",
    "rows_before_preprocessing",
    "empty_text_removed_at_preprocessing",
    "invalid_datetime_removed",
    "final_clean_rows",
)


def stage_flags(df: DataFrame, formats=DATETIME_FORMATS, drop_empty: bool = True, units=("second", "milli")) -> DataFrame:
    """Add the tests of all later stages as columns: raw text, tokens, readable dates.

    ``units`` are those of the two readings of numbers as dates. Without ``drop_empty`` posts without words pass the second test, too.
    """
    df = fill_text(df)
    df = df.withColumn("_has_text", some_text(df)) if "_has_text" not in df.columns else df
    df = df if "tokens" in df.columns else with_tokens(df)
    if is_time(column_type(df, "datetime")):
        present = F.col("datetime").cast("timestamp_ntz")
        nothing = F.lit(None).cast("timestamp_ntz")
        df = df.withColumns({"_by_format": present, "_by_second": nothing, "_by_milli": nothing})
    else:
        df = with_time_readings(df, formats, units)
    return df.withColumn("_has_words", F.col("_has_text") & (F.size("tokens") > (0 if drop_empty else -1)))


def quality_counts(raw: DataFrame, order_by=None, formats=DATETIME_FORMATS) -> DataFrame:
    """One row with all metrics, straight from the mapped input.

    The stage tests run before the shuffle, so what is shuffled per post_id is a count and a few
    flags, never a text. Copies of one post_id, and all rows without required values (under the null
    key), collapse on the map side.
    """
    flagged = stage_flags(trim_keys(with_input_order(raw, order_by)), formats)
    tests = [F.col("_has_text"), F.col("_has_words"), *(F.col(c).isNotNull() for c in READINGS)]
    # One integer of flags and one of order keep the aggregation a hash aggregation.
    flags = sum(t.cast("int") * (1 << i) for i, t in enumerate(tests))
    key = F.when(F.col("_required"), F.col("post_id"))
    per_post = (
        flagged.withColumn("_required", required_present())
        .select(key.alias("post_id"), flags.alias("flags"), F.col(ORDER))
        .groupBy("post_id")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.min_by("flags", ORDER), F.max("flags")).alias("first"),
        )
    )
    kept = F.col("post_id").isNotNull()
    names = ("_has_text", "_has_words", *READINGS)
    stage = {c: F.col("first").bitwiseAND(1 << i) > 0 for i, c in enumerate(names)}
    counted = per_post.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("loaded"),
        F.coalesce(F.sum(F.when(kept, F.col("rows"))), F.lit(0)).alias("valid"),
        F.count_if(kept).alias("unique"),
        F.count_if(kept & stage["_has_text"]).alias("with_text"),
        F.count_if(kept & stage["_has_words"]).alias("with_words"),
        *(F.count_if(kept & stage["_has_words"] & stage[c]).alias(c) for c in READINGS),
    )
    return _metrics(counted)


def _metrics(counted: DataFrame, reading: str = "auto") -> DataFrame:
    reading = choose_reading(*(F.col(c) for c in READINGS)) if reading == "auto" else F.lit(f"_by_{reading}")
    dated = F.when(reading == "_by_format", F.col("_by_format")).when(reading == "_by_second", F.col("_by_second"))
    dated = dated.otherwise(F.col("_by_milli"))
    values = (
        F.col("loaded"),
        F.col("loaded") - F.col("valid"),
        F.col("valid") - F.col("unique"),
        F.col("unique") - F.col("with_text"),
        F.col("with_text"),
        F.col("with_text"),
        F.col("with_text") - F.col("with_words"),
        F.col("with_words") - dated,
        dated,
    )
    return counted.select(*(v.cast("long").alias(m) for m, v in zip(METRICS, values, strict=True)), reading.alias("reading"))


def stage_counts(raw: DataFrame, staged: DataFrame, reading: str = "auto") -> dict:
    """The same metrics for a stored stage table (see ``analysis``): two narrow aggregates."""
    first = raw.agg(F.count(F.lit(1)).alias("loaded"), F.count_if(required_present()).alias("valid")).first()
    kept = F.col("_has_words")
    rest = staged.select(
        "_has_text", "_has_words", *(F.when(kept, F.col(c)).alias(c) for c in READINGS)
    ).agg(
        F.count(F.lit(1)).alias("unique"),
        F.count_if("_has_text").alias("with_text"),
        F.count_if("_has_words").alias("with_words"),
        *reading_counts(),
    )
    counted = rest.select(F.lit(first.loaded).alias("loaded"), F.lit(first.valid).alias("valid"), "*")
    return _metrics(counted, reading).first().asDict()


def quality_report(counts: DataFrame) -> DataFrame:
    """(metric_name, metric_value) rows in the order of the stages."""
    rows = [F.struct(F.lit(m).alias("metric_name"), F.col(m).alias("metric_value")) for m in METRICS]
    return counts.select(F.inline(F.array(*rows)))


def report_frame(spark, counts: Mapping[str, int]) -> DataFrame:
    rows = [(m, int(counts[m])) for m in METRICS if m in counts]
    return spark.createDataFrame(rows, "metric_name string, metric_value bigint")
