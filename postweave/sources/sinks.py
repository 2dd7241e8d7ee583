"""Writers: result tables as CSV, reports as text."""

from __future__ import annotations

from collections.abc import Mapping
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame

from postweave.plans.reports import quality_lines, summary_lines


def save_tables(tables: Mapping[str, DataFrame], folder: str, parallelism: int = 4) -> None:
    """Each table as CSV with a header under its name, several at a time.

    A table is written by as many tasks as its plan has: short reports come out of one or a few, open-ended
    tables out of many.
    """

    def save(name: str) -> None:
        tables[name].write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")

    with ThreadPool(parallelism) as pool:
        pool.map(save, list(tables), chunksize=1)


def save_summary(summary: DataFrame, folder: str) -> None:
    summary_lines(summary).coalesce(1).write.mode("overwrite").text(f"{folder}/summary_report")


def save_quality_report(report: DataFrame, folder: str) -> None:
    """As CSV and as text; an empty report is skipped. The report has one row per metric."""
    if report.isEmpty():
        return
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/preprocessing_quality_report_csv")
    lines = quality_lines(report.coalesce(1))
    lines.coalesce(1).write.mode("overwrite").text(f"{folder}/preprocessing_quality_report_txt")
