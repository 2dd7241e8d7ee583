"""Delimited text whose quoted fields hold line breaks, read in splits.

A line break ends a record where the number of quotes before it is even. So the quotes of each split are counted first;
sums over the splits of a file tell whether a split begins within quotes. Tasks then join the lines of a record, and what a
split border cuts is put together afterwards. Spark's own CSV parser gets whole records.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postweave.operators.cleaning import ORDER

QUOTE = '"'
# What a row of the second pass is: a record, or the end, a middle part or the begin of one.
WHOLE, END, MIDDLE, BEGIN = range(4)


def _split_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines between line feeds, as bytes, with their file and split."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def open_splits(lines: DataFrame) -> dict[tuple[str, int], bool]:
    """For each split that has lines whether it begins within quotes.

    One row for each split comes to the driver, as many as Spark itself lists there to plan the scan.
    """
    text = F.decode("line", "iso-8859-1")
    quotes = F.length(text) - F.length(F.replace(text, F.lit(QUOTE), F.lit("")))
    counted = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes")).collect()
    out, inside = {}, {}
    for row in sorted(counted, key=lambda r: (r.file, r.start)):
        out[row.file, row.start] = inside.get(row.file, False)
        inside[row.file] = out[row.file, row.start] ^ (row.quotes % 2 == 1)
    return out


def _joined(lines: pa.Array, starts: list[int]) -> pa.Array:
    """Lines from each start up to the next one, with line feeds between them."""
    offsets = pa.array([*starts, len(lines)], pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, lines), b"\n")


def _records(lines: DataFrame, splits: dict[tuple[str, int], bool]) -> DataFrame:
    """(record, kind, file, start, row): whole records and parts of those that go over split borders."""
    held = lines.sparkSession.sparkContext.broadcast(splits)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, inside, began_inside, row = None, False, False, 0
        waiting: list[pa.Array] = []

        def rows(records: pa.Array, kinds: list[int], first: int) -> pa.RecordBatch:
            n = len(records)
            columns = [records, pa.array(kinds, pa.int32()), pa.array([split[0]] * n), pa.array([split[1]] * n, pa.int64()), pa.array(range(first, first + n), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["record", "kind", "file", "start", "row"])

        def rest() -> Iterator[pa.RecordBatch]:
            """What is left at the end of a split goes on in the next one."""
            if waiting:
                kind = MIDDLE if began_inside else BEGIN
                yield rows(_joined(pa.concat_arrays(waiting), [0]), [kind], row)

        for batch in batches:
            files, starts = batch.column("file"), batch.column("start")
            if not batch.num_rows:
                continue
            changes = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(starts[1:], starts[:-1]))
            borders = [0, *(i + 1 for i, c in enumerate(changes.to_pylist()) if c), batch.num_rows] if pc.any(changes).as_py() else [0, batch.num_rows]
            for a, b in zip(borders[:-1], borders[1:]):
                here = (files[a].as_py(), starts[a].as_py())
                if here != split:
                    yield from rest()
                    if here not in held.value:
                        raise RuntimeError(f"{here} was no split when quotes were counted: the files or the session's splits have changed")
                    split, inside, row, waiting = here, held.value[here], 0, []
                    began_inside = inside
                lines_here = batch.column("line").slice(a, b - a)
                odd = pc.bit_wise_and(pc.count_substring(lines_here, QUOTE.encode()), 1).to_numpy(zero_copy_only=False)
                after = (odd.cumsum() + inside) % 2 == 1
                closed = (~after).nonzero()[0]
                inside = bool(after[-1])
                if not len(closed):
                    waiting.append(lines_here)
                    continue
                last = int(closed[-1]) + 1
                done = lines_here.slice(0, last)
                begins = [0, *(int(i) + 1 for i in closed[:-1])]
                if waiting:
                    size = sum(map(len, waiting))
                    done = pa.concat_arrays([*waiting, done])
                    begins = [0, *(i + size for i in begins[1:])]
                kinds = [END if began_inside else WHOLE, *[WHOLE] * (len(begins) - 1)]
                yield rows(_joined(done, begins), kinds, row)
                row, began_inside = row + len(begins), False
                waiting = [lines_here.slice(last)] if last < len(lines_here) else []
        if split is not None:
            yield from rest()

    return lines.mapInArrow(assemble, "record binary, kind int, file string, start long, row long")


def _put_together(parts: DataFrame) -> DataFrame:
    """Records that go over split borders, at the place where they begin. A split has two parts at most."""
    order = Window.partitionBy("file").orderBy("start", "row")
    numbered = parts.withColumn("number", F.sum((F.col("kind") == BEGIN).cast("long")).over(order))
    pieces = F.sort_array(F.collect_list(F.struct("start", "row", F.decode("record", "iso-8859-1").alias("piece"))))
    whole = numbered.groupBy("file", "number").agg(pieces.alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: p["piece"]), "\n")
    first = F.col("pieces")[0]
    return whole.select(F.encode(text, "iso-8859-1").alias("record"), "file", first["start"].alias("start"), first["row"].alias("row"))


def scan_multi_line(spark: SparkSession, path: str, separator: str, encoding: str) -> DataFrame:
    """Delimited text with a header and quoted line breaks, every column as text, and the place of each record as ORDER.

    ``encoding`` is a Java name. Records begin anew after a line feed (with or without a carriage return) outside quotes. An
    open quote goes on to the end of its file. The files are read twice, both times in splits; the first record of each is its header.
    """
    options = {"sep": separator, "quote": QUOTE, "escape": QUOTE}
    schema = spark.read.csv(path, header=True, encoding=encoding, multiLine=True, **options).schema
    lines = _split_lines(spark, path)
    found = _records(lines, open_splits(lines))
    whole = found.where(F.col("kind") == WHOLE).drop("kind").union(_put_together(found.where(F.col("kind") != WHOLE)))
    text = F.regexp_replace(F.decode("record", encoding), "\r$", "")
    header = (F.col("start") == 0) & (F.col("row") == 0)
    rows = whole.where(~header).withColumn("record", text).where(F.trim("record") != "")
    parsed = F.from_csv("record", schema.toDDL(), options)
    return rows.select(F.inline(F.array(parsed)), F.struct(F.col("file"), F.col("start"), F.col("row")).alias(ORDER))
