"""Word hashes of Arrow text batches, computed over whole byte buffers."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SLAB_BYTES = 2 << 20
# Bytes whose running sums are made at once.
HASH_BYTES = 1 << 18

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

PUNCTUATION = SPACES.copy()
PUNCTUATION[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

BASE = 0x9E3779B97F4A7C15
LENGTH = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(length: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i below ``length``."""
    found = _powers.get(base)
    if found is None or len(found[0]) < length:
        factors = np.empty((2, max(length, HASH_BYTES + 1)), np.uint64)
        factors[:, 0], factors[0, 1:], factors[1, 1:] = 1, base, pow(base, -1, 1 << 64)
        found = _powers[base] = tuple(np.cumprod(factors, axis=1, dtype=np.uint64))
    return found


def hash_spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """A polynomial hash of each span of bytes; starts and ends ascend.

    The sums run over HASH_BYTES at a time, so that their memory does not grow with the texts; a longer span has its own.
    """
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        begin = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, begin + HASH_BYTES, "right")))
        out[at:stop] = _hash_some(values[begin : int(ends[stop - 1])], starts[at:stop] - begin, ends[at:stop] - begin, base)
        at = stop
    return out


def _hash_some(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """The hashes of spans, taken from one running sum over all bytes."""
    power, inverse = _power_tables(len(values) + 1, base)
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    terms = sums[1:]
    terms[:] = values
    terms += np.uint64(1)
    terms *= power[: len(values)]
    np.cumsum(terms, out=terms)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * LENGTH)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the row boundaries in them; null is an empty text."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    _, ends, data = column.buffers()
    bounds = np.frombuffer(ends, np.int64 if wide else np.int32, len(column) + 1, column.offset * (8 if wide else 4))
    bounds = bounds.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), bounds
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slabs(batches, text: str = "text", limit: int = SLAB_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def word_spans(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; a word is a run of bytes of one row that are no separators."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    return starts, np.flatnonzero(inside & (~after | edge[1:])) + 1


def hash_words(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, A-Z counting as a-z, and where each row's words begin."""
    starts, ends = word_spans(data, bounds, separators)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    return hash_spans(LOWER[data], starts, ends), np.searchsorted(starts, bounds)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words, by its first word; rows are not told apart."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, np.uint64(width))
    for k in range(width):
        total = (total + words[k : k + count]) * np.uint64(BASE)
    return mix(total)


# Schemes that file libraries know, by those that Spark reads.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def file_uri(spark: SparkSession, folder: str) -> str:
    """The folder as a URI under which tasks can write files by a file library what Spark reads there.

    A folder without a scheme lies on Hadoop's default file system, as it does for Spark. Schemes that such libraries do not
    know are refused here, before any task starts.
    """
    if not re.match("[A-Za-z][A-Za-z0-9+.-]*:", folder):
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        default = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(conf).toString().rstrip("/")
        folder = ("file://" if default in ("file:", "") else default) + (folder if folder.startswith("/") else os.path.abspath(folder))
    scheme, rest = folder.split(":", 1)
    if scheme not in SCHEMES:
        raise ValueError(f"files cannot be written to {scheme}: name a folder on one of {', '.join(sorted(SCHEMES))}")
    return f"{SCHEMES[scheme]}://{re.sub('^//', '', rest)}"
