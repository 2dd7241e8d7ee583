"""Shards by a keyed permutation of row numbers.

Row r of n goes to place p(r), where p is a Feistel network over the smallest even number of bits that
holds n, walked until it falls below n. Place q is slot q div shards of shard q mod shards. So any row's shard
and slot, and the row at any slot, are computed from (seed, n, shards) alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postweave.llm.batches import mix
from postweave.plans.storage import stored

ROUNDS = 6


class Permutation:
    """A bijection of 0 .. n-1, both ways, on arrays."""

    def __init__(self, n: int, seed: int = 0, rounds: int = ROUNDS):
        self.n = n
        self.half = max(1, -(-max(n - 1, 1).bit_length() // 2))
        keys = np.arange(rounds, dtype=np.uint64) + np.uint64(seed % (1 << 32)) * np.uint64(1 << 32)
        self.keys = mix(keys)

    def _network(self, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = values >> half, values & mask
        for key in keys:
            left, right = right, left ^ (mix(right ^ key) & mask)
        return (right << half) | left

    def _walk(self, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = self._network(np.asarray(values).astype(np.uint64), keys)
        outside = np.flatnonzero(out >= self.n)
        while len(outside):
            out[outside] = self._network(out[outside], keys)
            outside = outside[out[outside] >= self.n]
        return out.astype(np.int64)

    def place(self, rows: np.ndarray) -> np.ndarray:
        return self._walk(rows, self.keys)

    def row(self, places: np.ndarray) -> np.ndarray:
        """The rows at the given places: the inverse of ``place``."""
        return self._walk(places, self.keys[::-1])


def row_numbers(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with row_number, 0 .. n-1 in the given order, and n.

    One shuffle by ranges. Rows are numbered within their partition; the number of rows before a partition is
    summed on the driver from one count each. The ranges are written once, as both steps must see the same ones.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    local = F.monotonically_increasing_id()
    ranged = ranged.withColumn("part", F.shiftright(local, 33).cast("int"))
    ranged = stored(ranged.withColumn("within", local.bitwiseAND(F.lit((1 << 33) - 1))), "ranges")
    counts = sorted(ranged.groupBy("part").count().collect())
    before = np.cumsum([0, *(c["count"] for c in counts)]).tolist()
    starts = rows.sparkSession.createDataFrame([(c.part, b) for c, b in zip(counts, before)], "part int, before long")
    numbered = ranged.join(F.broadcast(starts), "part").withColumn("row_number", F.col("before") + F.col("within"))
    return numbered.drop("part", "within", "before"), before[-1]


def shard_rows(docs: DataFrame, shards: int = 24, seed: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, size (UTF-8 bytes and 8), text_crc32, shard, slot.

    Law `rows`: shards hold equal numbers of rows, at most one apart, whatever the ids and texts.
    Global row numbers follow doc_id (null first), then checksum and size, so equal rows are
    interchangeable and the result does not depend on files or partitions. A null text has 8 bytes.
    Texts stay with their input splits: only ids, sizes and checksums are shuffled.
    """
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.encode(text, "UTF-8"), F.lit(b""))).alias("text_crc32"),
    )
    numbered, n = row_numbers(narrow, ["doc_id", "text_crc32", "size"])

    @F.pandas_udf("long")
    def place(rows: pd.Series) -> pd.Series:
        return pd.Series(Permutation(n, seed).place(rows.to_numpy()))

    placed = numbered.withColumn("place", place("row_number"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("place") % shards).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )


def row_at(shard: int, slot: int, n: int, shards: int = 24, seed: int = 0) -> int:
    """The global row number at a slot, without looking at any row."""
    return int(Permutation(n, seed).row(np.array([slot * shards + shard]))[0])
