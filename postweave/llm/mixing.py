"""Mixing sources to target weights by exact block quotas.

Documents fall into blocks of their source by hash. Whole blocks, in a permuted order, fill a source's
target, first those of long documents up to their share; the block where each ends is cut between documents. A tree of multivariate-hypergeometric draws
splits the sources' block quotas among the output shards: at each node the left half of the shards gets
its exact share of blocks, drawn without replacement. Shards then take disjoint runs of the permuted blocks and shuffle
their documents by hash. All of it depends on (rows, weights, seed) only.

The driver holds numbers of sources and blocks (at most MAX_SOURCES * 2 * MAX_BLOCKS), never rows. Every
row's copies and shards follow from that plan, so texts are not shuffled to be chosen.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postweave.llm.line_rules import WORD
from postweave.plans.storage import stored

WEIGHTS = (3.0, 1.0, 2.0)
# All targets together and each target, as multiples of the words there are.
SHARE, MOST_REPEATS = 1.5, 2.0
MAX_SOURCES, MAX_BLOCKS, BLOCK_DOCS = 1000, 1024, 64
# Documents of this many times the source's mean size have blocks of their own, which are filled first.
LONG = 4

KEYED = "doc_id", "source", "size", "key"


def targets(sizes: Sequence[int], weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS) -> list[float]:
    """Words to take from each source: ``share`` of all words by weight, none above ``most`` times its size.

    ``weights`` repeat along the sources. What a source can't take is dealt to the others by weight, again until
    none is above.
    """
    weight = [weights[k % len(weights)] for k in range(len(sizes))]
    out = [0.0] * len(sizes)
    left, open_ = share * sum(sizes), list(range(len(sizes)))
    while open_:
        unit = left / sum(weight[k] for k in open_)
        full = [k for k in open_ if unit * weight[k] > most * sizes[k]]
        for k in full or open_:
            out[k] = most * sizes[k] if full else unit * weight[k]
        if not full:
            break
        left -= sum(out[k] for k in full)
        open_ = [k for k in open_ if k not in set(full)]
    return out


def split_quotas(quotas: np.ndarray, shards: int, seed: int = 0) -> np.ndarray:
    """Blocks of each source for each shard: rows are shards, columns sources; exact in both sums."""
    out = np.zeros((shards, len(quotas)), np.int64)

    def split(first: int, last: int, have: np.ndarray) -> None:
        if last - first == 1:
            out[first] = have
            return
        middle = (first + last) // 2
        rng = np.random.default_rng([seed, first, last])
        take = int(have.sum()) * (middle - first) // (last - first)
        left = rng.multivariate_hypergeometric(have, take, method="marginals") if take else np.zeros_like(have)
        split(first, middle, left)
        split(middle, last, have - left)

    if len(quotas):
        split(0, shards, np.asarray(quotas, np.int64))
    return out


def keyed(docs: DataFrame, seed: int, doc_id: str, text: str, source: str) -> DataFrame:
    """The narrow rows the plan is made from: doc_id, source, words, and a hash of the row."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        _size(F.col(text)).alias("size"),
        _key(F.col(doc_id), F.col(text), seed).alias("key"),
    )


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(doc_id: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), doc_id, text)


def _block(key: Column, blocks: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(f"block {seed}")), blocks).cast("int")


PLAN = "source string, long boolean, block int, copies int, cut long, extra long, shards array<int>"


def mixing_plan(
    rows: DataFrame, weights: Sequence[float] = WEIGHTS, shards: int = 24, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Two small tables for narrow ``rows`` (see ``keyed``).

    sources: source, source_size, docs, blocks, target. blocks: for each block of a source the copies
    that all its documents get, ``cut`` (documents with keys up to it get one more), ``extra`` (so does that key), and
    the shards of the copies in order.
    """
    spark = rows.sparkSession
    sums = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    found = sums.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"a mix has at most {MAX_SOURCES} sources; group them first")
    found = sorted(found, key=lambda r: (r.source is None, r.source or ""))
    goal = targets([r.words for r in found], weights)
    sources = spark.createDataFrame(
        [(r.source, r.words, r.docs, min(MAX_BLOCKS, max(1, r.docs // BLOCK_DOCS)), t) for r, t in zip(found, goal)],
        "source string, source_size long, docs long, blocks int, target double",
    )
    placed = _placed(rows, sources, seed)
    per_block = placed.groupBy("source", "long", "block").agg(F.sum("size").alias("words")).collect()
    have: dict = {}
    for r in per_block:
        have.setdefault((r.source, r.long), {})[r.block] = r.words

    chosen, rests, cuts = {}, {}, {}
    for long in (True, False):
        ends = []
        for k, (r, target) in enumerate(zip(found, goal)):
            passes = min(int(target // r.words), int(MOST_REPEATS)) if r.words else 0
            rest = rests.setdefault(k, target - passes * r.words)
            fraction = (target - passes * r.words) / r.words if r.words else 0.0
            blocks = have.get((r.source, long), {})
            order = _permuted(blocks, seed, r.source, long)
            words = np.array([blocks[b] for b in order], np.int64)
            if long:
                rest = fraction * words.sum()
            full = int((np.cumsum(words) <= max(rest, 0)).sum()) if fraction else 0
            rests[k] -= int(words[:full].sum())
            rest -= int(words[:full].sum())
            if fraction and full < len(order) and rest > 0:
                ends.append((r.source, order[full], float(rest)))
            chosen[r.source, long] = (order, passes, full)
        found_cuts = _cuts(placed, long, ends)
        cuts |= {(s, long, b): (cut, extra) for (s, b), (cut, extra, _) in found_cuts.items()}
        taken = {s: words for (s, _), (_, _, words) in found_cuts.items()}
        for k, r in enumerate(found):
            rests[k] -= taken.get(r.source, 0)

    quotas, instances = [], []
    for r in found:
        mine = []
        for long in (True, False):
            order, passes, full = chosen[r.source, long]
            mine += [(long, b, k) for k in range(passes) for b in order]
            mine += [(long, b, passes) for k, b in enumerate(order) if k < full or (r.source, long, b) in cuts]
        instances.append(sorted(mine, key=lambda x: (x[2], _mixed(seed, r.source, x[0], x[1], x[2]))))
        quotas.append(len(mine))
    counts = split_quotas(np.array(quotas, np.int64), shards, seed)
    table = []
    for k, r in enumerate(found):
        ends_at = np.cumsum(counts[:, k])
        shards_of: dict = {}
        for place, (long, b, copy) in enumerate(instances[k]):
            shards_of.setdefault((long, b), []).append(int(np.searchsorted(ends_at, place, "right")))
        for (long, b), own in shards_of.items():
            cut, extra = cuts.get((r.source, long, b), (None, None))
            partial = cut is not None or extra is not None
            table.append((r.source, long, b, len(own) - partial, cut, extra, own))
    return sources, spark.createDataFrame(table, PLAN)


def _mixed(seed: int, *what) -> int:
    """A hash for orders on the driver."""
    import zlib

    return zlib.crc32(repr((seed, *what)).encode())


def _permuted(blocks, seed: int, source, long: bool) -> list[int]:
    return sorted(blocks, key=lambda b: (_mixed(seed, source, long, b), b))


def _placed(rows: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """``rows`` with their source's numbers and their block; the sources are bounded by MAX_SOURCES."""
    s = F.broadcast(sources.withColumnRenamed("source", "its_source"))
    joined = rows.join(s, rows.source.eqNullSafe(s.its_source)).drop("its_source")
    long = F.col("size") * F.col("docs") > LONG * F.col("source_size")
    return joined.withColumn("long", long).withColumn("block", _block(F.col("key"), F.col("blocks"), seed))


def _cuts(placed: DataFrame, long: bool, ends: list[tuple]) -> dict:
    """Where each source's target ends in its last block of the kind: (greatest key taken, one more key, words of all these).

    The block's documents are taken by key while they fit; then the one whose size is nearest to what is missing, if
    that brings the sum nearer. The block is one of up to MAX_BLOCKS of its source.
    """
    if not ends:
        return {}
    spark = placed.sparkSession
    wanted = spark.createDataFrame(ends, "end_source string, end_block int, rest double")
    here = placed.source.eqNullSafe(F.col("end_source")) & (placed.block == F.col("end_block")) & (placed.long == F.lit(long))
    last = placed.join(F.broadcast(wanted), here).groupBy("end_source", "end_block", "rest", "key").agg(F.sum("size").alias("size"))
    window = Window.partitionBy("end_source").orderBy("key")
    last = last.withColumn("sum", F.sum("size").over(window))
    last = last.withColumn("taken", F.max(F.when(F.col("sum") <= F.col("rest"), F.col("sum"))).over(Window.partitionBy("end_source")))
    missing = F.col("rest") - F.coalesce("taken", F.lit(0))
    off = F.when((F.col("sum") > F.col("rest")) & (F.col("size") < 2 * missing), F.abs(F.col("size") - missing))
    found = last.groupBy("end_source", "end_block").agg(
        F.max(F.when(F.col("sum") <= F.col("rest"), F.col("key"))).alias("cut"),
        F.min(F.when(off.isNotNull(), F.struct(off.alias("off"), F.col("key").alias("key"), F.col("size").alias("size")))).alias("extra"),
        F.coalesce(F.max("taken"), F.lit(0)).alias("taken"),
    )
    out = {}
    for r in found.collect():
        if r.cut is not None or r.extra:
            extra = (r.extra.key, r.taken + r.extra.size) if r.extra else (None, r.taken)
            out[r.end_source, r.end_block] = (r.cut, *extra)
    return out


def with_copies(rows: DataFrame, sources: DataFrame, plan: DataFrame, seed: int = 0) -> DataFrame:
    """``rows`` with source_size, target, copies and shards (one for each copy). Both tables are small, see above."""
    p = F.broadcast(plan.select(*(F.col(c).alias(f"plan_{c}") for c in plan.columns)))
    r = _placed(rows, sources, seed)
    same = r.source.eqNullSafe(p.plan_source) & (r.long == p.plan_long) & (r.block == p.plan_block)
    more = F.coalesce(r.key <= p.plan_cut, F.lit(False)) | F.coalesce(r.key == p.plan_extra, F.lit(False))
    copies = F.coalesce(p.plan_copies + more.cast("int"), F.lit(0))
    joined = r.join(p, same, "left").withColumn("copies", copies)
    shards = F.coalesce(F.slice("plan_shards", F.lit(1), F.col("copies")), F.array().cast("array<int>"))
    return joined.withColumn("shards", shards).drop("docs", "blocks", "long", "block", *p.columns)


def mix_report(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    shards: int = 24,
    seed: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken (words times copies), copies, shards.

    Null texts have size 0; null is a source, the last one. Rows that are equal in id and text share
    their fate. No rows: no rows.
    """
    rows = stored(keyed(docs, seed, doc_id, text, source), "mix-rows")
    sources, plan = mixing_plan(rows, weights, shards, seed)
    out = with_copies(rows, sources, plan, seed)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "shards")


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    shards: int = 24,
    seed: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row for each copy taken, with the columns of ``docs``, dealt to the shards and shuffled within each.

    Partitions are runs of the shuffled order, so a large shard fills several and none is limited by their number.
    """
    rows = stored(keyed(docs, seed, doc_id, text, source), "mix-rows")
    sources, plan = mixing_plan(rows, weights, shards, seed)
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")
    full = docs.select(
        whole, F.col(source).alias("source"), _size(F.col(text)).alias("size"), _key(F.col(doc_id), F.col(text), seed).alias("key")
    )
    taken = with_copies(full, sources, plan, seed).where(F.size("shards") > 0)
    placed = taken.select("whole", "key", F.posexplode("shards").alias("copy", "shard"))
    placed = placed.withColumn("order", F.xxhash64("key", "copy", "shard", F.lit(f"shuffle {seed}")))
    return placed.repartitionByRange("shard", "order").sortWithinPartitions("shard", "order").select("whole.*")
