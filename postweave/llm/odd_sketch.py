"""Near-duplicate components of documents by banded MinHash, odd sketches and exact sets.

1. One pass over the texts makes, for each document, its number of shingles, a 128-bit digest of its shingle set,
   MinHash band keys and an odd sketch: MinHash samples are hashed into a bitmap whose bits are parities, so the
   XOR of two bitmaps has about as many ones as samples differ. Documents with equal digests are one node.
2. Nodes that share a band key are candidates. Every node is first compared with the least node of its
   groups only; the odd sketch estimates the similarity, and what may reach the threshold is confirmed on the full sets.
3. Groups that are still in more than one component have all their pairs between different components compared by sketch, in
   blocks of members, and what may link by full sets, within the task: sets are sent to the groups of
   those members that may have a link, and only confirmed links between what is not yet connected come back. So a group
   of m members makes at most m rows, and no pair is left out.
4. Components follow from the confirmed links. Links between documents of one component need not be looked for, as they
   change nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postweave.llm.batches import hash_words, mix, slabs, text_bytes, window_hashes
from postweave.llm.components import components
from postweave.llm.line_rules import WORD
from postweave.plans.storage import stored

SAMPLES, BITS = 120, 512
# Chance that a pair at the threshold shares no band, at most.
MISS = 1e-6
# A pair is confirmed on full sets if its estimate is no lower than the threshold less this many deviations of the samples.
DEVIATIONS = 6.0
# Members of a band group, and shingles of theirs, that one task compares with each other or with as many others.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20

SKETCHED = "n_shingles long, node binary, bands array<long>, sketch array<long>"


def band_rows(threshold: float, samples: int = SAMPLES, miss: float = MISS) -> int:
    """The most samples for each band at which a pair at the threshold is missed with a chance of at most ``miss``."""
    fit = [r for r in range(1, samples + 1) if (1 - threshold**r) ** (samples // r) <= miss]
    return max(fit, default=1)


def most_ones(threshold: float, samples: int = SAMPLES, bits: int = BITS, deviations: float = DEVIATIONS) -> int:
    """Ones in the XOR of two sketches up to which a pair may reach the threshold.

    Of 2 * samples * (1 - J) entries in the symmetric difference, n bits show n / 2 * (1 - exp(-4 samples (1 - J) / n)) ones.
    """
    lowest = max(0.0, threshold - deviations * math.sqrt(threshold * (1 - threshold) / samples))
    return math.ceil(bits / 2 * (1 - math.exp(-4 * samples * (1 - lowest) / bits)))


def shingle_sets(words: np.ndarray, bounds: np.ndarray, width: int) -> list[np.ndarray]:
    """For each row its distinct shingle hashes, ascending. Fewer words than ``width`` are one shingle; none, none."""
    windows = window_hashes(words, width)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= width:
            own = np.sort(windows[a : b - width + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif b > a:
            own = window_hashes(words[a:b], b - a)
        else:
            own = words[:0]
        out.append(own)
    return out


_rng = np.random.default_rng(20_240_601)
_FACTORS = (_rng.integers(1, 1 << 32, 4096, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_OFFSETS = _rng.integers(0, 1 << 32, 4096, dtype=np.uint64).astype(np.uint32)


def minhash(own: np.ndarray, samples: int) -> np.ndarray:
    """The least value of each of ``samples`` hash functions over a set of hashes."""
    values = (own >> np.uint64(32)).astype(np.uint32)
    least = np.full(samples, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(values), 2048):
        table = values[k : k + 2048, None] * _FACTORS[:samples] + _OFFSETS[:samples]
        np.minimum(least, table.min(axis=0), out=least)
    return least


def odd_sketches(signatures: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Rows of bits // 64 words: the parity of how many samples fall on each bit."""
    rows, samples = signatures.shape
    each = signatures.astype(np.uint64) + (np.arange(samples, dtype=np.uint64) << np.uint64(32))
    at = (mix(each) % np.uint64(bits)).astype(np.int64) + np.arange(rows)[:, None] * bits
    parity = (np.bincount(at.ravel(), minlength=rows * bits) & 1).astype(np.uint8).reshape(rows, bits)
    return np.packbits(parity, axis=1, bitorder="little").view("<u8")


def _digest(own: np.ndarray) -> bytes:
    """128 bits of a set: two sums of differently mixed members."""
    if not len(own):
        return None
    other = mix(own ^ np.uint64(0x5851F42D4C957F2D))
    return own.sum(dtype=np.uint64).tobytes() + other.sum(dtype=np.uint64).tobytes()


def _lists(values: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(values).view(np.int64).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), flat)


def sketch_documents(docs: DataFrame, width: int, threshold: float, samples: int = SAMPLES) -> DataFrame:
    """doc_id, text_key and SKETCHED of (doc_id, text, text_key) rows; texts without words have a null node."""
    rows_of_band = band_rows(threshold, samples)
    bands = samples // rows_of_band

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            sets = shingle_sets(*hash_words(*text_bytes(batch.column("text"))), width)
            signatures = np.stack([minhash(own, samples) for own in sets])
            parts = signatures[:, : bands * rows_of_band].reshape(len(sets), bands, rows_of_band).astype(np.uint64)
            keys = np.tile(np.arange(bands, dtype=np.uint64), (len(sets), 1))
            for k in range(rows_of_band):
                keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array([len(own) for own in sets], pa.int64()),
                    pa.array([_digest(own) for own in sets], pa.binary()),
                    _lists(keys),
                    _lists(odd_sketches(signatures)),
                ],
                names=["doc_id", "text_key", "n_shingles", "node", "bands", "sketch"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(sketch, f"doc_id {kind}, text_key long, {SKETCHED}")


def _ones(a: str, b: str) -> Column:
    differ = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(differ, F.lit(0), lambda n, x: n + x)


def _node_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of the wanted nodes, made again from the text of a document of each."""
    ids = wanted.select(F.col("doc_id").alias("its_id")).distinct()
    texts = docs.join(ids, docs.doc_id.eqNullSafe(ids.its_id), "left_semi").select("text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            found = [own for own in shingle_sets(*hash_words(*text_bytes(batch.column("text"))), width) if len(own)]
            ends = np.cumsum([0, *(len(own) for own in found)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *(np.sort(own.view(np.int64)) for own in found)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(own) for own in found], pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["node", "shingles"],
            )

    made = texts.mapInArrow(sets, "node binary, shingles array<long>")
    return made.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, threshold: float) -> DataFrame:
    """The pairs (u, v) whose full sets reach the threshold, in integers: 100 * shared >= percent * all."""
    pairs = stored(pairs, "pairs")
    ends = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    sets = stored(_node_sets(docs, nodes.join(ends, "node", "left_semi").select("node", "doc_id"), width), "sets")
    left = pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("su")), "u")
    both = left.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv")), "v")
    shared = F.size(F.array_intersect("su", "sv"))
    counted = both.select("u", "v", shared.alias("shared"), (F.size("su") + F.size("sv")).alias("sizes"))
    percent = whole_percent(threshold)
    return counted.where(100 * F.col("shared") >= percent * (F.col("sizes") - F.col("shared"))).select("u", "v")


def whole_percent(threshold: float) -> int:
    """The threshold in whole percent, in which similarities are compared exactly; finer ones are refused."""
    percent = round(100 * threshold)
    if abs(100 * threshold - percent) > 1e-9:
        raise ValueError(f"a threshold is in whole percent: {threshold}")
    return percent


def _first_pairs(nodes: DataFrame, members: DataFrame, most: int) -> DataFrame:
    """For each node the least node of a band group, of those that its sketch admits the one in most of its groups."""
    leaders = members.groupBy("band").agg(F.min("node").alias("leader"), F.count("*").alias("size")).where("size > 1")
    shared = members.join(leaders, "band").where("node <> leader").groupBy("node", "leader").agg(F.count("*").alias("times"))
    sketches = nodes.select("node", "sketch")
    with_own = shared.join(sketches, "node")
    with_both = with_own.join(sketches.select(F.col("node").alias("leader"), F.col("sketch").alias("other")), "leader")
    close = with_both.where(_ones("sketch", "other") <= most)
    best = close.groupBy("node").agg(F.max(F.struct("times", "leader")).alias("best"))
    return best.select(F.col("node").alias("u"), F.col("best.leader").alias("v"))


GROUP = "number", "band", "lower", "upper"


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of a group together and in order: by block and node."""
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP, "block", "node")


def _open_members(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Members of the band groups that are in more than one component, once for each pair of blocks they are compared in."""
    own = nodes.join(links, "node", "left").withColumn("component", F.coalesce("component", "node"))
    own = own.select("node", "component", "n_shingles", F.posexplode("bands").alias("number", "band"))
    open_ = own.groupBy("number", "band").agg(
        F.min("component").alias("least"),
        F.max("component").alias("greatest"),
        F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES).alias("size"),
    )
    open_ = open_.where("least <> greatest").select("number", "band", F.ceil("size").cast("int").alias("blocks"))
    rows = own.join(open_, ["number", "band"])
    # A member of block k of n meets the blocks of all n pairs that k is in.
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lower, upper = F.least("block", "other").alias("lower"), F.greatest("block", "other").alias("upper")
    return rows.select("number", "band", lower, upper, "block", "node", "component")


def _second_links(nodes: DataFrame, links: DataFrame, docs: DataFrame, width: int, threshold: float, most: int) -> DataFrame:
    """Confirmed links (u, v) between components of the same band group."""
    members = _open_members(nodes, links).join(nodes.select("node", "sketch", "bands"), "node")
    schema = "number int, band long, lower int, upper int, block int, node binary, component binary, sketch array<long>, bands array<long>"
    near = lambda batches: _each_group(batches, lambda group: _members_with_near(group, most))
    columns = [field.split()[0] for field in schema.split(", ")]
    some = stored(_dealt(members.select(columns)).mapInArrow(near, schema), "near-members")
    wanted = nodes.join(some.select("node").distinct(), "node", "left_semi").select("node", "doc_id")
    sets = stored(_node_sets(docs, wanted, width), "sets")
    confirm = lambda batches: _each_group(batches, lambda group: _linked(group, most, whole_percent(threshold)))
    return _dealt(some.join(sets, "node")).mapInArrow(confirm, "u binary, v binary").distinct()


def _each_group(batches: Iterator[pa.RecordBatch], use) -> Iterator[pa.RecordBatch]:
    """What ``use`` makes of each run of rows with equal GROUP columns, one run in memory at a time."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        keys = [table.column(c).to_numpy() for c in GROUP]
        starts = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])).tolist()
        if held and all(held[-1].column(c)[-1].as_py() == k[0] for c, k in zip(GROUP, keys)):
            end = starts[1] if len(starts) > 1 else table.num_rows
            held.append(table.slice(0, end))
            starts = starts[1:]
        if not starts:
            continue
        if held:
            yield from use(pa.concat_tables(held).combine_chunks())
        for a, b in zip(starts, starts[1:]):
            if b - a > 1:
                yield from use(table.slice(a, b - a).combine_chunks())
        held = [table.slice(starts[-1])]
    if held:
        yield from use(pa.concat_tables(held).combine_chunks())


def _near_pairs(group: pa.Table, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places (i, j) and XOR ones of the pairs of a group that the sketch admits, that are in different components, and
    whose first common band is this one: each pair of nodes is in one group only."""
    lower, upper, number = (group.column(c)[0].as_py() for c in ("lower", "upper", "number"))
    matrix = lambda c: group.column(c).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(group.num_rows, -1)
    sketch, bands = matrix("sketch"), matrix("bands")
    block = group.column("block").to_numpy()
    component = np.unique(np.array(group.column("component").to_pylist(), dtype="S16"), return_inverse=True)[1]
    left = np.arange(group.num_rows) if lower == upper else np.flatnonzero(block == lower)
    right = left if lower == upper else np.flatnonzero(block == upper)
    for k in range(0, len(left), 64):
        some = left[k : k + 64]
        near = component[some][:, None] != component[right]
        if lower == upper:
            near &= some[:, None] < right
        i, j = np.nonzero(near)
        i, j = some[i], right[j]
        ones = np.zeros(len(i), np.int64)
        for word in range(sketch.shape[1]):
            ones += np.bitwise_count(sketch[i, word] ^ sketch[j, word])
        close = ones <= most
        i, j, ones = i[close], j[close], ones[close]
        first = (bands[i, :number] != bands[j, :number]).all(axis=1)
        yield i[first], j[first], ones[first]


def _members_with_near(group: pa.Table, most: int) -> Iterator[pa.RecordBatch]:
    found = np.zeros(group.num_rows, bool)
    for i, j, _ in _near_pairs(group, most):
        found[i] = found[j] = True
    if found.any():
        yield from group.filter(pa.array(found)).to_batches()


def _linked(group: pa.Table, most: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Links of a group whose sets are at hand, most similar first, between what they do not connect yet."""
    pairs = [np.concatenate(parts) for parts in zip(*_near_pairs(group, most))]
    if not pairs or not len(pairs[0]):
        return
    ends = group.column("shingles").combine_chunks()
    values, bounds = ends.flatten().to_numpy(), ends.offsets.to_numpy()
    bounds = bounds - bounds[0]
    root = np.unique(np.array(group.column("component").to_pylist(), dtype="S16"), return_inverse=True)[1]
    nodes, out = group.column("node").to_pylist(), []
    order = np.argsort(pairs[2], kind="stable")
    for i, j in zip(pairs[0][order].tolist(), pairs[1][order].tolist()):
        if root[i] == root[j]:
            continue
        a, b = values[bounds[i] : bounds[i + 1]], values[bounds[j] : bounds[j + 1]]
        both = _shared(a, b)
        if 100 * both >= percent * (len(a) + len(b) - both):
            root[root == root[j]] = root[i]
            out.append((max(nodes[i], nodes[j]), min(nodes[i], nodes[j])))
    if out:
        u, v = zip(*out)
        yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.binary()), "v": pa.array(v, pa.binary())})


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Common members of two ascending sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    return int((large[np.minimum(at, len(large) - 1)] == small).sum())


def near_duplicates(
    docs: DataFrame, width: int = 5, threshold: float = 0.8, samples: int = SAMPLES, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept, group, text_key.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Rows without words are linked with nothing, their
    component is their own doc_id. Rows with null doc_id are linked as others, but no component is named
    by null unless all its ids are. Rows with equal id and text are equal in everything. No rows: no rows.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key"))
    rows = stored(sketch_documents(plain, width, threshold, samples), "sketches")
    with_words = rows.where(F.col("node").isNotNull())
    nodes = with_words.groupBy("node").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ("n_shingles", "bands", "sketch")))
    nodes = stored(nodes, "nodes")
    members = nodes.select("node", F.explode("bands").alias("band"))
    most = most_ones(threshold, samples)

    first = stored(_first_pairs(nodes, members, most), "first-pairs")
    links = stored(_confirmed(first, nodes, plain, width, threshold), "links")
    near = stored(components(links), "components")
    more = stored(_second_links(nodes, near, plain, width, threshold, most), "links")
    if more.take(1):
        near = stored(components(links.union(more)), "components")

    named = nodes.select("node", "doc_id").join(near, "node", "left").withColumn("group", F.coalesce("component", "node"))
    least = named.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    of_node = named.select("node", "group").join(least, "group")
    out = rows.select("doc_id", "text_key", "n_shingles", "node").join(of_node, "node", "left")
    component_id = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", "n_shingles", component_id.alias("component_id"), "group", "text_key")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(
    docs: DataFrame, width: int = 5, threshold: float = 0.8, samples: int = SAMPLES, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates: of the smallest doc_id (null last), the text with the smallest hash.

    Rows without words are in no group and all stay.
    """
    report = near_duplicates(docs, width, threshold, samples, doc_id, text).where(F.col("group").isNotNull())
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    best = report.groupBy("group").agg(F.min(rank).alias("best"))
    best = best.select(_id_text(F.col("best.doc_id")).alias("id"), F.col("best.text_key").alias("key"))
    whole = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"),
        _id_text(F.col(doc_id)).alias("id"),
        F.xxhash64(text).alias("key"),
        F.coalesce(F.col(text).rlike(WORD), F.lit(False)).alias("has_words"),
    )
    # Copies of a row meet for the join, and the next step needs no other shuffle.
    one = whole.where("has_words").join(best, ["id", "key"], "left_semi").dropDuplicates(["id", "key"])
    columns = ["id", "key", "whole"]
    return one.select(columns).union(whole.where("not has_words").select(columns)).select("whole.*")


def _id_text(doc_id: Column) -> Column:
    """A text for each id, which is not null and tells null from all others."""
    return F.coalesce(F.concat(F.lit("="), doc_id.cast("string")), F.lit(""))
