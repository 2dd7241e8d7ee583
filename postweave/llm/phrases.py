"""Phrases whose words occur together more often than apart, counted over a prefix-free parse.

1. Texts are cut into pieces at punctuation, and pieces into overlapping chunks: a chunk goes from one trigger, a run of
   OVERLAP words whose hash says so, to the end of the next. Equal chunks are counted: the dictionary of the parse. A run of
   words within an overlap belongs to the chunk that begins with it, so every phrase of a piece lies in one chunk once.
2. Phrases are counted inside distinct chunks, weighted by how often these occur. Level by level, from words to the
   longest phrases, tasks count hashes of phrases whose parts were frequent enough; hashes whose sums are, set bits
   in a filter of fixed size. Equal hashes only add to a sum, so the filter never loses a phrase.
3. Phrases that pass the filter are counted exactly, as texts, and candidates are scored with exact arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postweave.llm.batches import LOWER, hash_spans, mix, slabs, text_bytes, window_hashes, word_spans
from postweave.plans.storage import stored

LONGEST, LEAST, TOP = 5, 100, 2000
OVERLAP = LONGEST - 1
# A run of OVERLAP words in so many is a trigger.
TRIGGER = 16
# Bits of the filter; bits of a phrase's hash that are counted; phrases whose counts a task adds up at once.
FILTER_BITS, HASH_BITS = 1 << 27, 48
HELD_PHRASES, HELD_ROWS = 1 << 22, 1 << 20
# Words of the dictionary for each bucket of hashes.
BUCKET_WORDS = 1 << 21
SENT_BYTES = 4 << 20
# A candidate goes if a longer one that holds it has at least this percentage of its count.
SWALLOWED = 100
UNKNOWN = "und"


def _set(chars) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


BREAKS = _set(".,;:!?\n\x0b\x0c\r")
BLANKS = _set(" \t")


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... of all ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def texts_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans of bytes as a text column."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[ragged(starts, ends - starts)]))


def chunk_spans(words: np.ndarray, pieces: np.ndarray, trigger: int = TRIGGER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and end of each chunk, and whether it is the last of its piece; ``pieces`` ascend by word."""
    count = len(words)
    if not count:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    begins = np.concatenate([[True], pieces[1:] != pieces[:-1]])
    piece_end = np.append(np.flatnonzero(begins)[1:], count)[np.cumsum(begins) - 1]
    hashes = window_hashes(words, OVERLAP)
    at = np.flatnonzero(hashes % np.uint64(trigger) == 0)
    at = at[at + OVERLAP <= piece_end[at]]
    begins[at] = True
    starts = np.flatnonzero(begins)
    following = np.append(starts[1:], count)
    last = following == piece_end[starts]
    return starts, np.where(last, following, following + OVERLAP), last


def dictionary(docs: DataFrame, trigger: int = TRIGGER) -> DataFrame:
    """(lang, chunk, last, words, times) of (lang, text): distinct chunks, words joined by a space."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            data, bounds = text_bytes(batch.column("text"))
            data = LOWER[data]
            starts, ends = word_spans(data, bounds, BREAKS | BLANKS)
            if not len(starts):
                continue
            row = np.searchsorted(bounds, starts, "right") - 1
            pieces = np.cumsum(BREAKS[data])[starts] + row
            first, end, last = chunk_spans(hash_spans(data, starts, ends), pieces, trigger)
            # All words, a space after each.
            sizes = ends - starts
            offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
            plain = np.full(int(offsets[-1]), 0x20, np.uint8)
            plain[ragged(offsets[:-1], sizes)] = data[ragged(starts, sizes)]
            begin, stop = offsets[first], offsets[end] - 1
            total = np.cumsum(stop - begin)
            at = 0
            while at < len(first):
                done = total[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(total, done + SENT_BYTES, "right")))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("lang").take(pa.array(row[first[at:to]])),
                        texts_of(plain, begin[at:to], stop[at:to]),
                        pa.array(last[at:to]),
                        pa.array((end - first)[at:to]),
                    ],
                    names=["lang", "chunk", "last", "words"],
                )
                at = to

    found = docs.mapInArrow(parse, "lang string, chunk string, last boolean, words long")
    return found.groupBy("lang", "chunk", "last", "words").agg(F.count("*").alias("times"))


class Chunks:
    """The words of a batch of distinct chunks."""

    def __init__(self, batch: pa.RecordBatch):
        self.data, bounds = text_bytes(batch.column("chunk"))
        self.starts, self.ends = word_spans(self.data, bounds, BLANKS)
        self.words = hash_spans(self.data, self.starts, self.ends)
        at = np.searchsorted(self.starts, bounds)
        sizes = np.diff(at)
        self.row = np.repeat(np.arange(batch.num_rows), sizes)
        last = batch.column("last").to_numpy(zero_copy_only=False)
        # The end of each word's chunk, and whether phrases that begin there are its own.
        self.end = at[1:][self.row]
        self.own = last[self.row] | (np.arange(len(self.words)) < self.end - OVERLAP)
        self.times = batch.column("times").to_numpy()
        langs = batch.column("lang").dictionary_encode()
        names, at = text_bytes(langs.dictionary)
        self.lang = hash_spans(names, at[:-1], at[1:])[langs.indices.to_numpy()][self.row]

    def hashes(self, length: int) -> np.ndarray:
        """HASH_BITS of each phrase of ``length`` words, by its first word, whether or not it is within a chunk."""
        found = self.words if length == 1 else window_hashes(self.words, length)
        return mix(found ^ (self.lang[: len(found)] * np.uint64(2 * length + 1))) >> np.uint64(64 - HASH_BITS)

    def phrases(self, length: int) -> np.ndarray:
        """First words of the phrases of ``length`` words that belong to their chunk."""
        at = np.arange(len(self.words))
        return np.flatnonzero(self.own & (at + length <= self.end))


class Filter:
    """Bits set by hashes; a hash may share its bit with others."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.shift = np.uint64(HASH_BITS - (len(bits) * 8).bit_length() + 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _six(keys: np.ndarray) -> bytes:
    """The low HASH_BITS of 64-bit numbers."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : HASH_BITS // 8]).tobytes()


def _from_six(blob: bytes) -> np.ndarray:
    keys = np.zeros((len(blob) // (HASH_BITS // 8), 8), np.uint8)
    keys[:, : HASH_BITS // 8] = np.frombuffer(blob, np.uint8).reshape(-1, HASH_BITS // 8)
    return keys.view("<u8").ravel()


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _run_lengths(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def _sent(keys: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """A row for each bucket: hashes that were found once, and others with their counts."""
    edges = np.arange(1, buckets, dtype=np.uint64) << np.uint64(HASH_BITS - (buckets.bit_length() - 1))
    parts = []
    for some in (counts == 1, counts > 1):
        bounds = np.concatenate([[0], np.searchsorted(keys[some], edges), [int(some.sum())]])
        parts.append((keys[some], counts[some], bounds))
    rows = []
    (once, _, a), (more, sums, b) = parts
    for k in np.flatnonzero((a[:-1] < a[1:]) | (b[:-1] < b[1:])).tolist():
        rows.append((k, _six(once[a[k] : a[k + 1]]), _six(more[b[k] : b[k + 1]]), sums[b[k] : b[k + 1]].astype(np.int64).tobytes()))
    if rows:
        bucket, *blobs = zip(*rows)
        columns = [pa.array(bucket, pa.int32()), *(pa.array(b, pa.binary()) for b in blobs)]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "once", "keys", "counts"])


def _frequent(chunks: DataFrame, length: int, passed: Filter | None, buckets: int, least: int, filter_bits: int) -> np.ndarray:
    """The filter's bits of phrases of ``length`` words whose hashes occur ``least`` times or more.

    Phrases with a part, less a word at either end, that ``passed`` lacks are left out: they are rarer than that.
    """
    held = chunks.sparkSession.sparkContext.broadcast(passed)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, weights, size = [], [], 0

        def send() -> Iterator[pa.RecordBatch]:
            key, weight = np.concatenate(keys), np.concatenate(weights)
            yield from _sent(*_run_lengths(key[weight == 1]), buckets)
            yield from _sent(*_summed(key[weight > 1], weight[weight > 1]), buckets)

        for batch in slabs(batches, "chunk"):
            c = Chunks(batch)
            at = c.phrases(length)
            if held.value is not None:
                parts = held.value.has(c.hashes(length - 1))
                at = at[parts[at] & parts[at + 1]]
            keys.append(c.hashes(length)[at])
            weights.append(c.times[c.row[at]])
            size += len(at)
            if size >= HELD_PHRASES:
                yield from send()
                keys, weights, size = [], [], 0
        if size:
            yield from send()

    def gather(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        once = [_from_six(b) for b in group.column("once").to_pylist()]
        more = [_from_six(b) for b in group.column("keys").to_pylist()]
        counts = [np.ones(sum(map(len, once)), np.int64), *(np.frombuffer(b, np.int64) for b in group.column("counts").to_pylist())]
        keys, counts = _summed(np.concatenate([*once, *more]), np.concatenate(counts))
        bits = np.zeros(filter_bits // buckets, np.uint8)
        shift = np.uint64(HASH_BITS - (filter_bits.bit_length() - 1))
        bits[((keys[counts >= least] >> shift) & np.uint64(len(bits) - 1)).astype(np.int64)] = 1
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    sums = chunks.mapInArrow(count, "bucket int, once binary, keys binary, counts binary")
    found = np.zeros(filter_bits // 8, np.uint8)
    part = filter_bits // 8 // buckets
    for row in sums.groupBy("bucket").applyInArrow(gather, "bucket int, bits binary").collect():
        found[row.bucket * part : (row.bucket + 1) * part] = np.frombuffer(row.bits, np.uint8)
    held.unpersist()
    return found


NAMES = ["lang", "length", "phrase"]


def _added(tables: list[pa.Table]) -> pa.Table:
    """Equal phrases of a language once, with the sum of their counts."""
    return pa.concat_tables(tables).group_by(NAMES).aggregate([("f", "sum")]).select([*NAMES, "f_sum"]).rename_columns([*NAMES, "f"])


def _as_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _in_buckets(table: pa.Table, buckets: int) -> Iterator[pa.RecordBatch]:
    """A row for each bucket with its part of the counts, as a stream of columns."""
    data, bounds = text_bytes(table.column("phrase"))
    bucket = hash_spans(data, bounds[:-1], bounds[1:]) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    ordered = table.take(pa.array(order))
    parts = [_as_bytes(ordered.slice(a, b - a)) for a, b in zip(first, np.append(first[1:], len(order)))]
    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(parts, pa.binary())], names=["bucket", "counts"])


def _exact(chunks: DataFrame, passed: Filter, longest: int, buckets: int, least: int) -> DataFrame:
    """(lang, length, phrase, f) of the phrases that pass the filter and occur ``least`` times."""
    held = chunks.sparkSession.sparkContext.broadcast(passed)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, size = [], 0
        for batch in slabs(batches, "chunk", SENT_BYTES // 4):
            c = Chunks(batch)
            langs = batch.column("lang")
            for length in range(1, longest + 1):
                at = c.phrases(length)
                at = at[held.value.has(c.hashes(length)[at])]
                if not len(at):
                    continue
                texts, times = texts_of(c.data, c.starts[at], c.ends[at + length - 1]), pa.array(c.times[c.row[at]])
                columns = [langs.take(pa.array(c.row[at])), pa.array(np.full(len(at), length, np.int32)), texts, times]
                tables.append(_added([pa.table(columns, names=[*NAMES, "f"])]))
                size += tables[-1].num_rows
            if size >= HELD_ROWS:
                tables = [_added(tables)]
                size = tables[0].num_rows
                if size >= HELD_ROWS // 2:
                    yield from _in_buckets(tables[0], buckets)
                    tables, size = [], 0
        if tables:
            yield from _in_buckets(_added(tables), buckets)

    def gather(group: pa.Table) -> pa.Table:
        total = _added([pa.ipc.open_stream(part.as_py()).read_all() for part in group.column("counts")])
        total = total.filter(pc.greater_equal(total.column("f"), least))
        return total.select(["lang", "length", "phrase", "f"])

    parts = chunks.mapInArrow(count, "bucket int, counts binary")
    return parts.groupBy("bucket").applyInArrow(gather, "lang string, length int, phrase string, f long")


def exact_score(a: str, n: str, l: str, r: str) -> Column:
    """floor(1000 * a * n / (l * r)) of columns of whole numbers below 10**16, by products of up to 38 digits."""
    wide = lambda c: f"cast({c} as decimal(17,0))"
    return F.expr(f"(cast(1000 as decimal(4,0)) * ({wide(a)} * {wide(n)})) div ({wide(l)} * {wide(r)})")


def _joined(words: Column, start, size) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def _power_of_two(n: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1, n)))))


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, filter_bits: int = FILTER_BITS, trigger: int = TRIGGER) -> tuple[DataFrame, DataFrame]:
    """Of (lang, text): (lang, phrase, length, f) of phrases with f >= least, and (lang, n) of all words."""
    chunks = stored(dictionary(docs, trigger), "chunks")
    own = F.when(F.col("last"), F.col("words")).otherwise(F.col("words") - OVERLAP)
    totals = chunks.groupBy("lang").agg(F.sum(own * F.col("times")).alias("n"))
    words = chunks.agg(F.sum("words")).first()[0] or 0
    at_least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(_power_of_two(max(at_least, words / BUCKET_WORDS)), filter_bits // 64)
    bits, passed = np.zeros(filter_bits // 8, np.uint8), None
    for length in range(1, longest + 1):
        found = _frequent(chunks, length, passed, buckets, least, filter_bits)
        bits |= found
        passed = Filter(found)
    return stored(_exact(chunks, Filter(bits), longest, buckets, least), "phrases"), totals


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    swallowed: int = SWALLOWED,
    filter_bits: int = FILTER_BITS,
    trigger: int = TRIGGER,
) -> DataFrame:
    """Per language the first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased; pieces end at ``.,;:!?`` and line ends, words at spaces and tabs. Null languages are one, ``und``,
    null texts empty, and equal rows count each time. Without phrases that occur ``least`` times there are no rows.
    """
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    plain = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    counted, totals = phrase_counts(plain, longest, least, filter_bits, trigger)
    words = F.split("phrase", " ")
    candidates = counted.where("length >= 2")

    inner = F.transform(
        F.sequence(F.lit(2), F.col("length") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.col("length") - size + 1), lambda at: _joined(words, at, size)),
    )
    longer = candidates.where("length >= 3").select("lang", F.explode(F.flatten(inner)).alias("phrase"), F.col("f").alias("longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer").cast("decimal(20,0)") < swallowed * F.col("f").cast("decimal(20,0)"))
    )

    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), "length", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("cut"))
    cuts = cuts.withColumns({"first": _joined(words, F.lit(1), F.col("cut")), "rest": _joined(words, F.col("cut") + 1, F.col("length"))})
    part = lambda name, count: counted.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    scored = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    scored = scored.withColumn("score", exact_score("a", "n", "l", "r"))
    lowest = F.min(F.struct("score", "cut", "l", "r")).alias("lowest")
    best = scored.groupBy("lang", "phrase", "a", "n").agg(lowest)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    flat = best.select("lang", "phrase", "a", "lowest.l", "lowest.r", "n", "lowest.score")
    ranked = flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), sized AS (
    SELECT lang, w, len(w) AS size FROM (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces) WHERE len(w) > 0
), totals AS (
    SELECT lang, sum(size)::BIGINT AS n FROM sized GROUP BY lang
), counted AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
    FROM sized, (VALUES (1), (2), (3), (4), (5)) lengths(k), unnest(range(1, size - k + 2)) places(i)
    GROUP BY ALL HAVING count(*) >= 100
), longer AS (
    SELECT c.lang, array_to_string(string_split(c.phrase, ' ')[i : i + s - 1], ' ') AS phrase, max(c.f) AS f
    FROM counted c, (VALUES (2), (3), (4)) sizes(s), unnest(range(1, c.k - s + 2)) places(i)
    WHERE s < c.k
    GROUP BY ALL
), kept AS (
    SELECT c.* FROM counted c LEFT JOIN longer b USING (lang, phrase) WHERE c.k >= 2 AND (b.f IS NULL OR 100 * b.f < 100 * c.f)
), cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, cut, array_to_string(string_split(c.phrase, ' ')[1 : cut], ' ') AS head,
        array_to_string(string_split(c.phrase, ' ')[cut + 1 :], ' ') AS tail
    FROM kept c, unnest(range(1, c.k)) cuts(cut)
), scored AS (
    SELECT lang, c.phrase, a, cut, h.f AS l, t.f AS r, n, ((1000::HUGEINT * a * n) // (h.f::HUGEINT * t.f))::BIGINT AS score
    FROM cuts c JOIN counted h USING (lang) JOIN counted t USING (lang) JOIN totals USING (lang)
    WHERE h.phrase = c.head AND t.phrase = c.tail
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""
