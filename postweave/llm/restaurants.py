"""Restaurants of all pairs of neighbouring words, in buckets by context.

A bucket is one row: its contexts' hashes, how many words follow each (``runs``), these words and their counts. A word that
every task holds is named by its place in the shared list, any other by a place behind it, in the row's own list ``rare``.
Within a context words ascend by that number. Pairs seen once have one table in every seating, so they are counted and
stored but not sampled.

Seatings are sampled in rounds. Within a round each bucket's restaurants are seated several times with the chances of words
at the parent as they were after the round before; then the mean numbers of tables are summed by word, in buckets by word, and
give the next chances. Frequent words' chances are sent to all tasks, those of others are asked of the words' buckets. These are
as many as the texts need, not as the restaurants have, and a task adds up the sums of its restaurants before it deals them to
the words' buckets: else each bucket of restaurants sent a row to each of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postweave.llm.seating import Seating
from postweave.plans.storage import delete, stored

STRENGTH = 1.0
ROUNDS, SWEEPS = 3, 5
# Sums by word, of several buckets of restaurants, that a task holds before it sends them on.
HELD_SUMS = 1 << 21
LOW = np.uint64(0xFFFFFFFF)

PAIRS = "bucket int, contexts binary, runs binary, refs binary, rare binary, counts binary"
ASKED = "array<struct<bucket:int,keys:binary>>"
SUMS = "bucket int, keys binary, counts binary"


def blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def planes(values: np.ndarray) -> bytes:
    """Integers with all their first bytes first, so that bytes that are mostly zero are next to each other and compress."""
    return blob(values.reshape(-1, 1).view(np.uint8).T)


def whole(data: bytes, kind: type) -> np.ndarray:
    """The inverse of ``planes``."""
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(kind).reshape(-1)


def at(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key in an ascending table, -1 if it has none."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[place] == keys, place, -1)


def bucket_bounds(ordered: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in ascending hashes; ``buckets`` is a power of two."""
    edges = np.arange(1, buckets, dtype=np.uint64) << np.uint64(64 - (buckets.bit_length() - 1)) if buckets > 1 else []
    return np.concatenate([[0], np.searchsorted(ordered, edges), [len(ordered)]]).astype(np.int64)


def in_buckets(keys: np.ndarray, buckets: int, **values: np.ndarray) -> list[dict]:
    """Ascending keys and what belongs to them, as one entry for each bucket that has some."""
    cuts = bucket_bounds(keys, buckets)
    return [
        {"bucket": k, "keys": blob(keys[a:b]), **{name: blob(v[a:b]) for name, v in values.items()}}
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))
        if b > a
    ]


class Pairs:
    """Distinct pairs in the order of their contexts' hashes, then of their words' numbers."""

    def __init__(self, contexts: np.ndarray, context: np.ndarray, refs: np.ndarray, rare: np.ndarray, held: int):
        self.contexts, self.context, self.refs, self.rare, self.held = contexts, context, refs, rare, held

    def rows(self, buckets: int, counts: np.ndarray) -> Iterator[tuple]:
        """PAIRS of all buckets that have some."""
        cuts = bucket_bounds(self.contexts, buckets)
        ends = np.searchsorted(self.context, cuts)
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = ends[k], ends[k + 1]
            runs = np.bincount(self.context[a:b] - cuts[k], minlength=cuts[k + 1] - cuts[k])
            refs, rare = own_list(self.refs[a:b], self.rare, self.held)
            yield k, blob(self.contexts[cuts[k] : cuts[k + 1]]), planes(runs.astype(np.uint32)), planes(refs), blob(rare), planes(counts[a:b])


def own_list(refs: np.ndarray, rare: np.ndarray, held: int) -> tuple[np.ndarray, np.ndarray]:
    """The same words by a list of rare ones that has no others."""
    refs = refs.astype(np.uint32)
    far = refs >= held
    used, place = np.unique(refs[far], return_inverse=True)
    refs[far] = held + place
    return refs, rare[used.astype(np.int64) - held]


class Numbered:
    """Tokens by their place ``number`` among the ascending distinct hashes ``names``, ``before`` that of the token before, and
    ``place`` each name's among the words that every task holds, -1 for others."""

    def __init__(self, tokens: np.ndarray, first: np.uint64, held: np.ndarray):
        tokens = np.append(tokens, first)
        order = np.argsort(tokens)
        tokens = tokens[order]
        new = np.append(True, tokens[1:] != tokens[:-1])
        names, number = tokens[new], np.empty(len(order), np.uint32)
        number[order] = np.cumsum(new, dtype=np.uint32) - np.uint32(1)
        self.names, self.number, self.before, self.held = names, number[:-1], np.append(number[-1], number[:-2]), len(held)
        self.place = at(held, names)
        self.ref = self.place.copy()
        self.ref[self.place < 0] = len(held) + np.arange(int((self.place < 0).sum()))

    def keys(self) -> np.ndarray:
        """Numbers of each token's pair, that ascend by its context's name and its word's ref."""
        keys = self.before.astype(np.int64)
        keys *= self.held + len(self.names)
        keys += self.ref[self.number]
        return keys

    def pairs(self, keys: np.ndarray) -> Pairs:
        """The pairs of some distinct, ascending keys."""
        context = keys // (self.held + len(self.names))
        refs = (keys - context * (self.held + len(self.names))).astype(np.uint32)
        new = np.append(True, context[1:] != context[:-1])[: len(context)]
        return Pairs(self.names[context[new]], np.cumsum(new) - 1, refs, self.names[self.place < 0], self.held)


class Bucket:
    """Pairs of one or more rows of PAIRS, read back; ``counts`` are added up."""

    def __init__(self, rows: pa.Table, held: int):
        read = lambda name, kind: [np.frombuffer(v, kind) for v in rows.column(name).to_pylist()]
        join = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
        contexts, rare = read("contexts", np.uint64), read("rare", np.uint64)
        runs, refs = ([whole(v, np.uint32) for v in rows.column(c).to_pylist()] for c in ("runs", "refs"))
        self.contexts, context = np.unique(join(contexts, np.uint64), return_inverse=True)
        self.rare, behind = np.unique(join(rare, np.uint64), return_inverse=True)
        self.order = np.repeat(context, join(runs, np.int64))
        numbers, begin = [], 0
        for own, names in zip(refs, rare):
            own = own.astype(np.int64)
            far = own >= held
            own[far] = held + behind[begin + own[far] - held]
            begin += len(names)
            numbers.append(own)
        self.held = held
        self.keys = (self.order.astype(np.uint64) << np.uint64(32)) | join(numbers, np.int64).astype(np.uint64)

    def add_up(self, counts: np.ndarray) -> tuple[Pairs, np.ndarray]:
        order = np.argsort(self.keys, kind="stable")
        keys = self.keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        counts = np.add.reduceat(counts[order], first) if len(keys) else counts
        keys = keys[first]
        return Pairs(self.contexts, (keys >> np.uint64(32)).astype(np.int64), (keys & LOW).astype(np.uint32), self.rare, self.held), counts


def count_pairs(texts: DataFrame, tokens_of, first: np.uint64, held, buckets: int, most: int) -> DataFrame:
    """PAIRS of all texts, one row for each bucket; and how many pairs were seen once and twice.

    ``tokens_of`` gives the tokens of an Arrow column of texts, each text's last one ``first``; tasks add up ``most`` of them
    before they send.
    """
    from postweave.llm.batches import slabs

    def rows_of(parts: list[np.ndarray]) -> pa.RecordBatch:
        tokens = np.concatenate(parts)
        parts.clear()
        numbered = Numbered(tokens, first, held.value)
        del tokens
        keys = numbered.keys()
        # The tokens' numbers, which are long, are in the keys.
        del numbered.number, numbered.before
        keys.sort()
        begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        counts = np.diff(np.append(begins, len(keys))).astype(np.uint32)
        keys = keys[begins]
        columns = list(map(list, zip(*numbered.pairs(keys).rows(buckets, counts))))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], [f.split()[0] for f in PAIRS.split(", ")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in slabs(batches):
            parts.append(tokens_of(batch.column("text")))
            size += len(parts[-1])
            if size >= most:
                yield rows_of(parts)
                parts, size = [], 0
        if parts:
            yield rows_of(parts)

    def gather(rows: pa.Table) -> pa.Table:
        counts = np.concatenate([whole(c, np.uint32).astype(np.int64) for c in rows.column("counts").to_pylist()])
        pairs, counts = Bucket(rows, len(held.value)).add_up(counts)
        bucket = rows.column("bucket")[0].as_py()
        runs = np.bincount(pairs.context, minlength=len(pairs.contexts)).astype(np.uint32)
        refs, rare = own_list(pairs.refs, pairs.rare, pairs.held)
        values = (blob(pairs.contexts), planes(runs), planes(refs), blob(rare), planes(counts))
        columns = [pa.array([bucket], pa.int32()), *(pa.array([v], pa.binary()) for v in values), pa.array([int((counts == 1).sum())]), pa.array([int((counts == 2).sum())])]
        return pa.Table.from_arrays(columns, ["bucket", "contexts", "runs", "refs", "rare", "counts", "ones", "twos"])

    return texts.mapInArrow(count, PAIRS).groupBy("bucket").applyInArrow(gather, PAIRS + ", ones long, twos long")


def looked_up(requests: DataFrame, table: DataFrame) -> DataFrame:
    """(slab, bucket, found): the ``counts`` (doubles) of the keys that a slab asks of a bucket, 0 if there are none."""

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, counts = (
            np.concatenate([np.zeros(0, t), *(np.frombuffer(b, t) for b in right.column(c).to_pylist())])
            for c, t in (("keys", np.uint64), ("counts", np.float64))
        )
        found = []
        for wanted in left.column("keys").to_pylist():
            place = at(keys, np.frombuffer(wanted, np.uint64))
            found.append(blob(np.where(place >= 0, counts[place] if len(counts) else 0.0, 0.0)))
        return pa.table({"slab": left.column("slab"), "bucket": left.column("bucket"), "found": pa.array(found, pa.binary())})

    pairs = requests.select("slab", "bucket", "keys").groupBy("bucket").cogroup(table.select("bucket", "keys", "counts").groupBy("bucket"))
    return pairs.applyInArrow(answer, "slab long, bucket int, found binary")


def _by_word(refs: np.ndarray, amounts: np.ndarray, held: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, ascending, and the sums of their amounts."""
    used, place = np.unique(refs, return_inverse=True)
    sums = np.bincount(place, amounts, len(used))
    far = used >= len(held)
    words = np.empty(len(used), np.uint64)
    words[~far], words[far] = held[used[~far]], rare[used[far].astype(np.int64) - len(held)]
    order = np.argsort(words)
    return words[order], sums[order]


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of all parts, ascending, and the sums of their counts."""
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([c for _, c in parts]), len(keys))


STATE = f"bucket int, alone binary, runs binary, refs binary, asked {ASKED}, customers binary, tables binary, means binary, words binary, sums binary"
_ASK = pa.list_(pa.struct([("bucket", pa.int32()), ("keys", pa.binary())]))


def _first_state(restaurants: DataFrame, held, buckets: int) -> DataFrame:
    """Pairs seen more than once, without tables; ``sums`` by ``words`` are the tables of those seen once."""

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                runs, refs = (whole(row[c], np.uint32) for c in ("runs", "refs"))
                rare, counts = np.frombuffer(row["rare"], np.uint64), whole(row["counts"], np.int64)
                context = np.repeat(np.arange(len(runs)), runs)
                once = counts == 1
                alone = np.bincount(context[once], minlength=len(runs))
                more = np.bincount(context[~once], minlength=len(runs)).astype(np.uint32)
                own, names = own_list(refs[~once], rare, len(held.value))
                words, sums = _by_word(refs[once], np.ones(int(once.sum())), held.value, rare)
                values = {
                    "bucket": pa.array([row["bucket"]], pa.int32()),
                    "alone": [planes(alone)],
                    "runs": [planes(more)],
                    "refs": [planes(own)],
                    "asked": pa.array([in_buckets(names, buckets)], _ASK),
                    "customers": [planes(counts[~once])],
                    "tables": [b""],
                    "means": [b""],
                    "words": [blob(words)],
                    "sums": [blob(sums)],
                }
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.binary()) if isinstance(v, list) else v for v in values.values()], list(values))

    return restaurants.mapInArrow(begin, STATE)


def _round(state: DataFrame, answers: DataFrame, held, chances, of_rare, discount: float, seed: int) -> DataFrame:
    """The state after SWEEPS seatings of each bucket's restaurants; ``means`` are over all but the first."""

    def sit(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        read = lambda name, kind: whole(row[name], kind)
        alone, runs, refs, customers = read("alone", np.int64), read("runs", np.uint32), read("refs", np.uint32), read("customers", np.int64)
        order = np.argsort(right.column("bucket").to_numpy())
        found = right.column("found").to_pylist()
        rare_tables = np.concatenate([np.zeros(0), *(np.frombuffer(found[k]) for k in order)])
        names = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(a["keys"], np.uint64) for a in row["asked"])])
        chance = np.concatenate([chances.value, of_rare(rare_tables)])[refs]
        restaurant = np.repeat(np.arange(len(runs)), runs)
        tables = read("tables", np.int64) if row["tables"] else None
        seating = Seating(restaurant, customers, discount, STRENGTH + discount * alone, chance, [seed, row["bucket"]], tables)
        means = np.zeros(len(customers))
        for _ in range(SWEEPS - 1):
            seating.step(chance)
            means += seating.tables / (SWEEPS - 1)
        words, sums = _by_word(refs, means, held.value, names)
        row |= {"tables": planes(seating.tables), "means": blob(means.astype(np.float32)), "words": blob(words), "sums": blob(sums)}
        kinds = {"bucket": pa.int32(), "asked": _ASK}
        return pa.Table.from_arrays([pa.array([v], kinds.get(c, pa.binary())) for c, v in row.items()], list(row))

    # Keys of one type, as Spark deals the two by their hashes.
    own = answers.withColumn("slab", F.col("slab").cast("int"))
    state = state.drop("means", "words", "sums")
    return state.groupBy("bucket").cogroup(own.groupBy("slab")).applyInArrow(sit, STATE)


def _dealt_sums(state: DataFrame, buckets: int) -> DataFrame:
    """SUMS of a state by word: a task adds up those of its rows, and sends one row to each bucket of words whenever it holds many."""

    def sent(words: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = in_buckets(words, buckets, counts=sums)
        if rows:
            kinds = {"bucket": pa.int32(), "keys": pa.binary(), "counts": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in kinds.items()], list(kinds))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for words, sums in zip(batch.column("words"), batch.column("sums")):
                parts.append((np.frombuffer(words.as_buffer(), np.uint64), np.frombuffer(sums.as_buffer())))
                size += len(parts[-1][0])
                if size < HELD_SUMS:
                    continue
                parts = [_added(parts)]
                size = len(parts[0][0])
                if size > HELD_SUMS // 2:
                    yield from sent(*parts[0])
                    parts, size = [], 0
        if parts:
            yield from sent(*_added(parts))

    return state.select("words", "sums").mapInArrow(deal, SUMS)


def _tables_by_word(state: DataFrame, buckets: int, *gathered: DataFrame) -> DataFrame:
    """One row for each bucket of words: keys, their tables over all contexts (doubles) and the sum of these; with those that are
    ``gathered`` by bucket."""
    parts = _dealt_sums(state, buckets)
    for frame in gathered:
        parts = parts.unionAll(frame.select("bucket", "keys", "counts"))

    def gather(rows: pa.Table) -> pa.Table:
        keys, counts = _added([(np.frombuffer(k, np.uint64), np.frombuffer(c)) for k, c in zip(*(rows.column(c).to_pylist() for c in ("keys", "counts")))])
        values = [pa.array([rows.column("bucket")[0].as_py()], pa.int32()), pa.array([blob(keys)], pa.binary()), pa.array([blob(counts)], pa.binary())]
        return pa.Table.from_arrays([*values, pa.array([float(counts.sum())])], ["bucket", "keys", "counts", "total"])

    return stored(parts.groupBy("bucket").applyInArrow(gather, f"{SUMS}, total double"), "tables-by-word")


def discard(frame: DataFrame) -> None:
    """Delete a stored frame that nothing reads any more."""
    files = frame.inputFiles()
    if files:
        delete(frame.sparkSession, files[0].rsplit("/", 1)[0])


def of_held(table: DataFrame, held) -> np.ndarray:
    """The ``counts`` (doubles) of the words that every task holds."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
                place = at(held.value, np.frombuffer(keys, np.uint64))
                some = place >= 0
                yield pa.RecordBatch.from_pydict({"place": [blob(place[some])], "counts": [blob(np.frombuffer(counts)[some])]})

    out = np.zeros(len(held.value))
    for row in table.select("keys", "counts").mapInArrow(select, "place binary, counts binary").toLocalIterator():
        out[np.frombuffer(row.place, np.int64)] = np.frombuffer(row.counts)
    return out


def seated(restaurants: DataFrame, words: DataFrame, tokens: int, held, discount: float, parent, buckets: int, seed: int):
    """Mean tables of all pairs seen more than once (STATE), and of all words over all contexts by bucket, with their sum.

    ``words`` holds the training counts of words as doubles in ``buckets`` by word, from which the chances start;
    ``parent(tables, total)`` gives the chances of words at the parent.
    """
    spark = restaurants.sparkSession
    state = stored(_first_state(restaurants, held, buckets), "seated")
    once = _tables_by_word(state, buckets)
    tables, total = words, float(tokens)
    for k in range(ROUNDS):
        chances = spark.sparkContext.broadcast(parent(of_held(tables, held), total))
        of_rare = lambda found, total=total: parent(found, total)
        requests = state.select(F.col("bucket").cast("long").alias("slab"), F.explode("asked").alias("a")).select("slab", "a.*")
        before, state = (state, tables), stored(_round(state, looked_up(requests, tables), held, chances, of_rare, discount, seed * ROUNDS + k), "seated")
        tables = _tables_by_word(state, buckets, once)
        total = tables.agg(F.coalesce(F.sum("total"), F.lit(0.0))).first()[0]
        for frame in before[: 2 if k else 1]:
            discard(frame)
    discard(once)
    return state, tables, total


SHARES = "bucket int, contexts binary, runs binary, refs binary, rare binary, back binary, kept binary, often binary, chances binary"


def shares(restaurants: DataFrame, state: DataFrame, held, chances, discount: float, least: float, key_of) -> DataFrame:
    """PAIRS with the ``kept`` share of each pair and the share of each context that goes ``back`` to the parent.

    ``often`` and ``chances`` are keys and whole chances of pairs of held words seen at least ``least`` times.
    """

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        row, own = left.to_pylist()[0], right.to_pylist()[0]
        counts, runs = whole(row["counts"], np.int64), whole(row["runs"], np.uint32)
        refs, contexts = whole(row["refs"], np.uint32), np.frombuffer(row["contexts"], np.uint64)
        context = np.repeat(np.arange(len(runs)), runs)
        tables = np.ones(len(counts))
        tables[counts > 1] = np.frombuffer(own["means"], np.float32)
        there = STRENGTH + np.bincount(context, counts, len(runs))
        back = (STRENGTH + discount * np.bincount(context, tables, len(runs))) / there
        kept = (counts - discount * tables) / there[context]
        often = np.flatnonzero((refs < len(held.value)) & (counts >= least))
        both = kept[often] + back[context[often]] * chances.value[refs[often]]
        keys = key_of(contexts[context[often]], held.value[refs[often]])
        values = (row["contexts"], row["runs"], row["refs"], row["rare"], blob(back), blob(kept.astype(np.float32)), blob(keys), blob(both))
        return pa.Table.from_arrays([pa.array([row["bucket"]], pa.int32()), *(pa.array([v], pa.binary()) for v in values)], [f.split()[0] for f in SHARES.split(", ")])

    pairs = restaurants.select("bucket", "contexts", "runs", "refs", "rare", "counts").groupBy("bucket")
    return stored(pairs.cogroup(state.select("bucket", "means").groupBy("bucket")).applyInArrow(finish, SHARES), "shares")
