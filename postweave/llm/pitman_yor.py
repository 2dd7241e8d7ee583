"""A hierarchical Pitman-Yor model of words, trained on all training documents.

A word follows its context, the word before it. The restaurant of a context has the words after it as customers;
contexts share one parent, the restaurant of all words, whose customers are the tables of the contexts. The parent's
base measure has no atoms: a word there has one table, and what is left goes to words that training has not seen.

    P(w | u) = (c_uw - d t_uw) / (s + c_u) + (s + d t_u) / (s + c_u) * P(w)
    P(w)     = (c_w - d0) / (s0 + c),  or  (s0 + d0 V) / (s0 + c) for an unseen word

Seatings of pairs are sampled by Gibbs steps in several chains, and the parts of P are averaged over samples.

All pairs take part, however rare: their counts and seatings lie in buckets by context (see ``restaurants``), the counts and
tables of words in buckets by word. Tables that every task needs hold words and pairs with at least a given share of all
training tokens, so at most 1 / share of each; what texts ask of the others goes to the buckets. The share only decides where a
number is looked up.

``train`` is the model of such heavy hitters alone, whole in memory: other pairs have one table a customer there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postweave.llm.batches import hash_words, mix, slabs, text_bytes
from postweave.llm.restaurants import STRENGTH, Bucket, at as _at, blob as _blob, bucket_bounds as _bucket_bounds
from postweave.llm.restaurants import Numbered, count_pairs, discard, in_buckets, looked_up, of_held, own_list, planes, seated, shares, whole
from postweave.llm.seating import Seating
from postweave.plans.storage import stored

SHARE = 1e-6
PARENT_STRENGTH = 1.0
CHAINS, BURN_IN, SAMPLES = 4, 15, 15
FOLDS, HELD_OUT = 7, 2
END = np.uint64(0xA0761D6478BD642F)
# Tokens whose counts a task adds up before it sends them on.
HELD_TOKENS = 1 << 22
# The same of tokens whose pairs are counted, with several numbers each.
HELD_PAIRS = 1 << 21
# Bytes of text that ask the buckets together: the more, the fewer pairs are asked twice.
ASKING_BYTES = 8 << 20
# Training tokens for each bucket of words.
WORD_TOKENS = 1 << 22
# Parts of the documents that are scored one after another, so that what they ask and are answered is on disk for one at a time.
PARTS = 4

COUNTS = "bucket int, keys binary, counts binary"


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end after each text, and where each text begins."""
    words, bounds = hash_words(*text_bytes(column))
    return np.insert(words, bounds[1:], END), bounds + np.arange(len(bounds))


def _counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and their counts or sums of counts."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    order = None if counts is None else np.argsort(keys)
    keys = np.sort(keys) if order is None else keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    if order is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts[order], first)


def _send_counts(held: list[np.ndarray], buckets: int) -> Iterator[pa.RecordBatch]:
    """COUNTS of the keys held, which are let go."""
    keys = np.concatenate(held)
    held.clear()
    keys, counts = _counted(keys)
    bounds = _bucket_bounds(keys, buckets)
    rows = [(k, _blob(keys[a:b]), _blob(counts[a:b].astype(np.uint32))) for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if b > a]
    if rows:
        bucket, key, count = map(list, zip(*rows))
        yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(key, pa.binary()), pa.array(count, pa.binary())], ["bucket", "keys", "counts"])


def _count_in_tasks(texts: DataFrame, keys_of, buckets: int) -> DataFrame:
    """COUNTS of what ``keys_of`` makes of each slab of texts; counts are added up within tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slabs(batches):
            held.append(keys_of(batch.column("text")))
            size += len(held[-1])
            if size >= HELD_TOKENS:
                yield from _send_counts(held, buckets)
                size = 0
        if held:
            yield from _send_counts(held, buckets)

    return texts.mapInArrow(count, COUNTS)


def _sums(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist())])
    counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(c, np.uint32).astype(np.int64) for c in table.column("counts").to_pylist())])
    return _counted(keys, counts)


def _gathered(parts: DataFrame, least: float = 0) -> DataFrame:
    """One row for each bucket: its keys with a count of at least ``least`` and these counts (64 bits); and of all
    its keys their number, the sum of counts, and how many counts are one and two."""

    def gather(table: pa.Table) -> pa.Table:
        keys, counts = _sums(table)
        kept = counts >= least
        return pa.table(
            {
                "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()),
                "keys": pa.array([_blob(keys[kept])], pa.binary()),
                "counts": pa.array([_blob(counts[kept])], pa.binary()),
                "distinct": [len(keys)],
                "total": [int(counts.sum())],
                "ones": [int((counts == 1).sum())],
                "twos": [int((counts == 2).sum())],
            }
        )

    return parts.groupBy("bucket").applyInArrow(gather, COUNTS + ", distinct long, total long, ones long, twos long")


def _heavy(gathered: DataFrame, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys with a count of at least ``least``: at most (all counts) / least of them."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
                counts = np.frombuffer(counts, np.int64)
                some = counts >= least
                if some.any():
                    yield pa.RecordBatch.from_pydict({"keys": [_blob(np.frombuffer(keys, np.uint64)[some])], "counts": [_blob(counts[some])]})

    rows = gathered.select("keys", "counts").mapInArrow(select, "keys binary, counts binary").collect()
    keys = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["keys"], np.uint64) for r in rows)])
    counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r["counts"], np.int64) for r in rows)])
    order = np.argsort(keys)
    return keys[order], counts[order]


# Pair keys are mixed, so that buckets by their leading bits are even; mixing is a bijection.
def _pair_keys(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix((context.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64))


def _discount(ones: int, twos: int) -> float:
    """From the numbers of keys seen once and twice."""
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5


class Model:
    """The tables every task needs, as arrays: heavy words, contexts' shares for the parent, heavy pairs."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, tokens: int, distinct: int, discount: float):
        self.words, self.counts = words, counts
        self.tokens, self.distinct, self.discount = tokens, distinct, discount
        self.back = np.ones(len(words))
        self.alone = np.maximum(counts - discount, 0) / (PARENT_STRENGTH + max(tokens, 1))
        self.parent_total = PARENT_STRENGTH + tokens
        self.pairs, self.kept = np.zeros(0, np.uint64), np.zeros(0)
        # Hashes of frequent pairs and their chances, where all pairs have a seating (see ``learn``).
        self.often, self.chances = np.zeros(0, np.uint64), np.zeros(0)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + self.distinct + 1))

    def parent(self, tables: np.ndarray) -> np.ndarray:
        """P(w) by the number of a word's tables."""
        unseen = PARENT_STRENGTH + self.discount * self.distinct
        return np.where(tables > 0, tables - self.discount, unseen) / self.parent_total

    def rare(self, counts: np.ndarray) -> np.ndarray:
        """log10 P(w) of words whose customers sit alone, by their training count."""
        return np.log10(self.parent(counts))


def _chain(seed: int, context, word, customers, counts, tokens: int, discount: float, parent_discount: float):
    """Means over the samples of one chain: kept share of each pair, share of each context for the parent, P(w), total of the parent."""
    own, restaurant = np.unique(context, return_inverse=True)
    at_parent = counts - np.bincount(word, customers, len(counts))
    other = counts[own] - np.bincount(restaurant, customers, len(own))

    def parent(tables):
        there = at_parent + np.bincount(word, tables, len(counts))
        total = PARENT_STRENGTH + tokens - (customers - tables).sum()
        return np.maximum(there - parent_discount, 1e-3) / total, total

    chance, total = parent(np.ones(len(customers)))
    seating = Seating(restaurant, customers, discount, STRENGTH, chance[word], seed)
    chance, total = parent(seating.tables)
    sums = [np.zeros(len(customers)), np.zeros(len(own)), np.zeros(len(counts)), 0.0]
    for k in range(BURN_IN + SAMPLES):
        seating.step(chance[word])
        chance, total = parent(seating.tables)
        if k >= BURN_IN:
            there = STRENGTH + counts[own]
            sums[0] += (customers - discount * seating.tables) / there[restaurant]
            sums[1] += (STRENGTH + discount * seating.tables_of_restaurants() + other) / there
            sums[2] += chance
            sums[3] += 1 / total
    return own, *(s / SAMPLES for s in sums)


def _sampled(spark: SparkSession, model: Model, context, word, customers, discount: float, seed: int) -> None:
    """Run the chains as tasks and put their means into ``model``."""
    data = spark.sparkContext.broadcast((context, word, customers, model.counts, model.tokens, discount, model.discount))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                _, kept, back, chance, inverse = _chain(seed * 1000 + k, *data.value)
                yield pa.RecordBatch.from_pydict(
                    {"kept": [_blob(kept)], "back": [_blob(back)], "chance": [_blob(chance)], "inverse": [float(inverse)]}
                )

    chains = spark.range(CHAINS).repartition(CHAINS, "id").mapInArrow(run, "kept binary, back binary, chance binary, inverse double")
    rows = chains.collect()
    mean = lambda name: sum(np.frombuffer(r[name]) for r in rows) / len(rows)
    model.kept, model.alone = mean("kept"), mean("chance")
    model.back[np.unique(context)] = mean("back")
    model.parent_total = len(rows) / sum(r.inverse for r in rows)
    data.unpersist()


def _power_of_two(n: int) -> int:
    return 1 << max(0, (n - 1).bit_length())


def _vocabulary(texts: DataFrame, buckets: int, share: float) -> tuple[Model, DataFrame, float]:
    """A model without pairs, the counts of all words by bucket, and the least count of words that every task holds."""
    words = stored(_gathered(_count_in_tasks(texts, lambda column: tokens_of(column)[0], buckets)), "word-counts")
    sums = words.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "distinct", "ones", "twos"))).first()
    least = max(1.0, share * sums.total)
    return Model(*_heavy(words, least), sums.total, sums.distinct, _discount(sums.ones, sums.twos)), words, least


def train(texts: DataFrame, buckets: int, share: float = SHARE, seed: int = 0) -> tuple[Model, DataFrame]:
    """The model of heavy hitters alone of the column ``text``, and the counts of all its words by bucket."""
    spark = texts.sparkSession
    model, words, least = _vocabulary(texts, buckets, share)
    heavy = model.words
    if not len(heavy):
        return model, words

    table = spark.sparkContext.broadcast(heavy)

    def pairs_of(column: pa.Array) -> np.ndarray:
        """Pairs of heavy words; a pair with another word is no heavy hitter."""
        at = _at(table.value, tokens_of(column)[0])
        before = np.concatenate([_at(table.value, np.array([END])), at[:-1]])
        both = (at >= 0) & (before >= 0)
        return _pair_keys(before[both], at[both])

    pairs = stored(_gathered(_count_in_tasks(texts, pairs_of, buckets), least), "pair-counts")
    seen = pairs.agg(F.sum("ones").alias("ones"), F.sum("twos").alias("twos")).first()
    model.pairs, customers = _heavy(pairs, least)
    if len(customers):
        plain = _unmix(model.pairs)
        context, word = (plain >> np.uint64(32)).astype(np.int64), (plain & np.uint64(0xFFFFFFFF)).astype(np.int64)
        _sampled(spark, model, context, word, customers, _discount(seen.ones, seen.twos), seed)
    return model, words


def _unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    def unshift(x, s):
        y = x
        for _ in range(64 // s):
            y = x ^ (y >> np.uint64(s))
        return y

    x = unshift(x, 31) * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = unshift(x, 27) * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return unshift(x, 30)


def _pair_hashes(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(context * np.uint64(0x9E3779B97F4A7C15) + word)


def _word_buckets(tokens: int, buckets: int) -> int:
    """In how many buckets the words are: by the texts' size, and at most as many as the restaurants have."""
    return min(buckets, _power_of_two(-(-tokens // WORD_TOKENS)))


def _as_doubles(words: DataFrame, buckets: int, fewer: int) -> DataFrame:
    """The counts as doubles, in fewer buckets: each takes up neighbours of the former ones."""

    def convert(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("bucket", "keys", "counts"))))
        counts = _blob(np.concatenate([np.frombuffer(c, np.int64) for _, _, c in rows]).astype(np.float64))
        values = [pa.array([rows[0][0] // (buckets // fewer)], pa.int32()), pa.array([b"".join(k for _, k, _ in rows)], pa.binary()), pa.array([counts], pa.binary())]
        return pa.Table.from_arrays(values, ["bucket", "keys", "counts"])

    whole_bucket = F.floor(F.col("bucket") / (buckets // fewer))
    return words.select("bucket", "keys", "counts").groupBy(whole_bucket).applyInArrow(convert, COUNTS)


def learn(texts: DataFrame, buckets: int, share: float = SHARE, seed: int = 0) -> tuple[Model, DataFrame, DataFrame, DataFrame]:
    """The model of all pairs of the column ``text``: what every task holds; by bucket the counts and the tables of all words, as
    doubles; and the SHARES of all contexts and pairs."""
    spark = texts.sparkSession
    model, counts, least = _vocabulary(texts, buckets, share)
    fewer = _word_buckets(model.tokens, buckets)
    words = stored(_as_doubles(counts, buckets, fewer), "word-counts")
    discard(counts)
    held = spark.sparkContext.broadcast(model.words)

    counted = count_pairs(texts, lambda column: tokens_of(column)[0], END, held, buckets, HELD_PAIRS)
    restaurants = stored(counted, "restaurants")
    seen = restaurants.agg(F.sum("ones").alias("ones"), F.sum("twos").alias("twos")).first()
    discount, parent_discount = _discount(seen.ones, seen.twos), model.discount

    def parent(tables: np.ndarray, total: float) -> np.ndarray:
        return np.maximum(tables - parent_discount, 1e-3) / (PARENT_STRENGTH + total)

    state, tables, total = seated(restaurants, words, model.tokens, held, discount, parent, fewer, seed)
    model.parent_total = PARENT_STRENGTH + total
    model.alone = parent(of_held(tables, held), total)
    found = shares(restaurants, state, held, spark.sparkContext.broadcast(model.alone), discount, least, _pair_hashes)
    for frame in (restaurants, state):
        discard(frame)
    rows = found.select("often", "chances").collect()
    often = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r.often, np.uint64) for r in rows)])
    order = np.argsort(often)
    model.often, model.chances = often[order], np.concatenate([np.zeros(0), *(np.frombuffer(r.chances) for r in rows)])[order]
    return model, words, tables, found


_PAIR_REQUEST = "struct<bucket:int,contexts:binary,runs:binary,refs:binary,rare:binary>"
_PAIR_TYPE = pa.struct([("bucket", pa.int32()), *((c, pa.binary()) for c in ("contexts", "runs", "refs", "rare"))])


def _row_type(rows: int) -> type:
    return np.uint16 if rows <= 1 << 16 else np.uint32


def _asked(docs: DataFrame, model: Model, buckets: int) -> DataFrame:
    """One row for each slab of documents: sums over what every task holds, and the other pairs, which are asked of the buckets.

    ``row`` holds the row of each other token, in the order of its pair, and ``times`` how many belong to a pair; ``far`` and
    ``word`` the places of pairs whose word is asked, too, and of that word.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"slab long, doc_id array<{kind}>, held_out array<boolean>, n_tokens binary, n_known binary, base binary, score binary,"
        f" row binary, times binary, far binary, word binary, pairs array<{_PAIR_REQUEST}>, words array<struct<bucket:int,keys:binary>>"
    )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        m, part = held.value, TaskContext.get().partitionId()
        for number, batch in enumerate(slabs(batches, limit=ASKING_BYTES)):
            tokens, bounds = tokens_of(batch.column("text"))
            rows = batch.num_rows
            row = np.repeat(np.arange(rows), np.diff(bounds))
            numbered = Numbered(tokens, END, m.words)
            at = numbered.place[numbered.number]
            known = at >= 0
            base = np.zeros(len(tokens))
            base[known] = m.base(m.counts[at[known]])
            keys, own = np.unique(numbered.keys(), return_inverse=True)
            example = np.empty(len(keys), np.int64)
            example[own] = np.arange(len(own))
            pair = _at(m.often, _pair_hashes(numbered.names[numbered.before[example]], tokens[example]))
            log_chance = np.zeros(len(keys))
            log_chance[pair >= 0] = np.log10(m.chances[pair[pair >= 0]])
            other = np.flatnonzero((pair < 0)[own])
            by_pair = other[np.argsort(own[other], kind="stable")]
            pairs = numbered.pairs(keys[pair < 0])
            pairs.refs, pairs.rare = own_list(pairs.refs, pairs.rare, len(m.words))
            far = np.flatnonzero(pairs.refs >= len(m.words))
            places = [
                row[by_pair].astype(_row_type(rows)),
                np.bincount(own, minlength=len(keys))[pair < 0].astype(np.uint32),
                far.astype(np.uint32),
                (pairs.refs[far] - np.uint32(len(m.words))).astype(np.uint32),
            ]
            sums = [
                np.diff(bounds).astype(np.float64),
                np.bincount(row, known, rows),
                np.bincount(row, base, rows),
                np.bincount(row, log_chance[own], rows),
            ]
            words = in_buckets(pairs.rare, _word_buckets(m.tokens, buckets))
            asked = [dict(zip(_PAIR_TYPE.names, r)) for r in pairs.rows(buckets, np.zeros(len(pairs.refs), np.uint8))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) | number]),
                    _as_list(batch.column("doc_id")),
                    _as_list(batch.column("held_out")),
                    *(pa.array([_blob(s)], pa.binary()) for s in sums),
                    *(pa.array([planes(s)], pa.binary()) for s in places),
                    pa.array([asked], pa.list_(_PAIR_TYPE)),
                    pa.array([words], pa.list_(pa.struct([("bucket", pa.int32()), ("keys", pa.binary())]))),
                ],
                names=["slab", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "row", "times", "far", "word", "pairs", "words"],
            )

    return docs.mapInArrow(ask, schema)


def _as_list(column: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)


def _pair_answers(asked: DataFrame, found: DataFrame, model: Model) -> DataFrame:
    """(slab, bucket, found, back), in the order asked: P(w | u) of pairs with a word that every task holds; of others the
    kept share, and in ``back`` what goes to the parent."""
    held = asked.sparkSession.sparkContext.broadcast(model.alone)
    requests = asked.select("slab", F.explode("pairs").alias("p")).select("slab", "p.*")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        chances = held.value
        table = Bucket(right, len(chances))
        back, kept = (
            np.concatenate([np.zeros(0), *(np.frombuffer(b, t) for b in right.column(c).to_pylist())]) for c, t in (("back", np.float64), ("kept", np.float32))
        )
        values, backs = [], []
        for contexts, runs, refs, rare in zip(*(left.column(c).to_pylist() for c in ("contexts", "runs", "refs", "rare"))):
            context = np.repeat(_at(table.contexts, np.frombuffer(contexts, np.uint64)), whole(runs, np.uint32))
            ref = whole(refs, np.uint32).astype(np.int64)
            far = ref >= len(chances)
            its_chance = np.where(far, 0.0, chances[np.where(far, 0, ref)] if len(chances) else 0.0)
            there = _at(table.rare, np.frombuffer(rare, np.uint64))[ref[far] - len(chances)]
            ref[far] = np.where(there >= 0, len(chances) + there, -1)
            pair = _at(table.keys, (context.astype(np.uint64) << np.uint64(32)) | ref.astype(np.uint64))
            pair[(context < 0) | (ref < 0)] = -1
            share = np.where(context >= 0, back[context] if len(back) else 1.0, 1.0)
            value = np.where(pair >= 0, kept[pair] if len(kept) else 0.0, 0.0) + share * its_chance
            values.append(_blob(value.astype(np.float32)))
            backs.append(_blob(share[far].astype(np.float32)))
        return pa.Table.from_arrays([left.column("slab"), left.column("bucket"), pa.array(values, pa.binary()), pa.array(backs, pa.binary())], ["slab", "bucket", "found", "back"])

    right = found.select("bucket", "contexts", "runs", "refs", "rare", "back", "kept").groupBy("bucket")
    return requests.groupBy("bucket").cogroup(right).applyInArrow(answer, "slab long, bucket int, found binary, back binary")


def _finished(asked: DataFrame, answers: DataFrame, model: Model, doc_type: str) -> DataFrame:
    """One row for each document. ``answers`` are those of pairs and, of words, counts and tables: ``kind`` 0, 1 and 2."""
    small = Model(np.zeros(0, np.uint64), np.zeros(0), model.tokens, model.distinct, model.discount)
    small.parent_total = model.parent_total

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds, buckets = (right.column(c).to_numpy() for c in ("kind", "bucket"))

        def joined(kind: int, column: str, dtype) -> np.ndarray:
            own = np.flatnonzero(kinds == kind)
            parts = right.column(column).take(pa.array(own[np.argsort(buckets[own])])).to_pylist()
            return np.concatenate([np.zeros(0), *(np.frombuffer(p, dtype) for p in parts)])

        one = {c: left.column(c)[0] for c in left.column_names}
        sums = {c: np.frombuffer(one[c].as_py()) for c in ("n_tokens", "n_known", "base", "score")}
        rows = len(sums["n_tokens"])
        times, far, word = (whole(one[c].as_py(), np.uint32) for c in ("times", "far", "word"))
        row = whole(one["row"].as_py(), _row_type(rows)).astype(np.int64)
        counts, tables = joined(1, "found", np.float64), joined(2, "found", np.float64)
        chance = joined(0, "found", np.float32)
        chance[far] += joined(0, "back", np.float32) * small.parent(tables)[word]
        base, known = np.zeros(len(times)), np.zeros(len(times))
        base[far], known[far] = small.base(counts)[word], (counts > 0)[word]
        add = lambda values: np.bincount(row, np.repeat(values, times), rows)
        return pa.table(
            {
                "doc_id": left.column("doc_id").combine_chunks().flatten(),
                "held_out": left.column("held_out").combine_chunks().flatten(),
                "n_tokens": sums["n_tokens"].astype(np.int64),
                "n_known": (sums["n_known"] + add(known)).astype(np.int64),
                "base_score": sums["base"] + add(base),
                "score": sums["score"] + add(np.log10(chance)),
            }
        )

    slabs_ = asked.drop("pairs", "words").groupBy("slab").cogroup(answers.groupBy("slab"))
    schema = f"doc_id {doc_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return slabs_.applyInArrow(finish, schema)


def _scored(docs: DataFrame, model: Model, words: DataFrame, tables: DataFrame, found: DataFrame, buckets: int, doc_type: str) -> DataFrame:
    """One stored row for each document; what was asked is deleted."""
    asked = stored(_asked(docs, model, buckets), "asked")
    requests = asked.select("slab", F.explode("words").alias("w")).select("slab", "w.*")
    answers = _pair_answers(asked, found, model).withColumn("kind", F.lit(0))
    for kind, table in ((1, words), (2, tables)):
        answers = answers.unionByName(looked_up(requests, table).withColumns({"back": F.lit(None).cast("binary"), "kind": F.lit(kind)}))
    out = stored(_finished(asked, answers, model, doc_type), "scores")
    discard(asked)
    return out


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves HELD_OUT modulo FOLDS; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def language_scores(docs: DataFrame, share: float = SHARE, seed: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Tokens are the words, A-Z lower-cased, and one end. Null texts are empty: the end alone. Null ids
    are not held out. Equal rows have equal scores. Without training rows every token is unseen.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out(F.col(doc_id)).alias("held_out"))
    buckets = _power_of_two(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    model, words, tables, found = learn(plain.where(~F.col("held_out")).select("text"), buckets, share, seed)
    kind = docs.schema[doc_id].dataType.simpleString()
    scored = []
    for k in range(PARTS):
        part = plain.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(PARTS)) == k)
        scored.append(_scored(part, model, words, tables, found, buckets, kind))
    for frame in (words, tables, found):
        discard(frame)
    out = reduce(DataFrame.unionByName, scored)
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
