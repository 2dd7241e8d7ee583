import zlib

from collections import Counter

import numpy as np
import pytest

from postweave.llm import pitman_yor, restaurants
from postweave.llm.restaurants import Bucket, Numbered, planes, whole


def texts_of(n, seed=2):
    rng = np.random.default_rng(seed)
    return [(k, " ".join(f"w{w}" for w in np.minimum(rng.zipf(1.4, 60), 400))) for k in range(n)]


def test_share_drops_no_pair(spark, documents):
    """The share decides where a number is looked up: rare pairs keep their discounted share whatever it is."""
    docs = documents(texts_of(300))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = [{r.doc_id: (r.n_known, r.score) for r in pitman_yor.language_scores(docs, share).collect()} for share in (1e-9, 5e-3, 2)]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    whole = found[0]
    for other in found[1:]:
        assert {d: k for d, (k, _) in other.items()} == {d: k for d, (k, _) in whole.items()}
        assert all(other[d][1] == pytest.approx(whole[d][1], abs=2.0) for d in whole)
        assert sum(s for _, s in other.values()) == pytest.approx(sum(s for _, s in whole.values()), rel=2e-3)


def test_scores_are_those_of_chains_over_all_pairs(documents):
    """With no share at all ``train`` samples every pair in chains within tasks: both give about the same chances."""
    rows = texts_of(300)
    docs = documents(rows)
    model, _ = pitman_yor.train(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 7 != 2").select("text"), 4, 1e-9)
    expected = 0.0
    found = {r.doc_id: r for r in pitman_yor.language_scores(docs, 5e-3).collect()}
    training = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 7 != 2]
    for _, text in (rows[k] for k in training):
        tokens, _ = pitman_yor.tokens_of(pitman_yor.pa.array([text]))
        word = pitman_yor._at(model.words, tokens)
        before = np.concatenate([pitman_yor._at(model.words, np.array([pitman_yor.END])), word[:-1]])
        pair = pitman_yor._at(model.pairs, pitman_yor._pair_keys(before, word))
        expected += np.log10(model.kept[pair] + model.back[before] * model.alone[word]).sum()
    assert sum(found[k].score for k in training) == pytest.approx(expected, rel=3e-3)


def test_all_chances_add_up(documents):
    """Of every context, also those that no task holds, kept shares and what goes back; and of words at the parent."""
    model, counts, tables, found = pitman_yor.learn(documents(texts_of(200)).select("text"), 4, 5e-3)
    contexts = pairs = 0
    for row in found.collect():
        runs, back = whole(row.runs, np.uint32).astype(int), np.frombuffer(row.back)
        kept = np.frombuffer(row.kept, np.float32).astype(float)
        assert np.add.reduceat(kept, np.cumsum(runs) - runs) + back == pytest.approx(np.ones(len(runs)), abs=1e-5)
        contexts, pairs = contexts + len(runs), pairs + len(kept)
    join = lambda frame: np.concatenate([np.frombuffer(r["counts"]) for r in frame.orderBy("bucket").collect()])
    assert contexts == len(join(counts)) > len(model.words) and pairs > len(model.often)
    assert (join(tables) <= join(counts) + 1e-3).all()
    assert model.parent(join(tables)).sum() + model.parent(np.zeros(1))[0] == pytest.approx(1, abs=1e-6)


def test_rows_of_a_bucket_are_added_up():
    import pyarrow as pa

    rng, held = np.random.default_rng(0), np.array([10, 20, 30], np.uint64)
    names = [f.split()[0] for f in "bucket int, contexts binary, runs binary, refs binary, rare binary, counts binary".split(", ")]
    rows, expected = [], {}
    for _ in range(3):
        tokens = rng.integers(1, 40, 50).astype(np.uint64)
        numbered = Numbered(tokens, np.uint64(7), held)
        keys, times = np.unique(numbered.keys(), return_counts=True)
        rows += numbered.pairs(keys).rows(1, times)
        for pair in zip([7, *tokens.tolist()[:-1]], tokens.tolist()):
            expected[pair] = expected.get(pair, 0) + 1
    table = pa.table(dict(zip(names, map(list, zip(*rows)))))
    counts = np.concatenate([whole(r[5], np.int64) for r in rows])
    pairs, sums = Bucket(table, len(held)).add_up(counts)
    words = np.concatenate([held, pairs.rare])[pairs.refs]
    assert dict(zip(zip(pairs.contexts[pairs.context].tolist(), words.tolist()), sums.tolist())) == expected


def test_planes_are_undone():
    x = np.random.default_rng(1).integers(0, 2**60, 99)
    assert (whole(planes(x), np.int64) == x).all() and len(whole(planes(x[:0]), np.int64)) == 0


def test_sums_are_added_up_before_they_are_dealt(spark):
    """A task sends a row to each bucket of words when it holds many sums, not one for each bucket of restaurants."""
    rng, rows, expected = np.random.default_rng(3), [], Counter()
    for _ in range(64):
        words = np.unique(rng.integers(0, 2**64, 300, np.uint64) & ~np.uint64(0xFFFFFFFFFFFFF))
        sums = rng.integers(0, 99, len(words)) / 4
        expected.update(dict(zip(words.tolist(), sums.tolist())))
        rows.append((bytearray(words.tobytes()), bytearray(sums.tobytes())))
    rows.append((bytearray(), bytearray()))
    state = spark.createDataFrame(rows, "words binary, sums binary").repartition(3)
    for held, most in ((1 << 21, 3 * 64), (1000, 25 * 64)):
        kept, restaurants.HELD_SUMS = restaurants.HELD_SUMS, held
        try:
            assert 64 <= restaurants._dealt_sums(state, 64).count() <= most
            tables = restaurants._tables_by_word(state, 64, restaurants._dealt_sums(state, 64)).collect()
        finally:
            restaurants.HELD_SUMS = kept
        found = {}
        for r in tables:
            keys = np.frombuffer(r["keys"], np.uint64)
            assert (keys >> np.uint64(58) == r.bucket).all() and (keys[1:] > keys[:-1]).all()
            found |= dict(zip(keys.tolist(), np.frombuffer(r["counts"]).tolist()))
            assert r.total == np.frombuffer(r["counts"]).sum()
        assert found == {w: 2 * s for w, s in expected.items()}


def test_words_have_buckets_by_the_size_of_texts(documents, monkeypatch):
    """Restaurants may have more: rows between the two do not grow with the square of their buckets, and results are the same."""
    docs = documents(texts_of(200)).select("text")
    found = {}
    for tokens in (1 << 22, 4000, 1):
        monkeypatch.setattr(pitman_yor, "WORD_TOKENS", tokens)
        model, words, tables, shares = pitman_yor.learn(docs, 16, 5e-3)
        sets = [sorted((r.bucket, bytes(r["keys"]), bytes(r["counts"])) for r in frame.collect()) for frame in (words, tables)]
        fewer = pitman_yor._word_buckets(model.tokens, 16)
        assert fewer == {1 << 22: 1, 4000: 4, 1: 16}[tokens] and [{b for b, _, _ in s} for s in sets] == [set(range(fewer))] * 2
        join = lambda s: [b"".join(r[k] for r in s) for k in (1, 2)]
        found[tokens] = [*map(join, sets), sorted(map(tuple, shares.collect())), model.parent_total]
    assert found[1] == found[4000] == found[1 << 22]
    assert np.frombuffer(found[1][0][1]).sum() == model.tokens
