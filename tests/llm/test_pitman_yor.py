import math
import zlib
from collections import Counter

import numpy as np
import pytest

from postweave.llm import pitman_yor
from postweave.llm.seating import Seating
from tests.llm.brute import lower_words


def tokens(text):
    return lower_words(text) + [None]


def expected(rows):
    """Counts and base scores by the definition."""
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    counts = Counter(w for d, t in rows if not held[d] for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        w = tokens(t)
        out.append((d, held[d], len(w), sum(x in counts for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)))
    return out


def check(rows, found):
    plain = lambda r: (r[0] is not None, r[0] or 0, r[2], round(r[5], 6))
    want, have = sorted(expected(rows), key=plain), sorted((tuple(r) for r in found), key=plain)
    assert [w[:5] for w in want] == [h[:5] for h in have]
    assert [w[5] for w in want] == pytest.approx([h[5] for h in have], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("share", [1e-6, 2e-4])
def test_given_table(spark, share):
    """The second share leaves most words and pairs to the buckets."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = pitman_yor.language_scores(docs, share).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], found)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for r in found)


def test_chances_add_up(spark, documents):
    """P(. | u) over all known words and the unseen one is 1, for contexts of every kind."""
    rng = np.random.default_rng(5)
    vocabulary = [f"w{k}" for k in range(60)]
    texts = [" ".join(rng.choice(vocabulary, 30, p=np.arange(1, 61)[::-1] / 1830)) for _ in range(60)]
    texts += ["of the sea of the sea of the sea"] * 5
    for share in (1e-6, 3e-3):
        model, words = pitman_yor.train(documents(list(enumerate(texts))).select("text"), 4, share)
        rows = words.collect()
        keys = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in rows])
        counts = np.concatenate([np.frombuffer(r.counts, np.int64) for r in rows])
        at = pitman_yor._at(model.words, keys)
        parent = np.where(at >= 0, model.alone[at], 10 ** model.rare(counts))
        unseen = 10 ** model.rare(np.array([0]))[0]
        assert parent.sum() + unseen == pytest.approx(1, abs=2e-4)
        for u in range(len(model.words)):
            pair = pitman_yor._at(model.pairs, pitman_yor._pair_keys(np.full(len(model.words), u), np.arange(len(model.words))))
            kept = model.kept[pair[pair >= 0]].sum()
            assert kept + model.back[u] == pytest.approx(1, abs=1e-9)
        assert len(model.words) < len(keys) or share == 1e-6


def test_seating_agrees_with_exact_numbers_of_tables():
    """One dish in each restaurant: the chance of t tables of n customers follows from a recursion."""
    n, d, s, p = 9, 0.4, 1.0, 0.35
    weight = {1: 1.0}
    for c in range(1, n):
        step = Counter()
        for t, w in weight.items():
            step[t] += w * (c - d * t)
            step[t + 1] += w * (s + d * t) * p
        weight = step
    mean = sum(t * w for t, w in weight.items()) / sum(weight.values())
    many = 20_000
    seating = Seating(np.arange(many), np.full(many, n), d, s, np.full(many, p), 3)
    for _ in range(150):
        seating.step(np.full(many, p))
    assert (np.bincount(seating.owner, seating.sizes, many) == n).all()
    assert seating.tables.mean() == pytest.approx(mean, abs=0.03)


@pytest.mark.parametrize("n, d, p, exact", [(3000, 0.7, 0.9, 4096), (3000, 0.9, 0.5, 4096), (3000, 0.7, 0.9, 512), (3000, 0.8, 0.02, 512)])
def test_seating_of_thousands_of_customers(n, d, p, exact, monkeypatch):
    """As above; with 512 the numbers for 3000 customers are carried on from those for 512."""
    monkeypatch.setattr("postweave.llm.seating.EXACT", exact)
    mean, spread = tables_of(n, d, 1.0, p)
    many = 1000
    seating = Seating(np.arange(many), np.full(many, n), d, 1.0, np.full(many, p), 3)
    for _ in range(60):
        seating.step(np.full(many, p))
    assert seating.tables.mean() == pytest.approx(mean, abs=0.2 * spread)
    assert seating.tables.std() == pytest.approx(spread, rel=0.1)


def tables_of(n, d, s, p):
    """Mean and deviation of t for one dish with n customers."""
    row = np.array([0.0])
    for c in range(1, n):
        t = np.arange(1, c + 1)
        stays, opens = np.append(row + np.log(c - d * t), -np.inf), np.append(-np.inf, row + np.log((s + d * t) * p))
        row = np.logaddexp(stays, opens)
    weight, t = np.exp(row - row.max()), np.arange(1, n + 1)
    mean = (t * weight).sum() / weight.sum()
    return mean, math.sqrt(((t - mean) ** 2 * weight).sum() / weight.sum())


def test_frequent_pairs_have_hundreds_of_tables():
    """A pair of 3000 customers beside 20,000 pairs of one: these are as so much more strength."""
    mean, _ = tables_of(3000, 0.8, 1 + 0.8 * 20_000, 0.03)
    restaurant, customers = np.repeat(np.arange(4), 20_001), np.tile(np.append(3000, np.ones(20_000, int)), 4)
    chance = np.tile(np.append(0.03, np.full(20_000, 4e-5)), 4)
    seating = Seating(restaurant, customers, 0.8, 1.0, chance, 1)
    found = []
    for k in range(30):
        seating.step(chance)
        found.append(seating.tables[::20_001])
    assert mean > 200 and np.mean(found[15:]) == pytest.approx(mean, rel=0.03)


def test_seatings_stay_whole():
    rng = np.random.default_rng(0)
    customers = np.minimum(rng.zipf(1.5, 3000), 50_000)
    seating = Seating(np.sort(rng.integers(0, 90, 3000)), customers, 0.7, 1.0, rng.random(3000), 1)
    for _ in range(30):
        seating.step(rng.random(3000))
    assert (np.bincount(seating.owner, seating.sizes, 3000) == customers).all() and (seating.sizes >= 0).all()
    assert (np.bincount(seating.owner, seating.sizes > 0, 3000) == seating.tables).all() and (seating.tables >= 1).all()


def test_mixing_is_undone():
    x = np.random.default_rng(1).integers(0, 2**63, 1000, dtype=np.uint64)
    assert (pitman_yor._unmix(pitman_yor.mix(x)) == x).all()


def test_awkward_rows(awkward, nothing):
    check([(r.doc_id, r.text) for r in awkward.collect()], pitman_yor.language_scores(awkward).collect())
    assert pitman_yor.language_scores(nothing).collect() == []


def test_nothing_to_learn_from(documents):
    held = [k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2][:3]
    found = pitman_yor.language_scores(documents([(k, "some words") for k in held])).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in found] == [(0, 0, 0.0)] * 3
    assert all(r.score == pytest.approx(0) for r in found)


def test_copies_score_better(documents):
    rng = np.random.default_rng(3)
    fresh = lambda: " ".join(f"w{rng.integers(3000)}" for _ in range(200))
    text = fresh()
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 7 == 2]
    rows = [(k, text if k % 3 == 0 else fresh()) for k in range(400) if k not in held] + [(held[0], text), (held[1], fresh())]
    found = {r.doc_id: r.score for r in pitman_yor.language_scores(documents(rows)).collect()}
    assert found[held[0]] > found[held[1]] + 100
