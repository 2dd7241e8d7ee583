import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from postweave.llm import queries, toxic_spans
from postweave.llm.toxic_spans import Field, Words


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


TEXTS = ["You fool, you", None, "", "  .\n", "one", "É üß same same same x1 THE end", "a b c d e"]


def some_field(seed=0, scale=1.0):
    rng = np.random.default_rng(seed)
    return Field(np.concatenate([rng.normal(size=toxic_spans.SLOTS) * scale, [-1.0, 0.5]]))


def taggings(field, words, k):
    """Weights of all taggings of text k."""
    slots = words.slots[words.at[k] : words.at[k + 1]]
    e = field.weights[:-2][slots].sum(axis=1)
    out = {}
    for tags in itertools.product((0, 1), repeat=len(slots)):
        total = sum(e[i] + field.weights[-1 if i and tags[i - 1] else -2] for i, t in enumerate(tags) if t)
        out[tags] = np.exp(total)
    return out


def test_marginals_against_all_taggings():
    words = Words(pa.array(TEXTS))
    field = some_field(scale=0.5)
    chance, score = field.marginals(words.slots, words.at)
    for k in range(len(TEXTS)):
        weights = taggings(field, words, k)
        z = sum(weights.values())
        assert score[k] == pytest.approx(1 - 1 / z, abs=1e-9)
        for i in range(words.at[k + 1] - words.at[k]):
            assert chance[words.at[k] + i] == pytest.approx(sum(w for t, w in weights.items() if t[i]) / z, abs=1e-9)


def test_loss_and_gradient():
    words, toxic, share = Words(pa.array(TEXTS)), np.array([1, 0, 0, 0, 1, 1, 0]) == 1, np.array([1, 2, 1, 1, 3, 0.5, 1.0])
    field = some_field(1, 0.4)
    value, gradient = field.loss(words.slots, words.at, toxic, share)
    expected = 0
    for k in range(len(TEXTS)):
        z = sum(taggings(field, words, k).values())
        expected -= share[k] * (np.log(1 - 1 / z) if toxic[k] else np.log(1 / z))
    assert value == pytest.approx(expected)
    for at in [*np.unique(words.slots)[::11], toxic_spans.SLOTS, toxic_spans.SLOTS + 1]:
        moved = [Field(field.weights.copy()) for _ in range(2)]
        moved[0].weights[at] += 1e-5
        moved[1].weights[at] -= 1e-5
        a, b = (m.loss(words.slots, words.at, toxic, share)[0] for m in moved)
        assert gradient[at] == pytest.approx((a - b) / 2e-5, abs=1e-5)


def test_lanes_do_not_show():
    rng = np.random.default_rng(3)
    enter, stay = np.exp(rng.normal(size=(2, 1000)) * 3)
    stay[0] = enter[0]
    forward, backward = toxic_spans.ratios(enter, stay)
    r, q = 0.0, 1.0
    for k in range(1000):
        r = (enter[k] + r * stay[k]) / (1 + r)
        assert forward[k] == pytest.approx(r)
    for k in range(999, -1, -1):
        assert backward[k] == pytest.approx(q)
        q = (1 + stay[k] * q) / (1 + enter[k] * q)


def test_minimiser():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(30, 30))
    a = a @ a.T + np.eye(30)
    b = rng.normal(size=30)
    x = toxic_spans.minimised(np.zeros(30), lambda v: (v @ a @ v / 2 - b @ v, a @ v - b), steps=200, gain=1e-12)
    assert np.allclose(x, np.linalg.solve(a, b), atol=1e-3)


def test_sums_over_partitions(spark):
    rows = [(t, k % 3 == 0, 1.0 + k) for k, t in enumerate(TEXTS * 3)]
    words = toxic_spans._stored_words(spark.createDataFrame(rows, "text string, toxic boolean, share double").repartition(5))
    field = some_field(2, 0.3)
    together = Words(pa.array([r[0] for r in rows]))
    value, gradient = field.loss(together.slots, together.at, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
    found = toxic_spans._summed(words, toxic_spans.SLOTS + 3, lambda *texts: np.append(*field.loss(*texts)[::-1]))
    assert found[-1] == pytest.approx(value) and np.allclose(found[:-1], gradient)
    counts = toxic_spans._summed(words, 3 * toxic_spans.SLOTS + 3, toxic_spans._texts_of_slots)
    assert np.allclose(counts, toxic_spans._texts_of_slots(together.slots, together.at, *(np.array([r[k] for r in rows]) for k in (1, 2))))


def test_held_out_accuracy_and_columns(spark):
    folder = "/root/testdata/sf0.1"
    found = {r.doc_id: r for r in queries.op11_toxic_spans(spark, folder).collect()}
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    assert len(found) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (fold(d) == 2) for d, r in found.items())
    truth = [(found[r.doc_id], r.toxic) for r in labels.collect() if fold(r.doc_id) == 2]
    hits = sum(r.predicted and y for r, y in truth)
    assert hits / sum(y for _, y in truth) > 0.85 and hits / sum(r.predicted for r, _ in truth) > 0.85


def planted(n):
    clean = "the quiet river runs past old houses and a small green garden by night".split()
    rng = np.random.default_rng(7)
    rows = []
    for k in range(n):
        words = list(rng.choice(clean, 12))
        toxic = k % 4 == 0
        if toxic:
            words[3:3] = ["Vile" + rng.choice(["st", "ly", "", "ness"]), rng.choice(["rotter", "crook"])]
        rows.append((k, "Né " + " ".join(words) + ".", int(toxic)))
    return rows


def test_spans_and_what_is_learned_from(spark, documents):
    rows = planted(400)
    docs = documents([(k, t) for k, t, _ in rows])
    make = lambda flip: spark.createDataFrame([(k, 1 - y if flip and fold(k) == 2 else y) for k, _, y in rows], "doc_id long, toxic int")
    once = {r.doc_id: r for r in toxic_spans.toxicity_scores(docs, make(False)).collect()}
    again = {r.doc_id: r for r in toxic_spans.toxicity_scores(docs.selectExpr("doc_id", "text", "'x' as lang"), make(True)).collect()}
    for k, text, y in rows:
        assert once[k].predicted == y and once[k].score == pytest.approx(again[k].score, abs=1e-6)
        marked = [text[s.start : s.end] for s in once[k].spans]
        assert bool(marked) == bool(y)
        assert all(m.startswith("Vile") or m in ("rotter", "crook") for m in marked)


def test_sample_is_bounded_and_weighted(spark, documents):
    docs = documents([(k % 50 if k > 300 else k, f"text {k}") for k in range(1000)])
    labels = spark.createDataFrame([(k, k % 5 == 0) for k in range(300)], "doc_id long, toxic boolean")
    rows = toxic_spans.sampled(docs, labels, 20).collect()
    assert 20 < sum(r.toxic for r in rows) < 70 and 20 < sum(not r.toxic for r in rows) < 70
    assert 30 < sum(r.share for r in rows if r.toxic) < 100 and 120 < sum(r.share for r in rows if not r.toxic) < 400


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (2, None), (5, 0), (5, 1), (None, 1), (99, 1)], "doc_id long, toxic int")
    found = toxic_spans.toxicity_scores(awkward, labels).collect()
    assert len(found) == awkward.count() and all(0 <= r.score <= 1 for r in found)
    none = toxic_spans.toxicity_scores(awkward, labels.limit(0)).collect()
    assert all(r.predicted == 0 and r.spans == [] for r in none if r.doc_id != 6)
    assert toxic_spans.toxicity_scores(nothing, labels).collect() == []
