import zlib

import numpy as np
import pyarrow as pa
import pytest

from postweave.llm import quality


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    assert len(found) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (fold(d) == 0) for d, r in found.items())
    truth = [(found[r.doc_id], r.quality) for r in labels.collect() if fold(r.doc_id) == 0]
    assert np.mean([r.predicted == q for r, q in truth]) > 0.95
    good, bad = ([r.score for r, q in truth if q == k] for k in (1, 0))
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.97


def test_held_out_labels_and_other_columns_are_no_input(spark, documents):
    texts = [("good words in plain lines, as they come. " * (1 + k % 4), 1) if k % 2 else ("bad!!! ### " * (3 + k % 5), 0) for k in range(200)]
    docs = documents([(k, t) for k, (t, _) in enumerate(texts)])
    rows = [(k, q) for k, (_, q) in enumerate(texts)]
    flipped = [(k, 1 - q if fold(k) == 0 else q) for k, q in rows]
    make = lambda r: spark.createDataFrame(r, "doc_id long, quality int")
    once = sorted(quality.quality_scores(docs, make(rows)).collect())
    again = sorted(quality.quality_scores(docs.selectExpr("doc_id", "text", "'x' as source"), make(flipped)).collect())
    assert [(r.doc_id, round(r.score, 9)) for r in once] == [(r.doc_id, round(r.score, 9)) for r in again]
    assert np.mean([r.predicted == q for r, (_, q) in zip(once, texts)]) > 0.95


def test_normal_equations_are_sums_over_all_partitions(spark, documents):
    rng = np.random.default_rng(0)
    rows = [tuple(map(float, rng.normal(size=len(quality.STATISTICS)))) + (float(k % 2),) for k in range(500)]
    frame = spark.createDataFrame(rows, ", ".join(f"{s} double" for s in (*quality.STATISTICS, "label"))).repartition(20)
    model = quality.Model(np.zeros(len(quality.STATISTICS)), np.ones(len(quality.STATISTICS)))
    gram, target, n = quality.normal_equations(frame, model)
    data = np.array(rows)
    z = model.features(data[:, :-1])
    assert n == 500 and np.allclose(gram, z.T @ z) and np.allclose(target, z.T @ data[:, -1])


def test_features_approximate_a_gaussian_kernel():
    model = quality.Model(np.zeros(20), np.ones(20), features=4096)
    x = np.random.default_rng(2).normal(size=(30, 20))
    z = model.features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * quality.WIDTH**2))
    assert np.abs(z @ z.T - exact).max() < 0.08


@pytest.mark.parametrize("values, expected", [([1, 2, 3], [1, 2, 3]), ([3, 1], [2, 2]), ([0, 1, 0, 1], [0, 0.5, 0.5, 1]), ([], [])])
def test_pooling(values, expected):
    assert quality.pool_adjacent_violators(np.array(values, float), np.ones(len(values))).tolist() == expected


def test_statistics_do_not_depend_on_neighbours():
    texts = ["A b c. D!\nE f\nE f", None, "", " ", "é ü ß", "same same same", "x" * 5000, "a | b | c"]
    together = quality.statistics(pa.array(texts))
    for k, t in enumerate(texts):
        assert np.allclose(together[k], quality.statistics(pa.array([t], pa.string()))[0])
    named = dict(zip(quality.STATISTICS, together[0]))
    assert named["repeated_lines"] == pytest.approx(1 / 3) and named["distinct_words"] == pytest.approx(6 / 8)


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (2, None), (5, 0), (5, 0), (None, 1), (99, 1)], "doc_id long, quality int")
    found = quality.quality_scores(awkward, labels).collect()
    assert len(found) == awkward.count() and all(0 <= r.score <= 1 for r in found)
    none = quality.quality_scores(awkward, labels.limit(0)).collect()
    assert all(r.score == pytest.approx(0.5, abs=2e-3) for r in none)
    assert quality.quality_scores(nothing, labels).collect() == []
