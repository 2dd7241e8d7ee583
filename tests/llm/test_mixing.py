import numpy as np
import pytest

from postweave.llm import mixing
from tests.llm.brute import words


def test_targets():
    assert mixing.targets([100, 100, 100]) == pytest.approx([200, 250 / 3, 500 / 3])
    assert mixing.targets([0, 10]) == [0, 15.0]
    assert mixing.targets([]) == []
    sizes = [10, 1000, 5, 0, 300, 70]
    goal = mixing.targets(sizes)
    assert sum(goal) == pytest.approx(1.5 * sum(sizes)) and all(g <= 2 * s + 1e-9 for g, s in zip(goal, sizes))


@pytest.mark.parametrize("shards", [1, 2, 7, 24])
def test_quotas_are_exact(shards):
    quotas = np.array([5, 0, 1000, 37])
    counts = mixing.split_quotas(quotas, shards, seed=3)
    assert (counts.sum(axis=0) == quotas).all()
    assert np.ptp(counts.sum(axis=1)) <= 1
    assert (counts == mixing.split_quotas(quotas, shards, seed=3)).all()


def check(rows, docs, near):
    found = mixing.mix_report(docs, shards=6).collect()
    assert len(found) == len(rows)
    sizes, taken, goal = {}, {}, {}
    for doc_id, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    expected = dict(zip(order, mixing.targets([sizes[s] for s in order])))
    assert sorted((str(f.doc_id), f.size) for f in found) == sorted((str(d), len(words(t))) for d, t, _ in rows)
    by_size = {}
    for f in found:
        assert f.taken <= 2 * f.size and len(f.shards) == f.copies and f.taken == f.size * f.copies
        by_size.setdefault((f.source_size, f.target), 0)
        by_size[f.source_size, f.target] += f.taken
    for (size, target), words_taken in by_size.items():
        assert any(sizes[s] == size and expected[s] == pytest.approx(target) for s in order)
        assert abs(words_taken - target) <= near * max(target, 1), (size, target, words_taken)
    return found


def test_small_table(spark, small):
    rows = [(r.doc_id, r.text, "one" if r.doc_id % 3 else "two") for r in small.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    once = check(rows, docs, 0.03)
    assert sorted(once) == sorted(check(rows, docs.repartition(5), 0.03))


def test_many_sources_and_a_hot_one(spark, documents):
    rows = [(k, "w " * (1 + k * 7919 % 300), None if k % 3 == 0 else f"s{k % 5}") for k in range(3000)]
    check(rows, documents(rows), 0.01)


@pytest.mark.parametrize("fraction, words_taken", [(0.49, 113_400), (0.75, 213_400)])
def test_long_documents_of_a_small_source(documents, fraction, words_taken):
    """3 texts of 100,000 words and 67 of 200; the other source is so large that the target is a fraction of this one."""
    rows = [(k, "w " * (100_000 if k < 3 else 200), "a") for k in range(70)]
    rows += [(100 + k, "w " * 10_000, "b") for k in range(200)]
    weight = fraction * 313_400 / (mixing.SHARE * 2_313_400)
    rows_ = mixing.mix_report(documents(rows), weights=(weight, 1 - weight), shards=3).collect()
    mine = [r for r in rows_ if r.doc_id < 70]
    assert mine[0].target == pytest.approx(fraction * 313_400)
    assert sum(r.taken for r in mine) == words_taken


def test_repeated_documents_land_apart(spark, small):
    docs = small.selectExpr("doc_id", "text", "'x' as source", "lang", "n_chars")
    rows = mixing.mixed_documents(docs, shards=5)
    assert rows.columns == docs.columns
    report = {r.doc_id: r.copies for r in mixing.mix_report(docs, shards=5).collect()}
    counts = {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert counts == {d: c for d, c in report.items() if c}


def test_awkward_rows(awkward):
    found = mixing.mix_report(awkward).collect()
    assert len(found) == awkward.count()
    assert mixing.mixed_documents(awkward).columns == awkward.columns


def test_no_rows(nothing):
    assert mixing.mix_report(nothing).collect() == []
    assert mixing.mixed_documents(nothing).collect() == []


def test_too_many_sources(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 2)
    with pytest.raises(ValueError):
        mixing.mix_report(documents([(1, "a", "x"), (2, "a", "y"), (3, "a", "z")]))
