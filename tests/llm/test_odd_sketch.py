import random

import numpy as np
import pytest

from postweave.llm import odd_sketch
from postweave.llm.components import components
from tests.llm.brute import near_components


def check(docs, width, threshold):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    root, sizes = near_components(rows, width, round(100 * threshold))
    found = odd_sketch.near_duplicates(docs, width, threshold).collect()
    assert {f.doc_id: f.component_id for f in found} == root
    assert {f.doc_id: f.n_shingles for f in found} == sizes
    assert all(f.kept == (f.doc_id == f.component_id) for f in found) and len(found) == len(rows)
    return root


@pytest.mark.parametrize("width, threshold", [(3, 0.85), (5, 0.8)])
def test_given_table(spark, width, threshold):
    root = check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), width, threshold)
    assert len(set(root.values())) < len(root)


def family(seed, count, words, edits):
    """Texts made from each other by a few edits, so that many pairs are close to the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    out = []
    for _ in range(count):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(words)] = f"e{rng.randrange(10_000)}"
        out.append(" ".join(text))
        if rng.random() < 0.3:
            base = text
    return out


@pytest.mark.parametrize("seed", range(3))
def test_families_near_the_threshold(documents, monkeypatch, seed):
    monkeypatch.setattr(odd_sketch, "BLOCK", 16)
    texts = family(seed, 60, 120, 6) + family(seed + 50, 40, 40, 2) + ["a b", "A B", "a b c", "", None] + ["same text here now"] * 5
    check(documents(list(enumerate(texts))), 3, 0.85)


def test_awkward_rows(awkward):
    found = odd_sketch.near_duplicates(awkward).collect()
    assert len(found) == awkward.count()
    assert {f.component_id for f in found if f.doc_id == 5} == {5}
    assert {(f.n_shingles, f.component_id, f.kept) for f in found if f.doc_id in (1, 2, 3)} == {(0, 1, True), (0, 2, True), (0, 3, True)}


def test_no_rows(nothing):
    assert odd_sketch.near_duplicates(nothing).collect() == []


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    a, b = np.sort(pool[:950]), np.sort(pool[50:])
    signs = np.stack([odd_sketch.minhash(x, 120) for x in (a, b)])
    ones = int(np.bitwise_count(np.bitwise_xor(*odd_sketch.odd_sketches(signs))).sum())
    estimate = 1 + odd_sketch.BITS / (4 * 120) * np.log(1 - 2 * ones / odd_sketch.BITS)
    assert abs(estimate - 0.9) < 0.12
    assert ones <= odd_sketch.most_ones(0.85)


def test_bands():
    for threshold in (0.8, 0.85, 0.95):
        r = odd_sketch.band_rows(threshold)
        assert (1 - threshold**r) ** (120 // r) <= 1e-6


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(100)] + [(5, 5)]
    frame = spark.createDataFrame([(f"{a:04}".encode(), f"{b:04}".encode()) for a, b in edges], "u binary, v binary")
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    found = {int(bytes(r.node)): int(bytes(r.component)) for r in components(frame).collect()}
    assert found == {x: find(x) for x in root}


def test_thresholds_in_whole_percent():
    assert [odd_sketch.whole_percent(t) for t in (0.85, 0.29, 0.8, 1.0)] == [85, 29, 80, 100]
    with pytest.raises(ValueError):
        odd_sketch.whole_percent(0.855)
