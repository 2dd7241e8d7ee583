import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from postweave.llm import queries, spelling
from tests.llm.brute import ASCII_LOWER

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_counts(rows, noise=31, least=7):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def edits(a, b):
    """Whether b is a with one letter inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows, ratio=10, **options):
    n = brute_counts(rows, **options)
    sharing = defaultdict(set)
    for w in n:
        for key in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            sharing[key].add(w)
    near = defaultdict(set)
    for group in sharing.values():
        for a in group:
            near[a].update(b for b in group if b != a and edits(a, b))
    form = {}
    for w in n:
        best = min(near[w], key=lambda b: (-n[b], b), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def rows_of(frame):
    return [tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = rows_of(queries.op12_spelling_variants(spark, folder))
    assert len(found) == len(set(found)) and set(found) == brute([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("node_words", [0, 3, 100])
def test_more_coarse_groups_change_nothing(spark, small, node_words):
    expected = brute([tuple(r) for r in small.select("doc_id", "text").collect()], noise=None)
    assert set(rows_of(spelling.spelling_variants(small, node_words=node_words))) == expected


def test_edits_at_every_place_and_chains(spark, documents):
    word = "abéücdefg"
    kinds = [word[:k] + word[k + 1 :] for k in range(len(word))] + [word[:k] + "z" + word[k + 1 :] for k in range(len(word))]
    kinds += [word[:k] + "ÿ" + word[k:] for k in range(len(word) + 1)]
    chain = [("chainaaaa", 300), ("chainaaab", 30), ("chainaabb", 3)]
    texts = [" ".join([word] * 40)] + [f"{w}, {w}" for w in kinds] + [" ".join([w] * n) for w, n in chain]
    rows = list(enumerate(texts))
    found = {r[0]: r for r in rows_of(spelling.spelling_variants(documents(rows)))}
    assert set(found.values()) == brute(rows, noise=None)
    assert all(found[w][1] == word for w in kinds)
    assert found["chainaabb"][1:3] == ("chainaaab", "chainaaaa")


def test_near_pairs_of_many_equal_letters():
    rng = np.random.default_rng(0)
    # Few letters and long words: leaves with many words, counts beyond a byte, words beyond the compared width.
    words = {"".join(rng.choice(list("ab"), 9)) for _ in range(400)} | {"a" * k for k in range(250, 262)} | {"ab" * 20, "ab" * 19 + "bb", "ba" * 20}
    words |= {"".join(rng.choice(list("euà"), 34)) for _ in range(20)}
    words |= {w[:-1] for w in list(words)[:60]}
    words = sorted(words)
    expected = {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if edits(a, b)}
    for limit in (1 << 16, 4):
        spelling.LEAF_PAIRS, before = limit, spelling.LEAF_PAIRS
        try:
            (i, j), _ = spelling.near_pairs(pa.array(words), pa.array([], pa.string()))
            half = len(words) // 2
            _, (x, y) = spelling.near_pairs(pa.array(words[:half]), pa.array(words[half:]))
        finally:
            spelling.LEAF_PAIRS = before
        pairs = [tuple(sorted((words[a], words[b]))) for a, b in zip(i, j)]
        assert len(pairs) == len(set(pairs)) and set(pairs) == expected
        across = [(words[a], words[half + b]) for a, b in zip(x, y)]
        assert sorted(across) == sorted(p for p in expected if p[0] in words[:half] and p[1] in words[half:])


def test_checksums_of_spans():
    data = np.frombuffer(b"1:abc" + b"x" * 100 + b"\xc3\xa9", np.uint8)
    spans = [(2, 5), (5, 105), (105, 107), (3, 3)]
    before = np.array([zlib.crc32(b"7:")] * 4, np.uint32)
    found = spelling.crc32_spans(data, *map(np.array, zip(*spans)), before)
    assert found.tolist() == [zlib.crc32(b"7:" + data[a:b].tobytes()) for a, b in spans]


def test_hot_word(spark, documents):
    rows = [(k, "popular popular") for k in range(3000)] + [(k, f"populax{chr(97 + k % 26)} popula") for k in range(3000, 3100)]
    assert set(rows_of(spelling.spelling_variants(documents(rows).repartition(20), noise=31))) == brute(rows)


def test_awkward_rows(spark, awkward, nothing):
    rows = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    assert set(rows_of(spelling.spelling_variants(awkward, noise=31))) == brute(rows)
    assert spelling.spelling_variants(nothing, noise=31).collect() == []
