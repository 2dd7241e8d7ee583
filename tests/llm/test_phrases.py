import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from postweave.llm import phrases, queries
from tests.compare import connect, differences
from tests.llm.brute import ASCII_LOWER

PIECE, WORD = re.compile("[.,;:!?\x0a-\x0d]"), re.compile("[^\x20\x09]+")


def brute(rows, least=100, top=2000, longest=5, swallowed=100):
    """rows: (lang, text)"""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split((text or "").translate(ASCII_LOWER)):
            w = WORD.findall(piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inner = Counter()
        for p, a in candidates.items():
            for s in range(2, len(p)):
                for i in range(len(p) - s + 1):
                    inner[p[i : i + s]] = max(inner[p[i : i + s]], a)
        found = []
        for p, a in candidates.items():
            if 100 * inner[p] >= swallowed * a:
                continue
            score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((" ".join(p), a, l, r, n[lang], score))
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, k + 1, *x) for k, x in enumerate(found[:top])]
    return sorted(out)


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def in_languages(spark, rows):
    return spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")


def test_sql_and_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    frame = queries.op13_phrase_collocations(spark, folder)
    assert differences(frame, connect(folder), phrases.COLLOCATIONS_SQL) == []
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").collect()
    assert rows_of(frame) == brute([tuple(r) for r in docs])


@pytest.mark.parametrize("trigger, bits", [(1, 1 << 20), (3, 1 << 12), (1 << 40, 1 << 16)])
def test_triggers_and_filters_change_nothing(spark, trigger, bits):
    rng = np.random.default_rng(trigger % 97)
    vocabulary = np.array("a b c d E é 42 x\x00y the of".split(" "))
    rows = [(["en", "de", None][k % 3], " ".join(rng.choice(vocabulary, rng.integers(0, 40))) + rng.choice([". ", "\t", "\n"]) + "a b c d") for k in range(150)]
    for options in ({"least": 5}, {"least": 3, "longest": 3, "top": 20, "swallowed": 60}):
        found = phrases.collocations(in_languages(spark, rows), trigger=trigger, filter_bits=bits, **options)
        assert rows_of(found) == brute(rows, **options)


def test_overlaps_are_counted_once():
    rng = np.random.default_rng(5)
    words = rng.integers(0, 2**63, 500).astype(np.uint64)[rng.integers(0, 30, 5000)]
    pieces = np.sort(rng.integers(0, 400, 5000))
    starts, ends, last = phrases.chunk_spans(words, pieces, 4)
    assert len(starts) > 800
    for k in range(1, 6):
        seen = Counter(i for a, b, z in zip(starts, ends, last) for i in range(a, b) if i + k <= b and (z or i < b - phrases.OVERLAP))
        expected = Counter(i for i in range(5000 - k + 1) if pieces[i] == pieces[i + k - 1])
        assert seen == expected


def test_hashes_keep_their_low_bits_and_languages_apart():
    keys = np.array([0, 1, (1 << 48) - 1, 0x123456789ABC], np.uint64)
    assert phrases._from_six(phrases._six(keys)).tolist() == keys.tolist()
    batch = pa.record_batch({"lang": ["en", "de"], "chunk": ["a b", "a b"], "last": [True, True], "times": [1, 1]})
    found = phrases.Chunks(batch)
    assert len(set(found.hashes(1).tolist())) == 4 and len(set(found.hashes(2)[[0, 2]].tolist())) == 2


def test_products_beyond_64_bits(spark):
    rows = [(10**12, 10**15, 3 * 10**13, 7 * 10**12), (123456789012345, 9999999999999999, 123456789012346, 123456789012347), (7, 3, 5, 11)]
    found = spark.createDataFrame(rows, "a long, n long, l long, r long").select(phrases.exact_score("a", "n", "l", "r")).collect()
    assert [r[0] for r in found] == [1000 * a * n // (l * r) for a, n, l, r in rows]


def test_hot_passage(spark):
    rows = [("en", "one very common passage of many words that all documents share")] * 400 + [("en", f"other {k} text") for k in range(300)]
    found = phrases.collocations(in_languages(spark, rows).repartition(13), filter_bits=1 << 20)
    assert rows_of(found) == brute(rows)


def test_awkward_rows(spark, awkward, nothing):
    rows = [tuple(r) for r in awkward.select("lang", "text").collect()]
    assert rows_of(phrases.collocations(awkward, least=2, filter_bits=1 << 20)) == brute(rows, least=2)
    assert phrases.collocations(nothing).collect() == []
