import tracemalloc

import numpy as np

from postweave.llm import batches
from postweave.llm.batches import hash_spans, word_spans


def test_hashes_do_not_depend_on_where_sums_begin(monkeypatch):
    data = np.random.default_rng(0).integers(97, 123, 5000).astype(np.uint8)
    data[::7] = 32
    data[1000:2000] = 97
    spans = word_spans(data, np.array([0, 10, 10, 700, 5000]))
    whole = hash_spans(data, *spans)
    monkeypatch.setattr(batches, "HASH_BYTES", 64)
    assert (hash_spans(data, *spans) == whole).all() and len(hash_spans(data, *(s[:0] for s in spans))) == 0
    one = [sum((int(x) + 1) * batches.BASE**k for k, x in enumerate(data[a:b])) + (b - a) * int(batches.LENGTH) for a, b in zip(*(s.tolist() for s in spans))]
    assert (batches.mix(np.array([x % 2**64 for x in one], np.uint64)) == whole).all()


def test_sums_of_a_long_text_take_little_memory():
    data = np.frombuffer(b"word " * 800_000, np.uint8)
    spans = word_spans(data, np.array([0, len(data)]))
    batches._powers.clear()
    tracemalloc.start()
    hash_spans(data, *spans)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * len(data)
