import tracemalloc

import numpy as np

from postweave.llm import seating
from postweave.llm.restaurants import Numbered


def test_rows_of_stirling_numbers_are_made_from_kept_ones(monkeypatch):
    steps, plain = [], seating._next_row
    monkeypatch.setattr(seating, "_kept", {})
    monkeypatch.setattr(seating, "_next_row", lambda *a: steps.append(a[1]) or plain(*a))
    first = seating.log_stirling_rows(np.array([3, 900, 1005]), 0.7)
    assert len(steps) == 1005
    steps.clear()
    again = seating.log_stirling_rows(np.array([3, 17, 900, 1005]), 0.7)
    assert len(steps) < 4 * seating.KEPT and all((again[c] == first[c]).all() for c in first)
    assert (seating.log_stirling_rows(np.array([17]), 0.5)[17] != again[17]).any()


def test_numbers_of_tokens_take_little_memory():
    tokens = np.random.default_rng(0).integers(0, 1000, 1 << 19).astype(np.uint64)
    tracemalloc.start()
    keys = Numbered(tokens, np.uint64(7), np.zeros(0, np.uint64)).keys()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(keys) == len(tokens) and peak < 45 * len(tokens)
