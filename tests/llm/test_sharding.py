import numpy as np
import pytest

from postweave.llm import sharding
from tests.llm.brute import crc


@pytest.mark.parametrize("n", [1, 2, 3, 24, 1000, 4097])
def test_permutation_and_its_inverse(n):
    p = sharding.Permutation(n, seed=9)
    places = p.place(np.arange(n))
    assert sorted(places.tolist()) == list(range(n))
    assert (p.row(places) == np.arange(n)).all()
    if n > 100:
        assert abs(np.corrcoef(np.arange(n), places)[0, 1]) < 0.15
        assert (sharding.Permutation(n, seed=10).place(np.arange(n)) != places).mean() > 0.9


def check(rows, docs, shards):
    found = sharding.shard_rows(docs, shards=shards).collect()
    assert sorted((str(f.doc_id), f.size, f.text_crc32) for f in found) == sorted(
        (str(d), len((t or "").encode()) + 8, crc(t)) for d, t in rows
    )
    slots = {}
    for f in found:
        slots.setdefault(f.shard, []).append(f.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for f in found[:20]:
        assert sharding.row_at(f.shard, f.slot, len(found), shards) == f.row_number
    return found


def test_small_table_and_partitions(small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    once = check(rows, small, 24)
    again = check(rows, small.repartition(7), 24)
    assert sorted(once) == sorted(again)


def test_awkward_rows(awkward):
    check([(r.doc_id, r.text) for r in awkward.collect()], awkward, 4)


def test_no_rows(nothing):
    assert sharding.shard_rows(nothing).collect() == []
