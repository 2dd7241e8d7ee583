import public_tokenizers
import pytest

import corpus_pipeline
from postweave.llm import decontaminate, odd_sketch
from tests.llm.brute import near_components, words
from tests.llm.test_decontaminate import leaked
from tests.llm.test_token_files import plain

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """What each stage makes of its predecessor's rows, written and read again."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_columns_stay(results):
    for r in results[1:-1]:
        assert r.dtypes == results[0].dtypes


def test_rules(results):
    before, after = ({r.doc_id: r.text for r in results[k].collect()} for k in (0, 1))
    assert 0 < len(after) < len(before)
    for doc_id, text in after.items():
        assert set(text.split("\n")) <= set(before[doc_id].split("\n")) and len(words(text)) > 0


def test_one_document_of_each_group(results):
    before, after = ([(r.doc_id, r.text) for r in results[k].collect()] for k in (1, 2))
    root, _ = near_components(before, 5, 80)
    assert sorted(d for d, _ in after) == sorted(set(root.values()))


def test_no_benchmark_items(spark, results):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    before = results[2].collect()
    _, whole = leaked(before, items)
    some, _ = leaked(before, items)
    after = {r.doc_id for r in results[3].collect()}
    ids = {r.doc_id for r in before}
    assert not after & {d for d, _ in whole} and ids - {d for d, _ in some} <= after


def test_mix(results):
    before = {r.doc_id: len(words(r.text)) for r in results[3].collect()}
    copies = [r.doc_id for r in results[4].collect()]
    assert set(copies) <= set(before) and max(map(copies.count, set(copies))) <= 2
    assert sum(before[d] for d in copies) == pytest.approx(1.5 * sum(before.values()), rel=0.05)


def test_ids(results):
    rows = sorted((r.doc_id, r.text) for r in results[4].collect())
    found = sorted((r.doc_id, r.n_tokens) for r in results[5].collect())
    assert found == [(d, len(ids)) for (d, _), ids in zip(rows, plain([t for _, t in rows]))]


def test_run_is_the_stages_in_order(spark, results):
    assert sorted(corpus_pipeline.run(spark, FOLDER).collect()) == sorted(results[-1].collect())


def test_deduplication_of_awkward_rows(spark, awkward, nothing):
    found = [r.doc_id for r in odd_sketch.deduplicated(awkward).collect()]
    assert sorted(map(str, found)) == sorted(map(str, [1, 2, 3, None, 5, 5, 6, 7, 8]))
    assert odd_sketch.deduplicated(nothing).collect() == []


def test_empty_documents(spark, nothing):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.collect() == []
