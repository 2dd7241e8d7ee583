import random
import re

import numpy as np
import pytest

from postweave.llm import decontaminate


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


PLAIN = re.compile(r"[^\x00-\x20!-/:-@\[-`{-~]+")


def plain(text):
    return PLAIN.findall(text.lower())


def share(part, text):
    """Share of the part's n-grams in the text."""
    size = min(4, len(part))
    grams = lambda w: {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}
    return len(grams(part) & grams(text)) / len(grams(part)) if size else 1


def leaked(docs, items):
    """(doc_id, item_id) where question and answer lie in some run of twice the item's words; and the whole copies among these."""
    found, whole = set(), set()
    for item in items:
        parts = [plain(p) for p in decontaminate.question_and_answer(item.text)]
        full = parts[0] + parts[1]
        for doc in docs:
            text = plain(doc.text)
            if share(full, text) < 0.5:
                continue
            runs = [text[k : k + 2 * len(full)] for k in range(max(1, len(text) - len(full) + 1))]
            if any(share(parts[0], r) >= 0.6 and share(parts[1], r) >= 0.6 for r in runs):
                found.add((doc.doc_id, item.item_id))
            if any(r[: len(full)] == full for r in runs):
                whole.add((doc.doc_id, item.item_id))
    return found, whole


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contamination(docs, items).collect()}
    expected, whole = leaked(docs.collect(), items.collect())
    assert whole <= found <= expected and len(whole) > 10
    kept = {r.doc_id for r in decontaminate.clean_documents(docs, items).collect()}
    assert kept == {d.doc_id for d in docs.collect()} - {d for d, _ in found}


def test_copies_of_all_lengths_at_all_places(spark, documents):
    rng = random.Random(7)
    vocabulary = [f"word{k}" for k in range(3000)]
    item = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)) + ". Answer: " + rng.choice(vocabulary) + " it is."
    items = [(k, item(n)) for k, n in enumerate([5, 12, 13, 28, 29, 60, 61, 200, 900])]
    docs, planted = [], set()
    for k in range(90):
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 700))]
        if k % 3:
            i = k % len(items)
            at = rng.randrange(len(text) + 1)
            text[at:at] = items[i][1].upper().split()
            planted.add((k, i))
        docs.append((k, " ".join(text)))
    found = decontaminate.contamination(documents(docs), items_of(spark, items))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == planted


def test_pruning_loses_nothing():
    """Scores by posting lists and bounds equal those of all items on all passages."""
    rng = np.random.default_rng(3)
    pool = [f"t{k}" for k in range(120)]
    rows = [(k, " ".join(rng.choice(pool, rng.integers(3, 60)))) for k in range(150)]
    index = decontaminate.ItemIndex(rows)
    texts = [" ".join(rng.choice(pool, 400)) for _ in range(10)]
    words_, bounds = decontaminate._words(texts)
    at = np.minimum(np.searchsorted(index.vocabulary, words_), len(index.vocabulary) - 1)
    place = np.flatnonzero(index.vocabulary[at] == words_)
    for group in index.classes:
        found = {(r, w, i): s for r, w, i, s in group.retrieve(at[place], place, bounds, 0.5)}
        dense = np.zeros((len(group.items), len(index.vocabulary)))
        keys = np.repeat(np.arange(len(group.begins) - 1), np.diff(group.begins)) % len(index.vocabulary)
        dense[group.item, keys] = group.impact
        for r in range(len(texts)):
            for w in range(0, bounds[r + 1] - bounds[r], group.unit):
                terms = np.unique(at[bounds[r] + w : min(bounds[r] + w + 2 * group.unit, bounds[r + 1])])
                for i in np.flatnonzero(dense[:, terms].sum(axis=1) >= 0.5 + 1e-5):
                    assert found[r, w, i] == pytest.approx(dense[i, terms].sum(), abs=1e-5)
                    del found[r, w, i]
        assert all(s < 0.5 + 2e-5 for s in found.values())


def test_question_without_its_answer_is_no_leak(spark, documents):
    question = "which of the many old rivers of the north flows through nine towns before it meets the sea"
    items = items_of(spark, [(1, question + "? The Velmora river of Tarn.")])
    docs = documents([(1, question + ". nobody knows at all, we say."), (2, question + " The Velmora river of Tarn.")])
    assert [r.doc_id for r in decontaminate.contamination(docs, items).collect()] == [2]


@pytest.mark.parametrize("answer", [1, 2, 3, 4, 5, 8])
def test_one_changed_word_at_any_place(spark, documents, answer):
    """Copies with one other word, without the answer, and of the answer alone; answers of few words."""
    rng = random.Random(answer)
    fresh = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    docs, items, near = [], [], []
    for length in (8, 40):
        question, last = fresh(length), fresh(answer)
        items.append((length, " ".join(question) + ". " + " ".join(last) + "."))
        full = question + last
        copies = [full[:k] + fresh(1) + full[k + 1 :] for k in range(len(full))]
        if length == 40:
            copies.append(question)
        for copy in copies:
            near.append((len(docs), length))
            docs.append((len(docs), " ".join(fresh(30) + copy + fresh(30))))
        docs.append((len(docs), " ".join(fresh(30) + last + fresh(30))))
        docs.append((len(docs), " ".join(question[: len(question) // 2] + fresh(30) + last)))
    found = decontaminate.contamination(documents(docs), items_of(spark, items))
    found = {(r.doc_id, r.item_id) for r in found.collect()}
    assert found == set(near)


def test_several_indexes(spark, documents):
    items = items_of(spark, [(k, " ".join(f"i{k}w{j}" for j in range(20))) for k in range(40)])
    docs = documents([(k, f"before i{k}w0 " + " ".join(f"i{k}w{j}" for j in range(20)) + " after") for k in range(40)])
    indexes = decontaminate.item_indexes(items, chars=1000)
    assert len(indexes) > 3 and sum(len(c.items) for i in indexes for c in i.classes) == 40
    assert decontaminate.clean_documents(docs, items).count() == 0


def test_awkward_rows(spark, awkward, nothing):
    items = items_of(spark, [(None, "x y z"), (2, None), (3, ""), (4, "a b c d e f g"), (4, "a b c d e f g"), (5, "!!!")])
    found = {(r.doc_id, r.item_id) for r in decontaminate.contamination(awkward, items).collect()}
    assert found == {(5, None), (None, 4)}
    assert decontaminate.clean_documents(awkward, items).columns == awkward.columns
    assert decontaminate.contamination(nothing, items).collect() == []
    assert decontaminate.contamination(awkward, items_of(spark, [])).collect() == []
    assert decontaminate.clean_documents(awkward, items_of(spark, [])).count() == awkward.count()
