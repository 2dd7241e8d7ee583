"""Benchmark items in training texts: a BM25 index of the items, block-max WAND, and overlap checks.

The items are indexed (posting lists by blocks of items, greatest impact of a term in each block), and every
passage of every training text is a query. Impacts are divided by the item's score for its own words, so one
threshold holds for all items and a whole copy scores 1. The common words of an item, up to half the threshold, are not
sought: no item can reach the threshold by them alone. A passage is scored against a block of items only if the sum of
greatest impacts of the other words, over all items and then over the block, and the greatest weight of common words reach
the threshold: nothing above it is lost. What is retrieved is verified: word n-grams of the item's question and of its
answer must occur in the passage, or nearly all of both together. Answers too short for several n-grams are verified by their words.

Items are grouped by length: for items of U/2 to U words passages have 2U words and begin every U words, so any copy lies
whole in some passage.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postweave.llm.batches import PUNCTUATION, hash_words, slabs, text_bytes, window_hashes

K1, B = 1.2, 0.75
# Least score of a passage, and least share of n-grams of question and answer.
THRESHOLD, OVERLAP = 0.6, 0.6
# Share of the whole item's n-grams that is enough whatever its answer has.
WHOLE = 0.8
GRAM, SHORTEST, ITEM_BLOCK = 4, 16, 32
# Characters of items in one index, which goes to every task; more items make more indexes, each run over all texts.
INDEX_CHARS = 16 << 20

SENTENCE = re.compile(r"[.!?:]\s+|\n+")


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence or line is the answer; a single sentence is a question without answer."""
    text = text.strip()
    cuts = [m.end() for m in SENTENCE.finditer(text) if m.end() < len(text)]
    return (text[: cuts[-1]], text[cuts[-1] :]) if cuts else (text, "")


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return hash_words(*text_bytes(pc.utf8_lower(pa.array(texts, pa.string()))), PUNCTUATION)


def _part(words: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    size = min(GRAM, len(words))
    return words, size, np.unique(window_hashes(words, size)) if size else words


class LengthClass:
    """Index of the items of ``unit`` / 2 to ``unit`` words."""

    def __init__(self, items: list[tuple], unit: int, vocabulary: np.ndarray, idf: np.ndarray, mean: float):
        self.unit, self.items, self.terms = unit, items, len(vocabulary)
        blocks = -(-len(items) // ITEM_BLOCK)
        self.greatest = np.zeros((blocks, len(vocabulary)), np.float32)
        self.common = np.zeros(blocks)
        postings = []
        for k, (_, (words, _, _), _, _) in enumerate(items):
            terms, counts = np.unique(np.searchsorted(vocabulary, words), return_counts=True)
            impact = idf[terms] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * len(words) / mean))
            impact = (impact / impact.sum()).astype(np.float32)
            block = k // ITEM_BLOCK
            by_frequency = np.argsort(idf[terms], kind="stable")
            taken = np.cumsum(impact[by_frequency]) <= THRESHOLD / 2
            sought = by_frequency[~taken]
            np.maximum.at(self.greatest[block], terms[sought], impact[sought])
            self.common[block] = max(self.common[block], float(impact[by_frequency[taken]].sum()))
            postings.append(np.rec.fromarrays([np.full(len(terms), block), terms, np.full(len(terms), k), impact], names="block,term,item,impact"))
        table = np.concatenate(postings)
        table = table[np.lexsort((table["item"], table["term"], table["block"]))]
        self.item, self.impact = table["item"].astype(np.int64), table["impact"].astype(np.float64)
        keys = table["block"].astype(np.int64) * len(vocabulary) + table["term"]
        self.begins = np.searchsorted(keys, np.arange(blocks * len(vocabulary) + 1)).astype(np.int64)
        self.over_all = self.greatest.max(axis=0)

    def retrieve(self, term: np.ndarray, place: np.ndarray, bounds: np.ndarray, least: float) -> Iterator[tuple[int, int, int, float]]:
        """(row, first word of the passage, item, score) of all passages that score ``least`` or more.

        ``term`` are the terms at the word places ``place``; words that no item has are left out.
        """
        halves_before = np.concatenate([[0], np.cumsum(-(-np.diff(bounds) // self.unit))])
        halves = int(halves_before[-1])
        row = np.searchsorted(bounds, place, "right") - 1
        half = halves_before[row] + (place - bounds[row]) // self.unit
        # A passage is a half and the next one of the same row.
        together = np.ones(halves, bool)
        together[halves_before[1:][np.diff(halves_before) > 0] - 1] = False
        slack = least - 1e-6

        sought = self.over_all[term] > 0
        key = np.sort(half[sought] * self.terms + term[sought])
        key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
        its_half, its_term = key // self.terms, key % self.terms

        def greatest_sums(weights: np.ndarray) -> np.ndarray:
            sums = np.bincount(its_half, weights[its_term], halves + 1)
            return sums[:-1] + np.where(together, sums[1:], 0)

        passages = greatest_sums(self.over_all) + self.common.max() >= slack
        if not passages.any():
            return
        wanted = passages.copy()
        wanted[1:] |= passages[:-1]
        its_half, its_term = its_half[wanted[its_half]], its_term[wanted[its_half]]
        for block in range(len(self.greatest)):
            for k in np.flatnonzero(passages & (greatest_sums(self.greatest[block]) + self.common[block] >= slack)).tolist():
                first, stop = np.searchsorted(half, (k, k + 1 + bool(together[k])))
                own = np.unique(term[first:stop]) + block * self.terms
                first, stop = self.begins[own], self.begins[own + 1]
                lengths = stop - first
                ends = np.cumsum(lengths)
                at = np.arange(int(ends[-1])) + np.repeat(first - (ends - lengths), lengths)
                scores = np.bincount(self.item[at] - block * ITEM_BLOCK, self.impact[at])
                for found in np.flatnonzero(scores >= slack).tolist():
                    r = int(np.searchsorted(halves_before, k, "right")) - 1
                    yield r, (k - int(halves_before[r])) * self.unit, block * ITEM_BLOCK + found, float(scores[found])


class ItemIndex:
    """Posting lists of all items, by length class. Items without words are in none."""

    def __init__(self, rows: list[tuple]):
        texts = [text or "" for _, text in rows]
        words, bounds = _words(texts)
        parts = [_words([part])[0] for text in texts for part in question_and_answer(text)]
        self.vocabulary = np.unique(words)
        term = np.searchsorted(self.vocabulary, words)
        row = np.repeat(np.arange(len(rows)), np.diff(bounds))
        frequency = np.bincount(np.unique(row * max(1, len(self.vocabulary)) + term) % max(1, len(self.vocabulary)), minlength=len(self.vocabulary))
        idf = np.log(1 + (len(rows) - frequency + 0.5) / (frequency + 0.5))
        mean = len(words) / max(1, len(rows))
        classes: dict[int, list] = {}
        for k, (item_id, _) in enumerate(rows):
            own = words[bounds[k] : bounds[k + 1]]
            if len(own):
                unit = max(SHORTEST, 1 << (len(own) - 1).bit_length())
                classes.setdefault(unit, []).append((item_id, *map(_part, (own, parts[2 * k], parts[2 * k + 1]))))
        self.classes = [LengthClass(items, unit, self.vocabulary, idf, mean) for unit, items in sorted(classes.items())]

    def leaks(self, texts: pa.Array, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> Iterator[tuple]:
        """(row, item_id, first word, score, question_overlap, answer_overlap) of verified passages."""
        words, bounds = hash_words(*text_bytes(pc.utf8_lower(texts)), PUNCTUATION)
        if not len(self.vocabulary) or not len(words):
            return
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        place = np.flatnonzero(self.vocabulary[at] == words)
        term = at[place]
        for group in self.classes:
            for row, first, item, score in group.retrieve(term, place, bounds, threshold):
                start = int(bounds[row]) + first
                passage = words[start : min(start + 2 * group.unit, int(bounds[row + 1]))]
                item_id, full, question, answer = group.items[item]
                shares = [_share(part, passage, overlap) for part in (question, answer)]
                if all(s is None or s >= overlap for s in shares) or _share(full, passage, WHOLE) >= WHOLE:
                    yield row, item_id, first, score, *shares


def _share(part: tuple[np.ndarray, int, np.ndarray], passage: np.ndarray, least: float) -> float | None:
    """Share of the part's n-grams in the passage; None for a part without words.

    Where one changed word can bring that below ``least``, it is at least the share of words that are there in order.
    """
    words, size, grams = part
    if not size:
        return None
    share = float(np.isin(grams, window_hashes(passage, size)).mean())
    short = len(words) < round(GRAM - 1 + GRAM / max(1 - least, 1e-9), 6)
    return max(share, _in_order(words, passage)) if short and share < least else share


def _in_order(words: np.ndarray, passage: np.ndarray) -> float:
    """Greatest share of ``words`` that is a common subsequence with a run of the passage of one word more."""
    width = min(len(words) + 1, len(passage))
    runs = np.lib.stride_tricks.sliding_window_view(passage, width)
    best = np.zeros((width + 1, len(runs)), np.int64)
    for word in words:
        last, best = best, np.zeros_like(best)
        for k in range(width):
            best[k + 1] = np.maximum(np.maximum(last[k + 1], best[k]), last[k] + (runs[:, k] == word))
    return float(best[-1].max()) / len(words)


def item_indexes(items: DataFrame, item_id: str = "item_id", text: str = "text", chars: int = INDEX_CHARS) -> list[ItemIndex]:
    """The items as one index, or as several of about ``chars`` characters; each has the statistics of its own items."""
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-size // chars)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, parts)))
    return [ItemIndex([tuple(r) for r in rows.where(part == k).sort("item_id", "text").collect()]) for k in range(parts)]


def contamination(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row for each (doc_id, item_id) with a verified passage: score, question_overlap, answer_overlap and word of the best.

    Case and ASCII punctuation do not count. Null and empty texts and items match nothing; without items there are no rows.
    Rows of one doc_id are reported together.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kinds = docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, word long, score double, question_overlap double, answer_overlap double"
    spark = docs.sparkSession
    found = spark.createDataFrame([], schema)
    for index in item_indexes(items, item_id, item_text):
        found = found.union(plain.mapInArrow(_finder(spark.sparkContext.broadcast(index), threshold, overlap), schema))
    rank = F.struct("score", "question_overlap", "answer_overlap", (-F.col("word")).alias("word"))
    best = found.groupBy("doc_id", "item_id").agg(F.max(rank).alias("best"), F.count("*").alias("passages"))
    return best.select(
        "doc_id", "item_id", "best.score", "best.question_overlap", "best.answer_overlap", (-F.col("best.word")).alias("word"), "passages"
    )


def _finder(index, threshold: float, overlap: float):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            rows = list(index.value.leaks(batch.column("text"), threshold, overlap))
            if rows:
                row, item, word, score, question, answer = map(list, zip(*rows))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").take(pa.array(row)),
                        "item_id": pa.array(item),
                        "word": pa.array(word, pa.int64()),
                        "score": pa.array(score, pa.float64()),
                        "question_overlap": pa.array(question, pa.float64()),
                        "answer_overlap": pa.array(answer, pa.float64()),
                    }
                )

    return find


def clean_documents(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` in which no item is found; nothing is shuffled."""
    for index in item_indexes(items, item_id, item_text):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in slabs(batches, text):
                clean = np.ones(batch.num_rows, bool)
                clean[[leak[0] for leak in held.value.leaks(batch.column(text), threshold, overlap)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
