"""Spelling variants: words one inserted, deleted or replaced letter apart, found in a trie of letter-group counts.

1. Tasks cut texts into runs of letters and add up equal words before they are shuffled. All letters of a run are
   in U+0000 to U+00FF, so a word is handled as its Latin-1 bytes.
2. A word is the vector of how many letters of each group it has. One edit adds a letter to one group at most and
   takes one from one group at most. Words go to the task of their counts over a few coarse groups, and visit the
   tasks whose coarse counts are within that budget, each pair of tasks in one direction. As many coarse groups are
   used as keep the words of a task below a limit.
3. A task arranges its words in a trie by successive counts of the fine groups, and walks pairs of nodes depth-first in
   blocks, with a budget of one surplus and one deficit. Words of leaves that are reached together are compared.
4. A word's form is its near word of greatest count; roots follow forms by pointer jumping.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postweave.llm.batches import LOWER, slabs, text_bytes
from postweave.plans.storage import stored

LEAST_LETTERS, LEAST_COUNT, RATIO = 7, 2, 10
# Groups of letters, one level of the trie each; letters beyond ASCII are dealt to further ones.
GROUPS = "e t a o i n s r h l d u c m fg pb wyv kjqxz".split()
WIDE_GROUPS = 6
LEVELS = len(GROUPS) + WIDE_GROUPS
# Numbers of coarse groups to choose from, and the words of one task that ask for more.
DEPTHS, NODE_WORDS = (2, 3, 4, 6, 8), 40_000
GREATEST = 255
# Text bytes whose words a task adds up at once, node pairs of a block, pairs of words compared at once.
HELD_BYTES, BLOCK, COMPARED = 16 << 20, 1 << 18, 1 << 18
# Pairs of a leaf with more are found by halves of words; longer words are compared one by one.
LEAF_PAIRS, WIDTH = 1 << 16, 32

LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123)]] = True
WIDE = 0xC3  # first byte of U+00C0 to U+00FF in UTF-8


def _group_table() -> np.ndarray:
    table = np.full(256, 0, np.uint8)
    for k, letters in enumerate(GROUPS):
        table[[ord(c) for c in letters]] = k
    table[192:] = len(GROUPS) + np.arange(64) % WIDE_GROUPS
    return table


GROUP = _group_table()


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each span of bytes, going on from the checksum ``before`` of what precedes it."""
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    place, size = starts[order], sizes[order]
    state = before[order] ^ np.uint32(0xFFFFFFFF)
    long = int((size > 64).sum())
    for k in range(long):
        at = int(place[k])
        state[k] = zlib.crc32(data[at : at + int(size[k])].tobytes(), int(before[order[k]])) ^ 0xFFFFFFFF
    active = np.searchsorted(-size, -np.arange(int(size[long]) if long < len(size) else 0), "left")
    for j, n in enumerate(active.tolist()):
        own = state[long:n]
        state[long:n] = CRC[(own ^ data[place[long:n] + j]) & np.uint32(0xFF)] ^ (own >> np.uint32(8))
    out = np.empty(len(starts), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def letter_runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each maximal run of letters A-Z, a-z and U+00C0 to U+00FF; rows are told apart."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    wide = data == WIDE
    inside = LETTERS[data] | wide
    inside[1:] |= wide[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    starts = inside & edge[:-1]
    starts[1:] |= inside[1:] & ~inside[:-1]
    ends = inside & edge[1:]
    ends[:-1] |= inside[:-1] & ~inside[1:]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def _words(batch: pa.RecordBatch, noise: int | None, least: int) -> pa.Array:
    """All words of a batch of at least ``least`` letters, runs that ``noise`` chooses without one letter."""
    data, bounds = text_bytes(batch.column("text"))
    data = LOWER[data]
    starts, ends = letter_runs(data, bounds)
    keep = np.ones(len(data), bool)
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    letters = leads[ends] - leads[starts]
    if noise is not None and len(starts):
        ids = batch.column("doc_id").to_pylist()
        prefix = np.array([zlib.crc32(f"{'' if d is None else d}:".encode()) for d in ids], np.uint32)
        row = np.searchsorted(bounds, starts, "right") - 1
        h = crc32_spans(data, starts, ends, prefix[row])
        hit = np.flatnonzero(h % np.uint32(noise) == 0)
        place = np.flatnonzero((data & 0xC0) != 0x80)
        drop = place[leads[starts[hit]] + h[hit] % letters[hit]]
        keep[drop] = False
        wide = drop[data[drop] == WIDE]
        keep[wide + 1] = False
        letters[hit] -= 1
    long = letters >= least
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long], -1)
    inside = (np.cumsum(inside[:-1]) > 0) & keep
    place = np.concatenate([[0], np.cumsum(inside)])
    offsets = np.concatenate([[0], place[ends[long]]]).astype(np.int32)
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data[inside]))


def word_counts(docs: DataFrame, noise: int | None = None, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of (doc_id, text): runs of letters, A-Z lower-cased, of a least length and a least count overall.

    With ``noise`` each run of a document whose crc32 of ``<doc_id>:<run>`` is a multiple of it loses the letter at that
    number modulo the run's length, which plants typing errors. A null id counts as an empty one there.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def send() -> pa.RecordBatch:
            found = pc.value_counts(pa.chunked_array(held, pa.string()))
            return pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["word", "n"])

        for batch in slabs(batches):
            held.append(_words(batch, noise, least_letters))
            size += held[-1].nbytes
            if size >= HELD_BYTES:
                yield send()
                held, size = [], 0
        if held:
            yield send()

    found = docs.mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _latin(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Latin-1 bytes of all words, and where each begins."""
    data, bounds = text_bytes(words)
    wide = data == WIDE
    kept = ~wide
    out = data.copy()
    out[1:][wide[:-1]] += 0x40  # the second byte is the code point less 0x40
    place = np.concatenate([[0], np.cumsum(kept)])
    return out[kept], place[bounds]


def group_counts(words: pa.Array, groups: np.ndarray, number: int) -> np.ndarray:
    """How many letters of each group a word has, at most GREATEST: capping keeps differences within one."""
    data, bounds = _latin(words)
    row = np.repeat(np.arange(len(words)), np.diff(bounds))
    counts = np.bincount(row * number + groups[data], minlength=len(words) * number)
    return np.minimum(counts, GREATEST).astype(np.uint8).reshape(len(words), number)


def _places(words: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Coarse counts of words, and the key of their node: eight bits for each coarse group."""
    counts = group_counts(words, (GROUP % depth).astype(np.uint8), depth).astype(np.int64)
    return counts, (counts << (8 * np.arange(depth))).sum(axis=1)


def _sent(words: DataFrame, depth: int) -> DataFrame:
    """Each word at its own node, and as a visitor at those that one edit can lead to, in one direction of each pair."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, key = _places(batch.column("word"), depth)
            rows = np.arange(batch.num_rows)
            moves = [(rows, key, True)]
            for i in range(depth):
                up = counts[:, i] < GREATEST
                moves.append((rows[up], key[up] + (1 << 8 * i), False))
                for j in range(i + 1, depth):
                    both = up & (counts[:, j] > 0)
                    moves.append((rows[both], key[both] + (1 << 8 * i) - (1 << 8 * j), False))
            for some, keys, own in moves:
                kept = batch.take(pa.array(some))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), kept.column("word"), kept.column("n"), pa.array(np.full(len(some), own))], names=["node", "word", "n", "own"]
                )

    return words.mapInArrow(send, "node long, word string, n long, own boolean")


def _depth(words: DataFrame, node_words: int) -> int:
    """The least number of coarse groups at which no node has more than ``node_words`` words, else the greatest."""
    for depth in DEPTHS[:-1]:

        def keys(batches: Iterator[pa.RecordBatch], depth=depth) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array(_places(batch.column("word"), depth)[1])], names=["node"])

        sizes = words.select("word").mapInArrow(keys, "node long").groupBy("node").count()
        if (sizes.agg(F.max("count")).first()[0] or 0) <= node_words:
            return depth
    return DEPTHS[-1]


class Trie:
    """Words by successive group counts. Nodes of a level ascend by the counts that lead to them."""

    def __init__(self, counts: np.ndarray):
        self.order = np.lexsort(counts.T[::-1])
        ordered = counts[self.order]
        changed = np.logical_or.accumulate(ordered[1:] != ordered[:-1], axis=1)
        parent_of_row = np.zeros(len(ordered), np.int64)
        self.digit, self.first, self.keys = [], [], []
        for level in range(counts.shape[1]):
            starts = np.concatenate([[0], np.flatnonzero(changed[:, level]) + 1])
            parent, digit = parent_of_row[starts], ordered[starts, level].astype(np.int64)
            self.digit.append(digit)
            self.first.append(np.searchsorted(parent, np.arange(int(parent_of_row[-1]) + 2)))
            self.keys.append(parent * 256 + digit)
            parent_of_row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ordered))))
        self.starts = np.append(starts, len(ordered))

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children of all nodes, and the place of the node of each."""
        first = self.first[level]
        number = first[nodes + 1] - first[nodes]
        place = np.repeat(np.arange(len(nodes)), number)
        return np.arange(len(place)) - (np.cumsum(number) - number - first[nodes])[place], place

    def child(self, level: int, node: np.ndarray, digit: np.ndarray) -> np.ndarray:
        """The child of a node with a count, -1 if there is none."""
        keys = self.keys[level]
        wanted = node * 256 + digit
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where((keys[at] == wanted) & (digit >= 0) & (digit <= GREATEST), at, -1)


def near_leaves(a: Trie, b: Trie, same: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Leaves of two tries whose counts differ by one surplus and one deficit at most; of one trie each pair once."""
    zero = np.zeros(1, np.int64)
    # Budget spent: bit 0 for the surplus, bit 1 for the deficit of b.
    stack = [(0, zero, zero, zero)]
    while stack:
        level, left, right, spent = stack.pop()
        if level == len(a.digit):
            yield left, right
            continue
        child, place = a.children(level, left)
        digit, node, used = a.digit[level][child], right[place], spent[place]
        parts = []
        for step, bit in ((0, 0), (1, 1), (-1, 2)):
            some = np.flatnonzero(used & bit == 0) if bit else np.arange(len(child))
            other = b.child(level, node[some], digit[some] + step)
            found = (other >= child[some]) if same else (other >= 0)
            some = some[found]
            parts.append((child[some], other[found], used[some] | bit))
        left, right, spent = (np.concatenate(p) for p in zip(*parts))
        for k in range(0, len(left), BLOCK):
            stack.append((level + 1, left[k : k + BLOCK], right[k : k + BLOCK], spent[k : k + BLOCK]))


class Letters:
    """Words as rows of bytes, from the left and from the right, for comparing many pairs."""

    def __init__(self, words: pa.Array):
        data, bounds = _latin(words)
        self.size = np.diff(bounds)
        self.words = [data[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        row = np.repeat(np.arange(len(words)), self.size)
        column = np.arange(len(data)) - bounds[row]
        self.left = np.zeros((len(words), WIDTH), np.uint8)
        self.right = np.zeros((len(words), WIDTH), np.uint8)
        short = column < WIDTH
        self.left[row[short], column[short]] = data[short]
        from_end = self.size[row] - 1 - column
        short = from_end < WIDTH
        self.right[row[short], from_end[short]] = data[short]


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether two texts are one inserted, deleted or replaced letter apart."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    least = min(len(a), len(b))
    head = next((k for k in range(least) if a[k] != b[k]), least)
    tail = next((k for k in range(least - head) if a[-1 - k] != b[-1 - k]), least - head)
    return head + tail >= max(len(a), len(b)) - 1


def _near(a: Letters, b: Letters, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of different words are one edit apart: their common head and tail leave one letter at most."""
    longer = np.maximum(a.size[i], b.size[j])
    out = longer - np.minimum(a.size[i], b.size[j]) <= 1
    some = np.flatnonzero(out & (longer <= WIDTH))
    x, y = i[some], j[some]
    differs = a.left[x] != b.left[y]
    head = np.where(differs.any(axis=1), differs.argmax(axis=1), WIDTH)
    differs = a.right[x] != b.right[y]
    tail = np.where(differs.any(axis=1), differs.argmax(axis=1), WIDTH)
    out[some] = (head + tail >= longer[some] - 1) & (head < longer[some])
    for k in np.flatnonzero(out & (longer > WIDTH)).tolist():
        out[k] = one_edit(a.words[i[k]], b.words[j[k]])
    return out


def _by_halves(a: Letters, b: Letters, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of i x j that share a half: one edit leaves the first or the last half of the shorter word as it is."""
    having = defaultdict(list)
    for y in j.tolist():
        w = b.words[y]
        for least in (len(w) - 1, len(w)):
            having[least, 0, w[: least // 2]].append(y)
            having[least, 1, w[len(w) - (least - least // 2) :]].append(y)
    found = set()
    for x in i.tolist():
        w = a.words[x]
        for least in (len(w) - 1, len(w)):
            for key in ((least, 0, w[: least // 2]), (least, 1, w[len(w) - (least - least // 2) :])):
                found.update((x, y) for y in having.get(key, ()))
    pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _members(trie: Trie, leaf: int) -> np.ndarray:
    return trie.order[trie.starts[leaf] : trie.starts[leaf + 1]]


def _word_pairs(a: Trie, b: Trie, x: Letters, y: Letters, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of words of near leaves; of one trie each pair once, in any order."""
    for left, right in near_leaves(a, b, same):
        size_a, size_b = np.diff(a.starts)[left], np.diff(b.starts)[right]
        many = size_a * size_b > LEAF_PAIRS
        for p, q in zip(left[many].tolist(), right[many].tolist()):
            i, j = _by_halves(x, y, _members(a, p), _members(b, q))
            once = (i < j) | (not same or p != q)
            yield i[once], j[once]
        left, right, size_a, size_b = (v[~many] for v in (left, right, size_a, size_b))
        ends = np.cumsum(size_a * size_b)
        at = 0
        while at < len(left):
            done = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + COMPARED, "right")))
            number = (size_a * size_b)[at:stop]
            pair = np.repeat(np.arange(at, stop), number)
            within = np.arange(len(pair)) - (np.cumsum(number) - number)[pair - at]
            i = a.order[a.starts[left[pair]] + within // size_b[pair]]
            j = b.order[b.starts[right[pair]] + within % size_b[pair]]
            once = (i < j) | (left[pair] != right[pair]) if same else np.ones(len(i), bool)
            yield i[once], j[once]
            at = stop


def near_pairs(own: pa.Array, visitors: pa.Array) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Pairs of own words, each once, and pairs of own words and visitors, that are one edit apart, as places."""
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    if not len(own):
        return empty, empty
    a, x = Trie(group_counts(own, GROUP, LEVELS)), Letters(own)
    out = []
    for words, same in ((own, True), (visitors, False)):
        if not len(words):
            out.append(empty)
            continue
        b, y = (a, x) if same else (Trie(group_counts(words, GROUP, LEVELS)), Letters(words))
        found = [empty]
        for i, j in _word_pairs(a, b, x, y, same):
            near = _near(x, y, i, j)
            found.append((i[near], j[near]))
        out.append(tuple(np.concatenate(p) for p in zip(*found)))
    return out[0], out[1]


NEAR = "word string, n_near long, near_n long, near string"


def _neighbours(sent: DataFrame) -> DataFrame:
    """Per word and node: how many near words it has there, and the one of greatest count, the smallest of equals."""

    def find(group: pa.Table) -> pa.Table:
        own = group.filter(group.column("own")).combine_chunks()
        visitors = group.filter(pc.invert(group.column("own"))).combine_chunks()
        text = lambda t: t.column("word").combine_chunks() if t.num_rows else pa.array([], pa.string())
        within, across = near_pairs(text(own), text(visitors))
        words = pa.concat_arrays([text(own), text(visitors)])
        n = np.concatenate([t.column("n").to_numpy() for t in (own, visitors)])
        i = np.concatenate([within[0], across[0]])
        j = np.concatenate([within[1], across[1] + len(own)])
        left, right = np.concatenate([i, j]), np.concatenate([j, i])
        rank = np.empty(len(words), np.int64)
        rank[pc.array_sort_indices(words).to_numpy()] = np.arange(len(words))
        order = np.lexsort((rank[right], -n[right], left))
        left, right = left[order], right[order]
        first = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1]])) if len(left) else np.zeros(0, np.int64)
        best = right[first]
        counts = np.diff(np.append(first, len(left)))
        return pa.table({"word": words.take(pa.array(left[first])), "n_near": counts, "near_n": n[best], "near": words.take(pa.array(best))})

    return sent.groupBy("node").applyInArrow(find, NEAR)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): each round a root that has a form is replaced by the root of that word."""
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not roots.join(further, "root", "left_semi").limit(1).count():
            return roots
        roots = stored(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def spelling_variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    noise: int | None = None,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    node_words: int = NODE_WORDS,
) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, only A-Z lower-cased, see ``word_counts``. ``form`` is the near word of
    greatest count (of equals the smallest) if that is at least ``ratio`` times the word's, else null; ``root`` is where forms
    end. Null and empty texts have no words; equal rows count each time; without words there are no rows.
    """
    plain = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    words = stored(word_counts(plain, noise, least_letters, least_count), "words")
    near = _neighbours(_sent(words, _depth(words, node_words)))
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    has_form = -F.col("best.n") >= ratio * F.col("n")
    found = words.join(near, "word", "left").select(
        "word",
        F.when(has_form, F.col("best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, -F.col("best.n")).alias("form_n"),
    )
    found = stored(found, "forms")
    roots = _roots(found.where(F.col("form").isNotNull()).select("word", "form"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
