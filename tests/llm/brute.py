"""Plain versions of the operators, for small inputs."""

import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def words(text):
    return WORD.findall(text or "")


def lower_words(text):
    return words((text or "").translate(ASCII_LOWER))


def crc(text):
    return zlib.crc32((text or "").encode())


def shingles(text, width):
    w = lower_words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1)))


def near_components(rows, width, percent):
    """doc ids -> smallest id reachable; rows are (doc_id, text) with distinct ids."""
    sets = {d: shingles(t, width) for d, t in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            root[d] = root[root[d]]
            d = root[d]
        return d

    having = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            having[x].append(d)
    seen = set()
    for ids in having.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        x, y = find(a), find(b)
                        root[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}, {d: len(s) for d, s in sets.items()}
