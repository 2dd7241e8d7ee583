"""Patched frame-of-reference blocks of unsigned integers.

A block holds BLOCK values. Its minimum is subtracted; the differences are packed at the width that
holds the PERCENTILE of them; those that need more bits are exceptions: their slots hold the low
bits, and a list holds their positions and the bits above. All blocks of a call are packed together, one
width at a time.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
PERCENTILE = 0.9

# Per block: minimum, packed width in bits, number of exceptions, size in bytes.
HEAD = np.dtype([("least", "<u4"), ("width", "u1"), ("exceptions", "<u2"), ("size", "<u4")])


def _bit_length(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def _lanes(width: int):
    """For each of 64 values packed into ``width`` words of 64 bits: its word, and its shift within."""
    return [divmod(k * width, 64) for k in range(64)]


def _pack_width(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values, each below 2**width, as rows of bytes."""
    lanes = np.ascontiguousarray(values.reshape(-1, 64).T, dtype=np.uint64)
    words = np.zeros((width, lanes.shape[1]), np.uint64)
    for values_k, (word, shift) in zip(lanes, _lanes(width)):
        words[word] |= values_k << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= values_k >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T, dtype="<u8").view(np.uint8).reshape(len(values), -1)


def _unpack_width(data: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(np.ascontiguousarray(data).view("<u8").reshape(-1, width).T)
    lanes = np.empty((64, words.shape[1]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for k, (word, shift) in enumerate(_lanes(width)):
        lanes[k] = words[word] >> np.uint64(shift)
        if shift + width > 64:
            lanes[k] |= words[word + 1] << np.uint64(64 - shift)
    lanes &= mask
    return np.ascontiguousarray(lanes.T).reshape(len(data), BLOCK)


def pack(values: np.ndarray, percentile: float = PERCENTILE) -> tuple[np.ndarray, np.ndarray]:
    """Block heads and the bytes of the blocks; the last block is filled up with its last value."""
    if not len(values):
        return np.zeros(0, HEAD), np.zeros(0, np.uint8)
    blocks = -(-len(values) // BLOCK)
    padded = np.full(blocks * BLOCK, values[-1], np.uint32)
    padded[: len(values)] = values
    padded = padded.reshape(blocks, BLOCK)
    heads = np.zeros(blocks, HEAD)
    heads["least"] = padded.min(axis=1)
    rest = padded - heads["least"][:, None]
    widths = _bit_length(rest)
    held = np.bincount((widths + np.arange(blocks)[:, None] * 33).ravel(), minlength=blocks * 33).reshape(blocks, 33)
    heads["width"] = (np.cumsum(held, axis=1) >= np.ceil(percentile * BLOCK)).argmax(axis=1)
    over = widths > heads["width"][:, None]
    heads["exceptions"] = over.sum(axis=1)
    packed = heads["width"].astype(np.int64) * (BLOCK // 8)
    heads["size"] = packed + heads["exceptions"].astype(np.int64) * 5
    ends = np.cumsum(heads["size"], dtype=np.int64)
    starts = ends - heads["size"]
    out = np.zeros(int(ends[-1]), np.uint8)
    low = rest & ((np.uint64(1) << heads["width"].astype(np.uint64)) - np.uint64(1))[:, None].astype(np.uint32)
    for width in np.unique(heads["width"]):
        which = np.flatnonzero(heads["width"] == width)
        if width:
            body = _pack_width(low[which], int(width))
            for k, start in enumerate(starts[which].tolist()):
                out[start : start + body.shape[1]] = body[k]
    block, position = np.nonzero(over)
    nth = np.arange(len(block)) - np.searchsorted(block, block)
    count = heads["exceptions"].astype(np.int64)[block]
    at = starts[block] + packed[block]
    out[at + nth] = position
    high = (rest[block, position].astype(np.uint64) >> heads["width"][block].astype(np.uint64)).astype("<u4")
    out[(at + count + 4 * nth)[:, None] + np.arange(4)] = high.view(np.uint8).reshape(-1, 4)
    return heads, out


def unpack(heads: np.ndarray, body: np.ndarray) -> np.ndarray:
    """All values of the blocks, filling of the last one included."""
    starts = np.cumsum(heads["size"], dtype=np.int64) - heads["size"]
    rest = np.zeros((len(heads), BLOCK), np.uint64)
    for width in np.unique(heads["width"]):
        if width:
            which = np.flatnonzero(heads["width"] == width)
            size = int(width) * (BLOCK // 8)
            rest[which] = _unpack_width(np.stack([body[a : a + size] for a in starts[which].tolist()]), int(width))
    count = heads["exceptions"].astype(np.int64)
    block = np.repeat(np.arange(len(heads)), count)
    nth = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
    at = starts[block] + heads["width"].astype(np.int64)[block] * (BLOCK // 8)
    position = body[at + nth]
    high = np.ascontiguousarray(body[(at + count[block] + 4 * nth)[:, None] + np.arange(4)]).view("<u4")[:, 0]
    rest[block, position] |= high.astype(np.uint64) << heads["width"][block].astype(np.uint64)
    return (rest + heads["least"][:, None]).astype(np.uint32).ravel()
