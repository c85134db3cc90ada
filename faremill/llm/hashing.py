"""64-bit hashes of words, many at a time."""

from __future__ import annotations

import numpy as np
import xxhash


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no pattern."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


LONG_WORD = 256
_BELOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words between ASCII white space, where they start, and where the line breaks are. Words are read eight bytes at a
    time from all their places at once."""
    n = len(raw)
    padded = np.frombuffer(raw + b" " * 16, np.uint8)
    inside = (padded > 32) | (padded < 9) | ((padded > 13) & (padded < 32))
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edges = np.concatenate([[0], edges]) if inside[0] else edges
    start, end = edges[::2], edges[1::2]
    eight = np.ndarray((n + 9,), "<u8", padded.tobytes(), strides=(1,))
    size = end - start
    out = mix((eight[start] & _BELOW[np.minimum(size, 8)]) ^ size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    more = np.flatnonzero(size > 8)
    offset = 8
    while len(more) and offset < LONG_WORD:
        out[more] = mix(out[more] ^ (eight[start[more] + offset] & _BELOW[np.minimum(size[more] - offset, 8)]))
        offset += 8
        more = more[size[more] > offset]
    for k in more:
        out[k] = xxhash.xxh3_64_intdigest(raw[start[k] : end[k]])
    return out, start, np.flatnonzero(padded[:n] == 10)


