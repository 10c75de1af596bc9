"""Words and shingles of whole batches of texts as numpy arrays: no Python work per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SHINGLE = 5
#: Longer words are hashed one by one.
LONG_WORD = 48
#: Bytes of text that are worked on at once (a longer text is a chunk of its own).
CHUNK = 1_000_000
GOLD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


#: What the words of a shingle are multiplied by, by place.
_PLACES = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64) * GOLD) | np.uint64(1)


def chunks(col: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row behind the last, bytes, ends of the texts in them) of parts of a binary column without nulls."""
    offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(col):
        end = min(len(col), max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row + 1 : end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words of each text); A-Z count as a-z."""
    begins = np.concatenate([[0], ends[:-1]])
    text = np.concatenate([_LOWER[data], np.zeros(8, np.uint8)])
    solid = ~_SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    some = ends > begins  # words end where a text does
    first[begins[some]] = solid[begins[some]]
    last[ends[some] - 1] = solid[ends[some] - 1]
    start = np.flatnonzero(first)
    size = np.flatnonzero(last) + 1 - start
    eight = np.ndarray((len(data),), "<u8", text.data, strides=(1,))
    h = size.astype(np.uint64) * GOLD
    for k in range(0, min(int(size.max(initial=0)), LONG_WORD), 8):
        at = np.flatnonzero(size > k)
        h[at] = mix(h[at] * GOLD + (eight[start[at] + k] & _FIRST[np.minimum(size[at] - k, 8)]))
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = xxhash.xxh3_64_intdigest(text[start[i] : start[i] + size[i]].data, int(size[i]))
    return h, np.searchsorted(start, ends) - np.searchsorted(start, begins)


def shingle_sets(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, set sizes): the sorted distinct shingle hashes of each text, one behind the other.

    A text of fewer than SHINGLE words has its whole sequence as its one shingle; one without words has none.
    """
    h, count = word_hashes(data, ends)
    behind = np.cumsum(count)
    padded = np.concatenate([h, np.zeros(SHINGLE, np.uint64)])
    sums = np.zeros(len(h), np.uint64)
    for k in range(SHINGLE):
        sums += padded[k : k + len(h)] * _PLACES[k]
    good = np.ones(len(h), bool)
    for k in range(1, SHINGLE):
        good[behind[count >= k] - k] = False
        short = behind[count == k] - k
        good[short] = True
        sums[short] = k * int(GOLD) % 2**64
        for j in range(k):
            sums[short] += h[short + j] * _PLACES[j]
    s = mix(sums[good])
    size = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
    stop = np.cumsum(size)
    begin = stop - size
    for a, b in zip(begin[size > 1].tolist(), stop[size > 1].tolist()):
        s[a:b].sort()
    fresh = np.ones(len(s), bool)
    fresh[1:] = s[1:] != s[:-1]
    some = size > 0
    fresh[begin[some]] = True
    out = np.zeros(len(size), np.int64)
    if some.any():
        out[some] = np.add.reduceat(fresh, begin[some], dtype=np.int64)
    return s[fresh], out
