"""Words of whole texts as 64-bit hashes, computed for many rows at once with numpy.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z in lower case.
Different words of one table get different hashes but for a chance of about n^2 / 2^65, whatever their
structure: every eight bytes pass a mixing bijection, one after another.
"""

from __future__ import annotations

import numpy as np

U = np.uint64

SOLID = np.ones(256, bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = x + U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: Byte table of an exact comparison, where ``LOWER`` is that of words.
EXACT = np.arange(256, dtype=np.uint8)
#: Mask of the first k bytes of eight, and the bytes that one chain of eights takes.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], U)
_PART = 4096


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of every word."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = SOLID[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge[0] = edge[n] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:n]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:n]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = LOWER) -> np.ndarray:
    """Hashes of byte ranges; equal bytes give equal hashes wherever they stand.

    All ranges go eight bytes further at each step. A long one is cut into parts, and the hashes of its
    parts are hashed in the same way.
    """
    sizes = ends - starts
    state = mix(sizes.astype(U))
    eights = np.ndarray(len(data) + 1, "<u8", np.concatenate([table[data], np.zeros(8, np.uint8)]), strides=(1,))
    live = np.flatnonzero((sizes > 0) & (sizes <= _PART))
    at, left = starts[live], sizes[live]
    while len(live):
        state[live] = mix(state[live] ^ eights[at] & _FIRST[np.minimum(left, 8)])
        on = left > 8
        live, at, left = live[on], at[on] + 8, left[on] - 8
    long = np.flatnonzero(sizes > _PART)
    if len(long):
        parts = -(-sizes[long] // _PART)
        after = np.cumsum(parts)
        owner = np.repeat(long, parts)
        first = starts[owner] + (np.arange(len(owner)) - np.repeat(after - parts, parts)) * _PART
        inner = hash_spans(data, first, np.minimum(first + _PART, ends[owner]), table).astype("<u8")
        state[long] = mix(state[long] ^ hash_spans(inner.view(np.uint8), 8 * (after - parts), 8 * after, EXACT))
    return state


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word, in text order."""
    row, starts, ends = spans(data, offsets)
    return row, hash_spans(data, starts, ends)


_STEP = mix(np.arange(101, 133, dtype=U)) | U(1)


def shingles(row: np.ndarray, word: np.ndarray, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct ``size``-word shingles, sorted within each row.

    A row with fewer words has one shingle, the whole sequence; a row without words none.
    """
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    begins = np.ones(len(word), bool)
    if len(word) >= size:
        begins[: len(word) - size + 1] = row[: len(word) - size + 1] == row[size - 1 :]
        begins[len(word) - size + 1 :] = False
    else:
        begins[:] = False
    at = np.flatnonzero(begins)
    value = np.zeros(len(at), U)
    for k in range(size):
        value += word[at + k] * _STEP[k]
    owner = row[at]
    few = np.flatnonzero((count > 0) & (count < size))
    if len(few):
        short = np.zeros(len(few), U)
        for k in range(size - 1):
            has = count[few] > k
            short[has] += word[first[few[has]] + k] * _STEP[k]
        short += mix(count[few].astype(U))
        owner = np.concatenate([owner, few])
        order = np.argsort(owner, kind="stable")
        owner, value = owner[order], np.concatenate([value, short])[order]
    value = mix(value)
    bounds = np.searchsorted(owner, np.arange(rows + 1)).tolist()
    for begin, end in zip(bounds, bounds[1:]):
        if end - begin > 1:
            value[begin:end].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], value[new]
