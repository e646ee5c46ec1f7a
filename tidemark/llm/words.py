"""Words of UTF-8 text as 64-bit hashes, vectorised over the byte buffer of an Arrow string column.

Both word classes in use (everything but ASCII white space; ASCII letters, digits and all non-ASCII) are unions of
whole byte values in UTF-8, so words can be cut on bytes. A word's hash is a polynomial over random byte values modulo
2**64 with a final mix; equal words have equal hashes, unequal ones collide with probability about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.Generator(np.random.PCG64(20240229))
_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
for _c in range(65, 91):  # A-Z count as a-z
    _VALUE[_c] = _VALUE[_c + 32]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_STEP = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Word bytes: all but ASCII white space / ASCII letters and digits and every byte of a non-ASCII character.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

#: Texts are worked on in blocks of about so many bytes, and the words of a longer text in pieces of as many.
BLOCK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer text is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, hi
        lo = hi


_POWERS = [np.ones(1, dtype=np.uint64)]
_UNPOWERS = [np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers, or more, of the base and of its inverse. Only as many as a block needs are held."""
    found = []
    for held, base in ((_POWERS, _BASE), (_UNPOWERS, _INVERSE)):
        x = held[0]
        if len(x) < n:
            x = np.full(max(n, BLOCK_BYTES + 2), base, dtype=np.uint64)
            x[0] = 1
            x = np.multiply.accumulate(x)
            if n <= BLOCK_BYTES + 2:
                held[0] = x
        found.append(x)
    return found[0], found[1]


def hashes(raw: np.ndarray, offsets: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, its first byte, the byte after it, offsets of each row's words)."""
    n = len(raw)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(offsets), dtype=np.int64)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = kept[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    found = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):  # a piece begins with a word, so its words have the hashes that they have anywhere
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + BLOCK_BYTES, side="right")))
        size = int(ends[j - 1] - lo)
        up, down = powers(size + 1)
        total = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_VALUE[raw[lo : lo + size]] * up[:size], out=total[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        found[i:j] = mix((total[b] - total[a]) * down[a])
        i = j
    return found, starts, ends, np.searchsorted(starts, offsets)


def sequences(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive words in one array of word hashes."""
    out = h[: len(h) - k + 1] * _STEP[0]
    for j in range(1, k):
        out = out + h[j : len(h) - k + 1 + j] * _STEP[j]
    return mix(out + np.uint64(k))
