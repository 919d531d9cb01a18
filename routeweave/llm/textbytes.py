"""Vectorised helpers on Arrow text columns: byte views, words and hashes.

Everything here works on one bounded piece of one Arrow batch inside a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)                       # odd, hence invertible mod 2^64
_BASE_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


#: Random-looking 64-bit value of every byte, from a rule.
BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0xD6E8FEB86659FD93))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(spaces: bytes) -> np.ndarray:
    """Table of 256 flags, false on the bytes of ``spaces``."""
    table = np.ones(256, dtype=bool)
    table[np.frombuffer(spaces, dtype=np.uint8)] = False
    return table


#: Words that end at white space: ``[^\x20\x09-\x0D]+``.
NOT_SPACE = byte_set(b"\x20\x09\x0a\x0b\x0c\x0d")


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column without copying; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    values = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return values, offsets


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``limit`` bytes: (first row, end row,
    bytes, offsets from 0).  A longer text is a run of its own."""
    values, offsets = as_bytes(column)
    n, row = len(offsets) - 1, 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end, values[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i < n (mod 2^64), kept up to one piece."""
    if len(_powers[0]) < n:
        size = max(n, PIECE_BYTES + 1)
        made = []
        for base in (_BASE, _BASE_INV):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            made.append(np.cumprod(p))
        if n > PIECE_BYTES + 1:
            return made[0][:n], made[1][:n]
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums: n + 1 values, see ``span_hash``."""
    p, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUE[values] * p[:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes anywhere."""
    _, inv = powers(len(prefix))
    h = (prefix[ends] - prefix[starts]) * inv[starts]
    return mix64(h + (ends - starts).astype(np.uint64) * _U(0xA24BAED4963EE407))


def words(values: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = NOT_SPACE
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (no word crosses a row) and, per row, the
    index of its first word (rows + 1 values)."""
    n = len(values)
    flag = np.zeros(n + 2, dtype=bool)
    flag[1:-1] = is_word[values]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    here, before = flag[1:], flag[:-1]
    starts = np.flatnonzero(here & (~before | edge))
    ends = np.flatnonzero(before & (~here | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(values: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = NOT_SPACE
                ) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every lower-cased word and the first word of each row."""
    low = LOWER[values]
    starts, ends, first = words(low, offsets, is_word)
    return span_hash(prefix_hash(low), starts, ends), first


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of every row; a row of 1 to k - 1 words
    is one shingle of all of them.  Returns (hashes, first shingle of row)."""
    n_words = np.diff(first)
    n = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(n_words.dtype))
    begin = np.concatenate([[0], np.cumsum(n)])
    row = np.repeat(np.arange(len(n)), n)
    start = first[:-1][row] + (np.arange(begin[-1]) - begin[:-1][row])
    size = np.minimum(n_words, k)[row]
    padded = np.concatenate([h, np.zeros(k, np.uint64)])
    out = size.astype(np.uint64)
    for i in range(k):
        out = np.where(i < size, out * _BASE + mix64(padded[start + i] + _U(i + 1)), out)
    return mix64(out), begin


def row_sums(x: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sum of ``x`` over each row's range [begin[i], begin[i + 1])."""
    c = np.concatenate([np.zeros(1, x.dtype), np.cumsum(x)])
    return c[begin[1:]] - c[begin[:-1]]
