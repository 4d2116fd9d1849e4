"""Words and word shingles as columns of 64-bit hashes, computed over whole Arrow batches.

A word is a run of ASCII letters and digits and of non-ASCII characters, in lower case. A shingle is ``n``
consecutive words; a text of fewer words has one shingle of them all, a text without words none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import string_bytes, row_chunks

WORD = np.zeros(256, bool)
WORD[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
WORD[128:] = True
_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SHINGLE = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6EF372FE94F82B)]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, places of each row's words) of lower-cased UTF-8 rows."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.r_[False, word[:-1]]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.r_[word[1:], False]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    powers = np.full(int(lengths.max()), _BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    return mix(np.add.reduceat(_VALUES[data[word]] * powers[place], first)), np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each shingle, its row), rows in order."""
    lengths = np.diff(at)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(words))
    total = np.zeros(len(words), np.uint64)
    for k in range(n):
        own = words[k:] * _SHINGLE[k % 8] + np.uint64(k)
        inside = place[: len(own)] + k < at[1:][row[: len(own)]]
        total[: len(own)] += np.where(inside, own, np.uint64(0))
    keep = (place + n <= at[1:][row]) | (place == at[:-1][row])
    return mix(total[keep]), row[keep]


def distinct_by_row(values: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value of 44 bits, row, count) of the distinct values of each row; at most 2^20 rows."""
    assert rows <= 1 << 20
    key = np.sort(row.astype(np.uint64) << np.uint64(44) | values >> np.uint64(20))
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.r_[first, len(key)])
    key = key[first]
    return key & np.uint64((1 << 44) - 1), (key >> np.uint64(44)).astype(np.int64), count


def lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.cast(pa.large_string()))


def word_chunks(column: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, word hashes, places) for ranges of rows."""
    data, offsets = string_bytes(lowered(column))
    for a, b in row_chunks(offsets, limit):
        yield a, b, *word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
