"""Pre-token boundaries of byte-level BPE as a deterministic transducer run in parallel chunks.

The pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` is compiled by hand
into a transducer over character classes. A transition emits the boundaries that it decides: before the character it
reads, before the previous one (a look-ahead that failed), or both. Texts are cut into chunks of equal length;
each chunk's map from every entry state to its exit state is computed for all chunks at once, the maps compose
in a parallel prefix scan, and a second run from the true entry states emits the boundaries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex

OTHER, LETTER, NUMBER, SPACE, WHITE, QUOTE, SHORT, ELL, VEE, ARR, EEE, END = range(12)
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, QUOTED, QUOTE_L, QUOTE_V, QUOTE_R, ONE_SPACE, ONE_WHITE, MORE_SPACE, MORE_WHITE = range(12)
LETTERS = (LETTER, SHORT, ELL, VEE, ARR, EEE)
CHUNK = 512


def _tables() -> tuple[np.ndarray, np.ndarray]:
    goes, emits = np.zeros((12, 12), np.uint8), np.zeros((12, 12), np.uint8)
    opens = {OTHER: IN_OTHERS, NUMBER: IN_NUMBERS, SPACE: ONE_SPACE, WHITE: ONE_WHITE, QUOTE: QUOTED} | dict.fromkeys(LETTERS, IN_LETTERS)
    joins = opens | {QUOTE: IN_OTHERS}
    for state in range(12):
        for kind in range(12):
            go, emit = opens.get(kind, FRESH), int(kind != END)
            if kind == END:
                emit = 2 if state in (QUOTE_L, QUOTE_V, QUOTE_R) else 0
            elif (state == IN_LETTERS and kind in LETTERS) or (state == IN_NUMBERS and kind == NUMBER) or (state in (IN_OTHERS, QUOTED) and kind in (OTHER, QUOTE)):
                go, emit = joins[kind], 0
            elif state == QUOTED and kind in (SHORT, ELL, VEE, ARR):
                go, emit = {SHORT: FRESH, ELL: QUOTE_L, VEE: QUOTE_V, ARR: QUOTE_R}[kind], 0
            elif (state, kind) in ((QUOTE_L, ELL), (QUOTE_V, EEE), (QUOTE_R, EEE)):
                go, emit = FRESH, 0
            elif state in (QUOTE_L, QUOTE_V, QUOTE_R):
                emit = 2 if kind in LETTERS else 3
            elif state >= ONE_SPACE and kind in (SPACE, WHITE):
                go, emit = MORE_SPACE if kind == SPACE else MORE_WHITE, 0
            elif state in (ONE_SPACE, MORE_SPACE):
                go, emit = joins[kind], 0 if state == ONE_SPACE else 2
            elif state == MORE_WHITE:
                emit = 3
            goes[state, kind], emits[state, kind] = go, emit
    return goes, emits


GOES, EMITS = _tables()
_kinds: list[np.ndarray] = []


def kinds() -> np.ndarray:
    """Class of every code point."""
    if not _kinds:
        table = np.full(0x110000, OTHER, np.uint8)
        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", WHITE)):
            for m in regex.finditer(pattern, every):
                a, b = ord(every[m.start()]), ord(every[m.end() - 1])
                table[a : b + 1] = kind
        for chars, kind in ((" ", SPACE), ("'", QUOTE), ("sdmt", SHORT), ("l", ELL), ("v", VEE), ("r", ARR), ("e", EEE)):
            table[[*map(ord, chars)]] = kind
        _kinds.append(table)
    return _kinds[0]


def boundaries(symbols: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each symbol; texts end with END."""
    n = len(symbols)
    lanes = max(1, -(-n // CHUNK))
    padded = np.full(lanes * CHUNK, END, np.uint8)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(lanes, CHUNK).T)
    goes, emits = GOES.ravel(), EMITS.ravel()
    maps = np.repeat(np.arange(12, dtype=np.uint8)[:, None], lanes, axis=1)
    for kind in columns:
        maps = goes[maps * np.uint8(12) + kind]
    step = 1
    while step < lanes:
        later = np.take_along_axis(maps[:, step:], maps[:, :-step], axis=0)
        maps = np.concatenate([maps[:, :step], later], axis=1)
        step *= 2
    state = np.r_[np.uint8(FRESH), maps[FRESH, :-1]]
    out = np.empty_like(columns)
    for k, kind in enumerate(columns):
        at = state * np.uint8(12) + kind
        out[k] = emits[at]
        state = goes[at]
    emitted = out.T.ravel()[:n]
    start = (emitted & 1).astype(bool)
    start[:-1] |= emitted[1:] > 1
    return start


def pretokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte places of the pre-tokens and the end, places of each row's pre-tokens) of UTF-8 rows."""
    if not len(data):
        return np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    ends = np.searchsorted(chars, offsets[1:])
    place = np.arange(len(points)) + np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
    symbols = np.full(len(points) + len(ends), END, np.uint8)
    symbols[place] = kinds()[points]
    starts = chars[boundaries(symbols)[place]]
    return np.r_[starts, len(data)], np.searchsorted(starts, offsets)


def distinct(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(place of each pre-token among the distinct ones, the distinct ones)."""
    array = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(np.ascontiguousarray(cuts, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    coded = array.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()
