"""LM scoring: an Elias-Fano trie of token 3-grams with quantised Kneser-Ney probabilities.

The grams (a, b, c) of all texts, tokens of ``tokens.py`` after two zero symbols, are counted by tasks, packed and shuffled once
to the part of their middle symbol. There a context (a, b) and the grams that end in (b, c) are whole, so one merge gives the
discounted probabilities' sums, and the counts of distinct predecessors that are the next lower order. A middle symbol that is more
frequent than a part is large is split by the first one, which keeps contexts whole; lower counts of its pieces add up. The
smoothing is interpolated modified Kneser-Ney over a uniform base (``kneser_ney.py``).

The trie has a root of all symbols (with probability and back-off weight), pairs in parts of their first symbol and triples in
parts of their middle one. The successors of a symbol are kept as ranks among the root's symbols, those of a context
(a, b) as ranks among the successors of b, the context without its first symbol: small numbers, made monotone by adding
the end of the sibling range before. They, the contexts and the starts of sibling ranges are Elias-Fano sequences; a gram
is found by a successor search in its siblings. Groups of parts are files in the shared folder, which scoring tasks map into memory;
one call looks up in all parts of a group.

A score is the bits of all symbols of a text over its bytes. Null and empty texts have no bytes: 0 bytes and a null score. Rows with
equal ids stay as they are, rows with equal texts get equal scores, and each counts as often as it occurs. Texts may be of any
length. A table without bytes has no model and only null scores.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import delete_dir, map_file, put_file, release, resident, shared_dir, text_chunks, tidy
from .kneser_ney import discounts
from .tokens import TOKEN_BITS, Tokens, token_vocabulary
from .words import mix

#: log2 of a probability is kept as a code of this step, up to 16 bits.
STEP = 1 / 1024
NONE = 65535
#: Tokens of the corpus for each part, and distinct grams that a task holds before it hands them on.
PART_TOKENS, HELD_GRAMS = 2_000_000, 2_000_000
#: Grams of texts that are scored together.
SCORED_GRAMS = 700_000
#: Parts of one file at most, and grams that are looked up at once: enough to outweigh a call, few enough for the CPU's cache.
GROUP_PARTS, LOOKED_UP = 8, 1 << 15
#: Files of counts of single symbols.
SLICES = 16
_MASK = (1 << TOKEN_BITS) - 1
_SLICE = (1 << TOKEN_BITS) // SLICES


_ONES, _TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_FIVES, _THREES, _FIFTEENS = np.uint64(0x5555555555555555), np.uint64(0x3333333333333333), np.uint64(0x0F0F0F0F0F0F0F0F)
#: Place of the r-th set bit of a byte, at 8 * byte + r.
_IN_BYTE = np.array([([k for k in range(8) if x >> k & 1] + [0] * 8)[r] for x in range(256) for r in range(8)], np.uint8)


def _select(words: np.ndarray, before: np.ndarray, i: np.ndarray, flip: np.uint64) -> np.ndarray:
    """Position of the i-th set bit of ``words ^ flip``; before: how many such bits stand before each word."""
    word = np.searchsorted(before, i.astype(np.uint32), "right") - 1
    w = words[word] ^ flip
    r = i.astype(np.uint64) - before[word]
    sums = w - (w >> np.uint64(1) & _FIVES)
    sums = (sums & _THREES) + (sums >> np.uint64(2) & _THREES)
    sums = (sums + (sums >> np.uint64(4)) & _FIFTEENS) * _ONES  # set bits up to each byte
    shift = np.bitwise_count((r * _ONES | _TOPS) - sums & _TOPS).astype(np.uint64) << np.uint64(3)
    r -= sums << np.uint64(8) >> shift & np.uint64(255)
    return (word << 6) + shift.astype(np.int64) + _IN_BYTE[((w >> shift & np.uint64(255)) << np.uint64(3) | r).astype(np.int64)]


def _trailing_ones(words: np.ndarray, at: np.ndarray, flip: np.uint64) -> np.ndarray:
    """How many set bits of ``words ^ flip`` stand in a row from each position, up to 64."""
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    window = (words[word] ^ flip) >> shift
    after = np.minimum(word + 1, len(words) - 1)
    window |= (words[after] ^ flip) << np.uint64(63) - shift << np.uint64(1)
    clear = ~window
    return np.bitwise_count((clear & -clear) - np.uint64(1)).astype(np.int64)


_FLIP = np.uint64(0xFFFFFFFFFFFFFFFF)


class EliasFano:
    """Strictly or weakly increasing sequences of numbers from 0, one for each segment: low bits packed, high bits in unary.

    The segments' bits stand one after the other, so one call looks up in all of them. A place counts through all segments.
    """

    def __init__(self, head: np.ndarray, low: np.ndarray, words: np.ndarray, ones: np.ndarray, zeros: np.ndarray):
        self.head, self.low, self.words, self.ones, self.zeros = head, low, words, ones, zeros
        n, self.bits, size, length = head.reshape(-1, 4).T
        start = lambda x: np.cumsum(x) - x
        self.n, self.first = int(n.sum()), start(n)
        self.gaps = (length << 6) - n
        self.zero = start(self.gaps)
        self.end = self.first + n
        self.low_bit = (start(size) << 3) - self.first * self.bits
        self.mask = (np.int64(1) << self.bits) - 1
        self.low64 = np.ndarray((max(0, len(low) - 7),), np.uint64, low, 0, (1,))

    @staticmethod
    def encode(values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        universe = int(values[-1]) + 1 if n else 1
        bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        blocks = [values[a : a + 65536] for a in range(0, n, 65536)] if bits else []
        low = np.concatenate([np.zeros(0, np.uint8), *[np.packbits(((v[:, None] >> np.arange(bits)) & 1).astype(np.uint8).ravel(), bitorder="little") for v in blocks], np.zeros(8, np.uint8)])
        unary = np.zeros(-(-(n + (universe >> bits) + 2) // 64) * 64, np.uint8)
        unary[(values >> bits) + np.arange(n)] = 1
        words = np.packbits(unary, bitorder="little").view(np.uint64)
        ones = np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)
        return EliasFano(np.array([n, bits, len(low), len(words)]), low, words, ones.astype(np.uint32), (np.arange(len(words)) * 64 - ones).astype(np.uint32))

    @staticmethod
    def joined(parts: list[EliasFano]) -> list[list[np.ndarray]]:
        """Pieces of the arrays of a sequence whose segments are those of all parts."""
        n, zeros = (np.cumsum([0, *x]).astype(np.uint32) for x in ([p.n for p in parts], [int(p.gaps.sum()) for p in parts]))
        return [[p.head for p in parts], [p.low for p in parts], [p.words for p in parts], [p.ones + k for p, k in zip(parts, n)], [p.zeros + k for p, k in zip(parts, zeros)]]

    def _low(self, i: np.ndarray, segment: np.ndarray) -> np.ndarray:
        bit = i * self.bits[segment] + self.low_bit[segment]
        return (self.low64[bit >> 3] >> (bit & 7).astype(np.uint64)).astype(np.int64) & self.mask[segment]

    def _value(self, at: np.ndarray, i: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Value of the i-th number, whose bit of the high ones stands at ``at``."""
        return (at - i - self.zero[segment] << self.bits[segment]) | self._low(i, segment)

    def get(self, i: np.ndarray, segment: np.ndarray | None = None) -> np.ndarray:
        return self._value(_select(self.words, self.ones, i, np.uint64(0)), i, np.zeros(len(i), np.int64) if segment is None else segment)

    def get_two(self, i: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the i-th number and the next, which is of the same segment."""
        at = _select(self.words, self.ones, i, np.uint64(0))
        gap = _trailing_ones(self.words, at + 1, _FLIP)
        then = at + 1 + gap
        far = np.flatnonzero(gap == 64)
        if len(far):
            then[far] = _select(self.words, self.ones, i[far] + 1, np.uint64(0))
        return self._value(at, i, segment), self._value(then, i + 1, segment)

    def _search(self, x: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the segment's first element that is at least x, whether it has the high bits of x).

        The elements with these high bits are a range between two zeros, where the low bits are searched by halves.
        A segment's last bit is a zero, so the first range of the next one stands between two zeros, too.
        """
        high, i = x >> self.bits[segment], self.end[segment]
        end, inside = i.copy(), np.flatnonzero(high < self.gaps[segment])
        zero = high[inside] + self.zero[segment[inside]]
        at = np.where(zero > 0, _select(self.words, self.zeros, np.maximum(zero - 1, 0), _FLIP) + 1, 0)
        run = _trailing_ones(self.words, at, np.uint64(0))
        i[inside] = at - zero
        end[inside] = at - zero + run
        far = np.flatnonzero(run == 64)
        if len(far):
            end[inside[far]] = _select(self.words, self.zeros, zero[far], _FLIP) - zero[far]
        open_ = np.flatnonzero(i < end)
        own, first, till = segment[open_], i[open_], end[open_]
        low = x[open_] & self.mask[own]
        while len(open_):
            middle = first + till >> 1
            less = self._low(middle, own) < low
            first, till = np.where(less, middle + 1, first), np.where(less, till, middle)
            going = np.flatnonzero(first < till)
            if len(going) < len(open_):
                i[open_] = first
                open_, own, first, till, low = (c[going] for c in (open_, own, first, till, low))
        return i, i < end

    def successor(self, x: np.ndarray, segment: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(place, value) of the segment's first element that is at least x; its end and value -1 if there is none."""
        segment = np.zeros(len(x), np.int64) if segment is None else segment
        i, _ = self._search(x, segment)
        value = np.full(len(x), -1, np.int64)
        there = np.flatnonzero(i < self.end[segment])
        if len(there):
            value[there] = self.get(i[there], segment[there])
        return i, value

    def find(self, x: np.ndarray, segment: np.ndarray | None = None) -> np.ndarray:
        """Place of the segment's first element equal to x, -1 if there is none: its successor, which is x."""
        segment = np.zeros(len(x), np.int64) if segment is None else segment
        i, near = self._search(x, segment)
        at = np.flatnonzero(near)
        i[~near] = -1
        own = segment[at]
        i[at[self._low(i[at], own) != x[at] & self.mask[own]]] = -1
        return i

    def arrays(self) -> list[np.ndarray]:
        return [self.head, self.low, self.words, self.ones, self.zeros]

    @staticmethod
    def from_arrays(parts: list[np.ndarray]) -> EliasFano:
        return EliasFano(*parts)


def file_blocks(arrays: list[list[np.ndarray]]) -> Iterator[bytes]:
    """One file: a line of JSON with each array's type and length, then the arrays, each of pieces, at multiples of 8 bytes."""
    head = json.dumps([[str(a[0].dtype), sum(map(len, a))] for a in arrays]).encode()
    yield head + b" " * (-(len(head) + 1) % 8) + b"\n"
    for a in arrays:
        yield from (x.tobytes() for x in a)
        yield b"\0" * (-sum(x.nbytes for x in a) % 8)


def pack(arrays: list[np.ndarray]) -> bytes:
    return b"".join(file_blocks([[a] for a in arrays]))


def unpack(data: np.ndarray) -> list[np.ndarray]:
    head = 0
    while data[head] != 10:
        head += 1
    at, out = head + 1, []
    for dtype, n in json.loads(bytes(data[:head])):
        size = np.dtype(dtype).itemsize * n
        out.append(np.frombuffer(data, dtype, n, at))
        at += size + -size % 8
    return out


def quantise(p: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-np.log2(p) / STEP), NONE - 1).astype(np.uint16)


def packed(*columns: np.ndarray) -> bytes:
    """Columns of int64 as bytes: the first as differences, all by planes of bytes, compressed."""
    codec, parts = pa.Codec("zstd", compression_level=1), []
    for j, c in enumerate(columns):
        c = np.diff(c, prepend=0) if j == 0 else c
        parts.append(codec.compress(np.ascontiguousarray(c.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes(), asbytes=True) if len(c) else b"")
    return np.array([len(columns[0]), *map(len, parts)], np.int64).tobytes() + b"".join(parts)


def unpacked(data: bytes | memoryview, columns: int) -> list[np.ndarray]:
    n, *sizes = np.frombuffer(data, np.int64, columns + 1).tolist()
    codec, at, out = pa.Codec("zstd"), 8 * (columns + 1), []
    for j, size in enumerate(sizes):
        planes = np.frombuffer(codec.decompress(data[at : at + size], 8 * n, asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
        c = np.ascontiguousarray(planes.reshape(8, -1).T).view(np.int64).ravel()
        out.append(np.cumsum(c) if j == 0 else c)
        at += size
    return out


def merged(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, sums of their counts)."""
    key, n = (np.concatenate(c) for c in zip(*pieces, strict=True))
    by = np.argsort(key, kind="stable")
    key, n = key[by], n[by]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(n, first)


def token_grams(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """b, a, c of the gram that ends at each token, packed in this order: a context's grams are neighbours, and a middle symbol's."""
    c = tokens.astype(np.int64)
    b, a = np.r_[0, c[:-1]][: len(c)], np.r_[0, 0, c[:-2]][: len(c)]
    starts = offsets[:-1][np.diff(offsets) > 0]
    b[starts] = a[starts] = 0
    second = starts + 1
    a[second[second < len(c)]] = 0
    a[starts] = 0
    return b << 2 * TOKEN_BITS | a << TOKEN_BITS | c


class Parts:
    """Which part a context (a, b) is in: that of b, or one of several where b is hot."""

    def __init__(self, n: int, hot: list[int], pieces: list[int]):
        self.n, self.hot, self.pieces = n, np.array(hot, np.int64), np.array(pieces, np.int64)

    def of_symbol(self, b: np.ndarray) -> np.ndarray:
        return (mix(b.astype(np.uint64) + np.uint64(1)) % np.uint64(self.n)).astype(np.int64)

    def of_context(self, b: np.ndarray, a: np.ndarray) -> np.ndarray:
        out = self.of_symbol(b)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, b), len(self.hot) - 1)
            split = np.flatnonzero(self.hot[at] == b)
            piece = (mix(a[split].astype(np.uint64) + np.uint64(1)) % self.pieces[at[split]].astype(np.uint64)).astype(np.int64)
            out[split] = (out[split] + piece * max(1, self.n // 7)) % self.n
        return out


_ROWS = "part int, kind int, data binary"
_NAMES = ["part", "kind", "data"]
PAYLOAD, STATS = 0, 1


def _row_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, kind, data = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(data, pa.binary())], _NAMES)


def _by_part(key: np.ndarray, n: np.ndarray, part: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    by = np.argsort(part, kind="stable")
    key, n, part = key[by], n[by], part[by]
    cuts = np.r_[0, np.flatnonzero(part[1:] != part[:-1]) + 1, len(part)]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if a < b:
            yield int(part[a]), PAYLOAD, packed(key[a:b], n[a:b])


def _stats(level: int, n: np.ndarray) -> tuple[int, int, bytes]:
    return 0, STATS, np.array([level, *(int((n == k).sum()) for k in (1, 2, 3, 4)), int(n.sum()), len(n)], np.int64).tobytes()


def _merge(rows: DataFrame, folder: str, level: int, parts: int, lower) -> DataFrame:
    """Merge the counts of each part, keep them as a file, and pass on what ``lower`` makes of the keys (if any) and the statistics."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = [], None

        def flush() -> pa.RecordBatch:
            if not held:
                return _row_batch([])
            key, n = merged(held)
            put_file(f"{folder}/counts{level}/{part}", packed(key, n))
            held.clear()
            return _row_batch([_stats(level, n), *(lower(key) if lower else ())])

        for batch in batches:
            for p, kind, data in zip(batch.column("part").to_pylist(), batch.column("kind").to_pylist(), batch.column("data"), strict=True):
                if kind == STATS:
                    yield _row_batch([(p, kind, data.as_py())])
                    continue
                if p != part:
                    yield flush()
                    part = p
                held.append(tuple(unpacked(data.as_buffer().to_pybytes(), 2)))
                if len(held) > 1 and sum(len(k) for k, _ in held) > 1.5 * HELD_GRAMS:
                    held[:] = [merged(held)]
        yield flush()

    return rows.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, _ROWS)


def _read(folder: str, level: int, part: int) -> tuple[np.ndarray, np.ndarray]:
    try:
        return tuple(unpacked(map_file(f"{folder}/counts{level}/{part}").tobytes(), 2))
    except FileNotFoundError:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)


def count_levels(docs: DataFrame, text_col: str, vocabulary: str, parts: Parts, folder: str) -> dict[int, list[int]]:
    """Files of the counts of triples (b, a, c), pairs and symbols; {level: [n1, n2, n3, n4, total, rows]}."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            key, n = merged(held)
            held.clear()
            return _row_batch(list(_by_part(key, n, parts.of_context(key >> 2 * TOKEN_BITS, key >> TOKEN_BITS & _MASK))))

        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column("text")):
                if len(data):
                    held.append(np.unique(token_grams(*Tokens.of(vocabulary).split(data, offsets)), return_counts=True))
                    if sum(len(k) for k, _ in held) > 1.5 * HELD_GRAMS:
                        held[:] = [merged(held)]
                        if len(held[0][0]) > HELD_GRAMS:
                            yield flush()
        if held:
            yield flush()

    def pairs(key: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        pair, n = np.unique(key >> 2 * TOKEN_BITS << TOKEN_BITS | key & _MASK, return_counts=True)
        return _by_part(pair, n, parts.of_symbol(pair >> TOKEN_BITS))

    def symbols(key: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        symbol, n = np.unique(key & _MASK, return_counts=True)
        return _by_part(symbol, n, symbol // _SLICE)

    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(count, _ROWS)
    rows = _merge(rows, folder, 3, parts.n, pairs)
    rows = _merge(rows, folder, 2, parts.n, symbols)
    rows = _merge(rows, folder, 1, SLICES, None)
    sums: dict[int, np.ndarray] = {}
    for r in rows.where(f"kind = {STATS}").select("data").toLocalIterator():
        level, *n = np.frombuffer(r["data"], np.int64).tolist()
        sums[level] = sums.get(level, 0) + np.array(n)
    return {k: v.tolist() for k, v in sums.items()}


def _siblings(stored: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Ranks that grow within each context, made to grow throughout."""
    last = np.flatnonzero(context[1:] != context[:-1])
    ends = np.zeros(len(stored), np.int64)
    ends[last + 1] = stored[last]
    return stored + np.cumsum(ends)


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place of each run of equal values and the end, run of each place)."""
    first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)
    return np.r_[first, len(x)], np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(x)]))


class Root:
    """Probability and weight of every symbol, from the counts of symbols; the weights come with the pairs."""

    def __init__(self, counts: str, symbols: int, d: list[float]):
        read = [_read(counts, 1, s) for s in range(SLICES)]
        self.symbols = np.concatenate([k for k, _ in read])
        n = np.concatenate([n for _, n in read]).astype(np.float64)
        less = np.array(d)[np.minimum(n, 3).astype(int)]
        self.gamma = less.sum() / n.sum()
        self.place = np.zeros(1 << TOKEN_BITS, np.int64)
        self.place[self.symbols] = np.arange(1, len(self.symbols) + 1)
        self.p = np.full(1 << TOKEN_BITS, self.gamma / symbols)
        self.p[self.symbols] = (n - less) / n.sum() + self.gamma / symbols


def smoothed(context: np.ndarray, n: np.ndarray, d: list[float], low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(p, gamma of each context, first place of each context) of grams sorted by context, whose suffixes have probability ``low``."""
    cuts, run = _runs(context)
    less = np.array(d)[np.minimum(n, 3)]
    total = np.add.reduceat(n, cuts[:-1]).astype(np.float64) if len(n) else np.zeros(0)
    gamma = np.add.reduceat(less, cuts[:-1]) / total if len(n) else np.zeros(0)
    return (n - less) / total[run] + gamma[run] * low, gamma, cuts


Encoded = tuple[EliasFano, EliasFano, EliasFano, np.ndarray, np.ndarray]


def encode_level(context: np.ndarray, rank: np.ndarray, p: np.ndarray, gamma: np.ndarray, cuts: np.ndarray) -> Encoded:
    """Owners, starts of their children, the children's ranks, codes of weights and of probabilities: of one part."""
    owners = context[cuts[:-1]] if len(context) else context
    return *map(EliasFano.encode, (owners, cuts, _siblings(rank, context))), quantise(gamma), quantise(p)


def join_parts(parts: list[Encoded]) -> list[list[np.ndarray]]:
    """Pieces of the arrays of a group of parts, which are its segments: what ``Level`` takes."""
    *sequences, weight, code = map(list, zip(*parts, strict=True))
    return [*(a for x in sequences for a in EliasFano.joined(x)), weight, code]


def build_trie(docs: DataFrame, text_col: str = "text", part_tokens: int = PART_TOKENS) -> dict | None:
    """Count, smooth and encode the whole corpus; returns what ``Trie`` takes and the vocabulary, or None if it has no bytes."""
    spark = docs.sparkSession
    vocabulary, symbols, tokens, often = token_vocabulary(docs.select(F.col(f"`{text_col}`").cast("string").alias("text")))
    if not tokens:
        return None
    n = max(1, -(-tokens // part_tokens))
    hot = sorted((s, -(-k * n // tokens)) for s, k in often.items() if k * n > tokens)
    parts = Parts(n, [s for s, _ in hot], [k for _, k in hot])
    folder = shared_dir(spark, "trie")
    stats = count_levels(docs, text_col, vocabulary, parts, folder)
    d = {k: [0.0, *discounts(*v[:4])] for k, v in stats.items()}

    group = max(1, min(GROUP_PARTS, -(-n // (3 * spark.sparkContext.defaultParallelism))))

    def encode_part(root: Root, part: int) -> tuple[Encoded, Encoded]:
        """The pairs and triples of a part; those pairs that its triples end in may be of other parts."""
        key, count = _read(folder, 3, part)
        b, pair = key >> 2 * TOKEN_BITS, key >> 2 * TOKEN_BITS << TOKEN_BITS | key & _MASK
        low, rank = np.zeros(len(key)), np.zeros(len(key), np.int64)
        of = parts.of_symbol(b)
        for other in sorted({part, *np.unique(of).tolist()}):
            have, times = _read(folder, 2, other)
            p, gamma, cuts = smoothed(have >> TOKEN_BITS, times, d[2], root.p[have & _MASK])
            if other == part:
                pairs = encode_level(have >> TOKEN_BITS, root.place[have & _MASK], p, gamma, cuts)
            own = np.flatnonzero(of == other)
            at = np.searchsorted(have, pair[own])
            place = np.arange(len(have)) - np.repeat(cuts[:-1], np.diff(cuts)) + 1
            low[own], rank[own] = p[at], place[at]
        return pairs, encode_level(key >> TOKEN_BITS, rank, *smoothed(key >> TOKEN_BITS, count, d[3], low))

    @tidy
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = resident("lm", folder + "/root", lambda: Root(folder, symbols, d[1]), 2)
        for batch in batches:
            for first in batch.column("id").to_pylist():
                pairs, triples = zip(*(encode_part(root, part) for part in range(first, min(n, first + group))), strict=True)
                put_file(f"{folder}/{first // group}.pairs", file_blocks(join_parts(pairs)))
                del pairs
                put_file(f"{folder}/{first // group}.triples", file_blocks(join_parts(triples)))
        yield pa.RecordBatch.from_arrays([pa.array([0])], ["done"])

    spark.range(0, n, group, -(-n // group)).mapInArrow(encode, "done long").count()
    root = Root(folder, symbols, d[1])
    put_file(f"{folder}/root", pack([root.symbols.astype(np.int32), quantise(root.p[root.symbols])]))
    delete_dir(*[f"{folder}/counts{k}" for k in (1, 2, 3)])
    return {"folder": folder, "parts": n, "group": group, "hot": parts.hot.tolist(), "pieces": parts.pieces.tolist(), "gamma": float(root.gamma), "symbols": symbols, "vocabulary": vocabulary}


class Level:
    """Sibling ranges below sorted owners, in the segments of a group: pairs below symbols, triples below contexts."""

    def __init__(self, uri: str):
        parts = unpack(map_file(uri))
        self.owners, self.starts, self.ids = (EliasFano.from_arrays(parts[5 * k : 5 * k + 5]) for k in range(3))
        self.weight, self.code = parts[15], parts[16]

    def range_of(self, owner: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(weight code, first child, end, value before the first child's) of each owner; no weight and no children if it has none."""
        i = self.owners.find(owner, segment)
        own = np.flatnonzero(i >= 0)
        weight, lo, hi, before = np.full(len(owner), NONE, np.int64), *(np.zeros(len(owner), np.int64) for _ in range(3))
        if len(own):
            i, segment = i[own], segment[own]
            weight[own] = self.weight[i]
            first, end = self.starts.get_two(i + segment, segment)  # each segment has one start more than owners
            lo[own], hi[own] = first + self.ids.first[segment], end + self.ids.first[segment]
            inner = np.flatnonzero(first)
            before[own[inner]] = self.ids.get(lo[own[inner]] - 1, segment[inner])
        return weight, lo, hi, before

    def child(self, segment: np.ndarray, lo: np.ndarray, hi: np.ndarray, before: np.ndarray, stored: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank among the siblings, code) of the child with the stored rank; rank 0 if there is none. Successor search."""
        rank, code = np.zeros(len(lo), np.int64), np.full(len(lo), NONE, np.int64)
        at = np.flatnonzero((hi > lo) & (stored > 0))
        if len(at):
            i = self.ids.find(before[at] + stored[at], segment[at])
            ok = (i >= lo[at]) & (i < hi[at])
            at, i = at[ok], i[ok]
            rank[at], code[at] = i - lo[at] + 1, self.code[i]
        return rank, code

    def look_up(self, owner: np.ndarray, segment: np.ndarray, stored: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rank, code, weight code of the owner) of children; equal owners stand together."""
        cuts, run = _runs(owner)
        weight, *siblings = self.range_of(owner[cuts[:-1]], segment[cuts[:-1]])
        return *self.child(segment, *(c[run] for c in siblings), stored), weight[run]


class Trie:
    """The memory-mapped groups of parts below a folder; where the folder can't be mapped, at most ``held`` of them in memory."""

    def __init__(self, folder: str, parts: int, group: int, hot: list[int], pieces: list[int], gamma: float, symbols: int, held: int = 8):
        self.folder, self.parts, self.group, self.gamma, self.symbols, self.held = folder, Parts(parts, hot, pieces), group, gamma, symbols, held
        known, code = unpack(map_file(f"{folder}/root"))
        self.place = np.zeros(1 << TOKEN_BITS, np.int32)
        self.place[known] = np.arange(1, len(known) + 1)
        self.base = np.full(1 << TOKEN_BITS, np.log2(gamma) - np.log2(symbols), np.float32)
        self.base[known] = -STEP * code.astype(np.float32)
        self.levels: dict[str, Level] = {}

    def _level(self, name: str) -> Level:
        level = self.levels.get(name)
        if level is None:
            level = Level(f"{self.folder}/{name}")
            if not self.folder.startswith("file:") and len(self.levels) >= self.held:
                del self.levels[next(iter(self.levels))]
            self.levels[name] = level
        return level

    def _each(self, part: np.ndarray, kind: str) -> Iterator[tuple[Level, np.ndarray, np.ndarray]]:
        """(group, which grams are of it, their segments), up to ``LOOKED_UP`` at once."""
        by = np.argsort(part.astype(np.uint16) if self.parts.n <= 1 << 16 else part, kind="stable")
        group, segment = np.divmod(part[by], self.group)
        cuts, _ = _runs(group)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            level = self._level(f"{group[a]}.{kind}")
            for k in range(a, b, LOOKED_UP):
                yield level, by[k : min(b, k + LOOKED_UP)], segment[k : min(b, k + LOOKED_UP)]

    def log2(self, key: np.ndarray) -> np.ndarray:
        """log2 of the probability of each gram (b, a, c): that of c after a and b."""
        pair, inverse = np.unique(key >> 2 * TOKEN_BITS << TOKEN_BITS | key & _MASK, return_inverse=True)
        b, c = pair >> TOKEN_BITS, pair & _MASK
        rank, low = np.zeros(len(pair), np.int64), self.base[c].astype(np.float64)
        for level, own, segment in self._each(self.parts.of_symbol(b), "pairs"):
            rank[own], code, weight = level.look_up(b[own], segment, self.place[c[own]].astype(np.int64))
            low[own] = np.where(code != NONE, -STEP * code, low[own] - np.where(weight != NONE, STEP * weight, 0))
        rank, out, context = rank[inverse], low[inverse], key >> TOKEN_BITS
        for level, own, segment in self._each(self.parts.of_context(key >> 2 * TOKEN_BITS, context & _MASK), "triples"):
            _, code, weight = level.look_up(context[own], segment, rank[own])
            out[own] = np.where(code != NONE, -STEP * code, out[own] - np.where(weight != NONE, STEP * weight, 0))
        return out


def _settle(trie: Trie, held: list[tuple[int, int, np.ndarray, np.ndarray]], bits: np.ndarray) -> None:
    """Look up each gram of the texts held once, and sum up by text."""
    if held:
        key, rows = np.concatenate([key for *_, key in held]), [x[:3] for x in held]
        held.clear()
        key, inverse = np.unique(key, return_inverse=True)
        total, done = np.r_[0.0, np.cumsum(trie.log2(key)[inverse])], 0
        for a, b, at in rows:
            bits[a:b] = total[done + at[:-1]] - total[done + at[1:]]
            done += at[-1]
        del key, inverse, total
        release()


def scorer(model: dict | None):
    """The function of record batches (doc_id, text) that scores every row."""

    @tidy
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = resident("lm", model["folder"], lambda: Trie(**{k: v for k, v in model.items() if k != "vocabulary"}), 2) if model else None
        for batch in batches:
            n, bits, held = np.zeros(len(batch), np.int64), np.zeros(len(batch)), []
            for a, b, data, offsets in text_chunks(batch.column("text")):
                n[a:b] = np.diff(offsets)
                if trie and len(data):
                    tokens, at = Tokens.of(model["vocabulary"]).split(data, offsets)
                    held.append((a, b, at, token_grams(tokens, at)))
                    if sum(len(key) for *_, key in held) > SCORED_GRAMS:
                        _settle(trie, held, bits)
            _settle(trie, held, bits)
            empty = n == 0
            bits = bits / np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits, mask=empty), pa.array(np.exp2(bits), mask=empty), pa.array(n)], ["doc_id", "bits_per_byte", "perplexity", "n_bytes"])

    return score


def score_documents(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, bits_per_byte, perplexity, n_bytes) of every row under the trie."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scorer(model), f"doc_id {kind}, bits_per_byte double, perplexity double, n_bytes long")


def lm_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_tokens: int = PART_TOKENS) -> DataFrame:
    """Perplexity per byte of every document under the 3-gram model of the whole table."""
    return score_documents(docs, build_trie(docs, text_col, part_tokens), id_col, text_col)
