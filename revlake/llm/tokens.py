"""Tokens of 21 bits for language models: frequent words as one symbol, everything else byte by byte.

A word is a run of ASCII letters and digits and of non-ASCII bytes, as written, with the space before it if there is
one. The vocabulary holds every word that the corpus has at least twice; where these are more than fit, all of the least
counts that don't fit go together, so ties aren't broken. A word outside the vocabulary, and each byte between words, is
spelled: no text is skipped and nothing is unknown. Symbol 0 stands before a text, 1 to 256 are bytes, the rest words,
in the order of their 63-bit hashes; words whose hashes are equal would share a symbol.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_file, put_file, resident, shared_dir, tidy, written
from .kneser_ney import GramCache, gram_counts
from .words import _BASE, _VALUES, WORD, mix

TOKEN_BITS = 21
WORDS = (1 << TOKEN_BITS) - 257
#: A symbol that is more than one of so many tokens is frequent: at most as many are.
FREQUENT = 100_000


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start with the space, end, hash) of each word."""
    word = WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(word & (~np.r_[False, word[:-1]] | edge[:-1]))
    ends = np.flatnonzero(word & (~np.r_[word[1:], False] | edge[1:])) + 1
    if not len(starts):
        return starts, ends, np.zeros(0, np.int64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    powers = np.full(int(lengths.max()), _BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    sums = np.add.reduceat(_VALUES[data[word]] * powers[place], first)
    spaced = ~edge[starts] & (data[starts - 1] == 32)
    return starts - spaced, ends, (mix(sums * np.uint64(2) + spaced.astype(np.uint64)) >> np.uint64(1)).astype(np.int64)


def _units(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashes of the words, and -256 to -1 for the bytes between them."""
    starts, ends, hashes = spans(data, offsets)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    return np.r_[hashes, data[np.cumsum(inside[:-1], dtype=np.int8) == 0].astype(np.int64) - 256]


def token_vocabulary(texts: DataFrame) -> tuple[str, int, int, dict[int, int]]:
    """(file of the sorted hashes of the vocabulary's words, number of symbols that a text may have, number of tokens, that of the frequent symbols).

    The numbers of tokens leave out the bytes of words outside the vocabulary; only the division into parts rests on them.
    """
    counts = written(gram_counts(texts.select(F.lit("").alias("model"), "text"), grams_of=_units).select("gram", "n"), "words")
    least, held = 2, 0
    # counts of counts: from the highest, as many as fit
    for r in sorted(counts.where("n > 1 and gram >= 0").groupBy("n").agg(F.count("*").alias("words")).collect(), key=lambda r: -r["n"]):
        held += r["words"]
        if held > WORDS:
            least = r["n"] + 1
            break
    uri = f"{shared_dir(texts.sparkSession, 'vocabulary')}/words"

    @tidy
    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate([np.zeros(0, np.int64), *(batch.column("gram").to_numpy() for batch in batches)])
        put_file(uri, np.sort(hashes).tobytes() or b"\xff" * 8)
        yield pa.RecordBatch.from_arrays([pa.array([len(hashes)])], ["n"])

    # at most WORDS numbers, sorted by one task
    words = counts.where((F.col("n") >= least) & (F.col("gram") >= 0)).select("gram").repartition(1).mapInArrow(put, "n long").agg(F.max("n")).first()[0] or 0
    if not words:
        put_file(uri, b"\xff" * 8)
    hashes = map_file(uri).view(np.int64)
    tokens = counts.agg(F.sum("n")).first()[0] or 0
    often = {0: texts.where("text != ''").count()}
    for r in counts.where(F.col("n") > tokens / FREQUENT).collect():
        at = r["gram"] + 257 if r["gram"] < 0 else int(np.searchsorted(hashes, r["gram"])) + 257
        often[at] = r["n"]
    return uri, 256 + words, tokens, often


class Tokens:
    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.cache = GramCache(self._symbols, bits=20)

    @staticmethod
    def of(uri: str) -> Tokens:
        return resident("lm", uri, lambda: Tokens(map_file(uri).view(np.int64)), 2)

    def _symbols(self, hashes: np.ndarray) -> np.ndarray:
        """0 for words outside the vocabulary; exact, as the cache's floats hold 24 bits."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at + 257, 0).astype(np.float32)

    def split(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, offsets) of the texts."""
        if not len(data):
            return np.zeros(0, np.int32), offsets
        starts, ends, hashes = spans(data, offsets)
        symbols = self.cache.get(hashes).astype(np.int32)
        known = symbols > 0
        starts, ends, symbols = starts[known], ends[known], symbols[known]
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts] += 1
        inside[ends] -= 1
        keep = np.cumsum(inside[:-1], dtype=np.int8) == 0
        keep[starts] = True
        out = data.astype(np.int32) + 1
        out[starts] = symbols
        return out[keep], np.r_[0, np.cumsum(keep)][offsets]
