"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification.

Containment of an item in a document is the share of the item's distinct word shingles that the document has.
MinHash estimates Jaccard similarity, which a short item in a long document has next to none of, so sizes are
partitioned on both sides: items by their number of shingles into classes (S/2, S], and for each class the
documents that are large enough into segments of 2 S shingles at a stride of S. A run of an item's shingles lies
whole in some segment, and segment and item differ in size by a small factor. Signatures are one-permutation
MinHash with 8 S bins; every bin is a band of one row, so a segment and an item are a candidate when they share one
bin's minimum. The exact containment in the whole document decides.

Sampling a few shingles may miss the only one that counts, so an item of up to ``EXACT`` shingles keeps its whole hash set as its
sketch, and documents look all of theirs up. Of such an item only as many of its rarest shingles are filed as some one of
which a document with enough of them must have, so shingles that many items share make few candidates. A larger item
shares at least 9 shingles with a document that contains half of it; that each of them loses its bin to another of a segment's, which
is a quarter of a shingle a bin, has a chance below 10^-7.

Nothing is shuffled: the items' index is built by tasks into files of bounded size in the shared folder, which the
document tasks map into memory one after the other. Ids of either table may be of any type and stay as they are. Null and empty
texts contain nothing; an item without words is in no document; an item of fewer words than a shingle is only in documents with
the same few words. Items or rows that repeat are reported each time, with the ids they have; equal containments are all reported.
Texts of any length are searched whole. An empty benchmark is in no document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import map_file, put_file, resident, shared_dir, tidy
from .lm_trie import pack, unpack
from .words import shingle_hashes, word_chunks

SHINGLE = 4
THRESHOLD = 0.5
LEAST, BINS = 16, 8
#: Items of up to so many shingles are looked up by each of them.
EXACT = 16
#: Bytes of item texts in one index file.
SHARD_BYTES = 16 << 20
_NONE = np.uint32(0xFFFFFFFF)


def size_class(q: np.ndarray) -> np.ndarray:
    """The least power of two that is at least q and LEAST."""
    return np.maximum(LEAST, 1 << np.ceil(np.log2(np.maximum(q, 1))).astype(np.int64))


def bin_minima(h: np.ndarray, group: np.ndarray, groups: int, bins: int) -> np.ndarray:
    """[groups, bins] least value of each bin."""
    out = np.full(groups * bins, _NONE, np.uint32)
    shift = np.uint64(64 - (bins.bit_length() - 1))
    np.minimum.at(out, group * bins + (h >> shift).astype(np.int64), h.astype(np.uint32))
    return out.reshape(groups, bins)


def _keys(minima: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the bins that have a value."""
    at = np.flatnonzero(minima.ravel() != _NONE)
    return at // minima.shape[1], (at % minima.shape[1]).astype(np.uint64) << np.uint64(32) | minima.ravel()[at]


def ids_to_bytes(ids: pa.Array) -> np.ndarray:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([ids], ["id"])
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return np.frombuffer(sink.getvalue(), np.uint8)


def build_index(items: list[np.ndarray], ids: pa.Array, threshold: float) -> bytes:
    """File of one shard: per size class its sorted keys, their items and a filter; then each item's shingles, and the ids."""
    sizes = np.array([len(s) for s in items], np.int64)
    every = np.concatenate(items or [np.zeros(0, np.uint64)])
    value, often = np.unique(every, return_counts=True)
    classes = np.unique(size_class(sizes[sizes > 0]))
    arrays = [ids_to_bytes(ids), classes, np.r_[0, np.cumsum(sizes)], every]
    for c in classes:
        own = np.flatnonzero((size_class(sizes) == c) & (sizes > 0))
        if c <= EXACT:
            keep = []
            for i in own:
                h = items[i]
                rare = np.argsort(often[np.searchsorted(value, h)], kind="stable")
                keep.append(h[rare[: len(h) - least_shared(len(h), threshold) + 1]])
            row, key = np.repeat(np.arange(len(own)), [*map(len, keep)]), np.concatenate(keep)
        else:
            h = np.concatenate([items[i] for i in own])
            row, key = _keys(bin_minima(h, np.repeat(np.arange(len(own)), sizes[own]), len(own), BINS * int(c)))
        by = np.argsort(key, kind="stable")
        seen = np.zeros(1 << max(10, (16 * len(key)).bit_length()), np.uint8)
        seen[key & np.uint64(len(seen) - 1)] = 1
        arrays += [key[by], own[row[by]], seen]
    return pack(arrays)


def least_shared(n: int, threshold: float) -> int:
    """The least number of an item's n shingles whose share reaches the threshold."""
    k = max(1, int(threshold * n) - 1)
    while k / n < threshold and k < n:
        k += 1
    return k


class Index:
    def __init__(self, uri: str):
        parts = unpack(map_file(uri))
        self.ids = pa.ipc.open_stream(pa.py_buffer(np.ascontiguousarray(parts[0]))).read_all().column("id").combine_chunks()
        self.classes, self.cuts, self.shingles = parts[1:4]
        self.levels = [parts[4 + 3 * k : 7 + 3 * k] for k in range(len(self.classes))]

    def search(self, h: np.ndarray, row: np.ndarray, at: np.ndarray, threshold: float) -> list[tuple[int, int, float]]:
        """(row, item's place, containment) of the items that rows of shingles contain; at: places of each row's shingles."""
        n = np.diff(at)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for c, (keys, owners, seen) in zip(self.classes, self.levels, strict=True):
            c = int(c)
            if c <= EXACT:
                key, of = h, row
            else:
                large = n >= least_shared(c // 2 + 1, threshold)
                pick = large[row]
                if not pick.any():
                    continue
                blocks = np.where(large, -(-n // c), 0)
                first = np.r_[0, np.cumsum(blocks)]
                place = np.arange(len(h))[pick] - at[:-1][row[pick]]
                minima = bin_minima(h[pick], first[row[pick]] + place // c, int(first[-1]), BINS * c)
                owner = np.repeat(np.arange(len(n)), blocks)
                same = np.flatnonzero(owner[1:] == owner[:-1])
                single = first[:-1][blocks == 1]
                segment, key = _keys(np.concatenate([np.minimum(minima[same], minima[same + 1]), minima[single]]))
                of = np.r_[owner[same], owner[single]][segment]
            maybe = np.flatnonzero(seen[key & np.uint64(len(seen) - 1)])
            key, of = key[maybe], of[maybe]
            lo, hi = np.searchsorted(keys, key), np.searchsorted(keys, key, "right")
            hit = np.flatnonzero(hi > lo)
            times = hi[hit] - lo[hit]
            which = np.arange(times.sum()) + np.repeat(lo[hit] - (np.cumsum(times) - times), times)
            found.append((np.repeat(of[hit], times), owners[which]))
        rows = np.concatenate([np.zeros(0, np.int64), *[r for r, _ in found]])
        items = np.concatenate([np.zeros(0, np.int64), *[i for _, i in found]])
        pairs = np.unique(rows * np.int64(len(self.cuts)) + items)
        out, held = [], (-1, None)
        for r, item in zip((pairs // len(self.cuts)).tolist(), (pairs % len(self.cuts)).tolist(), strict=True):
            if held[0] != r:
                held = r, np.unique(h[at[r] : at[r + 1]])
            own = self.shingles[self.cuts[item] : self.cuts[item + 1]]
            share = np.isin(own, held[1], assume_unique=True).sum() / len(own)
            if share >= threshold:
                out.append((r, item, float(share)))
        return out


def benchmark_index(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", threshold: float = THRESHOLD, shingle: int = SHINGLE) -> list[str]:
    """Files of the items' index. Items with equal ids and texts stay apart."""
    items = benchmark.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text != ''")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(-(-size // SHARD_BYTES))
    folder = shared_dir(benchmark.sparkSession, "benchmark")

    @tidy
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, ids = None, [], []

        def flush() -> pa.RecordBatch:
            done = [shard] if held else []
            if held:
                put_file(f"{folder}/{shard}.index", build_index(held, pa.concat_arrays(ids), threshold))
            return pa.RecordBatch.from_arrays([pa.array(done, pa.int32())], ["shard"])

        for batch in batches:
            place = batch.column("shard").to_numpy()
            for a, b, words, at in word_chunks(batch.column("text")):
                h, row = shingle_hashes(words, at, shingle)
                cut = np.searchsorted(row, np.arange(b - a + 1))
                for k in range(b - a):
                    if place[a + k] != shard:
                        yield flush()
                        shard, held, ids = int(place[a + k]), [], []
                    if cut[k + 1] > cut[k]:
                        held.append(np.unique(h[cut[k] : cut[k + 1]]))
                        ids.append(batch.column("id").slice(a + k, 1))
        yield flush()

    if not shards:
        return []
    placed = items.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(shards)).cast("int"))
    made = placed.repartition(shards, "shard").sortWithinPartitions("shard", "text").mapInArrow(build, "shard int").collect()
    return sorted(f"{folder}/{r['shard']}.index" for r in made)


def _matches(column: pa.Array, files: list[str], threshold: float, shingle: int) -> Iterator[tuple[int, pa.Array, float]]:
    """(row, item id, containment) of a column of texts."""
    for a, _, words, at in word_chunks(column, 2 << 20):
        h, row = shingle_hashes(words, at, shingle)
        cut = np.searchsorted(row, np.arange(len(at)))
        for uri in files:
            index = resident("decontamination", uri, lambda uri=uri: Index(uri), 8)
            for r, item, share in index.search(h, row, cut, threshold):
                yield a + r, index.ids.slice(item, 1), share


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD, shingle: int = SHINGLE
) -> DataFrame:
    """(doc_id, item_id, containment) of each document that holds at least ``threshold`` of an item's shingles."""
    files = benchmark_index(benchmark, item_col, item_text_col, threshold, shingle)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)

    @tidy
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_matches(batch.column("text"), files, threshold, shingle))
            ids = batch.column("doc_id").take(pa.array([r for r, _, _ in found], pa.int64()))
            items = pa.concat_arrays([i for _, i, _ in found]) if found else pa.nulls(0, item_type)
            yield pa.RecordBatch.from_arrays([ids, items, pa.array([s for *_, s in found], pa.float64())], ["doc_id", "item_id", "containment"])

    kinds = [rows.schema["doc_id"].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()]
    return rows.mapInArrow(search, f"doc_id {kinds[0]}, item_id {kinds[1]}, containment double")


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD, shingle: int = SHINGLE
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item."""
    files = benchmark_index(benchmark, item_col, item_text_col, threshold, shingle)
    place = docs.columns.index(text_col)

    @tidy
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(len(batch), bool)
            clean[[r for r, _, _ in _matches(batch.column(place).cast(pa.string()), files, threshold, shingle)]] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(keep, docs.schema)
