"""A one-hash Bloom filter of 16-byte digests in the shared folder, to keep rows that can't match out of a shuffle.

It only ever saves work: rows that it lets through are joined exactly. Its size follows the number of digests up to
``MOST_BITS``; beyond some 10^8 digests it lets more and more rows through, and the join is an ordinary one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_file, put_file, resident, shared_dir, tidy

LEAST_BITS, MOST_BITS, SLICE_BITS = 1 << 16, 1 << 30, 1 << 24


def _slots(digests: list[bytes], bits: int) -> np.ndarray:
    head = np.frombuffer(b"".join(digests), ">u8")[::2]
    return (head.astype(np.uint64) >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)


class Bitmap:
    """The slices, mapped into memory; a missing one is empty."""

    def __init__(self, folder: str, bits: int, made: list[int], slice_bits: int):
        self.bits, self.slice_bits, self.slices = bits, slice_bits, {s: map_file(f"{folder}/{s}.bits") for s in made}

    def holds(self, digests: list[bytes]) -> np.ndarray:
        slots = _slots(digests, self.bits)
        out, of = np.zeros(len(slots), bool), slots // self.slice_bits
        for s in np.unique(of):
            own = np.flatnonzero(of == s)
            if int(s) in self.slices:
                at = slots[own] % self.slice_bits
                out[own] = self.slices[int(s)][at >> 3] >> (at & 7).astype(np.uint8) & 1
        return out


def bitmap(digests: DataFrame, n: int, slice_bits: int = SLICE_BITS) -> dict:
    """What ``may_hold`` takes, of ``n`` digests in the column ``node``."""
    bits = int(min(MOST_BITS, max(LEAST_BITS, 1 << (32 * n).bit_length())))
    folder, slices = shared_dir(digests.sparkSession, "bitmap"), max(1, bits // slice_bits)
    size = bits // slices // 8
    # The slice is the digest's first bits, so a slice's rows meet in one task.
    top = F.conv(F.hex(F.substring("node", 1, 4)), 16, 10).cast("long")
    placed = digests.select("node", F.shiftright(top, 32 - (slices.bit_length() - 1)).cast("int").alias("slice"))

    @tidy
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            slots, own = _slots(batch.column("node").to_pylist(), bits), batch.column("slice").to_numpy()
            for s in np.unique(own):
                marks = held.setdefault(int(s), np.zeros(size * 8, np.uint8))
                marks[slots[own == s] % slice_bits] = 1
        for s, marks in held.items():
            put_file(f"{folder}/{s}.bits", np.packbits(marks, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32())], ["slice"])

    made = [r["slice"] for r in placed.repartition(slices, "slice").mapInArrow(build, "slice int").collect()]
    return {"folder": folder, "bits": bits, "made": made, "slice_bits": slice_bits}


def may_hold(digest: Column, made: dict) -> Column:
    """False only where the digest is certainly not among those of the bitmap; null digests are not."""

    @F.pandas_udf("boolean")
    def holds(column: pd.Series) -> pd.Series:
        held = resident("bitmap", made["folder"], lambda: Bitmap(**made))
        known = column.notna().to_numpy()
        out = np.zeros(len(column), bool)
        if known.any():
            out[known] = held.holds(column[known].tolist())
        return pd.Series(out)

    return holds(digest)
