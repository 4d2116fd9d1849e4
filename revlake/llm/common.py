"""Plumbing shared by the operators: the shared folder, Arrow text access and columnar helpers."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that a task turns into NumPy columns at once.
CHUNK_BYTES = 2 << 20


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; only a local master may go without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="revlake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it again."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_fs(uri: str):
    """(pyarrow file system, path) of a URI, seen from driver and workers alike."""
    import pyarrow.fs as pafs

    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), os.path.abspath(uri)
    return pafs.FileSystem.from_uri(uri)


def put_file(uri: str, data: bytes | Iterable[bytes]) -> None:
    """Write a whole file, in one or block by block; a retried or doubled task leaves the same bytes under the same name."""
    fs, path = shared_fs(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        for block in [data] if isinstance(data, bytes) else data:
            out.write(block)
    fs.move(part, path)


def delete_dir(*uris: str) -> None:
    for uri in uris:
        fs, path = shared_fs(uri)
        with contextlib.suppress(FileNotFoundError):
            fs.delete_dir(path)


def map_file(uri: str) -> np.ndarray:
    """The file's bytes: memory-mapped where the shared folder is mounted, read once elsewhere."""
    import pyarrow.fs as pafs

    fs, path = shared_fs(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r")
    with fs.open_input_stream(path) as f:
        return np.frombuffer(f.read(), np.uint8)


_resident: dict[tuple[str, str], object] = {}


def resident(operator: str, key: str, make, most: int = 1):
    """What a worker process keeps between tasks: at most ``most`` objects of the operator that runs now, and of no other."""
    if (operator, key) not in _resident:
        if any(o != operator for o, _ in _resident):
            _resident.clear()
            gc.collect()
            release()
        while len(_resident) >= most:  # the one that has been there longest
            del _resident[next(iter(_resident))]
        _resident[operator, key] = make()
    return _resident[operator, key]


def release() -> None:
    """Give free pages back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(f):
    """A function of record batches that leaves no free memory behind: executors keep idle workers between tasks."""

    @functools.wraps(f)
    def run(batches):
        try:
            yield from f(batches)
        finally:
            release()

    return run


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes and 2^20 rows; a longer row is a range of its own."""
    a, rows = 0, len(offsets) - 1
    while a < rows:
        b = min(max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1), a + (1 << 20))
        yield a, b
        a = b


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) for ranges of rows."""
    data, offsets = string_bytes(column)
    for a, b in row_chunks(offsets, limit):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]

