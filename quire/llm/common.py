"""Pieces that the training-data operators share: staging through the shared
folder, slices of Arrow text columns, and vectorised word hashes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import hadoop_fs, shared_dir, stage_path

# A word is a run of bytes other than space and 0x09-0x0D.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (a bijection), so that every bit is usable."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
HASH_BYTES = 1 << 20       # bytes hashed together (a longer word on its own)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """BASE**i and its inverse modulo 2**64, for i < n; kept up to HASH_BYTES."""
    if _POWERS and n <= HASH_BYTES:
        return _POWERS
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(max(n, HASH_BYTES), b, dtype=np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    if n <= HASH_BYTES:
        _POWERS[:] = out
    return out


def word_hashes(buf: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts ``buf[offsets[i]:offsets[i+1]]``.

    Returns ``(hashes, bounds)``; text i owns ``hashes[bounds[i]:bounds[i+1]]``.
    Equal words have equal hashes wherever they stand (a polynomial over byte
    values, divided by the power of the word's position, then mixed).
    """
    n = len(buf)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = np.empty(n + 1, dtype=np.int8)
    inside[:n] = ~_SPACE[buf]
    inside[n] = 0
    before = np.empty(n + 1, dtype=np.int8)
    before[1:] = inside[:n]
    before[offsets[:-1]] = 0          # a text's first byte never continues a word
    before[0] = 0
    starts = np.flatnonzero((inside == 1) & (before == 0))
    ends_mask = (inside == 0)
    ends_mask[offsets[1:]] = True     # nor does a word run on into the next text
    ends = np.flatnonzero(ends_mask)
    ends = ends[np.searchsorted(ends, starts, side="right")] if len(starts) else starts
    hashes = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):      # in stretches, so that memory does not follow the length of a text
        a = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, a + HASH_BYTES, side="right")))
        part = buf[a:ends[j - 1]]
        up, down = _powers(len(part))
        total = np.empty(len(part) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(_BYTE[_LOWER[part] if lower else part] * up[:len(part)], out=total[1:])
        hashes[i:j] = mix((total[ends[i:j] - a] - total[starts[i:j] - a]) * down[starts[i:j] - a])
        i = j
    return hashes, np.searchsorted(starts, offsets)


def text_slices(batch: pa.RecordBatch, column: str = "text", max_bytes: int = 1 << 20
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole texts of an Arrow batch in slices of about ``max_bytes`` (a longer
    text is a slice of its own): ``(first row, last row + 1, bytes, offsets)``.
    Null texts are empty."""
    col = batch.column(batch.schema.get_field_index(column))
    if col.null_count:
        col = col.fill_null("")
    if not len(col):
        return
    wide = pa.types.is_large_string(col.type)
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)
    offs = offs[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i, n = 0, len(col)
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + max_bytes, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j, buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def give_back() -> None:
    """Return free memory to the system. A reused worker otherwise holds what its largest
    task needed, and the stages of a pipeline add up."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A ``mapInArrow`` function that gives its memory back when its task ends."""
    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()
    return tidied


def fresh_name(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores before it until no column has it."""
    held = {c.lower() for c in taken}
    while name.lower() in held:
        name = "_" + name
    return name


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches hold about 8 MB, so that a task's
    memory on both sides of the pipe does not follow the length of the texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    return df


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: later steps
    neither recompute it nor depend on the executors that made it."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Remove the folders of a staged frame that nothing reads any more. Only folders
    below the shared folder's stages are touched."""
    stages = shared_dir(df.sparkSession) + "/stage/"
    inner = stages.split("://")[-1].split("file:")[-1].lstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if inner in folder:
            fs, path = hadoop_fs(df.sparkSession, folder)
            fs.delete(path, True)


def id_remainder(c: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(c.cast("string").cast("binary")) % F.lit(modulus)


def about(rows: DataFrame, id_col: str, most: int, times: float = 1.0) -> DataFrame:
    """Rows whose ids have the smallest hashes, so many that about ``most * times``
    remain (all, if there are no more). Only a count reaches the driver."""
    n = rows.count()
    part = min(1.0, most * times / max(n, 1))
    return rows.filter(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 31)) < F.lit(int(part * (1 << 31))))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
