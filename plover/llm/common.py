"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plover.session import remove_path, scratch_path

TEXT_CHUNK = 1 << 19  # bytes of text that one vectorised step looks at


STAGED: list[str] = []  # folders of this session's staged tables, in order


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back. Cuts
    lineage, survives lost executors, and forgets the partitioning, so that
    a later join shuffles both sides and hot keys can be split at runtime."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, since: int, keep: int = 1) -> None:
    """Removes the folders staged after the first ``since`` ones, but for the last
    ``keep``. For a caller that has written what was made from them."""
    last = len(STAGED) - keep
    for path in STAGED[since:last]:
        remove_path(spark, path)
    del STAGED[since:last]


def _hand_back() -> None:
    """Give freed memory back to the system: Arrow's, and the C library's if it can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` whose tasks hand back unused memory when they end; their
    Python workers live on and would keep it."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            _hand_back()
    return df.mapInArrow(task, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` lacks, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: str = "text"):
    """64-bit hash of a text (null: that of the empty text). With the document id
    it names a row where ids are repeated."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 offsets of a string column; null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off, data = arr.buffers()
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def row_chunks(offs: np.ndarray, size: int = TEXT_CHUNK):
    """(first, last) row ranges of about ``size`` bytes; a longer row is one
    range of its own."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + size, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public SplitMix64 generator: a bijection of 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODE = mix64((np.arange(1, 257, dtype=np.uint64)) * np.uint64(_BASE))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if len(_POWERS[0]) < n:
        m = max(n, 1 << 16)
        for k, b in enumerate((_BASE, _INVERSE)):
            p = np.full(m, b, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1][:n]


class Prefix:
    """Polynomial prefix sums of codes modulo 2**64: the hash of any range of
    the sequence costs one subtraction and depends on the content alone."""

    def __init__(self, codes: np.ndarray):
        up, self.down = _powers(len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * up[:len(codes)], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix64(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True  # fixed: the contracts' [^\x20\x09-\x0D]+


def word_spans(raw: np.ndarray, offs: np.ndarray, separator: np.ndarray | None = None):
    """Byte starts and ends of the words of every row, and the n + 1 word
    offsets of the rows. ``separator``: per byte, True outside words."""
    inside = ~(_SPACE[raw] if separator is None else separator)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    first = np.zeros(len(raw) + 1, bool)
    first[offs] = True  # a row's first byte begins a word whatever comes before
    before = np.empty(len(raw), bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(raw), bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_codes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, by pieces of the text so that memory stays a
    small multiple of the piece (or of the longest word)."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + TEXT_CHUNK, side="right")), i + 1)
        lo = int(starts[i])
        p = Prefix(_BYTE_CODE[raw[lo:int(ends[j - 1])]])
        out[i:j] = p.ranges(starts[i:j] - lo, ends[i:j] - lo)
        i = j
    return out


def sliding_argmin(codes: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest code in each window of ``width``.
    The order is by the high 40 bits of the codes, so equal windows choose
    the same relative position. Long inputs go by overlapping pieces."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out = np.empty(n, np.int64)
    piece = (1 << 20) - width
    for lo in range(0, n, piece):
        hi = min(lo + piece, n)
        part = codes[lo:hi + width - 1]
        x = (part & ~np.uint64((1 << 24) - 1)) | np.arange(len(part), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            x = np.minimum(x[:-span], x[span:])
            span *= 2
        if span < width:
            x = np.minimum(x[:len(x) - (width - span)], x[width - span:])
        out[lo:hi] = (x & np.uint64((1 << 24) - 1)).astype(np.int64) + lo
    return out


def as_int64(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())
