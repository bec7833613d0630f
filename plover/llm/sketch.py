"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ascending ``SIZE`` smallest distinct 64-bit hashes of a
text's 5-word shingles (fewer words: the whole sequence is one shingle). The
sketch of a union is the smallest hashes of both sketches, so parts merge in
any order. Sketches are unsigned and kept as longs with the top bit flipped,
which sorts the same way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plover.llm.common import Prefix, map_batches, row_chunks, text_bytes, word_codes, word_spans

SIZE = 128
SHINGLE = 5
_TOP = np.uint64(1 << 63)


def _sketches(arr: pa.Array, size: int, shingle: int) -> list[np.ndarray]:
    """Ascending unsigned hashes per row."""
    raw, offs = text_bytes(arr)
    out = []
    for i, j in row_chunks(offs):
        s, e, rows = word_spans(raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        sums = Prefix(word_codes(raw[offs[i]:offs[j]], s, e))
        # shingle starts of all rows; a short row has one shingle of all its words
        count = np.diff(rows)
        shingles = np.where(count >= shingle, count - shingle + 1, np.minimum(count, 1))
        first = np.concatenate(([0], np.cumsum(shingles)))
        row = np.repeat(np.arange(j - i), shingles)
        at = rows[row] + np.arange(first[-1]) - first[row]
        codes = sums.ranges(at, np.minimum(at + shingle, rows[row + 1]))
        for k in range(j - i):
            part = codes[first[k]:first[k + 1]]
            if len(part) > 8 * size:  # distinct values below a cut hold the smallest ones
                cut = np.partition(part, 4 * size)[4 * size]
                few = np.unique(part[part <= cut])
                out.append(few[:size] if len(few) >= size else np.unique(part)[:size])
            else:
                out.append(np.unique(part)[:size])
    return out


def _list(sketches: list[np.ndarray]) -> pa.Array:
    at = np.concatenate(([0], np.cumsum([len(x) for x in sketches]))).astype(np.int32)
    flat = np.concatenate(sketches) if sketches else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array((flat ^ _TOP).view(np.int64)))


def _add(columns: dict[str, str], size: int, shingle: int, drop: bool):
    def run(batches):
        for b in batches:
            names = [n for n in b.schema.names if not (drop and n in columns)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in names), *(_list(_sketches(b.column(c), size, shingle)) for c in columns)],
                [*names, *columns.values()])
    return run


def with_sketches(df: DataFrame, columns: dict[str, str], size: int = SIZE, shingle: int = SHINGLE,
                  drop: bool = False) -> DataFrame:
    """Adds a sketch column array<long> for each text column of ``columns``
    (text column: sketch column), without the texts if ``drop``. Null and
    empty texts have the empty sketch; rows stay as they are."""
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields
             if not (drop and f.name in columns)]
    return df.transform(map_batches, _add(columns, size, shingle, drop),
                         ", ".join([*kinds, *(f"`{s}` array<bigint>" for s in columns.values())]))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def merged(a, b, size: int = SIZE) -> Column:
    """Sketch of the union of the texts' shingles."""
    return F.slice(F.array_sort(F.array_union(_col(a), _col(b))), 1, size)


def resemblance(a, b, size: int = SIZE) -> Column:
    """Estimated Jaccard likeness, 0 to 1; two empty sketches are alike (1)."""
    both = merged(a, b, size)
    shared = F.array_intersect(both, F.array_intersect(_col(a), _col(b)))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(F.size(shared) / F.size(both))


def distinct_shingles(a, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles: exact below ``size``, else
    (size - 1) over the largest kept hash as a share of all hashes."""
    a = _col(a)
    top = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63) + 1) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise(F.lit(size - 1.0) / top)


def containment(a, b, size: int = SIZE) -> Column:
    """Estimated share of a's shingles that b has, 0 to 1: likeness times the
    union's estimated size over a's. An empty a is contained (1)."""
    union = distinct_shingles(merged(a, b, size), size)
    own = distinct_shingles(a, size)
    return F.when(F.size(_col(a)) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), resemblance(a, b, size) * union / own))


def as_text(a) -> Column:
    """A sketch as a string: its hashes in hexadecimal, 16 digits each."""
    return F.array_join(F.transform(_col(a), lambda h: F.lpad(F.hex(h), 16, "0")), "")
