"""SimHash near-dedup with pigeonhole blocks.

A fingerprint has one bit per position of the 64-bit shingle hashes: 1 where
over half of them have 1. Equal fingerprints are one row from here on. A
fingerprint is cut into ``BLOCKS`` blocks of 8 bits; two fingerprints that
differ in at most ``max_bits`` bits agree in BLOCKS - max_bits of them, so
each is listed under every choice of that many blocks and fingerprints are
joined on the chosen blocks' bits. The rows of one such key differ only in
the bits left out (at most 2**16 fingerprints for 2 bits, whatever the
corpus holds). Hamming distance is verified inside a key by looking up each
fingerprint's possible neighbours, not by pairing all of them, and a key
passes on a spanning forest of its verified links instead of every link.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.llm.common import fresh, map_batches, row_chunks, stage, text_bytes, text_key
from plover.operators.graph import connected_components

SHINGLE = 3
MAX_BITS = 2
BLOCKS = 8
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def fingerprint_of(words: list[bytes], shingle: int = SHINGLE) -> int:
    """SimHash of a word sequence over XXH64 (seed 42) of its shingles,
    repeats included; fewer words than a shingle are one shingle, no words
    are fingerprint zero."""
    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_digest
    if n <= shingle:
        hashes = [digest(line, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = [digest(line[s:e], 42) for s, e in zip(starts[:n - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 15):
        part = np.frombuffer(b"".join(hashes[i:i + (1 << 15)]), np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(total * 2 > len(hashes)).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches):
        for b in batches:
            raw, offs = text_bytes(b.column("text"))
            for i, j in row_chunks(offs):
                data = _LOWER[raw[offs[i]:offs[j]]].tobytes()
                at = (offs[i:j + 1] - offs[i]).tolist()
                # bytes.split() cuts at exactly the bytes 0x20 and 0x09-0x0D
                out = np.array([fingerprint_of(data[p:q].split(), shingle) for p, q in zip(at, at[1:])], np.uint64)
                rows = b.slice(i, j - i)
                names = [n for n in b.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(n) for n in names), pa.array(out.view(np.int64), pa.int64())], [*names, "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """id, t (64-bit text hash), fp (the fingerprint's bits as a long) per
    input row. ASCII letters are lower-cased; null texts have no words."""
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("t"), F.col(text_col).alias("text"))
            .transform(map_batches, _fingerprints(shingle), f"id {kind}, t long, fp long"))


def _forest(keys: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between sorted distinct fingerprints
    that differ by one of ``masks``: each non-root with its tree's smallest."""
    n = len(keys)
    left, right = [], []
    if n <= 64:
        x = keys[:, None] ^ keys[None, :]
        p, q = np.nonzero(np.isin(x, masks))
        left, right = [p[p < q]], [q[p < q]]
    else:
        for m in masks:
            other = keys ^ m
            at = np.searchsorted(keys, other)
            at[at == n] = 0
            ok = (keys[at] == other) & (keys < other)
            left.append(np.flatnonzero(ok))
            right.append(at[ok])
    p, q = np.concatenate(left), np.concatenate(right)
    label = np.arange(n)
    while len(p):
        low = np.minimum(label[p], label[q])
        was = label.copy()
        np.minimum.at(label, label[p], low)
        np.minimum.at(label, label[q], low)
        label = label[label]
        if (label == was).all():
            break
    leaf = np.flatnonzero(label != np.arange(n))
    return keys[label[leaf]], keys[leaf]


def _links(max_bits: int):
    choices = list(combinations(range(BLOCKS), max_bits))  # the blocks left out of the key

    def flips(blocks):
        bits = [np.uint64(1) << np.uint64(8 * k + i) for k in blocks for i in range(8)]
        return np.array([np.bitwise_or.reduce(c) for r in range(1, max_bits + 1) for c in combinations(bits, r)],
                        np.uint64)

    masks = [flips(c) for c in choices]

    def run(batches):
        for b in batches:
            lists = b.column("fps")
            flat = lists.flatten().to_numpy().view(np.uint64)
            at = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            src, dst = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for k, c in enumerate(b.column("c").to_numpy().tolist()):
                s, d = _forest(np.sort(flat[at[k]:at[k + 1]]), masks[c])
                src.append(s)
                dst.append(d)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (src, dst)],
                                             ["src", "dst"])
    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (src, dst) between the distinct longs of fps.fp, sufficient to
    connect all that differ in at most ``max_bits`` bits."""
    if not 0 < max_bits < BLOCKS:
        raise ValueError(f"max_bits must be 1 to {BLOCKS - 1}")
    keys = []
    for c, out in enumerate(combinations(range(BLOCKS), max_bits)):
        mask = ~sum(0xFF << (8 * k) for k in out) & (2 ** 64 - 1)
        mask = mask - 2 ** 64 if mask >= 2 ** 63 else mask
        keys.append(F.struct(F.lit(c).alias("c"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key")))
    listed = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.c", "k.key", "fp")
    shared = listed.groupBy("c", "key").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    return shared.select("c", "fps").transform(map_batches, _links(max_bits), "src long, dst long").distinct()


def near_duplicate_classes(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, t, fp (long) and component, the smallest id
    that links of at most ``max_bits`` differing bits reach (itself included).

    Texts without words (null, empty, blank) have fingerprint zero, which
    links like any other. Repeated rows and ids keep their rows. Null ids are
    in classes but name one only if no other id is there (then null)."""
    fps = stage(fingerprints(docs, id_col, text_col, shingle), "simhash-fingerprints")
    own = stage(fps.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    links = stage(fingerprint_links(own.select("fp"), max_bits), "simhash-links")
    ends = links.select(F.col("src").alias("id")).unionByName(links.select(F.col("dst").alias("id")))
    tree = connected_components(ends, links)
    joined = own.join(tree.withColumnRenamed("id", "fp"), "fp", "left") \
        .select("fp", "first", F.coalesce("component", "fp").alias("root"))
    joined = stage(joined, "simhash-roots")
    least = stage(joined.groupBy("root").agg(F.min("first").alias("component")), "simhash-classes")
    named = stage(joined.join(least, "root").select("fp", "component"), "simhash-named")
    return fps.join(named, "fp").select(F.col("id").alias(id_col), "t", "fp", "component")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class left: the smallest id's, of equal ids
    the one with the smallest text hash; of rows that agree in both, any one.
    Columns are unchanged, whatever their names."""
    classes = near_duplicate_classes(docs, shingle, max_bits, id_col, text_col)
    row = fresh(docs, "row")
    # the class' first id names it; classes without any id are told apart by their fingerprints
    first = (classes.groupBy("component", F.when(F.col("component").isNull(), F.col("fp")).alias("nameless"))
             .agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "t")).alias("m"))
             .select(F.struct(F.col("m.id").alias("id"), F.col("m.t").alias("t")).alias(row)))
    first = stage(first, "simhash-kept")
    # one key column (null ids are equal inside it), so that the join's shuffle serves the last step too
    own = F.struct(F.col(id_col).alias("id"), text_key(text_col).alias("t"))
    d = docs.withColumn(row, own.cast(first.schema[row].dataType))  # no cast inside the join's key
    return d.join(first, row).dropDuplicates([row]).select(*docs.columns)
