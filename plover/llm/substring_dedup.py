"""Substring dedup by a relative Lempel-Ziv parse of every document.

The corpus is its own reference. Every text is cut into content-defined
reference blocks: each window of ``window`` words picks the anchor k-gram
with the smallest hash inside it, and neighbouring windows that pick the
same anchor form one block, so equal windows lie in blocks of equal anchors
wherever they stand. Every block whose anchor repeats is indexed: by anchor
and content, with its number of occurrences and the first and last place
(row, word) where it stands. A document is parsed against the index from
left to right:

* a block that occurs again is copied from its first place (from the last
  one, if it is that place itself), and the factor is extended, block by
  block, as long as the next block's copy goes on at the same distance in the
  same row: factors are (position, length, reference row, reference position);
* a block that occurs once, but whose anchor has other blocks, is the border
  of a factor. Its windows are checked one by one: hashes of the windows of
  every *different* block of that anchor are counted, each with the number of
  the block's occurrences, and a window that counts twice or more is a
  duplicate too, as a factor without a reference;
* an anchor that stands once has no window that occurs elsewhere.

Factors are at least ``window`` words long; overlapping ones merge into
duplicate spans. No pair of documents is ever formed. Equal blocks are
aggregated before their windows are looked at, so a large group of copies costs its
blocks once; every count is aggregated before its shuffle, and joins that
carry a hot anchor or block have a stored one-row-per-key side, so the hot
partition can be split.

Windows and blocks are compared by two 64-bit hashes (anchor and content),
rows are named by a 64-bit hash of id and text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.llm.common import (Prefix, as_int64, map_batches, row_chunks, sliding_argmin, stage, text_bytes, text_key, word_codes,
                               word_spans)

WINDOW = 35
GRAM = 6


def _blocks(codes: np.ndarray, rows: np.ndarray, window: int, gram: int):
    """Reference blocks of some texts' words: row, first and last window
    start (absolute positions) and anchor hash; the prefix sums as well."""
    sums = Prefix(codes)
    n = len(codes)
    empty = np.zeros(0, np.int64)
    if n < window:
        return empty, empty, empty, np.zeros(0, np.uint64), sums
    at = np.arange(n - gram + 1)
    grams = sums.ranges(at, at + gram)
    pick = sliding_argmin(grams, window - gram + 1)
    row_of = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    ok = row_of[:len(pick)] == row_of[window - 1:window - 1 + len(pick)]  # the window stays inside its text
    start = np.flatnonzero(ok)
    if not len(start):
        return empty, empty, empty, np.zeros(0, np.uint64), sums
    pick = pick[start]
    new = np.ones(len(start), bool)
    new[1:] = (pick[1:] != pick[:-1]) | (start[1:] != start[:-1] + 1) | (row_of[start[1:]] != row_of[start[:-1]])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(start)) - 1
    return row_of[start[lo]], start[lo], start[hi], grams[pick[lo]], sums


def _each_block(batches, window: int, gram: int):
    """Batch, row, first window start in the row, further windows, anchor and content of its blocks."""
    for b in batches:
        raw, offs = text_bytes(b.column("text"))
        for i, j in row_chunks(offs):
            part, o = raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
            s, e, rows = word_spans(part, o)
            row, first, last, anchor, sums = _blocks(word_codes(part, s, e), rows, window, gram)
            yield b, row + i, first - rows[row], last - first, anchor, sums.ranges(first, last + window)


def _anchor_rows(window: int, gram: int):
    def run(batches):
        for _, _, _, _, anchor, _ in _each_block(batches, window, gram):
            yield pa.RecordBatch.from_arrays([as_int64(anchor)], ["a"])
    return run


def _block_rows(window: int, gram: int):
    def run(batches):
        for b, row, s, n, anchor, content in _each_block(batches, window, gram):
            yield pa.RecordBatch.from_arrays(
                [b.column("k").take(pa.array(row)), as_int64(anchor), as_int64(content),
                 pa.array(s.astype(np.int32)), pa.array(n.astype(np.int32))], ["k", "a", "b", "s", "n"])
    return run


def _window_rows(window: int):
    """Windows of the blocks in ``open``: row, anchor, window hash, start, the block's occurrences."""
    def run(batches):
        for b in batches:
            raw, offs = text_bytes(b.column("text"))
            lists = b.column("open")
            firsts, counts, anchors, times = (lists.flatten().field(c).to_numpy() for c in "snac")
            at = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            for i, j in row_chunks(offs):
                part, o = raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
                s, e, rows = word_spans(part, o)
                sums = Prefix(word_codes(part, s, e))
                f, c, a, m = (x[at[i]:at[j]] for x in (firsts, counts, anchors, times))
                row = np.repeat(np.arange(j - i), np.diff(at[i:j + 1]))
                c = c.astype(np.int64) + 1
                begin = np.repeat(f - (np.cumsum(c) - c), c) + np.arange(c.sum())  # window starts within the text
                row, a, m = np.repeat(row, c), np.repeat(a, c), np.repeat(m, c)
                p = begin + rows[row]
                yield pa.RecordBatch.from_arrays(
                    [b.column("k").take(pa.array(row + i)), pa.array(a, pa.int64()), as_int64(sums.ranges(p, p + window)),
                     pa.array(begin.astype(np.int32)), pa.array(m, pa.int64())], ["k", "a", "w", "s", "c"])
    return run


def parse(pieces, window: int) -> tuple[list, list]:
    """Factors (s, e, ref, ref_s) and merged spans (s, e) of a row from its copied
    pieces (s, n, ref, ref_s): windows from s to s + n, and the row and word
    that they are copied from (None: not known)."""
    factors, spans = [], []
    for s, n, ref, ref_s in sorted(pieces, key=lambda p: (p[0], -p[1])):
        e = s + n + window
        last = factors[-1] if factors else None
        if (last and s <= last[1] and ref == last[2]
                and (ref is None or ref_s - s == last[3] - last[0])):
            last[1] = max(last[1], e)  # the copy goes on
        else:
            factors.append([s, e, ref, ref_s])
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], e)
        else:
            spans.append([s, e])
    return factors, spans


_FACTORS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("ref", pa.int64()), ("ref_s", pa.int32())]))
_SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))


def _parse_rows(window: int):
    def run(batches):
        for b in batches:
            factors, spans = [], []
            for pieces in b.column("pieces").to_pylist():
                f, x = parse([(p["s"], p["n"], p["ref"], p["ref_s"]) for p in pieces], window)
                factors.append([dict(zip(("s", "e", "ref", "ref_s"), y)) for y in f])
                spans.append([dict(zip("se", y)) for y in x])
            yield pa.RecordBatch.from_arrays([b.column("k"), pa.array(factors, _FACTORS), pa.array(spans, _SPANS)],
                                             ["k", "factors", "spans"])
    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, t (text hash), k (row hash), text."""
    d = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("t"), F.col(text_col).alias("text"))
    return d.select("id", "t", F.xxhash64(F.col("id").isNull(), "id", "t").alias("k"), "text")


def _parsed(d: DataFrame, window: int, gram: int) -> DataFrame:
    """k, factors, spans of the rows that have any."""
    if not 1 <= gram < window:
        raise ValueError("the anchor must be shorter than the window")
    anchors = d.select("text").transform(map_batches, _anchor_rows(window, gram), "a long").groupBy("a").count()
    anchors = stage(anchors.filter("count > 1").select("a"), "rlz-anchors")
    blocks = d.select("k", "text").transform(map_batches, _block_rows(window, gram), "k long, a long, b long, s int, n int")
    blocks = stage(blocks.join(anchors, "a", "left_semi"), "rlz-blocks")
    place = F.struct("k", "s")
    index = stage(blocks.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"),
                                               F.min(place).alias("first"), F.max(place).alias("last")), "rlz-index")
    known = index.filter("c > 1").select(F.col("a").alias("ia"), F.col("b").alias("ib"), "first", "last")
    here = F.col("first.k") == F.col("k")
    source = F.when(here & (F.col("first.s") == F.col("s")), F.col("last")).otherwise(F.col("first"))
    copied = (blocks.join(known, (F.col("a") == F.col("ia")) & (F.col("b") == F.col("ib")))
              .withColumn("from", source).select("k", "s", "n", F.col("from.k").alias("ref"), F.col("from.s").alias("ref_s")))
    # factor borders: anchors with several different blocks; one place of each block is enough
    several = stage(index.groupBy("a").count().filter("count > 1").select("a"), "rlz-borders")
    ends = index.join(several, "a", "left_semi").select(
        F.col("first.k").alias("o"), F.struct(F.col("first.s").alias("s"), "n", "a", "c").alias("x"))
    ends = stage(ends.groupBy("o").agg(F.collect_list("x").alias("open")), "rlz-ends")
    windows = (d.select("k", "text").join(ends, F.col("k") == F.col("o")).select("k", "text", "open")
               .transform(map_batches, _window_rows(window), "k long, a long, w long, s int, c long"))
    windows = stage(windows, "rlz-windows")
    twice = stage(windows.groupBy("a", "w").agg(F.sum("c").alias("n")).filter("n > 1").select("a", "w"), "rlz-repeated")
    checked = windows.filter("c = 1").join(twice, ["a", "w"]).select(
        "k", "s", F.lit(0).alias("n"), F.lit(None).cast("long").alias("ref"), F.lit(None).cast("int").alias("ref_s"))
    pieces = copied.unionByName(checked).groupBy("k").agg(F.collect_list(F.struct("s", "n", "ref", "ref_s")).alias("pieces"))
    return pieces.transform(map_batches, _parse_rows(window),
                            "k long, factors array<struct<s:int,e:int,ref:bigint,ref_s:int>>, spans array<struct<s:int,e:int>>")


def duplicate_spans(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                    gram: int = GRAM) -> DataFrame:
    """One row per document that has duplicate spans: id, t (64-bit hash of
    the text, so a repeated id with another text is another document), k (hash
    of both), spans array<struct<s int, e int>>: first and one-past-last word,
    ascending, apart from each other, and factors array<struct<s, e, ref, ref_s>>:
    words s to e are copied from word ref_s on of the row whose k is ref (null:
    found by the check at a border).

    A span is covered by windows of ``window`` words that start at least
    twice in the corpus. Null and empty texts, and texts shorter than the
    window, have none. Two rows with the same id and text are two occurrences
    of all their windows (both rows get the same spans). A null id is an id
    like any other. Very long texts are parsed whole; a row's blocks come
    together in one row of memory that grows with the text."""
    d = _keyed(docs, id_col, text_col)
    found = stage(_parsed(d, window, gram), "rlz-spans")
    rows = d.select("id", "t", "k").distinct()
    return rows.join(found, "k").select("id", "t", "k", "spans", "factors")


def _cut(batches):
    for b in batches:
        raw, offs = text_bytes(b.column("text"))
        data = raw.tobytes()
        starts = {i: x for i, x in enumerate(b.column("spans").to_pylist()) if x}
        kept, total, gone = [], np.zeros(len(offs) - 1, np.int64), np.zeros(len(offs) - 1, np.int64)
        for i, j in row_chunks(offs):
            s, e, rows = word_spans(raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
            total[i:j] = np.diff(rows)
            for k in range(i, j):
                lo, hi = rows[k - i], rows[k - i + 1]
                if k in starts:
                    keep = np.ones(hi - lo, bool)
                    for x in starts[k]:
                        keep[x["s"]:x["e"]] = False
                    gone[k] = (~keep).sum()
                    at = np.flatnonzero(keep) + lo
                    base = int(offs[i])
                    kept.append(b" ".join([data[base + p:base + q] for p, q in zip(s[at].tolist(), e[at].tolist())])
                                .decode("utf-8"))
                else:
                    # words never hold these bytes, so splitting by them and joining is the same
                    kept.append(b" ".join(data[offs[k]:offs[k + 1]].split()).decode("utf-8"))
        names = [n for n in b.schema.names if n not in ("text", "spans")]
        yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), b.column("spans"), pa.array(total),
                                          pa.array(gone), pa.array(kept, pa.string())],
                                         [*names, "spans", "n_words", "n_removed", "kept_text"])


def remove_duplicate_spans(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                           text_col: str = "text") -> DataFrame:
    """One row per input row: the id, spans (null: none), n_words, n_removed
    and kept_text, the words left joined by one space. See
    ``duplicate_spans`` for what is removed; null texts have no words."""
    d = _keyed(docs, id_col, text_col)
    found = stage(_parsed(d, window, GRAM).select(F.col("k").alias("fk"), "spans"), "rlz-spans")
    both = d.join(found, F.col("k") == F.col("fk"), "left").select("id", "text", "spans")
    kind = d.schema["id"].dataType.simpleString()
    out = both.transform(map_batches, _cut, f"id {kind}, spans array<struct<s:int,e:int>>, n_words long, n_removed long, "
                                "kept_text string")
    return out.withColumnRenamed("id", id_col)
