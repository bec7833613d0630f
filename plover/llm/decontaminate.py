"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of template tokens: lower-cased words, with typed
placeholders for numbers, for units after a number, and for names
(capitalised words; a run of them is one name). Whether a capitalised word
at the start of a sentence is a name can't be told from its place, so every
text is read three ways, on both sides: ``_INSIDE`` takes names inside
sentences only, ``_ANYWHERE`` every capitalised word but ``FUNCTION_WORDS``,
wherever a sentence or line begins, and ``_LITERAL`` no placeholders at all,
so that a verbatim copy matches whatever stands around it. A window
is ``WINDOW`` consecutive tokens (a shorter item is one window), half of
them words at least. Literal windows may hold anything, so verbatim copies
of arithmetic, tables, lists of names and series of numbers are found with
their values; an item of under ``SHORTEST`` tokens is compared literally
alone, as too little for a template. Windows
of documents are hash-joined with those of the benchmark. Their slots are consistent if the values can be mapped one to
one, which is so exactly when both windows repeat their values at the same
places; that pattern is part of the joined key. A document with one
consistent window is contaminated, verbatim if the slot values agree too,
else re-parameterised.

The join has two steps so that few rows leave the text scan: every window
picks the 4-gram of smallest hash in it, equal windows pick equal ones, and
only documents that share a picked gram with the benchmark list all their
windows. Grams without a word are picked last, and by literal windows alone; a window of fewer
tokens than a gram picks itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.llm.common import (Prefix, as_int64, map_batches, mix64, row_chunks, sliding_argmin, stage, text_bytes, text_key,
                               word_codes, word_spans)

WINDOW = 13
SHORTEST = 5  # shorter items match by their exact words only
GRAM = 4
UNITS = ("km kilometers kilometres m meters metres cm mm miles mile feet foot inches inch kg kilograms grams g mg lb "
         "pounds ounces liters litres ml seconds second minutes minute hours hour days day weeks week months month "
         "years year percent dollars dollar euros euro cents cent degrees mph kmh").split()
#: Begin sentences without being names; in _ANYWHERE they are words.
FUNCTION_WORDS = ("a about after all also although an and another any are as at because before both but by did do does "
                  "each either every few find five for four from given has have he her his how however if in into is it its let "
                  "many more most my next no not now of on once one or our she since so some that the their then there these "
                  "they this those three to two under until we were what when where which while who whose why with "
                  "would you your").split()
_INSIDE, _ANYWHERE, _LITERAL = range(3)
READINGS = 3
_NUMBER, _UNIT, _NAME = (np.uint64(x) for x in (0x6E756D, 0x756E6974, 0x6E616D65))
_NO_GRAM = np.uint64(2 ** 64 - 1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[0x41:0x5B] = True
_WORD = _DIGIT | _CAPITAL
_WORD[0x61:0x7B] = True
_WORD[0x80:] = True
_STOP = np.zeros(256, bool)  # a capital after one of these is no name
_STOP[[ord(c) for c in ".!?:;\n\r|\"()[]"]] = True


def _codes_of(words: list[str]) -> np.ndarray:
    raw, offs = text_bytes(pa.array(words))
    s, e, _ = word_spans(raw, offs)
    return word_codes(raw, s, e)


_UNIT_CODES, _FUNCTION_CODES = np.sort(_codes_of(UNITS)), np.sort(_codes_of(FUNCTION_WORDS))


def _among(codes: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, codes), len(known) - 1)] == codes


def _shift(x: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(x)
    if by > 0:
        out[by:] = x[:-by]
    elif by < 0:
        out[:by] = x[-by:]
    return out


def template(raw: np.ndarray, offs: np.ndarray):
    """Template codes, value codes, slot flags and word numbers in the row of the
    tokens of n rows, in each reading, and the token offsets: row r in reading
    k is sequence k * n + r."""
    word, digit = _WORD[raw], _DIGIT[raw]
    if len(raw) > 1:
        point = (raw == 0x2E) | (raw == 0x2C)
        word |= point & _shift(digit, 1) & _shift(digit, -1)  # 3.14 and 1,000 are one number
        quote = (raw == 0xE2) & ((_shift(raw, -1) == 0x80) | (_shift(raw, -1) == 0x81))
        word &= ~(quote | _shift(quote, 1) | _shift(quote, 2))  # typographic quotes and dashes
    accent = _shift(raw, 1) == 0xC3 if len(raw) > 1 else np.zeros(len(raw), bool)
    big = accent & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)
    low = _LOWER[raw]
    low[big] += 0x20
    s, e, rows = word_spans(raw, offs, ~word)
    if not len(s):
        return (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.int64),
                np.zeros(READINGS * (len(rows) - 1) + 1, np.int64))
    value = word_codes(low, s, e)
    first = np.zeros(len(s) + 1, bool)
    first[rows] = True
    stops = np.concatenate(([0], np.cumsum(_STOP[raw] & ~word)))
    begins = first[:-1].copy()
    begins[1:] |= stops[s[1:]] > stops[e[:-1]]
    number = _DIGIT[raw[s]]
    unit = np.zeros(len(s), bool)
    unit[1:] = number[:-1] & ~first[1:-1]
    unit &= _among(value, _UNIT_CODES) & ~number
    second = np.minimum(s + 1, len(raw) - 1)
    wide = np.append(big, False)[s + 1]  # an accented capital has two bytes
    capital = _CAPITAL[raw[s]] | wide
    cased = (e - s > 1 + wide) & ~_CAPITAL[raw[np.minimum(second + wide, len(raw) - 1)]]
    named = capital & cased & ~number & ~unit
    place = np.arange(len(s)) - np.repeat(rows[:-1], np.diff(rows))
    parts, ends = [], [np.zeros(1, np.int64)]
    for name in (named & ~begins, named & ~_among(value, _FUNCTION_CODES)):
        again = np.zeros(len(s), bool)
        again[1:] = name[1:] & name[:-1] & ~first[1:-1]
        keep = ~again
        code = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, value)))
        parts.append((code[keep], value[keep], (number | unit | name)[keep], place[keep]))
        ends.append(ends[-1][-1] + np.concatenate(([0], np.cumsum(keep)))[rows[1:]])
    parts.append((value, value, number, place))
    ends.append(ends[-1][-1] + rows[1:])
    return *(np.concatenate(x) for x in zip(*parts)), np.concatenate(ends)


def _literal_from(rows: np.ndarray) -> int:
    """First token of the literal reading."""
    return int(rows[_LITERAL * ((len(rows) - 1) // READINGS)])


def _grams(codes: np.ndarray, slots: np.ndarray, sums: Prefix, rows: np.ndarray) -> np.ndarray:
    """Gram hashes. Grams without a word are larger than all others, and none
    where slots are placeholders."""
    at = np.arange(max(len(codes) - GRAM + 1, 0))
    many = np.concatenate(([0], np.cumsum(slots)))
    gram = sums.ranges(at, at + GRAM) >> np.uint64(1)
    bare = np.where(at >= _literal_from(rows), gram | np.uint64(1 << 63), _NO_GRAM)
    return np.where(many[at + GRAM] - many[at] == GRAM, bare, gram)


def _own_gram(sums: Prefix, start: np.ndarray, size: int) -> np.ndarray:
    return sums.ranges(start, start + size) >> np.uint64(1)


def _windows(codes, values, slots, rows, size: int, sums: Prefix):
    """Windows of ``size`` tokens: sequence, start, joined key (template and slot
    pattern) and exact key (values too)."""
    n = len(codes) - size + 1
    row_of = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    many = np.concatenate(([0], np.cumsum(slots)))
    held = many[size:] - many[:n]
    literal = np.arange(n) >= _literal_from(rows)
    start = np.flatnonzero((row_of[:n] == row_of[size - 1:]) & (literal | ((held * 2 <= size) & (size >= SHORTEST))))
    # distance of each slot to the one before with its value, in the same row
    at = np.flatnonzero(slots)
    order = at[np.lexsort((at, values[at], codes[at], row_of[at]))]
    same = ((values[order[1:]] == values[order[:-1]]) & (codes[order[1:]] == codes[order[:-1]])
            & (row_of[order[1:]] == row_of[order[:-1]]))
    p, back = order[1:][same], (order[1:] - order[:-1])[same]
    p, back = p[back < size], back[back < size]
    pattern = np.zeros(n, np.uint64)
    for k in range(size):  # the repeat is at place k of the window that starts k tokens before it
        ok = (back <= k) & (p - k >= 0) & (p - k < n)
        np.add.at(pattern, p[ok] - k, mix64((back[ok] * size + k + 1).astype(np.uint64)))
    key = mix64(sums.ranges(start, start + size) + mix64(pattern[start]))
    return row_of[start], start, key, Prefix(values).ranges(start, start + size)


def _chunks(batches):
    """Batch, its first row and number of rows, and their template."""
    for b in batches:
        raw, offs = text_bytes(b.column("text"))
        for i, j in row_chunks(offs):
            yield b, i, j - i, template(raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i])


def _picked_rows(sizes: list[int]):
    """id, t, a: the grams that the windows of each size pick."""
    def run(batches):
        for b, i, n_rows, (codes, _, slots, _, rows) in _chunks(batches):
            sums = Prefix(codes)
            grams = _grams(codes, slots, sums, rows)
            row_of = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
            row, gram = [], []
            for size in sizes:
                if size < GRAM:
                    start = np.arange(_literal_from(rows), max(len(codes) - size + 1, 0))
                    start = start[row_of[start] == row_of[start + size - 1]]
                    row.append(row_of[start])
                    gram.append(_own_gram(sums, start, size))
                    continue
                pick = sliding_argmin(grams, size - GRAM + 1)
                n = len(pick)
                ok = row_of[:n] == row_of[size - 1:size - 1 + n]
                new = np.ones(n, bool)
                new[1:] = (pick[1:] != pick[:-1]) | ~ok[:-1]
                use = np.flatnonzero(ok & new & (grams[pick] != _NO_GRAM)) if n else np.zeros(0, np.int64)
                row.append(row_of[use])
                gram.append(grams[pick[use]] if n else np.zeros(0, np.uint64))
            row, gram = np.concatenate(row), np.concatenate(gram)
            row %= n_rows
            order = np.lexsort((gram, row))  # the readings agree on most grams
            row, gram = row[order], gram[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
            row, gram = row[new], gram[new]
            take = pa.array(row + i)
            yield pa.RecordBatch.from_arrays([b.column("id").take(take), b.column("t").take(take), as_int64(gram)],
                                             ["id", "t", "a"])
    return run


def _item_rows(window: int):
    """id, size, a, w, x of the items' windows."""
    def run(batches):
        for b, i, n_rows, (codes, values, slots, _, rows) in _chunks(batches):
            sums = Prefix(codes)
            grams = _grams(codes, slots, sums, rows)
            length = np.diff(rows)
            for size in sorted({int(x) for x in length if 0 < x < window} | {window}):
                row, start, key, exact = _windows(codes, values, slots, rows, size, sums)
                if size < window:  # only items that are no longer
                    own = length[row] == size
                    row, start, key, exact = row[own], start[own], key[own], exact[own]
                if not len(start):
                    continue
                gram = _own_gram(sums, start, size) if size < GRAM else grams[sliding_argmin(grams, size - GRAM + 1)[start]]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(row % n_rows + i)), pa.array(np.full(len(row), size, np.int32)),
                     as_int64(gram), as_int64(key), as_int64(exact)], ["id", "size", "a", "w", "x"])
    return run


def _window_rows(sizes: list[int]):
    def run(batches):
        for b, i, n_rows, (codes, values, slots, place, rows) in _chunks(batches):
            sums = Prefix(codes)
            for size in sizes:
                row, start, key, exact = _windows(codes, values, slots, rows, size, sums)
                take = pa.array(row % n_rows + i)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(take), b.column("t").take(take), as_int64(key), as_int64(exact),
                     pa.array(place[start], pa.int64()), pa.array(np.full(len(row), size, np.int32))],
                    ["id", "t", "w", "x", "s", "size"])
    return run


def contaminated_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                         text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Every window of a document that matches the benchmark consistently:
    id, t (64-bit text hash), s and size (number of the first word, tokens), item
    (the smallest item id that has the window), verbatim (its slot values
    agree with an item's). A place that matches in several readings is one. Null
    or empty texts on either side match nothing; an item of one word matches
    wherever that word stands; repeated rows of a document are one; many items
    that share a window give one row. Very long texts are read whole, in memory
    of a multiple of the text. Further columns are not looked at."""
    kind, ikind = (d.schema[c].dataType.simpleString() for d, c in ((docs, id_col), (benchmark, item_col)))
    items = (benchmark.select(F.col(item_col).alias("id"), F.col(item_text).alias("text"))
             .transform(map_batches, _item_rows(window), f"id {ikind}, size int, a long, w long, x long"))
    items = stage(items, "bench-windows")
    # at most ``window`` sizes
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect()) or [window]
    # stored, so that Spark knows their bytes and broadcasts them only if they are few
    grams = stage(items.select("a").distinct(), "bench-grams")
    keys = stage(items.groupBy("w").agg(F.min("id").alias("item")), "bench-keys")
    exact = stage(items.select("w", "x").distinct().withColumn("same", F.lit(True)), "bench-exact")
    d = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("t"), F.col(text_col).alias("text"))
    near = (d.transform(map_batches, _picked_rows(sizes), f"id {kind}, t long, a long")
            .join(grams, "a", "left_semi").select("id", "t").distinct())
    near = stage(near, "bench-candidates")
    some = d.join(near, d["id"].eqNullSafe(near["id"]) & (d["t"] == near["t"]), "left_semi")
    found = (some.transform(map_batches, _window_rows(sizes), f"id {kind}, t long, w long, x long, s long, size int")
             .join(keys, "w").join(exact, ["w", "x"], "left"))
    return found.groupBy("id", "t", "s", "size").agg(
        F.min("item").alias("item"), F.max(F.coalesce("same", F.lit(False))).alias("verbatim"))


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                           text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per contaminated document (id and text): the id, t, item (smallest
    matching), n_windows, n_verbatim. See ``contaminated_windows``."""
    w = contaminated_windows(docs, benchmark, window, id_col, text_col, item_col, item_text)
    return w.groupBy(F.col("id").alias(id_col), "t").agg(
        F.min("item").alias("item"), F.count("*").alias("n_windows"),
        F.sum(F.col("verbatim").cast("long")).alias("n_verbatim"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """``docs`` without the contaminated ones; repeated rows go together."""
    id_col, text_col = columns.get("id_col", "doc_id"), columns.get("text_col", "text")
    bad = contaminated_documents(docs, benchmark, **columns)
    bad = stage(bad.select(F.col(id_col).alias("_bad_id"), F.col("t").alias("_bad_t")), "bench-contaminated")
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_bad_id"]) & (text_key(text_col) == bad["_bad_t"]), "left_anti")
