"""Byte-level BPE over Arrow batches with the tokenizers library.

Pieces repeat a lot, so each worker keeps the ids of the pieces it has seen
and asks the library for the others. Texts of Latin letters are cut into
pieces by Python's own regular expressions (see ``latin_pattern``), any
other text goes through the library, long ones in parts that end where
pieces do.

``encode`` splits a text by the vocabulary's pattern and merges the UTF-8
bytes of each piece by the ranks of a rank file (base64 token, rank). Bytes
enter the library through the usual byte-to-character table, since its
vocabulary is made of characters. Offsets come from the token byte lengths:
a token that starts or ends inside a character spans that whole character.
``decode`` reverses the byte table: each id stands for its bytes, and only
the whole sequence has to be UTF-8, so characters split over tokens return.

The rank file's path is a parameter; it must be readable on the executors.
"""

from __future__ import annotations

import base64
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.llm.common import map_batches, row_chunks, text_bytes

_CACHE: dict = {}


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by id; ids without a token are empty."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * (max(int(r) for _, r in pairs) + 1)
    for token, r in pairs:
        out[int(r)] = base64.b64decode(token)
    return out


def byte_characters() -> list[str]:
    """A printable character for each byte: printable Latin-1 bytes stand for
    themselves, the others for the characters from 256 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def tokenizer(path: str, pattern: str):
    """The rank file as a tokenizer of the library. A merge is listed for every
    pair of tokens whose bytes make a token, by that token's rank, because
    ranks alone decide which neighbours merge; a piece that is a token is
    taken whole."""
    key = (path, pattern)
    if key not in _CACHE:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers
        tokens = read_ranks(path)
        known = {t for t in tokens if t}
        chars = byte_characters()
        text = {t: "".join(chars[b] for b in t) for t in known}
        merges = [(text[t[:k]], text[t[k:]]) for t in tokens for k in range(1, len(t))
                  if t[:k] in known and t[k:] in known]
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        model = models.BPE(vocab={text[x]: i for i, x in enumerate(tokens) if x}, merges=merges, ignore_merges=True)
        t = Tokenizer(model)
        t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), byte_level])
        alone = Tokenizer(model)  # for pieces that are cut already
        alone.pre_tokenizer = byte_level
        _CACHE[key] = (t, alone, np.array([len(x) for x in tokens], np.int64), _Seen())
    return _CACHE[key]


LATIN = 0x24F  # last character of the Latin blocks, whose classes are the same in all Unicode versions
FOREIGN_CHUNK = 1 << 16  # characters that one call of the library gets, about
#: Between a letter or digit and a space or mark there is always a border of the patterns
#: that this module serves: each alternative takes letters, digits, or neither.
_BORDER = re.compile(r"(?<=[^\W_])(?=[\s!-&(-/:-@\[-`{-~\u3001\u3002\uff01\uff0c\uff1f])")
SEEN_PIECES = 250_000  # pieces a worker remembers; beyond that it starts anew


def _ranges(keep) -> str:
    return "".join(f"\\u{c:04x}" for c in range(LATIN + 1) if keep(chr(c)))


def latin_pattern(pattern: str):
    """``pattern`` for Python's re on texts of characters up to U+024F, where
    its letter, number and space classes are written out; None if it uses
    other classes or the classes' meanings could differ."""
    inner = {r"\p{L}": _ranges(lambda c: unicodedata.category(c)[0] == "L"),
             r"\p{N}": _ranges(lambda c: unicodedata.category(c)[0] == "N"),
             r"\s": _ranges(lambda c: c in "\t\n\x0b\x0c\r \x85\xa0")}
    first, letters, rest = pattern.partition(r"| ?\p{L}+|")
    if letters and re.fullmatch(r"'\w+(?:\|'\w+)*", first):
        # alternatives that begin with different characters commute; the usual one goes first
        pattern = rf" ?\p{{L}}+|{first}|{rest}"
    out, inside, i = [], False, 0
    while i < len(pattern):
        m = re.match(r"\\(?:[pP]\{\w+\}|.)", pattern[i:])
        if m:
            name = m[0]
            if name == r"\S" and not inside:
                out.append(f"[^{inner[chr(92) + 's']}]")
            elif name in inner:
                out.append(inner[name] if inside else f"[{inner[name]}]")
            else:
                return None
            i += m.end()
            continue
        inside = pattern[i] == "[" or inside and pattern[i] != "]"
        out.append(pattern[i])
        i += 1
    return re.compile("".join(out))


class _Seen(dict):
    """Ids of the pieces seen, as int32 bytes; a piece that isn't there is
    noted in ``new`` and counts as nothing for now."""

    def __init__(self):
        self.new, self.misses = set(), 0

    def __missing__(self, piece):
        self.new.add(piece)
        self.misses += 1
        return b""


def _learn(alone, seen: _Seen) -> None:
    new = list(seen.new)
    e = alone.encode(new, is_pretokenized=True, add_special_tokens=False)
    cut = (4 * np.cumsum(np.bincount(np.array(e.word_ids, np.int64), minlength=len(new)))).tolist()
    ids = np.array(e.ids, np.int32).tobytes()
    seen.update(zip(new, [ids[lo:hi] for lo, hi in zip([0, *cut], cut)]))
    seen.new.clear()


def _parts(text: str) -> list[str]:
    """A text in parts of about FOREIGN_CHUNK characters, cut where pieces end; a
    longer run without a border stays whole."""
    out, at = [], 0
    while len(text) - at > FOREIGN_CHUNK and (m := _BORDER.search(text, at + FOREIGN_CHUNK)):
        out.append(text[at:m.start()])
        at = m.start()
    return [*out, text[at:]]


def _ids(key: tuple, texts: list[str], latin) -> list[np.ndarray]:
    whole, alone, _, seen = tokenizer(*key)
    if len(seen) > SEEN_PIECES:
        seen.clear()
    find = seen.__getitem__
    out, cut, rest = [b""] * len(texts), {}, []
    for k, text in enumerate(texts):
        if latin is None or _FOREIGN.search(text):
            rest.append(k)
            continue
        before, pieces = seen.misses, latin.findall(text)
        out[k] = b"".join(map(find, pieces))
        if seen.misses > before:
            cut[k] = pieces
    if seen.new:
        _learn(alone, seen)
        for k, pieces in cut.items():
            out[k] = b"".join(map(find, pieces))
    # the library's encodings are many times larger than the text, so a few texts, or a part of one, at a time
    parts = [(k, part) for k in rest for part in _parts(texts[k])]
    for i, j in row_chunks(np.cumsum([0, *(len(part) for _, part in parts)]), FOREIGN_CHUNK):
        for (k, _), e in zip(parts[i:j], whole.encode_batch_fast([part for _, part in parts[i:j]], add_special_tokens=False)):
            out[k] += np.array(e.ids, np.int32).tobytes()
    return [np.frombuffer(x, np.int32) for x in out]


_FOREIGN = re.compile(f"[^\\x00-\\u{LATIN:04x}]")


def _texts(arr: pa.Array) -> list[str]:
    return ["" if x is None else x for x in arr.to_pylist()]


def _encode(path: str, pattern: str, offsets: bool):
    def run(batches):
        sizes, latin = tokenizer(path, pattern)[2], latin_pattern(pattern)
        for b in batches:
            raw, offs = text_bytes(b.column("text"))
            for i, j in row_chunks(offs):
                rows = b.slice(i, j - i)
                ids = _ids((path, pattern), _texts(rows.column("text")), latin)
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                at = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                names = [n for n in b.schema.names if n != "text"]
                cols = [rows.column(n) for n in names] + [pa.ListArray.from_arrays(pa.array(at), pa.array(flat))]
                if offsets:
                    part = raw[offs[i]:offs[j]]
                    # characters begun before each byte, over the chunk; less those of earlier rows
                    begun = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))
                    end = np.cumsum(sizes[flat])
                    row = np.repeat(np.arange(j - i), np.diff(at))
                    before = begun[offs[i:j] - offs[i]][row]
                    first = begun[end - sizes[flat] + 1] - 1 - before
                    last = begun[end] - before
                    for x in (first, last):
                        cols.append(pa.ListArray.from_arrays(pa.array(at), pa.array(x.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, [*names, "ids", *(["starts", "ends"] if offsets else [])])
    return run


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", offsets: bool = True,
           keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with ids array<int> and, if asked for, starts and
    ends array<int>: each token's first character and one past its last, in
    code points. One row per input row, repeated rows included; a null or
    empty text has no tokens. Special-token strings are ordinary text. A very
    long text is encoded whole, in memory of a small multiple of it."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    more = ", starts array<int>, ends array<int>" if offsets else ""
    return (docs.select(*keep, F.col(text_col).alias("text"))
            .transform(map_batches, _encode(path, pattern, offsets), f"{kinds}, ids array<int>{more}"))


def _decode(path: str, ids_col: str):
    def run(batches):
        if path not in _CACHE:
            tokens = read_ranks(path)
            sizes = np.array([len(x) for x in tokens], np.int64)
            _CACHE[path] = (np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes, sizes)
        table, begin, sizes = _CACHE[path]
        for b in batches:
            lists = b.column(ids_col)
            n = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            for i, j in row_chunks(np.concatenate(([0], np.cumsum(n * 8)))):
                at = np.concatenate(([0], np.cumsum(n)))[i:j + 1]
                ids = flat[at[0]:at[-1]]
                size = sizes[ids]
                end = np.cumsum(size)
                data = table[np.repeat(begin[ids] - (end - size), size) + np.arange(size.sum())]
                cuts = np.concatenate(([0], end))[at - at[0]].astype(np.int64)
                out = pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(cuts), pa.py_buffer(data)])
                rows = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*rows.columns, out.cast(pa.binary())], [*b.schema.names, "decoded"])
    return run


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Adds decoded binary: the bytes of each row's ids (null ids: none). For a
    whole text's ids these are its UTF-8 bytes."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.transform(map_batches, _decode(path, ids_col), f"{kinds}, decoded binary")
