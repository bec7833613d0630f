"""Token counts by prefix dynamic programming.

The tokenizer file (tokenizers library, BPE with word ends) is read for its
vocabulary and merges. For a piece of text the exact count at every prefix
is found from shorter prefixes: the encoding of a prefix ends with the one
token that stands stably beside the last token of the prefix before it (no
merge across their border would come earlier than the merges that made
them), so count[i] = count[i - len(token)] + 1. Where a text is cut, its
last piece carries the word end, which is one more step of the same table.

``prefix_counts`` stores, per document, the change of the count at every
character and the count at every ``MARK`` characters. ``with_count_at``,
``with_truncation`` and ``with_budget`` answer from that table without
encoding again.

Prefixes are those of the text as the tokenizer's first step leaves it (NFC,
special strings apart), in code points; for any k, the count at k is what
the library gives for the first k of them. Special strings inside texts are
one token, the library's default; a cut inside one counts as ordinary text.
A null text counts as empty; repeated rows are answered one by one; an empty
table gives an empty table. Very long texts: the table of a text takes two
bytes a character, and a piece without a break is walked in blocks, so time
and memory are linear in the text.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from operator import sub

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.llm.byte_bpe import LATIN, byte_characters, latin_pattern
from plover.llm.common import map_batches, row_chunks, text_bytes

MARK = 1024  # characters between stored counts
SEEN_PIECES = 300_000  # pieces a worker remembers, and as many that it saw before those
SEEN_PAIRS = 1_000_000  # the same for neighbour tokens
LONG_PIECE = 256  # characters; longer pieces are not remembered and are walked in blocks
BLOCK = 1 << 14
_SPACES = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # fixed: Unicode white space
# Small letters that differ from str.lower (no final sigma; Unicode 16).
_SMALL = {"\u03a3": "\u03c3", "\ua7cb": "\u0264", "\ua7dc": "\u019b"}
_CACHE: dict = {}


class Merges:
    """Vocabulary and merges of a BPE model, and which tokens may stand side by side."""

    def __init__(self, model: dict):
        self.suffix = model["end_of_word_suffix"]
        vocab = model["vocab"]
        parts, self.rank = {}, {}
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            whole = vocab[a + b] + 1
            self.rank.setdefault(vocab[a] + 1 << 16 | vocab[b] + 1, r)
            parts.setdefault(whole, (vocab[a] + 1, vocab[b] + 1, r))
        self.parts = parts
        self.right, self.left, self.near = {}, {}, {}
        sound = {}

        def is_sound(t):
            if t not in sound:
                p = parts.get(t)
                sound[t] = p is None or (is_sound(p[0]) and is_sound(p[1]) and self._stable(p[0], p[1], p[2]))
            return sound[t]

        # every ending of a token's symbols -> the token of just these symbols, without and
        # with the word end (16 bits each, 0: none)
        self.tails: dict[str, int] = {}
        for text, t in vocab.items():
            t += 1  # tokens are kept as id + 1
            if is_sound(t):
                ends = text.endswith(self.suffix)
                body = text[:-len(self.suffix)] if ends else text
                for k in range(1, len(body)):
                    self.tails.setdefault(body[k:], 0)
                self.tails[body] = self.tails.get(body, 0) | (t << 16 if ends else t)
        self.longest = max(map(len, self.tails))

    def _spine(self, t: int, side: int, known: dict) -> tuple:
        """The symbols at one edge of a token, smallest first, each with the rank
        of the merge that takes it up (the token itself: None)."""
        if t not in known:
            out, up = [], None
            x = t
            while True:
                out.append((x, up))
                if x not in self.parts:
                    break
                up, x = self.parts[x][2], self.parts[x][side]
            known[t] = tuple(reversed(out))
        return known[t]

    def _stable(self, a: int, b: int, end: int = 1 << 30) -> bool:
        """True if no merge across the border of a and b comes before the merges
        that make them; ``end`` is the time up to which that is asked. Of equal
        merges the left one goes first."""
        xs, ys, rank = self._spine(a, 1, self.right), self._spine(b, 0, self.left), self.rank
        i = j = 0
        while True:
            x, rx = xs[i]
            y, ry = ys[j]
            rx, ry = end if rx is None else rx, end if ry is None else ry
            m = rank.get(x << 16 | y)
            if m is not None and m < rx and m <= ry:
                return False
            if rx <= ry:
                i += 1
                if i == len(xs):
                    return True
            else:
                j += 1

    def beside(self, a: int, b: int) -> bool:
        """``_stable``, remembered."""
        if len(self.near) >= SEEN_PAIRS:
            self.near.clear()
        ok = self.near[a << 16 | b] = self._stable(a, b)
        return ok

    def extend(self, s: str, last: list, count: list, ends) -> list:
        """Fills ``last`` and ``count`` (last token and number of tokens of the
        encoding without word end) up to the length of ``s`` and returns the
        counts with word end at the positions ``ends`` past the old length."""
        tails, near = self.tails.get, self.near.get
        out, ends = [], iter(ends)
        want = next(ends, None)
        for i in range(len(last), len(s) + 1):
            inner = final = 0  # the encoding's last token has one length only, so any order of lengths will do
            ask = i == want
            for j in range(i - 1, -1, -1):
                e = tails(s[j:i])
                if e is None:
                    break
                t = e & 0xFFFF
                if t and not inner:
                    ok = not j or near(last[j] << 16 | t)
                    if ok is None:
                        ok = self.beside(last[j], t)
                    if ok:
                        last.append(t)
                        count.append(count[j] + 1)
                        inner = t
                        if final or not ask:
                            break
                t = e >> 16
                if t and ask and not final:
                    ok = not j or near(last[j] << 16 | t)
                    if ok is None:
                        ok = self.beside(last[j], t)
                    if ok:
                        out.append(count[j] + 1)
                        final = t
                        if inner:
                            break
            if not inner:
                raise ValueError("the vocabulary lacks a byte")
            if ask:
                want = next(ends, None)
        return out


def _steps(counts: list[int]) -> bytes:
    return array("h", map(sub, counts, [0, *counts[:-1]])).tobytes()


class PrefixCounter:
    """Counts of one tokenizer file, and the pieces a worker has seen."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, normal = spec["model"], spec.get("normalizer") or {}
        kinds = [n["type"] for n in normal.get("normalizers", [])]
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        if (model.get("type") != "BPE" or not model.get("end_of_word_suffix") or kinds != ["NFC", "Replace", "Lowercase"]
                or split.get("type") != "Split" or not split.get("invert")):
            raise ValueError(f"{path}: not a lower-casing BPE tokenizer with word ends")
        self.merges = Merges(model)
        pattern = split["pattern"]["Regex"]
        self.fixed = [p for p in pattern.split("|") if regex.fullmatch(r"'\w+", p)]
        letters = r"[\p{L}]+"
        if letters in pattern.split("|"):  # alternatives that begin with different characters commute
            pattern = "|".join([letters, r"\s+", *(p for p in pattern.split("|") if p != letters)])
        else:
            pattern += r"|\s+"
        self.find = regex.compile(pattern.replace(r"\s+", f"[{_SPACES}]+").replace(r"\s", _SPACES)).findall
        latin = latin_pattern(pattern)  # the same for Python's re, which is faster
        self.find_latin = latin and latin.findall
        self.foreign = regex.compile(f"[^\\x00-\\u{LATIN:04x}]").search
        special = [t["content"] for t in spec.get("added_tokens", []) if t.get("special")]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.chars = dict(enumerate(byte_characters()))
        self.space = regex.compile(f"[{_SPACES}]")
        self.seen: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _pieces(self, text: str) -> list[str]:
        return self.find(text) if self.find_latin is None or self.foreign(text) else self.find_latin(text)

    def _symbols(self, piece: str) -> tuple[str, list[int]]:
        """The piece's bytes as the vocabulary's characters, and where its code points end."""
        raw = piece.encode()
        if len(raw) == len(piece):
            return raw.decode("latin-1").translate(self.chars), list(range(1, len(raw) + 1))
        ends = [i for i in range(1, len(raw)) if raw[i] & 0xC0 != 0x80]
        return raw.decode("latin-1").translate(self.chars), [*ends, len(raw)]

    def _long(self, piece: str) -> bytes:
        """Steps of a long piece, block by block: only the states that a token
        can reach back to are kept."""
        last, count, before, out = [-1], [0], "", []
        for k in range(0, len(piece), BLOCK):
            s, ends = self._symbols(piece[k:k + BLOCK])
            out.extend(self.merges.extend(before + s, last, count, [e + len(before) for e in ends]))
            # more states than a token is long, so the next block cannot reach its position 0 and
            # take it for the piece's beginning
            before = (before + s)[-2 * self.merges.longest:]
            last, count = last[-len(before) - 1:], count[-len(before) - 1:]
        return _steps(out)

    def learn(self, pieces) -> None:
        """Steps of new pieces, in alphabetical order: a piece goes on from the
        states of the prefix that it shares with the one before."""
        s, ends, last, count, cuts = "", [], [-1], [0], []
        for piece in sorted(pieces):
            if self.space.match(piece):
                self.seen[piece] = bytes(2 * len(piece))
                continue
            if piece in self.fixed:
                continue
            if len(piece) > LONG_PIECE:
                self.seen[piece] = self._long(piece)
                continue
            t, t_ends = self._symbols(piece)
            same = 0
            for a, b in zip(s, t):
                if a != b:
                    break
                same += 1
            del last[same + 1:], count[same + 1:]
            keep = 0
            while keep < len(cuts) and keep < len(t_ends) and ends[keep] == t_ends[keep] and ends[keep] <= same:
                keep += 1
            # an end inside the shared part that the other piece did not have is asked anew
            if keep < len(t_ends) and t_ends[keep] <= same:
                del last[t_ends[keep]:], count[t_ends[keep]:]
            cuts = cuts[:keep] + self.merges.extend(t, last, count, t_ends[keep:])
            s, ends = t, t_ends
            self.seen[piece] = _steps(cuts)
        for piece in self.fixed:
            if piece in pieces:
                # cut short, such a piece falls into its mark and its letters
                letters = piece[1:]
                self.learn([x for x in {piece[0], *(letters[:k] for k in range(1, len(letters)))} if x not in self.seen])
                head = self._total(piece[0])
                at = [head, *(head + self._total(letters[:k]) for k in range(1, len(letters)))]
                t, t_ends = self._symbols(piece)
                at.append(self.merges.extend(t, [-1], [0], t_ends)[-1])
                self.seen[piece] = _steps(at)

    @staticmethod
    def _small(text: str) -> str:
        if not text.isascii():
            for a, b in _SMALL.items():
                text = text.replace(a, b)
        return text.lower()

    def _total(self, piece: str) -> int:
        return int(np.frombuffer(self.seen[piece], np.int16).sum())

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """Steps of NFC texts without special strings."""
        low = [self._small(t) for t in texts]
        if len(self.seen) > SEEN_PIECES:
            self.before, self.seen = self.seen, {}
        pieces = [self._pieces(t) for t in low]
        new = set().union(*pieces).difference(self.seen)
        known = new.intersection(self.before)
        self.seen.update((p, self.before[p]) for p in known)
        new -= known
        if new:
            self.learn(new)
        seen = self.seen.__getitem__
        out = []
        for t, small, ps in zip(texts, low, pieces):
            steps = np.frombuffer(b"".join(map(seen, ps)), np.int16)
            if len(small) != len(t):  # a character whose small form is several characters
                first = np.cumsum([0, *(len(c.lower()) for c in t)])[:-1]
                steps = np.add.reduceat(steps, first).astype(np.int16)
            out.append(steps)
        for p in [p for p in new if len(p) > LONG_PIECE]:
            del self.seen[p]
        return out

    def _cut(self, text: str) -> list[str]:
        """Ordinary text and special strings in turn, beginning with text."""
        out, at = [], 0
        for m in self.special.finditer(text) if self.special else ():
            out += [text[at:m.start()], m[0]]
            at = m.end()
        return [*out, text[at:]]

    def normal(self, text: str) -> str:
        """The text whose prefixes are counted."""
        if unicodedata.is_normalized("NFC", text):
            return text
        return "".join(x if k % 2 else unicodedata.normalize("NFC", x) for k, x in enumerate(self._cut(text)))

    def steps(self, texts: list[str]) -> list[np.ndarray]:
        """Per text (as ``normal`` gives it) the change of the count at each code point."""
        cut = {}
        if self.special:
            for k, t in enumerate(texts):
                if "<" in t and self.special.search(t):
                    cut[k] = self._cut(t)
        out = self._plain([t if k not in cut else "" for k, t in enumerate(texts)])
        for k, parts in cut.items():
            joined = []
            for i in range(0, len(parts), 2):
                mark = parts[i + 1] if i + 1 < len(parts) else ""
                text, within = self._plain([parts[i], parts[i] + mark[:-1]])
                joined.append(text)
                if mark:  # up to its last character the mark is ordinary text, then one token
                    inside = np.cumsum(within, dtype=np.int64)[len(parts[i]):]
                    before = int(text.sum(dtype=np.int64))
                    # the text's own last piece may go on into the mark, so steps are taken from the counts
                    joined.append(np.diff(np.array([before, *inside, before + 1], np.int64)).astype(np.int16))
            out[k] = np.concatenate(joined)
        return out


def counter(path: str) -> PrefixCounter:
    if path not in _CACHE:
        _CACHE[path] = PrefixCounter(path)
    return _CACHE[path]


def _lists(values: list[np.ndarray], kind) -> pa.Array:
    at = np.concatenate(([0], np.cumsum([len(x) for x in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([*values, np.zeros(0, np.int64)]), kind))


def _count(path: str, limits: dict[str, int], stored: bool):
    def run(batches):
        c = counter(path)
        for b in batches:
            _, offs = text_bytes(b.column("text"))
            names = [n for n in b.schema.names if n != "text"]
            for i, j in row_chunks(offs):
                rows = b.slice(i, j - i)
                steps = c.steps([c.normal(x or "") for x in rows.column("text").to_pylist()])
                marks = [_marks(s) for s in steps]
                cols = [rows.column(n) for n in names]
                cols += [pa.array(np.diff(offs[i:j + 1])), pa.array([len(s) for s in steps], pa.int64()),
                         pa.array([count_at(s, m, len(s)) for s, m in zip(steps, marks)], pa.int64())]
                cols += [pa.array([longest_within(s, m, limit) for s, m in zip(steps, marks)], pa.int64())
                         for limit in limits.values()]
                if stored:
                    cols += [_lists(marks, pa.int64()), pa.array([s.tobytes() for s in steps], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, [*names, "n_bytes", "n_chars", "n_tokens", *limits,
                                                        *(["marks", "steps"] if stored else [])])
    return run


def prefix_counts(docs: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                  limits: dict[str, int] | None = None, stored: bool = True) -> DataFrame:
    """The prefix table: the ``keep`` columns, n_bytes (UTF-8, of the text as
    given), n_chars and n_tokens long (of its NFC form), marks array<long>
    (tokens of the first 0, MARK, 2 MARK, ... characters) and steps binary
    (little-endian 16-bit change of the count at each character). Limits that
    are known beforehand are answered as the table is made: a column for each
    name in ``limits``, as by ``with_truncation``. ``stored=False`` leaves
    marks and steps out, where only these answers are wanted."""
    limits = limits or {}
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    more = "".join(f", `{c}` long" for c in limits) + (", marks array<bigint>, steps binary" if stored else "")
    return (docs.select(*keep, F.col(text_col).alias("text")).transform(
        map_batches, _count(path, limits, stored), f"{kinds}, n_bytes long, n_chars long, n_tokens long{more}"))


def _answers(answer, ask: str, out: str):
    def run(batches):
        for b in batches:
            steps, marks = b.column("steps"), b.column("marks")
            got = [None if q is None or steps[k].as_py() is None else
                   answer(np.frombuffer(steps[k].as_buffer(), np.int16), marks[k].values.to_numpy(), q)
                   for k, q in enumerate(b.column(ask).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.int64())], [*b.schema.names, out])
    return run


def _ask(table: DataFrame, answer, ask: str, out: str) -> DataFrame:
    if out in table.columns:
        raise ValueError(f"column {out} is there already")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    return table.transform(map_batches, _answers(answer, ask, out), f"{kinds}, `{out}` long")


def _marks(steps: np.ndarray) -> np.ndarray:
    if not len(steps):
        return np.zeros(0, np.int64)
    whole = np.add.reduceat(steps, np.arange(0, len(steps), MARK), dtype=np.int64)
    return np.cumsum(whole) - whole


def count_at(steps: np.ndarray, marks: np.ndarray, k: int) -> int:
    k = min(max(int(k), 0), len(steps))
    if k == 0:
        return 0
    m = (k - 1) // MARK
    return int(marks[m]) + int(steps[m * MARK:k].sum(dtype=np.int64))


def longest_within(steps: np.ndarray, marks: np.ndarray, limit: int) -> int:
    """Characters of the longest prefix of at most ``limit`` tokens. Counts can
    fall when a piece grows, so blocks are looked at from the last one on."""
    if limit < 0:
        return 0
    for m in range(len(marks) - 1, -1, -1):
        part = steps[m * MARK:(m + 1) * MARK]
        fits = np.flatnonzero(np.cumsum(part, dtype=np.int64) + marks[m] <= limit)
        if len(fits):
            return m * MARK + int(fits[-1]) + 1
    return 0


def with_count_at(table: DataFrame, chars_col: str, out: str = "tokens_at") -> DataFrame:
    """Adds the count of the first ``chars_col`` characters (beyond the text: of all; null: null)."""
    return _ask(table, count_at, chars_col, out)


def with_truncation(table: DataFrame, limit_col: str, out: str = "fit_chars") -> DataFrame:
    """Adds the characters of the longest prefix within ``limit_col`` tokens (null: null)."""
    return _ask(table, longest_within, limit_col, out)


def with_budget(table: DataFrame, limit: int, out: str = "over_limit") -> DataFrame:
    """Adds whether the whole text has more than ``limit`` tokens."""
    return table.withColumn(out, F.col("n_tokens") > F.lit(limit))
