"""Chat formatting by schema fingerprints.

A record is a JSON object of any layout. Its nested field paths (list
elements as ``[]``) are hashed to a fingerprint, and the fingerprint selects
a declarative mapping that turns the record into canonical turns (role,
text). Fields that a layout does not know are left out of a second fingerprint
for that layout, so neither metadata nor another layout's field hides it.

Template: each turn is ``### role: text</turn>`` and a line feed. Inside
roles and texts a backslash goes before every backslash and control string
(``###`` and ``</turn>``, in roles also ``:``); as no lone backslash is left, reading
back is exact. The loss mask is a list of code point ranges of the formatted
text: the texts of assistant turns, without header and end mark.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame

HEAD, END = "### ", "</turn>"
_TEXT_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_LONE = re.compile("[\ud800-\udfff]")  # JSON escapes can name half a character
LOSS_ROLE = "assistant"


@dataclass(frozen=True)
class Layout:
    """``turns``: the list of messages with the paths of role and text in it,
    or ``fields``: (role, top-level fields whose texts make the turn, joined
    by a blank line). ``optional`` paths may be missing."""

    name: str
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict = field(default_factory=dict)


SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant"}
LAYOUTS = (
    Layout("messages", ("messages[].role", "messages[].content"), turns=("messages", "role", "content")),
    Layout("message_parts", ("messages[].role", "messages[].content[].text"), ("messages[].content[].type",),
           turns=("messages", "role", "content")),
    Layout("speakers", ("conversations[].from", "conversations[].value"), ("system",),
           turns=("conversations", "from", "value"), roles=SPEAKERS),
    Layout("prompt_response", ("prompt", "response"), ("system",),
           fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("prompt_completion", ("prompt", "completion"), ("system",),
           fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("instruction", ("instruction", "output"), ("input", "system"),
           fields=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("question_answer", ("question", "answer"),
           fields=(("user", ("question",)), ("assistant", ("answer",)))),
)


def field_paths(value, at: str = "") -> set[str]:
    """Paths of a JSON value's leaves; an empty list or object is a leaf."""
    out, todo = set(), [(value, at)]
    while todo:
        value, at = todo.pop()
        if isinstance(value, dict) and value:
            todo += [(v, f"{at}.{k}" if at else k) for k, v in value.items()]
        elif isinstance(value, list) and any(isinstance(v, (dict, list)) for v in value):
            todo += [(v, f"{at}[]") for v in value]
        else:
            out.add(at)
    return out


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode("utf-8", "surrogatepass")).hexdigest()[:16]


def mappings(layouts=LAYOUTS) -> dict[str, Layout]:
    """Layout by fingerprint, one entry for every set of optional paths."""
    out = {}
    for x in layouts:
        for n in range(len(x.optional) + 1):
            for more in combinations(x.optional, n):
                out[fingerprint((*x.paths, *more))] = x
        if x.turns:  # no message at all
            out.setdefault(fingerprint((x.turns[0],)), x)
    return out


def _text(v) -> str:
    if v is None:
        return ""
    if isinstance(v, list):  # parts of one message
        return "".join(_text(p.get("text") if isinstance(p, dict) else p) for p in v)
    return v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)


def canonical_turns(record: dict, layout: Layout) -> list[tuple[str, str]]:
    if layout.turns:
        many, role, text = layout.turns
        said = [(layout.roles.get(_text(m.get(role)), _text(m.get(role))), _text(m.get(text)))
                for m in record.get(many) or [] if isinstance(m, dict)]
        return [("system", _text(record["system"])), *said] if record.get("system") is not None else said
    return [(role, "\n\n".join(_text(record[f]) for f in names if record.get(f) is not None))
            for role, names in layout.fields if any(f in record for f in names)]


def layout_of(record, known: dict[str, Layout], layouts=LAYOUTS) -> tuple[str, Layout | None]:
    """Fingerprint of the record, and the layout it selects: by all its paths, or
    by those of them that a layout knows. Of several layouts that fit so, the
    one with most known paths is taken, then the first."""
    paths = field_paths(record) if isinstance(record, dict) else {""}
    key = fingerprint(paths)
    if key in known:
        return key, known[key]
    fits = [(len(own), -k, x) for k, x in enumerate(layouts) for own in [paths & {*x.paths, *x.optional}]
            if known.get(fingerprint(own)) is x]
    return key, max(fits, key=lambda f: f[:2])[2] if fits else None


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """Formatted text, and the loss mask's starts and ends."""
    out, at, starts, ends = [], 0, [], []
    for role, text in turns:
        head = HEAD + _ROLE_CONTROL.sub(r"\\\g<0>", role) + ": "
        body = _TEXT_CONTROL.sub(r"\\\g<0>", text)
        if role == LOSS_ROLE:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        out.append(head + body + END + "\n")
        at += len(out[-1])
    return "".join(out), starts, ends


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _unescaped(text: str, mark: str, at: int) -> int:
    """Place of the next ``mark`` that no backslash escapes, or -1."""
    while (k := text.find(mark, at)) >= 0:
        lead = k
        while lead > 0 and text[lead - 1] == "\\":
            lead -= 1
        if (k - lead) % 2 == 0:
            return k
        at = k + 1
    return -1


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text; one that the template can't have made
    raises ValueError."""
    out, at = [], 0
    while at < len(formatted):
        colon = _unescaped(formatted, ":", at + len(HEAD)) if formatted.startswith(HEAD, at) else -1
        end = _unescaped(formatted, END, colon + 2) if colon >= 0 and formatted.startswith(": ", colon) else -1
        if end < 0 or not formatted.startswith(END + "\n", end):
            raise ValueError(f"not a turn at {at}")
        out.append((unescape(formatted[at + len(HEAD):colon]), unescape(formatted[colon + 2:end])))
        at = end + len(END) + 1
    return out


def _strings(values):
    return pa.array(values, pa.string())


def _format(payload: str, layouts):
    known = mappings(layouts)

    def one(text):
        try:
            record = json.loads(text) if text is not None else None
        except (ValueError, RecursionError):
            record = None
        key, layout = layout_of(record, known, layouts)
        if layout is None:
            return key, None, None, None, None, None
        try:
            turns = [(_LONE.sub("\ufffd", r), _LONE.sub("\ufffd", t)) for r, t in canonical_turns(record, layout)]
        except RecursionError:  # parts within parts, too deep to read
            return key, None, None, None, None, None
        return key, layout.name, *format_turns(turns), len(turns)

    def run(batches):
        for b in batches:
            names = [n for n in b.schema.names if n != payload]
            cols = list(zip(*map(one, b.column(payload).to_pylist()))) or [[]] * 6
            kinds = (pa.string(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in names), *(pa.array(list(c), k) for c, k in zip(cols, kinds))],
                [*names, "fingerprint", "layout", "formatted", "loss_starts", "loss_ends", "n_turns"])
    return run


def format_records(records: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ("conv_id",),
                   layouts=LAYOUTS) -> DataFrame:
    """The ``keep`` columns with fingerprint, layout, formatted, loss_starts,
    loss_ends and n_turns, one row per record.

    A record of unknown layout, broken or too deeply nested JSON or null keeps
    its row with everything but the fingerprint null. Null texts and roles are
    empty; a record without messages is formatted as the empty text. Half a
    character from an escape becomes U+FFFD. Very long texts are formatted and
    read in time linear in their length; repeated rows are formatted each."""
    kinds = ", ".join(f"`{c}` {records.schema[c].dataType.simpleString()}" for c in keep)
    return records.select(*keep, payload).mapInArrow(
        _format(payload, layouts), f"{kinds}, fingerprint string, layout string, formatted string, "
                                   "loss_starts array<long>, loss_ends array<long>, n_turns long")


def _read(batches):
    for b in batches:
        names = [n for n in b.schema.names if n not in ("formatted", "loss_starts", "loss_ends")]
        shown, roles, texts, loss = b.column("formatted").to_pylist(), [], [], []
        for text, s, e in zip(shown, b.column("loss_starts").to_pylist(), b.column("loss_ends").to_pylist()):
            turns = read_turns(text) if text is not None else None
            roles.append(None if turns is None else [r for r, _ in turns])
            texts.append(None if turns is None else [t for _, t in turns])
            loss.append(None if turns is None else "".join(unescape(text[p:q]) for p, q in zip(s, e)))
        yield pa.RecordBatch.from_arrays(
            [*(b.column(n) for n in names), b.column("formatted"), pa.array(roles, pa.list_(pa.string())),
             pa.array(texts, pa.list_(pa.string())), _strings(loss)],
            [*names, "formatted", "roles", "texts", "loss_text"])


def read_back(formatted: DataFrame, keep: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """The ``keep`` columns with formatted, roles, texts and loss_text (all
    text under the loss mask, unescaped), from the output of
    ``format_records``; null formatted texts stay null."""
    kinds = ", ".join(f"`{c}` {formatted.schema[c].dataType.simpleString()}" for c in keep)
    return formatted.select(*keep, "formatted", "loss_starts", "loss_ends").mapInArrow(
        _read, f"{kinds}, formatted string, roles array<string>, texts array<string>, loss_text string")
