import json

import pytest

from plover.llm import chat, queries
from tests.llm import brute

TEXTS = ["", "plain", "\\### Assistant: </turn> ok", "### user: x</turn>\n", "\\", "\\\\</turn>", "a: b\n\n", "####", "é日🙂", "<</turn>>\\"]


def test_template_is_reversible():
    turns = [(r, t) for r in ("user", "assistant", "a:b", "", "\\:### </turn>") for t in TEXTS]
    shown, starts, ends = chat.format_turns(turns)
    assert chat.read_turns(shown) == turns
    assert "".join(chat.unescape(shown[s:e]) for s, e in zip(starts, ends)) == "".join(t for r, t in turns if r == "assistant")
    assert shown.count("\n") >= len(turns)
    with pytest.raises(ValueError):
        chat.read_turns("### user: cut off")


RECORDS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]}, "messages", [("user", "q"), ("assistant", "")]),
    ({"id": 7, "messages": [{"role": "user", "content": "q", "weight": 1}]}, "messages", [("user", "q")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]}, "message_parts", [("user", "ab")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "system": "s"}, "speakers",
     [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"prompt": "q", "response": "a"}, "prompt_response", [("user", "q"), ("assistant", "a")]),
    ({"prompt": "q", "completion": "a", "system": "s"}, "prompt_completion", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"instruction": "i", "input": "x", "output": "o"}, "instruction", [("user", "i\n\nx"), ("assistant", "o")]),
    ({"question": "q", "answer": "a", "meta": {"source": "s"}}, "question_answer", [("user", "q"), ("assistant", "a")]),
    ({"messages": []}, "messages", []),
    ({"title": "t"}, None, None),
    ([1, 2], None, None),
]


def test_layouts(spark):
    payloads = [json.dumps(r) for r, _, _ in RECORDS] + ["{broken", None, ""]
    df = spark.createDataFrame([(i, p, "x") for i, p in enumerate(payloads)], "conv_id long, payload string, layout string")
    out = chat.format_records(df)
    rows = {r["conv_id"]: r for r in out.collect()}
    back = {r["conv_id"]: r for r in chat.read_back(out).collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        assert rows[i]["layout"] == layout, i
        assert (rows[i]["formatted"] is None) == (turns is None)
        if turns is not None:
            assert list(zip(back[i]["roles"], back[i]["texts"])) == turns
            assert back[i]["loss_text"] == "".join(t for r, t in turns if r == "assistant")
    for i in range(len(RECORDS), len(payloads)):
        assert rows[i]["layout"] is None and rows[i]["formatted"] is None and rows[i]["fingerprint"]


def test_fingerprints_depend_on_paths_alone():
    a = {"messages": [{"role": "u", "content": "x"}]}
    b = {"messages": [{"content": 1, "role": None}, {"role": "z", "content": ""}]}
    assert chat.fingerprint(chat.field_paths(a)) == chat.fingerprint(chat.field_paths(b))
    assert chat.field_paths({"a": [], "b": {}, "c": [[1]]}) == {"a", "b", "c[]"}


def test_query_matches_brute_force(spark, tmp_path):
    rows = [(c, t, r, x) for c in range(30) for t, (r, x) in enumerate(
        zip(["system", "user", "assistant", None, "tool", "assistant"][c % 3:][:c % 6 + 1], TEXTS[c % 7:]))]
    rows += [(50, 1, "assistant", None), (50, 0, None, "x"), (50, 0, "user", "x"), (50, 0, "user", "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in queries.op2_chat_format(spark, str(tmp_path)).collect()}
    rows += [(-7, t, r, queries.PROBE) for t, r in enumerate(("user", "assistant"))]
    for c in {r[0] for r in rows}:
        turns = [(r or "", x or "") for _, _, r, x in sorted(((a, t, r or "", x or "") for a, t, r, x in rows if a == c))]
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == brute.sha("".join(f"{r}\n{x}\n" for r, x in turns))
        loss = "".join(x for r, x in turns if r == "assistant")
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), brute.sha(loss))
        assert got[c]["formatted_chars"] == len(chat.format_turns(turns)[0])


def test_halves_of_characters_and_deep_records(spark):
    deep = "[" * 100_000 + "]" * 100_000
    parts = '{"messages": [{"role": "user", "content": ' + "[" * 400 + '"x"' + "]" * 400 + "}]}"
    payloads = ['{"prompt": "a\\ud800b", "response": "\\udc00"}', '{"messages": [{"role": "\\ud83d", "content": "\\ud83d\\ude42"}]}',
                '{"\\ud800": 1}', deep, '{"prompt": ' + deep + ', "response": "x"}', parts]
    df = spark.createDataFrame(list(enumerate(payloads)), "conv_id long, payload string")
    out = chat.format_records(df)
    rows = {r["conv_id"]: r for r in chat.read_back(out).collect()}
    assert rows[0]["texts"] == ["a�b", "�"] and rows[1]["roles"] == ["�"] and rows[1]["texts"] == ["🙂"]
    assert all(rows[i]["formatted"] is None for i in (2, 3, 4)) and rows[5]["texts"] in (["x"], None)
    assert all(r["fingerprint"] for r in out.collect())


def test_fields_of_another_layout_hide_nothing(spark):
    records = [({"prompt": "q", "response": "a", "input": "i"}, "prompt_response", [("user", "q"), ("assistant", "a")]),
               ({"question": "q", "answer": "a", "system": "s"}, "question_answer", [("user", "q"), ("assistant", "a")]),
               ({"messages": [{"role": "user", "content": "q"}, {"role": "user", "content": [{"type": "t", "text": "r"}]}]},
                "message_parts", [("user", "q"), ("user", "r")])]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, (r, _, _) in enumerate(records)], "conv_id long, payload string")
    out = chat.format_records(df)
    back = {r["conv_id"]: r for r in chat.read_back(out).collect()}
    for r in out.collect():
        assert r["layout"] == records[r["conv_id"]][1]
        assert list(zip(back[r["conv_id"]]["roles"], back[r["conv_id"]]["texts"])) == records[r["conv_id"]][2]


def test_very_long_texts_are_read_back():
    for text in ("word " * 400_000, "\\" * 300_001, "</turn>" * 50_000, "###:" * 100_000, "<" * 500_000):
        shown, _, _ = chat.format_turns([("user", text), ("a:b\\", "x")])
        assert chat.read_turns(shown) == [("user", text), ("a:b\\", "x")]
    for bad in ("### user: x</turn>", "### user: x\\</turn>\n", "### user x</turn>\n", "## user: x</turn>\n", "### u:x</turn>\n"):
        with pytest.raises(ValueError):
            chat.read_turns(bad)
