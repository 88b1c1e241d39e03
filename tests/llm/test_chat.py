"""Chat formatting: links, order and JSON by hand and against a plain version; schemas; texts that are hard to read."""

import json
import random
from decimal import Decimal

import pytest

from quernstone.llm import chat

SCHEMAS = {"search": {"type": "object", "properties": {"query": {"type": "string"}, "limit": {"type": "integer"}}, "required": ["query"], "additionalProperties": False}}


def call(*calls):
    return json.dumps({"content": "looking", "tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})


def result(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


ROWS = [
    (1, 0, "user", "hé\n\"q\""),
    (1, 1, "tool", result("b", "early")),
    (1, 2, "assistant", call(("a", "search", {"query": "x", "limit": 2}), ("b", "search", '{"query": 5}'), ("c", "other", {}))),
    (1, 3, "user", "wait"),
    (1, 4, "tool", result("a", [1, {"z": 1, "a": None}])),
    (1, 5, "tool", result("a", "again")),
    (1, 6, "tool", result("zz", "nobody")),
    (2, 0, "tool", result("a", "other conversation")),
    (2, 1, "assistant", "{not json \"tool_calls\""),
    (2, 2, "tool", "{}"),
    (2, None, None, None),
    (2, 2, "tool", "{}"),
    (None, 1, "assistant", call(("n", "search", {"query": "x"}))),
    (None, 2, "tool", result("n", "null conversation")),
    (3, 0, "user", "long " * 40000),
]


def test_links_order_and_json(spark):
    frame = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").repartition(3).selectExpr("*", "1 as conv", "2 as message")
    out = chat.format_chats(frame, SCHEMAS).collect()
    assert len(out) == len(ROWS)
    first = sorted((r for r in out if r.conv_id == 1), key=lambda r: (r.anchor, r.step, r.turn))
    assert [(r.turn, r.status) for r in first] == [(0, "message"), (2, "call"), (4, "result"), (1, "result"), (3, "message"), (5, "duplicate"), (6, "orphan")]
    assert (first[1].n_calls, first[1].n_invalid) == (3, 2)
    assert first[0].message == '{"content":"hé\\n\\"q\\"","role":"user"}'
    assert first[2].message == '{"content":[1,{"a":null,"z":1}],"role":"tool","tool_call_id":"a"}'
    assert [c["valid"] for c in json.loads(first[1].message)["tool_calls"]] == [True, False, False]
    assert {r.status for r in out if r.conv_id == 2} == {"orphan", "message"}
    assert sorted((r.anchor, r.status) for r in out if r.conv_id is None) == [(1, "call"), (1, "result")]
    lines = chat.assemble(chat.format_chats(frame, SCHEMAS), 3).where("conv_id = 1").orderBy("part").collect()
    assert "\n".join(r.lines for r in lines) == "\n".join(r.message for r in first)
    assert chat.format_chats(frame.limit(0)).collect() == []


def test_schemas():
    schema = {"type": "object", "properties": {"a": {"enum": [1, 2]}, "b": {"type": "array", "items": {"type": "number"}}}}
    assert chat.valid({"a": 1, "b": [1, 2.5], "c": 0}, schema)
    assert not chat.valid({"a": 3}, schema) and not chat.valid({"b": [True]}, schema) and not chat.valid([], schema)
    assert chat.valid(2.0, {"type": "integer"}) and not chat.valid(True, {"type": "integer"}) and chat.valid(None, {"type": "null"})


def plain(rows):
    """Anchor, step and status of each message, one conversation at a time."""
    turn_of = lambda t: chat.LEAST if t is None else t
    out = []
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv]
        calls = {}
        for _, turn, role, text in sorted(own, key=lambda r: turn_of(r[1])):
            for i, c in enumerate(json.loads(text)["tool_calls"] if role == "assistant" and "tool_calls" in text else []):
                if isinstance(c["id"], str) and c["id"] not in calls:
                    needs = {x["$result"] for x in c["arguments"].get("from", [])}
                    calls[c["id"]] = (turn_of(turn), i + 1, needs)
        needs = {k: {x for x in v[2] if x in calls} for k, v in calls.items()}
        order = {}
        while True:
            ready = {k: (max([calls[k][0], *[order[x][0] for x in needs[k]]]), 1 + max([order[x][1] for x in needs[k]], default=-1)) for k in calls if k not in order and needs[k] <= set(order)}
            if not ready:
                break
            order |= ready
        results = {}
        for _, turn, role, text in own:
            if role == "tool":
                results.setdefault(json.loads(text)["tool_call_id"], []).append((turn_of(turn), chat.message(role, text, {})[0]))
        for _, turn, role, text in own:
            made = chat.message(role, text, {})[0]
            status, anchor, step = "call" if role == "assistant" and "tool_calls" in text else "message", turn, 0
            if role == "tool":
                key = json.loads(text)["tool_call_id"]
                if key not in calls:
                    status = "orphan"
                elif (turn_of(turn), made) != min(results[key]):
                    status = "duplicate"
                else:
                    status = "result" if key in order else "cyclic"
                    anchor, level = order.get(key, (calls[key][0], 0))
                    anchor, step = None if anchor == chat.LEAST else anchor, level * chat.LEVEL + calls[key][1]
            out.append((conv, turn, role, anchor, step, status, made))
    return sorted(out, key=str)


def test_against_a_plain_version(spark):
    draw = random.Random(7)
    rows = []
    for conv in [*range(12), None]:
        for turn in [*range(14), None]:
            role = draw.choice(["user", "assistant", "assistant", "tool", "tool"])
            if role == "assistant":
                made = [{"id": draw.choice([*"abcdefgh", 5]), "name": "t", "arguments": {"from": [{"$result": x} for x in draw.choices("abcdefghz", k=draw.choice([0, 0, 1, 2]))]}} for _ in range(draw.randrange(1, 4))]
                rows.append((conv, turn, role, json.dumps({"content": turn, "tool_calls": made})))
            else:
                rows.append((conv, turn, role, result(draw.choice("abcdefgh"), draw.randrange(3)) if role == "tool" else "hello"))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = [(r.conv_id, r.turn, r.role, r.anchor, r.step, r.status, r.message) for r in chat.format_chats(frame).collect()]
    want = plain(rows)
    assert sorted(got, key=str) == want
    assert {"result", "cyclic", "orphan", "duplicate"} <= {r[5] for r in want} and any(r[4] >= chat.LEVEL for r in want)


def test_texts_that_are_hard_to_read(spark):
    texts = [
        '{"tool_call_id":"a","content":"\\ud800"}', '{"tool_call_id":"\\udfff","content":1}', '{"tool_call_id":"a","content":NaN}', '{"tool_call_id":"a","content":1e999}', '{"tool_call_id":"a","content":-Infinity}',
        '{"tool_call_id":"a","content":' + "[" * 3000 + "]" * 3000 + "}", '{"tool_call_id":"a","content":' + "9" * 5000 + "}", '{"tool_call_id":"a","content":{"\ufb33":1,"\U0001f600":2,"x":1.0}}', "{", "", None,
    ]
    frame = spark.createDataFrame([(1, i, "tool", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    got = {r.turn: (r.status, r.message) for r in chat.format_chats(frame).collect()}
    assert len(got) == len(texts)
    assert got[0] == ("orphan", '{"content":"\\ud800","role":"tool","tool_call_id":"a"}') and json.loads(got[0][1])["content"] == "\ud800"
    assert got[1][0] == "orphan" and [got[i][0] for i in (2, 3, 4, 8, 9, 10)] == ["message"] * 6 and got[5][0] == got[6][0] == "orphan"
    assert got[7][1] == '{"content":{"x":1,"\U0001f600":2,"\ufb33":1},"role":"tool","tool_call_id":"a"}'  # by UTF-16 units
    mixed = json.dumps({"tool_calls": [{"id": 5, "name": "search", "arguments": {"query": "x"}}, {"id": "a", "name": "search", "arguments": {"query": "x"}}]})
    made, calls, wrong, _ = chat.message("assistant", mixed, SCHEMAS)
    assert [c["id"] for c in calls] == [None, "a"] and wrong == 1 and [c["valid"] for c in json.loads(made)["tool_calls"]] == [False, True]


def test_numbers_are_written_as_in_ecmascript():
    for x, want in ((1.0, "1"), (1e21, "1" + "0" * 21), (10**25, "1" + "0" * 25), (1e25, "1" + "0" * 25), (Decimal("-" + "9" * 5000), "-" + "9" * 5000), (1e-7, "1e-7"), (1.5e-6, "0.0000015"), (123e18, "123000000000000000000"), (-0.0, "0"), (5e-324, "5e-324"), (2**70, str(2**70)), (0.1, "0.1")):
        assert chat.number(x) == want


def test_all_keywords_of_schemas():
    good = [
        (3, {"type": ["integer", "null"], "minimum": 1, "maximum": 3, "multipleOf": 1.5}), ("abc", {"minLength": 3, "maxLength": 3, "pattern": "^a"}), ([1, 2], {"minItems": 2, "maxItems": 2, "uniqueItems": True, "prefixItems": [{"const": 1}], "items": {"const": 2}}),
        ({"x1": 1}, {"patternProperties": {"^x": {"type": "integer"}}, "additionalProperties": False, "minProperties": 1}), (1, {"anyOf": [{"type": "string"}, {"enum": [1.0]}], "not": {"const": 2}, "allOf": [True], "oneOf": [{"const": 1}, {"const": 2}]}), (1, True),
    ]
    bad = [
        (4, {"maximum": 3}), (0, {"exclusiveMinimum": 0}), (1, {"multipleOf": 2}), ("abcd", {"maxLength": 3}), ("b", {"pattern": "^a"}), ([1, 1.0], {"uniqueItems": True}), ([1], {"minItems": 2}), ({"y": 1}, {"patternProperties": {"^x": True}, "additionalProperties": False}),
        (True, {"enum": [1]}), (1, {"oneOf": [True, {"const": 1}]}), (1, {"not": {"type": "number"}}), ({}, {"minProperties": 1}), ({"a": "x"}, {"additionalProperties": {"type": "number"}}), (1, False), (1, {"type": ["string", "null"]}),
    ]
    for value, schema in good:
        chat.check_schema(schema)
        assert chat.valid(value, schema), (value, schema)
    for value, schema in bad:
        chat.check_schema(schema)
        assert not chat.valid(value, schema), (value, schema)
    for unknown in ({"dependentRequired": {}}, {"type": "text"}, {"properties": {"a": {"$ref": "#"}}}, {"anyOf": [3]}):
        with pytest.raises(ValueError):
            chat.check_schema(unknown)


def test_depth_and_size_have_no_limit():
    deep = '{"a":' * 20_000 + '[1,2.5,"x\\n",true,null,{}]' + "}" * 20_000
    assert chat.canonical(chat.loads(deep)) == deep
    call = '{"tool_calls":[{"id":"a","name":"t","arguments":{"x":' + "[" * 5_000 + "1" * 6_000 + "]" * 5_000 + "}}]}"
    text, links, wrong, _ = chat.message("assistant", call, {"t": {"type": "object"}})
    assert "1" * 6_000 in text and [x["id"] for x in links] == ["a"] and not wrong


def some_json(draw, depth):
    kind = draw.randrange(7 if depth else 5)
    if kind == 5:
        return [some_json(draw, depth - 1) for _ in range(draw.randrange(4))]
    if kind == 6:
        return {str(i): some_json(draw, depth - 1) for i in range(draw.randrange(4))}
    return [None, True, draw.randrange(-99, 99), '"\\\n é' + str(draw.random()), draw.random() * 10 ** draw.randrange(-9, 30)][kind]


def test_the_reader_of_deep_json_agrees_with_the_library():
    draw = random.Random(7)
    for _ in range(1500):
        value = some_json(draw, 4)
        text = json.dumps(value, indent=draw.choice([None, 1]))
        assert chat._deep(text) == value
        for bad in (text[:-1], text + "]", text.replace(",", ",,", 1) + ",", text.replace(":", "", 1), text.replace('"', "", 1)):
            try:
                want = json.loads(bad)
            except ValueError:
                with pytest.raises(ValueError):
                    chat._deep(bad)
            else:
                assert chat._deep(bad) == want


@pytest.mark.parametrize("schema", [{"multipleOf": 0}, {"multipleOf": "2"}, {"pattern": "("}, {"patternProperties": {"(": True}}, {"minimum": "a"}, {"maxLength": -1}, {"required": "a"}, {"properties": {"x": {"pattern": "["}}}])
def test_schemas_that_cannot_be_checked_are_refused(schema):
    with pytest.raises(ValueError):
        chat.check_schema(schema)


def test_multiples_are_exact():
    assert chat.valid(10**400, {"multipleOf": 2}) and not chat.valid(10**400 + 1, {"multipleOf": 2})
    assert chat.valid(0.3, {"multipleOf": 0.1}) and not chat.valid(0.35, {"multipleOf": 0.1}) and chat.valid(10**25, {"const": 1e25})
