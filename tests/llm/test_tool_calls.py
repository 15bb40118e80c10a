import json

import pytest

from genrec.llm import tool_calls as q
from genrec.llm.common import table
from tests.llm.conftest import SF001

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id long, turn long, call_id string, content string"
TOOLS = {"t": {"type": "object", "properties": {"x": {"type": "integer"}}}}


def test_statuses_and_order(spark):
    calls = [(1, 1, "a", "t", '{"x":1}', ["b"]), (1, 2, "b", "t", '{"x":"no"}', ["c"]), (1, 3, "c", "t", '{"x":2.0}', None),
             (1, 4, "d", "t", '{"x":2}', ["e"]), (1, 5, "e", "t", '{"x":2}', ["d"]), (1, 6, "f", "u", "{}", []),
             (1, 7, "g", "t", "{bad", ["zz"]), (1, 8, "h", "t", '{"x":1}', ["c"]), (1, 8, "h", "t", '{"x":1}', ["c"]),
             (1, 9, "i", "t", '{"x":1}', ["c"]), (1, 9, "i", "t", '{"x":3}', ["c"]), (None, 1, "a", "t", "{}", None),
             (1, 10, "j", "t", '{"x":1}', ["e"]), (2, 1, "a", "t", None, None), (1, 11, "k", None, "{}", None)]
    results = [(1, 2, k, "r" + k) for k in "abcdefgijk"] + [(1, 3, "orphan", "z"), (None, 1, "a", ""), (2, 2, "a", None)]
    got = q.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), TOOLS).collect()
    by = {(r.conv_id, r.call_id): r for r in got}
    assert {k[1]: r.status for k, r in by.items() if k[0] == 1} == {
        "a": "ok", "b": "invalid_arguments", "c": "ok", "d": "cycle", "e": "cycle", "f": "unknown_tool", "g": "invalid_arguments",
        "h": "missing_result", "i": "duplicate_id", "j": "cycle", "k": "unknown_tool", "orphan": "orphan_result"}
    place = {k[1]: r.position for k, r in by.items() if k[0] == 1}
    assert place["c"] < place["b"] < place["a"] and place["orphan"] is None
    assert sorted(p for p in place.values() if p) == list(range(1, 12))
    assert by[2, "a"].status == "invalid_arguments" and json.loads(by[2, "a"].json)["result"] is None
    assert by[1, "c"].json == '{"arguments":{"x":2},"depends_on":[],"id":"c","name":"t","result":"rc","status":"ok"}'


def test_backward_chain_is_ordered(spark):
    n = 12
    calls = [(1, i, f"c{i}", "t", "{}", [f"c{i + 1}"]) for i in range(n)] + [(1, n, f"c{n}", "t", "{}", None)]
    got = q.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame([], RESULTS), TOOLS).collect()
    assert [r.call_id for r in sorted(got, key=lambda r: r.position)] == [f"c{i}" for i in range(n, -1, -1)]
    assert {r.status for r in got} == {"missing_result"}


def test_conversations_equal_brute_force(spark):
    df = table(spark, SF001, "conversations")
    said = {(r.conv_id, r.turn): (r.role, r.text) for r in df.collect()}
    want = {}
    for (conv, turn), (role, text) in said.items():
        if role == "user":
            answer = said.get((conv, turn + 1))
            linked = answer is not None and answer[0] == "assistant"
            earlier = [f"call-{turn - 2}"] if turn >= 2 else []
            want[conv, f"call-{turn}"] = ("ok" if linked else "missing_result", answer[1] if linked else None, text, earlier)
        elif role == "assistant" and said.get((conv, turn - 1), ("",))[0] != "user":
            want[conv, f"call-{turn - 1}"] = ("orphan_result", text, None, [])
    got = {}
    for r in q.link_conversations(df).collect():
        x = json.loads(r.json)
        assert r.json == q.canonical(x)
        got[r.conv_id, r.call_id] = (r.status, x["result"], (x["arguments"] or {}).get("question"), x["depends_on"])
    assert got == want


def test_embedded_calls_and_edges(spark):
    rows = [(1, 0, "assistant", '{"tool_calls": [{"id": "p", "name": "t", "arguments": "{\\"x\\": 1}"}]}'),
            (1, 1, "tool", ' {"tool_call_id": "p", "content": "done"}'), (1, 2, "user", None), (1, 2, "user", None), (None, 3, "user", "x"),
            (2, None, "user", "x"), (3, 0, None, "x"), (4, 0, "user", "y " * 50000), (4, 0, "user", "y " * 50000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "role as call_id")
    got = {(r.conv_id, r.call_id): r.status for r in q.link_conversations(df, TOOLS).collect()}
    assert got[1, "p"] == "ok" and got[1, "call-2"] == "missing_result" and got[4, "call-0"] == "missing_result"
    assert q.link_conversations(df.limit(0)).count() == 0


@pytest.mark.parametrize("arguments, status", [
    ('{"x":1e400}', "invalid_arguments"), ('{"x":' + "9" * 400 + "}", "ok"), ('{"x":"\\ud800"}', "invalid_arguments"),
    ('{"x":' + "[" * 1500 + "]" * 1500 + "}", "invalid_arguments"), ('{"x":' + "[" * 200 + "]" * 200 + "}", "invalid_arguments"),
    ('{"x":' + "9" * 5000 + "}", "invalid_arguments"), ('{"x":-1e-400}', "ok"), ("[" * 100000, "invalid_arguments")])
def test_odd_arguments_end_no_job(spark, arguments, status):
    calls = spark.createDataFrame([(1, 1, "a", "t", arguments, None), (1, 2, "b", "t", '{"x":1}', None)], CALLS)
    results = spark.createDataFrame([(1, 3, "a", "r"), (1, 4, "b", "r")], RESULTS)
    got = {r.call_id: r for r in q.link(calls, results, TOOLS).collect()}
    assert got["a"].status == status and got["b"].status == "ok"
    if status == "invalid_arguments" and len(arguments) < 1000:
        assert json.loads(got["a"].json)["arguments"] in (arguments, json.loads(arguments))


@pytest.mark.parametrize("value, text", [
    ({"b": 1.0, "a": [True, None, 1.5]}, '{"a":[true,null,1.5],"b":1}'), ({"\U00010000": 1, "￿": 2}, '{"\U00010000":1,"￿":2}'),
    ("é\n\"", '"é\\n\\""'), (10 ** 20, "100000000000000000000")])
def test_canonical(value, text):
    assert q.canonical(value) == text


def test_schema_rules():
    s = {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {
        "a": {"type": ["integer", "null"], "minimum": 2}, "b": {"type": "array", "items": {"enum": [1, "x"]}, "maxItems": 2},
        "c": {"anyOf": [{"type": "boolean"}, {"type": "string", "pattern": "^z"}]}}}
    good = [{"a": 2}, {"a": None, "b": [1, "x"]}, {"a": 3.0, "c": True}, {"a": 5, "c": "zz"}]
    bad = [{}, {"a": 1}, {"a": True}, {"a": 2.5}, {"a": 2, "d": 1}, {"a": 2, "b": [2]}, {"a": 2, "b": [1, 1, 1]}, {"a": 2, "c": "y"}, [], "a"]
    assert all(q.valid(x, s) for x in good) and not any(q.valid(x, s) for x in bad)
    assert q._parsed('{"a":1,"a":2}') == (None, False) and q._parsed("NaN") == (None, False) and q._parsed(None) == (None, False)
