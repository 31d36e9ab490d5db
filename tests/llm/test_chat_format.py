import json

from chronomart.llm import chat_format
from chronomart.llm.queries import QUERIES

CALLS = "conv long, turn long, index int, id string, tool string, arguments string"
RESULTS = "conv long, turn long, index int, id string, content string"
SCHEMAS = {"add": {"required": ["a", "b"], "properties": {"a": "integer", "b": "number", "note": "string"}}}


def linked(spark, calls, results):
    out = chat_format.linked(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS)
    return sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0] or 0, r[1], r[2], r[3], r[4]))


def test_links_order_and_states(spark):
    calls = [
        (1, 1, 0, "x", "add", '{"b": 2.5, "a": 1}'),
        (1, 1, 1, "y", "add", '{"a": {"$result": "x"}, "b": 1}'),
        (1, 1, 2, "z", "add", '{"a": 1, "b": "two", "note": 3}'),
        (1, 3, 0, "x", "add", '{"a": 9, "b": 9}'),
        (1, 4, 0, "lost", "add", '{"a": 1}'),
        (1, 5, 0, None, "add", None),
        (2, 1, 0, "x", "divide", '{"a": 1}'),
        (2, 1, 1, "r1", "add", '{"a": {"$result": "r2"}}'),
        (2, 1, 2, "r2", "add", '{"a": {"$result": "r1"}}'),
        (2, 2, 0, "bad", "add", "[1"),
    ]
    results = [
        (1, 2, 0, "x", "3.5"), (1, 2, 1, "y", "4"), (1, 0, 0, "z", "early"), (1, 2, 2, "x", "again"),
        (1, 2, 3, "none", "?"), (2, 2, 0, "x", None), (2, 2, 1, "r1", "a"), (2, 2, 2, "r2", "b"), (2, 2, 3, "bad", "b"),
    ]
    rows = linked(spark, calls, results)
    by = {(r[0], r[3], r[4], r[5]): r for r in rows}
    assert len(rows) == len(calls) + len(results)
    status = {k: r[7] for k, r in by.items()}
    assert status[1, 1, 0, "call"] == "ok" and status[1, 3, 0, "call"] == "duplicate_call"
    assert status[1, 1, 2, "call"] == "invalid" and by[1, 1, 2, "call"][8] == ["type:b", "type:note"]
    assert by[1, 1, 1, "call"][8] == ["type:a"]
    assert status[1, 4, 0, "call"] == "unanswered" and by[1, 4, 0, "call"][8] == ["missing:b"]
    assert status[1, 5, 0, "call"] == "no_identifier" and by[1, 5, 0, "call"][8] == ["no_object"]
    assert by[2, 1, 0, "call"][8] == ["unknown_tool"] and by[2, 2, 0, "call"][8] == ["no_object"]
    assert status[2, 1, 1, "call"] == status[2, 1, 2, "call"] == "cyclic"
    assert status[1, 2, 3, "result"] == "orphan_result"
    # A result never sorts before its call, nor a call before the results it cites.
    order = {(r[0], r[6], r[5]): (r[1], r[2]) for r in reversed(rows) if r[7] != "duplicate_call"}
    for conv, id_ in [(1, "x"), (1, "y"), (1, "z"), (2, "x")]:
        assert order[conv, id_, "call"] < order[conv, id_, "result"]
    assert order[1, "x", "result"] <= order[1, "y", "call"]
    assert by[1, 1, 0, "call"][9] == '{"arguments":{"a":1,"b":2.5},"id":"x","name":"add","role":"assistant"}'
    for r in rows:
        assert json.dumps(json.loads(r[9]), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r[9]


def test_a_long_chain_of_citations(spark):
    calls = [(1, 1, 0, "c0", "add", "{}")]
    calls += [(1, 1, i, f"c{i}", "add", f'{{"a": {{"$result": "c{i - 1}"}}}}') for i in range(1, 6)]
    rows = linked(spark, calls, [])
    assert [r[6] for r in rows] == [f"c{i}" for i in range(6)] and [r[1] for r in rows] == list(range(1, 7))


def test_no_rows(spark):
    assert linked(spark, [], []) == []


def test_given_conversations(spark):
    sf = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    text = {(r.conv_id, r.turn): r for r in given}
    found = QUERIES["op4_chat_format"](spark, sf).collect()
    assert len(found) == len(given)
    for r in found:
        own = text[r.conv_id, r.turn]
        content = json.loads(r.json)
        assert json.dumps(content, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.json
        if own.role == "user":
            answer = text.get((r.conv_id, r.turn + 1))
            assert r.status == ("ok" if answer and answer.role == "assistant" else "unanswered")
            assert content["arguments"] == {"turn": r.turn, "text": own.text, "words": content["arguments"]["words"]}
        elif own.role == "assistant":
            before = text.get((r.conv_id, r.turn - 1))
            assert r.status == ("ok" if before and before.role == "user" else "orphan_result")
            assert content["content"] == own.text


def test_a_chain_of_any_length_is_ordered(spark):
    calls = [(1, 1, 0, "c0", "add", "{}")]
    calls += [(1, 1, i, f"c{i}", "add", f'{{"a": {{"$result": "c{i - 1}"}}}}') for i in range(1, 1050)]
    calls += [(1, 1, 2000, "two", "add", '{"a": {"$result": "c900"}, "b": {"$result": "c3"}}')]
    calls += [(2, 1, i, f"r{i}", "add", f'{{"a": {{"$result": "r{(i + 1) % 3}"}}}}') for i in range(3)]
    calls += [(2, 1, 3, "behind", "add", '{"a": {"$result": "r0"}}')]
    rows = linked(spark, calls, [(1, 50, 0, "c10", "late")])
    assert {r[7] for r in rows if r[0] == 2} == {"cyclic"} and not [r for r in rows if r[0] == 1 and r[7] == "cyclic"]
    steps = {r[6]: r[1] for r in rows if r[0] == 1 and r[5] == "call"}
    assert all(steps[f"c{i}"] == (i + 1 if i <= 10 else i + 40) for i in range(1050)) and steps["two"] == 941
