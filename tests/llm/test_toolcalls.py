import json
import random

import pytest

from rankspark.llm import toolcalls as C

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, depends_on array<string>, level string"
RESULTS = "conv_id long, call_id string, turn long, content string"


def brute_levels(nodes, edges):
    deps = {n: {d for c, d in edges if c == n and d in nodes} for n in nodes}
    level = {}
    while True:
        new = {n: max((level[d] + 1 for d in deps[n]), default=0) for n in nodes if n not in level and all(d in level for d in deps[n])}
        if not new:
            return {n: level.get(n) for n in nodes}
        level |= new


@pytest.mark.parametrize("kind", ["chain", "random", "cycle"])
def test_levels_against_brute_force(spark, kind):
    rng = random.Random(3)
    nodes = [f"n{i}" for i in range(40)]
    rng.shuffle(nodes)
    if kind == "chain":
        edges = [(b, a) for a, b in zip(nodes, nodes[1:])]
    else:
        edges = [(nodes[rng.randint(i + 1, 39)], nodes[i]) for i in range(39) for _ in range(rng.randint(0, 3))] + [(nodes[4], "unknown")]
    if kind == "cycle":
        edges += [(nodes[0], nodes[7]), (nodes[7], nodes[0]), (nodes[20], nodes[20])]
    calls = spark.createDataFrame([(c, n) for n in nodes for c in (1, 2)], "conv_id long, call_id string")
    frame = spark.createDataFrame([(1, a, b) for a, b in edges], "conv_id long, call_id string, dep string")
    got = {(r.conv_id, r.call_id): r.level for r in C.levels(calls, frame).collect()}
    assert {n: got[1, n] for n in nodes} == brute_levels(nodes, edges)
    assert all(got[2, n] == 0 for n in nodes)


def test_validation_linking_and_canonical_text(spark):
    schemas = spark.createDataFrame([("add", "a", "integer", True), ("add", "b", "number", False), ("say", "t", "string", True)], C.SCHEMA)
    rows = [(1, "x", 0, "add", ' {"b": 2, "a" : 1}', None), (1, "y", 1, "add", '{"a":1.5,"z":[1]}', ["x"]), (1, "z", 2, "say", '{}', ["y", "q"]),
            (1, "w", 3, "nope", '{"é":"\\u00e9\\n"}', []), (1, "v", 4, "say", "{broken", []), (1, "u", 5, "say", None, []), (1, "l", 5, "say", "[1]", None),
            (2, "x", 0, "say", '{"t":"' + "long " * 100000 + '"}', ["x"]), (1, "x", 9, "say", '{"t":"later copy"}', []),
            (None, "x", 0, "add", "{}", []), (1, None, 0, "add", "{}", [])]
    calls = spark.createDataFrame([(*r, "clash") for r in rows], CALLS)
    results = spark.createDataFrame([(1, "x", 3, "3"), (1, "x", 2, "2"), (1, "ghost", 8, None), (1, "y", 4, None), (None, "x", 1, "q")], RESULTS)
    got = {(r.conv_id, r.call_id): r for r in C.link(calls, results, schemas).collect()}
    assert len(got) == 9
    assert got[1, "x"].linked and got[1, "x"].valid
    assert got[1, "x"].canonical == '{"arguments":{"a":1,"b":2},"call_id":"x","conv_id":1,"errors":[],"level":0,"name":"add","result":"2","turn":0}'
    assert got[1, "y"].errors == ["a: number instead of integer", "z: unknown parameter"] and got[1, "y"].linked and got[1, "y"].level == 1
    assert got[1, "z"].errors == ["result: missing", "t: missing"] and got[1, "z"].level == 2
    assert got[1, "w"].errors == ["name: no schema", "result: missing"]
    for c in "vul":
        assert "arguments: not a JSON object" in got[1, c].errors and not got[1, c].valid
    assert got[1, "ghost"].errors == ["result: no call"] and not got[1, "ghost"].linked and got[1, "ghost"].turn == 8
    assert got[2, "x"].errors == ["cycle", "result: missing"] and got[2, "x"].level is None
    for r in got.values():
        text = json.loads(r.canonical)
        assert list(text) == sorted(text)
    empty = C.link(calls.limit(0), results.limit(0), schemas)
    assert empty.count() == 0


def test_sample_table(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    calls, results = C.conversation_calls(turns)
    got = C.link(calls, results, spark.createDataFrame(C.CHAT_SCHEMAS, C.SCHEMA)).collect()
    rows = turns.collect()
    role = {(r.conv_id, r.turn): r for r in rows}
    assert len(got) == sum(r.role != "assistant" for r in rows) + sum(r.role == "assistant" and getattr(role.get((r.conv_id, r.turn - 1)), "role", "assistant") == "assistant" for r in rows)
    for r in got:
        if "result: no call" not in r.errors:
            text = json.loads(r.canonical)
            own = role[r.conv_id, r.turn]
            assert text["arguments"] == ({"prompt": own.text, "turn": own.turn} if own.role == "user" else {"instructions": own.text})
            after = role.get((r.conv_id, r.turn + 1))
            assert r.linked == (after is not None and after.role == "assistant") and (not r.linked or text["result"] == after.text)
