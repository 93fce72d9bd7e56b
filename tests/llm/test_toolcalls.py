"""Tool-call linking against a plain version, and edge cases."""

import json
import random

import pytest

from tracklake.llm import toolcalls
from tracklake.llm.queries import op4_tool_calls, tool_call_graph
from tracklake.llm.toolcalls import canonical, faults, link_calls, link_conversations, parse, topological_levels

CALLS = "conv_id long, turn long, at int, call_id string, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id long, turn long, at int, call_id string, content string"
SCHEMAS = {"add": {"type": "object", "properties": {"a": {"type": "number"}, "b": {"type": ["number", "null"]}}, "required": ["a"], "additionalProperties": False}}


def test_table_against_plain_version(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    by = {(r.conv_id, r.turn): r for r in rows}
    want = {}
    for (c, t), r in by.items():
        if r.role == "user":
            answer = by.get((c, t + 1))
            answer = answer if answer and answer.role == "assistant" else None
            out = {"id": f"{c}/{t}", "name": "reply", "arguments": {"prompt": r.text, "turn": t}, "depends_on": [f"{c}/{t - 2}"] if t >= 2 else []}
            if answer:
                out["result"] = answer.text
            want[c, t] = ("linked" if answer else "no_result", canonical(out), t)
        elif r.role == "assistant" and by.get((c, t - 1), r).role != "user":
            want[c, t] = ("orphan_result", canonical({"id": f"{c}/{t - 1}", "result": r.text}), None)
    got = {(r.conv_id, r.turn): (r.status, r.json, r.level) for r in op4_tool_calls(spark, sf).collect()}
    assert got == want


def test_states(spark):
    calls = spark.createDataFrame(
        [
            (1, 0, 0, "a", "add", '{"b": 2, "a": 1}', []),
            (1, 1, 0, "b", "add", '{"a": "x"}', ["a", "gone", None]),
            (1, 2, 0, "a", "add", '{"a": 3}', []),
            (1, 3, 0, "c", "nope", "{}", ["b"]),
            (1, 4, 0, "d", "add", "{oops", None),
            (1, 5, 0, None, "add", '{"a": 1}', []),
            (2, 0, 0, "a", "add", '{"a": 1}', ["b"]),
            (2, 1, 0, "b", "add", '{"a": 1}', []),
            (2, 2, 0, "x", "add", '{"a": 1}', ["y"]),
            (2, 3, 0, "y", "add", '{"a": 1}', ["x"]),
            (None, 0, 0, "a", "add", '{"a": 1}', []),
        ],
        CALLS,
    )
    results = spark.createDataFrame([(1, 1, 0, "a", "3"), (1, 9, 0, "a", "4"), (1, 2, 0, "z", "?"), (2, 4, 0, "a", None), (2, 4, 1, None, "no")], RESULTS)
    got = {(r.conv_id, r.turn, r.kind): (r.status, r.level, json.loads(r.json)) for r in link_calls(calls, results, SCHEMAS).collect()}
    states = {k: v[0] for k, v in got.items()}
    assert states == {
        (1, 0, "call"): "linked", (1, 1, "call"): "invalid_arguments", (1, 2, "call"): "duplicate_call", (1, 3, "call"): "unknown_tool",
        (1, 4, "call"): "invalid_arguments", (1, 5, "call"): "no_id", (2, 0, "call"): "linked", (2, 1, "call"): "no_result", (2, 2, "call"): "cycle",
        (2, 3, "call"): "cycle", (None, 0, "call"): "no_id", (1, 9, "result"): "duplicate_result", (1, 2, "result"): "orphan_result", (2, 4, "result"): "no_id",
    }
    assert got[1, 0, "call"][2] == {"id": "a", "name": "add", "arguments": {"a": 1, "b": 2}, "depends_on": [], "result": "3"}
    assert got[1, 1, "call"][2]["faults"] == ["$.a: not number"]
    assert got[2, 0, "call"][1] > got[2, 1, "call"][1]
    assert link_calls(calls.limit(0), results.limit(0), SCHEMAS).collect() == []


def test_levels_respect_dependencies(spark):
    rng = random.Random(7)
    rows, edges = [], []
    for c in range(20):
        order = list(range(15))
        rng.shuffle(order)
        for k, i in enumerate(order):
            need = [f"n{j}" for j in rng.sample(order[:k], min(k, rng.randrange(3)))]
            rows.append((c, f"n{i}", i, need))
            edges += [(c, f"n{i}", n) for n in need]
    got = {(r.conv_id, r.call_id): r.level for r in topological_levels(spark.createDataFrame(rows, "conv_id long, call_id string, turn long, depends_on array<string>")).collect()}
    assert len(got) == len(rows)
    assert all(got[c, a] > got[c, b] for c, a, b in edges)


def longest(rows):
    """The longest chain of dependencies of each call, by following them; None on or behind a cycle."""
    needs = {(c, i): [(c, n) for n in set(need) if any(r[0] == c and r[1] == n for r in rows)] for c, i, _, need in rows}
    out, open_ = {}, set(needs)
    while ready := [x for x in open_ if all(n in out for n in needs[x])]:
        for x in ready:
            out[x] = max((out[n] + 1 for n in needs[x]), default=0)
        open_ -= set(ready)
    return out | dict.fromkeys(open_)


@pytest.mark.parametrize("most_pairs", [1000, 0])
def test_levels_are_longest_chains(spark, most_pairs):
    """Random graphs with cycles, by squaring and by peeling."""
    rng = random.Random(13)
    rows = []
    for c in range(40):
        n = rng.randrange(1, 14)
        for i in range(n):
            need = [f"n{rng.randrange(n + 1)}" for _ in range(rng.randrange(3))] if c % 3 else [f"n{j}" for j in range(i + 1, min(n, i + 3))]
            rows.append((c, f"n{i}", 5, need))
    want = longest(rows)
    got = topological_levels(spark.createDataFrame(rows, "conv_id long, call_id string, turn long, depends_on array<string>"), most_pairs)
    odd = {c for c, i, _, need in rows if any((c, n) in want for n in need)}
    assert {(r.conv_id, r.call_id): r.level for r in got.collect()} == {k: v if k[0] in odd else 5 for k, v in want.items()}


def test_deep_chain_takes_few_rounds(spark, monkeypatch):
    """A thousand calls, each waiting for the next turn's, and a cycle behind a chain."""
    rounds = []
    real = toolcalls.materialize
    monkeypatch.setattr(toolcalls, "materialize", lambda df, name: rounds.append(name) or real(df, name))
    rows = [(1, f"n{i}", i, [f"n{i + 1}"]) for i in range(1000)] + [(2, f"n{i}", i, [f"n{(i + 1) % 9}"]) for i in range(9)] + [(2, "behind", 20, ["n3"]), (2, "free", 21, [])]
    got = {(r.conv_id, r.call_id): r.level for r in topological_levels(spark.createDataFrame(rows, "conv_id long, call_id string, turn long, depends_on array<string>")).collect()}
    assert all(got[1, f"n{i}"] == 999 - i for i in range(1000))
    assert got[2, "free"] == 0 and got[2, "behind"] is None and all(got[2, f"n{i}"] is None for i in range(9))
    assert rounds.count("reach") < 12


def test_graph_query_has_every_state(spark):
    rows = tool_call_graph(spark, "/root/testdata/sf0.01").collect()
    assert {r.status for r in rows} >= {"linked", "cycle", "invalid_arguments"}


def test_tags_and_schema_faults(spark):
    text = 'go <tool_call>{"id":"k","name":"add","arguments":{"b":null,"a":1.5}}</tool_call> and <tool_call>not json</tool_call>'
    rows = [(1, 0, "user", "hi é"), (1, 1, "assistant", text), (1, 2, "tool", '<tool_result>{"id":"k","content":"done"}</tool_result>'), (2, 0, None, None), (3, 0, "user", None)]
    got = [(r.conv_id, r.at, r.status, r.json) for r in link_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), SCHEMAS).collect()]
    assert (1, 0, "linked", '{"arguments":{"a":1.5,"b":null},"depends_on":[],"id":"k","name":"add","result":"done"}') in got
    assert {(c, s) for c, a, s, _ in got} >= {(1, "no_id"), (1, "linked"), (3, "invalid_arguments")}
    assert faults([1, "a"], {"type": "array", "items": {"type": "integer"}}) == ["$[1]: not integer"]
    assert faults(True, {"type": "integer"}) and faults(3, {"enum": [1, 2]})


def test_odd_arguments(spark):
    deep = lambda n: "[" * n + "]" * n
    assert parse(deep(200))[1] == [] and parse(deep(201)) == (deep(201), ["$: nested more than 200 deep"])
    assert parse('{"a":"' + "[" * 500 + '\\""}')[1] == [] and parse("[" * 100_000)[1]
    for bad in ("NaN", "[1, -Infinity]", "1e999", "{", "", "9" * 5000, None):
        assert parse(bad) == (bad, ["$: not JSON"])
    assert canonical(parse('{"b":"\\ud800x","a":"\\ud83d\\ude00"}')[0]) == '{"a":"😀","b":"\\ud800x"}'
    assert faults(1, {"type": "integral"}) == ["$: not integral"] and faults(1, {"type": ["integral", "number"]}) == []
    schemas = SCHEMAS | {"odd": {"type": "integral"}, "any": {}}
    given = ['{"a":"\\ud800"}', deep(100_000), "NaN", "1e999", '{"a": 1}', "\x00", '"' + "x" * 2_000_000 + '"']
    rows = [(1, k, 0, f"c{k}", "any", a, []) for k, a in enumerate(given)] + [(1, 90, 0, "o", "odd", "1", []), (1, 90, 0, "o", "odd", "1", [])]
    calls = spark.createDataFrame([(*r, "extra", "extra") for r in rows], CALLS + ", level string, state string")
    results = spark.createDataFrame([(1, 1, 0, "c0", "done", "x"), (1, 1, 0, "c0", "done", "x")], RESULTS + ", status string")
    got = sorted(((r.turn, r.kind, r.status, r.json) for r in link_calls(calls, results, schemas).collect()), key=str)
    states = {(t, k): s for t, k, s, _ in got}
    assert [states[k, "call"] for k in range(7)] == ["linked", "invalid_arguments", "invalid_arguments", "invalid_arguments", "no_result", "invalid_arguments", "no_result"]
    assert [s for t, k, s, _ in got if t == 90] == ["invalid_arguments"] * 2
    assert len([1 for r in got if json.loads(r[3], parse_constant=int)["id"]]) == len(got)
