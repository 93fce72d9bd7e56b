"""Chat formatting: linking tool calls to their results."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, spread

#: How a call and a result are marked in a message.
CALL_TAG, RESULT_TAG = "tool_call", "tool_result"

_CALLS = "struct<id:string,name:string,arguments:string,depends_on:array<string>>"
_RESULTS = "struct<id:string,content:string>"

#: The deepest nesting of arguments that is validated and written as JSON.
DEEPEST = 200

_LONE = re.compile("[\ud800-\udfff]")
_TYPES = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
    "null": lambda v: v is None,
}


def _tagged(messages: DataFrame, tag: str, kind: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(f"(?s)<{tag}>(.*?)</{tag}>"), 1)
    return messages.filter(F.col("text").contains(f"<{tag}>")).select(
        "conv_id", "turn", F.posexplode(found).alias("at", "raw")
    ).select("conv_id", "turn", "at", "raw", F.from_json("raw", kind).alias("j"))


def tagged_calls(messages: DataFrame) -> DataFrame:
    """Calls that messages carry in tags, as JSON with id, name, arguments and depends_on."""
    return _tagged(messages, CALL_TAG, _CALLS).select(
        "conv_id", "turn", "at", F.col("j.id").alias("call_id"), F.col("j.name").alias("name"),
        F.coalesce(F.get_json_object("raw", "$.arguments"), F.lit("null")).alias("arguments"), F.coalesce("j.depends_on", F.array()).alias("depends_on"),
    )


def tagged_results(messages: DataFrame) -> DataFrame:
    """Results that messages carry in tags, as JSON with id and content."""
    return _tagged(messages, RESULT_TAG, _RESULTS).select("conv_id", "turn", "at", F.col("j.id").alias("call_id"), F.col("j.content").alias("content"))


def exchange_calls(messages: DataFrame) -> DataFrame:
    """Each user message as a call of the tool ``reply`` that depends on the exchange before it."""
    name = lambda turn: F.concat_ws("/", F.col("conv_id").cast("string"), turn.cast("string"))
    return messages.filter("role = 'user'").select(
        "conv_id", "turn", F.lit(-1).alias("at"), name(F.col("turn")).alias("call_id"), F.lit("reply").alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"), "turn"), {"ignoreNullFields": "false"}).alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(name(F.col("turn") - 2))).otherwise(F.array().cast("array<string>")).alias("depends_on"),
    )


def exchange_results(messages: DataFrame) -> DataFrame:
    """Each assistant message as the result of the call one turn before it."""
    call = F.concat_ws("/", F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string"))
    return messages.filter("role = 'assistant'").select("conv_id", "turn", F.lit(-1).alias("at"), call.alias("call_id"), F.col("text").alias("content"))


#: Pairs of a squared relation, for each call and dependency, up to which it is squared.
MOST_PAIRS = 16


def topological_levels(calls: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """A level for each call: above those of all calls of its conversation that it depends on.

    Where every dependency lies in an earlier turn, the turn itself is such a
    level and nothing is computed.  For conversations with a dependency that
    does not, the level is the length of the longest chain of dependencies.  In
    each round the relation "reaches in 2^k steps" is squared; calls that reach
    nothing in 2^k steps but something, y, in half of them have a level of half
    of them and the highest level of such y, all of which are known by then.  So
    there are as many rounds as the longest chain's length has binary digits.
    What still reaches something in as many steps as its conversation has calls
    lies on or behind a cycle and has no level.  Where squaring would give more
    than ``most_pairs`` pairs for each call and dependency, as in wide graphs,
    which are seldom deep, the calls that are left are peeled level by level.
    Dependencies on calls that do not exist are ignored.

    ``calls`` has ``conv_id``, ``call_id`` (once each), ``turn``, ``depends_on``.
    Returns ``conv_id``, ``call_id``, ``level``.
    """
    key = ["conv_id", "call_id"]
    turns = calls.select(*key, "turn")
    edges = calls.select(*key, "turn", F.explode(F.array_distinct("depends_on")).alias("need"))
    before = turns.select("conv_id", F.col("call_id").alias("need"), F.col("turn").alias("need_turn"))
    edges = materialize(spread(edges, before, ["conv_id", "need"]).select(*key, "turn", "need", "need_turn"), "edges")
    odd = edges.filter("need_turn >= turn or turn is null or need_turn is null").select("conv_id").distinct()
    regular = spread(turns, odd, ["conv_id"], "left_anti").select(*key, F.col("turn").alias("level"))
    left = materialize(spread(turns, odd, ["conv_id"], "left_semi").select(*key), "left")
    if left.isEmpty():
        return regular
    edges = materialize(spread(edges, odd, ["conv_id"], "left_semi").select(*key, "need"), "edges")
    longest = left.groupBy("conv_id").count().agg(F.max("count")).first()[0]
    most = most_pairs * (edges.count() + left.count())
    reach, steps, todo = edges, 1, edges.select(*key).distinct()
    done = spread(left, todo, key, "left_anti").select(*key, F.lit(0).cast("long").alias("level"))
    done = materialize(done, "levels")
    while steps < longest and not reach.isEmpty():
        ways = reach.groupBy("conv_id", F.col("need").alias("call_id")).agg(F.count("*").cast("double").alias("ins"))
        pairs = spread(reach.groupBy(*key).agg(F.count("*").alias("outs")), ways, key).agg(F.sum(F.col("outs") * F.col("ins"))).first()[0]
        if (pairs or 0) > most:
            return regular.unionByName(_peeled(todo, edges, done))
        onward = reach.select("conv_id", F.col("call_id").alias("need"), F.col("need").alias("far"))
        twice = materialize(spread(reach, onward, ["conv_id", "need"]).select(*key, F.col("far").alias("need")).distinct(), "reach")
        still = twice.select(*key).distinct()
        ended = spread(reach, still, key, "left_anti")
        known = done.select("conv_id", F.col("call_id").alias("need"), "level")
        found = spread(ended, known, ["conv_id", "need"]).groupBy(*key).agg((F.max("level") + steps).alias("level"))
        done = done.unionByName(materialize(found, "levels"))
        reach, todo, steps = twice, still, 2 * steps
    return regular.unionByName(done).unionByName(todo.select(*key, F.lit(None).cast("long").alias("level")))


def _peeled(todo: DataFrame, edges: DataFrame, done: DataFrame) -> DataFrame:
    """Levels of the calls ``todo`` one by one: those whose dependencies all have a level get the next; null on or behind a cycle."""
    key = ["conv_id", "call_id"]
    todo, n = materialize(todo, "left"), todo.count()
    while n:
        known = done.select("conv_id", F.col("call_id").alias("need"), "level")
        needs = spread(spread(edges, todo, key, "left_semi"), known, ["conv_id", "need"], "left")
        tops = needs.groupBy(*key).agg(F.max("level").alias("top"), F.count("*").alias("all"), F.count("level").alias("some"))
        found = materialize(tops.filter("all = some").select(*key, (F.col("top") + 1).alias("level")), "levels")
        if not (m := found.count()):
            break
        done = materialize(done.unionByName(found), "levels")
        todo, n = materialize(spread(todo, found, key, "left_anti"), "left"), n - m
    return done.unionByName(todo.select(*key, F.lit(None).cast("long").alias("level")))


def faults(value, schema: dict, path: str = "$") -> list[str]:
    """What is wrong with a value under a JSON schema of types, properties, required, items, enum and additionalProperties.

    A type that JSON does not have fits no value.
    """
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(k in _TYPES and _TYPES[k](value) for k in kinds):
        return [f"{path}: not {' or '.join(kinds)}"]
    out = [f"{path}: not one of the values"] if "enum" in schema and value not in schema["enum"] else []
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            if k in known:
                out += faults(v, known[k], f"{path}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{path}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        out += [x for i, v in enumerate(value) for x in faults(v, schema["items"], f"{path}[{i}]")]
    return out


def canonical(value) -> str:
    """JSON with sorted keys and no spaces; letters stand as they are, halves of surrogate pairs escaped."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return _LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def _finite(text: str) -> float:
    value = float(text)
    if not math.isfinite(value):
        raise ValueError(f"{text} is no number of JSON")
    return value


def parse(text: str | None) -> tuple[object, list[str]]:
    """The value of a JSON text and no fault; or the text itself and what is wrong with it.

    Faults are: no JSON (NaN and numbers beyond a double's range are none), and
    nesting beyond ``DEEPEST``.
    """
    if text is None:
        return None, ["$: not JSON"]
    depth = most = 0
    for part in re.findall(r'"(?:[^"\\]|\\.)*"|[\[\]{}]', text, re.DOTALL):
        depth += (part in "[{") - (part in "]}") if len(part) == 1 else 0
        most = max(most, depth)
    if most > DEEPEST:
        return text, [f"$: nested more than {DEEPEST} deep"]
    try:
        return json.loads(text, parse_float=_finite, parse_constant=_finite), []
    except ValueError:
        return text, ["$: not JSON"]


def _serialise(schemas: dict[str, dict]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            status, text = [], []
            rows = batch.to_pylist()
            for r in rows:
                if r["kind"] == "result":
                    state = r["state"]
                    out = {"id": r["call_id"], "result": r["content"]}
                else:
                    arguments, wrong = parse(r["arguments"])
                    state = r["state"]
                    if not wrong and r["name"] in schemas:
                        wrong = faults(arguments, schemas[r["name"]])
                    if state in ("linked", "no_result"):
                        state = "unknown_tool" if r["name"] not in schemas else "invalid_arguments" if wrong else state
                    out = {"id": r["call_id"], "name": r["name"], "arguments": arguments, "depends_on": sorted({d for d in r["depends_on"] or [] if d is not None})}
                    if wrong:
                        out["faults"] = wrong
                    if r["state"] == "linked":
                        out["result"] = r["content"]
                status.append(state)
                text.append(canonical(out))
            keep = [batch.column(c) for c in ("conv_id", "turn", "at", "kind", "call_id", "level")]
            yield pa.record_batch([*keep, pa.array(status, pa.string()), pa.array(text, pa.string())], names=["conv_id", "turn", "at", "kind", "call_id", "level", "status", "json"])

    return run


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Join calls and results by conversation and identifier, order, validate and serialise them.

    ``calls``: conv_id, turn, at (place in the turn), call_id, name, arguments
    (JSON), depends_on.  ``results``: conv_id, turn, at, call_id, content.
    ``schemas`` holds a JSON schema for each tool and is small.

    Returns one row for each call, and for each result that no call took:
    ``conv_id``, ``turn``, ``at``, ``kind``, ``call_id``, ``level`` (sorting by
    level, turn and place is a topological order), ``status`` and canonical
    ``json``.  Of calls that share an identifier the first is linked, the others
    are ``duplicate_call``; of results likewise, ``duplicate_result``; so a hot
    identifier never gives pairs.  Other states: ``linked``, ``no_result``,
    ``orphan_result``, ``invalid_arguments``, ``unknown_tool``, ``cycle``,
    ``no_id``.  Null conversations and identifiers join nothing.

    Arguments that are no JSON, or nested more than ``DEEPEST`` deep, are
    ``invalid_arguments`` and stand as the text that they are.  Rows that repeat
    place and identifier are linked each.  Texts of any length are taken whole.
    Empty tables give no rows of their kind; other columns are ignored.
    """
    calls = calls.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("at").cast("int").alias("at"), "call_id", "name", "arguments", "depends_on")
    results = results.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("at").cast("int").alias("at"), "call_id", "content")
    key, place = ["conv_id", "call_id"], F.struct("turn", "at")
    named = lambda df: df.filter(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull())
    first_call = materialize(named(calls).groupBy(*key).agg(F.min(place).alias("c"), F.min(F.struct("turn", "at", "depends_on")).alias("d")), "first-calls")
    first_result = materialize(named(results).groupBy(*key).agg(F.min(F.struct("turn", "at", "content")).alias("r")), "first-results")
    levels = topological_levels(first_call.select("conv_id", "call_id", F.col("c.turn").alias("turn"), F.col("d.depends_on").alias("depends_on")))
    own = spread(first_call.select(*key, "c"), levels, key, "left").withColumn("has", F.lit(True))
    linked = spread(spread(calls, own, key, "left"), first_result, key, "left")
    state = (
        F.when(F.col("has").isNull(), "no_id")
        .when(place > F.col("c"), "duplicate_call")
        .when(F.col("level").isNull(), "cycle")
        .when(F.col("r").isNull(), "no_result")
        .otherwise("linked")
    )
    rows = linked.select("conv_id", "turn", "at", F.lit("call").alias("kind"), "call_id", "level", "name", "arguments", "depends_on", state.alias("state"), F.col("r.content").alias("content"))
    late = spread(spread(results, first_call.select(*key, F.lit(True).alias("has")), key, "left"), first_result.select(*key, F.struct("r.turn", "r.at").alias("f")), key, "left")
    state = F.when(F.col("f").isNull(), "no_id").when(place > F.col("f"), "duplicate_result").when(F.col("has").isNull(), "orphan_result")
    rest = late.withColumn("state", state).filter("state is not null").select(
        "conv_id", "turn", "at", F.lit("result").alias("kind"), "call_id", F.lit(None).cast("long").alias("level"), F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("arguments"), F.lit(None).cast("array<string>").alias("depends_on"), "state", "content",
    )
    kind = calls.schema["conv_id"].dataType.simpleString()
    return rows.unionByName(rest).mapInArrow(
        _serialise(schemas), f"conv_id {kind}, turn long, at int, kind string, call_id string, level long, status string, json string"
    )


#: The tool that exchanges of a conversation are calls of.
REPLY_SCHEMA = {
    "reply": {
        "type": "object",
        "properties": {"prompt": {"type": "string"}, "turn": {"type": "integer"}},
        "required": ["prompt", "turn"],
        "additionalProperties": False,
    }
}


def link_conversations(messages: DataFrame, schemas: dict[str, dict] | None = None) -> DataFrame:
    """``link_calls`` on a table of messages (conv_id, turn, role, text).

    Calls are those in tags and, so that plain chats have a structure too, each
    user message with the assistant's answer as its result.
    """
    m = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    calls = exchange_calls(m).unionByName(tagged_calls(m))
    results = exchange_results(m).unionByName(tagged_results(m))
    return link_calls(calls, results, REPLY_SCHEMA | (schemas or {}))
