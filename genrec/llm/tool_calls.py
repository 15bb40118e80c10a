"""Link tool calls with their results, order them, validate their arguments, write canonical JSON.

Calls and results meet by ``(conv_id, call_id)``.  Calls are ordered so that a
call follows everything it depends on: its time is its turn or the latest time
it depends on, with a level that counts the steps since; ties go to the smaller
id.  Arguments are checked against the JSON schema of the called tool.

``status`` of an identifier: the first that holds of ``orphan_result`` (no
call), ``duplicate_id`` (different calls or results share it),
``missing_result``, ``cycle`` (the call depends on itself through others, or
on a call that does), ``unknown_tool``, ``invalid_arguments``, else ``ok``.

Defined cases: rows without ``conv_id`` or identifier link with nothing and are
left out; equal rows count once; a dependency that names no call of the
conversation does not bear on the order; null or malformed arguments, and those with numbers out
of range, halves of surrogate pairs or nesting too deep to check, are invalid and kept as their text; a null result
is ``null``; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genrec.llm.common import SPACES, arrow_batch_rows, materialise
from genrec.operators.rank import group_rank

BATCH_ROWS = 1000
REPLY_TOOL = "reply"
# the tool that a plain exchange calls
REPLY_SCHEMA = {
    "type": "object", "required": ["question", "turn"], "additionalProperties": False,
    "properties": {"question": {"type": "string", "minLength": 1, "pattern": r"[^\s]"},
                   "turn": {"type": "integer", "minimum": 0}},
}


# ---- canonical JSON and schemas

def canonical(value: object) -> str:
    """JSON without white space, keys by UTF-16 code units, whole floats as integers."""
    if isinstance(value, bool) or value is None:
        return json.dumps(value)
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("JSON has no such number")
        return str(int(value)) if value.is_integer() and abs(value) < 1e21 else repr(value)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, str):
        return json.dumps(value, ensure_ascii=False)
    if isinstance(value, dict):
        keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in keys) + "}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(canonical, value)) + "]"
    raise TypeError(f"not a JSON value: {type(value).__name__}")


def _is(value: object, kind: str) -> bool:
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    return {"object": isinstance(value, dict), "array": isinstance(value, list), "string": isinstance(value, str),
            "number": number, "integer": number and (isinstance(value, int) or value.is_integer()), "boolean": isinstance(value, bool),
            "null": value is None}.get(kind, False)


def valid(value: object, schema: dict | bool) -> bool:
    """Whether ``value`` fits a JSON schema (types, enum, const, bounds, lengths,
    pattern, properties, items, anyOf, allOf, oneOf, not)."""
    if isinstance(schema, bool):
        return schema
    kinds = schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return False
    if "enum" in schema and canonical(value) not in {canonical(x) for x in schema["enum"]}:
        return False
    if "const" in schema and canonical(value) != canonical(schema["const"]):
        return False
    if not all(valid(value, s) for s in schema.get("allOf", ())):
        return False
    if "anyOf" in schema and not any(valid(value, s) for s in schema["anyOf"]):
        return False
    if "oneOf" in schema and sum(valid(value, s) for s in schema["oneOf"]) != 1:
        return False
    if "not" in schema and valid(value, schema["not"]):
        return False
    if _is(value, "number"):
        return (value >= schema.get("minimum", value) and value <= schema.get("maximum", value)
                and ("exclusiveMinimum" not in schema or value > schema["exclusiveMinimum"])
                and ("exclusiveMaximum" not in schema or value < schema["exclusiveMaximum"]))
    if isinstance(value, str):
        return (schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value))
                and ("pattern" not in schema or re.search(schema["pattern"], value) is not None))
    if isinstance(value, list):
        return (schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value))
                and all(valid(x, schema.get("items", True)) for x in value))
    if isinstance(value, dict):
        known = schema.get("properties", {})
        return (all(k in value for k in schema.get("required", ()))
                and all(valid(x, known[k] if k in known else schema.get("additionalProperties", True)) for k, x in value.items()))
    return True


def _parsed(text: str | None) -> tuple[object, bool]:
    def once(pairs: list[tuple[str, object]]) -> dict:
        if len({k for k, _ in pairs}) < len(pairs):
            raise ValueError("a key is repeated")
        return dict(pairs)

    def no_constant(name: str) -> object:
        raise ValueError(name)

    try:
        value = json.loads(text or "", object_pairs_hook=once, parse_constant=no_constant)
        # numbers out of range, halves of surrogate pairs and nesting beyond the stack have no canonical text
        canonical(value).encode()
        return value, True
    except (ValueError, RecursionError):
        return None, False


def _fits(value: object, schema: dict) -> bool:
    try:
        return valid(value, schema)
    except RecursionError:
        return False


# ---- calls and results of a conversation table

def exchanges(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(calls, results)`` of plain conversations: a user's turn calls ``reply``
    with its text, the assistant's next turn is the result, and a call depends
    on the one two turns before it."""
    def name(turn: Column) -> Column:
        return F.concat(F.lit("call-"), turn.cast("string"))

    turn = F.col("turn").cast("long")
    calls = conversations.where("role = 'user'").select(
        "conv_id", turn.alias("turn"), name(turn).alias("call_id"), F.lit(REPLY_TOOL).alias("name"),
        F.to_json(F.struct(F.col("text").alias("question"), turn.alias("turn"))).alias("arguments"),
        F.when(turn >= 2, F.array(name(turn - 2))).alias("depends_on"))
    results = conversations.where("role = 'assistant'").select(
        "conv_id", turn.alias("turn"), name(turn - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


_CALL = "struct<id:string,name:string,arguments:string,depends_on:array<string>>"


def embedded(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(calls, results)`` that messages hold as JSON objects: ``{"tool_calls": [{"id", "name",
    "arguments", "depends_on"}]}`` and ``{"tool_call_id", "content"}``.  Arguments that are
    objects are kept as their JSON text."""
    looks = conversations.where(F.startswith(F.btrim("text", F.lit(SPACES)), F.lit("{")))
    read = looks.withColumn("m", F.from_json(
        "text", f"struct<tool_calls:array<{_CALL}>,tool_call_id:string,content:string>"))
    turn = F.col("turn").cast("long").alias("turn")
    calls = read.select("conv_id", turn, F.explode("m.tool_calls").alias("c")).select(
        "conv_id", "turn", F.col("c.id").alias("call_id"), "c.name", "c.arguments", "c.depends_on")
    results = read.where("m.tool_call_id is not null").select(
        "conv_id", turn, F.col("m.tool_call_id").alias("call_id"), F.col("m.content").alias("content"))
    return calls, results


# ---- linking

def _settled(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``conv_id, call_id, time, level, cyclic`` of conversations with backward dependencies.

    Times that still move after as many rounds as a conversation has calls
    belong to a circle or wait for one; as many rounds more reach all of those.
    """
    most = nodes.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    at = F.struct("time", "level")
    now = materialise(nodes.withColumn("cyclic", F.lit(False)), "call-times")
    for turn in range(2 * most):
        pushed = edges.select("conv_id", "call_id", "on").join(
            now.select("conv_id", F.col("call_id").alias("on"), at.alias("from"), F.col("cyclic").alias("from_cyclic")),
            ["conv_id", "on"]).groupBy("conv_id", "call_id").agg(
            F.max("from").alias("from"), F.bool_or("from_cyclic").alias("from_cyclic"))
        joined = now.join(pushed, ["conv_id", "call_id"], "left").withColumn(
            "moved", F.coalesce(F.col("from") >= at, F.lit(False)))
        now = materialise(joined.select(
            "conv_id", "call_id", F.when(F.col("moved"), F.col("from.time")).otherwise(F.col("time")).alias("time"),
            F.when(F.col("moved"), F.col("from.level") + 1).otherwise(F.col("level")).alias("level"),
            (F.col("cyclic") | F.coalesce("from_cyclic", F.lit(False)) | (F.col("moved") & F.lit(turn >= most))).alias("cyclic"),
            "moved"), "call-times")
        if now.where("moved").isEmpty():
            break
    return now.drop("moved")


def _ordered(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, position, cyclic``.  Where every dependency points to an earlier
    turn, the turns are the order; other conversations take rounds of joins."""
    nodes = calls.select("conv_id", "call_id", F.col("turn").alias("time"), F.lit(0).cast("long").alias("level"))
    edges = materialise(calls.select("conv_id", "call_id", "turn", F.explode("depends_on").alias("on")).distinct().join(
        calls.select("conv_id", F.col("call_id").alias("on"), F.col("turn").alias("on_turn")), ["conv_id", "on"]), "call-edges")
    late = edges.where("on_turn >= turn").select("conv_id").distinct()
    keyed = nodes.withColumn("cyclic", F.lit(False))
    if not late.isEmpty():
        late = materialise(late, "call-late")
        moved = _settled(nodes.join(late, "conv_id", "left_semi"), edges.join(late, "conv_id", "left_semi"))
        keyed = keyed.join(late, "conv_id", "left_anti").unionByName(moved)
    return group_rank(keyed, ["conv_id"], [F.col("time"), F.col("level"), F.col("call_id")], "position").drop("time", "level")


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``conv_id, call_id, position, name, status, json`` for every identifier; ``position``
    (from 1) orders the calls of a conversation, and is null for orphan results.

    ``schemas``: the schema of each tool.  Runs the linking job, a check of the
    dependencies' directions and the numbering job.
    """
    arrow_batch_rows(calls.sparkSession, BATCH_ROWS)
    call = F.struct("turn", "name", "arguments", F.array_sort(F.array_distinct(F.coalesce(
        "depends_on", F.array().cast("array<string>")))).alias("depends_on"))
    ours = calls.where("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id").agg(
        F.min(call).alias("c"), (F.min(call) < F.max(call)).alias("many"))
    theirs = results.where("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "content")).alias("r"),
        (F.min(F.struct("turn", "content")) < F.max(F.struct("turn", "content"))).alias("many_results"))
    linked = materialise(ours.join(theirs, ["conv_id", "call_id"], "full"), "call-links")
    order = _ordered(linked.where("c is not null").select("conv_id", "call_id", "c.turn", "c.depends_on"))
    placed = linked.join(order, ["conv_id", "call_id"], "left")
    early = F.when(F.col("c").isNull(), "orphan_result").when(
        F.coalesce(F.col("many"), F.lit(False)) | F.coalesce(F.col("many_results"), F.lit(False)), "duplicate_id").when(
        F.col("r").isNull(), "missing_result").when(F.col("cyclic"), "cycle")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            status, texts = [], []
            for r in b.itertuples(index=False):
                arguments, fine = _parsed(r.arguments)
                own = r.status
                if not own:
                    own = "unknown_tool" if r.name not in schemas else (
                        "ok" if fine and _fits(arguments, schemas[r.name]) else "invalid_arguments")
                status.append(own)
                texts.append(canonical({
                    "id": r.call_id, "name": r.name, "arguments": arguments if fine else r.arguments,
                    "depends_on": [] if r.depends_on is None else list(r.depends_on), "result": r.content, "status": own}))
            yield pd.DataFrame({"conv_id": b["conv_id"], "call_id": b["call_id"], "position": b["position"].astype("Int64"),
                                "name": b["name"], "status": status, "json": texts})

    rows = placed.select(F.col("conv_id").cast("long").alias("conv_id"), "call_id", F.col("position").cast("long").alias("position"),
                         F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"),
                         F.col("c.depends_on").alias("depends_on"), F.col("r.content").alias("content"), early.alias("status"))
    return rows.mapInPandas(write, "conv_id long, call_id string, position long, name string, status string, json string")


def link_conversations(conversations: DataFrame, schemas: dict[str, dict] | None = None) -> DataFrame:
    """``link`` over the plain exchanges and the embedded calls of ``conversations``."""
    calls, results = exchanges(conversations)
    more_calls, more_results = embedded(conversations)
    return link(calls.unionByName(more_calls), results.unionByName(more_results),
                {REPLY_TOOL: REPLY_SCHEMA} | (schemas or {}))
