"""Chat formatting: tool-call linking (operator 8).

Calls and results are hash-joined by (conversation, call id); calls are put into topological order of the
calls whose results they need; arguments are validated against the tool's schema; every call with its result
becomes one line of canonical JSON (keys in code-point order, no spaces, integral numbers without a fraction).

Order: within a conversation, calls are ordered by (step, turn, call_id). Where every need points to an earlier
turn, turn order is topological already and step is the turn; that test is a join, so a conversation of any
length takes no single task. In conversations with a need that points forward, step is the length of the longest chain of
needs below the call. Calls with one need are hung on the call that their chain ends at by pointer jumping, in rounds that
grow with the logarithm of the chain; what remains, calls with several needs, is sorted by Kahn's algorithm in one task per
conversation, or, for more than ``GROUP_CALLS`` of them, level by level. Calls on or behind a cycle have a null step.

Skew: repeated calls and results of one id are combined before the shuffle, and joins are keyed by conversation
and call, so neither a giant conversation nor one that is copied many times meets in one task.

Defined results: of repeated calls or results of one id the first counts (least turn, then text), and
``copies`` counts the calls; results without a call are reported with status orphan; needs that name no call are listed as
missing; a null conversation id is a conversation of its own, a null turn comes before all others; null or
malformed arguments (not JSON, infinite numbers, nested deeper than ``DEEPEST``) are invalid and serialised as the string
they are; halves of surrogate pairs stay escaped; messages of other roles are rows with status message; calls with a null id can't be linked and
are reported as unanswered, one row for each distinct call; empty tables give an empty result. Extra
columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from math import isfinite

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_key, stored

GROUP_CALLS = 50_000
Schema = dict
_KEY = ["conv", "call_id"]


DEEPEST = 200
_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
_KEYWORDS = {"type", "enum", "required", "properties", "additionalProperties", "items", "minimum", "maximum", "minLength", "maxLength",
             "title", "description", "default"}


def checked(schema: Schema, at: str = "$") -> None:
    """Refuse a schema with a keyword that ``errors_of`` would ignore."""
    unknown = set(schema) - _KEYWORDS
    kinds = schema.get("type", [])
    bad = [k for k in ([kinds] if isinstance(kinds, str) else kinds) if k not in (*_TYPES, "integer", "number")]
    if unknown or bad or schema.get("additionalProperties", True) not in (True, False):
        raise ValueError(f"{at}: unsupported {sorted(unknown) or bad or 'additionalProperties'}")
    for k, v in schema.get("properties", {}).items():
        checked(v, f"{at}.{k}")
    if "items" in schema:
        checked(schema["items"], f"{at}[]")


def _is_number(value: object) -> bool:
    return isinstance(value, int | float) and not isinstance(value, bool)


def _of_type(value: object, kind: str) -> bool:
    if kind == "integer":
        return _is_number(value) and (isinstance(value, int) or value.is_integer())
    return _is_number(value) if kind == "number" else isinstance(value, _TYPES[kind])


def _same(a: object, b: object) -> bool:
    """Equal as JSON: 1 and 1.0 are, true and 1 are not."""
    if _is_number(a) and _is_number(b):
        return a == b
    if type(a) is not type(b):
        return False
    if isinstance(a, dict):
        return a.keys() == b.keys() and all(_same(v, b[k]) for k, v in a.items())
    return len(a) == len(b) and all(map(_same, a, b)) if isinstance(a, list) else a == b


def errors_of(value: object, schema: Schema, at: str = "$") -> list[str]:
    """What a value violates of a JSON schema (type or a list of types, enum, required, properties,
    additionalProperties, items, minimum, maximum, minLength, maxLength)."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else list(kinds)
    if kinds and not any(_of_type(value, k) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    found = [f"{at}: not in enum"] if "enum" in schema and not any(_same(value, x) for x in schema["enum"]) else []
    for name, size in (("Length", len(value) if isinstance(value, str) else None), ("imum", value if _is_number(value) else None)):
        if size is not None:
            found += [f"{at}: below min{name}"] if size < schema.get("min" + name, size) else []
            found += [f"{at}: above max{name}"] if size > schema.get("max" + name, size) else []
    if isinstance(value, dict):
        own = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        found += [f"{at}.{k}: unknown" for k in value if k not in own and schema.get("additionalProperties", True) is False]
        for k in own:
            if k in value:
                found += errors_of(value[k], own[k], f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            found += errors_of(x, schema["items"], f"{at}[{i}]")
    return found


def _escaped(text: str) -> str:
    """Halves of surrogate pairs as JSON escapes: no UTF-8 holds them."""
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value: object) -> str:
    def plain(x: object) -> object:
        if isinstance(x, float) and x.is_integer():
            return int(x)
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        return [plain(v) for v in x] if isinstance(x, list) else x

    return _escaped(json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def _bad_number(name: str) -> object:
    raise ValueError(name)


def _finite(text: str) -> float:
    x = float(text)
    return x if isfinite(x) else _bad_number(text)


def parsed(arguments: str) -> object:
    """JSON with finite numbers, nested at most ``DEEPEST`` deep; else ValueError."""
    value = json.loads(arguments, parse_constant=_bad_number, parse_float=_finite)
    layer, depth = [value], 0
    while layer := [x for v in layer if isinstance(v, dict | list) for x in (v.values() if isinstance(v, dict) else v)]:
        depth += 1
        if depth > DEEPEST:
            raise ValueError("nested too deep")
    return value


def line_of(call_id: str | None, name: str | None, arguments: str | None, result: str | None, needs: list[str], schemas: dict[str, Schema]) -> tuple[bool, str, str]:
    """(valid, errors, canonical JSON) of one call."""
    call = {"id": call_id, "name": name, "needs": needs, "result": result}
    try:
        value = parsed(arguments)
        found = errors_of(value, schemas[name]) if name in schemas else ["unknown tool"]
        return not found, _escaped("; ".join(found)), canonical(call | {"arguments": value, "valid": not found})
    except (TypeError, ValueError, ArithmeticError, RecursionError):
        return False, "malformed arguments", canonical(call | {"arguments": arguments, "valid": False})


_LINE = T.StructType([T.StructField("valid", T.BooleanType()), T.StructField("errors", T.StringType()), T.StructField("json", T.StringType())])


def ordered(nodes: dict, needs: dict) -> dict:
    """Kahn's algorithm: nodes (id -> level at least) and needs (id -> [(id, distance)]) to levels, the longest way down.
    Nodes on or behind a cycle are left out."""
    waiting = {i: len(needs.get(i, ())) for i in nodes}
    users: dict = {}
    for i, of in needs.items():
        for x, far in of:
            users.setdefault(x, []).append((i, far))
    least, level = dict(nodes), {}
    ready = [i for i in nodes if not waiting[i]]
    while ready:
        i = ready.pop()
        level[i] = least[i]
        for user, far in users.get(i, ()):
            least[user] = max(least[user], level[i] + far)
            waiting[user] -= 1
            if not waiting[user]:
                ready.append(user)
    return level


def _sorted_group(group: pd.DataFrame) -> pd.DataFrame:
    needs = {i: [(e["need"], e["far"]) for e in of] for i, of in zip(group["call_id"], group["edges"])}
    level = ordered(dict(zip(group["call_id"], group["least"])), needs)
    rows = [(c, i, level[i]) for c, i in zip(group["conv"], group["call_id"]) if i in level]
    return pd.DataFrame(rows, columns=["conv", "call_id", "level"])


def _hung(spark: SparkSession, calls: DataFrame) -> DataFrame:
    """Every call (conv, call_id, n) with the call its chain of single needs ends at (``root``, none on a cycle) and how far
    that is. Each round doubles the distance that is covered."""
    longest = calls.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    single = F.size("known") == 1
    now = calls.select(*_KEY, F.when(single, F.col("known")[0]).otherwise(F.col("call_id")).alias("root"),
                       F.when(single, 1).otherwise(0).cast("long").alias("far"), (~single).alias("ended"))
    now, far = stored(spark, now, "calls-chain"), 1
    while True:
        up = now.select("conv", F.col("call_id").alias("root"), F.col("root").alias("up"), F.col("far").alias("more"),
                        F.col("ended").alias("up_ended"))
        done = now.where("ended")
        moved = now.where("not ended").join(up, ["conv", "root"]).select(
            *_KEY, F.col("up").alias("root"), (F.col("far") + F.col("more")).alias("far"), F.col("up_ended").alias("ended"))
        now = stored(spark, done.unionByName(moved), "calls-chain")
        far *= 2
        if now.where("not ended").isEmpty():
            return now.drop("ended")
        if far > longest:   # no chain is longer: what has not ended runs in a circle
            return now.select(*_KEY, F.when(F.col("ended"), F.col("root")).alias("root"), "far")


def _peeled(spark: SparkSession, left: DataFrame) -> DataFrame:
    """Levels of very many calls with several needs (conv, call_id, least, edges): each round places those whose needs
    are placed, so there are as many rounds as such calls on the longest way."""
    left = stored(spark, left, "calls-left")
    done = left.select(*_KEY, F.col("least").alias("level")).limit(0)
    while True:
        edges = left.select(*_KEY, F.explode("edges").alias("e")).select(*_KEY, "e.need", "e.far")
        placed = done.select("conv", F.col("call_id").alias("need"), "level")
        # A need outside this set can never be placed; one inside waits for its level.
        reach = edges.join(placed, ["conv", "need"], "left").groupBy(*_KEY).agg(
            F.max(F.col("level").isNull().cast("int")).alias("waits"), F.max(F.col("level") + F.col("far")).alias("below"))
        now = left.join(reach, _KEY, "left").where(F.coalesce("waits", F.lit(0)) == 0).select(
            *_KEY, F.greatest("least", F.coalesce("below", F.lit(0))).alias("level"))
        now = stored(spark, now, "calls-placed")
        if now.isEmpty():
            return done
        done = stored(spark, done.unionByName(now), "calls-done")
        left = stored(spark, left.join(now, _KEY, "left_anti"), "calls-left")


def _levels(spark: SparkSession, calls: DataFrame, group_calls: int) -> DataFrame:
    """(conv, call_id, level) of the calls (conv, call_id, known) that are not on or behind a cycle."""
    hung = _hung(spark, calls)
    several = calls.where(F.size("known") > 1)
    top = hung.select("conv", F.col("call_id").alias("need"), "root", "far")
    multi = several.select("conv", F.col("call_id").alias("root"), F.lit(True).alias("several"))
    edges = (several.select(*_KEY, F.explode("known").alias("need")).join(top, ["conv", "need"]).join(multi, ["conv", "root"], "left")
             .select(*_KEY, "root", (F.col("far") + 1).alias("far"), F.coalesce("several", F.lit(False)).alias("several")))
    # Needs that hang on a call without needs count from 0; the others wait for a call with several needs.
    waits = F.col("several") | F.col("root").isNull()
    nodes = edges.groupBy(*_KEY).agg(F.coalesce(F.max(F.when(~waits, F.col("far"))), F.lit(0)).alias("least"),
                                     F.collect_list(F.when(waits, F.struct(F.coalesce("root", F.lit("\x00circle")).alias("need"), "far"))).alias("edges"))
    nodes = stored(spark, nodes, "calls-several")
    sizes = nodes.groupBy("conv").agg(F.count("*").alias("n"))
    nodes = nodes.join(sizes, "conv")
    found = (nodes.where(F.col("n") <= group_calls).drop("n").groupBy("conv")
             .applyInPandas(_sorted_group, "conv long, call_id string, level long"))
    if not sizes.where(F.col("n") > group_calls).isEmpty():
        found = found.unionByName(_peeled(spark, nodes.where(F.col("n") > group_calls).drop("n")))
    base = found.select("conv", F.col("call_id").alias("root"), "level").unionByName(
        calls.where(F.size("known") == 0).select("conv", F.col("call_id").alias("root"), F.lit(0).cast("long").alias("level")))
    return hung.join(base, ["conv", "root"]).select(*_KEY, (F.col("level") + F.col("far")).alias("level"))


def steps(spark: SparkSession, calls: DataFrame, group_calls: int = GROUP_CALLS) -> DataFrame:
    """``calls`` (conv, call_id, turn, needs) plus known, missing (parts of needs) and step."""
    turns = calls.select("conv", F.col("call_id").alias("need"), F.col("turn").alias("need_turn"))
    edges = calls.select(*_KEY, "turn", F.explode(F.array_distinct("needs")).alias("need")).join(turns, ["conv", "need"])
    known = edges.groupBy(*_KEY).agg(F.array_sort(F.collect_list("need")).alias("known"),  # a part of the call's needs
                                     F.max((F.col("need_turn") >= F.col("turn")).cast("int")).alias("forward"))
    calls = calls.join(known, _KEY, "left")
    calls = calls.withColumns({"known": F.coalesce("known", F.array().cast("array<string>")), "forward": F.coalesce("forward", F.lit(0))})
    calls = stored(spark, calls.withColumn("missing", F.array_sort(F.array_except("needs", "known"))), "calls-known")
    odd = stored(spark, calls.where("forward = 1").select("conv").distinct(), "calls-odd")
    if odd.isEmpty():
        return calls.withColumn("step", F.col("turn")).drop("forward")
    levels = _levels(spark, stored(spark, calls.join(odd, "conv").select(*_KEY, "known"), "calls-sorted"), group_calls)
    marked = calls.join(odd.select("conv", F.lit(True).alias("odd")), "conv", "left").join(levels, _KEY, "left")
    return marked.withColumn("step", F.when(F.col("odd"), F.col("level")).otherwise(F.col("turn"))).drop("forward", "odd", "level")


def linked(spark: SparkSession, calls: DataFrame, results: DataFrame, schemas: dict[str, Schema], group_calls: int = GROUP_CALLS,
           messages: DataFrame | None = None) -> DataFrame:
    """calls (conv_id, turn, call_id, name, arguments, needs), results (conv_id, turn, call_id, content) and other messages
    (conv_id, turn, role, content) as one row per call, orphan result or message: conv_id, step, turn, call_id, status, copies,
    missing, valid, errors, json."""
    for name, schema in schemas.items():
        checked(schema, name)
    least = F.lit(-(2**63)).cast("long")
    known_id = F.coalesce("call_id", F.concat(F.lit("\x00"), F.hex(F.xxhash64("turn", "name", "arguments"))))
    c = calls.select(id_key("conv_id").alias("conv"), F.coalesce("turn", least).cast("long").alias("turn"), known_id.alias("call_id"),
                     "name", "arguments", F.array_compact(F.coalesce("needs", F.array().cast("array<string>"))).alias("needs"))
    c = c.groupBy(*_KEY).agg(F.min(F.struct("turn", "name", "arguments", "needs")).alias("c"), F.count("*").alias("copies")).select(*_KEY, "c.*", "copies")
    r = results.select(id_key("conv_id").alias("conv"), F.coalesce("turn", least).cast("long").alias("turn"), "call_id", "content")
    orphans = r.where("call_id is null").select("conv", F.lit(None).cast("string").alias("call_id"), "turn", "content")
    r = (r.where("call_id is not null").groupBy(*_KEY).agg(F.min(F.struct("turn", "content")).alias("r"))
         .select(*_KEY, F.col("r.turn").alias("result_turn"), F.col("r.content").alias("content"), F.lit(True).alias("answered")))
    r = stored(spark, r, "call-results")
    c = stored(spark, steps(spark, c, group_calls), "calls")

    @F.pandas_udf(_LINE)
    def line(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for ids, names, arguments, contents, needs in parts:
            yield pd.DataFrame([line_of(*row, schemas) for row in zip(ids, names, arguments, contents, map(list, needs))],
                               columns=["valid", "errors", "json"])

    real_id = F.when(~F.startswith("call_id", F.lit("\x00")), F.col("call_id"))
    rows = c.join(r, _KEY, "left").withColumn("line", line(real_id, "name", "arguments", "content", "needs")).select(
        "conv", "step", "turn", real_id.alias("call_id"), F.when(F.col("answered"), "answered").otherwise("unanswered").alias("status"),
        "copies", "missing", "line.valid", "line.errors", "line.json")
    alone = r.join(c.select(*_KEY), _KEY, "left_anti").select("conv", "call_id", F.col("result_turn").alias("turn"), "content").unionByName(orphans)

    @F.pandas_udf(T.StringType())
    def orphan(ids: pd.Series, contents: pd.Series) -> pd.Series:
        return pd.Series([canonical({"id": i, "result": x}) for i, x in zip(ids, contents)], dtype=object)

    rows = rows.unionByName(alone.select(
        "conv", F.col("turn").alias("step"), "turn", "call_id", F.lit("orphan").alias("status"), F.lit(0).cast("long").alias("copies"),
        F.array().cast("array<string>").alias("missing"), F.lit(None).cast("boolean").alias("valid"), F.lit(None).cast("string").alias("errors"),
        orphan("call_id", "content").alias("json")))
    if messages is not None:
        @F.pandas_udf(T.StringType())
        def message(roles: pd.Series, contents: pd.Series) -> pd.Series:
            return pd.Series([canonical({"role": r, "content": x}) for r, x in zip(roles, contents)], dtype=object)

        turn = F.coalesce("turn", least).cast("long")
        rows = rows.unionByName(messages.select(
            id_key("conv_id").alias("conv"), turn.alias("step"), turn.alias("turn"), F.lit(None).cast("string").alias("call_id"), F.lit("message").alias("status"),
            F.lit(0).cast("long").alias("copies"), F.array().cast("array<string>").alias("missing"), F.lit(None).cast("boolean").alias("valid"),
            F.lit(None).cast("string").alias("errors"), message("role", "content").alias("json")))
    real = lambda x: F.when(F.col(x) != least, F.col(x)).alias(x)
    return rows.select(F.when(F.col("conv") != least, F.col("conv")).alias("conv_id"), real("step"), real("turn"), "call_id", "status",
                       "copies", "missing", "valid", "errors", "json")


#: Tools that the turns of a plain chat stand for.
CHAT_TOOLS: dict[str, Schema] = {
    "lookup": {"type": "object", "required": ["query"], "additionalProperties": False,
               "properties": {"query": {"type": "string", "minLength": 1}}},
    "search": {"type": "object", "required": ["query", "limit"], "additionalProperties": False,
               "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 40}}},
    "summarise": {"type": "object", "required": ["text", "max_words"], "additionalProperties": False,
                  "properties": {"text": {"type": "string"}, "max_words": {"type": "integer", "minimum": 1}}},
}


def from_chat(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and messages that plain chat turns stand for. A user turn calls a tool chosen by its length, with its text
    as argument; an assistant turn is the result for the turn before; turns of any other role are messages.

    What a call needs follows from the conversation's id. In half of the conversations, the call two turns before. In the other
    half, the plan comes first: a call needs the one two turns after it, and every other call also the one after that, as far
    as there are any (the last ones miss theirs). In one of 16, the calls of turns 0 and 2 (or 1 and 3) need one another.
    """
    turn = F.col("turn").cast("long")
    name_of = lambda t: F.concat(F.lit("call_"), t.cast("string"))
    size, words = F.length("text"), F.size(F.split("text", " "))
    arguments = (F.when(size < 80, F.to_json(F.struct(F.col("text").alias("query"))))
                 .when(size < 250, F.to_json(F.struct(F.col("text").alias("query"), words.alias("limit"))))
                 .otherwise(F.to_json(F.struct("text", F.ceil(words / 4).alias("max_words")))))
    name = F.when(size < 80, "lookup").when(size < 250, "search").otherwise("summarise")
    kind = F.pmod(F.xxhash64("conv_id"), F.lit(16))
    none = F.array().cast("array<string>")
    needs = (F.when((kind == 0) & (turn < 4), F.array(name_of(F.when(turn < 2, turn + 2).otherwise(turn - 2))))
             .when((kind < 8) & (turn % 4 < 2), F.array(name_of(turn + 2), name_of(turn + 4)))
             .when(kind < 8, F.array(name_of(turn + 2)))
             .when(turn >= 2, F.array(name_of(turn - 2))).otherwise(none))
    calls = conversations.where("role = 'user'").select(
        "conv_id", turn.alias("turn"), name_of(turn).alias("call_id"), name.alias("name"), arguments.alias("arguments"),
        F.coalesce(needs, none).alias("needs"))
    results = conversations.where("role = 'assistant'").select(
        "conv_id", turn.alias("turn"), name_of(turn - 1).alias("call_id"), F.col("text").alias("content"))
    messages = conversations.where("role is null or role not in ('user', 'assistant')").select(
        "conv_id", turn.alias("turn"), "role", F.col("text").alias("content"))
    return calls, results, messages
