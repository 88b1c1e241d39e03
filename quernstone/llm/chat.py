"""Chat formatting with linked tool calls.

An assistant's message calls tools if its text is a JSON object with a list
`tool_calls` of objects {id, name, arguments} (and perhaps `content`). A message
of the role `tool` is a result if its text is a JSON object with `tool_call_id`
(and `content`). Calls and results are hash-joined by conversation and
identifier. A call needs another one if {"$result": identifier} stands anywhere
in its arguments. The order is topological: messages by turn, each linked result
behind the message of its call and behind the results that its call needs, else
in the order of calls, wherever it stood before. (anchor, step, turn) is that
order as a key, so that no conversation has to be gathered in one task: the
anchor is the latest turn among the call and all that it needs, the step is
LEVEL times the length of the longest chain of needs, plus the call's place.
Chains are followed in rounds of joins, one for each length. Arguments are checked
against the schemas of the tools, and every message is serialised as canonical
JSON: keys in order of their UTF-16 units, no spaces, numbers as ECMAScript
writes them.

Defined results: of several calls with one identifier in a conversation the
first by turn and place has it, of several results the first by turn and text is
linked, the others have the status `duplicate`; results without a call are
`orphan`, those of calls in a circle of needs, or behind one, are `cyclic` and
stand at their own call; needs that no call has are left aside; calls without
an identifier that is a string are invalid, kept and linked with nothing; results
without identifier, and texts that are no such JSON object (nested deeper than
DEPTH, or with numbers that JSON has not, too), are plain messages; half
surrogates are written as escapes; a null text is empty, null roles and turns stay
null in the message, a null turn is ordered first; repeated rows stay repeated;
an empty table gives an empty result; columns other than those named are not read.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import discard, only, settle, tidied

#: Steps of a level.
LEVEL = 1 << 32
LEAST = -(2**63)
TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
#: The schema keywords that are checked, and those that only describe.
CHECKED = frozenset(
    "type enum const required properties patternProperties additionalProperties minProperties maxProperties items prefixItems minItems maxItems uniqueItems "
    "minimum maximum exclusiveMinimum exclusiveMaximum multipleOf minLength maxLength pattern anyOf allOf oneOf not".split()
)
DESCRIBING = frozenset("title description default examples format deprecated readOnly writeOnly $schema $id $comment".split())


def number(x: int | float | Decimal) -> str:
    """A number as ECMAScript writes it; whole numbers of any size with all their digits."""
    if isinstance(x, float):
        if not x.is_integer():
            digits, _, power = repr(x).partition("e")
            return f"{digits.removesuffix('.0')}e{int(power):+d}" if power and int(power) < -6 else format(Decimal(repr(x)), "f") if power else digits
        x = Decimal(repr(x))
    return (format(x, "f").removeprefix("-0").removesuffix(".0") or "0") if isinstance(x, Decimal) else str(x)


def canonical(value: object) -> str:
    """Canonical JSON, of a value nested to any depth."""
    pieces, left = [], [(value, "")]
    while left:
        held, after = left.pop()
        if isinstance(held, dict):
            pieces.append("{")
            keys = sorted(held, key=lambda k: k.encode("utf-16-be", "surrogatepass"), reverse=True)
            left.append((None, "}" + after))
            for i, key in enumerate(keys):
                left += [(held[key], "," if i else ""), (key, ":")]
            continue
        if isinstance(held, list):
            pieces.append("[")
            left.append((None, "]" + after))
            left += [(x, "," if i else "") for i, x in enumerate(reversed(held))]
            continue
        if held is None and after[:1] in ("}", "]"):
            pieces.append(after)
            continue
        if isinstance(held, bool) or held is None:
            pieces.append({True: "true", False: "false", None: "null"}[held])
        elif isinstance(held, str):
            pieces.append(re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", json.dumps(held, ensure_ascii=False)))
        else:
            pieces.append(number(held))
        pieces.append(after)
    return "".join(pieces)


def is_type(value: object, kind: str) -> bool:
    if kind in ("integer", "number"):
        return not isinstance(value, bool) and (isinstance(value, (int, Decimal)) or isinstance(value, float) and (kind == "number" or value.is_integer()))
    return isinstance(value, TYPES[kind])


def check_schema(schema: object) -> None:
    """Raises ValueError for a schema that uses what valid() does not know, rather than let all values pass."""
    if isinstance(schema, bool):
        return
    if not isinstance(schema, dict) or (unknown := set(schema) - CHECKED - DESCRIBING):
        raise ValueError(f"schema keywords that are not known: {sorted(unknown) if isinstance(schema, dict) else schema!r}")
    kinds = schema.get("type", [])
    for kind in [kinds] if isinstance(kinds, str) else kinds:
        if kind not in TYPES and kind not in ("integer", "number"):
            raise ValueError(f"no type {kind!r}")
    for name in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf"):
        if name in schema and not is_type(schema[name], "number") or name == "multipleOf" and schema.get(name, 1) <= 0:
            raise ValueError(f"{name} is {schema[name]!r}")
    for name in ("minLength", "maxLength", "minItems", "maxItems", "minProperties", "maxProperties"):
        if name in schema and (not is_type(schema[name], "integer") or schema[name] < 0):
            raise ValueError(f"{name} is {schema[name]!r}")
    for name in ("enum", "required", "prefixItems", "anyOf", "allOf", "oneOf"):
        if not isinstance(schema.get(name, []), list):
            raise ValueError(f"{name} is no list")
    for pattern in [*schema.get("patternProperties", {}), *[schema[k] for k in ("pattern",) if k in schema]]:
        try:
            re.compile(pattern)
        except (re.error, TypeError) as error:
            raise ValueError(f"no pattern: {pattern!r}") from error
    for name in ("properties", "patternProperties"):
        for below in schema.get(name, {}).values():
            check_schema(below)
    for name in ("items", "additionalProperties", "not"):
        check_schema(schema.get(name, True))
    for name in ("anyOf", "allOf", "oneOf", "prefixItems"):
        for below in schema.get(name, []):
            check_schema(below)


def exact(x: int | float | Decimal) -> Fraction:
    """The number that a JSON text says."""
    return Fraction(Decimal(repr(x)) if isinstance(x, float) else x)


def valid(value: object, schema: dict | bool) -> bool:
    """Whether a value meets a schema of the keywords in CHECKED."""
    if isinstance(schema, bool):
        return schema
    get = schema.get
    if "type" in schema and not any(is_type(value, kind) for kind in ([schema["type"]] if isinstance(schema["type"], str) else schema["type"])):
        return False
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]) or "const" in schema and canonical(value) != canonical(schema["const"]):
        return False
    if any(not valid(value, s) for s in get("allOf", ())) or "anyOf" in schema and not any(valid(value, s) for s in schema["anyOf"]):
        return False
    if "oneOf" in schema and sum(valid(value, s) for s in schema["oneOf"]) != 1 or "not" in schema and valid(value, schema["not"]):
        return False
    if is_type(value, "number"):
        low, high, step = get("minimum", -math.inf), get("maximum", math.inf), get("multipleOf")
        return low <= value <= high and get("exclusiveMinimum", -math.inf) < value < get("exclusiveMaximum", math.inf) and (step is None or exact(value) % exact(step) == 0)
    if isinstance(value, str):
        return get("minLength", 0) <= len(value) <= get("maxLength", math.inf) and ("pattern" not in schema or re.search(schema["pattern"], value) is not None)
    if isinstance(value, list):
        first = get("prefixItems", [])
        if not get("minItems", 0) <= len(value) <= get("maxItems", math.inf) or get("uniqueItems") and len(set(map(canonical, value))) < len(value):
            return False
        return all(valid(x, s) for x, s in zip(value, first)) and all(valid(x, get("items", True)) for x in value[len(first) :])
    if isinstance(value, dict):
        known, patterns = get("properties", {}), get("patternProperties", {})
        if any(name not in value for name in get("required", ())) or not get("minProperties", 0) <= len(value) <= get("maxProperties", math.inf):
            return False
        for name, own in value.items():
            schemas = [known[name]] if name in known else []
            schemas += [s for p, s in patterns.items() if re.search(p, name)]
            if not all(valid(own, s) for s in schemas or [get("additionalProperties", True)]):
                return False
    return True


def _refuse(text: str) -> float:
    raise ValueError(text)


def _finite(text: str) -> float:
    return x if math.isfinite(x := float(text)) else _refuse(text)


def _whole(text: str) -> int | Decimal:
    return int(text) if len(text) <= 4000 else Decimal(text)


#: What stands between the values of a JSON text.
PLACE = re.compile(r"[ \t\n\r]*")
NUMBER = re.compile(r"(-?(?:0|[1-9][0-9]*))(\.[0-9]+)?([eE][-+]?[0-9]+)?")
WORDS = {"true": True, "false": False, "null": None}


def _deep(text: str) -> object:
    """JSON of any depth, which the library's recursive reader refuses: open lists and objects are kept in a list."""
    at, open_, root = 0, [], []
    held: list | dict = root
    key, wants = None, "value"
    while True:
        at = PLACE.match(text, at).end()
        c = text[at : at + 1]
        if not c:
            break
        if wants in ("value", "value or end") and not (c == "]" and wants == "value or end"):
            if c == '"':
                value, at = json.decoder.scanstring(text, at + 1, True)
            elif c in "[{":
                value, at = ([] if c == "[" else {}), at + 1
            elif (word := text[at : at + 5].rstrip("]}, \t\n\r")) in WORDS or (word := text[at : at + 4]) in WORDS:
                value, at = WORDS[word], at + len(word)
            elif found := NUMBER.match(text, at):
                whole, point, power = found.groups()
                value, at = (_finite(found[0]) if point or power else _whole(whole)), found.end()
            else:
                raise ValueError(text[at : at + 20])
            if isinstance(held, dict):
                held[key] = value
            elif held is root and root:
                raise ValueError("more than one value")
            else:
                held.append(value)
            if c in "[{":
                open_.append(held)
                held, wants = value, "value or end" if c == "[" else "key or end"
            else:
                wants = "comma or end"
        elif c == '"' and wants in ("key", "key or end"):
            key, at = json.decoder.scanstring(text, at + 1, True)
            at = PLACE.match(text, at).end()
            if text[at : at + 1] != ":":
                raise ValueError("no colon")
            at, wants = at + 1, "value"
        elif c == "," and wants == "comma or end" and open_:
            at, wants = at + 1, "key" if isinstance(held, dict) else "value"
        elif open_ and wants in ("comma or end", "key or end", "value or end") and c == ("}" if isinstance(held, dict) else "]"):
            held, at, wants = open_.pop(), at + 1, "comma or end"
        else:
            raise ValueError(text[at : at + 20])
    if open_ or not root:
        raise ValueError("not ended")
    return root[0]


def loads(text: str) -> object:
    """JSON; ValueError for what JSON has not."""
    try:
        return json.loads(text, parse_constant=_refuse, parse_float=_finite, parse_int=_whole)
    except RecursionError:
        return _deep(text)


def _object(text: str) -> dict:
    if text.lstrip()[:1] != "{":
        return {}
    try:
        found = loads(text)
    except ValueError:
        return {}
    return found if isinstance(found, dict) else {}


def needs_of(value: object) -> set[str]:
    """Identifiers in {"$result": identifier} anywhere in a value."""
    found, left = set(), [value]
    while left:
        held = left.pop()
        if isinstance(held, dict):
            if len(held) == 1 and isinstance(held.get("$result"), str):
                found.add(held["$result"])
            left += held.values()
        elif isinstance(held, list):
            left += held
    return found


def clean(text: str) -> str:
    """Without half surrogates, which no column can hold."""
    return text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


def message(role: str | None, text: str, schemas: dict[str, dict]) -> tuple[str, list[dict], int, str | None]:
    """Canonical JSON; its calls (id, step, needs; no id: linked with nothing); the number of invalid ones; the identifier of a result."""
    if role == "assistant" and '"tool_calls"' in text:
        found = _object(text)
        calls = found.get("tool_calls")
        if isinstance(calls, list) and calls and all(isinstance(call, dict) for call in calls):
            made, links, wrong = [], [], 0
            for step, call in enumerate(calls):
                name, arguments, key = call.get("name"), call.get("arguments", {}), call.get("id")
                if isinstance(arguments, str):
                    try:
                        arguments = loads(arguments)
                    except ValueError:
                        pass
                good = isinstance(key, str) and isinstance(name, str) and name in schemas and valid(arguments, schemas[name])
                wrong += not good
                made.append({"arguments": arguments, "id": key, "name": name, "valid": good})
                links.append({"id": clean(key) if isinstance(key, str) else None, "step": step + 1, "needs": sorted(map(clean, needs_of(arguments)))})
            return canonical({"content": found.get("content"), "role": role, "tool_calls": made}), links, wrong, None
    if role == "tool":
        found = _object(text)
        if isinstance(found.get("tool_call_id"), str):
            return canonical({"content": found.get("content"), "role": role, "tool_call_id": found["tool_call_id"]}), [], 0, clean(found["tool_call_id"])
    return canonical({"content": text, "role": role}), [], 0, None


CALL = pa.struct([("id", pa.string()), ("step", pa.int64()), ("needs", pa.list_(pa.string()))])


def _order(calls: DataFrame) -> DataFrame:
    """conv, id, own, anchor, step of each call; anchor is null in a circle and behind one. calls: conv, turn (null: LEAST), call."""
    first = settle(calls.groupBy("conv", F.col("call.id").alias("id")).agg(F.min(F.struct("turn", F.col("call.step").alias("step"), F.col("call.needs").alias("needs"))).alias("first")).select("conv", "id", "first.*"), "calls")
    known = first.select(F.col("conv").alias("c"), F.col("id").alias("need"))
    edges = first.select("conv", "id", F.explode("needs").alias("need")).join(known.withColumnRenamed("need", "n"), F.col("conv").eqNullSafe(F.col("c")) & (F.col("need") == F.col("n"))).select("conv", "id", "need")
    edges = settle(edges, "needs")
    if edges.isEmpty():
        discard(edges)
        return first.select("conv", "id", F.col("turn").alias("own"), F.col("turn").alias("anchor"), "step")
    counts = settle(edges.groupBy(F.col("conv").alias("c"), F.col("id").alias("i")).agg(F.count(F.lit(1)).alias("n")), "counts")
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("id") == F.col("i"))
    done = [settle(first.join(counts, same, "left_anti").select("conv", "id", F.col("turn").alias("anchor"), F.lit(0).cast("long").alias("level")), "ordered")]
    while True:  # a round for each length of chain
        before = done[0]
        for more in done[1:]:
            before = before.unionByName(more)
        met = edges.join(before.select(F.col("conv").alias("c3"), F.col("id").alias("i3"), "anchor", "level"), F.col("conv").eqNullSafe(F.col("c3")) & (F.col("need") == F.col("i3")))
        met = met.groupBy(F.col("conv").alias("c"), F.col("id").alias("i")).agg(F.count(F.lit(1)).alias("m"), F.max("anchor").alias("latest"), F.max("level").alias("level")).where(F.col("level") == len(done) - 1)
        full = met.join(counts.withColumnsRenamed({"c": "c4", "i": "i4"}), F.col("c").eqNullSafe(F.col("c4")) & (F.col("i") == F.col("i4")) & (F.col("m") == F.col("n"))).select("c", "i", "latest", "level")
        new = settle(first.join(full, same).select("conv", "id", F.greatest("turn", "latest").alias("anchor"), (F.col("level") + 1).alias("level")), "ordered")
        if new.isEmpty():
            break
        done.append(new)
    placed = before.select(F.col("conv").alias("c"), F.col("id").alias("i"), "anchor", "level")
    return first.join(placed, same, "left").select("conv", "id", F.col("turn").alias("own"), "anchor", (F.col("step") + F.coalesce("level", F.lit(0)) * LEVEL).alias("step"))


def format_chats(frame: DataFrame, schemas: dict[str, dict] | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row for each message: conversation, turn, role, anchor and step (its place), status, n_calls, n_invalid, message."""
    schemas, frame = schemas or {}, only(frame, conv_col, turn_col, role_col, text_col)
    for schema in schemas.values():
        check_schema(schema)
    source = frame.select(
        frame[f"`{conv_col}`"].alias("conv"), frame[f"`{turn_col}`"].cast("long").alias("turn"), frame[f"`{role_col}`"].cast("string").alias("role"), F.coalesce(frame[f"`{text_col}`"].cast("string"), F.lit("")).alias("text")
    )
    conv = frame.schema[conv_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [message(r, t, schemas) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            arrays = [batch.column("conv"), batch.column("turn"), batch.column("role"), pa.array([x[0] for x in made], pa.string()), pa.array([len(x[1]) for x in made], pa.int32()), pa.array([x[2] for x in made], pa.int32())]
            arrays += [pa.array([x[1] for x in made], pa.list_(CALL)), pa.array([x[3] for x in made], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["conv", "turn", "role", "message", "n_calls", "n_invalid", "calls", "result"])

    schema = f"conv {conv}, turn long, role string, message string, n_calls int, n_invalid int, calls array<struct<id:string,step:long,needs:array<string>>>, result string"
    is_tool = F.col("role").eqNullSafe("tool")
    others, tools = source.where(~is_tool).mapInArrow(tidied(run), schema), source.where(is_tool).mapInArrow(tidied(run), schema)
    # only texts that may call tools are read for their identifiers
    turn = F.coalesce("turn", F.lit(LEAST))
    calls = source.where((F.col("role") == "assistant") & F.col("text").contains('"tool_calls"')).mapInArrow(tidied(run), schema).select("conv", turn.alias("turn"), F.explode("calls").alias("call")).where("call.id IS NOT NULL")
    results, plain = tools.where("result IS NOT NULL"), others.unionByName(tools.where("result IS NULL"))
    # one row for each identifier: its call, and the first of its results; then results are joined once, by a key that Spark splits where it is hot
    first = results.groupBy("conv", "result").agg(F.min(F.struct(turn.alias("at"), F.col("message").alias("message"))).alias("first"))
    keys = first.join(_order(calls).withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c")) & (F.col("result") == F.col("id")), "left").select(F.col("conv").alias("c"), F.col("result").alias("r"), "first", "id", "own", "anchor", "step")
    linked = results.join(keys, F.col("conv").eqNullSafe(F.col("c")) & (F.col("result") == F.col("r")))
    is_first = (F.col("first.at") == turn) & (F.col("first.message") == F.col("message"))
    status = F.when(F.col("id").isNull(), "orphan").when(~is_first, "duplicate").when(F.col("anchor").isNull(), "cyclic").otherwise("result")
    place = F.nullif(F.coalesce("anchor", "own"), F.lit(LEAST))
    placed = F.col("status").isin("result", "cyclic")
    out = linked.withColumn("status", status).withColumn("anchor", F.when(placed, place).otherwise(F.col("turn"))).withColumn("step", F.when(placed, F.col("step")).otherwise(F.lit(0).cast("long")))
    plain = plain.withColumn("status", F.when(F.col("n_calls") > 0, "call").otherwise("message")).withColumn("anchor", F.col("turn")).withColumn("step", F.lit(0).cast("long"))
    names = ["conv", "turn", "role", "anchor", "step", "status", "n_calls", "n_invalid", "message"]
    return plain.select(names).unionByName(out.select(names)).withColumnsRenamed({"conv": conv_col, "turn": turn_col, "role": role_col})


def planted(frame: DataFrame) -> DataFrame:
    """Conversations in which assistants call a tool, for tables whose conversations call none; every turn is used.

    An assistant's message of turn t calls `search` as call-t with its text as the query;
    where (conv_id + t) mod 4 is below 2 it needs call-(t + 2), where (conv_id + t) mod 3 is
    0 its limit is a text, which the schema refuses. The result comes three turns later; where
    t mod 5 is 1 it names no call, and where (conv_id + t) mod 3 is 1 it comes again a turn
    after that.
    """
    both, turn = F.col("conv_id") + F.col("turn"), F.col("turn")
    name, after = F.concat(F.lit("call-"), turn), F.when(both % 4 < 2, F.struct(F.concat(F.lit("call-"), turn + 2).alias("$result")))
    written = lambda limit: F.to_json(F.struct(F.col("text").alias("query"), limit.alias("limit"), after.alias("after")))
    limit = F.length("text") % 30
    arguments = F.when(both % 3 == 0, written(limit.cast("string"))).otherwise(written(limit))
    call = F.to_json(F.struct(F.array(F.struct(name.alias("id"), F.lit("search").alias("name"), arguments.alias("arguments"))).alias("tool_calls")))
    rows = frame.select("conv_id", "turn", "role", F.when(F.col("role") == "assistant", call).otherwise(F.col("text")).alias("text"))
    late = F.explode(F.when(both % 3 == 1, F.array(F.lit(3), F.lit(4))).otherwise(F.array(F.lit(3)))).alias("late")
    results = frame.where("role = 'assistant'").select("conv_id", "turn", F.length("text").alias("size"), late)
    named = F.concat(F.when(turn % 5 == 1, "lost-").otherwise("call-"), turn)
    text = F.to_json(F.struct(named.alias("tool_call_id"), (F.col("size") + F.col("late")).cast("string").alias("content")))
    return rows.union(results.select("conv_id", turn + F.col("late"), F.lit("tool"), text))


SQL = f"""
    WITH a AS (SELECT * FROM conversations WHERE role = 'assistant'),
    c AS (SELECT a.*, (a.conv_id + a.turn) % 4 < 2 AS needs, n.turn AS needed FROM a LEFT JOIN a n ON n.conv_id = a.conv_id AND n.turn = a.turn + 2),
    r AS (SELECT c.*, unnest(CASE WHEN (conv_id + turn) % 3 = 1 THEN [3, 4] ELSE [3] END) AS late FROM c)
    SELECT conv_id, turn, role, turn AS anchor, CAST(0 AS BIGINT) AS step, 'message' AS status, 0 AS n_calls, 0 AS n_invalid, '{{"content":' || to_json(text) || ',"role":' || to_json(role) || '}}' AS message FROM conversations WHERE role <> 'assistant'
    UNION ALL SELECT conv_id, turn, role, turn, 0, 'call', 1, CASE WHEN (conv_id + turn) % 3 = 0 THEN 1 ELSE 0 END,
        '{{"content":null,"role":"assistant","tool_calls":[{{"arguments":{{' || CASE WHEN needs THEN '"after":{{"$result":"call-' || (turn + 2) || '"}},' ELSE '' END || '"limit":' ||
        CASE WHEN (conv_id + turn) % 3 = 0 THEN '"' || (length(text) % 30) || '"' ELSE CAST(length(text) % 30 AS VARCHAR) END || ',"query":' || to_json(text) || '}},"id":"call-' || turn || '","name":"search","valid":' ||
        CASE WHEN (conv_id + turn) % 3 = 0 THEN 'false' ELSE 'true' END || '}}]}}' FROM c
    UNION ALL SELECT conv_id, turn + late, 'tool', CASE WHEN turn % 5 = 1 OR late = 4 THEN turn + late WHEN needs AND needed IS NOT NULL THEN needed ELSE turn END,
        CASE WHEN turn % 5 = 1 OR late = 4 THEN 0 WHEN needs AND needed IS NOT NULL THEN {LEVEL} + 1 ELSE 1 END, CASE WHEN turn % 5 = 1 THEN 'orphan' WHEN late = 4 THEN 'duplicate' ELSE 'result' END, 0, 0,
        '{{"content":"' || (length(text) + late) || '","role":"tool","tool_call_id":"' || CASE WHEN turn % 5 = 1 THEN 'lost-' ELSE 'call-' END || turn || '"}}' FROM r"""


def assemble(formatted: DataFrame, size: int = 64, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """JSON lines of each conversation, in parts of `size` turns: part numbers in order, so that no long conversation is gathered."""
    part = F.floor(F.coalesce("anchor", F.lit(-1)) / size).alias("part")
    entry = F.struct("anchor", "step", F.col(turn_col).alias("turn"), "message")
    lines = F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["message"])
    return formatted.groupBy(conv_col, part).agg(F.count(F.lit(1)).alias("messages"), F.array_join(lines, "\n").alias("lines"))
