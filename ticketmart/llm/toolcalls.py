"""Tool calls linked with their results, ordered, validated and written as canonical JSON.

Calls and results meet in one join on (conversation, call id). Each side is brought to
one row per id first, so that an id that occurs very often costs no more than others; rows
of the id that differ from that one come out by themselves, so no content is lost.
Calls may refer to other calls; a call's level is one more than the highest level among
those it refers to. Sorting by (level, turn, position) is a topological order. Levels
are found round by round for all conversations together, so that no conversation, however
long, is ever gathered in one task.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField

from ticketmart.llm.common import annotate, stored

ID = ["conv_id", "call_id"]


def canonical_json(value: object) -> str:
    """Sorted names, no blanks, characters as they are, and one form for each number.

    A lone surrogate has no UTF-8 form; it raises a ValueError.
    """
    text = json.dumps(_one_form(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    text.encode()
    return text


def _one_form(value: object) -> object:
    """1.0 and 1e0 as 1, -0.0 as 0; a float that has no exact whole number stays as it is."""
    if isinstance(value, float) and value.is_integer() and abs(value) < 1 << 53:
        return int(value)
    if isinstance(value, list):
        return [_one_form(item) for item in value]
    if isinstance(value, dict):
        return {name: _one_form(item) for name, item in value.items()}
    return value


def _no_repeats(pairs: list[tuple[str, object]]) -> dict:
    found = dict(pairs)
    if len(found) < len(pairs):
        raise ValueError("a name occurs twice")
    return found


def parsed(text: str) -> object:
    """Strict JSON: no repeated names, no NaN or infinity."""

    def refuse(constant: str) -> None:
        raise ValueError(f"{constant} is no JSON")

    return json.loads(text, object_pairs_hook=_no_repeats, parse_constant=refuse)


_TYPES = {
    "object": dict,
    "array": list,
    "string": str,
    "boolean": bool,
    "null": type(None),
}


def _is(value: object, kind: str) -> bool:
    if kind in ("integer", "number"):
        whole = isinstance(value, int) or isinstance(value, float) and value.is_integer()
        return not isinstance(value, bool) and (whole if kind == "integer" else isinstance(value, int | float))
    return isinstance(value, _TYPES[kind])


_KEYWORDS = {"type", "enum", "minimum", "maximum", "properties", "required", "additionalProperties", "items"}


def check_schema(schema: dict, at: str = "$") -> None:
    """Refuse a schema that says what `violations` would not look at."""
    unknown = sorted(set(schema) - _KEYWORDS)
    if unknown:
        raise ValueError(f"schema at {at} has unknown keywords {unknown}")
    kinds = schema.get("type", [])
    for kind in [kinds] if isinstance(kinds, str) else kinds:
        if kind not in {*_TYPES, "integer", "number"}:
            raise ValueError(f"schema at {at} has an unknown type {kind!r}")
    if not isinstance(schema.get("additionalProperties", False), bool):
        raise ValueError(f"schema at {at}: additionalProperties is true or false here")
    for name, inner in schema.get("properties", {}).items():
        check_schema(inner, f"{at}.{name}")
    if "items" in schema:
        check_schema(schema["items"], f"{at}[]")


def _same(one: object, two: object) -> bool:
    """Equality of JSON: true is not 1, but 1.0 is."""
    return canonical_json(one) == canonical_json(two)


def violations(value: object, schema: dict, at: str = "$") -> list[str]:
    """What speaks against a value, in the order of the schema; empty if it is valid.

    Knows type, enum, minimum, maximum, properties, required, additionalProperties, items.
    """
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, kind) for kind in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    found = []
    if "enum" in schema and not any(_same(value, allowed) for allowed in schema["enum"]):
        found.append(f"{at}: not one of the allowed values")
    if isinstance(value, int | float) and not isinstance(value, bool):
        if "minimum" in schema and value < schema["minimum"]:
            found.append(f"{at}: below {schema['minimum']}")
        if "maximum" in schema and value > schema["maximum"]:
            found.append(f"{at}: above {schema['maximum']}")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{name}: missing" for name in schema.get("required", []) if name not in value]
        for name, inner in known.items():
            if name in value:
                found += violations(value[name], inner, f"{at}.{name}")
        if schema.get("additionalProperties") is False:
            found += [f"{at}.{name}: unknown" for name in sorted(value) if name not in known]
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += violations(item, schema["items"], f"{at}[{i}]")
    return found


def levels(calls: DataFrame, references: DataFrame) -> DataFrame:
    """Level of each call that refers to another (conv_id, call_id, level).

    References to ids that are no calls, or to the call itself, are not counted here.
    Calls in a circle, and calls that depend on one, get a null level. There is a round
    for each level; a round reads only what is still open.
    """
    known = calls.select(*ID)
    edges = references.join(known.withColumnRenamed("call_id", "needs"), ["conv_id", "needs"], "left_semi").where(
        F.col("needs") != F.col("call_id")
    )
    waiting = stored(edges.select(*ID, "needs").distinct(), "waiting")
    done, level = None, 0
    while True:
        level += 1
        open_calls = stored(waiting.select(*ID).distinct(), "open")
        blocked = waiting.join(open_calls.withColumnRenamed("call_id", "needs"), ["conv_id", "needs"], "left_semi")
        blocked = stored(blocked.select(*ID, "needs"), "blocked")
        ready = stored(open_calls.join(blocked, ID, "left_anti").withColumn("level", F.lit(level)), "ready")
        if ready.isEmpty():
            stuck = open_calls.withColumn("level", F.lit(None).cast("int"))
            return stuck if done is None else done.unionByName(stuck)
        done = ready if done is None else done.unionByName(ready)
        waiting = blocked


def linked(calls: DataFrame, results: DataFrame, references: DataFrame, tools: dict[str, dict]) -> DataFrame:
    """One row for each call id, one for each result id without a call, and further rows.

    `calls`: conv_id, call_id, turn, position, name, arguments (JSON text). `results`:
    conv_id, call_id, turn, content. `references`: conv_id, call_id, needs. `tools`: a
    schema of the arguments for each name. Other columns are not used.

    Of calls with one id the first by (turn, position, name, arguments) is linked, of results
    the first by (turn, content); `n_calls` and `n_results` tell how many there were. Calls
    and results of the id that differ from these have rows of their own, without the other
    side and without a level; equal ones are one row.
    Rows whose conversation or id is null can't be linked; they come out, one row each,
    as `unlinked`. `errors` lists what is wrong: unknown tool, arguments that are no JSON
    or don't fit the schema, references to unknown calls, circles. Arguments with a lone
    surrogate count as no JSON. A schema with a keyword or a type that is not known here is
    refused. `status` is the first that fits of unlinked, orphan (no call), duplicate,
    circular, invalid, pending (no result), ok. `json` is null for arguments that are no JSON.
    """
    for schema in tools.values():
        check_schema(schema)
    has_id = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    call = F.struct("turn", "position", "name", "arguments")
    first_calls = stored(
        calls.where(has_id).groupBy(*ID).agg(F.min(call).alias("call"), F.count("*").alias("n_calls")), "calls"
    )
    first_results = stored(
        results.where(has_id).groupBy(*ID).agg(F.min(F.struct("turn", "content")).alias("result"), F.count("*").alias("n_results")),
        "results",
    )
    asked = references.where(has_id & F.col("needs").isNotNull()).select(*ID, "needs").distinct()
    asked = stored(asked.join(first_calls.select(*ID), ID, "left_semi"), "asked")
    known = first_calls.select("conv_id", F.col("call_id").alias("needs"), F.lit(True).alias("known"))
    unknown = (
        asked.join(known, ["conv_id", "needs"], "left")
        .where(F.col("known").isNull() | (F.col("needs") == F.col("call_id")))
        .groupBy(*ID)
        .agg(F.count("*").alias("n_unknown"), F.min("needs").alias("unknown"))
    )
    level = levels(first_calls, asked).withColumn("listed", F.lit(True))
    met = first_calls.join(first_results, ID, "full").join(level, ID, "left").join(unknown, ID, "left")
    shaped = met.select(
        *ID,
        F.coalesce("call.turn", "result.turn").alias("turn"),
        F.col("call.position").alias("position"),
        F.col("call.name").alias("name"),
        F.col("call.arguments").alias("arguments"),
        F.col("call").isNotNull().alias("called"),
        F.col("result.turn").alias("result_turn"),
        F.col("result.content").alias("content"),
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.when(F.col("listed"), F.col("level")).when(F.col("call").isNotNull(), F.lit(0)).alias("level"),
        (F.coalesce("listed", F.lit(False)) & F.col("level").isNull()).alias("circular"),
        F.coalesce("n_unknown", F.lit(0)).alias("n_unknown"),
        F.col("unknown"),
    )
    lone_calls = calls.where(~has_id).select(
        *ID, "turn", "position", "name", "arguments", F.lit(True).alias("called"), F.lit(1).cast("long").alias("n_calls")
    )
    lone_results = results.where(~has_id).select(
        *ID, "turn", F.col("turn").alias("result_turn"), "content", F.lit(False).alias("called"), F.lit(1).cast("long").alias("n_results")
    )
    counts = [F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results")]
    both = first_calls.join(first_results, ID, "full")
    # Only ids that occur more than once are looked through again.
    again = calls.where(has_id).join(both.where("n_calls > 1").select(*ID, "call", "n_calls", "n_results"), ID)
    further_calls = again.where(~F.struct("turn", "position", "name", "arguments").eqNullSafe(F.col("call"))).select(
        *ID, "turn", "position", "name", "arguments", F.lit(True).alias("called"), F.lit(True).alias("further"), *counts
    )
    again = results.where(has_id).join(both.where("n_results > 1").select(*ID, "result", "n_calls", "n_results"), ID)
    further_results = again.where(~F.struct("turn", "content").eqNullSafe(F.col("result"))).select(
        *ID, "turn", F.col("turn").alias("result_turn"), "content", F.lit(False).alias("called"), F.lit(True).alias("further"), *counts
    )
    further = further_calls.distinct().unionByName(further_results.distinct(), allowMissingColumns=True)
    whole = further.unionByName(shaped, allowMissingColumns=True).unionByName(lone_calls, allowMissingColumns=True).unionByName(lone_results, allowMissingColumns=True)

    def start():
        def compute(batch: pa.RecordBatch) -> list:
            problems, written = [], []
            rows = batch.select(["call_id", "turn", "name", "arguments", "called", "n_results", "result_turn", "content", "circular", "n_unknown", "unknown"])
            for row in rows.to_pylist():
                errors, value = [], None
                out = {"id": row["call_id"], "result": row["content"]}
                if row["called"]:
                    if row["name"] not in tools:
                        errors.append("unknown tool")
                    try:
                        value = parsed(row["arguments"] or "")
                        errors += violations(value, tools.get(row["name"], {}))
                        text = canonical_json(out | {"name": row["name"], "arguments": value})
                    except (ValueError, RecursionError):
                        errors.append("arguments are no JSON")
                        text = None
                else:
                    text = canonical_json(out)
                if row["n_unknown"]:
                    errors.append(f"{row['n_unknown']} unknown references, {row['unknown']} the first")
                if row["circular"]:
                    errors.append("circular references")
                # A name with a lone surrogate can't be written as it is.
                problems.append([error.encode("utf-8", "backslashreplace").decode() for error in errors])
                written.append(text)
            return [problems, written]

        return compute

    fields = [StructField("errors", ArrayType(StringType(), False), False), StructField("json", StringType())]
    checked = annotate(whole, start, fields, "arguments")
    status = (
        F.when(~has_id, "unlinked")
        .when(F.col("further"), "duplicate")
        .when(~F.col("called"), "orphan")
        .when((F.col("n_calls") > 1) | (F.col("n_results") > 1), "duplicate")
        .when(F.col("circular"), "circular")
        .when(F.size("errors") > 0, "invalid")
        .when(F.col("n_results") == 0, "pending")
        .otherwise("ok")
    )
    zero = F.lit(0).cast("long")
    return checked.select(
        *ID, "turn", "position", "name", "level", status.alias("status"),
        F.coalesce("n_calls", zero).alias("n_calls"), F.coalesce("n_results", zero).alias("n_results"), "result_turn", "errors", "json",
    )
