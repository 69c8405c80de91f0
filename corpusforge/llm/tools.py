"""Chat formatting (operator 1): tool-call linking.

* **Link**: calls and results meet in a hash join on (conv_id, call id).
* **Order**: a call comes after the call it depends on, a result after its
  call.  The depth of a call in its tree of dependencies is found by doubling
  (each pass halves the way to the root), so a conversation of ``n`` chained
  calls takes ``log2 n`` joins and no task holds a conversation.  Calls on a
  cycle never reach a root and are marked.
* **Validate**: arguments are checked against the schema of the tool's name.
* **Serialise**: canonical JSON, that is keys in code-point order, no white
  space, one form for each string and number.
"""

from __future__ import annotations

import json
import operator
import re
from collections.abc import Iterator
from fractions import Fraction
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusforge.llm.common import staged

_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}


def canonical(value: object) -> str:
    """Canonical JSON: sorted keys, no spaces, whole floats as integers."""

    def plain(v: object) -> object:
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        if isinstance(v, list):
            return [plain(x) for x in v]
        if isinstance(v, float) and v.is_integer() and abs(v) < 1 << 53:
            return int(v)
        return v

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


#: Keywords that say nothing about a value.
_NOTES = {"title", "description", "default", "examples", "format", "deprecated", "readOnly", "writeOnly", "$schema", "$id", "$comment"}
_NUMBERS = {
    "minimum": operator.lt, "maximum": operator.gt, "exclusiveMinimum": operator.le, "exclusiveMaximum": operator.ge,
}
_SIZES = {
    str: {"minLength": operator.lt, "maxLength": operator.gt}, list: {"minItems": operator.lt, "maxItems": operator.gt},
    dict: {"minProperties": operator.lt, "maxProperties": operator.gt},
}
_LISTS = {"anyOf", "oneOf", "allOf"}
_MAPS = {"properties", "$defs", "definitions"}
_ONE = {"items", "additionalProperties", "not"}
_PLAIN = {"type", "enum", "const", "required", "pattern", "multipleOf", "uniqueItems", "$ref", *_NUMBERS}.union(*_SIZES.values())


def _resolve(ref: str, root: dict) -> object:
    """What ``#/a/b`` names in ``root``."""
    at: object = root
    for part in ref.removeprefix("#").split("/")[1:]:
        part = unquote(part).replace("~1", "/").replace("~0", "~")
        at = at[part] if isinstance(at, dict) else at[int(part)]
    return at


def check_schema(schema: object, root: object = None, at: str = "#", below: tuple[str, ...] = ()) -> None:
    """Raises ValueError for what ``faults`` couldn't check: a keyword or type it
    doesn't know, a broken pattern, a reference that leads out of the schema,
    nowhere or back to itself."""
    root = schema if root is None else root
    if isinstance(schema, bool):
        return
    if not isinstance(schema, dict):
        raise ValueError(f"{at}: a schema is an object or a boolean")
    unknown = sorted(set(schema) - _NOTES - _LISTS - _MAPS - _ONE - _PLAIN)
    if unknown:
        raise ValueError(f"{at}: keywords not supported: {', '.join(unknown)}")
    kinds = schema.get("type", [])
    for kind in [kinds] if isinstance(kinds, str) else kinds:
        if kind not in _TYPES:
            raise ValueError(f"{at}: no such type: {kind}")
    for key, fits in [(k, _number) for k in _NUMBERS] + [(k, _size) for sizes in _SIZES.values() for k in sizes] + [("multipleOf", _positive)]:
        if key in schema and not fits(schema[key]):
            raise ValueError(f"{at}: not a value for {key}: {schema[key]!r}")
    for key in ("enum", "required"):
        if not isinstance(schema.get(key, []), list):
            raise ValueError(f"{at}: {key} is a list")
    try:
        re.compile(schema.get("pattern", ""))
    except (re.error, TypeError) as e:
        raise ValueError(f"{at}: pattern: {e}") from None
    if "$ref" in schema:
        ref = schema["$ref"]
        if not (isinstance(ref, str) and (ref == "#" or ref.startswith("#/"))):
            raise ValueError(f"{at}: reference out of the schema: {ref}")
        if ref in below:
            raise ValueError(f"{at}: reference to itself: {ref}")
        try:
            target = _resolve(ref, root)
        except (KeyError, IndexError, ValueError, TypeError):
            raise ValueError(f"{at}: reference to nothing: {ref}") from None
        _check_in_place(target, root, at, (*below, ref))
    for key in _LISTS & set(schema):
        for i, one in enumerate(schema[key]):
            check_schema(one, root, f"{at}/{key}/{i}", below)
    for key in _MAPS & set(schema):
        for name, one in schema[key].items():
            check_schema(one, root, f"{at}/{key}/{name}")
    for key in _ONE & set(schema):
        check_schema(schema[key], root, f"{at}/{key}", below if key == "not" else ())


def _check_in_place(schema: object, root: object, at: str, below: tuple[str, ...]) -> None:
    """The parts of a referred schema that judge the same value."""
    if isinstance(schema, dict):
        check_schema({k: v for k, v in schema.items() if k not in _MAPS | (_ONE - {"not"})}, root, at, below)
    else:
        check_schema(schema, root, at, below)


def _number(x: object) -> bool:
    return isinstance(x, int | float) and not isinstance(x, bool)


def _size(x: object) -> bool:
    return _number(x) and x >= 0


def _positive(x: object) -> bool:
    return _number(x) and x > 0


def faults(value: object, schema: dict | bool, at: str = "$", root: dict | bool | None = None) -> list[str]:
    """What of ``value`` breaks ``schema``: type, enum, const, required,
    properties, additionalProperties, minProperties, maxProperties, items,
    minItems, maxItems, uniqueItems, minLength, maxLength, pattern (as ``re``
    reads it, found anywhere), minimum, maximum, exclusiveMinimum,
    exclusiveMaximum, multipleOf, anyOf, oneOf, allOf, not, ``$ref`` within the
    schema and boolean schemas.  Equal means equal as canonical JSON (1 is 1.0
    but not true).  A value of the wrong type is checked no further."""
    root = schema if root is None else root
    if isinstance(schema, bool):
        return [] if schema else [f"{at}:false"]
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        whole = isinstance(value, float) and value.is_integer() and "integer" in kinds
        fits = any(isinstance(value, _TYPES[k]) and not (isinstance(value, bool) and k in ("integer", "number")) for k in kinds)
        if not (fits or whole):
            return [f"{at}:type"]
    out = []
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        out.append(f"{at}:enum")
    if "const" in schema and canonical(value) != canonical(schema["const"]):
        out.append(f"{at}:const")
    out += [f"{at}:{k}" for kind, sizes in _SIZES.items() if isinstance(value, kind) for k, off in sizes.items() if k in schema and off(len(value), schema[k])]
    if isinstance(value, str) and "pattern" in schema and not re.search(schema["pattern"], value):
        out.append(f"{at}:pattern")
    if _number(value):
        out += [f"{at}:{k}" for k, off in _NUMBERS.items() if k in schema and off(value, schema[k])]
        if "multipleOf" in schema and (Fraction(repr(value)) / Fraction(repr(schema["multipleOf"]))).denominator != 1:
            out.append(f"{at}:multipleOf")
    if isinstance(value, dict):
        known, more = schema.get("properties", {}), schema.get("additionalProperties", True)
        out += [f"{at}.{k}:required" for k in sorted(schema.get("required", [])) if k not in value]
        for k in sorted(value):
            if k in known:
                out += faults(value[k], known[k], f"{at}.{k}", root)
            elif more is False:
                out.append(f"{at}.{k}:additionalProperties")
            else:
                out += faults(value[k], more, f"{at}.{k}", root)
    if isinstance(value, list):
        if schema.get("uniqueItems") and len(set(map(canonical, value))) < len(value):
            out.append(f"{at}:uniqueItems")
        if "items" in schema:
            for i, x in enumerate(value):
                out += faults(x, schema["items"], f"{at}[{i}]", root)
    if "$ref" in schema:
        out += faults(value, _resolve(schema["$ref"], root), at, root)
    for one in schema.get("allOf", []):
        out += faults(value, one, at, root)
    for k in ("anyOf", "oneOf"):
        if k in schema:
            fitting = sum(not faults(value, one, at, root) for one in schema[k])
            if not fitting or k == "oneOf" and fitting > 1:
                out.append(f"{at}:{k}")
    if "not" in schema and not faults(value, schema["not"], at, root):
        out.append(f"{at}:not")
    return out


def _checked(schemas: dict[str, dict]):
    def one(name: str | None, arguments: str | None) -> tuple[str | None, str]:
        try:
            value = json.loads(arguments or "")
            text = canonical(value)
        except (ValueError, RecursionError):
            return None, "$:json"
        if name not in schemas:
            return text, "$:unknown tool"
        try:
            return text, ",".join(faults(value, schemas[name]))
        except RecursionError:
            return text, "$:depth"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [one(n, a) for n, a in zip(batch.column("name").to_pylist(), batch.column("arguments").to_pylist(), strict=True)]
            out = {n: batch.column(n) for n in batch.schema.names if n != "arguments"}
            yield pa.RecordBatch.from_pydict(out | {
                "arguments": pa.array([x for x, _ in done], pa.string()), "faults": pa.array([x for _, x in done], pa.string()),
            })

    return rows


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) of distinct (conv_id, call_id, parent_id): how
    many calls a call depends on in turn; null on a cycle, or below one.  A
    parent that isn't among the calls doesn't count."""
    own = calls.select(F.col("conv_id").alias("c"), F.col("call_id").alias("above"))
    up = calls.join(own, (F.col("conv_id") == F.col("c")) & (F.col("parent_id") == F.col("above")), "left")
    at = staged(up.select("conv_id", "call_id", "above", F.col("above").isNotNull().cast("long").alias("depth")), "depths")
    bound = at.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    for _ in range(max(0, bound - 1).bit_length() + 1):
        if at.filter("above is not null").isEmpty():
            break
        step = at.select(F.col("conv_id").alias("c"), F.col("call_id").alias("via"), F.col("above").alias("next"), F.col("depth").alias("more"))
        on = (F.col("conv_id") == F.col("c")) & (F.col("above") == F.col("via"))
        at = staged(at.join(step, on, "left").select("conv_id", "call_id", F.col("next").alias("above"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "depths")
    return at.select("conv_id", "call_id", F.when(F.col("above").isNull(), F.col("depth")).alias("depth"))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict], others: DataFrame | None = None) -> DataFrame:
    """One row for each call, result and other turn.

    ``calls``: conv_id, call_id, parent_id, turn, name, arguments (JSON);
    ``results``: conv_id, call_id, turn, content; ``others``, turns that are
    neither: conv_id, turn, role, content.  ``schemas`` are JSON schemas by tool
    name; one that ``faults`` can't check is a ValueError before any job.  Returns
    conv_id, call_id, turn, kind (call, result or turn), status, depth, faults,
    message, where

    * status of a call is ``linked``, ``unanswered``, ``repeated`` (a later call
      of the same id) or ``cycle``; of a result ``linked``, ``orphan`` (no such
      call) or ``repeated`` (a later result of a call); of an other turn ``plain``,
      without call_id and depth;
    * depth places it: calls have 2 * (calls it depends on), results one more
      than their call; null where there is no place.  Sorted by depth, then
      turn, the linked rows of a conversation are in topological order;
    * faults says what breaks the schema ("" if nothing does, ``$:depth`` if the
      value is nested too deeply to check; null for results and other turns);
    * message is canonical JSON of the row.

    Rows without conv_id or call_id link to nothing (a call is then unanswered,
    a result an orphan) and have no depth.  Equal turns are ordered by content.
    Other columns are ignored; empty tables give no rows."""
    for schema in schemas.values():
        check_schema(schema)
    nth = lambda *by: F.row_number().over(Window.partitionBy("conv_id", "call_id").orderBy(*by))
    keyed = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    calls = calls.select("conv_id", "call_id", "parent_id", "turn", "name", "arguments")
    schema = "conv_id long, call_id string, parent_id string, turn long, name string, keyed boolean, nth int, arguments string, faults string"
    checked = staged(
        calls.withColumn("keyed", keyed).withColumn("nth", F.when(F.col("keyed"), nth("turn", "name", "arguments", "parent_id")).otherwise(1))
        .select("conv_id", "call_id", "parent_id", "turn", "name", "keyed", "nth", "arguments").mapInArrow(_checked(schemas), schema),
        "calls",
    )
    first = checked.filter("keyed and nth = 1")
    results = results.select("conv_id", "call_id", "turn", "content").withColumn("keyed", keyed)
    results = staged(results.withColumn("nth", F.when(F.col("keyed"), nth("turn", "content")).otherwise(1)), "results")
    deep = depths(first.select("conv_id", "call_id", "parent_id"))
    key = ["conv_id", "call_id"]
    answered = results.filter("keyed and nth = 1").select(*key, F.lit(True).alias("answered"))
    placed = staged(first.select(*key).join(deep, key).join(answered, key, "left"), "placed")
    call = checked.join(placed, key, "left").select(
        *key, "turn", F.lit("call").alias("kind"),
        F.when(F.col("nth") > 1, "repeated").when(F.col("keyed") & F.col("depth").isNull(), "cycle")
        .when(F.col("answered"), "linked").otherwise("unanswered").alias("status"),
        F.when(F.col("nth") == 1, 2 * F.col("depth")).alias("depth"), "faults",
        _object(arguments=F.coalesce("arguments", F.lit("null")), depends_on=_quoted("parent_id"), id=_quoted("call_id"), name=_quoted("name"), type=F.lit('"tool_call"')).alias("message"),
    )
    result = results.join(placed.withColumn("known", F.lit(True)), key, "left").select(
        *key, "turn", F.lit("result").alias("kind"),
        F.when(F.col("known").isNull(), "orphan").when(F.col("nth") > 1, "repeated").otherwise("linked").alias("status"),
        F.when(F.col("nth") == 1, 2 * F.col("depth") + 1).alias("depth"), F.lit(None).cast("string").alias("faults"),
        _object(content=_quoted("content"), id=_quoted("call_id"), type=F.lit('"tool_result"')).alias("message"),
    )
    if others is None:
        return call.unionByName(result)
    null = F.lit(None).cast("string")
    plain = others.select(
        "conv_id", null.alias("call_id"), "turn", F.lit("turn").alias("kind"), F.lit("plain").alias("status"),
        F.lit(None).cast("long").alias("depth"), null.alias("faults"),
        _object(content=_quoted("content"), role=_quoted("role"), type=F.lit('"turn"')).alias("message"),
    )
    return call.unionByName(result).unionByName(plain)


def _quoted(name: str) -> F.Column:
    """A JSON string, escaped as ``canonical`` does; null as null."""
    text = F.col(name)
    text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for code in range(32):
        short = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r"}.get(code, f"\\u{code:04x}")
        text = F.replace(text, F.lit(chr(code)), F.lit(short))
    return F.coalesce(F.concat(F.lit('"'), text, F.lit('"')), F.lit("null"))


def _object(**members: F.Column) -> F.Column:
    parts = []
    for k in sorted(members):
        parts += [F.lit(("," if parts else "{") + f'"{k}":'), members[k]]
    return F.concat(*parts, F.lit("}"))
