"""Tool calls and their results: linked, ordered, validated and written as canonical JSON.

Calls and results are joined by the call's identifier. A call can need another one's result; its
level is the number of calls that have to come before it, found by pointer doubling: in each
round a call takes over the level of the call it points to and points to where that one points,
so a chain of n calls takes log2(n) rounds. Arguments are checked against the tool's schema.
Built-in functions only.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, with_place

Schema = Mapping[str, tuple[str, bool]]
"""The fields of a tool's arguments: type (STRING, BIGINT, DOUBLE or BOOLEAN) and whether the
field must be there."""

_WIDER = {"DOUBLE": ("DOUBLE", "BIGINT", "DECIMAL")}


def argument_errors(name: Column, arguments: Column, schemas: Mapping[str, Schema]) -> Column:
    """What is wrong with a call's arguments, as an array of texts; empty if nothing is."""
    parsed = F.try_parse_json(arguments)
    keys = F.json_object_keys(arguments)

    def of_tool(schema: Schema) -> Column:
        checks = []
        for field, (kind, required) in sorted(schema.items()):
            found = F.schema_of_variant(F.try_variant_get(parsed, f"$.{field}", "variant"))
            right = F.lit(False)
            for accepted in _WIDER.get(kind, (kind,)):
                right = right | found.startswith(accepted)
            there = F.coalesce(F.array_contains(keys, field), F.lit(False))
            missing = F.when(~there, F.lit(f"missing {field}")) if required else F.lit(None).cast("string")
            checks += [missing, F.when(there & ~F.coalesce(right, F.lit(False)), F.lit(f"type of {field}"))]
        unknown = F.array_sort(F.array_except(keys, F.array(*map(F.lit, sorted(schema)))))
        unknown = F.transform(unknown, lambda key: F.concat(F.lit("unknown "), key))
        return F.concat(F.filter(F.array(*checks), lambda check: check.isNotNull()), unknown)

    errors = F.array(F.lit("unknown tool"))
    for tool, schema in sorted(schemas.items()):
        errors = F.when(name == tool, of_tool(schema)).otherwise(errors)
    not_an_object = parsed.isNull() | keys.isNull()
    return F.when(not_an_object, F.array(F.lit("not an object"))).otherwise(errors)


def levels(calls: DataFrame) -> DataFrame:
    """``call_id``, ``level`` of calls ``call_id, needs``: 0 for a call that needs none, or one
    that is not among them; NULL for calls that wait for themselves in a circle."""
    known = calls.select(F.col("call_id").alias("needs"))
    linked = calls.join(known.withColumn("known", F.lit(True)), "needs", "left")
    up = F.when(F.col("known"), F.col("needs")).alias("up")
    state = kept(linked.select("call_id", up, F.when(F.col("known"), 1).otherwise(0).cast("long").alias("level")), "levels")
    rounds = math.ceil(math.log2(max(state.count(), 2))) + 1
    for _ in range(rounds):
        if state.filter("up IS NOT NULL").isEmpty():
            break
        above = state.select(F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("level").alias("more"))
        both = state.join(above, "up", "left")
        state = kept(both.select("call_id", F.col("next").alias("up"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")), "levels")
    return state.select("call_id", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def link(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Schema], every_row: bool = False) -> DataFrame:
    """One row for each different call and each result without a call: ``conv_id``,
    ``call_id``, ``name``, ``level``, ``place`` in its conversation, ``status``, ``errors``,
    ``message``.

    ``calls`` has ``conv_id, position, call_id, name, arguments, needs``, ``results`` has
    ``conv_id, position, call_id, content``. The status is ``linked``, ``pending`` (no result)
    or ``orphan`` (no call). Of calls with the same id the first by conversation, position and
    content counts, and likewise of results; further ones are left out, repeated rows too, and
    so are rows without an id, which cannot be linked. Arguments that are NULL or no JSON
    object are an error and written as null. Places follow the level, then the position, then
    the id; circles come last, orphans after them. Empty tables give an empty table.

    With ``every_row``, calls and results are linked within their conversation (NULL is one like
    any other), and no row is left out: further calls and results of an id come as rows of their
    own with the status ``duplicate``, those without an id as ``unidentified``, after the orphans.

    Copies of an id are reduced in each task before the join, and places are counted over
    ranges, so neither a much-used id nor a very long conversation is left to one task.
    """
    call_fields = ["conv_id", "position", "call_id", "name", "arguments", "needs"]
    result_fields = ["conv_id", "position", "call_id", "content"]
    calls = calls.select(*call_fields, _key("call_id", every_row).alias("key"), _key("needs", every_row).alias("needs_key"))
    results = results.select(*result_fields, _key("call_id", every_row).alias("key"))
    first_call = F.min(F.struct("conv_id", "position", "name", "arguments", "needs", "call_id", "needs_key")).alias("call")
    made = calls.filter("key IS NOT NULL").groupBy("key").agg(first_call).select("key", "call.*")
    made = kept(made, "calls")
    first_result = F.min(F.struct("conv_id", "position", "content", "call_id")).alias("result")
    given = kept(results.filter("key IS NOT NULL").groupBy("key").agg(first_result), "results")
    level_of = levels(made.select(F.col("key").alias("call_id"), F.col("needs_key").alias("needs")))
    ordered = made.join(level_of.withColumnRenamed("call_id", "key"), "key")
    both = ordered.withColumn("called", F.lit(True)).join(given, "key", "full")
    status = F.when(F.col("called").isNull(), "orphan").when(F.col("result").isNull(), "pending").otherwise("linked")
    errors = argument_errors(F.col("name"), F.col("arguments"), schemas)
    rows = both.select(
        F.coalesce("conv_id", "result.conv_id").alias("conv_id"),
        F.coalesce("call_id", "result.call_id").alias("call_id"),
        "name", "level", "needs", "arguments",
        F.coalesce("position", "result.position").alias("position"),
        status.alias("status"),
        F.when(F.col("called"), F.array_join(errors, "; ")).alias("errors"),
        F.col("result.content").alias("content"),
        F.col("called").isNull().cast("int").alias("__orphan"),
    )
    if every_row:
        firsts = made.select("key", F.struct("position", "name", "arguments", "needs").alias("first"))
        more_calls = _further(calls.drop("needs_key"), firsts, ["position", "name", "arguments", "needs"])
        firsts = given.select("key", F.struct("result.position", "result.content").alias("first"))
        more_results = _further(results, firsts, ["position", "content"])
        nothing = lambda *names: {name: F.lit(None).cast("string") for name in names}
        more_calls = more_calls.withColumns({"errors": F.array_join(errors, "; "), **nothing("content")})
        more_results = more_results.withColumns(nothing("name", "needs", "arguments", "errors"))
        more = more_calls.unionByName(more_results)
        more = more.withColumns({"level": F.lit(None).cast("long"), "__orphan": F.when(F.col("status") == "duplicate", 2).otherwise(3)})
        rows = rows.unionByName(more.select(*rows.columns))
    order = [F.col("__orphan"), F.col("level").asc_nulls_last(), F.col("position").asc_nulls_last(), F.col("call_id")]
    placed = with_place(rows, ["conv_id"], order, "place")
    message = canonical(
        {
            "arguments": F.to_json(F.try_parse_json("arguments")),
            "errors": _text("errors"),
            "id": _text("call_id"),
            "name": _text("name"),
            "needs": _text("needs"),
            "result": _text("content"),
            "status": _text("status"),
        }
    )
    return placed.select("conv_id", "call_id", "name", "level", "place", "status", "errors", message.alias("message"))


def _key(column: str, in_conversation: bool) -> Column:
    """What calls and results are linked by; NULL for rows without an id."""
    if not in_conversation:
        return F.col(column)
    return F.when(F.col(column).isNotNull(), F.to_json(F.struct("conv_id", F.col(column).alias("id"))))


def _further(rows: DataFrame, firsts: DataFrame, fields: list[str]) -> DataFrame:
    """The rows that are not the ``first`` of their ``key``, with their status. Of equal rows,
    counted in each task before they meet, one can be the first."""
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    joined = counted.join(firsts, "key", "left")
    spare = F.col("n") - F.when(F.struct(*fields).eqNullSafe(F.col("first")), 1).otherwise(0)
    spare = F.when(F.col("key").isNull(), F.col("n")).otherwise(spare).cast("int")
    status = F.when(F.col("key").isNull(), "unidentified").otherwise("duplicate").alias("status")
    copies = joined.withColumn("n", spare).filter("n > 0")
    return copies.select("*", status, F.explode(F.array_repeat(F.lit(1), F.col("n")))).drop("key", "first", "n", "col")


def _text(column: str) -> Column:
    """A text column as a JSON string."""
    inner = F.to_json(F.array(F.col(column)))
    return F.when(F.col(column).isNotNull(), F.substring(inner, F.lit(2), F.length(inner) - 2))


def canonical(members: Mapping[str, Column]) -> Column:
    """A JSON object of JSON values: keys sorted, no blanks, NULL as null. Parsed JSON comes
    with sorted keys as well."""
    parts = []
    for key in sorted(members):
        parts += [F.lit(f'"{key}":'), F.coalesce(members[key], F.lit("null")), F.lit(",")]
    return F.concat(F.lit("{"), *parts[:-1], F.lit("}"))


# The tools that `from_conversations` calls.
TOOLS: dict[str, Schema] = {
    "count": {"chars": ("BIGINT", True), "limit": ("BIGINT", False)},
    "search": {"limit": ("BIGINT", True), "query": ("STRING", True), "chars": ("BIGINT", False)},
    "read": {"chars": ("BIGINT", True), "limit": ("BIGINT", True), "query": ("STRING", True)},
}


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results in conversations, which have only texts.

    Every assistant turn is a call: of ``search``, ``read``, ``count`` or an unknown tool by its
    length modulo 7, with its length, turn and whole text as arguments. Turns whose
    length is a multiple of 5 give the turn as text, multiples of 11 no query, multiples of 13
    cut JSON. If its length is even, a call needs that of two turns before. Every other turn is
    the result of the turn before it.
    """
    size, text = F.length(F.coalesce("text", F.lit(""))), F.coalesce("text", F.lit(""))
    name = F.element_at(F.array(*map(F.lit, ("search", "read", "count", "search", "read", "search", "draw"))), size % 7 + 1)
    limit = F.when(size % 5 == 0, F.concat(F.lit('"'), F.col("turn").cast("string"), F.lit('"'))).otherwise(F.col("turn").cast("string"))
    query = F.to_json(F.array(text))
    query = F.concat(F.lit('"query": '), F.substring(query, F.lit(2), F.length(query) - 2), F.lit(", "))
    query = F.when(size % 11 == 0, F.lit("")).otherwise(query)
    arguments = F.concat(F.lit("{"), query, F.lit('"limit": '), limit, F.lit(', "chars": '), size.cast("string"))
    arguments = F.when(size % 13 == 0, arguments).otherwise(F.concat(arguments, F.lit(" }")))

    def call_id(back: int) -> Column:
        return F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), (F.col("turn") - back).cast("string"))

    said = F.coalesce(F.col("role") == "assistant", F.lit(False))
    calls = turns.filter(said).select(
        "conv_id", F.col("turn").alias("position"), call_id(0).alias("call_id"), name.alias("name"),
        arguments.alias("arguments"), F.when(size % 2 == 0, call_id(2)).alias("needs"),
    )
    results = turns.filter(~said).select(
        "conv_id", F.col("turn").alias("position"), call_id(1).alias("call_id"), F.col("text").alias("content")
    )
    return calls, results
