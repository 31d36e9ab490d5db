"""Tool calls in conversations: linked to their results, ordered, checked and written as canonical JSON.

Calls and results meet by an equi-join on (conversation, identifier), so a conversation of any length is spread over
tasks. The order is topological: a call comes after the results that its arguments cite as ``{"$result": id}``, a result
after its call, everything else by turn. It is given as sort keys (``step``, ``place``), not by numbering, which would
bring a whole conversation into one task. Arguments are checked against the tool's schema; JSON has its keys
sorted at every depth, no spaces, and numbers as Spark's variant type holds them.

DataFrame functions only. Defined cases: of several calls with one identifier the first, by turn and index, is the
call and the others are ``duplicate_call``; a call without result is ``unanswered``, a result without call is
``orphan_result``, one of calls that cite each other in a ring is ``cyclic``; several results of one call stay, by turn.
Rows without conversation or identifier are linked with nothing. Arguments that are no JSON object, null ones
included, are invalid; a tool without a schema is ``unknown_tool``. Extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronomart.llm.scratch import written

#: Schema types by the names that ``schema_of_variant`` gives.
TYPES = {
    "string": ["STRING"],
    "integer": ["BIGINT"],
    "number": ["BIGINT", "DOUBLE", "DECIMAL"],
    "boolean": ["BOOLEAN"],
    "object": ["OBJECT"],
    "array": ["ARRAY"],
    "null": ["VOID"],
}
CITED = r'"\$result"\s*:\s*"([^"]+)"'


def canonical(json: Column) -> Column:
    """JSON with sorted keys and no spaces; null for what is no JSON."""
    return F.to_json(F.try_parse_json(json))


def problems(arguments: Column, schema: Mapping) -> Column:
    """What is wrong with parsed arguments under a schema with ``required`` and ``properties``, as an array."""
    found = []
    for name, kind in schema.get("properties", {}).items():
        value = F.variant_get(arguments, f"$.{name}", "variant")
        # DECIMAL(3,1), ARRAY<...>: the name before any bracket counts.
        got = F.regexp_extract(F.schema_of_variant(value), r"^\w+", 0)
        absent = f"missing:{name}" if name in schema.get("required", ()) else None
        found.append(
            F.when(value.isNull(), F.lit(absent)).when(~got.isin(TYPES[kind]), F.lit(f"type:{name}"))
        )
    for name in schema.get("required", ()):
        if name not in schema.get("properties", {}):
            value = F.variant_get(arguments, f"$.{name}", "variant")
            found.append(F.when(value.isNull(), F.lit(f"missing:{name}")))
    return F.array_sort(F.array_compact(F.array(*found))) if found else F.array().cast("array<string>")


def validated(calls: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """``calls`` with ``problems``, an array that is empty for valid arguments."""
    parsed = F.try_parse_json("arguments")
    is_object = F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT"))
    checks = F.lit(None).cast("array<string>")
    for tool, schema in schemas.items():
        checks = F.when(F.col("tool") == tool, problems(parsed, schema)).otherwise(checks)
    return calls.withColumn(
        "problems",
        F.when(F.coalesce(is_object, F.lit(False)), F.coalesce(checks, F.array(F.lit("unknown_tool")))).otherwise(
            F.array(F.lit("no_object"))
        ),
    )


def _steps(calls: DataFrame) -> DataFrame:
    """``(conv, id, step)`` of the calls ``(conv, id, turn, end, arguments)`` that cite results: one step after
    the last result of any call cited, null in or behind a ring. ``end`` is a call's last result, or itself.
    A cited identifier that is no call of the conversation does not count.

    A call's step is its ``least`` or ``far`` steps after a call that it waits for, whichever is later. In each round a
    call that waits for nothing is put in for those that wait for it, and so is one that waits for a single other:
    what waited for it then waits for that other, further off, so that chains halve. A round in which no call
    stops waiting leaves rings and what is behind them.
    """
    cites = calls.select(
        "conv", "id", "turn", F.explode(F.regexp_extract_all("arguments", F.lit(CITED), F.lit(1))).alias("cited")
    ).distinct()
    cites = written(
        cites.join(calls.select("conv", F.col("id").alias("cited"), "end"), ["conv", "cited"]), "cites"
    )
    known = written(
        cites.groupBy("conv", "id").agg(F.greatest(F.max("turn"), F.max("end") + 1).alias("least")), "known"
    )
    citing = known.select("conv", F.col("id").alias("cited"))
    waiting = written(
        cites.join(citing, ["conv", "cited"], "left_semi").select("conv", "id", "cited", F.lit(1).cast("long").alias("far")),
        "waiting",
    )
    names = waiting.select("conv", "id").distinct()
    left = names.count()
    while left:
        each = waiting.groupBy("conv", "id").agg(
            F.count("*").alias("n"), F.min("cited").alias("_next"), F.max("far").alias("_far")
        )
        put = written(
            known.join(each, ["conv", "id"], "left").select(
                "conv", F.col("id").alias("cited"), F.col("least").alias("_least"), F.coalesce("n", F.lit(0)).alias("n"), "_next", "_far"
            ),
            "put",
        )
        one = F.col("n") == 1
        moved = written(
            waiting.join(put, ["conv", "cited"]).select(
                "conv",
                "id",
                F.when(F.col("n") <= 1, F.col("_least") + F.col("far")).alias("_least"),
                F.when(one, F.col("_next")).when(F.col("n") > 1, F.col("cited")).alias("cited"),
                # No chain is as long as this; in rings it would grow without end.
                F.least(F.when(one, F.col("far") + F.col("_far")).otherwise(F.col("far")), F.lit(2**40)).alias("far"),
            ),
            "moved",
        )
        later = moved.groupBy("conv", "id").agg(F.max("_least").alias("_least"))
        known = written(
            known.join(later, ["conv", "id"], "left").select("conv", "id", F.greatest("least", "_least").alias("least")),
            "known",
        )
        waiting = written(
            moved.where("cited is not null").groupBy("conv", "id", "cited").agg(F.max("far").alias("far")), "waiting"
        )
        names = waiting.select("conv", "id").distinct()
        before, left = left, names.count()
        if left == before:
            break
    return known.join(names.withColumn("ring", F.lit(True)), ["conv", "id"], "left").select(
        "conv", "id", F.when(F.col("ring").isNull(), F.col("least")).alias("step")
    )


def linked(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """Calls ``(conv, turn, index, id, tool, arguments)`` and results ``(conv, turn, index, id, content)`` as rows
    ``(conv, step, place, turn, index, kind, id, status, problems, json)``; ``step`` and ``place`` order them.

    ``step`` is the turn, or later where a row has to wait; ``place`` is 0 for calls and 1 for results.
    Chains of citations may have any length.
    """
    calls = calls.select("conv", "turn", "index", "id", "tool", "arguments")
    results = results.select("conv", "turn", "index", "id", "content")
    first = calls.where("conv is not null and id is not null").groupBy("conv", "id").agg(
        F.min(F.struct("turn", "index", "tool", "arguments")).alias("first")
    )
    last = results.groupBy("conv", "id").agg(F.max("turn").alias("last"))
    first = (
        first.join(last, ["conv", "id"], "left")
        .select("conv", "id", "first", F.greatest("first.turn", "last").alias("end"), F.col("last").isNotNull().alias("answered"))
    )
    # Written before it is joined again: a result that very many rows repeat can then be split over tasks.
    first = written(first, "first-calls")
    steps = _steps(first.select("conv", "id", "first.turn", "end", "first.arguments"))
    placed = (
        first.join(steps.withColumn("cites", F.lit(True)), ["conv", "id"], "left")
        .withColumn("cyclic", F.col("cites").isNotNull() & F.col("step").isNull())
        .select("conv", "id", "first", F.coalesce("step", "first.turn").alias("step"), "answered", "cyclic")
    )
    placed = written(placed, "placed-calls")

    mine = F.struct("turn", "index", "tool", "arguments")
    out_calls = (
        validated(calls, schemas)
        .join(placed, ["conv", "id"], "left")
        .withColumn("same", F.coalesce(mine.eqNullSafe(F.col("first")), F.lit(False)))
        .withColumn(
            "status",
            F.when(F.col("first").isNull(), "no_identifier")
            .when(~F.col("same"), "duplicate_call")
            .when(F.col("cyclic"), "cyclic")
            .when(~F.col("answered"), "unanswered")
            .otherwise(F.when(F.size("problems") > 0, "invalid").otherwise("ok")),
        )
        .select(
            "conv",
            F.coalesce("step", "turn").alias("step"),
            F.lit(0).alias("place"),
            "turn",
            "index",
            F.lit("call").alias("kind"),
            "id",
            "status",
            "problems",
            message_json(
                {"id": F.col("id"), "name": F.col("tool"), "role": F.lit("assistant")},
                {"arguments": F.col("arguments")},
            ).alias("json"),
        )
    )
    out_results = results.join(placed.select("conv", "id", "step"), ["conv", "id"], "left").select(
        "conv",
        F.greatest("step", "turn").alias("step"),
        F.lit(1).alias("place"),
        "turn",
        "index",
        F.lit("result").alias("kind"),
        "id",
        F.when(F.col("step").isNull(), "orphan_result").otherwise("ok").alias("status"),
        F.array().cast("array<string>").alias("problems"),
        message_json({"content": F.col("content"), "role": F.lit("tool"), "tool_call_id": F.col("id")}).alias("json"),
    )
    return out_calls.unionByName(out_results)


def message_json(texts: Mapping[str, Column], values: Mapping[str, Column] | None = None) -> Column:
    """One JSON object with sorted keys; ``values`` are JSON themselves and stand as text where they are none.
    Null texts are left out."""
    fields = dict(texts)
    for name, json in (values or {}).items():
        fields[name] = F.coalesce(F.try_parse_json(json), F.try_parse_json(F.to_json(F.array(json))))
    plain = F.to_json(F.struct(*[fields[n].alias(n) for n in sorted(fields)]))
    return canonical(plain)


def plain_messages(messages: DataFrame) -> DataFrame:
    """Messages ``(conv, turn, index, role, content)`` in the form of ``linked``."""
    return messages.select(
        "conv",
        F.col("turn").alias("step"),
        F.lit(0).alias("place"),
        "turn",
        "index",
        F.lit("message").alias("kind"),
        F.lit(None).cast("string").alias("id"),
        F.lit("ok").alias("status"),
        F.array().cast("array<string>").alias("problems"),
        message_json({"content": F.col("content"), "role": F.col("role")}).alias("json"),
    )
