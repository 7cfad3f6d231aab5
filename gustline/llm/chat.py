"""Tool calls of conversations: linked with their results, levelled, validated, serialised.
DataFrame functions only.

- Calls and results are joined by conversation and id; ids need not be unique beyond a conversation. Of
  several calls (or results) with one id the least is linked, by its fields in order; each further one is a
  row of its own with status ``duplicate``. So every row of both tables is in one row of the result.
- A call may name the call of its conversation that it follows. Levels are topological: a call without
  such a parent has level 0, any other one more than its parent. They come from doubling: each round, every
  call's known ancestor is replaced by that one's, so a chain of n calls takes log2(n) rounds. Calls that
  have reached the top are set aside and not joined again. Calls on a cycle, or behind one, have no level.
- Arguments are parsed as JSON and checked field by field against the schema of the tool: fields that
  must be there, the kind of each field, fields that the schema does not have.
- Messages are canonical JSON: keys sorted at every depth, no spaces, absent fields left out.

``in_order`` sorts rows topologically, by (conv_id, level, call_id), by ranges: a conversation is never
gathered in one place, so one that holds a third of all calls is no different. Equal rows are counted before
they are shuffled by id.

Nulls: rows of null conversations are a conversation of their own; calls and results without id are left
out of linking and come back as errors; null arguments are invalid. Other columns are ignored. Empty tables
give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.session import stage

BROADCAST_FIELDS = 100_000  # schema fields sent to all tasks at most; more are joined by a shuffle
KINDS = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN"}
_KEY = ["conv", "call_id"]
_OUT = ["conv_id", "call_id", "level", "parent_id", "name", "n_calls", "n_results", "status", "errors", "message"]


def canonical(json: Column) -> Column:
    """Canonical text of JSON text; null if it is not JSON."""
    return F.to_json(F.try_parse_json(json))


def _kind(value: Column) -> Column:
    found = F.schema_of_variant(value)
    return (
        F.when(found == "VOID", "null").when(found.startswith("OBJECT"), "object").when(found.startswith("ARRAY"), "array")
        .when(found.startswith("DECIMAL") | found.isin("DOUBLE", "FLOAT"), "number").when(found == "BIGINT", "integer")
        .when(found == "BOOLEAN", "boolean").otherwise("string")
    )


def _conv(conv_id: Column) -> Column:
    """Text that stands for a conversation, the null one included."""
    return F.coalesce(F.concat(F.lit("v"), conv_id.cast("string")), F.lit("n"))


def levels(calls: DataFrame) -> DataFrame:
    """(conv, call_id, level) of the calls (conv, call_id, parent_id) that are on no cycle and behind none.

    A parent that is not among the calls of the conversation counts as none.
    """
    known = calls.select("conv", F.col("call_id").alias("parent_id")).distinct()
    followed = stage(calls.where("parent_id is not null").join(known, ["conv", "parent_id"]), "followed-calls")
    above = followed.select(*_KEY, F.lit(1).cast("long").alias("level"), F.col("parent_id").alias("up"))
    tops = calls.select(*_KEY).join(followed.select(*_KEY), _KEY, "left_anti")
    zero = F.lit(0).cast("long")
    parents = stage(tops.select(*_KEY, zero.alias("level"), F.lit(None).cast("string").alias("up")), "top-calls")
    done, rest = [parents], above
    left = followed.count()
    while left and not rest.isEmpty():
        state = parents.unionByName(rest)
        further = state.select("conv", F.col("call_id").alias("up"), F.col("up").alias("up2"), F.col("level").alias("more"))
        joined = rest.join(further, ["conv", "up"])
        moved = stage(joined.select(*_KEY, (F.col("level") + F.col("more")).alias("level"), F.col("up2").alias("up")), "levels")
        ended = moved.where("up is null")
        done.append(ended)
        parents = parents.unionByName(ended)
        rest = moved.where("up is not null")
        left //= 2
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.select(*_KEY, "level")


def argument_errors(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv, call_id, errors) of the calls whose arguments do not follow the schema of their tool.

    ``calls`` has conv, call_id, name and arguments; ``schemas`` name, field, kind and required.
    """
    fields = schemas.select("name", "field", "kind", "required").distinct()
    tools = fields.select("name").distinct().withColumn("known", F.lit(True))
    if fields.count() <= BROADCAST_FIELDS:
        fields, tools = F.broadcast(fields), F.broadcast(tools)

    def error(rows: DataFrame, text: Column) -> DataFrame:
        return rows.select(*_KEY, text.alias("error"))

    parsed = calls.select(*_KEY, "name", F.try_parse_json("arguments").alias("v"))
    parsed = parsed.withColumn("object", F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False)))
    whole = error(parsed.where("not object"), F.lit("arguments: not an object"))
    strange = error(parsed.select(*_KEY, "name").join(tools, "name", "left").where("known is null"), F.lit("name: unknown tool"))
    objects = parsed.where("object").select(*_KEY, "name", F.from_json(F.to_json("v"), "map<string,variant>").alias("m"))
    given = objects.select(*_KEY, "name", F.explode("m").alias("field", "value"))
    given = given.select(*_KEY, "name", "field", _kind(F.col("value")).alias("got"))
    told = given.join(tools, "name").drop("known").join(fields, ["name", "field"], "left")
    wrong = error(told.where("kind is null"), F.concat("field", F.lit(": not in the schema")))
    fits = (F.col("got") == F.col("kind")) | ((F.col("kind") == "number") & (F.col("got") == "integer"))
    kinds = error(told.where(F.col("kind").isNotNull() & ~fits), F.concat("field", F.lit(": not of kind "), "kind"))
    asked = objects.select(*_KEY, "name", F.map_keys("m").alias("keys")).join(fields, "name").where("required")
    missing = error(asked.where(~F.array_contains("keys", F.col("field"))), F.concat("field", F.lit(": missing")))
    every = whole.unionByName(strange).unionByName(wrong).unionByName(kinds).unionByName(missing)
    return every.groupBy(*_KEY).agg(F.array_join(F.array_sort(F.collect_set("error")), ", ").alias("errors"))


def _first_and_further(rows: DataFrame, fields: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """(the least row of each id with ``n`` rows, the others one by one), both with ``conv``."""
    counted = rows.where("call_id is not null").groupBy("conv", "conv_id", "call_id", *fields).agg(F.count(F.lit(1)).alias("copies"))
    counted = stage(counted, label)
    own = F.struct(*fields)
    least = counted.groupBy(*_KEY).agg(F.min(own).alias("least"), F.sum("copies").alias("n"))
    told = stage(counted.join(least, _KEY).withColumn("first", own.eqNullSafe(F.col("least"))), f"{label}-told")
    names = ["conv", "conv_id", "call_id", *fields]
    spare = F.col("copies") - F.when(F.col("first"), 1).otherwise(0)
    further = told.where(spare > 0).select(*names, F.explode(F.sequence(F.lit(1).cast("long"), spare)).alias("copy"))
    return told.where("first").select(*names, "n"), further.select(*names)


def _call_message(result: Column) -> Column:
    return F.to_json(F.struct(
        F.coalesce(F.try_parse_json("arguments"), F.col("arguments").cast("variant")).alias("arguments"),
        F.col("call_id").alias("id"), "name", F.col("parent_id").alias("parent"), result.alias("result"),
    ))


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call id of a conversation, linked with its result, and one for each row that is not linked.

    ``calls`` has conv_id, call_id, parent_id, name and arguments (JSON text); ``results`` conv_id,
    call_id and content.
    """
    calls = calls.select(_conv(F.col("conv_id")).alias("conv"), "conv_id", "call_id", "parent_id", "name", "arguments")
    results = results.select(_conv(F.col("conv_id")).alias("conv"), "conv_id", "call_id", "content")
    nothing, said = F.lit(None).cast("string"), F.to_json(F.struct(F.col("call_id").alias("id"), F.col("content").alias("result")))
    nameless = calls.where("call_id is null").select("conv_id", "parent_id", "name", F.lit("call without id").alias("status"), _call_message(nothing).alias("message")).unionByName(
        results.where("call_id is null").select("conv_id", F.lit("result without id").alias("status"), said.alias("message")), allowMissingColumns=True
    )
    one, more_calls = _first_and_further(calls, ["parent_id", "name", "arguments"], "calls")
    answer, more_answers = _first_and_further(results, ["content"], "results")
    answers = answer.select(*_KEY, F.col("n").alias("n_results"), "content")
    linked = one.withColumnRenamed("n", "n_calls").join(answers, _KEY, "left").join(levels(one), _KEY, "left").join(argument_errors(one, schemas), _KEY, "left")
    status = F.when(F.col("level").isNull(), "cycle").when(F.col("n_results").isNull(), "no result").when(F.col("errors").isNotNull(), "invalid").otherwise("ok")
    done = linked.withColumns({"message": _call_message(F.col("content")), "status": status, "errors": F.coalesce("errors", F.lit(""))})
    orphans = answer.join(one.select(*_KEY), _KEY, "left_anti").select(
        "conv_id", "call_id", F.col("n").alias("n_results"), F.lit("no call").alias("status"), said.alias("message")
    )
    duplicate = F.lit("duplicate").alias("status")
    spare = more_calls.select("conv_id", "call_id", "parent_id", "name", duplicate, _call_message(nothing).alias("message")).unionByName(
        more_answers.select("conv_id", "call_id", duplicate, said.alias("message")), allowMissingColumns=True
    )
    whole = done.select(*_OUT)
    for part in (orphans, nameless, spare):
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole.select(*_OUT)


def in_order(linked: DataFrame) -> DataFrame:
    """The rows of ``link`` by conversation, level and id; rows without a level stand last in theirs."""
    return linked.orderBy("conv_id", F.asc_nulls_last("level"), "call_id", "message")
