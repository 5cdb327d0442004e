"""Tool-call linking (operator 3).

Calls and results are hash-joined by (conversation, call id).  A call that
waits for others names them.  Every call gets its level, the longest way to a
call that waits for none: chains of calls with one dependency are followed by
doubled pointers, and calls with several are placed by Kahn's rounds on what
the chains leave (what is left over is a cycle).  (level, seq) is a topological
order.  Arguments are parsed as JSON and checked against the tool's schema,
one row per declared argument.
The linked call is serialised as canonical JSON: keys sorted, no blanks.

All of it is DataFrame operations; nothing is gathered per conversation, so
a conversation of any length is fine.

Columns: calls have conv_id, call_id, seq, tool, arguments (JSON text) and
waits_for (array of call ids); results have conv_id, call_id, seq and output;
schemas have tool, argument, kind (a JSON type, see ``KINDS``), required,
and least and most (of a number, or a text's length; null: no bound).

Statuses of a call: ok, no_result (nothing answers), repeated_result (the
earliest one, then the smallest, is linked), and repeated_call for every call
of an id but the earliest (ties: smallest arguments); results that answer no
call are returned as orphan_result rows.  A null id is never linked: a call
is no_result, a result an orphan.  Rows that repeat entirely count once.
Null or malformed arguments are the error not_an_object.  Unknown tools have
the error unknown_tool; errors are sorted and joined by commas.  A call that
waits for an unknown id has the error unknown_dependency and is ordered as
if it did not wait.  Calls on a cycle have level null and the error cycle.
Empty inputs give empty results; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

# JSON type by the name that Spark gives a variant's type
KINDS = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN"}

CALLS = "conv_id long, call_id string, seq long, tool string, arguments string, waits_for array<string>"
SCHEMAS = "tool string, argument string, kind string, required boolean, least double, most double"


def _kind_is(value: Column, kind: Column) -> Column:
    """Whether a variant has the JSON type."""
    name = F.schema_of_variant(value)
    number = name.isin("BIGINT", "DOUBLE", "FLOAT") | name.startswith("DECIMAL")
    return (F.when(kind == "number", number).when(kind == "array", name.startswith("ARRAY"))
            .when(kind == "object", name.startswith("OBJECT")).when(kind == "string", name == "STRING")
            .when(kind == "integer", (name == "BIGINT") | name.rlike(r"^DECIMAL\(\d+,0\)$"))
            .when(kind == "boolean", name == "BOOLEAN").otherwise(F.lit(False)))


def validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """Adds ``errors``: sorted distinct problems of each call's arguments.

    A call's declared arguments are looked up in an array of its tool's
    schema; the schemas are one row per tool (a declared, bounded list).
    """
    tools = schemas.groupBy(F.col("tool").alias("__tool")).agg(F.sort_array(F.collect_set(
        F.struct("argument", "kind", "required", "least", "most"))).alias("__fields"))
    parsed = calls.join(tools, F.col("tool") == F.col("__tool"), "left").withColumn("__v", F.try_parse_json("arguments"))
    is_object = F.coalesce(F.schema_of_variant("__v").startswith("OBJECT"), F.lit(False))
    # the whole value of each key, as JSON text; declared keys are few
    keys = F.coalesce(F.json_object_keys("arguments"), F.array().cast("array<string>"))
    values = F.from_json("arguments", "map<string,variant>")

    def problem(f):
        value = F.element_at(F.col("__map"), f["argument"])
        there = F.array_contains(F.col("__keys"), f["argument"])
        size = F.when(f["kind"] == "string", F.length(F.try_variant_get(value, "$", "string")).cast("double")).otherwise(
            F.try_variant_get(value, "$", "double"))
        return (F.when(~there, F.when(f["required"], F.concat(F.lit("missing:"), f["argument"])))
                .when(~F.coalesce(_kind_is(value, f["kind"]), F.lit(False)), F.concat(F.lit("type:"), f["argument"]))
                .when((size < f["least"]) | (size > f["most"]), F.concat(F.lit("range:"), f["argument"])))

    parsed = parsed.withColumns({"__keys": F.when(is_object, keys), "__map": F.when(is_object, values)})
    wrong = F.filter(F.transform("__fields", problem), lambda e: e.isNotNull())
    extra = F.transform(F.array_except("__keys", F.transform("__fields", lambda f: f["argument"])),
                        lambda k: F.concat(F.lit("undeclared:"), k))
    errors = (F.when(~is_object, F.array(F.lit("not_an_object"))).when(F.col("__fields").isNull(), F.array(F.lit("unknown_tool")))
              .otherwise(F.sort_array(F.array_distinct(F.concat(wrong, extra)))))
    return parsed.withColumn("errors", errors).withColumn("canonical", F.when(is_object, F.to_json("__v"))).drop(
        "__tool", "__fields", "__v", "__keys", "__map")


def chains(single: DataFrame) -> DataFrame:
    """Follows each call with one dependency (conv_id, call_id, to) to the end of its chain.

    Returns conv_id, call_id, to, dist and open: ``to`` is the first call on
    the way that waits for none or several, ``dist`` steps off.  Pointers are
    doubled, so a chain of n calls takes about log2(n) rounds.  A round that
    closes no pointer has only those left that run into a cycle: they stay open.
    """
    inner = single.select("conv_id", F.col("call_id").alias("to"), F.lit(True).alias("open"))
    point = single.select("conv_id", "call_id", "to", F.lit(1).cast("long").alias("dist")).join(inner, ["conv_id", "to"], "left")
    point = C.written(point.withColumn("open", F.coalesce("open", F.lit(False))), "chains")
    left = point.where("open").count()
    while left:
        step = point.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("__to"), F.col("dist").alias("__dist"),
                            F.col("open").alias("__open"))
        moved = point.where("open").join(step, ["conv_id", "to"]).select(
            "conv_id", "call_id", F.col("__to").alias("to"), (F.col("dist") + F.col("__dist")).alias("dist"), F.col("__open").alias("open"))
        point = C.written(point.where("not open").unionByName(moved), "chains")
        still = point.where("open").count()
        if still == left:
            break
        left = still
    return point


def joints(edges: DataFrame, waits: DataFrame, point: DataFrame) -> DataFrame:
    """conv_id, call_id, level of the calls with several dependencies, by Kahn's rounds among them.

    Chains between them are one step each; the level is null on or behind a cycle.
    """
    several = waits.where("n > 1").select("conv_id", "call_id")
    shut = point.where("not open").select("conv_id", F.col("call_id").alias("on"), "to", "dist")
    todo = edges.join(several, ["conv_id", "call_id"], "left_semi").join(shut, ["conv_id", "on"], "left").select(
        "conv_id", "call_id", F.coalesce("to", "on").alias("root"), (F.coalesce("dist", F.lit(0)) + 1).alias("plus"))
    waiting = waits.select("conv_id", F.col("call_id").alias("root"), F.lit(True).alias("waiting"))
    todo = C.written(todo.join(waiting, ["conv_id", "root"], "left").select(
        "conv_id", "call_id", "root", "plus", F.when(F.col("waiting").isNull(), F.lit(0).cast("long")).alias("at")), "joints")
    out = None
    while True:
        ready = todo.groupBy("conv_id", "call_id").agg(F.max(F.col("at") + F.col("plus")).alias("level"),
                                                       F.count_if(F.col("at").isNull()).alias("missing"))
        ready = C.written(ready.where("missing = 0").drop("missing"), "ready")
        if ready.isEmpty():
            break
        out = ready if out is None else out.unionByName(ready)
        known = ready.select("conv_id", F.col("call_id").alias("root"), "level")
        todo = todo.join(ready, ["conv_id", "call_id"], "left_anti").join(known, ["conv_id", "root"], "left")
        todo = C.written(todo.select("conv_id", "call_id", "root", "plus", F.coalesce("at", "level").alias("at")), "joints")
    cyclic = todo.select("conv_id", "call_id").distinct().withColumn("level", F.lit(None).cast("long"))
    return cyclic if out is None else out.unionByName(cyclic)


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level, unknown (a dependency that is no call).

    ``level`` is 0 for a call that waits for none, else one more than the
    greatest level it waits for; null on (or behind) a cycle.
    """
    named = "conv_id is not null and call_id is not null"
    node = calls.where(named).select("conv_id", "call_id")
    edges = calls.where(named).select("conv_id", "call_id", F.explode("waits_for").alias("on")).distinct()
    there = node.select("conv_id", F.col("call_id").alias("on"), F.lit(True).alias("found"))
    edges = C.written(edges.join(there, ["conv_id", "on"], "left"), "call-edges")
    unknown = edges.where("found is null").select("conv_id", "call_id").distinct().withColumn("unknown", F.lit(True))
    edges = edges.where("found").select("conv_id", "call_id", "on")
    waits = C.written(edges.groupBy("conv_id", "call_id").agg(F.count("*").alias("n"), F.min("on").alias("to")), "waits")
    point = chains(waits.where("n = 1"))
    placed = point.select("conv_id", "call_id", F.when(~F.col("open"), F.col("dist")).alias("level"))
    if not waits.where("n > 1").isEmpty():
        several = C.written(joints(edges, waits, point), "several")
        ends = several.select("conv_id", F.col("call_id").alias("to"), F.col("level").alias("end"), F.lit(True).alias("several"))
        behind = F.when(F.col("several"), F.col("end")).otherwise(F.lit(0)) + F.col("dist")
        placed = point.join(ends, ["conv_id", "to"], "left").select(
            "conv_id", "call_id", F.when(~F.col("open"), behind).alias("level")).unionByName(several)
    out = node.join(placed.withColumn("waits", F.lit(True)), ["conv_id", "call_id"], "left")
    return out.select("conv_id", "call_id", F.when(F.col("waits"), F.col("level")).otherwise(F.lit(0)).cast("int").alias("level")).join(
        unknown, ["conv_id", "call_id"], "left")


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv_id, call_id, level, seq, status, n_results, errors and json of every call and orphan result."""
    calls = calls.select("conv_id", "call_id", "seq", "tool", "arguments", "waits_for").distinct()
    results = results.select("conv_id", "call_id", "seq", "output").distinct()
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    # one call an id and one result: grouped minima, summed before the shuffle
    first = calls.where(named).groupBy("conv_id", "call_id").agg(
        F.min(F.struct("seq", "arguments", "tool", "waits_for")).alias("c"))
    first = C.written(first.select("conv_id", "call_id", "c.*"), "calls")
    again = calls.where(named).join(first.select("conv_id", "call_id", "seq", "arguments", "tool", "waits_for", F.lit(True).alias("__first")),
                                    [(calls[k].eqNullSafe(first[k])) for k in ("conv_id", "call_id", "seq", "arguments", "tool", "waits_for")],
                                    "left_anti")
    answer = results.where(named).groupBy("conv_id", "call_id").agg(
        F.min(F.struct("seq", "output")).alias("r"), F.count("*").alias("n_results"))
    order = levels(first)
    linked = first.join(answer, ["conv_id", "call_id"], "left").join(order, ["conv_id", "call_id"], "left")
    status = F.when(F.col("n_results").isNull(), "no_result").when(F.col("n_results") > 1, "repeated_result").otherwise("ok")
    nothing = F.lit(None).cast("int")
    linked = linked.withColumn("status", status)
    plain = again.unionByName(calls.where(~named)).withColumns({
        "r": F.lit(None).cast(answer.schema["r"].dataType), "n_results": F.lit(None).cast("long"), "level": nothing,
        "unknown": F.lit(None).cast("boolean"), "status": F.when(named, F.lit("repeated_call")).otherwise(F.lit("no_result"))})
    rows = validated(linked.unionByName(plain), schemas)
    more = F.concat(F.when(F.col("unknown"), F.array(F.lit("unknown_dependency"))).otherwise(F.array().cast("array<string>")),
                    F.when(F.col("level").isNull() & (F.col("status") != "repeated_call") & named, F.array(F.lit("cycle"))).otherwise(
                        F.array().cast("array<string>")))
    rows = rows.withColumn("errors", F.array_join(F.sort_array(F.concat("errors", more)), ","))
    # to_json writes a struct's fields in their order and leaves nulls out
    head = F.struct(F.col("call_id").alias("id"), F.col("r.output").alias("output"), F.col("r.seq").alias("result_seq"),
                    F.col("seq"), F.col("status"), F.col("tool"))
    arguments = F.concat(F.lit('{"arguments":'), F.coalesce("canonical", F.lit("null")), F.lit(","))
    rows = rows.withColumn("json", F.concat(arguments, F.substr(F.to_json(head), F.lit(2))))
    orphans = results.join(first.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti")
    orphans = orphans.select("conv_id", "call_id", nothing.alias("level"), "seq", F.lit("orphan_result").alias("status"),
                             F.lit(None).cast("long").alias("n_results"), F.lit("").alias("errors"),
                             F.to_json(F.struct(F.col("call_id").alias("id"), "output", "seq", F.lit("orphan_result").alias("status"))).alias("json"))
    return rows.select("conv_id", "call_id", "level", "seq", "status", F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
                       "errors", "json").unionByName(orphans.withColumn("n_results", F.lit(0).cast("long")))


def exchanges(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain chats: a user's turn asks the tool ``reply``
    (a question mark: ``answer``), the assistant's next turn is its result,
    and a call waits for that of the user's turn before.
    """
    kept = messages.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    call_id = F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    user = kept.where("role = 'user'")
    before = user.select("conv_id", (F.col("turn") + 2).alias("turn"), F.lit(True).alias("__before")).distinct()
    tool = F.when(F.contains(F.col("text"), F.lit("?")), "answer").otherwise("reply")
    arguments = F.to_json(F.struct(F.col("turn"), F.col("text"), F.col("role")))
    earlier = F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), (F.col("turn") - 2).cast("string"))
    calls = user.join(before, ["conv_id", "turn"], "left").select(
        "conv_id", call_id.alias("call_id"), F.col("turn").alias("seq"), tool.alias("tool"), arguments.alias("arguments"),
        F.when(F.col("__before"), F.array(earlier)).otherwise(F.array().cast("array<string>")).alias("waits_for"))
    asked = F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string"))
    results = kept.where("role = 'assistant'").select("conv_id", asked.alias("call_id"), F.col("turn").alias("seq"),
                                                      F.col("text").alias("output"))
    return calls, results
