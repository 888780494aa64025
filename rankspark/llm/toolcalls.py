"""Tool-call linking: join, order, validate, serialise. DataFrame functions only.

Calls and results are joined by (conversation, identifier).  Calls are
ordered by their dependencies: level 0 depends on no known call, others have
the longest path down to one as their level, so (level, turn, call_id) is a
topological order.  Arguments (JSON) are parsed to variants and checked
against schemas by their exploded fields: unknown, missing and wrongly typed
parameters are listed.  Every call becomes one line of canonical JSON: keys
in order, no white space, the same text for equal values.

Levels come by rounds of joins on the dependency edges alone.  An edge to a
call with a single edge is replaced by the edge beyond it with the lengths
added, so a chain of n calls takes log2(n) rounds; a round that settles no
call leaves cycles, whose calls (and those depending on them) get a null
level and the error ``cycle``.  No conversation is gathered in one task:
everything is a join or a grouped sum by call, however long it is.

Calls and results without a conversation or an identifier take no part.  Of
repeated calls the least (turn, name, arguments) counts, of repeated results
the least (turn, content).  Results without a call and calls without a result
are kept; a dependency on an unknown call is ignored.  Null or malformed
arguments give the error ``arguments: not a JSON object``; calls of a name
without schema the error ``name: no schema``.  Empty tables give an empty
result; extra columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankspark.llm.common import stored

KEY = ["conv_id", "call_id"]


def levels(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """``calls(conv_id, call_id)``, ``edges(conv_id, call_id, dep)`` -> calls with ``level`` (null: in or behind a cycle)."""
    known = edges.join(calls.select("conv_id", F.col("call_id").alias("dep")), ["conv_id", "dep"], "left_semi") \
        .join(calls, KEY, "left_semi").distinct()
    # an edge says: level >= level(dep) + length; base: what settled edges say
    open_ = stored(known.select(*KEY, "dep", F.lit(1).alias("length")), "edges")
    base = stored(calls.join(known.select(*KEY).distinct(), KEY, "left_anti").select(*KEY, F.lit(0).alias("level")), "levels")
    done, floors, settled = [base], None, base
    while not open_.isEmpty():
        many = open_.groupBy(*KEY).agg(F.count("*").alias("n"), F.min(F.struct("dep", "length")).alias("one"))
        of = many.select("conv_id", F.col("call_id").alias("dep"), F.lit(None).cast("int").alias("at"), "n", "one") \
            .union(settled.select("conv_id", F.col("call_id").alias("dep"), F.col("level").alias("at"), F.lit(0).cast("long"),
                                  F.lit(None).cast(many.schema["one"].dataType)))
        seen = stored(open_.join(of, ["conv_id", "dep"], "left"), "seen")
        fixed = seen.where("at is not null").groupBy(*KEY).agg(F.max(F.col("at") + F.col("length")).alias("floor"))
        floors = fixed if floors is None else floors.union(fixed).groupBy(*KEY).agg(F.max("floor").alias("floor"))
        floors = stored(floors, "floors")
        step = F.when((F.col("n") == 1) & (F.col("one.dep") != F.col("dep")), F.col("one"))
        open_ = stored(seen.where("at is null").select(*KEY, F.coalesce(step["dep"], F.col("dep")).alias("dep"),
                                                       (F.col("length") + F.coalesce(step["length"], F.lit(0))).alias("length"))
                       .groupBy(*KEY, "dep").agg(F.max("length").alias("length")), "edges")
        # settled now: calls without an open edge, unless settled before
        now = stored(fixed.select(*KEY).distinct().join(open_, KEY, "left_anti").join(floors, KEY).select(*KEY, F.col("floor").alias("level")), "levels")
        if now.isEmpty():
            break
        done.append(now)
        # edges that replaced others can point at any settled call
        settled = stored(settled.union(now), "settled")
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return calls.join(out, KEY, "left")


def violations(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls(conv_id, call_id, name, args variant)`` -> their sorted ``errors``.

    ``schemas(name, parameter, type, required)``: types are string, integer, number, boolean, object, array.
    """
    spark = calls.sparkSession
    # the schema table is joined like any other; adaptive execution broadcasts it where it is small
    names = schemas.select("name").distinct()
    plain = F.schema_of_variant("args").startswith("OBJECT")
    whole = calls.where("args is not null").where(plain)
    bad = calls.join(whole.select(*KEY), KEY, "left_anti").select(*KEY, F.lit("arguments: not a JSON object").alias("error"))
    nameless = calls.join(names, "name", "left_anti").select(*KEY, F.lit("name: no schema").alias("error"))
    known = whole.join(names, "name", "left_semi")
    fields = known.lateralJoin(spark.tvf.variant_explode(F.col("args").outer())) \
        .select(*KEY, "name", F.col("key").alias("parameter"), _kind(F.schema_of_variant("value")).alias("kind"))
    wanted = schemas.select("name", "parameter", F.col("type").alias("wanted"), "required")
    met = fields.join(wanted, ["name", "parameter"], "left")
    fits = (F.col("kind") == F.col("wanted")) | ((F.col("wanted") == "number") & (F.col("kind") == "integer"))
    wrong = met.select(*KEY, F.when(F.col("wanted").isNull(), F.concat("parameter", F.lit(": unknown parameter")))
                       .when(~fits, F.concat("parameter", F.lit(": "), "kind", F.lit(" instead of "), "wanted")).alias("error")).where("error is not null")
    missing = known.select(*KEY, "name").join(wanted.where("required"), "name").join(fields.select(*KEY, "parameter"), [*KEY, "parameter"], "left_anti") \
        .select(*KEY, F.concat("parameter", F.lit(": missing")).alias("error"))
    # a call's errors are as many as its own and its schema's parameters
    return bad.union(nameless).union(wrong).union(missing).groupBy(*KEY).agg(F.sort_array(F.collect_set("error")).alias("errors"))


def _kind(schema: Column) -> Column:
    return F.when(schema == "BIGINT", "integer").when(schema.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "number").when(schema == "STRING", "string") \
        .when(schema == "BOOLEAN", "boolean").when(schema.startswith("ARRAY"), "array").when(schema.startswith("OBJECT"), "object").otherwise("null")


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row for each call, and for each result without a call.

    ``calls(conv_id, call_id, turn, name, arguments, depends_on array<string>)``,
    ``results(conv_id, call_id, turn, content)`` -> ``conv_id, call_id, turn, level, linked, valid, errors, canonical``.
    """
    has_id = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    once = stored(calls.where(has_id).groupBy(*KEY).agg(F.min(F.struct("turn", "name", "arguments", "depends_on")).alias("c"))
                  .select(*KEY, "c.*").withColumn("args", F.try_parse_json("arguments")), "calls")
    answers = results.where(has_id).groupBy(*KEY).agg(F.min(F.struct("turn", "content")).alias("r")) \
        .select(*KEY, F.lit(True).alias("linked"), F.col("r.turn").alias("result_turn"), F.col("r.content").alias("content"))
    edges = once.select(*KEY, F.explode("depends_on").alias("dep")).where("dep is not null")
    placed = levels(once.select(*KEY), edges)
    errors = violations(once.select(*KEY, "name", "args"), schemas)
    met = once.withColumn("called", F.lit(True)).join(placed, KEY, "left").join(errors, KEY, "left").join(answers, KEY, "full_outer")
    called = F.coalesce("called", F.lit(False))
    found = F.sort_array(F.array_compact(F.concat(
        F.coalesce("errors", F.array().cast("array<string>")),
        F.array(F.when(called & F.col("level").isNull(), F.lit("cycle")), F.when(~called, F.lit("result: no call")),
                F.when(called & F.col("linked").isNull(), F.lit("result: missing"))))))
    line = F.to_json(F.struct(
        F.col("args").alias("arguments"), "call_id", "conv_id", F.sort_array("depends_on").alias("depends_on"),
        F.col("found").alias("errors"), "level", "name", F.col("content").alias("result"), F.coalesce("turn", "result_turn").alias("turn")))
    return met.withColumn("found", found).select(
        *KEY, F.coalesce("turn", "result_turn").alias("turn"), "level", (called & F.coalesce("linked", F.lit(False))).alias("linked"),
        (F.size(F.filter("found", lambda e: e != "result: missing")) == 0).alias("valid"), F.col("found").alias("errors"), line.alias("canonical"))


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of a chat table ``(conv_id, turn, role, text)``.

    A user turn calls ``reply`` and a system turn ``configure``; an assistant turn is the result of the turn before.  A call
    depends on the calls one and two turns before.
    """
    name = lambda back: F.concat(F.col("conv_id").cast("string"), F.lit(":"), (F.col("turn") - back).cast("string"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.col("text").cast("string").alias("text"))
    arguments = F.when(F.col("role") == "user", F.to_json(F.struct(F.col("text").alias("prompt"), "turn"))) \
        .otherwise(F.to_json(F.struct(F.col("text").alias("instructions"))))
    calls = rows.where(F.col("role").isin("user", "system")).select(
        "conv_id", name(0).alias("call_id"), "turn", F.when(F.col("role") == "user", "reply").otherwise("configure").alias("name"),
        arguments.alias("arguments"), F.array(name(1), name(2)).alias("depends_on"))
    results = rows.where(F.col("role") == "assistant").select("conv_id", name(1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


# What the calls of a chat table take.
CHAT_SCHEMAS = [("reply", "prompt", "string", True), ("reply", "turn", "integer", True), ("configure", "instructions", "string", True)]
SCHEMA = "name string, parameter string, type string, required boolean"
