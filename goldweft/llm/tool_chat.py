"""Chat formatting: links tool calls to their results and writes canonical JSON.

Calls and results are joined by identifier, calls get their place in the topological order
of what they build on, arguments are validated against their tool's schema, and each call
becomes one canonical JSON text: keys in order, no spaces, numbers in one form.  Nothing is
collected by conversation, so a conversation may have any number of turns.

DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldweft.llm.common import count_words, stage

#: Schemas of the tools that calls may name: of each argument its JSON type and whether a
#: call must have it.  A call with any other argument is not valid.
TOOLS = {
    "ask": {"query": ("STRING", True), "words": ("BIGINT", True)},
    "follow_up": {"after": ("STRING", True), "query": ("STRING", True), "words": ("BIGINT", True)},
}
#: Turns of a conversation that are looked through at once for the user turn before.
STRETCH = 256


def from_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations (conv_id, turn, role, text).

    Every user turn is a call, named ``conversation.turn``.  It builds on the user turn
    before it, if there is one (tool ``follow_up``, else ``ask``).  An assistant turn is a
    result of the last user turn before it; without one it is a result of no call (null).
    Turns of other roles are left to :func:`context`.
    Rows without conv_id or turn take no part; of several rows of one turn and role, the
    greatest text counts.
    """
    known = (
        turns.filter("conv_id IS NOT NULL AND turn IS NOT NULL AND role IN ('user', 'assistant')")
        .groupBy(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), "role")
        .agg(F.max("text").alias("text"))
        .withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    )
    # The last user turn before: within a stretch of turns, else the last one of the
    # stretches before, so that a long conversation is no single group.
    user = F.when(F.col("role") == "user", F.col("turn"))
    inner = Window.partitionBy("conv", "stretch").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        known.groupBy("conv", "stretch")
        .agg(F.max(user).alias("end"))
        .select("conv", "stretch", F.max("end").over(outer).alias("end"))
    )
    placed = (
        known.withColumn("near", F.max(user).over(inner))
        .join(ends, ["conv", "stretch"])
        .withColumn("last", F.coalesce("near", "end"))
    )
    name = lambda turn: F.concat_ws(".", F.col("conv").cast("string"), turn.cast("string"))
    before = F.when(F.col("last").isNotNull(), name(F.col("last")))
    calls = placed.filter("role = 'user'").select(
        "conv",
        name(F.col("turn")).alias("call"),
        F.col("turn").alias("place"),
        F.when(before.isNull(), "ask").otherwise("follow_up").alias("tool"),
        F.to_json(
            F.struct(before.alias("after"), F.col("text").alias("query"), count_words("text").alias("words"))
        ).alias("arguments"),
        F.array_compact(F.array(before)).alias("needs"),
    )
    results = placed.filter("role = 'assistant'").select(
        "conv", before.alias("call"), F.col("turn").alias("place"), F.col("text").alias("content")
    )
    return calls, results


def context(turns: DataFrame) -> DataFrame:
    """conv, place, role and content of the turns that are neither user's nor assistant's
    (system prompts, unknown and null roles).  Rows without conv_id or turn take no part; of
    several rows of one turn and role, the greatest text counts."""
    return (
        turns.filter("conv_id IS NOT NULL AND turn IS NOT NULL AND coalesce(role NOT IN ('user', 'assistant'), true)")
        .groupBy(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("place"), "role")
        .agg(F.max("text").alias("content"))
    )


def valid(tool: Column, arguments: Column) -> Column:
    """Whether ``arguments`` (a variant) is an object that fits the schema of ``tool``:
    required arguments present, types as given, strings not blank, numbers above 0, nothing
    else.  Never null; false for an unknown tool or text that is no JSON."""
    fits = F.lit(False)
    names = F.json_object_keys(F.to_json(arguments))
    for name, schema in TOOLS.items():
        rule = F.size(F.array_except(names, F.array(*map(F.lit, schema)))) == 0
        for field, (kind, required) in schema.items():
            value = F.try_variant_get(arguments, f"$.{field}", "variant")
            there = F.array_contains(names, field)
            if kind == "STRING":
                right = F.trim(F.try_variant_get(arguments, f"$.{field}", "string")) != ""
            else:
                right = F.try_variant_get(arguments, f"$.{field}", "bigint") > 0
            right = (F.schema_of_variant(value) == kind) & right
            rule &= F.when(there, F.coalesce(right, F.lit(False))).otherwise(F.lit(not required))
        fits |= F.coalesce((tool == name) & rule, F.lit(False))
    return fits


def depths(calls: DataFrame) -> DataFrame:
    """conv, call and depth of every call: 0 if it needs no other, else one more than the
    deepest call it needs.  Null for calls in a circle or behind one.  Needs that are no
    call of the same conversation, and repeated ones, are ignored.

    Each round a call whose needs have depths gets its own, and a need that itself has a
    single need is replaced by that, with the distance added: chains halve every round.
    """
    ids = calls.select("conv", "call").distinct()
    edges = (
        calls.select("conv", "call", F.explode("needs").alias("need"))
        .distinct()
        .join(ids.withColumnRenamed("call", "need"), ["conv", "need"])
    )
    state = ids.join(
        edges.groupBy("conv", "call").agg(
            F.collect_list(F.struct("need", F.lit(1).cast("long").alias("far"), F.lit(None).cast("long").alias("depth"))).alias("needs")
        ),
        ["conv", "call"],
        "left",
    ).select("conv", "call", "needs", F.when(F.col("needs").isNull(), F.lit(0).cast("long")).alias("depth"))
    state = stage(state, "depths")
    open_, idle = state.filter("depth IS NULL").count(), 0
    # In a circle nothing is ever settled; a chain of n calls takes log2(n) rounds to be.
    while open_ and idle <= math.log2(open_) + 1:
        wanted = state.filter("depth IS NULL").select("conv", "call", F.explode("needs").alias("n"))
        target = state.select("conv", F.col("call").alias("need"), F.col("depth").alias("known"), F.col("needs").alias("next"))
        jumped = wanted.select("conv", "call", "n.*").join(target, ["conv", "need"])
        single = F.col("known").isNull() & F.col("depth").isNull() & (F.size("next") == 1)
        step = F.when(single, F.struct(
            F.col("next")[0]["need"].alias("need"),
            (F.col("far") + F.col("next")[0]["far"]).alias("far"),
            F.lit(None).cast("long").alias("depth"),
        )).otherwise(F.struct("need", "far", F.coalesce("depth", F.col("known") + F.col("far")).alias("depth")))
        moved = (
            jumped.select("conv", "call", step.alias("n"))
            .groupBy("conv", "call")
            .agg(
                F.collect_list("n").alias("needs"),
                F.when(F.count("*") == F.count("n.depth"), F.max("n.depth")).alias("depth"),
            )
        )
        state = stage(state.filter("depth IS NOT NULL").unionByName(moved), "depths")
        left = state.filter("depth IS NULL").count()
        idle = idle + 1 if left == open_ else 0
        open_ = left
    return state.select("conv", "call", "depth")


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """One row per call: conv, call, place, depth, valid, n_results and json.

    ``calls``: conv, call, place, tool, arguments (JSON text), needs (array of calls);
    ``results``: conv, call, place, content.  (depth, place, call) is a topological order of
    a conversation's calls.  Of several results of a call the first (smallest place, then
    content) is linked, n_results counts them all; results of unknown calls are dropped.
    Arguments that are no JSON are written as null and are not valid.  Calls without conv or
    call are dropped; of repeated calls the first (smallest place, tool, arguments) counts.
    Null contents are written as null.  Empty tables give no rows.
    """
    first = (
        calls.filter("conv IS NOT NULL AND call IS NOT NULL")
        .groupBy("conv", "call")
        .agg(F.min(F.struct("place", "tool", "arguments", "needs")).alias("c"))
        .select("conv", "call", "c.*")
    )
    first = stage(first, "calls")
    answers = (
        results.filter("conv IS NOT NULL AND call IS NOT NULL")
        .groupBy("conv", "call")
        .agg(F.min(F.struct("place", "content")).alias("r"), F.count("*").alias("n_results"))
    )
    arguments = F.try_parse_json("arguments")
    linked = (
        first.join(depths(first), ["conv", "call"])
        .join(answers, ["conv", "call"], "left")
        .withColumn("parsed", arguments)
        .withColumn("valid", valid(F.col("tool"), F.col("parsed")))
        .withColumn("n_results", F.coalesce("n_results", F.lit(0).cast("long")))
    )
    # Keys in alphabetical order; a variant keeps its own keys sorted.
    body = F.struct(
        F.col("parsed").alias("arguments"), "call", "depth", F.col("r.content").alias("result"), "tool", "valid"
    )
    text = F.to_json(body, {"ignoreNullFields": "false"})
    return linked.select("conv", "call", "place", "depth", "valid", "n_results", text.alias("json"))


def format_chat(calls: DataFrame, results: DataFrame, notes: DataFrame) -> DataFrame:
    """Everything that was said, one row a message: the columns of :func:`link` and status.

    ``call``: a row of :func:`link`, with its first result.  ``result``: a further result of
    a call, ``orphan``: a result of no call or of an unknown one, both with the call's name
    and the content; ``context``: a row of ``notes`` (conv, place, role, content).  depth,
    valid and n_results are null but for calls.  Results are rows of their own, so a call may
    have any number of them; (place, status) puts a conversation in order.  Results that
    repeat their call's first one word for word at the same place are not written again.
    Rows without conv take no part.  Empty tables give no rows.
    """
    known = results.filter("conv IS NOT NULL")
    heads = known.filter("call IS NOT NULL").groupBy("conv", "call").agg(F.min(F.struct("place", "content")).alias("head"))
    names = calls.filter("conv IS NOT NULL AND call IS NOT NULL").select("conv", "call", F.lit(True).alias("there")).distinct()
    further = (
        known.join(names, ["conv", "call"], "left")
        .join(heads, ["conv", "call"], "left")
        .filter(F.col("there").isNull() | ~F.struct("place", "content").eqNullSafe(F.col("head")))
        .withColumn("status", F.when(F.col("there"), "result").otherwise("orphan"))
    )
    keep_nulls = {"ignoreNullFields": "false"}
    row = lambda call, text: [
        "conv", call.alias("call"), "place", F.lit(None).cast("long").alias("depth"), F.lit(None).cast("boolean").alias("valid"),
        F.lit(None).cast("long").alias("n_results"), text.alias("json"), "status",
    ]
    further = further.select(*row(F.col("call"), F.to_json(F.struct("call", "content", "status"), keep_nulls)))
    notes = notes.filter("conv IS NOT NULL").withColumn("status", F.lit("context"))
    notes = notes.select(*row(F.lit(None).cast("string"), F.to_json(F.struct("content", "role", "status"), keep_nulls)))
    return link(calls, results).withColumn("status", F.lit("call")).unionByName(further).unionByName(notes)
