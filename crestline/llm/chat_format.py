"""Chat formatting with tool-call linking.

Messages whose text is an envelope are unfolded: an assistant's
``{"content": ..., "tool_calls": [{"id", "name", "arguments"}]}`` and a tool's
``{"tool_call_id": ..., "content": ...}``. Calls and results are hash-joined by
conversation and identifier. Arguments are checked against the tools' schemas. A call
whose arguments name another call (``"$id"``) depends on that call's result; events are
put into an order that respects turns and dependencies. Every event becomes one line of
canonical JSON: keys sorted, no blanks, nulls written out.

Only DataFrame expressions are used. Lines stay rows; a conversation is never gathered
into one value nor ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crestline.llm.common import table, written
from crestline.operators.ordering import group_ordinal

CALLS = "content string, tool_calls array<struct<id:string, name:string, arguments:string>>"
RESULT = "tool_call_id string, content string"

#: turns of a conversation that one task numbers
SLICE = 64

#: JSON types and the variant types that satisfy them
TYPES = {
    "string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*", "boolean": "BOOLEAN",
    "array": "ARRAY.*", "object": "OBJECT.*",
}


def unfolded(messages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Plain messages, calls (``id, name, arguments, place``) and results (``id, content``) with their conv_id and turn."""
    role = F.coalesce("role", F.lit(""))
    made = messages.select(
        "conv_id", "turn", "role", "text",
        F.when(role == "assistant", F.from_json("text", CALLS, {"mode": "PERMISSIVE"})).alias("asked"),
        F.when(role == "tool", F.from_json("text", RESULT, {"mode": "PERMISSIVE"})).alias("told"),
    )
    asks = F.coalesce(F.size("asked.tool_calls") > 0, F.lit(False))
    calls = made.where(asks).select("conv_id", "turn", F.posexplode("asked.tool_calls").alias("place", "call")).select(
        "conv_id", "turn", "place", "call.id", "call.name", "call.arguments"
    )
    results = made.where("told.tool_call_id is not null").select(
        "conv_id", "turn", F.col("told.tool_call_id").alias("id"), F.col("told.content").alias("content")
    )
    plain = made.where("told.tool_call_id is null").select(
        "conv_id", "turn", "role", F.when(asks, F.col("asked.content")).otherwise(F.col("text")).alias("text")
    )
    return plain, calls, results


def problem(arguments: Column, name: Column, schemas: dict) -> Column:
    """What is wrong with a call, or null: ``unknown tool``, ``arguments``, ``missing x``, ``type of x``, ``extra``."""
    parsed = F.try_parse_json(arguments)
    checks = F.lit(None).cast("string")
    for tool, params in schemas.items():
        found = F.when(parsed.isNull() | ~F.schema_of_variant(parsed).startswith("OBJECT"), F.lit("arguments"))
        for param, (kind, required) in params.items():
            value = F.variant_get(parsed, f"$.{param}", "variant")
            absent = value.isNull() | (F.schema_of_variant(value) == "VOID")
            if required:
                found = found.when(absent, F.lit(f"missing {param}"))
            found = found.when(~absent & ~F.schema_of_variant(value).rlike(f"^({TYPES[kind]})$"), F.lit(f"type of {param}"))
        keys = F.json_object_keys(arguments)
        found = found.when(F.size(F.array_except(keys, F.array(*[F.lit(p) for p in params]))) > 0, F.lit("extra"))
        checks = F.when(name == tool, F.coalesce(found, F.lit(""))).otherwise(checks)
    return F.when(checks.isNull(), F.lit("unknown tool")).when(checks != "", checks)


def linked(calls: DataFrame, results: DataFrame, schemas: dict) -> tuple[DataFrame, DataFrame]:
    """Calls with ``status`` and the turn of their result; results with ``status``.

    The first call of an identifier and its first result are a pair. Calls: ``ok``,
    ``no result``, ``no id``, ``duplicate`` or what ``problem`` says. Results: ``ok``, ``orphan``, ``duplicate``.
    """
    by_id, span = ["conv_id", "id"], F.floor(F.col("turn") / SLICE)
    calls = group_ordinal(calls, by_id, ["turn", "place", "name", "arguments"], span, "rank", "n")
    results = group_ordinal(results, by_id, ["turn", "content"], span, "rank", "n")
    first_call = calls.where("rank = 1 and id is not null").select(F.col("conv_id").alias("c"), F.col("id").alias("i"), F.col("turn").alias("asked_at"))
    first_result = results.where("rank = 1").select(F.col("conv_id").alias("c"), F.col("id").alias("i"), F.col("turn").alias("told_at"))
    same = lambda x: x["conv_id"].eqNullSafe(F.col("c")) & (x["id"] == F.col("i"))
    wrong = problem(F.col("arguments"), F.col("name"), schemas)
    asked = calls.join(first_result, same(calls), "left").select(
        "conv_id", "turn", "place", "id", "name", "arguments", F.when(F.col("rank") == 1, F.col("told_at")).alias("told_at"),
        F.when(F.col("id").isNull(), F.lit("no id")).when(F.col("rank") > 1, F.lit("duplicate"))
        .when(wrong.isNotNull(), wrong).when(F.col("told_at").isNull(), F.lit("no result")).otherwise(F.lit("ok")).alias("status"),
    )
    told = results.join(first_call, same(results), "left").select(
        "conv_id", "turn", "id", "content", "asked_at",
        F.when(F.col("asked_at").isNull(), F.lit("orphan")).when(F.col("rank") > 1, F.lit("duplicate")).otherwise(F.lit("ok")).alias("status"),
    )
    return asked, told


def chased(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """``k, base, via, steps``: the call at the end of each call's chain of single needs, the latest end of those between, and how many
    needs away it is. A call without needs, or with several, is its own base; ``base`` is null if the chain never ends.

    Pointers are doubled: the number of rounds is the logarithm of the longest chain.
    """
    single = needs.groupBy("k").agg(F.count("*").alias("n"), F.first("need").alias("jump")).where("n = 1")
    at = written(
        calls.select("k", "own").join(single.select("k", "jump"), "k", "left")
        .withColumns({"via": F.lit(None).cast("bigint"), "steps": F.when(F.col("jump").isNull(), 0).otherwise(1).cast("bigint")}),
        "chat",
    )
    rounds, moving = at.where("jump is not null").count().bit_length() + 1, True
    while moving and rounds:
        ahead = at.where("jump is not null").select(
            F.col("k").alias("jump"), F.col("jump").alias("next"), F.greatest("own", "via").alias("more"), F.col("steps").alias("far")
        )
        at = written(
            at.join(ahead, "jump", "left").select(
                "k", "own", F.coalesce("next", "jump").alias("jump"), F.greatest("via", "more").alias("via"),
                (F.col("steps") + F.coalesce("far", F.lit(0))).alias("steps"), F.col("next").isNotNull().alias("moved"),
            ),
            "chat",
        )
        moving, rounds = at.where("moved").limit(1).count() > 0, rounds - 1
        at, last = at.drop("moved"), at
    endless = last.where("moved").select("k").withColumn("endless", F.lit(True)) if moving else None
    out = at.select("k", F.coalesce("jump", "k").alias("base"), "via", "steps")
    if endless is None:
        return out
    return out.join(endless, "k", "left").select("k", F.when(F.col("endless").isNull(), F.col("base")).alias("base"), "via", "steps")


def ordered(asked: DataFrame) -> DataFrame:
    """Calls with ``at`` (the turn at which they can run at the earliest) and ``depth`` (calls before them on a
    chain of dependencies); ``depth`` is null on a cycle or behind one, and ``at`` the call's own turn.

    Chains of single needs are settled by doubling. Calls with several needs are settled round by round, as many rounds as stand
    behind one another.
    """
    key = F.struct("conv_id", "id").alias("k")
    named = asked.where("id is not null and status <> 'duplicate'")
    calls = written(named.select(key, "turn", F.greatest("turn", F.coalesce("told_at", "turn")).alias("own")), "chat")
    asks = named.select(
        key, F.explode(F.array_distinct(F.regexp_extract_all("arguments", F.lit(r'"\$([^"]+)"'), F.lit(1)))).alias("id")
    ).select("k", F.struct(F.col("k.conv_id").alias("conv_id"), "id").alias("need"))
    needs = written(asks.join(calls.select(F.col("k").alias("need")), "need"), "chat")
    chains = chased(calls, needs)
    manifold = needs.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k")
    waiting = written(calls.join(manifold, "k"), "chat")
    done = calls.join(needs.select("k").distinct(), "k", "left_anti").select("k", F.col("turn").alias("at"), F.col("own").alias("end"), F.lit(0).cast("bigint").alias("depth"))
    # what each need of a waiting call leads to: the base of its chain, the latest end on the way, the steps to it
    own = calls.select(F.col("k").alias("need"), F.col("own").alias("o"))
    to = chains.withColumnRenamed("k", "need").join(own, "need").select(
        "need", "base", F.when(F.col("base") == F.col("need"), F.col("via")).otherwise(F.greatest("via", "o")).alias("via"), "steps"
    )
    edges = written(needs.join(manifold, "k").join(to, "need").select("k", "base", "via", "steps"), "chat")
    while waiting.limit(1).count():
        ready = (
            edges.join(waiting, "k").join(done.select(F.col("k").alias("base"), F.col("end").alias("b_end"), F.col("depth").alias("b_depth")), "base", "left")
            .groupBy("k").agg(
                F.first("turn").alias("turn"), F.first("own").alias("own"), F.bool_and(F.col("b_depth").isNotNull()).alias("all"),
                F.max(F.greatest("via", "b_end")).alias("after"), F.max(F.col("b_depth") + F.col("steps") + 1).alias("depth"),
            ).where("all")
            .select("k", F.greatest("turn", "after").alias("at"), F.greatest("own", "after").alias("end"), "depth")
        )
        ready = written(ready, "chat")
        if not ready.limit(1).count():  # what is left stands on cycles or behind them
            break
        waiting = written(waiting.join(ready.select("k"), "k", "left_anti"), "chat")
        done = written(done.union(ready), "chat")
    bases = done.select(F.col("k").alias("base"), F.col("at").alias("b_at"), F.col("end").alias("b_end"), F.col("depth").alias("b_depth"))
    found = calls.join(chains, "k").join(bases, "base", "left")
    settled = F.col("b_depth").isNotNull()
    return found.select(
        "k.conv_id", "k.id",
        F.when(settled & (F.col("steps") == 0), F.col("b_at")).when(settled, F.greatest("turn", "via", "b_end")).otherwise(F.col("turn")).alias("at"),
        (F.col("b_depth") + F.col("steps")).cast("int").alias("depth"),
    )


def canonical(**fields) -> Column:
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def format_chats(messages: DataFrame, schemas: dict) -> DataFrame:
    """``conv_id, seq, kind, turn, call_id, status, json``: one row per message, call and result.

    ``messages`` has ``conv_id, turn, role, text``; other columns are not read. ``seq``
    counts from 0 within the conversation. Null and empty texts are messages with null or
    empty content; a null role or turn is written as null, null turns come first; a null
    conversation is one of its own. Repeated messages are kept as repeated lines; repeated
    calls and results are kept and marked. Arguments that are no JSON object are kept as
    text. An empty table gives an empty result.
    """
    plain, calls, results = unfolded(messages.select("conv_id", "turn", "role", "text"))
    asked, told = linked(calls, results, schemas)
    asked = written(asked, "chat")
    times = ordered(asked)
    a, t = asked.alias("a"), times.alias("t")
    here = (F.col("a.conv_id").eqNullSafe(F.col("t.conv_id"))) & (F.col("a.id") == F.col("t.id")) & (F.col("a.status") != "duplicate")
    parsed = F.try_parse_json(F.col("a.arguments"))
    lines_of_calls = a.join(t, here, "left").select(
        "a.conv_id", "a.turn", F.lit("call").alias("kind"), F.col("a.id").alias("call_id"),
        F.when(F.col("t.id").isNotNull() & F.col("t.depth").isNull(), F.lit("cycle")).otherwise(F.col("a.status")).alias("status"),
        canonical(
            type=F.lit("call"), id=F.col("a.id"), name=F.col("a.name"),
            arguments=F.coalesce(parsed, F.col("a.arguments").cast("variant")), turn=F.col("a.turn"),
        ).alias("json"),
        F.coalesce("t.at", "a.turn").alias("at"), F.coalesce("t.depth", F.lit(0)).alias("depth"), F.lit(1).alias("step"), F.col("a.place").alias("place"),
    )
    r, t = told.alias("r"), times.alias("t")
    ends = r.join(t, F.col("r.conv_id").eqNullSafe(F.col("t.conv_id")) & (F.col("r.id") == F.col("t.id")), "left")
    lines_of_results = ends.select(
        "r.conv_id", "r.turn", F.lit("result").alias("kind"), F.col("r.id").alias("call_id"), F.col("r.status").alias("status"),
        canonical(type=F.lit("result"), id=F.col("r.id"), content=F.col("r.content"), turn=F.col("r.turn")).alias("json"),
        F.greatest("r.turn", "t.at").alias("at"), F.coalesce("t.depth", F.lit(0)).alias("depth"), F.lit(2).alias("step"), F.lit(0).alias("place"),
    )
    lines = plain.select(
        "conv_id", "turn", F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"), F.lit("ok").alias("status"),
        canonical(type=F.lit("message"), role=F.col("role"), content=F.col("text"), turn=F.col("turn")).alias("json"),
        F.col("turn").alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("step"), F.lit(0).alias("place"),
    )
    order = ["at", "depth", "step", "turn", "place", "call_id", "json"]
    # a long conversation is numbered in parts: by turns, and without any by what else orders its lines
    timeless = F.when(F.col("at").isNull(), F.struct("depth", "step", "place", "call_id", F.substring("json", 1, 64).alias("json")))
    part = F.struct(F.floor(F.col("at") / SLICE).alias("turns"), timeless.alias("rest"))
    numbered = group_ordinal(lines.union(lines_of_calls).union(lines_of_results), ["conv_id"], order, part, "seq", "n")
    return numbered.select("conv_id", (F.col("seq") - 1).alias("seq"), "kind", "turn", "call_id", "status", "json")


#: tools of the derived test-bed
TOOLS = {
    "lookup": {"query": ("string", True), "limit": ("integer", False), "after": ("string", False)},
    "count": {"text": ("string", True), "exact": ("boolean", True), "after": ("string", False)},
}


def with_tools(conversations: DataFrame) -> DataFrame:
    """Conversations with tool traffic made from their own turns: every assistant turn asks a tool, with an argument
    that names the assistant's previous call; the turn after it is the tool's answer."""
    # neighbours are looked up within a part of the conversation; where it begins, in what the parts before it ended with
    parts = conversations.withColumn("part", F.struct(F.floor(F.col("turn") / SLICE).alias("s"))).withColumn("c", F.struct("conv_id"))
    assistant = F.when(F.col("role") == "assistant", F.col("turn"))
    whole, row = W.partitionBy("c").orderBy("part"), F.struct("turn", "role", "text")
    ends = parts.groupBy("c", "part").agg(F.max(row).alias("end"), F.max(assistant).alias("asked"))
    ends = ends.select(
        "c", "part", F.lag("end").over(whole).alias("end"),
        F.max("asked").over(whole.rowsBetween(W.unboundedPreceding, -1)).alias("asked"),
    )
    turns = W.partitionBy("c", "part").orderBy("turn", "role", "text")
    back = parts.join(ends, ["c", "part"]).select(
        "*", F.coalesce(F.lag(row).over(turns), F.col("end")).alias("prev"),
        F.coalesce(F.max(assistant).over(turns.rowsBetween(W.unboundedPreceding, -1)), F.col("asked")).alias("last"),
    ).withColumns({"before": F.col("prev.role"), "came": F.col("prev.turn")})
    name = lambda t: F.concat(F.lit("c"), t.cast("string"))
    words = F.size(F.split(F.coalesce("text", F.lit("")), " "))
    after = F.when(F.col("last").isNotNull(), F.concat(F.lit("$"), name(F.col("last"))))
    lookup = F.to_json(F.struct(F.col("text").alias("query"), words.alias("limit"), after.alias("after")))
    count = F.to_json(F.struct(F.col("text").alias("text"), (words % 2 == 0).alias("exact"), after.alias("after")))
    even = F.pmod("turn", F.lit(2)) == 0
    call = F.struct(
        name(F.col("turn")).alias("id"), F.when(even, F.lit("count")).otherwise(F.lit("lookup")).alias("name"),
        F.when(even, count).otherwise(lookup).alias("arguments"),
    )
    asked = F.to_json(F.struct(F.col("text").alias("content"), F.array(call).alias("tool_calls")))
    told = F.to_json(F.struct(name(F.col("came")).alias("tool_call_id"), F.col("text").alias("content")))
    answers = (F.col("before") == "assistant") & (F.col("role") != "assistant")
    return back.select(
        "conv_id", "turn", F.when(answers, F.lit("tool")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("role") == "assistant", asked).when(answers, told).otherwise(F.col("text")).alias("text"),
    )


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(with_tools(table(spark, sf_dir, "conversations")), TOOLS)
