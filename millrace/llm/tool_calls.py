"""Chats with tool calls: link calls to results, order them, validate arguments, serialise canonically.

Everything here is column expressions; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.tables import saved

# A reference to another call's result, as the text of an argument.
REFERENCE = r'"\$ref:([^"\\]+)"'
TYPES = {
    "string": "^STRING$", "boolean": "^BOOLEAN$", "array": "^ARRAY", "object": "^OBJECT",
    "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL)",
}

CALLS = "array<struct<id:string,name:string,arguments:variant>>"


def _argument(arguments: Column, name: str) -> Column:
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(arguments, f"$['{quoted}']", "variant")


def _problems(call: Column, tools: dict[str, dict[str, dict]]) -> Column:
    """What is wrong with a call's arguments, as an array of texts; the schemas are constants of the plan."""
    none = F.array().cast("array<string>")
    out = F.when(call["name"].isNull(), F.array(F.lit("no_name")))
    for tool, parameters in sorted(tools.items()):
        found = [_keys(call["arguments"], sorted(parameters))]
        for name, rule in sorted(parameters.items()):
            value = _argument(call["arguments"], name)
            kind = F.schema_of_variant(value)
            given = value.isNotNull() & (kind != "VOID")
            wrong = F.when(~F.coalesce(given, F.lit(False)), F.lit(f"missing:{name}") if rule.get("required") else None)
            wrong = wrong.when(~kind.rlike(TYPES[rule["type"]]), F.lit(f"type:{name}"))
            outside = F.lit(False)
            if "enum" in rule:
                outside = outside | ~F.try_variant_get(value, "$", "string").isin(rule["enum"])
            if "minimum" in rule:
                outside = outside | (F.try_variant_get(value, "$", "double") < rule["minimum"])
            if "maximum" in rule:
                outside = outside | (F.try_variant_get(value, "$", "double") > rule["maximum"])
            found.append(F.array(wrong.when(outside, F.lit(f"value:{name}"))))
        out = out.when(call["name"] == tool, F.filter(F.concat(*found), lambda p: p.isNotNull()))
    return F.coalesce(out.otherwise(F.array(F.lit("unknown_tool"))), none)


def _keys(arguments: Column, allowed: list[str]) -> Column:
    keys = F.map_keys(F.try_variant_get(arguments, "$", "map<string,variant>"))
    extra = F.array_except(keys, F.array(*[F.lit(a) for a in allowed]))
    return F.coalesce(F.transform(extra, lambda k: F.concat(F.lit("extra:"), k)), F.array(F.lit("not_an_object")))


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, id, level, problem) of each call: its place in the order that references ask for.

    ``calls`` has conv_id, id and refs. A call without references is on level 0, another one above the
    highest it refers to. Each round places the calls whose references are all placed, so there are as many
    rounds as the longest chain of references. A reference to no call is a problem and asks for nothing; calls
    in a circle, and those above one, get no level.
    """
    named = calls.groupBy("conv_id", "id").agg(F.array_distinct(F.flatten(F.collect_set("refs"))).alias("refs"))
    wanted = named.select("conv_id", "id", F.explode("refs").alias("ref"))
    known = named.select("conv_id", F.col("id").alias("ref"), F.lit(True).alias("exists"))
    asked = saved(wanted.join(known, ["conv_id", "ref"], "left"), "references")
    edges = asked.where("exists").select("conv_id", "id", "ref")
    lost = asked.where("exists IS NULL").groupBy("conv_id", "id").agg(F.lit("unknown_ref").alias("lost"))
    waiting = saved(edges, "waiting")
    done = saved(named.join(waiting.select("conv_id", "id").distinct(), ["conv_id", "id"], "left_anti").select("conv_id", "id", F.lit(0).alias("level")), "placed")
    while not waiting.isEmpty():
        state = waiting.join(done.select("conv_id", F.col("id").alias("ref"), F.col("level").alias("below")), ["conv_id", "ref"], "left")
        ready = state.groupBy("conv_id", "id").agg(F.max("below").alias("below"), F.count_if(F.col("below").isNull()).alias("open"))
        placed = saved(ready.where("open = 0").select("conv_id", "id", (F.col("below") + 1).alias("level")), "placed")
        if placed.isEmpty():
            break
        done = done.union(placed)
        waiting = saved(waiting.join(placed, ["conv_id", "id"], "left_anti"), "waiting")
    circle = F.when(F.col("level").isNull(), F.lit("circular"))
    return named.select("conv_id", "id").join(done, ["conv_id", "id"], "left").join(lost, ["conv_id", "id"], "left").select(
        "conv_id", "id", "level", F.array_compact(F.array("lost", circle)).alias("problems")
    )


def formatted(messages: DataFrame, tools: dict[str, dict[str, dict]]) -> DataFrame:
    """Per message: conv_id, turn, level, status and json.

    ``messages`` needs conv_id, turn, role, content, tool_calls (JSON array of id, name, arguments; or null) and
    tool_call_id (for results; or null). ``tools`` gives the parameters of each tool by name: type (as in JSON
    schema), required, enum, minimum, maximum; parameters that are not named are problems.

    - Calls and results of a conversation meet by identifier in a hash join. A result belongs to the first
      call of its identifier, if that comes before it; further results of a call are ``repeated``, results without
      a call before them ``orphan``. A call without a result behind it is ``unanswered``.
    - Calls are ordered by their references to each other's results (see :func:`levels`), within a message
      by level, then as given. ``level`` is twice a call's level, one more for its result, else 0; rows in
      the order of (level, turn) never use a result before it is there. Calls in a circle have no level.
    - ``status`` joins the message's problems in order with commas; it is empty if there are none.
    - ``json`` has its keys in order at every depth, no white space, and numbers in shortest form; a null
      content is left out, as are unreadable calls (status ``malformed``).

    Long conversations are not gathered: joins are by conversation and identifier. Null conversations and
    identifiers link with nothing. Repeated rows are formatted row by row. No rows give no rows.
    """
    rows = messages.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "content", "tool_calls", "tool_call_id"
    ).withColumn("calls", F.from_json("tool_calls", CALLS))
    spread = rows.where("calls IS NOT NULL").select("conv_id", "turn", F.posexplode("calls").alias("at", "call"))
    calls = saved(
        spread.select(
            "conv_id", "turn", "at", F.col("call.id").alias("id"),
            F.coalesce(F.regexp_extract_all(F.to_json("call.arguments"), F.lit(REFERENCE), 1), F.array().cast("array<string>")).alias("refs"),
        ).where("conv_id IS NOT NULL AND id IS NOT NULL"),
        "calls",
    )
    answers = rows.where("tool_call_id IS NOT NULL AND conv_id IS NOT NULL").select("conv_id", F.col("tool_call_id").alias("id"), "turn")
    first_call = calls.groupBy("conv_id", "id").agg(F.min("turn").alias("called"))
    # The side of one row per identifier is hashed and the results stream by, so a hot identifier can be split.
    met = (
        answers.join(first_call.hint("shuffle_hash"), ["conv_id", "id"]).where("turn > called")
        .groupBy("conv_id", "id").agg(F.min("turn").alias("answered"))
    )
    linked = saved(
        first_call.join(met, ["conv_id", "id"], "left").select("conv_id", "id", "called", "answered")
        .join(levels(calls), ["conv_id", "id"]),
        "linked",
    )

    # Results: one narrow join by identifier.
    results = rows.where("tool_call_id IS NOT NULL").join(
        linked.select("conv_id", F.col("id").alias("tool_call_id"), "called", "answered", F.col("level").alias("call_level")),
        ["conv_id", "tool_call_id"], "left",
    )
    before = F.coalesce(F.col("called") < F.col("turn"), F.lit(False))
    result_status = F.when(~before, "orphan").when(F.col("turn") != F.col("answered"), "repeated").otherwise("")
    result_json = F.to_json(F.struct("content", "role", "tool_call_id"))
    out_results = results.select(
        "conv_id", "turn", F.when(before, 2 * F.col("call_level") + 1).otherwise(0).cast("long").alias("level"),
        result_status.alias("status"), result_json.alias("json"),
    )

    # Messages with calls: what is known of their calls comes back as one array per message.
    about = (
        calls.select("conv_id", "turn", "id").distinct().join(linked, ["conv_id", "id"])
        .withColumn("late", F.when(F.col("answered").isNull() | (F.col("called") != F.col("turn")), F.lit("unanswered")))
        .groupBy("conv_id", "turn").agg(F.map_from_entries(F.collect_set(F.struct("id", F.struct("level", F.array_compact(F.concat("problems", F.array("late"))).alias("problems"))))).alias("about"))
    )
    asking = rows.where("tool_call_id IS NULL AND calls IS NOT NULL").join(about, ["conv_id", "turn"], "left")
    known = F.transform(
        "calls",
        lambda c, i: F.struct(
            F.coalesce(F.col("about")[c["id"]]["level"], F.lit(2**30)).alias("level"), i.alias("at"),
            F.concat(_problems(c, tools), F.coalesce(F.col("about")[c["id"]]["problems"], F.array(F.lit("unanswered")))).alias("problems"),
            F.concat_ws(
                "", F.lit('{"arguments":'), F.coalesce(F.to_json(c["arguments"]), F.lit("null")),
                F.lit(',"id":'), _text(c["id"]), F.lit(',"name":'), _text(c["name"]), F.lit("}"),
            ).alias("json"),
        ),
    )
    sorted_calls = asking.select("conv_id", "turn", "role", "content", F.sort_array(known).alias("known"))
    top = F.array_max(F.transform("known", lambda k: k["level"]))
    out_calls = sorted_calls.select(
        "conv_id", "turn", F.when(top < 2**30, 2 * top).when(F.size("known") == 0, 0).cast("long").alias("level"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.transform("known", lambda k: k["problems"])))), ",").alias("status"),
        F.concat_ws(
            "", F.lit("{"), F.when(F.col("content").isNotNull(), F.concat(F.lit('"content":'), _text(F.col("content")), F.lit(","))),
            F.lit('"role":'), _text(F.col("role")), F.lit(',"tool_calls":['),
            F.array_join(F.transform("known", lambda k: k["json"]), ","), F.lit("]}"),
        ).alias("json"),
    )

    plain = rows.where("tool_call_id IS NULL AND calls IS NULL").select(
        "conv_id", "turn", F.lit(0).cast("long").alias("level"),
        F.when(F.col("tool_calls").isNotNull(), "malformed").otherwise("").alias("status"),
        F.to_json(F.struct("content", "role")).alias("json"),
    )
    return out_results.union(out_calls).union(plain)


def _text(value: Column) -> Column:
    """A text as JSON; null as null."""
    quoted = F.to_json(F.struct(value.alias("t")))
    return F.when(value.isNull(), F.lit("null")).otherwise(F.substring(quoted, F.lit(6), F.length(quoted) - 6))
