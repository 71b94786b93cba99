"""Chat formatting with linked tool calls (operator 1), DataFrame functions only.

Messages are rows (conv_id, turn, role, text). An assistant message that
calls tools has as text ``{"tool_calls": [{"id", "name", "arguments", "after"}]}``;
``after`` names the calls whose results this call uses, one or a list. A tool message has as text
``{"tool_call_id", "content"}``. Every other text is a plain message.

Calls and results are linked by a hash join on (conv_id, identifier), put in
topological order along ``after``, checked against
schemas, and written as canonical JSON: keys sorted, no blanks. No
conversation is ever gathered into one row or task, and the plain messages of
one spread over the tasks of the joins.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locastar.llm.common import written

CALLS = "array<struct<id:string,name:string,arguments:variant,after:variant>>"
#: Variant type -> JSON schema type.
TYPES = {"BIGINT": "integer", "DOUBLE": "number", "FLOAT": "number", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null"}


def canonical(*fields: Column) -> Column:
    """The fields as one JSON object with sorted keys, nested ones too, nulls kept."""
    return F.to_json(F.to_variant_object(F.struct(*fields)))


RULES = ("struct<params:array<struct<param:string,path:string,parent:string,types:array<string>,required:boolean,`enum`:array<string>>>,"
         "objects:array<struct<path:string,prefix:string,names:array<string>>>,"
         "items:array<struct<path:string,param:string,types:array<string>,`enum`:array<string>>>>")


def flattened(schema: dict, path: str = "$", prefix: str = "") -> dict[str, list[dict]]:
    """The rules of a JSON schema of an object, nested ones too, each with the path of its value.

    Read are properties, required, type (one or a list), enum, additionalProperties (true: others may
    be there) and items of arrays (type and enum).
    """
    out: dict[str, list[dict]] = {"params": [], "objects": [], "items": []}
    kinds = lambda d: [t] if isinstance(t := d.get("type", []), str) else list(t)
    values = lambda d: [json.dumps(x, separators=(",", ":"), ensure_ascii=False) for x in d.get("enum", [])]
    if "properties" in schema and schema.get("additionalProperties") is not True:
        out["objects"].append({"path": path, "prefix": prefix, "names": sorted(schema["properties"])})
    for name, d in sorted(schema.get("properties", {}).items()):
        if "'" in name:
            raise ValueError(f"a quote in the name of a parameter: {name}")
        at, full = f"{path}['{name}']", prefix + name
        out["params"].append({"param": full, "path": at, "parent": path, "types": kinds(d), "required": name in schema.get("required", []),
                              "enum": values(d)})
        if "items" in d:
            out["items"].append({"path": at, "param": full + "[]", "types": kinds(d["items"]), "enum": values(d["items"])})
        for k, rules in flattened(d, at, full + ".").items():
            out[k] += rules
    return out


def schema_table(spark: SparkSession, schemas: dict[str, dict]) -> DataFrame:
    """(name, rules) from JSON schemas of tools' arguments."""
    listed = json.dumps({name: flattened({"properties": {}} | s) for name, s in schemas.items()}, ensure_ascii=False)
    return spark.range(1).select(F.explode(F.from_json(F.lit(listed), f"map<string,{RULES}>")).alias("name", "rules"))


def parts(messages: DataFrame) -> DataFrame:
    """One row for each plain message, call and result: conv_id, turn, role, no, kind, text, and
    of a call call_id, name, arguments (variant), after (array of ids); of a result call_id and content (variant)."""
    own = messages.select("conv_id", "turn", "role", "text")
    parsed = own.withColumn("v", F.when(F.col("role").isin("assistant", "tool") & F.startswith(F.ltrim("text"), F.lit("{")), F.try_parse_json("text")))
    parsed = parsed.withColumn("calls", F.when(F.col("role") == "assistant", F.expr(f"try_variant_get(v, '$.tool_calls', '{CALLS}')"))) \
        .withColumn("answers", F.when(F.col("role") == "tool", F.expr("try_variant_get(v, '$.tool_call_id', 'string')")))
    kinds = F.when(F.size("calls") > 0, "call").when(F.col("answers").isNotNull(), "result").otherwise("message")
    rows = parsed.withColumn("kind", kinds)
    rows = rows.select("conv_id", "turn", "role", "text", "kind", "answers", "v", F.posexplode_outer(
        F.when(F.col("kind") == "call", F.col("calls"))).alias("no", "c"))
    return rows.select(
        "conv_id", "turn", "role", F.coalesce("no", F.lit(0)).alias("no"), "kind",
        F.when(F.col("kind") == "message", F.col("text")).alias("text"), F.coalesce(F.col("c.id"), F.col("answers")).alias("call_id"),
        F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"), named_calls(F.col("c.after")).alias("after"),
        F.expr("case when kind = 'result' then try_variant_get(v, '$.content', 'variant') end").alias("content"))


def named_calls(after: Column) -> Column:
    """The distinct ids of ``after``, a string or a list of strings; none where it is something else."""
    one = F.try_variant_get(after, "$", "string")
    many = F.try_variant_get(after, "$", "array<string>")
    given = F.coalesce(many, F.when(one.isNotNull(), F.array(one)), F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.filter(given, lambda x: x.isNotNull())))


def owners(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first call and the first result of each (conv_id, call_id); a null conv_id is a conversation of its own."""
    calls = rows.where("kind = 'call' and call_id is not null").groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "no", "after")).alias("call"))
    results = rows.where("kind = 'result'").groupBy("conv_id", "call_id").agg(F.min("turn").alias("result_turn"), F.count(F.lit(1)).alias("n_results"))
    return calls, results


#: No way back is as long as this; what runs in circles stays below it.
FAR = 1 << 40


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth): the longest way back along ``after``; null on or behind a cycle.

    An id in ``after`` without a call counts as none. A call with one open
    predecessor is a pointer: its depth is max(base, depth of ``to`` + off), and
    such pointers can be strung together, so each round doubles their reach. A
    call after several waits until one of them at most is open. So rounds grow
    with the logarithm of a chain and with the nesting of calls that wait for
    several. While some open call has no open predecessor each round
    closes one; when a round closes nothing, what is left runs in circles.
    """
    ids = calls.select(F.col("conv_id").alias("pc"), F.col("call_id").alias("pi"))
    wanted = calls.select("conv_id", "call_id", F.explode("call.after").alias("after"))
    edges = written(wanted.join(ids, wanted["conv_id"].eqNullSafe(ids["pc"]) & (wanted["after"] == ids["pi"])).select(
        "conv_id", "call_id", F.col("pi").alias("to")), "edges")
    back = edges.groupBy("conv_id", "call_id").agg(F.count("*").alias("n"), F.max("to").alias("one")) \
        .select(F.col("conv_id").alias("ec"), F.col("call_id").alias("ei"), "n", "one")
    own = calls.select("conv_id", "call_id")
    now = written(own.join(back, own["conv_id"].eqNullSafe(back["ec"]) & (own["call_id"] == back["ei"]), "left").select(
        "conv_id", "call_id", F.when(F.col("n") == 1, F.col("one")).alias("to"), F.lit(1).cast("long").alias("off"),
        F.when(F.col("n").isNull(), 0).otherwise(1).cast("long").alias("base"), F.col("n").isNull().alias("closed")), "order")
    several = written(edges.join(back.where("n > 1").select("ec", "ei"), edges["conv_id"].eqNullSafe(F.col("ec")) & (edges["call_id"] == F.col("ei"))).select(
        "conv_id", "call_id", "to"), "several")
    near = lambda c: F.least(c, F.lit(FAR))
    left, last = now.where(~F.col("closed")).count(), -1
    while left not in (0, last):
        # of a closed call base is its depth
        step = now.select(F.col("conv_id").alias("pc"), F.col("call_id").alias("pi"), F.col("to").alias("next"),
                          F.col("off").alias("next_off"), F.col("base").alias("next_base"), F.col("closed").alias("ended"))
        done, open_ = now.where("closed"), now.where("not closed and to is not null")
        known = F.col("ended") | F.col("next").isNotNull()
        moved = open_.join(step, open_["conv_id"].eqNullSafe(step["pc"]) & (open_["to"] == step["pi"])).select(
            "conv_id", "call_id", F.when(F.col("ended"), None).otherwise(F.coalesce("next", "to")).alias("to"),
            F.when(F.col("next").isNotNull(), near(F.col("off") + F.col("next_off"))).otherwise(F.col("off")).alias("off"),
            F.when(known, F.greatest("base", near(F.col("off") + F.col("next_base")))).otherwise(F.col("base")).alias("base"),
            F.col("ended").alias("closed"))
        waiting = now.where("not closed and to is null").select(F.col("conv_id").alias("wc"), F.col("call_id").alias("wi"))
        gathered = several.join(waiting, several["conv_id"].eqNullSafe(F.col("wc")) & (several["call_id"] == F.col("wi")), "left_semi")
        gathered = gathered.join(step, gathered["conv_id"].eqNullSafe(step["pc"]) & (gathered["to"] == step["pi"])) \
            .groupBy("conv_id", "call_id").agg(F.count_if(~F.col("ended")).alias("open"), F.max(F.when(~F.col("ended"), F.col("pi"))).alias("one"),
                                               F.max(F.when(F.col("ended"), F.col("next_base"))).alias("deepest")) \
            .select("conv_id", "call_id", F.when(F.col("open") == 1, F.col("one")).alias("to"), F.lit(1).cast("long").alias("off"),
                    (F.coalesce("deepest", F.lit(0)) + 1).alias("base"), (F.col("open") == 0).alias("closed"))
        now = written(done.unionByName(moved).unionByName(gathered), "order")
        left, last = now.where(~F.col("closed")).count(), left
    return now.select("conv_id", "call_id", F.when(F.col("closed"), F.col("base")).alias("depth"))


def argument_errors(arguments: Column, rules: Column) -> Column:
    """Sorted messages: what is missing, unknown, of another type or outside its values, by dotted names."""
    at = lambda path: F.try_variant_get(arguments, path, "variant")
    kind = lambda value: type_of(F.schema_of_variant(value))
    unfit = lambda value, r: (F.size(r["types"]) > 0) & ~F.exists(r["types"], lambda t: fits(kind(value), t))
    outside = lambda value, r: (F.size(r["enum"]) > 0) & ~F.array_contains(r["enum"], F.to_json(value))
    wanted = lambda value, r: F.concat_ws(" ", F.lit("type"), r["param"], F.array_join(r["types"], "|"), kind(value))
    params, none = rules["params"], F.array().cast("array<string>")
    missing = F.transform(F.filter(params, lambda p: p["required"] & at(p["path"]).isNull() & (
        (p["parent"] == "$") | F.coalesce(kind(at(p["parent"])) == "object", F.lit(False)))), lambda p: F.concat(F.lit("missing "), p["param"]))
    keys = lambda path: F.coalesce(F.map_keys(F.try_variant_get(arguments, path, "map<string,variant>")), none)
    unknown = F.flatten(F.transform(rules["objects"], lambda o: F.transform(
        F.filter(keys(o["path"]), lambda k: ~F.array_contains(o["names"], k)), lambda k: F.concat(F.lit("unknown "), o["prefix"], k))))
    given = F.filter(params, lambda p: at(p["path"]).isNotNull())
    wrong = F.transform(F.filter(given, lambda p: unfit(at(p["path"]), p)), lambda p: wanted(at(p["path"]), p))
    beyond = F.transform(F.filter(given, lambda p: outside(at(p["path"]), p)), lambda p: F.concat(F.lit("value "), p["param"]))
    members = lambda i: F.coalesce(F.try_variant_get(arguments, i["path"], "array<variant>"), F.array().cast("array<variant>"))
    inside = F.flatten(F.transform(rules["items"], lambda i: F.concat(
        F.transform(F.filter(members(i), lambda v: unfit(v, i)), lambda v: wanted(v, i)),
        F.transform(F.filter(members(i), lambda v: outside(v, i)), lambda v: F.concat(F.lit("value "), i["param"])))))
    whole = F.try_variant_get(arguments, "$", "map<string,variant>")
    found = F.array_sort(F.array_distinct(F.concat(missing, unknown, wrong, beyond, inside)))
    return F.when(whole.isNull(), F.array(F.lit("arguments are no object"))).otherwise(found)


def type_of(kind: Column) -> Column:
    out = F.when(F.startswith(kind, F.lit("OBJECT")), "object").when(F.startswith(kind, F.lit("ARRAY")), "array") \
        .when(kind.rlike(r"^DECIMAL\(\d+,0\)$"), "integer").when(F.startswith(kind, F.lit("DECIMAL")), "number")
    for k, t in TYPES.items():
        out = out.when(kind == k, t)
    return out.otherwise(F.lower(kind))


def fits(kind: Column, wanted: Column) -> Column:
    return (kind == wanted) | ((wanted == "number") & (kind == "integer"))


def format_chat(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row for each plain message, call and result:

    conv_id, turn, no (place in its message), role, kind, call_id, level,
    status, errors (joined by '; '), canonical. Inside a conversation the
    order is (level, turn, no): a call's level is twice its depth, its
    result's one more, a plain message's is null and keeps its turn. Status:
    a call is ``repeated`` (another with its id came first), ``cycle``,
    ``unanswered``, ``invalid`` (see errors) or ``linked``; a result is
    ``orphan``, ``repeated`` (an earlier turn answered), ``early`` (before its
    call) or ``linked``. Text that is no JSON is a plain message; null texts
    and ids stay null. Rows that repeat each other appear each, the calls and
    results among them linked alike. No rows give no rows.
    """
    rows = parts(messages)
    calls, results = owners(rows)
    # plain messages have no id to be found by: their turn spreads them over the joins' tasks
    rows = rows.withColumn("linked", F.col("kind") != "message") \
        .withColumn("find", F.when(F.col("linked"), F.col("call_id")).otherwise(F.col("turn").cast("string")))
    deep = depths(calls)
    known = calls.join(
        deep.select(F.col("conv_id").alias("dc"), F.col("call_id").alias("di"), "depth"),
        F.col("conv_id").eqNullSafe(F.col("dc")) & (F.col("call_id") == F.col("di"))).drop("dc", "di")
    known = known.select(F.col("conv_id").alias("kc"), F.col("call_id").alias("ki"), "call", "depth", F.lit(True).alias("kl"))
    answers = results.select(F.col("conv_id").alias("rc"), F.col("call_id").alias("ri"), "result_turn", "n_results", F.lit(True).alias("rl"))
    out = rows.join(known, F.col("conv_id").eqNullSafe(F.col("kc")) & (F.col("find") == F.col("ki")) & (F.col("linked") == F.col("kl")), "left") \
        .join(answers, F.col("conv_id").eqNullSafe(F.col("rc")) & (F.col("find") == F.col("ri")) & (F.col("linked") == F.col("rl")), "left") \
        .join(schemas.withColumnRenamed("name", "tool"), F.col("name") == F.col("tool"), "left")
    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    errors = F.when(is_call, F.when(F.col("rules").isNull(), F.array(F.concat(F.lit("no schema for "), F.coalesce("name", F.lit("null")))))
                    .otherwise(argument_errors(F.col("arguments"), F.col("rules")))).otherwise(F.array().cast("array<string>"))
    first = (F.col("turn") == F.col("call.turn")) & (F.col("no") == F.col("call.no"))
    status = F.when(is_call, F.when(~F.coalesce(first, F.lit(False)), "repeated").when(F.col("depth").isNull(), "cycle")
                    .when(F.col("result_turn").isNull(), "unanswered").when(F.size("errors") > 0, "invalid").otherwise("linked")) \
        .when(is_result, F.when(F.col("call").isNull(), "orphan").when(F.col("turn") > F.col("result_turn"), "repeated")
              .when(F.col("turn") < F.col("call.turn"), "early").otherwise("linked")).otherwise("message")
    text = F.when(is_call, canonical(F.col("arguments"), F.col("call_id").alias("id"), "name", F.lit("call").alias("type"))) \
        .when(is_result, canonical(F.col("content"), F.col("call_id").alias("tool_call_id"), F.lit("result").alias("type"))) \
        .otherwise(canonical(F.col("text").alias("content"), F.col("role")))
    return out.withColumn("errors", errors).select(
        "conv_id", "turn", "no", "role", "kind", "call_id",
        F.when(is_call | is_result, F.col("depth") * 2 + F.when(is_result, 1).otherwise(0)).alias("level"),
        status.alias("status"), F.array_join("errors", "; ").alias("errors"), text.alias("canonical"))


#: The tool of the derived calls and its arguments.
REPLY = {"reply": {"properties": {"prompt": {"type": "string"}, "turn": {"type": "integer"}, "words": {"type": "integer"}},
                   "required": ["prompt", "turn", "words"]}}


def as_tool_calls(conversations: DataFrame) -> DataFrame:
    """Messages derived from plain conversations, which hold no tool calls of their own.

    Each user turn becomes a call of the tool ``reply`` with id ``c<turn>``
    after the call two turns before and the one of turn 0; each assistant turn
    becomes the result of the call one turn before. Other roles stay plain
    messages. Some calls are broken: ``words`` is a string where turn mod 8
    is 4, missing beside an unknown ``note`` where conv_id mod 7 is 3 and turn mod
    8 is 2, the call of turn 0 comes after that of turn 2 where conv_id mod 13
    is 6 (a circle), and the call is there twice where conv_id mod 17 is 8.
    """
    turn, conv = F.col("turn"), F.col("conv_id")
    named = lambda k: F.concat(F.lit("c"), k.cast("string"))
    words = F.size(F.split("text", " "))
    given = [F.col("text").alias("prompt"), turn.alias("turn")]
    arguments = F.when(turn % 8 == 4, F.to_json(F.struct(*given, words.cast("string").alias("words")))) \
        .when((conv % 7 == 3) & (turn % 8 == 2), F.to_json(F.struct(*given, F.lit(True).alias("note")))) \
        .otherwise(F.to_json(F.struct(*given, words.alias("words"))))
    after = F.when((turn == 0) & (conv % 13 == 6), F.array(F.lit("c2"))).when(turn == 0, F.array().cast("array<string>")) \
        .otherwise(F.array(named(turn - 2), F.lit("c0")))
    one = F.concat(F.lit('{"id":"'), named(turn), F.lit('","name":"reply","arguments":'), arguments, F.lit(',"after":'), F.to_json(after), F.lit("}"))
    call = F.concat(F.lit('{"tool_calls":['), one, F.when(conv % 17 == 8, F.concat(F.lit(","), one)).otherwise(""), F.lit("]}"))
    result = F.to_json(F.struct(named(turn - 1).alias("tool_call_id"), F.col("text").alias("content")))
    return conversations.select(
        "conv_id", "turn", F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool").otherwise(F.col("role")).alias("role"),
        F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", result).otherwise(F.col("text")).alias("text"))
