"""Tool calls of conversations: linked to results, ordered, validated, serialised.

Calls and results meet in a hash join on conversation and call identifier. Dependencies
give every call a level, the length of the longest chain below it, by rounds of joins over
the dependency edges: an edge to a call without open dependencies becomes a number, an edge
to a call with one open dependency jumps over it. A chain of n calls takes about log2(n)
rounds. (level, seq) is a topological order of a conversation, whatever its size, without
gathering it. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import small
from rivulet.util import stage


def _node(call_id: str = "call_id") -> Column:
    known = F.col("conv_id").isNotNull() & F.col(call_id).isNotNull()
    return F.when(
        known, F.md5(F.to_json(F.struct("conv_id", F.col(call_id).alias("id"))).cast("binary"))
    )


def levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, level) of `nodes` (node); `edges` (node, parent) lie within them.

    `level` is the number of edges on the longest path to the node, and null for nodes on
    a cycle or behind one.
    """
    total = nodes.count()
    state = stage(nodes.select("node", F.lit(0).cast("long").alias("base")), "levels")
    links = stage(
        edges.select("node", "parent", F.lit(1).cast("long").alias("w")).distinct(), "links"
    )
    before = None
    while True:
        seen = links.agg(F.count("*"), F.sum("w")).first()
        if seen[0] == 0 or seen == before:
            break
        before = seen
        open_links = links.groupBy("node").agg(
            F.count("*").alias("open"), F.max(F.struct("parent", "w")).alias("only")
        )
        info = state.join(open_links, "node", "left").select(
            F.col("node").alias("parent"), F.col("base").alias("p_base"),
            F.coalesce("open", F.lit(0)).alias("open"), "only",
        )
        met = stage(links.join(info, "parent"), "met")
        sums = met.where("open < 2").groupBy("node").agg(
            F.max(F.col("p_base") + F.col("w")).alias("more")
        )
        state = stage(
            state.join(sums, "node", "left").select(
                "node", F.greatest("base", "more").alias("base")
            ),
            "levels",
        )
        kept = met.where("open > 1").select("node", "parent", "w")
        jumped = met.where("open = 1").select(
            "node", F.col("only.parent").alias("parent"), (F.col("w") + F.col("only.w")).alias("w")
        )
        # no path has more edges than there are nodes, so a heavier link is on a cycle
        w = F.least(F.max("w"), F.lit(total + 1)).alias("w")
        links = stage(kept.unionByName(jumped).groupBy("node", "parent").agg(w), "links")
    stuck = links.select("node").distinct().withColumn("stuck", F.lit(True))
    return state.join(stuck, "node", "left").select(
        "node", F.when(F.col("stuck").isNull(), F.col("base")).alias("level")
    )


def _fits(kind: Column, wanted: Column) -> Column:
    """Whether a value of a variant kind is of a declared type."""
    whole = kind.isin("BIGINT") | kind.rlike(r"^DECIMAL\(\d+,0\)$")
    return (
        F.when(wanted == "string", kind == "STRING")
        .when(wanted == "integer", whole)
        .when(wanted == "number", whole | kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"))
        .when(wanted == "boolean", kind == "BOOLEAN")
        .when(wanted == "object", kind.startswith("OBJECT"))
        .when(wanted == "array", kind.startswith("ARRAY"))
        .otherwise(F.lit(False))
    )


def _argument_errors(kinds: Column, params: Column) -> Column:
    """What is wrong with arguments (map from name to kind), as an array of strings."""
    given = F.map_keys(kinds)
    missing = F.transform(
        F.filter(params, lambda p: p["required"] & ~F.array_contains(given, p["param"])),
        lambda p: F.concat(F.lit("missing:"), p["param"]),
    )
    unknown = F.transform(
        F.filter(given, lambda k: ~F.exists(params, lambda p: p["param"] == k)),
        lambda k: F.concat(F.lit("unknown:"), k),
    )
    wrong = F.transform(
        F.filter(
            params,
            lambda p: F.array_contains(given, p["param"])
            & ~(
                _fits(kinds[p["param"]], p["type"])
                | (~p["required"] & (kinds[p["param"]] == "VOID"))
            ),
        ),
        lambda p: F.concat(F.lit("type:"), p["param"]),
    )
    return F.concat(missing, unknown, wrong)


def validate(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """`calls` with `canonical` (arguments as canonical JSON, or null) and `errors`."""
    tools = stage(
        schemas.where("name is not null and param is not null")
        .groupBy("name", "param")
        .agg(F.min("type").alias("type"), F.max(F.coalesce("required", F.lit(False))).alias("required"))
        .groupBy("name")
        .agg(F.sort_array(F.collect_list(F.struct("param", "type", "required"))).alias("params")),
        "tools",
    )
    parsed = calls.withColumn("_json", F.try_parse_json("arguments"))
    object_ = F.expr("try_variant_get(_json, '$', 'map<string,variant>')")
    kinds = F.transform_values(object_, lambda k, v: F.schema_of_variant(v))
    parsed = parsed.withColumn("_kinds", kinds).withColumn("canonical", F.to_json("_json"))
    checked = parsed.join(small(tools), "name", "left")
    errors = (
        F.when(F.col("_kinds").isNull(), F.array(F.lit("no_object")))
        .when(F.col("params").isNull(), F.array(F.lit("unknown_tool")))
        .otherwise(_argument_errors(F.col("_kinds"), F.col("params")))
    )
    return checked.withColumn("errors", F.array_sort(errors)).drop("_json", "_kinds", "params")


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call and per result without a call: status, level, errors and JSON.

    calls: conv_id, seq, call_id, name, arguments (JSON), after (array of call ids);
    results: conv_id, seq, call_id, content; schemas: name, param, type, required. Other
    columns are not looked at. Returns conv_id, call_id, seq, level, status, errors and
    message, the canonical JSON of the call and its result: sorted keys, no white space,
    the arguments as canonical JSON where they are JSON and else as text.

    status is the first that applies: orphan_result (no such call), no_id (conv_id or
    call_id is null), duplicate (another call of that id comes first: the least by seq,
    name, arguments), cyclic (depends on itself), invalid (errors), unanswered, ok. Of
    several results the first counts (by seq, content); a result from before its call does
    not answer it and is an orphan. A dependency that is not in the conversation is the
    error dependency:<id>. Null arrays of dependencies are empty. Repeated calls are
    duplicates of the first, repeated results are counted once. Empty tables give no rows.
    """
    text = ["call_id", "name", "arguments"]
    typed = calls.select(
        "conv_id", F.col("seq").cast("long").alias("seq"),
        *(F.col(c).cast("string").alias(c) for c in text), "after", _node().alias("node"),
    )
    order = F.struct("seq", "name", "arguments", "after")
    first = typed.where("node is not null").groupBy("node", "conv_id", "call_id").agg(
        F.min(order).alias("c"), F.count("*").alias("times")
    )
    first = stage(first.select("node", "conv_id", "call_id", "c.*", "times"), "calls")
    edges = first.select("node", "conv_id", F.explode(F.array_distinct("after")).alias("id"))
    edges = edges.withColumn("parent", _node("id"))
    known = edges.join(first.select(F.col("node").alias("parent"), F.lit(1).alias("hit")), "parent", "left")
    known = stage(known.select("node", "parent", "id", "hit"), "edges")
    level = levels(first.select("node"), known.where("hit is not null").select("node", "parent"))
    absent = known.where("hit is null").groupBy("node").agg(
        F.collect_set(F.concat(F.lit("dependency:"), "id")).alias("absent")
    )
    answers = results.select(
        "conv_id", F.col("seq").cast("long").alias("seq"), F.col("call_id").cast("string").alias("call_id"),
        F.col("content").cast("string").alias("content"), _node().alias("node"),
    )
    linked = answers.join(
        first.select("node", F.col("seq").alias("asked")), "node", "left"
    ).withColumn("fits", F.coalesce(F.col("seq") > F.col("asked"), F.lit(False)))
    linked = stage(linked, "linked")
    answer = linked.where("fits").groupBy("node").agg(
        F.min(F.struct("seq", "content")).alias("answer")
    )
    none = F.array().cast("array<string>")
    joined = (
        validate(first, schemas).join(level, "node").join(absent, "node", "left")
        .join(answer, "node", "left")
        .withColumn("errors", F.array_sort(F.concat("errors", F.coalesce("absent", none))))
    )
    status = (
        F.when(F.col("level").isNull(), "cyclic")
        .when(F.size("errors") > 0, "invalid")
        .when(F.col("answer").isNull(), "unanswered")
        .otherwise("ok")
    )
    keep_nulls = {"ignoreNullFields": "false"}
    arguments = F.coalesce(F.try_parse_json("canonical"), F.col("arguments").cast("variant"))
    message = F.to_json(
        F.struct(
            arguments.alias("arguments"), F.col("call_id").alias("id"), "name",
            F.col("answer.content").alias("result"),
        ),
        keep_nulls,
    )
    done = joined.select("conv_id", "call_id", "seq", "level", status.alias("status"), "errors",
                         message.alias("message"))
    nothing = [F.lit(None).cast("long").alias("level")]
    tail = [none.alias("errors"), F.lit(None).cast("string").alias("message")]
    ids = ["conv_id", "call_id", "seq"]
    extra = first.where("times > 1").select(
        *ids, *nothing, F.lit("duplicate").alias("status"), *tail,
        F.explode(F.sequence(F.lit(2).cast("long"), F.col("times"))).alias("_"),
    ).drop("_")
    unnamed = typed.where("node is null").select(*ids, *nothing, F.lit("no_id").alias("status"), *tail)
    orphans = linked.where("not fits").select(
        *ids, *nothing, F.lit("orphan_result").alias("status"), *tail
    )
    return done.unionByName(extra).unionByName(unnamed).unionByName(orphans)
