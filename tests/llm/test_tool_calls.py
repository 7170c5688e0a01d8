import json

from rivulet.llm import tool_calls as T

CALLS = "conv_id long, seq long, call_id string, name string, arguments string, after array<string>, node string, level int"
RESULTS = "conv_id long, seq long, call_id string, content string, fits string"
SCHEMAS = "name string, param string, type string, required boolean"
TOOLS = [("f", "a", "integer", True), ("f", "b", "string", False), ("g", "x", "number", True), ("g", "o", "object", False), ("g", "l", "array", False), ("g", "t", "boolean", False), ("f", "a", "integer", True)]


def link(spark, calls, results):
    found = T.link_tool_calls(
        spark.createDataFrame([(*c, "clash", 7) for c in calls], CALLS),
        spark.createDataFrame([(*r, "clash") for r in results], RESULTS),
        spark.createDataFrame(TOOLS, SCHEMAS),
    )
    return found.collect()


def test_validation_and_links(spark):
    calls = [
        (1, 1, "a", "f", '{"b": "é\\n", "a": 1}', []), (1, 2, "b", "f", '{"a": "1"}', ["a"]), (1, 3, "c", "f", "{}", None),
        (1, 4, "d", "g", '{"x": 1.50, "o": {"z": 1, "y": [2]}, "l": [], "t": true}', ["a", "b", "a"]),
        (1, 5, "e", "g", '{"x": true, "q": 1, "o": null}', ["zz"]), (1, 6, "f", "h", "{}", []), (1, 7, "g", "f", "nope", []),
        (1, 8, "h", "f", None, []), (1, 9, "i", "f", '{"a": 1, "a": 2}', []), (1, 10, "a", "f", '{"a": 5}', []), (None, 1, "a", "f", "{}", []),
        (1, 11, None, "f", "{}", []), (2, 1, "a", "f", '{"a": 12345678901234567890}', []), (1, 12, "j", None, "[1]", []),
    ]
    results = [
        (1, 3, "a", "second"), (1, 2, "a", "first"), (1, 2, "a", "first"), (1, 1, "b", "too early"), (1, 9, "d", None), (3, 1, "a", "?"),
        (None, 1, "a", "?"), (1, 9, None, "?"), (1, 99, "e", "late"),
    ]
    found = link(spark, calls, results)
    by = {(r.conv_id, r.call_id): r for r in found if r.status not in ("duplicate", "orphan_result", "no_id")}
    assert by[1, "a"].message == '{"arguments":{"a":1,"b":"é\\n"},"id":"a","name":"f","result":"first"}'
    assert (by[1, "a"].status, by[1, "a"].level, by[1, "a"].errors) == ("ok", 0, [])
    assert (by[1, "b"].errors, by[1, "b"].level) == (["type:a"], 1)
    assert by[1, "c"].errors == ["missing:a"]
    assert (by[1, "d"].status, by[1, "d"].level) == ("ok", 2)
    assert json.loads(by[1, "d"].message)["arguments"] == {"x": 1.5, "o": {"z": 1, "y": [2]}, "l": [], "t": True}
    assert by[1, "d"].message.startswith('{"arguments":{"l":[],"o":{"y":[2],"z":1},"t":true,"x":1.5}')
    assert by[1, "e"].errors == ["dependency:zz", "type:x", "unknown:q"]
    assert by[1, "f"].errors == ["unknown_tool"]
    assert [by[1, k].errors for k in "ghij"] == [["no_object"]] * 4
    assert json.loads(by[1, "g"].message)["arguments"] == "nope"
    assert by[2, "a"].status == "unanswered"
    count = lambda s: sum(r.status == s for r in found)
    assert (count("duplicate"), count("no_id"), count("orphan_result")) == (1, 2, 4)
    assert len(found) == len(calls) + 4


def test_levels_of_chains_ladders_and_cycles(spark):
    edges = [(f"c{k}", f"c{k - 1}") for k in range(1, 60)]
    edges += [(f"l{k}", f"l{k - d}") for k in range(1, 9) for d in (1, 2) if k >= d]
    edges += [("x", "y"), ("y", "z"), ("z", "x"), ("below", "x"), ("s", "s"), ("c5", "c1"), ("p", "q"), ("q", "p"), ("p", "c3"), ("q", "c3")]
    nodes = sorted({n for e in edges for n in e} | {"alone"})
    found = T.levels(
        spark.createDataFrame([(n,) for n in nodes], "node string"),
        spark.createDataFrame(edges + edges[:3], "node string, parent string"),
    )
    level = {r.node: r.level for r in found.collect()}
    assert len(level) == len(nodes)
    assert all(level[f"c{k}"] == k for k in range(60)) and all(level[f"l{k}"] == k for k in range(9))
    assert level["alone"] == 0
    assert {level[n] for n in ("x", "y", "z", "below", "s", "p", "q")} == {None}


def test_cyclic_calls_and_empty_tables(spark):
    found = link(spark, [(1, 1, "a", "f", '{"a":1}', ["b"]), (1, 2, "b", "f", '{"a":1}', ["a"])], [])
    assert {r.status for r in found} == {"cyclic"}
    assert link(spark, [], []) == []
    assert [r.status for r in link(spark, [], [(1, 1, "a", "x")])] == ["orphan_result"]
