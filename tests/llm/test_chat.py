import json

import pytest

from platewise.llm.chat import call_depths, link_tool_calls

SCHEMAS = {
    "add": {
        "a": {"type": "integer", "required": True, "minimum": 0, "maximum": 9},
        "b": {"type": "number"},
        "exact": {"type": "boolean"},
    },
    "say": {"text": {"type": "string", "required": True, "max_length": 5}},
}
CALLS = "conv_id long, call_id string, turn long, tool string, arguments string, after string"
RESULTS = "conv_id long, call_id string, turn long, content string"


def call(arguments, tool="add", conv=1, call_id="c", turn=1, after=None):
    return (conv, call_id, turn, tool, arguments, after)


@pytest.mark.parametrize(
    "tool, arguments, errors",
    [
        ("add", '{"a": 3}', ""),
        ("add", '{"b": 1.5, "a": 0, "exact": false}', ""),
        ("add", '{"a": null}', "a: missing"),
        ("add", "{}", "a: missing"),
        ("add", '{"a": "3"}', "a: not integer"),
        ("add", '{"a": 2.5}', "a: not integer"),
        ("add", '{"a": -1}', "a: too small"),
        ("add", '{"a": 10, "b": "x", "exact": 1}', "a: too large; b: not number; exact: not boolean"),
        ("add", '{"a": 1, "z": 1, "y": 2}', "y: not in schema; z: not in schema"),
        ("say", '{"text": "12345"}', ""),
        ("say", '{"text": "123456"}', "text: too long"),
        ("say", '{"text": ["a"]}', "text: not string"),
        ("say", "[1]", "arguments are no object"),
        ("say", "not json", "arguments are no object"),
        ("say", "", "arguments are no object"),
        ("say", None, "arguments are no object"),
        ("other", "{}", "unknown tool"),
        (None, "{}", "unknown tool"),
    ],
)
def test_arguments_against_schemas(spark, tool, arguments, errors):
    calls = spark.createDataFrame([call(arguments, tool)], CALLS)
    (row,) = link_tool_calls(calls, spark.createDataFrame([], RESULTS), SCHEMAS).collect()
    assert (row.errors, row.valid) == (errors, errors == "")


def test_lines_are_canonical_json(spark):
    arguments = '{"b" : 2, "a": 1, "nested": {"z": [1, {"y": null, "x": "é\\n\\"q\\""}]}}'
    calls = spark.createDataFrame([call(arguments)], CALLS)
    results = spark.createDataFrame([(1, "c", 2, "done /\t")], RESULTS)
    (row,) = link_tool_calls(calls, results, SCHEMAS).collect()
    value = json.loads(row.line)
    assert value == {"arguments": json.loads(arguments), "id": "c", "result": "done /\t", "tool": "add"}
    assert row.line == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_linking_order_and_faults(spark):
    good = '{"a": 1}'
    calls = [
        call(good, call_id="late", turn=1, after="early"),
        call(good, call_id="early", turn=5),
        call(good, call_id="x", turn=2, after="y"),
        call(good, call_id="y", turn=3, after="x"),
        call(good, call_id="after circle", turn=4, after="x"),
        call(good, call_id="twice", turn=6),
        call('{"a": 2}', call_id="twice", turn=7, after="nowhere"),
        call(good, call_id=None, turn=8),
        call(good, call_id="early", conv=None, turn=1),
        call(good, call_id="early", turn=5),
    ]
    results = [(1, "early", 9, "second"), (1, "early", 8, "first"), (None, "early", 2, None), (1, "twice", 8, "t"), (1, "stray", 1, "s")]
    frames = spark.createDataFrame([(*c, 1) for c in calls], CALLS + ", line int"), spark.createDataFrame(results, RESULTS)
    rows = link_tool_calls(*frames, SCHEMAS).orderBy("conv_id", "position").collect()
    got = [(r.conv_id, r.position, r.call_id, r.depth, r.errors, r.results) for r in rows]
    assert got == [
        (None, 0, "early", 0, "", 1),
        (1, 0, "early", 0, "", 2),
        (1, 1, "twice", 0, "", 1),
        (1, 2, "twice", 0, "duplicate id; unknown predecessor", 0),
        (1, 3, None, 0, "no id", 0),
        (1, 4, "late", 1, "", 0),
        (1, 5, "stray", None, "no call", 1),
        (1, 6, "x", None, "circle", 0),
        (1, 7, "y", None, "circle", 0),
        (1, 8, "after circle", None, "circle", 0),
    ]
    assert '"result":"first"' in rows[1].line and "result" not in rows[0].line


def test_every_other_turn_is_a_message(spark):
    calls = spark.createDataFrame([call('{"a": 1}', call_id="c", turn=1)], CALLS)
    results = spark.createDataFrame([(1, "c", 2, "done")], RESULTS)
    told = [(1, 0, "system", "Be \"brief\"."), (1, 5, None, "who?"), (1, 6, "tool", None), (1, 0, "system", "Be \"brief\"."), (None, None, None, None)]
    told += [(2, 0, "system", "x" * 1_000_000)]
    messages = spark.createDataFrame([(*m, 1) for m in told], "conv_id long, turn long, role string, content string, depth int")
    rows = link_tool_calls(calls, results, SCHEMAS, messages).orderBy("conv_id", "position").collect()
    assert len(rows) == 1 + len(told)
    brief = '{"content":"Be \\"brief\\".","role":"system"}'
    assert [(r.conv_id, r.position, r.call_id, r.depth, r.errors, r.line) for r in rows if r.conv_id != 2] == [
        (None, 0, None, 0, "no role", "{}"),
        (1, 0, None, 0, "", brief),
        (1, 1, None, 0, "", brief),
        (1, 2, "c", 0, "", '{"arguments":{"a":1},"id":"c","result":"done","tool":"add"}'),
        (1, 3, None, 0, "no role", '{"content":"who?"}'),
        (1, 4, None, 0, "unknown role", '{"role":"tool"}'),
    ]
    assert len(rows[-1].line) > 1_000_000


def test_depths_of_a_long_chain_and_a_hub(spark):
    chain = [(1, f"n{i}", f"n{i - 1}" if i else None) for i in range(70)]
    hub = [(2, f"h{i}", "h0" if i else None) for i in range(50)]
    ring = [(3, "a", "b"), (3, "b", "c"), (3, "c", "a"), (3, "d", "d")]
    calls = spark.createDataFrame(chain + hub + ring, "conv_id long, call_id string, after string")
    got = {(r.conv_id, r.call_id): r.depth for r in call_depths(calls).collect()}
    assert got == (
        {(1, f"n{i}"): i for i in range(70)}
        | {(2, f"h{i}"): int(i > 0) for i in range(50)}
        | {(3, c): None for c in "abcd"}
    )


def test_empty_tables(spark):
    calls, results = spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS)
    assert link_tool_calls(calls, results, SCHEMAS).count() == 0
    with pytest.raises(ValueError, match="keywords"):
        link_tool_calls(calls, results, {"add": {"a": {"type": "integer", "odd": 1}}})
