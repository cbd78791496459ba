import json
import random

import pytest

from crestline.llm import chat_format

TOOLS = {"lookup": {"query": ("string", True), "limit": ("integer", False)}, "sum": {"of": ("array", True)}}
DDL = "conv_id bigint, turn bigint, role string, text string, seq string, json string"


def ask(*calls, content=None):
    return json.dumps({"content": content, "tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})


def tell(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


def formatted(spark, *rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], DDL).repartition(2)
    out = chat_format.format_chats(df, TOOLS).collect()
    return sorted(out, key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.seq))


def test_calls_follow_what_they_depend_on(spark):
    got = formatted(
        spark, (1, 0, "user", "hi"),
        (1, 1, "assistant", ask(("b", "sum", '{"of": ["$a", 2]}'), ("a", "lookup", '{"query":"x","limit":3}'), content="hm")),
        (1, 2, "tool", tell("b", "5")), (1, 3, "tool", tell("a", "y")), (1, 4, "tool", tell("q", "?")), (1, 5, "tool", tell("a", "again")),
        (2, 0, "assistant", ask(("a", "lookup", '{"query":"other"}'))),
    )
    line = [(r.kind, r.call_id, r.status) for r in got if r.conv_id == 1]
    assert line == [
        ("message", None, "ok"), ("message", None, "ok"), ("call", "a", "ok"), ("result", "a", "ok"), ("call", "b", "ok"),
        ("result", "b", "ok"), ("result", "q", "orphan"), ("result", "a", "duplicate"),
    ]
    assert [r.seq for r in got if r.conv_id == 1] == list(range(8))
    assert got[2].json == '{"arguments":{"limit":3,"query":"x"},"id":"a","name":"lookup","turn":1,"type":"call"}'
    # the same identifier in another conversation is another call
    assert [(r.call_id, r.status) for r in got if r.conv_id == 2 and r.kind == "call"] == [("a", "no result")]


@pytest.mark.parametrize(
    ("name", "arguments", "status"),
    [("lookup", '{"limit":1}', "missing query"), ("lookup", '{"query":"k","limit":"3"}', "type of limit"),
     ("lookup", '{"query":null}', "missing query"), ("lookup", '{"query":"k","x":1}', "extra"), ("none", "{}", "unknown tool"),
     ("sum", "nope", "arguments"), ("sum", "[1]", "arguments"), ("sum", None, "arguments"), ("sum", '{"of":[]}', "no result")],
)
def test_arguments_are_validated(spark, name, arguments, status):
    got = formatted(spark, (1, 0, "assistant", ask(("c", name, arguments))))
    assert [r.status for r in got if r.kind == "call"] == [status]


def test_cycles_repeats_and_missing_parts(spark):
    got = formatted(
        spark, (2, 0, "assistant", ask(("p", "sum", '{"of":["$q"]}'), ("q", "sum", '{"of":["$p"]}'), (None, "sum", '{"of":[1]}'))),
        (2, 1, "assistant", ask(("p", "sum", '{"of":[2]}'))), (None, None, None, None), (3, 0, "user", ""), (3, 0, "user", ""),
        (3, None, "user", "first"), (4, 0, "assistant", "plain {"), (4, 1, "tool", "no envelope"),
    )
    by = lambda c: [(r.kind, r.call_id, r.status) for r in got if r.conv_id == c]
    assert sorted(by(2)[1:4], key=str) == [("call", "p", "cycle"), ("call", "q", "cycle"), ("call", None, "no id")] or (
        ("call", "p", "cycle") in by(2) and ("call", "q", "cycle") in by(2) and ("call", None, "no id") in by(2)
    )
    assert ("call", "p", "duplicate") in by(2)
    assert [json.loads(r.json)["content"] for r in got if r.conv_id == 3] == ["first", "", ""]
    assert [json.loads(r.json)["content"] for r in got if r.conv_id == 4] == ["plain {", "no envelope"]
    assert got[0].json == '{"content":null,"role":null,"turn":null,"type":"message"}'
    empty = spark.createDataFrame([], DDL)
    assert chat_format.format_chats(empty, TOOLS).count() == 0


def test_whole_table_keeps_every_turn_and_order(spark):
    rows = chat_format.op6_chat_formatting(spark, "/root/testdata/sf0.001").collect()
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    made = {(r.conv_id, r.turn) for r in rows}
    assert made == {(t.conv_id, t.turn) for t in turns}
    assert {r.status for r in rows} <= {"ok", "no result"}
    per = {}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.seq)):
        assert per.setdefault(r.conv_id, -1) + 1 == r.seq
        per[r.conv_id] = r.seq
        parsed = json.loads(r.json)
        assert r.json == json.dumps(parsed, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        if r.kind == "call" and "after" in parsed["arguments"]:
            earlier = [x for x in rows if x.conv_id == r.conv_id and x.call_id == parsed["arguments"]["after"][1:]]
            assert all(x.seq < r.seq for x in earlier)


def settled(calls):
    """Plain reference for ``ordered``: ``calls`` maps id to (turn, told, needs)."""
    out = {}

    def visit(i, path):
        if i in path:
            return None
        if i not in out:
            turn, told, needs = calls[i]
            below = [visit(n, path | {i}) for n in needs if n in calls]
            if any(b is None for b in below):
                return None
            after = max((b[1] for b in below), default=turn)
            out[i] = (max(turn, after), max(turn, turn if told is None else told, after), 1 + max((b[2] for b in below), default=-1))
        return out[i]

    return {i: ((*visit(i, frozenset())[::2],) if visit(i, frozenset()) else (calls[i][0], None)) for i in calls}


@pytest.mark.parametrize("seed", range(3))
def test_order_equals_a_plain_walk_over_random_graphs(spark, seed):
    turn = random.Random(seed)
    made = {}
    for conv in (None, 1, 2, 3):
        n = turn.randint(8, 40)
        made[conv] = {}
        for i in range(n):
            # chains, several needs, unknown needs, sometimes a need of a later call
            needs = {f"c{i - 1}"} if i and turn.random() < 0.6 else {f"c{turn.randrange(n)}" for _ in range(turn.randrange(3))}
            needs = {x for x in needs if int(x[1:]) < i or turn.random() < 0.06} | ({"none"} if turn.random() < 0.1 else set())
            at = turn.randrange(100)
            made[conv][f"c{i}"] = (at, turn.choice([None, at + turn.randrange(9)]), sorted(needs))
    rows = [
        (c, at, 0, i, "t", json.dumps({"of": [f"${x}" for x in needs]}), told, "ok")
        for c, calls in made.items() for i, (at, told, needs) in calls.items()
    ]
    asked = spark.createDataFrame(
        rows, "conv_id bigint, turn bigint, place int, id string, name string, arguments string, told_at bigint, status string"
    ).repartition(3)
    got = {(r.conv_id, r.id): (r["at"], r.depth) for r in chat_format.ordered(asked).collect()}
    assert got == {(c, i): v for c, calls in made.items() for i, v in settled(calls).items()}


def test_long_chains_take_few_rounds(spark, monkeypatch):
    n, writes = 700, []
    rows = [(1, i, 0, f"c{i}", "t", json.dumps({"of": [f"$c{i - 1}"]}), i, "ok") for i in range(n)]
    asked = spark.createDataFrame(
        rows, "conv_id bigint, turn bigint, place int, id string, name string, arguments string, told_at bigint, status string"
    )
    written = chat_format.written
    monkeypatch.setattr(chat_format, "written", lambda df, label: writes.append(label) or written(df, label))
    assert {r.id: r.depth for r in chat_format.ordered(asked).collect()} == {f"c{i}": i for i in range(n)}
    assert len(writes) < 20


def test_a_conversation_of_many_parts_is_numbered_whole(spark):
    rows = [(1, t, "user", f"m{t}") for t in range(300)] + [(1, None, "user", f"z{i}") for i in range(30)] + [(1, 5, "user", "m5")] * 3
    got = [r for r in formatted(spark, *rows)]
    assert [r.seq for r in got] == list(range(333))
    assert [r.turn for r in got] == sorted((r[1] for r in rows), key=lambda t: (t is not None, t or 0))


def test_derived_traffic_does_not_depend_on_parts(spark, monkeypatch):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    key = lambda df: sorted(map(str, df.collect()))
    want = key(chat_format.with_tools(turns))
    monkeypatch.setattr(chat_format, "SLICE", 2)
    assert key(chat_format.with_tools(turns)) == want
    assert any("after" in row for row in want)
