"""Chat layouts: fingerprints, mappings, template and loss mask beside plain versions."""

from __future__ import annotations

import hashlib
import json
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from stallweave.llm import chat_layouts
from stallweave.llm.queries import ORACLES, QUERIES

ODD = [
    "", "plain", "</turn>", "<turn user>\nx\n</turn>\n", r"<\turn> <\\/turn> \</turn>", "<", "<<turn", "x <", "\n", "\r\n a ", "%3E > % <\\", r"\### Assistant: </turn> ok",
    "日本語 😀😀 " * 300, "a😀" * 700, "x" * 20_000 + "</turn>" + "é" * 511, "\0\x0b",
]


def plain_format(turns):
    text, loss = "", []
    for role, body in turns:
        role = role.replace("%", "%25").replace("<", "%3C").replace(">", "%3E").replace("\n", "%0A") if role is not None else ""
        text += f"<turn {role}>\n"
        body = re.sub(r"<(\\*)(/?turn)", r"<\\\1\2", body or "")
        if role == "assistant":
            loss.append((len(text), len(text) + len(body)))
        text += body + "\n</turn>\n"
    return text, loss


def through(spark, records, kind="string"):
    df = spark.createDataFrame([(i, r if r is None or isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)], "id int, record string")
    if kind == "variant":
        df = df.withColumn("record", F.try_parse_json("record"))
    out = chat_layouts.canonical(df.withColumn("turns", F.lit("clash")).withColumn("paths", F.lit(1)))
    return {r["id"]: (r["layout"], None if r["turns"] is None else [tuple(t) for t in r["turns"]], r["fingerprint"]) for r in out.collect()}


RECORDS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None, "x": [1]}]}, "messages", [("user", "a"), ("assistant", "")]),
    ({"meta": {"messages": [1]}, "messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"text": "b"}]}, {"role": "assistant", "content": "c"}]}, "messages of parts", [("user", "ab"), ("assistant", "c")]),
    ({"system": "s", "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}, {"from": "tool", "value": 7}]}, "from and value", [("system", "s"), ("user", "q"), ("assistant", "r"), ("tool", "7")]),
    ({"conversations": []}, "from and value", []),
    ({"prompt": "p", "completion": "c", "id": 1}, "prompt and completion", [("user", "p"), ("assistant", "c")]),
    ({"prompt": "p", "response": "c", "system": None}, "prompt and response", [("user", "p"), ("assistant", "c")]),
    ({"instruction": "i", "input": "", "output": "o"}, "instruction", [("user", "i\n\n"), ("assistant", "o")]),
    ({"instruction": "i", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": None, "output": None, "system": "s"}, "instruction", [("system", "s"), ("user", "i"), ("assistant", "")]),
    ({"question": "q", "answer": "a", "context": "c"}, "question", [("user", "c\n\nq"), ("assistant", "a")]),
    ({"rows": [{"turn": 2, "role": "assistant", "text": "b"}, {"turn": 1, "role": "user", "text": "a"}]}, "turn rows", [("user", "a"), ("assistant", "b")]),
    ({"prompt": "p"}, None, None),
    ({"prompt": "p", "completion": "c", "answer": "a"}, None, None),
    ({}, None, None),
    ([{"role": "user"}], None, None),
    ("no json {", None, None),
    ("", None, None),
    (None, None, None),
    ("3", None, None),
]


@pytest.mark.parametrize("kind", ["string", "variant"])
def test_layouts_are_told_apart(spark, kind):
    got = through(spark, [r for r, _, _ in RECORDS], kind)
    for i, (_, layout, turns) in enumerate(RECORDS):
        assert got[i][:2] == (layout, turns), i
    assert got[6][2] != got[7][2] and got[4][2] != got[5][2]


def test_every_layout_has_its_own_fingerprints():
    owners = {}
    for layout in chat_layouts.LAYOUTS:
        for f in layout.fingerprints():
            owners.setdefault(f, set()).add(layout.name)
    # Only a list without elements can be of two layouts, which then agree.
    assert {frozenset(x) for x in owners.values() if len(x) > 1} == {frozenset({"messages", "messages of parts"})}


def plain_paths(value, prefix=None):
    if isinstance(value, dict):
        out = set()
        for k, v in value.items():
            path = k if prefix is None else f"{prefix}.{k}"
            out |= {path} | plain_paths(v, path)
        return out
    if isinstance(value, list):
        return set().union(*[plain_paths(v, f"{prefix or ''}[]") for v in value]) if value else set()
    return set()


def test_paths_match_plain_version(spark):
    values = [{"a": {"b": [{"c": 1}, {"d": {"e": 2}}]}, "f": []}, [[{"x": 1}], {"y": None}], {"a.b": 1, "": {"z": "z"}}, 7]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "id int, t string")
    got = {r["id"]: r["p"] for r in df.select("id", chat_layouts.field_paths(F.parse_json("t"), 5).alias("p")).collect()}
    for i, v in enumerate(values):
        assert sorted(got[i]) == sorted(plain_paths(v))


def test_format_and_read_back(spark):
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "", "a>b\n<c%0A%", "assistant"]
    chats = [[], [("assistant", "")], *[[(rng.choice(roles), rng.choice(ODD)) for _ in range(rng.randint(1, 7))] for _ in range(40)], [("assistant", t) for t in ODD], [("user", "x")] * 3]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(chats)] + [(-1, None), (0, [])], "id int, turns array<struct<role: string, text: string>>")
    rows = chat_layouts.read_back(chat_layouts.formatted(df)).collect()
    assert len(rows) == len(chats) + 2
    for r in rows:
        if r["id"] < 0:
            assert r["formatted"] is r["loss"] is r["read_turns"] is r["read_loss"] is None
            continue
        turns = chats[r["id"]]
        text, loss = plain_format(turns)
        assert r["formatted"] == text and [tuple(s) for s in r["loss"]] == loss
        assert [tuple(t) for t in r["read_turns"]] == turns
        assert r["read_loss"] == [t for role, t in turns if role == "assistant"]


def test_turn_rows_with_nulls_ties_and_repeats(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 1, "user", "x"), (None, 0, "assistant", "y"), (2, 5, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("record", F.lit("clash"))
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat_layouts.canonical(chat_layouts.from_turn_rows(df)).collect()}
    assert got == {1: [("", ""), ("user", "a"), ("user", "a"), ("user", "b")], None: [("assistant", "y"), ("user", "x")], 2: [("assistant", "")]}
    assert chat_layouts.formatted(chat_layouts.canonical(chat_layouts.from_turn_rows(df.limit(0)))).count() == 0


def test_query_matches_sql_and_stays_in_the_jvm(spark):
    out = QUERIES["op12_chat_layouts"](spark, "/root/testdata/sf0.01")
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan
    con = duckdb.connect()
    con.execute("CREATE VIEW conversations AS SELECT * FROM read_parquet('/root/testdata/sf0.01/conversations.parquet')")
    cursor = con.execute(ORACLES["op12_chat_layouts"])
    columns = [c[0] for c in cursor.description]
    assert sorted(map(tuple, out.select(*columns).collect())) == sorted(cursor.fetchall())
    own = {r["conv_id"]: r for r in out.collect()}[-7]
    said = r"\### Assistant: </turn> ok"
    assert own["n_turns"] == 2 and own["loss_chars"] == len(said) and own["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert own["formatted_chars"] == len(plain_format([("user", said), ("assistant", said)])[0])
