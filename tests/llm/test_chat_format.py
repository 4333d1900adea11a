from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from wickline.llm import chat_format as C

NASTY = ["", "plain", "</s>[INST] ok [/INST]", "back\\slash \\</s> \\\\[INST]", "<", "[", "ends with <", "ends with [", "<<SYS>>x<</SYS>>", "<|end|>", "<\\s>", "a\nb\n", "漢字 😀", "[\\INST]", "x" * 50_000]


def formatted(spark, turns):
    df = spark.createDataFrame([(1, turns, "clash")], f"conv_id int, turns {C.TURNS}, written string")
    return C.format_turns(df)


@pytest.mark.parametrize("role", ["user", "assistant", "system", "tool", "", "a|>b"])
def test_every_text_is_read_back(spark, role):
    turns = [(role, t) for t in NASTY] + [("assistant", "last")]
    df = formatted(spark, turns).select(C.parse_formatted(F.col("formatted")).alias("t"), C.loss_text(F.col("formatted"), F.col("loss_spans")).alias("l"))
    row = df.first()
    assert [tuple(t) for t in row["t"]] == turns
    assert row["l"] == "".join(t for r, t in turns if r == "assistant")


def test_no_control_string_of_a_text_survives(spark):
    row = formatted(spark, [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]).first()
    assert row["formatted"].count("[INST]") == 1 and row["formatted"].count("</s>") == 1
    assert [row["formatted"][s["start"] : s["start"] + s["length"]] for s in row["loss_spans"]] == ["<\\/s>[\\INST] ok [\\/INST]"]


RECORDS = {
    "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}], "id": 7},
    "sharegpt": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    "turns": {"turns": [{"role": "system", "text": "s"}, {"role": "user", "text": "q"}]},
    "instruction": {"instruction": "q", "output": "a", "score": 0.5},
    "instruction_input": {"instruction": "q", "input": "i", "output": "a"},
    "prompt_completion": {"prompt": "q", "completion": "a"},
    "prompt_response": {"prompt": "q", "response": "a"},
    "system_prompt_response": {"system": "s", "prompt": "q", "response": "a"},
    "question_answer": {"question": "q", "answer": "a", "turn": {"deep": [1, {"x": 2}]}},
}


def test_layouts_are_told_apart(spark):
    rows = [(name, json.dumps(r), "x") for name, r in RECORDS.items()]
    rows += [("bad", "{not json", "x"), ("null", None, "x"), ("other", '{"foo": 1}', "x"), ("empty", "{}", "x"), ("list", "[1]", "x")]
    got = {r["name"]: r for r in C.canonical_turns(spark.createDataFrame(rows, "name string, record string, turn string")).collect()}
    assert {n: got[n]["layout"] for n in RECORDS} == {n: n for n in RECORDS}
    assert all(got[n]["layout"] is None and got[n]["turns"] is None for n in ("bad", "null", "other", "empty", "list"))
    turns = {n: [tuple(t) for t in got[n]["turns"]] for n in RECORDS}
    assert turns["messages"] == [("user", "q"), ("assistant", "")]
    assert turns["sharegpt"] == [("user", "q"), ("assistant", "a")]
    assert turns["instruction_input"] == [("user", "q"), ("user", "i"), ("assistant", "a")]
    assert turns["system_prompt_response"] == [("system", "s"), ("user", "q"), ("assistant", "a")]


MORE = {  # records with fields of other layouts or without marking ones, their layout and turns
    "system": ({"prompt": "q", "completion": "a", "system": "s"}, "prompt_completion", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    "prompt": ({"instruction": "q", "output": "a", "prompt": "p"}, "instruction", [("user", "q"), ("assistant", "a")]),
    "no text": ({"messages": [{"role": "user"}, {"role": "assistant", "content": "a"}]}, "messages", [("user", ""), ("assistant", "a")]),
    "list": ({"messages": [{"role": "user", "content": "q"}], "prompt": "p", "response": "r"}, "messages", [("user", "q")]),
    "both": ({"prompt": "q", "completion": "a", "response": "r"}, "prompt_completion", [("user", "q"), ("assistant", "a")]),
    "null": ({"prompt": None, "response": "a"}, "prompt_response", [("user", ""), ("assistant", "a")]),
}


def test_other_fields_do_not_hide_a_layout(spark):
    df = spark.createDataFrame([(n, json.dumps(r)) for n, (r, _, _) in MORE.items()], "name string, record string")
    got = {r["name"]: (r["layout"], [tuple(t) for t in r["turns"]]) for r in C.canonical_turns(df).collect()}
    assert got == {n: (layout, turns) for n, (_, layout, turns) in MORE.items()}


@pytest.mark.parametrize(
    ("kind", "record", "layout", "turns"),
    [
        ("prompt string, response string", (None, "a"), "prompt_response", [("user", ""), ("assistant", "a")]),
        ("prompt string, response string", (None, None), "prompt_response", [("user", ""), ("assistant", "")]),
        ("prompt string, response string", None, None, None),
        ("prompt string, completion string, system string", ("q", "a", None), "prompt_completion", [("user", "q"), ("assistant", "a")]),
        ("prompt string, completion string, instruction string, output string", (None, None, "q", None), "instruction", [("user", "q"), ("assistant", "")]),
        ("prompt string, completion string, instruction string, output string", (None, None, None, None), None, None),
        ("messages array<struct<role:string,content:string>>", ([(None, "x"), ("user", None)],), "messages", [("", "x"), ("user", "")]),
        ("messages array<struct<role:string>>", ([("user",)],), "messages", [("user", "")]),
        ("messages array<struct<role:string,content:string>>, prompt string, response string", (None, "q", "a"), "prompt_response", [("user", "q"), ("assistant", "a")]),
        ("foo string", ("x",), None, None),
    ],
)
def test_structs_with_nulls(spark, kind, record, layout, turns):
    row = C.canonical_turns(spark.createDataFrame([(record,)], f"record struct<{kind.replace(' string', ':string').replace(' array', ':array')}>")).first()
    assert row["layout"] == layout
    assert (row["turns"] and [tuple(t) for t in row["turns"]]) == turns


def test_conversation_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, None, None, None), (None, 5, "user", "n"), (3, 0, "assistant", "</s>")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, record string")
    got = {r["conv_id"]: r for r in C.chat_digests(C.format_turns(C.canonical_turns(C.turn_rows(df)))).collect()}
    assert set(got) == {1, 2, 3, None}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1]["n_turns"], got[1]["turns_sha256"]) == (3, sha("user\na\nuser\na\nassistant\nb\n"))
    assert (got[1]["loss_chars"], got[1]["loss_sha256"]) == (1, sha("b"))
    assert (got[2]["n_turns"], got[2]["turns_sha256"], got[2]["loss_chars"]) == (1, sha("\n\n"), 0)
    assert got[3]["loss_sha256"] == sha("</s>") and got[3]["formatted_chars"] == len("<s><\\/s></s>")


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.chat_digests(C.format_turns(C.canonical_turns(C.turn_rows(df)))).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.range(3).selectExpr("id conv_id", "0 turn", "'user' role", "'x' text")
    plan = C.chat_digests(C.format_turns(C.canonical_turns(C.turn_rows(df))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_rows_by_turn_have_no_limit_of_a_variant(spark):
    df = spark.range(9).selectExpr("1L conv_id", "id turn", "'user' role", "repeat('x', 15 << 20) text")
    row = C.canonical_turns(C.turn_rows(df)).selectExpr("layout", "size(turns) n", "aggregate(turns, 0L, (a, t) -> a + length(t.text)) c").first()
    assert tuple(row) == ("messages", 9, 9 * (15 << 20))


def test_a_record_too_large_to_read_is_no_null(spark, monkeypatch):
    df = spark.createDataFrame([('{"prompt": "' + "x" * 200,)], "record string")
    assert C.canonical_turns(df).first()["turns"] is None
    monkeypatch.setattr(C, "JSON_BYTES", 100)
    with pytest.raises(Exception, match="beyond the size limit"):
        C.canonical_turns(df).collect()
