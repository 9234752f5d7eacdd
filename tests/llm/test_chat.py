"""Chat formatting: equal to SQL, and an exact round trip for any text."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from parcelflow.llm import chat
from parcelflow.llm.expected_sql import ORACLE
from parcelflow.llm.queries import QUERIES
from tests.compare import database, difference

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns string"


def rows_of(spark, turns):
    frame = spark.createDataFrame([(*t, "x", "y") for t in turns], SCHEMA)
    done = chat.format_conversations(frame).withColumn("turns", chat.read_back(F.col("formatted")))
    return {r.conv_id: r for r in done.withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}


def test_query_equals_sql(spark, tables):
    assert difference(QUERIES["op2_chat_format"](spark, tables), database(tables), ORACLE["op2_chat_format"]) is None


def test_template_merges_neighbours(spark):
    got = rows_of(spark, [(1, 2, "assistant", "c"), (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 3, "assistant", "d")])[1]
    assert got.formatted == "<s>[INST]user[TEXT]a[NEXT]b[/INST][ANS]assistant[TEXT]c[NEXT]d</s>"
    assert [got.formatted[s.start : s.end] for s in got.loss_spans] == ["c", "d"]
    assert [(t.role, t.text) for t in got.turns] == [("user", "a"), ("user", "b"), ("assistant", "c"), ("assistant", "d")]


def test_any_text_survives(spark):
    marks = ["[INST]", "[/INST]", "[ANS]", "[TEXT]", "[NEXT]", "</s>", "<s>", "[\\INST]", "<\\\\/s>", "\\", "[", "<", "$1", "é\n", "x", ""]
    dice = random.Random(5)
    turns = [
        (c, t, dice.choice(["user", "assistant", "system", "[ANS]"]), "".join(dice.choices(marks, k=dice.randrange(6))))
        for c in range(150)
        for t in range(dice.randrange(1, 6))
    ]
    got = rows_of(spark, turns)
    for conv_id, row in got.items():
        want = [(role, text) for c, _, role, text in turns if c == conv_id]
        assert [(t.role, t.text) for t in row.turns] == want
        assert row.loss == "".join(text for role, text in want if role == "assistant")


def test_nulls_ties_repeats_and_empty(spark):
    got = rows_of(spark, [(1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, "assistant", None)])
    assert [(t.role, t.text) for t in got[1].turns] == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert got[None].loss == "" and got[None].formatted == "<s>[ANS]assistant[TEXT]</s>"
    assert rows_of(spark, []) == {}


def test_long_conversation(spark):
    turns = [(1, t, "user" if t % 3 else "assistant", f"t{t}") for t in range(1500)]
    got = rows_of(spark, turns)[1]
    assert [(t.role, t.text) for t in got.turns] == [x[2:] for x in turns]
    assert got.loss == "".join(x[3] for x in turns if x[2] == "assistant")
