from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatloom.operators import parsing as P


def turns_of(spark, text, persona="bot"):
    row = P.parse_turns(spark.createDataFrame([(text,)], "text string"), persona).first()
    return row.tag_fixes, None if row.turns is None else [(t.role, t.text) for t in row.turns]


@pytest.mark.parametrize(
    ("text", "fixes", "turns"),
    [
        ("Bot: Bot: hi", 1, [("assistant", "hi")]),
        ("user: a\nuser: Bot: hi", 1, [("user", "a"), ("assistant", "hi")]),
        ("user: Bot: hi", 1, [("user", "hi")]),
        ("Bot: Bot: Bot: hi", 1, [("assistant", "hi")]),
        ("words first\nuser: a", 0, None),
        ("user: a\n\nBot:\n\nuser: b", 0, [("user", "a"), ("user", "b")]),
        ("**User**: a\nmore\r\nBOT: b", 0, [("user", "a\nmore"), ("assistant", "b")]),
        ("```\n{user: a}\n```", 0, [("user", "a")]),
        ("", 0, []),
        (None, 0, []),
    ],
)
def test_parse(spark, text, fixes, turns):
    assert turns_of(spark, text) == (fixes, turns)


def test_json_pairs_keep_repeated_keys(spark):
    df = spark.createDataFrame([('{"user": "a", "Bot": "b \\"c\\"\\nd", "user": "e"}',), ("plain",), ('"user": " "',)], "t string")
    out = [r[0] for r in df.select(P.parse_json_pairs(P.clean_llm_text(F.col("t")), "bot")).collect()]
    assert out == ['user: a\n\nbot: b "c"\nd\n\nuser: e', "plain", '"user": " "']


def test_clean_llm_text(spark):
    df = spark.createDataFrame([(" ```json\n{x}\n``` ",), ("{a}",), ("a",)], "t string")
    assert [r[0] for r in df.select(P.clean_llm_text(F.col("t"))).collect()] == ["x", "a", "a"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), st.text("abc .é", min_size=1).map(str.strip).filter(bool)), min_size=1, max_size=6), min_size=1, max_size=20))
def test_parse_undoes_render(spark, convs):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(convs)], f"conv_id long, turns {P.TURNS}")
    back = P.parse_turns(df.select("conv_id", P.render(F.col("turns"), "bot").alias("text")), "bot").orderBy("conv_id").collect()
    assert [[tuple(t) for t in r.turns] for r in back] == convs


def test_nest_and_unnest(spark):
    df = spark.createDataFrame([(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "user", "c")], "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, P.unnest(P.nest(df)).collect())) == [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "c")]
