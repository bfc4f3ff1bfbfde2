"""Inputs that the queries share, as DataFrames and as the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.config import Config, Rule, narration_rule
from chatloom.operators.parsing import nest, render
from chatloom.sources.conversations import read_turns

#: Patterns that the test tables' invented words meet now and then; callers bring their own.
RULES = (
    Rule(0, "any", r"idiot|moron|scum", "abuse"),
    narration_rule(1),
    Rule(2, "assistant", r"trash|loser", "abuse_assistant"),
    Rule(3, "assistant", r"(^|[^\p{L}\p{N}_])(ich|je|yo)([^\p{L}\p{N}_]|$)", "human_claim"),
    Rule(4, "assistant", r"onhaha|enßte", "denies_ai"),
    Rule(5, "assistant", r"ouaux|ingthe", "claims_ai"),
)
WORDS = {"the": "that", "and": "plus", "der": "jener", "les": "ces", "que": "quien", "of": "from"}
CFG = Config(
    persona="assistant", min_turns=4, max_turns=24, rules=RULES, words=WORDS,
    scene_patterns=("thth[a-z]+",), overused_stems=("tion", "keit"), refusal_phrases=("on the", "in der"),
)
PROMPT = "You are a helpful companion."
DAY = "2024-02-01"

#: Oracle: turns without system messages, numbered anew; nested conversations; trimmed ones.
T = """t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn, role, text FROM conversations WHERE role <> 'system')"""
TRIM = (
    T
    + """, z AS (SELECT conv_id, count(*) AS n0, arg_max(role, turn) AS last FROM t GROUP BY conv_id),
o AS (SELECT t.*, n0 - CASE WHEN n0 % 2 = 1 AND last = 'user' THEN 1 ELSE 0 END AS n FROM t JOIN z USING (conv_id)),
w AS (SELECT * FROM o WHERE turn < n)"""
)
RENDERED = T + """, r AS (SELECT conv_id, string_agg(role || ': ' || text, chr(10) || chr(10) ORDER BY turn) AS text FROM t GROUP BY conv_id)"""
#: Defects by conversation, in words that both engines read: a double tag, a leading line, an emoji run, a stage direction, fences.
DEFECT = """CASE conv_id % 7
 WHEN 1 THEN replace(text, 'assistant: ', 'user: Assistant: ')
 WHEN 2 THEN concat('a line before', chr(10), text)
 WHEN 3 THEN concat(text, ' 😀😀 😀😀 and ⭐ ✨ 🎉 ⌚ the end')
 WHEN 4 THEN concat(text, ' *waves*')
 WHEN 5 THEN concat('```', chr(10), '{', text, '}', chr(10), '```')
 WHEN 6 THEN replace(text, 'user: ', '**User**: user: user: ')
 ELSE text END"""
RAW = RENDERED + f", raw AS (SELECT conv_id, {DEFECT} AS text FROM r)"


def turns(spark: SparkSession, d: str) -> DataFrame:
    """(conv_id, turn, role, text) without system messages, numbered anew from 0."""
    own = nest(read_turns(spark, f"{d}/conversations.parquet").where("role <> 'system'"))
    return own.select("conv_id", F.posexplode("turns").alias("turn", "t")).select("conv_id", "turn", "t.role", "t.text")


def convs(spark: SparkSession, d: str) -> DataFrame:
    return nest(read_turns(spark, f"{d}/conversations.parquet").where("role <> 'system'"))


def rendered(spark: SparkSession, d: str) -> DataFrame:
    return convs(spark, d).select("conv_id", render(F.col("turns"), "assistant").alias("text"))


def raw(spark: SparkSession, d: str) -> DataFrame:
    return rendered(spark, d).select("conv_id", F.expr(DEFECT).alias("text"))


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")
