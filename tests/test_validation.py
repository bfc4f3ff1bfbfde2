from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from chatloom.config import Config, Rule, narration_rule
from chatloom.functions import text as X
from chatloom.operators import phrases as PH
from chatloom.operators import validation as V

RULES = (Rule(0, "any", "curse", "abuse"), narration_rule(1), Rule(2, "assistant", "rude", "abuse_assistant"), Rule(3, "assistant", "i am human", "human_claim"), Rule(5, "assistant", "i am an ai", "claims_ai"))
CFG = Config(persona="Bot", rules=RULES, words={"tum": "aap"}, overused_stems=("sigh",), refusal_phrases=("cannot help",))
LONG = "One. Two. Three."


def chat(n, **change):
    """n turns; change: turn number (t3) to text."""
    return "\n\n".join(f"{'user' if i % 2 == 0 else 'Bot'}: {change.get(f't{i}', LONG)}" for i in range(n))


CASES = [
    ("", "invalid_format"), ("prose\n" + chat(8), "invalid_format"), (chat(7), "too_few_turns(6)"), (chat(9), "ok"), (chat(26), "too_many_turns(26)"),
    (chat(8) + "\n\nuser: x\n\nuser: y\n\nBot: z", "odd_turns(11)"), ("Bot: a\n\n" * 4 + "user: b\n\n" * 4, "bad_alternation(turn 0)"),
    (chat(8, t2="a curse"), "abuse"), (chat(8, t2="rude"), "ok"), (chat(8, t3="hm *waves* " + LONG, t1="I am an AI. b. c."), "claims_ai"),
    (chat(8, t1="hm *waves* I am human. b. c."), "narration_detected"), (chat(8, t1=LONG + " (short)"), "ok"), (chat(8, t1=LONG + " (longer aside)"), "narration_detected"),
    (chat(8, **{f"t{i}": "😀" for i in (1, 3, 5, 7)}), "no_words_in_conversation"), (chat(8, **{f"t{i}": "a\nb" for i in (1, 3, 5, 7)}), "no_turn_reaches_min_length(best=2)"),
]


def test_reasons(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "conv_id long, text string")
    got = {r.conv_id: r.reason for r in V.process(df, CFG).collect()}
    assert [got[i] for i in range(len(CASES))] == [r for _, r in CASES]


def test_flags_and_fixes(spark):
    rows = [(0, chat(8, t1="sigh sigh sigh. b. c.")), (1, chat(8, t1="sigh sigh sigh sigh. b. c.")), (2, chat(8, t1="Tum cannot help. b. c."))]
    out = {r.conv_id: (r.flags, r.fixes) for r in V.process(spark.createDataFrame(rows, "conv_id long, text string"), CFG).collect()}
    assert out == {0: ([], 0), 1: (["overused:sigh"], 0), 2: (["refusal"], 1)}


def one(spark, value, f):
    r = spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("r")).first().r
    return (r.text, r.n) if hasattr(r, "text") else r


@pytest.mark.parametrize(("text", "want"), [("tum Tum TUM tum_x", ("aap Aap AAP tum_x", 3)), ("x", ("x", 0)), ("", ("", 0))])
def test_replace_words(spark, text, want):
    assert one(spark, text, lambda c: X.replace_words(c, {"tum": "aap"})) == want


@pytest.mark.parametrize(("text", "want"), [("😀😀", ("😀😀", 0)), ("😀😀😀😀😀", ("😀😀", 1)), ("a😀 😀 ⭐ 😀 b", ("a😀😀 b", 1))])
def test_emoji_runs(spark, text, want):
    assert one(spark, text, X.collapse_emoji_runs) == want


def test_emoji_cap_squeezes(spark):
    assert one(spark, "😀 a 😀 b 😀 c 😀 d 😀 e 😀", lambda c: X.repaired(c, {}, 4)) == ("😀 a 😀 b 😀 c 😀 d e", 2)


@pytest.mark.parametrize(("text", "n"), [("a\nb", 2), ("a. b! c…", 3), ("a", 1), ("", 0), (" \n ", 0)])
def test_count_lines(spark, text, n):
    assert one(spark, text, X.count_lines) == n


def test_first_reason_takes_the_earlier_turn(spark):
    t = spark.createDataFrame([(1, 3, "assistant", "*x*"), (1, 1, "assistant", "i am an ai"), (2, 0, "user", "rude")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in V.first_reason(V.scan_rules(t, CFG)).collect()] == [(1, "claims_ai")]


def test_topic_bias_without_keywords_is_none(spark):
    df = spark.createDataFrame([("Grief and loss", "hard talk"), ("Games", None)], "t string, d string")
    bias = lambda heavy, fun: [r[0] for r in df.select(X.topic_bias(F.col("t"), F.col("d"), heavy, fun)).collect()]
    assert bias([], []) == [None, None] and bias([], ["GAME"]) == [None, "fun"] and bias(["rief"], ["g"]) == ["heavy", "fun"]


def test_long_texts_parse_in_time(spark):
    """Twenty thousand lines with double tags: the time grows with the lines."""
    import time

    rows = [(1, "\n".join("user: Bot: hi" if i % 3 == 0 else f"Bot: line {i}" if i % 3 == 1 else "more" for i in range(20_000)))]
    start = time.time()
    row = V.process(spark.createDataFrame(rows, "conv_id long, text string"), CFG).first()
    assert row.reason.startswith("too_many_turns") and time.time() - start < 60


TABLE = "rank int, scope string, kind string, pattern string"
TURN = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("whole", [16 << 20, 300])
def test_phrases_are_those_of_a_plain_search(spark, monkeypatch, whole):
    """Phrases of one byte to many, within each other, over row ends, beyond ASCII, in capitals; one pass and several; odd rows."""
    monkeypatch.setattr(PH, "PASS_BYTES", whole)
    rnd = random.Random(whole)
    some = lambda n: "".join(rnd.choice("abcdé 😀") for _ in range(n))
    texts = [some(rnd.randint(0, 80)) for _ in range(120)] + [None, "", "ab", "x" * 9000 + "abcd", "ABCD É"]
    rows = [(i, i % 3, ["user", "assistant"][i % 2], t) for i, t in enumerate(texts)]
    rows += rows[:3]
    phrases = {some(rnd.randint(1, 9)) for _ in range(150)} | {"a", "é", "😀", "abcd", "ABCD", "d", "x" * 700}
    table = [(rnd.randrange(4), rnd.choice(["any", "assistant"]), f"k{rnd.randrange(9)}", p) for p in sorted(phrases)] + [(0, "any", "again", "a"), (1, "any", "none", ""), (1, "any", "none", None)]
    got = {tuple(r) for r in PH.scan_phrases(spark.createDataFrame(rows, TURN), spark.createDataFrame(table, TABLE)).collect()}
    want = {(i, t, rank, kind) for i, t, role, text in rows for rank, scope, kind, p in table if p and text and p.lower() in text.lower() and (scope == "any" or role == "assistant")}
    assert got == want and len(got) > 500


def test_a_hundred_thousand_phrases_in_one_pass(spark):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 9)))
    words = [word() for _ in range(3000)]
    phrases = sorted({" ".join(rnd.choice(words) for _ in range(rnd.randint(2, 4))) for _ in range(100_000)})
    texts = [(i, " ".join(rnd.choice(words) for _ in range(60)) + " " + rnd.choice(phrases)) for i in range(200)]
    found = PH.find_phrases(spark.createDataFrame(texts, "row long, text string"), spark.createDataFrame(list(enumerate(phrases)), "phrase_id long, phrase string"))
    want = {(i, k) for k, p in enumerate(phrases) for i, t in texts if p in t}
    assert {tuple(r) for r in found.collect()} == want and len(want) >= 200
    assert PH.find_phrases(spark.createDataFrame(texts, "row long, text string"), spark.createDataFrame([], "phrase_id long, phrase string")).count() == 0


def test_repeated_phrases_count_conversations_not_turns(spark):
    rows = [(1, 0, "assistant", "a b c d"), (1, 1, "assistant", "a b c"), (2, 0, "assistant", "x A  B\nC"), (2, 1, "user", "b c d"), (3, 0, "assistant", None), (3, 1, "assistant", "x y x y x y")]
    got = {tuple(r) for r in V.repeated_phrases(spark.createDataFrame(rows, TURN), 3, 2).collect()}
    assert got == {("a b c", 2)}


def test_a_repair_makes_each_step_once(spark):
    df = spark.createDataFrame([("the foo 😀😀😀😀 x",)], "text string").select(X.repaired(F.col("text"), {"foo": "bar"}, 1).alias("r"))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert [plan.count(f"{x}(") for x in ("regexp_extract_all", "regexp_count", "map_contains_key")] == [2, 1, 1]
    assert tuple(df.first().r) == ("the bar 😀 x", 3)
