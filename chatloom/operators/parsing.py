"""Free text to turns, turns to text and to chat records. All in a row's own arrays: no shuffle.

Turns are an array of struct(role, text) with roles user and assistant. Line ends are brought to \\n first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.text import let, strip

TURNS = "array<struct<role:string,text:string>>"
FENCE = "```"


def _one_brace_off(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(col, r"^\{", ""), r"\}$", "")


def _without_fences(col: Column) -> Column:
    return F.array_join(F.filter(F.split(col, "\n"), lambda x: ~strip(x).startswith(FENCE)), "\n")


def clean_llm_text(col: Column) -> Column:
    """Trimmed; of a fenced answer the fence lines dropped; one brace off either end."""
    text = strip(F.regexp_replace(col, "\r\n?", "\n"))
    text = F.when(text.startswith(FENCE), strip(_without_fences(text))).otherwise(text)
    return strip(_one_brace_off(text))


def parse_json_pairs(col: Column, persona: str) -> Column:
    """Text of "speaker": "words" pairs, repeated keys kept in order, as tagged lines; other text as it is."""
    pair = rf'(?is)"\s*(user|{persona})\s*"\s*:\s*"((?:[^"\\]|\\.)*+)"'
    keys = F.regexp_extract_all(col, F.lit(pair), F.lit(1))
    values = F.regexp_extract_all(col, F.lit(pair), F.lit(2))

    def plain(v: Column) -> Column:
        return strip(F.replace(F.replace(F.replace(v, F.lit("\\n"), F.lit("\n")), F.lit('\\"'), F.lit('"')), F.lit("\\'"), F.lit("'")))

    lines = F.zip_with(
        keys, values, lambda k, v: F.when(plain(v) != "", F.concat(F.when(F.lower(k) == "user", F.lit("user")).otherwise(F.lit(persona)), F.lit(": "), plain(v)))
    )
    joined = F.array_join(F.filter(lines, lambda x: x.isNotNull()), "\n\n")
    return F.when(joined != "", joined).otherwise(col)


#: The speaker tags of the transcript format, bold or not, and two of them in one line.
TAG = r"(?is)^\s*\**(user|{0})\**\s*:\s*\**\s*(.*)$"
DOUBLE_TAG = r"(?is)^\s*\**(user|{0})\**\s*:\s*\**\s*\**(user|{0})\**\s*:\s*(.*)$"


def _tag(persona: str) -> str:
    return TAG.format(persona)


def _double(persona: str) -> str:
    return DOUBLE_TAG.format(persona)


def _sections(lines: Column, starts: Column) -> Column:
    """The lines after each line whose place (from 0) starts lists, up to the next such line."""
    ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(lines)))
    return F.zip_with(starts, ends, lambda s, e: F.slice(lines, s + 2, e - s - 1))


def _places(rows: Column, wanted: Callable[[Column], Column]) -> Column:
    """Places, from 0, of the rows that are wanted."""
    return F.filter(F.transform(rows, lambda x, i: F.when(wanted(x), i)), lambda i: i.isNotNull())


def tag_of(col: Column, persona: str) -> Column:
    """struct(role, content) of a line; role is null without a speaker tag."""
    who = F.lower(F.regexp_extract(col, _tag(persona), 1))
    role = F.when(who == "user", F.lit("user")).when(who != "", F.lit("assistant"))
    return F.struct(role.alias("role"), F.regexp_extract(col, _tag(persona), 2).alias("content"))


def fix_double_tags(col: Column, persona: str) -> Column:
    """struct(text, n): lines with two tags get one. Equal tags stand; else the speaker is not the previous one; without a previous the first stands.

    Lines whose speaker is given (one tag, or two equal ones) start runs; the lines with unequal tags after one take
    turns from its speaker on, and those before any take turns from the first's first tag on. So a line of letters,
    upper case for a given speaker, is cut into runs and every run alternates: linear in the lines.
    """
    role = lambda x: F.when(x == "", F.lit(None)).when(x == "user", F.lit("user")).otherwise(F.lit("assistant"))
    seen = F.transform(
        F.split(col, "\n"),
        lambda x: F.struct(
            x.alias("line"),
            role(F.lower(F.regexp_extract(x, _double(persona), 1))).alias("one"),
            role(F.lower(F.regexp_extract(x, _double(persona), 2))).alias("two"),
            F.regexp_extract(x, _double(persona), 3).alias("content"),
            role(F.lower(F.regexp_extract(x, _tag(persona), 1))).alias("tag"),
        ),
    )
    letter = lambda r: F.substring(r, 1, 1)
    other = lambda c: F.when(c == "u", F.lit("a")).otherwise(F.lit("u"))

    def mark(x: Column) -> Column:
        given = F.when(x["one"].isNull(), x["tag"]).when(x["one"] == x["two"], x["one"])
        return F.coalesce(F.upper(letter(given)), letter(x["one"]))

    def turned(run: Column) -> Column:
        first = F.lower(F.substring(run, 1, 1))
        return F.transform(F.sequence(F.lit(0), F.length(run) - 1), lambda k: F.when(k % 2 == 0, first).otherwise(other(first)))

    def shown(x: Column, r: Column) -> Column:
        tag = F.when(r == "u", F.lit("user: ")).otherwise(F.lit(f"{persona}: "))
        return F.when(x["one"].isNotNull(), F.concat(tag, x["content"])).otherwise(x["line"])

    def fixed(rows: Column) -> Column:
        tagged = F.filter(rows, lambda x: x["tag"].isNotNull())
        marks = F.array_join(F.transform(tagged, mark), "")
        speakers = F.flatten(F.transform(F.regexp_extract_all(marks, F.lit("[UA]?[ua]+|[UA]"), F.lit(0)), turned))
        lines = F.transform(rows, lambda x: x["line"])

        def joined(lines: Column, starts: Column) -> Column:
            heads = F.zip_with(tagged, speakers, shown)
            parts = F.zip_with(heads, _sections(lines, starts), lambda h, rest: F.concat(F.array(h), rest))
            return F.array_join(F.concat(F.slice(lines, F.lit(1), F.get(starts, F.lit(0))), F.flatten(parts)), "\n")

        return let(lines, lambda ls: let(_places(rows, lambda x: x["tag"].isNotNull()), lambda at: joined(ls, at)))

    def whole(rows: Column) -> Column:
        n = F.size(F.filter(rows, lambda x: x["one"].isNotNull()))
        return F.struct(F.when(n > 0, fixed(rows)).otherwise(col).alias("text"), n.alias("n"))

    return let(seen, whole)


def body_lines(col: Column) -> Column:
    """Array of the trimmed lines that aren't blank, fences and outer braces gone."""
    body = _one_brace_off(strip(_without_fences(strip(col))))
    return F.filter(F.transform(F.split(body, "\n"), strip), lambda x: x != "")


def explode_lines(df: DataFrame) -> DataFrame:
    """(conv_id, line_no, line) of df(conv_id, text)."""
    return df.select("conv_id", F.posexplode(body_lines(F.col("text"))).alias("line_no", "line"))


def lines_to_turns(lines: Column, persona: str) -> Column:
    """Tagged lines open turns, others continue them; empty turns go; null if a line stands before the first tag. Linear in the lines."""
    tagged = F.transform(lines, lambda x: F.struct(x.alias("line"), tag_of(x, persona).alias("t")))

    def turn(head: Column, rest: Column) -> Column:
        own = F.filter(F.concat(F.array(strip(head["t"]["content"])), rest), lambda x: x != "")
        return F.struct(head["t"]["role"].alias("role"), F.array_join(own, "\n").alias("text"))

    def turns(rows: Column) -> Column:
        is_head = lambda x: x["t"]["role"].isNotNull()
        plain = F.transform(rows, lambda x: x["line"])
        rest = let(plain, lambda ls: let(_places(rows, is_head), lambda at: _sections(ls, at)))
        own = F.filter(F.zip_with(F.filter(rows, is_head), rest, turn), lambda t: t["text"] != "")
        bad = (F.size(rows) > 0) & F.get(rows, F.lit(0))["t"]["role"].isNull()
        return F.when(~bad, own)

    return let(tagged, turns)


def parse_turns(df: DataFrame, persona: str) -> DataFrame:
    """df(text, …) with tag_fixes (of the first pass) and turns (null: no valid format). Triple tags take the second pass."""
    one = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "\r\n?", "\n")

    # A generator after each step keeps the optimizer from repeating it wherever its result is named.
    def step(rows: DataFrame, value: Column, name: str) -> DataFrame:
        return rows.select("*", F.explode(F.array(value)).alias(name))

    out = step(df, fix_double_tags(one, persona), "_one")
    out = step(out, fix_double_tags(F.col("_one.text"), persona), "_two")
    out = step(out.withColumn("tag_fixes", F.col("_one.n")).drop("_one"), body_lines(F.col("_two.text")), "_lines").drop("_two")
    return step(out, lines_to_turns(F.col("_lines"), persona), "turns").drop("_lines")


def nest(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) of turns(conv_id, turn, role, text), in order of turn; one shuffle on conv_id."""
    rows = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return turns.groupBy("conv_id").agg(F.transform(rows, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def unnest(convs: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of convs(conv_id, turns)."""
    return convs.select("conv_id", F.posexplode("turns").alias("turn", "t")).select("conv_id", "turn", "t.role", "t.text")


def render(turns: Column, persona: str) -> Column:
    """speaker: words, a blank line between turns."""
    shown = lambda t: F.concat(F.when(t["role"] == "user", F.lit("user")).otherwise(F.lit(persona)), F.lit(": "), t["text"])
    return F.array_join(F.transform(turns, shown), "\n\n")


def to_chatml(turns: Column, system_prompt: str) -> Column:
    """JSON of the system message and the turns."""
    message = lambda role, text: F.struct(role.alias("role"), text.alias("content"))
    return F.to_json(F.struct(F.concat(F.array(message(F.lit("system"), F.lit(system_prompt))), F.transform(turns, lambda t: message(t["role"], t["text"]))).alias("messages")))
