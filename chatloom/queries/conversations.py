"""Queries on parsing, validation, repair and the sinks' columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.config import Config
from chatloom.functions import text as X
from chatloom.operators import parsing as P
from chatloom.operators import validation as V
from chatloom.operators.phrases import scan_phrases
from chatloom.operators.phrases import topic_bias as bias_of
from chatloom.queries.base import CFG, DAY, PROMPT, RAW, RENDERED, T, TRIM, WORDS, convs, raw, read, rendered, turns
from chatloom.queries.duplicates import MARKED
from chatloom.sources import conversations as S
from chatloom.sources.scratch import scratch, stored

#: Oracle: the tag patterns of the parser, for the persona of the queries, which both engines read alike.
TAG_SQL, DOUBLE_SQL = P.TAG.format("assistant"), P.DOUBLE_TAG.format("assistant")
#: Oracle: V6 on a column called text.
LINES = """CASE WHEN len([x FOR x IN string_split(text, chr(10)) IF trim(x, ' ' || chr(9) || chr(13)) <> '']) = 1
 THEN greatest(1, len(regexp_extract_all([x FOR x IN string_split(text, chr(10)) IF trim(x, ' ' || chr(9) || chr(13)) <> ''][1], '[.!?\\x{2026}]+(?:\\s|$)')))
 ELSE len([x FOR x IN string_split(text, chr(10)) IF trim(x, ' ' || chr(9) || chr(13)) <> '']) END"""
NORM = "regexp_replace(lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g')), '\\s+', ' ', 'g')"
STRUCTURE = (
    TRIM
    + """, s AS (SELECT conv_id, max(n) AS n, min(CASE WHEN turn < n AND role <> CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END THEN turn END) AS bad FROM o GROUP BY conv_id),
st AS (SELECT conv_id, n, CASE WHEN n = 0 THEN 'invalid_format' WHEN n < 4 THEN 'too_few_turns(' || n || ')' WHEN n > 24 THEN 'too_many_turns(' || n || ')'
 WHEN n % 2 = 1 THEN 'odd_turns(' || n || ')' WHEN bad IS NOT NULL THEN 'bad_alternation(turn ' || bad || ')' END AS reason FROM s)"""
)
BEST = f", bl AS (SELECT conv_id, max({LINES}) AS best FROM w WHERE role = 'assistant' GROUP BY conv_id)"


def _checked(spark, d):
    own = convs(spark, d).withColumn("turns", V.trimmed(F.col("turns")))
    t = F.col("turns")
    return own.withColumn("n_turns", F.size(t)).withColumn("reason", F.coalesce(V.structure_reason(t, 4, 24), V.alternation_reason(t)))


def structure_check(spark, d):
    return _checked(spark, d).select("conv_id", F.col("n_turns").cast("long"), "reason")


def alternation_check(spark, d):
    swapped = turns(spark, d).withColumn("role", F.expr("CASE WHEN conv_id % 3 = 0 AND turn = conv_id % 4 THEN 'user' ELSE role END"))
    return P.nest(swapped).select("conv_id", V.alternation_reason(F.col("turns")).alias("reason"))


def line_counts(spark, d):
    return turns(spark, d).select("conv_id", F.col("turn").cast("long"), X.count_lines(F.col("text")).cast("long").alias("n_lines"))


def min_length_check(spark, d):
    own = convs(spark, d).withColumn("turns", V.trimmed(F.col("turns"))).where(F.size("turns") > 0)
    return own.select("conv_id", V.best_lines(F.col("turns")).cast("long").alias("best"), V.min_length_reason(F.col("turns"), 3).alias("reason"))


def trainable(spark, d):
    """Which conversations are trainable, why not, and their hash."""
    own = _checked(spark, d)
    reason = F.coalesce("reason", V.min_length_reason(F.col("turns"), 3), F.lit("ok"))
    text = P.render(F.col("turns"), "assistant")
    return own.select("conv_id", (reason == "ok").alias("ok"), reason.alias("reason"), F.col("n_turns").cast("long"), X.content_hash(text).alias("hash"))


TRAINABLE = f"""WITH {STRUCTURE}{BEST}, rr AS (SELECT conv_id, string_agg(role || ': ' || text, chr(10) || chr(10) ORDER BY turn) AS text FROM w GROUP BY conv_id),
v AS (SELECT st.conv_id, coalesce(reason, CASE WHEN coalesce(best, 0) < 3 THEN 'no_turn_reaches_min_length(best=' || coalesce(best, 0) || ')' END, 'ok') AS reason, n, coalesce(text, '') AS text
 FROM st LEFT JOIN bl USING (conv_id) LEFT JOIN rr USING (conv_id))
SELECT conv_id, reason = 'ok' AS ok, reason, n::BIGINT AS n_turns, sha256({NORM}) AS hash FROM v"""


def reason_histogram(spark, d):
    from chatloom.operators.reporting import reason_histogram as histogram

    return histogram(trainable(spark, d).withColumn("flags", F.array().cast("array<string>")))


def outcome_histogram(spark, d):
    """Rejects by family and flags by kind of what the whole validation gives."""
    from chatloom.operators.reporting import reason_histogram as histogram

    return histogram(stored(V.process(raw(spark, d), CFG).select("ok", "reason", "flags"), "outcomes"))


def chatml_record(spark, d):
    return convs(spark, d).select("conv_id", P.to_chatml(F.col("turns"), PROMPT).alias("record"))


def double_tags(spark, d):
    fixed = P.fix_double_tags(F.col("text"), "assistant")
    return raw(spark, d).select("conv_id", fixed["n"].cast("long").alias("n_fixed"), fixed["text"].alias("text"))


#: A second copy of every conversation that differs in spaces only.
COPY = "replace(text, 'e ', 'e  ')"


def curate_job(spark, d):
    """The whole way from raw text to routed chat records; every conversation comes twice, so copies occur."""
    from chatloom.plans.jobs import curate

    own = raw(spark, d).select("conv_id", F.col("conv_id").alias("seq"), "text")
    again = own.select((F.col("conv_id") + 1_000_000_000).alias("conv_id"), (F.col("seq") + 1_000_000_000).alias("seq"), F.expr(COPY).alias("text"))
    out = curate(own.unionByName(again), CFG, PROMPT, DAY)
    return out.select("conv_id", "ok", "reason", "dup_reason", "bucket", "tag", F.sha2("record", 256).alias("record_hash"))


#: Oracle: the closed form of the double-tag rule by running counts, in the place of a fold.
DT = r"""
l AS (SELECT conv_id, i, ls[i] AS line FROM (SELECT conv_id, string_split({src}, chr(10)) AS ls, unnest(range(1, len(string_split({src}, chr(10))) + 1)) AS i FROM {rel})),
m AS (SELECT *, lower(regexp_extract(line, '<DOUBLE>', 1)) AS a, lower(regexp_extract(line, '<DOUBLE>', 2)) AS b,
  regexp_extract(line, '<DOUBLE>', 3) AS c, lower(regexp_extract(line, '<TAG>', 1)) AS s FROM l),
k AS (SELECT *, CASE WHEN a <> '' THEN CASE WHEN a = b THEN a END WHEN s <> '' THEN s END AS fixed_role, a <> '' AND a <> b AS mismatch FROM m),
g AS (SELECT *, count(fixed_role) OVER (PARTITION BY conv_id ORDER BY i) AS grp FROM k),
h AS (SELECT *, sum(mismatch::INT) OVER (PARTITION BY conv_id, grp ORDER BY i) AS j, first(fixed_role) OVER (PARTITION BY conv_id, grp ORDER BY i) AS base,
  first_value(a) OVER (PARTITION BY conv_id, grp ORDER BY CASE WHEN mismatch THEN i ELSE 1000000 + i END) AS f FROM g),
e AS (SELECT *, CASE WHEN a = '' THEN NULL WHEN a = b THEN a
  WHEN grp > 0 THEN CASE WHEN j % 2 = 0 THEN base WHEN base = 'user' THEN 'assistant' ELSE 'user' END
  ELSE CASE WHEN j % 2 = 1 THEN f WHEN f = 'user' THEN 'assistant' ELSE 'user' END END AS final FROM h)""".replace("<DOUBLE>", DOUBLE_SQL).replace("<TAG>", TAG_SQL)
DOUBLE = f"WITH {RAW}, {DT.format(src='text', rel='raw')} SELECT conv_id, sum((a <> '')::INT)::BIGINT AS n_fixed, string_agg(CASE WHEN a <> '' THEN final || ': ' || c ELSE line END, chr(10) ORDER BY i) AS text FROM e GROUP BY conv_id"


def parse_turns(spark, d):
    out = P.parse_turns(raw(spark, d), "assistant")
    return out.select("conv_id", F.col("tag_fixes").cast("long"), F.coalesce(F.size("turns"), F.lit(-1)).cast("long").alias("n_turns"), P.render(F.col("turns"), "assistant").alias("text"))


def _second(sql: str) -> str:
    """DT's names for a second pass."""
    for name in ("l", "m", "k", "g", "h", "e"):
        sql = sql.replace(f"\n{name} AS", f"\n{name}2 AS").replace(f"FROM {name})", f"FROM {name}2)")
    return sql


def _parsed(rel: str) -> str:
    """Oracle: from rel(conv_id, text), p1 with the fixes, q3(conv_id, turn, role, text) with turn 0 for lines before a tag, and q4 by conversation."""
    return rf"""{DT.format(src='text', rel=rel)},
p1 AS (SELECT conv_id, sum((a <> '')::INT) AS fixes, string_agg(CASE WHEN a <> '' THEN final || ': ' || c ELSE line END, chr(10) ORDER BY i) AS text FROM e GROUP BY conv_id),
{_second(DT.format(src='text', rel='p1'))},
p2 AS (SELECT conv_id, string_agg(CASE WHEN a <> '' THEN final || ': ' || c ELSE line END, chr(10) ORDER BY i) AS text FROM e2 GROUP BY conv_id),
p3 AS (SELECT conv_id, regexp_replace(array_to_string([x FOR x IN string_split(regexp_replace(text, '^\s+|\s+$', '', 'g'), chr(10)) IF NOT starts_with(ltrim(x), '```')], chr(10)), '^\s+|\s+$', '', 'g') AS text FROM p2),
p4 AS (SELECT conv_id, [trim(x) FOR x IN string_split(regexp_replace(regexp_replace(text, '^\{{', ''), '\}}$', ''), chr(10)) IF trim(x) <> ''] AS ls FROM p3),
q1 AS (SELECT conv_id, i, ls[i] AS line, lower(regexp_extract(ls[i], '{TAG_SQL}', 1)) AS who, regexp_extract(ls[i], '{TAG_SQL}', 2) AS said FROM (SELECT conv_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM p4)),
q2 AS (SELECT *, sum((who <> '')::INT) OVER (PARTITION BY conv_id ORDER BY i) AS turn FROM q1),
q3 AS (SELECT conv_id, turn, max(who) AS role, string_agg(CASE WHEN who <> '' THEN nullif(trim(said), '') ELSE line END, chr(10) ORDER BY i) AS text FROM q2 GROUP BY conv_id, turn),
q4 AS (SELECT conv_id, bool_or(turn = 0) AS bad, count(*) FILTER (text <> '') AS n, string_agg(role || ': ' || text, chr(10) || chr(10) ORDER BY turn) FILTER (text <> '') AS text FROM q3 GROUP BY conv_id)"""


PARSE = f"""WITH {RAW}, {_parsed('raw')}
SELECT p1.conv_id, fixes::BIGINT AS tag_fixes, CASE WHEN bad THEN -1 ELSE coalesce(n, 0) END::BIGINT AS n_turns, CASE WHEN bad THEN NULL ELSE coalesce(q4.text, '') END AS text
FROM p1 LEFT JOIN q4 USING (conv_id)"""


def explode_lines(spark, d):
    return P.explode_lines(raw(spark, d)).select("conv_id", F.col("line_no").cast("long"), "line")


EXPLODE = f"""WITH {RAW}, a AS (SELECT conv_id, regexp_replace(array_to_string([x FOR x IN string_split(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), chr(10)) IF NOT starts_with(ltrim(x), '```')], chr(10)), '^\\s+|\\s+$', '', 'g') AS text FROM raw),
b AS (SELECT conv_id, [regexp_replace(x, '^\\s+|\\s+$', '', 'g') FOR x IN string_split(regexp_replace(regexp_replace(text, '^\\{{', ''), '\\}}$', ''), chr(10)) IF regexp_matches(x, '\\S')] AS ls FROM a)
SELECT conv_id, (i - 1)::BIGINT AS line_no, ls[i] AS line FROM (SELECT conv_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM b)"""


def tag_of(spark, d):
    lines = P.explode_lines(raw(spark, d)).withColumn("t", P.tag_of(F.col("line"), "assistant"))
    return lines.groupBy("t.role").agg(F.count("*").alias("n"), F.sum(F.length("t.content")).alias("chars"))


TAGS = EXPLODE.rpartition("SELECT conv_id, (i")[0] + """, c AS (SELECT unnest(ls) AS line FROM b),
f AS (SELECT nullif(lower(regexp_extract(line, '@TAG@', 1)), '') AS role, regexp_extract(line, '@TAG@', 2) AS content FROM c)
SELECT role, count(*) AS n, sum(length(content))::BIGINT AS chars FROM f GROUP BY role""".replace("@TAG@", TAG_SQL)

def json_pairs(spark, d):
    """Turns as pairs with repeated keys; each fourth conversation stays plain."""
    one = F.transform("turns", lambda t: F.concat(F.lit('"'), t["role"], F.lit('": "'), F.replace(F.replace(t["text"], F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit('"')))
    text = F.when(F.col("conv_id") % 4 == 0, P.render(F.col("turns"), "assistant")).otherwise(F.concat(F.lit("{"), F.array_join(one, ", "), F.lit("}")))
    return convs(spark, d).select("conv_id", P.parse_json_pairs(P.clean_llm_text(text), "assistant").alias("text"))


PAIRS = f"""WITH {T} SELECT conv_id, string_agg(role || ': ' || regexp_replace(text, '^\\s+|\\s+$', '', 'g'), chr(10) || chr(10) ORDER BY turn) FILTER (regexp_matches(text, '\\S')) AS text FROM t GROUP BY conv_id"""


def rule_scan(spark, d):
    return V.scan_rules(turns(spark, d), CFG).select("conv_id", F.col("turn").cast("long"), F.col("rank").cast("long"), "reason")


HITS = (
    T
    + r""", hit AS (SELECT conv_id, turn, 0 AS rank, 'abuse' AS reason FROM t WHERE regexp_matches(lower(text), 'idiot|moron|scum')
 UNION ALL SELECT conv_id, turn, 1, 'narration_detected' FROM t WHERE role = 'assistant' AND regexp_matches(text, '(?m)\*[^*\n]+\*|(^|[^\p{L}\p{N}_])[A-Za-z]+\*\s*$|\([^)\n]{8,}\)')
 UNION ALL SELECT conv_id, turn, 2, 'abuse_assistant' FROM t WHERE role = 'assistant' AND regexp_matches(lower(text), 'trash|loser')
 UNION ALL SELECT conv_id, turn, 3, 'human_claim' FROM t WHERE role = 'assistant' AND regexp_matches(lower(text), '(^|[^\p{L}\p{N}_])(ich|je|yo)([^\p{L}\p{N}_]|$)')
 UNION ALL SELECT conv_id, turn, 4, 'denies_ai' FROM t WHERE role = 'assistant' AND regexp_matches(lower(text), 'onhaha|enßte')
 UNION ALL SELECT conv_id, turn, 5, 'claims_ai' FROM t WHERE role = 'assistant' AND regexp_matches(lower(text), 'ouaux|ingthe'))"""
)


def first_reason(spark, d):
    return V.first_reason(V.scan_rules(turns(spark, d), CFG))


def soft_flags(spark, d):
    return convs(spark, d).select("conv_id", F.array_join(V.soft_flags(F.col("turns"), CFG), ",").alias("flags"))


FLAGS = T + """, j AS (SELECT conv_id, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (role = 'assistant'), '') AS text FROM t GROUP BY conv_id),
fl AS (SELECT conv_id, concat_ws(',', CASE WHEN regexp_matches(text, '(?i)thth[a-z]+') THEN 'scene:thth[a-z]+' END,
 CASE WHEN len(regexp_extract_all(text, '(?i)tion')) > 3 THEN 'overused:tion' END, CASE WHEN len(regexp_extract_all(text, '(?i)keit')) > 3 THEN 'overused:keit' END,
 CASE WHEN regexp_matches(lower(text), 'on the|in der') THEN 'refusal' END) AS flags FROM j)"""


def has_words(spark, d):
    own = V.assistant_texts(F.col("turns"))
    return convs(spark, d).select("conv_id", F.array_join(own, "\n").rlike(X.LETTER).alias("has_words"))


def word_replace(spark, d):
    r = X.replace_words(F.col("text"), WORDS)
    return turns(spark, d).select("conv_id", F.col("turn").cast("long"), r["n"].cast("long").alias("n"), r["text"].alias("text"))


_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in WORDS.items()) + "}"
WORDSQL = f"""WITH {T}, p AS (SELECT conv_id, turn, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+') AS ps FROM t),
u AS (SELECT conv_id, turn, unnest(range(1, len(ps) + 1)) AS i, ps FROM p), x AS (SELECT conv_id, turn, i, ps[i] AS w, {_MAP}[lower(ps[i])] AS v FROM u)
SELECT conv_id, turn::BIGINT AS turn, count(v) AS n, string_agg(CASE WHEN v IS NULL THEN w WHEN length(w) > 1 AND w = upper(w) THEN upper(v)
 WHEN substr(w, 1, 1) = upper(substr(w, 1, 1)) THEN upper(substr(v, 1, 1)) || substr(v, 2) ELSE v END, '' ORDER BY i) AS text FROM x GROUP BY conv_id, turn"""

EMO = "concat(text, CASE conv_id % 4 WHEN 0 THEN ' 😀😀 😀😀 next' WHEN 1 THEN ' ⭐a✨b🎉c⌚d💖e🌸  end' WHEN 2 THEN ' 😀 😀 ok' ELSE ' 💖💖💖' END)"
_E = "[\\x{1F000}-\\x{1FAFF}\\x{2600}-\\x{27BF}\\x{2B00}-\\x{2BFF}\\x{2300}-\\x{23FF}]\\x{FE0F}?"
_RUNSQL = f"({_E})[ \\t]?({_E})[ \\t]?(?:{_E}[ \\t]?)*{_E}(?:( )|\\t)?"


def _emoji(spark, d):
    return turns(spark, d).select("conv_id", F.col("turn").cast("long").alias("turn"), F.expr(EMO).alias("text"))


def emoji_collapse(spark, d):
    r = X.collapse_emoji_runs(F.col("text"))
    return _emoji(spark, d).select("conv_id", "turn", r["text"].alias("text"), r["n"].cast("long").alias("n"))


def emoji_cap(spark, d):
    r = X.cap_emoji(F.col("text"), 4)
    return _emoji(spark, d).select("conv_id", "turn", X.squeeze_if_changed(r["text"], r["n"]).alias("text"), r["n"].cast("long").alias("n"))


CAPSQL = f"""WITH {T}, e AS (SELECT conv_id, turn, {EMO} AS text FROM t), s AS (SELECT conv_id, turn, regexp_extract_all(text, '{_E}') AS em, regexp_split_to_array(text, '{_E}') AS gs FROM e),
c AS (SELECT conv_id, turn, greatest(len(em) - 4, 0) AS n, array_to_string([gs[i] || CASE WHEN i <= least(len(em), 4) THEN em[i] ELSE '' END FOR i IN range(1, len(gs) + 1)], '') AS text FROM s)
SELECT conv_id, turn::BIGINT AS turn, n::BIGINT AS n, CASE WHEN n > 0 THEN regexp_replace(regexp_replace(text, '[ \\t]{{2,}}', ' ', 'g'), '(?m)[^\\S\\n]+$', '', 'g') ELSE text END AS text FROM c"""


def process(spark, d):
    out = V.process(raw(spark, d), CFG)
    return out.select("conv_id", "ok", "reason", F.array_join("flags", ",").alias("flags"), F.col("fixes").cast("long"), F.size("turns").cast("long").alias("n_turns"), F.sha2("text", 256).alias("text_hash"))


def _processed(rel: str) -> str:
    """Oracle: from rel(conv_id, text) res(conv_id, ok, reason, flags, fixes, n_turns, text, replies, messages): parse, check, repair, check again, flag."""
    hits = HITS.partition(", hit AS")[2].replace("FROM t WHERE", "FROM xw WHERE")
    norm = NORM.replace("(text,", "(f5.text,")
    return rf"""{_parsed(rel)},
xt AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn, role, text FROM q3 WHERE text <> '' AND conv_id IN (SELECT conv_id FROM q4 WHERE NOT bad)),
xz AS (SELECT conv_id, count(*) AS n0, arg_max(role, turn) AS last FROM xt GROUP BY conv_id),
xo AS (SELECT xt.*, n0 - CASE WHEN n0 % 2 = 1 AND last = 'user' THEN 1 ELSE 0 END AS n FROM xt JOIN xz USING (conv_id)),
xw AS (SELECT * FROM xo WHERE turn < n),
xs AS (SELECT conv_id, max(n) AS n, min(CASE WHEN turn < n AND role <> CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END THEN turn END) AS off FROM xo GROUP BY conv_id),
shape AS (SELECT r.conv_id, CASE WHEN coalesce(n, 0) = 0 THEN 'invalid_format' WHEN n < 4 THEN 'too_few_turns(' || n || ')' WHEN n > 24 THEN 'too_many_turns(' || n || ')'
 WHEN n % 2 = 1 THEN 'odd_turns(' || n || ')' WHEN off IS NOT NULL THEN 'bad_alternation(turn ' || off || ')' END AS reason FROM {rel} r LEFT JOIN xs USING (conv_id)),
hit AS{hits},
broken AS (SELECT conv_id, arg_min(reason, turn * 10 + rank) AS reason FROM hit GROUP BY conv_id),
good AS (SELECT conv_id FROM shape WHERE reason IS NULL AND conv_id NOT IN (SELECT conv_id FROM broken)),
f0 AS (SELECT conv_id, turn, role, text, regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+') AS ps FROM xw JOIN good USING (conv_id)),
f1 AS (SELECT conv_id, turn, role, CASE WHEN role = 'assistant' THEN len([x FOR x IN ps IF {_MAP}[lower(x)] IS NOT NULL]) ELSE 0 END AS n1,
  CASE WHEN role = 'assistant' THEN array_to_string([CASE WHEN {_MAP}[lower(x)] IS NULL THEN x WHEN length(x) > 1 AND x = upper(x) THEN upper({_MAP}[lower(x)])
   WHEN substr(x, 1, 1) = upper(substr(x, 1, 1)) THEN upper(substr({_MAP}[lower(x)], 1, 1)) || substr({_MAP}[lower(x)], 2) ELSE {_MAP}[lower(x)] END FOR x IN ps], '') ELSE text END AS text FROM f0),
f2 AS (SELECT conv_id, turn, role, n1, CASE WHEN role = 'assistant' THEN len(regexp_extract_all(text, '{_RUNSQL}')) ELSE 0 END AS n2,
  CASE WHEN role = 'assistant' THEN regexp_replace(text, '{_RUNSQL}', '\1\2\3', 'g') ELSE text END AS text FROM f1),
f3 AS (SELECT *, CASE WHEN role = 'assistant' THEN greatest(len(regexp_extract_all(text, '{_E}')) - 4, 0) ELSE 0 END AS n3, regexp_extract_all(text, '{_E}') AS em, regexp_split_to_array(text, '{_E}') AS gs FROM f2),
f4 AS (SELECT conv_id, turn, role, n1 + n2 + n3 AS fixed, n2 + n3 AS changed, CASE WHEN n3 > 0 THEN array_to_string([gs[i] || CASE WHEN i <= least(len(em), 4) THEN em[i] ELSE '' END FOR i IN range(1, len(gs) + 1)], '') ELSE text END AS text FROM f3),
f5 AS (SELECT conv_id, turn, role, fixed, CASE WHEN changed > 0 THEN regexp_replace(regexp_replace(text, '[ \t]{{2,}}', ' ', 'g'), '(?m)[^\S\n]+$', '', 'g') ELSE text END AS text FROM f4),
sums AS (SELECT conv_id, count(*) AS n_turns, sum(fixed) AS fixed, bool_or(role = 'assistant' AND regexp_matches(f5.text, '[A-Za-z\x{{0900}}-\x{{097F}}]')) AS worded,
  coalesce(max(CASE WHEN role = 'assistant' THEN {LINES.replace('(text,', '(f5.text,')} END), 0) AS best, coalesce(string_agg(f5.text, chr(10) ORDER BY turn) FILTER (role = 'assistant'), '') AS said,
  string_agg(role || ': ' || f5.text, chr(10) || chr(10) ORDER BY turn) AS text, list({{'role': role, 'content': f5.text}} ORDER BY turn) AS messages,
  coalesce(list({norm} ORDER BY turn) FILTER (role = 'assistant' AND regexp_matches(f5.text, '\S')), []) AS replies FROM f5 GROUP BY conv_id),
verdict AS (SELECT shape.conv_id, coalesce(shape.reason, broken.reason, CASE WHEN NOT worded THEN 'no_words_in_conversation' WHEN best < 3 THEN 'no_turn_reaches_min_length(best=' || best || ')' END, 'ok') AS reason
 FROM shape LEFT JOIN broken USING (conv_id) LEFT JOIN sums USING (conv_id)),
res AS (SELECT conv_id, reason = 'ok' AS ok, reason,
 CASE WHEN reason = 'ok' THEN concat_ws(',', CASE WHEN regexp_matches(said, '(?i)thth[a-z]+') THEN 'scene:thth[a-z]+' END, CASE WHEN len(regexp_extract_all(said, '(?i)tion')) > 3 THEN 'overused:tion' END,
  CASE WHEN len(regexp_extract_all(said, '(?i)keit')) > 3 THEN 'overused:keit' END, CASE WHEN regexp_matches(lower(said), 'on the|in der') THEN 'refusal' END) ELSE '' END AS flags,
 CASE WHEN reason = 'ok' THEN fixes + fixed ELSE 0 END::BIGINT AS fixes, CASE WHEN reason = 'ok' THEN n_turns ELSE 0 END::BIGINT AS n_turns, CASE WHEN reason = 'ok' THEN sums.text ELSE '' END AS text, replies, messages
 FROM verdict JOIN p1 USING (conv_id) LEFT JOIN sums USING (conv_id))"""


PROCESS = f"WITH {RAW}, {_processed('raw')} SELECT conv_id, ok, reason, flags, fixes, n_turns, sha256(text) AS text_hash FROM res"
OUTCOMES = f"""WITH {RAW}, {_processed('raw')} SELECT 'reject' AS kind, regexp_extract(reason, '^([a-z_]+)', 1) AS name, count(*) AS n FROM res WHERE NOT ok GROUP BY ALL
UNION ALL SELECT 'flag', split_part(f, ':', 1), count(*) FROM (SELECT unnest(string_split(flags, ',')) AS f FROM res WHERE ok AND flags <> '') GROUP BY ALL"""
ROUTED = f"""WITH {RENDERED}, {_processed('r')} SELECT CASE WHEN flags <> '' THEN 'flagged' ELSE 'batch' END AS bucket, CASE WHEN flags <> '' THEN 'flagged' ELSE 'batch-{DAY}' END AS tag, count(*) AS n FROM res WHERE ok GROUP BY ALL"""
#: The copies' raw text, then what an answer's fences and outer braces leave of it.
CURATED = rf"""WITH {RAW}, raw2 AS (SELECT conv_id, text FROM raw UNION ALL SELECT conv_id + 1000000000, {COPY} FROM raw),
c1 AS (SELECT conv_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS text FROM raw2),
c2 AS (SELECT conv_id, CASE WHEN starts_with(text, '```') THEN regexp_replace(array_to_string([x FOR x IN string_split(text, chr(10)) IF NOT starts_with(ltrim(x), '```')], chr(10)), '^\s+|\s+$', '', 'g') ELSE text END AS text FROM c1),
clean AS (SELECT conv_id, regexp_replace(regexp_replace(regexp_replace(text, '^\{{', ''), '\}}$', ''), '^\s+|\s+$', '', 'g') AS text FROM c2),
{_processed('clean')} SELECT * FROM res"""
#: Similarity of the accepted conversations by their replies, with the same SQL as the dedup queries.
CURATE = f"""WITH res AS MATERIALIZED ({CURATED}),
k AS (SELECT conv_id AS seq, sha256({NORM}) AS hash, CASE WHEN len(replies) > 0 THEN array_to_string(string_split(replies[1], ' ')[1:30], ' ') || ' ||| ' || array_to_string(string_split(replies[-1], ' ')[greatest(len(string_split(replies[-1], ' ')) - 19, 1):], ' ')
  ELSE substr({NORM}, 1, 200) END AS signature, CASE WHEN len(replies) > 0 THEN replies[1] ELSE '' END AS opening FROM res WHERE ok),
{MARKED}
SELECT res.conv_id, ok, reason, dup_reason, CASE WHEN dup_reason = 'unique' THEN CASE WHEN flags <> '' THEN 'flagged' ELSE 'batch' END END AS bucket,
 CASE WHEN dup_reason = 'unique' THEN CASE WHEN flags <> '' THEN 'flagged' ELSE 'batch-{DAY}' END END AS tag,
 CASE WHEN dup_reason = 'unique' THEN sha256(to_json({{'messages': [{{'role': 'system', 'content': '{PROMPT}'}}] || messages}})::VARCHAR) END AS record_hash
FROM res LEFT JOIN dr ON dr.conv_id = res.conv_id"""


def validate(spark, d):
    return V.validate(rendered(spark, d), CFG)


VALIDATE = f"""WITH {STRUCTURE}{BEST}, {HITS.partition(', hit AS')[1].lstrip(', ')}{HITS.partition(', hit AS')[2]},
fr AS (SELECT conv_id, arg_min(reason, turn * 10 + rank) AS rule FROM hit JOIN (SELECT conv_id, n FROM st) USING (conv_id) WHERE turn < n GROUP BY conv_id),
v AS (SELECT st.conv_id, coalesce(st.reason, rule, CASE WHEN coalesce(best, 0) < 3 THEN 'no_turn_reaches_min_length(best=' || coalesce(best, 0) || ')' END, 'ok') AS reason
 FROM st LEFT JOIN fr USING (conv_id) LEFT JOIN bl USING (conv_id))
SELECT conv_id, reason = 'ok' AS ok, CASE WHEN reason = 'ok' THEN 'ok' ELSE 'rejected: ' || reason END AS verdict FROM v"""


def topic_bias(spark, d):
    """Bias of every topic of the hierarchy; and none at all where there are no keywords."""
    from chatloom.queries.plans import _topics

    own = _topics(spark, d)
    bias = X.topic_bias(F.col("name"), F.col("definition"), ["An", "ru"], ["i"])
    return own.select("id", bias.alias("bias"), X.topic_bias(F.col("name"), F.col("definition"), [], []).alias("none"))


def topic_bias_table(spark, d):
    """Bias of the topics by keywords that are a table: ends of the names of every seventh customer are heavy ones, of every fifth fun ones."""
    from chatloom.queries.plans import _topics

    heavy = read(spark, d, "customer").where("c_custkey % 7 = 0").select(F.lit("heavy").alias("kind"), F.substring("c_name", -3, 3).alias("word"))
    fun = read(spark, d, "customer").where("c_custkey % 5 = 0").select(F.lit("fun").alias("kind"), F.substring("c_name", -2, 2).alias("word"))
    return bias_of(_topics(spark, d), heavy.unionByName(fun))


#: Rule lists as a configuration file gives them, in any case.
LISTS = {"abuse": ["IDIOT", "moron", "Scum"], "abuse_assistant": ["Trash", "LOSER"], "denies_ai": ["onHAha", "ENßte"], "claims_ai": ["Ouaux", "ingTHE"], "human_claim": []}
SCOPES = {"abuse": "any", "narration": "assistant", "abuse_assistant": "assistant", "human_claim": "assistant", "denies_ai": "assistant", "claims_ai": "assistant"}


def rule_table(spark, d):
    """The scan with rules that a table of patterns gives."""
    rules = S.rules_of(S.load_rules(spark, LISTS, SCOPES))
    return V.scan_rules(turns(spark, d), Config(rules=rules)).select("conv_id", F.col("turn").cast("long"), F.col("rank").cast("long"), "reason")


def chatml_file(spark, d):
    """Chat records written as JSON lines and read back."""
    path = scratch(spark, "chatml")
    S.write_chatml(convs(spark, d), path, PROMPT)
    return spark.read.text(path).select(F.col("value").alias("record"))


def routed_files(spark, d):
    """Records by bucket and tag as written, and whether every file holds a batch at most."""
    path = scratch(spark, "routed")
    S.write_routed(convs(spark, d).withColumn("flags", V.soft_flags(F.col("turns"), CFG)), path, DAY, PROMPT)
    files = spark.read.text(path).groupBy("bucket", "tag", F.input_file_name().alias("file")).agg(F.count("*").alias("n"))
    return files.groupBy("bucket", "tag").agg(F.sum("n").alias("n"), F.bool_and(F.col("n") <= 15).alias("fits"))


def convert_file(spark, d):
    """A file of JSON lines, every fifth without a conversation, to chat records: lines converted and skipped."""
    src, dst = scratch(spark, "lines"), scratch(spark, "converted")
    line = F.when(F.col("conv_id") % 5 == 0, F.lit('{"other": 1}')).otherwise(S.wrap_legacy(F.col("text")))
    rendered(spark, d).select(line.alias("value")).write.text(src)
    ok, bad = S.convert_file(spark, src, dst, CFG, PROMPT)
    return spark.read.text(dst).agg(F.count("*").alias("written")).select("written", F.lit(ok).cast("long").alias("ok"), F.lit(bad).cast("long").alias("bad"))


def routed_tags(spark, d):
    return S.routed(_flagged(spark, d), DAY).select("conv_id", "bucket", "tag")


def _flagged(spark, d):
    return convs(spark, d).select("conv_id", V.soft_flags(F.col("turns"), CFG).alias("flags"), F.col("conv_id").alias("seq"))


def assign_batches(spark, d):
    own = S.routed(_flagged(spark, d), DAY).withColumn("day", F.lit(DAY))
    return S.assign_batches(own, 15).select("conv_id", "batch_no", "batch_id")


def batch_log(spark, d):
    own = S.assign_batches(S.routed(_flagged(spark, d), DAY).withColumn("day", F.lit(DAY)), 15)
    return S.batch_log(own, F.lit(f"{DAY} 00:00:00").cast("timestamp")).select("batch_id", "tag_prefix", "count")


BATCHES = f"""WITH {FLAGS}, bk AS (SELECT conv_id, CASE WHEN flags <> '' THEN 'flagged' ELSE 'batch' END AS bucket FROM fl),
bn AS (SELECT conv_id, bucket, (row_number() OVER (PARTITION BY bucket ORDER BY conv_id) - 1) // 15 AS batch_no FROM bk),
bi AS (SELECT conv_id, bucket, batch_no::BIGINT AS batch_no, bucket || '-{DAY}-' || batch_no AS batch_id FROM bn)"""


def wrap_legacy(spark, d):
    return rendered(spark, d).select("conv_id", S.wrap_legacy(F.col("text")).alias("record"))


def record_text(spark, d):
    """What reading gives for wrapped, bare and plain lines."""
    line = F.when(F.col("conv_id") % 3 == 0, S.wrap_legacy(F.col("text"))).when(F.col("conv_id") % 3 == 1, F.lit('{"other": 1}')).otherwise(F.replace("text", F.lit("\n"), F.lit(" ")))
    return rendered(spark, d).select("conv_id", S.record_text(line).alias("text"))


def emoji_density(spark, d):
    with_emoji = _emoji(spark, d).join(turns(spark, d).select("conv_id", "turn", "role"), ["conv_id", "turn"])
    return V.emoji_density(with_emoji, X.EMOJI, 2.5).withColumn("density", F.round("density", 6))


def emoji_only_turns(spark, d):
    own = turns(spark, d).withColumn("text", F.expr("CASE WHEN (conv_id + turn) % 3 = 0 THEN '😀 ✨' ELSE text END"))
    return V.emoji_only_turns(own, X.EMOJI)


def phrase_ngrams(spark, d):
    # Nested and taken apart again for the queries, so written once for the two passes.
    return V.repeated_phrases(stored(turns(spark, d), "turns"), 3, 2)


PHRASES = f"""WITH {T}, w AS (SELECT conv_id, [x FOR x IN regexp_split_to_array(lower(text), '\\s+') IF x <> ''] AS ws FROM t WHERE role = 'assistant'),
g AS (SELECT DISTINCT conv_id, unnest([ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] FOR i IN range(1, len(ws) - 1)]) AS phrase FROM w)
SELECT phrase, count(*) AS convs FROM g GROUP BY phrase HAVING count(*) >= 2"""

def phrase_scan(spark, d):
    """Turns that hold the beginning of any conversation, as literal phrases: as many as there are conversations."""
    own = turns(spark, d)
    begins = own.where("turn = 0 AND length(text) >= 12").select(F.lower(F.substring("text", 1, 12)).alias("pattern"), "conv_id")
    table = begins.select((F.col("conv_id") % 5).cast("int").alias("rank"), F.when(F.col("conv_id") % 2 == 0, F.lit("any")).otherwise(F.lit("assistant")).alias("scope"), F.concat(F.lit("opens-"), F.col("conv_id") % 5).alias("kind"), "pattern")
    return scan_phrases(own, table)


PHRASE_SCAN = f"""WITH {T}, p AS (SELECT DISTINCT (conv_id % 5)::INT AS rank, CASE WHEN conv_id % 2 = 0 THEN 'any' ELSE 'assistant' END AS scope, lower(substr(text, 1, 12)) AS pattern FROM t WHERE turn = 0 AND length(text) >= 12)
SELECT DISTINCT conv_id, turn, rank, 'opens-' || rank AS reason FROM t JOIN p ON contains(lower(text), pattern) AND (scope = 'any' OR role = 'assistant')"""


MESSAGES = f"""WITH {T} SELECT conv_id, to_json({{'messages': [{{'role': 'system', 'content': '{PROMPT}'}}] || list({{'role': role, 'content': text}} ORDER BY turn)}})::VARCHAR AS record FROM t GROUP BY conv_id"""

BIAS_TABLE = """WITH tp AS (SELECT r_regionkey AS id, lower(r_name || ' about ' || r_name) AS x FROM region UNION ALL SELECT n_nationkey + 1000, lower(n_name || ' of ' || n_name) FROM nation
 UNION ALL SELECT c_custkey + 1000000, lower(c_name || ' with ' || c_name) FROM customer),
kw AS (SELECT DISTINCT 2 AS k, lower(substr(c_name, -3)) AS w FROM customer WHERE c_custkey % 7 = 0 UNION ALL SELECT DISTINCT 1, lower(substr(c_name, -2)) FROM customer WHERE c_custkey % 5 = 0),
f AS (SELECT id, max(k) AS k FROM tp JOIN kw ON contains(x, w) GROUP BY id)
SELECT tp.id::BIGINT AS id, CASE k WHEN 2 THEN 'heavy' WHEN 1 THEN 'fun' END AS bias FROM tp LEFT JOIN f USING (id)"""
TOPICS = """WITH tp AS (SELECT r_regionkey AS id, r_name AS name, 'about ' || r_name AS definition FROM region UNION ALL SELECT n_nationkey + 1000, n_name, 'of ' || n_name FROM nation
 UNION ALL SELECT c_custkey + 1000000, c_name, 'with ' || c_name FROM customer)
SELECT id::BIGINT AS id, CASE WHEN regexp_matches(lower(name || ' ' || definition), 'an|ru') THEN 'heavy' WHEN regexp_matches(lower(name || ' ' || definition), 'i') THEN 'fun' END AS bias, NULL::VARCHAR AS none FROM tp"""

QUERIES = {
    "structure_check": (structure_check, f"WITH {STRUCTURE} SELECT conv_id, n::BIGINT AS n_turns, reason FROM st"),
    "alternation_check": (alternation_check, f"WITH {T}, s AS (SELECT conv_id, turn, CASE WHEN conv_id % 3 = 0 AND turn = conv_id % 4 THEN 'user' ELSE role END AS role FROM t) SELECT conv_id, 'bad_alternation(turn ' || min(CASE WHEN role <> CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END THEN turn END) || ')' AS reason FROM s GROUP BY conv_id"),
    "line_counts": (line_counts, f"WITH {T} SELECT conv_id, turn::BIGINT AS turn, ({LINES})::BIGINT AS n_lines FROM t"),
    "min_length_check": (min_length_check, f"WITH {TRIM}{BEST} SELECT conv_id, best::BIGINT AS best, CASE WHEN coalesce(best, 0) < 3 THEN 'no_turn_reaches_min_length(best=' || coalesce(best, 0) || ')' END AS reason FROM (SELECT DISTINCT conv_id FROM w) LEFT JOIN bl USING (conv_id)"),
    "trainable": (trainable, TRAINABLE),
    "reason_histogram": (reason_histogram, f"SELECT 'reject' AS kind, regexp_extract(reason, '^([a-z_]+)', 1) AS name, count(*) AS n FROM ({TRAINABLE}) WHERE NOT ok GROUP BY ALL"),
    "outcome_histogram": (outcome_histogram, OUTCOMES),
    "render": (rendered, f"WITH {RENDERED} SELECT conv_id, text FROM r"),
    "chatml_record": (chatml_record, MESSAGES),
    "double_tags": (double_tags, DOUBLE),
    "parse_turns": (parse_turns, PARSE),
    "explode_lines": (explode_lines, EXPLODE),
    "tag_of": (tag_of, TAGS),
    "json_pairs": (json_pairs, PAIRS),
    "rule_scan": (rule_scan, f"WITH {HITS} SELECT conv_id, turn::BIGINT AS turn, rank::BIGINT AS rank, reason FROM hit"),
    "first_reason": (first_reason, f"WITH {HITS} SELECT conv_id, arg_min(reason, turn * 10 + rank) AS reason FROM hit GROUP BY conv_id"),
    "soft_flags": (soft_flags, f"WITH {FLAGS} SELECT conv_id, flags FROM fl"),
    "has_words": (has_words, f"WITH {T} SELECT conv_id, coalesce(bool_or(role = 'assistant' AND regexp_matches(text, '[A-Za-z\\x{{0900}}-\\x{{097F}}]')), false) AS has_words FROM t GROUP BY conv_id"),
    "word_replace": (word_replace, WORDSQL),
    "emoji_collapse": (emoji_collapse, f"WITH {T}, e AS (SELECT conv_id, turn, {EMO} AS text FROM t) SELECT conv_id, turn::BIGINT AS turn, regexp_replace(text, '{_RUNSQL}', '\\1\\2\\3', 'g') AS text, len(regexp_extract_all(text, '{_RUNSQL}'))::BIGINT AS n FROM e"),
    "emoji_cap": (emoji_cap, CAPSQL),
    "process": (process, PROCESS),
    "curate_job": (curate_job, CURATE),
    "validate": (validate, VALIDATE),
    "topic_bias": (topic_bias, TOPICS),
    "topic_bias_table": (topic_bias_table, BIAS_TABLE),
    "rule_table": (rule_table, f"WITH {HITS} SELECT conv_id, turn::BIGINT AS turn, rank::BIGINT AS rank, reason FROM hit WHERE reason NOT IN ('narration_detected', 'human_claim')"),
    "chatml_file": (chatml_file, f"SELECT record FROM ({MESSAGES})"),
    "routed_files": (routed_files, f"WITH {FLAGS} SELECT CASE WHEN flags <> '' THEN 'flagged' ELSE 'batch' END AS bucket, CASE WHEN flags <> '' THEN 'flagged' ELSE 'batch-{DAY}' END AS tag, count(*) AS n, true AS fits FROM fl GROUP BY ALL"),
    "convert_file": (convert_file, f"WITH {RENDERED}, {_parsed('r')}, c AS (SELECT conv_id % 5 <> 0 AND coalesce(NOT bad AND n >= 2, false) AS fine FROM r LEFT JOIN q4 USING (conv_id)) SELECT count(*) FILTER (fine) AS written, count(*) FILTER (fine) AS ok, count(*) FILTER (NOT fine) AS bad FROM c"),
    "routed_tags": (routed_tags, f"WITH {FLAGS} SELECT conv_id, CASE WHEN flags <> '' THEN 'flagged' ELSE 'batch' END AS bucket, CASE WHEN flags <> '' THEN 'flagged' ELSE 'batch-{DAY}' END AS tag FROM fl"),
    "assign_batches": (assign_batches, f"{BATCHES} SELECT conv_id, batch_no, batch_id FROM bi"),
    "batch_log": (batch_log, f"{BATCHES} SELECT batch_id, bucket AS tag_prefix, count(*) AS count FROM bi GROUP BY ALL"),
    "wrap_legacy": (wrap_legacy, f"WITH {RENDERED} SELECT conv_id, to_json({{'conversation': text}})::VARCHAR AS record FROM r"),
    "record_text": (record_text, f"WITH {RENDERED} SELECT conv_id, CASE conv_id % 3 WHEN 0 THEN text WHEN 1 THEN '' ELSE regexp_replace(replace(text, chr(10), ' '), '^\\s+|\\s+$', '', 'g') END AS text FROM r"),
    "emoji_density": (emoji_density, f"WITH {T}, e AS (SELECT conv_id, role, {EMO} AS text FROM t) SELECT conv_id, round(avg(len(regexp_extract_all(text, '{_E}'))), 6) AS density, avg(len(regexp_extract_all(text, '{_E}'))) < 2.5 AS flagged FROM e WHERE role = 'assistant' GROUP BY conv_id"),
    "emoji_only_turns": (emoji_only_turns, f"WITH {T} SELECT conv_id, count(*) FILTER (role = 'assistant' AND (conv_id + turn) % 3 = 0) AS n FROM t GROUP BY conv_id"),
    "phrase_ngrams": (phrase_ngrams, PHRASES),
    "phrase_scan": (phrase_scan, PHRASE_SCAN),
}
