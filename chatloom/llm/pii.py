"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

Native: DataFrame functions only, each text in its own row, no shuffle. Kinds email, ip, card and phone are
always kept once valid. An iban must have its country's length and mod-97 checksum, an ssn an issued area,
group and serial; both must stand apart from other letters and digits. Every span's score, in hundredths,
starts at its kind's and goes up by CONTEXT where a word of the kind stands near it and down where a word of
examples and part numbers does; iban and ssn are kept from 50 on.

Defined results: a null or empty text has no spans; equal rows get equal results; spans of different
kinds may overlap, spans of one kind do not; a match that is not valid is dropped without a retry inside it;
an empty table gives no rows; further columns are ignored. Patterns use possessive repeats and start at run
starts, so very long runs cost linear time and no stack.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import table

OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Characters on either side of a span that are searched for context words.
NEAR = 40
#: What a context word adds to or takes from a score, in hundredths.
CONTEXT = 30
#: Words that speak against personal data.
AGAINST = "example|examples|sample|samples|test|dummy|fake|version|isbn|serial|order|part"
#: kind: (guard that a text must meet, pattern, valid(match), score of a valid match, context words, least score, border needed).
Kind = tuple[Callable[[Column], Column], str, Callable[[Column], Column], int, str, int, bool]
#: Length of an IBAN by country, as the public registry lists them.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}
IBAN = "(?:" + "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:[ ]?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()) + ")"
SSN = "[0-9]{3}-[0-9]{2}-[0-9]{4}"
#: Numbers of that form that are not issued.
NOT_ISSUED = "^(000|666|9..)|-00-|0000$"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = _digits(match)
    return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)


def _mod97(match: Column) -> Column:
    """Whether the letters-as-numbers form, first four characters moved to the end, leaves 1 modulo 97."""
    plain = F.regexp_replace(match, " ", "")
    moved = F.split(F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4)), "")
    step = lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.filter(moved, lambda c: c != ""), F.lit(0), step) == 1


KINDS: dict[str, Kind] = {
    "email": (
        lambda t: t.contains("@"),
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True), 70, "mail|mails|email|emails|contact|write", 0, False,
    ),
    "ip": (
        lambda t: t.rlike(r"[0-9]\.[0-9]"),
        r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
        lambda m: m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), 60, "ip|addr|address|host|server", 0, False,
    ),
    "card": (
        lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"),
        r"[0-9](?:[\x20-]?[0-9])++",
        _luhn, 70, "card|cards|visa|credit|karte|carte|tarjeta", 0, False,
    ),
    "phone": (
        lambda t: t.contains("+"),
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda m: F.length(_digits(m)).between(9, 15), 60, "phone|tel|call|mobile|fax", 0, False,
    ),
    "iban": (lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"), IBAN, _mod97, 70, "iban|bank|konto|compte|cuenta|account", 50, True),
    "ssn": (lambda t: t.rlike(r"[0-9]-[0-9]{2}-[0-9]"), SSN, lambda m: ~m.rlike(NOT_ISSUED), 30, "ssn|social|security", 50, True),
}
BASE = ["email", "ip", "card", "phone"]
SPAN = "struct<start:int,rank:int,end:int,kind:string,score:int>"


def as_words(words: str) -> str:
    """The pattern of any of the words, not part of a longer one, in lower-cased text."""
    return f"[^a-z0-9](?:{words})[^a-z0-9]"


def _around(text: Column, start: Column, end: Column) -> Column:
    """NEAR characters on either side of a span, lower-cased; an end of the text counts as a space, a word cut by the distance not as one."""
    left = F.substr(text, F.greatest(start - NEAR, F.lit(0)) + 1, F.least(start, F.lit(NEAR)))
    right = F.substr(text, end + 1, F.lit(NEAR))
    pad = lambda at_end: F.when(at_end, F.lit(" ")).otherwise(F.lit(""))
    return F.lower(F.concat(pad(start <= NEAR), left, F.lit(" "), right, pad(F.length(right) < NEAR)))


def kind_spans(text: Column, kind: str) -> Column:
    """Array of the kind's spans, by start; offsets in code points, end exclusive."""
    guard, pattern, valid, score, context, least, apart = KINDS[kind]
    rank = list(KINDS).index(kind)
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match")
    )

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))
        good = valid(x["match"])
        if apart:
            inside = lambda c: c.rlike("[A-Za-z0-9-]")
            before = F.when(start > 0, F.substr(text, start, F.lit(1))).otherwise(F.lit(""))
            good = good & ~(inside(before) | inside(F.substr(text, end + 1, F.lit(1))))
        keep = F.when(x["match"].isNotNull(), good).otherwise(F.lit(False))
        return F.struct(end.alias("at"), F.when(keep, F.concat(a["out"], F.array(span))).otherwise(a["out"]).alias("out"))

    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda a: a["out"])

    def scored(s: Column) -> Column:
        around = _around(text, s["start"], s["end"])
        hit = lambda words: F.when(around.rlike(as_words(words)), F.lit(CONTEXT)).otherwise(F.lit(0))
        return F.struct(
            s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"),
            (F.lit(score) + hit(context) - hit(AGAINST)).alias("score"),
        )

    spans = F.filter(F.transform(found, scored), lambda s: s["score"] >= least) if least else F.transform(found, scored)
    return F.when(guard(text), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def find_pii(docs: DataFrame) -> DataFrame:
    """docs with a column per kind (array of spans); a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({f"pii_{k}": kind_spans(text, k) for k in KINDS})


def all_spans(kinds: list[str]) -> Column:
    return F.sort_array(F.concat(*(F.col(f"pii_{k}") for k in kinds)))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """text with each span replaced by its kind in angle brackets; overlapping spans become one, named by the first."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        gap = F.substr(text, a["at"] + 1, s["start"] - a["at"])
        cut = F.concat(a["out"], F.array(F.concat(gap, F.lit("<"), F.upper(s["kind"]), F.lit(">"))))
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], cut).otherwise(a["out"]).alias("out")
        )

    whole = F.aggregate(
        spans, start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substr(text, a["at"] + 1, F.length(text)))
    )
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def mask_pii(docs: DataFrame) -> DataFrame:
    """docs with every span in text masked and n_chars, where present, brought up to date."""
    columns = docs.columns
    out = find_pii(docs).withColumn("pii_all", all_spans(list(KINDS)))
    out = out.withColumn("text", F.when(F.col("text").isNotNull(), masked(F.col("text"), F.col("pii_all"))))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.size("pii_all") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*columns)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        *(F.size(f"pii_{k}").cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(joined(all_spans(BASE)), 256).alias("base_sha256"),
        joined(all_spans(list(KINDS))).alias("spans"),
        F.array_join(F.transform(all_spans(list(KINDS)), lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


#: kind: pattern without what the SQL engine's expressions lack, context words, score and least score.
_SQL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": IBAN,
    "ssn": SSN,
}
_MATCHES = " UNION ALL ".join(
    f"SELECT rid, text, {i} AS rnk, '{k}' AS kind, '{as_words(KINDS[k][4])}' AS words, {KINDS[k][3]} AS score, {KINDS[k][5]} AS least, "
    f"regexp_extract_all(text, '{p}') AS ms, regexp_split_to_array(text, '{p}') AS gs FROM t"
    for i, (k, p) in enumerate(_SQL.items())
)
ORACLE = rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({_MATCHES}),
e AS (SELECT * EXCLUDE (ms, gs), ms[i] AS m, gs[i] AS g FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM m)),
p AS (SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY rid, rnk ORDER BY i) AS fin FROM e),
q AS (SELECT * EXCLUDE (fin), (fin - length(m))::BIGINT AS start, fin::BIGINT AS fin, regexp_replace(m, '[^0-9]', '', 'g') AS d FROM p),
n AS (SELECT *, lower(concat(CASE WHEN start <= {NEAR} THEN ' ' END, substr(text, greatest(start - {NEAR}, 0) + 1, least(start, {NEAR})), ' ',
    substr(text, fin + 1, {NEAR}), CASE WHEN length(substr(text, fin + 1, {NEAR})) < {NEAR} THEN ' ' END)) AS near,
    NOT regexp_matches(concat(CASE WHEN start > 0 THEN substr(text, start, 1) END, '|', substr(text, fin + 1, 1)), '[A-Za-z0-9-]') AS apart FROM q),
v AS (SELECT *, score + CASE WHEN regexp_matches(near, words) THEN {CONTEXT} ELSE 0 END - CASE WHEN regexp_matches(near, '{as_words(AGAINST)}') THEN {CONTEXT} ELSE 0 END AS total FROM n WHERE CASE kind
  WHEN 'email' THEN true
  WHEN 'ip' THEN len([x FOR x IN string_split(m, '.') IF regexp_full_match(x, '0*([0-9]{{1,2}}|1[0-9]{{2}}|2[0-4][0-9]|25[0-5])')]) = 4
  WHEN 'card' THEN length(d) BETWEEN 12 AND 19 AND list_sum([
      CASE WHEN (length(d) - k) % 2 = 0 THEN d[k]::INT WHEN d[k]::INT * 2 > 9 THEN d[k]::INT * 2 - 9 ELSE d[k]::INT * 2 END
      FOR k IN range(1, length(d) + 1)]) % 10 = 0
  WHEN 'phone' THEN length(d) BETWEEN 9 AND 15
  WHEN 'iban' THEN apart AND list_reduce([0] || [x::INT FOR x IN string_split(array_to_string([
      CASE WHEN c BETWEEN 'A' AND 'Z' THEN (ascii(c) - 55)::VARCHAR ELSE c END
      FOR c IN string_split(replace(m, ' ', '')[5:] || replace(m, ' ', '')[:4], '')], ''), '')], lambda a, b: (a * 10 + b) % 97) = 1
  ELSE apart AND NOT regexp_matches(m, '{NOT_ISSUED}') END),
s AS (SELECT rid,
    count(*) FILTER (rnk = 0) AS n_email, count(*) FILTER (rnk = 1) AS n_ip,
    count(*) FILTER (rnk = 2) AS n_card, count(*) FILTER (rnk = 3) AS n_phone,
    coalesce(string_agg(kind || ':' || start || ':' || fin, ',' ORDER BY start, rnk) FILTER (rnk < 4), '') AS base,
    string_agg(kind || ':' || start || ':' || fin, ',' ORDER BY start, rnk) AS spans, string_agg(total::VARCHAR, ',' ORDER BY start, rnk) AS scores
  FROM v WHERE total >= least GROUP BY rid)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM t LEFT JOIN s USING (rid)
"""
