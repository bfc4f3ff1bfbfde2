"""Quality rules: base counts, and divergence of a document's histograms from its language's reference.

Native: DataFrame functions only. Two passes over the texts: the first counts the words of each
language, the second makes each document's counts in its own row, without a shuffle of texts.

A language's references are summed over its models: documents of enough words whose share of common words is
half or more of that which a tenth of these documents reach. So text without common words shapes no reference
and no bound, up to nine tenths of a language, while in a mixture of languages each one's documents are models.

Character classes are far where their Jensen-Shannon distance from the language's is over a fixed bound. A
common-word distance cannot pass that of a text without any common word, so it is held to a share of that
one (or the fixed bound, if less), after the distance that a sample of the text's length has by chance is
taken out. Neither is far, as a square, up to a multiple of the mean among the language's models, which
spares documents whose language is a mixture, as those without one are.

Defined results: a null or blank text has no words, so base_failed is true; a null lang uses the
reference of the documents without a language; texts under the minimum lengths, and texts of a language
without common words, are judged by the other rules alone; the classes' reference of a language without models is
that of all its documents; equal rows get equal results; an empty table
gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.functions.text import let
from chatloom.llm.common import stored, table, words

SYMBOLS = r"[#*$%&|<>]"
#: Lower-case letters, spaces and full stops make most of a text: one pass takes them out and the classes are counted in what is left.
PLAIN = r"[a-z\x20\x09-\x0D]+"
CLASSES = {
    "upper": r"[A-Z]+",
    "digit": r"[0-9]+",
    "symbol": r"[#*$%&|<>]+",
    "punct": r"[!-\"'-),-/:;=?@\[-`{}~]+",
}
HISTOGRAM = ["space", *CLASSES, "beyond", "lower"]
#: A word is common in a language if it has this share of the language's words or more, so a language has 200 at most.
COMMON_SHARE = 0.005
MIN_CHARS, MIN_WORDS = 200, 50
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.35, 0.45
#: Of the distance of a text without common words, the share that is far; and of the mean square, the multiple that is.
FAR, USUAL = 0.85, 2
#: Models have this part of the share of common words (in steps of 1/STEPS) that one in TOP of the documents reaches.
MODEL_PART, STEPS, TOP = 0.5, 1000, 10
#: References are broadcast up to this many languages and joined by shuffle beyond.
BROADCAST_LANGS = 2000


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two arrays of counts; null if either has no mass."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))
    sp, sq = total(p), total(q)
    terms = F.zip_with(
        F.transform(p, lambda x: x / sp),
        F.transform(q, lambda x: x / sq),
        lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2),
    )
    return F.when((sp > 0) & (sq > 0), F.sqrt(F.greatest(total(terms) / 2, F.lit(0.0))))


def common_words(docs: DataFrame, share: float = COMMON_SHARE) -> DataFrame:
    """(lang_key, common): the common words of each language in order."""
    every = docs.select(F.coalesce("lang", F.lit("und")).alias("lang_key"), F.explode(words(F.col("text"))).alias("word"))
    counts = stored(every.groupBy("lang_key", "word").agg(F.count("*").alias("count")), "word-counts")
    totals = counts.groupBy("lang_key").agg(F.sum("count").alias("total"))
    many = totals.count()
    totals = F.broadcast(totals) if many <= BROADCAST_LANGS else totals
    kept = counts.join(totals, "lang_key").where(F.col("count") >= share * F.col("total"))
    return kept.groupBy("lang_key").agg(F.array_sort(F.collect_list("word")).alias("common"))


def model_bounds(own: DataFrame) -> DataFrame:
    """(lang_key, least): the share of common words, in steps, from which a document of own(lang_key, share) is a model of its language."""
    steps = own.where("share IS NOT NULL").groupBy("lang_key", "share").agg(F.count("*").alias("n"))
    langs = Window.partitionBy("lang_key")
    steps = steps.withColumns({"reach": F.sum("n").over(langs.orderBy(F.desc("share"))), "all": F.sum("n").over(langs)})
    return steps.where(TOP * F.col("reach") >= F.col("all")).groupBy("lang_key").agg((MODEL_PART * F.max("share")).alias("least"))


def references(own: DataFrame) -> DataFrame:
    """(lang_key, common_ref, most, classes_ref) of own(lang_key, n_words, found, classes, model): the counts of the common words in models
    and last the count of all others, the distance of a text without common words, and the classes' counts."""
    some = F.filter(F.transform("found", lambda n, i: F.struct(i.alias("i"), n.alias("n"))), lambda x: x["n"] > 0)
    hits = own.where("model").select("lang_key", F.explode(some).alias("hit")).groupBy("lang_key", "hit.i").agg(F.sum("hit.n").alias("n"))
    hits = hits.groupBy("lang_key").agg(F.map_from_entries(F.collect_list(F.struct("i", "n"))).alias("hits"))
    sums = lambda of: F.array(*(F.sum(of(F.col("classes")[i])) for i in range(len(HISTOGRAM))))
    out = own.groupBy("lang_key").agg(
        F.max(F.size("found")).alias("kinds"),
        F.sum(F.when(F.col("model"), F.col("n_words"))).cast("double").alias("total"),
        F.when(F.bool_or("model"), sums(lambda c: F.when(F.col("model"), c))).otherwise(sums(lambda c: c)).alias("classes_ref"),
    )
    out = out.join(hits, "lang_key", "left")
    ref = F.transform(F.sequence(F.lit(0), F.col("kinds") - 1), lambda i: F.coalesce(F.col("hits")[i], F.lit(0.0)))
    out = out.withColumn("ref", F.when(F.col("total").isNotNull() & (F.col("kinds") > 0), ref))
    rest = F.col("total") - F.aggregate("ref", F.lit(0.0), lambda s, x: s + x)
    out = out.select("lang_key", F.concat("ref", F.array(rest)).alias("common_ref"), "classes_ref")
    none = F.concat(F.transform(F.slice("common_ref", 1, F.size("common_ref") - 1), lambda c: F.lit(0.0)), F.array(F.lit(1.0)))
    return out.withColumn("most", js_distance(none, F.col("common_ref")))


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the class counts to (doc_id, lang_key, text)."""
    text = F.col("text")
    n = F.length(text)
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumns({"n_text": n, "words": words(text), "lines": lines, "left": F.regexp_replace(text, PLAIN, "")})
    out = out.withColumns(
        {"n_left": F.length("left"), "n_word_chars": F.length(F.array_join("words", ""))}
        | {f"c_{k}": F.length("left") - _without(F.col("left"), v) for k, v in CLASSES.items()}
    )
    own = sum((F.col(f"c_{k}") for k in CLASSES), F.lit(0))
    out = out.withColumns({"c_space": F.col("n_text") - F.col("n_word_chars"), "c_beyond": F.col("n_left") - own})
    out = out.withColumn("c_lower", F.col("n_word_chars") - F.col("n_left"))
    # A window's hash has 64 bits and is compared within one document only.
    window = F.transform(F.sequence(F.lit(0), F.size("words") - 5), lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(5))))
    out = out.withColumn("hashes", F.when(F.size("words") >= 5, window))
    out = out.withColumn(
        "sorted",
        F.when(
            F.size(F.array_distinct("hashes")) < F.size("hashes"),
            F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
        ),
    )
    z = F.col("sorted")
    out = out.withColumn(
        "repeated",
        F.sort_array(
            F.transform(
                F.filter(z, lambda e, k: (F.get(z, k - 1)["h"] == e["h"]) | (F.get(z, k + 1)["h"] == e["h"])),
                lambda e: e["p"],
            )
        ),
    )
    zero = F.lit(0).cast("int")
    covered = F.aggregate(
        "repeated",
        F.struct(zero.alias("n"), F.lit(-5).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(5), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    return out.select(
        "doc_id",
        "lang_key",
        "words",
        "n_text",
        F.size("words").cast("long").alias("n_words"),
        F.col("n_word_chars").cast("long").alias("word_chars"),
        F.col("c_symbol").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, zero).cast("long").alias("n_repeat_words"),
        F.array(*(F.col(f"c_{k}").cast("double") for k in HISTOGRAM)).alias("classes"),
    )


def common_counts(own: Column, common: Column) -> Column:
    """How often each common word is among the words own: those that are common are picked once, and taken out word by word."""
    counts = lambda hits: F.transform(common, lambda c: (F.size(hits) - F.size(F.array_remove(hits, c))).cast("double"))
    return let(F.filter(own, lambda w: F.array_contains(common, w)), counts)


def quality_rules(docs: DataFrame, max_char: float = MAX_CHAR_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """One row per row of docs(doc_id, text, lang): counts, base_failed, both distances (null under the minimum length) and kept."""
    docs = docs.select("doc_id", "text", "lang")
    refs = stored(common_words(docs), "common-words")
    few = refs.count() <= BROADCAST_LANGS
    near = F.broadcast if few else (lambda x: x)
    own = base_counts(
        docs.select("doc_id", F.coalesce("lang", F.lit("und")).alias("lang_key"), F.coalesce("text", F.lit("")).alias("text"))
    )
    own = own.join(near(refs), "lang_key", "left")
    own = own.withColumn("found", F.when(F.col("n_words") >= MIN_WORDS, common_counts(F.col("words"), F.col("common"))))
    n_found = F.aggregate("found", F.lit(0.0), lambda s, x: s + x)
    own = own.withColumn("share", F.floor(STEPS * n_found / F.col("n_words")))
    own = stored(own.drop("words", "common"), "quality-counts")
    own = own.join(near(stored(model_bounds(own), "model-bounds")), "lang_key", "left")
    own = own.withColumn("model", F.coalesce(F.col("share") >= F.col("least"), F.lit(False)))
    own = own.join(near(stored(references(own), "references")), "lang_key", "left")
    rest = F.array(F.col("n_words") - F.aggregate("found", F.lit(0.0), lambda s, x: s + x))
    # A sample of n words from k + 1 kinds is k / (8 n ln 2) away by chance, as a square.
    chance = F.size("found") / (8 * F.col("n_words") * F.lit(0.6931471805599453))
    out = own.withColumns(
        {
            "word_distance": js_distance(F.concat("found", rest), F.col("common_ref")),
            "char_distance": F.when(F.col("n_text") >= MIN_CHARS, js_distance(F.col("classes"), F.col("classes_ref"))),
        }
    ).withColumn("excess", F.greatest(F.pow("word_distance", 2) - chance, F.lit(0.0)))
    mean = lambda x: F.coalesce(F.avg(F.when(F.col("model"), x)), F.avg(x))
    usual = out.groupBy("lang_key").agg((USUAL * mean(F.col("excess"))).alias("usual"), (USUAL * mean(F.pow("char_distance", 2))).alias("usual_chars"))
    out = out.join(near(usual), "lang_key", "left")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    word_bound = F.greatest(F.pow(F.least(FAR * F.col("most"), F.lit(max_word)), 2), F.col("usual"))
    char_bound = F.greatest(F.lit(max_char**2), F.col("usual_chars"))
    far = F.coalesce(F.pow("char_distance", 2) > char_bound, F.lit(False)) | F.coalesce(F.col("excess") > word_bound, F.lit(False))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~far).alias("kept"),
        F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, 'und') AS k, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, [x FOR x IN regexp_split_to_array(text, '[\x20\x09-\x0D]+') IF x <> ''] AS ws,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls,
    regexp_replace(text, '[a-z\x20\x09-\x0D]+', '', 'g') AS lf FROM d),
b AS (SELECT rid, doc_id, k, ws, length(text) AS n_text, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, length(lf) AS n_left,
    length(lf) - length(regexp_replace(lf, '[A-Z]+', '', 'g')) AS c_upper,
    length(lf) - length(regexp_replace(lf, '[0-9]+', '', 'g')) AS c_digit,
    length(lf) - length(regexp_replace(lf, '[#*$%&|<>]+', '', 'g')) AS c_symbol,
    length(lf) - length(regexp_replace(lf, '[!-\"''-),-/:;=?@\[-`{}~]+', '', 'g')) AS c_punct FROM w),
v AS (SELECT rid, i, ws[i] || chr(0) || ws[i+1] || chr(0) || ws[i+2] || chr(0) || ws[i+3] || chr(0) || ws[i+4] AS five
    FROM (SELECT rid, ws, unnest(range(1, n_words - 3)) AS i FROM b)),
r AS (SELECT rid, i FROM v QUALIFY count(*) OVER (PARTITION BY rid, five) > 1),
g AS (SELECT rid, sum(least(5, i - before)) AS n FROM (SELECT rid, i, coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i), i - 5) AS before FROM r) GROUP BY rid),
one AS (SELECT rid, k, unnest(ws) AS word FROM b),
tot AS (SELECT k, count(*) AS total FROM one GROUP BY k),
cm AS (SELECT k, word, count(*) AS n FROM one GROUP BY k, word),
com AS (SELECT cm.k, word, n, total FROM cm JOIN tot USING (k) WHERE n >= 0.005 * total),
own AS (SELECT rid, k, word, count(*) AS n FROM one GROUP BY ALL),
sh AS (SELECT b.rid, b.k, any_value(b.n_words) AS n_words, floor(1000 * coalesce(sum(own.n), 0)::DOUBLE / any_value(b.n_words)) AS share
    FROM b JOIN com ON com.k = b.k LEFT JOIN own ON own.rid = b.rid AND own.word = com.word WHERE b.n_words >= 50 GROUP BY b.rid, b.k),
st AS (SELECT k, share, sum(c) OVER (PARTITION BY k ORDER BY share DESC) AS reach, sum(c) OVER (PARTITION BY k) AS every
    FROM (SELECT k, share, count(*) AS c FROM sh GROUP BY k, share)),
md AS (SELECT rid, k, n_words FROM sh JOIN (SELECT k, 0.5 * max(share) AS least FROM st WHERE 10 * reach >= every GROUP BY k) USING (k) WHERE share >= least),
rt AS (SELECT k, sum(n_words) AS total FROM md GROUP BY k),
rc AS (SELECT own.k, word, sum(n) AS n FROM own JOIN md USING (rid) GROUP BY own.k, word),
rn AS (SELECT com.k, com.word, coalesce(rc.n, 0) AS n, rt.total FROM com JOIN rt ON rt.k = com.k LEFT JOIN rc ON rc.k = com.k AND rc.word = com.word),
wp AS (SELECT b.rid, coalesce(own.n, 0) / b.n_words::DOUBLE AS p, rn.n / rn.total::DOUBLE AS q
    FROM b JOIN rn ON rn.k = b.k LEFT JOIN own ON own.rid = b.rid AND own.word = rn.word WHERE b.n_words >= 50
  UNION ALL SELECT b.rid, 1 - coalesce(sum(own.n), 0) / any_value(b.n_words)::DOUBLE, 1 - sum(rn.n) / any_value(rn.total)::DOUBLE
    FROM b JOIN rn ON rn.k = b.k LEFT JOIN own ON own.rid = b.rid AND own.word = rn.word WHERE b.n_words >= 50 GROUP BY b.rid),
cl AS (SELECT rid, k, n_text, [n_text - word_chars, c_upper, c_digit, c_symbol, c_punct, n_left - c_upper - c_digit - c_symbol - c_punct, word_chars - n_left] AS c FROM b),
cu AS (SELECT rid, k, n_text, unnest(c)::DOUBLE AS n, unnest(range(7)) AS j FROM cl),
cr AS (SELECT cu.k, j, CASE WHEN count(md.rid) > 0 THEN sum(n) FILTER (md.rid IS NOT NULL) ELSE sum(n) END AS n FROM cu LEFT JOIN md USING (rid) GROUP BY cu.k, j),
cp AS (SELECT cu.rid, cu.n / cu.n_text AS p, cr.n / sum(cr.n) OVER (PARTITION BY cu.rid) AS q FROM cu JOIN cr USING (k, j) WHERE n_text >= 200),
jw AS (SELECT rid, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS x FROM wp GROUP BY rid),
jc AS (SELECT rid, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS x FROM cp GROUP BY rid),
mw AS (SELECT k, n / total::DOUBLE AS q, 0 AS p FROM rn UNION ALL SELECT k, 1 - sum(n) / any_value(total)::DOUBLE, 1 FROM rn GROUP BY k),
mx AS (SELECT k, count(*) - 1 AS kinds, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS most FROM mw GROUP BY k),
ex AS (SELECT b.rid, b.k, most, greatest(jw.x ** 2 - kinds / (8 * n_words * ln(2)), 0) AS excess FROM b JOIN jw USING (rid) JOIN mx ON mx.k = b.k),
uc AS (SELECT b.k, 2 * coalesce(avg(jc.x ** 2) FILTER (md.rid IS NOT NULL), avg(jc.x ** 2)) AS usual_chars
    FROM b JOIN jc USING (rid) LEFT JOIN md USING (rid) GROUP BY b.k),
us AS (SELECT ex.k, 2 * avg(excess) AS usual FROM ex JOIN md USING (rid) GROUP BY ex.k),
f AS (SELECT b.*, coalesce(g.n, 0)::BIGINT AS n_repeat_words, jc.x AS dc, jw.x AS dw, coalesce(excess > greatest(least(0.85 * most, 0.45) ** 2, usual), false)
    OR coalesce(jc.x ** 2 > greatest(0.35 ** 2, usual_chars), false) AS far
    FROM b LEFT JOIN g USING (rid) LEFT JOIN jc USING (rid) LEFT JOIN jw USING (rid) LEFT JOIN ex USING (rid) LEFT JOIN us ON us.k = b.k LEFT JOIN uc ON uc.k = b.k)
SELECT doc_id, n_words, word_chars, c_symbol AS n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT far AS kept,
  round(dc, 6) AS char_distance, round(dw, 6) AS word_distance
FROM f
"""
