"""Column functions on one string: trimming, hashing, counting, word replacement, emoji repair, token sets."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The code points that count as emoji, with an optional variation selector after them.
EMOJI = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}\x{2300}-\x{23FF}]\x{FE0F}?"
#: Sentence ends, and letters of the two scripts that count as words.
SENTENCE_END = r"[.!?\x{2026}]+(\s|$)"
LETTER = r"[A-Za-z\x{0900}-\x{097F}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body's lambdas name it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(col: Column) -> Column:
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def normalize(col: Column) -> Column:
    """Trimmed, lower-cased, each run of white space one space."""
    return F.regexp_replace(F.lower(strip(col)), r"\s+", " ")


def content_hash(col: Column) -> Column:
    return F.sha2(normalize(col), 256)


def tokens(col: Column) -> Column:
    """Distinct words of a string."""
    return F.array_distinct(F.filter(F.split(col, r"\s+"), lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two word arrays without repeats; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both)).otherwise(F.lit(0.0))


def count_lines(col: Column) -> Column:
    """Lines that are not blank; for a single line its sentences, at least one."""
    sentences = lambda line: F.greatest(F.lit(1), F.regexp_count(line, F.lit(SENTENCE_END)))
    counted = lambda lines: F.when(F.size(lines) == 1, sentences(F.get(lines, F.lit(0)))).otherwise(F.size(lines))
    return let(F.filter(F.split(col, "\n"), lambda x: strip(x) != ""), counted)


def reason_family(col: Column) -> Column:
    return F.regexp_extract(col, "^([a-z_]+)", 1)


def any_of(words: tuple[str, ...] | list[str]) -> str:
    return "|".join(re.sub(r"([^\w\s])", r"\\\1", w) for w in words)


def topic_bias(topic: Column, definition: Column, heavy: list[str], fun: list[str]) -> Column:
    """heavy if a heavy keyword is a substring, else fun if a fun one is, else null."""
    text = F.lower(F.concat_ws(" ", topic, definition))
    # No keywords match nothing; the empty pattern would match everything.
    hit = lambda words: text.rlike(any_of([w.lower() for w in words])) if words else F.lit(False)
    return F.when(hit(heavy), F.lit("heavy")).when(hit(fun), F.lit("fun"))


def _parts(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_]+)"), F.lit(0))


def replace_words(col: Column, mapping: dict[str, str]) -> Column:
    """struct(text, n): whole words replaced by the lower-cased mapping; upper and capitalised sources keep their case."""
    if not mapping:
        return F.struct(col.alias("text"), F.lit(0).alias("n"))
    table = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))

    def one(w: Column) -> Column:
        new = F.try_element_at(table, F.lower(w))
        first = F.substring(w, 1, 1)
        cased = (
            F.when((F.length(w) > 1) & (F.upper(w) == w) & (F.lower(w) != w), F.upper(new))
            .when((F.upper(first) == first) & (F.lower(first) != first), F.concat(F.upper(F.substring(new, 1, 1)), F.substr(new, F.lit(2))))
            .otherwise(new)
        )
        return F.coalesce(cased, w)

    # Most parts are no word of the mapping: each is looked up once, and only the found ones are cased.
    known = lambda w: F.map_contains_key(table, F.lower(w))
    replaced = lambda w: F.when(known(w), F.struct(one(w).alias("text"), F.lit(1).alias("n"))).otherwise(F.struct(w.alias("text"), F.lit(0).alias("n")))
    guard = F.lower(col).rlike(any_of(sorted(mapping)))
    joined = lambda ws: F.struct(F.array_join(ws["text"], "").alias("text"), F.size(F.filter(ws["n"], lambda n: n > 0)).alias("n"))
    new = let(F.transform(_parts(col), replaced), joined)
    return F.when(guard, new).otherwise(F.struct(col.alias("text"), F.lit(0).alias("n")))


_RUN = rf"({EMOJI})[ \t]?({EMOJI})[ \t]?(?:{EMOJI}[ \t]?)*{EMOJI}(?:( )|\t)?"


def collapse_emoji_runs(col: Column) -> Column:
    """struct(text, n): runs of three or more emoji cut to the first two, with the space that ended the run."""
    return F.struct(F.regexp_replace(col, _RUN, "$1$2$3").alias("text"), F.regexp_count(col, F.lit(_RUN)).alias("n"))


def cap_emoji(col: Column, most: int) -> Column:
    """struct(text, n): the emoji after the first most deleted."""
    gaps = F.split(col, EMOJI, -1)

    def capped(found: Column) -> Column:
        kept = F.transform(gaps, lambda g, i: F.concat(g, F.when(i < most, F.coalesce(F.get(found, i), F.lit(""))).otherwise(F.lit(""))))
        n = F.greatest(F.size(found) - most, F.lit(0))
        return F.struct(F.when(n > 0, F.array_join(kept, "")).otherwise(col).alias("text"), n.alias("n"))

    return let(F.regexp_extract_all(col, F.lit(EMOJI), F.lit(0)), capped)


def squeeze_if_changed(col: Column, n: Column) -> Column:
    """Where n > 0: runs of spaces and tabs become one space, lines lose their trailing white space."""
    return F.when(n > 0, F.regexp_replace(F.regexp_replace(col, r"[ \t]{2,}", " "), r"(?md)[^\S\n]+$", "")).otherwise(col)


def repaired(col: Column, mapping: dict[str, str], emoji_cap: int) -> Column:
    """struct(text, n): word replacement, then emoji runs, then the emoji cap, then squeezing."""

    def squeezed(n_words: Column, n_runs: Column, caps: Column) -> Column:
        emoji = n_runs + caps["n"]
        return F.struct(squeeze_if_changed(caps["text"], emoji).alias("text"), (n_words + emoji).alias("n"))

    # Each step is made once, though the next ones name it several times.
    caps = lambda w, r: let(cap_emoji(r["text"], emoji_cap), lambda c: squeezed(w["n"], r["n"], c))
    return let(replace_words(col, mapping), lambda w: let(collapse_emoji_runs(w["text"]), lambda r: caps(w, r)))
