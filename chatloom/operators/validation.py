"""Rejects, flags and repairs of conversations. Input convs(conv_id, turns) with turns an array of struct(role, text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.config import Config
from chatloom.functions.text import LETTER, any_of, count_lines, let, repaired
from chatloom.operators.parsing import TURNS, parse_turns, render
from chatloom.sources.scratch import stored


def assistant_texts(turns: Column) -> Column:
    return F.transform(F.filter(turns, lambda t: t["role"] == "assistant"), lambda t: t["text"])


def trimmed(turns: Column) -> Column:
    """Turns without a last user turn that leaves their number odd."""
    n = F.size(turns)
    odd = (n % 2 == 1) & (F.get(turns, n - 1)["role"] == "user")
    return F.when(odd, F.slice(turns, F.lit(1), F.greatest(n - 1, F.lit(0)))).otherwise(turns)


def structure_reason(turns: Column, min_turns: int, max_turns: int) -> Column:
    """Of trimmed turns the first structural fault, else null."""
    n = F.size(turns)
    name = lambda what: F.concat(F.lit(f"{what}("), n.cast("string"), F.lit(")"))
    return (
        F.when(turns.isNull() | (n == 0), F.lit("invalid_format"))
        .when(n < min_turns, name("too_few_turns"))
        .when(n > max_turns, name("too_many_turns"))
        .when(n % 2 == 1, name("odd_turns"))
    )


def alternation_reason(turns: Column) -> Column:
    """The first turn whose speaker is out of turn, counted from 0, else null."""
    bad = F.transform(turns, lambda t, i: F.when(t["role"] != F.when(i % 2 == 0, F.lit("user")).otherwise(F.lit("assistant")), i))
    first = F.array_min(bad)
    return F.when(first.isNotNull(), F.concat(F.lit("bad_alternation(turn "), first.cast("string"), F.lit(")")))


def turn_reason(role: Column, text: Column, cfg: Config) -> Column:
    """The first rule, by rank, that a turn breaks, else null."""

    def first(lower: Column) -> Column:
        out = F.lit(None).cast("string")
        for rule in sorted(cfg.rules, key=lambda r: -r.rank):
            hit = (text if rule.raw else lower).rlike(rule.pattern)
            scope = F.lit(True) if rule.scope == "any" else role == "assistant"
            out = F.when(scope & hit, F.lit(rule.reason)).otherwise(out)
        return out

    return let(F.lower(text), first)


def scan_rules(turns: DataFrame, cfg: Config) -> DataFrame:
    """(conv_id, turn, rank, reason): every rule that a turn of turns(conv_id, turn, role, text) breaks; no shuffle."""
    hits = []
    for rule in cfg.rules:
        hit = F.col("text").rlike(rule.pattern) if rule.raw else F.lower("text").rlike(rule.pattern)
        scope = F.lit(True) if rule.scope == "any" else F.col("role") == "assistant"
        hits.append(F.when(scope & hit, F.struct(F.lit(rule.rank).alias("rank"), F.lit(rule.reason).alias("reason"))))
    return turns.select("conv_id", "turn", F.explode(F.array_compact(F.array(*hits))).alias("hit")).select("conv_id", "turn", "hit.rank", "hit.reason")


def first_reason(hits: DataFrame) -> DataFrame:
    """(conv_id, reason) of the earliest turn's lowest rank."""
    return hits.groupBy("conv_id").agg(F.min_by("reason", F.struct("turn", "rank")).alias("reason"))


def best_lines(turns: Column) -> Column:
    return F.array_max(F.transform(assistant_texts(turns), count_lines))


def min_length_reason(turns: Column, least: int) -> Column:
    named = lambda best: F.concat(F.lit("no_turn_reaches_min_length(best="), best.cast("string"), F.lit(")"))
    return let(F.coalesce(best_lines(turns), F.lit(0)), lambda best: F.when(best < least, named(best)))


def soft_flags(turns: Column, cfg: Config) -> Column:
    """Array of flags over the joined assistant text, in the order of the rule lists."""

    def flags_of(joined: Column) -> Column:
        flags = [F.when(joined.rlike(f"(?i){p}"), F.lit(f"scene:{p[:24]}")) for p in cfg.scene_patterns]
        flags += [F.when(F.regexp_count(joined, F.lit(f"(?i){p}")) > cfg.overused_max, F.lit(f"overused:{p[:16]}")) for p in cfg.overused_stems]
        if cfg.refusal_phrases:
            flags.append(F.when(F.lower(joined).rlike(any_of(cfg.refusal_phrases)), F.lit("refusal")))
        return F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")

    return let(F.array_join(assistant_texts(turns), "\n"), flags_of)


def apply_fixes(turns: Column, cfg: Config) -> Column:
    """struct(turns, n): assistant turns repaired."""
    fixed = F.transform(
        turns,
        lambda t: F.struct(
            t["role"].alias("role"),
            F.when(t["role"] == "assistant", repaired(t["text"], cfg.words, cfg.emoji_cap))
            .otherwise(F.struct(t["text"].alias("text"), F.lit(0).alias("n"))).alias("r"),
        ),
    )

    def parted(rows: Column) -> Column:
        own = F.transform(rows, lambda x: F.struct(x["role"].alias("role"), x["r"]["text"].alias("text")))
        return F.struct(own.alias("turns"), F.aggregate(rows, F.lit(0), lambda a, x: a + x["r"]["n"]).alias("n"))

    return let(fixed, parted)


def process(raw: DataFrame, cfg: Config) -> DataFrame:
    """(conv_id, ok, reason, flags, fixes, turns, text) of raw(conv_id, text): parse, check, repair, check again, flag; no shuffle."""
    out = parse_turns(raw.select("conv_id", "text"), cfg.persona).drop("text")
    out = out.withColumn("own", F.when(F.size("turns") > 0, trimmed(F.col("turns"))))
    shape = F.coalesce(structure_reason(F.col("own"), cfg.min_turns, cfg.max_turns), alternation_reason(F.col("own")))
    out = out.withColumn("shape", shape)
    rules = F.transform("own", lambda t: turn_reason(t["role"], t["text"], cfg))
    out = out.withColumn("broken", F.when(F.col("shape").isNull(), F.get(F.array_compact(rules), F.lit(0))))
    good = F.col("shape").isNull() & F.col("broken").isNull()
    # Here too a generator keeps what follows from repeating the repair.
    out = out.select("*", F.explode(F.array(F.when(good, apply_fixes(F.col("own"), cfg)))).alias("fixed"))
    turns = F.col("fixed.turns")
    wordless = ~F.array_join(assistant_texts(turns), "\n").rlike(LETTER)
    reason = F.coalesce("shape", "broken", F.when(wordless, F.lit("no_words_in_conversation")), min_length_reason(turns, cfg.min_lines), F.lit("ok"))
    out = out.withColumn("reason", reason).withColumn("ok", F.col("reason") == "ok")
    ok = F.col("ok")
    row = F.struct(
        "conv_id", "ok", "reason",
        F.when(ok, soft_flags(turns, cfg)).otherwise(F.array().cast("array<string>")).alias("flags"),
        F.when(ok, F.col("tag_fixes") + F.col("fixed.n")).otherwise(F.lit(0)).alias("fixes"),
        F.when(ok, turns).otherwise(F.array().cast(TURNS)).alias("turns"),
        F.when(ok, render(turns, cfg.persona)).otherwise(F.lit("")).alias("text"),
    )
    # Filters on the result stop at a generator; pushed through the projections they would repeat all of their expressions.
    return out.select(F.explode(F.array(row)).alias("r")).select("r.*")


def validate(raw: DataFrame, cfg: Config) -> DataFrame:
    """(conv_id, ok, verdict): ok, or rejected: and the reason."""
    done = process(raw, cfg)
    return done.select("conv_id", "ok", F.when(F.col("ok"), F.lit("ok")).otherwise(F.concat(F.lit("rejected: "), "reason")).alias("verdict"))


def emoji_only_turns(turns: DataFrame, emoji: str) -> DataFrame:
    """(conv_id, n): assistant turns with emoji and no letter."""
    only = (F.col("role") == "assistant") & F.col("text").rlike(emoji) & ~F.col("text").rlike(LETTER)
    return turns.groupBy("conv_id").agg(F.count_if(only).alias("n"))


def emoji_density(turns: DataFrame, emoji: str, least: float) -> DataFrame:
    """(conv_id, density, flagged): mean emoji of the assistant turns, flagged under least."""
    own = turns.where("role = 'assistant'").groupBy("conv_id").agg(F.avg(F.regexp_count("text", F.lit(emoji))).alias("density"))
    return own.withColumn("flagged", F.col("density") < least)


def repeated_phrases(turns: DataFrame, n: int, least: int) -> DataFrame:
    """(phrase, convs): n-word phrases of assistant turns that at least so many conversations share.

    Two passes: hashes of the phrases are counted by turn first, which is never less than by conversation; only those
    that reach the number are then spelled out, made distinct and counted.
    """
    words = F.filter(F.split(F.lower("text"), r"\s+"), lambda w: w != "")
    own = turns.where("role = 'assistant'").select("conv_id", words.alias("w")).where(F.size("w") >= n)
    each = lambda make: F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: make(F.slice("w", i, F.lit(n))))
    hashes = own.select(F.explode(F.array_distinct(each(F.xxhash64))).alias("h"))
    frequent = stored(hashes.groupBy("h").agg(F.count("*").alias("turns")).where(F.col("turns") >= least).select("h"), "frequent-phrases")
    spelled = each(lambda w: F.struct(F.xxhash64(w).alias("h"), F.array_join(w, " ").alias("phrase")))
    grams = own.select("conv_id", F.explode(F.array_distinct(spelled)).alias("x")).select("conv_id", "x.*")
    pairs = grams.join(frequent, "h", "left_semi").select("conv_id", "phrase").distinct()
    return pairs.groupBy("phrase").agg(F.count("*").alias("convs")).where(F.col("convs") >= least)
