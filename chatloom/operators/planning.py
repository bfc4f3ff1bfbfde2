"""Quotas over a topic hierarchy and the sampling plan. Draws come from hashes of (seed, axis, id), so they repeat under retries."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.operators.ordering import numbered, running_total
from chatloom.sources.scratch import stored

PATH = " > "


def uniform(seed: int | str, axis: str, key: Column) -> Column:
    """A number from 0 to below 1 for each key: the first eight hex digits of an MD5 over 2^32."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(axis), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 4294967296.0


def flatten_tree(topics: DataFrame, max_depth: int = 1000) -> DataFrame:
    """Leaves of topics(id, parent_id, name, definition, pos): leaf_path, ancestors' definitions, own ones, and order, depth first.

    Every topic carries the stretch of its path up to the ancestor it knows of; a round puts that ancestor's own stretch
    before it, so stretches double and the rounds follow the logarithm of the depth. Topics that no root leads to (a
    cycle, a missing parent, or more than max_depth levels) are an error, not left out.
    """
    part = F.struct("name", "definition", F.format_string("%09d", F.col("pos")).alias("place"))
    tree = stored(topics.select("id", F.col("parent_id").alias("up"), F.col("parent_id").alias("parent"), F.array(part).alias("path")), "topics")
    whole = tree.count()
    own = tree
    for _ in range(max_depth.bit_length() + 1):
        if not own.where("up IS NOT NULL").head(1):
            break
        above = own.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"))
        grown = own.where("up IS NOT NULL").join(above, "up").select("id", F.col("_up").alias("up"), "parent", F.concat("_path", "path").alias("path"))
        own = stored(own.where("up IS NULL").unionByName(grown), "stretches")
    fine = own.where(F.col("up").isNull() & (F.size("path") <= max_depth + 1))
    found = fine.count()
    if found != whole:
        raise ValueError(f"{whole - found} topics are not within {max_depth} levels of a root")
    leaves = fine.join(tree.select(F.col("parent").alias("id")).distinct(), "id", "left_anti")
    above, last = F.slice("path", F.lit(1), F.size("path") - 1), F.get("path", F.size("path") - 1)
    text = F.when(F.size("path") > 1, F.concat(F.array_join(F.transform(above, lambda x: x["definition"]), ". "), F.lit("."))).otherwise(F.lit(""))
    return leaves.select(
        "id", F.array_join("path.name", PATH).alias("leaf_path"), text.alias("main_subtopics_string"), last["name"].alias("core_topic"),
        last["definition"].alias("core_definition"), F.array_join("path.place", ".").alias("sort_key"),
    )


def seeded_order(leaves: DataFrame, seed: int = 42) -> DataFrame:
    """leaves with pos, a fixed pseudo-random order from 0."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), "leaf_path"))
    return numbered(leaves.withColumn("_key", key), ["_key", "leaf_path"], "pos", lazy=True).drop("_key")


def allocate_quotas(leaves: DataFrame, total: int, existing: DataFrame | None = None) -> DataFrame:
    """(leaf_path, quota): an equal share each, one more for the first ones in depth-first order; existing leaves are left out."""
    placed = stored(numbered(leaves.select("leaf_path", "sort_key"), ["sort_key"], "rank"), "numbered-leaves")
    n = max(placed.count(), 1)
    quota = F.lit(total // n) + F.when(F.col("rank") < total % n, 1).otherwise(0)
    out = placed.select("leaf_path", quota.cast("long").alias("quota"))
    return out if existing is None else out.join(existing.select("leaf_path"), "leaf_path", "left_anti")


def expand_plan(state: DataFrame) -> DataFrame:
    """One row per open slot of state(leaf_path, pos, quota, generated): leaf by leaf in order."""
    left = state.where(F.col("quota") > F.col("generated"))
    return left.select("pos", "leaf_path", F.explode(F.sequence(F.col("generated") + 1, F.col("quota"))).alias("slot"))


def next_leaf(state: DataFrame) -> DataFrame:
    """One row: the first leaf in order that is not full, null if none."""
    return state.where(F.col("generated") < F.col("quota")).agg(F.min_by("leaf_path", "pos").alias("leaf_path"))


def weighted_pick(df: DataFrame, options: list[tuple[str, float]], axis: str, seed: int, key: str = "slot_id") -> DataFrame:
    """df with a column axis: one option a row, in proportion to its weight."""
    total, low, out = sum(w for _, w in options), 0.0, F.lit(options[-1][0])
    steps = []
    for name, weight in options:
        low += weight
        steps.append((low, name))
    u = F.col("_u")
    for high, name in reversed(steps[:-1]):
        out = F.when(u * total < high, F.lit(name)).otherwise(out)
    return df.withColumn("_u", uniform(seed, axis, F.col(key))).withColumn(axis, out).drop("_u")


#: Options that stand in one row, rows whose ends stand in one row above them, and units that a weight of 1 counts.
CHUNK, UNITS = 256, 1_000_000


def fine_uniform(seed: int | str, axis: str, key: Column) -> Column:
    """As uniform, in steps of 2^-52."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(axis), key.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def _first_above(tops: Column, target: Column) -> Column:
    """The index, from 0, of the first of the growing numbers that is above the target, by binary search; their number if none is."""
    n = F.size(tops)
    steps = F.sequence(F.lit(1), F.ceil(F.log2(n + 1)).cast("int") + 1)
    start = F.struct(F.lit(0).alias("low"), n.alias("high"))

    def halve(at: Column, _: Column) -> Column:
        middle = ((at["low"] + at["high"]) / 2).cast("int")
        left = F.get(tops, middle) > target
        done = at["low"] >= at["high"]
        return F.when(done, at).when(left, F.struct(at["low"].alias("low"), middle.alias("high"))).otherwise(F.struct((middle + 1).alias("low"), at["high"].alias("high")))

    return F.aggregate(steps, start, halve, lambda at: at["low"])


def weighted_draw(df: DataFrame, options: DataFrame, group: str, axis: str, seed: int, key: str = "slot_id") -> DataFrame:
    """df with a column axis: one id of options(group, id, pos, weight) of the row's group, in proportion to its weight, in the order of pos and id.

    Weights count in millionths; null, negative and zero weights are never drawn, and rows of a group without any other
    have no option. A group's weights are added up over slices of its options and laid out as a tree with CHUNK ends a
    row: a draw goes down from the group's one row at the top, a join and a search by halving a level, so no row is
    long however many options there are.
    """
    units = F.round(F.coalesce(F.col("weight"), F.lit(0)).cast("double") * UNITS).cast("long")
    own = options.select(group, "id", "pos", units.alias("units")).where(F.col("units") > 0)
    placed = running_total(own, ["pos", "id"], F.col("units"), "before", [group], lazy=True)
    placed = numbered(placed.withColumn("top", F.col("before") + F.col("units")), ["top"], "no", [group], lazy=True)
    level, levels = stored(placed.select(group, "no", "top", "id"), "options"), []
    while not levels or level.where("no > 0").head(1):
        each = F.array_sort(F.collect_list(F.struct("top", "id") if not levels else F.struct("top")))
        rows = level.groupBy(group, F.floor(F.col("no") / CHUNK).cast("long").alias("no")).agg(each.alias("own"))
        ids = [] if levels else [F.col("own.id").alias("ids")]
        rows = stored(rows.select(group, "no", F.col("own.top").alias("tops"), *ids), "option-rows")
        levels.append(rows)
        level = rows.select(group, "no", F.get("tops", F.size("tops") - 1).alias("top"))
    total = level.select(F.col(group).alias("_group"), F.col("top").alias("_total"))
    out = df.join(total, F.col(group) == F.col("_group"), "left").drop("_group")
    out = out.withColumns({"_target": F.floor(fine_uniform(seed, axis, F.col(key)) * F.col("_total")).cast("long"), "_at": F.lit(0).cast("long")}).drop("_total")
    for rows in reversed(levels):
        named = rows.select(F.col(group).alias("_group"), F.col("no").alias("_no"), "tops", *(["ids"] if rows is levels[0] else []))
        below = _first_above(F.col("tops"), F.col("_target"))
        found = F.get("ids", below).alias(axis) if rows is levels[0] else (F.col("_at") * CHUNK + below).alias("_at")
        keep = df.columns if rows is levels[0] else [*df.columns, "_target"]
        out = out.join(named, (F.col(group) == F.col("_group")) & (F.col("_at") == F.col("_no")), "left").select(*keep, found)
    return out


def edge_pick(df: DataFrame, edges: list[tuple[str, float, int]], seed: int, key: str = "slot_id", stage: str = "stage") -> DataFrame:
    """df with edge: the first (id, rate in percent, least stage) that the stage allows and the draw hits, else null."""
    hits = [
        F.when((F.col(stage) >= least) & (uniform(seed, f"edge:{name}", F.col(key)) < rate / 100.0), F.lit(name))
        for name, rate, least in edges
    ]
    return df.withColumn("edge", F.coalesce(*hits) if hits else F.lit(None).cast("string"))


def apply_bias(tone: Column, bias: Column) -> Column:
    """A heavy topic makes a fun tone soft, a fun topic a heavy tone."""
    clash = ((bias == "heavy") & (tone == "fun")) | ((bias == "fun") & (tone == "heavy"))
    return F.when(clash, F.lit("soft")).otherwise(tone)


def allowed_categories(cells: DataFrame, categories: DataFrame, types: DataFrame) -> DataFrame:
    """cells(stage, tone) with allowed, the sorted categories(category, conv_type) that types(conv_type, tone_class, min_stage) permits; all if none."""
    own = categories.join(types, "conv_type", "left")
    fits = (F.col("tone_class").isNull() | (F.col("tone_class") == F.col("tone"))) & (F.col("stage") >= F.coalesce("min_stage", F.lit(0)))
    found = cells.join(own, fits, "left").groupBy("stage", "tone").agg(F.array_sort(F.collect_set("category")).alias("allowed"))
    every = categories.agg(F.array_sort(F.collect_set("category")).alias("every"))
    return found.join(every, F.lit(True)).select("stage", "tone", F.when(F.size("allowed") > 0, F.col("allowed")).otherwise(F.col("every")).alias("allowed"))


def category_type(df: DataFrame, categories: DataFrame, default: str) -> DataFrame:
    """df(category, …) with conv_type, the default where the category is not mapped."""
    return df.join(categories, "category", "left").withColumn("conv_type", F.coalesce("conv_type", F.lit(default)))


def conflict_filter(cands: DataFrame, rules: DataFrame, left: str, right: str) -> DataFrame:
    """cands without those that rules(left_key, forbidden array) forbid: right forbidden for left."""
    pairs = rules.select(F.col("left_key").alias(left), F.explode("forbidden").alias(right)).distinct()
    return cands.join(pairs, [left, right], "left_anti")


def contains_filter(cands: DataFrame, rules: DataFrame, text: str, right: str) -> DataFrame:
    """cands without those whose lower-cased text holds a rule's left_key that forbids right."""
    pairs = rules.select("left_key", F.explode("forbidden").alias("_bad"))
    return cands.join(pairs, F.lower(text).contains(F.col("left_key")) & (F.col(right) == F.col("_bad")), "left_anti")


def allow_filter(cands: DataFrame, rules: DataFrame, left: str, right: str) -> DataFrame:
    """cands that rules(left_key, forbidden) list: here the list allows."""
    pairs = rules.select(F.col("left_key").alias(left), F.explode("forbidden").alias(right)).distinct()
    return cands.join(pairs, [left, right], "left_semi")


def _rank(seed: int, axis: str, key: str, cand: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(axis), F.col(key).cast("string"), F.col(cand)))


def pick_one(rows: DataFrame, cands: DataFrame, key: str, cand: str, axis: str, seed: int, fallback: str | None) -> DataFrame:
    """rows(key) with cand: a uniform choice among cands(key, cand), the fallback for rows without candidates."""
    best = cands.groupBy(key).agg(F.min_by(cand, F.struct(_rank(seed, axis, key, cand), F.col(cand))).alias(cand))
    return rows.join(best, key, "left").withColumn(cand, F.coalesce(cand, F.lit(fallback)))


def pick_n(cands: DataFrame, key: str, cand: str, axis: str, seed: int, n: int = 2) -> DataFrame:
    """(key, cand, rank): n different candidates a key, fewer if there are fewer."""
    w = Window.partitionBy(key).orderBy(_rank(seed, axis, key, cand), cand)
    return cands.select(key, cand).distinct().withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def ending_candidates(prefs: Column, lean: Column, known: list[str], default: list[str]) -> Column:
    """Preferences that the place leans to; else preferences, else the lean, else the default; known ones only, all known if none is left."""
    some = lambda a: F.when(F.size(a) > 0, a)
    names = F.array(*map(F.lit, sorted(known)))
    first = F.coalesce(some(F.array_intersect(prefs, lean)), some(prefs), some(lean), F.array(*map(F.lit, default)))
    return F.array_sort(F.coalesce(some(F.array_intersect(first, names)), names))


def _picks(batches: Iterator[pa.RecordBatch], history: int) -> Iterator[pa.RecordBatch]:
    """The picks of runs that come one after the other, step by step; only the last ones of the present run are held."""
    run: object = _picks
    recent: deque = deque(maxlen=history)
    for batch in batches:
        out = []
        for run_id, choices in zip(batch.column("run_id").to_pylist(), batch.column("choices").to_pylist(), strict=True):
            if run_id != run:
                run = run_id
                recent.clear()
            choices = choices or [None]
            pick = next((c for c in choices if c not in recent), choices[0])
            recent.append(pick)
            out.append(pick)
        yield pa.RecordBatch.from_arrays([batch.column("run_id"), batch.column("step"), pa.array(out, pa.string())], ["run_id", "step", "category"])


def pick_without_recent(plan: DataFrame, history: int = 25, seed: int = 42) -> DataFrame:
    """(run_id, step, category) of plan(run_id, step, allowed array): a category not among the run's last picks where one is allowed.

    Each pick follows from those before, so a run is gone through in order, as batches of a sorted partition: a run of
    any length takes the memory of a batch. The choices' ranks are made beforehand.
    """
    rank = lambda c: F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("category"), F.col("step").cast("string"), c))
    ranked = F.array_sort(F.transform("allowed", lambda c: F.struct(rank(c).alias("rank"), c.alias("c"))))
    own = plan.select(F.col("run_id").cast("long").alias("run_id"), F.col("step").cast("long").alias("step"), "allowed")
    dealt = own.repartition(int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions")), "run_id").sortWithinPartitions("run_id", "step")
    return dealt.select("run_id", "step", ranked["c"].alias("choices")).mapInArrow(lambda b: _picks(b, history), "run_id long, step long, category string")


def audit_recent_repeats(plan: DataFrame, n: int = 25) -> DataFrame:
    """plan(run_id, step, category) rows whose category is among the n before.

    Runs are numbered and cut into blocks of n steps: what a step repeats is in its block or the one before, so a
    category's first step of the one and last of the other decide, and no task sees a whole run.
    """
    placed = stored(numbered(plan, ["step"], "_at", ["run_id"], lazy=True).withColumn("_block", F.floor(F.col("_at") / n)), "numbered-steps")
    groups = placed.groupBy("run_id", "category", "_block").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    own = groups.select("run_id", "category", "_block", "_first")
    before = groups.select("run_id", "category", (F.col("_block") + 1).alias("_block"), "_last")
    out = placed.join(own, ["run_id", "category", "_block"]).join(before, ["run_id", "category", "_block"], "left")
    return out.where((F.col("_first") < F.col("_at")) | (F.col("_at") - F.col("_last") <= n)).select(*plan.columns)


def assemble_prompt(*sections: Column) -> Column:
    """The sections that are not empty, a blank line between them."""
    return F.concat_ws("\n\n", *(F.nullif(s, F.lit("")) for s in sections))
