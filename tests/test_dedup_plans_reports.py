from __future__ import annotations

import datetime as dt
import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from chatloom.operators import dedup as D
from chatloom.operators import planning as P
from chatloom.operators import reporting as R
from chatloom.operators.components import connected
from chatloom.operators.ordering import numbered, running_total


def test_similar_values_is_brute_force(spark):
    rnd = random.Random(1)
    base = [[f"w{rnd.randrange(400)}" for _ in range(40)] for _ in range(15)]
    rows = [" ".join(w if rnd.random() > 0.02 else f"x{rnd.randrange(9)}" for w in rnd.choice(base)) for _ in range(150)]
    values = list(enumerate(dict.fromkeys(rows)))
    got = {(r.a, r.b) for r in D.similar_values(spark.createDataFrame(values, "id long, value string"), 9, 10).collect()}
    sets = {i: set(v.split()) for i, v in values}
    want = {(i, j) for (i, a), (j, b) in itertools.combinations(sets.items(), 2) if 10 * len(a & b) > 9 * len(a | b)}
    assert got == want and want


def test_jaccard_at_the_threshold_is_unique(spark):
    nine = " ".join(f"w{i}" for i in range(9))
    rows = [(0, f"{nine} w9"), (1, nine)]
    assert D.similar_values(spark.createDataFrame(rows, "id long, value string"), 9, 10).count() == 0


def test_dup_reasons_in_order(spark):
    rows = [(i, i, [("assistant", t)], t) for i, t in enumerate(["a b c", "A  b c", "a b c\nz", "q", "q"])]
    df = D.keyed(spark.createDataFrame(rows, "seq long, conv_id long, turns array<struct<role:string,text:string>>, text string"))
    got = {r.seq: r.dup_reason for r in D.dup_reason(df).collect()}
    assert got == {0: "unique", 1: "exact_hash_duplicate", 2: "unique", 3: "unique", 4: "exact_hash_duplicate"}


def test_ttl_moves_only_on_expiry(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("h", t0 + dt.timedelta(days=x)) for x in (0, 89, 91, 170, 182)]
    out = [r.duplicate for r in D.ttl_anchor(spark.createDataFrame(rows, "hash string, created_at timestamp")).orderBy("created_at").collect()]
    assert out == [False, True, False, True, False]
    twice = D.ttl_anchor(spark.createDataFrame([rows[0]] * 3, "hash string, created_at timestamp"))
    assert sorted(r.duplicate for r in twice.collect()) == [False, True, True]
    assert D.ttl_anchor(spark.createDataFrame([], "hash string, created_at timestamp")).count() == 0


def anchors_of(rows, days):
    """By the walk in order: (hash, time) of the anchors."""
    out, last = set(), {}
    for t, h in sorted({(t, h) for h, t in rows}, key=lambda x: (x[0], str(x[1]))):
        if h not in last or t >= last[h] + dt.timedelta(days=days):
            last[h] = t
            out.add((h, t))
    return out


@pytest.mark.parametrize(("days", "long"), [(1, 10_000), (1, 5), (7, 40), (90, 20), (400, 5)])
def test_anchors_are_the_walk_in_order(spark, monkeypatch, days, long):
    """Hashes within a task and dealt over several, one with most of the rows; gaps, equal times, a null hash, times before 1970."""
    monkeypatch.setattr(D, "LONG", long)
    rnd, t0 = random.Random(days), dt.datetime(1969, 6, 1)
    some = lambda: t0 + dt.timedelta(minutes=rnd.randrange(60 * 24 * 900)) + dt.timedelta(days=rnd.choice([0, 0, 3000]))
    rows = [(rnd.choice(["hot", "hot", "hot", "b", "c", None, f"h{i % 90}"]), some()) for i in range(1200)]
    rows += rows[:50] + [("hot", t0)] * 5
    out = D.ttl_anchor(spark.createDataFrame(rows, "hash string, created_at timestamp"), days).collect()
    assert sorted((str(r.hash), r.created_at) for r in out) == sorted((str(h), t) for h, t in rows)
    first = [(r.hash, r.created_at) for r in out if not r.duplicate]
    assert len(first) == len(set(first)) and set(first) == anchors_of(rows, days)


def jobs_of(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    out = action()
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, n


def test_jobs_do_not_grow_with_the_years(spark):
    t0, jobs = dt.datetime(2020, 1, 1), []
    for years in (1, 20):
        rows = [(f"h{i % 3}", t0 + dt.timedelta(days=i)) for i in range(365 * years)]
        df = spark.createDataFrame(rows, "hash string, created_at timestamp")
        jobs.append(jobs_of(spark, f"ttl-{years}", lambda df=df: D.ttl_anchor(df).count())[1])
    assert jobs[0] == jobs[1]


def test_equal_strings_are_similar(spark):
    rows = spark.createDataFrame([(0, "a b c"), (1, "a b c"), (2, ""), (3, ""), (4, "a b c")], "seq long, signature string")
    assert sorted((r.a, r.b, r.sim) for r in D.similar_pairs(rows, "signature", 9, 10).collect()) == [(0, 1, 1.0), (0, 4, 1.0)]


def near_rows(n, seed, words=30):
    """n rows over a few texts with small changes, equal ones among them."""
    rnd = random.Random(seed)
    base = [[f"w{rnd.randrange(300)}" for _ in range(words)] for _ in range(6)]
    rows = []
    for i in range(n):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2])):
            w[rnd.randrange(words)] = f"x{rnd.randrange(6)}"
        rows.append((i * 3 + 1, " ".join(w) if rnd.random() > 0.1 else rnd.choice(["", "one two"])))
    return rows


def alike(a, b, num, den, blank=False):
    x, y = set(a.split()), set(b.split())
    return bool(x and y and den * len(x & y) > num * len(x | y)) or (a == b and (bool(x) or blank))


def test_a_band_compares_with_the_rows_before(spark):
    rows = near_rows(160, 8)
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "seq long, signature string")
    for n, blank in ((1, False), (7, True), (50, False), (500, True)):
        want = {rows[i][0] for i in range(len(rows)) if any(alike(rows[i][1], rows[j][1], 9, 10, blank) for j in range(max(0, i - n), i))}
        assert {r.seq for r in D.similar_within(df, "signature", 9, 10, n, blank).collect()} == want, n


@pytest.mark.parametrize("words", [2, 9, 30, 116, 140])
def test_similar_values_of_any_length_are_brute_force(spark, words):
    """Sets on both sides of the length from which they meet on one word, and next to it."""
    rnd = random.Random(words)
    base = [[f"w{rnd.randrange(4000)}" for _ in range(words + k)] for k in range(8)]
    rows = {"one", "one one", "two"}
    for _ in range(120):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 1, 2, 5])):
            k = rnd.randrange(len(w))
            w[k : k + 1] = [f"x{rnd.randrange(50)}"] * rnd.choice([1, 1, 2])
        rows.add(" ".join(w))
    values = list(enumerate(sorted(rows)))
    df = spark.createDataFrame(values, "id long, value string")
    for num, den in ((9, 10), (19, 20), (1, 2)):
        want = {(i, j) for (i, a), (j, b) in itertools.combinations(values, 2) if alike(a, b, num, den)}
        assert {(r.a, r.b) for r in D.similar_values(df, num, den).collect()} == want and want
    with pytest.raises(ValueError, match="half"):
        D.similar_values(df, 1, 3)


def test_heavy_prefix_words_are_dealt_without_loss(spark, monkeypatch):
    rows = near_rows(150, 3)
    values = [(i, v) for i, v in enumerate(dict.fromkeys(v for _, v in rows))]
    df = spark.createDataFrame(values, "id long, value string")
    want = {(i, j) for (i, a), (j, b) in itertools.combinations(values, 2) if alike(a, b, 9, 10)}
    for heavy in (2, 5, 2000):
        monkeypatch.setattr(D, "HEAVY", heavy)
        assert {(r.a, r.b) for r in D.similar_values(df, 9, 10).collect()} == want and want


def test_candidates_stay_few_over_a_fixed_vocabulary(spark, monkeypatch):
    """Four times the texts over a vocabulary that stays: next to none meet."""
    seen = []
    inner = D.stored
    monkeypatch.setattr(D, "stored", lambda df, name: (out := inner(df, name), seen.append(out.count()) if name == "candidates" else None)[0])
    for n in (1000, 4000):
        rnd = random.Random(n)
        rows = [(i, " ".join(f"v{rnd.randrange(3000)}" for _ in range(40))) for i in range(n)]
        assert D.similar_values(spark.createDataFrame(rows, "id long, value string"), 9, 10).count() == 0
    assert seen[0] < 250 and seen[1] < 4000


def test_greedy_is_the_walk_in_order(spark):
    rows = near_rows(200, 5)
    df = spark.createDataFrame(rows, "seq long, signature string")
    kept = []
    for seq, text in rows:
        if not any(alike(text, t, 9, 10) for _, t in kept):
            kept.append((seq, text))
    got = {r.seq: r.kept for r in D.resolve_greedy(df, D.similar_pairs(df, "signature", 9, 10), "signature").collect()}
    assert got == {seq: (seq, text) in kept for seq, text in rows}


@pytest.mark.parametrize(("slice_pairs", "held"), [(500_000, 100_000), (13, 3)])
def test_greedy_over_any_pairs_is_the_walk(spark, monkeypatch, slice_pairs, held):
    """Chains, stars, dense groups and long loops, in one task and over many."""
    monkeypatch.setattr(D, "SLICE_PAIRS", slice_pairs)
    monkeypatch.setattr(D, "HELD", held)
    rnd = random.Random(held)
    pairs = {(i, i + 1) for i in range(120)} | {(200, i) for i in range(201, 215)} | {(i, 240) for i in range(215, 232)}
    pairs |= {tuple(sorted(rnd.sample(range(300, 340), 2))) for _ in range(150)} | {(i, i + rnd.choice([1, 2, 7])) for i in range(400, 460)}
    kept = {}
    for i in range(500):
        kept[i] = not any(kept[a] for a, b in pairs if b == i)
    rows = spark.range(500).select(F.col("id").alias("seq"), F.concat(F.lit("t"), "id").alias("t"))
    got = {r.seq: r.kept for r in D.resolve_greedy(rows, spark.createDataFrame(sorted(pairs), "a long, b long"), "t").collect()}
    assert got == kept


@pytest.mark.parametrize("slice_pairs", [500_000, 700])
def test_a_chain_of_thousands_takes_few_jobs(spark, monkeypatch, slice_pairs):
    monkeypatch.setattr(D, "SLICE_PAIRS", slice_pairs)
    rows = spark.range(5000).select(F.col("id").alias("seq"), F.concat(F.lit("t"), "id").alias("t"))
    chain = spark.range(4999).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got, jobs = jobs_of(spark, f"chain-{slice_pairs}", lambda: D.resolve_greedy(rows, chain, "t").where(F.col("kept") != (F.col("seq") % 2 == 0)).count())
    assert got == 0
    assert jobs < 40 or slice_pairs < 1000


def test_greedy_keeps_what_only_dropped_rows_block(spark):
    rows, chain = spark.range(1, 30).select(F.col("id").alias("seq"), F.concat(F.lit("t"), "id").alias("t")), [(i, i + 1) for i in range(1, 28)]
    out = {r.seq: r.kept for r in D.resolve_greedy(rows, spark.createDataFrame(chain, "a long, b long"), "t").collect()}
    assert out == {i: i % 2 == 1 or i == 29 for i in range(1, 30)}
    assert D.resolve_greedy(rows, spark.createDataFrame([], "a long, b long"), "t").where("NOT kept").count() == 0


def test_a_hot_key_is_numbered_in_ranges(spark):
    """One key with nine tenths of the rows: numbers, batches and caps are those of a plain sort, and no window sees all of it."""
    rnd = random.Random(3)
    rows = [("hot" if i % 10 else f"k{i}", x) for i, x in enumerate(rnd.sample(range(10_000), 2000))] + [(None, 3), (None, 1)]
    df = spark.createDataFrame(rows, "k string, seq long")
    got = {(r.k, r.seq): r.n for r in numbered(df, ["seq"], "n", ["k"]).collect()}
    groups = {k: sorted(x for a, x in rows if a == k) for k, _ in rows}
    assert got == {(k, x): i for k, xs in groups.items() for i, x in enumerate(xs)}
    seen = running_total(df, ["seq"], F.lit(1), "n", ["k"]).groupBy("k").count()
    assert seen.where("k = 'hot'").first()["count"] == 1800
    whole = numbered(df.where("k IS NOT NULL").repartition(7), ["seq"], "n").orderBy("n").collect()
    assert [r.n for r in whole] == list(range(2000)) and [r.seq for r in whole] == sorted(x for k, x in rows if k)


def test_caps_keep_the_newest_of_a_hot_kind(spark):
    rnd, t0 = random.Random(6), dt.datetime(2024, 1, 1)
    rows = [("hot", rnd.randrange(900), t0 + dt.timedelta(seconds=rnd.randrange(300))) for _ in range(900)] + [("b", i, t0) for i in range(5)] + [("other", 1, t0)]
    df = spark.createDataFrame(rows, "kind string, value long, created_at timestamp")
    caps = {"hot": 100, "b": 50}
    order = lambda k: sorted(((t, v) for kind, v, t in rows if kind == k), reverse=True)
    for salts in (1, 7):
        got = sorted((r.kind, r.created_at, r.value) for r in R.latest_n_per_kind(df, caps, salts).collect())
        assert got == sorted((k, t, v) for k, n in caps.items() for t, v in order(k)[:n])
    left = sorted((r.kind, r.created_at, r.value) for r in R.trim_oldest(df.unionByName(df), {"hot": 150}).collect())
    twice = sorted([x for x in order("hot") for _ in range(2)], reverse=True)
    assert left == sorted(("hot", t, v) for t, v in twice[150:])


def test_first_seen_breaks_ties(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, 5, t0), (1, 3, t0), (1, 1, t0 + dt.timedelta(1)), (2, 9, t0)], "key long, value long, created_at timestamp")
    assert sorted((r.key, r.value) for r in R.first_seen(df, "key", "created_at").collect()) == [(1, 3), (2, 9)]


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rnd.randrange(90), rnd.randrange(90)) for _ in range(50)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    want = {n: root(n) for a, b in edges if a != b for n in (a, b)}
    assert {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()} == want
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_quotas(spark):
    leaves = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "leaf_path string, sort_key string")
    assert [r.quota for r in P.allocate_quotas(leaves, 10).orderBy("leaf_path").collect()] == [4, 3, 3]


def test_quotas_of_new_leaves(spark):
    leaves = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "leaf_path string, sort_key string")
    out = P.allocate_quotas(leaves, 10, spark.createDataFrame([("a",)], "leaf_path string")).orderBy("leaf_path").collect()
    assert [(r.leaf_path, r.quota) for r in out] == [("b", 3), ("c", 3)]
    assert P.allocate_quotas(leaves.limit(0), 10).count() == 0


TOPIC = "id long, parent_id long, name string, definition string, pos int"


def test_deep_trees_are_whole_and_broken_ones_an_error(spark):
    chain = [(i, i - 1 if i else None, f"n{i}", f"d{i}", 0) for i in range(41)]
    leaf = P.flatten_tree(spark.createDataFrame(chain, TOPIC)).collect()
    assert len(leaf) == 1 and leaf[0].leaf_path.count(" > ") == 40 and leaf[0].main_subtopics_string.startswith("d0. d1. ")
    for bad in ([*chain[:3], (7, 8, "a", "", 0), (8, 7, "b", "", 0)], [*chain[:3], (9, 99, "orphan", "", 0)]):
        with pytest.raises(ValueError, match="root"):
            P.flatten_tree(spark.createDataFrame(bad, TOPIC))
    with pytest.raises(ValueError, match="within 5"):
        P.flatten_tree(spark.createDataFrame(chain, TOPIC), 5)


def test_a_thousand_levels_take_few_rounds(spark, monkeypatch):
    """Rounds follow the logarithm of the depth; the tree has two deep branches."""
    rounds, inner = [], P.stored
    monkeypatch.setattr(P, "stored", lambda df, name: (rounds.append(name), inner(df, name))[1])
    chain = [(i, i - 1 if i else None, f"n{i}", f"d{i}", 0) for i in range(1001)]
    chain += [(5000 + i, 4999 + i if i else 500, f"m{i}", None, 1) for i in range(300)]
    out = {r.core_topic: r for r in P.flatten_tree(spark.createDataFrame(chain, TOPIC)).collect()}
    assert rounds.count("stretches") <= 12 and set(out) == {"n1000", "m299"}
    assert out["n1000"].leaf_path == " > ".join(f"n{i}" for i in range(1001))
    assert out["m299"].leaf_path.split(" > ")[499:503] == ["n499", "n500", "m0", "m1"] and out["m299"].main_subtopics_string.endswith("d499. d500.")
    assert P.flatten_tree(spark.createDataFrame([], TOPIC)).count() == 0


OPTION = "grp string, id long, pos int, weight double"


@pytest.mark.parametrize("chunk", [4096, 3])
def test_draws_from_a_table_are_those_of_a_walk(spark, monkeypatch, chunk):
    """Equal places, null, negative and zero weights, a group of zeros, a null group, a group without options."""
    monkeypatch.setattr(P, "CHUNK", chunk)
    rnd = random.Random(chunk)
    options = [(rnd.choice(["a", "b"]), i, rnd.randrange(9), rnd.choice([None, -2.0, 0.0, 0.5, 3.25, 1e-6])) for i in range(60)]
    options += [("zero", 1, 1, 0.0), (None, 7, 1, 2.0)]
    df = spark.range(500).select(F.col("id").alias("slot_id"), F.element_at(F.array(*(F.lit(x) for x in ("a", "b", "zero", "none"))), (F.col("id") % 4 + 1).cast("int")).alias("grp"), F.lit("x").alias("id"))
    out = P.weighted_draw(df, spark.createDataFrame(options, OPTION), "grp", "axis", 5)
    assert out.columns == ["slot_id", "grp", "id", "axis"]
    rows = out.withColumn("u", P.fine_uniform(5, "axis", F.col("slot_id"))).collect()
    assert len(rows) == 500
    for r in rows:
        own = sorted((pos, i, round(w * P.UNITS)) for g, i, pos, w in options if g == r.grp and w and w > 0)
        total, at, want = sum(w for _, _, w in own), 0, None
        for _, i, w in own:
            at += w
            if at > int(r.u * total):
                want = i
                break
        assert r.axis == want
    share = sum(r.axis is None for r in rows)
    assert share == 250


def test_many_options_a_group(spark):
    """10,000 options a group over two levels of rows; what is drawn follows the weights."""
    options = spark.range(20_000).select((F.col("id") % 2).cast("string").alias("grp"), "id", F.lit(0).alias("pos"), F.when(F.col("id") < 2000, F.lit(9.0)).otherwise(F.lit(1.0)).alias("weight"))
    df = spark.range(4000).select(F.col("id").alias("slot_id"), (F.col("id") % 2).cast("string").alias("grp"))
    out = P.weighted_draw(df, options, "grp", "axis", 1)
    low, odd = out.agg(F.avg((F.col("axis") < 2000).cast("int")), F.count_if(F.col("axis") % 2 != F.col("grp").cast("int"))).first()
    assert abs(low - 0.5) < 0.04 and odd == 0


def test_sketches_by_day_merge_and_late_days_are_replaced(spark, tmp_path):
    rows = spark.range(60_000).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 20 * 86400).alias("created_at"), (F.col("id") % 25_000).cast("string").alias("hash"))
    path = str(tmp_path / "days")
    R.put_days(R.day_sketches(rows.where("created_at < TIMESTAMP '2024-01-11'")), path)
    R.put_days(R.day_sketches(rows.where("created_at >= TIMESTAMP '2024-01-10' AND hash > '5'")), path)
    R.put_days(R.day_sketches(rows.where("created_at >= TIMESTAMP '2024-01-09'")), path)
    read = lambda: spark.read.schema(R.DAY_SKETCHES).parquet(path)
    assert read().count() == 20
    whole = R.distinct_over(read()).first()
    assert whole.n_rows == 60_000 and abs(whole.n_hashes - 25_000) < 0.03 * 25_000
    by_half = {r.half: r for r in R.distinct_over(read(), (F.dayofmonth("day") > 10).alias("half")).collect()}
    exact = rows.groupBy((F.dayofmonth("created_at") > 10).alias("half")).agg(F.count_distinct("hash").alias("n")).collect()
    assert all(abs(by_half[r.half].n_hashes - r.n) < 0.03 * r.n for r in exact)
    assert R.distinct_over(R.day_sketches(rows.limit(0))).first().n_rows is None


def test_no_recent_repeat_where_there_is_a_choice(spark):
    plan = spark.createDataFrame([(r, s, [f"c{k}" for k in range(30)]) for r in (1, 2) for s in range(60)], "run_id long, step long, allowed array<string>")
    picked = P.pick_without_recent(plan).cache()
    assert picked.count() == 120 and P.audit_recent_repeats(picked).count() == 0


def test_repeats_within_a_hot_run(spark):
    rnd = random.Random(2)
    plan = [(7 if i % 2 else i % 30, i, rnd.choice([None, *(f"c{k}" for k in range(12))])) for i in range(900)]
    got = {(r.run_id, r.step) for r in P.audit_recent_repeats(spark.createDataFrame(plan, "run_id long, step long, category string"), 6).collect()}
    want, before = set(), {}
    for run, step, c in plan:
        past = before.setdefault(run, [])
        if c is not None and c in past[-6:]:
            want.add((run, step))
        past.append(c)
    assert got == want and len(got) > 100


def test_keys_of_a_state_come_in_rows_of_bounded_length(spark):
    states = spark.range(1000).select(F.col("id").alias("idx"), F.when(F.col("id") % 10 == 0, F.lit("dead")).otherwise(F.lit("working")).alias("state"))
    rows = R.key_lists(states, 64).collect()
    assert max(len(r.ids) for r in rows) == 64
    for state in ("dead", "working"):
        own = [i for r in sorted((r for r in rows if r.state == state), key=lambda r: r.part) for i in r.ids]
        assert own == [i for i in range(1000) if (i % 10 == 0) == (state == "dead")]


def test_a_run_of_any_length_is_picked_in_order(spark):
    """A run that holds half of all steps, over several batches of a partition, beside short ones, one out of choices."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        plan = [("hot" == r and 7 or r, s, [f"c{(s * k) % 31}" for k in range(1, 9)] if s % 50 else []) for r, n in (("hot", 600), (1, 200), (2, 150), (3, 1)) for s in range(n)]
        random.Random(3).shuffle(plan)
        df = spark.createDataFrame(plan, "run_id long, step long, allowed array<string>")
        got = {(r.run_id, r.step): r.category for r in P.pick_without_recent(df, 5).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    recent = {}
    for run, step, allowed in sorted(plan):
        before = recent.setdefault(run, [])
        fresh = [c for c in allowed if c not in before[-5:]] or allowed
        want = min(fresh, key=lambda c: (hashlib.md5(f"42|category|{step}|{c}".encode()).hexdigest(), c)) if fresh else None
        assert got[run, step] == want
        before.append(want)


def test_report_on_an_empty_log(spark):
    row = R.progress_report(spark.createDataFrame([], "tag_prefix string, count long, created_at timestamp"), "2024-01-10 00:00:00", 600).first()
    assert (row.avg_per_day, row.eta_days, row.days_elapsed, row.total_all) == (1, 600, 1, 0)


def test_unknown_tags_count_as_batch(spark):
    log = spark.createDataFrame([(None, 2), ("odd", 3), ("flagged", None)], "tag_prefix string, count long")
    assert {r.tag: (r.total, r.batches) for r in R.totals_by_tag(log).collect()} == {"batch": (5, 2), "flagged": (0, 1)}


def test_weighted_pick_follows_the_weights(spark):
    out = P.weighted_pick(spark.range(20000).withColumnRenamed("id", "slot_id"), [("a", 1), ("b", 3)], "axis", 7)
    share = out.agg(F.avg((F.col("axis") == "b").cast("int"))).first()[0]
    assert abs(share - 0.75) < 0.02
