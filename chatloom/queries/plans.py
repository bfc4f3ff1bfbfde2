"""Queries on quotas and sampling plans: region, nation and customer stand for a topic tree, orders for slots."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.operators import planning as P
from chatloom.queries.base import read
from chatloom.sources.scratch import stored

STAGES = [("0", 4), ("1", 8), ("2", 26), ("3", 26), ("4", 20), ("5", 16)]
TONES = [("fun", 60), ("soft", 25), ("heavy", 15)]
STYLES = [("short", 3), ("chatty", 3), ("shy", 2)]
EDGES = [("alone", 20.0, 3), ("real", 10.0, 0), ("tired", 5.0, 0)]
TYPES = [("banter", "fun", 0), ("care", "heavy", 0), ("warm", "soft", 1), ("deep", "soft", 4), ("open", None, 2)]
CATEGORIES = [("greet", "banter"), ("tease", "banter"), ("hold", "care"), ("dream", "warm"), ("vow", "deep"), ("story", "open"), ("stray", "none")]
MOODS = ["calm", "bright", "tense", "shy"]
FORBIDDEN = [("banter", ["tense"]), ("care", ["bright", "shy"]), ("deep", ["bright", "tense", "calm", "shy"])]
KNOWN, DEFAULT = ["later", "promise", "sleep", "smile"], ["smile", "later"]


def _topics(spark, d):
    r = read(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("id"), F.lit(None).cast("long").alias("parent_id"), F.col("r_name").alias("name"), F.concat(F.lit("about "), "r_name").alias("definition"), F.col("r_regionkey").cast("int").alias("pos"))
    n = read(spark, d, "nation").select((F.col("n_nationkey") + 1000).cast("long").alias("id"), F.col("n_regionkey").cast("long").alias("parent_id"), F.col("n_name").alias("name"), F.concat(F.lit("of "), "n_name").alias("definition"), F.col("n_nationkey").cast("int").alias("pos"))
    c = read(spark, d, "customer").select((F.col("c_custkey") + 1000000).cast("long").alias("id"), (F.col("c_nationkey") + 1000).cast("long").alias("parent_id"), F.col("c_name").alias("name"), F.concat(F.lit("with "), "c_name").alias("definition"), F.col("c_custkey").cast("int").alias("pos"))
    return r.unionByName(n).unionByName(c)


LEAF = """leaf AS (SELECT r_name || ' > ' || n_name || ' > ' || c_name AS leaf_path, 'about ' || r_name || '. of ' || n_name || '.' AS main_subtopics_string, c_name AS core_topic, 'with ' || c_name AS core_definition,
 printf('%09d.%09d.%09d', r_regionkey, n_nationkey, c_custkey) AS sort_key FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
 UNION ALL SELECT r_name || ' > ' || n_name, 'about ' || r_name || '.', n_name, 'of ' || n_name, printf('%09d.%09d', r_regionkey, n_nationkey) FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer)
 UNION ALL SELECT r_name, '', r_name, 'about ' || r_name, printf('%09d', r_regionkey) FROM region WHERE r_regionkey NOT IN (SELECT n_regionkey FROM nation))"""
#: A plan has as many slots as there are orders.
QUOTA = LEAF + ", n AS (SELECT count(*) AS n FROM orders), q AS (SELECT leaf_path, (n // count(*) OVER ()) + CASE WHEN row_number() OVER (ORDER BY sort_key) <= n % count(*) OVER () THEN 1 ELSE 0 END AS quota FROM leaf, n)"
ORDER = "p AS (SELECT leaf_path, row_number() OVER (ORDER BY md5('42|' || leaf_path), leaf_path) - 1 AS pos FROM leaf)"


def flatten_tree(spark, d):
    return P.flatten_tree(_topics(spark, d)).drop("id")


def seeded_order(spark, d):
    return P.seeded_order(P.flatten_tree(_topics(spark, d))).select("leaf_path", F.col("pos").cast("long"))


def _total(spark, d):
    return read(spark, d, "orders").count()


def quotas(spark, d):
    return P.allocate_quotas(P.flatten_tree(_topics(spark, d)), _total(spark, d))


def quotas_of_new(spark, d):
    """Quotas where every third topic has one already."""
    leaves = stored(P.flatten_tree(_topics(spark, d)), "leaves")
    return P.allocate_quotas(leaves, _total(spark, d), leaves.where(F.length("leaf_path") % 3 == 0))


def _state(spark, d):
    leaves = stored(P.flatten_tree(_topics(spark, d)), "leaves")
    q = P.allocate_quotas(leaves, _total(spark, d)).withColumn("generated", F.pmod(F.length("leaf_path"), F.lit(3)).cast("long"))
    return P.seeded_order(leaves).select("leaf_path", "pos").join(q, "leaf_path")


STATE = QUOTA + ", " + ORDER + ", st AS (SELECT leaf_path, pos, quota, length(leaf_path) % 3 AS generated FROM q JOIN p USING (leaf_path))"


def expand_plan(spark, d):
    return P.expand_plan(_state(spark, d)).select(F.col("pos").cast("long"), "leaf_path", "slot")


def next_leaf(spark, d):
    return P.next_leaf(_state(spark, d))


def leaf_lookup(spark, d):
    """Attributes of the leaves that the plan's slots are on."""
    plan = P.expand_plan(_state(spark, d))
    leaves = P.flatten_tree(_topics(spark, d)).select("leaf_path", "core_topic", "main_subtopics_string")
    return plan.join(leaves, "leaf_path").groupBy("core_topic", "main_subtopics_string").agg(F.count("*").alias("slots"))


def _slots(spark, d):
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("slot_id"), F.col("o_custkey").alias("cust"))


def _drawn(spark, d):
    return P.weighted_pick(P.weighted_pick(_slots(spark, d), STAGES, "stage", 42).withColumn("stage", F.col("stage").cast("int")), TONES, "tone", 42)


def _u(axis: str) -> str:
    return f"(('0x' || substr(md5('42|{axis}|' || slot_id), 1, 8))::BIGINT / 4294967296.0)"


def _case(axis: str, options: list) -> str:
    low, total, out = 0, sum(w for _, w in options), "CASE"
    for name, w in options[:-1]:
        low += w
        out += f" WHEN {_u(axis)} * {total}.0 < {low}.0 THEN '{name}'"
    return out + f" ELSE '{options[-1][0]}' END"


SLOT = "sl AS (SELECT o_orderkey AS slot_id, o_custkey AS cust FROM orders)"
DRAWN = SLOT + f", dr AS (SELECT slot_id, cust, ({_case('stage', STAGES)})::INT AS stage, {_case('tone', TONES)} AS tone FROM sl)"


def weighted_pick(spark, d):
    return _drawn(spark, d).select("slot_id", "stage", "tone")


def weighted_table(spark, d):
    """A part for every slot, drawn by price from half of the parts; slots of a third group have none."""
    weight = F.when(F.col("p_partkey") % 10 == 3, F.lit(None)).when(F.col("p_partkey") % 10 == 4, F.lit(0)).otherwise(F.col("p_retailprice").cast("double"))
    options = read(spark, d, "part").select((F.col("p_partkey") % 2).cast("long").alias("grp"), F.col("p_partkey").alias("id"), F.col("p_size").alias("pos"), weight.alias("weight"))
    slots = _slots(spark, d).select("slot_id", F.pmod(F.col("slot_id"), F.lit(3)).cast("long").alias("grp"))
    return P.weighted_draw(slots, options, "grp", "part", 42).select("slot_id", F.col("part").cast("long").alias("part"))


#: Draws by the cumulative weights of a window.
DRAWN_PART = """WITH o AS (SELECT p_partkey % 2 AS grp, p_partkey AS id, p_size AS pos, round(CASE p_partkey % 10 WHEN 3 THEN NULL WHEN 4 THEN 0 ELSE p_retailprice::DOUBLE END * 1000000)::BIGINT AS units FROM part),
c AS (SELECT grp, id, sum(units) OVER (PARTITION BY grp ORDER BY pos, id)::BIGINT AS top FROM o WHERE units > 0), t AS (SELECT grp, max(top) AS total FROM c GROUP BY grp),
s AS (SELECT o_orderkey AS slot_id, o_orderkey % 3 AS grp FROM orders),
g AS (SELECT slot_id, s.grp, floor(('0x' || substr(md5('42|part|' || slot_id), 1, 13))::BIGINT / 4503599627370496.0 * total)::BIGINT AS target FROM s LEFT JOIN t ON t.grp = s.grp)
SELECT slot_id, id::BIGINT AS part FROM g ASOF LEFT JOIN c ON g.grp = c.grp AND g.target < c.top"""


def edge_pick(spark, d):
    return P.edge_pick(_drawn(spark, d), EDGES, 42).select("slot_id", "edge")


def bias_tone(spark, d):
    bias = F.when(F.col("cust") % 3 == 0, F.lit("heavy")).when(F.col("cust") % 3 == 1, F.lit("fun"))
    return _drawn(spark, d).select("slot_id", P.apply_bias(F.col("tone"), bias).alias("tone"))


def _tables(spark):
    return spark.createDataFrame(CATEGORIES, "category string, conv_type string"), spark.createDataFrame(TYPES, "conv_type string, tone_class string, min_stage int")


def _values(rows: list[tuple], names: str) -> str:
    shown = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(shown, r)) + ')' for r in rows)}) v({names}))"


def allowed_categories(spark, d):
    cells = _drawn(spark, d).select("stage", "tone").distinct()
    out = P.allowed_categories(cells, *_tables(spark))
    return _drawn(spark, d).join(out, ["stage", "tone"]).select("slot_id", F.array_join("allowed", ",").alias("allowed"))


ALLOWED = DRAWN + f""", ca AS (SELECT * FROM {_values(CATEGORIES, 'category, conv_type')} LEFT JOIN {_values(TYPES, 'conv_type, tone_class, min_stage')} USING (conv_type)),
al AS (SELECT stage, tone, string_agg(category, ',' ORDER BY category) AS allowed FROM (SELECT DISTINCT stage, tone FROM dr) c JOIN ca ON (tone_class IS NULL OR tone_class = tone) AND stage >= coalesce(min_stage, 0) GROUP BY ALL)"""


def category_type(spark, d):
    names = [c for c, _ in CATEGORIES] + ["unmapped"]
    cat = F.element_at(F.array(*map(F.lit, names)), F.pmod("slot_id", F.lit(len(names))).cast("int") + 1)
    return P.category_type(_slots(spark, d).select("slot_id", cat.alias("category")), spark.createDataFrame(CATEGORIES, "category string, conv_type string"), "banter")


def _typed(spark, d):
    kind = F.element_at(F.array(*(F.lit(t) for t, _, _ in TYPES)), F.pmod("slot_id", F.lit(len(TYPES))).cast("int") + 1)
    return _slots(spark, d).select("slot_id", kind.alias("conv_type"))


TYPED = SLOT + f", ty AS (SELECT slot_id, [{', '.join(repr(t) for t, _, _ in TYPES)}][(slot_id % {len(TYPES)})::INT + 1] AS conv_type FROM sl)"
PAIRS = "(SELECT * FROM (VALUES " + ", ".join(f"('{t}', '{m}')" for t, ms in FORBIDDEN for m in ms) + ") v(conv_type, mood))"
CANDS = TYPED + f", cd AS (SELECT slot_id, conv_type, mood FROM (SELECT slot_id, conv_type, unnest({MOODS}) AS mood FROM ty) ANTI JOIN {PAIRS} f USING (conv_type, mood))"


def _cands(spark, d):
    rules = spark.createDataFrame(FORBIDDEN, "left_key string, forbidden array<string>")
    every = _typed(spark, d).withColumn("mood", F.explode(F.array(*map(F.lit, MOODS))))
    return P.conflict_filter(every, rules, "conv_type", "mood")


def conflict_filter(spark, d):
    return _cands(spark, d)


def contains_filter(spark, d):
    """Parts whose name holds a word don't go with some types."""
    rules = spark.createDataFrame([("ring", ["ECONOMY", "PROMO"]), ("red", ["STANDARD"])], "left_key string, forbidden array<string>")
    return P.contains_filter(read(spark, d, "part").select("p_partkey", "p_name", "p_type"), rules, F.col("p_name"), "p_type").select("p_partkey")


def allow_filter(spark, d):
    rules = spark.createDataFrame(FORBIDDEN, "left_key string, forbidden array<string>")
    every = _typed(spark, d).withColumn("mood", F.explode(F.array(*map(F.lit, MOODS))))
    return P.allow_filter(every, rules, "conv_type", "mood")


def pick_one(spark, d):
    return P.pick_one(_typed(spark, d).select("slot_id"), _cands(spark, d).select("slot_id", "mood"), "slot_id", "mood", "mood", 42, "calm")


def pick_n(spark, d):
    return P.pick_n(_cands(spark, d), "slot_id", "mood", "vibe", 42, 2).select("slot_id", "mood", F.col("rank").cast("long"))


def ending_candidates(spark, d):
    k = F.pmod("slot_id", F.lit(6))
    prefs = F.when(k < 3, F.array(F.lit("promise"), F.lit("sleep"))).when(k == 3, F.array(F.lit("gone"))).otherwise(F.array().cast("array<string>"))
    lean = F.when(k % 2 == 0, F.array(F.lit("sleep"), F.lit("smile"))).otherwise(F.array().cast("array<string>"))
    return _slots(spark, d).select("slot_id", F.array_join(P.ending_candidates(prefs, lean, KNOWN, DEFAULT), ",").alias("endings"))


ENDINGS = f"WITH {SLOT} SELECT slot_id, CASE slot_id % 6 WHEN 0 THEN 'sleep' WHEN 1 THEN 'promise,sleep' WHEN 2 THEN 'sleep' WHEN 3 THEN 'later,promise,sleep,smile' WHEN 4 THEN 'sleep,smile' ELSE 'later,smile' END AS endings FROM sl"


def _runs(spark, d):
    e = read(spark, d, "events")
    return e.select(F.col("user_id").cast("long").alias("run_id"), F.col("event_id").cast("long").alias("step"), F.concat("event_type", F.lit("-"), F.floor(F.col("value")) % 7).alias("category"))


def audit_recent_repeats(spark, d):
    return P.audit_recent_repeats(_runs(spark, d), 25).select("run_id", "step", "category")


def recent_pick(spark, d):
    """Categories of each user's events that no pick within 25 before repeats; none may be audited as a repeat but for runs out of choices."""
    plan = _runs(spark, d).select("run_id", "step", F.array(*(F.lit(f"c{k:02d}") for k in range(40))).alias("allowed"))
    return P.pick_without_recent(plan)


def prompt(spark, d):
    out = P.edge_pick(_drawn(spark, d), EDGES, 42)
    text = P.assemble_prompt(F.lit("Rules"), F.concat(F.lit("Tone: "), "tone"), F.when(F.col("tone") == "heavy", F.lit("Be gentle")).otherwise(F.lit("")), F.concat(F.lit("Edge: "), "edge"))
    return out.select("slot_id", text.alias("prompt"))


def plan_job(spark, d):
    """The whole plan: a row per slot with its draws."""
    from chatloom.plans.jobs import plan

    out = plan(_topics(spark, d), _total(spark, d), STAGES, TONES, STYLES, EDGES)
    return out.select("leaf_path", "slot", F.col("stage").cast("long"), "tone", "style", "edge")


#: One pick a round in every run: of the least rank among the categories that the last 25 picks do not hold.
PICKED = """WITH RECURSIVE e AS (SELECT user_id::BIGINT AS run_id, event_id::BIGINT AS step, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
c AS (SELECT list(printf('c%02d', i)) AS every FROM range(40) t(i)),
w(run_id, k, step, category, recent) AS (SELECT DISTINCT run_id, 0::BIGINT, NULL::BIGINT, NULL::VARCHAR, []::VARCHAR[] FROM e UNION ALL
 SELECT run_id, k, step, best, list_append(recent, best)[-25:] FROM (SELECT e.run_id, e.k, e.step, w.recent,
  list_min([md5('42|category|' || e.step || '|' || x) || x FOR x IN every IF NOT list_contains(w.recent, x)])[33:] AS best FROM w JOIN e ON e.run_id = w.run_id AND e.k = w.k + 1, c))
SELECT run_id, step, category FROM w WHERE k > 0"""
EDGE = "CASE" + "".join(f" WHEN stage >= {least} AND {_u(f'edge:{name}')} < {rate / 100.0} THEN '{name}'" for name, rate, least in EDGES) + " END"
RANK = "md5('42|{0}|' || slot_id || '|' || mood)"

QUERIES = {
    "plan_job": (plan_job, f"WITH {QUOTA}, sl AS (SELECT leaf_path, slot, leaf_path || '#' || slot AS slot_id FROM (SELECT leaf_path, unnest(range(1, quota + 1))::BIGINT AS slot FROM q)), dr AS (SELECT *, ({_case('stage', STAGES)})::BIGINT AS stage, {_case('tone', TONES)} AS tone, {_case('style', STYLES)} AS style FROM sl) SELECT leaf_path, slot, stage, tone, style, {EDGE} AS edge FROM dr"),
    "flatten_tree": (flatten_tree, f"WITH {LEAF} SELECT * FROM leaf"),
    "seeded_order": (seeded_order, f"WITH {LEAF}, {ORDER} SELECT * FROM p"),
    "quotas": (quotas, f"WITH {QUOTA} SELECT leaf_path, quota::BIGINT AS quota FROM q"),
    "quotas_of_new": (quotas_of_new, f"WITH {QUOTA} SELECT leaf_path, quota::BIGINT AS quota FROM q WHERE length(leaf_path) % 3 <> 0"),
    "expand_plan": (expand_plan, f"WITH {STATE} SELECT pos, leaf_path, unnest(range(generated + 1, quota + 1))::BIGINT AS slot FROM st WHERE quota > generated"),
    "next_leaf": (next_leaf, f"WITH {STATE} SELECT arg_min(leaf_path, pos) AS leaf_path FROM st WHERE generated < quota"),
    "leaf_lookup": (leaf_lookup, f"WITH {STATE} SELECT core_topic, main_subtopics_string, sum(quota - generated)::BIGINT AS slots FROM st JOIN leaf USING (leaf_path) WHERE quota > generated GROUP BY ALL"),
    "weighted_pick": (weighted_pick, f"WITH {DRAWN} SELECT slot_id, stage, tone FROM dr"),
    "weighted_table": (weighted_table, DRAWN_PART),
    "edge_pick": (edge_pick, f"WITH {DRAWN} SELECT slot_id, {EDGE} AS edge FROM dr"),
    "bias_tone": (bias_tone, f"WITH {DRAWN} SELECT slot_id, CASE WHEN (cust % 3 = 0 AND tone = 'fun') OR (cust % 3 = 1 AND tone = 'heavy') THEN 'soft' ELSE tone END AS tone FROM dr"),
    "allowed_categories": (allowed_categories, f"WITH {ALLOWED} SELECT slot_id, coalesce(allowed, (SELECT string_agg(category, ',' ORDER BY category) FROM ca)) AS allowed FROM dr LEFT JOIN al USING (stage, tone)"),
    "category_type": (category_type, f"WITH {SLOT}, c AS (SELECT slot_id, [{', '.join(repr(c) for c, _ in CATEGORIES)}, 'unmapped'][(slot_id % {len(CATEGORIES) + 1})::INT + 1] AS category FROM sl) SELECT slot_id, category, coalesce(conv_type, 'banter') AS conv_type FROM c LEFT JOIN {_values(CATEGORIES, 'category, conv_type')} USING (category)"),
    "conflict_filter": (conflict_filter, f"WITH {CANDS} SELECT * FROM cd"),
    "allow_filter": (allow_filter, f"WITH {TYPED} SELECT slot_id, conv_type, mood FROM (SELECT slot_id, conv_type, unnest({MOODS}) AS mood FROM ty) SEMI JOIN {PAIRS} f USING (conv_type, mood)"),
    "contains_filter": (contains_filter, "SELECT p_partkey FROM part WHERE NOT (contains(lower(p_name), 'ring') AND p_type IN ('ECONOMY', 'PROMO')) AND NOT (contains(lower(p_name), 'red') AND p_type = 'STANDARD')"),
    "pick_one": (pick_one, f"WITH {CANDS} SELECT slot_id, coalesce(arg_min(mood, {RANK.format('mood')}), 'calm') AS mood FROM ty LEFT JOIN (SELECT slot_id, mood FROM cd) USING (slot_id) GROUP BY slot_id"),
    "pick_n": (pick_n, f"WITH {CANDS}, r AS (SELECT slot_id, mood, row_number() OVER (PARTITION BY slot_id ORDER BY {RANK.format('vibe')}) AS rank FROM cd) SELECT * FROM r WHERE rank <= 2"),
    "ending_candidates": (ending_candidates, ENDINGS),
    "recent_repeats": (audit_recent_repeats, "WITH e AS (SELECT user_id::BIGINT AS run_id, event_id::BIGINT AS step, event_type || '-' || floor(value)::BIGINT % 7 AS category FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step) AS k FROM e), p AS (SELECT *, k - lag(k) OVER (PARTITION BY run_id, category ORDER BY k) AS gap FROM n) SELECT run_id, step, category FROM p WHERE gap <= 25"),
    "recent_pick": (recent_pick, PICKED),
    "prompt": (prompt, f"WITH {DRAWN} SELECT slot_id, concat_ws(chr(10) || chr(10), 'Rules', 'Tone: ' || tone, CASE WHEN tone = 'heavy' THEN 'Be gentle' END, 'Edge: ' || {EDGE}) AS prompt FROM dr"),
}
