"""Totals, progress, histories and health of keys, from a batch log, leaf states and call logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.text import reason_family
from chatloom.operators.ordering import numbered

TAGS = ("batch", "flagged")


def tag(col: Column) -> Column:
    return F.when(col.isin(*TAGS), col).otherwise(F.lit("batch"))


def totals_by_tag(log: DataFrame) -> DataFrame:
    """(tag, total, batches) of log(tag_prefix, count)."""
    return log.groupBy(tag(F.col("tag_prefix")).alias("tag")).agg(F.sum(F.coalesce("count", F.lit(0))).alias("total"), F.count("*").alias("batches"))


def day_tag_totals(log: DataFrame) -> DataFrame:
    """(day, tag, level, total, batches): by day and tag, by day, and in all; level counts the keys summed over."""
    own = log.select(F.to_date("created_at").alias("day"), tag(F.col("tag_prefix")).alias("tag"), F.coalesce("count", F.lit(0)).alias("count"))
    out = own.rollup("day", "tag").agg(F.grouping_id().alias("gid"), F.sum("count").alias("total"), F.count("*").alias("batches"))
    return out.select("day", "tag", F.when(F.col("gid") == 0, 0).when(F.col("gid") == 1, 1).otherwise(2).alias("level"), F.coalesce("total", F.lit(0)).alias("total"), "batches")


def progress_report(log: DataFrame, as_of: str, target: int) -> DataFrame:
    """One row of figures as of a UTC time: totals by tag today, yesterday, recently and in all, rates and the estimated finish.

    Recent means the day three days before and later, over three days; an empty log has average 1.
    """
    now = F.lit(as_of).cast("timestamp")
    day, today = F.to_date("created_at"), F.to_date(now)
    n, t = F.coalesce("count", F.lit(0)), tag(F.col("tag_prefix"))
    total = lambda when: F.coalesce(F.sum(F.when(when, n)), F.lit(0))
    spans = {"today": day == today, "yesterday": day == F.date_sub(today, 1), "recent": day >= F.date_sub(today, 3), "total": F.lit(True)}
    sums = [total(w & (t == k)).alias(f"{s}_{'clean' if k == 'batch' else k}") for s, w in spans.items() for k in TAGS]
    row = log.agg(*sums, F.count("*").alias("total_batches"), F.min("created_at").alias("started_at"))
    row = row.withColumns({f"{s}_all": F.col(f"{s}_clean") + F.col(f"{s}_flagged") for s in spans})
    whole_days = F.floor((F.unix_micros(now) - F.unix_micros(F.coalesce("started_at", now))) / 86_400_000_000)
    row = row.withColumn("days_elapsed", F.greatest(F.lit(1), whole_days + 1).cast("long"))
    grand = F.col("total_all")
    average = F.when(grand > 0, grand / F.col("days_elapsed")).otherwise(F.lit(1.0))
    row = row.withColumn("avg", average).withColumn("rate", F.when(F.col("recent_all") > 0, F.col("recent_all") / 3).otherwise(F.col("avg")))
    remaining = F.greatest(F.lit(0), F.lit(target) - grand)
    row = row.withColumn("eta_days", F.floor(remaining / F.greatest("rate", F.lit(1.0))).cast("int"))
    share = lambda c: F.when(grand > 0, F.round(F.col(c) / grand * 100, 6)).otherwise(F.lit(0.0))
    return row.select(
        *(f"{s}_{k}" for s in spans for k in ("clean", "flagged", "all")), "total_batches", "days_elapsed",
        F.round(grand / F.lit(target) * 100, 6).alias("pct_complete"), share("total_clean").alias("clean_pct"), share("total_flagged").alias("flagged_pct"),
        F.col("avg").cast("long").alias("avg_per_day"), F.col("rate").cast("long").alias("recent_rate"), "eta_days",
        F.date_add(today, F.col("eta_days")).alias("estimated_finish"),
    )


def leaf_completion(state: DataFrame) -> DataFrame:
    return state.agg(F.count_if(F.col("generated") >= F.col("quota")).alias("leaves_completed"), F.count("*").alias("total_leaves"))


def leaf_progress(accepted: DataFrame, state: DataFrame) -> DataFrame:
    """state(leaf_path, quota, generated) with the accepted conversations of each leaf added."""
    new = accepted.groupBy("leaf_path").agg(F.count("*").alias("new"))
    return state.join(new, "leaf_path", "left").select("leaf_path", "quota", (F.col("generated") + F.coalesce("new", F.lit(0))).alias("generated"))


def daily_counts(results: DataFrame) -> DataFrame:
    """(day, generated, rejected) of results(created_at, ok)."""
    return results.groupBy(F.to_date("created_at").alias("day")).agg(F.count_if("ok").alias("generated"), F.count_if(~F.col("ok")).alias("rejected"))


def reason_histogram(results: DataFrame) -> DataFrame:
    """(kind, name, n): rejects by the family of their reason and accepted rows' flags by kind."""
    rejects = results.where("NOT ok").select(F.lit("reject").alias("kind"), reason_family(F.col("reason")).alias("name"))
    flags = results.where("ok").select(F.lit("flag").alias("kind"), F.explode("flags").alias("f")).select("kind", F.split_part("f", F.lit(":"), F.lit(1)).alias("name"))
    return rejects.unionByName(flags).groupBy("kind", "name").agg(F.count("*").alias("n"))


def key_id(key: Column) -> Column:
    return F.concat(F.lit("key_"), F.substring(F.sha2(key, 256), 1, 12))


def requests_per_key(calls: DataFrame) -> DataFrame:
    """(key_id, day, requests, last_used_at) of calls(key, ts)."""
    return calls.groupBy(key_id(F.col("key").cast("string")).alias("key_id"), F.to_date("ts").alias("day")).agg(
        F.count("*").alias("requests"), F.max("ts").alias("last_used_at")
    )


def key_states(registry: DataFrame, stats: DataFrame, as_of: str) -> DataFrame:
    """(idx, key_id, state): unknown without stats, dead, cooling until after as_of, else working."""
    own = registry.join(stats.withColumn("_known", F.lit(True)), "key_id", "left")
    cooling = F.col("cooldown_until") > F.lit(as_of).cast("timestamp")
    state = F.when(F.col("_known").isNull(), F.lit("unknown")).when(F.coalesce("dead", F.lit(False)), F.lit("dead")).when(cooling, F.lit("cooling"))
    return own.select("idx", "key_id", F.coalesce(state, F.lit("working")).alias("state"))


def key_health(states: DataFrame) -> DataFrame:
    """(state, n, ids): the registered keys of each state, ids sorted."""
    return states.groupBy("state").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("idx")).alias("ids"))


def key_lists(states: DataFrame, n: int = 1000) -> DataFrame:
    """(state, part, ids): the registered keys of each state in order, n of them a row, so that no row or task has all of a state."""
    placed = numbered(states.select("state", "idx"), ["idx"], "_at", ["state"], lazy=True).withColumn("part", F.floor(F.col("_at") / n).cast("long"))
    return placed.groupBy("state", "part").agg(F.array_sort(F.collect_list("idx")).alias("ids"))


def first_seen(df: DataFrame, key: str, order: str) -> DataFrame:
    """The earliest row of each key; of rows at one time that with the least other columns. Found by partial aggregation."""
    rest = [c for c in df.columns if c not in (key, order)]
    first = df.groupBy(key).agg(F.min(F.struct(order, *rest)).alias("_first"))
    return first.select(key, "_first.*").select(*df.columns)


def latest_n(df: DataFrame, n: int, order: str = "created_at", tie: str = "value") -> DataFrame:
    return df.orderBy(F.desc(order), F.desc(tie)).limit(n)


def _newest_first() -> list[Column]:
    return [F.desc("created_at"), F.desc("value")]


def latest_n_per_kind(df: DataFrame, caps: dict[str, int], salts: int | None = None) -> DataFrame:
    """The newest rows of each kind, as many as its cap; kinds without a cap have none.

    Each kind's rows are dealt to salts (as many as there are shuffle partitions), which keep their newest ones, and the
    kind's newest are among these: no task sees more than salts times the cap of a kind that holds most rows.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = F.element_at(F.create_map(*(F.lit(x) for pair in caps.items() for x in pair)), F.col("kind"))
    salted = Window.partitionBy("kind", "_salt").orderBy(*_newest_first())
    salt = F.pmod(F.xxhash64("created_at", "value"), F.lit(salts))
    few = df.where(F.col("kind").isin(*caps)).withColumn("_salt", salt).withColumn("_rank", F.row_number().over(salted)).where(F.col("_rank") <= limit)
    whole = Window.partitionBy("kind").orderBy(*_newest_first())
    return few.withColumn("_rank", F.row_number().over(whole)).where(F.col("_rank") <= limit).drop("_rank", "_salt")


def trim_oldest(df: DataFrame, caps: dict[str, int]) -> DataFrame:
    """The rows that latest_n_per_kind leaves out, of the kinds with a cap: those older than the oldest that it keeps, and
    of rows equal to that one as many as it leaves out."""
    kept = latest_n_per_kind(df, caps).groupBy("kind").agg(F.min(F.struct("created_at", "value")).alias("_least"), F.count("*").alias("_kept"))
    place = F.struct("created_at", "value")
    own = df.join(kept, "kind")
    older = own.where(place < F.col("_least"))
    ties = own.where(place == F.col("_least"))
    above = own.where(place > F.col("_least")).groupBy("kind").agg(F.count("*").alias("_above"))
    # Equal rows in any order: some of them stay, and no task sees all of a kind's.
    ranked = numbered(ties.join(above, "kind", "left").withColumn("_any", F.monotonically_increasing_id()), ["_any"], "_rank", ["kind"], lazy=True)
    left = ranked.where(F.col("_rank") >= F.col("_kept") - F.coalesce("_above", F.lit(0)))
    return older.select(*df.columns).unionByName(left.select(*df.columns))


def distinct_hashes(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: the number of rows and of different hashes."""
    count = F.approx_count_distinct("hash") if approximate else F.count_distinct("hash")
    return df.agg(F.count("*").alias("n_rows"), count.alias("n_hashes"))


#: Size of a sketch of different hashes: 2^14 registers, an error of under 1 %.
SKETCH = 14
DAY_SKETCHES = "n_rows long, sketch binary, day date"


def day_sketches(df: DataFrame) -> DataFrame:
    """(day, n_rows, sketch) of df(created_at, hash): what a day adds to counts of different hashes, mergeable."""
    own = df.groupBy(F.to_date("created_at").alias("day"))
    return own.agg(F.count("*").alias("n_rows"), F.hll_sketch_agg("hash", SKETCH).alias("sketch")).select("n_rows", "sketch", "day")


def put_days(sketches: DataFrame, path: str) -> None:
    """Writes days' sketches into the table at path; a day that is there already, as after late rows, is replaced."""
    dealt = sketches.repartition("day")
    dealt.write.partitionBy("day").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def distinct_over(sketches: DataFrame, *by: Column) -> DataFrame:
    """(by, n_rows, n_hashes): rows and the estimated number of different hashes, merged from day_sketches; rows are not read again."""
    return sketches.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_hashes"))
