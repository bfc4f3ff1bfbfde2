"""Queries on totals, progress and keys (events stand for batch and call logs) and on the streaming jobs, held to batch SQL."""

from __future__ import annotations

import itertools
import time

from pyspark.sql import functions as F

from chatloom.operators import reporting as R
from chatloom.operators import validation as V
from chatloom.operators.parsing import to_chatml
from chatloom.queries.base import CFG, DAY, PROMPT, convs, read, rendered
from chatloom.queries.conversations import BATCHES, ROUTED
from chatloom.queries.duplicates import BAND, RECENT, _keyed
from chatloom.queries.duplicates import TTL as _TTL
from chatloom.sources import conversations as S
from chatloom.sources.scratch import fs_path, scratch, stored
from chatloom.streaming import jobs as J
from chatloom.streaming.anchor_table import AnchorSink
from chatloom.streaming.batches import BatchSink, routed_batches

AS_OF = "2024-01-28 12:00:00"
TARGET = 600_000
DAYS = 90


def _events(spark, d):
    return read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _log(spark, d):
    """Events as batches: clicks are unflagged, errors flagged, views without a tag, others under unknown ones; some counts are missing."""
    kind = F.col("event_type")
    tag = F.when(kind == "error", F.lit("flagged")).when(kind == "view", F.lit(None)).when(kind == "click", F.lit("batch")).otherwise(kind)
    return _events(spark, d).select(tag.alias("tag_prefix"), F.when(F.col("event_id") % 11 > 0, F.col("event_id") % 15 + 1).alias("count"), F.col("ts").alias("created_at"))


LOG = """lg AS (SELECT CASE WHEN event_type = 'error' THEN 'flagged' ELSE 'batch' END AS tag, CASE WHEN event_id % 11 > 0 THEN event_id % 15 + 1 ELSE 0 END AS cnt, ts AS created_at FROM events)"""


def totals_by_tag(spark, d):
    return R.totals_by_tag(_log(spark, d))


def day_tag_rollup(spark, d):
    return R.day_tag_totals(_log(spark, d)).select(F.col("day").cast("string"), "tag", F.col("level").cast("long"), "total", "batches")


def progress_report(spark, d):
    return R.progress_report(_log(spark, d), AS_OF, TARGET).withColumn("estimated_finish", F.col("estimated_finish").cast("string")).withColumn("eta_days", F.col("eta_days").cast("long"))


_SUM = "coalesce(sum(cnt) FILTER ({0} AND tag = '{1}'), 0)::BIGINT AS {2}_{3}"
_SPANS = {"today": "created_at::DATE = DATE '2024-01-28'", "yesterday": "created_at::DATE = DATE '2024-01-27'", "recent": "created_at::DATE >= DATE '2024-01-25'", "total": "true"}
PROGRESS = f"""WITH {LOG}, a AS (SELECT {', '.join(_SUM.format(w, t, s, n) for s, w in _SPANS.items() for t, n in (('batch', 'clean'), ('flagged', 'flagged')))}, count(*) AS total_batches, min(created_at) AS s FROM lg),
b AS (SELECT *, today_clean + today_flagged AS today_all, yesterday_clean + yesterday_flagged AS yesterday_all, recent_clean + recent_flagged AS recent_all, total_clean + total_flagged AS total_all,
 greatest(1, floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(s)) / 86400000000.0)::BIGINT + 1) AS days_elapsed FROM a),
c AS (SELECT *, CASE WHEN total_all > 0 THEN total_all / days_elapsed ELSE 1 END AS av FROM b), r AS (SELECT *, CASE WHEN recent_all > 0 THEN recent_all / 3 ELSE av END AS rate FROM c),
e AS (SELECT *, floor(greatest(0, {TARGET} - total_all) / greatest(rate, 1))::BIGINT AS eta_days FROM r)
SELECT {', '.join(f'{s}_{k}' for s in _SPANS for k in ('clean', 'flagged', 'all'))}, total_batches, days_elapsed, round(total_all / {TARGET}.0 * 100, 6) AS pct_complete,
 round(total_clean / total_all * 100, 6) AS clean_pct, round(total_flagged / total_all * 100, 6) AS flagged_pct, trunc(av)::BIGINT AS avg_per_day, trunc(rate)::BIGINT AS recent_rate, eta_days,
 (DATE '2024-01-28' + eta_days::INT)::VARCHAR AS estimated_finish FROM e"""


def _leaves(spark, d):
    return read(spark, d, "customer").select(F.col("c_name").alias("leaf_path"), F.lit(12).cast("long").alias("quota"), F.lit(1).cast("long").alias("generated"))


def _accepted(spark, d):
    return read(spark, d, "orders").join(read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_name").alias("leaf_path"))


def leaf_progress(spark, d):
    return R.leaf_progress(_accepted(spark, d), _leaves(spark, d))


LEAVES = "lp AS (SELECT c_name AS leaf_path, 12::BIGINT AS quota, 1 + count(o_orderkey) AS generated FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_name)"


def leaf_completion(spark, d):
    return R.leaf_completion(leaf_progress(spark, d))


def daily_counts(spark, d):
    out = R.daily_counts(_events(spark, d).select(F.col("ts").alias("created_at"), (F.col("event_type") != "error").alias("ok")))
    return out.withColumn("day", F.col("day").cast("string"))


DAILY = "SELECT ts::DATE::VARCHAR AS day, count(*) FILTER (event_type <> 'error') AS generated, count(*) FILTER (event_type = 'error') AS rejected FROM events GROUP BY 1"


def requests_per_key(spark, d):
    out = R.requests_per_key(_events(spark, d).select(F.col("user_id").alias("key"), "ts"))
    return out.select("key_id", F.col("day").cast("string"), "requests", F.unix_micros("last_used_at").alias("last_used_us"))


def _states(spark, d):
    e = _events(spark, d)
    stats = e.where("user_id % 5 <> 4").groupBy(R.key_id(F.col("user_id").cast("string")).alias("key_id")).agg(
        (F.max("user_id") % 7 == 0).alias("dead"), F.max(F.when(F.col("event_type") == "error", F.col("ts") + F.expr("INTERVAL 2 DAYS"))).alias("cooldown_until")
    )
    registry = e.select(F.col("user_id").alias("idx"), R.key_id(F.col("user_id").cast("string")).alias("key_id")).distinct()
    return R.key_states(registry, stats, AS_OF)


KEYS = f"""ks AS (SELECT user_id AS idx, 'key_' || substr(sha256(user_id::VARCHAR), 1, 12) AS key_id, CASE WHEN user_id % 5 = 4 THEN 'unknown' WHEN user_id % 7 = 0 THEN 'dead'
 WHEN max(CASE WHEN event_type = 'error' THEN ts + INTERVAL 2 DAYS END) > TIMESTAMP '{AS_OF}' THEN 'cooling' ELSE 'working' END AS state FROM events GROUP BY user_id)"""


def key_states(spark, d):
    return _states(spark, d)


def key_health(spark, d):
    return R.key_health(_states(spark, d)).select("state", "n", F.array_join("ids", ",").alias("ids"))


def key_lists(spark, d):
    return R.key_lists(_states(spark, d), 50).select("state", "part", F.array_join("ids", ",").alias("ids"))


def _recent(spark, d):
    return _events(spark, d).select(F.col("event_type").alias("kind"), F.col("event_id").alias("value"), F.col("ts").alias("created_at"))


CAPS = {"view": 500, "click": 200, "error": 50}


def first_seen(spark, d):
    return R.first_seen(_recent(spark, d).withColumn("key", F.col("value") % 97), "key", "created_at").select("key", "value")


def latest_n(spark, d):
    return R.latest_n(_recent(spark, d), 100).select("value")


def latest_per_kind(spark, d):
    return R.latest_n_per_kind(_recent(spark, d).where(F.col("kind").isin(*CAPS)), CAPS).select("kind", "value")


def trim_oldest(spark, d):
    return R.trim_oldest(_recent(spark, d).where(F.col("kind").isin(*CAPS)), CAPS).groupBy("kind").agg(F.count("*").alias("n"), F.sum("value").alias("ids"))


_CAP = "CASE kind WHEN 'view' THEN 500 WHEN 'click' THEN 200 ELSE 50 END"
RANKED = "rk AS (SELECT event_type AS kind, event_id AS value, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS k FROM events WHERE event_type IN ('view', 'click', 'error'))"


def curation_report(spark, d):
    """The report job: progress, leaf completion and keys in one row."""
    from chatloom.plans.jobs import report

    out = report(_log(spark, d), leaf_progress(spark, d), _states(spark, d), AS_OF, TARGET)
    return out.select("total_all", "total_batches", "leaves_completed", "total_leaves", "keys_working", "keys_dead", "keys_cooling", "keys_unknown")


def _day_hashes(spark, d):
    return _events(spark, d).select(F.col("ts").alias("created_at"), F.concat_ws(":", "user_id", "event_type", F.floor(F.col("value"))).alias("hash"), "event_id")


def distinct_sketches(spark, d):
    """Different hashes a month from days' sketches, the last of which are replaced once late rows are in; whether they are within 3 % of the exact count."""
    own, path = _day_hashes(spark, d), scratch(spark, "day-sketches")
    R.put_days(R.day_sketches(own.where("event_id % 10 > 0")), path)
    # Rows that come late: their days are written anew.
    R.put_days(R.day_sketches(own), path)
    sketches = spark.read.schema(R.DAY_SKETCHES).parquet(path)
    month = F.date_format("day", "yyyy-MM").alias("month")
    exact = own.groupBy(F.date_format("created_at", "yyyy-MM").alias("month")).agg(F.count_distinct("hash").alias("exact"))
    out = R.distinct_over(sketches, month).join(exact, "month")
    return out.select("month", "n_rows", F.col("exact").alias("n_hashes"), (F.abs(F.col("n_hashes") - F.col("exact")) <= 0.03 * F.col("exact")).alias("close"))


#: Micro-batches that a streamed table is cut into at least, and rows that one has at most.
PARTS, PART_ROWS = 4, 1_000_000


def _keeps_times(spark) -> bool:
    """Whether files of the shared folder can be given a time; object stores keep the one they were written at."""
    fs, file = fs_path(spark, scratch(spark, "time"))
    fs.create(file, True).close()
    fs.setTimes(file, 1_000_000_000_000, -1)
    return fs.getFileStatus(file).getModificationTime() == 1_000_000_000_000


def _stream(spark, df, order: str):
    """df as a stream of micro-batches in order: its ranges by the order, each later than the one before, written by all cores as equally many files."""
    src, own = scratch(spark, "stream-in"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    # A slice is a range of the order; its rows are numbered as they are written, so they need not be sorted or joined again.
    sliced = stored(df, "stream-rows").repartitionByRange(order).sortWithinPartitions(order)
    sliced = stored(sliced.select("*", F.spark_partition_id().alias("_slice"), own.alias("_own")), "stream-slices")
    sizes = {r["_slice"]: r["n"] for r in sliced.groupBy("_slice").agg(F.count("*").alias("n")).collect()}
    before = list(itertools.accumulate((sizes.get(k, 0) for k in range(max(sizes, default=-1) + 1)), initial=0))
    n = before[-1]
    parts = max(PARTS, -(-n // PART_ROWS))
    files = max(1, min(spark.sparkContext.defaultParallelism, n // parts))
    number, part, file = F.get(F.lit(before), F.col("_slice")) + F.col("_own"), F.col("_part"), (F.col("_number") % files).cast("int")
    # The rows from n * k // parts on are part k.
    placed = sliced.select(*df.columns, number.alias("_number")).withColumn("_part", F.expr(f"CAST(((_number + 1) * {parts} - 1) div {max(n, 1)} AS INT)"))
    if n >= parts and _keeps_times(spark):
        placed.repartitionById(parts * files, part * files + file).drop("_number").write.partitionBy("_part").parquet(src)
        begin = int(time.time() - parts) * 1000
        for k in range(parts):
            fs, folder = fs_path(spark, f"{src}/_part={k}")
            for status in fs.listStatus(folder):
                fs.setTimes(status.getPath(), begin + 1000 * k, -1)
    else:
        # Files have the time that they are written at, so one part after the other.
        ranges = scratch(spark, "stream-ranges")
        placed.write.partitionBy("_part").parquet(ranges)
        dealt = spark.read.schema(placed.schema).parquet(ranges)
        for k in range(parts):
            dealt.where(part == k).repartitionById(files, file).select(*df.columns).write.parquet(f"{src}/_part={k}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(f"{src}/_part=*")


def _ran(spark, stream, name: str, keys: list[str] | None = None):
    """What a stream gives in append mode, or with keys in update mode, the last row of each key."""
    out = scratch(spark, name)
    if keys is None:
        J.run_once(stream, scratch(spark, f"{name}-checkpoint"), path=out)
        return spark.read.schema(stream.schema).parquet(out)
    J.run_once(stream, scratch(spark, f"{name}-checkpoint"), "update", sink=lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}"))
    rows = spark.read.parquet(out)
    # A key is in a micro-batch's rows once. Column by column, as a struct would be sorted and not hashed.
    return rows.groupBy(*keys).agg(*(F.max_by(c, "batch").alias(c) for c in stream.columns if c not in keys)).select(*stream.columns)


def stream_dedup(spark, d):
    stretched = F.timestamp_seconds(F.lit(1704067200) + (F.unix_seconds("ts") - 1704067200) * 18)
    own = _events(spark, d).select(F.concat_ws(":", "user_id", "event_type").alias("hash"), stretched.alias("created_at"))
    sink = AnchorSink(scratch(spark, "stream-dedup"), DAYS)
    J.run_once(_stream(spark, own, "created_at"), scratch(spark, "stream-dedup-checkpoint"), sink=sink)
    return sink.anchors(spark).groupBy("hash").agg(F.count("*").alias("anchors"))


def stream_daily(spark, d):
    own = _events(spark, d).select(F.col("ts").alias("created_at"), (F.col("event_type") != "error").alias("ok"))
    return _ran(spark, J.daily_counters(_stream(spark, own, "created_at")), "stream-daily", ["day"]).withColumn("day", F.col("day").cast("string"))


def stream_rate(spark, d):
    own = _events(spark, d).select(F.col("ts").alias("created_at"))
    out = _ran(spark, J.trailing_rate(_stream(spark, own, "created_at")), "stream-rate", ["until"])
    return out.select(F.col("until").cast("string"), F.round("per_day", 6).alias("per_day"))


def stream_leaves(spark, d):
    own = _events(spark, d).select("ts", F.concat_ws(" > ", "event_type", "user_id").alias("leaf_path"))
    return _ran(spark, J.leaf_counters(_stream(spark, own, "ts").select("leaf_path")), "stream-leaves", ["leaf_path"])


def stream_route(spark, d):
    """Raw conversations through validation and routing into batches; how many records each bucket got."""
    stream, sink = _stream(spark, rendered(spark, d), "conv_id"), BatchSink(scratch(spark, "route-out"))
    J.run_once(stream, scratch(spark, "route-checkpoint"), sink=routed_batches(sink, DAY, PROMPT, CFG))
    sink.close(spark)
    tag = F.when(F.col("bucket") == "flagged", F.lit("flagged")).otherwise(F.concat(F.lit("batch-"), "day"))
    return sink.records(spark).groupBy("bucket", tag.alias("tag")).agg(F.count("*").alias("n"))


def stream_batches(spark, d):
    """Routed conversations through the sink that carries what fills no batch over to the next micro-batch: the batches' sizes and files."""
    own = S.routed(convs(spark, d).withColumn("flags", V.soft_flags(F.col("turns"), CFG)), DAY)
    own = own.select("bucket", F.lit(DAY).alias("day"), F.col("conv_id").alias("seq"), to_chatml(F.col("turns"), PROMPT).alias("value"))
    sink = BatchSink(scratch(spark, "batches"), 15)
    J.run_once(_stream(spark, own, "seq"), scratch(spark, "batches-checkpoint"), sink=sink)
    sink.close(spark)
    return sink.records(spark).groupBy("bucket", "batch_no").agg(F.count("*").alias("n"), F.count_distinct("file").alias("files"))


def stream_near(spark, d):
    """Documents that one of the newest signatures or openings before them repeats, over several micro-batches."""
    stream = _stream(spark, _keyed(spark, d).select("seq", "signature", "opening"), "seq")
    state, out = scratch(spark, "near-state"), scratch(spark, "near-out")
    J.run_once(stream, scratch(spark, "near-checkpoint"), sink=J.near_duplicate_sink(state, out, RECENT))
    return spark.read.parquet(f"{out}/*").select("seq", "memory")


_ANCHORS = "SELECT hash, anchors FROM (" + _TTL + ")"

QUERIES = {
    "totals_by_tag": (totals_by_tag, f"WITH {LOG} SELECT tag, sum(cnt)::BIGINT AS total, count(*) AS batches FROM lg GROUP BY tag"),
    "day_tag_rollup": (day_tag_rollup, f"WITH {LOG}, g AS (SELECT created_at::DATE AS dy, tag, grouping(created_at::DATE, tag) AS gid, sum(cnt)::BIGINT AS total, count(*) AS batches FROM lg GROUP BY ROLLUP (created_at::DATE, tag)) SELECT dy::VARCHAR AS day, tag, CASE gid WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END::BIGINT AS level, total, batches FROM g"),
    "progress_report": (progress_report, PROGRESS),
    "leaf_progress": (leaf_progress, f"WITH {LEAVES} SELECT * FROM lp"),
    "leaf_completion": (leaf_completion, f"WITH {LEAVES} SELECT count(*) FILTER (generated >= quota) AS leaves_completed, count(*) AS total_leaves FROM lp"),
    "daily_counts": (daily_counts, DAILY),
    "requests_per_key": (requests_per_key, "SELECT 'key_' || substr(sha256(user_id::VARCHAR), 1, 12) AS key_id, ts::DATE::VARCHAR AS day, count(*) AS requests, epoch_us(max(ts)) AS last_used_us FROM events GROUP BY user_id, ts::DATE"),
    "key_states": (key_states, f"WITH {KEYS} SELECT * FROM ks"),
    "key_health": (key_health, f"WITH {KEYS} SELECT state, count(*) AS n, string_agg(idx::VARCHAR, ',' ORDER BY idx) AS ids FROM ks GROUP BY state"),
    "key_lists": (key_lists, f"WITH {KEYS}, n AS (SELECT state, idx, (row_number() OVER (PARTITION BY state ORDER BY idx) - 1) // 50 AS part FROM ks) SELECT state, part, string_agg(idx::VARCHAR, ',' ORDER BY idx) AS ids FROM n GROUP BY ALL"),
    "first_seen": (first_seen, "SELECT key, value FROM (SELECT event_id % 97 AS key, event_id AS value, row_number() OVER (PARTITION BY event_id % 97 ORDER BY ts, event_type, event_id) AS k FROM events) WHERE k = 1"),
    "latest_n": (latest_n, "SELECT event_id AS value FROM events ORDER BY ts DESC, event_id DESC LIMIT 100"),
    "latest_per_kind": (latest_per_kind, f"WITH {RANKED} SELECT kind, value FROM rk WHERE k <= {_CAP}"),
    "trim_oldest": (trim_oldest, f"WITH {RANKED} SELECT kind, count(*) AS n, sum(value)::BIGINT AS ids FROM rk WHERE k > {_CAP} GROUP BY kind"),
    "report_job": (curation_report, f"WITH {LOG}, {LEAVES}, {KEYS} SELECT (SELECT sum(cnt)::BIGINT FROM lg) AS total_all, (SELECT count(*) FROM lg) AS total_batches, (SELECT count(*) FROM lp WHERE generated >= quota) AS leaves_completed, (SELECT count(*) FROM lp) AS total_leaves, count(*) FILTER (state = 'working') AS keys_working, count(*) FILTER (state = 'dead') AS keys_dead, count(*) FILTER (state = 'cooling') AS keys_cooling, count(*) FILTER (state = 'unknown') AS keys_unknown FROM ks"),
    "distinct_sketches": (distinct_sketches, "SELECT strftime(ts, '%Y-%m') AS month, count(*) AS n_rows, count(DISTINCT user_id || ':' || event_type || ':' || floor(value)::BIGINT) AS n_hashes, true AS close FROM events GROUP BY 1"),
    "stream_dedup": (stream_dedup, _ANCHORS),
    "stream_daily": (stream_daily, DAILY),
    "stream_rate": (stream_rate, "WITH w AS (SELECT (ts::DATE + k) AS until FROM events, (SELECT unnest([1, 2, 3]) AS k)) SELECT until::DATE::VARCHAR AS until, round(count(*) / 3, 6) AS per_day FROM w GROUP BY 1"),
    "stream_leaves": (stream_leaves, "SELECT event_type || ' > ' || user_id AS leaf_path, count(*) AS n FROM events GROUP BY ALL"),
    "stream_route": (stream_route, ROUTED),
    "stream_batches": (stream_batches, f"{BATCHES} SELECT bucket, batch_no, count(*) AS n, 1::BIGINT AS files FROM bi GROUP BY ALL"),
    "stream_near": (stream_near, BAND),
}
