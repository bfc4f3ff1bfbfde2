"""Readers and writers of conversations: JSON lines, turn tables, rules, chat records, routed batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chatloom.config import Config, Rule
from chatloom.functions.text import strip
from chatloom.operators.ordering import numbered
from chatloom.operators.parsing import parse_turns, to_chatml

TURN_SCHEMA = "conv_id long, turn long, role string, text string"


def record_text(line: Column) -> Column:
    """A JSON object's conversation ('' without one); any other line is the text itself."""
    line = strip(line)
    value = F.try_parse_json(line)
    is_object = line.startswith("{") & value.isNotNull()
    return F.when(is_object, F.coalesce(F.get_json_object(line, "$.conversation"), F.lit(""))).otherwise(line)


def read_conversations(spark: SparkSession, path: str) -> DataFrame:
    """(conv_id, text): one a line that is not blank. conv_id is the line's number, from 0, in the order of paths and lines."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    own = lines.where(strip(F.col("value")) != "")
    return numbered(own, ["file", "start", "at"], "conv_id", lazy=True).select("conv_id", record_text(F.col("value")).alias("text"))


def read_turns(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TURN_SCHEMA).parquet(path)


#: Rows of a rules table that become patterns in the plan; a longer one is no configuration.
MAX_RULES = 10_000


def load_rules(spark: SparkSession, lists: dict[str, list[str]], scopes: dict[str, str]) -> DataFrame:
    """(rank, scope, kind, pattern): pattern lists by kind as a table, ranked in the order of scopes; a missing kind has no rows."""
    rows = [(rank, scope, kind, p) for rank, (kind, scope) in enumerate(scopes.items()) for p in lists.get(kind, [])]
    return spark.createDataFrame(rows, "rank int, scope string, kind string, pattern string")


def rules_of(table: DataFrame) -> tuple[Rule, ...]:
    """One rule a kind of a rules table, for Config: the alternation of its patterns, case-insensitive on the text as it is."""
    rows = table.limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"over {MAX_RULES} rules")
    kinds = sorted({(r.rank, r.scope, r.kind) for r in rows})
    patterns = lambda k: sorted(r.pattern for r in rows if (r.rank, r.scope, r.kind) == k)
    return tuple(Rule(k[0], k[1], "(?iu)" + "|".join(f"(?:{p})" for p in patterns(k)), k[2], raw=True) for k in kinds)


def write_chatml(convs: DataFrame, path: str, system_prompt: str) -> None:
    """A JSON chat record a line for convs(turns)."""
    convs.select(to_chatml(F.col("turns"), system_prompt).alias("value")).write.text(path)


def wrap_legacy(text: Column) -> Column:
    return F.to_json(F.struct(text.alias("conversation")))


def routed(df: DataFrame, day: str) -> DataFrame:
    """df(flags, …) with bucket and tag: flagged under one fixed tag, clean ones under that of the day."""
    flagged = F.size("flags") > 0
    return df.withColumns({
        "bucket": F.when(flagged, F.lit("flagged")).otherwise(F.lit("batch")),
        "tag": F.when(flagged, F.lit("flagged")).otherwise(F.lit(f"batch-{day}")),
    })


def write_routed(df: DataFrame, path: str, day: str, system_prompt: str, batch_size: int = 15, salts: int | None = None) -> None:
    """Chat records by bucket and tag, at most batch_size a file. Each tag's rows are dealt to salts tasks, as many as there are shuffle partitions."""
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = routed(df, day).select("bucket", "tag", to_chatml(F.col("turns"), system_prompt).alias("value"), F.pmod(F.xxhash64("conv_id"), F.lit(salts)).alias("salt"))
    dealt = out.repartition("bucket", "tag", "salt").drop("salt")
    dealt.write.partitionBy("bucket", "tag").option("maxRecordsPerFile", batch_size).text(path)


def assign_batches(df: DataFrame, n: int = 15) -> DataFrame:
    """df(bucket, day, seq, …) with batch_no and batch_id: every n rows of a bucket and day in order of arrival."""
    out = numbered(df, ["seq"], "_number", ["bucket", "day"], lazy=True).withColumn("batch_no", F.floor(F.col("_number") / n).cast("long")).drop("_number")
    return out.withColumn("batch_id", F.concat_ws("-", "bucket", "day", "batch_no"))


def batch_log(batches: DataFrame, created_at: Column) -> DataFrame:
    """(batch_id, tag_prefix, count, created_at) of the rows of assign_batches."""
    return batches.groupBy("batch_id", F.col("bucket").alias("tag_prefix")).agg(F.count("*").alias("count"), F.min(created_at).alias("created_at"))


def convert_file(spark: SparkSession, src: str, dst: str, cfg: Config, system_prompt: str) -> tuple[int, int]:
    """Lines of src to chat records in dst, without validation; counts of lines converted and skipped, taken while writing."""
    parsed = parse_turns(read_conversations(spark, src), cfg.persona)
    seen = Observation()
    good = F.coalesce(F.size("turns") >= 2, F.lit(False))
    counted = parsed.observe(seen, F.count_if(good).alias("ok"), F.count_if(~good).alias("bad"))
    counted.where(good).select(to_chatml(F.col("turns"), system_prompt).alias("value")).write.text(dst)
    return seen.get["ok"], seen.get["bad"]
