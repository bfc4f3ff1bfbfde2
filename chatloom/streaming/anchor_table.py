"""Hash memory in tables, for streams that bring many hashes a micro-batch.

dedup_with_memory asks the state store for one hash after the other, from Python; here a micro-batch is one grouping.
The anchors that are written are the memory: a hash gets a new one only when the last is forgotten, so the parts
not older than the memory hold about one row a hash, and nothing is written twice. A micro-batch is grouped with
these parts, and older ones aren't opened. A part is named by the micro-batch's number and valid once a
commit names it with the newest sighting so far; a repeated micro-batch replaces its own part, from those before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.sources.scratch import fs_path

ANCHORS = "hash string, us long"
DAY_US = 86_400_000_000


class AnchorSink:
    """A foreachBatch function over (hash, created_at): keeps the sightings that no sighting within days before, counted from its anchor, precedes.

    Within a micro-batch sightings are taken by time; equal ones are one. Those late_days or more before the newest of
    earlier micro-batches are dropped.
    """

    def __init__(self, path: str, days: int = 90, late_days: int = 1) -> None:
        self.path, self.span, self.late = path, days * DAY_US, late_days * DAY_US

    def _commits(self, spark: SparkSession) -> dict[int, int]:
        """The newest sighting up to each micro-batch; both numbers are in the names."""
        fs, folder = fs_path(spark, f"{self.path}/commits")
        names = [status.getPath().getName() for status in fs.listStatus(folder)] if fs.exists(folder) else []
        return dict(sorted(tuple(int(x) for x in name.split("_")) for name in names))

    def _parts(self, spark: SparkSession, numbers: list[int]) -> DataFrame:
        paths = [f"{self.path}/anchors/{k}" for k in numbers]
        return spark.read.schema(ANCHORS).parquet(*paths) if paths else spark.createDataFrame([], ANCHORS)

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done = self._commits(spark)
        before = {k: v for k, v in done.items() if k < number}
        newest = max(before.values(), default=None)
        own = batch.where("created_at IS NOT NULL").select("hash", F.unix_micros("created_at").alias("us"))
        last = max((x for x in (own.agg(F.max("us")).first()[0], newest) if x is not None), default=None)
        if last is None:
            return
        rows = own.select("hash", "us", F.lit(False).alias("known"))
        if newest is not None:
            # What is accepted is later than this by the memory at least, so anchors up to it are forgotten.
            forgotten = newest - self.late - self.span
            remembered = self._parts(spark, [k for k, v in before.items() if v > forgotten]).where(F.col("us") > forgotten)
            rows = rows.where(F.col("us") > newest - self.late).unionByName(remembered.withColumn("known", F.lit(True)))
        each = rows.groupBy("hash").agg(F.max(F.when(F.col("known"), F.col("us"))).alias("anchor"), F.collect_set(F.when(~F.col("known"), F.col("us"))).alias("times"))
        # From anchor to anchor: each one's next is the first sighting that it doesn't remember.
        walk = lambda a, t: F.when(t >= F.coalesce(F.get(a, F.size(a) - 1), F.col("anchor"), t - self.span) + self.span, F.concat(a, F.array(t))).otherwise(a)
        new = F.aggregate(F.array_sort("times"), F.array().cast("array<bigint>"), walk)
        fs, part = fs_path(spark, f"{self.path}/commits/{number}_{last}")
        if number in done:
            fs.delete(fs_path(spark, f"{self.path}/commits/{number}_{done[number]}")[1], False)
        each.where(F.size("times") > 0).select("hash", F.explode(new).alias("us")).write.mode("overwrite").parquet(f"{self.path}/anchors/{number}")
        fs.create(part, True).close()

    def anchors(self, spark: SparkSession) -> DataFrame:
        """(hash, created_at) of all micro-batches."""
        return self._parts(spark, list(self._commits(spark))).select("hash", F.timestamp_micros("us").alias("created_at"))
