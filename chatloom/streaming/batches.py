"""A streaming sink that fills batches across micro-batches: every file holds exactly n records but for the last of a bucket and day.

A step takes in a micro-batch. Rows that fill no batch yet are carried to the next step as a table; how many batches a
bucket and day has is carried beside it. A step writes records, rows left over and counts into folders of its own, and
a manifest renamed into commits/ makes them valid, so a step that failed half-way is written anew and one that
is committed is not done again. close() writes what is left over as last, shorter batches; a stream that goes on
afterwards starts new ones.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.config import Config
from chatloom.operators.ordering import numbered
from chatloom.operators.parsing import to_chatml
from chatloom.operators.validation import process
from chatloom.sources.conversations import routed
from chatloom.sources.scratch import fs_path, stored

KEYS = ["bucket", "day"]
ROWS = "bucket string, day string, seq long, value string"
COUNTS = "bucket string, day string, batches long"


class BatchSink:
    """Records of (bucket, day, seq, value) by batches of n in the order of seq within a bucket and day; for foreachBatch."""

    def __init__(self, path: str, n: int = 15) -> None:
        self.path, self.n = path, n

    def _committed(self, spark: SparkSession) -> dict[str, int]:
        """The steps that are committed, in order, and how many batches each has: both are in the names of the manifests."""
        fs, folder = fs_path(spark, f"{self.path}/commits")
        names = [status.getPath().getName() for status in fs.listStatus(folder)] if fs.exists(folder) else []
        return dict(sorted((step, int(n)) for step, _, n in (name.rpartition(".") for name in names)))

    def _commit(self, spark: SparkSession, step: str, batches: int, after: str | None) -> None:
        fs, temporary = fs_path(spark, f"{self.path}/_temporary/{uuid.uuid4().hex}")
        out = fs.create(temporary, True)
        out.write(json.dumps({"step": step, "after": after, "batches": batches}).encode())
        out.close()
        _, end = fs_path(spark, f"{self.path}/commits/{step}.{batches}")
        fs.mkdirs(end.getParent())
        if not fs.rename(temporary, end):
            raise RuntimeError(f"step {step} was committed meanwhile")

    def __call__(self, batch: DataFrame, number: int) -> None:
        self._step(batch.sparkSession, f"{number:020d}", batch.select("bucket", "day", "seq", "value"), False)

    def close(self, spark: SparkSession) -> None:
        """Writes the rows left over; nothing happens if there are none or this has been done."""
        done = list(self._committed(spark))
        if done and not done[-1].endswith("-closed"):
            self._step(spark, f"{done[-1]}-closed", spark.createDataFrame([], ROWS), True)

    def _step(self, spark: SparkSession, step: str, new: DataFrame, last: bool) -> None:
        done = self._committed(spark)
        if step in done:
            return
        before = max((s for s in done if s < step), default=None)
        read = lambda what, schema: spark.read.schema(schema).parquet(f"{self.path}/{what}/{before}") if before else spark.createDataFrame([], schema)
        rows = stored(new.unionByName(read("left", ROWS)), "step")
        placed = numbered(rows, ["seq"], "_at", KEYS).withColumn("_batch", F.floor(F.col("_at") / self.n))
        placed = stored(placed, "placed")
        # Of a bucket and day all batches but the last are full, so sizes are by batch and no key is hot.
        sizes = stored(placed.groupBy(*KEYS, "_batch").agg(F.count("*").alias("_size")), "sizes")
        whole = sizes.where(F.lit(last) | (F.col("_size") == self.n)).select(*KEYS, "_batch")
        counts = stored(read("counts", COUNTS), "counts")
        new_counts = whole.groupBy(*KEYS).agg(F.count("*").alias("batches"))
        counts.unionByName(new_counts).groupBy(*KEYS).agg(F.sum("batches").alias("batches")).write.mode("overwrite").parquet(f"{self.path}/counts/{step}")
        full = placed.join(whole, [*KEYS, "_batch"]).join(counts, KEYS, "left")
        full = full.withColumn("batch_no", F.col("_batch") + F.coalesce("batches", F.lit(0)))
        out = full.select(*KEYS, "batch_no", "value", "seq").repartition(*KEYS, "batch_no").sortWithinPartitions(*KEYS, "batch_no", "seq").drop("seq")
        out.write.mode("overwrite").partitionBy(*KEYS, "batch_no").text(f"{self.path}/records/step={step}")
        placed.join(whole, [*KEYS, "_batch"], "left_anti").select("bucket", "day", "seq", "value").write.mode("overwrite").parquet(f"{self.path}/left/{step}")
        self._commit(spark, step, whole.count(), before)

    def records(self, spark: SparkSession) -> DataFrame:
        """(bucket, day, batch_no, value, file) of the committed batches."""
        schema, steps = "value string, step string, bucket string, day string, batch_no long", [step for step, n in self._committed(spark).items() if n]
        columns = ["bucket", "day", "batch_no", "value", F.col("_metadata.file_path").alias("file")]
        if not steps:
            return spark.createDataFrame([], "bucket string, day string, batch_no long, value string, file string")
        paths = [f"{self.path}/records/step={step}" for step in steps]
        return spark.read.schema(schema).option("basePath", f"{self.path}/records").text(paths).select(*columns)

    def log(self, spark: SparkSession) -> DataFrame:
        """(batch_id, tag_prefix, count): the batch log of what is written."""
        own = self.records(spark).groupBy("bucket", "day", "batch_no").agg(F.count("*").alias("count"))
        return own.select(F.concat_ws("-", "bucket", "day", "batch_no").alias("batch_id"), F.col("bucket").alias("tag_prefix"), "count")


def routed_batches(sink: BatchSink, day: str, system_prompt: str, cfg: Config) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function over (conv_id, text): what passes validation goes into the sink's batches as chat records, by route."""

    def write(batch: DataFrame, number: int) -> None:
        own = routed(process(batch, cfg).where("ok"), day)
        sink(own.select("bucket", F.lit(day).alias("day"), F.col("conv_id").alias("seq"), to_chatml(F.col("turns"), system_prompt).alias("value")), number)

    return write
