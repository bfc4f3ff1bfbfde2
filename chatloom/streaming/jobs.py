"""Structured Streaming forms of validation, deduplication and counting. Each takes a streaming DataFrame; starting it is the caller's.

Rows later than the watermark are dropped by the stateful jobs, so that their state can expire.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from chatloom.config import Config
from chatloom.operators.ordering import numbered
from chatloom.operators.validation import process
from chatloom.sources.scratch import stored
from chatloom.streaming.near_index import NearIndex


#: State in RocksDB, which holds more keys than an executor's heap; set on the session before a stream with timers starts.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class Memory(StatefulProcessor):
    """A hash's anchor, and a timer that drops it once no sighting can fall into its memory any more."""

    def __init__(self, span: int) -> None:
        self.span = span

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.anchor = handle.getValueState("anchor", "us long")

    def _timer(self, anchor: int) -> int:
        return (anchor + self.span) // 1000 + 1

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        times = np.unique(np.concatenate([b["us"].to_numpy(dtype=np.int64) for b in rows]))
        old = self.anchor.get()[0] if self.anchor.exists() else None
        # From anchor to anchor: each one's next is the first sighting that it doesn't remember.
        kept, at = [], 0 if old is None else int(np.searchsorted(times, old + self.span))
        while at < len(times):
            kept.append(int(times[at]))
            at = int(np.searchsorted(times, kept[-1] + self.span))
        if kept:
            if old is not None:
                self.handle.deleteTimer(self._timer(old))
            self.anchor.update((kept[-1],))
            self.handle.registerTimer(self._timer(kept[-1]))
        yield self._rows(key, kept)

    def _rows(self, key: tuple, kept: list[int]) -> pd.DataFrame:
        return pd.DataFrame({"hash": np.array([key[0]] * len(kept), dtype=object), "us": np.array(kept, dtype=np.int64)}).astype({"hash": object})

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        self.anchor.clear()
        yield self._rows(key, [])

    def close(self) -> None:
        pass


def dedup_with_memory(stream: DataFrame, days: int = 90, late: str = "1 day") -> DataFrame:
    """(hash, created_at): sightings of stream(hash, created_at) that no sighting within days before, counted from its anchor, precedes.

    The state of a hash is its anchor alone, a value in RocksDB, and a timer drops it once the watermark is days past
    it: what comes then is a new anchor anyway. Within a micro-batch sightings are taken by time. Equal sightings are one.
    """
    for k, v in ROCKSDB.items():
        stream.sparkSession.conf.set(k, v)
    own = stream.select("hash", "created_at", F.unix_micros("created_at").alias("us")).where("created_at IS NOT NULL").withWatermark("created_at", late)
    out = own.groupBy("hash").transformWithStateInPandas(Memory(days * 86_400_000_000), "hash string, us long", "Append", "EventTime")
    return out.select("hash", F.timestamp_micros("us").alias("created_at"))


def validate_stream(stream: DataFrame, cfg: Config) -> DataFrame:
    """process() on a stream of (conv_id, text): it works row by row, so it needs no state."""
    return process(stream, cfg)


def near_duplicate_sink(state_path: str, out_path: str, caps: dict[str, int], sig: tuple[int, int] = (9, 10), opn: tuple[int, int] = (19, 20)) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function over (seq, signature, opening), seq growing over the batches: marks the rows that one of the
    newest signatures or openings before them is similar or equal to, caps of each, in this micro-batch or remembered.

    The memories are indexes that only the micro-batch's rows are shuffled to. State and output of a micro-batch are
    named by its number; a repeat replaces them, from the state before.
    """

    kinds = {"signature": sig, "opening": opn}

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = numbered(batch.select("seq", "signature", "opening"), ["seq"], "number", lazy=True)
        own = stored(own, "micro-batch")

        def found(kind: str) -> DataFrame:
            index = NearIndex(spark, f"{state_path}/{kind}", *kinds[kind], caps[kind], blank_equal=kind == "opening")
            return index.step(number, own.select("seq", F.col(kind).alias("value"), "number")).withColumn("memory", F.lit(kind))

        # The two memories know nothing of each other; side by side the many short stages of one fill the cores that the other's leave idle.
        with ThreadPoolExecutor(len(kinds)) as pool:
            near = [x.result() for x in [pool.submit(inheritable_thread_target(spark)(found), kind) for kind in kinds]]
        functools.reduce(DataFrame.unionByName, near).write.mode("overwrite").parquet(f"{out_path}/{number}")

    return step


def daily_counters(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """(day, generated, rejected) of stream(created_at, ok), a tumbling day; rows later than the watermark are dropped, and in append mode a day comes out once it has passed."""
    own = stream.withWatermark("created_at", late).groupBy(F.window("created_at", "1 day"))
    return own.agg(F.count_if("ok").alias("generated"), F.count_if(~F.col("ok")).alias("rejected")).select(F.to_date("window.start").alias("day"), "generated", "rejected")


def trailing_rate(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """(until, per_day): rows a day over windows of three days that move by one."""
    own = stream.withWatermark("created_at", late).groupBy(F.window("created_at", "3 days", "1 day"))
    return own.agg((F.count("*") / 3).alias("per_day")).select(F.to_date("window.end").alias("until"), "per_day")


def leaf_counters(stream: DataFrame) -> DataFrame:
    """(leaf_path, n), for update mode."""
    return stream.groupBy("leaf_path").agg(F.count("*").alias("n"))


#: Shuffle partitions of a micro-batch, and so of a new stream's state, for each core at most.
PER_CORE = 2


def run_once(stream: DataFrame, checkpoint: str, mode: str = "append", sink: Any = None, name: str | None = None, path: str | None = None) -> None:
    """Takes in all that is there and stops; the checkpoint makes a restart go on where it ended.

    A micro-batch is of bounded size, so it is shuffled to as many partitions as the cores work on, even where the session,
    for whole tables, has more: each one is a task, and of stateful streams a store, in every micro-batch.
    """
    spark, key = stream.sparkSession, "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    out = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if sink is not None:
        out = out.foreachBatch(sink)
    elif path is not None:
        out = out.format("parquet").option("path", path)
    else:
        out = out.format("memory").queryName(name)
    # A stream runs in a copy of the session that starting it makes.
    spark.conf.set(key, min(int(before), PER_CORE * spark.sparkContext.defaultParallelism))
    try:
        query = out.start()
    finally:
        spark.conf.set(key, before)
    query.awaitTermination()
