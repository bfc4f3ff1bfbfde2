"""Streams over several files, restarts, late rows and expiring state, held to the batch forms."""

from __future__ import annotations

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from chatloom.config import Config
from chatloom.operators import dedup as D
from chatloom.queries import reports as Q
from chatloom.sources import conversations as S
from chatloom.streaming import jobs as J
from chatloom.streaming import near_index as N
from chatloom.streaming.anchor_table import AnchorSink
from chatloom.streaming.batches import BatchSink, routed_batches

T0 = dt.datetime(2024, 1, 1)


def feed(spark, tmp_path, schema):
    """A folder that files are added to one after the other, and a function that opens it as a stream, a file a micro-batch."""
    src = str(tmp_path / "in")
    add = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    return add, lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)


def test_memory_outlives_restarts_and_expires(spark, tmp_path):
    rnd = random.Random(2)
    rows = sorted((T0 + dt.timedelta(hours=rnd.randrange(24 * 400)), f"h{rnd.randrange(6)}") for _ in range(300))
    add, stream = feed(spark, tmp_path, "created_at timestamp, hash string")
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for k in range(4):
        add(rows[75 * k : 75 * k + 75])
        if k % 2:
            # A new query on the same checkpoint goes on where the last one ended.
            J.run_once(J.dedup_with_memory(stream(), 30), check, path=out)
    got = sorted((r.created_at, r.hash) for r in spark.read.parquet(out).collect())
    batch = D.ttl_anchor(spark.createDataFrame(rows, "created_at timestamp, hash string"), 30).where("NOT duplicate")
    assert got == sorted((r.created_at, r.hash) for r in batch.collect())


def test_state_is_dropped_after_the_memory(spark, tmp_path):
    """Over restarts the state table loses the keys that are past the memory, as its reader shows."""
    add, stream = feed(spark, tmp_path, "created_at timestamp, hash string")
    check = str(tmp_path / "check")
    held = []
    for days in ((0, 1), (40,), (80, 81), (82,)):
        add([(T0 + dt.timedelta(days=d), f"h{d}") for d in days])
        J.run_once(J.dedup_with_memory(stream(), 30), check, path=str(tmp_path / "out"))
        state = spark.read.format("statestore").option("stateVarName", "anchor").load(check)
        held.append({r.key.hash for r in state.select("key").collect()})
    assert held[0] == {"h0", "h1"} and held[-1] == {"h80", "h81", "h82"}
    assert {r.hash for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {f"h{d}" for d in (0, 1, 40, 80, 81, 82)}


def test_late_rows_are_dropped_and_days_come_out_once(spark, tmp_path):
    add, stream = feed(spark, tmp_path, "created_at timestamp, ok boolean")
    day = lambda n, h=1: T0 + dt.timedelta(days=n, hours=h)
    add([(day(0), True), (day(0), False), (day(1), True)])
    add([(day(5), True)])
    add([(day(5, 2), True)])
    add([(day(0, 2), True), (day(4, 12), False)])
    add([(day(9), True)])
    out = str(tmp_path / "out")
    J.run_once(J.daily_counters(stream()), str(tmp_path / "check"), path=out)
    got = {(r.day.isoformat(), r.generated, r.rejected) for r in spark.read.parquet(out).collect()}
    # The fourth file's first row is older than the watermark; the last day is still open.
    assert got == {("2024-01-01", 1, 1), ("2024-01-02", 1, 0), ("2024-01-05", 0, 1), ("2024-01-06", 2, 0)}


def rows_of(n, seed):
    rnd = random.Random(seed)
    base = [" ".join(f"w{rnd.randrange(200)}" for _ in range(30)) for _ in range(8)]
    change = lambda t: " ".join(w if rnd.random() > 0.02 else "x" for w in t.split())
    return [(i, change(rnd.choice(base)), rnd.choice(["", "hello there", change(base[0])])) for i in range(n)]


@pytest.mark.parametrize("caps", [{"signature": 20, "opening": 3}, {"signature": 5000, "opening": 500}])
def test_near_duplicates_over_batches_are_the_band_of_the_whole(spark, tmp_path, caps):
    rows = rows_of(90, 4)
    schema = "seq long, signature string, opening string"
    add, stream = feed(spark, tmp_path, schema)
    sink = J.near_duplicate_sink(str(tmp_path / "state"), str(tmp_path / "out"), caps)
    for k in range(3):
        add(rows[30 * k : 30 * k + 30])
        if k:
            J.run_once(stream(), str(tmp_path / "check"), sink=sink)
    got = {(r.seq, r.memory) for r in spark.read.parquet(str(tmp_path / "out") + "/*").collect()}
    df = spark.createDataFrame(rows, schema)
    want = {(r.seq, "signature") for r in D.similar_within(df, "signature", 9, 10, caps["signature"]).collect()}
    want |= {(r.seq, "opening") for r in D.similar_within(df, "opening", 19, 20, caps["opening"], blank_equal=True).collect()}
    assert got == want and {m for _, m in got} == {"signature", "opening"}


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    df = spark.createDataFrame(rows_of(20, 5), "seq long, signature string, opening string")
    sink = J.near_duplicate_sink(str(tmp_path / "state"), str(tmp_path / "out"), {"signature": 50, "opening": 50})
    seen = lambda: sorted((r.seq, r.memory) for r in spark.read.parquet(str(tmp_path / "out") + "/*").collect())
    sink(df.where("seq < 10"), 0)
    # A number may be left out: the state before it is the last there is.
    sink(df.where("seq >= 10"), 2)
    first = seen()
    sink(df.where("seq >= 10"), 2)
    assert seen() == first and first


RECORDS = "bucket string, day string, seq long, value string"


def records(n, start=0):
    return [("flagged" if i % 5 == 0 else "batch", f"2024-01-0{1 + i % 2}", i, f"r{i}") for i in range(start, start + n)]


def test_batches_are_filled_across_micro_batches(spark, tmp_path):
    add, stream = feed(spark, tmp_path, RECORDS)
    sink = BatchSink(str(tmp_path / "out"), 7)
    sizes = (23, 3, 40, 11)
    for k, n in enumerate(sizes):
        add(records(n, sum(sizes[:k])))
        J.run_once(stream(), str(tmp_path / "check"), sink=sink)
        # Until the end all files are full.
        assert {r.n for r in sink.records(spark).groupBy("file").agg(F.count("*").alias("n")).collect()} == {7}
    sink.close(spark)
    sink.close(spark)
    got = {(r.bucket, r.day, r.batch_no): sorted(r.values) for r in sink.records(spark).groupBy("bucket", "day", "batch_no").agg(F.collect_list("value").alias("values")).collect()}
    whole = S.assign_batches(spark.createDataFrame(records(sum(sizes)), RECORDS), 7)
    want = {(r.bucket, r.day, r.batch_no): sorted(r.values) for r in whole.groupBy("bucket", "day", "batch_no").agg(F.collect_list("value").alias("values")).collect()}
    assert got == want
    log = {(r.batch_id, r.tag_prefix, r["count"]) for r in sink.log(spark).collect()}
    assert log == {(r.batch_id, r.tag_prefix, r["count"]) for r in S.batch_log(whole, F.lit(None).cast("timestamp")).collect()}
    # What comes after the end starts batches of its own.
    sink(spark.createDataFrame([("batch", "2024-01-01", 900 + i, "x") for i in range(8)], RECORDS), 9)
    assert sink.records(spark).where("value = 'x'").select("batch_no").distinct().count() == 1


def test_a_step_that_failed_is_written_anew_and_a_done_one_is_not(spark, tmp_path, monkeypatch):
    sink = BatchSink(str(tmp_path / "out"), 4)
    rows = lambda a, b: spark.createDataFrame(records(b - a, a), RECORDS)
    values = lambda: sorted(r.value for r in sink.records(spark).collect())
    sink(rows(0, 30), 0)
    first = values()
    monkeypatch.setattr(BatchSink, "_commit", lambda *x: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        sink(rows(30, 50), 1)
    monkeypatch.undo()
    assert values() == first
    sink(rows(30, 50), 1)
    second = values()
    sink(rows(30, 50), 1)
    sink(rows(0, 30), 0)
    assert values() == second and len(second) == len(set(second)) > len(first)
    sink.close(spark)
    assert values() == sorted(f"r{i}" for i in range(50))


def test_an_empty_stream_has_no_batches(spark, tmp_path):
    sink = BatchSink(str(tmp_path / "out"))
    sink.close(spark)
    sink(spark.createDataFrame([], RECORDS), 0)
    sink.close(spark)
    assert sink.records(spark).count() == 0 and sink.log(spark).count() == 0


def test_routing_into_batches(spark, tmp_path):
    text = "\n\n".join(f"{'user' if i % 2 == 0 else 'Bot'}: One. Two. Three." for i in range(8))
    add, stream = feed(spark, tmp_path, "conv_id long, text string")
    for k in range(3):
        add([(10 * k + i, text if i else "nothing") for i in range(3)])
    sink = BatchSink(str(tmp_path / "out"), 4)
    J.run_once(stream(), str(tmp_path / "check"), sink=routed_batches(sink, "2024-01-01", "be kind", Config(persona="Bot")))
    sink.close(spark)
    assert sorted((r.batch_id, r["count"]) for r in sink.log(spark).collect()) == [("batch-2024-01-01-0", 4), ("batch-2024-01-01-1", 2)]


def near_by(df, cap, blank=False):
    return {r.seq for r in D.similar_within(df.select("seq", F.col("value").alias("signature")), "signature", 9, 10, cap, blank).collect()}


@pytest.mark.parametrize(("cap", "blank", "rebuild"), [(25, False, 3), (7, True, 50)])
def test_the_index_finds_what_the_band_of_the_whole_does(spark, tmp_path, monkeypatch, cap, blank, rebuild):
    monkeypatch.setattr(N, "REBUILD", rebuild)
    rows = [(i, s if i % 9 else rnd_blank) for (i, s, _), rnd_blank in zip(rows_of(109, 7), itertools.cycle(["", " ", "solo"]))]
    index = N.NearIndex(spark, str(tmp_path / "index"), 9, 10, cap, blank, buckets=3)
    got, at = set(), 0
    for k, n in enumerate((30, 44, 0, 35)):
        part = spark.createDataFrame(rows[at : at + n], "seq long, value string")
        found = {r.seq for r in index.step(2 * k, part).collect()}
        # The same again, and in another session that doesn't know the tables.
        if k == 1:
            assert {r.seq for r in N.NearIndex(spark.newSession(), str(tmp_path / "index"), 9, 10, cap, blank).step(2 * k, spark.createDataFrame(rows[at : at + n], "seq long, value string")).collect()} == found
        got |= found
        at += n
    assert got == near_by(spark.createDataFrame(rows, "seq long, value string"), cap, blank) and len(got) > 10
    assert len(index._manifest(99)["parts"]) <= rebuild + 1


def shuffled(spark, action):
    """Records written to shuffles by what action runs."""
    gateway, store = spark.sparkContext._gateway, spark.sparkContext._jsc.sc().statusStore()
    stages = lambda: {s.stageId(): s.shuffleWriteRecords() for s in _all(store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList()))}
    before = stages()
    action()
    return sum(n for k, n in stages().items() if k not in before)


def _all(seq):
    return [seq.apply(i) for i in range(seq.size())]


def test_what_a_micro_batch_shuffles_does_not_follow_the_memory(spark, tmp_path):
    monkey = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in monkey}
    for k, v in monkey.items():
        spark.conf.set(k, v)
    try:
        seen = []
        for size in (300, 3000):
            rnd = random.Random(size)
            text = lambda: " ".join(f"w{rnd.randrange(5000)}" for _ in range(20))  # noqa: E731, B023
            df = lambda a, b: spark.createDataFrame([(i, text()) for i in range(a, b)], "seq long, value string")  # noqa: E731, B023
            index = N.NearIndex(spark, str(tmp_path / f"index-{size}"), 9, 10, 10 * size, buckets=2)
            index.step(0, df(0, size))
            new = df(size, size + 50)
            seen.append(shuffled(spark, lambda index=index, new=new: index.step(1, new).count()))
        assert 0 < seen[1] < 1.2 * seen[0] + 500, seen
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("days", [3, 30])
def test_the_anchor_table_gives_the_anchors_of_the_whole(spark, tmp_path, days):
    """Over restarts and a repeated micro-batch; equal and null hashes, and sightings at the memory's very end."""
    rnd = random.Random(3)
    rows = [(T0 + dt.timedelta(hours=6 * rnd.randrange(4 * 400)), rnd.choice(["a", "b", "c", "d", None])) for _ in range(300)]
    rows = sorted(rows + [(T0, "e"), (T0 + dt.timedelta(days=days), "e"), (T0 + dt.timedelta(days=days), "e")], key=lambda r: r[0])
    schema = "created_at timestamp, hash string"
    add, stream = feed(spark, tmp_path, schema)
    sink = AnchorSink(str(tmp_path / "out"), days)
    for k in range(5):
        add(rows[61 * k : 61 * k + 61])
        if k % 2 == 0:
            J.run_once(stream(), str(tmp_path / "check"), sink=sink)
    again = spark.createDataFrame(rows[61 * 4 :], schema)
    sink(again, 4)
    got = sorted((r.created_at, str(r.hash)) for r in AnchorSink(str(tmp_path / "out"), days).anchors(spark).collect())
    batch = D.ttl_anchor(spark.createDataFrame(rows, schema), days).where("NOT duplicate")
    assert got == sorted((r.created_at, str(r.hash)) for r in batch.collect())


def test_the_anchor_table_drops_late_rows_and_opens_only_parts_within_the_memory(spark, tmp_path, monkeypatch):
    opened, own = [], AnchorSink._parts
    sink = AnchorSink(str(tmp_path / "out"), 30)
    step = lambda days, n: sink(spark.createDataFrame([(T0 + dt.timedelta(days=d), h) for d, h in days], "created_at timestamp, hash string"), n)
    monkeypatch.setattr(AnchorSink, "_parts", lambda self, spark, numbers: opened.append(numbers) or own(self, spark, numbers))
    step([(0, "a"), (1, "b")], 0)
    step([(29, "a"), (32, "c")], 1)
    step([(30, "late"), (31.5, "in time"), (50, "a")], 3)
    step([(90, "c")], 4)
    step([], 5)
    # Part 0 ends 31 days before the newest sighting, the memory and the day that rows may be late.
    assert opened == [[0], [1], [1, 3], [4]]
    monkeypatch.undo()
    got = sorted(((r.created_at - T0).total_seconds() / 86_400, r.hash) for r in sink.anchors(spark).collect())
    assert got == [(0, "a"), (1, "b"), (31.5, "in time"), (32, "c"), (50, "a"), (90, "c")]


@pytest.mark.parametrize(("n", "size"), [(103, 20), (3, 20), (0, 20)])
def test_a_streamed_table_comes_in_order_and_is_written_by_many_tasks(spark, tmp_path, monkeypatch, n, size):
    monkeypatch.setattr(Q, "PART_ROWS", size)
    got, files = {}, {}

    def sink(batch, number):
        got[number] = sorted(r.i for r in batch.select("i").collect())
        files[number] = batch.select("i", F.input_file_name().alias("f")).select("f").distinct().count()

    J.run_once(Q._stream(spark, spark.range(n).select((n - 1 - F.col("id")).alias("i")), "i"), str(tmp_path / "check"), sink=sink)
    parts = max(4, -(-n // size))
    want = [list(range(n * k // parts, n * (k + 1) // parts)) for k in range(parts)]
    assert [x for _, x in sorted(got.items())] == want
    # One file a micro-batch made every step on it a single task.
    assert n < 100 or min(files.values()) == 8


def test_what_the_band_shuffles_grows_with_the_rows(spark, monkeypatch):
    """A key in many blocks is dealt by the sets that can meet in one, not by those of the whole table."""
    monkeypatch.setattr(D, "HEAVY", 20)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen = []
        for n in (400, 1600):
            df = spark.range(n).select(F.col("id").alias("seq"), F.concat(F.lit("a b c d e f g h i j w"), "id").alias("signature"))
            seen.append(shuffled(spark, lambda df=df: D.similar_within(df, "signature", 9, 10, 40).count()))
        assert seen[1] < 6 * seen[0], seen
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_words_are_put_in_order_without_a_shuffle(spark, tmp_path):
    """A micro-batch shuffles its strings and their keys, not each of their words twice."""
    rnd = random.Random(1)
    text = lambda: " ".join(f"w{rnd.randrange(100_000)}" for _ in range(130))
    df = lambda a, b: spark.createDataFrame([(i, text()) for i in range(a, b)], "seq long, value string")
    index = N.NearIndex(spark, str(tmp_path / "index"), 9, 10, 5000, buckets=2)
    index.step(0, df(0, 20))
    new = df(20, 120)
    assert shuffled(spark, lambda: index.step(1, new).count()) < 100 * 130


def test_a_new_row_is_compared_with_what_it_can_reach_alone(spark, tmp_path):
    """Of a long part before, only the strings of the newest rows take part in the joins."""
    df = lambda a, b: spark.createDataFrame([(i, f"a b c d e f g h i j w{i}") for i in range(a, b)], "seq long, value string")
    index, met, own = N.NearIndex(spark, str(tmp_path / "index"), 4, 5, 10, buckets=2), [], N.NearIndex.candidates
    index.candidates = lambda *x: met.append(own(index, *x)) or met[-1]
    index.step(0, df(0, 19))
    # Row 19's block and the one before begin with row 0, its memory with row 9.
    assert index.step(1, df(19, 21)).count() == 2
    assert {r.y for r in met[1].select("y").collect()} == set(range(9, 20))


def test_a_stream_has_partitions_by_the_cores(spark, tmp_path):
    """Also where the session has more for its large tables; the session's own number stays."""
    key = "spark.sql.shuffle.partitions"
    before, seen = spark.conf.get(key), []
    spark.conf.set(key, "64")
    try:
        add, stream = feed(spark, tmp_path, "leaf_path string")
        add([("a",), ("b",)])
        check = str(tmp_path / "check")
        J.run_once(J.leaf_counters(stream()), check, "update", sink=lambda batch, n: seen.append((batch.sparkSession.conf.get(key), batch.count())))
        stores = spark.read.format("state-metadata").load(check).select("numPartitions").collect()
        assert spark.conf.get(key) == "64"
        assert seen == [("16", 2)] and [r.numPartitions for r in stores] == [16]
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("keeps", [True, False])
def test_a_streamed_table_comes_in_order_wherever_it_is_written(spark, tmp_path, monkeypatch, keeps):
    """Also with equal values at the borders, and where files can't be given a time."""
    monkeypatch.setattr(Q, "_keeps_times", lambda spark: keeps)
    monkeypatch.setattr(Q, "PART_ROWS", 50)
    got = {}
    df = spark.range(300).select((F.col("id") * 7 % 300 / 3).cast("int").alias("i"), "id")
    stream = Q._stream(spark, df, "i")
    assert stream.columns == ["i", "id"]
    J.run_once(stream, str(tmp_path / "check"), sink=lambda batch, n: got.update({n: [tuple(r) for r in batch.collect()]}))
    assert [sorted(i for i, _ in x) for _, x in sorted(got.items())] == [[i // 3 for i in range(k, k + 50)] for k in range(0, 300, 50)]
    assert sorted(j for x in got.values() for _, j in x) == list(range(300))


def test_a_streamed_table_takes_as_many_jobs_for_any_number_of_micro_batches(spark, monkeypatch):
    """Each micro-batch's rows were shuffled and written by jobs of their own."""
    df, jobs = spark.range(240).withColumnRenamed("id", "i"), []
    for size in (60, 20):
        monkeypatch.setattr(Q, "PART_ROWS", size)
        spark.sparkContext.setJobGroup(f"parts of {size}", "")
        Q._stream(spark, df, "i")
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"parts of {size}")))
    spark.sparkContext.setJobGroup("rest", "")
    assert jobs[0] == jobs[1] > 0


def test_the_last_row_of_a_key_is_found_without_a_sort(spark, monkeypatch):
    """A struct of the columns was sorted by key; nulls of the last row stay."""
    monkeypatch.setattr(Q, "PART_ROWS", 25)
    df = spark.range(100).select("id", (F.col("id") % 7).alias("k"), F.when(F.col("id") < 95, F.col("id")).alias("v"))
    counts = Q._stream(spark, df, "id").groupBy("k").agg(F.count("*").alias("n"), F.max_by("v", "id").alias("v"))
    out = Q._ran(spark, counts, "last", ["k"])
    last = {k: max(i for i in range(100) if i % 7 == k) for k in range(7)}
    assert sorted(tuple(r) for r in out.collect()) == [(k, len(range(k, 100, 7)), i if i < 95 else None) for k, i in last.items()]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
