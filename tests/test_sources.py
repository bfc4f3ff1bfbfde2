from __future__ import annotations

import json

import pytest

from chatloom.config import Config
from chatloom.operators import validation as V
from chatloom.sources import conversations as S
from chatloom.sources.scratch import clear, scratch, stored


def test_convert_file(spark, tmp_path):
    lines = [json.dumps({"conversation": "user: a\n\nbot: b"}), '{"other": 1}', "[1, 2]", "user: a", "", '{"conversation": "user: é\\n\\nbot: \\"x\\""}']
    (tmp_path / "in.jsonl").write_text("\n".join(lines), encoding="utf-8")
    assert S.convert_file(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "out"), Config(persona="bot"), "be kind") == (2, 3)
    out = sorted(json.loads(r.value)["messages"][1]["content"] for r in spark.read.text(str(tmp_path / "out")).collect())
    assert out == ["a", "é"]


def test_routed_files_hold_a_batch(spark, tmp_path):
    rows = [(i, [("user", "a"), ("assistant", "b")], ["refusal"] if i % 3 == 0 else []) for i in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turns array<struct<role:string,text:string>>, flags array<string>")
    S.write_routed(df, str(tmp_path / "out"), "2024-01-01", "be kind", batch_size=15)
    sizes = {p.parent.name: [] for p in (tmp_path / "out").glob("*/*/*.txt")}
    for p in (tmp_path / "out").glob("*/*/*.txt"):
        sizes[p.parent.name].append(len(p.read_text().splitlines()))
    assert {k: sum(v) for k, v in sizes.items()} == {"tag=flagged": 14, "tag=batch-2024-01-01": 26} and max(map(max, sizes.values())) <= 15


def test_rules_table_has_no_rows_for_missing_kinds(spark):
    out = S.load_rules(spark, {"abuse": ["x", "y"]}, {"abuse": "any", "claims": "assistant"})
    assert [(r.rank, r.pattern) for r in out.collect()] == [(0, "x"), (0, "y")]


def test_rules_of_a_table_hit_in_any_case(spark):
    rules = S.rules_of(S.load_rules(spark, {"human_claim": ["I am Human", "ÉTÉ"], "none": []}, {"none": "any", "human_claim": "assistant"}))
    turns = spark.createDataFrame([(1, 1, "assistant", "well, i AM hUMAN"), (1, 3, "assistant", "cet été"), (1, 0, "user", "i am human"), (1, 5, "assistant", "fine")], "conv_id long, turn long, role string, text string")
    assert sorted((r.turn, r.rank, r.reason) for r in V.scan_rules(turns, Config(rules=rules)).collect()) == [(1, 1, "human_claim"), (3, 1, "human_claim")]
    assert S.rules_of(S.load_rules(spark, {}, {"abuse": "any"})) == ()


def test_ids_are_line_numbers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"part-{k}.txt").write_text("\n".join(f"line {k} {i}" if i % 4 else "" for i in range(20)), encoding="utf-8")
    rows = sorted((r.conv_id, r.text) for r in S.read_conversations(spark, str(tmp_path / "in")).collect())
    assert rows == list(enumerate(f"line {k} {i}" for k in range(3) for i in range(20) if i % 4))


def test_batches_follow_arrival(spark):
    df = spark.createDataFrame([("b", "d", i * 7 % 100) for i in range(100)] + [("f", "d", i) for i in range(3)], "bucket string, day string, seq long")
    out = {(r.bucket, r.seq): (r.batch_no, r.batch_id) for r in S.assign_batches(df, 15).collect()}
    assert out == {("b", i): (i // 15, f"b-d-{i // 15}") for i in range(100)} | {("f", i): (0, "f-d-0") for i in range(3)}


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch(Session(), "x")


def test_scratch_tables_are_cleared(spark):
    df = stored(spark.range(3), "mine")
    assert df.count() == 3 and clear(spark) >= 1 and clear(spark) == 0
    assert scratch(spark, "x").rpartition("/")[2].startswith("x-")


def test_passing_tables_go_and_others_stay(spark):
    from chatloom.sources import scratch as T

    before = stored(spark.range(3), "before")
    end = scratch(spark, "end")
    with T.passing(spark):
        stored(before, "inner").write.parquet(end)
        inner = T._MADE[-1]
    fs, folder = T.fs_path(spark, inner)
    assert "/inner-" in inner and not fs.exists(folder) and inner not in T._MADE and end in T._MADE
    assert spark.read.parquet(end).count() == before.count() == 3
