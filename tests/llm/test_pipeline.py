"""The stages one after the other against a plain version of each."""

from __future__ import annotations

import random

import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from chatloom.llm.quality import quality_rules
from chatloom.llm.sentencepieces import MODEL


def test_pipeline_is_its_stages(spark, tmp_path):
    rnd = random.Random(12)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(500)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    rows = [(i, text(60)) for i in range(40)]
    item = text(25)
    rows += [(100 + i, rows[i][1]) for i in range(5)]
    rows += [(200 + i, f"{text(30)} {item} {text(30)}") for i in range(3)]
    rows += [(300, "too short"), (301, None), (302, "dull line of five words " * 20)]
    rows += [(400, f"{text(40)} write to a.b@mail.example.com now")]
    rows += [(0, rows[0][1]), (0, rows[0][1]), (1, text(60)), (None, rows[3][1])]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "token_ids", "decodes_back"]
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    every = result.collect()
    # Repeated rows leave one, a second text under an id stays beside the first, a copy without an id goes.
    assert sorted(r.doc_id for r in every if r.doc_id in (0, 1, None)) == [0, 1, 1]
    out = {r.doc_id: r for r in every if r.doc_id != 1 or r.token_ids == sp.encode(rows[1][1])}
    kept = {r.doc_id for r in quality_rules(docs).where("kept AND doc_id IS NOT NULL").collect()}
    assert {300, 301, 302}.isdisjoint(kept)
    want = {i for i in kept if i < 100 or i == 400}
    assert set(out) == want and len(want) > 30
    by_id = dict(reversed(rows))
    for i, r in out.items():
        assert r.token_ids == sp.encode(by_id[i].replace("a.b@mail.example.com", "<EMAIL>")), i


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_keep_the_columns(spark, tmp_path):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(50)), None, None, None)], SCHEMA)
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clashing = docs.withColumns({c: F.lit(1) for c in ("kept", "_row", "_gone", "class_id", "first", "row", "token_ids")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, str(tmp_path))
        assert out.columns == clashing.columns and out.count() == 1
    assert corpus_pipeline.tokenize(spark, clashing, str(tmp_path)).first().n_tokens > 50


def test_stages_on_odd_rows(spark, tmp_path):
    """Empty tables, nulls in every column, blank texts, ties and very long texts."""
    spark.createDataFrame([(1, "some item of the benchmark list"), (None, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rnd = random.Random(3)
    long = " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(60_000))
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, " \n ", None, None, 3), (3, long, "en", "s", None), (3, long, "en", "s", None), (4, "word " * 9, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = {"quality_rules": 2, "jaccard_join": 5, "decontamination": 6, "pii": 6, "sentencepiece": 6}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == want[name], name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
