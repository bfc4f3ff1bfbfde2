"""Token counts: delta-maintained rollups by source, language and tokenizer version.

A batch is a feed of signed changes: inserts, deletes and revised counts of documents under a tokenizer
version. A commit adds the batch up by key and writes only these sums; a file that names them, renamed into
place, is the commit. A batch id that is already there is not applied again, so a batch may be sent any number
of times. Totals are the sums over the committed batches; compact() replaces many by one. Compactions form a line of
generations, each named after the one it read, so of two that overlap one is refused. What a compaction replaces
is deleted by the one after it: who reads the totals meanwhile still finds their files.

Defined results: null source or lang is a key of its own; a null count is 0; a key whose documents and tokens
have both fallen to 0 has no row; an empty feed commits an empty batch; further columns are ignored.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import fs_path, scratch, stored, table, words

KEYS = ["source", "lang", "tokenizer"]
DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def inserts(docs: DataFrame, tokenizer: str, tokens: Column) -> DataFrame:
    """Feed rows that add docs(source, lang) with their counts."""
    return docs.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(1).alias("sign"), F.coalesce(tokens, F.lit(0)).alias("tokens"))


def deletes(docs: DataFrame, tokenizer: str, tokens: Column) -> DataFrame:
    """Feed rows that take docs away, with the counts they were added or last revised with."""
    return inserts(docs, tokenizer, tokens).withColumn("sign", F.lit(-1))


def revisions(docs: DataFrame, tokenizer: str, old: Column, new: Column) -> DataFrame:
    """Feed rows that replace docs' counts."""
    return deletes(docs, tokenizer, old).unionByName(inserts(docs, tokenizer, new))


class TokenRollup:
    """The totals kept in a folder of the shared file system.

    data/ holds folders of sums, commits/ one small file a batch that names its folder, generations/ one a compaction,
    which names the batches that it stands for too. The rename of such a file into its place is the commit. It is
    refused where the name is taken, as HDFS does it atomically; on a store without atomic renames, let one writer at
    a time commit.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def _listed(self, folder: str) -> dict[str, dict]:
        """The commit files of a folder by name."""
        fs, path = fs_path(self.spark, f"{self.root}/{folder}")
        every = {}
        for status in fs.listStatus(path) if fs.exists(path) else []:
            stream = fs.open(status.getPath())
            try:
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            every[unquote(status.getPath().getName())] = json.loads(text)
        return every

    def _state(self) -> tuple[int, dict[str, dict]]:
        """(generation, the commits in effect by id): the last compaction, if any, and the batches that it doesn't stand for."""
        batches = self._listed("commits")
        line = self._listed("generations")
        if not line:
            return 0, batches
        last = line[max(line)]
        return int(max(line)), {last["id"]: last} | {k: c for k, c in batches.items() if k not in last["replaces"]}

    def committed(self, batch_id: str) -> bool:
        _, now = self._state()
        return batch_id in now or any(batch_id in c["replaces"] for c in now.values())

    def _commit(self, name: str, batch_id: str, sums: DataFrame, replaces: list[str]) -> bool:
        own = f"data/{uuid.uuid4().hex}"
        sums.write.parquet(f"{self.root}/{own}")
        fs, temporary = fs_path(self.spark, f"{self.root}/_temporary/{uuid.uuid4().hex}")
        out = fs.create(temporary, True)
        out.write(json.dumps({"id": batch_id, "data": own, "replaces": replaces}).encode())
        out.close()
        _, end = fs_path(self.spark, f"{self.root}/{name}")
        fs.mkdirs(end.getParent())
        if fs.exists(end) or not fs.rename(temporary, end):
            fs.delete(temporary, True)
            self._delete(own)
            return False
        return True

    def _delete(self, name: str) -> None:
        fs, path = fs_path(self.spark, f"{self.root}/{name}")
        fs.delete(path, True)

    def apply(self, batch_id: str, feed: DataFrame) -> bool:
        """Commits the feed under batch_id; False, with nothing changed, if that batch is there already."""
        if self.committed(batch_id):
            return False
        tokens = F.col("sign") * F.coalesce("tokens", F.lit(0))
        sums = feed.groupBy(*KEYS).agg(F.sum("sign").cast("long").alias("n_docs"), F.sum(tokens).cast("long").alias("n_tokens"))
        return self._commit(f"commits/{quote(batch_id, safe='')}", batch_id, sums, [])

    def totals(self) -> DataFrame:
        return self._totals(self._state()[1])

    def _totals(self, commits: dict[str, dict]) -> DataFrame:
        paths = [f"{self.root}/{c['data']}" for c in commits.values()]
        deltas = self.spark.read.schema(DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], DELTA)
        sums = deltas.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 OR n_tokens <> 0")

    def compact(self, name: str) -> bool:
        """Commits the sum of the batches under a new name that replaces them; their ids stay known. False, with nothing changed, if the name is there or another compaction came first.

        The commit takes all of them out of effect at once, so a crash at any point leaves the totals as they were,
        and what is committed meanwhile stays.
        """
        generation, now = self._state()
        known = sorted({x for k, c in now.items() for x in (k, *c["replaces"])})
        if self.committed(name) or not self._commit(f"generations/{generation + 1:012d}", name, self._totals(now), known):
            return False
        self._clean(generation)
        return True

    def _clean(self, generation: int) -> None:
        """Deletes what had been replaced when that generation was the last."""
        line = self._listed("generations")
        if (name := f"{generation:012d}") not in line:
            return
        for k, c in self._listed("commits").items():
            if k in line[name]["replaces"]:
                self._delete(c["data"])
                self._delete(f"commits/{quote(k, safe='')}")
        for k, c in line.items():
            if int(k) < generation:
                self._delete(c["data"])
                self._delete(f"generations/{k}")


def counted(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, copy_key, words_v1, words_v1_again, parts_v2): counts under the query's tokenizer versions.

    words_v1 counts what white space separates, its revision leaves out what has no letter or digit, and
    parts_v2 counts runs of letters or digits.
    """
    text = F.coalesce("text", F.lit(""))
    own = docs.select("doc_id", "source", "lang", F.md5(text).alias("copy_key"), words(text).alias("words"), text.alias("text"))
    return own.select(
        "doc_id", "source", "lang", "copy_key",
        F.size("words").cast("long").alias("words_v1"),
        F.size(F.filter("words", lambda w: w.rlike(r"[\p{L}\p{N}]"))).cast("long").alias("words_v1_again"),
        F.size(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+"), F.lit(0))).cast("long").alias("parts_v2"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in under two versions, the first is counted anew, copies go (the least doc_id stays), and two batches are sent twice."""
    docs = stored(counted(table(spark, sf_dir, "documents")), "token-counts")
    copies = stored(docs.groupBy("copy_key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1"), "copies")
    extra = docs.join(copies, "copy_key").where(F.col("doc_id") != F.col("first"))
    rollup = TokenRollup(spark, scratch(spark, "token-rollup"))
    first = inserts(docs, "words", F.col("words_v1"))
    again = revisions(docs, "words", F.col("words_v1"), F.col("words_v1_again"))
    gone = deletes(extra, "words", F.col("words_v1_again")).unionByName(deletes(extra, "parts", F.col("parts_v2")))
    rollup.apply("load-words", first)
    rollup.apply("load-parts", inserts(docs, "parts", F.col("parts_v2")))
    rollup.apply("recount-words", again)
    rollup.apply("recount-words", again)
    rollup.apply("drop-copies", gone)
    rollup.apply("load-words", first)
    return rollup.totals()


ORACLE = r"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents),
k AS (SELECT * FROM d WHERE doc_id = (SELECT min(e.doc_id) FROM d e WHERE e.text = d.text)),
c AS (
  SELECT source, lang, 'words' AS tokenizer,
    len([w FOR w IN regexp_split_to_array(text, '[\x20\x09-\x0D]+') IF regexp_matches(w, '[\p{L}\p{N}]')]) AS n FROM k
  UNION ALL SELECT source, lang, 'parts', len(regexp_extract_all(text, '[\p{L}\p{N}]+')) FROM k)
SELECT source, lang, tokenizer, count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_tokens FROM c GROUP BY ALL
"""
