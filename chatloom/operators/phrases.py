"""Scans for tables of literal phrases, however many: one pass over the texts for every PASS_BYTES of phrases.

Phrases are looked up by their first bytes: a bit table over hashes of these tells the places of a text where any
phrase may begin, for all phrases at once. From there it is as in a trie whose levels are the phrases' lengths: the
places that are left are compared by hashes of the text's next bytes with the phrases of each length, and the finds
byte by byte. Alternations of patterns, which grow with the table, are for rules that are no literals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.operators.ordering import running_total
from chatloom.sources.scratch import stored

#: Bytes of phrases that a pass hands to every task; a longer phrase is a pass of its own.
PASS_BYTES = 16 << 20
#: Bytes that a phrase is first looked up by, shorter phrases by fewer; and bits of the table of their hashes.
HEAD, TABLE_BITS = 4, 20
#: Bytes of text worked on at once.
CHUNK_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(_BASE)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _heads(data: np.ndarray, size: int) -> np.ndarray:
    """The number that the size bytes from each byte on are, for all bytes that so many follow."""
    n = max(len(data) - size + 1, 0)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out |= data[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    return out


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Spans:
    """Hashes of spans of bytes, from sums of powers of a number that has an inverse."""

    def __init__(self, data: np.ndarray) -> None:
        terms = (data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data))
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(terms, dtype=np.uint64)])
        self.down = _powers(pow(_BASE, -1, 1 << 64), len(data) + 1)

    def of(self, starts: np.ndarray, size: int) -> np.ndarray:
        return (self.sums[starts + size] - self.sums[starts]) * self.down[starts]


class Phrases:
    """Phrases, by number: a table of their first bytes, for these the lengths that phrases have, and by length their hashes."""

    def __init__(self, phrases: list[str]) -> None:
        self.raw = [p.encode() for p in phrases]
        by_size: dict[int, list[int]] = {}
        for k, own in enumerate(self.raw):
            if own:
                by_size.setdefault(len(own), []).append(k)
        self.levels = []
        for head in sorted({min(n, HEAD) for n in by_size}):
            sizes = sorted(n for n in by_size if min(n, HEAD) == head)
            firsts = [_heads(np.frombuffer(b"".join(self.raw[k][:head] for k in by_size[n]), dtype=np.uint8), head)[::head] for n in sizes]
            heads = np.unique(np.concatenate(firsts))
            table = np.zeros(1 << TABLE_BITS, dtype=bool)
            table[_slot(heads)] = True
            begins = np.zeros((len(heads), len(sizes)), dtype=bool)
            of_size = []
            for j, n in enumerate(sizes):
                begins[np.searchsorted(heads, firsts[j]), j] = True
                every = np.frombuffer(b"".join(self.raw[k] for k in by_size[n]), dtype=np.uint8)
                hashes = Spans(every).of(np.arange(len(by_size[n])) * n, n)
                order = np.argsort(hashes, kind="stable")
                of_size.append((n, hashes[order], np.array(by_size[n])[order]))
            self.levels.append((head, table, heads, begins, of_size))

    def find(self, data: np.ndarray, row_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, phrase), distinct, of what stands in the bytes of several rows; a phrase lies within one row."""
        rows, found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        text, spans = data.tobytes(), Spans(data)
        for head, table, heads, begins, of_size in self.levels:
            here = _heads(data, head)
            places = np.flatnonzero(table[_slot(here)])
            which = np.minimum(np.searchsorted(heads, here[places]), len(heads) - 1)
            same = heads[which] == here[places]
            places, which = places[same], which[same]
            for j, (n, hashes, phrases) in enumerate(of_size):
                at = places[begins[which, j]]
                at = at[at + n <= len(data)]
                at = at[row_of[at] == row_of[at + n - 1]]
                own = spans.of(at, n)
                k = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                hit = np.flatnonzero(hashes[k] == own)
                hit = hit[[text[p : p + n] == self.raw[x] for p, x in zip(at[hit].tolist(), phrases[k[hit]].tolist(), strict=True)]] if len(hit) else hit
                rows.append(row_of[at[hit]])
                found.append(phrases[k[hit]])
        pairs = np.unique(np.stack([np.concatenate(rows), np.concatenate(found)]), axis=1)
        return pairs[0], pairs[1]


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batch of about CHUNK_BYTES of text, with the bytes and the row of each byte; a longer text is one alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + CHUNK_BYTES, "right")))
        part = batch.slice(start, stop - start)
        data = b"".join(x.encode() for x in part.column("text").to_pylist() if x)
        yield part, np.frombuffer(data, dtype=np.uint8), np.repeat(np.arange(stop - start), sizes[start:stop])
        start = stop


def _scan(batches: Iterator[pa.RecordBatch], phrases: Phrases, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, row_of in _chunks(batch):
            rows, found = phrases.find(data, row_of)
            yield pa.RecordBatch.from_arrays([part.column("row").take(pa.array(rows)), pa.array(ids[found])], ["row", "phrase_id"])


def find_phrases(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    """(row, phrase_id), distinct: phrases(phrase_id, phrase) that stand anywhere in texts(row, text), both as they are.

    Null and empty phrases and texts have no finds; equal phrases are found each.
    """
    text = F.col("phrase")
    distinct = phrases.where(F.length(text) > 0).select(text.alias("phrase")).distinct()
    placed = running_total(distinct, ["phrase"], F.octet_length(text), "before", lazy=True)
    placed = stored(placed.withColumn("pass", F.floor(F.col("before") / PASS_BYTES)).withColumn("no", F.monotonically_increasing_id()), "phrases")
    spark, found = texts.sparkSession, None
    for n in range((placed.agg(F.max("pass")).first()[0] or 0) + 1):
        own = placed.where(F.col("pass") == n).select("no", "phrase").toArrow()
        shared = spark.sparkContext.broadcast((Phrases(own.column("phrase").to_pylist()), own.column("no").to_numpy()))
        hits = texts.select("row", "text").mapInArrow(lambda b, shared=shared: _scan(b, *shared.value), "row long, phrase_id long")
        found = hits if found is None else found.unionByName(hits)
    named = placed.select("phrase", F.col("no").alias("phrase_id")).join(phrases.select(F.col("phrase_id").alias("id"), "phrase"), "phrase").select("phrase_id", "id")
    return found.join(named, "phrase_id").select("row", F.col("id").alias("phrase_id"))


def scan_phrases(turns: DataFrame, table: DataFrame) -> DataFrame:
    """(conv_id, turn, rank, reason): as scan_rules, for literal phrases of table(rank, scope, kind, pattern) in the lower-cased text of turns(conv_id, turn, role, text)."""
    rules = stored(table.select("rank", "scope", "kind", F.lower("pattern").alias("phrase")).distinct().withColumn("phrase_id", F.monotonically_increasing_id()), "phrase-rules")
    own = stored(turns.select("conv_id", "turn", "role", F.lower("text").alias("text")).withColumn("row", F.monotonically_increasing_id()), "turns")
    hits = find_phrases(own, rules).join(rules.drop("phrase"), "phrase_id")
    on = (F.col("scope") == "any") | (F.col("role") == "assistant")
    out = hits.join(own.drop("text"), "row").where(on)
    return out.select("conv_id", "turn", "rank", F.col("kind").alias("reason")).distinct()


def topic_bias(topics: DataFrame, keywords: DataFrame) -> DataFrame:
    """(id, bias) of topics(id, name, definition): heavy if a heavy keyword of keywords(kind, word) stands in them, else fun if a fun one does, else null; for lists of any length."""
    text = F.lower(F.concat_ws(" ", "name", "definition"))
    own = stored(topics.select("id", text.alias("text")).withColumn("row", F.monotonically_increasing_id()), "topics")
    words = stored(keywords.where(F.col("kind").isin("heavy", "fun")).select("kind", F.lower("word").alias("phrase")).distinct().withColumn("phrase_id", F.monotonically_increasing_id()), "keywords")
    heavy = F.max(F.col("kind") == "heavy")
    found = find_phrases(own, words).join(words.drop("phrase"), "phrase_id").groupBy("row").agg(F.when(heavy, F.lit("heavy")).otherwise(F.lit("fun")).alias("bias"))
    return own.join(found, "row", "left").select("id", "bias")
