"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents and unlabelled documents train a linear numpy classifier on the words a text holds and
on their beginnings.
The risk of the positives' share is taken out of the unlabelled risk by the class prior, and where the rest
turns negative (overfitting) the step goes the other way. The prior is the share of toxic documents among
the labelled ones that may be learned from. Training uses at most about SAMPLE positives and SAMPLE
unlabelled documents, by the hash of doc_id; scoring covers every whole text.

Defined results: one row per document; null and empty texts get the classifier's score of no words; equal rows
get equal results; without any positive to learn from all scores are 0; null labels are not labels; several
labels of a document count as toxic if one does; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import stored, table
from chatloom.llm.textops import chunks, span_hashes, word_spans

#: Bound on the positive and on the unlabelled documents of the fit.
SAMPLE = 12_000
#: Words become features if so many distinct documents of the sample hold them, if their shares of positive and
#: of unlabelled documents lie this many standard errors apart, and if they are among so many such words.
LEAST_DOCS, APART, FEATURES = 5, 6.0, 1024
ROUNDS, RATE, DECAY = 400, 0.05, 1e-5
CUT = 0.7
#: Bytes between words: all of ASCII but letters and digits.
BETWEEN = np.array([not chr(c).isalnum() if c < 128 else False for c in range(256)])


#: Lengths in bytes of the word beginnings that count as features beside whole words.
BEGINNINGS = (4, 6, 8, 10)
#: Marks the feature that a text holds a feature twice or more.
TWICE = np.uint64(0x5851F42D4C957F2D)


def row_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature hashes, row of each): the whole words of a text and the beginnings of its longer words."""
    starts, ends, first = word_spans(data, offsets, BETWEEN)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    hashes, rows = [span_hashes(data, starts, ends)], [row]
    for n in BEGINNINGS:
        own = ends - starts > n
        hashes.append(span_hashes(data, starts[own], starts[own] + n) ^ np.uint64(n))
        rows.append(row[own])
    return np.concatenate(hashes), np.concatenate(rows)


@dataclass
class Classifier:
    words: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, hashes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        if not len(self.words):
            return np.zeros(rows)
        n = len(self.words)
        spot = np.minimum(np.searchsorted(self.words, hashes), n - 1)
        hit = np.flatnonzero(self.words[spot] == hashes)
        both = np.unique(row[hit] * n + spot[hit])
        again = hashes ^ TWICE
        spot = np.minimum(np.searchsorted(self.words, again), n - 1)
        hit = np.flatnonzero(self.words[spot] == again)
        pairs, times = np.unique(row[hit] * n + spot[hit], return_counts=True)
        both = np.concatenate([both, pairs[times > 1]])
        total = np.bincount(both // len(self.words), weights=self.weights[both % len(self.words)], minlength=rows) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def distinct_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """row_features without repeats, and the mark TWICE of those that repeat."""
    hashes, row = row_features(data, offsets)
    if not len(hashes):
        return hashes, row
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])])
    first = np.flatnonzero(new)
    often = np.diff(np.concatenate([first, [len(hashes)]])) > 1
    return np.concatenate([hashes[first], hashes[first[often]] ^ TWICE]), np.concatenate([row[first], row[first[often]]])


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in chunks(batch, "text"):
            hashes, row = distinct_features(data, offsets)
            marks = [part.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("positive", "unlabelled")]
            words, inverse = np.unique(hashes, return_inverse=True)
            p, u = (np.bincount(inverse, weights=m[row], minlength=len(words)).astype(np.int64) for m in marks)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(p), pa.array(u)], ["word", "p", "u"])


def _chosen_features(batches: Iterator[pa.RecordBatch], words: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The places in words of what each row holds."""
    for batch in batches:
        for part, data, offsets in chunks(batch, "text"):
            hashes, row = distinct_features(data, offsets)
            spot = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
            hit = words[spot] == hashes
            order = np.argsort(row[hit], kind="stable")
            at = np.concatenate([[0], np.cumsum(np.bincount(row[hit], minlength=len(part)))]).astype(np.int32)
            held = pa.ListArray.from_arrays(pa.array(at), pa.array(spot[hit][order].astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("positive"), part.column("unlabelled"), held], ["key", "positive", "unlabelled", "held"]
            )


def fit(words: np.ndarray, row: np.ndarray, col: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Classifier:
    """Trains on documents that hold feature col in row; positive: confirmed; unlabelled: drawn from all, confirmed ones among them."""
    docs = len(positive)
    w, b = np.zeros(len(words)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    share_p, share_u = positive / positive.sum(), unlabelled / unlabelled.sum()
    for t in range(1, ROUNDS + 1):
        f = np.bincount(row, weights=w[col], minlength=docs) + b
        p = 1 / (1 + np.exp(-np.clip(f, -40, 40)))
        loss_neg = np.logaddexp(0, f)
        rest = (share_u * loss_neg).sum() - prior * (share_p * loss_neg).sum()
        # d/df of log(1 + exp(-f)) is p - 1, of log(1 + exp(f)) is p.
        down = share_u * p - prior * share_p * p
        grad_f = prior * share_p * (p - 1) + down if rest >= 0 else -down
        grad = np.concatenate([np.bincount(col, weights=grad_f[row], minlength=len(w)) + DECAY * w, [grad_f.sum()]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Classifier(words, w, float(b))


def _few(key: Column, n: int, sample: int) -> Column:
    """About sample of n rows, the same for the same key."""
    return F.pmod(F.xxhash64(key), F.lit(1_000_000)) < F.lit(min(1_000_000, 1_000_000 * sample // max(n, 1)))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    """From docs(doc_id, text) and labels(doc_id, toxic), all of which may be learned from."""
    none = Classifier(np.zeros(0, dtype=np.uint64), np.zeros(0), 0.0)
    marked = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic"))
    counts = marked.agg(F.count("*").alias("n"), F.count_if("toxic").alias("p")).first()
    if not counts.p:
        return none
    prior = min(max(counts.p / counts.n, 1e-3), 0.9)
    known = marked.where("toxic").where(_few(F.col("doc_id"), counts.p, sample)).select("doc_id", F.lit(True).alias("positive"))
    chosen = _few(F.col("doc_id"), docs.count(), sample)
    # The sample bounds the positives' ids, so they can be broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id", "left").where(F.col("positive") | chosen)
    rows = rows.select(F.md5("text").alias("key"), "text", F.coalesce("positive", F.lit(False)).alias("positive"), chosen.alias("unlabelled"))
    # Copies would make any word of theirs look telling.
    rows = stored(rows.where("text IS NOT NULL").dropDuplicates(["key", "positive", "unlabelled"]), "toxicity-sample")
    size = rows.agg(F.count_if("positive").alias("p"), F.count_if("unlabelled").alias("u"), F.count("*").alias("n")).first()
    if not size.p or not size.u:
        return none
    found = rows.mapInArrow(_feature_counts, "word long, p long, u long").groupBy("word").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    share = (F.col("p") + F.col("u")) / (size.p + size.u)
    error = F.sqrt(share * (1 - share) * (1 / size.p + 1 / size.u))
    apart = found.withColumn("apart", F.abs(F.col("p") / size.p - F.col("u") / size.u) / F.greatest(error, F.lit(1e-12)))
    apart = apart.where((F.col("p") + F.col("u") >= LEAST_DOCS) & (F.col("apart") >= APART)).orderBy(F.desc("apart"), "word").limit(FEATURES)
    words = np.sort(np.array([r.word for r in apart.collect()], dtype=np.int64).view(np.uint64))
    if not len(words):
        return none
    got = rows.mapInArrow(lambda b: _chosen_features(b, words), "key string, positive boolean, unlabelled boolean, held array<int>")
    got = got.orderBy("key", "positive", "unlabelled").toArrow()
    held = got.column("held").combine_chunks()
    row = np.repeat(np.arange(len(got)), np.diff(held.offsets.to_numpy()))
    positive, unlabelled = (got.column(c).to_numpy().astype(bool) for c in ("positive", "unlabelled"))
    return fit(words, row, held.flatten().to_numpy(), positive, unlabelled, prior)


def _score(batches: Iterator[pa.RecordBatch], model: Classifier) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in chunks(batch, "text"):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(*row_features(data, offsets), len(part)))], ["doc_id", "score"])


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """(doc_id, score) of docs(doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(lambda b: _score(b, shared.value), "doc_id long, score double")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = learn(docs.where(~held_out), labels.where(~held_out))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
