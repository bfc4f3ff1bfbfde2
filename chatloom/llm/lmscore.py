"""LM scoring by masked pseudo-likelihood with a bidirectional window network.

Tokens are the UTF-8 bytes of a text, so no two characters of any script share their signs. The network sees
SIDE bytes on either side of a masked one, sums a learned vector for each place and byte, and predicts the
masked byte's upper half from one tanh layer and, given that, its lower half from a second one, each by a
softmax over 16. It is trained in numpy on the whole corpus: windows are counted over all documents by a
shuffle, and every round each partition of the distinct windows, PER_TASK in the mean, takes weighted Adam
steps from the shared parameters batch by batch; the results are averaged by the windows' counts, in Spark
till MERGE of them are left. A text's score is the sum over its bytes of the log-probability given both sides.

Defined results: null and empty texts have 0 tokens, sum 0 and a null mean; equal rows get equal results; an
untrained model (no text at all) is uniform; an empty table gives no rows; further columns are ignored; a very
long text is one row of the same sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import stored, table
from chatloom.llm.textops import chunks

SIDE, WIDTH = 2, 24
#: Signs: 0 beyond the text, then the bytes.
SIGNS, BITS = 257, 9
ROUNDS, BATCH, RATE = 3, 2048, 0.01
#: Distinct windows that a training task takes, and trained networks that one task averages.
PER_TASK, MERGE = 150_000, 32
#: Distinct windows that a task holds before it hands them on, and scores it remembers.
HELD = 1_000_000
PLACES = [k for k in range(-SIDE, SIDE + 1) if k]


def windows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The window codes of rows of bytes: BITS bits a place, the masked byte lowest."""
    rows = np.diff(offsets)
    # SIDE signs of the outside stand before each row and after the last.
    where = np.arange(len(data)) + np.repeat(np.arange(1, len(rows) + 1) * SIDE, rows)
    x = np.zeros(len(data) + SIDE * (len(rows) + 1), dtype=np.uint64)
    x[where] = data.astype(np.uint64) + np.uint64(1)
    code = np.zeros(len(data), dtype=np.uint64)
    for k in PLACES:
        code = code << np.uint64(BITS) | x[where + k]
    return code << np.uint64(BITS) | x[where]


def unpack(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signs by place, masked byte) of window codes."""
    n, mask = len(PLACES), np.uint64((1 << BITS) - 1)
    around = np.stack([(codes >> np.uint64(BITS * (n - k)) & mask).astype(np.int64) for k in range(n)], axis=1)
    return around, (codes & mask).astype(np.int64) - 1


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    low = logits - logits.max(axis=1, keepdims=True)
    return low - np.log(np.exp(low).sum(axis=1, keepdims=True))


class Network:
    """Window network. Parameters: vectors by place and sign, two hidden biases, vectors of the upper half for
    the second layer, and output weights and biases of both halves."""

    def __init__(self, parts: list[np.ndarray] | None = None, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        zeros = lambda *shape: np.zeros(shape, dtype=np.float32)
        self.parts = parts or [
            rng.normal(0, 0.3, (len(PLACES), SIGNS, WIDTH)).astype(np.float32),
            zeros(WIDTH), zeros(WIDTH), rng.normal(0, 0.3, (16, WIDTH)).astype(np.float32),
            zeros(WIDTH, 16), zeros(16), zeros(WIDTH, 16), zeros(16),
        ]

    def layers(self, around: np.ndarray, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Both hidden layers and the log-probabilities of both halves."""
        vectors, one, two, given, w1, b1, w2, b2 = self.parts
        total = vectors[0][around[:, 0]]
        for k in range(1, len(PLACES)):
            total = total + vectors[k][around[:, k]]
        h1, h2 = np.tanh(total + one), np.tanh(total + two + given[upper])
        return h1, h2, _log_softmax(h1 @ w1 + b1), _log_softmax(h2 @ w2 + b2)

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        out = np.empty(len(codes))
        for low in range(0, len(codes), 20_000):
            around, masked = unpack(codes[low : low + 20_000])
            _, _, p1, p2 = self.layers(around, masked >> 4)
            rows = np.arange(len(masked))
            out[low : low + 20_000] = p1[rows, masked >> 4].astype(float) + p2[rows, masked & 15]
        return out

    def gradient(self, codes: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
        """Of the weighted mean of the negative log-probabilities."""
        around, masked = unpack(codes)
        upper, rows = masked >> 4, np.arange(len(codes))
        h1, h2, p1, p2 = self.layers(around, upper)
        share = (weights / weights.sum())[:, None].astype(np.float32)
        p1, p2 = np.exp(p1), np.exp(p2)
        p1[rows, upper] -= 1
        p2[rows, masked & 15] -= 1
        p1, p2 = p1 * share, p2 * share
        back1, back2 = (p1 @ self.parts[4].T) * (1 - h1 * h1), (p2 @ self.parts[6].T) * (1 - h2 * h2)

        def by_sign(signs: np.ndarray, n: int, back: np.ndarray) -> np.ndarray:
            # Sums by sign through one product are faster than scattered additions.
            pick = np.zeros((n, len(codes)), dtype=np.float32)
            pick[signs, rows] = 1
            return pick @ back

        vectors = np.stack([by_sign(around[:, k], SIGNS, back1 + back2) for k in range(len(PLACES))])
        return [vectors, back1.sum(axis=0), back2.sum(axis=0), by_sign(upper, 16, back2), h1.T @ p1, p1.sum(axis=0), h2.T @ p2, p2.sum(axis=0)]


class Adam:
    """Steps on a network's parameters, window counts as weights."""

    def __init__(self, net: Network) -> None:
        self.net = Network([x.copy() for x in net.parts])
        self.m, self.v = ([np.zeros_like(x) for x in net.parts] for _ in range(2))
        self.t = self.seen = 0

    def step(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.t, self.seen = self.t + 1, self.seen + int(counts.sum())
        for i, g in enumerate(self.net.gradient(codes, counts.astype(np.float64))):
            self.m[i], self.v[i] = 0.9 * self.m[i] + 0.1 * g, 0.99 * self.v[i] + 0.01 * g * g
            move = RATE * (self.m[i] / (1 - 0.9**self.t)) / (np.sqrt(self.v[i] / (1 - 0.99**self.t)) + 1e-7)
            self.net.parts[i] = (self.net.parts[i] - move).astype(np.float32)


def _window_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts: what is held is added up and handed on once it passes HELD."""

    def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        codes, inverse = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate([n for _, n in parts])).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(counts)], ["code", "n"])

    held, size = [], 0
    for batch in batches:
        for _, data, offsets in chunks(batch, "text", lower=False):
            held.append(np.unique(windows(data, offsets), return_counts=True))
            size += len(held[-1][0])
            if size > HELD:
                yield added(held)
                held, size = [], 0
    if size:
        yield added(held)


WEIGHED = "n long, parts binary"


def _weighed(n: int, parts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n]), pa.array([parts.astype(np.float32).tobytes()], pa.binary())], ["n", "parts"])


def _train(batches: Iterator[pa.RecordBatch], net: Network) -> Iterator[pa.RecordBatch]:
    """One row: the parameters after this partition's windows, taken as they come, and how many bytes they stand for."""
    adam = Adam(net)
    for batch in batches:
        codes, counts = batch.column("code").to_numpy().view(np.uint64), batch.column("n").to_numpy()
        for low in range(0, len(codes), BATCH):
            adam.step(codes[low : low + BATCH], counts[low : low + BATCH])
    if adam.t:
        yield _weighed(adam.seen, np.concatenate([x.ravel() for x in adam.net.parts]))


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: the mean of the rows, by their weights."""
    total, seen = None, 0
    for batch in batches:
        for n, parts in zip(batch.column("n").to_pylist(), batch.column("parts").to_pylist(), strict=True):
            own = np.frombuffer(parts, dtype=np.float32).astype(np.float64) * n
            total, seen = own if total is None else total + own, seen + n
    if seen:
        yield _weighed(seen, total / seen)


def learn(docs: DataFrame) -> Network:
    """The network trained on all of docs(text)."""
    context = docs.sparkSession.sparkContext
    counts = docs.select("text").mapInArrow(_window_counts, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = stored(counts, "windows")
    net, tasks = Network(), -(-counts.count() // PER_TASK)
    # A fixed order that mixes the windows, so that every batch is a sample of its partition's.
    order = F.xxhash64("code", F.lit(1))
    for _ in range(ROUNDS if tasks else 0):
        now = context.broadcast(net)
        dealt = counts.repartition(tasks, "code").sortWithinPartitions(order, "code")
        got, left = dealt.mapInArrow(lambda b, now=now: _train(b, now.value), WEIGHED), tasks
        while left > MERGE:
            got, left = stored(got, "networks"), -(-left // MERGE)
            got = got.repartition(left).mapInArrow(_average, WEIGHED)
        rows = sorted((r.n, bytes(r.parts)) for r in got.collect())
        flat = np.average([np.frombuffer(p, dtype=np.float32) for _, p in rows], axis=0, weights=[n for n, _ in rows]).astype(np.float32)
        cuts = np.cumsum([x.size for x in net.parts])[:-1]
        net = Network([x.reshape(y.shape) for x, y in zip(np.split(flat, cuts), net.parts, strict=True)])
    return net


class Scorer:
    """Scores windows and remembers them."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self.codes, self.values = np.zeros(0, dtype=np.uint64), np.zeros(0)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        unique, inverse = np.unique(codes, return_inverse=True)
        if len(self.codes) > HELD:
            self.codes, self.values = np.zeros(0, dtype=np.uint64), np.zeros(0)
        spot = np.searchsorted(self.codes, unique)
        known = np.zeros(len(unique), dtype=bool)
        inside = spot < len(self.codes)
        known[inside] = self.codes[spot[inside]] == unique[inside]
        new = unique[~known]
        if len(new):
            at = np.searchsorted(self.codes, new)
            self.codes, self.values = np.insert(self.codes, at, new), np.insert(self.values, at, self.net.log_probabilities(new))
            spot = np.searchsorted(self.codes, unique)
        return self.values[spot][inverse]


def _score(batches: Iterator[pa.RecordBatch], net: Network) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(net)
    for batch in batches:
        for part, data, at in chunks(batch, "text", lower=False):
            codes = windows(data, at)
            sums = np.concatenate([[0.0], np.cumsum(scorer(codes))]) if len(codes) else np.zeros(1)
            n = np.diff(at)
            total = sums[at[1:]] - sums[at[:-1]]
            mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n), pa.array(np.where(n > 0, total, 0.0)), mean], ["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"]
            )


def score(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood) of docs(doc_id, text)."""
    given = docs.sparkSession.sparkContext.broadcast(net)
    return docs.select("doc_id", "text").mapInArrow(
        lambda b: _score(b, given.value), "doc_id long, n_tokens long, log_likelihood double, mean_log_likelihood double"
    )


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs))
