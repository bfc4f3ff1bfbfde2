"""Language identification by language-bitmask n-gram filters.

Learned from all documents dealt to training: the character n-grams (three characters within a word and its
borders, lower-cased) that make up at least SHARE of a language's n-grams, 1 / SHARE of them a language at
most. They go into one bit-sliced Bloom filter: each slot is a mask with a bit a language, in as many 64-bit words
as there are languages for, and the AND of an n-gram's slots gives all languages that hold it. A text's n-grams are counted by language; the counts are
corrected for the filter's false positives, and the greatest decides.

Defined results: `und` with score 0 for texts that are null or have no letter; with letters but no n-gram of
any language, the language with the most training n-grams, score 0; ties go to the first language in order;
documents without a language are predicted but not learned from; equal rows get equal results; with nothing
to learn from every prediction is `und`; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import stored, table
from chatloom.llm.textops import chunks, mix

SHARE = 5e-5
HASHES, SLOT_BITS = 3, 20
#: Languages that one word of a mask has bits for.
WORD = 64
#: Distinct n-grams that a task holds before it hands their counts on.
HELD = 2_000_000


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets by row) of UTF-8 rows."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points, heads[offsets]


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-grams, row of each, letters by row): an n-gram around every letter, other characters standing as one border sign."""
    points, at = code_points(data, offsets)
    is_letter = letters()[points] if len(points) else np.zeros(0, dtype=bool)
    x = np.zeros(len(points) + 2, dtype=np.uint64)
    x[1:-1] = np.where(is_letter, points, 0)
    grams = x[:-2] << np.uint64(42) | x[1:-1] << np.uint64(21) | x[2:]
    starts, ends = at[:-1][np.diff(at) > 0], at[1:][np.diff(at) > 0] - 1
    # Neighbours in other rows are borders too.
    grams[starts] &= np.uint64((1 << 42) - 1)
    grams[ends] &= ~np.uint64((1 << 21) - 1)
    own = np.flatnonzero(is_letter)
    row = np.searchsorted(at, own, "right") - 1
    return grams[own], row, np.bincount(row, minlength=len(offsets) - 1)


def _slots(grams: np.ndarray) -> Iterator[np.ndarray]:
    for k in range(HASHES):
        yield (mix(grams + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


class Filter:
    """The bit-sliced filter, and each language's chance of a false positive."""

    def __init__(self, langs: list[str], grams: list[np.ndarray], usual: int) -> None:
        self.langs, self.usual = langs, usual
        self.masks = np.zeros((-(-len(langs) // WORD), 1 << SLOT_BITS), dtype=np.uint64)
        for b, own in enumerate(grams):
            for slots in _slots(own):
                self.masks[b // WORD, slots] |= np.uint64(1 << b % WORD)
        fill = np.array([(self.masks[b // WORD] >> np.uint64(b % WORD) & np.uint64(1)).mean() for b in range(len(langs))])
        self.false = fill**HASHES

    def languages(self, grams: np.ndarray) -> np.ndarray:
        """For each n-gram the mask of the languages that hold it, a row a word."""
        out = np.full((len(self.masks), len(grams)), ~np.uint64(0), dtype=np.uint64)
        for slots in _slots(grams):
            out &= self.masks[:, slots]
        return out

    def decide(self, grams: np.ndarray, row: np.ndarray, n: np.ndarray) -> tuple[list[str], np.ndarray]:
        rows = len(n)
        if not self.langs:
            return ["und"] * rows, np.zeros(rows)
        masks = self.languages(grams)
        best, top, total = np.full(rows, self.usual), np.zeros(rows), np.zeros(rows)
        for b, false in enumerate(self.false):
            held = masks[b // WORD] >> np.uint64(b % WORD) & np.uint64(1)
            hits = np.bincount(row, weights=held.astype(float), minlength=rows)
            true = np.maximum((hits - n * false) / max(1 - false, 1e-9), 0)
            better = true > top
            best[better], top[better] = b, true[better]
            total += true
        score = np.where(total > 0, top / np.maximum(total, 1e-9), 0.0)
        return [self.langs[b] if k else "und" for b, k in zip(best, n, strict=True)], np.where(n > 0, score, 0.0)


def _count(batches: Iterator[pa.RecordBatch], langs: list[str]) -> Iterator[pa.RecordBatch]:
    """Partial counts of the languages' n-grams, HELD of them at a time."""
    known = {x: i for i, x in enumerate(langs)}
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def handed_on() -> Iterator[pa.RecordBatch]:
        for b, parts in held.items():
            grams, inverse = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            n = np.bincount(inverse, weights=np.concatenate([k for _, k in parts])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), b, dtype=np.int32)), pa.array(grams.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    for batch in batches:
        for part, data, offsets in chunks(batch, "text"):
            grams, row, _ = ngrams(data, offsets)
            lang = np.array([known[x] for x in part.column("lang").to_pylist()], dtype=np.int64)
            order = np.argsort(lang[row], kind="stable")
            grams, of = grams[order], lang[row][order]
            for b in np.unique(of):
                own = grams[np.searchsorted(of, b, "left") : np.searchsorted(of, b, "right")]
                held.setdefault(int(b), []).append(np.unique(own, return_counts=True))
                size += len(held[int(b)][-1][0])
            if size > HELD:
                yield from handed_on()
                held, size = {}, 0
    yield from handed_on()


def learn(docs: DataFrame) -> Filter:
    """The filter of docs(text, lang), all of whose rows are learned from."""
    docs = docs.select("text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    langs = sorted(r.lang for r in docs.select("lang").distinct().collect())
    if not langs:
        return Filter([], [], 0)
    counts = docs.mapInArrow(lambda b: _count(b, langs), "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = stored(counts, "ngrams")
    totals = stored(counts.groupBy("lang").agg(F.sum("n").alias("total")), "ngram-totals")
    total = {r.lang: r.total for r in totals.collect()}
    kept = counts.join(totals, "lang").where(F.col("n") >= SHARE * F.col("total")).select("lang", "gram").toArrow()
    lang, gram = kept.column("lang").to_numpy(), kept.column("gram").to_numpy().view(np.uint64)
    usual = max(range(len(langs)), key=lambda b: (total.get(b, 0), -b))
    return Filter(langs, [gram[lang == b] for b in range(len(langs))], usual)


def _predict(batches: Iterator[pa.RecordBatch], model: Filter) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in chunks(batch, "text"):
            langs, score = model.decide(*ngrams(data, offsets))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(langs, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])


def predict(docs: DataFrame, model: Filter) -> DataFrame:
    """(doc_id, lang_pred, score) of docs(doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(lambda b: _predict(b, shared.value), "doc_id long, lang_pred string, score double")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = learn(docs.where(~held_out))
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
