"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

A document is contaminated by an item if some stretch of it lies within RATE * length edits of the item
(lower-cased, every white-space character counted as a space). The CGK walk reads a string byte by byte and,
by random bits that depend on step and byte, stays or goes on; few edits leave most of what it reads equal,
so edit distance becomes Hamming distance. Several walks start at every STRIDE-th word of a document and at
every word of an item, and inside words of over LONG bytes at every EVERY-th character of a document and at
every character of an item, so text without spaces has windows too; per walk several samples of the steps give LSH keys. Windows that share a key with an
item are compared on their whole walks, and what stays near is verified by semi-global edit distance.

Items of SHORT bytes or more have walks of STEPS steps, shorter ones, down to LEAST bytes, of FEW steps, which every
word of a document starts. Items under PIECED bytes have few words to start a walk at, so beside their walks their pieces
are looked up, which leaves nothing to chance: one that may have k edits is cut into k + 2 pieces of whole characters, of
which two at least stand in the document unchanged, about as far apart; what the beginnings of two pieces meet is
verified in the same way. Items under LEAST bytes count where they stand exactly as they are, not inside a longer ASCII word; items
without any text are found nowhere.

Items are handled in blocks of at most BLOCK bytes and the last one's, an item counting for EACH bytes and for ENTRY bytes a
window at least, so what is broadcast has a bound (under 100 MB for text of any kind) and is released at the end; each
block takes one pass over the documents.

Defined results: one row per row of the documents, for any number of blocks; null and empty texts are clean; equal
rows get equal results; an empty benchmark leaves all clean, and empty documents give no rows; null item texts count
as empty; an item id on several rows stands for all of their texts; further columns are ignored; a very long text is
searched whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import stored, table, words
from chatloom.llm.textops import chunks, word_spans
from chatloom.operators.ordering import running_total

#: Edits per character of an item that still count as the item.
RATE = 0.1
STEPS, STRIDE = 56, 4
WALKS, TABLES, SAMPLES = 2, 4, 12
PIECED, SHORT, LEAST = 160, 80, 16
#: Steps of the walks of short items, about as many as they have bytes from a word on.
FEW = 24
#: Words of more bytes than LONG have starts inside, in a document one for EVERY characters.
LONG, EVERY = 24, 8
#: Bytes of a piece that are looked up.
SEED = 8
BLOCK, EACH, ENTRY = 4 << 20, 400, 8
#: Steps that two walks must agree on, as a share, before the edit distance is computed.
AGREE = 0.6
_BITS = 20
_MUL = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Walk:
    """One random walk: its bits by step and byte, and the steps that each table samples, in order."""

    bits: np.ndarray
    samples: list[list[int]]
    keys: list[np.ndarray] = field(default_factory=list)
    owners: list[np.ndarray] = field(default_factory=list)
    filters: list[np.ndarray] = field(default_factory=list)
    early: list[np.ndarray] = field(default_factory=list)


@dataclass
class Index:
    steps: int
    stride: int
    half: int
    items: list[tuple[int, bytes]]
    #: The items' bytes one after the other, and where in them each entry begins; and each entry's item and place in it.
    data: np.ndarray
    pos: np.ndarray
    entries: np.ndarray
    walks: list[Walk]


def _plain(text: str) -> bytes:
    raw = np.frombuffer(text.lower().encode(), dtype=np.uint8).copy()
    raw[(raw >= 9) & (raw <= 13)] = 32
    return raw.tobytes()


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys * _MUL) >> np.uint64(64 - _BITS)).astype(np.int64)


def run_walk(data: np.ndarray, pos: np.ndarray, walk: Walk, steps: int) -> np.ndarray:
    """What the walk reads from each position, a row a step."""
    out = np.empty((steps, len(pos)), dtype=np.uint8)
    pos = pos.copy()
    for j in range(steps):
        out[j] = data[pos]
        pos += walk.bits[j][out[j]]
    return out


def _keys(read: np.ndarray, sample: list[int]) -> np.ndarray:
    key = np.zeros(read.shape[1], dtype=np.uint64)
    for j in sample:
        key = key * _MUL + read[j] + np.uint64(1)
    return key


def inner_starts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, every: int) -> np.ndarray:
    """Each every-th character boundary inside the words of over LONG bytes."""
    long = np.flatnonzero(ends - starts > LONG)
    if not len(long):
        return np.zeros(0, dtype=np.int64)
    n = (ends - starts)[long]
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[long], n)
    word = np.repeat(np.arange(len(long)), n)
    head = (data[at] & 0xC0) != 0x80
    at, word = at[head], word[head]
    order = np.arange(len(at)) - np.searchsorted(word, word, "left")
    return at[(order > 0) & (order % every == 0)]


def build(items: list[tuple[int, bytes]], steps: int, stride: int, seed: int = 11) -> Index:
    """The index of the items: for each walk and table the sorted keys of the items' windows and their entries."""
    data = np.frombuffer(b"".join(t + b"\0" * (steps + 1) for _, t in items), dtype=np.uint8)
    base = np.cumsum([0] + [len(t) + steps + 1 for _, t in items])
    entries = []
    for k, (_, text) in enumerate(items):
        own = np.frombuffer(text, dtype=np.uint8)
        starts, ends, _ = word_spans(own, np.array([0, len(own)]))
        starts = np.concatenate([starts, inner_starts(own, starts, ends, 1)])
        entries += [(k, int(s)) for s in starts]
    entries = np.array(entries, dtype=np.int64).reshape(-1, 2)
    pos = (base[entries[:, 0]] + entries[:, 1]).astype(np.int64)
    ends = base[entries[:, 0]] + np.array([len(t) for _, t in items], dtype=np.int64)[entries[:, 0]]
    rng = np.random.default_rng(seed)
    walks = []
    half = steps // 2
    for _ in range(WALKS):
        bits = rng.integers(0, 2, (steps, 256), dtype=np.uint8)
        few = min(SAMPLES, steps)
        samples = []
        for _ in range(TABLES):
            first = rng.choice(half, few // 2, replace=False)
            rest = half + rng.choice(steps - half, few - few // 2, replace=False)
            samples.append(sorted(map(int, first)) + sorted(map(int, rest)))
        walk = Walk(bits, samples)
        read = run_walk(data, pos, walk, steps)
        last = pos + np.array([walk.bits[j][read[j]] for j in range(steps)]).sum(axis=0) if len(pos) else pos
        whole = np.flatnonzero(last <= ends)
        for sample in samples:
            keys = _keys(read, sample)[whole]
            order = np.argsort(keys, kind="stable")
            walk.keys.append(keys[order])
            walk.owners.append(whole[order].astype(np.int32))
            for part, into in ((sample, walk.filters), ([j for j in sample if j < half], walk.early)):
                bitmap = np.zeros(1 << _BITS, dtype=bool)
                bitmap[_slot(_keys(read, part)[whole])] = True
                into.append(bitmap)
        walks.append(walk)
    return Index(steps, stride, half, items, data, pos.astype(np.int32), entries.astype(np.int32), walks)


def candidates(data: np.ndarray, pos: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(position, entry) of the windows that share a key with an entry and agree with it on enough steps."""
    found_pos, found_entry = [], []
    for walk in index.walks:
        at, alive = pos.copy(), np.arange(len(pos))
        keys = [np.zeros(len(pos), dtype=np.uint64) for _ in walk.samples]
        wanted = [[t for t, s in enumerate(walk.samples) if j in s] for j in range(index.steps)]
        for j in range(index.steps):
            if j == index.half:
                hit = np.zeros(len(at), dtype=bool)
                for key, bitmap in zip(keys, walk.early, strict=True):
                    hit |= bitmap[_slot(key)]
                alive, at, keys = alive[hit], at[hit], [k[hit] for k in keys]
            read = data[at]
            for t in wanted[j]:
                keys[t] = keys[t] * _MUL + read + np.uint64(1)
            at += walk.bits[j][read]
        for key, bitmap, known, owners in zip(keys, walk.filters, walk.keys, walk.owners, strict=True):
            hit = np.flatnonzero(bitmap[_slot(key)])
            lo, hi = np.searchsorted(known, key[hit], "left"), np.searchsorted(known, key[hit], "right")
            n = hi - lo
            if not n.sum():
                continue
            ends = np.cumsum(n)
            entry = owners[np.arange(ends[-1]) - np.repeat(ends - n - lo, n)]
            where = pos[alive[np.repeat(hit, n)]]
            for low in range(0, len(entry), 1 << 16):
                own, there = entry[low : low + (1 << 16)], where[low : low + (1 << 16)]
                # An item's walk is made again, which is shorter than keeping the walks of all entries.
                agree = run_walk(data, there, walk, index.steps) == run_walk(index.data, index.pos[own].astype(np.int64), walk, index.steps)
                near = agree.mean(axis=0) >= AGREE
                found_pos.append(there[near]), found_entry.append(own[near])
    if not found_pos:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    both = np.unique(np.stack([np.concatenate(found_pos), np.concatenate(found_entry)]), axis=1)
    return both[0], both[1]


@dataclass
class Seeds:
    """Beginnings of the pieces of short items: by width the sorted keys, and the item and place of each."""

    items: list[tuple[int, bytes]]
    widths: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    #: Bytes that an item's edits can move its pieces by.
    spread: np.ndarray


def seed_keys(data: np.ndarray, width: int) -> np.ndarray:
    """The width bytes from each position of data as one number; data is followed by width zeros."""
    padded = np.concatenate([data, np.zeros(width, dtype=np.uint8)])
    key = np.zeros(len(data), dtype=np.uint64)
    for j in range(width):
        key = key << np.uint64(8) | padded[j : j + len(data)]
    return key


def build_seeds(items: list[tuple[int, bytes]], rate: float) -> Seeds:
    rows: dict[int, list[tuple[int, int, int]]] = {}
    for k, (_, item) in enumerate(items):
        text = item.decode("utf-8")
        pieces = 1 if len(item) < LEAST else int(rate * len(text)) + 2
        cuts = [len(text[: len(text) * i // pieces].encode()) for i in range(pieces + 1)]
        width = min(SEED, *(b - a for a, b in zip(cuts[:-1], cuts[1:], strict=True)))
        for a in cuts[:-1] if width else [0]:
            rows.setdefault(width, []).append((int.from_bytes(item[a : a + width], "big"), k, a))
    widths = {}
    for width, found in rows.items():
        keys = np.array([x for x, _, _ in found], dtype=np.uint64)
        order = np.argsort(keys, kind="stable")
        owners, places = (np.array([x[i] for x in found], dtype=np.int64)[order] for i in (1, 2))
        bitmap = np.zeros(1 << _BITS, dtype=bool)
        bitmap[_slot(keys)] = True
        widths[width] = keys[order], owners, places, bitmap
    return Seeds(items, widths, np.array([int(4 * rate * len(t)) + 1 for _, t in items], dtype=np.int64))


def seeded(data: np.ndarray, offsets: np.ndarray, seeds: Seeds) -> Iterator[tuple[int, int, int]]:
    """(row, item, place where the item would begin) for the pieces met in data, about once for each 16 bytes."""
    found, whole = [], seed_keys(data, SEED) if seeds.widths else None
    for width, (known, owners, places, bitmap) in seeds.widths.items():
        keys = whole >> np.uint64(8 * (SEED - width))
        at = np.flatnonzero(bitmap[_slot(keys)])
        lo, hi = np.searchsorted(known, keys[at], "left"), np.searchsorted(known, keys[at], "right")
        n = hi - lo
        if n.sum():
            ends = np.cumsum(n)
            entry = np.arange(ends[-1]) - np.repeat(ends - n - lo, n)
            where = np.repeat(at, n)
            found.append(np.stack([np.searchsorted(offsets, where, "right") - 1, owners[entry], where - places[entry], places[entry]]))
    if found:
        row, item, begin, place = np.unique(np.concatenate(found, axis=1), axis=1)
        exact = np.array([len(t) < LEAST for _, t in seeds.items])[item]
        hit = np.flatnonzero(exact | in_company(row, item, begin, place, seeds.spread))
        row, item, begin, exact = row[hit], item[hit], begin[hit], exact[hit]
        # Items that must stand exactly are tried at each place.
        _, first = np.unique(np.stack([row, item, np.where(exact, begin, begin // 16)]), axis=1, return_index=True)
        yield from zip(row[first].tolist(), item[first].tolist(), begin[first].tolist(), strict=True)


def in_company(row: np.ndarray, item: np.ndarray, begin: np.ndarray, place: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Whether another piece of the same item is met about as far from the item's beginning; hits sorted by row, item and begin."""
    n = len(row)
    other = np.concatenate([[True], (row[1:] != row[:-1]) | (item[1:] != item[:-1])])
    starts = np.flatnonzero(other | np.concatenate([[True], place[1:] != place[:-1]]))
    run = np.searchsorted(starts, np.arange(n), "right") - 1
    before, after = starts[run] - 1, np.concatenate([starts, [n]])[run + 1]
    out = np.zeros(n, dtype=bool)
    for near in (before, after):
        ok = (near >= 0) & (near < n)
        at = np.where(ok, near, 0)
        out |= ok & (row[at] == row) & (item[at] == item) & (np.abs(begin[at] - begin) <= spread[item])
    return out


def _stands(item: bytes, text: bytes, begin: int) -> bool:
    """Whether item stands in text at begin, not as a part of a longer ASCII word."""
    end = begin + len(item)
    if begin < 0 or text[begin:end] != item:
        return False
    word = lambda b: b.isascii() and b.isalnum()
    return not (word(item[:1]) and word(text[max(begin - 1, 0) : begin]) or word(item[-1:]) and word(text[end : end + 1]))


def least_edits(item: str, text: str) -> int:
    """Least edit distance of item and any stretch of text, by bit vectors over the item's characters."""
    m = len(item)
    if not m or item in text:
        return 0
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << m - 1
    up, down, score = full, 0, m
    best = m
    for c in text:
        eq = masks.get(c, 0)
        rows = eq | down
        columns = (((eq & up) + up) ^ up) | eq
        plus, minus = (down | ~(columns | up)) & full, up & columns
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        # No carry into the lowest bit: a match may begin anywhere in text.
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = (minus | ~(rows | plus)) & full, plus & rows
        best = min(best, score)
    return best


@lru_cache(maxsize=20_000)
def _grams(item: str, q: int) -> frozenset[str]:
    return frozenset(item[i : i + q] for i in range(len(item) - q + 1))


def may_hold(item: str, text: str, edits: int, q: int = 4) -> bool:
    """False only if no stretch of text can be within the edits: each edit breaks q of the item's q-grams at most."""
    own = _grams(item, q)
    least = len(own) - q * edits
    return least <= 0 or len(own.intersection([text[i : i + q] for i in range(len(text) - q + 1)])) >= least


def search(batches: Iterator[pa.RecordBatch], indexes: list[Index], rate: float, seeds: Seeds, keys: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in chunks(batch, "text"):
            padded = np.concatenate([data, np.zeros(PIECED + STEPS + 2, dtype=np.uint8)])
            padded[(padded >= 9) & (padded <= 13)] = 32
            starts, ends, first = word_spans(data, offsets)
            inner = inner_starts(data, starts, ends, EVERY)
            rows = len(offsets) - 1
            row = np.repeat(np.arange(rows), np.diff(first))
            hits: list[set[int]] = [set() for _ in range(rows)]
            for r, k, begin in seeded(padded[: len(data)], offsets, seeds):
                item_id, item = seeds.items[k]
                low, high = int(offsets[r]), int(offsets[r + 1])
                if item_id in hits[r]:
                    continue
                if len(item) < LEAST:
                    if begin >= low and _stands(item, padded[max(low, begin - 1) : min(high, begin + len(item) + 1)].tobytes(), begin - max(low, begin - 1)):
                        hits[r].add(item_id)
                    continue
                slack = int(4 * rate * len(item)) + 32
                region = padded[max(low, begin - slack) : min(high, begin + len(item) + slack)].tobytes().decode("utf-8", "ignore")
                word = item.decode("utf-8")
                most = int(rate * len(word))
                if may_hold(word, region, most) and least_edits(word, region) <= most:
                    hits[r].add(item_id)
            for index in indexes:
                pick = (np.arange(len(starts)) - first[row]) % index.stride == 0 if index.stride > 1 else slice(None)
                pos, entry = candidates(padded, np.concatenate([starts[pick], inner]), index)
                tried: set[tuple[int, int, int]] = set()
                for p, e in zip(pos.tolist(), entry.tolist(), strict=True):
                    k, offset = map(int, index.entries[e])
                    item_id, item = index.items[k]
                    r = int(np.searchsorted(offsets, p, "right")) - 1
                    if item_id in hits[r] or (r, k, (p - offset) // 16) in tried:
                        continue
                    tried.add((r, k, (p - offset) // 16))
                    slack = int(4 * rate * len(item)) + 32
                    a, b = max(int(offsets[r]), p - int(offset) - slack), min(int(offsets[r + 1]), p - int(offset) + len(item) + slack)
                    region = padded[a:b].tobytes().decode("utf-8", "ignore")
                    word = item.decode("utf-8")
                    most = int(rate * len(word))
                    if may_hold(word, region, most) and least_edits(word, region) <= most:
                        hits[r].add(item_id)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(k) for k in keys), pa.array([sorted(h) for h in hits], pa.list_(pa.int64()))], [*keys, "item_ids"]
            )


def in_blocks(items: DataFrame, block: int = BLOCK) -> DataFrame:
    """items(item_id, text) with the number of the block that each is in."""
    long = F.filter(words(F.col("text")), lambda w: F.octet_length(w) > LONG)
    entries = F.size(words(F.col("text"))) + F.aggregate(long, F.lit(0), lambda n, w: n + F.length(w) - 1)
    counted = running_total(items, ["item_id", "text"], F.greatest(F.octet_length("text"), F.lit(EACH), ENTRY * entries), "before")
    return counted.select("item_id", "text", F.floor(F.col("before") / block).alias("block"))


def find_items(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_ids): for each row of docs the ids of the items that contaminate it, in order."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    placed = stored(in_blocks(items, block), "items")
    blocks = sorted(r.block for r in placed.select("block").distinct().collect()) or [0]
    own, keys = docs.select("doc_id", "text"), ["doc_id"]
    if len(blocks) > 1:
        # The blocks' results meet again by row.
        own, keys = stored(own.withColumn("row", F.monotonically_increasing_id()), "numbered-documents"), ["row", "doc_id"]
    out, broadcasts = None, []
    for b in blocks:
        rows = sorted({(r.item_id, _plain(r.text)) for r in placed.where(F.col("block") == b).collect()})
        classes = [([x for x in rows if len(x[1]) >= SHORT], STEPS, STRIDE), ([x for x in rows if LEAST <= len(x[1]) < SHORT], FEW, 1)]
        indexes = [build(x, steps, stride) for x, steps, stride in classes if x]
        seeds = build_seeds([x for x in rows if len(x[1]) < PIECED and x[1].strip()], rate)
        shared = spark.sparkContext.broadcast((indexes, seeds))
        broadcasts.append(shared)
        got = own.mapInArrow(
            lambda it, shared=shared: search(it, shared.value[0], rate, shared.value[1], keys), ", ".join(f"{k} long" for k in keys) + ", item_ids array<bigint>"
        )
        out = got if out is None else out.unionByName(got)
    if len(blocks) > 1:
        out = out.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids")).drop("row")
    # What is found is a few ids a row; once it is written the indexes can go.
    out = stored(out, "found-items")
    for shared in broadcasts:
        shared.destroy()
    return out


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), F.size("item_ids").cast("long").alias("n_items"), "item_ids")
